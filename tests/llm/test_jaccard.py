"""The Jaccard join against all pairs of sets."""

import random
from fractions import Fraction

import numpy as np
import pytest

from millrace.llm import jaccard
from millrace.llm.jaccard import shingle_sets, signatures, similar_groups


def brute_set(text, n=3):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute_similar(rows, percent=90, n=3):
    """id -> (size, smallest id reachable), by all pairs."""
    sets = [brute_set(t, n) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and root(i) != root(j) and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                common = len(a & b)
                if 100 * common >= percent * (len(a) + len(b) - common):
                    label[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        known = least.get(root(i))
        least[root(i)] = doc if known is None else known if doc is None else min(known, doc)
    return sorted(((doc, len(sets[i]), least[root(i)]) for i, (doc, _) in enumerate(rows)), key=str)


def varied(rnd, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rnd.randrange(len(words) + 1)
        kind = rnd.random()
        if kind < 0.4 and at < len(words):
            words[at] = f"new{rnd.randrange(10 ** 6)}"
        elif kind < 0.7:
            words.insert(at, f"new{rnd.randrange(10 ** 6)}")
        elif at < len(words):
            del words[at]
    return words


def planted(rnd, groups, size):
    """Groups of texts at and around the threshold, in chains and stars."""
    texts = []
    for _ in range(groups):
        base = [f"w{rnd.randrange(5000)}" for _ in range(rnd.randint(2, 300))]
        chain = base
        for _ in range(rnd.randint(1, size)):
            edits = rnd.randint(0, max(1, len(base) // 40))
            chain = varied(rnd, chain, edits) if rnd.random() < 0.5 else varied(rnd, base, edits)
            texts.append(" ".join(chain))
    return texts


def docs_of(llm, rows):
    return llm.createDataFrame(rows, "doc_id bigint, text string").repartition(4)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("percent", [90, 75])
def test_against_all_pairs(llm, percent):
    rnd = random.Random(percent)
    rows = list(enumerate(planted(rnd, 40, 8)))
    rows += [(1000 + i, t) for i, (_, t) in enumerate(rows[:30])]
    rnd.shuffle(rows)
    assert result(similar_groups(docs_of(llm, rows), percent=percent)) == brute_similar(rows, percent)


def test_a_large_group_of_near_copies(llm):
    """Borderline copies of one text: many links are found in no star, and many pairs just miss."""
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(varied(rnd, base, rnd.randint(1, 7)))) for i in range(250)] + [(1000 + i, " ".join(base)) for i in range(100)]
    got = result(similar_groups(docs_of(llm, rows)))
    assert got == brute_similar(rows)
    assert 1 < len({c for _, _, c in got}) < 250


def test_linked_sets_share_a_signature():
    """The guarantee of PartEnum, at the very edge of the threshold and over neighbouring size bands."""
    rnd = random.Random(1)
    share = Fraction(9, 10)
    for _ in range(300):
        size = rnd.randint(10, 400)
        base = np.array([rnd.getrandbits(64) for _ in range(size)], np.uint64)
        gone = rnd.randint(0, size // 10)
        more = 0
        while 100 * (size - gone) >= 90 * (size + more + 1):
            more += 1
        if 100 * (size - gone) < 90 * (size + more):
            continue
        other = np.concatenate([base[gone:], np.array([rnd.getrandbits(64) for _ in range(more)], np.uint64)])
        if len(other) == size and not gone:
            continue
        sets = [np.sort(base), np.sort(other)]
        a, b = signatures(np.concatenate(sets), np.array([0, size, size + len(other)]), share)
        assert set(a.tolist()) & set(b.tolist())


def test_signatures_do_not_depend_on_the_batch():
    texts = [b"a b c d e f g h i j k l m n o p q r s t u v w x y z " * 2, b"", b"one", b"one two", b"x " * 50, b"q w e r t y u i o p a s d f g h"]
    together, at = shingle_sets(texts)
    whole = signatures(together, at, Fraction(9, 10))
    for i, t in enumerate(texts):
        grams, alone = shingle_sets([t])
        assert together[at[i]:at[i + 1]].tolist() == grams.tolist()
        assert signatures(grams, alone, Fraction(9, 10))[0].tolist() == whole[i].tolist()


def test_odd_rows(llm, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = similar_groups(odd)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    want = brute_similar(rows)
    # rows without words stand alone: their own id, null for null
    assert result(got) == want
    assert similar_groups(empty).count() == 0
    with pytest.raises(ValueError):
        similar_groups(empty, percent=100)


def test_one_long_text(llm):
    rnd = random.Random(6)
    long = [f"w{rnd.randrange(10 ** 6)}" for _ in range(60000)]
    rows = [(1, " ".join(long)), (2, " ".join(varied(rnd, long, 300))), (3, " ".join(long[:40000])), (4, "short one here")]
    assert result(similar_groups(docs_of(llm, rows))) == brute_similar(rows)
    assert jaccard.differing(100, Fraction(9, 10)) == 10
