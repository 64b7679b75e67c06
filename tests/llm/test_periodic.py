"""Periodic runs against a scan of every period."""

import random

import pytest

from millrace.llm.periodic import collapsed, find_runs, runs_of, shared_prefixes, suffix_order


def brute_runs(w, least=6, exponent=4):
    """Every period q: stretches where words q apart are equal; of one stretch the smallest period counts."""
    out = {}
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, exponent * q) and j > i:
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, l, q) for (s, l), q in out.items()), key=lambda r: (r[0], r[2]))


def brute_collapsed(w, runs):
    gone = {i for s, l, q in runs for i in range(s + q, s + l)}
    return b" ".join(x for i, x in enumerate(w) if i not in gone)


def random_text(rnd):
    w = []
    for _ in range(rnd.randint(0, 6)):
        w += [bytes([97 + rnd.randrange(rnd.choice([1, 2, 3, 6]))]) for _ in range(rnd.randint(1, 7))] * rnd.randint(1, 7)
        w = w[:len(w) - rnd.randint(0, 3)]
    return w


@pytest.mark.parametrize("least, exponent", [(6, 4), (6, 3), (2, 3), (20, 5)])
def test_random_texts(least, exponent):
    rnd = random.Random(least)
    for _ in range(400):
        batch = [random_text(rnd) for _ in range(rnd.randint(1, 4))]
        got = runs_of(batch, least, exponent)
        assert got == [brute_runs(w, least, exponent) for w in batch]
        for w, runs in zip(batch, got):
            assert collapsed(w, runs) == brute_collapsed(w, runs)


def test_suffixes_and_shared_prefixes():
    import numpy as np
    rnd = random.Random(5)
    for _ in range(100):
        ids = np.array([rnd.randrange(3) for _ in range(rnd.randint(1, 300))] + [9])
        if rnd.random() < 0.5:
            ids = np.append(np.tile(ids[:-1], 3), 9)
        order = suffix_order(ids)
        want = sorted(range(len(ids)), key=lambda i: ids[i:].tolist())
        assert order.tolist() == want
        match = lambda a, b: next(k for k in range(len(ids)) if ids[a + k] != ids[b + k])
        assert shared_prefixes(ids, order).tolist()[1:] == [match(a, b) for a, b in zip(want, want[1:])]


def test_long_texts():
    rnd = random.Random(2)
    some = [b"%d" % rnd.randrange(10 ** 6) for _ in range(5000)]
    line = b"a b c d e f".split()
    apart = [w for i in range(20000) for w in [b"%d" % (i % 500), *line]]
    assert runs_of([[b"ha"] * 100000, some * 8, apart]) == [[(0, 100000, 1)], [(0, 40000, 5000)], [(0, 140000, 3500)]]


def test_find_runs(llm, odd):
    rows = find_runs(odd).collect()
    assert len(rows) == odd.count()
    texts = sorted((r.text or "") for r in odd.select("text").collect())
    want = []
    for t in texts:
        w = t.encode().split()
        runs = brute_runs(w)
        want.append((brute_collapsed(w, runs).decode(), runs))
    assert sorted((r.collapsed, [tuple(x) for x in r.runs]) for r in rows) == sorted(want)


def test_find_runs_of_nothing(llm, empty):
    out = find_runs(empty)
    assert out.columns == ["doc_id", "runs", "collapsed"] and out.count() == 0
    with pytest.raises(ValueError):
        find_runs(empty, exponent=2)
