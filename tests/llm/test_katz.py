import math
import random
from collections import Counter
from functools import cache
from pathlib import Path
from zlib import crc32

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from millrace.llm import katz


def brute(rows, order=3):
    """The model word by word, from dictionaries."""
    texts = [("" if t is None else t).encode().lower().split() + [None] for _, t in rows]
    held = [crc32(str("" if i is None else i).encode()) % 10 == 0 for i, _ in rows]
    words, pairs, context = Counter(), Counter(), Counter()
    triples, after_one, after_two = Counter(), {}, {}
    for text, out in zip(texts, held):
        if not out:
            words.update(text)
            for pair in zip([b"<s>", *text], text):
                pairs[pair] += 1
                context[pair[0]] += 1
                after_one.setdefault(pair[0], set()).add(pair[1])
            for g, h, w in zip([b"<s>", *text], text, text[1:]):
                triples[g, h, w] += 1
                after_two.setdefault((g, h), set()).add(w)
    total, distinct = sum(words.values()), len(words)

    def discounts(counts):
        return katz.Discounts.fit(dict(Counter(counts.values())))

    of_words, of_pairs, of_triples = discounts(words), discounts(pairs), discounts(triples)

    worth = {}

    def d(discount, r):
        if (id(discount), r) not in worth:
            worth[id(discount), r] = float(discount.of(np.array([r]))[0])
        return worth[id(discount), r]

    unknown = 1 - sum(d(of_words, r) * r for r in words.values()) / total if total else 1.0

    @cache
    def low(w):
        return (d(of_words, words[w]) * words[w] / total if words[w] else unknown) if total else 1.0

    @cache
    def weight(h):
        after = after_one[h]
        left = 1 - sum(d(of_pairs, pairs[h, w]) * pairs[h, w] for w in after) / context[h]
        return left / (1 - sum(low(w) for w in after))

    def chance(h, w):
        if pairs[h, w]:
            return d(of_pairs, pairs[h, w]) * pairs[h, w] / context[h]
        return low(w) * (weight(h) if context[h] else 1)

    @cache
    def weight_two(g, h):
        after = after_two[g, h]
        left = 1 - sum(d(of_triples, triples[g, h, w]) * triples[g, h, w] for w in after) / pairs[g, h]
        return left / (1 - sum(chance(h, w) for w in after))

    def chance_two(g, h, w):
        if triples[g, h, w]:
            return d(of_triples, triples[g, h, w]) * triples[g, h, w] / pairs[g, h]
        return chance(h, w) * (weight_two(g, h) if pairs[g, h] else 1)

    out = []
    for (doc, _), text, is_out in zip(rows, texts, held):
        base = sum(math.log10((words[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in text)
        score = math.log10(chance(b"<s>", text[0]))
        for g, h, w in zip([b"<s>", *text], text, text[1:]):
            score += math.log10(chance_two(g, h, w) if order > 2 else chance(h, w))
        out.append((doc, is_out, len(text), sum(words[w] > 0 for w in text), total, base, score))
    vocabulary = [*words, "unknown"]
    sums = [sum(chance(h, w) for w in vocabulary) for h in [*context][:40]]
    sums += [sum(chance_two(g, h, w) for w in vocabulary) for g, h in [*after_two][:40]]
    return out, sums


def close(got, want):
    key = lambda r: (str(r[0]), r[2], round(r[5], 6), r[6])
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("order", [2, 3])
@pytest.mark.parametrize("batch", [50, 1 << 20])
def test_against_brute_force(llm, batch, order):
    rng = random.Random(batch)
    words = ["w%d" % int(rng.expovariate(0.05)) for _ in range(3000)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 40)))) for i in range(150)]
    rows += [(i, "always the same words here") for i in range(200, 240)]
    docs = llm.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = [tuple(r) for r in katz.score_documents(docs, batch_tokens=batch, order=order).collect()]
    want, sums = brute(rows, order)
    assert any(r[1] for r in want)
    close(got, want)
    assert sums == pytest.approx([1.0] * len(sums))


def test_packing():
    rng = np.random.default_rng(1)
    for values in (np.zeros(0, np.uint8), np.arange(300, dtype=np.uint16), rng.random(50)):
        assert (katz.unpack(katz.pack(values)) == values).all()
    keys = np.unique(rng.integers(0, 1 << 64, 1000, dtype=np.uint64))
    assert (katz.unpack_sorted(katz.pack_sorted(keys)) == keys).all()
    for parts in (1, 3, 211):
        dealt = [(p, i) for p, a, b in katz._spans(keys, parts) for i in range(a, b)]
        assert [i for _, i in dealt] == list(range(len(keys)))
        assert all(p == int(keys[i]) * parts >> 64 for p, i in dealt)


def test_odd_rows(llm, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    close([tuple(r) for r in katz.score_documents(odd).collect()], brute(rows)[0])
    assert katz.score_documents(empty).collect() == []


def test_without_training_rows(llm):
    docs = llm.createDataFrame([(None, "a b"), (None, None)], "doc_id bigint, text string")
    got = {r.n_tokens: r for r in katz.score_documents(docs).collect()}
    assert got[3].score == 0 and got[3].train_tokens == 0 and got[3].base_score == pytest.approx(0)


def test_batches_ask_only_for_triples_of_shared_pairs(llm, monkeypatch):
    """A triple that holds a pair of one batch, which no held-out text has, is known without being asked for."""
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(6)) + " the end of it") for i in range(60)]
    asked = []

    def settle(df, label, **options):
        out = kept(df, label, **options)
        if label == "answers":
            asked.append(sum(len(katz.unpack(r.counts)) for r in out.where("kind = 'triple'").collect()))
        return out

    kept = katz.settle
    monkeypatch.setattr(katz, "settle", settle)
    got = [tuple(r) for r in katz.score_documents(llm.createDataFrame(rows, "doc_id bigint, text string").repartition(3), batch_tokens=100).collect()]
    close(got, brute(rows)[0])
    assert sum(asked) < 200  # the texts have 600


def test_packing_of_repeated_numbers():
    for values in ([], [0.5], [0.1, 0.2] * 300, list(np.random.default_rng(1).random(500))):
        assert katz.unpack_repeated(katz.pack_repeated(np.array(values, float))).tolist() == values


def test_rows_of_megabytes_are_not_gathered_by_the_hundred(llm):
    """Writers and readers hold a row group: a few large rows make one, not all rows of a task."""
    rows = llm.range(0, 30, 1, 1).select("id", F.expr("CAST(repeat('x', 1 << 20) AS BINARY)").alias("packed"))
    made = []
    assert katz._settle_rows(rows, "large", made).agg(F.sum(F.length("packed"))).first()[0] == 30 << 20
    file, = Path(made[0].removeprefix("file:")).glob("*.parquet")
    groups = [pq.ParquetFile(file).metadata.row_group(i) for i in range(pq.ParquetFile(file).num_row_groups)]
    assert max(g.total_byte_size for g in groups) < 12 << 20
    assert all(g.column(1).compression == "UNCOMPRESSED" for g in groups)


def test_batches_and_answers_meet_in_python(llm, monkeypatch):
    """No Spark row holds all answers of a batch."""
    rows = [(i, f"some words of text {i % 7} here") for i in range(60)]
    plans = []

    def settle(df, label, **options):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return kept(df, label, **options)

    kept = katz.settle
    monkeypatch.setattr(katz, "settle", settle)
    scored = katz.score_documents(llm.createDataFrame(rows, "doc_id bigint, text string").repartition(3), batch_tokens=50)
    plans.append(scored._jdf.queryExecution().optimizedPlan().toString())
    assert len(plans) == 5 and not any("Join" in p or "collect_list" in p for p in plans)
    close([tuple(r) for r in scored.collect()], brute(rows)[0])


def test_files_are_read_by_a_few_rows(llm, monkeypatch):
    """A reader's arrays of texts and lists don't grow with the rows of a file; the session's setting comes back."""
    name, seen = "spark.sql.parquet.columnarReaderBatchSize", []

    def settle(df, label, **options):
        seen.append(int(llm.conf.get(name)))
        return kept(df, label, **options)

    before, kept = llm.conf.get(name), katz.settle
    monkeypatch.setattr(katz, "settle", settle)
    assert katz.score_documents(llm.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")).count() == 2
    assert len(seen) == 4 and max(seen) <= 64 and llm.conf.get(name) == before
