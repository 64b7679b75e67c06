import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import bpe, quality_model

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(bpe.default_path())


PARTS = ["a", "e", "t", "ing", "the", "'s", "'ll", "’", "'", " ", "\n", "1", "99", ".", "!!", "é", "É", "ß", "İ", "Σ", "ü", "ü", "你好", " ", "\x1c",
         "²", "<|endoftext|>", "<|startoftext|", "|>", "😀", "_", "€", "ſ", "​", "\x00", "\x85", "ŉ", "А", "aaaa", "don't", "they've"]


def test_ids_are_the_librarys(llm, library, odd, empty):
    rng = random.Random(1)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 30))) for _ in range(2000)]
    texts += ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(1, 40))) for _ in range(2000)]
    texts += ["ab" * 3000, "ha " * 1000, "x" * 3_000, ""]
    rows = [*enumerate(texts), (None, None), (7, texts[7])]
    docs = llm.createDataFrame(rows, "doc_id bigint, text string")
    encoded = bpe.encode_documents(docs)
    got = sorted((str(r.doc_id), r.n_tokens, r.ids, r.ids_sha256, r.decoded_sha256) for r in encoded.collect())
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((str(i), len(ids), ids, hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want)
    decoded = bpe.decode_documents(encoded).join(encoded.select("doc_id", "decoded_sha256"), "doc_id")
    assert decoded.where(F.sha2("text", 256) != F.col("decoded_sha256")).count() == 0
    assert bpe.encode_documents(empty).collect() == [] and bpe.encode_documents(odd).count() == odd.count()


def test_batches_give_what_single_texts_give(library):
    one, many = (bpe.Bpe(open(bpe.default_path(), encoding="utf-8").read()) for _ in range(2))
    rng = random.Random(2)
    texts = ["".join(rng.choices(PARTS + ["word ", "Wort, "], k=rng.randint(0, 60))) for _ in range(300)]
    for text, ids in zip(texts, many.encode_batch(texts)):
        assert ids.tolist() == one.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        bpe.Bpe('{"model": {"type": "Unigram"}, "added_tokens": []}')


def graded(n, seed):
    """Grades 0, 1, 2 by marker words of two kinds."""
    rng = random.Random(seed)
    plain = ["word%d" % i for i in range(300)]
    rows = []
    for i in range(n):
        g = rng.choice([0, 1, 2, 2, 2])
        words = rng.choices(plain, k=rng.randint(20, 80))
        for marker in (["nasty", "vileness"], ["***", "junk***"], [])[g]:
            words[rng.randrange(len(words))] = marker
        rows.append((i, " ".join(words), g))
    return rows


def test_held_out_accuracy(llm):
    rows = graded(900, 1)
    docs = llm.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = llm.createDataFrame([(r[0], r[2]) for r in rows if r[0] < 600], "doc_id bigint, g int")
    model = quality_model.train_quality(docs, labels, F.col("g"), 3)
    assert model.thresholds[0] < model.thresholds[1]
    got = {r.doc_id: r for r in quality_model.grade_documents(docs, model).collect()}
    held = [(got[i], g) for i, _, g in rows if i >= 600]
    assert np.mean([r.kept == (g == 2) for r, g in held]) > 0.95
    means = [np.mean([r.expected for r, g in held if g == k]) for k in range(3)]
    assert means[0] < means[1] < means[2]
    low = {r.doc_id: r.tail for r in quality_model.grade_documents(docs, model, at_least=1).collect()}
    assert all(low[i] >= got[i].tail for i in low)


def test_gradient_descends_to_the_shares():
    rows = [(b"same words", g) for g in (0, 1, 1, 2, 2, 2, 2, 2)]
    model = quality_model.fit_ordinal(rows, 3, rounds=2000, rate=0.05)
    tails = model.tails([model.score(b"same words")])[0]
    weight = np.array([1 / np.sqrt((np.bincount([g for _, g in rows])[g] + 1) / 11) for _, g in rows])
    share = np.array([weight[[g >= j for _, g in rows]].sum() for j in (1, 2)]) / weight.sum()
    assert tails == pytest.approx(share, abs=0.02)


def test_classifier_of_odd_rows(llm, odd, empty):
    labels = llm.createDataFrame([(1, 1), (4, 0), (4, 2), (None, 1), (5, None), (6, 7), (777, 0)], "doc_id bigint, g int")
    model = quality_model.train_quality(odd, labels, F.col("g"), 3)
    rows = quality_model.grade_documents(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.tail <= 1 for r in rows)
    assert quality_model.grade_documents(empty, model).collect() == []
    blank = quality_model.train_quality(empty, labels, F.col("g"), 3)
    assert not blank.weights.any() and blank.thresholds[0] < blank.thresholds[1]
