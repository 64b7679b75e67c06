import random

import numpy as np
import xxhash

from millrace.llm import simhash
from millrace.llm.components import components


def brute_print(text):
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(prints, most=2):
    """Smallest key reachable, by union-find over all pairs."""
    keys = sorted(prints)
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= most:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in keys}


def unsigned(x):
    return x & (1 << 64) - 1


def test_fingerprints_are_the_contracts(llm, odd):
    for text in ["", "a", "a b", "A B c", "one two three four", "ha " * 100]:
        assert simhash.fingerprint(text.encode()) == brute_print(text)
    spark_hash = llm.sql("SELECT xxhash64('one two three')").first()[0]
    assert unsigned(spark_hash) == xxhash.xxh64_intdigest(b"one two three", seed=42)


def test_groups_against_brute_force(llm):
    rng = random.Random(5)
    words = ["w%d" % i for i in range(60)]
    texts = {}
    for i in range(150):
        text = [rng.choice(words) for _ in range(rng.randint(0, 80))]
        texts[i * 3] = " ".join(text)
        if text and i % 2:
            for j in (1, 2):
                copy = list(text)
                copy[rng.randrange(len(copy))] = rng.choice(words)
                texts[i * 3 + j] = " ".join(copy)
    docs = llm.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    prints = {k: brute_print(t) for k, t in texts.items()}
    groups = brute_groups(prints)
    assert got == {k: (f"{prints[k]:016x}", groups[k]) for k in texts}


def test_crowded_buckets_are_split(llm, monkeypatch):
    rng = random.Random(6)
    centre = rng.getrandbits(64)
    prints = {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (rng.random() < 0.3 and 1 << rng.randrange(64)) for _ in range(500)}
    prints |= {rng.getrandbits(64) for _ in range(100)}
    monkeypatch.setattr(simhash, "BUCKET", 20)
    fps = llm.createDataFrame([(simhash.signed(p),) for p in prints], "fp bigint")
    roots = {r.node: r.root for r in components(simhash.links(fps)).collect()}
    groups = brute_groups({simhash.signed(p): p for p in prints})
    assert {p: roots.get(p, p) for p in groups} == groups


def test_allotment_is_exact_for_any_sample():
    rng = np.random.default_rng(1)
    sample = rng.integers(0, 1 << 16, 500, dtype=np.uint64)  # three quarters of the bits never change
    for n in (10, 1e6, 1e12):
        for highest in (2, 0):
            chosen = simhash.plan(sample, list(range(64)), 2, n, highest)
            # two bits can't be further apart than every threshold at once
            assert sum(t + 1 for _, t in chosen) >= 3 and max(t for _, t in chosen) <= highest
            assert len({b for g, _ in chosen for b in g}) == sum(len(g) for g, _ in chosen)


def test_odd_rows(llm, odd, empty):
    got = simhash.near_duplicates(odd)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    rows = got.collect()
    assert len(rows) == odd.count()
    assert {r.component_id for r in rows if r.fingerprint == "0" * 16} == {0}
    assert simhash.near_duplicates(empty).collect() == []
