"""SimHash near-duplicates: generalised pigeonhole over groups of correlated bits."""

from __future__ import annotations

import math
from itertools import accumulate

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import map_batches, settle, signed, texts
from .components import components

BITS = 64
SEED = 42
#: Distinct fingerprints (smallest hashes) that the partitions and candidate counts are estimated from.  Links are
#: exact whatever the sample says.
SAMPLE = 4096
#: Fingerprints of a bucket that are compared with each other in one task; larger buckets are split further.
BUCKET = 2048
#: With so few free bits a bucket is compared whole: it can't hold more than two to that power.
LEAST_FREE = 11
#: What a row of a probe costs, in comparisons.
ROW_COST = 30.0


def fingerprint(data: bytes, words: int = 3) -> int:
    """Bit i is 1 if it is set in over half the XXH64 values of the text's shingles."""
    tokens = data.lower().split()
    if not tokens:
        return 0
    text = b" ".join(tokens)
    n = max(1, len(tokens) - words + 1)
    lengths = [len(t) + 1 for t in tokens]
    starts = [0, *accumulate(lengths)]
    last = starts[min(words, len(tokens)):]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(text[a:b - 1], SEED) for a, b in zip(starts, last)), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):
        part = h[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """doc_id and fingerprint (as a signed bigint) of every text."""
    def make():
        return lambda batch: {"doc_id": batch["doc_id"], "fp": [signed(fingerprint(t, words)) for t in batch["text"]]}

    return map_batches(texts(docs, id_col, text_col), make, f"doc_id {dict(docs.dtypes)[id_col]}, fp bigint")


def group_bits(sample: np.ndarray, free: list[int], m: int) -> list[list[int]]:
    """``m`` groups of about equal width; a group takes the bits most correlated with it."""
    table = ((sample[:, None] >> np.array(free, np.uint64)) & np.uint64(1)).astype(float)
    table -= table.mean(0)
    spread = np.sqrt((table ** 2).sum(0))
    near = np.abs(table.T @ table) / np.maximum(np.outer(spread, spread), 1e-9)
    np.fill_diagonal(near, 0)
    left, groups = list(range(len(free))), []
    for i in range(m):
        width = math.ceil(len(left) / (m - i))
        group = [max(left, key=lambda b: near[b, left].sum())]
        left.remove(group[0])
        while len(group) < width:
            best = max(left, key=lambda b: near[b, group].sum())
            group.append(best)
            left.remove(best)
        groups.append([free[b] for b in group])
    return groups


def allot(sample: np.ndarray, groups: list[list[int]], most: int, n: float, highest: int) -> tuple[float, list[int]]:
    """Cost and thresholds, by dynamic programming over the groups.

    Texts within ``most`` bits agree within ``t[i]`` bits in some group i if the thresholds add up to
    ``most - groups + 1``; -1 leaves a group out.  A threshold costs the rows that its probes emit and the
    candidate pairs that it is estimated to bring up among ``n`` fingerprints.  None is over ``highest``.
    """
    goal = most - len(groups) + 1
    pairs = max(len(sample) * (len(sample) - 1) / 2, 1)
    state: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for group in groups:
        mask = np.uint64(sum(1 << b for b in group))
        values, counts = np.unique(sample & mask, return_counts=True)
        costs = {-1: 0.0}
        for t in range(highest + 1):
            variants = sum(math.comb(len(group), i) for i in range(t + 1))
            near = 0.0
            for at in range(0, len(values), 512):
                apart = np.bitwise_count(values[at:at + 512, None] ^ values[None, :])
                near += float((counts[at:at + 512, None] * counts[None, :])[apart <= t].sum())
            share = max((near - len(sample)) / 2 / pairs, variants / 2.0 ** len(group))
            costs[t] = ROW_COST * n * variants + share * n * n / 2
        step: dict[int, tuple[float, list[int]]] = {}
        for total, (cost, chosen) in state.items():
            for t, extra in costs.items():
                if total + t not in step or cost + extra < step[total + t][0]:
                    step[total + t] = (cost + extra, [*chosen, t])
        state = step
    return state.get(goal, (math.inf, []))


def plan(sample: np.ndarray, free: list[int], most: int, n: float, highest: int) -> list[tuple[list[int], int]]:
    """The cheapest partition of the free bits: (bits, threshold) of each group that is probed."""
    best = None
    for m in range(max(1, most), most + 3):
        if m <= len(free):
            groups = group_bits(sample, free, m)
            cost, chosen = allot(sample, groups, most, n, highest)
            if best is None or cost < best[0]:
                best = cost, [(g, t) for g, t in zip(groups, chosen) if t >= 0]
    return best[1]


def _mask(bits: list[int]) -> int:
    return signed(sum(1 << b for b in bits))


def _flips(bits: list[int], t: int) -> list[int]:
    """Masks of all changes of at most ``t`` of these bits."""
    out = [0]
    for _ in range(t):
        out = sorted({x | 1 << b for x in out for b in bits} | set(out))
    return [signed(x) for x in out]


def _spanning(fps: list[int], most: int) -> list[tuple[int, int]]:
    """Links that join what is within ``most`` bits, at most one for each fingerprint."""
    values = np.unique(np.array(fps, np.int64))
    apart = (values[:, None] ^ values[None, :]).view(np.uint64)  # signed numbers would count their absolute value
    near = np.bitwise_count(apart) <= most
    label = np.arange(len(values))
    while True:
        low = np.where(near, label[None, :], len(values)).min(1)
        low = low[low]
        if (low == label).all():
            return [(int(values[i]), int(values[j])) for i, j in enumerate(label) if i != j]
        label = low


def links(fps: DataFrame, most: int = 2) -> DataFrame:
    """Links (u, v) between distinct fingerprints (column ``fp``) that join the same ones as all pairs
    within ``most`` bits do.

    Probes of each group of bits meet in buckets; buckets up to ``BUCKET`` are compared whole, in one
    task each, and give at most one link a row.  A larger bucket is split by the same principle on the bits
    that it doesn't fix, as often as needed, then with thresholds of 0 at most: its rows are dealt to finer
    buckets, so no task ever holds it and no pairs are emitted.
    """
    spark = fps.sparkSession
    found: list[DataFrame] = []
    n = fps.count()
    sample = fps.orderBy(F.xxhash64("fp")).limit(SAMPLE)
    rows = fps.select(F.lit(0).alias("path"), F.lit(0).cast("bigint").alias("at"), "fp")
    open_paths = {0: list(range(BITS))}
    paths = 0
    while open_paths and n > 1:
        seen = np.array([r.fp for r in sample.collect()], np.int64).astype(np.uint64)
        keys, free_of = None, {}
        for path, free in open_paths.items():
            options = []
            for bits, t in plan(seen, free, most, n, most if path == 0 else 0):
                paths += 1
                free_of[paths] = [b for b in free if b not in bits]
                options.append(F.struct(F.lit(paths).alias("path"), F.lit(_mask(bits)).cast("bigint").alias("mask"),
                                        F.array(*[F.lit(x).cast("bigint") for x in _flips(bits, t)]).alias("flips")))
            option = F.when(F.col("path") == path, F.array(*options))
            keys = option if keys is None else keys.when(F.col("path") == path, F.array(*options))
        dealt = (rows.select("at", "fp", F.explode(keys).alias("k"))
                 .select(F.col("k.path").alias("path"), "fp", F.col("k.mask").alias("mask"), "at",
                         F.explode("k.flips").alias("flip"))
                 .select("path", F.expr("at | ((fp & mask) ^ flip)").alias("at"), "fp"))
        whole = [p for p, free in free_of.items() if len(free) <= LEAST_FREE]
        sizes = dealt.groupBy("path", "at").agg(F.count("*").alias("n"))
        large = sizes.where((F.col("n") > BUCKET) & ~F.col("path").isin(whole)).select("path", "at")
        large = settle(large, "buckets")
        some = large.groupBy("path").count().collect()  # one row for each path
        fits = dealt.join(large, ["path", "at"], "left_anti") if some else dealt
        buckets = fits.groupBy("path", "at").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1).select("fps")

        def make():
            def compare(batch):
                pairs = [p for fps in batch["fps"] for p in _spanning(fps, most)]
                return {"u": [u for u, _ in pairs], "v": [v for _, v in pairs]}
            return compare

        found.append(settle(map_batches(buckets, make, "u bigint, v bigint"), "near"))
        open_paths = {r.path: free_of[r.path] for r in some}
        if open_paths:
            rows = settle(dealt.join(large, ["path", "at"]), "crowded")
            n = rows.count()
            sample = rows.select("fp").distinct().orderBy(F.xxhash64("fp")).limit(SAMPLE)
    out = spark.createDataFrame([], "u bigint, v bigint")
    for df in found:
        out = out.unionByName(df)
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                    most: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    Words are what blanks part, A-Z in lower case; shingles are ``words`` words, repeats included; a shorter
    text is one shingle; a text without words, or null, has fingerprint zero and is linked like any other.
    component_id is the smallest doc_id reachable over links of at most ``most`` differing bits, null
    if the component has no ids.  Repeated rows and ids come back as they came; an empty table gives no rows.
    """
    prints = settle(fingerprints(docs, id_col, text_col, words), "prints")
    firsts = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "firsts")
    roots = components(links(firsts.select("fp"), most))
    member = firsts.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = member.groupBy("root").agg(F.min("first").alias("component_id"))
    member = settle(member.join(smallest, "root").select(F.col("fp").alias("member"), "component_id"), "members")
    return prints.join(member, F.col("fp") == F.col("member")).select(
        F.col("doc_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
