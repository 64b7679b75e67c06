"""N-gram Jaccard join: PartEnum signatures of shingle sets, then exact verification."""

from __future__ import annotations

from fractions import Fraction
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import BLANK_WORDS, arrow_schema, batch_words, map_batches, mix, rolling, settle, texts
from .components import components
from .periodic import slices

#: Second-level parts, and of these how many may differ.
PARTS, DIFFER = 3, 1
#: Bands are as wide as this power of the least ratio of sizes; only sets that near the next band are probed in it too.
WIDTH = 2
#: In each bucket all sets are compared with so many of them first.
STARS = 2
#: Sets, and elements of sets, of a block that is compared whole with another one in a task.
BLOCK_SETS, BLOCK_ELEMENTS = 1024, 1 << 20

_SALT = np.uint64(0xD6E8FEB86659FD93)


def bands(most: int, share: Fraction) -> list[int]:
    """Least set size of each band up to size ``most``: sets that link are in one band or in neighbouring ones."""
    out = [1]
    while out[-1] <= most:
        out.append(int(out[-1] / share ** WIDTH) + 1)
    return out


def differing(size: int, share: Fraction) -> int:
    """Elements that two linked sets of up to ``size`` elements can differ in."""
    return int(2 * size * (1 - share) / (1 + share))


def shingle_sets(batch: list[bytes], words: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the texts, sorted by text and hash, and where each text begins (one more entry)."""
    first, _, _, hashes = batch_words([t.lower() for t in batch], BLANK_WORDS)
    counts = np.diff(first)
    grams = rolling(hashes, words) if len(hashes) >= words else np.zeros(0, np.uint64)
    text = np.repeat(np.arange(len(batch)), counts)
    inside = text[:len(grams)] == text[words - 1:] if len(grams) else np.zeros(0, bool)
    owner, grams = text[:len(grams)][inside], grams[inside]
    short = np.flatnonzero((counts > 0) & (counts < words)).tolist()
    whole = [rolling(hashes[first[t]:first[t + 1]], int(counts[t])) for t in short]
    owner, grams = np.concatenate([owner, np.array(short, np.int64)]), np.concatenate([grams, *whole])
    order = np.lexsort((grams, owner))
    owner, grams = owner[order], grams[order]
    new = np.append(True, (owner[1:] != owner[:-1]) | (grams[1:] != grams[:-1])) if len(owner) else np.zeros(0, bool)
    owner, grams = owner[new], grams[new]
    return grams, np.searchsorted(owner, np.arange(len(batch) + 1))


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums (modulo 2**64) of consecutive spans; ``starts`` has one more entry."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[starts[1:]] - total[starts[:-1]]


def signatures(grams: np.ndarray, at: np.ndarray, share: Fraction) -> list[np.ndarray]:
    """PartEnum signatures of each set, for its own size band and, if it can link with a set of it, the next one.

    Two sets of a band that link differ in k elements at most.  Hashes deal the domain to n parts with
    n * (DIFFER + 1) > k, so in some part they differ in DIFFER elements at most, and that part to PARTS smaller
    ones, of which all but DIFFER are equal: one signature for each way to choose these is the sum of their
    elements.  Sets of which no others differ (k = 0) have none.
    """
    sizes = np.diff(at)
    edges = bands(int(int(sizes.max(initial=1)) / share), share)
    edges.append(int(edges[-1] / share ** WIDTH) + 1)
    own = np.maximum(np.searchsorted(edges, sizes, side="right") - 1, 0)
    changes = np.array([differing(upper - 1, share) for upper in edges[1:]])
    reaches = sizes * share.denominator // share.numerator >= np.array(edges)[own + 1]
    choices = list(combinations(range(PARTS), PARTS - DIFFER))
    text = np.repeat(np.arange(len(sizes)), sizes)
    spread = mix(grams + _SALT)
    out: list[list[np.ndarray]] = [[] for _ in sizes]
    for step in (0, 1):
        band = own + step
        k = changes[band]
        parts = np.where((sizes > 0) & (k > 0) & (reaches | (step == 0)), -(-(k + 1) // (DIFFER + 1)), 0)
        base = np.append(0, np.cumsum(parts * PARTS))
        live = parts[text] > 0
        owner, value = text[live], spread[live]
        part = (value >> np.uint64(32)) % parts[owner].astype(np.uint64)
        cell = base[owner] + part.astype(np.int64) * PARTS + ((value & np.uint64(0xFFFFFFFF)) % np.uint64(PARTS)).astype(np.int64)
        order = np.argsort(cell, kind="stable")
        cells = _sums(mix(value[order]), np.searchsorted(cell[order], np.arange(base[-1] + 1))).reshape(-1, PARTS)
        number = np.arange(len(cells)) - np.repeat(base[:-1] // PARTS, parts)
        tag = (np.repeat(band, parts) * (1 << 40) + number * len(choices)).astype(np.uint64)
        made = np.stack([mix(sum(cells[:, i] * np.uint64(2 * i + 3) for i in chosen) + mix(tag + np.uint64(c)))
                         for c, chosen in enumerate(choices)], 1) if len(cells) else np.zeros((0, len(choices)), np.uint64)
        rows = base // PARTS
        for t in np.flatnonzero(parts).tolist():
            out[t].append(made[rows[t]:rows[t + 1]].ravel())
    return [np.concatenate(s) if s else np.zeros(0, np.uint64) for s in out]


def _prints(words: int, share: Fraction):
    def work(batch):
        out = {"id": batch["id"], "text_hash": batch["text_hash"], "n": [], "node": [], "signatures": []}
        for part in slices(batch["text"]):
            grams, at = shingle_sets(part, words)
            sizes = np.diff(at)
            sums = mix(_sums(mix(grams), at) + mix(sizes.astype(np.uint64)))
            out["n"] += sizes.tolist()
            out["node"] += sums.view(np.int64).tolist()
            out["signatures"] += [s.view(np.int64) for s in signatures(grams, at, share)]
        return out
    return lambda: work


def _sets(words: int):
    def work(batch):
        out = {"node": batch["node"], "grams": []}
        for part in slices(batch["text"]):
            grams, at = shingle_sets(part, words)
            out["grams"] += [grams[a:b].view(np.int64) for a, b in zip(at, at[1:])]
        return out
    return lambda: work


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, percent: int = 90) -> DataFrame:
    """The id, ``n_shingles`` and ``component_id`` of every row.

    Words are what blanks part, A-Z in lower case; a set holds the distinct shingles of ``words`` words, or the whole
    text of one with fewer.  Rows link if their sets share ``percent`` in 100 of their union.  component_id is the
    smallest id reachable over links, itself included.  A text without words, or null, is empty and linked
    with nothing.  Repeated rows and ids come back as they came (rows of one set are one class; its smallest id
    counts, null if none of the component has one); an empty table gives no rows; other columns are left out.

    Equal sets fold into one node first.  Sets that share a signature meet in its bucket, where all are compared
    with a few of them; links found join components.  Buckets that still hold several components are
    then compared across these (``_rest``).  So copies never make pairs, and no task holds a bucket.
    Shingles and sets are told apart by 64-bit hashes.
    """
    share = Fraction(percent, 100)
    if not Fraction(1, 2) <= share < 1:
        raise ValueError("percent must be from 50 to 99")
    id_type = dict(docs.dtypes)[id_col]
    rows = texts(docs, id_col, text_col).select(F.col("doc_id").alias("id"), "text", F.xxhash64("text").alias("text_hash"))
    prints = settle(map_batches(rows, _prints(words, share), f"id {id_type}, text_hash bigint, n bigint, node bigint, "
                                "signatures array<bigint>"), "prints")
    # one row stands for a set: its smallest (id, text)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("first")
    firsts = settle(prints.where("n > 0").groupBy("node").agg(first, F.max("n").alias("n"), F.first("signatures").alias("signatures")),
                    "firsts")
    links = _links(rows, firsts, words, percent)
    roots = components(links)
    member = firsts.join(roots, "node", "left").select("node", "first.id", F.coalesce("root", "node").alias("root"))
    smallest = member.groupBy("root").agg(F.min("id").alias("component_id"))
    member = settle(member.join(smallest, "root").select("node", "component_id"), "members")
    slim = prints.select("id", "n", "node")
    return slim.where("n > 0").join(member, "node").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id").unionByName(
        slim.where("n = 0").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("id").alias("component_id")))


def _links(rows: DataFrame, firsts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (u, v) between nodes that join the same ones as all pairs that link do."""
    # one shuffle, read twice: for the buckets of several sets, and for their sets
    signed = firsts.select("node", F.explode("signatures").alias("signature")).repartition("signature")
    shared = (signed.groupBy("signature").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b")
              .select("signature"))
    bucket = settle(signed.join(shared, "signature").select("signature", "node"), "buckets")
    candidates = firsts.join(bucket.select("node").distinct(), "node")
    chosen = candidates.select("node", F.struct("first.id").alias("k"), F.col("first.text_hash").alias("h"))
    found = rows.join(chosen, (F.struct("id") == F.col("k")) & (F.col("text_hash") == F.col("h"))).select("node", "text")
    sets = settle(map_batches(found, _sets(words), "node bigint, grams array<bigint>").dropDuplicates(["node"]), "sets")
    sizes = firsts.select("node", "n")
    stars = [_star(bucket, i) for i in range(STARS)]
    pairs = reduce(DataFrame.unionByName, stars).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    links = settle(_verified(pairs, sizes, sets, percent), "stars")
    open_ = _open(bucket, components(links).withColumnRenamed("root", "label"))
    return links if open_.isEmpty() else links.unionByName(settle(_rest(open_, sizes, sets, percent), "rest"))


def _labelled(bucket: DataFrame, label: DataFrame) -> DataFrame:
    return bucket.join(label, "node", "left").select("signature", "node", F.coalesce("label", "node").alias("label"))


def _open(bucket: DataFrame, label: DataFrame) -> DataFrame:
    """The buckets that hold several components."""
    rows = settle(_labelled(bucket, label), "labelled")
    several = rows.groupBy("signature").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("signature")
    return settle(rows.join(several, "signature", "left_semi"), "open")


def _star(bucket: DataFrame, turn: int) -> DataFrame:
    """Each set of a bucket with one of it, the least by a hash."""
    centre = bucket.groupBy("signature").agg(F.min(F.struct(F.xxhash64("node", F.lit(turn)), "node"))["node"].alias("v"))
    return bucket.select("signature", F.col("node").alias("u")).join(centre, "signature").where("u <> v").select("u", "v")


def _verified(pairs: DataFrame, sizes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that link; sizes are compared first, then the sets."""
    low, high = F.least("n_u", "n_v"), F.greatest("n_u", "n_v")
    sized = (pairs.join(sizes.select(F.col("node").alias("u"), F.col("n").alias("n_u")), "u")
             .join(sizes.select(F.col("node").alias("v"), F.col("n").alias("n_v")), "v").where(100 * low >= percent * high))
    both = (sized.join(sets.select(F.col("node").alias("u"), F.col("grams").alias("g_u")), "u")
            .join(sets.select(F.col("node").alias("v"), F.col("grams").alias("g_v")), "v"))
    common = F.size(F.array_intersect("g_u", "g_v"))
    return both.where(100 * common >= percent * (F.col("n_u") + F.col("n_v") - common)).select("u", "v")


def _rest(open_: DataFrame, sizes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components that meet in a bucket.

    Components that meet, directly or over others, are a cluster.  A cluster's sets are cut into blocks and every
    block meets every other in a task, which compares sets of different components and gives at most one link
    for each, so no pairs are emitted and a task holds two blocks.
    """
    centre = open_.groupBy("signature").agg(F.min("label").alias("v"))
    meet = open_.select("signature", F.col("label").alias("u")).join(centre, "signature").select("u", "v")
    cluster = components(meet).withColumnRenamed("node", "label").withColumnRenamed("root", "cluster")
    rows = open_.select("node", "label").distinct().join(cluster, "label", "left").withColumn("cluster", F.coalesce("cluster", "label"))
    rows = settle(rows.join(sizes, "node"), "clusters")
    blocks = rows.groupBy("cluster").agg(F.ceil(F.greatest(F.count("*") / BLOCK_SETS, F.sum("n") / BLOCK_ELEMENTS)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (rows.join(blocks, "cluster").withColumn("own", own)
             .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
             .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
             .select("cluster", "i", "j", "own", "node", "label").join(sets, "node"))
    schema = arrow_schema("u bigint, v bigint")

    def compare(group: pa.Table) -> pa.Table:
        return pa.table(_cross_links(group, percent), schema=schema)

    return dealt.groupBy("cluster", "i", "j").applyInArrow(compare, "u bigint, v bigint")


def _cross_links(group: pa.Table, percent: int) -> list[np.ndarray]:
    """Links that join the components of a group of sets: sets are counted out against all others by their elements."""
    group = group.combine_chunks()
    node, label, own = (group.column(c).to_numpy() for c in ("node", "label", "own"))
    grams = group.column("grams").combine_chunks()
    offsets = grams.offsets.to_numpy()
    values = grams.values.to_numpy()[offsets[0]:offsets[-1]]
    at = offsets - offsets[0]
    sizes = np.diff(at)
    element, _ = pd.factorize(values)
    holders = np.repeat(np.arange(len(node)), sizes)[np.argsort(element, kind="stable")]
    ends = np.cumsum(np.bincount(element))
    codes, labels = pd.factorize(label)
    root = np.arange(len(labels))
    largest = np.bincount(codes).argmax()
    across = len(np.unique(own)) > 1
    u, v = [], []
    for x in np.flatnonzero(codes != largest).tolist():  # of two components one is not the largest
        mine = element[at[x]:at[x + 1]]
        first = np.append(0, ends)[mine]
        reach = ends[mine] - first
        spans = np.repeat(first - np.cumsum(reach) + reach, reach) + np.arange(reach.sum())
        common = np.bincount(holders[spans], minlength=len(node))
        near = (100 * common >= percent * (sizes[x] + sizes - common)) & (root[codes] != root[codes[x]])
        if across:
            near &= own != own[x]
        for y in np.flatnonzero(near).tolist():
            a, b = root[codes[x]], root[codes[y]]
            if a != b:
                root[root == max(a, b)] = min(a, b)
                u.append(node[x])
                v.append(node[y])
    return [np.array(u, np.int64), np.array(v, np.int64)]
