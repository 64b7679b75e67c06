"""Benchmark decontamination: a broadcast hash set of n-grams, checked word by word."""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import LETTER_WORDS, batch_words, joined, map_batches, rolling, settle, text_key, texts

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Words in a window.
WINDOW = 13
#: Windows of one broadcast block; a larger benchmark is scanned in several blocks.
BLOCK = 1_000_000


def words_of(data: bytes) -> list[bytes]:
    """A-Z in lower case; runs of digits, letters and everything beyond ASCII."""
    return WORD.findall(data.lower())


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", n: int = WINDOW) -> DataFrame:
    """Distinct (item_id, window, words): ``n`` consecutive words of an item, or all of a shorter one."""
    def make():
        def cut(batch):
            out = {"item_id": [], "window": [], "words": []}
            for item, data in zip(batch["doc_id"], batch["text"]):
                words = words_of(data)
                size = min(n, len(words))
                windows = {b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)} if words else ()
                for window in windows:
                    out["item_id"].append(item)
                    out["window"].append(window)
                    out["words"].append(size)
            return out
        return cut

    cut = map_batches(texts(items, id_col, text_col), make, f"item_id {dict(items.dtypes)[id_col]}, window binary, words int")
    return cut.select(F.col("item_id").cast("string").alias("item_id"), "window", "words").distinct()


class Grams:
    """Windows of one block: items by window, and sorted hashes by window length."""

    def __init__(self, rows):
        self.items: dict[bytes, list[str]] = {}
        sizes: dict[int, list[bytes]] = {}
        for item, window, size in rows:
            known = self.items.setdefault(window, [])
            if not known:
                sizes.setdefault(size, []).append(window)
            known.append(item)
        self.hashes = {}
        for size, windows in sizes.items():
            _, _, _, h = batch_words(windows, LETTER_WORDS)
            self.hashes[size] = np.unique(rolling(h, size)[::size])

    def hits(self, data: bytes, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, hashes: np.ndarray):
        """For all texts of a batch: (position of the first word, length, items) of each occurrence."""
        for size, known in self.hashes.items():
            if not len(known):
                continue
            h = rolling(hashes, size)
            at = np.flatnonzero(known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h)
            # inside one text, and the same words
            text = np.searchsorted(first, at, side="right")
            for i in at[at + size <= first[np.minimum(text, len(first) - 1)]].tolist():
                items = self.items.get(b" ".join(data[a:b] for a, b in zip(starts[i:i + size], ends[i:i + size])))
                if items:
                    yield i, size, items


def _scan(docs: DataFrame, grams: Grams) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(grams)

    def make():
        grams = shared.value

        def scan(batch):
            low = [t.lower() for t in batch["text"]]
            first, starts, ends, hashes = batch_words(low, LETTER_WORDS)
            data, _ = joined(low)
            ranges: list[list] = [[] for _ in low]
            items: list[set] = [set() for _ in low]
            for i, size, found in grams.hits(data, starts, ends, first, hashes):
                text = int(np.searchsorted(first, i, side="right")) - 1
                ranges[text].append((i - int(first[text]), size))
                items[text].update(found)
            return {"doc_id": batch["doc_id"], "n_words": np.diff(first).tolist(),
                    "hits": [_merged(r) for r in ranges], "items": [sorted(x) for x in items]}
        return scan

    kind = dict(docs.dtypes)["doc_id"]
    return map_batches(docs, make, f"doc_id {kind}, n_words bigint, hits array<struct<first: bigint, words: bigint>>, "
                                   "items array<string>")


def _merged(ranges: list[tuple[int, int]]) -> list[dict]:
    """Disjoint runs of the words that are in any range."""
    out: list[list[int]] = []
    for first, size in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], first + size)
        else:
            out.append([first, first + size])
    return [dict(first=a, words=b - a) for a, b in out]


def find_benchmark(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text: str = "text", n: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """doc_id, n_words, hits (runs of words inside an occurrence of a window), items (sorted as strings).

    A hash set of the windows is broadcast; hits are verified by comparing words.  The set is bounded:
    windows are counted first, and if there are more than ``block`` they are dealt to blocks by
    hash, the texts are scanned once for each block, and a text's hits are put together by row.  Null or
    empty texts have no words; items without words have no windows; null item ids count as no item but
    their windows hit.  Repeated rows come back as they came; an empty table gives no rows.
    """
    windows = item_windows(items, item_col, item_text, n)
    total = windows.count()
    docs = texts(docs, id_col, text_col)
    if total <= block:
        out = _scan(docs, Grams(windows.select(F.coalesce("item_id", F.lit("")), "window", "words").collect()))
    else:
        blocks = -(-total * 5 // (4 * block))  # a fifth of slack for uneven hashes
        dealt = settle(windows.withColumn("block", F.pmod(F.xxhash64("window", "item_id"), F.lit(blocks))), "windows")
        rows = settle(docs.withColumn("row", F.expr("uuid()")), "rows")
        out = None
        for b in range(blocks):
            grams = Grams(dealt.where(F.col("block") == b).select(F.coalesce("item_id", F.lit("")), "window", "words").collect())
            scanned = _scan(rows.select(F.struct("row", "doc_id").alias("doc_id"), "text"), grams)
            out = scanned if out is None else out.unionByName(scanned)

        def merge():
            return lambda batch: {"doc_id": batch["doc_id"], "n_words": batch["n_words"], "items": batch["items"],
                                  "hits": [_merged([(h["first"], h["words"]) for h in hits]) for hits in batch["hits"]]}

        gathered = out.groupBy("doc_id").agg(
            F.max("n_words").alias("n_words"), F.flatten(F.collect_list("hits")).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        out = map_batches(gathered.withColumn("doc_id", F.col("doc_id.doc_id")), merge, out.select("doc_id.doc_id").schema
                          .simpleString()[7:-1].replace("doc_id:", "doc_id ") + ", n_words bigint, "
                          "hits array<struct<first: bigint, words: bigint>>, items array<string>")
    return out.select(F.col("doc_id").alias(id_col), "n_words", "hits",
                      F.filter("items", lambda x: x != "").alias("items"))


def judged(found: DataFrame) -> DataFrame:
    """The counts and the verdict: contaminated if any word is hit, and at least a twentieth of all."""
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda s, h: s + h["words"])
    return found.withColumn("n_hit", n_hit).withColumn("n_items", F.size("items").cast("bigint")).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  action: str = "drop", **options) -> DataFrame:
    """The documents without contaminated ones (``drop``), or with every hit run of words cut out of
    their texts (``cut``).  Every row is judged by its own text, also where ids are null or shared."""
    if action == "cut":
        return _cut(docs, items, id_col, text_col, **options)
    rows = docs.withColumn("__key", text_key(id_col, text_col))
    bad = judged(find_benchmark(rows, items, "__key", text_col, **options)).where("contaminated").select("__key").distinct()
    return rows.join(bad, "__key", "left_anti").select(*docs.columns)


def _cut(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, n: int = WINDOW, block: int = BLOCK,
         **names) -> DataFrame:
    keyed = docs.withColumn("__key", text_key(id_col, text_col))
    found = find_benchmark(keyed, items, "__key", text_col, n=n, block=block, **names)
    runs = found.where(F.size("hits") > 0).select("__key", F.col("hits").alias("__hits")).dropDuplicates(["__key"])
    rows = keyed.join(runs, "__key", "left").select(*docs.columns, "__hits")

    @F.pandas_udf("string")
    def without(text, hits):
        return text.combine(hits, lambda t, h: t if t is None or h is None else remove_words(t, h))

    return rows.withColumn(text_col, without(F.col(text_col), F.col("__hits"))).drop("__hits")


def remove_words(text: str, hits) -> str:
    """The text without the given runs of words and what parts them inside a run."""
    data = text.encode()
    places = [m.span() for m in WORD.finditer(data.lower())]
    out, at = [], 0
    for h in hits:
        out.append(data[at:places[h["first"]][0]])
        at = places[h["first"] + h["words"] - 1][1]
    return b"".join([*out, data[at:]]).decode()


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
