"""Quality rules: figures of each document, and lines that too many documents of a host share."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import BLANK_WORDS, CONTINUATION, batch_words, map_batches, rolling, settle, signed

SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOLS = bytes(b for b in range(256) if b not in SYMBOLS)
MIN_WORDS = 50
#: A line is boilerplate if more documents of its host than this have it, whatever else the host has.
MAX_DOCUMENTS = 20
#: A document is depleted if fewer words than these are left, or under this share of them.
LEAST_WORDS, LEAST_SHARE = 10, 0.3


def _figures(batch: list[bytes]) -> dict[str, list[int]]:
    first, starts, ends, hashes = batch_words(batch, BLANK_WORDS)
    out = {"n_words": np.diff(first).tolist(), "word_chars": [], "n_symbols": [], "n_dup_lines": [], "n_repeat_words": []}
    for i, data in enumerate(batch):
        size = int((ends[first[i]:first[i + 1]] - starts[first[i]:first[i + 1]]).sum())
        # all continuation bytes are in words
        out["word_chars"].append(size if data.isascii() else size - (len(data) - len(data.translate(None, CONTINUATION))))
        out["n_symbols"].append(len(data.translate(None, _NOT_SYMBOLS)))
        lines = [x for x in data.split(b"\n") if x and not x.isspace()]
        out["n_dup_lines"].append(len(lines) - len(set(lines)))
        out["n_repeat_words"].append(repeated(hashes[first[i]:first[i + 1]]))
    return out


def repeated(hashes: np.ndarray, n: int = 3) -> int:
    """Words inside windows of ``n`` words that occur twice or more."""
    if len(hashes) <= n:
        return 0
    codes, values = pd.factorize(rolling(hashes, n))
    often = np.bincount(codes, minlength=len(values))[codes] > 1
    if not often.any():
        return 0
    hit = np.zeros(len(hashes), bool)
    for i in range(n):
        hit[i:i + len(often)] |= often
    return int(hit.sum())


def _lines(batch: list[bytes]) -> list[list[dict]]:
    """Hash of every distinct normalised line (A-Z in lower case, blanks joined), and the words of
    all its copies in the text."""
    out = []
    for data in batch:
        words: dict[bytes, int] = {}
        for line in data.lower().split(b"\n"):
            tokens = line.split()
            if tokens:
                key = b" ".join(tokens)
                words[key] = words.get(key, 0) + len(tokens)
        out.append([dict(line=signed(xxhash.xxh64_intdigest(line)), words=n) for line, n in words.items()])
    return out


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  max_documents: int = MAX_DOCUMENTS, least_words: int = LEAST_WORDS,
                  least_share: float = LEAST_SHARE) -> DataFrame:
    """Figures and verdict of every row.

    Lines are normalised and hashed; each host's distinct documents are counted for each line.  A line that
    over ``max_documents`` of a host's documents have is removed.  A document is depleted, and rejected, if that leaves under ``least_words`` words or under ``least_share`` of
    what it had.  ``base_failed`` rows are rejected in any case.

    A null text has no words, null hosts are one host; rows with one id (or none) count as one document, but
    each row loses its own lines only and has its own verdict.  Texts are read whole, however long.  An empty table gives
    no rows.

    A line's documents are counted by partial sums, so a line that all documents have costs one row a task.
    Only (host, line) pairs above the limits meet the documents' lines again, in a join that Spark broadcasts
    if they turn out small and splits if skewed.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))

    def make():
        return lambda batch: {"doc_id": batch["doc_id"], "host": batch["host"], **_figures(batch["text"]),
                              "lines": _lines(batch["text"])}

    base = settle(map_batches(rows, make, f"""
        doc_id {dict(docs.dtypes)[id_col]}, host string, n_words bigint, word_chars bigint, n_symbols bigint,
        n_dup_lines bigint, n_repeat_words bigint, lines array<struct<line: bigint, words: bigint>>""").withColumn("__row", F.monotonically_increasing_id()), "lines")
    document = F.struct("doc_id")  # not null where the id is
    lines = base.select("doc_id", "__row", "host", F.inline("lines"))
    often = (lines.groupBy("host", "line").agg(F.count_distinct(document).alias("n")).where(F.col("n") > max_documents)
             .select("host", "line"))
    removed = (lines.join(often, ["host", "line"], "left_semi").groupBy("__row")
               .agg(F.sum("words").alias("removed")))
    base = base.drop("host", "lines")
    left = F.col("n_words") - F.coalesce("removed", F.lit(0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    depleted = (left < least_words) | (left < least_share * F.col("n_words"))
    return (base.join(removed, "__row", "left")
            .withColumn("base_failed", failed).withColumn("n_left", left)
            .withColumn("kept", ~failed & ~depleted).drop("__row", "removed").withColumnRenamed("doc_id", id_col))
