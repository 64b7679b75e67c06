"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..sinks.files import delete, scratch

#: Rows of documents that a Python worker gets at once.
BATCH_ROWS = 256
#: Bytes of text that are turned into arrays at once; arrays take about 40 times as much.
PIECE_BYTES = 1 << 20

#: Continuation bytes of UTF-8: text without them has one byte per code point.
CONTINUATION = bytes(range(0x80, 0xC0))
BLANKS = frozenset((0x20, *range(0x09, 0x0E)))
#: Bytes of words between blanks, and of words made of digits, letters and everything beyond ASCII.
BLANK_WORDS = np.array([b not in BLANKS for b in range(256)])
LETTER_WORDS = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])

_random = np.random.default_rng(20240601)
_BYTE_VALUES = _random.integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_powers: dict[str, np.ndarray] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, because documents may be long, and this package on every Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if getattr(context, "_millrace_shipped", None) is None:
        package = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="millrace-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for file in sorted(package.rglob("*.py")):
                z.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))
        context._millrace_shipped = str(archive)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark deletes the shuffle files of an execution when it ends.
FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settle(df: DataFrame, label: str, free: bool = False, made: list[str] | None = None, **options: str) -> DataFrame:
    """The same rows from files in the folder that all executors share: computed once, and
    still there when the executor that made them is lost.  With ``free`` the shuffle files of the write go
    once it has ended, because nothing reads them any more, and not when the driver next collects garbage.  ``made``
    takes the folder's name, for ``drop`` when the rows have become part of another such table.  ``options`` go to Spark's writer."""
    spark = df.sparkSession
    folder = scratch(spark, label)
    before = spark.conf.get(FREE)
    spark.conf.set(FREE, "true" if free else before)
    try:
        df.write.options(**options).parquet(folder)
    finally:
        spark.conf.set(FREE, before)
    if made is not None:
        made.append(folder)
    return spark.read.schema(df.schema).parquet(folder)


def drop(spark: SparkSession, made: list[str]) -> None:
    """Delete tables that nothing reads any more."""
    for folder in made:
        delete(spark, folder)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids and texts as UTF-8 bytes; a null text is empty."""
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))


def text_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Key of a row by its text and id, never null: rows that share it have one text (null is empty), so
    what is found in the text alone holds for all of them."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    return F.concat_ws(":", F.sha2(text, 256), F.col(id_col).cast("string"))


def arrow_schema(schema: str) -> pa.Schema:
    """Arrow's form of a schema; needs the driver."""
    return to_arrow_schema(StructType.fromDDL(schema))


def map_batches(df: DataFrame, make: Callable[[], Callable[[dict], dict | None]], schema: str) -> DataFrame:
    """``make()`` runs once per task and returns the function from a batch's columns
    (lists) to the output's columns."""
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            out = work({name: column.to_pylist() for name, column in zip(batch.schema.names, batch.columns)})
            if out is not None:
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def signed(x: int) -> int:
    """An unsigned 64-bit number as Spark's bigint."""
    return x - (1 << 64) if x >> 63 else x


def code_points(data: bytes) -> int:
    return len(data) if data.isascii() else len(data.translate(None, CONTINUATION))


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 4 * PIECE_BYTES:
            _powers[name] = have
    return have[:n]


class Words:
    """Words of a text as arrays: where they start and end, and 64-bit hashes of any part.

    A hash is a polynomial over random values of the bytes, modulo 2**64, then mixed; equal
    bytes always have equal hashes, unequal ones by chance in 1 of 2**64 pairs.
    """

    def __init__(self, data: bytes, member: np.ndarray):
        self.raw = np.frombuffer(data, np.uint8)
        inside = member[self.raw]
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        self.starts, self.ends = edges[::2], edges[1::2]
        n = len(data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[self.raw] * _power("up", _BASE, n), out=sums[1:])
        self._sums, self._down = sums, _power("down", _BASE_INVERSE, n + 1)

    def hashes(self, starts: np.ndarray | None = None, ends: np.ndarray | None = None) -> np.ndarray:
        starts, ends = self.starts if starts is None else starts, self.ends if ends is None else ends
        return mix((self._sums[ends] - self._sums[starts]) * self._down[starts])


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _MIX
    return h ^ (h >> np.uint64(29))


def pieces(data: bytes, member: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, bytes]]:
    """The text cut between words into parts of about ``most`` bytes, with their offsets."""
    start, n = 0, len(data)
    while start < n:
        end = min(n, start + most)
        while end < n:  # no cut inside a word
            outside = np.flatnonzero(~member[np.frombuffer(data, np.uint8, min(4096, n - end), end)])
            if len(outside):
                end += int(outside[0])
                break
            end = min(n, end + 4096)
        yield start, data[start:end]
        start = end


def word_arrays(data: bytes, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of all words of a text."""
    parts = [(at, Words(part, member)) for at, part in pieces(data, member)]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(parts) == 1:
        return parts[0][1].starts, parts[0][1].ends, parts[0][1].hashes()
    return (np.concatenate([at + w.starts for at, w in parts]), np.concatenate([at + w.ends for at, w in parts]),
            np.concatenate([w.hashes() for _, w in parts]))


def joined(batch: list[bytes], gap: bytes = b"\n") -> tuple[bytes, np.ndarray]:
    """Texts of a batch in one buffer with a gap after each, and where each begins (one more
    entry at the end)."""
    at = np.zeros(len(batch) + 1, np.int64)
    np.cumsum([len(x) + len(gap) for x in batch], out=at[1:])
    return gap.join(batch) + gap, at


def batch_words(batch: list[bytes], member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts of a batch: first word of each text (one more entry at the end),
    starts and ends in the joined buffer, hashes."""
    data, at = joined(batch)
    starts, ends, hashes = word_arrays(data, member)
    return np.searchsorted(starts, at), starts, ends, hashes


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` hashes, in order."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for i in range(n):
        out = out * _BASE + hashes[i:i + m]
    return mix(out)
