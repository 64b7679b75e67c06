"""Incremental selection: cursor filters, resumable key sweeps, account and status filters."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.values import instant
from ..sinks.files import delete, scratch, settled
from ..spec import SpecError, utc


def newer(df: DataFrame, column: str, floor: Any, inclusive: bool = False) -> DataFrame:
    """Rows past the floor: strictly by default, ``>=`` for sources that filter inclusively.

    A plain comparison with a literal, so it reaches the scan (Parquet row groups, JDBC).
    No floor means every row.
    """
    if floor is None:
        return df
    cell, bound = F.col(f"`{column}`"), F.lit(floor)
    if df.schema[column].dataType.typeName() == "timestamp_ntz":
        bound = F.lit(utc(floor).replace(tzinfo=None)) if isinstance(floor, datetime) else bound.cast("timestamp_ntz")
    return df.filter(cell >= bound if inclusive else cell > bound)


def within(df: DataFrame, column: str, since: Any, until: Any) -> DataFrame:
    """Rows of an inclusive date window."""
    return df.filter(F.col(f"`{column}`").between(since, until))


# --------------------------------------------------------------------------
# bootstrap: sweep a table in key order, a slice per run


def _key(key: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"`{k}`") for k in key])


def _as_python(df: DataFrame, name: str) -> Column:
    """A key part as Python may hold it: timestamps as text in the session's zone, because
    Python would get them without a zone, in the one of the driver."""
    value = F.col("k").getField(name)
    return (value.cast("string") if df.schema[name].dataType.typeName().startswith("timestamp") else value).alias(name)


def _literal_key(df: DataFrame, key: Sequence[str], values: Sequence[Any]) -> Column:
    if len(values) != len(key):
        raise SpecError(f"key {list(key)} needs {len(key)} values, got {list(values)}")
    return F.struct(*[F.lit(v).cast(df.schema[k].dataType).alias(k) for k, v in zip(key, values)])


def after_key(df: DataFrame, key: Sequence[str], last: Sequence[Any] | None) -> DataFrame:
    """Rows whose key follows ``last``; the first part is also compared on its own,
    because that comparison can skip Parquet row groups and the composite one cannot."""
    if last is None:
        return df
    first = F.col(f"`{key[0]}`") >= F.lit(last[0]).cast(df.schema[key[0]].dataType)
    return df.filter(first & (_key(key) > _literal_key(df, key, last)))


def slice_end(df: DataFrame, key: Sequence[str], rows: int) -> tuple | None:
    """The key of the ``rows``-th row in key order; ``None`` when fewer rows are left.

    Only key columns move.  Rows are first counted per key, which also folds a key
    that repeats; the counts are range-partitioned and written out once (and deleted
    in the end), the partition holding the wanted rank is found from one total per
    partition, and only that partition is ranked row by row.
    """
    names = [f"`{k}`" for k in key]
    counted = df.groupBy(*names).agg(F.count(F.lit(1)).alias("__n"))
    folder = scratch(df.sparkSession, "ranks")
    ranged = counted.repartitionByRange(*names).withColumn("__p", F.spark_partition_id())
    ranged.write.parquet(folder)
    try:
        return _key_at(df, df.sparkSession.read.schema(ranged.schema).parquet(folder), key, rows)
    finally:
        delete(df.sparkSession, folder)


def _key_at(df: DataFrame, ranged: DataFrame, key: Sequence[str], rows: int) -> tuple | None:
    names, before = [f"`{k}`" for k in key], 0
    for p, n in sorted((r["__p"], r["n"]) for r in
                       ranged.groupBy("__p").agg(F.sum("__n").alias("n")).collect()):
        if before + n >= rows:
            running = F.sum("__n").over(Window.partitionBy("__p").orderBy(*names))
            hit = (ranged.filter(F.col("__p") == p).withColumn("__run", running)
                   .filter(F.col("__run") >= rows - before)
                   .agg(F.min(_key(key)).alias("k")).select(*[_as_python(df, k) for k in key]).first())
            return tuple(hit[k] for k in key)
        before += n
    return None


def sweep_ends(df: DataFrame, key: Sequence[str], rows: int, most: int, cursor: str | None = None) -> tuple[list[tuple], Any]:
    """The keys at which the slices of a sweep end, ``rows`` rows apart, in order, the first ``most`` of them; and the
    highest ``cursor`` of all rows.

    All ends come from one range shuffle of the keys and their row counts, written out once: totals of the ranges
    give each its offset, and running sums within the ranges that hold an end give the key of every
    multiple of ``rows``.  Rows of one key stay together, so a slice may be longer by those of its last key.
    """
    names = [f"`{k}`" for k in key]
    highest = [] if cursor is None else [F.max(F.col(f"`{cursor}`")).alias("__c")]
    counted = df.groupBy(*names).agg(F.count(F.lit(1)).alias("__n"), *highest)
    folder = scratch(df.sparkSession, "ranks")
    written = counted.repartitionByRange(*names).withColumn("__p", F.spark_partition_id())
    written.write.parquet(folder)
    try:
        ranged = df.sparkSession.read.schema(written.schema).parquet(folder)
        totals = ranged.groupBy("__p").agg(F.sum("__n").alias("n"), *[instant(ranged, F.max("__c")).alias("c") for _ in highest]).orderBy("__p").collect()
        before, offsets = 0, {}
        for r in totals:
            if before // rows < min((before + r["n"]) // rows, most):
                offsets[r["__p"]] = before
            before += r["n"]
        top = max((r["c"] for r in totals if r["c"] is not None), default=None) if highest else None
        if not offsets:
            return [], top
        offset = F.create_map(*[F.lit(x) for pair in offsets.items() for x in pair])[F.col("__p")]
        running = offset + F.sum("__n").over(Window.partitionBy("__p").orderBy(*names))
        ends = (ranged.filter(F.col("__p").isin(*offsets)).withColumn("__run", running)
                .filter(F.expr(f"__run div {rows} > (__run - __n) div {rows} AND (__run - __n) div {rows} < {most}"))
                .select("__run", _key(key).alias("k")).select("__run", *[_as_python(df, k) for k in key]).orderBy("__run").collect())
        return [tuple(r[k] for k in key) for r in ends], top
    finally:
        delete(df.sparkSession, folder)


def up_to_key(df: DataFrame, key: Sequence[str], end: Sequence[Any] | None) -> DataFrame:
    """Rows whose key does not follow ``end``."""
    if end is None:
        return df
    first = F.col(f"`{key[0]}`") <= F.lit(end[0]).cast(df.schema[key[0]].dataType)
    return df.filter(first & (_key(key) <= _literal_key(df, key, end)))


def bootstrap_slice(df: DataFrame, key: Sequence[str], last: Sequence[Any] | None = None,
                    max_rows: int = 0) -> tuple[DataFrame, tuple | None]:
    """The next slice of a key sweep and the key it ends at; rows that tie with the end
    belong to the slice.  The end is ``None`` when the slice runs to the table's end."""
    rest = after_key(df, key, last)
    end = slice_end(rest, key, max_rows) if max_rows else None
    return up_to_key(rest, key, end), end


# --------------------------------------------------------------------------
# small filters


def account_tree(df: DataFrame, depth: int) -> DataFrame:
    """Enabled leaf accounts down to ``depth``: ids as text."""
    chosen = df.filter(F.col("level").between(1, depth) & ~F.col("manager") & (F.col("status") == "ENABLED"))
    return chosen.select(F.col("id").cast("string").alias("id")).filter("id <> ''")


def account_tree_of_links(accounts: DataFrame, links: DataFrame, roots: DataFrame, depth: int) -> DataFrame:
    """Enabled leaf accounts under the ``roots`` (column ``id``), down to ``depth`` links: ``id`` as text, and its ``level``.

    ``links`` are rows (``parent``, ``child``); ``accounts`` have ``id``, ``manager`` and ``status``.  One join a level; an
    account that was reached before is not followed again, so a cycle ends the walk and an account under two
    managers counts at its shortest distance.  Only managers are followed.
    """
    managers = accounts.filter("manager").select(F.col("id").alias("parent"))
    below = links.join(managers, "parent", "left_semi").select("parent", "child").distinct()
    seen = settled(roots.select("id").distinct().withColumn("level", F.lit(0)), "tree")
    front = seen
    for level in range(1, depth + 1):
        reached = front.join(below, F.col("id") == F.col("parent")).select(F.col("child").alias("id")).distinct()
        front = settled(reached.join(seen.select("id"), "id", "left_anti").withColumn("level", F.lit(level)), "tree")
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    leaves = accounts.filter(~F.col("manager") & (F.col("status") == "ENABLED")).select("id")
    return seen.filter("level > 0").join(leaves, "id").select(F.col("id").cast("string").alias("id"), "level").filter("id <> ''")


def tagged(df: DataFrame, column: str, values: Sequence[str], tag: str) -> DataFrame:
    """Rows of the wanted values, each tagged with the value it was asked for."""
    return df.filter(F.col(column).isin(*values)).withColumn(tag, F.col(column))


def with_status(df: DataFrame, column: str, status: str) -> DataFrame:
    return df.filter(F.col(column) == status)
