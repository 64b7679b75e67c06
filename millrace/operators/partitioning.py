"""Partition values derived from a partition spec."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from ..spec import SYNCED_AT, Granularity, PartitionKind, PartitionSpec, SpecError

PART = "_part"
UNPARTITIONED = "all"
NULL_PART = "null"
OUTSIDE = "outside"

_PATTERNS = {
    Granularity.HOUR: "yyyy-MM-dd-HH",
    Granularity.DAY: "yyyy-MM-dd",
    Granularity.MONTH: "yyyy-MM",
    Granularity.YEAR: "yyyy",
}


_LABELS = {
    Granularity.HOUR: "%Y-%m-%d-%H",
    Granularity.DAY: "%Y-%m-%d",
    Granularity.MONTH: "%Y-%m",
    Granularity.YEAR: "%Y",
}


class PartitionMismatch(SpecError):
    """The table exists with another partition spec."""


def range_bucket(value: Column, spec: PartitionSpec) -> Column:
    """Lower bound of the bucket; NULL outside ``[start, end)``."""
    inside = (value >= spec.start) & (value < spec.end)
    low = F.lit(spec.start) + F.floor((value - spec.start) / spec.interval) * spec.interval
    return F.when(inside, low.cast("bigint"))


def partition_value(spec: PartitionSpec | None, key: tuple[str, ...] = (), buckets: int = 0) -> Column:
    """The directory value a row is stored under.

    Without a spec, a merge table may be spread over ``buckets`` hash buckets of its
    key, so that a merge rewrites only the buckets its batch touches.
    """
    if spec is None or spec.kind is PartitionKind.NONE:
        if buckets and key:
            slot = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in key]), F.lit(buckets))
            return F.concat(F.lit("b"), slot.cast("string"))
        return F.lit(UNPARTITIONED)
    if spec.kind is PartitionKind.INGESTION:
        return F.date_format(F.col(SYNCED_AT), _PATTERNS[Granularity.DAY])
    value = F.col(f"`{spec.column}`")
    if spec.kind is PartitionKind.TIME:
        return F.coalesce(F.date_format(value, _PATTERNS[spec.granularity]), F.lit(NULL_PART))
    bucket = range_bucket(value, spec).cast("string")
    return F.when(value.isNull(), F.lit(NULL_PART)).otherwise(F.coalesce(bucket, F.lit(OUTSIDE)))


def partition_follows_key(spec: PartitionSpec | None, key: tuple[str, ...]) -> bool:
    """Whether equal keys always share a partition value."""
    if spec is None or spec.kind is PartitionKind.NONE:
        return True
    return spec.kind in (PartitionKind.TIME, PartitionKind.RANGE) and spec.column in key


def parts_between(spec: PartitionSpec, names: Iterable[str], since: Any, until: Any) -> set[str]:
    """Those partition values that may hold rows with ``since <= column < until``."""
    if spec.kind is PartitionKind.RANGE:
        def may(name: str) -> bool:
            if name == OUTSIDE:
                return True
            low = int(name)
            return (since is None or low + spec.interval > since) and (until is None or low < until)
    else:
        form = _LABELS[spec.granularity or Granularity.DAY]
        low, high = (None if edge is None else edge.strftime(form) for edge in (since, until))

        def may(name: str) -> bool:
            return (low is None or name >= low) and (high is None or name <= high)
    return {n for n in names if n != NULL_PART and may(n)}


def check_same_partition(existing: dict | None, requested: dict | None, table: str) -> None:
    """A table cannot change its partitioning in place."""
    if existing != requested:
        raise PartitionMismatch(f"table {table!r} is partitioned by {existing or 'nothing'}, "
                                f"but {requested or 'nothing'} is requested; load into a new table")


def spread(df: DataFrame) -> DataFrame:
    """Group rows by partition value for the write.  A rebalance, unlike a plain
    repartition, lets AQE split a partition that holds a third of the rows."""
    return df.hint("rebalance", PART)


def writes_one_part(partition: PartitionSpec | None, buckets: int) -> bool:
    """Whether all rows go to one partition value, so that grouping them would be for nothing."""
    return not buckets and (partition is None or partition.kind is PartitionKind.NONE)
