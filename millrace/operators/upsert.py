"""Dedupe and merge: one row per key, newest wins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..spec import SYNCED_AT, SpecError

_HIT = "__hit"
# At most so many ranges cover the keys of a batch, whatever its size.
KEY_RANGES = 64
_NUMBERS = (T.IntegralType, T.DecimalType)
_RANGED = (*_NUMBERS, T.StringType, T.DateType, T.TimestampNTZType)


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def keep_last(df: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The last row of each key by ``order``; the remaining columns break ties, so the
    result does not depend on how rows arrive.  NULL keys count as equal.

    ``row_number() = 1`` lets Spark keep a single candidate per key in every input
    partition before the shuffle, so a key that holds a third of the rows costs one
    row per partition on the wire.
    """
    order = list(order)
    rest = [c for c in df.columns if c not in key and c not in order
            and df.schema[c].dataType.typeName() not in ("map", "variant")]
    ranking = [c.desc() for c in _cols(order + rest)] or [F.lit(1)]
    newest = Window.partitionBy(*_cols(key)).orderBy(*ranking)
    return df.withColumn("__rn", F.row_number().over(newest)).filter("__rn = 1").drop("__rn")


def keep_newest(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """``keep_last`` by load time."""
    return keep_last(df, key, [SYNCED_AT])


def _complete(key: Sequence[str]) -> Column:
    return reduce(and_, [c.isNotNull() for c in _cols(key)])


def merge(target: DataFrame, source: DataFrame, key: Sequence[str], null_keys: bool = True) -> DataFrame:
    """``target`` after upserting ``source``, which holds one row per key.

    Matched rows take the source's non-key columns; a target column the source lacks
    keeps its old value; unmatched rows are inserted.  NULL never equals NULL, so a
    row with a NULL key part is always inserted.  ``null_keys=False`` promises that
    the target has none and saves the branch that keeps those rows out of the join
    (they would all hash to one partition).

    The source is the right side of every join: Spark broadcasts it when its measured
    size is under ``autoBroadcastJoinThreshold`` and shuffles otherwise.
    """
    key = list(key)
    if not key:
        raise SpecError("merge needs a primary key")
    lacking = [c for c in target.columns if c not in source.columns]
    source_only = [c for c in source.columns if c not in target.columns]
    if source_only:
        target = target.select("*", *[F.lit(None).cast(source.schema[c].dataType).alias(c) for c in source_only])
    columns = target.columns
    values = [c for c in columns if c not in key]

    keyed, unkeyed = target, None
    if null_keys:
        keyed, unkeyed = target.filter(_complete(key)), target.filter(~_complete(key))

    if not values:
        return target.unionByName(source.join(keyed, key, "left_anti"))
    if not lacking:
        out = keyed.join(source.select(*_cols(key)), key, "left_anti").unionByName(source)
    else:
        given = [c for c in values if c not in lacking]
        right = source.select(*[F.col(f"`{k}`").alias(f"__k_{k}") for k in key],
                              *[F.col(f"`{c}`").alias(f"__s_{c}") for c in given],
                              F.lit(True).alias(_HIT))
        on = reduce(and_, [F.col(f"`{k}`") == F.col(f"`__k_{k}`") for k in key])
        updated = keyed.join(right, on, "left").select(*[
            F.when(F.col(_HIT), F.col(f"`__s_{c}`")).otherwise(F.col(f"`{c}`")).alias(c)
            if c in given else F.col(f"`{c}`") for c in columns])
        # Matched keys number at most the source's rows, so this join stays source-sized.
        matched = keyed.select(*_cols(key)).join(source.select(*_cols(key)), key, "left_semi").distinct()
        fresh = source.join(matched, key, "left_anti")
        out = updated.unionByName(fresh, allowMissingColumns=True)
    out = out.select(*_cols(columns))
    return out if unkeyed is None else out.unionByName(unkeyed)


def key_cover(source: DataFrame, key: Sequence[str]) -> Column:
    """A condition on the key columns that every row with a key of ``source`` meets: few ranges per column.

    As plain comparisons with literals it reaches the scan of a target, which then skips the files and row groups
    whose smallest and largest keys lie outside.  Numbers and dates get up to ``KEY_RANGES`` ranges, cut at equal steps and
    drawn in to the keys there are, so a batch of new keys and some old ones does not cover all between; texts get one.
    Columns without a useful order for this (floats, instants, booleans, nested values) are left out.  False if a
    key column is NULL throughout: such rows match nothing.
    """
    keyed = source.filter(_complete(key)).select(*_cols(key))
    ranged = [k for k in key if isinstance(keyed.schema[k].dataType, _RANGED)]
    if not ranged:
        return F.lit(True)
    ends = keyed.agg(*[f(f"`{k}`").alias(f"{name}_{i}") for i, k in enumerate(ranged)
                       for name, f in (("low", F.min), ("high", F.max))]).first()
    if ends["low_0"] is None:
        return F.lit(False)
    covers = []
    for i, k in enumerate(ranged):
        kind, cell, ranges = keyed.schema[k].dataType, F.col(f"`{k}`"), [(ends[f"low_{i}"], ends[f"high_{i}"])]
        if isinstance(kind, (*_NUMBERS, T.DateType)) and ranges[0][0] != ranges[0][1]:
            at = lambda c: (F.unix_date(c) if isinstance(kind, T.DateType) else c).cast("double")
            low, high = (at(F.lit(end).cast(kind)) for end in ranges[0])
            # any slot does for a key, as the ends of a slot's range are those of its keys
            slot = F.floor((at(cell) - low) / (high - low) * KEY_RANGES)
            slots = keyed.groupBy(F.least(F.greatest(slot, F.lit(0)), F.lit(KEY_RANGES)).alias("slot"))
            ranges = [(r.low, r.high) for r in slots.agg(F.min(cell).alias("low"), F.max(cell).alias("high")).collect()]
        covers.append(reduce(or_, [cell.between(F.lit(a).cast(kind), F.lit(b).cast(kind)) for a, b in sorted(ranges)]))
    return reduce(and_, covers)


def null_key_rows(key: Sequence[str]) -> Column:
    """Aggregate: rows that can never match because a key part is NULL."""
    return F.count_if(~_complete(key))


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count; empty when the key is unique."""
    complete = df.filter(_complete(key))
    return complete.groupBy(*_cols(key)).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
