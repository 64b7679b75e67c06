"""Date-window plans as column expressions.

Each function yields an array of ``struct(since, until)``; ``explode`` it to get
one row per window.  They take columns, so one plan covers any number of
streams, and a row's own window comes from arithmetic on its date rather than
from a range join (``window_start``).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..spec import SpecError


def _days(n: int) -> Column:
    return F.make_interval(days=F.lit(n))


def _tiles(start: Column, end: Column, days: int, type: str, last) -> Column:
    """Tiles from ``start``; ``end`` is the last possible start."""
    starts = F.sequence(start, end, _days(days))
    tiles = F.transform(starts, lambda s: F.struct(s.cast(type).alias("since"), last(s).alias("until")))
    return F.when(start <= end, tiles).otherwise(F.array().cast(f"array<struct<since:{type},until:{type}>>"))


def inclusive(first: Column, last: Column, days: int) -> Column:
    """Days ``first..last`` in windows of ``days`` that neither overlap nor leave a gap."""
    if days < 1:
        raise SpecError(f"a window needs at least one day, got {days}")
    return _tiles(first, last, days, "date", lambda s: F.least(F.date_add(s, days - 1), last).cast("date"))


def half_open(start: Column, end: Column, days: int) -> Column:
    """``[since, until)`` windows of ``days``, the last one clipped to ``end``."""
    if days < 1:
        raise SpecError(f"a window needs at least one day, got {days}")
    last_start = end - F.expr("INTERVAL 1 MICROSECOND")
    return _tiles(start, last_start, days, "timestamp", lambda s: F.least(s + _days(days), end))


def through_yesterday(cursor: Column, initial: Column, lookback: int, days: int, today: Column) -> Column:
    """Complete days only: from ``cursor - lookback`` (not before ``initial``) to yesterday."""
    return inclusive(start_with_lookback(cursor, lookback, initial), F.date_sub(today, 1), max(days, 1))


def or_full_sweep(cursor: Column, lookback: int, days: int, today: Column) -> Column:
    """Through today; without a cursor one window open at both ends, and a cursor from
    the future still gives the one window that ends today."""
    start = F.least(F.date_sub(cursor, lookback), today)
    sweep = F.array(F.struct(F.lit(None).cast("date").alias("since"), F.lit(None).cast("date").alias("until")))
    return F.when(cursor.isNull(), sweep).otherwise(inclusive(start, today, max(days, 1)))


# --------------------------------------------------------------------------
# where a plan starts


def start_with_lookback(cursor: Column, lookback: int, initial: Column) -> Column:
    """``cursor - lookback`` but not before ``initial``; ``initial`` without a cursor."""
    return F.greatest(F.coalesce(F.date_sub(cursor, lookback), initial), initial)


def start_at_midnight(cursor: Column, lookback: int, initial: Column) -> Column:
    """Timestamp cursor less whole days, or ``initial``, cut to midnight UTC."""
    return F.date_trunc("day", F.coalesce(cursor - _days(lookback), initial))


def start_capped_lookback(cursor: Column, lookback: int, initial: Column, today: Column) -> Column:
    """``max(cursor, today - lookback)``.  It never re-reads a fresh cursor's days and
    skips the gap behind an old one, so it is offered under its own name only;
    ``start_with_lookback`` is the default everywhere."""
    return F.greatest(F.coalesce(cursor, initial), F.date_sub(today, lookback))


# --------------------------------------------------------------------------
# plans over data


def window_start(day: Column, first: date | Column, days: int) -> Column:
    """First day of the window that holds ``day``, for windows of ``days`` from ``first``."""
    first = F.lit(first) if isinstance(first, date) else first
    return F.date_add(first, (F.floor(F.datediff(day, first) / days) * days).cast("int"))


def plan(spark, windows: Column) -> DataFrame:
    """A plan of literals as a DataFrame ``since, until``."""
    return spark.range(1).select(F.inline(windows))


def per_account(accounts: DataFrame, windows: Column) -> DataFrame:
    """One row per account and window: every account row expands to its windows."""
    return accounts.select("*", F.inline(windows))


def finished_windows(progress: DataFrame, done: str = "done") -> DataFrame:
    """Per window: whether all accounts have finished it, and how many there are."""
    return progress.groupBy("since", "until").agg(
        F.bool_and(F.coalesce(F.col(done), F.lit(False))).alias("all_done"),
        F.count(F.lit(1)).alias("accounts"))


def open_windows(accounts: DataFrame, windows: Column, unfinished: DataFrame, account: str) -> DataFrame:
    """What ``finished_windows`` tells of a walk of all accounts over all windows, from what is not
    finished alone: rows (``account``, ``since``).  Accounts are counted once; accounts times
    windows are never made."""
    known = accounts.select(account).distinct()
    total = known.agg(F.count(F.lit(1))).scalar()
    gaps = unfinished.join(known, account, "left_semi").groupBy("since").agg(F.lit(False).alias("__ok"))
    return (plan(accounts.sparkSession, windows).join(gaps, "since", "left")
            .select("since", "until", F.coalesce("__ok", F.lit(True)).alias("all_done"), total.alias("accounts")))


def safe_cursor(windows: DataFrame) -> DataFrame:
    """One row ``cursor``: the last day such that every window up to it is finished."""
    open_from = F.min(F.when(~F.col("all_done"), F.col("since")))
    return windows.agg(open_from.alias("open_from"), F.max("until").alias("last")).select(
        F.coalesce(F.date_sub("open_from", 1), F.col("last")).alias("cursor"))


# --------------------------------------------------------------------------
# coverage: finished intervals of any shape

# Days of a stretch whose intervals are united before an account's are.
_STRETCH = 64


def _united(rows: DataFrame, *keys: str) -> DataFrame:
    """Intervals (``since``, ``until``, both inclusive) of each key that neither overlap nor touch."""
    ahead = Window.partitionBy(*keys).orderBy("since", "until")
    reached = F.max("until").over(ahead.rowsBetween(Window.unboundedPreceding, -1))
    starts = rows.withColumn("__new", F.coalesce(F.col("since") > F.date_add(reached, 1), F.lit(True)).cast("int"))
    island = F.sum("__new").over(ahead.rowsBetween(Window.unboundedPreceding, 0))
    return (starts.withColumn("__island", island).groupBy(*keys, "__island")
            .agg(F.min("since").alias("since"), F.max("until").alias("until")).drop("__island"))


def coverage(finished: DataFrame, account: str) -> DataFrame:
    """The days each account has finished, as intervals that neither overlap nor touch, from intervals of any
    length and overlap; rows without a day, or that end before they begin, count for nothing.

    Intervals are united by stretches of the calendar first, so what is left of an account that has a third of
    all rows is bounded by its days.
    """
    rows = finished.filter("since <= until").select(account, "since", "until")
    stretch = F.floor(F.datediff("since", F.lit(date(1970, 1, 1))) / _STRETCH)
    # equal intervals fold before they are shuffled by account
    partly = _united(rows.distinct().withColumn("__stretch", stretch), account, "__stretch").drop("__stretch")
    return _united(partly, account)


def coverage_gaps(covered: DataFrame, account: str) -> DataFrame:
    """The days between an account's intervals: ``since``, ``until``."""
    order = Window.partitionBy(account).orderBy("since")
    before = F.lag("until").over(order)
    return (covered.withColumn("__before", before).filter("__before IS NOT NULL")
            .select(account, F.date_add("__before", 1).alias("since"), F.date_sub("since", 1).alias("until")))


def covered_cursor(covered: DataFrame, accounts: DataFrame, account: str, first: date) -> DataFrame:
    """One row ``cursor``: the last day such that every account has finished all days from ``first`` on; the day
    before ``first`` if one has not begun, NULL without accounts."""
    start = F.lit(first)
    done = covered.filter((F.col("since") <= start) & (F.col("until") >= start)).select(account, F.col("until").alias("__done"))
    each = accounts.select(account).distinct().join(done, account, "left")
    return each.agg(F.min(F.coalesce("__done", F.date_sub(start, 1))).alias("cursor"))
