"""Cursor rules over columns: lookback, floor, complete days."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..spec import CursorType, parse_lookback


def less_lookback(cursor: Column, lookback: str, cursor_type: str | CursorType) -> Column:
    """A cursor column stepped back by its lookback."""
    span = parse_lookback(lookback, cursor_type)
    if isinstance(span, int):
        return cursor - F.lit(span)
    if CursorType.of(cursor_type) is CursorType.DATE:
        return F.date_sub(cursor, span.days)
    return cursor - F.make_dt_interval(F.lit(span.days), F.lit(0), F.lit(0), F.lit(span.seconds))


def floored(observed: Column, committed: Column) -> Column:
    """Never behind the committed cursor; NULLs do not count."""
    return F.greatest(observed, committed)


def observed_max(column: str) -> Column:
    """Aggregate: the highest cursor value seen, NULLs ignored."""
    return F.max(F.col(f"`{column}`"))


def complete_day_max(day: Column, today: Column) -> Column:
    """Aggregate: the last day that is over."""
    return F.max(F.when(day < today, day))


def final_day_max(day: Column, incomplete: Column) -> Column:
    """Aggregate: the last day whose rows are not marked incomplete."""
    return F.max(F.when(~F.coalesce(incomplete, F.lit(False)), day))
