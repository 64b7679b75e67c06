import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.plans import cursors as K, windows as W
from millrace.spec import SpecError


def tiles(spark, column):
    return [(r.since, r.until) for r in W.plan(spark, column).collect()]


def test_inclusive(spark):
    got = tiles(spark, W.inclusive(F.lit(date(2026, 8, 1)), F.lit(date(2026, 8, 17)), 7))
    assert got == [(date(2026, 8, 1), date(2026, 8, 7)), (date(2026, 8, 8), date(2026, 8, 14)),
                   (date(2026, 8, 15), date(2026, 8, 17))]
    assert tiles(spark, W.inclusive(F.lit(date(2026, 8, 2)), F.lit(date(2026, 8, 1)), 7)) == []
    with pytest.raises(SpecError):
        W.inclusive(F.lit(date(2026, 8, 1)), F.lit(date(2026, 8, 1)), 0)


def test_half_open(spark):
    d = lambda n: datetime(2024, 1, n)
    assert tiles(spark, W.half_open(F.lit(d(1)), F.lit(d(10)), 3)) == [(d(1), d(4)), (d(4), d(7)), (d(7), d(10))]
    assert tiles(spark, W.half_open(F.lit(d(1)), F.lit(d(9)), 3))[-1] == (d(7), d(9))
    assert tiles(spark, W.half_open(F.lit(d(1)), F.lit(d(1)), 3)) == []
    with pytest.raises(SpecError):
        W.half_open(F.lit(d(1)), F.lit(d(2)), 0)


def test_random_spans_tile_exactly(spark):
    rng = random.Random(3)
    spans = [(i, date(2024, 1, 1) + timedelta(rng.randint(0, 400)), rng.randint(0, 300)) for i in range(40)]
    df = spark.createDataFrame([(i, a, a + timedelta(n)) for i, a, n in spans], "i int, a date, b date")
    for step in (1, 5, 30):
        rows = W.per_account(df, W.inclusive(F.col("a"), F.col("b"), step)).collect()
        for i, a, n in spans:
            mine = sorted((r.since, r.until) for r in rows if r.i == i)
            assert mine[0][0] == a and mine[-1][1] == a + timedelta(n)
            assert all(y[0] == x[1] + timedelta(1) for x, y in zip(mine, mine[1:]))
            assert all((u - s).days < step for s, u in mine)


def test_plans_from_cursors(spark):
    d, today = lambda m, n: date(2024, m, n), F.lit(date(2024, 3, 10))
    none = F.lit(None).cast("date")
    initial = F.lit(d(3, 1))
    assert tiles(spark, W.through_yesterday(none, initial, 3, 5, today)) == [(d(3, 1), d(3, 5)), (d(3, 6), d(3, 9))]
    assert tiles(spark, W.through_yesterday(F.lit(d(3, 8)), initial, 3, 0, today))[0] == (d(3, 5), d(3, 5))
    assert tiles(spark, W.through_yesterday(F.lit(d(3, 2)), initial, 30, 30, today)) == [(d(3, 1), d(3, 9))]
    assert tiles(spark, W.through_yesterday(F.lit(d(3, 10)), initial, 0, 5, today)) == []
    assert tiles(spark, W.or_full_sweep(none, 1, 5, today)) == [(None, None)]
    assert tiles(spark, W.or_full_sweep(F.lit(d(5, 1)), 1, 5, today)) == [(d(3, 10), d(3, 10))]
    assert tiles(spark, W.or_full_sweep(F.lit(d(3, 7)), 1, 3, today)) == [(d(3, 6), d(3, 8)), (d(3, 9), d(3, 10))]


def test_window_of_a_day_is_the_planned_one(spark):
    first = date(2024, 1, 3)
    days = spark.range(200).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("d"))
    plan = W.plan(spark, W.inclusive(F.lit(first), F.lit(date(2025, 1, 1)), 7))
    joined = days.withColumn("since", W.window_start(F.col("d"), first, 7)).join(plan, "since")
    assert joined.filter("d BETWEEN since AND until").count() == 200


def test_safe_cursor_stops_before_an_open_window(spark):
    rows = [(date(2024, 1, 1 + 2 * w), date(2024, 1, 2 + 2 * w), a, not (w == 2 and a == 1)) for w in range(5) for a in range(3)]
    progress = spark.createDataFrame(rows, "since date, until date, account int, done boolean")
    assert W.safe_cursor(W.finished_windows(progress)).first().cursor == date(2024, 1, 4)
    assert W.safe_cursor(W.finished_windows(progress.withColumn("done", F.lit(True)))).first().cursor == date(2024, 1, 10)
    assert W.finished_windows(progress).filter("all_done").count() == 4


def test_cursor_rules(spark):
    df = spark.createDataFrame([(date(2024, 1, 1), False), (date(2024, 1, 2), None), (date(2024, 1, 3), True)], "d date, i boolean")
    row = df.agg(K.complete_day_max(F.col("d"), F.lit(date(2024, 1, 3))).alias("a"),
                 K.final_day_max(F.col("d"), F.col("i")).alias("b"), K.observed_max("d").alias("c")).first()
    assert (row.a, row.b, row.c) == (date(2024, 1, 2), date(2024, 1, 2), date(2024, 1, 3))
