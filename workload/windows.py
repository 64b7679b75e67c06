"""Date-window plans over the tables."""

from datetime import date

from pyspark.sql import functions as F

from millrace.plans import cursors as K, windows as W

from .base import day, query, sql_day, sql_stamp, stamp, table

_SPAN = "SELECT CAST(MIN(o_orderdate) AS DATE) AS a, CAST(MAX(o_orderdate) AS DATE) AS b FROM orders"
_TODAY = date(2001, 8, 5)
_CURSORS = """SELECT c_custkey, MAX(CAST(o_orderdate AS DATE)) AS cursor
              FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey"""


def _day_span(spark, sf):
    return table(spark, sf, "orders").agg(F.to_date(F.min("o_orderdate")).alias("a"),
                                          F.to_date(F.max("o_orderdate")).alias("b"))


def _customer_cursors(spark, sf):
    newest = table(spark, sf, "orders").groupBy("o_custkey").agg(F.to_date(F.max("o_orderdate")).alias("cursor"))
    customers = table(spark, sf, "customer").select("c_custkey")
    return customers.join(newest, customers.c_custkey == newest.o_custkey, "left").select("c_custkey", "cursor")


@query("windows_inclusive", f"""
    WITH s AS ({_SPAN}), t AS (SELECT b, UNNEST(range(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP) + INTERVAL 1 DAY,
                                                      INTERVAL 30 DAY)) AS f FROM s)
    SELECT {sql_day('f')} AS since, {sql_day("LEAST(CAST(f AS DATE) + 29, b)")} AS until FROM t""")
def windows_inclusive(spark, sf):
    plan = _day_span(spark, sf).select(F.inline(W.inclusive(F.col("a"), F.col("b"), 30)))
    return plan.select(day("since").alias("since"), day("until").alias("until"))


@query("windows_counts", f"""
    WITH s AS ({_SPAN}), t AS (SELECT a, b, UNNEST(range(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP) + INTERVAL 1 DAY,
                                                         INTERVAL 7 DAY)) AS f FROM s)
    SELECT {sql_day('f')} AS since, {sql_day("LEAST(CAST(f AS DATE) + 6, b)")} AS until, COUNT(o_orderkey) AS rows
    FROM t LEFT JOIN orders ON CAST(o_orderdate AS DATE) BETWEEN CAST(f AS DATE) AND CAST(f AS DATE) + 6
    GROUP BY 1, 2""")
def windows_counts(spark, sf):
    """Rows per planned window.  A row's window comes from arithmetic on its date, so the
    plan meets the data in an equi-join of totals, not in a range join of rows."""
    orders, span = table(spark, sf, "orders"), _day_span(spark, sf)
    start = W.window_start(F.to_date("o_orderdate"), span.select("a").scalar(), 7)
    totals = orders.groupBy(start.alias("since")).agg(F.count(F.lit(1)).alias("rows"))
    plan = span.select(F.inline(W.inclusive(F.col("a"), F.col("b"), 7)))
    return plan.join(totals, "since", "left").select(
        day("since").alias("since"), day("until").alias("until"), F.coalesce("rows", F.lit(0)).alias("rows"))


@query("windows_yesterday", f"""
    WITH c AS ({_CURSORS}), s AS (SELECT c_custkey, DATE '2001-08-05' - 1 AS y,
             GREATEST(COALESCE(cursor - 10, DATE '2001-07-20'), DATE '2001-07-20') AS f FROM c),
         t AS (SELECT c_custkey, y, UNNEST(range(CAST(f AS TIMESTAMP), CAST(y AS TIMESTAMP) + INTERVAL 1 DAY,
                                                 INTERVAL 5 DAY)) AS w FROM s)
    SELECT c_custkey, {sql_day('w')} AS since, {sql_day("LEAST(CAST(w AS DATE) + 4, y)")} AS until FROM t""")
def windows_yesterday(spark, sf):
    cursors = _customer_cursors(spark, sf)
    plan = W.through_yesterday(F.col("cursor"), F.lit(date(2001, 7, 20)), 10, 5, F.lit(_TODAY))
    return W.per_account(cursors, plan).select("c_custkey", day("since").alias("since"), day("until").alias("until"))


@query("windows_or_sweep", f"""
    WITH c AS ({_CURSORS}), s AS (SELECT c_custkey, cursor, DATE '2001-08-05' AS y,
             LEAST(cursor - 3, DATE '2001-08-05') AS f FROM c),
         t AS (SELECT c_custkey, y, UNNEST(range(CAST(f AS TIMESTAMP), CAST(y AS TIMESTAMP) + INTERVAL 1 DAY,
                                                 INTERVAL 60 DAY)) AS w FROM s WHERE cursor IS NOT NULL)
    SELECT c_custkey, {sql_day('w')} AS since, {sql_day("LEAST(CAST(w AS DATE) + 59, y)")} AS until FROM t
    UNION ALL SELECT c_custkey, NULL, NULL FROM s WHERE cursor IS NULL""")
def windows_or_sweep(spark, sf):
    plan = W.or_full_sweep(F.col("cursor"), 3, 60, F.lit(_TODAY))
    return W.per_account(_customer_cursors(spark, sf), plan).select(
        "c_custkey", day("since").alias("since"), day("until").alias("until"))


@query("windows_halfopen", f"""
    WITH s AS (SELECT user_id, date_trunc('day', MIN(ts) - INTERVAL 2 DAY) AS a, date_trunc('day', MAX(ts)) AS b
               FROM events GROUP BY user_id),
         t AS (SELECT user_id, b, UNNEST(range(a, b, INTERVAL 10 DAY)) AS f FROM s)
    SELECT user_id, {sql_stamp('f')} AS since, {sql_stamp('LEAST(f + INTERVAL 10 DAY, b)')} AS until FROM t""")
def windows_halfopen(spark, sf):
    per_user = table(spark, sf, "events").groupBy("user_id").agg(
        F.min("ts").cast("timestamp").alias("a"), F.max("ts").cast("timestamp").alias("b"))
    start = W.start_at_midnight(F.col("a"), 2, F.lit("2024-01-01").cast("timestamp"))
    plan = W.half_open(start, F.date_trunc("day", "b"), 10)
    return W.per_account(per_user, plan).select("user_id", stamp("since").alias("since"), stamp("until").alias("until"))


@query("window_start_modes", f"""
    WITH c AS ({_CURSORS})
    SELECT c_custkey,
           {sql_day("GREATEST(COALESCE(cursor - 7, DATE '1999-01-01'), DATE '1999-01-01')")} AS with_lookback,
           {sql_stamp("COALESCE(CAST(cursor AS TIMESTAMP) - INTERVAL 7 DAY, TIMESTAMP '1999-01-01')")} AS at_midnight,
           {sql_day("GREATEST(COALESCE(cursor, DATE '1999-01-01'), DATE '2001-08-05' - 7)")} AS capped
    FROM c""")
def window_start_modes(spark, sf):
    cursor, initial = F.col("cursor"), F.lit(date(1999, 1, 1))
    return _customer_cursors(spark, sf).select(
        "c_custkey", day(W.start_with_lookback(cursor, 7, initial)).alias("with_lookback"),
        stamp(W.start_at_midnight(cursor.cast("timestamp"), 7, initial.cast("timestamp"))).alias("at_midnight"),
        day(W.start_capped_lookback(cursor, 7, initial, F.lit(_TODAY))).alias("capped"))


_FAILED = "o_orderstatus = 'P' AND o_totalprice > 490000"


@query("window_account_progress", f"""
    WITH w AS (SELECT CAST(UNNEST(range(TIMESTAMP '1995-01-01', TIMESTAMP '2001-08-02', INTERVAL 90 DAY)) AS DATE) AS f),
         bad AS (SELECT DISTINCT o_custkey, DATE '1995-01-01' + CAST(datediff('day', DATE '1995-01-01',
                        CAST(o_orderdate AS DATE)) // 90 * 90 AS INT) AS f FROM orders WHERE {_FAILED})
    SELECT {sql_day('w.f')} AS since, {sql_day("LEAST(w.f + 89, DATE '2001-08-01')")} AS until,
           COUNT(bad.o_custkey) = 0 AS all_done, COUNT(*) AS accounts
    FROM w CROSS JOIN customer LEFT JOIN bad ON bad.o_custkey = c_custkey AND bad.f = w.f GROUP BY 1, 2""")
def window_account_progress(spark, sf):
    return _progress(spark, sf).select(day("since").alias("since"), day("until").alias("until"),
                                               "all_done", "accounts")


def _progress(spark, sf):
    """Every customer's windows, a window of a customer being done unless an order in it failed."""
    first, last = date(1995, 1, 1), date(2001, 8, 1)
    plan = W.inclusive(F.lit(first), F.lit(last), 90)
    failed = table(spark, sf, "orders").filter(_FAILED).select(
        F.col("o_custkey").alias("c_custkey"),
        W.window_start(F.to_date("o_orderdate"), first, 90).alias("since"))
    return W.open_windows(table(spark, sf, "customer"), plan, failed, "c_custkey")


@query("window_safe_cursor", f"""
    WITH bad AS (SELECT MIN(DATE '1995-01-01' + CAST(datediff('day', DATE '1995-01-01',
                        CAST(o_orderdate AS DATE)) // 90 * 90 AS INT)) AS f FROM orders
                 JOIN customer ON o_custkey = c_custkey WHERE {_FAILED})
    SELECT COALESCE({sql_day('f - 1')}, '2001-08-01') AS cursor FROM bad""")
def window_safe_cursor(spark, sf):
    return W.safe_cursor(_progress(spark, sf)).select(day("cursor").alias("cursor"))


@query("complete_day_cursor", f"""
    SELECT event_type, {sql_day("MAX(CAST(ts AS DATE)) FILTER (CAST(ts AS DATE) < DATE '2024-01-21')")} AS by_today,
           {sql_day("MAX(CAST(ts AS DATE)) FILTER (NOT (event_id % 50 = 0))")} AS by_flag
    FROM events GROUP BY event_type""")
def complete_day_cursor(spark, sf):
    d = F.to_date("ts")
    return table(spark, sf, "events").groupBy("event_type").agg(
        day(K.complete_day_max(d, F.lit(date(2024, 1, 21)))).alias("by_today"),
        day(K.final_day_max(d, F.col("event_id") % 50 == 0)).alias("by_flag"))


@query("cursor_floor", f"""
    WITH c AS (SELECT user_id, MAX(ts) FILTER (event_type = 'click') AS observed,
                      MAX(ts) FILTER (event_type = 'view') AS committed FROM events GROUP BY user_id)
    SELECT user_id, {sql_stamp('GREATEST(observed, committed)')} AS cursor FROM c""")
def cursor_floor(spark, sf):
    seen = lambda kind: F.max(F.when(F.col("event_type") == kind, F.col("ts")))
    cursors = table(spark, sf, "events").groupBy("user_id").agg(seen("click").alias("o"), seen("view").alias("c"))
    return cursors.select("user_id", stamp(K.floored(F.col("o"), F.col("c"))).alias("cursor"))


_DONE = """SELECT {account} AS account, CAST(o_orderdate AS DATE) AS since,
                  CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INT) AS until FROM orders"""
_ISLANDS = """
    done AS ({done}),
    marked AS (SELECT *, COALESCE(since > MAX(until) OVER (PARTITION BY account ORDER BY since, until
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1, TRUE) AS new FROM done),
    numbered AS (SELECT *, SUM(CAST(new AS INT)) OVER (PARTITION BY account ORDER BY since, until ROWS UNBOUNDED PRECEDING) AS island FROM marked),
    islands AS (SELECT account, MIN(since) AS since, MAX(until) AS until FROM numbered GROUP BY account, island)"""


def _done(spark, sf, account):
    since = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select(F.expr(account).alias("account"), since.alias("since"),
                                             F.date_add(since, (F.col("o_orderkey") % 40).cast("int")).alias("until"))


@query("window_coverage", f"""
    WITH {_ISLANDS.format(done=_DONE.format(account="o_custkey"))}
    SELECT account, {sql_day('since')} AS since, {sql_day('until')} AS until, TRUE AS done FROM islands
    UNION ALL SELECT account, {sql_day('before + 1')}, {sql_day('since - 1')}, FALSE FROM (
        SELECT *, lag(until) OVER (PARTITION BY account ORDER BY since) AS before FROM islands) t WHERE before IS NOT NULL""")
def window_coverage(spark, sf):
    """Finished intervals of any length, overlapping or not: what each account has finished, and the gaps between."""
    covered = W.coverage(_done(spark, sf, "o_custkey"), "account")
    rows = covered.withColumn("done", F.lit(True)).unionByName(W.coverage_gaps(covered, "account").withColumn("done", F.lit(False)))
    return rows.select("account", day("since").alias("since"), day("until").alias("until"), "done")


@query("window_covered_cursor", f"""
    WITH {_ISLANDS.format(done=_DONE.format(account="o_custkey % 5"))},
    firsts(f) AS (VALUES (DATE '1990-01-01'), (DATE '1996-01-01'), (DATE '1998-06-01'), (DATE '2001-07-01')),
    each AS (SELECT f, a.account, COALESCE(MAX(until), MIN(f) - 1) AS cursor
             FROM firsts CROSS JOIN (SELECT DISTINCT account FROM islands) a
             LEFT JOIN islands i ON i.account = a.account AND since <= f AND until >= f GROUP BY f, a.account)
    SELECT {sql_day('f')} AS first, {sql_day('MIN(cursor)')} AS cursor FROM each GROUP BY f""")
def window_covered_cursor(spark, sf):
    """The safe cursor over all accounts, from several first days."""
    covered, out = W.coverage(_done(spark, sf, "o_custkey % 5"), "account"), None
    for first in (date(1990, 1, 1), date(1996, 1, 1), date(1998, 6, 1), date(2001, 7, 1)):
        one = W.covered_cursor(covered, covered, "account", first).select(day(F.lit(first)).alias("first"), day("cursor").alias("cursor"))
        out = one if out is None else out.unionByName(one)
    return out
