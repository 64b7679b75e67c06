"""Incremental selection: cursor floors, lookback, query sources, bootstrap sweeps."""

from datetime import date, datetime

from pyspark.sql import functions as F

from millrace.functions import values as V
from millrace.operators import selection as S
from millrace.plans import cursors as K
from millrace.sources import tables as src
from millrace.spec import Incremental

from .base import day, money, query, sql_day, sql_money, sql_stamp, stamp, table


@query("incremental_strict", f"""
    SELECT event_id, user_id, event_type, {sql_stamp('ts')} AS ts
    FROM events WHERE ts > TIMESTAMP '2024-01-10 12:00:00'""")
def incremental_strict(spark, sf):
    new = src.read_table(table(spark, sf, "events"), "ts", datetime(2024, 1, 10, 12))
    return new.select("event_id", "user_id", "event_type", stamp("ts").alias("ts"))


@query("incremental_inclusive", f"""
    SELECT o_orderkey, {sql_day('o_orderdate')} AS created, o_totalprice
    FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""")
def incremental_inclusive(spark, sf):
    new = src.read_table(table(spark, sf, "orders"), "o_orderdate", datetime(1998, 1, 1), inclusive=True)
    return new.select("o_orderkey", day("o_orderdate").alias("created"), "o_totalprice")


@query("incremental_between", f"""
    SELECT o_orderkey, o_custkey, {sql_day('o_orderdate')} AS day FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1997-02-28'""")
def incremental_between(spark, sf):
    orders = table(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate"))
    rows = S.within(orders, "day", date(1996, 3, 1), date(1997, 2, 28))
    return rows.select("o_orderkey", "o_custkey", day("day").alias("day"))


@query("incremental_key", f"""
    SELECT l_orderkey, COUNT(*) AS lines, {sql_money('l_extendedprice')} AS amount
    FROM lineitem WHERE l_shipdate > TIMESTAMP '1998-06-30' GROUP BY l_orderkey""")
def incremental_key(spark, sf):
    new = src.read_table(table(spark, sf, "lineitem"), "l_shipdate", datetime(1998, 6, 30))
    return new.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"),
                                         money("l_extendedprice").alias("amount"))


@query("incremental_query", f"""
    SELECT * FROM (SELECT o.o_orderkey AS id, c.c_mktsegment AS segment, o.o_totalprice AS total,
                          {sql_stamp('o.o_orderdate')} AS updated_at
                   FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey) q
    WHERE updated_at > '1997-06-30 00:00:00.000000'""")
def incremental_query(spark, sf):
    text = """SELECT o.o_orderkey AS id, c.c_mktsegment AS segment, o.o_totalprice AS total,
                     o.o_orderdate AS updated_at
              FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey"""
    new = src.read_query(spark, text, "updated_at", datetime(1997, 6, 30),
                         orders=table(spark, sf, "orders"), customer=table(spark, sf, "customer"))
    return new.withColumn("updated_at", stamp("updated_at"))


@query("sql_as_stream", f"""
    SELECT o_orderkey AS id, o_totalprice AS amount, {sql_stamp('o_orderdate')} AS created,
           o_orderstatus AS status, o_orderstatus = 'F' AS paid
    FROM orders WHERE o_orderdate > TIMESTAMP '1996-05-20 10:00:00' AND o_totalprice > 1500.5
                  AND o_orderpriority <> 'T.B.D.' AND o_orderstatus <> 'P'""")
def sql_as_stream(spark, sf):
    text = """SELECT o_orderkey AS id, o_totalprice AS amount, o_orderdate AS created,
                     o_orderstatus AS status, o_orderstatus = 'F' AS paid
              FROM {orders} WHERE o_orderdate > CAST({since} AS TIMESTAMP_NTZ) AND o_totalprice > {least}
                AND o_orderpriority <> {later} AND concat(o_orderstatus, 'T.') <> {status}"""
    rows = src.read_sql(spark, text, {"since": "1996-05-20T10:00:00.500+00:00", "least": 1500.5, "later": "T.B.D.",
                                      "status": "PT."},
                        orders=table(spark, sf, "orders"))
    return rows.withColumn("created", stamp("created"))


@query("account_window_query", f"""
    SELECT CAST(c_custkey AS VARCHAR) AS customer_id, {sql_day('o_orderdate')} AS date, COUNT(*) AS clicks,
           {sql_money('o_totalprice')} AS cost
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
      AND CAST(o_orderdate AS DATE) BETWEEN DATE '1995-06-01' AND DATE '1999-12-31'
    GROUP BY 1, 2""")
def account_window_query(spark, sf):
    text = """SELECT CAST(c_custkey AS STRING) AS customer_id, date_format(o_orderdate, 'yyyy-MM-dd') AS date,
                     count(*) AS clicks, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS cost
              FROM {orders} JOIN {accounts} ON o_custkey = c_custkey
              WHERE CAST(o_orderdate AS DATE) BETWEEN CAST({since} AS DATE) AND CAST({until} AS DATE)
              GROUP BY 1, 2"""
    accounts = table(spark, sf, "customer").filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    return src.read_sql(spark, text, {"since": date(1995, 6, 1), "until": date(1999, 12, 31)},
                        orders=table(spark, sf, "orders"), accounts=accounts)


@query("lookback_rescan", f"""
    SELECT event_type, COUNT(*) AS rows, {sql_stamp('MAX(ts)')} AS cursor, {sql_stamp('MIN(ts)')} AS first_ts
    FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 36 HOUR GROUP BY event_type""")
def lookback_rescan(spark, sf):
    inc = Incremental("ts", "timestamp", lookback="36h")
    new = src.read_table(table(spark, sf, "events"), "ts", inc.seed("2024-01-20T00:00:00+00:00"))
    return new.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"),
                                         stamp(K.observed_max("ts")).alias("cursor"),
                                         stamp(F.min("ts")).alias("first_ts"))


@query("lookback_columns", f"""
    WITH c AS (SELECT user_id, MAX(ts) AS t FROM events GROUP BY user_id)
    SELECT user_id, {sql_stamp("t - INTERVAL 90 MINUTE")} AS by_time,
           {sql_day("CAST(t AS DATE) - INTERVAL 2 DAY")} AS by_day,
           CAST(epoch(t) AS BIGINT) - 21600 AS by_second
    FROM (SELECT user_id, date_trunc('second', t) AS t FROM c)""")
def lookback_columns(spark, sf):
    cursors = table(spark, sf, "events").groupBy("user_id").agg(
        F.date_trunc("second", K.observed_max("ts")).alias("t"))
    return cursors.select(
        "user_id",
        stamp(K.less_lookback(F.col("t"), "90m", "timestamp")).alias("by_time"),
        day(K.less_lookback(F.to_date("t"), "25h", "date")).alias("by_day"),
        K.less_lookback(F.unix_seconds(F.col("t").cast("timestamp")), "6h", "int").alias("by_second"))


@query("full_sweep_cursor", """
    SELECT o_orderpriority AS stream, COUNT(*) AS rows, MAX(CAST(CAST(o_orderdate AS DATE) AS VARCHAR)) AS cursor
    FROM orders GROUP BY o_orderpriority""")
def full_sweep_cursor(spark, sf):
    swept = src.read_table(table(spark, sf, "orders")).withColumn("date_updated", day("o_orderdate"))
    return swept.groupBy(F.col("o_orderpriority").alias("stream")).agg(
        F.count(F.lit(1)).alias("rows"), K.observed_max("date_updated").alias("cursor"))


_CURSOR_TEXT = """CASE event_id % 6
    WHEN 0 THEN CAST(CAST(ts AS DATE) AS STRING) || 'T08:09:10Z'
    WHEN 1 THEN CAST(CAST(ts AS DATE) AS STRING) || 'T08:09:10+00:00'
    WHEN 2 THEN CAST(CAST(ts AS DATE) AS STRING) || 'T08:09:10.123Z'
    WHEN 3 THEN CAST(CAST(ts AS DATE) AS STRING) || ' 08:09:10'
    WHEN 4 THEN CAST(CAST(ts AS DATE) AS STRING) || 'T08:09:10.5-05:30'
    ELSE CAST(CAST(ts AS DATE) AS STRING) END"""


@query("cursor_literal", f"""
    WITH r AS (SELECT event_id, {_CURSOR_TEXT} AS raw FROM events)
    SELECT event_id, CASE WHEN LENGTH(raw) = 10 THEN raw
                          ELSE SUBSTR(raw, 1, 10) || ' 08:09:10' END AS literal FROM r""")
def cursor_literal(spark, sf):
    raw = table(spark, sf, "events").selectExpr("event_id", f"{_CURSOR_TEXT} AS raw")
    return raw.select("event_id", V.sql_timestamp_text(F.col("raw")).alias("literal"))


# --------------------------------------------------------------------------
# bootstrap

_KEY = ["l_orderkey", "l_linenumber"]


@query("bootstrap_slice", """
    WITH rest AS (SELECT l_orderkey, l_linenumber, l_partkey,
                         RANK() OVER (ORDER BY l_orderkey, l_linenumber) AS r
                  FROM lineitem WHERE (l_orderkey, l_linenumber) > (100, 3))
    SELECT l_orderkey, l_linenumber, l_partkey FROM rest WHERE r <= 4 * 1000""")
def bootstrap_slice(spark, sf):
    """The slice after (100, 3) of at most four pages of a thousand rows."""
    rows, _ = S.bootstrap_slice(table(spark, sf, "lineitem"), _KEY, last=(100, 3), max_rows=4 * 1000)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey")


@query("bootstrap_handover", f"""
    WITH k AS (SELECT l_orderkey, l_linenumber, MAX(l_shipdate) AS mx, COUNT(*) AS n
               FROM lineitem GROUP BY l_orderkey, l_linenumber),
         c AS (SELECT *, SUM(n) OVER (ORDER BY l_orderkey, l_linenumber) AS run FROM k),
         t AS (SELECT COUNT(*) AS total, CAST(CEIL(COUNT(*) / 2.0) AS BIGINT) AS half FROM lineitem),
         e AS (SELECT MIN(CASE WHEN run >= half THEN run END) AS edge FROM c, t),
         s AS (SELECT CASE WHEN run <= edge THEN 1 ELSE 2 END AS slice, l_orderkey, l_linenumber, mx, n
               FROM c, e),
         g AS (SELECT slice, SUM(n) AS rows, MAX(mx) AS mx FROM s GROUP BY slice)
    SELECT slice, CAST(rows AS BIGINT) AS rows,
           {sql_stamp('MAX(mx) OVER (ORDER BY slice)')} AS cursor_max,
           slice = 2 AS bootstrapped FROM g""")
def bootstrap_handover(spark, sf):
    """Two runs sweep the whole table in key order; each commits the highest cursor so
    far, and only the completing run hands it over."""
    lines = table(spark, sf, "lineitem")
    half = -(-lines.count() // 2)
    first, end = S.bootstrap_slice(lines, _KEY, None, half)
    second = S.after_key(lines, _KEY, end)
    totals = None
    for number, rows in ((1, first), (2, second)):
        one = rows.agg(F.count(F.lit(1)).alias("rows"), K.observed_max("l_shipdate").alias("mx"))
        one = one.withColumn("slice", F.lit(number))
        totals = one if totals is None else totals.unionByName(one)
    earlier = totals.filter("slice = 1").select(F.col("mx").alias("before"))
    running = F.greatest("mx", earlier.scalar())
    return totals.select("slice", "rows", stamp(running).alias("cursor_max"),
                         (F.col("slice") == 2).alias("bootstrapped"))


# --------------------------------------------------------------------------
# account and status filters

_TREE = """SELECT c_custkey AS id, CAST(c_nationkey % 4 AS INT) AS level, c_acctbal < 0 AS manager,
                  CASE WHEN c_mktsegment = 'BUILDING' THEN 'CLOSED' ELSE 'ENABLED' END AS status"""


@query("account_tree", f"""
    SELECT CAST(id AS VARCHAR) AS id FROM ({_TREE} FROM customer)
    WHERE level BETWEEN 1 AND 2 AND NOT manager AND status = 'ENABLED'""")
def account_tree(spark, sf):
    tree = spark.sql(_TREE + " FROM {customer}", customer=table(spark, sf, "customer"))
    return S.account_tree(tree, 2)


_MANAGES = "c_custkey % 3 <> 0"


@query("account_tree_edges", f"""
    WITH RECURSIVE links AS (
        SELECT c_custkey // 4 AS parent, c_custkey AS child FROM customer
        UNION SELECT c_custkey, c_custkey // 4 FROM customer WHERE c_custkey % 7 = 0),
    tree(id, level) AS (SELECT c_custkey, 0 FROM customer WHERE c_custkey IN (1, 2)
        UNION SELECT child, level + 1 FROM tree JOIN links ON parent = id JOIN customer ON c_custkey = id WHERE level < 4 AND {_MANAGES})
    SELECT CAST(id AS VARCHAR) AS id, MIN(level) AS level FROM tree JOIN customer ON c_custkey = id
    WHERE NOT ({_MANAGES}) AND c_mktsegment <> 'BUILDING' GROUP BY id HAVING MIN(level) > 0""")
def account_tree_edges(spark, sf):
    """Accounts under two managers, four links down, over links that lead back up as well."""
    customer = table(spark, sf, "customer")
    accounts = customer.select(F.col("c_custkey").alias("id"), F.expr(_MANAGES).alias("manager"),
                               F.when(F.col("c_mktsegment") == "BUILDING", "CLOSED").otherwise("ENABLED").alias("status"))
    up = F.expr("c_custkey div 4")
    links = customer.select(up.alias("parent"), F.col("c_custkey").alias("child")).unionByName(
        customer.filter("c_custkey % 7 = 0").select(F.col("c_custkey").alias("parent"), up.alias("child")))
    return S.account_tree_of_links(accounts, links, accounts.filter("id IN (1, 2)"), 4)


@query("tagged_filter", """
    SELECT o_orderkey, o_orderpriority AS agency, o_totalprice FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def tagged_filter(spark, sf):
    rows = S.tagged(table(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"], "agency")
    return rows.select("o_orderkey", "agency", "o_totalprice")


@query("status_snapshot", """
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'""")
def status_snapshot(spark, sf):
    return S.with_status(table(spark, sf, "orders"), "o_orderstatus", "O").select(
        "o_orderkey", "o_custkey", "o_orderstatus")
