"""Record shaping: projections, label joins, parent/child payloads, scalar rules."""

from datetime import datetime, timezone

from pyspark.sql import functions as F, types as T

from millrace.functions import values as V
from millrace.operators import shaping as S
from millrace.operators.normalize import normalize
from millrace.spec import table_schema

from .base import day, query, sql_day, sql_stamp, stamp, table

_AT = datetime(2024, 6, 1, 12, 0, tzinfo=timezone.utc)
_AT_TEXT = "'2024-06-01 12:00:00.000000'"


@query("project_allowlist", "SELECT p_partkey, p_brand FROM part")
def project_allowlist(spark, sf):
    return S.allow_list(table(spark, sf, "part"), ["p_partkey", "p_color", "p_brand"])


@query("project_fixed", "SELECT p_partkey, CAST(NULL AS VARCHAR) AS p_color, p_brand FROM part")
def project_fixed(spark, sf):
    return S.fixed_list(table(spark, sf, "part"), {"p_partkey": T.LongType(), "p_color": T.StringType(),
                                                   "p_brand": T.StringType()})


@query("flatten_map", f"""
    SELECT CAST(o_custkey AS VARCHAR) AS customer_id, {sql_day('o_orderdate')} AS date,
           CAST(o_orderkey AS VARCHAR) AS campaign_id,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS campaign_name,
           CAST(NULL AS BIGINT) AS impressions, o_custkey AS clicks,
           CAST(ROUND(o_totalprice * 100) AS BIGINT) AS cost_micros, o_totalprice AS conversions,
           CAST(NULL AS DOUBLE) AS conversions_value FROM orders""")
def flatten_map(spark, sf):
    """Nested report rows to flat typed columns; an absent or null leaf is NULL."""
    campaign = F.struct(F.col("o_orderkey").alias("id"),
                        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("name"))
    metrics = F.struct(F.col("o_custkey").cast("string").alias("clicks"), F.col("o_totalprice").alias("conversions"),
                       F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string").alias("costMicros"))
    body = F.to_json(F.struct(F.struct(day("o_orderdate").alias("date")).alias("segments"),
                              campaign.alias("campaign"), metrics.alias("metrics")))
    rows = table(spark, sf, "orders").select("o_custkey", F.parse_json(body).alias("record"))
    flat = S.flatten(rows, S.FIELD_MAPS["campaign_daily_stats"], F.col("o_custkey").cast("string"))
    typed = normalize(flat, table_schema(
        ("customer_id", "STRING"), ("date", "DATE"), ("campaign_id", "STRING"), ("campaign_name", "STRING"),
        ("impressions", "INTEGER"), ("clicks", "INTEGER"), ("cost_micros", "INTEGER"), ("conversions", "FLOAT"),
        ("conversions_value", "FLOAT")))
    return typed.withColumn("date", day("date"))


@query("attribute_stamp", """
    SELECT c_custkey, n_name AS timezone_name,
           CASE WHEN n_nationkey % 5 <> 0 THEN n_nationkey - 12.5::DOUBLE END AS timezone_offset_hours_utc
    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey <> 2""")
def attribute_stamp(spark, sf):
    """Account attributes on every row; a bad offset and an unknown account give NULL."""
    accounts = table(spark, sf, "nation").filter("n_regionkey <> 2").selectExpr(
        "n_nationkey AS c_nationkey", "n_name AS timezone_name",
        "CASE WHEN n_nationkey % 5 = 0 THEN 'UTC+1' ELSE CAST(n_nationkey - 12.5D AS STRING) END"
        " AS timezone_offset_hours_utc")
    rows = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return S.stamp_account(rows, accounts, "c_nationkey").drop("c_nationkey")


@query("measure_label_join", f"""
    WITH v AS (SELECT event_id, user_id, value, event_type, ts, UNNEST([0, 1, 2, 3]) AS m FROM events)
    SELECT event_id AS chart, {sql_day('ts')} AS cohort_date,
           CASE m WHEN 0 THEN 'Revenue' WHEN 1 THEN 'count' WHEN 2 THEN 'measure_2' ELSE 'measure_7' END AS measure_name,
           CASE WHEN m = 1 THEN CAST(user_id AS DOUBLE) ELSE value END AS value, event_type = 'error' AS incomplete,
           {_AT_TEXT} AS pulled_at FROM v""")
def measure_label_join(spark, sf):
    """Labels by position: display name, else name, else a numbered fallback."""
    at = F.unix_seconds(F.date_trunc("day", "ts").cast("timestamp"))
    point = lambda measure, value, cohort=at: F.struct(
        cohort.alias("cohort"), measure.cast("bigint").alias("measure"), value.cast("double").alias("value"),
        F.when(F.col("event_type") == "error", F.lit(True)).alias("incomplete"))
    label = lambda display, name: F.struct(F.lit(display).alias("display_name"), F.lit(name).alias("name"))
    none = F.lit(None)
    body = F.to_json(F.struct(
        F.array(label("Revenue", "revenue"), label("", "count"), label(None, None)).alias("measures"),
        F.array(point(none, F.col("value")), point(F.lit(1), F.col("user_id")), point(F.lit(2), F.col("value")),
                point(F.lit(7), F.col("value")),
                point(F.lit(0), F.col("value"), none.cast("bigint"))).alias("values")))
    charts = table(spark, sf, "events").select(F.col("event_id").alias("chart"), body.alias("body"))
    rows = S.label_measures(charts, "body", _AT, ["chart"])
    return rows.withColumns({"cohort_date": day("cohort_date"), "pulled_at": stamp("pulled_at")})


def _customers(spark, sf):
    seen = F.col("c_custkey") * 86400000 + 1500
    body = F.struct(F.concat(F.lit("c"), "c_custkey").alias("id"), seen.alias("first_seen_at"),
                    F.when(F.col("c_acctbal") > 0, seen + 1).alias("last_seen_at"),
                    F.col("c_mktsegment").alias("last_seen_platform"))
    return table(spark, sf, "customer").select(F.parse_json(F.to_json(body)).alias("record"))


@query("customer_records", f"""
    SELECT 'c' || c_custkey AS id, {sql_stamp('make_timestamp((c_custkey * 86400000 + 1500) * 1000)')} AS first_seen_at,
           CASE WHEN c_acctbal > 0 THEN {sql_stamp('make_timestamp((c_custkey * 86400000 + 1501) * 1000)')} END
               AS last_seen_at, CAST(NULL AS VARCHAR) AS last_seen_app_version, CAST(NULL AS VARCHAR) AS last_seen_country,
           c_mktsegment AS last_seen_platform FROM customer""")
def customer_records(spark, sf):
    rows = S.customer_record(_customers(spark, sf))
    return rows.withColumns({c: stamp(c) for c in ("first_seen_at", "last_seen_at")})


@query("parent_child", f"""
    SELECT 's' || o_orderkey AS id, 'c' || o_custkey AS customer_id,
           CASE WHEN c_acctbal > 0 THEN {sql_stamp('make_timestamp((c_custkey * 86400000 + 1501) * 1000)')} END
               AS customer_last_seen_at,
           o_orderpriority AS product_id, o_orderstatus AS status, o_orderstatus = 'O' AS gives_access,
           CAST(NULL AS VARCHAR) AS auto_renewal_status, 'web' AS store,
           CAST(NULL AS VARCHAR) AS store_subscription_identifier,
           {sql_stamp('o_orderdate')} AS current_period_starts_at,
           CAST(NULL AS VARCHAR) AS current_period_ends_at,
           CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS total_revenue_gross_usd,
           CAST(NULL AS DOUBLE) AS total_revenue_proceeds_usd
    FROM orders JOIN customer ON o_custkey = c_custkey""")
def parent_child(spark, sf):
    """Children landed per parent: the parent's id fills in, its last-seen time rides along."""
    revenue = F.when(F.col("o_orderstatus") != "P", F.struct(F.col("o_totalprice").alias("gross")))
    page_of = F.concat(F.lit("c"), "o_custkey")
    body = F.struct(
        F.concat(F.lit("s"), "o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "F", page_of).alias("customer_id"),
        F.col("o_orderpriority").alias("product_id"), F.col("o_orderstatus").alias("status"),
        (F.col("o_orderstatus") == "O").alias("gives_access"), F.lit("web").alias("store"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("current_period_starts_at"),
        revenue.alias("total_revenue_in_usd"))
    children = table(spark, sf, "orders").select(page_of.alias("page_of"),
                                                 F.parse_json(F.to_json(body)).alias("record"))
    rows = S.subscription_record(children, S.customer_record(_customers(spark, sf)), "page_of")
    times = ("customer_last_seen_at", "current_period_starts_at", "current_period_ends_at")
    return rows.withColumns({c: stamp(c) for c in times})


_HOURS = """CASE event_id % 8 WHEN 0 THEN LPAD(CAST(event_id % 24 AS STRING), 2, '0') || ':00:00 - 13:59:59'
    WHEN 1 THEN CAST(event_id % 10 AS STRING) || ':00:00 - 1:59:59' WHEN 2 THEN '24:00:00 - 24:59:59'
    WHEN 3 THEN 'unknown' WHEN 4 THEN '' WHEN 5 THEN NULL WHEN 6 THEN ' 07:00:00-07:59:59 ' ELSE '13:00' END"""
_HOUR = r"""CASE WHEN regexp_full_match(raw, '\s*[0-9]{1,2}:[0-9]{2}:[0-9]{2}\s*-\s*[0-9]{1,2}:[0-9]{2}:[0-9]{2}\s*')
    AND CAST(regexp_extract(raw, '([0-9]{1,2}):', 1) AS BIGINT) <= 23
    THEN CAST(regexp_extract(raw, '([0-9]{1,2}):', 1) AS BIGINT) END"""


@query("hour_parse", f"""
    WITH r AS (SELECT event_id, user_id - 5 AS n, {_HOURS} AS raw FROM events)
    SELECT event_id, raw, {_HOUR} AS hour, CASE WHEN n BETWEEN 0 AND 23 THEN n END AS from_int FROM r""")
def hour_parse(spark, sf):
    raw = table(spark, sf, "events").selectExpr("event_id", "user_id - 5 AS n", f"{_HOURS} AS raw")
    return raw.select("event_id", "raw", V.hour_of_range(F.col("raw")).alias("hour"),
                      V.hour_of_int(F.col("n")).alias("from_int"))


@query("keyed_records", f"""
    SELECT {sql_day('o_orderdate')} AS date_start, CAST(o_custkey AS VARCHAR) AS account_id,
           CAST(o_orderkey AS VARCHAR) AS ad_id, o_totalprice AS spend, {_AT_TEXT} AS extracted_at
    FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'""")
def keyed_records(spark, sf):
    rows = table(spark, sf, "orders").select(
        day("o_orderdate").alias("date_start"),
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("act_"), "o_custkey")).alias("account_id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey").cast("string")).otherwise("").alias("ad_id"),
        F.col("o_totalprice").alias("spend"))
    out = S.keyed(rows, ["date_start", "account_id", "ad_id"], _AT)
    return out.withColumn("extracted_at", stamp("extracted_at"))


@query("unkeyable_rows", """
    SELECT COUNT(*) FILTER (o_orderstatus = 'P' OR o_orderpriority = '5-LOW') AS skipped FROM orders""")
def unkeyable_rows(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("account_id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey")).alias("ad_id"))
    return rows.agg(S.unkeyable(["account_id", "ad_id"]).alias("skipped"))


@query("hourly_records", f"""
    WITH r AS (SELECT event_id, user_id, {sql_day('ts')} AS date_start, {_HOURS} AS raw FROM events)
    SELECT date_start, CAST(user_id AS VARCHAR) AS account_id, CAST(event_id AS VARCHAR) AS campaign_id,
           raw AS hour_range, {_HOUR} AS hour, {_AT_TEXT} AS extracted_at FROM r WHERE {_HOUR} IS NOT NULL""")
def hourly_records(spark, sf):
    rows = table(spark, sf, "events").select(
        day("ts").alias("date_start"), F.concat(F.lit("act_"), "user_id").alias("account_id"),
        F.col("event_id").alias("campaign_id"), F.expr(_HOURS).alias("hours"))
    return S.hourly(rows, "hours", _AT).withColumn("extracted_at", stamp("extracted_at"))


@query("epoch_convert", f"""
    SELECT event_id, CASE WHEN event_type <> 'view' THEN {sql_stamp('date_trunc(' + chr(39) + 'millisecond' + chr(39) + ', ts)')}
           END AS at, {sql_day('ts')} AS day FROM events""")
def epoch_convert(spark, sf):
    instant = F.col("ts").cast("timestamp")
    rows = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") != "view", F.unix_millis(instant)).alias("ms"),
        F.unix_seconds(instant).alias("s"))
    return rows.select("event_id", stamp(V.millis_to_timestamp(F.col("ms"))).alias("at"),
                       day(V.seconds_to_date(F.col("s"))).alias("day"))


_NUMBERS = """CASE l_orderkey % 8 WHEN 0 THEN CAST(l_partkey AS STRING) || '.9' WHEN 1 THEN '-' || CAST(l_partkey AS STRING)
    || '.9' WHEN 2 THEN '' WHEN 3 THEN NULL WHEN 4 THEN 'n/a' WHEN 5 THEN ' 12 ' WHEN 6 THEN '1e3'
    ELSE CAST(l_suppkey AS STRING) END"""
_LENIENT = r"""CASE WHEN regexp_full_match(TRIM(raw), '[+-]?[0-9]+(\.[0-9]+)?(e[0-9]+)?') THEN CAST(TRIM(raw) AS DOUBLE) END"""


@query("lenient_numeric", f"""
    WITH r AS (SELECT l_orderkey, l_linenumber, {_NUMBERS} AS raw FROM lineitem)
    SELECT l_orderkey, l_linenumber, CAST(TRUNC({_LENIENT}) AS BIGINT) AS whole, {_LENIENT} AS number FROM r""")
def lenient_numeric(spark, sf):
    raw = table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", f"{_NUMBERS} AS raw")
    return raw.select("l_orderkey", "l_linenumber", V.lenient_int(F.col("raw")).alias("whole"),
                      V.lenient_float(F.col("raw")).alias("number"))


@query("period_metric", """
    SELECT event_id, CASE event_id % 4 WHEN 0 THEN value WHEN 1 THEN value END AS revenue FROM events""")
def period_metric(spark, sf):
    raw = table(spark, sf, "events").selectExpr(
        "event_id", """CASE event_id % 4 WHEN 0 THEN concat('{"actual":', value, '}') WHEN 1 THEN CAST(value AS STRING)
                       WHEN 2 THEN '{"1d":5}' ELSE '' END AS raw""")
    return raw.select("event_id", V.period_value(F.col("raw"), "actual").alias("revenue"))


@query("null_dims", f"""
    SELECT {sql_day('o_orderdate')} AS date, 'north' AS agency,
           CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS app, o_orderpriority AS source,
           '' AS os, '' AS platform, '' AS country_field, CAST(o_custkey AS VARCHAR) AS adn_campaign_id,
           '' AS adn_campaign_name, o_custkey AS adn_impressions, CAST(NULL AS BIGINT) AS custom_clicks,
           CAST(TRUNC(o_totalprice) AS BIGINT) AS custom_installs, o_totalprice AS adn_cost, o_totalprice AS revenue
    FROM orders WHERE o_orderkey % 10 <> 0""")
def null_dims(spark, sf):
    """Report rows, all text: NULL dimensions become '', rows without a date go."""
    raw = table(spark, sf, "orders").selectExpr(
        "CASE WHEN o_orderkey % 20 = 0 THEN NULL WHEN o_orderkey % 10 = 0 THEN '' "
        "ELSE concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T00:00:00') END AS start_date",
        "nullif(o_orderstatus, 'P') AS app", "o_orderpriority AS source", "CAST(NULL AS STRING) AS os",
        "'' AS platform", "CAST(NULL AS STRING) AS country_field", "CAST(o_custkey AS STRING) AS adn_campaign_id",
        "CAST(NULL AS STRING) AS adn_campaign_name", "CAST(o_custkey AS STRING) AS adn_impressions",
        "'' AS custom_clicks", "CAST(o_totalprice AS STRING) AS custom_installs",
        "CAST(o_totalprice AS STRING) AS adn_cost", """concat('{"actual":', o_totalprice, '}') AS revenue""")
    return S.network_record(raw, "north")


_CURSORS = """CASE event_id % 5 WHEN 0 THEN CAST(CAST(ts AS DATE) AS STRING)
    WHEN 1 THEN CAST(CAST(ts AS DATE) AS STRING) || 'T05:06:07Z'
    WHEN 2 THEN CAST(CAST(ts AS DATE) AS STRING) || 'T05:06:07+03:00'
    WHEN 3 THEN CAST(CAST(ts AS DATE) AS STRING) || ' 05:06:07.25' ELSE NULL END"""


@query("cursor_to_utc", f"""
    SELECT event_id, {sql_stamp('''CASE event_id % 5 WHEN 0 THEN d WHEN 1 THEN d + to_seconds(18367)
        WHEN 2 THEN d + to_seconds(7567) WHEN 3 THEN d + to_milliseconds(18367250) END''')} AS utc
    FROM (SELECT event_id, date_trunc('day', ts) AS d FROM events) t""")
def cursor_to_utc(spark, sf):
    raw = table(spark, sf, "events").selectExpr("event_id", f"{_CURSORS} AS raw")
    return raw.select("event_id", stamp(V.cursor_to_utc(F.col("raw"))).alias("utc"))


@query("to_date_lenient", f"""
    SELECT event_id, CASE WHEN event_id % 5 <> 4 THEN {sql_day('ts')} END AS from_text, {sql_day('ts')} AS from_time
    FROM events""")
def to_date_lenient(spark, sf):
    raw = table(spark, sf, "events").selectExpr("event_id", "ts", f"{_CURSORS} AS raw")
    return raw.select("event_id", day(V.first_ten_to_date(F.col("raw"))).alias("from_text"),
                      day(V.first_ten_to_date(F.col("ts"))).alias("from_time"))
