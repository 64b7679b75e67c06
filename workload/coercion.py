"""Normalize: the eight coercions over messy cells, drift policies, schema operators."""

from pyspark.sql import functions as F, types as T

from millrace.functions import coerce as C
from millrace.operators import normalize as N, schema as H
from millrace.spec import table_schema

from .base import day, query, stamp, table

# The messy cells are plain SQL that both engines evaluate.  Blanks around a cell are
# spaces, which TRIM removes in both.
_INTEGER = """CASE l_orderkey % 12
    WHEN 0 THEN CAST(l_partkey AS STRING)
    WHEN 1 THEN '-' || CAST(l_partkey AS STRING)
    WHEN 2 THEN '  +' || CAST(l_suppkey AS STRING) || ' '
    WHEN 3 THEN CAST(l_partkey AS STRING) || '.0'
    WHEN 4 THEN CAST(l_partkey AS STRING) || '.5'
    WHEN 5 THEN 'n/a'
    WHEN 6 THEN ''
    WHEN 7 THEN NULL
    WHEN 8 THEN CAST(l_linenumber AS STRING) || 'e2'
    WHEN 9 THEN '1_' || CAST(100 + l_linenumber AS STRING)
    WHEN 10 THEN '9223372036854775' || CAST(800 + l_linenumber AS STRING)
    ELSE CAST(l_partkey AS STRING) || 'd' END"""

_FLOAT = """CASE l_orderkey % 10
    WHEN 0 THEN CAST(l_partkey AS STRING) || '.25'
    WHEN 1 THEN ' -' || CAST(l_partkey AS STRING) || '.5 '
    WHEN 2 THEN CAST(l_linenumber AS STRING) || '.5e3'
    WHEN 3 THEN '.' || CAST(l_partkey AS STRING)
    WHEN 4 THEN CAST(l_partkey AS STRING) || 'f'
    WHEN 5 THEN ''
    WHEN 6 THEN NULL
    WHEN 7 THEN '1,5'
    WHEN 8 THEN '1_000.' || CAST(l_linenumber AS STRING)
    ELSE CAST(l_suppkey AS STRING) END"""

_BOOLEAN = """CASE event_id % 12
    WHEN 0 THEN 'true' WHEN 1 THEN 'FALSE' WHEN 2 THEN ' Yes ' WHEN 3 THEN 'no' WHEN 4 THEN '1'
    WHEN 5 THEN '0' WHEN 6 THEN 't' WHEN 7 THEN 'y' WHEN 8 THEN '' WHEN 9 THEN NULL WHEN 10 THEN '1.0'
    ELSE event_type END"""

_DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
_TIMESTAMP = f"""CASE o_orderkey % 14
    WHEN 0 THEN {_DAY} || 'T10:11:12Z'
    WHEN 1 THEN {_DAY} || ' 10:11:12.5'
    WHEN 2 THEN {_DAY} || 'T10:11:12+02:00'
    WHEN 3 THEN {_DAY}
    WHEN 4 THEN CAST(900000000 + o_orderkey AS STRING)
    WHEN 5 THEN CAST(900000000 + o_orderkey AS STRING) || '.25'
    WHEN 6 THEN '2024'
    WHEN 7 THEN '12:30'
    WHEN 8 THEN 'yesterday'
    WHEN 9 THEN ''
    WHEN 10 THEN NULL
    WHEN 11 THEN {_DAY} || 'T10:11'
    WHEN 12 THEN ' ' || {_DAY} || 'T23:00:00-05:30 '
    ELSE '2024-02-30T00:00:00' END"""

_DATE = f"""CASE o_orderkey % 9
    WHEN 0 THEN {_DAY} WHEN 1 THEN ' ' || {_DAY} || ' ' WHEN 2 THEN REPLACE({_DAY}, '-', '')
    WHEN 3 THEN {_DAY} || ' 10:00' WHEN 4 THEN '1998-2-3' WHEN 5 THEN '1998-02-30' WHEN 6 THEN ''
    WHEN 7 THEN NULL ELSE 'soon' END"""

_BYTES = """CASE event_id % 8
    WHEN 0 THEN event_type WHEN 1 THEN 'YWJjZA==' WHEN 2 THEN event_type || '!' WHEN 3 THEN ''
    WHEN 4 THEN ' ' || event_type || ' ' WHEN 5 THEN 'A===' WHEN 6 THEN NULL ELSE 'Zm9vYg' || '==' END"""

_NUMBER = "[0-9]+(_[0-9]+)*"
_RE_INT = f"[+-]?{_NUMBER}"
_RE_FLOAT = rf"[+-]?({_NUMBER}\.?({_NUMBER})?|\.{_NUMBER})([eE][+-]?{_NUMBER})?"
_RE_BASE64 = "([A-Za-z0-9+/]{4})*([A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?"
_PLAIN = "REPLACE(TRIM(raw), '_', '')"
_WHOLE = f"TRY_CAST({_PLAIN} AS DOUBLE)"

_AS_INTEGER = f"""CASE WHEN raw = '' THEN NULL
    WHEN regexp_full_match(TRIM(raw), '{_RE_INT}') THEN TRY_CAST(LTRIM({_PLAIN}, '+') AS BIGINT)
    WHEN regexp_full_match(TRIM(raw), '{_RE_FLOAT}') AND {_WHOLE} = FLOOR({_WHOLE})
         THEN CAST({_WHOLE} AS BIGINT) END"""
_AS_FLOAT = f"CASE WHEN regexp_full_match(TRIM(raw), '{_RE_FLOAT}') THEN {_WHOLE} END"
_AS_BOOLEAN = """CASE WHEN LOWER(TRIM(raw)) IN ('true', '1', 'yes') THEN TRUE
    WHEN LOWER(TRIM(raw)) IN ('false', '0', 'no') THEN FALSE END"""
_RE_DAY = "[0-9]{4}-[0-9]{2}-[0-9]{2}"
_AS_TIMESTAMP = rf"""CASE
    WHEN regexp_full_match(TRIM(raw), '-?[0-9]+(\.[0-9]+)?')
         THEN make_timestamp(CAST(CAST(TRIM(raw) AS DOUBLE) * 1000000 AS BIGINT))
    WHEN regexp_full_match(TRIM(raw), '{_RE_DAY}([T ][0-9:.]+)?Z?')
         THEN TRY_CAST(REPLACE(TRIM(raw), 'Z', '') AS TIMESTAMP)
    WHEN regexp_full_match(TRIM(raw), '{_RE_DAY}T[0-9:.]+[+-][0-9]{{2}}:[0-9]{{2}}')
         THEN TRY_CAST(LEFT(TRIM(raw), 19) AS TIMESTAMP)
              - to_minutes(CAST(RIGHT(TRIM(raw), 6)[1] || '1' AS BIGINT)
                           * (60 * CAST(RIGHT(TRIM(raw), 5)[1:2] AS BIGINT) + CAST(RIGHT(TRIM(raw), 2) AS BIGINT)))
    END"""
_AS_DATE = f"""CASE WHEN regexp_full_match(TRIM(raw), '{_RE_DAY}') THEN TRY_CAST(TRIM(raw) AS DATE)
    WHEN regexp_full_match(TRIM(raw), '[0-9]{{8}}')
         THEN TRY_CAST(TRIM(raw)[1:4] || '-' || TRIM(raw)[5:6] || '-' || TRIM(raw)[7:8] AS DATE) END"""
_AS_BYTES = f"""CASE WHEN raw = '' THEN NULL
    WHEN TRIM(raw) <> '' AND regexp_full_match(TRIM(raw), '{_RE_BASE64}') THEN hex(from_base64(TRIM(raw)))
    ELSE hex(encode(TRIM(raw))) END"""


def _twin(key: str, source: str, raw: str, value: str, shown: str = "v") -> str:
    return f"""
    WITH r AS (SELECT {key}, {raw} AS raw FROM {source}), c AS (SELECT *, {value} AS v FROM r)
    SELECT {key}, raw, {shown} AS value, (raw IS NOT NULL AND raw <> '' AND v IS NULL) AS drift FROM c"""


def _coerced(spark, sf, source, keys, raw, target, show=lambda v: v):
    cells = table(spark, sf, source).selectExpr(*keys, f"{raw} AS raw")
    text = T.StringType()
    cells, parts = C.with_parts(cells, {"raw": target})
    valued = cells.select("*", C.coerced(F.col("raw"), text, target, parts["raw"]).alias("v"))
    return valued.select(*keys, "raw", show(F.col("v")).alias("value"),
                         C.is_drift(F.col("raw"), text, F.col("v")).alias("drift"))


_LINE = ["l_orderkey", "l_linenumber"]


@query("coerce_integer", _twin("l_orderkey, l_linenumber", "lineitem", _INTEGER, _AS_INTEGER))
def coerce_integer(spark, sf):
    return _coerced(spark, sf, "lineitem", _LINE, _INTEGER, "INTEGER")


@query("coerce_float", _twin("l_orderkey, l_linenumber", "lineitem", _FLOAT, _AS_FLOAT))
def coerce_float(spark, sf):
    return _coerced(spark, sf, "lineitem", _LINE, _FLOAT, "FLOAT")


@query("coerce_boolean", _twin("event_id", "events", _BOOLEAN, _AS_BOOLEAN))
def coerce_boolean(spark, sf):
    return _coerced(spark, sf, "events", ["event_id"], _BOOLEAN, "BOOLEAN")


@query("coerce_timestamp", _twin("o_orderkey", "orders", _TIMESTAMP, _AS_TIMESTAMP,
                                 "strftime(v, '%Y-%m-%d %H:%M:%S.%f')"))
def coerce_timestamp(spark, sf):
    return _coerced(spark, sf, "orders", ["o_orderkey"], _TIMESTAMP, "TIMESTAMP", stamp)


@query("coerce_date", _twin("o_orderkey", "orders", _DATE, _AS_DATE, "CAST(v AS VARCHAR)"))
def coerce_date(spark, sf):
    return _coerced(spark, sf, "orders", ["o_orderkey"], _DATE, "DATE", day)


@query("coerce_bytes", _twin("event_id", "events", _BYTES, _AS_BYTES))
def coerce_bytes(spark, sf):
    return _coerced(spark, sf, "events", ["event_id"], _BYTES, "BYTES", F.hex)




@query("coerce_string", f"""
    SELECT l_orderkey, l_linenumber, l_extendedprice,
           CAST(l_extendedprice AS VARCHAR) AS from_float, CAST(l_partkey AS VARCHAR) AS from_integer,
           CASE WHEN l_returnflag = 'R' THEN 'True' ELSE 'False' END AS from_boolean,
           CAST(l_extendedprice * 1024.0::DOUBLE AS VARCHAR) AS from_large,
           CAST(CAST(l_shipdate AS DATE) AS VARCHAR) || ' 00:00:00' AS from_timestamp
    FROM lineitem""")
def coerce_string(spark, sf):
    lines = table(spark, sf, "lineitem")
    text = lambda c, t: C.to_text(c, t)
    large = F.col("l_extendedprice") * F.lit(1024.0)
    return lines.select(
        *_LINE, "l_extendedprice",
        text(F.col("l_extendedprice"), T.DoubleType()).alias("from_float"),
        text(F.col("l_partkey"), T.LongType()).alias("from_integer"),
        text(F.col("l_returnflag") == "R", T.BooleanType()).alias("from_boolean"),
        text(large, T.DoubleType()).alias("from_large"),
        text(F.col("l_shipdate"), T.TimestampNTZType()).alias("from_timestamp"))


@query("coerce_json", """
    SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE props END AS from_text,
           '{"event_id":' || event_id || ',"user_id":' || user_id || '}' AS from_struct,
           '[' || event_id || ',' || user_id || ']' AS from_array,
           CASE WHEN event_type = 'click' THEN 'true' ELSE 'false' END AS from_boolean
    FROM events""")
def coerce_json(spark, sf):
    events = table(spark, sf, "events").selectExpr(
        "event_id", "CASE WHEN event_id % 5 = 0 THEN '' ELSE props END AS raw",
        "struct(event_id, user_id) AS s", "array(event_id, user_id) AS a", "event_type = 'click' AS b")
    kind = {f.name: f.dataType for f in events.schema.fields}
    as_json = lambda c, alias: C.coerced(F.col(c), kind[c], "JSON").alias(alias)
    return events.select("event_id", as_json("raw", "from_text"), as_json("s", "from_struct"),
                         as_json("a", "from_array"), as_json("b", "from_boolean"))


@query("empty_to_null", """
    SELECT COUNT(*) AS cells, COUNT(*) FILTER (event_id % 3 = 0) AS text_kept,
           COUNT(*) FILTER (event_id % 3 <> 0) AS others_left
    FROM events""")
def empty_to_null(spark, sf):
    raw = table(spark, sf, "events").selectExpr("CASE WHEN event_id % 3 = 0 THEN '' ELSE '1' END AS raw")
    as_type = lambda t: C.coerced(F.col("raw"), T.StringType(), t)
    others = F.lit(True)
    for t in ("INTEGER", "FLOAT", "BOOLEAN", "TIMESTAMP", "JSON", "BYTES"):
        others = others & as_type(t).isNotNull()
    return raw.agg(F.count(F.lit(1)).alias("cells"), F.count_if(as_type("STRING") == "").alias("text_kept"),
                   F.count_if(others).alias("others_left"))


# --------------------------------------------------------------------------
# whole rows

_RAW_LINE = f"""l_orderkey, l_linenumber, {_INTEGER} AS part, {_FLOAT} AS price,
    CASE l_partkey % 4 WHEN 0 THEN 'yes' WHEN 1 THEN 'NO' WHEN 2 THEN 'maybe' ELSE '' END AS returned,
    CASE WHEN l_suppkey % 10 = 0 THEN 'bad' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS shipped,
    l_linestatus AS note"""
_LINE_SCHEMA = table_schema(("l_orderkey", "INTEGER", "REQUIRED"), ("l_linenumber", "INTEGER"),
                            ("part", "INTEGER"), ("price", "FLOAT"), ("returned", "BOOLEAN"),
                            ("shipped", "DATE"), ("gone", "STRING"))


def _on(expr: str, column: str) -> str:
    return expr.replace("raw", column)


@query("normalize_warn", f"""
    WITH r AS (SELECT {_RAW_LINE} FROM lineitem)
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, {_on(_AS_INTEGER, 'part')} AS part,
           {_on(_AS_FLOAT, 'price')} AS price, {_on(_AS_BOOLEAN, 'returned')} AS returned,
           CAST(({_on(_AS_DATE, 'shipped')}) AS VARCHAR) AS shipped, CAST(NULL AS VARCHAR) AS gone, note
    FROM r""")
def normalize_warn(spark, sf):
    raw = table(spark, sf, "lineitem").selectExpr(*_split(_RAW_LINE))
    return N.normalize(raw, _LINE_SCHEMA).withColumn("shipped", day("shipped"))


def _split(select_list: str) -> list[str]:
    """Split a SELECT list at its top-level commas."""
    parts, depth, start = [], 0, 0
    for i, ch in enumerate(select_list):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0 and select_list[:i].count("'") % 2 == 0:
            parts.append(select_list[start:i])
            start = i + 1
    return [*parts, select_list[start:]]


@query("drift_report", f"""
    WITH r AS (SELECT {_RAW_LINE} FROM lineitem),
    d AS (SELECT COUNT(*) AS n,
        COUNT(*) FILTER (part <> '' AND ({_on(_AS_INTEGER, 'part')}) IS NULL) AS part,
        COUNT(*) FILTER (price <> '' AND ({_on(_AS_FLOAT, 'price')}) IS NULL) AS price,
        COUNT(*) FILTER (returned <> '' AND ({_on(_AS_BOOLEAN, 'returned')}) IS NULL) AS returned,
        COUNT(*) FILTER (shipped <> '' AND ({_on(_AS_DATE, 'shipped')}) IS NULL) AS shipped FROM r)
    SELECT 'part' AS column_name, 'type_mismatch' AS kind, part AS cells FROM d
    UNION ALL SELECT 'price', 'type_mismatch', price FROM d
    UNION ALL SELECT 'returned', 'type_mismatch', returned FROM d
    UNION ALL SELECT 'shipped', 'type_mismatch', shipped FROM d
    UNION ALL SELECT 'gone', 'missing_column', n FROM d
    UNION ALL SELECT 'note', 'new_column', n FROM d""")
def drift_report(spark, sf):
    raw = table(spark, sf, "lineitem").selectExpr(*_split(_RAW_LINE))
    return N.drift_report(raw, _LINE_SCHEMA)


@query("drift_samples", f"""
    WITH r AS (SELECT {_RAW_LINE} FROM lineitem),
    m AS (SELECT 'part' AS column_name, part AS value FROM r WHERE part <> '' AND ({_on(_AS_INTEGER, 'part')}) IS NULL
        UNION ALL SELECT 'price', price FROM r WHERE price <> '' AND ({_on(_AS_FLOAT, 'price')}) IS NULL
        UNION ALL SELECT 'returned', returned FROM r WHERE returned <> '' AND ({_on(_AS_BOOLEAN, 'returned')}) IS NULL
        UNION ALL SELECT 'shipped', shipped FROM r WHERE shipped <> '' AND ({_on(_AS_DATE, 'shipped')}) IS NULL),
    c AS (SELECT column_name, value, COUNT(*) AS cells FROM m GROUP BY ALL)
    SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY column_name ORDER BY md5(value), value) <= 3""")
def drift_samples(spark, sf):
    raw = table(spark, sf, "lineitem").selectExpr(*_split(_RAW_LINE))
    return N.drift_samples(raw, _LINE_SCHEMA)


_RAGGED = """CASE event_id % 5
    WHEN 0 THEN '{"id":' || event_id || ',"v":"' || user_id || '"}'
    WHEN 1 THEN '{"id":' || event_id || ',"v":' || user_id || '.0}'
    WHEN 2 THEN '{"id":' || event_id || ',"v":true}'
    WHEN 3 THEN '{"id":' || event_id || ',"v":[1,2],"w":"x"}'
    ELSE '{"id":' || event_id || ',"v":null}' END"""


@query("normalize_ragged", """
    SELECT event_id AS id, CASE WHEN event_id % 5 IN (0, 1) THEN user_id END AS v,
           CASE WHEN event_id % 5 = 3 THEN 'x' END AS w, event_id % 5 IN (2, 3) AS v_drift
    FROM events""")
def normalize_ragged(spark, sf):
    """Cells of one column that arrive as text, number, boolean, list or null."""
    bodies = table(spark, sf, "events").selectExpr(f"{_RAGGED} AS body")
    record = F.parse_json("body")
    cell = lambda k: F.try_variant_get(record, f"$.{k}", "variant").alias(k)
    schema = table_schema(("id", "INTEGER"), ("v", "INTEGER"), ("w", "STRING"))
    out = N.normalize(bodies.select(cell("id"), cell("v"), cell("w")), schema, flags=True)
    return N.drop_flags(out.withColumn("v_drift", F.col("__drift_v")))


# --------------------------------------------------------------------------
# schema operators


@query("infer_schema_types", """
    SELECT 'id' AS column_name, 'INTEGER' AS type FROM events HAVING COUNT(*) > 0
    UNION ALL SELECT 'v', 'STRING' FROM events HAVING COUNT(*) > 0
    UNION ALL SELECT 'w', 'STRING' FROM events HAVING COUNT(*) > 0""")
def infer_schema_types(spark, sf):
    bodies = table(spark, sf, "events").selectExpr(f"{_RAGGED} AS body")
    return H.infer_json_columns(bodies, "body")


@query("infer_schema_props", """
    SELECT 'k' AS column_name, CASE json_type(ANY_VALUE(props), '$.k')
           WHEN 'UBIGINT' THEN 'INTEGER' WHEN 'BIGINT' THEN 'INTEGER' ELSE 'STRING' END AS type FROM events""")
def infer_schema_props(spark, sf):
    return H.infer_json_columns(table(spark, sf, "events"), "props")


@query("infer_schema_first", """
    SELECT 'id' AS column_name, 'INTEGER' AS type FROM events HAVING COUNT(*) > 0
    UNION ALL SELECT 'v', FIRST(CASE event_id % 5 WHEN 1 THEN 'FLOAT' WHEN 2 THEN 'BOOLEAN' WHEN 3 THEN 'JSON' END
                               ORDER BY event_id) FILTER (event_id % 5 IN (1, 2, 3)) FROM events
    UNION ALL SELECT 'w', 'STRING' FROM events HAVING COUNT(*) > 0""")
def infer_schema_first(spark, sf):
    bodies = table(spark, sf, "events").selectExpr("event_id", f"{_RAGGED} AS body")
    return H.infer_json_columns(bodies, "body", ["event_id"], rule="first")


@query("evolve_add_column", """
    SELECT o_orderkey, o_totalprice, NULL AS o_orderpriority, CAST(NULL AS VARCHAR) AS note FROM orders
    WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, NULL, o_orderpriority, 'new' FROM orders WHERE o_orderstatus <> 'F'""")
def evolve_add_column(spark, sf):
    orders = table(spark, sf, "orders")
    old = orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")
    new = orders.filter("o_orderstatus <> 'F'").select("o_orderkey", "o_orderpriority", F.lit("new").alias("note"))
    grown = H.evolved(old.schema, new.schema)
    return H.aligned(old, grown).unionByName(H.aligned(new, grown))


@query("ragged_union", """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status, NULL AS name FROM orders
    UNION ALL SELECT c_name, NULL, c_mktsegment FROM customer""")
def ragged_union(spark, sf):
    left = table(spark, sf, "orders").selectExpr("o_orderkey AS id", "o_orderstatus AS status")
    right = table(spark, sf, "customer").selectExpr("c_name AS id", "c_mktsegment AS name")
    return H.ragged_union(left, right)


@query("required_nulls", """
    SELECT 'o_orderkey' AS column_name, COUNT(*) FILTER (o_orderkey IS NULL) AS nulls FROM orders
    UNION ALL SELECT 'status', COUNT(*) FILTER (o_orderstatus = 'P') FROM orders""")
def required_nulls(spark, sf):
    rows = table(spark, sf, "orders").selectExpr("o_orderkey", "nullif(o_orderstatus, 'P') AS status", "o_custkey")
    schema = table_schema(("o_orderkey", "INTEGER", "REQUIRED"), ("status", "STRING", "REQUIRED"),
                          ("o_custkey", "INTEGER"))
    return H.required_nulls(rows, schema)
