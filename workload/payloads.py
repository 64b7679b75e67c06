"""Records out of landed payloads, and the audit of page walks.

Each payload is built from the columns of one row, so building it groups nothing.
"""

from pyspark.sql import Window, functions as F

from millrace.functions import payloads as P
from millrace.operators import page_audit as A

from .base import query, table


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


def _node(key, price):
    return F.struct(key.alias("id"), price.alias("price"), F.col("o_orderstatus").alias("status"))


def _shown(records):
    get = lambda step, type: P.get(F.col("record"), [step], type)
    return records.select(get("id", "bigint").alias("id"), get("price", "double").alias("price"),
                          get("status", "string").alias("status"))


@query("record_path", """
    SELECT o_orderkey AS id, o_totalprice AS price, o_orderstatus AS status FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT -o_orderkey, CAST(o_custkey AS DOUBLE), o_orderstatus FROM orders WHERE o_orderstatus <> 'P'""")
def record_path(spark, sf):
    """A plain list of records; a null list (status P) is an empty page."""
    items = F.array(_node(F.col("o_orderkey"), F.col("o_totalprice")),
                    _node(-F.col("o_orderkey"), F.col("o_custkey").cast("double")))
    data = F.struct(F.when(F.col("o_orderstatus") != "P", items).alias("items"))
    body = F.to_json(F.struct(data.alias("data")), {"ignoreNullFields": "false"})
    return _shown(P.extract_records(_orders(spark, sf).select(body.alias("body")), "body", ["data", "items"]))


@query("record_path_edges", """
    SELECT o_orderkey AS id, o_totalprice AS price, o_orderstatus AS status FROM orders WHERE o_orderstatus <> 'F'""")
def record_path_edges(spark, sf):
    """One wildcard unwraps every edge; a null node (status F) is skipped."""
    node = F.when(F.col("o_orderstatus") != "F", _node(F.col("o_orderkey"), F.col("o_totalprice")))
    edges = F.array(F.struct(node.alias("node")))
    body = F.to_json(F.struct(F.struct(edges.alias("edges")).alias("data")), {"ignoreNullFields": "false"})
    return _shown(P.extract_records(_orders(spark, sf).select(body.alias("body")), "body",
                                    ["data", "edges", "*", "node"]))


@query("record_path_lenient", """
    SELECT o_orderkey AS id, o_totalprice AS price, o_orderstatus AS status,
           (SELECT COUNT(*) FROM orders WHERE o_orderstatus = 'P') AS unreadable FROM orders WHERE o_orderstatus = 'O'""")
def record_path_lenient(spark, sf):
    """Two wildcards; a missing key, a null edge and a scalar node give no rows.  Bodies that are no
    JSON are set aside and counted."""
    body = F.expr("""CASE o_orderstatus
        WHEN 'O' THEN concat('{"groups":[{"edges":[{"node":{"id":', o_orderkey, ',"price":', o_totalprice,
                             ',"status":"O"}},null,{"node":7},{"other":1}]},{"none":[]}]}')
        WHEN 'F' THEN '{"groups":[{"edges":null},null,5]}'
        ELSE '{"groups":[' END""")
    bodies = _orders(spark, sf).select(body.alias("body"))
    broken = P.unreadable_bodies(bodies, "body")
    readable = bodies.filter(F.try_parse_json("body").isNotNull())
    rows = _shown(P.extract_records_lenient(readable, "body", ["groups", "*", "edges", "*", "node"]))
    return rows.withColumn("unreadable", broken.agg(F.count(F.lit(1))).scalar())


@query("envelope_data", """
    SELECT o_orderkey AS id FROM orders WHERE o_orderstatus <> 'P'""")
def envelope_data(spark, sf):
    """A bare list, a list under ``data``, or a null ``data``."""
    body = F.expr("""CASE o_orderstatus WHEN 'F' THEN concat('[{"id":', o_orderkey, '}]')
        WHEN 'O' THEN concat('{"success":true,"data":[{"id":', o_orderkey, '}]}') ELSE '{"data":null}' END""")
    rows = P.unwrap_data(_orders(spark, sf).select(body.alias("body")), "body")
    return rows.select(P.get(F.col("record"), ["id"], "bigint").alias("id"))


@query("envelope_results", """
    SELECT o_orderkey AS id, o_orderstatus AS status FROM orders""")
def envelope_results(spark, sf):
    """``results`` at the top, or one level down under ``value``."""
    body = F.expr("""CASE o_orderstatus WHEN 'F' THEN concat('{"results":[{"id":', o_orderkey, '}]}')
        ELSE concat('{"results":null,"value":{"results":[{"id":', o_orderkey, '}]}}') END""")
    rows = P.unwrap_results(_orders(spark, sf).select("o_orderstatus", body.alias("body")), "body", ["o_orderstatus"])
    return rows.select(P.get(F.col("record"), ["id"], "bigint").alias("id"), F.col("o_orderstatus").alias("status"))


@query("envelope_chunks", """
    SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'""")
def envelope_chunks(spark, sf):
    """A list of chunks, some without results."""
    body = F.expr("""CASE o_orderstatus WHEN 'O' THEN concat('[{"results":[{"id":', o_orderkey,
        '}]},{"fieldMask":"x"},{"results":[{"id":', o_custkey, '}]}]') WHEN 'F' THEN '[]'
        ELSE '[{"results":null}]' END""")
    rows = P.unwrap_chunks(_orders(spark, sf).select(body.alias("body")), "body")
    return rows.select(P.get(F.col("record"), ["id"], "bigint").alias("id"))


@query("dotted_pointer", """
    SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'c' || user_id WHEN 1 THEN CAST(user_id AS VARCHAR) END AS next
    FROM events""")
def dotted_pointer(spark, sf):
    body = F.expr("""CASE event_id % 5 WHEN 0 THEN concat('{"meta":{"next_cursor":"c', user_id, '"}}')
        WHEN 1 THEN concat('{"meta":{"next_cursor":', user_id, '}}') WHEN 2 THEN '{"meta":{"next_cursor":""}}'
        WHEN 3 THEN '{"meta":null}' ELSE '{"data":[]}' END""")
    pages = table(spark, sf, "events").select("event_id", body.alias("body"))
    return pages.select("event_id", P.dotted(F.col("body"), "meta.next_cursor").alias("next"))


# --------------------------------------------------------------------------
# page walks: ten pages per endpoint, some lost, some that end too early

def _pages(spark, sf, body, **more):
    pages = table(spark, sf, "events").selectExpr(
        "event_id DIV 10 AS endpoint", "event_id % 10 + 1 AS page", "event_type")
    pages = pages.filter("NOT (endpoint % 7 = 3 AND page = 5)")
    return pages.withColumns({"body": F.expr(body), **{k: F.expr(v) for k, v in more.items()}})


def _report_sql(stop: str, cap: str = "") -> str:
    """The verdict per endpoint; ``stop`` is the rule that fires on a page, or NULL."""
    return f"""
    WITH p AS (SELECT event_id // 10 AS endpoint, event_id % 10 + 1 AS page, event_type FROM events
               WHERE NOT (event_id // 10 % 7 = 3 AND event_id % 10 = 4)),
         r AS (SELECT *, {stop} AS stop FROM p),
         w AS (SELECT endpoint, COUNT(*) AS pages, MIN(page) AS first_page, MAX(page) AS last_page,
                      MIN(page) FILTER (stop IS NOT NULL) AS end_page,
                      MIN_BY(stop, page) FILTER (stop IS NOT NULL) AS end_rule FROM r GROUP BY endpoint)
    SELECT endpoint, pages, last_page, end_page, end_rule,
           CASE WHEN first_page <> 1 OR pages <> last_page THEN 'gap' WHEN end_page = last_page THEN 'complete'
                WHEN end_page < last_page THEN 'overrun' {cap} ELSE 'truncated' END AS verdict FROM w"""


@query("page_audit_cursor", _report_sql("""CASE WHEN page = 10 AND endpoint % 5 <> 0 THEN 'no_cursor'
    WHEN endpoint % 11 = 2 AND page = 7 THEN 'stuck_cursor' END"""))
def page_audit_cursor(spark, sf):
    body = """CASE WHEN page = 10 AND endpoint % 5 <> 0 THEN '{"meta":{}}'
        WHEN endpoint % 11 = 2 AND page = 7 THEN concat('{"meta":{"next":"', endpoint, '-6"}}')
        ELSE concat('{"meta":{"next":"', endpoint, '-', page, '"}}') END"""
    return A.walk_report(A.cursor_rule(_pages(spark, sf, body), "meta.next"))


@query("page_audit_short", _report_sql("""CASE WHEN endpoint % 13 = 5 AND page = 8 THEN 'unreadable'
    WHEN page = 10 AND endpoint % 4 <> 0 THEN 'short_page' END""", "WHEN last_page >= 10 THEN 'capped'"))
def page_audit_short(spark, sf):
    body = """CASE WHEN endpoint % 13 = 5 AND page = 8 THEN '{"error":"x"}'
        WHEN page = 10 AND endpoint % 4 <> 0 THEN '{"items":[{"id":1}]}'
        ELSE '{"items":[{"id":1},{"id":2},{"id":3}]}' END"""
    return A.walk_report(A.short_page_rule(_pages(spark, sf, body), ["items"], 3), page_cap=10)


@query("page_audit_link", _report_sql("""CASE WHEN endpoint % 9 = 1 AND page = 6 THEN 'off_origin'
    WHEN page = 10 THEN 'no_link' END"""))
def page_audit_link(spark, sf):
    link = """CASE WHEN endpoint % 9 = 1 AND page = 6 THEN '<https://other.example/x?page=7>; rel="next"'
        WHEN page = 10 THEN '<https://api.example/x?page=1>; rel="first"'
        ELSE concat('<https://api.example/x?page=1>; rel="first", <https://api.example/x?page=', page + 1,
                    '>; rel="next"') END"""
    return A.walk_report(A.link_rule(_pages(spark, sf, "'{}'", link=link), "link", "https://api.example/"))


@query("page_audit_has_more", _report_sql("""CASE WHEN endpoint % 8 = 0 AND page = 9 THEN 'no_data'
    WHEN endpoint % 8 = 1 AND page = 10 THEN 'empty_page' WHEN endpoint % 8 = 2 AND page = 10 THEN 'no_id'
    WHEN page = 10 THEN 'no_more' END"""))
def page_audit_has_more(spark, sf):
    body = """CASE WHEN endpoint % 8 = 0 AND page = 9 THEN '{"has_more":true}'
        WHEN endpoint % 8 = 1 AND page = 10 THEN '{"data":[],"has_more":true}'
        WHEN endpoint % 8 = 2 AND page = 10 THEN '{"data":[{"x":1}],"has_more":true}'
        WHEN page = 10 THEN '{"data":[{"id":1}],"has_more":false}' ELSE '{"data":[{"id":1}],"has_more":true}' END"""
    return A.walk_report(A.has_more_rule(_pages(spark, sf, body)))


@query("page_audit_info", _report_sql("""CASE WHEN event_type = 'error' THEN 'no_cursor'
    WHEN page = 10 THEN 'last_page' END"""))
def page_audit_info(spark, sf):
    body = """CASE WHEN event_type = 'error' THEN '{"data":{"pageInfo":{"hasNextPage":true,"endCursor":""}}}'
        WHEN page = 10 THEN '{"data":{"pageInfo":{"hasNextPage":false}}}'
        ELSE '{"data":{"pageInfo":{"hasNextPage":true,"endCursor":"abc"}}}' END"""
    return A.walk_report(A.page_info_rule(_pages(spark, sf, body), ["data", "pageInfo"]))


@query("page_audit_chain", """
    WITH n AS (SELECT o_custkey % 50 AS endpoint, COUNT(*) AS n FROM orders GROUP BY 1),
    c AS (SELECT *, CASE endpoint % 5 WHEN 1 THEN 6 WHEN 2 THEN 4 WHEN 3 THEN 7 ELSE n END AS walked FROM n)
    SELECT endpoint, n AS pages, CAST(walked AS BIGINT) AS in_order, CAST(walked AS BIGINT) AS length,
           CAST(endpoint % 5 = 2 AS BIGINT) AS breaks, CAST(endpoint % 5 = 1 AS BIGINT) AS forks,
           CASE WHEN endpoint % 5 IN (1, 2) THEN n - walked ELSE 0 END AS orphans,
           CASE WHEN endpoint % 5 = 3 THEN n - walked ELSE 0 END AS cyclic FROM c""")
def page_audit_chain(spark, sf):
    """Pages that only name the next one, with offers that lead back, to nowhere, and in a circle."""
    numbered = _orders(spark, sf).select((F.col("o_custkey") % 50).alias("endpoint"), F.row_number().over(
        Window.partitionBy(F.col("o_custkey") % 50).orderBy("o_orderkey")).alias("p"))
    last = F.max("p").over(Window.partitionBy("endpoint"))
    kind = F.col("endpoint") % 5
    cursor = F.when(F.col("p") > 1, F.concat(F.lit("c"), F.col("p") - 1))
    offered = (F.when((kind == 1) & (F.col("p") == 6), "c2").when((kind == 2) & (F.col("p") == 4), "lost")
               .when((kind == 3) & (F.col("p") == 7), F.lit(None)).when((kind == 3) & (F.col("p") == F.col("last")), "c7")
               .when(F.col("p") < F.col("last"), F.concat(F.lit("c"), "p")))
    return A.chain_report(numbered.withColumn("last", last).select("endpoint", cursor.alias("cursor"), offered.alias("next")))
