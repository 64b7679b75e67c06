"""State rows, run history, event logs and redaction."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from millrace.load import EventLog
from millrace.operators import reports as R, state as S
from millrace.sinks.files import scratch

from .base import query, sql_stamp, stamp, table

_AT = datetime(2024, 6, 1, 12, 0, tzinfo=timezone.utc)


def _state(spark, sf, until, run):
    """One state row per user and event type, as if each were a stream."""
    events = table(spark, sf, "events").filter(f"ts < TIMESTAMP_NTZ '{until}'")
    rows = events.groupBy(F.col("event_type").alias("connector"),
                          F.concat(F.lit("user_"), "user_id").alias("stream")).agg(
        F.max("event_id").cast("string").alias("cursor_value"), F.count(F.lit(1)).alias("rows"))
    return rows.withColumns({"cursor_type": F.lit("int"), "state_blob": F.lit("{}"), "last_run_id": F.lit(run),
                             "updated_at": F.lit(_AT).cast("timestamp")})


_STATE = """SELECT event_type AS connector, 'user_' || user_id AS stream, CAST(MAX(event_id) AS VARCHAR) AS cursor_value,
                   COUNT(*) AS rows FROM events WHERE ts < TIMESTAMP '{}' GROUP BY ALL"""


@query("state_upsert", f"""
    WITH a AS ({_STATE.format('2024-01-04')}), b AS ({_STATE.format('2024-02-01')})
    SELECT connector, stream, COALESCE(b.cursor_value, a.cursor_value) AS cursor_value,
           CASE WHEN b.rows IS NULL THEN 'r1' ELSE 'r2' END AS last_run_id,
           COALESCE(a.rows, 0) + COALESCE(b.rows, 0) AS rows_total
    FROM a FULL JOIN b USING (connector, stream)""")
def state_upsert(spark, sf):
    """A second run's commits over the first one's state; row totals add up."""
    first = _state(spark, sf, "2024-01-04", "r1").withColumnRenamed("rows", "rows_total")
    out = S.commit_state(first, _state(spark, sf, "2024-02-01", "r2"))
    return out.select("connector", "stream", "cursor_value", "last_run_id", "rows_total")


@query("state_reset", f"""
    WITH a AS ({_STATE.format('2024-02-01')})
    SELECT connector, stream, cursor_value, rows AS rows_total FROM a
    WHERE connector <> 'click' AND NOT (connector = 'view' AND stream = 'user_7')""")
def state_reset(spark, sf):
    """One whole source and one stream of another are forgotten."""
    state = _state(spark, sf, "2024-02-01", "r1").withColumnRenamed("rows", "rows_total")
    state = S.reset_state(S.reset_state(state, "click"), "view", "user_7")
    return state.select("connector", "stream", "cursor_value", "rows_total")


# --------------------------------------------------------------------------
# run history


def _runs(spark, sf):
    """One run per order: what it loaded and how it ended."""
    result = lambda name, n: F.struct(
        F.lit(name).alias("name"), n.alias("rows_extracted"), (n - 1).alias("rows_loaded"),
        F.lit(None).cast("string").alias("cursor_before"), F.col("o_orderpriority").alias("cursor_after"),
        F.when(F.col("o_orderstatus") == "F", F.lit("succeeded")).otherwise(F.lit("failed")).alias("status"))
    both = F.array(result("a", F.col("o_custkey")), result("b", F.col("o_orderkey")))
    return table(spark, sf, "orders").select(
        F.concat(F.lit("run-"), "o_orderkey").alias("run_id"), F.col("o_orderdate").cast("timestamp").alias("started_at"),
        F.col("o_orderstatus").alias("status"), F.to_json(both).alias("streams_json"))


@query("runs_recent", f"""
    SELECT 'run-' || o_orderkey AS run_id, {sql_stamp('o_orderdate')} AS started_at, o_orderstatus AS status
    FROM orders ORDER BY o_orderdate DESC, run_id DESC LIMIT 25""")
def runs_recent(spark, sf):
    return R.recent_runs(_runs(spark, sf), 25).select("run_id", stamp("started_at").alias("started_at"), "status")


@query("run_show", f"""
    SELECT 'run-' || o_orderkey AS run_id, {sql_stamp('o_orderdate')} AS started_at FROM orders WHERE o_orderkey = 77""")
def run_show(spark, sf):
    return R.one_run(_runs(spark, sf), "run-77").select("run_id", stamp("started_at").alias("started_at"))


@query("runs_streams", f"""
    WITH r AS (SELECT o_orderkey, o_orderdate, o_orderpriority, o_orderstatus, UNNEST(['a', 'b']) AS name,
                      UNNEST([o_custkey, o_orderkey]) AS n FROM orders)
    SELECT 'run-' || o_orderkey AS run_id, {sql_stamp('o_orderdate')} AS started_at, name, n AS rows_extracted,
           n - 1 AS rows_loaded, CAST(NULL AS VARCHAR) AS cursor_before, o_orderpriority AS cursor_after,
           CASE WHEN o_orderstatus = 'F' THEN 'succeeded' ELSE 'failed' END AS status FROM r""")
def runs_streams(spark, sf):
    return R.run_streams(_runs(spark, sf)).withColumn("started_at", stamp("started_at"))


@query("event_log", """
    SELECT 'e' || user_id AS stream, CASE event_type WHEN 'click' THEN 'batch_loaded' WHEN 'error' THEN 'stream_failed'
               ELSE 'user' END AS event, COUNT(*) AS lines, CAST(SUM(event_id) AS BIGINT) AS rows
    FROM events WHERE event_id % 97 <> 0 GROUP BY ALL""")
def event_log(spark, sf):
    """Event lines written as JSON, some torn, read back as a table."""
    kind = F.expr("CASE event_type WHEN 'click' THEN 'batch_loaded' WHEN 'error' THEN 'stream_failed' ELSE 'user' END")
    line = F.to_json(F.struct(F.lit("r1").alias("run_id"), kind.alias("event"),
                              F.concat(F.lit("e"), "user_id").alias("stream"), F.col("event_id").alias("rows")))
    torn = F.when(F.col("event_id") % 97 == 0, F.substring(line, 1, 20)).otherwise(line)
    path = scratch(spark, "events")
    table(spark, sf, "events").select(torn.alias("value")).write.text(path)
    return R.read_events(spark, path).groupBy("stream", "event").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("rows").alias("rows"))


@query("event_log_user", """
    SELECT event_type, COUNT(*) AS lines, CAST(SUM(event_id) AS BIGINT) AS ids,
           CAST(SUM(CASE WHEN event_id % 10 = 0 THEN 0 ELSE event_id END) AS BIGINT) AS rows,
           COUNT_IF(event_id % 10 = 0) AS misfits, COUNT(props) AS props
    FROM events GROUP BY 1""")
def event_log_user(spark, sf):
    """The file that an event log writes, of as many user events as there are types, and every event as a line of its own: fields of
    their own are kept, and a line is kept where one field is no number."""
    events, root = table(spark, sf, "events"), scratch(spark, "own")
    log = EventLog("r1", ())
    for row in events.select("event_type").distinct().collect():
        log.emit("user", message="seen", event_type=row.event_type, order={"id": 7})
    path = log.write(spark, root)
    rows = F.when(F.col("event_id") % 10 == 0, F.lit("many")).otherwise(F.col("event_id").cast("string"))
    own = events.select(F.to_json(F.struct(F.lit("user").alias("event"), rows.alias("rows"), F.col("event_id").alias("my_id"),
                                           "event_type", "props")).alias("value"))
    own.write.text(f"{root}/more")
    written = R.read_events(spark, path).where("event = 'user' AND message = 'seen'").select(
        F.col("fields")["event_type"].alias("event_type"), F.get_json_object(F.col("fields")["order"], "$.id").alias("id"))
    lines = R.read_events(spark, f"{root}/more").groupBy(F.col("fields")["event_type"].alias("event_type")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("fields")["my_id"].cast("bigint")).alias("ids"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.count(F.col("fields")["rows"]).alias("misfits"),
        F.count(F.col("fields")["props"]).alias("props"))
    return lines.join(written.where("id = '7'").select("event_type"), "event_type")


_SECRETS = ("that", "please", "with", "the", "that")


@query("log_redact", """
    SELECT conv_id, turn, REPLACE(REPLACE(REPLACE(text, 'that', '***'), 'please', '***'), 'with', '***') AS text
    FROM conversations""")
def log_redact(spark, sf):
    """Every secret in the whole text is masked; three letters are too short to be one."""
    log = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return R.masked(log, "text", _SECRETS)


@query("log_redact_documents", """
    SELECT doc_id, LENGTH(REPLACE(REPLACE(text, 'password', '***'), 'secret', '***')) AS chars,
           md5(REPLACE(REPLACE(text, 'password', '***'), 'secret', '***')) AS digest FROM documents""")
def log_redact_documents(spark, sf):
    docs = R.masked(table(spark, sf, "documents"), "text", ["password", "secret"])
    return docs.select("doc_id", F.length("text").cast("bigint").alias("chars"),
                       F.md5(F.encode("text", "UTF-8")).alias("digest"))
