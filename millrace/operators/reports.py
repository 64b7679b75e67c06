"""Reports over run history and event logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.values import redact

# The columns of a run row and of its per-stream breakdown.
RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("config", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("destination", T.StringType()),
    T.StructField("target", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("ended_at", T.TimestampType()),
    T.StructField("duration_s", T.DoubleType()),
    T.StructField("rows_loaded", T.LongType()),
    T.StructField("full_refresh", T.BooleanType()),
    T.StructField("error_type", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("streams_json", T.StringType()),
])
STREAM_RESULTS = ("array<struct<name:string,rows_extracted:bigint,rows_loaded:bigint,"
                  "cursor_before:string,cursor_after:string,status:string>>")

# The kinds of event in a run's log.
EVENTS = ("run_start", "stream_start", "batch_loaded", "stream_committed", "stream_failed",
          "run_end", "schema_drift", "stream_skipped_leased", "user")


def recent_runs(runs: DataFrame, limit: int) -> DataFrame:
    """Newest runs first; the run id breaks ties.  A top-k, never a full sort."""
    return runs.orderBy(F.desc("started_at"), F.desc("run_id")).limit(limit)


def one_run(runs: DataFrame, run_id: str) -> DataFrame:
    return runs.filter(F.col("run_id") == run_id)


def run_streams(runs: DataFrame) -> DataFrame:
    """One row per run and stream out of ``streams_json``."""
    parsed = F.from_json("streams_json", STREAM_RESULTS)
    return (runs.select("run_id", "started_at", F.explode(parsed).alias("s"))
            .select("run_id", "started_at", "s.*"))


# The fields of the events and their types; what else an event has is its own.
EVENT_SCHEMA = (
    "ts string, run_id string, event string, stream string, rows bigint, cumulative_rows bigint, rows_loaded bigint, "
    "status string, level string, message string, column string, kind string, cells bigint, disposition string, "
    "cursor_before string, cursor_after string, partition string, error_type string, error_message string, "
    "traceback string, config string, source string, destination string, target string, full_refresh boolean, duration_s double")


def read_events(spark, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """An event log, one row for every line that is a JSON object; torn lines are skipped.

    Each line is parsed as a map of its fields to text; the known ones are cast to their types.  A value that doesn't fit its type is NULL, and its field stays in ``fields``,
    with every field that is not in the schema, such as those of ``user`` events.  Lists and objects
    stay JSON text.
    """
    schema = schema or EVENT_SCHEMA
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    entries = spark.read.text(path).select(F.from_json("value", "map<string,string>").alias("all")).where("all IS NOT NULL")

    def typed(field: T.StructField) -> Column:
        cell = F.col("all")[field.name]
        return cell if isinstance(field.dataType, T.StringType) else cell.try_cast(field.dataType)

    known = {f.name: f for f in fields.fields}
    misfit = [F.when(F.col("all")[n].isNotNull() & typed(f).isNull(), F.lit(n)) for n, f in known.items()
              if not isinstance(f.dataType, T.StringType)]
    own = F.map_filter("all", lambda k, v: ~k.isin(*known) | F.array_contains(F.array(*misfit, F.lit("")), k)) if misfit else \
        F.map_filter("all", lambda k, v: ~k.isin(*known))
    return entries.select(*[typed(f).alias(f.name) for f in fields.fields], own.alias("fields"))


def masked(log: DataFrame, column: str, secrets: Sequence[str]) -> DataFrame:
    """The log with every secret in ``column`` masked."""
    return log.withColumn(column, redact(F.col(column), secrets))
