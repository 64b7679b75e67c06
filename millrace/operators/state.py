"""State rows as a table: commit, reset, list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from .upsert import merge

STATE_KEY = ("connector", "stream")

# The columns of a state row and of a run row.
STATE_SCHEMA = T.StructType([
    T.StructField("connector", T.StringType()),
    T.StructField("stream", T.StringType()),
    T.StructField("cursor_value", T.StringType()),
    T.StructField("cursor_type", T.StringType()),
    T.StructField("state_blob", T.StringType()),
    T.StructField("last_run_id", T.StringType()),
    T.StructField("rows_total", T.LongType()),
    T.StructField("updated_at", T.TimestampType()),
])


def commit_state(state: DataFrame, commits: DataFrame) -> DataFrame:
    """Upsert state rows; ``rows`` of a commit adds to the stored ``rows_total``."""
    before = state.select(*STATE_KEY, F.col("rows_total").alias("__before"))
    total = F.coalesce(F.col("__before"), F.lit(0)) + F.col("rows")
    fresh = (commits.join(before, list(STATE_KEY), "left")
             .withColumn("rows_total", total.cast("bigint")).drop("rows", "__before"))
    return merge(state, fresh, STATE_KEY, null_keys=False)


def reset_state(state: DataFrame, connector: str, stream: str | None = None) -> DataFrame:
    """State without one source's rows, or without one stream's row; tables are not touched."""
    gone = F.col("connector") == connector
    if stream is not None:
        gone = gone & (F.col("stream") == stream)
    return state.filter(~F.coalesce(gone, F.lit(False)))


def list_state(state: DataFrame, connector: str | None = None) -> DataFrame:
    return state if connector is None else state.filter(F.col("connector") == connector)
