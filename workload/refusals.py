"""What the operators refuse: the kind of error that a load raises, beside figures of the rows it was about."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from millrace.load import Stream, load_frame, read_runs, run, run_stream
from millrace.operators.normalize import normalize
from millrace.sinks.files import scratch
from millrace.sinks.tables import TargetTable, read_state
from millrace.sources.tables import read_table
from millrace.spec import Incremental, SpecError, StreamSpec, table_schema

from .base import query, table

_AT = datetime(2024, 6, 1, 12, 0, tzinfo=timezone.utc)
_PAIR = table_schema(("o_orderkey", "INTEGER"), ("o_orderstatus", "STRING"))


def _refused(rows, act):
    """The error's kind and how many rows there were."""
    try:
        act()
        kind = "none"
    except SpecError as error:
        kind = type(error).__name__
    except Exception as error:  # of a job that the error ended
        kind = "job" if "cannot" in str(error) else type(error).__name__
    return rows.agg(F.lit(kind).alias("refused"), F.count(F.lit(1)).alias("rows"))


@query("drift_fail", "SELECT 'job' AS refused, COUNT(*) AS rows FROM orders WHERE o_orderstatus = 'P'")
def drift_fail(spark, sf):
    """One misfit under the policy ``fail`` ends the job."""
    orders = table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") == "P", "none").otherwise(F.col("o_orderkey").cast("string")).alias("o_orderkey"), "o_orderstatus")
    act = lambda: normalize(orders, _PAIR, "fail").write.format("noop").mode("overwrite").save()
    return _refused(orders.filter("o_orderstatus = 'P'"), act)


@query("strict_contract", "SELECT 'SchemaError' AS refused, COUNT(*) AS rows FROM orders")
def strict_contract(spark, sf):
    """A column that a strict stream doesn't declare."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    spec = StreamSpec("strict", schema=_PAIR, contract="strict")
    return _refused(orders, lambda: load_frame(spark, scratch(spark, "strict"), spec, orders, run_at=_AT))


@query("partition_drift", "SELECT 'PartitionMismatch' AS refused, COUNT(*) AS rows FROM orders")
def partition_drift(spark, sf):
    """A table can't change its partitioning; the rows that it has stay."""
    root, orders = scratch(spark, "drift"), table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    ranges = {"field": "o_orderkey", "type": "range", "range": {"start": 0, "end": 100_000, "interval": 20_000}}
    load_frame(spark, root, StreamSpec("parted", schema=_PAIR, partition="none"), orders, run_at=_AT)
    again = StreamSpec("parted", schema=_PAIR, partition=ranges)
    return _refused(TargetTable(spark, root, "parted").read(), lambda: load_frame(spark, root, again, orders, run_at=_AT))


@query("evolve_table", """
    SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 2 = 1 THEN o_custkey END AS o_custkey FROM orders""")
def evolve_table(spark, sf):
    """A table made by its first load gets the column that the second one brings."""
    root, orders = scratch(spark, "evolve"), table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    spec = StreamSpec("grown", schema=_PAIR, partition="none")
    load_frame(spark, root, spec, orders.filter("o_orderkey % 2 = 0").drop("o_custkey"), run_at=_AT)
    load_frame(spark, root, spec, orders.filter("o_orderkey % 2 = 1"), run_at=_AT)
    return TargetTable(spark, root, "grown").read().select("o_orderkey", "o_orderstatus", "o_custkey")


_CURSORED = StreamSpec("orders", schema=_PAIR, partition="none", incremental=Incremental("o_orderkey", "int"))


def _reading(orders):
    return Stream(_CURSORED, lambda _, ctx: read_table(orders, "o_orderkey", ctx.floor))


@query("refresh_and_since", """
    SELECT COUNT(*) * 2 + COUNT(*) FILTER (o_orderkey > 1000) AS rows, CAST(MAX(o_orderkey) AS VARCHAR) AS cursor_value FROM orders""")
def refresh_and_since(spark, sf):
    """An incremental run, a full refresh and a one-shot start: what they load, and the cursor that stays."""
    root, orders = scratch(spark, "modes"), table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    run_stream(spark, root, _reading(orders), run_at=_AT)
    run_stream(spark, root, _reading(orders), run_at=_AT, full_refresh=True)
    run_stream(spark, root, _reading(orders), run_at=_AT, since=1000)
    rows = TargetTable(spark, root, "orders").read().agg(F.count(F.lit(1)).alias("rows"))
    return rows.withColumn("cursor_value", read_state(spark, root).select("cursor_value").scalar())


@query("run_records", """
    SELECT 'succeeded' AS status, COUNT(*) AS rows_loaded, 'orders:succeeded' AS streams FROM orders
    UNION ALL SELECT 'failed', CAST(0 AS BIGINT), 'orders:failed,orders:skipped'""")
def run_records(spark, sf):
    """One record a run: its status, its rows, and what became of each stream."""
    root, orders = scratch(spark, "runs"), table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")

    def broken(_, ctx):
        raise ValueError("no such table")

    run(spark, root, [_reading(orders)], source="shop", run_at=_AT)
    run(spark, root, [Stream(_CURSORED, broken), _reading(orders)], source="shop", run_at=_AT)
    streams = F.from_json("streams_json", "array<struct<name: string, status: string>>")
    told = F.array_join(F.transform(streams, lambda s: F.concat_ws(":", s["name"], s["status"])), ",")
    return read_runs(spark, root).select("status", "rows_loaded", told.alias("streams"))
