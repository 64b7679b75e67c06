"""The continuous form of a load: a Structured Streaming query whose every
micro-batch is one commit."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from ..load import load_frame
from ..sinks.tables import TargetTable
from ..spec import Disposition, SpecError, StreamSpec

LAST_BATCHES = "last_batches"


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                files_per_batch: int = 1000, **options: Any) -> DataFrame:
    """New files under a path.  Spark tracks files, not times, so a file that lands in
    the same second as the last one is still read."""
    if fmt not in ("csv", "json", "parquet"):
        raise SpecError(f"unknown streaming format {fmt!r}")
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.options(**options).load(path)


def ingest(stream: DataFrame, root: str, spec: StreamSpec, checkpoint: str, *, source: str = "",
           shape: Callable[[DataFrame], DataFrame] | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Start a query that loads each micro-batch by the stream's disposition.

    A replayed micro-batch is recognised by the batch number published with the
    rows for its checkpoint, so each is applied once, also when several queries load one
    table.  A ``replace`` stream empties the table with the first micro-batch of a
    checkpoint; the others add to it.  The cursor of a stream declared ``ordered`` moves
    with every micro-batch; any other stream may still bring older rows, so its cursor
    waits for ``load.settle`` at the end.
    """
    ordered = spec.incremental is None or spec.incremental.ordered

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        blob = json.loads(TargetTable(spark, root, spec.table).state(source, spec.name).get("state_blob") or "{}")
        done = blob.get(LAST_BATCHES, {})
        if number <= done.get(checkpoint, -1):
            return
        rows = shape(batch) if shape else batch
        adds = spec.disposition is Disposition.REPLACE and checkpoint in done
        load_frame(spark, root, replace(spec, disposition=Disposition.APPEND) if adds else spec, rows, source=source,
                   run_id=f"{checkpoint}#{number}", state={**blob, LAST_BATCHES: {**done, checkpoint: number}},
                   advance=ordered)

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


