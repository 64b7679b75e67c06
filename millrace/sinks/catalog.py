"""Tables of the session catalog, behind the same interface as ``TargetTable``.

A root ``catalog:<namespace>`` names a schema of the session's catalog; ``destination`` gives the writer for
either kind of root.  Rows go in by Spark's own writers: inserts, static or dynamic partition overwrite, and
``MERGE`` where the table's format has it.  There is no pointer that publishes rows and cursor together, so the cursor
is written after the rows: a run that dies in between reads its rows again, which a merge
or a replace absorbs.  One writer per table.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from . import files
from .tables import TargetTable, state_key
from ..operators.partitioning import PART, partition_follows_key, partition_value, spread
from ..operators.schema import aligned, evolved
from ..operators.upsert import merge
from ..spec import Mode, PartitionSpec, check_name, field_mode, with_synced_at

PREFIX = "catalog:"
STATES = "_states"
OVERWRITE = "spark.sql.sources.partitionOverwriteMode"
# Formats whose tables take MERGE.
MERGING = ("delta", "iceberg", "hudi")


def destination(spark: SparkSession, root: str, name: str) -> "TargetTable | CatalogTable":
    """The writer of a table: of a schema of the catalog, or of a folder."""
    if root.startswith(PREFIX):
        return CatalogTable(spark, root.removeprefix(PREFIX), name)
    return TargetTable(spark, root, name)


class CatalogTable:
    def __init__(self, spark: SparkSession, namespace: str, name: str, provider: str = "parquet"):
        self.spark, self.namespace, self.name, self.provider = spark, namespace, check_name(name, "table"), provider
        self.full = ".".join(f"`{p}`" for p in (*namespace.split("."), name))
        self.states = ".".join(f"`{p}`" for p in (*namespace.split("."), STATES))

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.full)

    def pointer(self) -> dict[str, Any] | None:
        """The state rows of the table; ``None`` before its first load."""
        if not self.exists():
            return None
        states = {}
        if self.spark.catalog.tableExists(self.states):
            mine = self.spark.table(self.states).filter(F.col("table") == self.name)
            newest = mine.groupBy("connector", "stream").agg(F.max_by("state", F.struct("at", "id")).alias("state"))
            states = {state_key(r.connector, r.stream): json.loads(r.state) for r in newest.collect() if r.state}
        return {"states": states}

    def state(self, connector: str, stream: str) -> dict[str, Any]:
        return ((self.pointer() or {}).get("states", {}).get(state_key(connector, stream))) or {}

    def update_state(self, connector: str, stream: str, change: dict[str, Any]) -> None:
        self._write_state(connector, stream, {**self.state(connector, stream), **change})

    def read(self) -> DataFrame:
        return self.spark.table(self.full).drop(PART)

    def commit(self, df: DataFrame | None, how: str, *, key: tuple[str, ...] = (), partition: PartitionSpec | None = None,
               buckets: int = 0, run_id: str | None = None, state=None) -> None:
        """Write ``df`` by ``append``, ``replace`` or ``merge``, then the state; see ``TargetTable.commit``.

        The batch is staged first, so it is computed once and counted from its files.
        """
        if how not in ("append", "replace", "merge"):
            raise ValueError(f"unknown disposition {how!r}")
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.full.rpartition('.')[0]}")
        loaded = 0
        if df is not None:
            # without a partition and buckets a table has one part, as in a folder
            stage = files.scratch(self.spark, "stage")
            have = with_synced_at(T.StructType()) if not self.exists() else \
                T.StructType([f for f in self.spark.table(self.full).schema.fields if f.name != PART])
            schema = evolved(have, df.schema) if self.exists() else with_synced_at(df.schema)
            value = partition_value(partition, key, buckets)
            known = [f for f in schema.fields if f.name in df.columns]
            staged_schema = T.StructType(known).add(PART, T.StringType())
            full = aligned(df, schema).withColumn(PART, value)
            spread(full.select(*[f"`{f.name}`" for f in staged_schema.fields])).write.parquet(stage)
            staged = self.spark.read.schema(staged_schema).parquet(stage)
            loaded = staged.count()
            if not self.exists():
                rows = aligned(staged, schema).withColumn(PART, F.col(PART)) if PART in schema.names else \
                    staged.select(*[F.col(f"`{n}`") if n in staged.columns else F.lit(None).cast(schema[n].dataType).alias(n)
                                    for n in schema.names], PART)
                rows.write.format(self.provider).partitionBy(PART).saveAsTable(self.full)
            else:
                self._evolve(have, schema)
                if how == "merge":
                    self._merge(staged, schema, key, partition, value)
                else:
                    self._insert(staged, schema, how == "replace", "static")
            files.delete(self.spark, stage)
        row = state(loaded) if callable(state) else state
        if row and self.exists():
            self._write_state(row["connector"], row["stream"], row)

    def _evolve(self, have: T.StructType, schema: T.StructType) -> None:
        new = [f for f in schema.fields if f.name not in have.names]
        if new:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
            self.spark.sql(f"ALTER TABLE {self.full} ADD COLUMNS ({columns})")

    def _insert(self, rows: DataFrame, schema: T.StructType, overwrite: bool, mode: str) -> None:
        whole = rows.select(*[F.col(f"`{n}`") if n in rows.columns else F.lit(None).cast(schema[n].dataType).alias(n)
                              for n in schema.names], PART)
        conf, before = self.spark.conf, self.spark.conf.get(OVERWRITE)
        conf.set(OVERWRITE, mode)  # an insert into a table takes it from the session only
        try:
            whole.write.insertInto(self.full, overwrite=overwrite)
        finally:
            conf.set(OVERWRITE, before)

    def _merge(self, staged: DataFrame, schema: T.StructType, key: tuple[str, ...], partition: PartitionSpec | None, value) -> None:
        """``MERGE`` where the format has it; else the partitions that the batch touches are rewritten by a dynamic
        partition overwrite, and those that lost all their rows to another are dropped."""
        table = self.spark.table(self.full)
        if self.provider in MERGING:
            on = reduce(and_, [F.col(f"t.`{k}`") == F.col(f"s.`{k}`") for k in key])
            (staged.alias("s").mergeInto(self.full, on).whenMatched().updateAll().whenNotMatched().insertAll().merge())
            return
        touched = {r[0] for r in staged.select(PART).distinct().collect()}
        if not partition_follows_key(partition, key):
            names = [f"`{k}`" for k in key]
            hit = table.select(*names, PART).join(staged.select(*names), list(key), "left_semi")
            touched |= {r[0] for r in hit.select(PART).distinct().collect()}
        if not touched:
            return
        base = table.filter(F.col(PART).isin(*touched)).drop(PART)
        may_be_null = any(field_mode(schema[k]) is not Mode.REQUIRED for k in key)
        merged = aligned(merge(base, staged.drop(PART), key, null_keys=may_be_null), schema).withColumn(PART, value)
        kept = files.scratch(self.spark, "merged")  # a table can't be read and overwritten at once
        spread(merged).write.parquet(kept)
        rows = self.spark.read.schema(T.StructType([*schema.fields, T.StructField(PART, T.StringType())])).parquet(kept)
        self._insert(rows, schema, True, "dynamic")
        for part in touched - {r[0] for r in rows.select(PART).distinct().collect()}:
            literal = part.replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(f"ALTER TABLE {self.full} DROP IF EXISTS PARTITION ({PART} = '{literal}')")
        files.delete(self.spark, kept)

    def _write_state(self, connector: str, stream: str, row: dict[str, Any]) -> None:
        line = (self.name, connector, stream, json.dumps(row), datetime.now(timezone.utc).isoformat(), uuid.uuid4().hex)
        frame = self.spark.createDataFrame([line], "table string, connector string, stream string, state string, at string, id string")
        frame.coalesce(1).write.format(self.provider).mode("append").saveAsTable(self.states)


def namespace_location(spark: SparkSession, namespace: str) -> str:
    """The folder of a schema, for what is kept beside its tables."""
    name = ".".join(f"`{p}`" for p in namespace.split("."))
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")
    rows = spark.sql(f"DESCRIBE SCHEMA {name}").collect()
    return next(r[1] for r in rows if r[0] == "Location")
