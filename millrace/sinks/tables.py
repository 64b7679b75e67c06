"""Target tables: Parquet folders plus one published pointer per commit.

A commit writes a new folder ``data/_commit=<id>/_part=<value>/`` with Spark's
Parquet writer and then publishes ``log/<version>.json``.  The pointer says which
commits hold the live rows of each partition value and carries the state of every
(connector, stream) that loads the table, so rows and cursor become visible together;
an earlier pointer is the table as of that version.  Nothing that is live is ever overwritten.

This convention is for plain Parquet; ``millrace.sinks.catalog`` writes to tables of the session catalog.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Iterable
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from . import files
from ..operators.partitioning import (PART, check_same_partition, partition_follows_key, partition_value,
                                      parts_between, spread, writes_one_part)
from ..operators.schema import aligned, evolved
from ..operators.state import STATE_SCHEMA, list_state
from ..operators.upsert import key_cover, merge
from ..spec import (SYNCED_AT, Mode, PartitionKind, PartitionSpec, SpecError, check_name, field_mode, utc,
                    with_synced_at)

logger = logging.getLogger(__name__)

COMMIT = "_commit"
# Every so many versions a commit tidies up: partitions of more commits than this are put together,
# and versions older than the newest ones are forgotten, with the files that only they had.
TIDY_EVERY, MOST_COMMITS, KEEP_VERSIONS = 50, 30, 500
# Folders that no version names are those of a failed commit, or of one that is being written.
ORPHAN_HOURS = 48


def state_key(connector: str, stream: str) -> str:
    return json.dumps([connector, stream])


def state_of(pointer: dict | None, connector: str, stream: str) -> dict[str, Any]:
    return (pointer or {}).get("states", {}).get(state_key(connector, stream)) or {}


class TargetTable:
    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.name = spark, check_name(name, "table")
        self.home = f"{root.rstrip('/')}/{name}"

    # -- reading -----------------------------------------------------------

    def versions(self) -> list[int]:
        names = files.list_names(self.spark, f"{self.home}/log")
        return [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]

    def pointer(self, version: int | None = None) -> dict[str, Any] | None:
        """The published pointer: the latest, or the one of an earlier version."""
        known = self.versions()
        if version is None:
            version = known[-1] if known else None
        if version is None:
            return None
        if version not in known:
            raise ValueError(f"table {self.name!r} has no version {version}")
        return json.loads(files.read_text(self.spark, f"{self.home}/log/{version:012d}.json"))

    def version_at(self, moment: datetime) -> int:
        """The version that was current at a moment."""
        for version in reversed(self.versions()):
            if datetime.fromisoformat(self.pointer(version)["committed_at"]) <= utc(moment):
                return version
        raise ValueError(f"table {self.name!r} did not exist at {moment}")

    def read(self, version: int | None = None, parts: Iterable[str] | None = None, since: Any = None,
             until: Any = None) -> DataFrame:
        """The table, as of a version if given, limited to some partition values if given.

        ``since`` and ``until`` keep the rows with ``since <= column < until`` of the column
        that the table is partitioned by; only the partitions that may hold some are read.
        """
        pointer = self.pointer(version)
        if pointer is None:
            raise ValueError(f"table {self.name!r} does not exist")
        if since is None and until is None:
            return self._rows(pointer, parts).drop(PART)
        spec = PartitionSpec(**(pointer["partition"] or {"kind": "none"}))
        if spec.kind is PartitionKind.NONE:
            raise SpecError(f"table {self.name!r} has no partition column to read a part by")
        wanted = parts_between(spec, pointer["parts"] if parts is None else parts, since, until)
        rows = self._rows(pointer, wanted).drop(PART)
        value = F.col(f"`{spec.column or SYNCED_AT}`")
        for edge, keep in ((since, value.__ge__), (until, value.__lt__)):
            if edge is not None:
                rows = rows.filter(keep(F.lit(edge)))
        return rows

    def _schema(self, pointer: dict) -> T.StructType:
        return T.StructType.fromJson(pointer["schema"])

    def _rows(self, pointer: dict, parts: Iterable[str] | None = None) -> DataFrame:
        wanted = pointer["parts"] if parts is None else {
            p: pointer["parts"][p] for p in parts if p in pointer["parts"]}
        data = f"{self.home}/data"
        folders = [f"{data}/{COMMIT}={c}/{PART}={p}" for p, commits in wanted.items() for c in commits]
        schema = self._schema(pointer).add(PART, T.StringType()).add(COMMIT, T.StringType())
        if not folders:
            return self.spark.createDataFrame([], schema).drop(COMMIT)
        if parts is None:
            folders = self._whole_commits(pointer, folders)
        return self.spark.read.option("basePath", data).schema(schema).parquet(*folders).drop(COMMIT)

    def _whole_commits(self, pointer: dict, folders: list[str]) -> list[str]:
        """Name a commit's folder once where all its partitions are live."""
        live: dict[str, int] = {}
        for commits in pointer["parts"].values():
            for c in commits:
                live[c] = live.get(c, 0) + 1
        whole = {c for c, n in live.items() if n == pointer["sizes"][c]}
        data = f"{self.home}/data"
        kept = [f for f in folders if f.rsplit("/", 2)[1].removeprefix(f"{COMMIT}=") not in whole]
        return kept + [f"{data}/{COMMIT}={c}" for c in sorted(whole)]

    # -- writing -----------------------------------------------------------

    def commit(self, df: DataFrame | None, how: str, *, key: tuple[str, ...] = (),
               partition: PartitionSpec | None = None, buckets: int = 0, run_id: str | None = None,
               state=None) -> dict[str, Any]:
        """Write ``df`` by ``append``, ``replace`` or ``merge`` and publish the result.

        ``None`` as ``df`` means the source was not read: only the state is published.
        ``state`` is the state row of one (connector, stream), or a function that builds
        it from the number of rows loaded once the write is done (so it may use what an
        ``Observation`` on ``df`` measured); the rows of others stay, and so does this
        one's if there is none.  ``df`` is computed once.  The row count is read from the footers of
        the written files, so a re-run task cannot inflate it.
        """
        if how not in ("append", "replace", "merge"):
            raise ValueError(f"unknown disposition {how!r}")
        before, commit_id, loaded = self.pointer(), uuid.uuid4().hex, 0
        spec = partition.to_json() if partition is not None else None
        pointer = dict(before) if before is not None else {
            "version": -1, "parts": {}, "sizes": {}, "schema": with_synced_at(T.StructType()).jsonValue(),
            "partition": spec, "buckets": buckets, "key": list(key)}
        if df is not None:
            check_same_partition(pointer["partition"], spec, self.name)
            schema = evolved(self._schema(pointer), df.schema) if before else with_synced_at(df.schema)
            value = partition_value(partition, key, pointer["buckets"])
            if how == "merge" and pointer["parts"]:
                loaded = self._merge(pointer, df, schema, partition, key, value, commit_id)
            else:
                parts = {} if how == "replace" else pointer["parts"]
                one = writes_one_part(partition, pointer["buckets"] if key else 0)
                written = self._write(aligned(df, schema).withColumn(PART, value), commit_id, one)
                loaded = self._count(f"{self.home}/data/{COMMIT}={commit_id}")
                self._adopt(pointer, parts, commit_id, written)
            pointer["schema"] = schema.jsonValue()
        pointer["version"] += 1
        pointer["commit"], pointer["run_id"] = commit_id, run_id
        pointer["committed_at"] = datetime.now(timezone.utc).isoformat()
        row = state(loaded) if callable(state) else state
        if row:
            pointer["states"] = {**pointer.get("states", {}), state_key(row["connector"], row["stream"]): row}
        self._publish(pointer)
        if pointer["version"] and pointer["version"] % TIDY_EVERY == 0:
            try:
                self.tidy()
            except Exception:  # the rows are in, whatever becomes of the tidying; a later commit tries again
                logger.warning("table %s was not tidied", self.name, exc_info=True)
        return pointer

    def tidy(self, most_commits: int | None = None, keep_versions: int | None = None,
             orphan_hours: float = ORPHAN_HOURS) -> None:
        """Keep the pointer and the log bounded however many commits there are.

        Partitions with over ``most_commits`` commits are rewritten as one, in a version of their own; only
        the newest ``keep_versions`` versions stay readable; files that none of them names
        go, those that no version ever named once they are ``orphan_hours`` old.
        """
        most_commits = MOST_COMMITS if most_commits is None else most_commits
        keep_versions = KEEP_VERSIONS if keep_versions is None else keep_versions
        before = self.pointer()
        if before is None:
            return
        crowded = {p for p, commits in before["parts"].items() if len(commits) > most_commits}
        if crowded:
            pointer, commit_id = dict(before), uuid.uuid4().hex
            written = self._write(self._rows(before, sorted(crowded)), commit_id)
            self._adopt(pointer, {p: c for p, c in before["parts"].items() if p not in crowded}, commit_id, written)
            self._publish({**pointer, "version": before["version"] + 1, "commit": commit_id,
                           "committed_at": datetime.now(timezone.utc).isoformat()})
        versions = self.versions()
        old, kept = versions[:-keep_versions], versions[-keep_versions:]
        named = {c for v in kept for commits in self.pointer(v)["parts"].values() for c in commits}
        dropped = {c for v in old for commits in self.pointer(v)["parts"].values() for c in commits} - named
        now = datetime.now(timezone.utc)
        for folder in files.list_names(self.spark, f"{self.home}/data"):
            path, commit_id = f"{self.home}/data/{folder}", folder.removeprefix(f"{COMMIT}=")
            if commit_id in named:
                continue
            age = now - files.modified(self.spark, path)
            if commit_id in dropped or age.total_seconds() > 3600 * orphan_hours:
                files.delete(self.spark, path)
        for version in old:
            files.delete(self.spark, f"{self.home}/log/{version:012d}.json")

    def _merge(self, pointer: dict, df: DataFrame, schema: T.StructType, partition: PartitionSpec | None,
               key: tuple[str, ...], value: Column, commit_id: str) -> int:
        """Stage the batch, rewrite the partitions it touches, drop the stage; the batch's
        row count.  The stage stays behind when the merge fails."""
        stage = f"{self.home}/stage/{commit_id}"
        placed = self._with_part_column(df, schema, partition).withColumn(PART, value)
        spread(placed).write.partitionBy(PART).parquet(stage)
        touched = self._names(stage)
        loaded = self._count(stage)
        if touched:
            staged = self._staged(stage, df.schema)
            if not partition_follows_key(partition, key):
                touched |= self._parts_of_keys(pointer, staged, key)
            base = self._rows(pointer, sorted(touched)).drop(PART)
            may_be_null = any(field_mode(schema[k]) is not Mode.REQUIRED for k in key)
            merged = aligned(merge(base, staged, key, null_keys=may_be_null), schema)
            written = self._write(merged.withColumn(PART, value), commit_id)
            kept = {p: c for p, c in pointer["parts"].items() if p not in touched}
            self._adopt(pointer, kept, commit_id, written)
        files.delete(self.spark, stage)
        return loaded

    def _adopt(self, pointer: dict, parts: dict[str, list[str]], commit_id: str, written: set[str]) -> None:
        """Add a commit's partitions to the live ones; commits without any are forgotten."""
        added = {p: [*parts.get(p, []), commit_id] for p in written}
        pointer["parts"] = {**parts, **added}
        live = {c for commits in pointer["parts"].values() for c in commits}
        sizes = {**pointer["sizes"], commit_id: len(written)}
        pointer["sizes"] = {c: n for c, n in sizes.items() if c in live}

    def state(self, connector: str, stream: str) -> dict[str, Any]:
        """The state row of one (connector, stream); empty before its first commit."""
        return state_of(self.pointer(), connector, stream)

    def update_state(self, connector: str, stream: str, change: dict[str, Any]) -> None:
        """Publish the same rows with a changed state row."""
        before = self.pointer()
        row = {**state_of(before, connector, stream), **change}
        self._publish({**before, "states": {**before.get("states", {}), state_key(connector, stream): row},
                       "version": before["version"] + 1})

    def reset_state(self, connector: str | None = None, stream: str | None = None) -> int:
        """Forget the state of all, or of a connector or one of its streams; keep the rows.
        How many state rows that was."""
        before = self.pointer()
        states = (before or {}).get("states", {})
        kept = {k: row for k, row in states.items()
                if connector not in (None, row["connector"]) or stream not in (None, row["stream"])}
        if len(kept) < len(states):
            self._publish({**before, "states": kept, "version": before["version"] + 1})
        return len(states) - len(kept)

    def _publish(self, pointer: dict) -> None:
        files.publish_text(self.spark, f"{self.home}/log/{pointer['version']:012d}.json", json.dumps(pointer))

    def _with_part_column(self, df: DataFrame, schema: T.StructType,
                          partition: PartitionSpec | None) -> DataFrame:
        name = partition.column if partition is not None else None
        if name is None or name in df.columns:
            return df
        return df.withColumn(name, F.lit(None).cast(schema[name].dataType))

    def _staged(self, stage: str, schema: T.StructType) -> DataFrame:
        with_part = T.StructType([*schema.fields, T.StructField(PART, T.StringType())])
        return self.spark.read.schema(with_part).parquet(stage).drop(PART)

    def _parts_of_keys(self, pointer: dict, staged: DataFrame, key: tuple[str, ...]) -> set[str]:
        """Partition values whose rows the batch updates."""
        return {r[0] for r in self._hits(pointer, staged, key).select(PART).distinct().collect()}

    def _hits(self, pointer: dict, staged: DataFrame, key: tuple[str, ...]) -> DataFrame:
        """Keys of the target that the batch updates, with their partition values: a key-only scan that skips the row
        groups outside the ranges of the batch's keys."""
        keys = [f"`{k}`" for k in key]
        near = self._rows(pointer).filter(key_cover(staged, key))
        return near.select(*keys, PART).join(staged.select(*keys), list(key), "left_semi")

    def _write(self, df: DataFrame, commit_id: str, one_part: bool = False) -> set[str]:
        folder = f"{self.home}/data/{COMMIT}={commit_id}"
        (df if one_part else spread(df)).write.partitionBy(PART).parquet(folder)
        return self._names(folder)

    def _count(self, folder: str) -> int:
        has_rows = any(n.startswith(f"{PART}=") for n in files.list_names(self.spark, folder))
        return self.spark.read.parquet(folder).count() if has_rows else 0

    def _names(self, folder: str) -> set[str]:
        prefix = f"{PART}="
        return {n.removeprefix(prefix) for n in files.list_names(self.spark, folder) if n.startswith(prefix)}


def tables(spark: SparkSession, root: str) -> list[str]:
    return [n for n in files.list_names(spark, root) if files.list_names(spark, f"{root}/{n}/log")]


def reset_state(spark: SparkSession, root: str, connector: str, stream: str | None = None) -> int:
    """Forget the state of a source, or of one of its streams; how many rows that was."""
    return sum(TargetTable(spark, root, name).reset_state(connector, stream) for name in tables(spark, root))


def read_state(spark: SparkSession, root: str, connector: str | None = None) -> DataFrame:
    """The state rows published with the tables under ``root``, as a DataFrame."""
    rows = []
    for name in tables(spark, root):
        for state in TargetTable(spark, root, name).pointer().get("states", {}).values():
            at = datetime.fromisoformat(state["updated_at"])
            rows.append(tuple({**state, "updated_at": at}.get(f) for f in STATE_SCHEMA.names))
    return list_state(spark.createDataFrame(rows, STATE_SCHEMA), connector)
