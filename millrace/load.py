"""Run streams: read what is new, normalize, write, publish rows and cursor together."""

from __future__ import annotations

import json
import logging
import random
import time
import traceback
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from . import session
from .functions.coerce import coerced
from .functions.values import REDACTED, SHORTEST_SECRET, instant
from .operators.normalize import drift_rows, observe_drift
from .operators.reports import RUN_SCHEMA
from .operators.schema import check_strict, evolved, inferred_schema, require, stamped
from .operators.upsert import keep_last, null_key_rows
from .sinks import files
from .sinks.catalog import PREFIX, destination, namespace_location
from .sinks.tables import state_of
from .spec import (Contract, Disposition, Incremental, PartitionSpec, RunMode, SpecError, StreamSpec, cursor_to_json,
                   logical_type, typed_cursor)

logger = logging.getLogger(__name__)

RUNS_TABLE = "_runs"
# Tries to record a run while others record theirs.
RECORD_ATTEMPTS = 50
SEEN = "cursor_seen"
# What an observation raises whose node is not in the plan that ran.
NOT_OBSERVED = ("AssertionError",)


@dataclass
class Context:
    """What a stream function gets besides the session."""

    spec: StreamSpec
    floor: Any
    state: dict[str, Any]
    run_at: datetime
    full_refresh: bool
    # An aggregate that replaces max(cursor column), e.g. the last complete day.
    observed: Column | None = None
    # A cursor known without looking at rows, e.g. the end of the last window.
    reached: Any = None
    # The highest cursor that this run may commit, whatever its rows have.
    ceiling: Any = None
    # Adds to the state what is known after the load: called with the state and the cursor.
    finish: Callable[[dict[str, Any], Any], None] | None = None


StreamFunction = Callable[[SparkSession, Context], DataFrame | None]


@dataclass(frozen=True)
class Stream:
    spec: StreamSpec
    read: StreamFunction


def stream(spec: StreamSpec) -> Callable[[StreamFunction], Stream]:
    """Decorator: tie a reading function to its declaration."""
    return lambda read: Stream(spec, read)


@dataclass
class StreamResult:
    name: str
    rows_extracted: int = 0
    rows_loaded: int = 0
    cursor_before: Any = None
    cursor_after: Any = None
    status: str = "succeeded"
    drift: list[tuple[str, str, int]] = field(default_factory=list)
    null_key_rows: int = 0

    def to_json(self) -> dict[str, Any]:
        text = lambda v: None if v is None else str(cursor_to_json(v))
        return {"name": self.name, "rows_extracted": self.rows_extracted, "rows_loaded": self.rows_loaded,
                "cursor_before": text(self.cursor_before), "cursor_after": text(self.cursor_after),
                "status": self.status}


@dataclass
class RunResult:
    run_id: str
    source: str
    status: str
    started_at: datetime
    ended_at: datetime
    streams: list[StreamResult]
    error: BaseException | None = None
    # Why the run's record could not be written; its streams are as they say.
    record_error: BaseException | None = None

    @property
    def rows_loaded(self) -> int:
        return sum(s.rows_loaded for s in self.streams)

    def raise_for_status(self) -> "RunResult":
        if self.error is not None:
            raise self.error
        return self


class EventLog:
    """Events of one run, written as one JSON-lines file next to the tables."""

    def __init__(self, run_id: str, mask: Iterable[str] = ()):
        self.run_id, self.lines = run_id, []
        self.secrets = sorted((s for s in mask if len(s) >= SHORTEST_SECRET), key=len, reverse=True)

    def masked(self, value: Any) -> Any:
        """A text without the secrets, before anything escapes their characters."""
        if isinstance(value, str):
            for secret in self.secrets:
                value = value.replace(secret, REDACTED)
        return value

    def emit(self, event: str, **fields: Any) -> None:
        self.lines.append(json.dumps({
            "ts": datetime.now(timezone.utc).isoformat(), "run_id": self.run_id, "event": event,
            **{k: self.masked(cursor_to_json(v)) for k, v in fields.items()}}))

    def write(self, spark: SparkSession, root: str) -> str:
        home = namespace_location(spark, root.removeprefix(PREFIX)) if root.startswith(PREFIX) else root
        path = f"{home.rstrip('/')}/_logs/{self.run_id}.jsonl"
        files.write_text(spark, path, "\n".join(self.lines) + "\n")
        return path


def load_frame(spark: SparkSession, root: str, spec: StreamSpec, df: DataFrame | None, *, source: str = "",
               run_id: str = "", run_at: datetime | None = None, state: Mapping[str, Any] | None = None,
               observed: Column | None = None, reached: Any = None, write_state: bool = True,
               advance: bool = True, seed: Any = None, partition: Any = None, ceiling: Any = None,
               finish: Callable[[dict[str, Any], Any], None] | None = None) -> StreamResult:
    """Load one DataFrame as one commit of a stream's table.

    Rows are read once: drift, extracted rows and the highest cursor come from an
    observation on the same write.  A stage that is re-run after a lost executor can
    raise the observed counts, never the cursor; ``rows_loaded`` comes from the files.
    ``advance=False`` leaves the cursor where it is and only remembers the highest value
    seen (see ``settle``); ``write_state=False`` leaves the whole state row as it is.  ``None`` leaves the rows alone and commits only the state.
    """
    session.check(spark)
    run_at = run_at or datetime.now(timezone.utc)
    table = destination(spark, root, spec.table)
    pointer = table.pointer()
    prior = state_of(pointer, source, spec.name)
    inc = spec.incremental
    result = StreamResult(spec.name, cursor_before=seed)
    before, after = Observation(), Observation()
    resolved = None
    if df is not None:
        schema = spec.schema
        if schema is None:
            schema = inferred_schema(df)
        elif spec.contract is Contract.STRICT:
            check_strict(df, schema, spec.name)
        raw, declared = df, schema
        highest = observed
        if highest is None and inc and inc.column in df.columns:
            highest = F.max(F.col(f"`{inc.column}`"))
        extra = [] if highest is None else [instant(df, highest).alias("__cursor")]
        df = observe_drift(df, schema, before, spec.drift, *extra)
        # Undeclared columns are landed too, with the logical type they arrived in.
        new = inferred_schema(df.drop(*schema.names))
        if len(new):
            df = _as_logical(df, new)
            schema = evolved(schema, new)
        df = require(df, schema)
        df = stamped(df, F.lit(run_at).cast("timestamp"))
        if spec.disposition is Disposition.MERGE:
            df = keep_last(df, spec.key, spec.last_by or ((inc.column,) if inc else ()))
            df = df.observe(after, null_key_rows(spec.key).alias("nulls"))
        resolved, warning = spec.resolve_partition(schema, partition)
        present = {f.name for f in df.schema.fields}
        if pointer is not None and spec.disposition is Disposition.MERGE:
            absent = [f.name for f in declared.fields if f.name not in raw.columns and f.name not in spec.key]
            df = df.drop(*[c for c in absent if c in present])

    def new_state(loaded: int) -> dict[str, Any] | None:
        seen = reached
        if df is not None:
            merging = spec.disposition is Disposition.MERGE
            measured = _measured(before)
            result.rows_loaded = loaded
            result.rows_extracted = measured.get("rows", 0) if merging else loaded
            result.null_key_rows = _measured(after).get("nulls", 0) if merging else 0
            result.drift = drift_rows(measured, raw, declared)
            seen = reached if reached is not None else measured.get("__cursor")
        if inc is not None and seen is not None and ceiling is not None:
            seen = min(typed_cursor(seen, inc.type), typed_cursor(ceiling, inc.type))
        committed = prior.get("cursor_value")
        blob = dict(state if state is not None else json.loads(prior.get("state_blob") or "{}"))
        if inc is None:
            result.cursor_after = None
        elif write_state and advance:
            result.cursor_after = inc.advance(seen if seen is not None else seed, committed)
        else:
            result.cursor_after = typed_cursor(committed, inc.type)
            if write_state:
                earlier = json.loads(prior.get("state_blob") or "{}").get(SEEN)
                blob[SEEN] = cursor_to_json(inc.advance(seen, earlier))
        if not write_state:
            return prior or None
        if finish is not None:
            finish(blob, result.cursor_after)
        return {"connector": source, "stream": spec.name,
                "cursor_value": _text(cursor_to_json(result.cursor_after)),
                "cursor_type": inc.type.value if inc else None,
                "state_blob": json.dumps(blob),
                "last_run_id": run_id,
                "rows_total": int(prior.get("rows_total") or 0) + result.rows_loaded,
                "updated_at": run_at.isoformat()}

    if df is None and pointer is None:
        new_state(0)
        return result
    table.commit(df, spec.disposition.value, key=spec.key, partition=resolved,
                 buckets=spec.buckets if spec.disposition is Disposition.MERGE else 0,
                 run_id=run_id, state=new_state)
    return result


def _measured(observation: Observation) -> dict[str, Any]:
    """What an observation saw; nothing where Spark dropped it from a plan without rows."""
    try:
        return observation.get
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() not in NOT_OBSERVED:
            raise
        return {}


def settle(spark: SparkSession, root: str, spec: StreamSpec, source: str = "") -> Any:
    """Commit the cursor an unordered stream has seen, now that all of it has landed."""
    table = destination(spark, root, spec.table)
    state = table.state(source, spec.name)
    blob = json.loads(state.get("state_blob") or "{}")
    if SEEN not in blob:
        return typed_cursor(state.get("cursor_value"), spec.incremental.type)
    cursor = spec.incremental.advance(blob.pop(SEEN), state.get("cursor_value"))
    table.update_state(source, spec.name, {"cursor_value": _text(cursor_to_json(cursor)), "state_blob": json.dumps(blob)})
    return cursor


def _text(value: Any) -> str | None:
    return None if value is None else str(value)


def _as_logical(df: DataFrame, schema) -> DataFrame:
    """Undeclared columns in the Spark type of their logical type."""
    changes = {f.name: coerced(F.col(f"`{f.name}`"), df.schema[f.name].dataType, logical_type(f))
               for f in schema.fields}
    return df.withColumns(changes)


def run_stream(spark: SparkSession, root: str, one: Stream, *, source: str = "", run_id: str = "",
               mode: Any = None, full_refresh: bool = False, since: Any = None,
               run_at: datetime | None = None, partition: Any = None,
               log: EventLog | None = None) -> StreamResult:
    """Seed the cursor, read, load and commit one stream."""
    spec = one.spec
    run_at = run_at or datetime.now(timezone.utc)
    refresh = spec.mode(mode, full_refresh) is RunMode.FULL_REFRESH
    pointer = destination(spark, root, spec.table).pointer()
    prior = state_of(pointer, source, spec.name)
    inc: Incremental | None = spec.incremental
    seed = inc.seed(prior.get("cursor_value"), since, refresh) if inc else None
    context = Context(spec, seed, json.loads(prior.get("state_blob") or "{}"), run_at, refresh)
    if log:
        log.emit("stream_start", stream=spec.name, disposition=spec.disposition.value, cursor_before=seed)
    df = one.read(spark, context)
    result = load_frame(spark, root, spec, df, source=source, run_id=run_id, run_at=run_at,
                        state=context.state, observed=context.observed, reached=context.reached,
                        write_state=not (refresh and inc is not None), seed=seed, partition=partition,
                        ceiling=context.ceiling, finish=context.finish)
    if log:
        for name, kind, cells in result.drift:
            log.emit("schema_drift", stream=spec.name, column=name, kind=kind, cells=cells)
        log.emit("batch_loaded", stream=spec.name, rows=result.rows_loaded, cumulative_rows=result.rows_loaded)
        log.emit("stream_committed", stream=spec.name, rows_loaded=result.rows_loaded,
                 cursor_after=_text(cursor_to_json(result.cursor_after)))
    return result


def run(spark: SparkSession, root: str, streams: Iterable[Stream], *, source: str = "", config: str = "",
        target: str = "", full_refresh: bool = False, modes: Mapping[str, Any] | None = None,
        since: Mapping[str, Any] | None = None, secrets: Iterable[str] = (),
        run_at: datetime | None = None, parallel: int = 1) -> RunResult:
    """Run streams in order, record the run, and return its result; ``root`` is a folder or
    ``catalog:<namespace>``.  A failing stream
    ends the run and those not yet begun are ``skipped``.  Never raises: see ``raise_for_status``.

    ``parallel`` streams run at a time, so that small ones share the cluster; results keep
    the declared order.  Streams that load one table must not run at a time.
    """
    run_id, streams = uuid.uuid4().hex, list(streams)
    log = EventLog(run_id, secrets)
    started = datetime.now(timezone.utc)
    errors: list[BaseException] = []
    log.emit("run_start", config=config, source=source, destination="parquet", target=target,
             full_refresh=full_refresh)

    def attempt(one: Stream) -> StreamResult:
        name = one.spec.name
        if errors:
            return StreamResult(name, status="skipped")
        try:
            return run_stream(spark, root, one, source=source, run_id=run_id, run_at=run_at,
                              mode=(modes or {}).get(name), full_refresh=full_refresh,
                              since=(since or {}).get(name), log=log)
        except Exception as failure:
            errors.append(failure)
            log.emit("stream_failed", stream=name, error_type=type(failure).__name__,
                     error_message=str(failure), traceback=traceback.format_exc())
            return StreamResult(name, status="failed")

    if parallel > 1:
        tables = [one.spec.table for one in streams]
        if len(set(tables)) < len(tables):
            raise SpecError("streams that load one table can't run in parallel")
        with ThreadPoolExecutor(parallel) as pool:
            results = list(pool.map(inheritable_thread_target(spark)(attempt), streams))
    else:
        results = [attempt(one) for one in streams]
    error = errors[0] if errors else None
    ended = datetime.now(timezone.utc)
    status = "failed" if error is not None else "succeeded"
    result = RunResult(run_id, source, status, started, ended, results, error)
    log.emit("run_end", status=status, rows_loaded=result.rows_loaded,
             duration_s=(ended - started).total_seconds(),
             error_type=type(error).__name__ if error else None,
             error_message=str(error) if error else None)
    try:
        log.write(spark, root)
        record_run(spark, root, result, config=config, target=target, full_refresh=full_refresh, mask=log.masked)
    except Exception as failure:  # what was loaded stays loaded
        logger.warning("run %s was not recorded", run_id, exc_info=True)
        result.record_error = failure
    return result


def record_run(spark: SparkSession, root: str, result: RunResult, *, config: str = "", target: str = "",
               full_refresh: bool = False, mask: Callable[[str], str] = str) -> None:
    """Upsert the run's row on its run id; runs of one day share a partition.  ``mask``
    takes secrets out of the error's text.  Runs that end together record themselves one after the other."""
    row = (result.run_id, config, result.source, "parquet", target, result.status, result.started_at,
           result.ended_at, (result.ended_at - result.started_at).total_seconds(), result.rows_loaded,
           full_refresh, type(result.error).__name__ if result.error else None,
           mask(str(result.error)) if result.error else None,
           json.dumps([s.to_json() for s in result.streams]))
    spec = StreamSpec(RUNS_TABLE, key="run_id", disposition="merge")
    day = PartitionSpec.parse("started_at")
    frame = stamped(spark.createDataFrame([row], RUN_SCHEMA), F.lit(result.ended_at).cast("timestamp"))
    for attempt in range(RECORD_ATTEMPTS):
        try:
            destination(spark, root, RUNS_TABLE).commit(frame, "merge", key=spec.key, partition=day, run_id=result.run_id)
            return
        except files.AlreadyExists:
            if attempt + 1 == RECORD_ATTEMPTS:
                raise
            time.sleep(random.uniform(0, 0.2 * (attempt + 1)))


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    """The run history; empty before the first run."""
    table = destination(spark, root, RUNS_TABLE)
    if table.pointer() is None:
        return spark.createDataFrame([], RUN_SCHEMA)
    return table.read().select(*RUN_SCHEMA.names)
