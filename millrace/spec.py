"""Declarations: logical types, columns, streams, cursors and partition specs.

A table schema is an ordinary ``StructType``.  The logical type, the mode and
the description travel in the field metadata, so a schema survives a trip
through JSON or a Parquet footer unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from enum import Enum
from typing import Any

from pyspark.sql import types as T

SYNCED_AT = "_synced_at"


class SpecError(ValueError):
    """A declaration that cannot be honoured."""


class _Choice(str, Enum):
    @classmethod
    def of(cls, value):
        for member in cls:
            if str(getattr(value, "value", value)).strip().lower() == member.value.lower():
                return member
        raise SpecError(f"{value!r} is not one of {[m.value for m in cls]}")


class FieldType(_Choice):
    STRING = "STRING"
    INTEGER = "INTEGER"
    FLOAT = "FLOAT"
    BOOLEAN = "BOOLEAN"
    TIMESTAMP = "TIMESTAMP"
    DATE = "DATE"
    JSON = "JSON"
    BYTES = "BYTES"


class Mode(_Choice):
    NULLABLE = "NULLABLE"
    REQUIRED = "REQUIRED"
    REPEATED = "REPEATED"


class CursorType(_Choice):
    TIMESTAMP = "timestamp"
    DATE = "date"
    INT = "int"
    STRING = "string"


class Disposition(_Choice):
    APPEND = "append"
    MERGE = "merge"
    REPLACE = "replace"


class Drift(_Choice):
    WARN = "warn"
    FAIL = "fail"


class Contract(_Choice):
    EVOLVE = "evolve"
    STRICT = "strict"


class RunMode(_Choice):
    INCREMENTAL = "incremental"
    FULL_REFRESH = "full_refresh"


SPARK_TYPES: dict[FieldType, T.DataType] = {
    FieldType.STRING: T.StringType(),
    FieldType.INTEGER: T.LongType(),
    FieldType.FLOAT: T.DoubleType(),
    FieldType.BOOLEAN: T.BooleanType(),
    FieldType.TIMESTAMP: T.TimestampType(),
    FieldType.DATE: T.DateType(),
    FieldType.JSON: T.StringType(),
    FieldType.BYTES: T.BinaryType(),
}

CURSOR_SPARK_TYPES: dict[CursorType, T.DataType] = {
    CursorType.TIMESTAMP: T.TimestampType(),
    CursorType.DATE: T.DateType(),
    CursorType.INT: T.LongType(),
    CursorType.STRING: T.StringType(),
}

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def check_name(name: str, what: str = "identifier") -> str:
    """Names come from declarations and from source records, so they are checked
    before they become a column, a table or a directory."""
    if not isinstance(name, str) or not _NAME.fullmatch(name):
        raise SpecError(f"{what} {name!r} must be letters, digits and underscores, not starting with a digit")
    return name


def _reject_unknown(given: Iterable[str], known: Iterable[str], what: str) -> None:
    extra = sorted(set(given) - set(known))
    if extra:
        raise SpecError(f"unknown {what} key(s): {', '.join(extra)}")


# --------------------------------------------------------------------------
# columns and schemas


def column(name: str, type: str | FieldType, mode: str | Mode = Mode.NULLABLE,
           description: str = "") -> T.StructField:
    logical, mode = FieldType.of(type), Mode.of(mode)
    spark_type = SPARK_TYPES[logical]
    if mode is Mode.REPEATED:
        spark_type = T.ArrayType(spark_type)
    meta = {"logical": logical.value, "mode": mode.value}
    if description:
        meta["description"] = description
    return T.StructField(name, spark_type, True, meta)


def table_schema(*columns: T.StructField | Sequence | Mapping[str, Any]) -> T.StructType:
    """Build a schema from ``StructField``s, ``(name, type[, mode])`` tuples or mappings."""
    fields = []
    for item in columns:
        if isinstance(item, T.StructField):
            fields.append(item)
        elif isinstance(item, Mapping):
            _reject_unknown(item, ("name", "type", "mode", "description"), "schema field")
            for needed in ("name", "type"):
                if needed not in item:
                    raise SpecError(f"schema field needs a {needed!r}: {dict(item)!r}")
            fields.append(column(**item))
        else:
            fields.append(column(*item))
    names = [f.name for f in fields]
    if len(set(names)) != len(names):
        raise SpecError(f"duplicate column in schema: {names}")
    return T.StructType(fields)


def logical_type(field: T.StructField) -> FieldType:
    """The logical type of a field: its metadata, or else what its Spark type maps to."""
    if "logical" in (field.metadata or {}):
        return FieldType.of(field.metadata["logical"])
    return logical_of_spark(field.dataType)


def logical_of_spark(data_type: T.DataType) -> FieldType:
    if isinstance(data_type, T.BooleanType):
        return FieldType.BOOLEAN
    if isinstance(data_type, T.IntegralType):
        return FieldType.INTEGER
    if isinstance(data_type, (T.FractionalType,)):
        return FieldType.FLOAT
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return FieldType.TIMESTAMP
    if isinstance(data_type, T.DateType):
        return FieldType.DATE
    if isinstance(data_type, T.BinaryType):
        return FieldType.BYTES
    if isinstance(data_type, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return FieldType.JSON
    return FieldType.STRING


def field_mode(field: T.StructField) -> Mode:
    return Mode.of((field.metadata or {}).get("mode", Mode.NULLABLE))


def with_synced_at(schema: T.StructType) -> T.StructType:
    if SYNCED_AT in schema.names:
        return schema
    stamp = column(SYNCED_AT, FieldType.TIMESTAMP, description="time of the load that wrote the row")
    return T.StructType([*schema.fields, stamp])


# --------------------------------------------------------------------------
# cursors

_LOOKBACK = re.compile(r"\s*(\d+)\s*([smhdw]?)\s*")
_UNIT_SECONDS = {"s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800}


def parse_lookback(text: str | int, cursor_type: str | CursorType) -> timedelta | int:
    """``<int><unit>``; a day cursor rounds up to whole days, an int cursor counts
    seconds (or plain units when no suffix is given)."""
    cursor_type = CursorType.of(cursor_type)
    match = _LOOKBACK.fullmatch(str(text))
    if match is None:
        raise SpecError(f"lookback {text!r} is not <int><s|m|h|d|w>")
    if cursor_type is CursorType.STRING:
        raise SpecError("a string cursor has no arithmetic, so it cannot take a lookback")
    amount, unit = int(match[1]), match[2]
    if cursor_type is CursorType.INT:
        return amount * _UNIT_SECONDS.get(unit, 1)
    if not unit:
        raise SpecError(f"lookback {text!r} on a {cursor_type.value} cursor needs a unit")
    span = timedelta(seconds=amount * _UNIT_SECONDS[unit])
    if cursor_type is CursorType.DATE:
        whole_days = span.days + (1 if span.seconds else 0)
        return timedelta(days=max(whole_days, 1))
    return span


def typed_cursor(value: Any, cursor_type: str | CursorType) -> Any:
    """Bring a cursor value, possibly read back from JSON, to its Python type.
    Timestamps come out in UTC, so two cursors always compare."""
    if value is None:
        return None
    cursor_type = CursorType.of(cursor_type)
    if cursor_type is CursorType.INT:
        return int(value)
    if cursor_type is CursorType.STRING:
        return str(value)
    if cursor_type is CursorType.DATE:
        if isinstance(value, datetime):
            return utc(value).date()
        return value if isinstance(value, date) else date.fromisoformat(str(value)[:10])
    if isinstance(value, datetime):
        return utc(value)
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day, tzinfo=timezone.utc)
    return utc(datetime.fromisoformat(str(value)))


def utc(value: datetime) -> datetime:
    if value.tzinfo is None:
        return value.replace(tzinfo=timezone.utc)
    return value.astimezone(timezone.utc)


def cursor_to_json(value: Any) -> Any:
    """JSON-safe form of a cursor or key value: dates and timestamps as ISO-8601."""
    if value is None or isinstance(value, (bool, int, float, str)):
        return value
    return value.isoformat() if isinstance(value, (date, datetime)) else str(value)


@dataclass(frozen=True)
class Incremental:
    column: str
    type: CursorType = CursorType.TIMESTAMP
    initial: Any = None
    lookback: str | None = None
    ordered: bool = False
    inclusive: bool = False

    def __post_init__(self):
        object.__setattr__(self, "type", CursorType.of(self.type))
        if self.lookback is not None:
            parse_lookback(self.lookback, self.type)

    def seed(self, committed: Any = None, since: Any = None, full_refresh: bool = False) -> Any:
        """Where this run starts reading; ``None`` means from the beginning.

        A full refresh has no floor.  A one-shot ``since`` is taken as it is.  A
        resumed run steps back by the lookback; a first run starts at ``initial``.
        """
        if full_refresh:
            return None
        if since is not None:
            return typed_cursor(since, self.type)
        if committed is None:
            return typed_cursor(self.initial, self.type)
        floor = typed_cursor(committed, self.type)
        if self.lookback is None:
            return floor
        return floor - parse_lookback(self.lookback, self.type)

    def advance(self, observed: Any, committed: Any = None) -> Any:
        """The cursor to commit: never behind the committed one."""
        values = [typed_cursor(v, self.type) for v in (observed, committed) if v is not None]
        return max(values, default=None)


# --------------------------------------------------------------------------
# partitioning


class PartitionKind(_Choice):
    TIME = "time"
    RANGE = "range"
    INGESTION = "ingestion"
    NONE = "none"


class Granularity(_Choice):
    HOUR = "hour"
    DAY = "day"
    MONTH = "month"
    YEAR = "year"


@dataclass(frozen=True)
class PartitionSpec:
    kind: PartitionKind
    column: str | None = None
    granularity: Granularity | None = None
    start: int | None = None
    end: int | None = None
    interval: int | None = None

    def __post_init__(self):
        object.__setattr__(self, "kind", PartitionKind.of(self.kind))
        if self.granularity is not None:
            object.__setattr__(self, "granularity", Granularity.of(self.granularity))
        bounds = (self.start, self.end, self.interval)
        allowed = {
            PartitionKind.TIME: (True, True, False),
            PartitionKind.RANGE: (True, False, True),
            PartitionKind.INGESTION: (False, False, False),
            PartitionKind.NONE: (False, False, False),
        }[self.kind]
        given = (self.column is not None, self.granularity is not None,
                 any(b is not None for b in bounds))
        for label, want, have in zip(("a column", "a granularity", "start/end/interval"), allowed, given):
            if want != have:
                raise SpecError(f"{self.kind.value} partitioning {'needs' if want else 'does not take'} {label}")
        if self.kind is PartitionKind.RANGE:
            if any(b is None for b in bounds):
                raise SpecError("range partitioning needs start, end and interval")
            if self.interval < 1 or self.end <= self.start:
                raise SpecError("range partitioning needs interval >= 1 and end > start")

    @classmethod
    def parse(cls, value: Any) -> "PartitionSpec | None":
        """``None``, ``"none"``, a column name (one partition per day) or a mapping."""
        if value is None or isinstance(value, cls):
            return value
        if isinstance(value, str):
            if value.strip().lower() == PartitionKind.NONE.value:
                return cls(PartitionKind.NONE)
            return cls(PartitionKind.TIME, value, Granularity.DAY)
        if not isinstance(value, Mapping):
            raise SpecError(f"partition must be a name or a mapping, not {type(value).__name__}")
        _reject_unknown(value, ("field", "type", "granularity", "range"), "partition")
        if "type" not in value:
            raise SpecError("partition mapping needs a 'type'")
        kind = PartitionKind.of(value["type"])
        granularity = value.get("granularity")
        if kind is PartitionKind.TIME and granularity is None:
            granularity = Granularity.DAY
        limits = value.get("range") or {}
        _reject_unknown(limits, ("start", "end", "interval"), "partition range")
        return cls(kind, value.get("field"), granularity, **{k: int(v) for k, v in limits.items()})

    def describe(self) -> str:
        if self.kind is PartitionKind.TIME:
            return f"{self.column} (TIME/{self.granularity.value.upper()})"
        if self.kind is PartitionKind.RANGE:
            return f"{self.column} (RANGE {self.start}..{self.end}/{self.interval})"
        if self.kind is PartitionKind.INGESTION:
            return f"{SYNCED_AT} (INGESTION/DAY)"
        return "none"

    def to_json(self) -> dict[str, Any]:
        out = {k: getattr(self, k) for k in ("kind", "column", "granularity", "start", "end", "interval")}
        return {k: getattr(v, "value", v) for k, v in out.items() if v is not None}


@dataclass(frozen=True)
class StreamSpec:
    """One output table: its key, how it is loaded and how it advances."""

    name: str
    table: str | None = None
    key: tuple[str, ...] = ()
    disposition: Disposition = Disposition.APPEND
    incremental: Incremental | None = None
    schema: T.StructType | None = None
    partition: Any = None
    contract: Contract = Contract.EVOLVE
    drift: Drift = Drift.WARN
    last_by: tuple[str, ...] = ()
    buckets: int = 0

    def __post_init__(self):
        put = lambda k, v: object.__setattr__(self, k, v)
        put("table", check_name(self.table or self.name, "table"))
        put("key", (self.key,) if isinstance(self.key, str) else tuple(self.key))
        put("last_by", (self.last_by,) if isinstance(self.last_by, str) else tuple(self.last_by))
        put("disposition", Disposition.of(self.disposition))
        put("contract", Contract.of(self.contract))
        put("drift", Drift.of(self.drift))
        if isinstance(self.partition, Mapping) or self.partition == PartitionKind.NONE.value:
            put("partition", PartitionSpec.parse(self.partition))
        if self.disposition is Disposition.MERGE and not self.key:
            raise SpecError(f"stream {self.name!r}: merge needs a primary key")
        if self.schema is not None:
            for part in self.key:
                if part not in self.schema.names:
                    raise SpecError(f"stream {self.name!r}: key column {part!r} is not in the schema")
            if self.incremental is not None and self.incremental.column not in self.schema.names:
                raise SpecError(f"stream {self.name!r}: cursor column "
                                f"{self.incremental.column!r} is not in the schema")

    def mode(self, requested: str | RunMode | None = None, full_refresh: bool = False) -> RunMode:
        """The run flag wins, then the requested mode, then what the stream can do."""
        if full_refresh:
            return RunMode.FULL_REFRESH
        if requested is not None:
            requested = RunMode.of(requested)
            if requested is RunMode.INCREMENTAL and self.incremental is None:
                raise SpecError(f"stream {self.name!r} declares no cursor, so it cannot run incrementally")
            return requested
        return RunMode.INCREMENTAL if self.incremental is not None else RunMode.FULL_REFRESH

    def resolve_partition(self, schema: T.StructType, override: Any = None) -> tuple[PartitionSpec | None, str | None]:
        """The partition spec in force, and a warning when a request was dropped.

        Order: override, declared spec, declared column name where it is a day or
        a timestamp, a day per cursor value, none.
        """
        explicit = PartitionSpec.parse(override)
        if explicit is None and isinstance(self.partition, PartitionSpec):
            explicit = self.partition
        if explicit is not None:
            return (None if explicit.kind is PartitionKind.NONE else explicit), None
        inc = self.incremental
        by_time = (CursorType.TIMESTAMP, CursorType.DATE)
        if self.partition is not None:
            name = self.partition
            known = {f.name: logical_type(f) for f in schema.fields}.get(name)
            fits = known in (None, FieldType.TIMESTAMP, FieldType.DATE)
            if inc is not None and inc.column == name and inc.type not in by_time:
                fits = False
            if fits:
                return PartitionSpec.parse(name), None
            return None, f"{self.name}: {name} is neither a date nor a timestamp; use a range partition"
        if inc is None:
            return None, None
        if inc.type in by_time:
            return PartitionSpec.parse(inc.column), None
        return None, f"{self.name}: a {inc.type.value} cursor has no default partitioning"


def parse_ids(raw: str, strip_prefix: str = "", strip_chars: str = "") -> list[str]:
    """Comma-separated ids, cleaned, each kept once in the order given."""
    ids: dict[str, None] = {}
    for token in str(raw).split(","):
        token = token.strip().removeprefix(strip_prefix)
        for ch in strip_chars:
            token = token.replace(ch, "")
        if token:
            ids[token] = None
    if not ids:
        raise SpecError("the id list is empty")
    return list(ids)
