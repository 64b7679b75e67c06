from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import types as T

from millrace.sources.native_types import logical_of_native, native_types, schema_of_columns
from millrace.spec import (FieldType, Incremental, Mode, PartitionSpec, RunMode, SpecError, StreamSpec, check_name,
                           column, field_mode, logical_type, parse_ids, parse_lookback, table_schema, typed_cursor,
                           with_synced_at)

UTC = timezone.utc


def test_schema_carries_logical_type_mode_and_description():
    schema = table_schema(("id", "integer", "required"), {"name": "tags", "type": "STRING", "mode": "REPEATED"},
                          column("doc", "JSON", description="raw"))
    assert schema["id"].dataType == T.LongType() and field_mode(schema["id"]) is Mode.REQUIRED
    assert schema["tags"].dataType == T.ArrayType(T.StringType())
    assert logical_type(schema["doc"]) is FieldType.JSON and schema["doc"].metadata["description"] == "raw"
    again = T.StructType.fromJson(schema.jsonValue())
    assert logical_type(again["doc"]) is FieldType.JSON
    stamped = with_synced_at(schema)
    assert stamped.names[-1] == "_synced_at" and with_synced_at(stamped) == stamped


@pytest.mark.parametrize("bad", [{"name": "x"}, {"type": "STRING"}, {"name": "x", "type": "STRING", "size": 3},
                                 {"name": "x", "type": "DECIMAL"}])
def test_schema_rejects(bad):
    with pytest.raises(SpecError):
        table_schema(bad)


@pytest.mark.parametrize("name", ["1a", "a b", "a-b", "", 'x"; DROP', "é"])
def test_names_are_guarded(name):
    with pytest.raises(SpecError):
        check_name(name)


@pytest.mark.parametrize("text,kind,want", [
    ("2d", "timestamp", timedelta(days=2)), ("30m", "timestamp", timedelta(minutes=30)), ("1w", "date", timedelta(days=7)),
    ("6h", "date", timedelta(days=1)), ("25h", "date", timedelta(days=2)), ("0s", "date", timedelta(days=1)),
    ("6h", "int", 21600), ("100", "int", 100), (" 5 m ", "int", 300)])
def test_lookback(text, kind, want):
    assert parse_lookback(text, kind) == want


@pytest.mark.parametrize("text,kind", [("2d", "string"), ("2", "timestamp"), ("d", "date"), ("-2d", "int"), ("2y", "int")])
def test_lookback_rejects(text, kind):
    with pytest.raises(SpecError):
        parse_lookback(text, kind)


def test_seed():
    inc = Incremental("ts", "timestamp", initial="2024-01-01", lookback="6h")
    start = datetime(2024, 1, 1, tzinfo=UTC)
    assert inc.seed() == start
    assert inc.seed("2024-01-02T06:00:00+00:00") == datetime(2024, 1, 2, tzinfo=UTC)
    assert inc.seed("2024-01-02T00:00:00+00:00", since="2023-05-05") == datetime(2023, 5, 5, tzinfo=UTC)
    assert inc.seed("2024-01-02T00:00:00+00:00", since="2023-05-05", full_refresh=True) is None
    assert Incremental("n", "int").seed() is None and Incremental("n", "int", initial="0").seed() == 0


def test_cursor_never_moves_back_and_compares_across_shapes():
    inc = Incremental("ts", "timestamp")
    assert inc.advance(datetime(2024, 1, 1), "2024-01-02T00:00:00+00:00") == datetime(2024, 1, 2, tzinfo=UTC)
    assert inc.advance(None, "2024-01-02") == datetime(2024, 1, 2, tzinfo=UTC)
    assert Incremental("d", "date").advance(date(2024, 1, 3), "2024-01-02") == date(2024, 1, 3)
    assert Incremental("n", "int").advance(90, "100") == 100
    assert Incremental("n", "int").advance(None, None) is None
    assert typed_cursor("2024-01-05T10:00:00", "date") == date(2024, 1, 5)


def test_partition_spec_parsing():
    assert PartitionSpec.parse("day_col").describe() == "day_col (TIME/DAY)"
    assert PartitionSpec.parse({"type": "time", "field": "t"}).granularity.value == "day"
    assert PartitionSpec.parse({"type": "range", "field": "n", "range": {"start": 0, "end": 10, "interval": 5}}
                               ).describe() == "n (RANGE 0..10/5)"
    assert PartitionSpec.parse(" None ").describe() == "none"
    assert PartitionSpec.parse({"type": "ingestion"}).column is None


@pytest.mark.parametrize("bad", [
    {"type": "time"}, {"field": "x"}, {"type": "range", "field": "n"}, {"type": "ingestion", "field": "x"},
    {"type": "time", "field": "x", "range": {"start": 0, "end": 1, "interval": 1}}, {"type": "none", "field": "x"},
    {"type": "range", "field": "n", "granularity": "day", "range": {"start": 0, "end": 1, "interval": 1}},
    {"type": "range", "field": "n", "range": {"start": 0, "end": 1}}, {"type": "time", "field": "x", "size": 1},
    {"type": "range", "field": "n", "range": {"start": 0, "end": 1, "interval": 0}}, 5])
def test_partition_spec_rejects(bad):
    with pytest.raises((SpecError, TypeError)):
        PartitionSpec.parse(bad)


def test_partition_resolution_order():
    schema = table_schema(("ts", "TIMESTAMP"), ("n", "INTEGER"))
    by_ts, by_n = Incremental("ts", "timestamp"), Incremental("n", "int")
    describe = lambda spec, over=None: (lambda r: (r[0].describe() if r[0] else None, r[1] is not None))(
        spec.resolve_partition(schema, over))
    assert describe(StreamSpec("s", incremental=by_ts)) == ("ts (TIME/DAY)", False)
    assert describe(StreamSpec("s", incremental=by_n)) == (None, True)
    assert describe(StreamSpec("s")) == (None, False)
    assert describe(StreamSpec("s", incremental=by_ts, partition="none")) == (None, False)
    assert describe(StreamSpec("s", partition="n")) == (None, True)
    assert describe(StreamSpec("s", partition="ts")) == ("ts (TIME/DAY)", False)
    assert describe(StreamSpec("s", incremental=by_n, partition="n")) == (None, True)
    month = {"type": "time", "field": "ts", "granularity": "month"}
    assert describe(StreamSpec("s", incremental=by_ts, partition=month)) == ("ts (TIME/MONTH)", False)
    assert describe(StreamSpec("s", incremental=by_ts, partition=month), {"type": "ingestion"}) == (
        "_synced_at (INGESTION/DAY)", False)


def test_stream_rules():
    with pytest.raises(SpecError):
        StreamSpec("s", disposition="merge")
    with pytest.raises(SpecError):
        StreamSpec("s", schema=table_schema(("a", "STRING")), incremental=Incremental("b"))
    with pytest.raises(SpecError):
        StreamSpec("s").mode("incremental")
    spec = StreamSpec("s", key="id", incremental=Incremental("ts"))
    assert spec.key == ("id",) and spec.table == "s"
    assert spec.mode() is RunMode.INCREMENTAL and spec.mode("incremental", full_refresh=True) is RunMode.FULL_REFRESH
    assert StreamSpec("s").mode() is RunMode.FULL_REFRESH


def test_native_types():
    assert logical_of_native(" BIGINT ") is FieldType.INTEGER and logical_of_native("uuid") is FieldType.STRING
    assert logical_of_native("array", "cockroachdb") is FieldType.JSON
    assert "serial" not in native_types("cockroachdb") and "oid" not in native_types("postgres")
    assert len(native_types("postgres")) == 36
    with pytest.raises(SpecError):
        logical_of_native("money")
    schema = schema_of_columns([("id", "bigint", "NO"), ("doc", "jsonb", "YES")])
    assert field_mode(schema["id"]) is Mode.REQUIRED and logical_type(schema["doc"]) is FieldType.JSON
    with pytest.raises(SpecError):
        schema_of_columns([])


def test_id_lists():
    assert parse_ids(" act_1, 2 ,act_1,,3", strip_prefix="act_") == ["1", "2", "3"]
    assert parse_ids("123-456-7890", strip_chars="-") == ["1234567890"]
    with pytest.raises(SpecError):
        parse_ids(" , ")
