"""Loads into a schema of the session catalog."""

import uuid

import pytest

from millrace.load import Stream, load_frame, read_runs, run
from millrace.sinks.catalog import CatalogTable, destination
from millrace.sinks.tables import TargetTable
from millrace.sources.tables import read_table
from millrace.spec import Incremental, StreamSpec, table_schema

ITEMS = table_schema(("id", "INTEGER"), ("label", "STRING"), ("day", "DATE"))


@pytest.fixture
def namespace(spark, tmp_path):
    name = f"ns_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{tmp_path}'")
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


def items(spark, *cells):
    return spark.createDataFrame(list(cells), "id bigint, label string, day string")


def seen(spark, namespace, *columns):
    return sorted((tuple(str(r[c]) for c in columns) for r in CatalogTable(spark, namespace, "items").read().collect()))


def test_the_root_names_the_kind_of_table(spark, root):
    assert isinstance(destination(spark, "catalog:x", "t"), CatalogTable) and isinstance(destination(spark, root, "t"), TargetTable)


@pytest.mark.parametrize("how", ["append", "replace"])
def test_append_and_replace(spark, namespace, how):
    spec = StreamSpec("items", schema=ITEMS, disposition=how, partition="none")
    load_frame(spark, f"catalog:{namespace}", spec, items(spark, (1, "a", "2024-01-01")))
    assert load_frame(spark, f"catalog:{namespace}", spec, items(spark, (2, "b", None), (3, "c", None))).rows_loaded == 2
    assert [r[0] for r in seen(spark, namespace, "id")] == (["1", "2", "3"] if how == "append" else ["2", "3"])
    load_frame(spark, f"catalog:{namespace}", spec, items(spark).limit(0) if how == "append" else items(spark, (9, "x", None)).limit(0))
    assert len(seen(spark, namespace, "id")) == (3 if how == "append" else 0)


def test_merge_moves_rows_and_drops_emptied_partitions(spark, namespace):
    spec = StreamSpec("items", schema=ITEMS, disposition="merge", key="id", partition={"field": "day", "type": "time", "granularity": "day"})
    root = f"catalog:{namespace}"
    load_frame(spark, root, spec, items(spark, (1, "a", "2024-01-01"), (2, "b", "2024-01-02"), (None, "n", "2024-01-03")))
    more = items(spark, (2, "B", "2024-01-04"), (3, "c", "2024-01-01")).selectExpr("*", "id * 2 AS extra")
    load_frame(spark, root, spec, more)
    assert seen(spark, namespace, "id", "label", "day", "extra") == [
        ("1", "a", "2024-01-01", "None"), ("2", "B", "2024-01-04", "4"), ("3", "c", "2024-01-01", "6"), ("None", "n", "2024-01-03", "None")]
    parts = {r[0] for r in spark.sql(f"SHOW PARTITIONS {namespace}.items").collect()}
    assert parts == {"_part=2024-01-01", "_part=2024-01-03", "_part=2024-01-04"}
    # a batch without a column keeps its old values
    load_frame(spark, root, spec, items(spark, (3, "C", "2024-01-01")).drop("day"))
    assert ("3", "C", "2024-01-01", "6") in seen(spark, namespace, "id", "label", "day", "extra")


def test_runs_resume_at_the_cursor_and_are_recorded(spark, namespace):
    spec = StreamSpec("items", schema=ITEMS, partition="none", incremental=Incremental("id", "int"))
    root = f"catalog:{namespace}"
    for n, want in ((2, 2), (5, 3), (5, 0)):
        source = items(spark, *[(i, "x", None) for i in range(n)])
        result = run(spark, root, [Stream(spec, lambda s, ctx: read_table(source, "id", ctx.floor))], source="echo")
        assert result.record_error is None and result.raise_for_status().rows_loaded == want
    assert read_runs(spark, root).count() == 3
    assert CatalogTable(spark, namespace, "items").state("echo", "items")["cursor_value"] == "4"
