"""Tables, commits, cursors and runs, end to end."""

import json
import time
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from millrace.load import Context, Stream, load_frame, read_runs, run, run_stream, settle, stream
from millrace.operators import reports as R
from millrace.operators.partitioning import PartitionMismatch
from millrace.operators.schema import SchemaError, stamped
from millrace.operators.upsert import key_cover
from millrace.sinks import files, tables
from millrace.sinks.tables import TargetTable, read_state, reset_state
from millrace.operators import selection
from millrace.sources import bootstrap
from millrace.sources.bootstrap import read_with_bootstrap
from millrace.sources.tables import all_text, jdbc_options, read_query, read_sql, read_table
from millrace.spec import Incremental, SpecError, StreamSpec, table_schema
from millrace.streaming.ingest import file_stream, ingest

AT = datetime(2024, 6, 1, tzinfo=timezone.utc)
ITEMS = table_schema(("id", "INTEGER", "REQUIRED"), ("label", "STRING"), ("updated_at", "INTEGER"))
MERGED = StreamSpec("items", key="id", disposition="merge", schema=ITEMS,
                    incremental=Incremental("updated_at", "int", initial=0))


def rows(root, spark, name="items", *columns, version=None):
    out = TargetTable(spark, root, name).read(version)
    return sorted(map(tuple, out.select(*(columns or ("id", "label", "updated_at"))).collect()), key=str)


def items(spark, *cells):
    return spark.createDataFrame(list(cells), "id bigint, label string, updated_at bigint")


def test_second_run_loads_nothing_new(spark, root):
    source = items(spark, *[(i, f"item-{i}", i) for i in range(1, 6)])
    one = Stream(MERGED, lambda s, ctx: read_table(source, "updated_at", ctx.floor))
    first = run(spark, root, [one], source="echo")
    assert first.status == "succeeded" and first.rows_loaded == 5 and first.streams[0].cursor_after == 5
    second = run(spark, root, [one], source="echo")
    assert second.rows_loaded == 0 and second.streams[0].cursor_before == 5
    assert len(rows(root, spark)) == 5
    state = read_state(spark, root, "echo").first()
    assert (state.cursor_value, state.cursor_type, state.rows_total) == ("5", "int", 5)
    runs = read_runs(spark, root)
    assert runs.count() == 2 and R.recent_runs(runs, 1).first().run_id == second.run_id
    per_stream = R.run_streams(R.one_run(runs, first.run_id)).first()
    assert (per_stream.name, per_stream.rows_loaded, per_stream.cursor_after) == ("items", 5, "5")
    events = R.read_events(spark, f"{root}/_logs/{first.run_id}.jsonl")
    assert [r.event for r in events.collect()] == ["run_start", "stream_start", "batch_loaded", "stream_committed", "run_end"]


def test_counts_before_and_after_dedupe(spark, root):
    df = items(spark, (1, "a", 10), (2, "b", 20), (1, "c", 30))
    result = load_frame(spark, root, MERGED, df)
    assert (result.rows_extracted, result.rows_loaded, result.cursor_after) == (3, 2, 30)
    assert rows(root, spark) == [(1, "c", 30), (2, "b", 20)]


def test_cursor_floor_lookback_since_and_full_refresh(spark, root):
    spec = StreamSpec("items", key="id", disposition="merge", schema=ITEMS,
                      incremental=Incremental("updated_at", "int", initial=0, lookback="10"))
    seeds = []

    def reading(df):
        def read(_, ctx: Context):
            seeds.append(ctx.floor)
            return read_table(df, "updated_at", ctx.floor)
        return Stream(spec, read)

    run_stream(spark, root, reading(items(spark, (1, "a", 100))))
    again = run_stream(spark, root, reading(items(spark, (2, "b", 95))))
    assert seeds == [0, 90] and again.cursor_after == 100 and again.rows_loaded == 1
    once = run_stream(spark, root, reading(items(spark, (3, "c", 20))), since=5)
    assert seeds[-1] == 5 and once.cursor_after == 100
    run_stream(spark, root, reading(items(spark, (4, "d", 500))), full_refresh=True)
    assert seeds[-1] is None and read_state(spark, root).first().cursor_value == "100"
    assert len(rows(root, spark)) == 4


def test_failed_stream_leaves_rows_and_cursor(spark, root):
    strict = StreamSpec("items", key="id", disposition="merge", schema=ITEMS, drift="fail",
                        incremental=Incremental("updated_at", "int", initial=0))
    load_frame(spark, root, strict, items(spark, (1, "a", 1)), source="s")
    bad = spark.createDataFrame([("2", "b", "2"), ("oops", "c", "3")], "id string, label string, updated_at string")
    other = Stream(StreamSpec("other", schema=ITEMS), lambda s, c: items(spark, (1, "x", 1)))
    result = run(spark, root, [Stream(strict, lambda s, c: bad), other], source="s", secrets=["oops"])
    assert result.status == "failed" and [s.status for s in result.streams] == ["failed", "skipped"]
    with pytest.raises(Exception, match="oops"):
        result.raise_for_status()
    assert rows(root, spark) == [(1, "a", 1)] and read_state(spark, root).first().cursor_value == "1"
    log = files.read_text(spark, f"{root}/_logs/{result.run_id}.jsonl")
    assert "oops" not in log and "***" in log
    assert read_runs(spark, root).first().status == "failed"


def test_append_replace_empty_and_none(spark, root):
    append = StreamSpec("items", schema=ITEMS)
    load_frame(spark, root, append, items(spark, (1, "a", 1)))
    load_frame(spark, root, append, items(spark, (1, "a", 1)))
    assert len(rows(root, spark)) == 2 and rows(root, spark, version=0) == [(1, "a", 1)]
    replace = StreamSpec("items", schema=ITEMS, disposition="replace")
    load_frame(spark, root, replace, items(spark, (7, "z", 7)))
    assert rows(root, spark) == [(7, "z", 7)]
    load_frame(spark, root, replace, None)
    assert rows(root, spark) == [(7, "z", 7)]
    load_frame(spark, root, replace, items(spark, (7, "z", 7)).limit(0))
    assert rows(root, spark) == [] and len(rows(root, spark, version=1)) == 2


def test_evolution_strict_and_missing_columns(spark, root):
    load_frame(spark, root, MERGED, items(spark, (1, "a", 1), (2, "b", 2)))
    wider = spark.createDataFrame([(2, 5, "new")], "id bigint, updated_at bigint, extra string")
    result = load_frame(spark, root, MERGED, wider)
    assert rows(root, spark, "items", "id", "label", "updated_at", "extra") == [(1, "a", 1, None), (2, "b", 5, "new")]
    assert ("extra", "new_column", 0) in result.drift and ("label", "missing_column", 0) in result.drift
    strict = StreamSpec("other", schema=ITEMS, contract="strict")
    with pytest.raises(SchemaError):
        load_frame(spark, root, strict, wider)
    odd = table_schema(("id", "INTEGER"), ("label", "INTEGER"), ("updated_at", "INTEGER"))
    with pytest.raises(SchemaError):
        load_frame(spark, root, StreamSpec("items", schema=odd, key="id", disposition="merge"), items(spark, (1, "5", 9)))


@pytest.mark.parametrize("layout", [{"partition": {"type": "time", "field": "day", "granularity": "day"}},
                                    {"partition": {"type": "range", "field": "id", "range": {"start": 0, "end": 40, "interval": 10}}},
                                    {"buckets": 4}, {"partition": {"type": "ingestion"}}, {}])
def test_merge_by_layout_equals_a_dict(spark, root, layout):
    """Rows may change partition; untouched partitions are not rewritten."""
    schema = table_schema(("id", "INTEGER"), ("day", "DATE"), ("v", "STRING"))
    spec = StreamSpec("t", key="id", disposition="merge", schema=schema, last_by="v", **layout)
    frame = lambda cells: spark.createDataFrame(cells, "id bigint, day string, v string")
    first = [(i, f"2024-01-{1 + i % 9:02d}", "old") for i in range(50)]
    second = [(i, f"2024-01-{20 + i % 3}", "up") for i in range(3, 30, 9)] + [(100, None, "ins")]
    load_frame(spark, root, spec, frame(first), run_at=AT)
    load_frame(spark, root, spec, frame(second), run_at=AT)
    want = {r[0]: r for r in first} | {r[0]: r for r in second}
    got = sorted((r.id, str(r.day) if r.day else None, r.v) for r in TargetTable(spark, root, "t").read().collect())
    assert got == sorted(want.values())
    pointer = TargetTable(spark, root, "t").pointer()
    if "time" in str(layout):
        commits = {p: c for p, c in pointer["parts"].items()}
        assert commits["2024-01-01"] != commits["2024-01-04"] and len(set(map(str, commits.values()))) == 2


def test_null_keys_are_inserted_and_counted(spark, root):
    spec = StreamSpec("t", key="id", disposition="merge", schema=table_schema(("id", "INTEGER"), ("v", "STRING")))
    df = spark.createDataFrame([(None, "a"), (1, "b")], "id bigint, v string")
    assert load_frame(spark, root, spec, df).null_key_rows == 1
    load_frame(spark, root, spec, df)
    assert TargetTable(spark, root, "t").read().filter("id IS NULL").count() == 2


def test_partition_change_and_conflicting_publish(spark, root):
    load_frame(spark, root, StreamSpec("t", schema=ITEMS), items(spark, (1, "a", 1)))
    with pytest.raises(PartitionMismatch):
        load_frame(spark, root, StreamSpec("t", schema=ITEMS, partition={"type": "ingestion"}), items(spark, (1, "a", 1)))
    table = TargetTable(spark, root, "t")
    with pytest.raises(files.AlreadyExists):
        table._publish({**table.pointer()})
    assert rows(root, spark, "t") == [(1, "a", 1)]


def test_state_reset_keeps_rows_and_reads_all_again(spark, root):
    one = Stream(MERGED, lambda s, ctx: read_table(items(spark, (1, "a", 1)), "updated_at", ctx.floor))
    run_stream(spark, root, one)
    assert TargetTable(spark, root, "items").reset_state() and not TargetTable(spark, root, "items").reset_state()
    assert read_state(spark, root).isEmpty() and len(rows(root, spark)) == 1
    assert run_stream(spark, root, one).rows_loaded == 1


def test_state_blob_and_given_cursor(spark, root):
    @stream(MERGED)
    def walk(session, ctx):
        ctx.state["page"] = ctx.state.get("page", 0) + 1
        ctx.reached = 10 * ctx.state["page"]
        return items(spark, (ctx.state["page"], "p", 1))

    assert run_stream(spark, root, walk).cursor_after == 10 and run_stream(spark, root, walk).cursor_after == 20
    blob = read_state(spark, root).first().state_blob
    assert json.loads(blob) == {"page": 2}


def test_session_zone_is_checked(spark, root):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(SpecError):
            load_frame(spark, root, MERGED, items(spark, (1, "a", 1)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_sql_sources(spark):
    t = items(spark, (1, "a", 1), (2, "b", 2))
    assert read_query(spark, "SELECT id, updated_at FROM {t};", "updated_at", 1, t=t).count() == 1
    assert read_sql(spark, "SELECT * FROM {t} WHERE label > {since}", {"since": "a'"}, t=t).count() == 1
    with pytest.raises(SpecError):
        read_sql(spark, "SELECT * FROM {t} WHERE id > {nope}", {"since": 1}, t=t)
    with pytest.raises(SpecError):
        read_query(spark, "SELECT 1", None)
    assert [r.updated_at for r in all_text(t).collect()] == ["1", "2"]


def test_jdbc_options():
    at = datetime(2024, 1, 5, 10, tzinfo=timezone.utc)
    plain = jdbc_options("jdbc:x", table="public.users", fetch_size=7)
    assert plain == {"url": "jdbc:x", "dbtable": "public.users", "fetchsize": "7"}
    past = jdbc_options("jdbc:x", table="users", cursor="updated_at", floor=at, as_of="'-5s'")
    assert past["dbtable"] == ("(SELECT * FROM users AS OF SYSTEM TIME '-5s' "
                               "WHERE updated_at > '2024-01-05 10:00:00') t")
    query = jdbc_options("jdbc:x", query="SELECT 1;", cursor="n", floor=5, inclusive=True)
    assert query["dbtable"] == "(SELECT * FROM (SELECT 1) q WHERE n >= 5) t"
    split = jdbc_options("jdbc:x", table="t", split_on="id", bounds=(0, 100), partitions=4)
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "4"
    for bad in ({}, {"table": "t", "query": "q"}, {"table": "t", "split_on": "id"}):
        with pytest.raises(SpecError):
            jdbc_options("jdbc:x", **bad)


def test_stream_is_applied_once_per_batch(spark, root, tmp_path):
    landing = str(tmp_path / "in")
    spec = StreamSpec("items", schema=ITEMS)
    go = lambda: ingest(file_stream(spark, landing, items(spark, (0, "", 0)).schema),
                        root, spec, str(tmp_path / "cp")).awaitTermination()
    items(spark, (1, "a", 1)).write.mode("append").parquet(landing)
    go()
    go()
    assert len(rows(root, spark)) == 1
    items(spark, (2, "b", 2)).write.mode("append").parquet(landing)
    go()
    assert rows(root, spark) == [(1, "a", 1), (2, "b", 2)]
    pointer = TargetTable(spark, root, "items").pointer()
    assert [*json.loads(next(iter(pointer["states"].values()))["state_blob"])["last_batches"].values()] == [1]


def test_unordered_stream_waits_for_the_end(spark, root, tmp_path):
    landing, schema = str(tmp_path / "in"), items(spark, (0, "", 0)).schema
    for ordered, name in ((False, "late"), (True, "early")):
        spec = StreamSpec(name, schema=ITEMS, incremental=Incremental("updated_at", "int", ordered=ordered))
        for batch in ((1, "a", 9), (2, "b", 4)):
            items(spark, batch).write.mode("append").parquet(f"{landing}/{name}")
            ingest(file_stream(spark, f"{landing}/{name}", schema), root, spec, str(tmp_path / name)).awaitTermination()
        state = read_state(spark, root).filter(F.col("stream") == name).first()
        assert state.cursor_value == ("9" if ordered else None) and state.rows_total == 2
        assert settle(spark, root, spec) == 9
        assert read_state(spark, root).filter(F.col("stream") == name).first().cursor_value == "9"


def test_bootstrap_then_steady_state(spark, root):
    """Pages of two, two pages a run: pauses at key 4, completes, hands over the global max."""
    cells = [(1, "a", 50), (2, "b", 20), (3, "c", 30), (4, "d", 40), (5, "e", 10)]
    source = {"rows": items(spark, *cells)}
    one = Stream(MERGED, lambda s, ctx: read_with_bootstrap(ctx, source["rows"], ["id"], page_rows=2, max_pages=2))
    blob = lambda: json.loads(read_state(spark, root).first().state_blob)
    assert run_stream(spark, root, one).rows_loaded == 4
    assert blob() == {"bootstrapped": False, "bootstrap_last_pk": [4], "bootstrap_cursor_max": 50,
                      "bootstrap_cursor_start": 50, "bootstrap_ends": [None]}
    done = run_stream(spark, root, one)
    assert done.rows_loaded == 1 and done.cursor_after == 50 and blob()["bootstrapped"]
    source["rows"] = items(spark, *cells, (6, "f", 60))
    assert run_stream(spark, root, one).rows_loaded == 1
    assert len(rows(root, spark)) == 6


def test_reset_of_a_source_counts_its_streams(spark, root):
    for name, source in (("a", "x"), ("b", "x"), ("c", "y")):
        load_frame(spark, root, StreamSpec(name, schema=ITEMS), items(spark, (1, "a", 1)), source=source)
    assert reset_state(spark, root, "x", "a") == 1 and reset_state(spark, root, "x") == 1
    assert [r.stream for r in read_state(spark, root).collect()] == ["c"]


def test_as_of_a_moment(spark, root):
    spec = StreamSpec("items", schema=ITEMS)
    load_frame(spark, root, spec, items(spark, (1, "a", 1)))
    between = datetime.now(timezone.utc)
    load_frame(spark, root, spec, items(spark, (2, "b", 2)))
    table = TargetTable(spark, root, "items")
    assert table.version_at(between) == 0 and table.version_at(datetime.now(timezone.utc)) == 1
    with pytest.raises(ValueError):
        table.version_at(datetime(2000, 1, 1))


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
def test_cursors_do_not_depend_on_the_drivers_zone(spark, root, monkeypatch, zone):
    monkeypatch.setenv("TZ", zone)
    time.tzset()
    try:
        source = spark.sql("SELECT id, TIMESTAMP '2024-03-01 12:00:00Z' + make_interval(0, 0, 0, id) AS at FROM range(4)")
        spec = StreamSpec("timed", incremental=Incremental("at", "timestamp"), partition="none")
        one = Stream(spec, lambda _, ctx: read_table(source, "at", ctx.floor))
        assert run_stream(spark, root, one).rows_loaded == 4
        assert read_state(spark, root).first().cursor_value == "2024-03-04T12:00:00+00:00"
        assert run_stream(spark, root, one).rows_loaded == 0
        swept = StreamSpec("swept", key="at", disposition="merge", incremental=Incremental("at", "timestamp"), partition="none",
                           schema=table_schema(("id", "INTEGER"), ("at", "TIMESTAMP")))
        sweep = Stream(swept, lambda _, ctx: read_with_bootstrap(ctx, source, ["at"], page_rows=1, max_pages=1))
        loaded = [run_stream(spark, root, sweep).rows_loaded for _ in range(5)]
        assert sum(loaded) == 4 and TargetTable(spark, root, "swept").read().count() == 4
    finally:
        monkeypatch.undo()
        time.tzset()


def test_values_bind_as_they_are(spark):
    rows = spark.createDataFrame([("TRIAL", 1.5, "U.S."), ("OTHER", 1.0, "UTC")], "a string, b double, c string")
    got = read_sql(spark, "SELECT a FROM {t} WHERE a = {kind} AND b = {least} AND c = {land}",
                   {"kind": "TRIAL", "least": 1.5, "land": "U.S."}, t=rows)
    assert [r.a for r in got.collect()] == ["TRIAL"]
    table = jdbc_options("jdbc:x", table="t", cursor="name", floor="O'Brien. T", as_of="now()")["dbtable"]
    assert table.endswith("WHERE name > 'O''Brien. T') t")


def test_secrets_are_masked_before_they_are_escaped(spark, root):
    def fail(_, ctx):
        raise RuntimeError('login with pa"ss and hunter22 failed')
    result = run(spark, root, [Stream(MERGED, fail)], source="s", secrets=['pa"ss', "hunter22"])
    assert result.status == "failed"
    log = files.read_text(spark, f"{root}/_logs/{result.run_id}.jsonl")
    row = read_runs(spark, root).first()
    for text in (log, row.error_message if "error_message" in row.asDict() else str(row)):
        assert "hunter22" not in text and 'pa"ss' not in text and 'pa\\"ss' not in text


def test_pointer_and_log_stay_bounded(spark, root, monkeypatch):
    monkeypatch.setattr(tables, "TIDY_EVERY", 5)
    monkeypatch.setattr(tables, "MOST_COMMITS", 3)
    monkeypatch.setattr(tables, "KEEP_VERSIONS", 4)
    table = TargetTable(spark, root, "small")
    frame = lambda i: stamped(spark.createDataFrame([(i,)], "id int"), F.lit(AT).cast("timestamp"))
    for i in range(23):
        table.commit(frame(i), "append", state={"connector": "c", "stream": "s", "cursor_value": str(i)})
    versions = table.versions()
    assert len(versions) <= 4 + 5 and max(len(c) for c in table.pointer()["parts"].values()) <= 3 + 5
    assert sorted(r.id for r in table.read().collect()) == list(range(23))
    ids = {v: len(table.read(v).collect()) for v in versions}
    assert all(0 < n <= 23 for n in ids.values()) and ids[versions[-1]] == 23
    assert table.state("c", "s")["cursor_value"] == "22"
    folders = files.list_names(spark, f"{root}/small/data")
    assert len(folders) <= 3 + 2 * 5 + 4
    with pytest.raises(ValueError):
        table.read(0)
    spark.range(1).write.parquet(f"{root}/small/data/_commit=failed")
    table.tidy()
    assert "_commit=failed" in files.list_names(spark, f"{root}/small/data")
    table.tidy(orphan_hours=0)
    assert "_commit=failed" not in files.list_names(spark, f"{root}/small/data")
    assert table.read().count() == 23


def test_streams_in_parallel(spark, root):
    def stream_of(name, n):
        spec = StreamSpec(name, schema=ITEMS, partition="none", incremental=Incremental("updated_at", "int"))
        return Stream(spec, lambda _, ctx: read_table(items(spark, *[(i, name, i) for i in range(n)]), "updated_at", ctx.floor))
    result = run(spark, root, [stream_of(f"s{i}", i + 1) for i in range(4)], source="p", parallel=3)
    assert result.status == "succeeded" and [s.rows_loaded for s in result.streams] == [1, 2, 3, 4]
    assert {r.stream: r.cursor_value for r in read_state(spark, root, "p").collect()} == {f"s{i}": str(i) for i in range(4)}

    def fail(_, ctx):
        raise RuntimeError("gone")
    broken = [stream_of("s0", 9), Stream(StreamSpec("bad"), fail)]
    result = run(spark, root, broken, source="p", parallel=2)
    assert result.status == "failed" and [s.status for s in result.streams] == ["succeeded", "failed"]
    with pytest.raises(SpecError):
        run(spark, root, [stream_of("s0", 1)] * 2, parallel=2)


def test_a_sweep_is_planned_once_and_ends_where_it_began(spark, root, monkeypatch):
    """Ten slices from one plan; rows that change behind the sweep are read again, whatever cursor it saw later."""
    plans = []
    real = selection.sweep_ends
    monkeypatch.setattr(selection, "sweep_ends", lambda *a, **k: plans.append(1) or real(*a, **k))
    cells = [(i, "old", i % 37) for i in range(1, 101)]
    source = {"rows": items(spark, *cells)}
    one = Stream(MERGED, lambda s, ctx: read_with_bootstrap(ctx, source["rows"], ["id"], page_rows=10, max_pages=1))
    loaded = [run_stream(spark, root, one).rows_loaded for _ in range(4)]
    # 5 is behind the sweep, 95 ahead of it; the sweep sees the cursor of 95 and must not skip that of 5
    source["rows"] = items(spark, *[(i, "new", 50) if i == 5 else (i, "new", 90) if i == 95 else (i, l, u) for i, l, u in cells])
    loaded += [run_stream(spark, root, one).rows_loaded for _ in range(7)]
    assert loaded == [10] * 10 + [0] and len(plans) == 1
    done = run_stream(spark, root, one)
    assert done.cursor_before == 36 and done.rows_loaded == 2 and done.cursor_after == 90
    assert [r for r in rows(root, spark) if r[1] == "new"] == [(5, "new", 50), (95, "new", 90)]


def test_a_long_sweep_is_planned_again(spark, root, monkeypatch):
    monkeypatch.setattr(bootstrap, "PLANNED", 3)
    source = items(spark, *[(i // 2, "x", i) for i in range(40)])
    spec = StreamSpec("items", schema=ITEMS, incremental=Incremental("updated_at", "int"), partition="none")
    one = Stream(spec, lambda s, ctx: read_with_bootstrap(ctx, source, ["id"], page_rows=3, max_pages=1))
    loaded = [run_stream(spark, root, one).rows_loaded for _ in range(14)]
    assert sum(loaded) == 40 and max(loaded) <= 4
    assert TargetTable(spark, root, "items").read().select("updated_at").distinct().count() == 40


def test_an_error_while_tidying_leaves_the_load_done(spark, root, monkeypatch):
    from millrace.sinks import tables
    monkeypatch.setattr(tables, "TIDY_EVERY", 1)
    monkeypatch.setattr(TargetTable, "tidy", lambda self: 1 / 0)
    spec = StreamSpec("items", schema=ITEMS)
    for i in range(3):
        assert load_frame(spark, root, spec, items(spark, (i, "a", i))).rows_loaded == 1
    assert len(rows(root, spark)) == 3


def test_runs_that_end_together_are_all_recorded(spark, root):
    from concurrent.futures import ThreadPoolExecutor
    from pyspark import inheritable_thread_target

    def go(i):
        spec = StreamSpec(f"items_{i}", schema=ITEMS)
        return run(spark, root, [Stream(spec, lambda s, ctx: items(spark, (i, "a", i)))], source="echo")

    with ThreadPoolExecutor(8) as pool:
        results = list(pool.map(inheritable_thread_target(spark)(go), range(8)))
    assert all(r.status == "succeeded" and r.record_error is None for r in results)
    assert {r.run_id for r in read_runs(spark, root).collect()} == {r.run_id for r in results}


def test_a_run_that_cannot_be_recorded_does_not_raise(spark, root, monkeypatch):
    import millrace.load
    monkeypatch.setattr(millrace.load, "record_run", lambda *a, **k: 1 / 0)
    one = Stream(StreamSpec("items", schema=ITEMS), lambda s, ctx: items(spark, (1, "a", 1)))
    result = run(spark, root, [one], source="echo")
    assert result.status == "succeeded" and isinstance(result.record_error, ZeroDivisionError) and len(rows(root, spark)) == 1


def test_events_keep_their_own_fields_and_lines_with_misfits(spark, root, tmp_path):
    path = str(tmp_path / "log.jsonl")
    with open(path, "w") as f:
        f.write('{"event": "user", "rows": "many", "note": "x", "order": {"id": 7}, "full_refresh": true}\n{"event": "run_end", "rows": 5, '
                '"duration_s": 1.5}\n{"event": "torn", "ro\n[1]\n\n')
    user, end = R.read_events(spark, path).orderBy(F.desc("event")).collect()
    assert (user.event, user.rows, user.full_refresh, user.fields) == ("user", None, True, {"rows": "many", "note": "x", "order": '{"id":7}'})
    assert (end.event, end.rows, end.duration_s, end.fields) == ("run_end", 5, 1.5, {})


def scanned(df):
    """Rows that the file scans of a run of ``df`` handed on."""
    df.collect()
    todo, total = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
            continue
        if node.nodeName().startswith("Scan"):
            total += node.metrics().apply("numOutputRows").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_a_merge_looks_for_moved_rows_in_a_few_files_only(spark, root):
    """Rows of 1 % of the keys, old and newest ones, leave their partition."""
    schema = table_schema(("id", "INTEGER", "REQUIRED"), ("shelf", "INTEGER"), ("label", "STRING"))
    spec = StreamSpec("stock", key="id", disposition="merge", schema=schema,
                      partition={"type": "range", "field": "shelf", "range": {"start": 0, "end": 200, "interval": 1}})
    first = spark.range(100_000).selectExpr("id", "id div 1000 AS shelf", "'old' AS label")
    load_frame(spark, root, spec, first, run_at=AT)
    table = TargetTable(spark, root, "stock")
    batch = spark.range(100_000).filter("id BETWEEN 3100 AND 3599 OR id >= 99500").selectExpr("id", "150L AS shelf", "'new' AS label")
    before = table.pointer()
    assert table._parts_of_keys(before, batch, ("id",)) == {"3", "99"}
    assert scanned(table._hits(before, batch, ("id",)).select("id")) < 10_000
    load_frame(spark, root, spec, batch, run_at=AT)
    after = table.read()
    assert after.count() == 100_000 and after.filter("label = 'new' AND shelf = 150").count() == 1000
    assert after.filter("label = 'old' AND shelf = id div 1000").count() == 99_000
    kept = {p: c for p, c in before["parts"].items() if p not in ("3", "99")}
    assert {p: c for p, c in table.pointer()["parts"].items() if p in kept} == kept


@pytest.mark.parametrize("kind", ["bigint", "string", "date", "decimal(12,2)", "double", "timestamp_ntz", "boolean"])
def test_a_cover_holds_every_key(spark, kind):
    made = {"date": "date_add(DATE'2020-01-01', CAST(id AS INT))", "timestamp_ntz": "TIMESTAMP_NTZ'2020-01-01' + make_dt_interval(0, CAST(id AS INT))",
            "boolean": "id % 2 = 0"}.get(kind, f"CAST(id AS {kind})")
    rows = spark.range(1000).selectExpr("id AS n", f"{made} AS k")
    batch = rows.filter("n IN (3, 4, 5, 990, 991)").select("k").union(spark.createDataFrame([(None,)], f"k {dict(rows.dtypes)['k']}"))
    near = rows.filter(key_cover(batch, ["k"]))
    assert {3, 4, 5, 990, 991} <= {r.n for r in near.collect()}
    if kind in ("bigint", "date", "decimal(12,2)"):
        assert near.count() == 5
    none = batch.filter("k IS NULL")
    assert rows.filter(key_cover(none, ["k"])).count() == (1000 if kind in ("double", "boolean") else 0)
