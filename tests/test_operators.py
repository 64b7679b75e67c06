"""Normalize policies, schema operators, dedupe and merge on small frames."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation, functions as F

from millrace.operators import page_audit as A
from millrace.operators.schema import widened_union
from millrace.operators import normalize as N, schema as H, selection as S, upsert as U
from millrace.spec import SpecError, table_schema

SCHEMA = table_schema(("id", "INTEGER", "REQUIRED"), ("amount", "FLOAT"), ("active", "BOOLEAN"),
                      ("seen_at", "TIMESTAMP"), ("day", "DATE"), ("gone", "STRING"))
RAW = [("1", "1.5", "yes", "2024-01-05T00:00:00Z", "2024-01-05", "e"), ("x", "", "maybe", "nope", "2024-1-5", "f"),
       (None, "n/a", "0", "1717200000", "", None)]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(RAW, "id string, amount string, active string, seen_at string, day string, extra string")


def test_warn_turns_misfits_into_null_and_reports_them(raw):
    out = N.normalize(raw, SCHEMA)
    assert out.columns == ["id", "amount", "active", "seen_at", "day", "gone", "extra"]
    rows = [r.asDict() for r in out.collect()]
    assert [r["id"] for r in rows] == [1, None, None] and [r["amount"] for r in rows] == [1.5, None, None]
    assert [r["active"] for r in rows] == [True, None, False] and rows[0]["extra"] == "e"
    report = {(r.column_name, r.kind): r.cells for r in N.drift_report(raw, SCHEMA).collect()}
    assert report == {("id", "type_mismatch"): 1, ("amount", "type_mismatch"): 1, ("active", "type_mismatch"): 1,
                      ("seen_at", "type_mismatch"): 1, ("day", "type_mismatch"): 1, ("gone", "missing_column"): 3,
                      ("extra", "new_column"): 3}


def test_observed_counts_equal_the_report(raw):
    seen = Observation()
    N.observe_drift(raw, SCHEMA, seen).write.format("noop").mode("overwrite").save()
    rows = N.drift_rows(seen.get, raw, SCHEMA)
    mismatches = {(c, k): n for c, k, n in rows if k == "type_mismatch"}
    report = {(r.column_name, r.kind): r.cells for r in N.drift_report(raw, SCHEMA).collect()}
    assert mismatches == {k: v for k, v in report.items() if k[1] == "type_mismatch"} and seen.get["rows"] == 3


def test_fail_names_column_value_and_type(raw):
    with pytest.raises(PySparkException) as error:
        N.normalize(raw.select("id"), table_schema(("id", "INTEGER")), "fail").collect()
    assert "column id" in str(error.value) and "'x'" in str(error.value) and "INTEGER" in str(error.value)
    clean = raw.filter("id = '1'").select("id")
    assert N.normalize(clean, table_schema(("id", "INTEGER")), "fail").first().id == 1


def test_injected_drift_is_counted(spark):
    rng = random.Random(7)
    cells = [rng.choice(["1", "2.0", "bad", "", None, "1.5"]) for _ in range(500)]
    df = spark.createDataFrame([(c,) for c in cells], "n string")
    report = N.drift_report(df, table_schema(("n", "INTEGER"))).collect()
    assert report[0].cells == sum(c in ("bad", "1.5") for c in cells)


def test_drift_samples_show_a_few_misfits_of_each_column(raw, spark):
    shown = {(r.column_name, r.value): r.cells for r in N.drift_samples(raw, SCHEMA).collect()}
    counts = {r.column_name: r.cells for r in N.drift_report(raw, SCHEMA).collect() if r.kind == "type_mismatch"}
    assert {c for c, _ in shown} == set(counts) and ("id", "x") in shown
    many = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 'same' WHEN id % 3 = 1 THEN 'v' || id ELSE '7' END AS n", "repeat('z', 1000) AS m")
    schema = table_schema(("n", "INTEGER"), ("m", "FLOAT"))
    three = N.drift_samples(many, schema).collect()
    assert [len([r for r in three if r.column_name == c]) for c in "nm"] == [3, 1]
    assert [(r.value, r.cells) for r in three if r.column_name == "m"] == [("z" * N.SAMPLE_CHARS, 3000)]
    assert {(r.column_name, r.value) for r in N.drift_samples(many.repartition(7), schema).collect()} == {(r.column_name, r.value) for r in three}
    every = {r.value: r.cells for r in N.drift_samples(many, schema, most=5000).collect() if r.column_name == "n"}
    assert every["same"] == 1000 and len(every) == 1001 and sum(every.values()) == 2000
    assert N.drift_samples(many.limit(0), schema).count() == 0 and N.drift_samples(many, table_schema(("gone", "INTEGER"))).count() == 0


def test_inference_rules(spark):
    bodies = ['{"a": "abc", "b": null, "c": 1, "d": true}', '{"a": 5, "b": 1.5, "c": 2.5, "d": true, "e": [1]}',
              '{"a": true, "e": {"x": 1}}']
    df = spark.createDataFrame(list(enumerate(bodies)), "i int, body string")
    got = lambda rule: {r.column_name: r.type for r in H.infer_json_columns(df, "body", ["i"], rule).collect()}
    assert got("widest") == {"a": "STRING", "b": "FLOAT", "c": "FLOAT", "d": "BOOLEAN", "e": "JSON"}
    assert got("first") == {"a": "INTEGER", "b": "FLOAT", "c": "INTEGER", "d": "BOOLEAN", "e": "JSON"}


def test_strict_evolved_required(spark):
    df = spark.createDataFrame([(1, "a")], "id bigint, z string")
    with pytest.raises(H.SchemaError, match="z"):
        H.check_strict(df, table_schema(("id", "INTEGER")), "s")
    grown = H.evolved(table_schema(("id", "INTEGER")), df.schema)
    assert grown.names == ["id", "z"]
    with pytest.raises(H.SchemaError, match="id"):
        H.evolved(table_schema(("id", "STRING")), df.schema)
    with pytest.raises(SpecError):
        H.evolved(table_schema(("id", "INTEGER")), spark.createDataFrame([(1,)], "`a b` int").schema)
    nulls = spark.createDataFrame([(None,), (1,)], "id bigint")
    assert H.required_nulls(nulls, table_schema(("id", "INTEGER", "REQUIRED"))).collect()[0].nulls == 1
    with pytest.raises(PySparkException, match="REQUIRED"):
        H.require(nulls, table_schema(("id", "INTEGER", "REQUIRED"))).collect()


def test_ragged_union_keeps_first_seen_order_and_makes_clashes_text(spark):
    a = spark.createDataFrame([(1, True)], "id bigint, flag boolean")
    b = spark.createDataFrame([("x", "y")], "id string, name string")
    out = H.ragged_union(a, b)
    assert out.columns == ["id", "flag", "name"]
    assert sorted(map(tuple, out.collect()), key=str) == [("1", True, None), ("x", None, "y")]


def test_keep_last(spark):
    df = spark.createDataFrame([(1, 10, 0), (2, 20, 1), (1, 30, 2), (None, 1, 3), (None, 2, 4)], "k int, v int, seq int")
    assert sorted(((r.k, r.v) for r in U.keep_last(df, ["k"], ["seq"]).collect()), key=str) == [(1, 30), (2, 20), (None, 2)]


def test_keep_last_prunes_before_the_shuffle(spark):
    plan = U.keep_last(spark.range(10).selectExpr("id % 2 AS k", "id"), ["k"], ["id"])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("seed", range(3))
def test_merge_equals_a_dict(spark, seed):
    """Against brute force, including NULL keys and columns the source lacks."""
    rng = random.Random(seed)
    make = lambda n, tag: {k: (k, f"{tag}{k}", rng.randint(0, 9)) for k in rng.sample(range(60), n)}
    old, new = make(30, "o"), make(25, "n")
    target = spark.createDataFrame([*old.values(), (None, "onull", 1)], "k int, a string, b int")
    source = spark.createDataFrame([*new.values(), (None, "nnull", 2)], "k int, a string, b int")
    nulls = [(None, "onull", 1), (None, "nnull", 2)]
    got = sorted(map(tuple, U.merge(target, source, ["k"]).collect()), key=str)
    assert got == sorted([*{**old, **new}.values(), *nulls], key=str)
    narrow = U.merge(target, source.drop("b"), ["k"])
    kept = [(k, new[k][1] if k in new else old[k][1], old[k][2] if k in old else None) for k in {**old, **new}]
    expected = sorted([*kept, (None, "onull", 1), (None, "nnull", None)], key=str)
    assert sorted(map(tuple, narrow.collect()), key=str) == expected
    wide = U.merge(target.drop("b"), source, ["k"])
    assert wide.columns == ["k", "a", "b"] and wide.filter("k IS NOT NULL").count() == len({**old, **new})


def test_merge_is_idempotent_and_key_only_tables_only_insert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    once = U.merge(target, source, ["k"])
    assert sorted(map(tuple, U.merge(once, source, ["k"]).collect())) == sorted(map(tuple, once.collect()))
    keys = U.merge(target.select("k"), source.select("k"), ["k"])
    assert sorted(r.k for r in keys.collect()) == [1, 2, 3]
    assert U.duplicate_keys(once, ["k"]).isEmpty()
    with pytest.raises(SpecError):
        U.merge(target, source, [])


def test_merge_with_one_hot_null_key(spark):
    hot = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    out = U.merge(hot, spark.createDataFrame([(1, -1), (None, -2)], "k bigint, v bigint"), ["k"])
    assert out.count() == 3001 and out.filter("k = 1 AND v = -1").count() == 1


@pytest.mark.parametrize("seed", range(3))
def test_bootstrap_slices_cover_the_table_once(spark, seed):
    """Ties at a slice's end stay together; the slices are the sorted table cut up."""
    rng = random.Random(seed)
    rows = [(rng.randint(0, 12), rng.randint(0, 3), i) for i in range(300)] + [(5, 1, 1000 + i) for i in range(100)]
    df = spark.createDataFrame(rows, "a int, b int, v int").repartition(5)
    seen, last = [], None
    while True:
        part, end = S.bootstrap_slice(df, ["a", "b"], last, max_rows=70)
        got = [tuple(r) for r in part.collect()]
        rest = sorted(r[:2] for r in rows if last is None or r[:2] > last)
        assert end == (rest[69] if len(rest) >= 70 else None)
        seen += got
        if end is None:
            break
        assert max(r[:2] for r in got) == end
        last = end
    assert sorted(seen) == sorted(rows)


def test_after_key_needs_a_whole_key(spark):
    with pytest.raises(SpecError):
        S.after_key(spark.range(1), ["id"], (1, 2))


def test_newer_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).write.parquet(path)
    df = spark.read.parquet(path)
    plan = S.newer(df, "id", 50)._jdf.queryExecution().toString()
    assert "GreaterThan(id,50)" in plan
    assert S.newer(df, "id", 50).count() == 49 and S.newer(df, "id", 50, inclusive=True).count() == 50
    assert S.newer(df, "id", None).count() == 100


def brute_chain(rows):
    """(pages, in order, cyclic, orphans) of one endpoint, by walking each page back."""
    by = {}
    for cursor, following in rows:
        if following is not None:
            known = by.get(following, ())
            by[following] = min(known, (cursor is not None, cursor or "")) if known else (cursor is not None, cursor or "")
    known = {c for c, _ in rows}
    out = {"in_order": 0, "cyclic": 0, "orphans": 0}
    for cursor, _ in rows:
        at, steps = cursor, 0
        while at is not None and at in by and steps <= len(rows):
            later, before = by[at]
            at, steps = (before if later else None), steps + 1
        kind = "cyclic" if steps > len(rows) else "in_order" if at is None else "orphans"
        out[kind] += 1
    forks = sum(1 for c in known if sum(x == c for x, _ in rows) > 1 or sum(f == c for _, f in rows if f is not None) > 1)
    breaks = sum(1 for _, f in rows if f is not None and f not in known)
    return len(rows), out["in_order"], breaks, forks, out["orphans"], out["cyclic"]


@pytest.mark.parametrize("seed", range(2))
def test_chains_of_pages_against_a_walk(spark, seed):
    rng = random.Random(seed)
    rows = {}
    for endpoint in range(12):
        n = rng.randint(1, 40)
        chain = [(None if p == 0 else f"c{p}", f"c{p + 1}" if p + 1 < n else None) for p in range(n)]
        for _ in range(rng.randint(0, 3)):
            p = rng.randrange(n)
            chain[p] = (chain[p][0] if rng.random() < 0.6 else f"c{rng.randrange(1, 45)}", rng.choice([None, f"c{rng.randrange(1, 45)}"]))
        rows[endpoint] = chain
    df = spark.createDataFrame([(e, c, f) for e, chain in rows.items() for c, f in chain], "endpoint int, cursor string, next string")
    got = {r.endpoint: (r.pages, r.in_order, r.breaks, r.forks, r.orphans, r.cyclic) for r in A.chain_report(df).collect()}
    assert got == {e: brute_chain(chain) for e, chain in rows.items()}


def test_rounds_of_long_chains_move_numbers_only(spark, monkeypatch):
    n = 3000
    walk = [(1, f"page {p}" if p else None, f"page {p + 1}") for p in range(n)]
    circle = [(2, f"page {p}", f"page {(p + 1) % n}") for p in range(n)] + [(2, None, "lost"), (2, "page 5", "side"), (2, "side", None)]
    df = spark.createDataFrame([*walk, *circle, (3, "stray", "")], "endpoint int, cursor string, next string")
    tables = []
    monkeypatch.setattr(A, "settled", lambda rows, label, kept=A.settled: tables.append((label, rows.dtypes)) or kept(rows, label))
    got = {tuple(r) for r in A.chain_report(df).collect()}
    assert got == {(1, n, n, n, 1, 0, 0, 0), (2, n + 3, 1, 1, 1, 1, 0, n + 2), (3, 1, 0, 0, 1, 0, 1, 0)}
    rounds = [kind for label, columns in tables if label == "chain" for _, kind in columns]
    assert rounds and set(rounds) <= {"bigint", "boolean"}


def test_common_types(spark):
    a = spark.createDataFrame([(1, 1, "2024-01-01", 5)], "i int, n int, d string, t int").withColumn("d", F.to_date("d"))
    b = spark.createDataFrame([(2 ** 40, 1.5, "2024-01-02 03:00:00", "x")], "i bigint, n double, d string, t string").withColumn("d", F.to_timestamp("d"))
    out = widened_union(a, b)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["bigint", "double", "timestamp", "string"]
    assert sorted((r.i, r.n, r.t) for r in out.collect()) == [(1, 1.0, "5"), (2 ** 40, 1.5, "x")]
