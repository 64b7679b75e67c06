import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.functions import payloads as P, values as V
from millrace.operators import page_audit as A, shaping as S
from millrace.operators.schema import infer_json_columns
from millrace.spec import SpecError


def records(spark, extract, body, path=None):
    df = spark.createDataFrame([(json.dumps(body) if not isinstance(body, str) else body,)], "body string")
    out = extract(df, "body", path) if path is not None else extract(df, "body")
    return [json.loads(r[0]) for r in out.select(F.to_json("record")).collect()]


def nested(steps, value):
    """A body with ``value`` under the given names."""
    for name in reversed(steps):
        value = {name: value}
    return value


WARDS = ["clinic", "wards"]
BEDS = ["clinic", "wards", "*", "bed"]
FULL, SPARE = {"bed_no": 11, "ward": "east"}, {"bed_no": 12}


@pytest.mark.parametrize("body,path,want", [
    (nested(WARDS, [FULL, SPARE]), WARDS, [FULL, SPARE]),
    (nested(WARDS, [{"bed": FULL}, {"bed": SPARE, "floor": 3}]), BEDS, [FULL, SPARE]),
    (nested(WARDS, [None, {"bed": SPARE}, {"bed": None}]), BEDS, [SPARE]),
    (nested(WARDS, None), WARDS, []), (nested(WARDS, []), WARDS, []),
    ([SPARE], [], [SPARE]), ([None, FULL], ["*"], [FULL]),
    (nested(["dot.ted", "two words"], [FULL]), ["dot.ted", "two words"], [FULL])])
def test_record_path(spark, body, path, want):
    assert records(spark, P.extract_records, body, path) == want


@pytest.mark.parametrize("body,path", [
    (nested(["clinic", "rooms"], [FULL]), WARDS), (nested(WARDS, FULL), WARDS), (nested(WARDS, ["east"]), WARDS),
    (nested(["clinic"], None), WARDS), (nested(WARDS, [{"cot": FULL}]), BEDS), (nested(WARDS, [{"bed": "11"}]), BEDS),
    (nested(WARDS, None), BEDS), (nested(WARDS, [0.5]), BEDS), ('["clinic"', ["clinic"])])
def test_record_path_is_strict(spark, body, path):
    with pytest.raises(Exception):
        records(spark, P.extract_records, body, path)


def test_record_path_takes_one_wildcard(spark):
    with pytest.raises(SpecError):
        records(spark, P.extract_records, {}, ["clinic", "*", "wards", "*"])


@pytest.mark.parametrize("body,path,want", [
    (nested(WARDS, [{"cot": 1}, {"bed": FULL}, {"bed": "11"}, None]), BEDS, [FULL]),
    (nested(["clinic"], {}), BEDS, []), (nested(["clinic"], [FULL]), BEDS, []),
    ([nested(["wards"], [SPARE]), nested(["wards"], [FULL])], ["*", "wards", "*"], [SPARE, FULL]),
    (nested(["clinic"], FULL), ["clinic"], [FULL])])
def test_record_path_lenient(spark, body, path, want):
    assert records(spark, P.extract_records_lenient, body, path) == want


def test_a_broken_body_is_an_error_and_can_be_set_aside(spark):
    df = spark.createDataFrame([('["clinic"',), ('{"clinic": [{"bed_no": 11}]}',), (None,)], "body string")
    assert [r.body for r in P.unreadable_bodies(df, "body").collect()] == ['["clinic"']
    for strict in (P.extract_records_lenient(df, "body", ["clinic", "*"]), infer_json_columns(df, "body")):
        with pytest.raises(Exception, match="MALFORMED_RECORD"):
            strict.collect()
    readable = df.exceptAll(P.unreadable_bodies(df, "body"))
    assert P.extract_records_lenient(readable, "body", ["clinic", "*"]).count() == 1


def test_envelopes(spark):
    one = [{"id": 1}]
    for body in (one, {"success": True, "data": one}):
        assert records(spark, P.unwrap_data, body) == one
    assert records(spark, P.unwrap_data, {"data": None}) == records(spark, P.unwrap_data, {}) == []
    for bad in ({"data": 7.25}, "5", "null"):
        with pytest.raises(PySparkException):
            records(spark, P.unwrap_data, bad)
    assert records(spark, P.unwrap_results, {"results": one}) == one
    assert records(spark, P.unwrap_results, {"value": {"results": one}}) == one
    with pytest.raises(PySparkException):
        records(spark, P.unwrap_results, {"value": None})
    assert records(spark, P.unwrap_chunks, [{"results": one}, {}, {"results": None}, {"results": one}]) == one + one
    with pytest.raises(PySparkException):
        records(spark, P.unwrap_chunks, {"results": one})


def test_dotted(spark):
    rows = [('{"meta":{"next":"abc"}}', "abc"), ('{"meta":{"next":""}}', None), ('{"meta":{}}', None),
            ('{"meta":null}', None), ('{"meta":{"next":5}}', "5"), ("[1]", None)]
    df = spark.createDataFrame(rows, "body string, want string")
    assert all(r.got == r.want for r in df.select(P.dotted(F.col("body"), "meta.next").alias("got"), "want").collect())


def test_values(spark):
    cells = [("13:00:00 - 13:59:59", 13), ("0:00:00 - 0:59:59", 0), ("24:00:00 - 24:59:59", None), ("unknown", None),
             ("", None), (None, None), ("13", None)]
    df = spark.createDataFrame(cells, "x string, want bigint")
    assert all(r.got == r.want for r in df.select(V.hour_of_range(F.col("x")).alias("got"), "want").collect())
    numbers = [("1.9", 1), ("-1.9", -1), ("", None), ("n/a", None), (None, None), ("1e3", 1000), ("nan", None), ("inf", None)]
    df = spark.createDataFrame(numbers, "x string, want bigint")
    assert [r.got for r in df.select(V.lenient_int(F.col("x")).alias("got")).collect()] == [n for _, n in numbers]
    literals = [("2024-01-05T10:00:00Z", "2024-01-05 10:00:00"), ("2024-01-05T10:00:00.123+02:00", "2024-01-05 10:00:00"),
                ("2024-01-05", "2024-01-05"), (" 2024-01-05 10:00:00.5 ", "2024-01-05 10:00:00")]
    df = spark.createDataFrame(literals, "x string, want string")
    assert all(r.got == r.want for r in df.select(V.sql_timestamp_text(F.col("x")).alias("got"), "want").collect())
    redacted = spark.range(1).select(V.redact(F.lit("key=hunter2 abc hunter2"), ["hunter2", "abc"]).alias("t")).first().t
    assert redacted == "key=*** abc ***"


def test_audit_of_one_hot_endpoint(spark):
    """A single endpoint of many pages: complete, then with a page lost."""
    pages = spark.range(1, 5001).selectExpr(
        "'hot' AS endpoint", "id AS page",
        """CASE WHEN id < 5000 THEN concat('{"next":"', id, '"}') ELSE '{"next":null}' END AS body""")
    verdict = lambda df: A.walk_report(A.cursor_rule(df, "next")).first().asDict()
    assert verdict(pages)["verdict"] == "complete"
    assert verdict(pages.filter("page <> 77"))["verdict"] == "gap"
    assert verdict(pages.filter("page < 5000"))["verdict"] == "truncated"
    plan = A.cursor_rule(pages, "next")._jdf.queryExecution().toString()
    assert "Window" not in plan


def test_label_measures(spark):
    from datetime import datetime, timezone
    body = {"measures": [{"display_name": "Revenue"}, {"name": "txn"}, {}],
            "values": [{"cohort": 86400, "measure": 0, "value": 1.5, "incomplete": True}, {"cohort": 0, "value": 2},
                       {"cohort": 0, "measure": 1, "value": 3}, {"cohort": 0, "measure": 2}, {"cohort": 0, "measure": 9},
                       {"cohort": None, "measure": 0}, {"cohort": 0, "measure": -1}]}
    df = spark.createDataFrame([(json.dumps(body),)], "body string")
    rows = S.label_measures(df, "body", datetime(2024, 1, 1, tzinfo=timezone.utc)).collect()
    assert [(str(r.cohort_date), r.measure_name, r.value, r.incomplete) for r in rows] == [
        ("1970-01-02", "Revenue", 1.5, True), ("1970-01-01", "Revenue", 2.0, False), ("1970-01-01", "txn", 3.0, False),
        ("1970-01-01", "measure_2", None, False), ("1970-01-01", "measure_9", None, False),
        ("1970-01-01", "measure_-1", None, False)]


def test_projections(spark):
    df = spark.createDataFrame([(1, "x")], "id int, junk string")
    assert S.allow_list(df, ["id", "nope"]).columns == ["id"]
    assert S.fixed_list(df, ["id", "nope"]).first().asDict() == {"id": 1, "nope": None}
