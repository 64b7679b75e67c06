import os
from datetime import datetime, timezone

import pytest

from millrace.load import Stream, run_stream
from millrace.sinks.tables import TargetTable, read_state
from millrace.sources.files import FILE_CURSOR, observed_file_cursor, read_files
from millrace.spec import Incremental, SpecError, StreamSpec


def put(folder, name, text, at=None):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    if at is not None:
        os.utime(path, (at, at))


def rows(df):
    return sorted((tuple(None if v is None else str(v) for v in r) for r in df.drop(FILE_CURSOR).collect()), key=str)


def test_csv_cells(spark, tmp_path):
    put(tmp_path, "a.csv", 'a,b,c\n1,,x\n\n2,"",y\n3,"said ""hi""\nnext",z\n4\n')
    assert rows(read_files(spark, str(tmp_path))) == [("1", "", "x"), ("2", "", "y"), ("3", 'said "hi"\nnext', "z"),
                                                      ("4", None, None)]


def test_csv_misquoting_is_an_error(spark, tmp_path):
    put(tmp_path, "a.csv", 'a,b\n1,"x"y\n')
    with pytest.raises(Exception, match="(?s)quote"):
        read_files(spark, str(tmp_path)).collect()


def test_csv_bad_bytes_are_replaced(spark, tmp_path):
    put(tmp_path, "a.csv", b"a\ncaf\xff\n")
    assert rows(read_files(spark, str(tmp_path))) == [("caf�",)]


def test_tsv_without_header(spark, tmp_path):
    put(tmp_path, "x/y/a.TSV", "1\tx\n2\ty\n")
    out = read_files(spark, str(tmp_path), "**/*", delimiter="\t", header=False)
    assert out.columns[:2] == ["col_0", "col_1"] and rows(out) == [("1", "x"), ("2", "y")]


def test_headers_that_differ(spark, tmp_path):
    put(tmp_path, "a.csv", "a,b\n1,2\n")
    put(tmp_path, "b.csv", "b,a\n3,4\n")
    put(tmp_path, "c.csv", "a,c\n5,6\n")
    with pytest.raises(Exception, match="(?s)[Hh]eader"):
        read_files(spark, str(tmp_path)).collect()
    out = read_files(spark, str(tmp_path), same_header=False)
    assert rows(out.select("a", "b", "c", FILE_CURSOR)) == [("1", "2", None), ("4", "3", None), ("5", None, "6")]


def test_json_lines(spark, tmp_path):
    put(tmp_path, "a.jsonl", '{"a": 1}\n\n  \n{"a": 2, "b": [1]}\n')
    assert rows(read_files(spark, str(tmp_path), "**/*.jsonl")) == [("1", None), ("2", "[1]")]
    for bad in ("[1, 2]", "5", "{torn"):
        put(tmp_path, "a.jsonl", '{"a": 1}\n' + bad + "\n")
        with pytest.raises(Exception):
            read_files(spark, str(tmp_path), "**/*.jsonl").collect()


def test_folders_in_patterns_and_unknown_endings(spark, tmp_path):
    put(tmp_path, "x/a.csv", "a\n1\n")
    put(tmp_path, "y/b.csv", "a\n2\n")
    put(tmp_path, "c.csv", "a\n3\n")
    assert rows(read_files(spark, str(tmp_path), "x/*.csv")) == [("1",)]
    assert rows(read_files(spark, str(tmp_path), "**/*.csv")) == [("1",), ("2",), ("3",)]
    assert rows(read_files(spark, str(tmp_path), "*.csv")) == [("3",)]
    assert read_files(spark, str(tmp_path), "z/*.csv") is None
    assert read_files(spark, str(tmp_path / "nowhere")) is None
    put(tmp_path, "x/d.dat", "a\n1\n")
    with pytest.raises(SpecError, match="dat"):
        read_files(spark, str(tmp_path), "**/*")
    assert rows(read_files(spark, str(tmp_path), "**/*.dat", fmt="csv")) == [("1",)]
    for bad in ({"fmt": "xml"}, {"cursor": "size"}):
        with pytest.raises(SpecError):
            read_files(spark, str(tmp_path), **bad)
    with pytest.raises(SpecError):
        read_files(spark, "gcs://bucket/x")


def test_formats_mix_and_clashing_types_become_text(spark, tmp_path):
    put(tmp_path, "a.csv", "id,v\n1,x\n")
    put(tmp_path, "b.json", '{"id": 2, "w": true}\n')
    spark.createDataFrame([(3, 1.5)], "id bigint, w double").write.parquet(str(tmp_path / "p"))
    for name in os.listdir(tmp_path / "p"):
        if not name.endswith(".parquet"):
            os.remove(tmp_path / "p" / name)
    out = read_files(spark, str(tmp_path), "**/*")
    assert rows(out.select("id", "v", "w", FILE_CURSOR)) == [("1", "x", None), ("2", None, "True"), ("3", None, "1.5")]


def test_only_newer_files_are_read(spark, tmp_path):
    put(tmp_path, "a.csv", "a\n1\n", at=1_700_000_000)
    put(tmp_path, "b.csv", "a\n2\n", at=1_700_000_000.25)
    put(tmp_path, "c.csv", "a\n3\n", at=1_700_000_100)
    cursor = datetime.fromtimestamp(1_700_000_000, timezone.utc)
    assert rows(read_files(spark, str(tmp_path), since=cursor)) == [("2",), ("3",)]
    assert rows(read_files(spark, str(tmp_path), since=cursor.isoformat())) == [("2",), ("3",)]
    for unset in (None, "", datetime(1970, 1, 1), "1970-01-01T00:00:00+00:00"):
        assert len(rows(read_files(spark, str(tmp_path), since=unset))) == 3
    assert rows(read_files(spark, str(tmp_path), cursor="name", since="a.csv")) == [("2",), ("3",)]
    named = read_files(spark, str(tmp_path), cursor="name")
    assert named.agg(observed_file_cursor()).first()[0] == "c.csv"
    assert read_files(spark, str(tmp_path), cursor="name", since="c.csv") is None


def test_files_as_an_incremental_stream(spark, tmp_path, root):
    folder = tmp_path / "in"
    put(folder, "a.csv", "a\n1\n", at=1_700_000_000)
    spec = StreamSpec("files", incremental=Incremental(FILE_CURSOR, "timestamp", initial="1970-01-01"), partition="none")
    one = Stream(spec, lambda s, ctx: read_files(s, str(folder), since=ctx.floor))
    assert run_stream(spark, root, one).rows_loaded == 1
    assert run_stream(spark, root, one).rows_loaded == 0
    put(folder, "b.csv", "a\n2\n", at=1_700_000_001)
    assert run_stream(spark, root, one).rows_loaded == 1
    assert sorted(r.a for r in TargetTable(spark, root, "files").read().collect()) == ["1", "2"]
    assert read_state(spark, root).first().cursor_value == "2023-11-14T22:13:21+00:00"


def test_a_row_with_too_many_cells_is_an_error(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "good.csv").write_text('a,b\n1,2\n3\n"x,y",\n')
    rows = read_files(spark, str(folder), multiline=False)
    assert sorted(map(tuple, rows.select("a", "b").collect()), key=str) == [("1", "2"), ("3", None), ("x,y", "")]
    assert sorted([r.b for r in rows.select("b").collect()], key=str) == ["", "2", None]
    for surplus in ("4,5,6", "4,5,", "4,,", '"4,5",6,"7,8"'):
        (folder / "long.csv").write_text(f"a,b\n{surplus}\n")
        for column in ("a", "b"):
            with pytest.raises(Exception, match="long.csv"):
                read_files(spark, str(folder), multiline=False).select(column).collect()


@pytest.mark.parametrize("lines, want", [
    (["1", "2,x", "3,"], {("1", None), ("2", "x"), ("3", "")}),
    (["1", '2,"a,b\nc"', "3"], {("1", None), ("2", "a,b\nc"), ("3", None)}),
    (["a,b", '"x,""y"",",z'], {("a", "b"), ('x,"y",', "z")}),
    (["one"], {("one",)})])
def test_the_longest_row_sets_the_columns_without_a_header(spark, tmp_path, lines, want):
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    got = read_files(spark, str(tmp_path), header=False).drop(FILE_CURSOR)
    assert {tuple(r) for r in got.collect()} == want
