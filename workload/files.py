"""File source: the tables written out as files, then read back as new arrivals."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from millrace.load import load_frame
from millrace.operators.normalize import normalize
from millrace.sinks.files import list_names, scratch
from millrace.sinks.tables import TargetTable
from millrace.sources.files import FILE_CURSOR, read_files
from millrace.sources.tables import all_text
from millrace.spec import StreamSpec, table_schema

from .base import day, query, sql_day, table

_ORDER = "o_orderkey, o_custkey, o_orderstatus, o_totalprice"
_TYPES = table_schema(("o_orderkey", "INTEGER"), ("o_custkey", "INTEGER"), ("o_orderstatus", "STRING"),
                      ("o_totalprice", "FLOAT"))


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query("csv_all_string", f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END
           AS o_orderstatus, 'say "' || o_orderpriority || '",' || chr(10) || 'twice' AS note, {sql_day('o_orderdate')} AS day
    FROM orders""")
def csv_all_string(spark, sf):
    """Quotes, commas and line breaks inside cells; every cell comes back as text."""
    note = F.concat(F.lit('say "'), "o_orderpriority", F.lit('",\ntwice'))
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).otherwise("").alias("o_orderstatus"),
        note.alias("note"), day("o_orderdate").alias("day"))
    path = scratch(spark, "csv")
    rows.write.option("header", "true").option("escape", '"').option("quoteAll", "true").csv(path)
    return read_files(spark, path).drop(FILE_CURSOR)


@query("csv_no_header", "SELECT CAST(c_custkey AS VARCHAR) AS col_0, c_mktsegment AS col_1 FROM customer")
def csv_no_header(spark, sf):
    path = scratch(spark, "tsv")
    table(spark, sf, "customer").select("c_custkey", "c_mktsegment").write.option("sep", "\t").csv(path)
    return read_files(spark, path, delimiter="\t", header=False, multiline=False).drop(FILE_CURSOR)


@query("files_mixed", f"SELECT {_ORDER} FROM orders")
def files_mixed(spark, sf):
    """Three formats in one folder tree, united by name and normalized."""
    path, orders = scratch(spark, "mixed"), _orders(spark, sf)
    part = lambda s: orders.filter(F.col("o_orderstatus") == s)
    all_text(part("F")).write.option("header", "true").csv(f"{path}/a")
    part("O").write.json(f"{path}/b/c")
    part("P").write.parquet(f"{path}/d")
    return normalize(read_files(spark, path, "**/*").drop(FILE_CURSOR), _TYPES)


@query("jsonl_ragged", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice END AS price,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status FROM orders""")
def jsonl_ragged(spark, sf):
    """Objects with different keys, and blank lines between them."""
    path = scratch(spark, "jsonl")
    line = F.expr("""CASE WHEN o_orderstatus = 'P' THEN concat('{"o_orderkey":', o_orderkey, ',"price":', o_totalprice, '}')
                     ELSE concat('{"o_orderkey":', o_orderkey, ',"status":"', o_orderstatus, '"}\\n\\n') END""")
    _orders(spark, sf).select(line.alias("value")).write.text(path)
    return read_files(spark, path, "**/*.txt", fmt="jsonl").drop(FILE_CURSOR)


@query("files_new_by_name", """
    SELECT o_orderkey, CAST(o_orderkey % 7 AS VARCHAR) AS slot FROM orders WHERE o_orderkey % 7 > 2""")
def files_new_by_name(spark, sf):
    """One file a slot, named after it; files up to the cursor name are not read, so their
    other columns and types don't matter."""
    path, orders = scratch(spark, "byname"), _orders(spark, sf)
    slot = F.col("o_orderkey") % 7
    for i in range(7):
        rows = orders.filter(slot == i).select("o_orderkey", slot.cast("string").alias("slot"))
        if i <= 2:
            rows = rows.select(F.col("o_orderkey").cast("string"), F.lit(i).alias("slot"), F.lit("old").alias("gone"))
        rows.coalesce(1).write.json(f"{path}/tmp{i}")
        _named(spark, f"{path}/tmp{i}", f"{path}/slot-{i}.json")
    return read_files(spark, path, "*.json", fmt="jsonl", cursor="name", since="slot-2.json").drop(FILE_CURSOR)


@query("file_cursor", """
    SELECT 'slot-' || (o_orderkey % 3) || '.csv' AS file, COUNT(*) AS rows FROM orders GROUP BY 1""")
def file_cursor(spark, sf):
    """The name that stamps each row."""
    path, orders = scratch(spark, "stamp"), _orders(spark, sf)
    for i in range(3):
        all_text(orders.filter(F.col("o_orderkey") % 3 == i)).coalesce(1).write.option("header", "true").csv(f"{path}/tmp{i}")
        _named(spark, f"{path}/tmp{i}", f"{path}/slot-{i}.csv")
    rows = read_files(spark, path, "*.csv", cursor="name", multiline=False)
    return rows.groupBy(F.col(FILE_CURSOR).alias("file")).agg(F.count(F.lit(1)).alias("rows"))


@query("csv_one_column", """
    SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE '' END AS note, COUNT(*) AS rows FROM orders GROUP BY 1""")
def csv_one_column(spark, sf):
    """A cell that is missing stays NULL and an empty one empty, also when nothing else is selected."""
    path = scratch(spark, "short")
    line = F.when(F.col("o_orderstatus") == "P", F.col("o_orderkey").cast("string")).otherwise(F.concat("o_orderkey", F.lit(",")))
    body = _orders(spark, sf).select(line.alias("value"))
    body.write.text(f"{path}/rows")
    rows = read_files(spark, f"{path}/rows", "*.txt", fmt="csv", header=False, multiline=False)
    return rows.select(F.col("col_1").alias("note")).groupBy("note").agg(F.count(F.lit(1)).alias("rows"))


def _named(spark, folder, target):
    """Give the single file of a written folder a name."""
    name = next(n for n in list_names(spark, folder) if n.startswith("part-"))
    jvm = spark._jvm
    source = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    source.getFileSystem(spark._jsc.hadoopConfiguration()).rename(source, jvm.org.apache.hadoop.fs.Path(target))


@query("files_new_by_time", f"SELECT {_ORDER} FROM orders")
def files_new_by_time(spark, sf):
    """Everything is newer than a day-old cursor, nothing newer than tomorrow's."""
    path, now = scratch(spark, "bytime"), datetime.now(timezone.utc)
    _orders(spark, sf).write.parquet(path)
    later = read_files(spark, path, "**/*.parquet", since=now + timedelta(days=1))
    if later is not None:
        raise AssertionError("files from before the cursor were read")
    return read_files(spark, path, "**/*.parquet", since=now - timedelta(days=1)).drop(FILE_CURSOR)


@query("files_types_differ", """
    SELECT o_orderkey, o_custkey, o_totalprice, CASE o_orderstatus WHEN 'F' THEN CAST(o_orderkey AS VARCHAR)
               WHEN 'O' THEN 'no ' || o_orderkey ELSE NULL END AS note FROM orders""")
def files_types_differ(spark, sf):
    """Parquet files that type one column as int, bigint and text, another as bigint and double, a third as number and text,
    read as one source and loaded."""
    path, orders = scratch(spark, "types"), _orders(spark, sf)
    part = lambda s: orders.filter(F.col("o_orderstatus") == s)
    key = lambda kind: F.col("o_orderkey").cast(kind).alias("o_orderkey")
    part("F").select(key("int"), "o_custkey", "o_totalprice", F.col("o_orderkey").alias("note")).write.parquet(f"{path}/f")
    part("O").select(key("string"), F.col("o_custkey").cast("double"), "o_totalprice",
                     F.concat(F.lit("no "), "o_orderkey").alias("note")).write.parquet(f"{path}/o")
    part("P").select(key("bigint"), F.col("o_custkey").cast("int"), "o_totalprice").write.parquet(f"{path}/p")
    spec = StreamSpec("typed", partition="none", schema=table_schema(
        ("o_orderkey", "INTEGER"), ("o_custkey", "INTEGER"), ("o_totalprice", "FLOAT"), ("note", "STRING")))
    load_frame(spark, f"{path}/store", spec, read_files(spark, path, "**/*.parquet").drop(FILE_CURSOR))
    return TargetTable(spark, f"{path}/store", "typed").read().select("o_orderkey", "o_custkey", "o_totalprice", "note")
