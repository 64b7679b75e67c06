"""Schema operators: inference, contracts, additive evolution, required checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import coerce as C
from ..spec import (SYNCED_AT, FieldType, Mode, SpecError, check_name, column, field_mode,
                    logical_type, table_schema)


class SchemaError(SpecError):
    """Data and declared schema contradict each other."""


# --------------------------------------------------------------------------
# inference


def json_kind(value: Column) -> Column:
    """Logical type of one variant value; NULL for a null."""
    kind = F.schema_of_variant(value)
    return (F.when(kind == "BOOLEAN", F.lit(FieldType.BOOLEAN.value))
            .when(kind == "BIGINT", F.lit(FieldType.INTEGER.value))
            .when((kind == "DOUBLE") | (kind == "FLOAT") | kind.startswith("DECIMAL"),
                  F.lit(FieldType.FLOAT.value))
            .when(kind.startswith("TIMESTAMP"), F.lit(FieldType.TIMESTAMP.value))
            .when(kind == "DATE", F.lit(FieldType.DATE.value))
            .when(kind == "STRING", F.lit(FieldType.STRING.value))
            .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(FieldType.JSON.value)))


def infer_json_columns(df: DataFrame, body: str, order: Sequence[str] = (),
                       rule: str = "widest") -> DataFrame:
    """One row per key of the JSON objects in ``body``: ``column_name, type``.

    ``widest`` looks at every value: integers and floats give FLOAT, any other
    mixture STRING.  ``first`` lets the first value that is neither null nor text
    decide, in the order of the ``order`` columns.  A body that is no JSON ends the job.  Only per-key aggregates cross
    the shuffle, never the values of a key.
    """
    rank = F.struct(*[F.col(c) for c in order]) if order else F.lit(0)
    cells = (df.select(F.parse_json(F.col(body)).alias("__v"), rank.alias("__rank"))
             .lateralJoin(_exploded(df.sparkSession))
             .select("key", "__rank", "pos", json_kind(F.col("value")).alias("kind")))
    if rule == "first":
        if not order:
            raise SpecError("the 'first' rule needs order columns")
        typed = F.when(F.col("kind") != FieldType.STRING.value, F.col("kind"))
        decided = F.min_by(typed, F.when(typed.isNotNull(), F.col("__rank")))
        return cells.groupBy(F.col("key").alias("column_name")).agg(
            F.coalesce(decided, F.lit(FieldType.STRING.value)).alias("type"))
    if rule != "widest":
        raise SpecError(f"unknown inference rule {rule!r}")
    seen = F.collect_set("kind")
    numbers = F.array(F.lit(FieldType.INTEGER.value), F.lit(FieldType.FLOAT.value))
    grouped = cells.groupBy(F.col("key").alias("column_name")).agg(seen.alias("kinds"))
    return grouped.select(
        "column_name",
        F.when(F.size("kinds") == 1, F.col("kinds")[0])
        .when((F.size("kinds") > 1) & (F.size(F.array_except("kinds", numbers)) == 0),
              F.lit(FieldType.FLOAT.value))
        .otherwise(F.lit(FieldType.STRING.value)).alias("type"))


def _exploded(spark) -> DataFrame:
    return spark.tvf.variant_explode(F.col("__v").outer())


def inferred_schema(df: DataFrame) -> T.StructType:
    """Logical schema of a typed DataFrame, column order kept."""
    return table_schema(*[column(f.name, logical_type(f)) for f in df.schema.fields])


# --------------------------------------------------------------------------
# contracts and evolution


def check_strict(df: DataFrame, schema: T.StructType, stream: str = "") -> None:
    extra = sorted(set(df.columns) - set(schema.names))
    if extra:
        raise SchemaError(f"strict stream {stream!r} carries undeclared column(s): {', '.join(extra)}")


def evolved(schema: T.StructType, incoming: T.StructType) -> T.StructType:
    """``schema`` plus the columns it lacks, appended as nullable.  Nothing is dropped
    or widened; a column that changes its Spark type is an error."""
    known = {f.name: f for f in schema.fields}
    fields = list(schema.fields)
    for field in incoming.fields:
        check_name(field.name, "column")
        have = known.get(field.name)
        if have is None:
            fields.append(T.StructField(field.name, field.dataType, True, field.metadata))
        elif have.dataType != field.dataType:
            raise SchemaError(f"column {field.name!r} is {have.dataType.simpleString()} in the table, "
                              f"{field.dataType.simpleString()} in the data")
    return T.StructType(fields)


def aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in order; those ``df`` lacks are NULL."""
    return df.select(*[
        (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])


def stamped(df: DataFrame, at: Column) -> DataFrame:
    """Set the load time where a row does not carry one."""
    if SYNCED_AT in df.columns:
        return df.withColumn(SYNCED_AT, F.coalesce(F.col(SYNCED_AT), at))
    return df.withColumn(SYNCED_AT, at)


def ragged_union(*parts: DataFrame) -> DataFrame:
    """Union by name, columns in first-seen order, missing cells NULL.  Where two
    parts give a column different types it becomes text on both sides."""
    kinds: dict[str, set] = {}
    for part in parts:
        for field in part.schema.fields:
            check_name(field.name, "column")
            kinds.setdefault(field.name, set()).add(field.dataType.json())
    clash = {name for name, types in kinds.items() if len(types) > 1}
    as_text = lambda part: part.select(*[
        C.to_text(part[f"`{f.name}`"], f.dataType).alias(f.name) if f.name in clash else part[f"`{f.name}`"]
        for f in part.schema.fields])
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [as_text(p) for p in parts])


def common_type(types: Sequence[T.DataType]) -> T.DataType | None:
    """The least type of the lattice that holds all: whole numbers below bigint, numbers below double, days
    below times; ``None`` where only text does."""
    if len({t.json() for t in types}) == 1:
        return types[0]
    if all(isinstance(t, T.IntegralType) for t in types):
        return T.LongType()
    if all(isinstance(t, T.NumericType) for t in types):
        return T.DoubleType()
    if all(isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)) for t in types):
        return T.TimestampType()
    return None


def widened_union(*parts: DataFrame) -> DataFrame:
    """``ragged_union`` that widens a column's types where one type holds them all."""
    kinds: dict[str, list[T.DataType]] = {}
    for part in parts:
        for field in part.schema.fields:
            kinds.setdefault(field.name, []).append(field.dataType)
    common = {name: common_type(types) for name, types in kinds.items()}
    widen = lambda part: part.select(*[
        part[f"`{f.name}`"] if common[f.name] in (None, f.dataType) else part[f"`{f.name}`"].cast(common[f.name]).alias(f.name)
        for f in part.schema.fields])
    return ragged_union(*[widen(p) for p in parts])


def required_nulls(df: DataFrame, schema: T.StructType) -> DataFrame:
    """NULL count of every REQUIRED column: ``column_name, nulls``, in one aggregate."""
    names = [f.name for f in schema.fields if field_mode(f) is Mode.REQUIRED]
    if not names:
        return df.sparkSession.createDataFrame([], "column_name string, nulls bigint")
    counts = df.agg(*[F.count_if(F.col(f"`{n}`").isNull()).alias(n) for n in names])
    entries = [F.struct(F.lit(n).alias("column_name"), F.col(f"`{n}`").alias("nulls")) for n in names]
    return counts.select(F.inline(F.array(*entries)))


def require(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The same rows; a NULL in a REQUIRED column ends the job."""
    for field in schema.fields:
        if field_mode(field) is Mode.REQUIRED and field.name in df.columns:
            cell = F.col(f"`{field.name}`")
            broken = F.raise_error(F.lit(f"column {field.name} is REQUIRED but NULL")).cast(field.dataType)
            df = df.withColumn(field.name, F.when(cell.isNull(), broken).otherwise(cell))
    return df
