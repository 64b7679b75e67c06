"""Normalize a DataFrame to a declared schema under a drift policy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F, types as T

from ..functions import coerce as C
from ..spec import Drift, Mode, field_mode, logical_type

TYPE_MISMATCH = "type_mismatch"
MISSING_COLUMN = "missing_column"
NEW_COLUMN = "new_column"

# How much of a misfit a sample shows.
SAMPLE_CHARS = 200

_FLAG = "__drift_"
_VALUE = "__value_"


def _cell(df: DataFrame, name: str) -> Column:
    return df[f"`{name}`"]


def _present(df: DataFrame, schema: T.StructType) -> list[T.StructField]:
    return [f for f in schema.fields if f.name in df.columns]


def new_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    return [c for c in df.columns if c not in schema.names]


def missing_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if f.name not in df.columns]


def _coerce_all(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, dict[str, C.Parts], dict]:
    """``df`` with the parts of its cells and, next to each declared column, its coerced value.

    Parts, values and flags are three projections: each reads the columns of the one
    before, so nothing is computed twice.
    """
    fields = {f.name: f for f in _present(df, schema)}
    kinds = {n: df.schema[n].dataType for n in fields}
    targets = {n: logical_type(f) for n, f in fields.items() if field_mode(f) is not Mode.REPEATED}
    staged, parts = C.with_parts(df, targets)
    values = [C.coerced_field(_cell(staged, n), kinds[n], f, parts.get(n)).alias(_VALUE + n)
              for n, f in fields.items()]
    return staged.select("*", *values), parts, kinds


def drift_counts(df: DataFrame, schema: T.StructType) -> list[Column]:
    """One count per flag column left by ``normalize(..., flags=True)``."""
    return [F.count_if(F.col(_FLAG + f.name)).alias(_FLAG + f.name) for f in _present(df, schema)]


def normalize(df: DataFrame, schema: T.StructType, policy: str | Drift = Drift.WARN,
              flags: bool = False) -> DataFrame:
    """Coerce every declared column; undeclared columns pass through unchanged.

    Declared columns come first, in declared order, and a declared column the
    data lacks is NULL.  Under ``warn`` a misfit becomes NULL (text and JSON
    always fit); under ``fail`` the first misfit ends the job with its column and value.
    ``flags`` leaves one boolean per declared column for ``drift_counts``.
    """
    policy = Drift.of(policy)
    staged, parts, kinds = _coerce_all(df, schema)
    columns, marks = [], []
    for field in schema.fields:
        name = field.name
        if name not in kinds:
            columns.append(F.lit(None).cast(field.dataType).alias(name, metadata=field.metadata))
            continue
        cell, value = _cell(staged, name), F.col(_VALUE + name)
        drifted = C.is_drift(cell, kinds[name], value, parts.get(name))
        if policy is Drift.FAIL:
            message = C.cannot_become(name, cell, kinds[name], logical_type(field))
            value = F.when(drifted, F.raise_error(message).cast(field.dataType)).otherwise(value)
        columns.append(value.alias(name, metadata=field.metadata))
        if flags:
            marks.append(drifted.alias(_FLAG + name))
    extras = [_cell(staged, c) for c in new_columns(df, schema)]
    return staged.select(*columns, *extras, *marks)


def drop_flags(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(_FLAG)])


def drift_rows(observed: dict, df: DataFrame, schema: T.StructType) -> list[tuple[str, str, int]]:
    """(column, kind, cells) from observed flag counts plus the column sets."""
    rows = [(k.removeprefix(_FLAG), TYPE_MISMATCH, n) for k, n in observed.items()
            if k.startswith(_FLAG) and n]
    rows += [(c, MISSING_COLUMN, 0) for c in missing_columns(df, schema)]
    rows += [(c, NEW_COLUMN, 0) for c in new_columns(df, schema)]
    return rows


def drift_report(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per drifted column and kind: ``column_name, kind, cells``.

    ``cells`` counts misfits; for a missing or a new column it is the row count.
    One aggregate over the data, then an unpivot of that single row.
    """
    staged, parts, kinds = _coerce_all(df, schema)
    cells = list(kinds)
    marked = staged.select(*[C.is_drift(_cell(staged, n), kinds[n], F.col(_VALUE + n), parts.get(n)).alias(n)
                             for n in cells])
    totals = marked.agg(F.count(F.lit(1)).alias("__rows"),
                        *[F.count_if(F.col(f"`{n}`")).alias(n) for n in cells])
    entry = lambda name, kind, n: F.struct(F.lit(name).alias("column_name"), F.lit(kind).alias("kind"),
                                           n.alias("cells"))
    entries = [entry(n, TYPE_MISMATCH, F.col(f"`{n}`")) for n in cells]
    entries += [entry(n, MISSING_COLUMN, F.col("__rows")) for n in missing_columns(df, schema)]
    entries += [entry(n, NEW_COLUMN, F.col("__rows")) for n in new_columns(df, schema)]
    return totals.select(F.inline(F.array(*entries))).filter("cells > 0")


def drift_samples(df: DataFrame, schema: T.StructType, most: int = 3) -> DataFrame:
    """Some misfits of each column: ``column_name, value, cells``, at most ``most`` distinct values a column.

    Values are texts (nested ones JSON), cut at ``SAMPLE_CHARS``; ``cells`` counts the cells with that value.  Those with the smallest MD5 are
    taken, so the choice depends on the values alone and is spread over them.  Equal misfits are counted within each task before
    they move, and each task hands on the first few of a column, however many misfits it has.
    """
    staged, parts, kinds = _coerce_all(df, schema)
    misfits = [F.when(C.is_drift(_cell(staged, n), kind, F.col(_VALUE + n), parts.get(n)),
                      F.struct(F.lit(n).alias("column_name"), F.left(C.to_json_text(_cell(staged, n), kind), F.lit(SAMPLE_CHARS)).alias("value")))
               for n, kind in kinds.items()]
    if not misfits:
        return df.sparkSession.createDataFrame([], "column_name string, value string, cells bigint")
    each = staged.select(F.inline(F.array_compact(F.array(*misfits))))
    counted = each.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("cells"))
    spread = Window.partitionBy("column_name").orderBy(F.md5(F.col("value").cast("binary")), "value")
    return counted.withColumn("__rn", F.row_number().over(spread)).filter(F.col("__rn") <= most).drop("__rn")


def observe_drift(df: DataFrame, schema: T.StructType, observation: Observation,
                  policy: str | Drift = Drift.WARN, *extra: Column) -> DataFrame:
    """Normalize and count drift (and ``extra`` aggregates) as rows pass to the write."""
    flagged = normalize(df, schema, policy, flags=True)
    counts = drift_counts(df, schema)
    measured = flagged.observe(observation, F.count(F.lit(1)).alias("rows"), *counts, *extra)
    return drop_flags(measured)
