"""Records out of landed JSON payloads.

A payload table has one JSON body per row.  The functions here turn it into one
row per record, the record being a VARIANT, and keep the columns asked for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from ..spec import SpecError

RECORD = "record"
ANY = "*"


def path_of(steps: Sequence[str]) -> str:
    for step in steps:
        if "'" in step:
            raise SpecError(f"path step {step!r} may not contain a quote")
    return "$" + "".join(f"['{s}']" for s in steps)


def get(value: Column, steps: Sequence[str] = (), type: str = "variant") -> Column:
    """Value at a path; SQL NULL where a step is absent or of another shape."""
    return F.try_variant_get(value, path_of(steps), type)


def as_list(value: Column, steps: Sequence[str] = ()) -> Column:
    return get(value, steps, "array<variant>")


def is_object(value: Column) -> Column:
    return get(value, (), "map<string,variant>").isNotNull()


def _is_null(value: Column) -> Column:
    return F.coalesce(F.is_variant_null(value), F.lit(False))


def _fail(what: str) -> Column:
    return F.raise_error(F.lit(what))


def _rows(df: DataFrame, elements: Column, keep: Sequence[str]) -> DataFrame:
    return df.select(*keep, F.explode(elements).alias(RECORD))


def extract_records(df: DataFrame, body: str, path: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per record at ``path``; a shape that does not fit ends the job.

    One ``*`` step may flatten a list; the steps after it unwrap each element, and
    an element that is null on the way is skipped.  A null where the record list
    should be means no records.
    """
    path = list(path)
    if path.count(ANY) > 1:
        raise SpecError("a record path takes one '*' step")
    split = path.index(ANY) if ANY in path else None
    head = path if split is None else path[:split]
    shown = ".".join(path) or "<root>"
    parsed = df.select(*keep, F.parse_json(F.col(body)).alias("__v"))
    value = F.col("__v")

    # The list itself comes first; only when there is none is the reason looked for.
    missing = get(value, head).isNull() if head else F.lit(False)
    why = F.when(missing, _fail(f"record path {shown}: a step of {'.'.join(head)} was not found")
                 .cast("array<variant>"))
    if split is None:
        why = why.when(_is_null(get(value, head)), F.array().cast("array<variant>"))
    why = why.otherwise(_fail(f"record path {shown}: no list at {'.'.join(head) or '<root>'}")
                        .cast("array<variant>"))
    as_items = F.coalesce(as_list(value, head), why)
    rows = _rows(parsed, as_items, keep)
    element = F.col(RECORD)
    if split is None:
        checked = F.when(is_object(element), element).otherwise(
            _fail(f"record path {shown}: an element is not an object").cast("variant"))
        return rows.withColumn(RECORD, checked)

    tail = path[split + 1:]
    on_the_way = [_is_null(get(element, tail[:i])) for i in range(len(tail) + 1)]
    rows = rows.withColumn("__inner", get(element, tail))
    inner = F.col("__inner")
    checked = (F.when(is_object(inner), inner)
               .when(reduce(or_, on_the_way), F.lit(None).cast("variant"))
               .otherwise(_fail(f"record path {shown}: an element has no object at "
                                f"{'.'.join(tail) or 'its root'}").cast("variant")))
    return rows.select(*keep, checked.alias(RECORD)).filter(F.col(RECORD).isNotNull())


def extract_records_lenient(df: DataFrame, body: str, path: Sequence[str],
                            keep: Sequence[str] = ()) -> DataFrame:
    """One row per object at ``path``; any number of ``*`` steps, misfits give no rows.

    Lenient is the path, not the body: one that is no JSON ends the job (see ``unreadable_bodies``).
    """
    rows = df.select(*keep, F.parse_json(F.col(body)).alias(RECORD))
    steps: list[str] = []
    for step in [*path, None]:
        if step not in (ANY, None):
            steps.append(step)
            continue
        here = get(F.col(RECORD), steps)
        rows = rows.select(*keep, here.alias(RECORD)) if step is None else _rows(
            rows, as_list(F.col(RECORD), steps), keep)
        steps = []
    return rows.filter(F.col(RECORD).isNotNull() & is_object(F.col(RECORD)))


def unreadable_bodies(df: DataFrame, body: str) -> DataFrame:
    """The rows whose body is no JSON, to be counted or set aside before an extraction."""
    return df.filter(F.col(body).isNotNull() & F.try_parse_json(F.col(body)).isNull())


def dotted(body: Column, pointer: str) -> Column:
    """Scalar at a dotted path of a JSON text; absent, null or ``""`` give NULL."""
    if not pointer:
        return F.lit(None).cast("string")
    return F.nullif(F.get_json_object(body, path_of(pointer.split("."))), F.lit(""))


# --------------------------------------------------------------------------
# envelopes


def unwrap_data(df: DataFrame, body: str, keep: Sequence[str] = ()) -> DataFrame:
    """A bare list, or a list under ``data``; null or no ``data`` means no rows."""
    parsed = df.select(*keep, F.parse_json(F.col(body)).alias("__v"))
    value = F.col("__v")
    empty = F.array().cast("array<variant>")
    data = get(value, ["data"])
    other = F.when(is_object(value) & (data.isNull() | _is_null(data)), empty).otherwise(
        _fail("envelope: no list, bare or under 'data'").cast("array<variant>"))
    items = F.coalesce(as_list(value, ["data"]), as_list(value), other)
    return _rows(parsed, items, keep)


def unwrap_results(df: DataFrame, body: str, keep: Sequence[str] = ()) -> DataFrame:
    """The list under ``results``, or else under ``value.results``."""
    parsed = df.select(*keep, F.parse_json(F.col(body)).alias("__v"))
    value = F.col("__v")
    items = F.coalesce(as_list(value, ["results"]), as_list(value, ["value", "results"]),
                       _fail("envelope: no 'results'").cast("array<variant>"))
    return _rows(parsed, items, keep)


def unwrap_chunks(df: DataFrame, body: str, keep: Sequence[str] = ()) -> DataFrame:
    """A list of chunks, each with an optional ``results`` list."""
    parsed = df.select(*keep, F.parse_json(F.col(body)).alias("__v"))
    chunks = F.coalesce(as_list(F.col("__v")), _fail("envelope: not a list of chunks").cast("array<variant>"))
    return _rows(_rows(parsed, chunks, keep), as_list(F.col(RECORD), ["results"]), keep)


# --------------------------------------------------------------------------
# projections


def pick(fields: Mapping[str, Sequence[str] | str], record: str = RECORD) -> list[Column]:
    """``{column: path}`` to one VARIANT column per entry; an absent leaf is NULL, a null one a
    variant null, and normalize makes NULL of both."""
    out = []
    for name, path in fields.items():
        steps = path.split(".") if isinstance(path, str) else path
        out.append(get(F.col(record), steps).alias(name))
    return out


def pick_text(fields: Mapping[str, str], record: str = RECORD, type: str = "string") -> list[Column]:
    return [get(F.col(record), p.split("."), type).alias(n) for n, p in fields.items()]
