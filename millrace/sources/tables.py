"""Table and query sources: DataFrames, catalog tables, JDBC, parameterised SQL."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import date, datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.coerce import to_text
from ..operators.selection import newer
from ..spec import SpecError, utc
from .native_types import schema_of_columns

_HOLE = re.compile(r"\{(\w+)\}")


def read_table(table: DataFrame, cursor: str | None = None, floor: Any = None,
               inclusive: bool = False) -> DataFrame:
    """Rows past the cursor floor in one distributed scan.

    There are no pages, hence no page edge at which tied cursor values could be lost.
    """
    return table if cursor is None else newer(table, cursor, floor, inclusive)


def read_query(spark: SparkSession, text: str, cursor: str, floor: Any = None, inclusive: bool = False,
               **tables: DataFrame) -> DataFrame:
    """A SELECT as an incremental source: its result is filtered on the cursor column,
    and Catalyst pushes the filter into the query where it can."""
    if cursor is None:
        raise SpecError("a query source is incremental: name its cursor column")
    return newer(spark.sql(text.rstrip().rstrip(";"), **tables), cursor, floor, inclusive)


def read_sql(spark: SparkSession, text: str, values: Mapping[str, Any], cursors: Sequence[str] = ("since",),
             **tables: DataFrame) -> DataFrame:
    """SQL text with ``{name}`` holes.  A hole becomes a named parameter, so its value is
    never spliced into the text; a hole without a value is an error.

    Values bind with their types, texts as they are.  Dates bind as ``YYYY-MM-DD`` and
    timestamps as ``YYYY-MM-DD HH:MM:SS`` text; so do the texts of ``cursors``, which are
    timestamps read back from a state.  Tables are addressed as ``{table_name}`` and
    passed by keyword.
    """
    def fill(match: re.Match) -> str:
        name = match[1]
        if name in tables:
            return match[0]
        if name not in values:
            raise SpecError(f"no value for {{{name}}}; known: {', '.join(sorted(values))}")
        return f":{name}"

    bound = {k: sql_literal_text(v) if k in cursors and isinstance(v, str) or isinstance(v, date) else v
             for k, v in values.items()}
    return spark.sql(_HOLE.sub(fill, text), args=bound, **tables)


def sql_literal_text(value: Any) -> str:
    if isinstance(value, datetime):
        return utc(value).strftime("%Y-%m-%d %H:%M:%S")
    if isinstance(value, date):
        return value.isoformat()
    text = re.sub(r"(Z|[+-]\d\d:\d\d)$", "", str(value).strip()).replace("T", " ")
    return text.split(".", 1)[0]


def _quoted(value: Any) -> str:
    """A literal of a database: numbers bare, dates and timestamps in their text form, texts
    with their quotes doubled."""
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return str(value)
    text = sql_literal_text(value) if isinstance(value, date) else str(value)
    return "'" + text.replace("'", "''") + "'"


def jdbc_options(url: str, *, table: str | None = None, query: str | None = None,
                 cursor: str | None = None, floor: Any = None, inclusive: bool = False,
                 as_of: str | None = None, split_on: str | None = None,
                 bounds: tuple[Any, Any] | None = None, partitions: int = 8,
                 fetch_size: int = 5000, **extra: str) -> dict[str, str]:
    """Options of a JDBC read.

    The cursor predicate goes into the statement together with an ``AS OF SYSTEM TIME``
    snapshot; without a snapshot it is left to Spark's own pushdown.  ``split_on`` with
    ``bounds`` reads in parallel; ``fetch_size`` bounds the rows held per task.
    """
    if (table is None) == (query is None):
        raise SpecError("give a table or a query")
    source = f"({query.rstrip().rstrip(';')}) q" if query else table
    if as_of or query:
        clause = f" AS OF SYSTEM TIME {as_of}" if as_of else ""
        where = ""
        if cursor is not None and floor is not None:
            literal = _quoted(floor)
            where = f" WHERE {cursor} {'>=' if inclusive else '>'} {literal}"
        source = f"(SELECT * FROM {source}{clause}{where}) t"
    options = {"url": url, "dbtable": source, "fetchsize": str(fetch_size), **extra}
    if split_on is not None:
        if bounds is None:
            raise SpecError("split_on needs bounds")
        low, high = bounds
        options |= {"partitionColumn": split_on, "lowerBound": str(low), "upperBound": str(high),
                    "numPartitions": str(partitions)}
    return options


def read_jdbc(spark: SparkSession, url: str, *, cursor: str | None = None, floor: Any = None,
              inclusive: bool = False, **how: Any) -> DataFrame:
    """An external table or query; the filter reaches the database either way."""
    options = jdbc_options(url, cursor=cursor, floor=floor, inclusive=inclusive, **how)
    return read_table(spark.read.format("jdbc").options(**options).load(), cursor, floor, inclusive)


def jdbc_schema(spark: SparkSession, url: str, schema: str, table: str, dialect: str = "postgres", **extra):
    """Logical schema of a database table from its information schema."""
    text = lambda s: s.replace("'", "''")
    query = ("SELECT column_name, data_type, is_nullable FROM information_schema.columns "
             f"WHERE table_schema = '{text(schema)}' AND table_name = '{text(table)}' ORDER BY ordinal_position")
    rows = spark.read.format("jdbc").options(url=url, query=query, **extra).load().collect()
    return schema_of_columns([tuple(r) for r in rows], dialect)


def all_text(df: DataFrame) -> DataFrame:
    """Every cell as text, the way a CSV report arrives; typing is left to normalize."""
    return df.select(*[to_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])
