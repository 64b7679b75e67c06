"""Registry and helpers shared by the queries."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.session import tune

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)``; the session is tuned first."""
    def register(fn):
        @functools.wraps(fn)
        def call(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = call
        if sql is not None:
            ORACLES[name] = sql
        return call
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stamp(col: Column | str) -> Column:
    """Timestamp as text with microseconds, the same in both engines."""
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def day(col: Column | str) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


def sql_stamp(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def sql_day(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def money(col: Column | str) -> Column:
    """Exact sum of a two-digit amount, back as a float."""
    return F.sum(F.col(col).cast("decimal(18,2)")).cast("double")


def sql_money(expr: str) -> str:
    return f"CAST(SUM(CAST({expr} AS DECIMAL(18,2))) AS DOUBLE)"
