"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .spec import SpecError


def tune(spark: SparkSession) -> SparkSession:
    """Set what the coercion rules need.

    The zone is UTC because text without an offset means UTC.  A generated method of
    more than 8000 bytes of bytecode is never compiled by the JVM's JIT, and a wide
    normalize pass easily reaches that; under this limit Spark splits such a stage into
    small compiled methods instead (measured: about twice as fast).
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def check(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "GMT"):
        raise SpecError("set spark.sql.session.timeZone to UTC (see millrace.session.tune)")
