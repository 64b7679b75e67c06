"""A training corpus from raw documents: grade, deduplicate, decontaminate, encode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import bpe, decontaminate, line_dedup, quality_model, queries, simhash
from millrace.llm.common import settle, table, text_key, tune


def grade(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps.  It is fitted on the labelled rows of the stage's own input."""
    model = quality_model.train_quality(docs, table(spark, sf_dir, "labels"), queries.grade(), 3)
    rows = docs.withColumn("__key", text_key())
    kept = quality_model.grade_documents(rows, model, least_tail=queries.LEAST_TAIL, id_col="__key").where("kept")
    return rows.join(kept.select("__key"), "__key", "left_semi").select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated passages; those of which no words are left, though they had some, go.  ``n_chars`` is
    counted anew, where there is such a column."""
    names = docs.columns
    # the filter reads the new text from files: Spark would push it below and repeat, for every use of the text, all that makes it
    out = settle(line_dedup.dedup_lines(docs, prefix="__"), "lines", free=True)
    changed = F.col("__n_dropped_lines") > 0
    out = out.where(~(changed & (F.length(F.trim(F.translate("text", "\n\t\r", ""))) == 0)))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*names)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest id; one of several rows with that
    id, or of a group without ids."""
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.monotonically_increasing_id().alias("at"))
    rows = settle(docs.withColumn("__row", rank), "rows")
    groups = simhash.near_duplicates(rows, id_col="__row")
    first = groups.where("__row.at = component_id.at").select(F.col("__row.at").alias("__keep"))
    return rows.join(first, F.col("__row.at") == F.col("__keep"), "left_semi").select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of them and of the text that they decode to."""
    return bpe.encode_documents(docs)


def _tuned(stage):
    return lambda spark, docs, sf_dir: stage(tune(spark), docs, sf_dir)


STAGES = [("quality classifier", _tuned(grade)), ("line dedup", _tuned(dedup_lines)),
          ("SimHash near-dedup", _tuned(dedup_near)), ("benchmark decontamination", _tuned(drop_benchmark)),
          ("BPE encoding and decoding", _tuned(encode))]

#: SQL can't express the classifier; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's rows from files in the folder that all executors share."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), "stage")
    return docs
