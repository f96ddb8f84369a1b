"""A corpus in five stages: toxic documents, repeated lines, near duplicates, benchmark passages, packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import documents, written
from shelfmark.llm.decontaminate import remove_leaks
from shelfmark.llm.line_dedup import dedup_lines
from shelfmark.llm.minhash import near_duplicates
from shelfmark.llm.packing import packed
from shelfmark.llm.queries import vocabulary
from shelfmark.llm.toxicity import drop_toxic, train


def _counted(docs: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of documents; n_chars follows a changed text."""
    if "n_chars" in like.columns:
        docs = docs.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(like.schema["n_chars"].dataType))
    return docs.select(*like.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold.  Labels of the held-out fold are not learnt from."""
    return drop_toxic(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that occur earlier; a document that had nothing else goes, one that was empty before stays."""
    done = dedup_lines(docs, counts=("__lines", "__removed"))
    return _counted(done.filter("__removed = 0 OR text <> ''"), docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at a similarity of 0.8, the one with the smallest doc_id.  Rows without a doc_id stay."""
    gone = near_duplicates(docs, percent=80).filter("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages they share with benchmark items."""
    return _counted(remove_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2,048 tokens."""
    return packed(docs, vocabulary("byte_bpe_50k.json"), length=2048, end_id=1, kind="digest")


STAGES = [("toxicity", toxicity), ("line_dedup", lines), ("near_dedup", near), ("decontaminate", benchmark), ("packing", packing)]

#: A trained network decides the first stage, which SQL cannot state; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
