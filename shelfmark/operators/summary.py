"""Run counts and the run summary row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.quality import is_comic, load_reject

RUN = ["run_date", "source"]


def run_counts(items: DataFrame, keys: list[str] = RUN) -> DataFrame:
    """Records of a run, and how many of them the catalog load would process (re-seen rows count too)."""
    loads = is_comic() & load_reject(items).isNull()
    return items.groupBy(*keys).agg(F.count("*").alias("records"), F.count_if(loads).alias("rows_processed"))


def run_summary(items: DataFrame, files: DataFrame, runs: DataFrame) -> DataFrame:
    """One row per scheduled run: status, records, rows processed, file."""
    return (runs.select(*RUN).distinct().join(run_counts(items), RUN, "left").join(files.select(*RUN, "file"), RUN, "left")
            .withColumn("status", F.when(F.col("file").isNotNull(), "completed").otherwise("completed_without_file"))
            .select(*RUN, "status", "records", "rows_processed", "file"))
