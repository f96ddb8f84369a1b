"""The pages table: already-fetched pages, partitioned by run and source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import schemas


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PAGES).parquet(path)


def write_pages(pages: DataFrame, path: str, mode: str = "append") -> None:
    """One folder per run and source, so a source's rules read only its own pages."""
    pages.write.partitionBy("run_id", "source").mode(mode).parquet(path)


def as_pages(rows: DataFrame, source: str, run_ts: Column, url: Column, html: Column, seq: Column,
             run_id: Column | None = None, status: Column | None = None) -> DataFrame:
    """Any table with page text in the shape of ``pages``."""
    run_ts = run_ts.cast("timestamp")
    return rows.select(F.lit(source).alias("source"), url.alias("url"),
                       (status if status is not None else F.lit(200)).cast("int").alias("status"), html.alias("html"),
                       (run_id if run_id is not None else F.date_format(run_ts, "yyyyMMdd")).alias("run_id"),
                       run_ts.alias("run_ts"), seq.cast("bigint").alias("seq"), run_ts.alias("fetched_at"))
