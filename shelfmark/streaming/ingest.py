"""Incremental input: pages arrive as files, records leave deduplicated, and each batch is merged into the tables."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import LongType, StructField, StructType

from shelfmark import schemas
from shelfmark.functions.text import truthy
from shelfmark.operators.extract import extract_comics
from shelfmark.operators.quality import dedupe_by_url, validate
from shelfmark.operators.records import _with_series, listing_of, told_by_listing
from shelfmark.plans.jobs import load
from shelfmark.profiles import PROFILES, SourceProfile
from shelfmark.streaming.java import new_instance


def page_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(schemas.PAGES).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def record_stream(pages: DataFrame, profiles: list[SourceProfile] = PROFILES) -> DataFrame:
    """Publisher, comic and series records of a page stream, validated.

    Every listing page gives its publisher record; all of a run have the shop's own url, so the url rule keeps the first.
    """
    parts = []
    for p in profiles:
        comics = extract_comics(pages, p)
        parts.append((comics.withColumn("ord", F.lit(1)) if p.family == "retail" else _with_series(comics)).drop("page_url"))
        parts.append(told_by_listing(listing_of(pages, p), p).withColumn("ord", F.lit(0)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return validate(out)


def _first_arrivals(ranked: DataFrame, record: StructType, keys: list[str], delay_ms: int | None) -> DataFrame:
    """The records that ``FirstArrival.java`` lets through; it gets them with their rank and time as three more columns."""
    spark, row = ranked.sparkSession, ranked.sparkSession._jvm.org.apache.spark.sql.Encoders.row
    kind = lambda fields: row(spark._jsparkSession.parseDataType(StructType(fields).json()))
    processor = new_instance(spark, "FirstArrival").of(len(record), -1 if delay_ms is None else delay_ms)
    streaming = spark._jvm.org.apache.spark.sql.streaming
    mode = getattr(streaming.TimeMode, "None" if delay_ms is None else "EventTime")()
    grouped = ranked.groupBy(*keys)._jgd
    grouped = getattr(grouped, "as")(kind([record[k] for k in keys]), kind(ranked.schema.fields))
    told = grouped.transformWithState(processor, mode, streaming.OutputMode.Append(), kind(record.fields))
    return DataFrame(told.toDF(), spark)


def dedupe_stream(records: DataFrame, delay: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(records with a url, one per run and url; records without one, all of them).

    The first micro-batch that brings a url decides, and in it the lowest (seq, ord), as in a batch job.  State is one time per url;
    ``delay`` bounds it by ``fetched_at``: a url is forgotten that long after it was last seen, and records later than that are dropped.
    The session's state store must be RocksDB (``session.SETTINGS``).
    """
    has_url = truthy(F.col("url")).isNotNull()
    with_url, without = records.filter(has_url), records.filter(F.coalesce(~has_url, F.lit(True)))
    number = lambda c, default: F.coalesce(F.col(c).cast("long") if c in records.columns else F.lit(None).cast("long"), F.lit(default))
    if delay is not None:
        with_url = with_url.withWatermark("fetched_at", delay)
    ranked = with_url.withColumns({"__seq": number("seq", 1 << 62), "__ord": number("ord", 0), "__at": F.coalesce(F.unix_millis("fetched_at"), F.lit(0))})
    firsts = _first_arrivals(ranked, records.schema, ["run_id", "source", "url"], None if delay is None else int(pd.Timedelta(delay).total_seconds() * 1000))
    return firsts, without


def merge_sink(spark: SparkSession, root: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: first arrivals of batch n become items n, then load n of both tables.

    A repeated batch replaces its own items and load.  Items are written before they are merged, so pages are parsed once and a lost
    executor costs no more than a re-read.  Of earlier items only the runs between the batch's first and last are read: items lie in
    folders by run, and one row of bounds is all that reaches the driver.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        session, items = batch.sparkSession, f"{root}/items"
        kinds = StructType([*batch.schema.fields, StructField("batch", LongType())])
        here = f"{root}/arrived/batch={batch_id}"
        dedupe_by_url(batch, order=("seq", "ord")).select(*batch.columns).write.mode("overwrite").parquet(here)
        arrived = session.read.schema(batch.schema).parquet(here)
        low, high, stamp = arrived.agg(F.min("run_id"), F.max("run_id"), F.max("run_ts")).first()
        if low is None:
            return
        fresh = arrived
        if _exists(session, items):
            stored = session.read.schema(kinds).parquet(items)
            seen = stored.filter(F.col("run_id").between(low, high) & (F.col("batch") < batch_id)).select("run_id", "source", "url").distinct()
            fresh = arrived.join(seen, ["run_id", "source", "url"], "left_anti")
        (fresh.select(*batch.columns, F.lit(batch_id).cast("bigint").alias("batch")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "batch").parquet(items))
        records = session.read.schema(kinds).parquet(items).filter(F.col("run_id").between(low, high) & (F.col("batch") == batch_id))
        # The load time travels with the data; a source without new records is ensured too.
        load(session, records, root, batch_id, F.lit(stamp).cast("timestamp"), runs=arrived)
    return sink


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def write_merged(records: DataFrame, root: str, checkpoint: str) -> DataStreamWriter:
    return (records.writeStream.foreachBatch(merge_sink(records.sparkSession, root))
            .option("checkpointLocation", checkpoint).outputMode("append"))
