"""Run exports: JSON and CSV writers, the scan of exported arrays, and latest-file selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.functions import text as t
from shelfmark.operators.quality import is_comic, load_reject
from shelfmark.sources.arrays import RANGE_BYTES, read_members

# Every field an exported record may carry, whatever its kind.
ITEM_FIELDS = schemas.fields(schemas.PUBLISHER) | schemas.fields(schemas.SERIES) | schemas.fields(schemas.COMIC)


def write_json(items: DataFrame, path: str, mode: str = "append") -> None:
    """JSON lines under ``run_date=/source=``; needs both columns."""
    items.write.partitionBy("run_date", "source").mode(mode).json(path)


def write_observed(items: DataFrame, path: str, sources: list[str], mode: str = "append") -> list[dict]:
    """Write a run's export and count it on the way: per source of the run, its records and how many of them the catalog load would process.

    The counts are observed by the write itself, so the records are made and read once.  Numbers of the listed sources are all that comes back.
    """
    loads = is_comic() & load_reject(items).isNull()
    of = lambda s: F.col("source") == s
    seen = Observation()
    counts = [c for i, s in enumerate(sources) for c in (F.count_if(of(s)).alias(f"records_{i}"), F.count_if(of(s) & loads).alias(f"processed_{i}"))]
    write_json(items.observe(seen, *counts), path, mode)
    return [{"source": s, "records": seen.get[f"records_{i}"], "rows_processed": seen.get[f"processed_{i}"]} for i, s in enumerate(sources)]


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """Own exports, with a fixed schema, so that partitions prune and only named fields are parsed."""
    ddl = ", ".join(f"`{c}` {k}" for c, k in ({"entity": "string", "run_id": "string", "seq": "bigint"} | ITEM_FIELDS).items())
    return spark.read.schema(ddl + ", run_date date, source string").json(path)


def _records(items: DataFrame) -> DataFrame:
    """Fields of the members that are objects, from a column ``item``; a field of another type than expected is NULL."""
    field = lambda c, k: F.try_variant_get("item", f"$.{c}", k).alias(c)
    return items.filter(F.schema_of_variant("item").startswith("OBJECT")).select(
        *[c for c in items.columns if c != "item"], F.to_json("item").alias("raw_json"), *[field(c, k) for c, k in ITEM_FIELDS.items()])


def parse_export(documents: DataFrame, text: str = "value") -> DataFrame:
    """Records of exported array documents that are at hand as a column.

    A document that is not an array is rejected whole; members that are not objects are skipped; a field of another type
    than expected is NULL.  Adds ``position``, the record's place in its document.
    """
    members = documents.withColumn("members", F.from_json(F.col(text), "array<variant>")).drop(text)
    return _records(members.select(*[c for c in members.columns if c != "members"], F.posexplode("members").alias("position", "item")))


def read_export(spark: SparkSession, paths: str | list[str], range_bytes: int = RANGE_BYTES, task_bytes: int | None = None) -> DataFrame:
    """Records of exported array files, as ``parse_export`` gives them; every file is read by as many tasks as its size asks for.

    A file with anything in it that is no JSON is rejected whole, so the files are read once more to find these; only their names are kept.
    """
    members = read_members(spark, paths, range_bytes, task_bytes).select("file", "position", t.settled(F.try_parse_json("value")).alias("item"))
    bad = members.filter(F.col("item").isNull()).select("file").distinct()
    return _records(members.join(bad, "file", "left_anti"))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Export files with run date, source folder and modification time; reads no file content."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")
             .load(path).select("path", "modificationTime"))
    part = lambda i: F.try_element_at(F.split("path", "/"), F.lit(i))
    return files.select(part(-3).try_cast("date").alias("run_date"), part(-2).alias("folder"),
                        F.col("path").alias("file"), F.col("modificationTime").alias("modified_at"))


def latest_files(files: DataFrame, keys: tuple[str, ...] = ("run_date", "folder")) -> DataFrame:
    """Newest file per run date and source."""
    return files.groupBy(*keys).agg(F.max_by("file", F.struct("modified_at", "file")).alias("file"))


def run_file_path(root: str, run_ts: Column, source: Column) -> Column:
    """``<root>/<date>/<Source>/<time>.json`` of a run."""
    return F.concat_ws("/", F.lit(root), F.date_format(run_ts, "yyyy-MM-dd"), t.folder_name(source), t.run_file_name(run_ts))


def csv_columns(items: DataFrame) -> DataFrame:
    """Per record kind, the fields that some record of it has, by name: one aggregate over the items, one row per kind."""
    filled = [F.when(F.count(c) > 0, F.lit(c)) for c in sorted(c for c in ITEM_FIELDS if c in items.columns)]
    return items.groupBy("entity").agg(F.array_compact(F.array(*filled)).alias("columns"))


def record_headers(records: DataFrame, raw: str = "raw_json") -> DataFrame:
    """Per record kind, the names of all keys that some record's text has, known fields or not, by name.

    Keys are made distinct before the shuffle, so a task sends each name once; nothing is collected.
    """
    keys = records.select("entity", F.explode(F.json_object_keys(raw)).alias("key")).distinct()
    return keys.groupBy("entity").agg(F.array_sort(F.collect_list("key")).alias("columns"))


def csv_table(items: DataFrame, entity: str, columns: list[str]) -> DataFrame:
    """One record kind flattened for CSV: the given columns by name, lists joined.  Runs nothing."""
    kinds = dict(items.dtypes)

    def flat(c: str) -> Column:
        if kinds[c].startswith("array"):
            return F.array_join(F.filter(c, lambda x: x != ""), ", ").alias(c)
        if kinds[c].startswith("map"):
            return F.to_json(c).alias(c)
        return F.col(c)

    own = schemas.fields(schemas.ENTITIES[entity])
    return items.filter(F.col("entity") == entity).select(*[flat(c) for c in sorted(columns) if c in own])


def write_csv(items: DataFrame, path: str, mode: str = "append") -> None:
    """A folder per record kind that occurs, with the fields that occur in it.  Items should be stored ones: they are read once for the
    headers and once per kind."""
    for entity, columns in csv_columns(items).collect():  # at most six kinds
        if entity in schemas.ENTITIES:
            csv_table(items, entity, columns).write.mode(mode).option("header", True).option("escape", '"').csv(f"{path}/{entity}")
