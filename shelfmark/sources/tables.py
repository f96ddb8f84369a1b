"""The stored tables, one folder per load.

``sources`` is small, so each load writes it whole and readers take the newest folder.

``catalog`` is a log: a load adds one row per key of its own, and readers resolve the log.  A key that is known already adds a narrow row, with
its key and the time alone.  Folders are laid out by a bucket of the key's hash and sorted by id, and each has a membership filter: bitmaps over
the keys' hashes, some sixteen bits a key.  A load looks its keys up in the filters and reads only the buckets of those folders that may hold one.
When as many folders of one level have come together as `fan` says, they are merged into one of the next level, so that readers meet a handful of
folders a level and a row is rewritten once a level, however many loads there are.  Merged folders stay until the next merge, for readers that
have begun.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.operators.merge import CATALOG_KEY, first_write_wins
from shelfmark.sources.work import file_system, remove, saved, work_path

LAYOUT = {"catalog": schemas.CATALOG, "sources": schemas.SOURCES}


BUCKETS = 16  # fixed by the layout of stored catalogs
FAN = 8
BITS = 32768  # of one bitmap
BITS_PER_KEY = 16

_STORED = f"{schemas.CATALOG}, snapshot bigint, bucket int"


def _hash() -> Column:
    return F.xxhash64(*CATALOG_KEY)


def _complete(spark: SparkSession, pattern: str) -> list[str]:
    """Folders of finished writes, from the folder listing."""
    fs, at = file_system(spark, f"{pattern}/_SUCCESS")
    return [s.getPath().getParent().toString() for s in (fs.globStatus(at) or [])]


def _numbers(path: str) -> dict[str, int]:
    return {k: int(v) for k, v in (part.split("=") for part in path.split("/") if part.split("=")[0] in ("level", "from", "snapshot") and part.count("=") == 1)}


def snapshots(spark: SparkSession, root: str) -> list[int]:
    """Ids of the complete folders."""
    return sorted(_numbers(p)["snapshot"] for p in _complete(spark, f"{root}/snapshot=*"))


def read_table(spark: SparkSession, name: str, root: str, before: int | None = None) -> DataFrame:
    """The table after the newest load, or after the newest one older than ``before``; empty when there is none."""
    if name != "catalog":
        ids = [i for i in snapshots(spark, root) if before is None or i < before]
        return spark.read.schema(LAYOUT[name]).parquet(f"{root}/snapshot={ids[-1]}") if ids else spark.createDataFrame([], LAYOUT[name])
    rows = _read(spark, root, [f.path for f in folders(spark, root, before)])
    return first_write_wins(rows.drop("bucket").withColumnRenamed("snapshot", "seq"), CATALOG_KEY, ["seq"])


def write_table(df: DataFrame, name: str, root: str, load_id: int) -> None:
    """Write one load's folder of a table that is stored whole.  Writing an id again replaces it."""
    ordered = df.select(*[F.col(c).cast(k).alias(c) for c, k in schemas.fields(LAYOUT[name]).items()])
    ordered.write.mode("overwrite").parquet(f"{root}/snapshot={load_id}")


# ---- catalog --------------------------------------------------------------------------------

@dataclass(frozen=True)
class Folder:
    """Rows of the loads low to high; level 0 is the log."""
    level: int
    low: int
    high: int
    path: str

    def filters(self, root: str) -> str:
        return f"{root}_keys/level={self.level}/from={self.low}/snapshot={self.high}"


def _all(spark: SparkSession, root: str) -> list[Folder]:
    merged = [(_numbers(p), p) for p in _complete(spark, f"{root}_base/level=*/from=*/snapshot=*")]
    log = [(_numbers(p)["snapshot"], p) for p in _complete(spark, f"{root}/snapshot=*")]
    return [Folder(n["level"], n["from"], n["snapshot"], p) for n, p in merged] + [Folder(0, i, i, p) for i, p in log]


def _within(f: Folder, others: list[Folder]) -> bool:
    return any(o.level > f.level and o.low <= f.low and f.high <= o.high for o in others)


def folders(spark: SparkSession, root: str, before: int | None = None) -> list[Folder]:
    """The folders that make up the table, in order of their loads: those that no other one holds."""
    usable = [f for f in _all(spark, root) if before is None or f.high < before]
    return sorted((f for f in usable if not _within(f, usable)), key=lambda f: f.low)


def _read(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    """One scan of the log and one of merged folders; paths may be single buckets."""
    rows = spark.createDataFrame([], _STORED)
    for at in (f"{root}_base", root):
        below = [p for p in paths if f"/{at.rstrip('/').rsplit('/', 1)[-1]}/" in p]
        if below:
            rows = rows.unionByName(spark.read.schema(_STORED).option("basePath", at).parquet(*below).select(*rows.columns))
    return rows


def _write(spark: SparkSession, root: str, rows: DataFrame, folder: Folder) -> None:
    """A folder in buckets, split or joined by size, and then its filter."""
    typed = rows.select(*[F.col(c).cast(k).alias(c) for c, k in schemas.fields(schemas.CATALOG).items()])
    placed = typed.withColumn("bucket", F.pmod(_hash(), F.lit(BUCKETS)).cast("int")).hint("rebalance", "bucket")
    placed.sortWithinPartitions("bucket", "id").write.mode("overwrite").partitionBy("bucket").parquet(folder.path)
    stored = spark.read.schema(f"{schemas.CATALOG}, bucket int").parquet(folder.path)
    slots = max(1, -(-stored.count() * BITS_PER_KEY // (BUCKETS * BITS)))
    bit = F.pmod(F.shiftright(_hash(), 8), F.lit(slots * BITS))
    bits = stored.select("bucket", F.floor(bit / BITS).cast("int").alias("slot"), (bit % BITS).alias("bit"))
    (bits.groupBy("bucket", "slot").agg(F.bitmap_construct_agg("bit").alias("bits")).withColumn("slots", F.lit(slots))
     .write.mode("overwrite").parquet(folder.filters(root)))


def may_hold(spark: SparkSession, root: str, keys: DataFrame, among: list[Folder]) -> list[str]:
    """The bucket folders that may hold one of the keys, by the filters alone: what a lookup has to read."""
    if not among:
        return []
    at = f"{root}_keys"
    filters = spark.read.schema("level int, `from` bigint, snapshot bigint, bucket int, slot int, slots int, bits binary").option("basePath", at).parquet(
        *[f.filters(root) for f in among])
    sizes = F.array(*[F.lit(r[0]) for r in filters.select("slots").distinct().collect()])  # one number for each size of folder
    wanted = keys.select(F.pmod(_hash(), F.lit(BUCKETS)).cast("int").alias("bucket"), F.shiftright(_hash(), 8).alias("h"), F.explode(sizes).alias("slots"))
    wanted = wanted.withColumn("bit", F.pmod(F.col("h"), F.col("slots") * BITS)).withColumn("slot", F.floor(F.col("bit") / BITS).cast("int"))
    byte = F.conv(F.hex(F.substring("bits", (F.col("bit") % BITS / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hits = filters.join(wanted, ["bucket", "slot", "slots"]).filter(F.getbit(byte, (F.col("bit") % 8).cast("int")) == 1)
    path = {(f.level, f.low, f.high): f.path for f in among}
    # A row per folder and bucket at most: as many as the planner would list files.
    found = hits.select("level", "from", "snapshot", "bucket").distinct().collect()
    return sorted(f"{path[r[0], r[1], r[2]]}/bucket={r[3]}" for r in found)


def known_keys(spark: SparkSession, root: str, keys: DataFrame, before: int | None = None) -> DataFrame:
    """Those of the keys that the catalog holds."""
    wanted = keys.select(*CATALOG_KEY)
    paths = may_hold(spark, root, wanted, folders(spark, root, before))
    return wanted.join(_read(spark, root, paths).select(*CATALOG_KEY), CATALOG_KEY, "left_semi").distinct()


def append(spark: SparkSession, root: str, rows: DataFrame, load_id: int, fan: int = FAN) -> None:
    """Add a load's rows, one per key, and merge folders when enough have come together.

    The newest id may be written again and is replaced.  An older one must not come with other records, since later loads rely on it, and
    one that is new but lies before merged loads is refused.
    """
    here = _all(spark, root)
    if load_id <= max((f.high for f in here if f.level), default=load_id - 1):
        if load_id not in {f.high for f in here if not f.level}:
            raise ValueError(f"load {load_id} lies before loads that are merged already")
        return
    at = work_path(spark, "catalog-batch")
    batch = saved(rows, at)
    known = known_keys(spark, root, batch, before=load_id).withColumn("known", F.lit(True))
    kept = {*CATALOG_KEY, "id", "updated_at"}
    marked = batch.join(known, CATALOG_KEY, "left")
    _write(spark, root, marked.select(*[F.col(c) if c in kept else F.when(F.col("known").isNull(), F.col(c)).alias(c) for c in batch.columns]),
           Folder(0, load_id, load_id, f"{root}/snapshot={load_id}"))
    remove(spark, at)
    merge_levels(spark, root, fan)


def merge_levels(spark: SparkSession, root: str, fan: int = FAN) -> None:
    """Merge the newest `fan` folders of a level, as long as a level has that many; then drop what earlier merges left behind."""
    before = [f for f in _all(spark, root) if f.level]
    while True:
        now = folders(spark, root)
        tail = [f for f in now if f.level == now[-1].level] if now else []
        if len(tail) < fan:
            break
        _merge(spark, root, tail)
    for f in _all(spark, root) if len(before) < len([f for f in _all(spark, root) if f.level]) else []:
        if _within(f, before):
            remove(spark, f.path)
            remove(spark, f.filters(root))


def _merge(spark: SparkSession, root: str, some: list[Folder]) -> None:
    level, low, high = max(f.level for f in some) + 1, some[0].low, some[-1].high
    rows = first_write_wins(_read(spark, root, [f.path for f in some]).drop("bucket").withColumnRenamed("snapshot", "seq"), CATALOG_KEY, ["seq"])
    _write(spark, root, rows, Folder(level, low, high, f"{root}_base/level={level}/from={low}/snapshot={high}"))


def compact(spark: SparkSession, root: str) -> None:
    """Merge all folders into one."""
    now = folders(spark, root)
    if len(now) > 1:
        _merge(spark, root, now)
