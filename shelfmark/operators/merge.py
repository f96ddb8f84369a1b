"""Keyed merges into the two tables.

``catalog``: first write wins per (url, title, price, source); a later sighting moves only ``updated_at``, and a new price
is a new row, so the table is a price history.  ``sources``: last publisher record wins, ``created_at`` stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.functions import text as t
from shelfmark.operators.quality import is_comic, is_publisher, load_reject
from shelfmark.profiles import DISPLAY_NAMES

CATALOG_KEY = ["url", "title", "price", "source"]


def source_key(source: Column) -> Column:
    return t.name_key(t.display_name(source, DISPLAY_NAMES))


def surrogate_id(*keys: str) -> Column:
    return F.sha2(F.to_json(F.array(*[F.col(k).cast("string") for k in keys])), 256)


def catalog_rows(items: DataFrame, load_ts: Column) -> DataFrame:
    """Loadable comic records in the catalog's shape, plus ``seq`` for the order within the load."""
    # A record read from an export keeps its own text; fields outside the contract are in there alone.
    built = F.to_json(F.struct(*[F.col(c) for c in schemas.fields(schemas.COMIC) if c in items.columns]))
    raw = F.coalesce("raw_json", built) if "raw_json" in items.columns else built
    rows = items.filter(is_comic() & load_reject(items).isNull()).withColumns({
        "raw_json": raw, "series_name": F.col("series"), "source": source_key(F.col("source")),
        "publisher": F.when(t.truthy(F.col("publisher")).isNotNull(), t.name_key(F.col("publisher"))),
        "price": F.col("price").try_cast("decimal(10,2)"), "original_price": F.col("original_price").try_cast("decimal(10,2)"),
        "uploaded_date": F.col("listing_date").try_cast("date"), "scraped_at_text": F.col("scraped_at"),
        "scraped_at": F.try_to_timestamp("scraped_at"), "status": F.lit("CREATED"),
        "failed_at": F.lit(None), "processed_at": F.lit(None), "failure_reason": F.lit(None),
        "created_at": load_ts, "updated_at": load_ts})
    rows = rows.withColumn("id", surrogate_id(*CATALOG_KEY))
    return rows.select(*[F.col(c).cast(k).alias(c) for c, k in schemas.fields(schemas.CATALOG).items()], "seq")


def first_write_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Earliest row per key with the time of the last sighting; ``seq`` only orders and is dropped.

    Both parts combine before the shuffle, so a key seen very often costs one row per task.
    """
    kept = [c for c in rows.columns if c not in [*keys, "seq", "updated_at"]]
    merged = rows.groupBy(*keys).agg(F.min_by(F.struct(*kept), F.struct(*order)).alias("first"), F.max("updated_at").alias("updated_at"))
    return merged.select(*[F.col(f"first.{c}").alias(c) if c in kept else F.col(c) for c in rows.columns if c != "seq"])


def refused(items: DataFrame) -> DataFrame:
    """Comic records that do not reach the catalog, with the reason."""
    rows = items.filter(is_comic()).withColumn("reason", load_reject(items)).filter(F.col("reason").isNotNull())
    return rows.select(source_key(F.col("source")).alias("source"), "seq", "url", "title", "reason")


def merge_catalog(catalog: DataFrame, batch: DataFrame) -> DataFrame:
    """Catalog after one load.

    The batch is reduced to one row per key first.  The catalog itself is only joined with the batch's keys, on its
    right side, so when those are small the engine broadcasts them by their measured size and no catalog row moves.
    """
    new = first_write_wins(batch, CATALOG_KEY, ["created_at", "seq"])
    touched = new.select(*CATALOG_KEY, F.col("updated_at").alias("seen_at"))
    known = catalog.select(*CATALOG_KEY).join(touched.select(*CATALOG_KEY), CATALOG_KEY, "left_semi")
    refreshed = catalog.join(touched, CATALOG_KEY, "left").withColumn("updated_at", F.greatest("updated_at", "seen_at"))
    return refreshed.select(*catalog.columns).unionByName(new.join(known, CATALOG_KEY, "left_anti").select(*catalog.columns))


def source_rows(items: DataFrame, load_ts: Column, runs: DataFrame | None = None) -> DataFrame:
    """Writes to ``sources`` of one load: a bare row per loaded source, then its publisher records in order."""
    ensure = (runs if runs is not None else items).select("source").distinct().select(
        source_key(F.col("source")).alias("source"), F.lit(None).cast("string").alias("description"),
        F.lit(None).cast("string").alias("url"), F.lit(0).alias("is_publisher"), F.lit(-1).cast("bigint").alias("seq"))
    told = items.filter(is_publisher()).select(
        F.when(t.truthy(F.col("name")).isNotNull(), t.name_key(F.col("name"))).alias("source"), "description",
        F.coalesce(t.truthy(F.col("url")), F.col("website")).alias("url"), F.lit(1).alias("is_publisher"), "seq")
    return ensure.unionByName(told.filter(F.col("source").isNotNull())).withColumns({"created_at": load_ts, "updated_at": load_ts})


def last_write_wins(rows: DataFrame) -> DataFrame:
    """Description and url of the latest publisher write, NULLs included; a bare row never overwrites."""
    rank = F.struct("is_publisher", F.when(F.col("is_publisher") == 1, F.col("updated_at")), F.when(F.col("is_publisher") == 1, F.col("seq")))
    written = F.when(F.col("is_publisher") == 1, F.col("updated_at"))
    return rows.groupBy("source").agg(
        F.max_by(F.struct("description", "url"), rank).alias("last"), F.min("created_at").alias("created_at"),
        F.coalesce(F.max(written), F.min("updated_at")).alias("updated_at")).select(
        surrogate_id("source").alias("id"), "source", "last.description", "last.url", "created_at", "updated_at")


def merge_sources(sources: DataFrame, batch: DataFrame) -> DataFrame:
    """Sources after one load; stored rows rank before the batch by their own ``updated_at``."""
    stored = sources.select("source", "description", "url", F.lit(1).alias("is_publisher"), F.lit(-1).cast("bigint").alias("seq"),
                            "created_at", "updated_at")
    return last_write_wins(stored.unionByName(batch))


def price_history(catalog: DataFrame, product: list[str]) -> DataFrame:
    """When each price of a product held: from its first sighting (valid_from) until the next price was first seen (valid_to, NULL for the
    newest).  Of prices first seen at one time the lowest comes first and holds for no time.

    A product's prices, not its sightings, are what one window sorts: the catalog has one row for each.
    """
    order = Window.partitionBy(*product).orderBy("created_at", "price")
    return catalog.select(*product, "price", F.col("created_at").alias("valid_from"), F.lead("created_at").over(order).alias("valid_to"),
                          F.lag("price").over(order).alias("price_before"))


def price_as_of(history: DataFrame, asked: DataFrame, product: list[str], at: str) -> DataFrame:
    """`asked` with the price that held at its time `at`, NULL before the first sighting.

    Sightings and questions are put in one order per product, and each question takes the last price at or before it: one shuffle and no join,
    so a product asked for a million times meets its prices once.
    """
    starts = history.filter(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from"))).select(
        *product, F.col("valid_from").alias("__at"), F.lit(0).alias("__kind"), F.struct("price", "valid_from").alias("__price"))
    questions = asked.select(*product, F.col(at).alias("__at"), F.lit(1).alias("__kind"), F.struct(*[c for c in asked.columns if c not in product]).alias("__row"))
    order = Window.partitionBy(*product).orderBy("__at", "__kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = F.last("__price", ignorenulls=True).over(order)
    both = starts.unionByName(questions, allowMissingColumns=True).withColumn("__held", held).filter("__kind = 1")
    return both.select(*[F.col(c) if c in product else F.col(f"__row.{c}").alias(c) for c in asked.columns],
                       F.col("__held.price").alias("price"), F.col("__held.valid_from").alias("price_since"))
