"""Shop pages rendered by Spark from ordinary tables, so that every page rule can be exercised at any scale.

One page per row of ``part`` (product pages) or ``orders`` (listing pages); nothing is grouped or collected.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.profiles import PRESS, RETAIL, STUDIO
from shelfmark.sources.pages import as_pages

RUN_TS = "timestamp'2025-11-25 04:00:00'"


def render(template: str, **values: Column) -> Column:
    """Fill ``{name}`` places with columns; NULL counts as empty."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[F.lit(p) if i % 2 == 0 else F.coalesce(values[p].cast("string"), F.lit("")) for i, p in enumerate(parts)])


def escaped(c: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(char), F.lit(entity))
    return c


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt anew over at least all cores, for rules that cost far more than their bytes suggest: a file of one row group is one task
    otherwise, and an exchange without a number is drawn together by its bytes."""
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions()), *keys)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with the document of the same number as their story, and the words the page rules look for."""
    part = read(spark, sf_dir, "part").withColumns({
        "name": F.initcap("p_name"), "slug": F.replace("p_name", F.lit(" "), F.lit("-")),
        "lang": F.when(F.col("p_type") == "PROMO", "Hindi").when(F.col("p_type") == "SMALL", "English"),
        "form": F.when(F.col("p_type") == "LARGE", "Hardcover").when(F.col("p_type") == "ECONOMY", "Paper Back"),
        "brand_no": F.regexp_extract("p_brand", r"\d+", 0)})
    stories = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("p_partkey"), "text")
    return dealt(part, "p_partkey").join(stories, "p_partkey", "left")


PRESS_HTML = """<html><head><title>{title}</title></head><body><h1 class="product_title entry-title"> {title}
</h1><p class="price"><del><span class="amount">₹{was}</span></del> <ins><span class="amount">₹{now}</span></ins></p>
<div class="woocommerce-Tabs-panel--description"><h2>Story</h2><p>{story}</div>
<div class="woocommerce-product-gallery__image"><img src="/wp-content/uploads/{year}/{month}/{slug}.jpg"></div>
<table class="woocommerce-Tabs-panel--additional_information"><tr><th>Writer<td>{name} &amp; Co, {brand}<tr><th>Pages<td>{size} Pages
<tr><th>Format<td>{form}.</table>
<div class="product_meta"><span class="sku">SKU-{key}</span><span class="posted_in"><a>{type}</a><a>Uncategorized</a></span></div>
</body></html>"""

STUDIO_HTML = """<html><body><h1 class="entry-title">{title}</h1><p class="price"><span class="amount">Rs. {now}</span></p>
<div class="x woocommerce-Tabs-panel--description"><h2>Description</h2><p>{story}</p><table><tr><td><p>not this</p></table></div>
<div class="product_meta"><table><tr><td>Artist</td><td>{name}</td></tr><tr><td>Binding</td><td>{form}</td></tr></table>
<b class="sku">{key}</b></div></body></html>"""

RETAIL_HTML = """<html><body><div class="col-sm-6"><ul class="thumbnails"><li><a class="thumbnail" href="/image/{thumb}"><img
src="/image/cache/catalog/{slug}-300x300.jpg"></a></ul></div><h1>{title}</h1><ul class="list-unstyled"><li>Brand: <a
href="/index.php?route=product/manufacturer/info&amp;id={brand}">{brand}</a></ul>
<ul class="list-unstyled"><li><span style="text-decoration: line-through;">₹{was}INR</span><li><h2>₹{now}INR</h2></ul>
<div id="tab-description">{story}</div><table class="attribute"><tr><td>Page Count<td>{size}<tr><td>Binding<td>{form}</table></body></html>"""


def press_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = products(spark, sf_dir)
    title = F.concat_ws(" ", "name", F.concat(F.lit("Issue "), "p_size"), "lang", "form")
    html = render(PRESS_HTML, title=title, name=F.col("name"), was=F.format_number(F.col("p_retailprice") + 50, 2),
                  now=F.format_number("p_retailprice", 2), story=escaped(F.col("text")), year=F.col("p_size") + 2000, month=F.col("brand_no"),
                  slug=F.col("slug"), brand=F.col("p_brand"), size=F.col("p_size"), form=F.col("form"), key=F.col("p_partkey"),
                  type=F.col("p_type"))
    url = render("https://press.example/product/{slug}-{size}/", slug=F.col("slug"), size=F.col("p_size"))
    return as_pages(p, PRESS.source, F.expr(RUN_TS), url, html, F.col("p_partkey"))


def studio_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = products(spark, sf_dir)
    title = F.when(F.col("p_type") == "STANDARD", F.concat("name", F.lit(": Tales #"), "p_size")).otherwise(
        F.concat_ws(" ", "name", "lang", F.concat(F.lit("Vol. "), "p_size")))
    html = render(STUDIO_HTML, title=title, now=F.col("p_retailprice").cast("decimal(12,2)"), story=escaped(F.col("text")),
                  name=F.col("p_name"), form=F.coalesce("form", F.lit("Saddle")), key=F.col("p_partkey"))
    url = render("https://studio.example/product/{slug}-{key}-by-{slug}/", slug=F.col("slug"), key=F.col("p_partkey"))
    return as_pages(p, STUDIO.source, F.expr(RUN_TS), url, html, F.col("p_partkey"))


def retail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = products(spark, sf_dir)
    title = F.concat("name", F.lit(" Issue "), "p_size", F.when(F.col("lang").isNotNull(), F.concat(F.lit(" "), "lang")).otherwise(F.lit("")),
                     F.when(F.col("p_type") == "MEDIUM", " (Pre Booking)").otherwise(F.lit("")))
    html = render(RETAIL_HTML, title=title, thumb=F.when(F.col("p_type") == "PROMO", F.lit("placeholder.png")).otherwise(F.concat("slug", F.lit(".png"))),
                  slug=F.col("slug"), brand=F.col("p_brand"), was=F.format_number(F.col("p_retailprice") + 50, 2),
                  now=F.format_number("p_retailprice", 2), story=escaped(F.col("text")), size=F.col("p_size"), form=F.col("form"))
    url = render("https://retail.example/index.php?route=product/product&product_id={key}", key=F.col("p_partkey"))
    return as_pages(p, RETAIL.source, F.expr(RUN_TS), url, html, F.col("p_partkey"))


LISTING_HTML = """<html><body><footer><p>Shop of {segment}</p></footer><ul class="products"><li class="product"><a
href="/product/customer-{cust}/">c</a><li class="product"><a href='{second}'>o</a></ul><!-- <a href="/product/none/"> -->{paging}</body></html>"""


def listing_pages(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """One listing page per order; a run per order month.  A page links its customer, and some link their own number."""
    o = dealt(read(spark, sf_dir, "orders"), "o_orderkey")
    n, p = F.col("o_orderkey"), F.col("o_orderpriority")
    second = F.when(F.col("o_orderstatus") == "O", render("/product/order-{n}/", n=n)).otherwise(F.lit("/about/"))
    paging = (F.when(p == "1-URGENT", render('<a class="next" href="/shop/page/{n}/">next</a>', n=n + 1))
              .when(p == "2-HIGH", render('<nav class="pagination"><a href="/shop/page/{b}/">b</a><a href="/shop/page/{f}/">f</a></nav>', b=n - 1, f=n + 2))
              .when(p == "3-MEDIUM", render('<a class="next" href="">here</a><a rel="next" href="../{n}/">next</a>', n=n + 3)))
    html = render(LISTING_HTML, segment=F.col("o_orderstatus"), cust=F.col("o_custkey"), second=second, paging=paging)
    url = render("https://press.example/shop/page/{n}/", n=n)
    status = F.when(F.col("o_totalprice") < 1200, 404).otherwise(200)
    return as_pages(o, source, F.col("o_orderdate"), url, html, n, run_id=F.date_format("o_orderdate", "yyyyMM"), status=status)
