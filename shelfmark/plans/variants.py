"""Registered queries on pages of many shapes: each row of ``part`` or ``orders`` is rendered by one of several templates, so that the
second and later choices of the page rules decide rows of the result, and the SQL says what they must give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators import links as L
from shelfmark.operators.extract import extract_comics
from shelfmark.plans import jobs
from shelfmark.plans import shop_pages as S
from shelfmark.plans.queries import flat, query, table, title_case
from shelfmark.profiles import PRESS, RETAIL
from shelfmark.sources import exports as X
from shelfmark.sources.pages import as_pages, read_pages, write_pages
from shelfmark.sources.tables import read_table
from shelfmark.sources.work import work_path
from shelfmark.streaming import ingest


def pick(kind: Column, shapes: dict[int, Column], otherwise: Column) -> Column:
    """The shape of a row's kind."""
    out = F.when(F.lit(False), otherwise)
    for k, shape in shapes.items():
        out = out.when(kind == k, shape)
    return out.otherwise(otherwise)


def parts(spark: SparkSession, sf_dir: str, kinds: int) -> DataFrame:
    return S.dealt(table(spark, sf_dir, "part"), "p_partkey").withColumns({
        "kind": F.col("p_partkey") % kinds, "name": F.initcap("p_name"), "slug": F.replace("p_name", F.lit(" "), F.lit("-"))})


VARIANTS = f"WITH p AS (SELECT *, p_partkey %% %d AS kind, {title_case('p_name').replace('%', '%%')} AS name, replace(p_name, ' ', '-') AS slug FROM part)\n"

# ---- the first shop -------------------------------------------------------------------------

PRESS_HTML = """<html><body><h1 class="product_title">{title}</h1><p class="price">{prices}</p>
<div class="woocommerce-product-details__short-description">{short}</div><div class="woocommerce-Tabs-panel--description">{tab}</div>
{extra}<div class="product_meta">{meta}</div></body></html>"""


def press_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = parts(spark, sf_dir, 10)
    kind, fill = F.col("kind"), dict(name=F.col("name"), size=F.col("p_size"), brand=F.col("p_brand"), type=F.col("p_type"),
                                     now=F.format_number("p_retailprice", 2))
    r = lambda template: S.render(template, **{k: v for k, v in fill.items() if "{" + k + "}" in template})
    title = pick(kind, {1: r("{name} Issue {size} by Amit Singh"), 4: r("{name} Issue {size} – cover by Ravi Kumar"),
                        5: r("{name} Issue {size} by Amit Singh"), 6: r("Issue {size}")}, r("{name} Issue {size}"))
    prices = pick(kind, {5: r("<bdi>{size}</bdi><bdi>₹{now}</bdi><bdi>{size}</bdi>")}, r('<span class="amount">₹{now}</span>'))
    short = pick(kind, {2: r("<p>A tale without any number in it at all</p>"), 3: r("<p>A tale without any number in it at all</p>"), 7: r("")},
                 r("<p>The tale of {brand} begins in a quiet town</p>"))
    tab = pick(kind, {0: r("<p>Add to cart now and share it with everyone</p><p>Too few</p><p>Main hero: Zed</p><p>It ends well for the whole village</p>"),
                      7: r("Plain words of {brand} without any mark")}, r(""))
    extra = pick(kind, {1: r('<i data-pages="{size}"></i>'), 3: r("<b>Pages: {size}</b>")}, r(""))
    meta = pick(kind, {2: r("<span>Book of {size} pages</span>"), 4: r("<span>Artist: RAVI KUMAR.</span>"), 5: r("<span>Artist: Ravi Kumar.</span>"),
                       8: r("<table><tr><td> <td>x</table>"), 9: r('<span class="posted_in"><a>{type}</a><a> </a></span>')},
                r('<span class="posted_in"><a>{type}</a><a>Uncategorized</a></span>'))
    html = S.render(PRESS_HTML, title=title, prices=prices, short=short, tab=tab, extra=extra, meta=meta)
    url = F.concat(S.render("https://press.example/product/{k}/", k=F.col("p_partkey")), F.when(kind == 7, F.lit(" ")).otherwise(F.lit("")))
    return as_pages(p, PRESS.source, F.expr(S.RUN_TS), url, html, F.col("p_partkey"))


@query(VARIANTS % 10 + r"""
SELECT p_partkey AS seq, CASE WHEN kind NOT IN (8, 9) THEN 'https://press.example/product/' || p_partkey || '/' END AS url,
    CASE kind WHEN 4 THEN name || ' Issue ' || p_size || ' – cover by Ravi Kumar' WHEN 6 THEN 'Issue ' || p_size
              WHEN 1 THEN name || ' Issue ' || p_size || ' by Amit Singh' WHEN 5 THEN name || ' Issue ' || p_size || ' by Amit Singh'
              ELSE name || ' Issue ' || p_size END AS title,
    CASE WHEN kind NOT IN (6, 8) THEN name END AS series, CASE WHEN kind <> 8 THEN p_size::BIGINT END AS issue,
    CASE WHEN kind = 5 THEN p_size::DOUBLE ELSE p_retailprice END AS price, CASE WHEN kind = 5 THEN p_retailprice END AS original_price,
    CASE kind WHEN 0 THEN 'The tale of ' || p_brand || ' begins in a quiet town It ends well for the whole village'
              WHEN 2 THEN 'A tale without any number in it at all' WHEN 3 THEN 'A tale without any number in it at all'
              WHEN 7 THEN 'Plain words of ' || p_brand || ' without any mark' ELSE 'The tale of ' || p_brand || ' begins in a quiet town' END AS description,
    CASE kind WHEN 1 THEN 'Amit Singh' WHEN 4 THEN 'Ravi Kumar' WHEN 5 THEN 'Amit Singh|Ravi Kumar' END AS artists,
    CASE WHEN kind = 4 THEN 'Ravi Kumar' END AS cover_artist,
    CASE WHEN kind IN (2, 4, 5) THEN '' WHEN kind NOT IN (8, 9) THEN p_type END AS genre,
    CASE WHEN kind IN (1, 2, 3) THEN p_size::BIGINT WHEN kind <> 8 THEN regexp_extract(p_brand, '\d+')::BIGINT END AS pages,
    CASE kind WHEN 8 THEN 'blank_info_cell' WHEN 9 THEN 'blank_category' END AS parse_issue
FROM p""")
def press_rules(spark, sf_dir):
    """Noise and several paragraphs, page counts by attribute, meta and whole page, artists by title, credit and cover, a price list,
    a refused series, a url that needs cleaning, and records cut short."""
    return flat(extract_comics(press_variants(spark, sf_dir), PRESS), "url", "title", "series", "issue", "price", "original_price", "description",
                "artists", "cover_artist", "genre", "pages", "parse_issue")


# ---- the retailer ---------------------------------------------------------------------------

RETAIL_HTML = """<html><body><div>{left}</div>{pictures}<h1>{name} Issue {size}</h1>{brand}{prices}
<div id="tab-description">{story}</div>{table}</body></html>"""


def retail_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = parts(spark, sf_dir, 12)
    kind, fill = F.col("kind"), dict(name=F.col("name"), slug=F.col("slug"), key=F.col("p_partkey"), brand=F.col("p_brand"),
                                     now=F.format_number("p_retailprice", 2), was=F.format_number(F.col("p_retailprice") + 50, 2))
    r = lambda template: S.render(template, **{k: v for k, v in fill.items() if "{" + k + "}" in template})
    brand = pick(kind, {0: r(""), 1: r('<a href="/manufacturer/x">ComicsAdda</a>'), 2: r(""), 3: r("")}, r('<span class="brand">{brand}</span>'))
    rows = pick(kind, {0: r('<table class="attribute"><tr><td>Publisher<td>{brand}</table>')}, r(""))
    story = pick(kind, {2: r("Published by {name} House. A tale"), 3: r("Published by Individual. A tale"), 11: r(" <p> </p>")}, r("A tale"))
    prices = pick(kind, {
        0: r('<ul class="list-unstyled"><li>x<li><span>{was}</span><li><span>{now}</span><li><span>5</span></ul>'),
        1: r('<span class="price-new">{now}</span><span class="price-old">{was}</span>'),
        2: r('<ul class="list-unstyled"><li>x<li><span>{now}</span></ul>')},
        r('<ul class="list-unstyled"><li><span style="text-decoration: line-through;">₹{was}INR</span><li><h2>₹{now}INR</h2></ul>'))
    pictures = pick(kind, {
        4: r('<ul class="thumbnails"><a class="thumbnail" href="/image/placeholder.png"><img src="/image/cache/catalog/{slug}-300x300.jpg"></a></ul>'),
        5: r('<div class="product-info"><img data-zoom-image="/image/{slug}-1000x800.jpg" src="/image/x-100x100.jpg"></div>'),
        6: r('<div class="image"><img data-zoom-image="/image/{slug}-big.jpg"></div>'),
        7: r('<div class="product-info"><img src="/image/placeholder.png"><img src="/image/{slug}-600x9.png"><img src="/image/{slug}-1000x800.jpg">'
             '<img src="/image/a-1000x800.jpg"></div>'),
        8: r('<img src="/image/{slug}-a.jpg"><img src="/image/{slug}-b.jpg"><div class="related-products"><img src="/image/{slug}-r.jpg"></div>'),
        9: r('<img src="/image/z.jpg">'), 10: r('<img src="/image/placeholder-{key}.png">')}, r('<ul class="thumbnails"><a class="thumbnail" href="/image/{slug}.png"></a></ul>'))
    left = pick(kind, {9: r('<div class="col-lg-6"><img src="/image/{slug}-left.jpg"></div>')}, r(""))
    html = S.render(RETAIL_HTML, left=left, pictures=pictures, name=F.col("name"), size=F.col("p_size"), brand=brand, prices=prices, story=story, table=rows)
    return as_pages(p, RETAIL.source, F.expr(S.RUN_TS), S.render("https://retail.example/product/{k}", k=F.col("p_partkey")), html, F.col("p_partkey"))


@query(VARIANTS % 12 + """
SELECT p_partkey AS seq, name || ' Issue ' || p_size AS title, CASE WHEN kind <> 11 THEN name END AS series,
    CASE kind WHEN 1 THEN 'Unknown' WHEN 2 THEN name || ' House' WHEN 3 THEN 'Unknown' ELSE p_brand END AS publisher,
    p_retailprice AS price, CASE WHEN kind = 2 THEN p_retailprice ELSE round(p_retailprice + 50, 2) END AS original_price,
    CASE kind WHEN 2 THEN 'Published by ' || name || ' House. A tale' WHEN 3 THEN 'Published by Individual. A tale' WHEN 11 THEN NULL ELSE 'A tale' END AS description,
    'https://retail.example/image/' || CASE kind WHEN 4 THEN 'cache/catalog/' || slug || '-700x700.jpg' WHEN 5 THEN slug || '-1000x800.jpg'
        WHEN 6 THEN slug || '-big.jpg' WHEN 7 THEN slug || '-1000x800.jpg' WHEN 8 THEN slug || '-b.jpg' WHEN 9 THEN slug || '-left.jpg'
        WHEN 10 THEN 'placeholder-' || p_partkey || '.png' WHEN 11 THEN NULL ELSE slug || '.png' END AS cover_image_url,
    CASE WHEN kind = 11 THEN 'blank_description' END AS parse_issue
FROM p""")
def retail_rules(spark, sf_dir):
    """Publishers by attribute row, by the story and refused ones; prices by list and by class; every later choice of the cover image; a blank story."""
    return flat(extract_comics(retail_variants(spark, sf_dir), RETAIL), "title", "series", "publisher", "price", "original_price", "description",
                "cover_image_url", "parse_issue")


# ---- paging ---------------------------------------------------------------------------------

@query("""
WITH k AS (SELECT p_partkey AS k, max(p_partkey) OVER () AS top FROM part),
c AS (SELECT k, CASE WHEN k >= top - 1 THEN 'constructed' WHEN k % 2 = 0 THEN 'load_more' END AS kind FROM k)
SELECT -k AS seq, 1::BIGINT AS new_products, kind, CASE kind WHEN 'constructed' THEN 'https://press.example/shop/page/' || (k + 1) || '/'
       WHEN 'load_more' THEN 'https://press.example/more/' || k END AS next_url, CASE WHEN kind IS NULL THEN 'no_next_link' END AS stop_reason FROM c""")
def next_page_more(spark, sf_dir):
    """Listing pages fetched from the last to the first, so that the page a rule would construct is a visited one and only the button leads on."""
    k = F.col("p_partkey")
    more = F.when(k % 2 == 0, S.render('<button class="load-more" data-url="/more/{k}">more</button>', k=k))
    html = S.render('<html><body><a href="/product/{k}/">p</a>{more}</body></html>', k=k, more=more)
    pages = as_pages(S.dealt(table(spark, sf_dir, "part"), "p_partkey"), PRESS.source, F.expr(S.RUN_TS), S.render("https://press.example/shop/page/{k}/", k=k), html, -k)
    return L.next_page(pages, PRESS).select("seq", "new_products", "kind", "next_url", "stop_reason")


@query("""
WITH l AS (SELECT o_orderkey AS n, o_orderstatus AS s, o_orderpriority AS p, strftime(o_orderdate, '%Y%m') AS run_id FROM orders)
SELECT run_id, n AS seq, CASE WHEN s = 'O' THEN 1 ELSE 0 END::BIGINT AS new_products,
       CASE WHEN s = 'P' THEN NULL WHEN p IN ('1-URGENT', '2-HIGH') THEN 'next' WHEN p = '3-MEDIUM' THEN 'number' ELSE 'constructed' END AS kind,
       CASE WHEN s = 'P' THEN NULL WHEN p = '1-URGENT' THEN 'https://retail.example/index.php?route=product/category&path=1&page=' || (n + 1)
            WHEN p = '2-HIGH' THEN 'https://retail.example/index.php?route=product/category&path=1&page=' || (n + 2)
            WHEN p = '3-MEDIUM' THEN 'https://retail.example/index.php?route=product/category&path=1&page=' || (n + 3)
            WHEN s = 'F' THEN 'https://retail.example/cat-' || n || '?page=2' ELSE 'https://retail.example/index.php?page=' || (n + 1) END AS next_url,
       CASE WHEN s = 'P' THEN 'no_products' END AS stop_reason FROM l""")
def next_page_retail(spark, sf_dir):
    """The retailer's paging: a page without products ends it only where its url names a page."""
    n, p, s = F.col("o_orderkey"), F.col("o_orderpriority"), F.col("o_orderstatus")
    to = "/index.php?route=product/category&amp;path=1&amp;page={n}"
    paging = (F.when(p == "1-URGENT", S.render(f'<a rel="next" href="{to}">on</a>', n=n + 1))
              .when(p == "2-HIGH", S.render(f'<ul class="pagination"><li><a href="{to}">Next</a></ul>', n=n + 2))
              .when(p == "3-MEDIUM", S.render(f'<ul class="pagination"><li><a href="{to}">c</a></ul>', n=n + 3)))
    product = F.when(s == "O", S.render('<a href="/index.php?route=product/product&amp;product_id={n}">p</a>', n=n))
    html = S.render("<html><body>{product}{paging}</body></html>", product=product, paging=paging)
    url = F.when(s == "F", S.render("https://retail.example/cat-{n}", n=n)).otherwise(
        S.render("https://retail.example/index.php?route=product/category&path=1&page={n}", n=n))
    pages = as_pages(S.dealt(table(spark, sf_dir, "orders"), "o_orderkey"), RETAIL.source, F.col("o_orderdate"), url, html, n, run_id=F.date_format("o_orderdate", "yyyyMM"))
    return L.next_page(pages, RETAIL).select("run_id", "seq", "new_products", "kind", "next_url", "stop_reason")


# ---- one record stream ----------------------------------------------------------------------

@query(f"""
SELECT 'comic' AS entity, '20251125' AS run_id, p_partkey AS seq, CASE WHEN p_partkey % 10 NOT IN (8, 9) THEN 'https://press.example/product/' || p_partkey || '/' END AS url FROM part
UNION ALL SELECT 'series', '20251125', p_partkey, 'https://press.example/product/' || p_partkey || '/' FROM part WHERE p_partkey % 10 = 9
UNION ALL SELECT 'publisher', strftime(o_orderdate, '%Y%m'), min(o_orderkey), '{PRESS.website}' FROM orders WHERE o_totalprice >= 1200 GROUP BY 2""")
def run_records(spark, sf_dir):
    """Publisher, comic and series records of product and listing pages together."""
    pages = press_variants(spark, sf_dir).unionByName(S.listing_pages(spark, sf_dir, PRESS.source))
    return jobs.items(pages, [PRESS]).select("entity", "run_id", "seq", "url")


# ---- loads and streams ----------------------------------------------------------------------

@query(f"""
WITH o AS (SELECT *, o_orderdate >= DATE '1998-01-01' AS late, 'u' || o_custkey AS url, CAST(round(o_totalprice / 50000) AS DECIMAL(10,2)) AS price FROM orders),
k AS (SELECT url, o_orderstatus AS title, price, arg_min(o_orderpriority, row(late, o_orderkey)) AS description, arg_min(o_orderkey, row(late, o_orderkey)) AS extra,
             min(late) AS first_late, max(late) AS last_late FROM o WHERE o_custkey % 7 <> 0 GROUP BY ALL)
SELECT url, title, price::DOUBLE AS price, description, extra::VARCHAR AS extra, CASE WHEN first_late THEN TIMESTAMP '1998-01-01' ELSE TIMESTAMP '1997-01-01' END AS created_at,
       CASE WHEN last_late THEN TIMESTAMP '1998-01-01' ELSE TIMESTAMP '1997-01-01' END AS updated_at, NULL AS reason FROM k
UNION ALL SELECT url, o_orderstatus, NULL, NULL, NULL, NULL, NULL, 'no_scraped_at' FROM o WHERE o_custkey % 7 = 0""")
def export_load(spark, sf_dir):
    """Exported records in two loads: catalog rows with a field that only the stored record text has, and the refused records."""
    o = table(spark, sf_dir, "orders")
    record = F.to_json(F.struct(
        F.col("o_orderstatus").alias("title"), F.round(F.col("o_totalprice") / 50000).alias("price"), F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("url"),
        F.col("o_orderpriority").alias("description"), F.when(F.col("o_custkey") % 7 != 0, "2025-11-25T09:30:00+05:30").alias("scraped_at"),
        F.struct(F.col("o_orderkey").alias("k")).alias("extra")))
    docs = o.select(F.lit(PRESS.source).alias("source"), F.col("o_orderkey").alias("seq"), "o_orderdate", F.concat(F.lit("["), record, F.lit("]")).alias("value"))
    root, years = work_path(spark, "export-load"), ("1997-01-01", "1998-01-01")
    late = F.col("o_orderdate") >= F.lit("1998-01-01").cast("date")
    for load_id, (year, part) in enumerate(zip(years, (~late, late))):
        stored = f"{root}/items/load={load_id}"
        X.parse_export(docs.filter(part)).write.parquet(stored)
        jobs.load(spark, spark.read.parquet(stored), root, load_id, F.lit(year).cast("timestamp"))
    rows = read_table(spark, "catalog", f"{root}/catalog").select(
        "url", "title", F.col("price").cast("double").alias("price"), "description", F.get_json_object("raw_json", "$.extra.k").alias("extra"), "created_at", "updated_at")
    refused = spark.read.parquet(*[f"{root}/rejects/snapshot={i}" for i in range(len(years))])
    return rows.unionByName(refused.select("url", "title", "reason"), allowMissingColumns=True)


@query(f"""
SELECT 'item' AS kind, 'comic' AS entity, '20251125' AS run_id, CASE WHEN p_partkey % 10 NOT IN (8, 9) THEN 'https://press.example/product/' || p_partkey || '/' END AS url, count(*) AS n
FROM part, range(2) r(i) WHERE i = 0 OR p_partkey % 10 IN (8, 9) GROUP BY ALL
UNION ALL SELECT 'item', 'series', '20251125', 'https://press.example/product/' || p_partkey || '/', 1 FROM part WHERE p_partkey % 10 = 9
UNION ALL SELECT 'item', 'publisher', strftime(o_orderdate, '%Y%m'), '{PRESS.website}', 1 FROM orders WHERE o_totalprice >= 1200 GROUP BY 3
UNION ALL SELECT 'catalog', 'comic', NULL, 'https://press.example/product/' || p_partkey || '/', 1 FROM part WHERE p_partkey % 10 NOT IN (8, 9) AND CAST(regexp_extract(p_brand, '[0-9]+') AS INT) > 0
UNION ALL SELECT 'source', NULL, NULL, '{PRESS.website}', 1""")
def stream_load(spark, sf_dir):
    """Pages as a file stream, all product pages arriving twice: records with a url are kept once, and both tables follow batch by batch."""
    root = work_path(spark, "stream-load")
    products = press_variants(spark, sf_dir)
    for arriving in (products, products.unionByName(S.listing_pages(spark, sf_dir, PRESS.source))):
        write_pages(arriving, f"{root}/pages")
        records = ingest.record_stream(ingest.page_stream(spark, f"{root}/pages"), [PRESS])
        ingest.write_merged(records, f"{root}/tables", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    items = spark.read.parquet(f"{root}/tables/items").groupBy(F.lit("item").alias("kind"), "entity", F.col("run_id").cast("string").alias("run_id"), "url").agg(F.count("*").alias("n"))
    catalog = read_table(spark, "catalog", f"{root}/tables/catalog").groupBy(F.lit("catalog").alias("kind"), F.lit("comic").alias("entity"), "url").agg(F.count("*").alias("n"))
    sources = read_table(spark, "sources", f"{root}/tables/sources").groupBy(F.lit("source").alias("kind"), "url").agg(F.count("*").alias("n"))
    return items.unionByName(catalog, allowMissingColumns=True).unionByName(sources, allowMissingColumns=True)


@query("SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'odd' ELSE 'even' END AS source, p_name AS title, p_retailprice AS price, p_type || '/' || p_brand AS genre FROM part")
def json_round_trip(spark, sf_dir):
    """Records written as JSON exports and read back by run date and source."""
    path = work_path(spark, "json")
    items = table(spark, sf_dir, "part").select(
        F.lit("comic").alias("entity"), F.col("p_partkey").alias("seq"), F.col("p_name").alias("title"), F.col("p_retailprice").alias("price"),
        F.array("p_type", "p_brand").alias("genre"), F.to_date(F.lit("2025-11-25")).alias("run_date"), F.when(F.col("p_type") == "PROMO", "odd").otherwise("even").alias("source"))
    X.write_json(items, path)
    return X.read_json(spark, path).filter("run_date = DATE'2025-11-25'").select(
        F.col("seq").alias("p_partkey"), "source", "title", "price", F.array_join("genre", "/").alias("genre"))


@query("SELECT page_id, url, html FROM pages")
def pages_table(spark, sf_dir):
    """The pages table as stored, one folder per run and source, read back for one source."""
    path = work_path(spark, "pages")
    stored = as_pages(table(spark, sf_dir, "pages"), "site", F.expr(S.RUN_TS), F.col("url"), F.col("html"), F.col("page_id"))
    write_pages(stored, path)
    return read_pages(spark, path).filter("source = 'site'").select(F.col("seq").alias("page_id"), "url", "html")
