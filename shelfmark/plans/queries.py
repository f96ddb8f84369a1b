"""Registered queries: each operator over whole tables, with the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.functions import images, text as t
from shelfmark.functions.urls import resolve
from shelfmark.operators import links as L
from shelfmark.operators import merge as M
from shelfmark.operators import quality as Q
from shelfmark.operators.extract import extract_comics, issue_of, series_of, woo_prices
from shelfmark.operators.records import distinct_series, publisher_record
from shelfmark.operators.shred import from_html
from shelfmark.operators.summary import run_summary
from shelfmark.plans import jobs
from shelfmark.plans import shop_pages as S
from shelfmark.profiles import DISPLAY_NAMES, PRESS, RETAIL, STUDIO
from shelfmark.session import tune
from shelfmark.sources import exports as X
from shelfmark.sources.pages import as_pages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Building blocks of the SQL, in DuckDB's regex dialect.
WS = r"[\t\n\x0B\f\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
NW = r"(?:^|[^\p{L}\p{N}_])"
NE = r"(?:[^\p{L}\p{N}_]|$)"


def clean(c: str) -> str:
    return f"nullif(trim(regexp_replace({c}, '{WS}', ' ', 'g')), '')"


def first_number(c: str) -> str:
    return rf"try_cast(nullif(regexp_extract(replace({c}, ',', ''), '\d+\.?\d*', 0), '') AS double)"


def title_case(c: str) -> str:
    return f"array_to_string(list_transform(string_split({c}, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"


HOST = "nullif(regexp_extract(url, 'https?://([^/]+)', 1), '')"


def query(sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)
        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- pages: scan, titles, hosts -------------------------------------------------------------

@query(f"""
WITH p AS (SELECT url, {clean("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")} AS raw, {HOST} AS host FROM pages),
d AS (SELECT url, min(host) AS host, min(raw) AS title FROM p GROUP BY url)
SELECT host, count(*) AS pages, count(title) AS titled FROM d GROUP BY host""")
def title_by_host(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    titled = pages.select("page_id", "url", F.get(from_html(F.col("html"), {"title": "title::text"})["title"], F.lit(0)).alias("title"))
    return (Q.first_per(titled, ["url"], [F.col("page_id")]).withColumn("title", t.clean_text(F.col("title")))
            .groupBy(t.url_host(F.col("url")).alias("host")).agg(F.count("*").alias("pages"), F.count("title").alias("titled")))


@query(rf"""
SELECT page_id, {clean("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)").replace("regexp_extract(html", "(regexp_extract(html")
                 .replace("</h1>', 1)", "</h1>', 1))")} AS h1,
       len(regexp_extract_all(html, '<nav>.*?</nav>')) AS navs, len(regexp_extract_all(html, '<p>')) AS paragraphs
FROM pages""")
def page_nodes(spark, sf_dir):
    h = from_html(F.col("html"), {"h1": "h1::deep", "navs": "nav::attr(class), nav::html", "paragraphs": "p::html"})
    picked = table(spark, sf_dir, "pages").select("page_id", h.alias("h"))
    return picked.select("page_id", t.clean_text(F.replace(F.replace(F.replace(F.array_join("h.h1", ""), F.lit("&"), F.lit("&amp;")),
                                                                     F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))).alias("h1"),
                         F.size("h.navs").cast("bigint").alias("navs"), F.size("h.paragraphs").cast("bigint").alias("paragraphs"))


@query(f"""
SELECT url, {HOST} AS host,
       regexp_matches(url, '^https?://([^/]*\\.)?example\\.com(/|$)') AS in_scope FROM pages""")
def domain_scope(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("url", t.url_host(u).alias("host"), t.in_domains(u, ["example.com"]).alias("in_scope"))


# ---- links ----------------------------------------------------------------------------------

# A profile whose product pages are any rooted link, as the plain pages table has no shop markup.
ANY_LINK = replace(PRESS, source="site", family="retail", product_markers=["/"], stop_markers=["page="], page_number=[r"[?&]page=(\d+)"])


def site_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_pages(table(spark, sf_dir, "pages"), "site", F.expr(S.RUN_TS), F.col("url"), F.col("html"), F.col("page_id"))


LINKS_SQL = """
WITH raw AS (SELECT url, page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages),
links AS (SELECT DISTINCT url, page_id, regexp_extract(url, '^https?://[^/]+', 0) || replace(href, '&amp;', '&') AS link_url
          FROM raw WHERE contains(href, '/'))
"""


@query(LINKS_SQL + "SELECT url, link_url FROM links")
def links_exploded(spark, sf_dir):
    return L.product_links(site_pages(spark, sf_dir), ANY_LINK).select("url", "link_url")


@query(LINKS_SQL + "SELECT DISTINCT link_url FROM links WHERE link_url NOT IN (SELECT url FROM pages)")
def frontier(spark, sf_dir):
    pages = site_pages(spark, sf_dir)
    return L.frontier(L.product_links(pages, ANY_LINK), pages).select("link_url")


@query(LINKS_SQL + """
, firsts AS (SELECT link_url, min(page_id) AS page_id FROM links GROUP BY link_url)
SELECT p.page_id, count(f.link_url) AS new_links FROM pages p LEFT JOIN firsts f USING (page_id) GROUP BY p.page_id""")
def new_links_per_page(spark, sf_dir):
    pages = site_pages(spark, sf_dir)
    fresh = L.first_seen(L.product_links(pages, ANY_LINK)).groupBy("seq").agg(F.count("*").alias("n"))
    return pages.select("seq").join(fresh, "seq", "left").select(F.col("seq").alias("page_id"), F.coalesce("n", F.lit(0)).alias("new_links"))


def based_pages(spark: SparkSession, sf_dir: str, shop) -> DataFrame:
    """A listing page per order: some have a base element, and every link is written with character references."""
    o, n = S.dealt(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), "o_orderkey"), F.col("o_orderkey")
    base = F.when(F.col("o_orderstatus") == "F", F.lit('<head><base target="_top"><base href="https://shop.example/"></head>')).when(
        F.col("o_orderstatus") == "P", F.lit("<head><BASE HREF='/sub/'></head>"))
    path = "shop/product/p{n}/?a=1&#038;b=&eacute;&#x26;c={c}" if shop is PRESS else "index.php?route=product/product&amp;product_id={n}&#x26;c=&#{c};"
    html = S.render("<html>{base}<body><a href=\"" + path + "\">p</a></body></html>", base=base, n=n, c=F.col("o_custkey") % 50 + 50)
    return as_pages(o, shop.source, F.expr(S.RUN_TS), S.render("https://s.example/cat/list/{n}/", n=n), html, n)


@query("""
WITH p AS (SELECT o_orderkey AS n, o_custkey % 50 + 50 AS c, CASE o_orderstatus WHEN 'F' THEN 'https://shop.example/' WHEN 'P' THEN 'https://s.example/sub/'
           ELSE 'https://s.example/cat/list/' || o_orderkey || '/' END AS base FROM orders)
SELECT 'press' AS shop, n, base || 'shop/product/p' || n || '/?a=1&b=é&c=' || c AS link_url FROM p
UNION ALL SELECT 'retail', n, base || 'index.php?route=product/product&product_id=' || n || '&c=' || chr(c::INTEGER) FROM p""")
def links_based(spark, sf_dir):
    found = lambda shop: L.product_links(based_pages(spark, sf_dir, shop), shop)
    return found(PRESS).select(F.lit("press").alias("shop"), F.col("seq").alias("n"), "link_url").unionByName(
        found(RETAIL).select(F.lit("retail").alias("shop"), F.col("seq").alias("n"), "link_url"))


@query(r"""
SELECT url, coalesce(try_cast(nullif(regexp_extract(url, '[?&]page=(\d+)', 1), '') AS bigint), 1) AS page_no,
       regexp_replace(url, '\?.*$', '') || '?page=' ||
       (coalesce(try_cast(nullif(regexp_extract(url, '[?&]page=(\d+)', 1), '') AS bigint), 1) + 1) AS next_retail,
       regexp_replace(regexp_replace(url, '\?.*$', ''), '/+$', '') || '/page/2/' AS next_woo
FROM pages""")
def next_page_constructed(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "url", F.coalesce(L.page_number(u, RETAIL), F.lit(1)).alias("page_no"), L.constructed_next(u, RETAIL).alias("next_retail"),
        L.constructed_next(F.replace(u, F.lit("page="), F.lit("p=")), PRESS).alias("next_woo"))


NEXT_PAGE_SQL = r"""
WITH l AS (SELECT o_orderkey AS n, o_custkey, o_orderstatus, o_orderpriority AS p, strftime(o_orderdate, '%Y%m') AS run_id,
                  CASE WHEN o_totalprice < 1200 THEN 404 ELSE 200 END AS status FROM orders),
links AS (SELECT run_id, n, 'https://press.example/product/customer-' || o_custkey || '/' AS u FROM l WHERE status = 200
          UNION ALL SELECT run_id, n, 'https://press.example/product/order-' || n || '/' FROM l WHERE status = 200 AND o_orderstatus = 'O'),
seen AS (SELECT run_id, u, min(n) AS n FROM links GROUP BY ALL),
fresh AS (SELECT run_id, n, count(*) AS new_products FROM seen GROUP BY ALL),
gone AS (SELECT run_id, min(n) AS gone FROM l WHERE status = 404 GROUP BY ALL),
picks AS (SELECT l.*, coalesce(new_products, 0) AS new_products,
    CASE WHEN p = '1-URGENT' THEN 'next' WHEN p = '2-HIGH' THEN 'number' WHEN p = '3-MEDIUM' THEN 'next' ELSE 'constructed' END AS kind,
    CASE WHEN p = '1-URGENT' THEN 'https://press.example/shop/page/' || (n + 1) || '/'
         WHEN p = '2-HIGH' THEN 'https://press.example/shop/page/' || (n + 2) || '/'
         WHEN p = '3-MEDIUM' THEN 'https://press.example/shop/page/' || (n + 3) || '/'
         ELSE 'https://press.example/shop/page/' || (n + 1) || '/' END AS next_url,
    CASE WHEN status = 404 THEN 'not_found' WHEN gone < n THEN 'after_not_found' WHEN coalesce(new_products, 0) = 0 THEN 'no_products' END AS stop_reason
    FROM l LEFT JOIN fresh USING (run_id, n) LEFT JOIN gone USING (run_id))
SELECT run_id, n AS seq, 'https://press.example/shop/page/' || n || '/' AS url, new_products,
       CASE WHEN stop_reason IS NULL THEN kind END AS kind, CASE WHEN stop_reason IS NULL THEN next_url END AS next_url,
       stop_reason FROM picks"""


@query(NEXT_PAGE_SQL)
def next_page(spark, sf_dir):
    return L.next_page(S.listing_pages(spark, sf_dir, PRESS.source), PRESS).drop("source")


@query(r"""
SELECT l_orderkey, l_linenumber,
       CASE l_returnflag WHEN 'A' THEN 'https://h.example/a/' || l_partkey || '/' || l_suppkey
                         WHEN 'N' THEN 'https://h.example/' || l_suppkey || '?q=' || l_partkey
                         ELSE 'https://cdn.example/' || l_partkey END AS resolved,
       'https://h.example/a/b/' || l_orderkey || '?x=1#' || l_linenumber AS fragment
FROM lineitem""")
def url_resolution(spark, sf_dir):
    base = S.render("https://h.example/a/b/{o}?x=1", o=F.col("l_orderkey"))
    link = (F.when(F.col("l_returnflag") == "A", S.render("../{p}/./{s}", p=F.col("l_partkey"), s=F.col("l_suppkey")))
            .when(F.col("l_returnflag") == "N", S.render("/{s}?q={p}", p=F.col("l_partkey"), s=F.col("l_suppkey")))
            .otherwise(S.render("//cdn.example/{p}", p=F.col("l_partkey"))))
    rows = S.dealt(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_partkey", "l_suppkey"), "l_orderkey", "l_linenumber")
    return rows.select("l_orderkey", "l_linenumber", resolve(base, link).alias("resolved"),
                       resolve(base, S.render("#{n}", n=F.col("l_linenumber"))).alias("fragment"))


# ---- scalar functions -----------------------------------------------------------------------

@query(f"SELECT doc_id, {clean('text')} AS cleaned FROM documents")
def clean_text_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", t.clean_text(F.col("text")).alias("cleaned"))


@query(f"SELECT doc_id, {first_number('text')} AS first_number FROM documents")
def first_number_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", t.extract_number(F.col("text")).alias("first_number"))


@query(r"""
WITH d AS (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y-%-m-%-d')
    WHEN '2-HIGH' THEN strftime(o_orderdate, '%m/%d/%Y') WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%d/%m/%Y')
    WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate, ' %B %-d, %Y') ELSE strftime(o_orderdate, '%d-%m-%Y') END AS given FROM orders)
SELECT o_orderkey, given, coalesce(strftime(try_strptime(trim(given), '%Y-%m-%d'), '%Y-%m-%d'), strftime(try_strptime(trim(given), '%m/%d/%Y'), '%Y-%m-%d'),
    strftime(try_strptime(trim(given), '%d/%m/%Y'), '%Y-%m-%d'), strftime(try_strptime(trim(given), '%B %d, %Y'), '%Y-%m-%d'), trim(given)) AS parsed FROM d""")
def date_cascade(spark, sf_dir):
    d, p = F.col("o_orderdate"), F.col("o_orderpriority")
    given = (F.when(p == "1-URGENT", F.date_format(d, "yyyy-M-d")).when(p == "2-HIGH", F.date_format(d, "MM/dd/yyyy"))
             .when(p == "3-MEDIUM", F.date_format(d, "dd/MM/yyyy")).when(p == "4-NOT SPECIFIED", F.date_format(d, "' 'MMMM d, yyyy"))
             .otherwise(F.date_format(d, "dd-MM-yyyy")))
    return table(spark, sf_dir, "orders").select("o_orderkey", given.alias("given")).withColumn("parsed", t.parse_date(F.col("given")))


@query(f"""
SELECT c_custkey, upper(replace(c_name || ' ' || lower(c_mktsegment), ' ', '_')) AS name_key,
       {title_case("replace('shop_' || lower(c_mktsegment), '_', ' ')")} AS display_name,
       replace({title_case("replace('shop_' || lower(c_mktsegment), '_', ' ')")}, ' ', '') AS folder FROM customer""")
def source_names(spark, sf_dir):
    source = F.concat(F.lit("shop_"), F.lower("c_mktsegment"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", t.name_key(F.concat_ws(" ", "c_name", F.lower("c_mktsegment"))).alias("name_key"),
        t.display_name(source, DISPLAY_NAMES).alias("display_name"), t.folder_name(source).alias("folder"))


@query(f"""
SELECT p_partkey, array_to_string(list_filter(list_transform(string_split_regex(p_name || ' , ' || p_type || '|; ' || p_brand, '[,;|]'),
       lambda x: trim(x)), lambda x: x <> ''), '/') AS items,
       array_to_string(list_transform(string_split(p_name || ' & ' || p_type || ',' || p_brand, ' & '), lambda x: replace(x, ',', '/')), '/') AS credits,
       {title_case("p_name")} AS person FROM part""")
def list_normalize(spark, sf_dir):
    c = F.col
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.array_join(t.split_list(F.concat(c("p_name"), F.lit(" , "), c("p_type"), F.lit("|; "), c("p_brand"))), "/").alias("items"),
        F.array_join(t.split_credits(F.concat(c("p_name"), F.lit(" & "), c("p_type"), F.lit(","), c("p_brand"))), "/").alias("credits"),
        t.slug_person(S.render("https://x.example/product/{b}-by-{n}/", b=c("p_partkey"), n=F.replace("p_name", F.lit(" "), F.lit("-")))).alias("person"))


@query(r"""
SELECT event_id, strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%S') ||
       CASE WHEN extract(microseconds FROM ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END || '+05:30' AS scraped_at,
       'data/' || strftime(ts, '%Y-%m-%d') || '/Shop' || upper(event_type[1]) || event_type[2:] || '/' ||
       strftime(ts, '%Y-%m-%d-%I-%M-%S-%g-%p') || '.json' AS file FROM events""")
def run_stamps(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", t.ist_timestamp(F.col("ts")).alias("scraped_at"),
        X.run_file_path("data", F.col("ts"), F.concat(F.lit("shop_"), "event_type")).alias("file"))


IMAGE_SQL = """CASE p_type WHEN 'PROMO' THEN '/image/cache/catalog/' || replace(p_name, ' ', '-') || '-300x300.JPG'
    WHEN 'SMALL' THEN '/image/Cache/catalog/' || p_size || '-700x700.png' WHEN 'LARGE' THEN '/image/cache/catalog/' || p_size || '.webp'
    WHEN 'MEDIUM' THEN '/image/' || p_size || '-1000x800.jpg' WHEN 'ECONOMY' THEN '/image/Placeholder-' || p_size || '.png'
    ELSE '/image/' || p_size || '-600x9.png' END"""


@query(f"""
WITH i AS (SELECT p_partkey, p_type, {IMAGE_SQL} AS image FROM part)
SELECT p_partkey, image, p_type = 'ECONOMY' AS placeholder,
       CASE p_type WHEN 'PROMO' THEN replace(image, '-300x300', '-700x700') WHEN 'SMALL' THEN replace(image, '-700x700', '-800x800')
                   WHEN 'LARGE' THEN replace(image, '/cache', '') END AS upsized,
       CASE p_type WHEN 'PROMO' THEN 1 WHEN 'SMALL' THEN 5 WHEN 'LARGE' THEN 8 WHEN 'MEDIUM' THEN 7 WHEN 'ECONOMY' THEN -1 ELSE 2 END AS score
FROM i""")
def image_rules(spark, sf_dir):
    u = F.col("image")
    return table(spark, sf_dir, "part").select("p_partkey", F.expr(IMAGE_SQL).alias("image")).select(
        "p_partkey", "image", images.is_placeholder(u).alias("placeholder"), images.upsize(u).alias("upsized"),
        images.quality_score(u).alias("score"))


@query(f"""
WITH d AS (SELECT p_partkey, {title_case('p_name')} AS name, p_size, p_type FROM part)
SELECT p_partkey, name AS series_press, p_size::bigint AS issue_press, name AS series_studio, p_size::bigint AS issue_studio,
       CASE WHEN p_type = 'PROMO' THEN name || ' Edition' ELSE name END AS series_retail, p_size::bigint AS issue_retail,
       CASE p_type WHEN 'PROMO' THEN 'Hindi' WHEN 'SMALL' THEN 'English' END AS language,
       CASE p_type WHEN 'LARGE' THEN 'Hardcover' WHEN 'ECONOMY' THEN 'Paperback' END AS binding FROM d""")
def title_parse(spark, sf_dir):
    p = S.products(spark, sf_dir)
    tail = F.concat_ws(" ", "lang", "form")
    titles = p.select("p_partkey", F.concat_ws(" ", "name", F.concat(F.lit("– Issue "), "p_size"), tail).alias("press"),
                      F.concat_ws(" ", "name", "lang", F.concat(F.lit("Vol. "), "p_size", F.lit(": Stage 1"))).alias("studio"),
                      F.concat_ws(" ", "name", F.when(F.col("lang") == "Hindi", "Hindi Edition"), F.concat(F.lit("Issue "), "p_size")).alias("retail"))
    press, studio, retail = F.col("press"), F.col("studio"), F.col("retail")
    return titles.select("p_partkey", series_of(press, PRESS).alias("series_press"), issue_of(press, PRESS).alias("issue_press"),
                         series_of(studio, STUDIO).alias("series_studio"), issue_of(studio, STUDIO).alias("issue_studio"),
                         series_of(retail, RETAIL).alias("series_retail"), issue_of(retail, RETAIL).alias("issue_retail"),
                         t.language_of(press).alias("language"), t.first_match_label(press, PRESS.binding).alias("binding"))


# ---- validation, dedupe, entity tests -------------------------------------------------------

def document_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as comic items: those of one source have no title, those of one language no url; the text's hash stands for the url."""
    return table(spark, sf_dir, "documents").select(
        F.lit("r").alias("run_id"), F.col("lang").alias("source"), F.col("doc_id").alias("seq"), F.lit("comic").alias("entity"),
        F.when(F.col("source") != "src1", t.clean_text(F.col("text"))).alias("title"),
        F.when(F.col("lang") != "fr", F.md5("text")).alias("url"))


DOC_ITEMS = f"""
WITH i AS (SELECT doc_id, lang, CASE WHEN source <> 'src1' THEN {clean('text')} END AS title, CASE WHEN lang <> 'fr' THEN md5(text) END AS url FROM documents)
"""


@query(DOC_ITEMS + "SELECT doc_id, lang, title IS NOT NULL AS valid, CASE WHEN title IS NULL THEN 'no_title' END AS reason FROM i")
def validated_documents(spark, sf_dir):
    return Q.checked(document_items(spark, sf_dir)).select(F.col("seq").alias("doc_id"), F.col("source").alias("lang"), F.col("reason").isNull().alias("valid"), "reason")


@query(DOC_ITEMS + """
SELECT min(doc_id) AS doc_id, lang, url FROM i WHERE url IS NOT NULL GROUP BY lang, url
UNION ALL SELECT doc_id, lang, url FROM i WHERE url IS NULL""")
def dedupe_by_url(spark, sf_dir):
    # Only these columns are asked for, so texts stay out of the shuffle.
    items = document_items(spark, sf_dir).select("run_id", "source", "seq", "url")
    return Q.dedupe_by_url(items).select(F.col("seq").alias("doc_id"), F.col("source").alias("lang"), "url")


@query("""
SELECT 'part' AS kind, p_partkey AS id, p_size > 5 AS comic, false AS publisher FROM part
UNION ALL SELECT 'supplier', s_suppkey, false, s_acctbal > 0 FROM supplier""")
def entity_classifier(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        F.lit("part").alias("kind"), F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_brand").alias("url"),
        F.when(F.col("p_size") > 5, F.col("p_retailprice")).alias("price"))
    suppliers = table(spark, sf_dir, "supplier").select(
        F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.when(F.col("s_acctbal") > 0, F.col("s_name")).alias("name"),
        F.lit("u").alias("url"))
    return parts.unionByName(suppliers, allowMissingColumns=True).select("kind", "id", Q.is_comic().alias("comic"), Q.is_publisher().alias("publisher"))


# ---- merges ---------------------------------------------------------------

def order_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as catalog sightings: the same customer, status and rounded price is the same product."""
    o = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate")
    rows = {"title": F.col("o_orderstatus"), "url": F.concat(F.lit("u"), F.col("o_custkey").cast("string")),
            "price": F.round(F.col("o_totalprice") / 50000).cast("decimal(10,2)"), "source": F.lit("S"), "description": F.col("o_orderpriority"),
            "created_at": day, "updated_at": day}
    return o.select(*[rows.get(c, F.lit(None)).cast(k).alias(c) for c, k in schemas.fields(schemas.CATALOG).items()], F.col("o_orderkey").alias("seq"))


SIGHTINGS = """
WITH s AS (SELECT 'u' || o_custkey AS url, o_orderstatus AS title, CAST(round(o_totalprice / 50000) AS decimal(10,2)) AS price,
                  o_orderpriority AS description, o_orderdate AS seen_at, o_orderkey AS seq FROM orders),
k AS (SELECT url, title, price, arg_min(description, row(seen_at, seq)) AS description, min(seen_at) AS created_at, max(seen_at) AS updated_at FROM s GROUP BY ALL)
"""
CATALOG_COLUMNS = ["url", "title", "price", "description", "created_at", "updated_at"]


@query(SIGHTINGS + "SELECT * FROM k")
def first_write_wins(spark, sf_dir):
    return M.first_write_wins(order_sightings(spark, sf_dir), M.CATALOG_KEY, ["created_at", "seq"]).select(*CATALOG_COLUMNS)


@query(SIGHTINGS + "SELECT * FROM k")
def catalog_merge(spark, sf_dir):
    rows = order_sightings(spark, sf_dir)
    late = F.col("created_at") >= F.lit("1998-01-01").cast("timestamp")
    stored = M.first_write_wins(rows.filter(~late), M.CATALOG_KEY, ["created_at", "seq"])
    return M.merge_catalog(stored, rows.filter(late)).select(*CATALOG_COLUMNS)


@query("""
WITH w AS (SELECT 'C_' || o_custkey AS source, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS description, o_orderdate AS seen_at, o_orderkey AS seq
           FROM orders),
e AS (SELECT 'C_' || c_custkey AS source FROM customer)
SELECT e.source, arg_max(coalesce(description, '-'), row(seen_at, seq)) FILTER (w.seq IS NOT NULL) AS description,
       least(TIMESTAMP '1999-01-01', min(seen_at)) AS created_at, coalesce(max(seen_at), TIMESTAMP '1999-01-01') AS updated_at
FROM e LEFT JOIN w USING (source) GROUP BY e.source""")
def last_write_wins(spark, sf_dir):
    day = F.col("o_orderdate")
    told = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("C_"), F.col("o_custkey").cast("string")).alias("source"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("description"), F.lit("u").alias("url"), F.lit(1).alias("is_publisher"),
        F.col("o_orderkey").alias("seq"), day.alias("created_at"), day.alias("updated_at"))
    stamp = F.lit("1999-01-01").cast("timestamp")
    bare = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("C_"), F.col("c_custkey").cast("string")).alias("source"), F.lit(None).cast("string").alias("description"),
        F.lit(None).cast("string").alias("url"), F.lit(0).alias("is_publisher"), F.lit(-1).cast("bigint").alias("seq"),
        stamp.alias("created_at"), stamp.alias("updated_at"))
    merged = M.last_write_wins(bare.unionByName(told))
    return merged.select("source", F.when(F.col("url").isNotNull(), F.coalesce("description", F.lit("-"))).alias("description"), "created_at", "updated_at")


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN len(v) > 1 THEN v[1] END AS original_price, CASE WHEN len(v) > 1 THEN v[2] ELSE v[1] END AS price
FROM (SELECT l_orderkey, l_linenumber, list_reverse_sort(list_distinct(list_filter([l_quantity, round(l_discount * 100), l_suppkey::double], lambda x: x <> 0))) AS v FROM lineitem)""")
def price_pair_topk(spark, sf_dir):
    """The shop's price rule over three price texts: highest is the original price, next the price; one alone, or the same ones, is the price."""
    texts = [F.concat(F.lit("₹"), F.format_number(c, 2)) for c in (F.col("l_quantity"), F.round(F.col("l_discount") * 100), F.col("l_suppkey").cast("double"))]
    none = F.array().cast("array<string>")
    page = F.struct(F.array(*texts).alias("price_all"), *[none.alias(n) for n in ("price_was", "price_cut", "price_plain")])
    rows = S.dealt(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_suppkey"), "l_orderkey", "l_linenumber")
    prices = woo_prices(rows.select("l_orderkey", "l_linenumber", page.alias("h")))
    return prices.select("l_orderkey", "l_linenumber", "original_price", "price")


# ---- run summary and exports ----------------------------------------------------------------

@query("""
WITH i AS (SELECT ts::date AS run_date, event_type AS source, value, ts, event_id FROM events)
SELECT run_date, source, 'completed' AS status, count(*) AS records, count(*) FILTER (value > 5 AND value < 100000000) AS rows_processed,
       arg_max('f' || event_id || '.json', ts) AS file FROM i GROUP BY run_date, source""")
def run_summary_by_day(spark, sf_dir):
    items = table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("run_date"), F.col("event_type").alias("source"), F.when(F.col("value") > 5, F.col("value")).alias("price"),
        F.col("event_type").alias("title"), F.col("props").alias("url"), F.col("props").alias("scraped_at"), "ts", "event_id",
        *[F.lit(None).cast(k).alias(c) for c, k in (("series", "string"), ("publisher", "string"), ("language", "string"), ("binding", "string"),
                                                    ("issue", "bigint"), ("pages", "bigint"), ("original_price", "double"), ("listing_date", "string"))])
    files = X.latest_files(items.select("run_date", "source", F.concat(F.lit("f"), F.col("event_id").cast("string"), F.lit(".json")).alias("file"),
                                        F.col("ts").alias("modified_at")), keys=("run_date", "source"))
    return run_summary(items, files, items)


@query("""
SELECT o_orderkey, 0 AS position, o_orderstatus AS title, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS price, o_orderpriority AS genre
FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT o_orderkey, 2, 'second', CAST(o_custkey AS double), NULL FROM orders WHERE o_orderstatus <> 'P'""")
def export_scan(spark, sf_dir):
    """Export documents built from orders: an array with a stray string in it, a wrongly typed price, or no array at all."""
    first = F.to_json(F.struct(F.col("o_orderstatus").alias("title"),
                               F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice").cast("string")).otherwise(F.lit("n/a")).alias("price"),
                               F.array("o_orderpriority").alias("genre")))
    number = F.when(F.col("o_orderstatus") != "F", F.regexp_replace(first, '"price":"([0-9.E]+)"', '"price":$1')).otherwise(first)
    whole = F.concat(F.lit("["), number, F.lit(', "{stray}", {"title": "second", "price": '), F.col("o_custkey").cast("string"), F.lit("}]"))
    docs = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "P", first).otherwise(whole).alias("value"))
    return X.parse_export(docs).select("o_orderkey", "position", "title", "price", F.array_join("genre", "/").alias("genre"))


@query("""
SELECT p_partkey, p_name || ', ' || p_type AS genre, p_size::bigint AS pages, p_retailprice AS price, p_name AS title FROM part""")
def csv_rows(spark, sf_dir):
    items = table(spark, sf_dir, "part").select(
        F.lit("comic").alias("entity"), "p_partkey", F.col("p_name").alias("title"), F.col("p_retailprice").alias("price"),
        F.col("p_size").cast("bigint").alias("pages"), F.array("p_name", F.lit(""), "p_type").alias("genre"), F.lit(None).cast("string").alias("isbn"),
        F.col("p_partkey").cast("string").alias("url"))
    return X.csv_table(items, "comic", ["url", "title", "price", "pages", "genre"]).withColumn("p_partkey", F.col("url").cast("bigint")).drop("url")


# ---- product pages --------------------------------------------------------------------------

PRODUCTS = f"""
WITH p AS (SELECT p.*, {title_case('p_name')} AS name, replace(p_name, ' ', '-') AS slug, d.text,
    CASE p_type WHEN 'PROMO' THEN 'Hindi' WHEN 'SMALL' THEN 'English' END AS lang,
    CASE p_type WHEN 'LARGE' THEN 'Hardcover' WHEN 'ECONOMY' THEN 'Paper Back' END AS form,
    CASE p_type WHEN 'LARGE' THEN 'Hardcover' WHEN 'ECONOMY' THEN 'Paperback' END AS binding_named,
    regexp_extract(p_brand, '\\d+') AS brand_no, {clean('d.text')} AS c
  FROM part p LEFT JOIN documents d ON d.doc_id = p.p_partkey)
"""
PAGES_WORD = rf"(?i){NW}(\d+)\s*(?:(?:pages?|pgs?|p){NE}|p\.[\p{{L}}\p{{N}}_])"
LANGUAGE_IN = rf"""CASE lower(nullif(regexp_extract(%s, '(?i){NW}(Hindi|English|Eng|Hin){NE}', 1), ''))
    WHEN 'hindi' THEN 'Hindi' WHEN 'hin' THEN 'Hindi' WHEN 'english' THEN 'English' WHEN 'eng' THEN 'English' END"""


def binding_in(c: str, bound: str = "", back: str = "", cover: str = "") -> str:
    rules = [(rf"hardbound|hard\s*bound{bound}", "Hardbound"), (rf"paperback|paper\s*back{back}", "Paperback"),
             (rf"hardcover|hard\s*cover{cover}", "Hardcover"), (r"softcover|soft\s*cover", "Softcover")]
    return "CASE " + " ".join(f"WHEN regexp_matches({c}, '(?i){NW}({r}){NE}') THEN '{label}'" for r, label in rules) + " END"


# Fixed values, as in the profile but stated for SQL.
DENY_WORDS = [
    "litespeed", "cache", "comments", "feed", "quantity", "logged", "customers", "purchased", "product", "review", "there",
    "are", "no", "reviews", "yet", "only", "may", "leave", "hand", "painted", "variant", "cover", "wraparound", "poster",
    "homage", "action", "figure", "regular", "hardbound", "paperback", "hardcover", "english", "hindi", "issue", "shot", "one",
]
DENY = "|".join(DENY_WORDS)


def told_by(pattern: str) -> str:
    name = f"nullif(regexp_extract(story, '{pattern}([A-Z][a-z]+(?:\\s+[A-Z][a-z]+)+)', 1), '')"
    return f"CASE WHEN length({name}) > 2 AND NOT regexp_matches(lower({name}), '{DENY}') THEN {name} END"


PRESS_SQL = PRODUCTS + rf"""
, s AS (SELECT *, regexp_replace(regexp_replace(c, '(?i)There are no reviews yet.*', ''), '(?i)Only logged in customers.*', '') AS story,
    try_cast(nullif(regexp_extract(c, '{PAGES_WORD}', 1), '') AS bigint) AS d1,
    list_filter(list_transform(list_reverse(string_split(c, ' ')[-3:]), lambda w: try_cast(nullif(regexp_extract(trim(w, '.,;:!?'), '^\d+$'), '') AS bigint)),
                lambda n: n BETWEEN 1 AND 10000)[1] AS d2,
    list_filter(list_transform(list_reverse(regexp_extract_all(c, '[\p{{L}}\p{{N}}_]+')), lambda w: try_cast(nullif(regexp_extract(w, '^\d+$'), '') AS bigint)),
                lambda n: n BETWEEN 1 AND 10000)[1] AS d3 FROM p)
SELECT p_partkey AS seq, 'https://press.example/product/' || slug || '-' || p_size || '/' AS url,
    concat_ws(' ', name, 'Issue ' || p_size, lang, form) AS title, name AS series, p_size::bigint AS issue, '{PRESS.name}' AS publisher,
    p_retailprice AS price, round(p_retailprice + 50, 2) AS original_price, c AS description, name || '|Co|' || p_brand AS writers,
    coalesce({told_by(rf'(?i){NW}(?:by|artist|art by|artwork by|illustrated by|drawn by)\s+')}, {told_by(r'(?i)(?:artist|artwork|illustrator)[:\s]+')}) AS artists,
    p_type AS genre, coalesce(lang, {LANGUAGE_IN % 'c'}) AS language,
    coalesce(binding_named, {binding_in('c')}) AS binding,
    coalesce(CASE WHEN d1 BETWEEN 1 AND 10000 THEN d1 END, d2, d3, p_size::bigint) AS pages, 'SKU-' || p_partkey AS isbn,
    'https://press.example/wp-content/uploads/' || (p_size + 2000) || '/' || brand_no || '/' || slug || '.jpg' AS cover_image_url,
    (p_size + 2000) || '-' || lpad(brand_no, 2, '0') || '-25' AS listing_date,
    '{{"Writer":"' || name || ' & Co, ' || p_brand || '","Pages":"' || p_size || ' Pages","Format":"' || coalesce(form, '') || '."}}' AS additional_info,
    '2025-11-25T09:30:00+05:30' AS scraped_at
FROM s"""


def flat(comics: DataFrame, *names: str) -> DataFrame:
    """Chosen comic fields with lists joined and the map as JSON."""
    kinds = dict(comics.dtypes)
    shape = lambda n: (F.array_join(n, "|") if kinds[n].startswith("array") else F.to_json(n) if kinds[n].startswith("map") else F.col(n)).alias(n)
    return comics.select("seq", *[shape(n) for n in names])


@query(PRESS_SQL)
def press_comics(spark, sf_dir):
    return flat(extract_comics(S.press_pages(spark, sf_dir), PRESS), "url", "title", "series", "issue", "publisher", "price", "original_price",
                "description", "writers", "artists", "genre", "language", "binding", "pages", "isbn", "cover_image_url", "listing_date",
                "additional_info", "scraped_at")


STUDIO_SQL = PRODUCTS + rf"""
, t AS (SELECT *, CASE WHEN p_type = 'STANDARD' THEN name || ': Tales #' || p_size ELSE concat_ws(' ', name, lang, 'Vol. ' || p_size) END AS title,
    coalesce(c, 'not this') AS part_text, len(string_split(coalesce(c, 'not this'), ' ')) AS n FROM p),
k AS (SELECT *, lower(part_text) <> 'description' AND NOT (n <= 1 AND length(part_text) < 5)
      AND NOT (length(part_text) < 25 AND regexp_matches(lower(part_text), 'add to cart|wishlist|share|quantity|logged in customers|there are no reviews|only logged in|you may also like|related products|description'))
      AND NOT (n <= 2 AND contains(part_text, ':') AND length(part_text) < 25 AND NOT suffix(part_text, '.'))
      AND trim(regexp_replace(part_text, '[.,!?;:]', '', 'g')) <> '' AS kept FROM t),
s AS (SELECT *, CASE WHEN kept THEN {clean(r"regexp_replace(part_text, '(?i)\s*(Writer|Art|Pages|Category|Additional Information|Description).*$', '')")}
                     WHEN lower(part_text) <> 'description' THEN part_text END AS description FROM k),
e AS (SELECT *, description IS NULL AND lang IS NULL AS partial FROM s)
SELECT p_partkey AS seq, title, CASE WHEN partial THEN 'null_description' END AS parse_issue, name AS series, p_size::bigint AS issue, p_retailprice AS price,
    NULL::double AS original_price, description, p_name AS artists,
    CASE WHEN NOT partial THEN 'https://studio.example/product/' || slug || '-' || p_partkey || '-by-' || slug || '/' END AS url,
    CASE WHEN NOT partial THEN coalesce(lang, {LANGUAGE_IN % 'description'}) END AS language,
    CASE WHEN NOT partial THEN coalesce(binding_named, 'Saddle') END AS binding,
    CASE WHEN NOT partial THEN nullif(try_cast(nullif(regexp_extract(description, '{PAGES_WORD}', 1), '') AS bigint), 0) END AS pages,
    CASE WHEN NOT partial THEN p_partkey::varchar END AS isbn, CASE WHEN NOT partial THEN '' END AS genre
FROM e"""


@query(STUDIO_SQL)
def studio_comics(spark, sf_dir):
    return flat(extract_comics(S.studio_pages(spark, sf_dir), STUDIO), "title", "parse_issue", "series", "issue", "price", "original_price",
                "description", "artists", "url", "language", "binding", "pages", "isbn", "genre")


RETAIL_PAGES_IN = [r"(?i)pages?[:\s]+(\d+)", r"(?i)(\d+)\s*pages?", r"(?i)page\s+count[:\s]+(\d+)", r"(?i)no\s+of\s+pages?[:\s]+(\d+)",
                   r"(?i)number\s+of\s+pages?[:\s]+(\d+)"]
_hits = [f"try_cast(nullif(regexp_extract(c, '{p}', 1), '') AS bigint)" for p in RETAIL_PAGES_IN]
_date = r"coalesce(nullif(regexp_extract(c, '(\d{1,2}[-/]\d{1,2}[-/]\d{2,4})', 1), ''), nullif(regexp_extract(c, '(\d{4}[-/]\d{1,2}[-/]\d{1,2})', 1), ''))"
RETAIL_SQL = PRODUCTS + rf"""
, s AS (SELECT *, coalesce({', '.join(f'CASE WHEN {h} BETWEEN 1 AND 10000 THEN {h} END' for h in _hits)}, {', '.join(reversed(_hits))}) AS said, {_date} AS day,
    name || ' Issue ' || p_size || coalesce(' ' || lang, '') || CASE WHEN p_type = 'MEDIUM' THEN ' (Pre Booking)' ELSE '' END AS title FROM p)
SELECT p_partkey AS seq, 'https://retail.example/index.php?route=product/product&product_id=' || p_partkey AS url, title, name AS series, p_size::bigint AS issue,
    p_brand AS publisher, p_retailprice AS price, round(p_retailprice + 50, 2) AS original_price, c AS description,
    CASE WHEN contains(lower(title || ' ' || coalesce(c, '')), 'hindi') THEN 'Hindi' WHEN contains(lower(title || ' ' || coalesce(c, '')), 'english') THEN 'English'
         WHEN contains(lower(coalesce(c, '')), 'malayalam') THEN 'Malayalam' END AS language,
    coalesce({binding_in('c', '|hb', '|pb', '|hc')}, binding_named) AS binding,
    CASE WHEN nullif(said, 0) IS NULL THEN p_size::bigint WHEN said BETWEEN 1 AND 10000 THEN said ELSE p_size::bigint END AS pages,
    CASE WHEN p_type = 'PROMO' THEN 'https://retail.example/image/cache/catalog/' || slug || '-700x700.jpg'
         ELSE 'https://retail.example/image/' || slug || '.png' END AS cover_image_url,
    CASE WHEN regexp_matches(day, '^\d{{1,2}}/\d{{1,2}}/\d{{4}}$')
         THEN coalesce(strftime(try_strptime(day, '%m/%d/%Y'), '%Y-%m-%d'), strftime(try_strptime(day, '%d/%m/%Y'), '%Y-%m-%d'), day)
         WHEN regexp_matches(day, '^\d{{4}}-\d{{1,2}}-\d{{1,2}}$') THEN coalesce(strftime(try_strptime(day, '%Y-%m-%d'), '%Y-%m-%d'), day) ELSE day END AS release_date
FROM s"""


@query(RETAIL_SQL)
def retail_comics(spark, sf_dir):
    return flat(extract_comics(S.retail_pages(spark, sf_dir), RETAIL), "url", "title", "series", "issue", "publisher", "price", "original_price",
                "description", "language", "binding", "pages", "cover_image_url", "release_date")


def all_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (S.press_pages(spark, sf_dir).unionByName(S.studio_pages(spark, sf_dir)).unionByName(S.retail_pages(spark, sf_dir)))


# A product page repeated under one url is kept once; a series record has its comic's url and stays only where the comic lost its own.
ITEMS_SQL = STUDIO_SQL.replace("SELECT p_partkey AS seq, title, CASE WHEN partial", ", studio AS (SELECT p_partkey AS seq, title, CASE WHEN partial") + r""")
, press AS (SELECT min(p_partkey) AS seq, slug, p_size FROM p GROUP BY slug, p_size)
SELECT source, entity, seq, title, url, price FROM (
  SELECT '{press}' AS source, 'comic' AS entity, p_partkey AS seq, concat_ws(' ', name, 'Issue ' || p.p_size, lang, form) AS title,
         'https://press.example/product/' || slug || '-' || p.p_size || '/' AS url, p_retailprice AS price
  FROM p WHERE p_partkey IN (SELECT seq FROM press)
  UNION ALL SELECT '{studio}', 'comic', seq, title, url, price FROM studio
  UNION ALL SELECT '{studio}', 'series', p_partkey, name, 'https://studio.example/product/' || slug || '-' || p_partkey || '-by-' || slug || '/', NULL FROM e WHERE partial
  UNION ALL SELECT '{retail}', 'comic', p_partkey, name || ' Issue ' || p_size || coalesce(' ' || lang, '') || CASE WHEN p_type = 'MEDIUM' THEN ' (Pre Booking)' ELSE '' END,
         'https://retail.example/index.php?route=product/product&product_id=' || p_partkey, p_retailprice FROM p)"""


for _name, _profile in (("press", PRESS), ("studio", STUDIO), ("retail", RETAIL)):
    ITEMS_SQL = ITEMS_SQL.replace("'{" + _name + "}'", f"'{_profile.source}'")


@query(ITEMS_SQL)
def run_items(spark, sf_dir):
    """The whole job over three shops: extract, validate, dedupe."""
    return jobs.items(all_pages(spark, sf_dir)).select("source", "entity", "seq", "title", "url", "price")


@query(PRODUCTS + """
SELECT name AS title, count(*) AS comics FROM p GROUP BY name""")
def series_distinct(spark, sf_dir):
    return distinct_series(extract_comics(S.press_pages(spark, sf_dir), PRESS)).select("title", "comics")


@query(PRODUCTS + f"""
SELECT 'https://press.example/product/' || slug || '-' || p_size || '/' AS url, concat_ws(' ', name, 'Issue ' || p_size, lang, form) AS title,
       CAST(p_retailprice AS decimal(10,2))::double AS price, '{PRESS.name.upper().replace(" ", "_")}' AS source,
       arg_min(p_size, p_partkey)::int AS issue, arg_min(p_partkey, p_partkey) AS first_seq, count(*) AS sightings
FROM p WHERE brand_no::int BETWEEN 1 AND 12 GROUP BY ALL""")
def catalog_load(spark, sf_dir):
    """Comic records cast to the catalog's types, one row per key; an impossible listing month is refused."""
    items = extract_comics(S.press_pages(spark, sf_dir), PRESS)
    rows = M.catalog_rows(items, F.expr(S.RUN_TS)).select(*M.CATALOG_KEY, "issue", "seq")
    return (rows.groupBy(*M.CATALOG_KEY).agg(F.min_by("issue", "seq").alias("issue"), F.min("seq").alias("first_seq"), F.count("*").alias("sightings"))
            .select("url", "title", F.col("price").cast("double").alias("price"), "source", "issue", "first_seq", "sightings"))


@query(f"""
SELECT strftime(o_orderdate, '%Y%m') AS run_id, '{PRESS.name}' AS name, '{PRESS.website}' AS url,
       'Shop of ' || arg_min(o_orderstatus, o_orderkey) AS description, min(o_orderkey) AS seq
FROM orders WHERE o_totalprice >= 1200 GROUP BY 1""")
def publisher_records(spark, sf_dir):
    return publisher_record(S.listing_pages(spark, sf_dir, PRESS.source), PRESS).select("run_id", "name", "url", "description", "seq")
