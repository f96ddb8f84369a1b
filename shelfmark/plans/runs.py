"""Registered queries on whole runs: large array exports, page chains, streams with state, and the catalog after many loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.functions import text as t
from shelfmark.operators import chain as C
from shelfmark.operators import links as L
from shelfmark.operators import merge as M
from shelfmark.operators import nodes as N
from shelfmark.plans import shop_pages as S
from shelfmark.plans.queries import CATALOG_COLUMNS, NEXT_PAGE_SQL, PRODUCTS, order_sightings, query, table
from shelfmark.profiles import PRESS
from shelfmark.sources import exports as X
from shelfmark.sources import tables as T
from shelfmark.sources.pages import as_pages
from shelfmark.sources.work import work_path
from shelfmark.streaming import ingest

# ---- array files ----------------------------------------------------------------------------

@query(r"""
WITH o AS (SELECT *, strftime(o_orderdate, '%Y%m') AS run_id, row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y%m') ORDER BY o_orderkey) - 1 AS position FROM orders)
SELECT run_id, position, 'o' || o_orderkey || CASE o_orderstatus WHEN 'F' THEN '"],[{' WHEN 'O' THEN '\' ELSE ', \"' END AS title, o_totalprice AS price,
       o_orderpriority || '/]' AS genre FROM o WHERE run_id NOT LIKE '%07' AND o_custkey % 10 <> 3""")
def export_ranges(spark, sf_dir):
    """One array file per order month, full of quotes and brackets, read in ranges of a few kilobytes so that their borders fall everywhere.
    The files of every July have no opening bracket and are refused whole; every tenth customer's member is a string and is skipped."""
    o = table(spark, sf_dir, "orders").withColumn("run_id", F.date_format("o_orderdate", "yyyyMM"))
    order = Window.partitionBy("run_id").orderBy("o_orderkey")
    odd = F.when(F.col("o_orderstatus") == "F", '"],[{').when(F.col("o_orderstatus") == "O", "\\").otherwise(', \\"')
    record = F.to_json(F.struct(F.concat(F.lit("o"), F.col("o_orderkey").cast("string"), odd).alias("title"), F.col("o_totalprice").alias("price"),
                                F.array("o_orderpriority", F.lit("]")).alias("genre")))
    member = F.when(F.col("o_custkey") % 10 == 3, F.to_json(F.array(F.lit("[{\\"), "o_orderstatus"))).otherwise(record)
    opening = F.when(F.row_number().over(order) > 1, ",").when(F.col("run_id").endswith("07"), "").otherwise("[")
    lines = o.select("run_id", "o_orderkey", F.concat(opening, member, F.when(F.lead("o_orderkey").over(order).isNull(), "]").otherwise("")).alias("value"))
    path = work_path(spark, "export-ranges")
    lines.sortWithinPartitions("run_id", "o_orderkey").select("run_id", "value").write.partitionBy("run_id").text(path)
    rows = X.read_export(spark, f"{path}/run_id=*", range_bytes=8 << 10, task_bytes=1 << 20)
    return rows.select(F.regexp_extract("file", r"run_id=(\d+)", 1).alias("run_id"), "position", "title", "price", F.array_join("genre", "/").alias("genre"))


# ---- pages as rows of nodes -------------------------------------------------------------------

@query(PRODUCTS + """
SELECT p_partkey AS seq, concat_ws(' ', name, 'Issue ' || p_size, lang, form) AS title,
       '₹' || format('{:,.2f}', p_retailprice + 50) || '|₹' || format('{:,.2f}', p_retailprice) AS prices,
       'Writer=' || name || ' & Co, ' || p_brand || '|Pages=' || p_size || ' Pages|Format=' || coalesce(form, '') || '.' AS info FROM p""")
def product_node_rows(spark, sf_dir):
    """Title, prices and info rows of product pages, selected by interval tests over rows of nodes; one exchange, by page."""
    found = N.product_nodes(S.press_pages(spark, sf_dir).select("seq", "html"), ["seq"], "woocommerce-Tabs-panel--additional_information")
    lines = F.transform("info", lambda row: F.array_join(F.transform(row, t.clean_text), "="))
    return found.select("seq", t.clean_text(F.col("title")).alias("title"), F.array_join("prices", "|").alias("prices"), F.array_join(lines, "|").alias("info"))


# ---- chains of pages ------------------------------------------------------------------------

def chained_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages of twenty runs, page k of a run at the k-th of its orders; each links the next page, or one two or three further on."""
    o = S.dealt(table(spark, sf_dir, "orders"), "o_orderkey")
    run, k, p = F.col("o_orderkey") % 20, F.floor(F.col("o_orderkey") / 20), F.col("o_orderpriority")
    second = F.when(F.col("o_orderstatus") != "F", S.render("/product/order-{n}/", n=F.col("o_orderkey"))).otherwise(F.lit("/about/"))
    paging = (F.when(p == "1-URGENT", S.render('<a class="next" href="/shop/page/{n}/">next</a>', n=k + 1))
              .when(p == "2-HIGH", S.render('<nav class="pagination"><a href="/shop/page/{b}/">b</a><a href="/shop/page/{f}/">f</a></nav>', b=k - 1, f=k + 2))
              .when(p == "3-MEDIUM", S.render('<a class="next" href="">here</a><a rel="next" href="../{n}/">next</a>', n=k + 3)))
    html = S.render(S.LISTING_HTML, segment=F.col("o_orderstatus"), cust=F.col("o_custkey"), second=second, paging=paging)
    status = F.when(F.col("o_totalprice") < 1200, 404).otherwise(200)
    return as_pages(o, PRESS.source, F.expr(S.RUN_TS), S.render("https://press.example/shop/page/{k}/", k=k), html, k, run_id=run.cast("string"), status=status)


CHAIN_SQL = """
WITH RECURSIVE l AS (SELECT (o_orderkey % 20)::VARCHAR AS run_id, o_orderkey // 20 AS k, o_orderkey, o_custkey, o_orderstatus, o_orderpriority AS p, o_totalprice < 1200 AS gone FROM orders),
links AS (SELECT run_id, k, 'c' || o_custkey AS u FROM l WHERE NOT gone UNION ALL SELECT run_id, k, 'o' || o_orderkey FROM l WHERE NOT gone AND o_orderstatus <> 'F'),
fresh AS (SELECT run_id, k, count(*) AS n FROM (SELECT run_id, u, min(k) AS k FROM links GROUP BY ALL) GROUP BY ALL),
firsts AS (SELECT run_id, min(k) AS gone_at FROM l WHERE gone GROUP BY ALL),
d AS (SELECT run_id, k, CASE WHEN gone THEN 'not_found' WHEN gone_at < k THEN 'after_not_found' WHEN coalesce(n, 0) = 0 THEN 'no_products' END AS stop,
             k + CASE p WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 ELSE 1 END AS next FROM l LEFT JOIN fresh USING (run_id, k) LEFT JOIN firsts USING (run_id)),
c AS (SELECT run_id, min(k) AS k, 0 AS step FROM d GROUP BY run_id
      UNION ALL SELECT c.run_id, d.next, step + 1 FROM c JOIN d ON d.run_id = c.run_id AND d.k = c.k JOIN d AS t ON t.run_id = d.run_id AND t.k = d.next WHERE d.stop IS NULL),
w AS (SELECT c.run_id, step, k, stop, row_number() OVER (PARTITION BY c.run_id ORDER BY step DESC) = 1 AS last FROM c JOIN d USING (run_id, k))
"""


@query(CHAIN_SQL + """
SELECT run_id, step::BIGINT AS step, k AS seq, 'https://press.example/shop/page/' || k || '/' AS url, CASE WHEN last THEN coalesce(stop, 'not_fetched') END AS stop_reason FROM w""")
def page_chain(spark, sf_dir):
    """The pages each run really visits, from its start along the link chosen on each page."""
    return C.page_chain(L.next_page(chained_listings(spark, sf_dir), PRESS)).select("run_id", "step", "seq", "url", "stop_reason")


@query(NEXT_PAGE_SQL.replace("strftime(o_orderdate, '%Y%m')", "'all'").replace("o_totalprice < 1200", "o_orderkey % 10007 = 10006"))
def one_crawl(spark, sf_dir):
    """Paging decisions where all listing pages belong to one run, whose pages are not found from some place on."""
    pages = S.listing_pages(spark, sf_dir, PRESS.source).withColumns(
        {"run_id": F.lit("all"), "status": F.when(F.col("seq") % 10007 == 10006, 404).otherwise(200)})
    return L.next_page(pages, PRESS).drop("source")


@query("""
WITH RECURSIVE m AS (SELECT (max(o_orderkey) // 20 + 1) * 20 AS size FROM orders),
e AS (SELECT o_orderkey % 20 AS run, o_orderkey AS node, CASE WHEN o_totalprice >= 1500 THEN (o_orderkey + 20 * (1 + o_custkey % 7)) % size END AS next FROM orders, m),
c AS (SELECT run, min(node) AS node FROM e GROUP BY run UNION SELECT e.run, e.next FROM c JOIN e USING (run, node) JOIN e AS t ON t.node = e.next),
s AS (SELECT run, node, next, next IS NOT NULL AND next IN (SELECT node FROM e) AS goes FROM c JOIN e USING (run, node))
SELECT run::VARCHAR AS run_id, count(*) AS pages, CASE WHEN bool_and(goes) THEN 'cycle' WHEN bool_or(next IS NULL) THEN 'no_next_link' ELSE 'not_fetched' END AS stop_reason,
       sum(node)::BIGINT AS visited FROM s GROUP BY run""")
def chain_cycles(spark, sf_dir):
    """Chains over links that lead round: each run's pages up to the first one that leads back, or that has no link."""
    o = table(spark, sf_dir, "orders")
    size = o.agg(((F.floor(F.max("o_orderkey") / 20) + 1) * 20).alias("size"))
    n = F.col("o_orderkey")
    to = F.when(F.col("o_totalprice") >= 1500, (n + 20 * (1 + F.col("o_custkey") % 7)) % F.col("size"))
    decisions = o.crossJoin(F.broadcast(size)).select(  # one row
        (n % 20).cast("string").alias("run_id"), F.lit("s").alias("source"), n.alias("seq"), n.cast("string").alias("url"), to.cast("string").alias("next_url"),
        F.when(to.isNull(), "no_next_link").alias("stop_reason"))
    chain = C.page_chain(decisions)
    told = C.chain_summary(chain).select("run_id", "pages", "stop_reason")
    return told.join(chain.groupBy("run_id").agg(F.sum("seq").alias("visited")), "run_id").select("run_id", "pages", "stop_reason", "visited")


# ---- a stream with state --------------------------------------------------------------------

STREAM_SQL = """
WITH o AS (SELECT o_orderpriority AS run_id, CASE WHEN o_custkey % 11 <> 0 THEN 'u' || o_custkey END AS url, o_orderkey AS seq, o_orderdate AS t,
                  CASE WHEN year(o_orderdate) < 1996 THEN 1 WHEN year(o_orderdate) < 1999 THEN 2 ELSE 3 END AS batch FROM orders),
ends AS (SELECT batch + 1 AS batch, max(max(t)) OVER (ORDER BY batch) AS top FROM o WHERE url IS NOT NULL GROUP BY batch),
k AS (SELECT run_id, url, batch, min(seq) AS seq, max(t) AS last FROM o WHERE url IS NOT NULL GROUP BY ALL),
p AS (SELECT *, max(last) OVER (PARTITION BY run_id, url ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM k)
SELECT run_id, url, seq FROM p LEFT JOIN ends USING (batch) WHERE before IS NULL OR before + INTERVAL 800 DAY <= top
UNION ALL SELECT run_id, NULL, seq FROM o WHERE url IS NULL"""


@query(STREAM_SQL)
def stream_first_arrivals(spark, sf_dir):
    """Records that arrive in three lots: of each run's repeated urls the first lot's lowest number stays, a url not seen for 400 days before the
    watermark (itself 400 days behind) counts as new, and records without a url all pass."""
    o = table(spark, sf_dir, "orders")
    root, year = work_path(spark, "arrivals"), F.year("o_orderdate")
    rows = o.select(F.col("o_orderpriority").alias("run_id"), F.lit("s").alias("source"), F.when(F.col("o_custkey") % 11 != 0, F.concat(F.lit("u"), F.col("o_custkey").cast("string"))).alias("url"),
                    F.col("o_orderkey").alias("seq"), F.lit(0).alias("ord"), F.col("o_orderdate").cast("timestamp").alias("fetched_at"))
    for part in (year < 1996, (year >= 1996) & (year < 1999), year >= 1999):
        rows.filter(part).write.mode("append").parquet(f"{root}/in")
        firsts, without = ingest.dedupe_stream(spark.readStream.schema(rows.schema).parquet(f"{root}/in"), delay="400 days")
        (firsts.unionByName(without).writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
         .trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(rows.schema).parquet(f"{root}/out").select("run_id", "url", "seq")


# ---- the catalog after many loads -----------------------------------------------------------

@query("""
WITH s AS (SELECT 'u' || o_custkey AS url, o_orderstatus AS title, CAST(round(o_totalprice / 50000) AS decimal(10,2)) AS price,
                  o_orderpriority AS description, o_orderdate AS seen_at, o_orderkey AS seq, o_orderkey % 7 AS load FROM orders),
k AS (SELECT url, title, price, load, arg_min(description, row(seen_at, seq)) AS description, min(seen_at) AS created_at, max(seen_at) AS updated_at FROM s GROUP BY ALL)
SELECT url, title, price, arg_min(description, load) AS description, arg_min(created_at, load) AS created_at, max(updated_at) AS updated_at FROM k GROUP BY ALL""")
def catalog_loads(spark, sf_dir):
    """Orders as sightings in seven loads: known products cost a load a narrow row, and every third load merges folders."""
    root = f"{work_path(spark, 'catalog-loads')}/catalog"
    rows = order_sightings(spark, sf_dir)
    for load_id in range(7):
        batch = M.first_write_wins(rows.filter(F.col("seq") % 7 == load_id), M.CATALOG_KEY, ["created_at", "seq"])
        T.append(spark, root, batch, load_id, fan=3)
    return T.read_table(spark, "catalog", root).select(*CATALOG_COLUMNS)


@query("""
WITH k AS (SELECT 'u' || o_custkey AS url, o_orderstatus AS title, CAST(round(o_totalprice / 50000) AS decimal(10,2)) AS price, min(o_orderdate) AS valid_from FROM orders GROUP BY ALL)
SELECT url, title, price, valid_from, lead(valid_from) OVER w AS valid_to, lag(price) OVER w AS price_before FROM k WINDOW w AS (PARTITION BY url, title ORDER BY valid_from, price)""")
def price_intervals(spark, sf_dir):
    """Each product's prices with the time they held, from the catalog of all orders as sightings."""
    catalog = M.first_write_wins(order_sightings(spark, sf_dir), M.CATALOG_KEY, ["created_at", "seq"])
    return M.price_history(catalog, ["url", "title", "source"]).drop("source")


@query("""
WITH k AS (SELECT 'u' || o_custkey AS url, o_orderstatus AS title, CAST(round(o_totalprice / 50000) AS decimal(10,2)) AS price, min(o_orderdate) AS valid_from FROM orders GROUP BY ALL),
h AS (SELECT *, lead(valid_from) OVER (PARTITION BY url, title ORDER BY valid_from, price) AS valid_to FROM k),
q AS (SELECT l_orderkey, l_linenumber, 'u' || o_custkey AS url, o_orderstatus AS title, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT l_orderkey, l_linenumber, q.url, price, valid_from AS price_since
FROM q LEFT JOIN h ON h.url = q.url AND h.title = q.title AND h.valid_from <= q.l_shipdate AND (h.valid_to IS NULL OR q.l_shipdate < h.valid_to)""")
def price_at_shipping(spark, sf_dir):
    """For every line item, the price that its order's product had when it was shipped."""
    product = ["url", "title", "source"]
    sightings = order_sightings(spark, sf_dir)
    history = M.price_history(M.first_write_wins(sightings, M.CATALOG_KEY, ["created_at", "seq"]), product)
    asked = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("seq"), "l_linenumber", "l_shipdate").join(sightings.select("seq", *product), "seq")
    return M.price_as_of(history, asked, product, "l_shipdate").select(F.col("seq").alias("l_orderkey"), "l_linenumber", "url", "price", "price_since")


@query("""
SELECT CASE WHEN o_orderstatus = 'F' THEN 'comic' WHEN o_orderstatus = 'O' THEN 'series' ELSE 'publisher' END AS entity,
       array_to_string(list_sort(list_distinct(flatten(list(list_concat(['title', 'k' || (o_custkey % 13), 'x-' || o_orderpriority], CASE WHEN o_totalprice > 400000 THEN ['price'] ELSE [] END))))), '|') AS columns
FROM orders GROUP BY 1""")
def csv_headers(spark, sf_dir):
    """The header of each record kind's CSV file: all keys its records have, those outside the contract too."""
    o = table(spark, sf_dir, "orders")
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('":1'))
    members = F.array_compact(F.array(F.lit('"title":"t"'), quoted(F.concat(F.lit("k"), (F.col("o_custkey") % 13).cast("string"))), quoted(F.concat(F.lit("x-"), F.col("o_orderpriority"))),
                                      F.when(F.col("o_totalprice") > 400000, F.lit('"price":[1]'))))
    kind = F.when(F.col("o_orderstatus") == "F", "comic").when(F.col("o_orderstatus") == "O", "series").otherwise("publisher")
    records = o.select(kind.alias("entity"), F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}")).alias("raw_json"))
    return X.record_headers(records).select("entity", F.array_join("columns", "|").alias("columns"))


@query("""
SELECT CASE WHEN p_partkey % 3 = 0 THEN 'a' ELSE 'b' END AS source, count(*) AS records,
       count(*) FILTER (p_size <> 7 AND p_partkey % 5 <> 0) AS rows_processed FROM part GROUP BY 1
UNION ALL SELECT 'none', 0, 0""")
def observed_export(spark, sf_dir):
    """A run's export with its summary counted by the write itself, also for a source without records."""
    n = F.col("p_partkey")
    fields = {"title": F.col("p_name"), "price": F.when(F.col("p_size") != 7, F.col("p_retailprice")), "url": S.render("u{n}", n=n),
              "scraped_at": F.when(n % 5 != 0, "2025-11-25T09:30:00+05:30")}
    items = table(spark, sf_dir, "part").select(
        F.lit("comic").alias("entity"), n.alias("seq"), F.to_date(F.lit("2025-11-25")).alias("run_date"), F.when(n % 3 == 0, "a").otherwise("b").alias("source"),
        *[fields.get(c, F.lit(None)).cast(k).alias(c) for c, k in X.ITEM_FIELDS.items()])
    path = work_path(spark, "observed")
    told = X.write_observed(items, path, ["a", "b", "none"])
    stored = X.read_json(spark, path).groupBy("source").agg(F.count("*").alias("stored"))
    # The stored export bears the counts out: a source whose numbers differ would be missing.
    counted = spark.createDataFrame(told, "source string, records long, rows_processed long").join(stored, "source", "left")
    return counted.filter(F.coalesce("stored", F.lit(0)) == F.col("records")).select("source", "records", "rows_processed")
