"""Link jobs: product links, frontier, and the one next page to follow from each listing page.

Pages are taken in ``seq`` order within a (run, source), which stands for the order they were fetched in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions import text as t
from shelfmark.functions.entities import unescape
from shelfmark.functions.patterns import java
from shelfmark.functions.text import settled
from shelfmark.functions.urls import parts, resolve
from shelfmark.operators.quality import first_per
from shelfmark.operators.shred import from_html
from shelfmark.profiles import SourceProfile
from shelfmark.sources.work import saved, work_path

RUN = ["run_id", "source"]
BLOCK = 4096  # consecutive numbers of a run that are dealt together

# Comments, scripts and styles hold no links; then every start tag <a …>.
_HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1\s*>|\z)"
_ANCHOR = r"(?is)<a(?=[\s/])((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
_HREF = r"(?is)(?:^|[\s/\"'])href\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)"

_BASE = _ANCHOR.replace("<a(", "<base(")


def _href(tag: Column) -> Column:
    """The value of a tag's href, without its quotes."""
    given = F.regexp_extract(tag, _HREF, 1)
    return unescape(t.let(given, lambda v: F.when(v.rlike(r"(?s)^([\"']).*\1\z"), F.substr(v, F.lit(2), F.length(v) - 2)).otherwise(v)))


def visible(html: Column) -> Column:
    """The page without comments, scripts and styles."""
    return F.regexp_replace(html, _HIDDEN, " ")


def _tags(page: Column, pattern: str) -> Column:
    return F.regexp_extract_all(page, F.lit(pattern), F.lit(1))


def anchor_hrefs(html: Column) -> Column:
    """All href values of anchors, in document order; JVM-side, no page parse."""
    return F.filter(F.transform(_tags(visible(html), _ANCHOR), _href), lambda u: u != "")


def _first_base(page: Column) -> Column:
    """The href of the page's first ``base`` element that has one."""
    found = F.filter(F.transform(_tags(page, _BASE), _href), lambda u: u != "")
    return F.when(page.rlike("(?i)<base"), F.get(found, F.lit(0)))


def _hrefs(page: Column, profile: SourceProfile) -> Column:
    """Distinct hrefs of a page that name a product; only tags that may name one, as written or in character references, are looked into."""
    wanted = lambda u: t.contains_any(u, profile.product_markers)
    tags = F.filter(_tags(page, _ANCHOR), lambda tag: wanted(tag) | tag.contains("&"))
    return F.array_distinct(F.filter(F.transform(tags, _href), wanted))


def _with_urls(found: DataFrame) -> DataFrame:
    """Rows with ``hrefs`` and the first base's href as ``named``: the urls they stand for as ``link_urls``.  A base is taken apart once a page."""
    based = found.withColumn("link_base", settled(F.when(F.col("named").isNull(), F.col("url")).otherwise(resolve(F.col("url"), F.col("named")))))
    placed = based.withColumn("base_parts", settled(parts(F.col("link_base"))))
    urls = F.array_distinct(F.transform("hrefs", lambda u: resolve(F.col("link_base"), u, F.col("base_parts"))))
    return placed.withColumn("link_urls", settled(urls)).drop("hrefs", "named", "link_base", "base_parts")


def product_links(pages: DataFrame, profile: SourceProfile) -> DataFrame:
    """One row per distinct product link of a page: (run, source, seq, url, link_url).

    Links are relative to the page's base element, else to its own url.  A page's hidden parts are taken out once.
    """
    mine = (pages.filter((F.col("source") == profile.source) & (F.col("status") == 200))
            .select(*RUN, "seq", "url", settled(visible(F.col("html"))).alias("page")))
    found = mine.select(*RUN, "seq", "url", settled(_hrefs(F.col("page"), profile)).alias("hrefs"), settled(_first_base(F.col("page"))).alias("named"))
    return _with_urls(found.filter(F.size("hrefs") > 0)).select(*RUN, "seq", "url", F.explode("link_urls").alias("link_url"))


def first_seen(links: DataFrame) -> DataFrame:
    """Each link once per run, with the page that showed it first."""
    return links.groupBy(*RUN, "link_url").agg(F.min_by(F.struct("seq", "url"), "seq").alias("on")).select(
        *RUN, "link_url", F.col("on.seq").alias("seq"), F.col("on.url").alias("page_url"))


def frontier(links: DataFrame, visited: DataFrame) -> DataFrame:
    """Links still to fetch, each once with the page that showed it first.

    Both sides are reduced to one row per url before they meet, so a link on every page costs one row per task.
    """
    once = first_per(links, ["link_url"], [F.col("seq"), F.col("url")])
    return once.join(visited.select(F.col("url").alias("link_url")).distinct(), "link_url", "left_anti")


def page_number(url: Column, profile: SourceProfile) -> Column:
    """Number in the URL by the profile's first matching rule, NULL when it names none."""
    return F.coalesce(*[t.to_int(t.search(url, p)) for p in profile.page_number])


def constructed_next(url: Column, profile: SourceProfile) -> Column:
    """The next page's URL by naming convention."""
    bare = F.substring_index(url, "?", 1)
    following = (F.coalesce(page_number(url, profile), F.lit(1)) + 1).cast("string")
    if profile.family == "retail":
        return F.concat(bare, F.lit("?page="), following)
    bare = F.regexp_replace(bare, "/+$", "")
    root = F.when(t.found(url, profile.page_number[0]), t.substitute(bare, r"/page/\d+/?$", "")).otherwise(bare)
    rest = F.concat(F.lit("/page/"), following, F.lit("/"))
    return (F.when(root.contains("/shop") & ~root.endswith("/shop") & ~root.endswith("/shop/"),
                   F.concat(F.regexp_replace(F.replace(root, F.lit("/shop"), F.lit("")), "/+$", ""), rest))
            .when(root.endswith("/shop/"), F.concat(root, F.lit("page/"), following, F.lit("/")))
            .otherwise(F.concat(root, rest)))


def _candidates(profile: SourceProfile) -> tuple[dict[str, str], Column]:
    """The rules to read a listing page by, and every link the paging rules could pick, best first: by name, by number, constructed, load-more.

    The second works on columns url, base (what links are relative to), here (the page's number) and h (what the rules found).
    """
    h = F.col("h")
    rules = {f"next_{i}": s for i, s in enumerate(profile.next_link)}
    rules |= {f"numbered_{i}": s for i, s in enumerate(profile.numbered_link)}
    rules |= {f"more_{i}": s for i, s in enumerate(profile.load_more)}
    rules["base_href"] = "base::attr(href)"

    def entry(kind: str, url: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), url.alias("next_url"))

    single = lambda name: resolve(F.col("base"), t.truthy(F.get(h[name], F.lit(0))))

    def onward(name: str) -> Column:
        urls = F.transform(F.filter(h[name], lambda u: u != ""), lambda u: resolve(F.col("base"), u))
        return F.transform(F.filter(urls, lambda u: page_number(u, profile) > F.col("here")), lambda u: entry("number", u))

    ranked = [F.array(*[entry("next", single(f"next_{i}")) for i in range(len(profile.next_link))])]
    ranked += [onward(f"numbered_{i}") for i in range(len(profile.numbered_link))]
    ranked.append(F.array(entry("constructed", constructed_next(F.col("url"), profile))))
    if profile.load_more:
        ranked.append(F.array(*[entry("load_more", single(f"more_{i}")) for i in range(len(profile.load_more))]))
    return rules, F.filter(F.concat(*ranked), lambda c: c["next_url"].isNotNull() & (c["next_url"] != F.col("url")))


def run_bounds(listing: DataFrame) -> DataFrame:
    """(run, block, start_seq, gone_seq): a run's first page and first page not found, carried to each block of the run's pages.

    Pages meet them on (run, block), so one run that holds all pages is dealt over all tasks; what is gathered on a run is a row per block.
    """
    blocks = listing.groupBy(*RUN, "block").agg(F.min("seq").alias("start_seq"), F.min(F.when(F.col("status") == 404, F.col("seq"))).alias("gone_seq"))
    run = Window.partitionBy(*RUN)
    return blocks.select(*RUN, "block", F.min("start_seq").over(run).alias("start_seq"), F.min("gone_seq").over(run).alias("gone_seq"))


def listing_facts(pages: DataFrame, profile: SourceProfile) -> DataFrame:
    """One narrow row per listing page: what it links (link_urls, candidates) and its run's bounds.  Html is read and parsed once and is in no join."""
    mine = pages.filter((F.col("source") == profile.source) & ~t.contains_any(F.col("url"), profile.product_markers)).withColumn(
        "block", F.floor(F.col("seq") / BLOCK))
    rules, ranked = _candidates(profile)
    html = F.when(F.col("status") == 200, F.col("html"))
    read = mine.select(*RUN, "seq", "url", "status", "block", html.alias("html")).withColumn("h", from_html(F.col("html"), rules))
    read = read.withColumn("page", settled(visible(F.col("html")))).withColumns({
        "hrefs": settled(_hrefs(F.col("page"), profile)), "named": settled(_first_base(F.col("page"))), "here": F.coalesce(page_number(F.col("url"), profile), F.lit(1)),
        "base": F.coalesce(resolve(F.col("url"), t.truthy(F.get(F.col("h.base_href"), F.lit(0)))), F.col("url"))})
    read = _with_urls(read.select(*RUN, "seq", "url", "status", "block", "hrefs", "named", F.when(F.col("status") == 200, ranked).alias("candidates")))
    return read.join(run_bounds(mine), [*RUN, "block"], "left").drop("block")


def next_page(pages: DataFrame, profile: SourceProfile) -> DataFrame:
    """One row per listing page: the link to follow, or why paging stops there.

    Two stored tables stand between the pages and the result: what each listing page says, and since when each url counts as requested.
    """
    spark = pages.sparkSession
    listing = saved(listing_facts(pages, profile), work_path(spark, "listing-facts"))

    # Urls already requested when a page is handled: products shown up to it, listing pages fetched up to it (not the start page).
    shown = listing.select(*RUN, "seq", F.explode("link_urls").alias("next_url"), F.col("seq").alias("shown"))
    fetched = listing.filter("seq > start_seq").select(*RUN, "seq", F.col("url").alias("next_url"), F.lit(None).cast("bigint").alias("shown"))
    visited = saved(shown.unionByName(fetched).groupBy(*RUN, "next_url").agg(F.min("seq").alias("since"), F.min("shown").alias("shown")),
                    work_path(spark, "visited"))
    fresh = visited.filter("shown IS NOT NULL").groupBy(*RUN, F.col("shown").alias("seq")).agg(F.count("*").alias("new_products"))
    open_ = (listing.select(*RUN, "seq", "url", F.posexplode("candidates").alias("place", "c"))
             .select(*RUN, "seq", "url", "place", "c.next_url").join(visited.drop("shown"), [*RUN, "next_url"], "left")
             .filter("since IS NULL OR since > seq").groupBy(*RUN, "seq", "url").agg(F.min("place").alias("place")))

    no_products = F.col("new_products") == 0
    if profile.stop_markers is not None:
        no_products = no_products & t.contains_any(F.col("url"), profile.stop_markers)
    return (listing.select(*RUN, "seq", "url", "status", "gone_seq", "candidates").join(fresh, [*RUN, "seq"], "left")
            .join(open_, [*RUN, "seq", "url"], "left")
            .withColumns({"new_products": F.coalesce("new_products", F.lit(0)), "pick": F.get("candidates", F.col("place"))})
            .withColumn("stop_reason", F.when(F.col("status") == 404, "not_found").when(F.col("gone_seq") < F.col("seq"), "after_not_found")
                        .when(no_products, "no_products").when(F.col("pick").isNull(), "no_next_link"))
            .select(*RUN, "seq", "url", "new_products",
                    F.when(F.col("stop_reason").isNull(), F.col("pick.kind")).alias("kind"),
                    F.when(F.col("stop_reason").isNull(), F.col("pick.next_url")).alias("next_url"), "stop_reason"))
