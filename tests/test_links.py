from pyspark.sql import functions as F

from shelfmark.functions.entities import unescape
from shelfmark.operators import links as L
from shelfmark.profiles import PRESS, RETAIL

SHOP = "https://s.example/shop/"
P1 = '<a href="/product/a/">a</a>'


def decide(make_pages, profile, rows):
    pages = make_pages([(profile.source, u, h, i, *rest) for i, (u, h, *rest) in enumerate(rows)])
    return {r.seq: r for r in L.next_page(pages, profile).collect()}


def test_anchor_hrefs_equal_the_page_parse(spark):
    from shelfmark.operators.shred import from_html
    html = """<a href=/x>1</a><A HREF='/y?a=1&amp;b=2'>2</A><!-- <a href="/no"> --><script>var s='<a href="/no">'</script><abbr href="/no">
    <a data-href="/no" class="k" href = "/z">3</a><a name=x><a
    href="/w>v">4</a><style>a{}</style><a href="">"""
    df = spark.createDataFrame([(html,)], "html string").select(
        L.anchor_hrefs(F.col("html")).alias("fast"), from_html(F.col("html"), {"a": "a::attr(href)"})["a"].alias("full"))
    r = df.first()
    assert r.fast == ["/x", "/y?a=1&b=2", "/z", "/w>v"] == [u for u in r.full if u]


def test_references_equal_the_standard_library(spark):
    import html
    texts = ["", "a&b", "&amp;&lt;x&gt;", "a=1&#038;b", "&#x26;", "&#X1F389;&#128521;", "&eacute;&eacute", "&copy2", "&nope;&nope", "&#0;&#x80;&#150;&#xD800;&#x110000;&#99999999999;", "&#1;&#xFDD0;&#13;",
             "&notit;&notin;", "&#;&#x;&", "é&amp;amp;", "&CounterClockwiseContourIntegral;"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [(r.t, r.u) for r in df.select("t", unescape(F.col("t")).alias("u")).collect()] == [(t, html.unescape(t)) for t in texts]


def test_links_are_seen_from_the_first_base_with_an_href(make_pages):
    page = '<base target="x"><!-- <base href="/no/"> --><base href="/sub/"><base href="/no/"><a href="shop/product/a/?x=1&#038;y=2">a</a>'
    got = L.product_links(make_pages([(PRESS.source, SHOP, page)]), PRESS).collect()
    assert [r.link_url for r in got] == ["https://s.example/sub/shop/product/a/?x=1&y=2"]


def test_paging_rules(make_pages):
    got = decide(make_pages, PRESS, [
        (SHOP, P1 + '<a class="next" href="/shop/page/2/">n</a>'),                                    # 0 by class
        (SHOP + "page/2/", '<a href="/product/b/">b</a><div class="pagination"><a href="/shop/page/1/">1</a><a href="/shop/page/4/">4</a></div>'),
        (SHOP + "page/4/", '<a href="/product/c/">c</a>'),                                            # 2 constructed
        (SHOP + "page/5/", P1),                                                                       # 3 nothing new
        ("https://s.example/shop/books/", '<a href="/product/d/">d</a>'),                             # 4 constructed without /shop
        ("https://s.example/list?paged=3", '<a href="/product/e/">e</a><a class="next" href="?paged=3">self</a><a rel="next" href="/shop/page/4/">seen</a>')])
    assert [(got[i].kind, got[i].next_url, got[i].stop_reason) for i in range(6)] == [
        ("next", SHOP + "page/2/", None), ("number", SHOP + "page/4/", None), ("constructed", SHOP + "page/5/", None), (None, None, "no_products"),
        ("constructed", "https://s.example/books/page/2/", None), ("constructed", "https://s.example/list/page/4/", None)]
    assert [got[i].new_products for i in range(6)] == [1, 1, 1, 0, 1, 1]


def test_load_more_when_the_constructed_page_was_seen(make_pages):
    got = decide(make_pages, PRESS, [(SHOP, P1), (SHOP + "page/2/", '<a href="/product/b/">b</a>'),
                                     (SHOP + "?x", '<a href="/product/c/">c</a><button class="load-more" data-url="/more">m</button>')])
    assert (got[2].kind, got[2].next_url) == ("load_more", "https://s.example/more")


def test_not_found_stops_the_run(make_pages):
    got = decide(make_pages, PRESS, [(SHOP, P1), (SHOP + "page/2/", "", 404), (SHOP + "page/3/", '<a href="/product/z/">z</a>')])
    assert [got[i].stop_reason for i in range(3)] == [None, "not_found", "after_not_found"]


def test_retail_goes_on_without_products_unless_paginated(make_pages):
    base = "https://r.example/index.php?route=product/category"
    got = decide(make_pages, RETAIL, [(base, '<ul class="pagination"><li><a href="?page=2">&gt;</a></li></ul>'), (base + "&page=2", "<p>none</p>")])
    assert (got[0].kind, got[0].next_url) == ("next", "https://r.example/index.php?page=2")
    assert got[1].stop_reason == "no_products"


def test_bounds_of_a_run_reach_every_block_of_it(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK", 4)
    rows = [("a", "s", n, 404 if n in (9, 30) else 200) for n in range(3, 41)] + [("b", "s", 7, 200), ("b", "s", 70, 200), ("c", "s", 1, 404)]
    listing = spark.createDataFrame(rows, "run_id string, source string, seq bigint, status int").withColumn("block", F.floor(F.col("seq") / L.BLOCK))
    got = {(r.run_id, r.block): (r.start_seq, r.gone_seq) for r in L.run_bounds(listing).collect()}
    assert got == {("a", k): (3, 9) for k in range(11)} | {("b", 1): (7, None), ("b", 17): (7, None), ("c", 0): (1, 1)}


def test_one_run_is_decided_alike_in_blocks_of_any_size(make_pages, monkeypatch):
    rows = [(f"{SHOP}page/{n}/", f'<a href="/product/{n // 2 if n % 5 else n}/">p</a><a class="next" href="/shop/page/{n + 1 + n % 3}/">n</a>',
             404 if n == 33 else 200) for n in range(1, 40)]
    whole = decide(make_pages, PRESS, rows)
    monkeypatch.setattr(L, "BLOCK", 2)
    assert decide(make_pages, PRESS, rows) == whole
    assert {r.stop_reason for r in whole.values()} == {None, "no_products", "not_found", "after_not_found"}


def test_frontier(make_pages, spark):
    pages = make_pages([(PRESS.source, SHOP, P1 + '<a href="/product/b/">b</a>' + P1), (PRESS.source, SHOP + "x", P1)])
    links = L.product_links(pages, PRESS)
    assert links.count() == 3
    visited = spark.createDataFrame([("https://s.example/product/b/",)], "url string")
    assert [r.link_url for r in L.frontier(links, visited).collect()] == ["https://s.example/product/a/"]
    assert {(r.link_url, r.seq) for r in L.first_seen(links).collect()} == {("https://s.example/product/a/", 0), ("https://s.example/product/b/", 0)}
