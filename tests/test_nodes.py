from pyspark.sql import functions as F

from shelfmark.operators import nodes as N
from shelfmark.operators.shred import Groups, from_html
from shelfmark.profiles import INFO, WOO_PRODUCT

TABLE = INFO.removeprefix(".")
PAGES = [
    ("", "empty"), (None, "null"), ("no tags", "plain"), ("<p>1</p>", "nothing selected"),
    ("<h1>x</h1><h1 class='entry-title'>a<b>not own</b>c</h1><i class='k product-title'>second</i>", "texts of its own, in order"),
    ("<div class=price><div class=price><span class=amount>1</span></div><bdi>2</bdi></div><span class=amount>outside</span>", "nested outer step"),
    ("<div class=price></div><bdi>behind</bdi><div class=price><p><bdi>in<bdi>deep</bdi></bdi>", "closed before, open at the end"),
    (f"<table class={TABLE}><tr><th>k &amp; l<td>v<b>w</b> <i></i><tr><td>one<tr></table><table><tr><td>no</table>", "rows without end tags"),
    (f"<table class={TABLE}><tr><td>a<table><tr><td>inner<td>cells</table>b</table>", "table in a cell"),
    ("<dl class='product_meta x'><table><tbody><tr><td><script>'<td>'</script>s</table></dl><tr><td>no", "raw text"),
]


def test_selected_nodes_equal_the_page_parse(spark):
    df = spark.createDataFrame([(html, name) for html, name in PAGES], "html string, name string")
    found = {r.name: r for r in N.product_nodes(df, ["name"], TABLE).collect()}
    rules = {k: WOO_PRODUCT[k] for k in ("title", "price_all")} | {"rows": Groups(f"{INFO} tr, .product_meta tr", {"cells": Groups("td, th", {"chunks": "*::deep"})})}
    for r in df.select("name", from_html(F.col("html"), rules).alias("h")).collect():
        if r.name not in found:  # no nodes, no row
            assert r.name in ("empty", "null") and not any(r.h)
            continue
        got = found[r.name]
        assert (got.title, got.prices) == (r.h.title[0] if r.h.title else None, r.h.price_all), r.name
        if r.name != "table in a cell":  # the outermost row and cell take in what is nested; the page parse lists inner ones besides
            assert got.info == [["".join(cell.chunks) for cell in row.cells] for row in r.h.rows], r.name
    assert found["rows without end tags"].info == [["k & l", "vw "], ["one"], []]
    assert found["table in a cell"].info == [["ainnercellsb"]]
    assert found["nested outer step"].prices == ["1", "2"]


def test_marks_do_not_depend_on_how_pages_are_dealt(spark):
    df = spark.createDataFrame([(i, f"<div class=price><span class=amount>{i}</span></div>" * (1 + i % 3)) for i in range(40)], "n int, html string")
    for parts in (1, 7):
        got = N.product_nodes(df.repartition(parts), ["n"], TABLE).collect()
        assert {r.n: r.prices for r in got} == {i: [str(i)] * (1 + i % 3) for i in range(40)}


def test_one_exchange_by_page(spark):
    df = spark.createDataFrame([(1, "<p>")], "n int, html string")
    plan = N.product_nodes(df, ["n"], TABLE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_a_page_is_asked_only_what_it_can_answer_and_once(monkeypatch):
    from shelfmark.operators import shred
    asked = []
    find = shred.Path._find
    monkeypatch.setattr(shred.Path, "_find", lambda self, page, root: asked.append((self.selector, root)) or find(self, page, root))
    rules = {"low": ".price .amount::text, .none::text", "all": ".price .amount::text, .price b::text", "none": "h4 + h5::deep, #x p::html",
             "rows": Groups("tr", {"cells": Groups("td", {"chunks": "*::deep"}), "none": "th::text"})}
    reader = shred.Reader({k: v if isinstance(v, Groups) else shred.Values(v) for k, v in rules.items()})
    html = '<p class="price"><i class="amount">1<b>2</b>3</i></p><table><tr><td>a<b>b</b>c<td>d</table>'
    rows = [{"cells": [{"chunks": ["a", "b", "c"]}, {"chunks": ["d"]}], "none": []}]
    assert reader(html) == {"low": ["1", "3"], "all": ["1", "2", "3"], "none": [], "rows": rows}
    assert {s for s, _ in asked} == {".price .amount", ".price b", "tr", "td", "*"} and len(asked) == len(set(asked))
    assert reader("") == {"low": [], "all": [], "none": [], "rows": []}
