"""Pages as rows of nodes, and selectors as interval tests within a page.

A node's number ``pre`` counts nodes in document order and ``end`` is the number of the last node inside it, so node j lies inside element i when
i < j <= end[i].  Elements nest, so j lies inside some element of a set exactly when the largest ``end`` of the set's elements before j reaches it.
That is a running maximum over the page's nodes: a chain of descendant steps takes one pass for each step, any number of chains at once, and
all of them share one exchange by page.  Nothing is joined, and a page with many matches of a step costs no more than one with few.

An empty or null page has no nodes.  Pages whose keys are the same are taken for one page; give repeated ones a key of their own.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.operators.shred import Page

NODE = "pre: bigint, end: bigint, parent: bigint, tag: string, classes: array<string>, attrs: map<string, string>, value: string"


def node_rows(pages: DataFrame, key: list[str], html: str = "html") -> DataFrame:
    """One row per element (tag, classes, attrs) and per text (value) of each page, with pre, end and parent; no shuffle."""
    kind = pa.list_(pa.struct([("pre", pa.int64()), ("end", pa.int64()), ("parent", pa.int64()), ("tag", pa.string()), ("classes", pa.list_(pa.string())),
                               ("attrs", pa.map_(pa.string(), pa.string())), ("value", pa.string())]))

    def nodes(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            p = Page(text or "")
            out.append([{"pre": i, "end": p.end[i], "parent": p.parent[i], "tag": p.tag[i], "classes": sorted(p.classes.get(i, ())),
                         "attrs": list(p.attrs[i].items()), "value": p.value[i]} for i in range(len(p.tag))])
        return pa.array(out, type=kind)

    read = F.arrow_udf(nodes, returnType=f"array<struct<{NODE}>>").asNondeterministic()
    return pages.select(*key, F.inline(read(F.col(html))))


def has_class(*names: str) -> Column:
    return F.arrays_overlap("classes", F.array(*[F.lit(n) for n in names]))


def is_tag(*names: str) -> Column:
    return F.col("tag").isin(*names)


def _true(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def mark(nodes: DataFrame, key: list[str], **chains: list[Column]) -> DataFrame:
    """A boolean column per chain: whether an element passes its last step and lies inside one that passes the step before, and so on."""
    before = Window.partitionBy(*key).orderBy("pre").rowsBetween(Window.unboundedPreceding, -1)
    out = nodes.withColumns({name: _true(F.col("tag").isNotNull() & steps[0]) for name, steps in chains.items()})
    for k in range(1, max(len(s) for s in chains.values())):
        longer = {name: steps[k] for name, steps in chains.items() if len(steps) > k}
        reach = {name: F.max(F.when(F.col(name), F.col("end"))).over(before) for name in longer}
        out = out.withColumns({name: _true(F.col("tag").isNotNull() & step & (reach[name] >= F.col("pre"))) for name, step in longer.items()})
    return out


def within(nodes: DataFrame, key: list[str], **marks: str) -> DataFrame:
    """A column per mark: the number of the outermost marked element that the node is or lies inside of, NULL if there is none."""
    upto = Window.partitionBy(*key).orderBy("pre").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    low = (1 << 32) - 1
    # Of the elements around a node the outermost has the largest end, and of equal ends the smallest number: both in one number to compare.
    reach = {name: F.max(F.when(F.col(m), F.shiftleft("end", 32) + (low - F.col("pre")))).over(upto) for name, m in marks.items()}
    return nodes.withColumns({name: F.when(F.shiftright(r, 32) >= F.col("pre"), low - r.bitwiseAND(F.lit(low))) for name, r in reach.items()})


def own_text(nodes: DataFrame, key: list[str], **marks: str) -> DataFrame:
    """A boolean column per mark: the node is a text right below a marked element."""
    family = Window.partitionBy(*key, F.when(F.col("tag").isNull(), F.col("parent")).otherwise(F.col("pre")))
    return nodes.withColumns({name: _true(F.col("tag").isNull() & F.max(F.when(F.col("tag").isNotNull(), F.col(m))).over(family)) for name, m in marks.items()})


def product_nodes(pages: DataFrame, key: list[str], info: str) -> DataFrame:
    """(key, title, prices, info) of WooCommerce product pages: title texts, price texts, and the info table's rows as lists of cell texts.

    ``info`` is the class of the info table.  Every page gives a row; what it lacks is NULL or empty.
    """
    nodes = node_rows(pages, key)
    row = [has_class(info, "product_meta"), is_tag("tr")]
    nodes = mark(nodes, key, named=[(is_tag("h1") & has_class("product_title", "entry-title")) | has_class("product-title")],
                 amount=[has_class("price"), has_class("woocommerce-Price-amount", "amount") | is_tag("bdi")], in_row=row, in_cell=[*row, is_tag("td", "th")])
    nodes = own_text(within(nodes, key, row="in_row", cell="in_cell"), key, title="named", price="amount")
    here = F.struct("pre", "value")
    in_order = lambda c: F.array_sort(F.flatten(F.collect_list(c)))
    # Three steps up, from cells to rows to the page; pages lie together already, so none of them shuffles.
    cells = nodes.groupBy(*key, "row", "cell").agg(
        F.collect_list(F.when(F.col("title"), here)).alias("titles"), F.collect_list(F.when(F.col("price"), here)).alias("prices"),
        F.collect_list(F.when(F.col("cell").isNotNull() & F.col("tag").isNull(), here)).alias("texts"))
    joined = F.array_join(F.transform(F.array_sort("texts"), lambda x: x["value"]), "")
    rows = cells.groupBy(*key, "row").agg(
        in_order("titles").alias("titles"), in_order("prices").alias("prices"),
        F.collect_list(F.when(F.col("cell").isNotNull(), F.struct("cell", joined.alias("text")))).alias("cells"))
    line = F.struct("row", F.transform(F.array_sort("cells"), lambda x: x["text"]).alias("cells"))
    found = rows.groupBy(*key).agg(in_order("titles").alias("titles"), in_order("prices").alias("prices"),
                                   F.collect_list(F.when(F.col("row").isNotNull(), line)).alias("lines"))
    values = lambda c: F.transform(c, lambda x: x["value"])
    return found.select(*key, F.get(values("titles"), F.lit(0)).alias("title"), values("prices").alias("prices"),
                        F.transform(F.array_sort("lines"), lambda x: x["cells"]).alias("info"))
