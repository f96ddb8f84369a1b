"""What keeps a job's cost in step with its input: rules that loop and do not recurse, expressions evaluated once, rows dealt to all cores."""

import json

from pyspark.sql import functions as F

from shelfmark.operators import links as L
from shelfmark.operators.extract import extract_comics
from shelfmark.plans import variants as V
from shelfmark.profiles import PRESS
from shelfmark.sources import arrays as A


def test_a_long_story_without_stops(make_pages):
    # A run of words behind "by" was matched by recursion, which ended the executor.
    story = "by " + "abc " * 20_000
    page = f'<h1 class="product_title">Zed Issue 4</h1><div class="woocommerce-Tabs-panel--description"><p>Made {story}</p></div>'
    row = extract_comics(make_pages([(PRESS.source, "https://press.example/product/z/", page)]), PRESS).select("title", "artists").first()
    assert row.title == "Zed Issue 4" and row.artists == [("abc " * 20_000).strip()]


def test_links_look_at_a_page_once(make_pages):
    pages = make_pages([(PRESS.source, "https://press.example/shop/", '<a href="/product/a/">a</a>')])
    links = L.product_links(pages, PRESS)
    assert [r.link_url for r in links.collect()] == ["https://press.example/product/a/"]
    plan = links._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<!--") == 1


def test_rendered_parts_are_dealt_to_all_cores(spark, tmp_path):
    names = F.concat(F.lit("a b"), F.col("id").cast("string"))
    part = spark.range(8).select(F.col("id").alias("p_partkey"), names.alias("p_name"), F.lit("PROMO").alias("p_type"), F.lit("Brand#12").alias("p_brand"),
                                 F.lit(7).alias("p_size"), F.lit(9.5).alias("p_retailprice"))
    part.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    for pages in (V.press_variants(spark, str(tmp_path)), V.retail_variants(spark, str(tmp_path))):
        assert pages.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism and pages.count() == 8


def test_a_small_range_reads_little(tmp_path):
    path = tmp_path / "a.json"
    path.write_text("[" + ",".join(json.dumps({"n": i, "t": "]" * (i % 50)}) for i in range(100_000)) + "]")
    size = path.stat().st_size

    class Counted:
        def __init__(self, file):
            self.file, self.bytes = file, 0

        def read_at(self, n, at):
            data = self.file.read_at(n, at)
            self.bytes += len(data)
            return data

    with A.open_file(str(path)) as file:
        counted = Counted(file)
        found = list(A.members(counted, A.Range(str(path), 0, 8192, size)))
    assert len(found) > 100 and counted.bytes < 32 << 10


def test_running_sums_give_true_starts(spark, tmp_path):
    text = json.dumps([{"a": ['"[', "\\", {"b": "]],{"}], "c": i} if i % 3 else "],[" for i in range(40)], indent=1)
    path = tmp_path / "a.json"
    path.write_text(text)
    size, step = len(text), 7
    told, rows = [], []
    with A.open_file(str(path)) as file:
        for at in range(0, size, step):
            r, ends = A.Range(str(path), at, min(at + step, size), size), [A.summary(file, at, min(at + step, size), k) for k in (False, True)]
            told.append((r, ends))
            number = lambda e: (e["inside"], e["depth"], e["marks"], {int(d): n for d, n in e["commas"].items()})
            rows.append((r.path, r.start, r.end, r.size, *map(number, ends)))
    got = A.true_starts(spark.createDataFrame(rows, A.BORDERS)).orderBy("start").collect()
    assert [A.Range(**r.asDict()) for r in got] == A.resolved(told)
