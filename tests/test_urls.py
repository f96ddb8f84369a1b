from urllib.parse import urljoin

from pyspark.sql import functions as F

from shelfmark.functions.urls import resolve

BASES = ["https://h.example/a/b/c?x=1#f", "https://h.example", "http://h.example:8080/a/", "https://h.example/a//b", "https://h.example/shop/page/2/"]
LINKS = ["", "/x", "x", "x/y?z=1", "../x", "../../../x", "./x", "..", ".", "a/../b", "/a/./b/../c", "//cdn.example/p", "?q=2", "#top", "?q=2#top",
         "https://o.example/p/../q", "http://o.example", "mailto:a@b.example", "/a/.hidden", "x//y", "/..", "x/..", "हिंदी?क=1", "/p?u=/./x"]


def test_same_as_standard_library(spark):
    rows = [(b, l) for b in BASES for l in LINKS]
    got = spark.createDataFrame(rows, "b string, l string").select("b", "l", resolve(F.col("b"), F.col("l")).alias("u")).collect()
    assert [(r.b, r.l, r.u) for r in got] == [(b, l, urljoin(b, l)) for b, l in rows]


def test_null_link(spark):
    assert spark.sql("select 'https://h.example/' b, cast(null as string) l").select(resolve(F.col("b"), F.col("l")).alias("u")).first().u is None
