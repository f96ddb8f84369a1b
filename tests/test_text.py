"""Golden values of the scalar functions."""

import datetime as dt
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from shelfmark.functions import images, text as t
from shelfmark.functions.patterns import java

GOLDEN = [
    (t.extract_number, [("₹2,898.00INR", 2898.0), ("₹449", 449.0), ("68 Pages", 68.0), ("1,2", 12.0), ("12.", 12.0), ("Free", None), ("१२३ रु", 123.0)]),
    (t.clean_text, [(" a\xa0 b ", "a b"), ("a\x1cb", "a b"), (" \n\xa0", None), ("", None), ("a  b\tc d", "a b c d"), ("a \x85", "a"), (None, None)]),
    (t.parse_date, [("2024-1-5", "2024-01-05"), ("03/04/2024", "2024-03-04"), ("25/12/2024", "2024-12-25"), ("December 5, 2024", "2024-12-05"),
                    ("Dec 5, 2024", "2024-12-05"), ("2024", "2024-01-01"), ("25-12-2024", "25-12-2024"), ("12/25/24", "12/25/24"),
                    ("24-10-05", "24-10-05"), ("2024-13-05", "2024-13-05"), ("2024-02-30", "2024-02-30"), ("024", "024"), (" ", None)]),
    (t.to_int, [("12", 12), ("-5", -5), ("1_000", 1000), ("12.0", None), ("x", None), ("१२", 12), ("9" * 30, None)]),
    (t.split_list, [("a, b;c| ;", ["a", "b", "c"]), (None, [])]),
    (t.split_credits, [("A B, C & D,", ["A B", "C", "D"])]),
    (t.name_key, [("Old Mill", "OLD_MILL"), (None, "")]),
    (t.folder_name, [("one_two", "OneTwo")]),
    (t.slug_person, [("https://s/x-by-deepjoy-subba/", "Deepjoy Subba"), ("https://s/x-by-deepjoy-subba", "Deepjoy Subba"), ("https://s/x-by-one/", None)]),
    (t.language_of, [("Raj Hin", "Hindi"), ("x हिंदी", None), ("ENG.", "English"), ("Englishman", None), ("éhin", None)]),
    (t.url_host, [("https://u@h.example:80/x", "u@h.example:80"), ("ftp://h/", None)]),
    (images.upsize, [("/image/cache/catalog/a-300x300.jpg", "/image/cache/catalog/a-700x700.jpg"),
                     ("/image/cache/catalog/a-700x700.jpg", "/image/cache/catalog/a-800x800.jpg"),
                     ("/image/cache/catalog/a-800x800.jpg", "/image/cache/catalog/a-700x700.jpg"),
                     ("/Image/Cache/catalog/a.jpg", "/image/catalog/a.jpg"), ("/image/a-300x300.jpg", None)]),
    (images.quality_score, [("/a-300x300.jpg", 1), ("/a-600x1.jpg", 2), ("/a-700x.jpg", 5), ("/a-800x8.jpg", 6), ("/a-1200x9.jpg", 7), ("/a.jpg", 8),
                            ("/no-image.png", -1), (None, -1)]),
]


@pytest.mark.parametrize("fn,cases", GOLDEN, ids=[g[0].__name__ for g in GOLDEN])
def test_golden(spark, fn, cases):
    rows = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(cases)], "i int, a string").select("i", fn(F.col("a")).alias("o")).collect()
    assert [r.o for r in sorted(rows)] == [b for _, b in cases]


def test_ist_timestamp_ignores_session_zone(spark):
    df = spark.sql("select timestamp_seconds(1709294400) a, timestamp_micros(1709294400123456) b").select(
        t.ist_timestamp(F.col("a")).alias("a"), t.ist_timestamp(F.col("b")).alias("b"), t.run_file_name(F.col("b")).alias("f"))
    assert tuple(df.first()) == ("2024-03-01T17:30:00+05:30", "2024-03-01T17:30:00.123456+05:30", "2024-03-01-12-00-00-123-PM.json")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = spark.sql("select timestamp_seconds(1709294400) a").select(t.ist_timestamp(F.col("a")).alias("a")).first().a
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == "2024-03-01T17:30:00+05:30"


PATTERNS = [(r"\b(\d+)\b", False), (r"\b(\d+)\s*(?:pages?|pgs?|p\.?)\b", True), (r"\bby\s+([A-Z][a-z]+(?:\s+[A-Z][a-z]+)+)", True),
            (r"^(.+?)(?:\s+Vol\.|[:–\-#])", True), (r"\s*(Writer|Art).*$", True)]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab by Pp.12१é́ि \xa0\x1f:-#\nARTart", max_size=25), min_size=20, max_size=40))
def test_patterns_mean_the_same_in_java(spark, texts):
    got = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string").select(
        "i", *[F.regexp_extract("x", java(p, i), 1).alias(f"p{n}") for n, (p, i) in enumerate(PATTERNS)],
        F.coalesce(t.clean_text(F.col("x")), F.lit("")).alias("clean")).collect()
    for r in got:
        x = texts[r.i]
        assert r.clean == re.sub(r"\s+", " ", x.strip())
        for n, (p, i) in enumerate(PATTERNS):
            m = re.search(p, x, re.I if i else 0)
            assert r[f"p{n}"] == (m.group(1) if m else ""), (p, x)


def test_digits_of_every_script(spark):
    from shelfmark.functions import text as t
    r = spark.createDataFrame([("𝟏𝟐", "x 𝟏𝟐.5", "१२")], "a string, b string, c string").select(
        t.to_int(F.col("a")).alias("a"), t.extract_number(F.col("b")).alias("b"), t.to_int(F.col("c")).alias("c")).first()
    assert (r.a, r.b, r.c) == (12, 12.5, 12)
