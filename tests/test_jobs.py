"""Items, tables, exports and streams end to end on small inputs."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.operators import merge as M
from shelfmark.operators import quality as Q
from shelfmark.plans import jobs
from shelfmark.profiles import PRESS, RETAIL, STUDIO
from shelfmark.sources import exports as X
from shelfmark.sources.tables import compact, read_table
from shelfmark.streaming import ingest

T1, T2, T3 = (dt.datetime(2025, 1, d) for d in (1, 2, 3))
PRICE = '<p class="price"><span class="amount">50</span></p>'


def shop(make_pages):
    return make_pages([
        (PRESS.source, "https://p.example/shop/", "<footer><p> About us </p></footer>"),
        (PRESS.source, "https://p.example/product/a/", f"<h1>Yagyaa 2</h1>{PRICE}"),
        (PRESS.source, "https://p.example/product/a/", "<h1>Yagyaa again</h1>"),
        (PRESS.source, "https://p.example/product/b/", f'<h1>Nagraj 3</h1>{PRICE}<div class="product_meta"><table><tr><td> <td>x</table></div>'),
        (PRESS.source, "https://p.example/product/c/", f'<h1>Doga 3</h1>{PRICE}<div class="product-short-description"><p> </p></div>'),
        (PRESS.source, "https://p.example/product/d/", "gone", 5, 404),
        (STUDIO.source, "https://st.example/shop/", "<p>no about</p>"),
        (RETAIL.source, "https://r.example/product/x", "<p>no title</p>"),
        (RETAIL.source, "https://r.example/product/y", '<h1>Bankelal 9</h1><ul class="list-unstyled"><li><h2>₹99</h2></ul>')])


@pytest.fixture(scope="module")
def items(spark, make_pages, tmp_path_factory):
    """The shop's items, extracted once and stored, as a run's export would be."""
    path = str(tmp_path_factory.mktemp("items"))
    jobs.run_items(jobs.items(shop(make_pages))).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_item_stream(items):
    got = sorted((r.source, r.entity, r.title or r.name, r.url or "-", r.parse_issue or "-") for r in items.collect())
    p, s, r = PRESS.source, STUDIO.source, RETAIL.source
    assert got == sorted([
        (p, "publisher", PRESS.name, PRESS.website, "-"), (s, "publisher", STUDIO.name, STUDIO.website, "-"),
        (p, "comic", "Yagyaa 2", "https://p.example/product/a/", "-"),          # its series and the repeat are dropped by url
        (p, "comic", "Nagraj 3", "-", "blank_info_cell"),                        # cut before its series was known
        (p, "comic", "Doga 3", "-", "null_description"), (p, "series", "Doga", "https://p.example/product/c/", "-"),
        (r, "comic", "Bankelal 9", "https://r.example/product/y", "-")])


def test_publisher_text(items):
    about = {r.source: r.description for r in items.filter("entity = 'publisher'").collect()}
    assert about == {PRESS.source: "About us", STUDIO.source: STUDIO.default_description}


def batch(spark, rows):
    ddl = "source string, seq bigint, entity string, name string, website string, " + schemas.COMIC
    full = [{"source": PRESS.source, "entity": "comic", "scraped_at": "2025-11-25T09:30:00+05:30", **r} for r in rows]
    names = [f.split(" ")[0] for f in ddl.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in full], ddl)


def test_catalog_history(spark, tmp_path):
    root = str(tmp_path / "t")
    loads = [(1, T1, [dict(url="u1", title="A", price=404.0, description="d1", seq=1, issue=2, listing_date="2024-10-25")]),
             (2, T2, [dict(url="u1", title="A", price=404.0, description="d2", seq=1), dict(url="u1", title="A", price=449.0, description="d3", seq=2)]),
             (3, T3, [dict(url="u1", title="A", description="d4", seq=1), dict(title="A", price=10.0, seq=2),
                      dict(url="u2", title="B", price=1.005, listing_date="2024-13-25", seq=3)])]
    for load_id, at, rows in loads:
        jobs.load(spark, batch(spark, rows), root, load_id, F.lit(at))
    rows = {(r.url, r.price): r for r in read_table(spark, "catalog", root + "/catalog").collect()}
    assert {(k[0], float(k[1])): (r.description, r.created_at, r.updated_at) for k, r in rows.items()} == {
        ("u1", 404.0): ("d1", T1, T2), ("u1", 449.0): ("d3", T2, T2)}
    first = next(r for r in rows.values() if float(r.price) == 404.0)
    assert (first.source, first.status, first.uploaded_date, first.issue) == (M_KEY, "CREATED", dt.date(2024, 10, 25), 2)
    assert json.loads(first.raw_json)["description"] == "d1"
    # a load writes only its own keys, and a base gives the same table
    assert spark.read.parquet(root + "/catalog/snapshot=2").count() == 2
    told = lambda: sorted(map(str, read_table(spark, "catalog", root + "/catalog").collect()))
    log = told()
    compact(spark, root + "/catalog")
    assert told() == log and [r.reason for r in spark.read.parquet(root + "/rejects/snapshot=3").filter("seq = 3").collect()] == ["bad_listing_date"]
    # the same load again gives the same snapshot
    before = sorted(map(str, read_table(spark, "catalog", root + "/catalog").collect()))
    jobs.load(spark, batch(spark, loads[2][2]), root, 3, F.lit(T3))
    assert sorted(map(str, read_table(spark, "catalog", root + "/catalog").collect())) == before
    reasons = {r.seq: r.reason for r in batch(spark, loads[2][2]).withColumn("reason", Q.load_reject(batch(spark, loads[2][2]))).collect()}
    assert reasons == {1: "no_price", 2: "no_url", 3: "bad_listing_date"}


M_KEY = PRESS.name.upper().replace(" ", "_")


def test_merge_by_batches_equals_merge_at_once(spark):
    rows = [dict(url=f"u{i % 7}", title="A", price=float(i % 3), description=str(i), seq=i) for i in range(1, 60)]
    first, second = batch(spark, rows[:30]), batch(spark, rows[30:])
    a, b = M.catalog_rows(first, F.lit(T1)), M.catalog_rows(second, F.lit(T2))
    once = M.first_write_wins(a.unionByName(b), M.CATALOG_KEY, ["created_at", "seq"])
    stepwise = M.merge_catalog(M.first_write_wins(a, M.CATALOG_KEY, ["created_at", "seq"]), b)
    assert sorted(map(str, once.select(sorted(once.columns)).collect())) == sorted(map(str, stepwise.select(sorted(once.columns)).collect()))


def test_sources_last_write_wins(spark):
    def pub(desc, seq=1):
        return batch(spark, [dict(entity="publisher", name=PRESS.name, website="w", url=PRESS.website, description=desc, seq=seq)])
    one = M.merge_sources(spark.createDataFrame([], schemas.SOURCES), M.source_rows(pub("x"), F.lit(T1)))
    two = M.merge_sources(one, M.source_rows(pub(None), F.lit(T2)))
    three = M.merge_sources(two, M.source_rows(batch(spark, [dict(title="A", price=1.0, url="u", seq=1)]), F.lit(T3)))
    r = [tuple(x) for x in three.select("source", "description", "url", "created_at", "updated_at").collect()]
    assert r == [(M_KEY, None, PRESS.website, T1, T2)]


def test_dedupe_is_order_and_partition_independent(spark):
    rows = [("r", "s", i % 5 and f"u{i % 5}" or None, i) for i in range(50)]
    df = spark.createDataFrame(rows, "run_id string, source string, url string, seq bigint")
    want = {(f"u{k}", k) for k in range(1, 5)} | {(None, i) for i in range(0, 50, 5)}
    for n in (1, 7):
        assert {(r.url, r.seq) for r in Q.dedupe_by_url(df.repartition(n)).collect()} == want


def test_exports_round_trip(spark, items, tmp_path):
    X.write_json(items, str(tmp_path / "json"))
    back = X.read_json(spark, str(tmp_path / "json"))
    pick = lambda df: sorted(map(str, df.select("source", "entity", "title", "price", "genre", "url").collect()))
    assert pick(back) == pick(items.withColumn("price", F.col("price")))
    X.write_csv(items, str(tmp_path / "csv"))
    csv = spark.read.csv(str(tmp_path / "csv/comic"), header=True)
    assert csv.columns == sorted(csv.columns) and "isbn" not in csv.columns and csv.count() == 4


def test_array_export_scan(spark, tmp_path):
    folder = tmp_path / "2025-11-25" / "Shop"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text(json.dumps([{"title": "A", "price": 5, "genre": ["x"], "additional_info": {"k": "v"}}, "{}", 3, {"name": "P"}], indent=2))
    (folder / "b.json").write_text('{"title": "B"}')
    (folder / "c.json").write_text('[{"title": "C"},')
    rows = {(r.position): r for r in X.read_export(spark, str(folder)).collect()}
    assert sorted(rows) == [0, 3] and rows[0].price == 5.0 and rows[0].genre == ["x"] and rows[0].additional_info == {"k": "v"} and rows[3].name == "P"
    import os
    os.utime(folder / "a.json", (1, 1)), os.utime(folder / "b.json", (9e8, 9e8)), os.utime(folder / "c.json", (5, 5))
    latest = X.latest_files(X.list_files(spark, str(tmp_path))).collect()
    assert [(r.run_date, r.folder, r.file.split("/")[-1]) for r in latest] == [(dt.date(2025, 11, 25), "Shop", "b.json")]


def test_stream_equals_batch(spark, make_pages, tmp_path):
    pages = shop(make_pages).coalesce(1)
    pages.write.parquet(str(tmp_path / "in"))
    with_url, without = ingest.dedupe_stream(ingest.record_stream(ingest.page_stream(spark, str(tmp_path / "in")), [PRESS]))
    for name, df in (("a", with_url), ("b", without)):
        df.writeStream.format("parquet").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"ck{name}")).trigger(
            availableNow=True).start().awaitTermination()
    pick = lambda df: sorted(map(str, df.select("source", "entity", "url", "parse_issue").collect()))
    streamed = spark.read.parquet(str(tmp_path / "a")).unionByName(spark.read.parquet(str(tmp_path / "b")))
    assert pick(streamed) == pick(jobs.items(pages, [PRESS]))


def test_stream_merges_into_the_catalog(spark, make_pages, tmp_path):
    """Two micro-batches; the repeat of a url loses by seq within a batch and by batch across them."""
    for i, low in enumerate((True, False)):
        part = shop(make_pages).filter("seq < 3" if low else "seq >= 3")
        part.unionByName(shop(make_pages).filter("seq in (0, 2)")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    records = ingest.record_stream(ingest.page_stream(spark, str(tmp_path / "in"), files_per_trigger=1), [PRESS])
    ingest.write_merged(records, str(tmp_path / "t"), str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    items = spark.read.parquet(str(tmp_path / "t/items"))
    assert sorted((r.entity, r.title or r.name, r.batch) for r in items.collect()) == [
        ("comic", "Doga 3", 1), ("comic", "Nagraj 3", 1), ("comic", "Yagyaa 2", 0), ("publisher", PRESS.name, 0), ("series", "Doga", 1)]
    assert [r.url for r in read_table(spark, "catalog", str(tmp_path / "t/catalog")).collect()] == ["https://p.example/product/a/"]
    assert [r.source for r in read_table(spark, "sources", str(tmp_path / "t/sources")).collect()] == [M_KEY]


def test_array_exports_into_the_tables(spark, tmp_path):
    """The newest file of each folder is loaded; record text stays as read, and a run without records has its source row."""
    import os
    def export(folder, name, records, at):
        (tmp_path / "x/2025-11-25" / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / "x/2025-11-25" / folder / name).write_text(json.dumps(records))
        os.utime(tmp_path / "x/2025-11-25" / folder / name, (at, at))
    comic = {"title": "A", "price": 12.5, "url": "u1", "scraped_at": "2025-11-25T09:30:00+05:30", "extra": {"k": 1}}
    export("BullseyePress", "old.json", [{**comic, "title": "old"}], 1e9)
    export("BullseyePress", "new.json", [comic, {**comic, "extra": 2}, {**comic, "url": "u2", "scraped_at": None}, "stray"], 1.1e9)
    export("HolyCow", "a.json", [], 1e9)
    jobs.load_exports(spark, str(tmp_path / "x"), str(tmp_path / "t"), 1, F.lit(T1))
    rows = read_table(spark, "catalog", str(tmp_path / "t/catalog")).collect()
    assert [(r.title, r.url, r.source, json.loads(r.raw_json)["extra"]) for r in rows] == [("A", "u1", M_KEY, {"k": 1})]
    assert {r.source for r in read_table(spark, "sources", str(tmp_path / "t/sources")).collect()} == {M_KEY, STUDIO.name.upper().replace(" ", "_")}
    assert [(r.url, r.reason) for r in spark.read.parquet(str(tmp_path / "t/rejects")).collect()] == [("u2", "no_scraped_at")]
    jobs.load_exports(spark, str(tmp_path / "t"), str(tmp_path / "none"), 1, F.lit(T1))  # no export, no table
