"""The catalog over many loads: the same rows as one merge, a bounded number of folders, and lookups that read only what may hold a key."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.operators import merge as M
from shelfmark.sources import tables as T

FIELDS = list(schemas.fields(schemas.CATALOG))
DAY = lambda n: dt.datetime(2025, 1, 1) + dt.timedelta(days=n)


def load(spark, n, urls):
    rows = [tuple({"id": f"i{u}", "url": f"u{u}", "title": "A", "price": float(u % 3), "source": "S", "description": f"{n}/{u}", "created_at": DAY(n), "updated_at": DAY(n)}.get(c) for c in FIELDS)
            for u in urls]
    ddl = ", ".join(f"{c} {'double' if 'decimal' in k else k}" for c, k in schemas.fields(schemas.CATALOG).items())
    df = spark.createDataFrame(rows, ddl)
    return df.withColumns({c: F.col(c).cast("decimal(10,2)") for c in ("price", "original_price")})


def test_many_loads_equal_one_merge(spark, tmp_path):
    root = f"{tmp_path}/catalog"
    loads = {n: [u for u in range(30) if (u * 7 + n) % 5 < 2] + [100 + n] for n in range(10)}
    every = None
    for n, urls in loads.items():
        batch = load(spark, n, urls)
        T.append(spark, root, batch, n, fan=3)
        every = batch.withColumn("seq", F.lit(n)) if every is None else every.unionByName(batch.withColumn("seq", F.lit(n)))
        now = T.folders(spark, root)
        assert len(now) <= 2 * 3 and sum(f.high - f.low + 1 for f in now) == n + 1
    want = M.first_write_wins(every, M.CATALOG_KEY, ["seq"])
    pick = lambda df: sorted((r.url, r.price, r.description, r.created_at, r.updated_at) for r in df.collect())
    assert pick(T.read_table(spark, "catalog", root)) == pick(want)
    assert [(f.level, f.low, f.high) for f in T.folders(spark, root)] == [(2, 0, 8), (0, 9, 9)]
    # known keys are narrow rows
    last = {r.url: r.description for r in spark.read.parquet(f"{root}/snapshot=9").collect()}
    assert last["u109"] == "9/109" and all(v is None for u, v in last.items() if u != "u109")
    # the newest load again changes nothing; an older unknown one is refused
    T.append(spark, root, load(spark, 9, loads[9]), 9, fan=3)
    assert pick(T.read_table(spark, "catalog", root)) == pick(want)
    with pytest.raises(ValueError):
        T.append(spark, root, load(spark, -1, [1]), -1, fan=3)
    T.compact(spark, root)
    assert len(T.folders(spark, root)) == 1 and pick(T.read_table(spark, "catalog", root)) == pick(want)


def test_lookups_read_what_may_hold_a_key(spark, tmp_path):
    root = f"{tmp_path}/catalog"
    for n in range(4):
        T.append(spark, root, load(spark, n, range(n * 500, n * 500 + 500)), n, fan=9)
    every = T.folders(spark, root)
    assert len(T.may_hold(spark, root, load(spark, 0, range(2000)), every)) == sum(len(spark.read.parquet(f.path).select("bucket").distinct().collect()) for f in every)
    asked = load(spark, 9, [3, 700, 5000])
    paths = T.may_hold(spark, root, asked, every)
    assert {"snapshot=0", "snapshot=1"} <= {p.split("/")[-2] for p in paths} and len(paths) <= 4
    assert sorted(r.url for r in T.known_keys(spark, root, asked).collect()) == ["u3", "u700"]
    assert len(T._read(spark, root, paths).inputFiles()) <= len(paths) + 1
    assert T.known_keys(spark, f"{tmp_path}/none", asked).count() == 0
