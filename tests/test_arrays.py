"""Array files cut into byte ranges: every cut gives the members the whole file gives."""

import json
import random

import pytest

from shelfmark.sources import arrays as A
from shelfmark.sources import exports as X

NASTY = ['"', "\\", '\\"', '\\\\"', "[", "]", "{", "}", ",", '",', "\\u005b", "é", "日", "\n", " ", "a", '"]', "\\\\\\"]


def value(r, depth=0):
    kind = r.randrange(7 if depth < 4 else 4)
    if kind == 0:
        return r.choice([None, True, 1.5, -3, 0])
    if kind in (1, 2, 3):
        return "".join(r.choice(NASTY) for _ in range(r.randint(0, 12)))
    if kind == 4:
        return [value(r, depth + 1) for _ in range(r.randint(0, 4))]
    return {"".join(r.choice(NASTY) for _ in range(r.randint(0, 3))): value(r, depth + 1) for _ in range(r.randint(0, 4))}


def read(path, size):
    """What the two reads give for one file, range by range."""
    data = open(path, "rb").read()
    ranges = [A.Range(path, at, min(at + size, len(data)), len(data)) for at in range(0, len(data), size)]
    with A.open_file(path) as file:
        ends = [json.loads(json.dumps([A.summary(file, r.start, r.end, k) for k in (False, True)])) for r in ranges]
        return [x for r in A.resolved(list(zip(ranges, ends))) for x in A.members(file, r)]


@pytest.mark.parametrize("block", [3, 1 << 20])
def test_any_cut_gives_the_members(tmp_path, monkeypatch, block):
    monkeypatch.setattr(A, "BLOCK", block)
    r = random.Random(1)
    for i in range(60):
        members = [value(r) for _ in range(r.randint(0, 6))]
        text = " \n" * r.randint(0, 2) + json.dumps(members, ensure_ascii=r.random() < 0.5, indent=r.choice([None, 2])) + r.choice(["", "\n", "  \r\n"])
        path = tmp_path / f"{i}.json"
        path.write_text(text)
        for size in (1, 2, 5, 17, 1000):
            got = read(str(path), size)
            assert [n for n, _ in got] == list(range(len(members))), (text, size, got)
            assert [json.loads(t) for _, t in got] == members


BAD = ['{"title": "B"}', '[{"title": "C"},', '[1] [2]', '[1], [2]', 'x [1]', '[1] x', '["open', '[1}', '', '   ', '"[1]"', '[1]]', ']', '[[1]', '{"a": [1]}']


def test_what_is_no_array_is_found(tmp_path):
    for i, text in enumerate(BAD):
        path = tmp_path / f"{i}.json"
        path.write_text(text)
        for size in (1, 2, 1000):
            got = read(str(path), size)
            assert not text or any(t is None for _, t in got), (text, size, got)


def test_files_equal_whole_documents(spark, tmp_path):
    r = random.Random(2)
    texts = BAD + ['[{"title": "a"}, oops]', '[{"title": "a"},, {"title": "b"}]', '[{"title": "a"},]', "[]", "[ ]"]
    for _ in range(30):
        rows = [{"title": value(r, 9), "price": value(r, 9), "genre": ["x", "y"], "additional_info": {"k": "v"}} if r.random() < 0.8 else value(r) for _ in range(r.randint(0, 9))]
        texts.append(json.dumps(rows, indent=r.choice([None, 1])))
    for i, text in enumerate(texts):
        (tmp_path / f"{i:03}.json").write_text(text)
    whole = spark.read.text(str(tmp_path), wholetext=True).selectExpr("value", "_metadata.file_path AS file")
    pick = lambda df: sorted((x.file.split("/")[-1], x.position, x.title, x.price, x.genre, x.additional_info, x.raw_json) for x in df.collect())
    key = lambda rows: sorted(map(str, rows))
    want = key(pick(X.parse_export(whole)))
    for size, task in ((7, 1000), (1 << 20, None)):
        assert key(pick(X.read_export(spark, str(tmp_path), size, task))) == want
    assert len(want) > 50


def test_one_large_array_is_read_by_many_tasks(spark, tmp_path):
    n = 60_000
    (tmp_path / "big.json").write_text("[\n" + ",\n".join(json.dumps({"title": f't{i} "[{{\\', "price": i / 2, "description": "d" * (i % 300)}) for i in range(n)) + "\n]\n")
    members = A.read_members(spark, str(tmp_path), range_bytes=1 << 20)
    assert members.rdd.getNumPartitions() >= 8
    sizes = [r["count"] for r in members.selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()]
    assert sum(sizes) == n and max(sizes) < 2 * n / len(sizes)
    rows = X.read_export(spark, str(tmp_path), range_bytes=1 << 20)
    assert rows.selectExpr("count(*)", "count(DISTINCT position)", "max(position)", "sum(price)").first() == (n, n, n - 1, sum(i / 2 for i in range(n)))
    assert rows.filter("position = 777").first().title == 't777 "[{\\'
