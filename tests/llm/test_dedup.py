import hashlib
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from shelfmark.llm import cover_sort, minhash, suffix_dedup
from shelfmark.llm.components import components
from shelfmark.llm.exact_dedup import OpenTable, exact_dedup
from shelfmark.llm.line_dedup import dedup_lines
from shelfmark.llm.minhash import least_matches, near_duplicates
from shelfmark.llm.suffix_dedup import remove_repeats

SCHEMA = "doc_id long, text string, kept string, component_id long, n_removed string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "own", -7, "own") for i, t in rows], SCHEMA).repartition(3)


# ---- exact ------------------------------------------------------------------------------------

@pytest.mark.parametrize("fit", [64 << 20, 100])  # the second spills over several levels
def test_exact_groups(spark, fit):
    r = random.Random(2)
    texts = [None, "", "a", "A", "é", "x" * 500] + [f"t{r.randint(0, 40)}" * 3 for _ in range(200)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a"), (None, None), (7, texts[7]), (7, texts[7])]
    got = exact_dedup(frame(spark, rows), fit_bytes=fit).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    want = sorted((str(i), str(max(groups[t or ""], key=lambda x: (x is not None, x or 0))), len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
    assert sorted((str(x.doc_id), str(x.keep_id), x.group_size, x.text_sha256) for x in got) == want
    assert Counter(x.text_sha256 for x in got if x.kept) == Counter({hashlib.sha256(t.encode()).hexdigest(): 1 for t in groups})
    assert exact_dedup(frame(spark, rows).limit(0)).count() == 0


def test_exact_levels_shrink(spark, monkeypatch):
    """Tables of 400 bytes: hundreds of buckets, but what a level leaves is a fraction of it."""
    from shelfmark.llm import exact_dedup as e

    tables = []
    monkeypatch.setattr(e, "written", lambda df, name, real=e.written: tables.append((name, real(df, name))) or tables[-1][1])
    monkeypatch.setattr(e, "delete", lambda df: None)
    rows = [(i, f"{i % 2000:05}" * (1 + i % 50)) for i in range(4000)]
    assert sum(x.kept for x in exact_dedup(frame(spark, rows), fit_bytes=400).collect()) == len({t for _, t in rows})
    total = sum(len(t) + 64 for t in {t for _, t in rows})
    spilt = [t.agg({"size": "sum"}).first()[0] for name, t in tables if name.startswith("exact-spill")]
    assert 1 <= len(spilt) <= 8 and spilt == sorted(spilt, reverse=True)
    assert sum(spilt) < total / 3


def test_equal_hashes_do_not_make_equal_texts():
    table = OpenTable()
    for text in (b"a", b"b"):
        e, slot = table.find(5, text)
        assert e < 0
        table.add(5, text, slot)
    assert table.find(5, b"b")[0] == 1 and table.find(5, b"c")[0] < 0


# ---- near -------------------------------------------------------------------------------------

def brute_near(rows, percent):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append(frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, s in enumerate(sets):
        for b in range(a):
            same = rows[a][0] is not None and rows[a][0] == rows[b][0] and s and sets[b]
            n = len(s & sets[b])
            if None not in (rows[a][0], rows[b][0]) and s and (same or n and 100 * n >= percent * (len(s) + len(sets[b]) - n)):
                root[find(a)] = find(b)
    least = defaultdict(list)
    for k in range(len(rows)):
        if rows[k][0] is not None:
            least[find(k)].append(rows[k][0])
    out = []
    for k, (i, _) in enumerate(rows):
        c = min(least[find(k)]) if i is not None else None
        out.append((i, len(sets[k]), c, i == c))
    return sorted(out, key=str)


def near_rows():
    r = random.Random(4)
    words = [f"w{k}" for k in range(400)]
    bases = [[r.choice(words) for _ in range(r.randint(30, 120))] for _ in range(8)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one two"), (4, "ONE two"), (5, "one two three"), (6, "ß one"), (None, "one two")]
    for k in range(150):
        w = list(r.choice(bases))
        for _ in range(r.randint(0, 6)):
            w[r.randrange(len(w))] = r.choice(words)
        rows.append((10 + k, " ".join(w)))
    return rows + [(20, rows[18][1]), (500, " ".join(bases[0] * 30))]


@pytest.mark.parametrize("percent", [85, 60])
def test_near_duplicates_are_brute_force(spark, percent, monkeypatch):
    import shelfmark.llm.minhash as m

    rows = near_rows() if percent == 85 else [(k, "a b c d e f g h i j" if k % 2 else "a b c d e f g h i k") for k in range(40)]
    monkeypatch.setattr(m, "BLOCK", 8)  # buckets are split into several blocks
    got = sorted(map(tuple, near_duplicates(frame(spark, rows), percent=percent).collect()), key=str)
    assert got == brute_near(rows, percent)


def test_near_duplicates_of_one_template(spark, monkeypatch):
    """A bucket's smallest document is linked with some members only; the others are linked with each other, or with none."""
    import shelfmark.llm.minhash as m

    r = random.Random(9)
    base = [f"b{k}" for k in range(100)]
    rows = []
    for k in range(90):
        w = list(base)
        for p in r.sample(range(100), k % 9):
            w[p] = f"x{r.randint(0, 3) if k % 2 else k}"
        rows.append((k, " ".join(w)))
    monkeypatch.setattr(m, "BLOCK", 16)
    tables = {}
    monkeypatch.setattr(m, "written", lambda df, name, real=m.written: tables.setdefault(name, real(df, name)))
    monkeypatch.setattr(m, "delete", lambda df: None)
    got = sorted(map(tuple, near_duplicates(frame(spark, rows), percent=85).collect()), key=str)
    assert got == brute_near(rows, 85)
    assert tables["minhash-hub-links"].count() > 10 and tables["minhash-open"].filter("free").count() > 10
    assert tables["minhash-block-pairs"].count() > 0


def test_near_duplicates_of_no_rows(spark):
    assert near_duplicates(frame(spark, [(1, "x")]).limit(0)).count() == 0


def test_pruning_bounds_grow_with_the_evidence():
    bounds = least_matches(0.85, 1e-9)
    assert [n for n, _ in bounds] == [64, 128, 192, 256] and all(m / n < 0.85 for n, m in bounds) and bounds[-1][1] / 256 > bounds[0][1] / 64


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(8, 30)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 100 for k in range(100, 141)} | {k: 7 for k in range(7, 30)}


def test_tables_of_no_more_use_are_gone_when_texts_are_joined(spark, monkeypatch):
    r = random.Random(4)
    base = [r.choice("abcdefgh") + str(r.randint(0, 999)) for _ in range(120)]
    rows = [(k, " ".join(base[:60 + k % 7] + [f"w{k // 7}"] * (k // 7))) for k in range(60)] + [(60, " ".join(base[:62])), (5, "another version of five words"), (None, "x y"), (61, None)]
    made, live = {}, {}
    written = minhash.written

    def spied(df, name, *more):
        if name in ("minhash-hub-links", "minhash-links"):
            live[name] = {x for x, path in made.items() if os.path.exists(path)}
        out = written(df, name, *more)
        made[name] = os.path.dirname(out.inputFiles()[0]).removeprefix("file:").replace("///", "/")
        return out

    monkeypatch.setattr(minhash, "written", spied)
    got = minhash.near_duplicates(frame(spark, rows)).collect()
    assert len(got) == len(rows) and len({x.component_id for x in got}) < len(rows)
    assert live["minhash-hub-links"] >= {"minhash-classes"} and "minhash-bands" not in live["minhash-hub-links"]
    for left in live.values():
        assert "minhash-signatures" not in left and "minhash-sets" in left
    assert not live["minhash-links"] & {"minhash-buckets", "minhash-hub-links", "minhash-open"}


def test_pairs_of_blocks_are_bits_and_versions_share_them():
    r = np.random.default_rng(3)
    sigs = [r.integers(0, 1 << 16, 256, dtype=np.uint16) for _ in range(3)]
    rows = [((9, 0, 1), k % 2, 100 + k, 100 + k, sigs[k // 2 % 3].astype("<u2").tobytes()) for k in range(8)]
    batch = pa.RecordBatch.from_pydict(dict(zip(minhash._OPEN.names, zip(*[(*key, block, doc, label, sig) for key, block, doc, label, sig in rows]), strict=True)), schema=minhash._OPEN)
    left = [x for out in minhash._block_pairs(85, 1e-9, False)(iter([batch])) for x in out.to_pylist()]
    assert max(len(x["partners"]) for x in left) == 1 and "sig" not in left[0]
    pairs = {(x["doc"], y["doc"]) for x in left for y in left if x["partners"][y["place"] // 8] >> (7 - y["place"] % 8) & 1}
    assert pairs == {(100 + a, 100 + b) for a in range(0, 8, 2) for b in range(1, 8, 2) if a // 2 % 3 == b // 2 % 3}
    texts = {100 + k: f"text {k // 2} of one two three four" for k in range(8)}
    given = [x | {"text": t} for x in left for t in ([texts[x["doc"]]] if x["doc"] != 107 else ["another version of that one text", texts[100]])]
    got = {(x["a"], x["b"]) for out in minhash._block_pairs(85, 1e-9, True)(iter([pa.RecordBatch.from_pylist(given)])) for x in out.to_pylist()}
    joined = {frozenset(x) for x in got}
    assert joined == {frozenset(x) for x in ((100, 101), (102, 103), (104, 105), (100, 107))}


# ---- repeated strings -------------------------------------------------------------------------

def test_suffix_order_bucket_by_bucket():
    r = random.Random(3)
    for trial in range(30):
        t = "".join(r.choice("ab" if trial % 2 else "abcdefgh ") for _ in range(r.randint(1, 300))) * (1 + 7 * (trial % 3 == 0))
        x, at = np.frombuffer(t.encode(), np.uint8), np.arange(max(0, len(t) - 49))
        order = np.concatenate([at[:0], *cover_sort.sorted_suffixes(x, at, 50, bucket=64)])
        windows = [t[p:p + 50] for p in order]
        assert sorted(order.tolist()) == at.tolist() and windows == sorted(windows)


def brute_repeats(rows, n=50):
    first, out = {}, []
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - n + 1 if i is not None else 0):
            first[b[p:p + n]] = min(i, first.get(b[p:p + n], i))
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - n + 1 if i is not None else 0):
            if first[b[p:p + n]] < i:
                gone[p:p + n] = b"\1" * n
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("many", [20_000, 0])  # the second compares every piece window by window
def test_repeats_are_brute_force(spark, many, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MANY", many)
    r = random.Random(6)
    base = "".join(r.choice("abcdeé ") for _ in range(300))
    rows = [(k, "".join(base[(a := r.randint(0, 250)):a + r.randint(0, 120)] if r.random() < 0.6 else "".join(r.choice("xyz ") for _ in range(30)) for _ in range(r.randint(0, 5)))) for k in range(120)]
    rows += [(None, base), (5, base), (5, base), (301, None), (302, ""), (303, "a" * 3000), (304, "a" * 2000), (305, base), (306, base)]
    got = remove_repeats(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == brute_repeats(rows)
    assert remove_repeats(frame(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("block", [2 << 20, 300])
def test_only_windows_that_may_repeat_are_put_in_order(block, monkeypatch):
    sorted_suffixes, ordered = suffix_dedup.sorted_suffixes, []
    monkeypatch.setattr(suffix_dedup, "sorted_suffixes", lambda text, at, *rest: [ordered.append(len(at)), *sorted_suffixes(text, at, *rest)][1:])
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", block)
    r = random.Random(8)
    rows = []
    for key in range(12):
        base = bytes(r.choices(range(97, 123), k=113))
        raw = [bytes(r.choices(range(97, 123), k=r.randint(50, 113))) for _ in range(6)] + [base, base[20:90] + b"q" * 10, b"z" + base[:60]]
        rows += [(key, k, r.randint(0, 5), x) for k, x in enumerate(raw)]
    names = ["key", "content", "doc", "bytes"]
    batches = [pa.RecordBatch.from_pydict(dict(zip(names, zip(*rows[k:k + 7]), strict=True))) for k in range(0, len(rows), 7)]
    got = [x for out in suffix_dedup._compared(50)(iter([batches[0].slice(0, 0), *batches])) for x in out.to_pylist()]
    least = {}
    for _, _, d, x in rows:
        for a in range(len(x) - 49):
            least[x[a:a + 50]] = min(d, least.get(x[a:a + 50], d))
    expected = {(k, c, a) for k, c, d, x in rows for a in range(len(x) - 49) if least[x[a:a + 50]] < d}
    assert expected and sorted((x["key"], x["content"], a) for x in got for a in range(x["a"], x["b"])) == sorted(expected)
    windows = [x[a:a + 50] for _, _, _, x in rows for a in range(len(x) - 49)]
    assert sum(ordered) == sum(windows.count(w) > 1 for w in windows) < len(windows) / 2


def test_contents_are_told_apart_by_place_and_size():
    text = b"abcdefghijklmnop" * 6 + b"ponmlkjihgfedcba" + b"abcdefghijklmnop" * 3 + b"a" * 200
    grams = suffix_dedup._grams(np.frombuffer(text, np.uint8))
    spans = [(a, n) for a in range(len(text) - 113) for n in range(16, 114)]
    hashes = suffix_dedup._contents(grams, *np.array(spans).T).tolist()
    by_text = {}
    for (a, n), h in zip(spans, hashes, strict=True):
        assert by_text.setdefault(text[a:a + n], h) == h
    assert len(set(by_text.values())) == len(by_text)


# ---- lines ------------------------------------------------------------------------------------

def brute_lines(rows):
    def near(a, b):
        a, b = sorted((a.split(" "), b.split(" ")), key=len)
        if len(a) < 8 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))

    first = {}
    split = [[x.strip(" ") for x in (t or "").split("\n")] for _, t in rows]
    place = lambda i, p: (i is None, i or 0, p)
    for (i, _), ls in zip(rows, split):
        for p, x in enumerate(ls):
            if x and len(x.split(" ")) >= 3:
                first[x] = min(first.get(x, (True, 1 << 62, 0)), place(i, p))
    out = []
    for (i, t), ls in zip(rows, split):
        raw = (t or "").split("\n")
        gone = {p for p, x in enumerate(ls) if x in first and (place(i, p) > first[x] or any(near(x, y) and first[y] < first[x] for y in first))}
        kept = [x for p, x in enumerate(raw) if p not in gone]
        text = t if not gone else "\n".join(kept) if any(x.strip(" ") for x in kept) else ""
        out.append((i, text, len(gone)))
    return sorted(out, key=str)


def test_lines_are_brute_force(spark):
    r = random.Random(8)
    words = [f"w{k}" for k in range(6)] + ["é", "🎉"]
    pool = [[r.choice(words) for _ in range(r.randint(1, 14))] for _ in range(12)]

    def line():
        w = list(r.choice(pool))
        k = r.randrange(len(w))
        edit = r.random()
        if edit < 0.25:
            w[k] = r.choice(words)
        elif edit < 0.4:
            del w[k]
        elif edit < 0.55:
            w.insert(k, r.choice(words))
        return r.choice(["", "", "  "]) + " ".join(w)

    rows = [(k, "\n".join(line() for _ in range(r.randint(0, 6)))) for k in range(60)] + [(100, None), (101, ""), (None, "\n".join(line() for _ in range(5))), (102, " \n\n"),
                                                                                        (103, " ".join(["long"] * 5000)), (104, " ".join(["long"] * 5001))]
    done = dedup_lines(frame(spark, rows), counts=("lines", "gone"))
    assert done.columns == ["doc_id", "text", "kept", "component_id", "n_removed", "lines", "gone"]
    assert sorted(((x.doc_id, x.text, x.gone) for x in done.collect()), key=str) == brute_lines(rows)
    assert dedup_lines(frame(spark, rows).limit(0)).count() == 0


def test_equal_rows_of_one_doc_id_both_keep_their_lines(spark):
    text = "one two three four"
    assert [x.text for x in dedup_lines(frame(spark, [(1, text), (1, text)])).collect()] == [text, text]


def test_built_words_are_not_taken_for_equal(spark):
    word = lambda x: "".join(x[bin(i).count("1") % 2] for i in range(1024))
    docs = spark.createDataFrame([(1, word("ab")), (2, word("ba")), (3, word("ab") + " a b c d"), (4, word("ba") + " a b c d")], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_duplicates(docs).collect()} == {1: 1, 2: 2, 3: 3, 4: 4}


def test_lines_of_tables_with_any_columns(spark):
    rows = [(1, "the same line here\nown words", "a", 1, 2, 3), (2, "the same line here\nother words", "b", 4, 5, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __id string, line_doc int, line_group_ int, line_places int")
    done = dedup_lines(docs)
    assert done.columns[:6] == docs.columns and sorted(tuple(r)[:6] for r in done.collect()) == [rows[0], (2, "other words", "b", 4, 5, 6)]
    assert dedup_lines(docs.limit(0)).count() == 0
