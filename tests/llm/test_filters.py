import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from shelfmark.llm import gru
from shelfmark.llm import toxicity as T
from shelfmark.llm.decontaminate import digest, leaks, remove_leaks
from shelfmark.llm.secret_scan import RULES, Rule, scan
from shelfmark.llm.secret_scan import digest as secret_digest

# ---- secrets ----------------------------------------------------------------------------------

PATTERNS = [("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), 2, 12), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18),
            ("hex", re.compile("[0-9a-f]+"), 0, 16)]


def brute_secrets(text):
    found = sorted((x.start(), k, name, x.end()) for k, (name, p, g, least) in enumerate(PATTERNS) for x in p.finditer(text or "") if len(x.group(g)) >= least)
    spans = ",".join(f"{name}:{a}:{b}" for a, _, name, b in found)
    return tuple(sum(x[1] == k for x in found) for k in range(3)) + (hashlib.sha256(spans.encode()).hexdigest(), spans)


def secret_rows():
    r = random.Random(2)
    parts = ["password", "Passwd", "TOKEN", "api_key", "apikey", " = ", ":", "=", "'", '"', "secret", "abcdefghijkl", "AKIA", "AKIAABCDEFGHIJKLMN", "0123456789abcdef", "é🎉", " ", "\n", "XYZ9"]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randint(0, 25)))) for i in range(400)]
    return rows + [(1000, None), (1001, ""), (None, "token=abcdefghijklmnop"), (1002, "token=abcdefghijklmnop"), (1002, "token=abcdefghijklmnop"), (1003, "f" * 100_000)]


def test_secrets_are_brute_force(spark, tmp_path):
    rows = secret_rows()
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, blob string").repartition(3)
    ledger = f"file://{tmp_path}/ledger"
    got = secret_digest(scan(docs, ledger)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(i, *brute_secrets(t)) for i, t in rows], key=str)
    n = spark.read.parquet(ledger).count()
    scan(docs, ledger)
    assert spark.read.parquet(ledger).count() == n  # nothing unseen


def test_secrets_of_a_text_full_of_them(spark, tmp_path):
    text = "".join(f"token={k:012} " if k % 3 else f"{k:020x}\n" for k in range(30_000))
    got = secret_digest(scan(spark.createDataFrame([(1, text), (2, None), (1, text)], "doc_id long, text string"), f"file://{tmp_path}/ledger")).collect()
    assert sorted(map(tuple, got)) == sorted([(1, *brute_secrets(text)), (2, *brute_secrets("")), (1, *brute_secrets(text))])


def test_only_unseen_blobs_and_rule_versions_are_scanned(spark, tmp_path):
    ledger = f"file://{tmp_path}/ledger"
    v1 = spark.createDataFrame([("a", 1, "token=abcdefghijklmnop"), ("b", 1, "clean")], "file string, version int, text string")
    both = v1.union(spark.createDataFrame([("a", 2, "clean"), ("c", 1, "0123456789abcdef")], v1.schema))
    named = lambda df: df.selectExpr("struct(file, version) AS path", "text")
    scan(named(v1), ledger, path="path")
    first = spark.read.parquet(ledger).count()
    found = scan(named(both), ledger, path="path")
    assert spark.read.parquet(ledger).count() == first + len(RULES)  # one new blob
    assert {(r.path.file, r.path.version): [f.rule for f in r.findings] for r in found.collect()} == {("a", 1): ["assign"], ("b", 1): [], ("a", 2): [], ("c", 1): ["hex"]}
    newer = (*RULES[:2], Rule("hex", 2, r"[0-9a-f]{32,}", 0, 32))
    again = scan(named(both), ledger, path="path", rules=newer)
    assert spark.read.parquet(ledger).count() == first + len(RULES) + 3  # three blobs, one rule
    assert all("hex" not in [f.rule for f in r.findings] for r in again.collect())
    assert scan(named(v1).limit(0), ledger + "2", path="path").count() == 0


# ---- benchmark windows ------------------------------------------------------------------------

def brute_leaks(rows, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for item, t in items:
        w = words(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            if item is not None:
                windows.setdefault(tuple(w[k:k + n]), set()).add(str(item))
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def leak_data(spark):
    r = random.Random(9)
    vocab = ["Alpha", "beta", "é", "3", "d-e", "zz", "日本"]
    items = [(k, " ".join(r.choice(vocab) for _ in range(r.choice([3, 9, 10, 14])))) for k in range(12)] + [(50, None), (51, ""), (52, "!!"), (None, "beta beta beta"), (3, "one more text of item three")]
    rows = [(k, " ".join(r.choice([*vocab, items[r.randrange(12)][1]]) for _ in range(r.randint(0, 12)))) for k in range(120)]
    rows += [(200, None), (201, ""), (None, items[0][1]), (202, items[3][1]), (202, items[3][1]), (203, "x " * 30_000 + items[0][1])]
    return rows, items, spark.createDataFrame([(i, t, "own") for i, t in rows], "doc_id long, text string, items string").repartition(3), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("most", [1 << 25, 0])  # the second joins instead of broadcasting
def test_leaks_are_brute_force(spark, most):
    rows, items, docs, benchmark = leak_data(spark)
    got = digest(leaks(docs, benchmark, most_bytes=most)).collect()
    assert sorted(map(tuple, got), key=str) == brute_leaks(rows, items)
    assert leaks(docs.limit(0), benchmark, most_bytes=most).count() == 0
    assert {r.n_hit for r in leaks(docs, benchmark.limit(0), most_bytes=most).collect()} == {0}


@pytest.mark.parametrize("most", [1 << 25, 0])
def test_leaks_of_tables_with_any_columns(spark, most):
    item = "one two three four five six seven eight nine ten"
    rows = [(1, "a " + item + " b", 1, 2, 3, 4), (2, "clean", 5, 6, 7, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, d int, g int, hit_doc int, hit_places_ int")
    done = remove_leaks(docs, spark.createDataFrame([(1, item)], "item_id long, text string"), most_bytes=most)
    assert done.columns == docs.columns and sorted(map(tuple, done.collect())) == [(1, "a  b", 1, 2, 3, 4), rows[1]]


@pytest.mark.parametrize("most", [1 << 25, 0])
def test_leaks_are_cut_out_and_clean_rows_stay(spark, most):
    item = "one two three four five six seven eight nine ten eleven"
    rows = [(1, f"Before, {item.upper()}! after."), (2, "clean text"), (3, item), (4, None), (5, ""), (None, "no id " + item), (6, "one two three")]
    docs = spark.createDataFrame([(i, t, "own") for i, t in rows], "doc_id long, text string, items string")
    done = remove_leaks(docs, spark.createDataFrame([(1, item)], "item_id long, text string"), most_bytes=most)
    assert done.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in done.collect()), key=str) == sorted([(1, "Before, ! after."), (2, "clean text"), (4, None), (5, ""), (None, "no id "), (6, "one two three")], key=str)


# ---- toxicity ---------------------------------------------------------------------------------

def toxic_rows(n, seed=1):
    r = random.Random(seed)
    syllables = ["th", "on", "er", "an", "ti", "sh", "ou", "ble"]
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 3)))
    out = []
    for i in range(n):
        w = [word() for _ in range(r.choice([5, 60, 200]))]
        toxic = r.random() < 0.3
        for _ in range(4 if toxic else 0):
            w.insert(r.randrange(len(w)), r.choice(["scumbag", "idiotic", "vilest" + word()]))
        out.append((i, " ".join(w), int(toxic)))
    return out


def test_backward_is_the_slope_of_forward():
    p = {k: v.astype(np.float64) for k, v in gru.initial(3).items()}
    r = np.random.default_rng(0)
    words = r.normal(size=(9, gru.WORD_DIM + 2 * gru.CHAR_DIM))
    index, inside = r.integers(0, 9, (5, 3)), np.arange(5)[:, None] < np.array([5, 3, 1])
    weight = r.normal(size=3)
    loss = lambda: float(gru.forward(p, words, index, inside)[0] @ weight)
    _, kept = gru.forward(p, words, index, inside, keep=True)
    g, dwords = gru.backward(p, words, index, inside, kept, weight)
    for name in ("out", "attend", "query", "in_f", "rec_f", "in_b", "rec_b", "shift_b"):
        at = tuple(r.integers(0, n) for n in p[name].shape)
        before = p[name][at]
        p[name][at] = before + 1e-3
        up = loss()
        p[name][at] = before - 1e-3
        down = loss()
        p[name][at] = before
        assert abs((up - down) / 2e-3 - g[name][at]) < 1e-3, name
    w = words[2, 5]
    words[2, 5] = w + 1e-3
    up = loss()
    words[2, 5] = w - 1e-3
    assert abs((up - loss()) / 2e-3 - dwords[2, 5]) < 1e-3


@pytest.fixture(scope="module")
def model():
    return T.fit([(t, y) for _, t, y in toxic_rows(300)], epochs=6)


def test_held_out_accuracy(model):
    rows = toxic_rows(200, seed=2)
    s = T._scores(model, pa.array([t for _, t, _ in rows]))
    assert np.mean((s >= T.THRESHOLD) == np.array([y for *_, y in rows])) > 0.9


def test_windows_cover_every_word():
    for n in (1, 63, 64, 65, 96, 97, 500):
        t = T.Texts(*((x := np.frombuffer(b" ".join([b"a"] * n), np.uint8)), np.array([0, len(x)]))[:2])
        first, size, _ = t.windows()
        assert set(range(n)) == {k for f, s in zip(first, size) for k in range(f, f + s)} and size.max() <= T.WINDOW and (size > 0).all()


def test_scores_of_any_row(spark, model):
    long = "word " * 20_000 + "scumbag idiotic scumbag idiotic"
    rows = [(1, None), (2, ""), (3, "!!"), (4, "scumbag idiotic scumbag"), (None, "th on er"), (4, "scumbag idiotic scumbag"), (5, long), (6, "é 日本")]
    docs = spark.createDataFrame([(i, t, "own") for i, t in rows], "doc_id long, text string, score string").repartition(2)
    got = T.scores(docs, model).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert by[1].score == by[2].score == by[3].score == 0 and by[4].predicted == 1 and by[5].predicted == 1
    assert by[4].held_out == T.held_out(4)
    kept = T.drop_toxic(docs, model)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if not r.predicted)
    assert T.scores(docs.limit(0), model).count() == 0


def test_training_leaves_the_held_out_fold_and_odd_labels_alone(spark):
    rows = toxic_rows(80)
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None), (999, 1)], "doc_id long, toxic int")
    seen = []
    keep, T.fit = T.fit, lambda r, *a: seen.append(r) or keep(r[:20], *a, epochs=1, least_steps=1)
    try:
        T.train(docs, labels, most_docs=40)
        T.train(docs, labels.limit(0))
    finally:
        T.fit = keep
    texts = {t for i, t, _ in rows if T.held_out(i)}
    assert 0 < len(seen[0]) <= 40 and not texts & {t for t, _ in seen[0]} and seen[1] == []
