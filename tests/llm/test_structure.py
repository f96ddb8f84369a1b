import hashlib
import html as H
import random
import re
import zlib
from itertools import product

import pytest

from shelfmark.llm import repair as R
from shelfmark.llm.main_text import main_text, text_of, tree, weigh
from shelfmark.llm.periodic import digest, periodic_runs, with_planted_runs

# ---- periodic runs ----------------------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w, least=24, times=3):
    found = set()
    for p in range(1, len(w) // times + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            length = j - i + p
            if length >= max(least, times * p):
                if not any(all(w[x] == w[x + q] for x in range(i, i + length - q)) for q in range(1, p)):
                    found.add((i, length, p))
            i = j + 1 if j == i else j
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted_words(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(w), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def brute_digest(doc_id, text):
    w = planted_words(doc_id, text)
    runs = brute_runs(w)
    gone = {x for s, n, p in runs for x in range(s + p, s + n)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    best = None
    for s, n, p in runs:
        if best is None or n * best[2] > best[1] * p:
            best = (s, n, p)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{n},{p}\n" for s, n, p in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def run_rows():
    r = random.Random(5)
    rows = []
    for i in range(150):
        kind = i % 5
        if kind == 0:
            w = [r.choice("ab") for _ in range(r.randint(0, 120))]
        elif kind == 1:
            w = [r.choice("abcdefgh") for _ in range(r.randint(0, 80))]
        elif kind == 2:
            unit = [r.choice(["x", "yy", "é", "zzz"]) for _ in range(r.randint(1, 15))]
            w = [f"n{k}" for k in range(r.randint(0, 9))] + unit * r.randint(2, 9) + unit[:r.randint(0, len(unit))] + [f"m{k}" for k in range(r.randint(0, 9))]
        elif kind == 3:  # runs that touch, and a run within a longer one's period
            inner = ["a"] * r.randint(20, 40) + ["b"]
            w = inner * r.randint(1, 5) + ["c", "d"] * r.randint(5, 20)
        else:
            w = ["a", "b"]
            for _ in range(r.randint(3, 8)):
                w = [y for x in w for y in (["a", "b"] if x == "a" else ["a"])]
        seps = [" ", "\n", "\t", "  ", " \r\n "]
        rows.append((i, "".join(x + r.choice(seps) for x in w)))
    long = " ".join(f"w{k % 7}" for k in range(30_000)) + " end " + " ".join(f"v{k % 5000}" for k in range(16_000))
    return rows + [(1000, None), (1001, ""), (1002, " \n "), (None, "a " * 40), (1003, "a " * 24), (1003, "a " * 24), (1004, "a " * 23), (1005, "  b" * 30)], (2000, long)


def test_runs_are_brute_force(spark):
    rows, long = run_rows()
    docs = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, runs string").repartition(3)
    got = digest(periodic_runs(with_planted_runs(docs))).collect()
    assert sorted(map(tuple, got), key=str) == sorted((brute_digest(i, t) for i, t in rows), key=str)
    found = periodic_runs(spark.createDataFrame([long], "doc_id long, text string")).first()
    assert [tuple(r) for r in found.runs] == [(0, 30_000, 7), (30_001, 16_000, 5000)]
    assert found.collapsed == " ".join([f"w{k}" for k in range(7)] + ["end"] + [f"v{k}" for k in range(5000)])
    assert periodic_runs(docs.limit(0)).count() == 0


def test_other_bounds_of_runs(spark):
    r = random.Random(8)
    rows = [(i, " ".join(r.choice("ab") for _ in range(60))) for i in range(40)]
    got = periodic_runs(spark.createDataFrame(rows, "doc_id long, text string"), least=6, times=4).collect()
    assert {g.doc_id: [tuple(x) for x in g.runs] for g in got} == {i: brute_runs(t.split(), 6, 4) for i, t in rows}
    with pytest.raises(ValueError):
        from shelfmark.llm.periodic import runs_of
        import numpy as np
        runs_of(np.zeros(3, np.int64), np.array([0, 3]), times=2)


# ---- main text --------------------------------------------------------------------------------

PROSE = "The quick story goes on for a while, sentence after sentence, so that its density is high. "

PAGES = [
    ("<!DOCTYPE html><html><head><title>T</title><script>var t='</p>';</script></head><body><nav><a href=/>Home</a></nav><div class=\"ad\">Buy</div>"
     "<article><h1>Head</h1><p><b>One &amp; two<br><p>Three\n  four</p><p>A.</p></article><footer>&copy; me</footer></body></html>", "Head One & two Three four A."),
    # no article element: the densest subtree
    (f"<body><div id=top><a href=1>one</a> <a href=2>two</a> <a href=3>three</a></div><div><h2>Title of it</h2><p>{PROSE}</p><p>{PROSE}{PROSE}</p><p>Short.</p></div>"
     "<div><ul><li><a href=4>x y</a><li><a href=5>z z</a></ul></div></body>", f"Title of it {PROSE}{PROSE}{PROSE}Short."),
    # what stands inside an article but is none of it
    (f"<main><article><header><h1>H</h1></header><p>{PROSE}</p><aside>Note</aside><div class='newsletter-box'>Sign up</div><form><p>Name</p></form><p>End.</p>"
     f"<section id=\"comments\"><p>{PROSE}</p></section></article><div>Other</div></main>", f"H {PROSE}End."),
    # inline elements do not part words; blocks, cells and line breaks do
    ("<article>a<b>b</b>c <i>d</i>e<div>f</div>g<table><tr><td>h<td>i</table><ul><li>j<li>k</ul></article>", "abc de f g h i j k"),
    ("plain text without a tag &lt;b&gt; &#233;&eacute; &amp", "plain text without a tag <b> éé &"),
    ("<p>unclosed <b>bold <p>next<!-- never closed <p>x", "unclosed bold next"),
    ("<article><p>x</p><script>if (a < b) { '<p>no</p>' }</article>", "x"),
    ("<article hidden><p>no</p></article><p>yes</p>", "yes"),
    ("a < b and <3 <a\"b>c</a>", None),
    ("<nav><p>only a menu</p></nav>", ""), ("<html><head><title>t</title></head><body></body></html>", ""), ("   ", ""), ("", ""), (None, ""),
    ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", "deep"),
    ("<article>" + f"<p>{PROSE}</p>" * 4000 + "</article>", " ".join([PROSE.strip()] * 4000)),
]


def test_pages_give_their_article(spark):
    rows = [(i, f"u{i}", p, "z") for i, (p, _) in enumerate(PAGES)] + [(0, "u0", PAGES[0][0], "z"), (None, None, "<p>t</p>", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(3)
    got = main_text(pages).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    for r in got:
        if r.page_id is not None and PAGES[r.page_id][1] is not None:
            assert r.text == PAGES[r.page_id][1], r.page_id
    assert sum(r.page_id == 0 for r in got) == 2 and [r.text for r in got if r.page_id is None] == ["t"]
    assert main_text(pages.limit(0)).count() == 0


def test_rendered_articles_come_back():
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdéü&<\"") for _ in range(r.randint(1, 9)))
    for _ in range(200):
        blocks = [" ".join(word() for _ in range(r.randint(1, 60))) for _ in range(r.randint(1, 8))]
        body = "".join(f"<p>{H.escape(b)}" + r.choice(["</p>", "", "<br>"]) for b in blocks)
        page = (f"<html><head><title>{H.escape(word())}</title></head><body><nav><ul><li><a href=/>{H.escape(word())}</a></ul></nav><div class=ad>{H.escape(word())}</div>"
                f"<article>{body}</article><footer>{H.escape(PROSE)}</footer>")
        assert text_of(page) == " ".join(blocks)


def test_densities_of_a_page():
    order = weigh(tree("<div><p>aaaa</p><p>bb<a href=x>cc</a></p></div>"))
    got = {n.tag: (n.chars, n.tags, n.link_chars, n.link_tags) for n in order}
    assert got == {"body": (8, 4, 2, 1), "div": (8, 3, 2, 1), "p": (4, 1, 2, 1), "a": (2, 0, 2, 0)}
    plain, linked = [n.density for n in order if n.tag == "p"]
    assert plain > linked > 0 and [n.density for n in order if n.tag == "a"] == [0.0]


# ---- conversations ----------------------------------------------------------------------------


def dynamic_program(kinds):
    """Least (cost, audit) by states, row by row."""
    def closed(best):
        while True:
            new = dict(best)
            for (p, x), q in R.STEP.items():
                if x in "ua" and p in best:
                    c = (best[p][0] + 5, best[p][1] + "I")
                    if q not in new or c < new[q]:
                        new[q] = c
            if new == best:
                return best
            best = new

    best = closed({0: (0, "")})
    for kind in kinds:
        initial, fault = kind[:-1], kind[-1]
        new = {}
        for p, (c, a) in best.items():
            for edit, x, cost in [("D", None, 2)] + ([] if fault == "x" else [("K", initial, 0), ("R", "u", 1), ("R", "a", 1)]):
                q = p if x is None else R.STEP.get((p, x))
                if q is not None:
                    v = (c + cost + (5 if fault == "t" and edit != "D" else 0), a + edit)
                    if q not in new or v < new[q]:
                        new[q] = v
        best = closed(new)
    return min(best[q] for q in (0, 3) if q in best)


def spanned(kinds):
    chart = R.Chart()
    for k in kinds:
        chart.add(k)
    return R.cheapest(chart.cell())


def test_spans_are_the_dynamic_program():
    for n in range(5):
        for kinds in product(["s-", "u-", "a-", "ux", "at", " -", "st"], repeat=n):
            assert spanned(kinds) == dynamic_program(kinds), kinds
    r = random.Random(1)
    for _ in range(60):
        kinds = [r.choice("sua ") + r.choice("---xt") for _ in range(r.randint(5, 90))]
        assert spanned(kinds) == dynamic_program(kinds)


def test_every_split_gives_the_same_cell():
    r = random.Random(4)
    for _ in range(20):
        kinds = [r.choice("sua") + r.choice("--xt") for _ in range(7)]
        cells = {(i, i + 1): R.leaf(k) for i, k in enumerate(kinds)}
        for size in range(2, 8):
            for i in range(8 - size):
                splits = [R.join(cells[i, k], cells[k, i + size]) for k in range(i + 1, i + size)]
                assert all(s == splits[0] for s in splits)
                cells[i, i + size] = splits[0]


def brute_conversation(conv_id, rows):
    """rows: (turn, role, text) of the undamaged table."""
    out = []
    for turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        how = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        if how == 0:
            continue
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        out += [(turn, "user" if how == 4 else role, text)] * (2 if how == 3 else 1)
    out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:32], hashlib.sha256(r[2].encode()).hexdigest()))
    seen, kinds, counts = set(), [], {"x": 0, "d": 0, "t": 0}
    for _, role, text in out:
        held = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "x" if not held else "d" if (role, text) in seen else "t" if held[-1] not in ".!?" else "-"
        seen.add((role, text))
        counts[fault] = counts.get(fault, 0) + 1
        kinds.append(role[:1] + ("x" if fault == "d" else fault))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(out, out[1:]))
    turns = [t for t, *_ in out if t is not None]
    cost, audit = dynamic_program(kinds)
    lines, state, rest = [], 0, iter(out)
    for edit in audit:
        _, role, text = next(rest) if edit != "I" else (None, None, "")
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if state == 2 else "user"
        state = R.STEP[state, role[:1]]
        lines.append(f"{role}:{text}")
    return (conv_id, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, counts["x"], counts["d"], counts["t"], illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def conversation_rows():
    r = random.Random(9)
    texts = ["Yes.", "No!", "Why?", "cut off", "", "  ", "Yes. ", "a\nb.", "x.\x0b", "é…", "é…!", None]
    rows = [(c, t, r.choice(["user", "assistant", "system", "tool", "", None, "assistant", "user"]), r.choice(texts))
            for c in range(120) for t in r.sample(range(12), r.randint(1, 9))]
    rows += [(None, t, "user", "Hm.") for t in (1, 2, None)] + [(500, None, "user", "A."), (500, None, "assistant", "B."), (501, 3, None, None)]
    rows += [(502, k, "user" if k % 2 == 0 else "assistant", f"line {k % 500}.") for k in range(2500)]  # one conversation with most rows
    rows += [(503, 1, "user", "same.")] * 3
    return rows


def test_repairs_are_brute_force(spark):
    rows = conversation_rows()
    talk = spark.createDataFrame([(*x, "z") for x in rows], "conv_id long, turn long, role string, text string, audit string").repartition(5)
    groups = {}
    for c, *rest in rows:
        groups.setdefault(c, []).append(rest)
    want = sorted((brute_conversation(c, g) for c, g in groups.items()), key=str)
    got = [tuple(r) for r in R.digest(R.damaged(talk), every=talk).collect()]
    assert sorted(got, key=str) == want
    assert R.digest(R.damaged(talk.limit(0)), every=talk.limit(0)).count() == 0


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Again?"), (1, 2, "assistant", "cut"), (2, 0, "assistant", "Well."), (3, 0, "system", "S."), (4, 0, "user", "")]
    got = R.repaired(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("conv_id", "place").collect()
    # 1: the second user row answers the first, the cut row goes; 2 and 3: cheaper deleted than completed.
    assert [(r.conv_id, r.place, r.edit, r.role, r.text) for r in got] == [(1, 0, "K", "user", "Hi."), (1, 1, "R", "assistant", "Again?")]
