"""Page chains against a walk, and first arrivals of a stream against a batch."""

import datetime as dt
import random

from pyspark.sql import functions as F

from shelfmark.operators import chain as C
from shelfmark.operators import quality as Q
from shelfmark.streaming import ingest

DECISION = "run_id string, source string, seq long, url string, next_url string, stop_reason string"


def walked(rows):
    """(run, source) -> [(step, seq, url, reason)] page by page."""
    runs = {}
    for run, source, seq, url, to, stop in rows:
        pages = runs.setdefault((run, source), {})
        if url not in pages or seq < pages[url][0]:
            pages[url] = (seq, to, stop)
    out = {}
    for key, pages in runs.items():
        url, seen = min(pages, key=lambda u: pages[u][0]), []
        while True:
            seq, to, stop = pages[url]
            seen.append((seq, url))
            reason = stop or ("not_fetched" if to not in pages else "cycle" if to in {u for _, u in seen} else None)
            if reason:
                break
            url = to
        out[key] = [(i, s, u, reason if i == len(seen) - 1 else None) for i, (s, u) in enumerate(seen)]
    return out


def test_chains_equal_a_walk(spark):
    r = random.Random(3)
    rows = []
    for run in range(40):
        n = r.choice([1, 2, 3, 10, 60])
        for seq in range(n):
            kind = r.random()
            to = None if kind < 0.05 else f"u{r.randrange(n)}" if kind < 0.25 else f"u{seq + 1}"
            rows.append((f"r{run % 30}", f"s{run // 30}", seq + 5, f"u{seq}", to, "no_next_link" if to is None else "no_products" if kind > 0.98 else None))
    rows += [("long", "s", k, f"u{k}", f"u{k + 1}", None) for k in range(700)] + [("self", "s", 1, "u1", "u1", None), ("twice", "s", 1, "a", "b", None), ("twice", "s", 2, "b", None, "not_found"),
             ("twice", "s", 3, "b", "c", None), ("twice", "s", 4, "a", "c", None)]
    chain = C.page_chain(spark.createDataFrame(rows, DECISION).repartition(5))
    got = {}
    for x in chain.orderBy("step").collect():
        got.setdefault((x.run_id, x.source), []).append((x.step, x.seq, x.url, x.stop_reason))
    want = walked(rows)
    assert got == want and len(got["long", "s"]) == 700 and got["self", "s"] == [(0, 1, "u1", "cycle")]
    told = {(x.run_id, x.source): (x.start_url, x.last_url, x.pages, x.stop_reason) for x in C.chain_summary(chain).collect()}
    assert told == {k: (v[0][2], v[-1][2], len(v), v[-1][3]) for k, v in want.items()}
    assert C.page_chain(spark.createDataFrame([], DECISION)).count() == 0


# ---- first arrivals -----------------------------------------------------------------------------

ROW = "run_id string, source string, url string, seq long, ord int, fetched_at timestamp, tags array<string>, info map<string,string>"
DAY = lambda n: dt.datetime(2025, 1, 1) + dt.timedelta(days=n)


def stream(spark, folder, parts, delay=None):
    """The rows each part lets through, one run of the stream per part."""
    out = []
    for part in parts:
        spark.createDataFrame(part, ROW).repartition(3).write.mode("append").parquet(f"{folder}/in")
        firsts, without = ingest.dedupe_stream(spark.readStream.schema(ROW).parquet(f"{folder}/in"), delay)
        (firsts.unionByName(without).writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/check")
         .trigger(availableNow=True).start().awaitTermination())
        now = sorted(map(str, spark.read.schema(ROW).parquet(f"{folder}/out").collect()))
        out.append([x for x in now if x not in {y for earlier in out for y in earlier}])
    return out


def test_first_arrivals_equal_a_batch(spark, tmp_path):
    r = random.Random(6)
    rows = [("r", "s", r.choice([None, "", "a", "b", "c", "d"]), i, r.randrange(2), DAY(i % 9), ["x", str(i)], {"k": str(i)}) for i in range(90)]
    parts = [rows[:30][::-1], rows[30:60], rows[60:]]  # the lowest number of a lot arrives last
    got = [x for lot in stream(spark, tmp_path, parts) for x in lot]
    want = Q.dedupe_by_url(spark.createDataFrame(rows, ROW), order=("seq", "ord"))
    assert sorted(got) == sorted(map(str, want.collect()))


def test_state_is_forgotten_by_fetch_time(spark, tmp_path):
    row = lambda url, seq, day: ("r", "s", url, seq, 0, DAY(day), None, None)
    parts = [[row("a", 1, 0), row("b", 2, 0), row("b", 3, 8), row("z", 4, 8)],   # the watermark goes to day 3
             [row("a", 5, 9), row("z", 6, 30)],                                   # a is known, and seen anew; then day 25
             [row("a", 7, 31), row("b", 8, 31), row("z", 9, 31)]]                 # a and b are forgotten, z is not
    got = [[x.split("seq=")[1].split(",")[0] for x in lot] for lot in stream(spark, tmp_path, parts, "5 days")]
    assert [sorted(x) for x in got] == [["1", "2", "4"], [], ["7", "8"]]
    state = spark.read.format("statestore").option("stateVarName", "seen").load(f"{tmp_path}/check")
    held = {x.key.url: x.value["at"] for x in state.select("key", "value").collect()}
    # A last run without rows moves the watermark to day 26: nothing seen from day 30 on is gone.
    assert held.keys() == {"a", "b", "z"} and set(held.values()) == {int(spark.range(1).select(F.unix_millis(F.lit(DAY(31)))).first()[0])}


def test_timers_move_on_and_python_has_no_part_in_state(spark, tmp_path):
    row = lambda url, seq, day: ("r", "s", url, seq, 0, DAY(day), None, None)
    parts = [[row("a", 1, 0), row("z", 2, 8)],      # the watermark goes to day 3; a's timer stands at day 5
             [row("a", 3, 6), row("z", 4, 12)],     # to day 7: the timer finds a seen on day 6 and moves to day 11
             [row("a", 5, 10), row("z", 6, 17)],    # to day 12: it moves to day 15
             [row("a", 7, 14), row("z", 8, 30)],    # to day 25: a is forgotten
             [row("a", 9, 31), row("z", 10, 31)]]
    got = [[x.split("seq=")[1].split(",")[0] for x in lot] for lot in stream(spark, tmp_path, parts, "5 days")]
    assert [sorted(x) for x in got] == [["1", "2"], [], [], [], ["9"]]
    firsts, _ = ingest.dedupe_stream(spark.readStream.schema(ROW).parquet(f"{tmp_path}/in"), "5 days")
    plan = firsts._jdf.queryExecution().logical().toString()
    assert "TransformWithState" in plan and "PySpark" not in plan
