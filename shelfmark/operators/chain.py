"""The chain of pages a run visits: from its start page along the link chosen on each page, until a page stops it, leads to a page that was not
fetched, or leads back.

A chain may be as long as a shop has pages, so it is not walked page by page.  Pointers are doubled: after k rounds every page knows the page
2^k steps on, and the pages within 2^k steps of the start are known, so a chain of a million pages takes twenty rounds.  Each round is a join on
(run, page), where the side that is looked up has one row per key; rounds are stored tables, and only a count of rows comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.sources.work import remove, saved, work_path

RUN = ["run_id", "source"]


def follow(edges: DataFrame, starts: DataFrame, run: list[str] = RUN) -> DataFrame:
    """(run, node, step): the nodes that edges (run, node, next) lead to from each run's start (run, node), each at its first step.

    A node has one edge at most.  Returns a stored table.
    """
    spark = edges.sparkSession
    root, made = work_path(spark, "chain"), []

    def stored(df: DataFrame, name: str) -> DataFrame:
        made.append(f"{root}/{name}")
        return saved(df, made[-1])

    jump = stored(edges.filter("next IS NOT NULL").select(*run, "node", "next"), "jump-0")
    seen = stored(starts.select(*run, "node", F.lit(0).cast("long").alias("step")), "seen-0")
    size, k = seen.count(), 0
    while True:
        onward = seen.join(jump, [*run, "node"]).select(*run, F.col("next").alias("node"), (F.col("step") + (1 << k)).alias("step"))
        wider = stored(seen.unionByName(onward).groupBy(*run, "node").agg(F.min("step").alias("step")), f"seen-{k + 1}")
        now = wider.count()
        if now == size:  # nothing new within twice the steps: every chain has ended or led back
            break
        far = jump.select(*run, F.col("node").alias("next"), F.col("next").alias("far"))
        jump = stored(jump.join(far, [*run, "next"]).select(*run, "node", F.col("far").alias("next")), f"jump-{k + 1}")
        seen, size, k = wider, now, k + 1
        for old in made[:-2]:
            remove(spark, old)
        del made[:-2]
    for old in made[:-1]:
        remove(spark, old)
    return wider


def page_chain(decisions: DataFrame) -> DataFrame:
    """(run, step, seq, url, stop_reason): the pages of each run's chain in order; the last one says why the chain ends there.

    ``decisions`` has a row per listing page, as ``links.next_page`` gives them.  Of pages fetched twice the first counts.
    """
    spark = decisions.sparkSession
    chosen = decisions.groupBy(*RUN, "url").agg(F.min_by(F.struct("seq", "next_url", "stop_reason"), "seq").alias("p")).select(
        *RUN, "url", F.col("p.seq").alias("node"), F.when(F.col("p.stop_reason").isNull(), F.col("p.next_url")).alias("next_url"), "p.stop_reason")
    pages = saved(chosen, work_path(spark, "chain-pages"))
    fetched = pages.select(*RUN, F.col("url").alias("next_url"), F.col("node").alias("next"))
    edges = saved(pages.join(fetched, [*RUN, "next_url"], "left"), work_path(spark, "chain-edges"))
    seen = follow(edges, edges.groupBy(*RUN).agg(F.min("node").alias("node")))
    last = seen.groupBy(*RUN).agg(F.max("step").alias("step")).withColumn("last", F.lit(True))
    ends = F.coalesce("stop_reason", F.when(F.col("next").isNull(), "not_fetched").otherwise("cycle"))
    return (seen.join(edges, [*RUN, "node"]).join(last, [*RUN, "step"], "left")
            .select(*RUN, "step", F.col("node").alias("seq"), "url", F.when(F.col("last"), ends).alias("stop_reason")))


def chain_summary(chain: DataFrame) -> DataFrame:
    """One row per run: its first and last page, how many pages the chain has, and why it ends."""
    return chain.groupBy(*RUN).agg(F.min_by("url", "step").alias("start_url"), F.max_by("url", "step").alias("last_url"), F.count("*").alias("pages"),
                                   F.max("stop_reason").alias("stop_reason"))
