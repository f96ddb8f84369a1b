"""Secret scans with an incremental blob ledger, in DataFrame operations only.

Every version of every path is content-addressed.  The ledger holds one row for each (blob, rule, rule version) that has been scanned, with the
spans found, also when there are none.  A run scans only the pairs that the ledger lacks, each blob once however many paths hold it, appends
them, and joins the findings back to all paths.

A null text is an empty one; empty texts hold nothing.  Paths may be null or repeat; each row of the input is one row of the result.  An empty
table gives an empty result and an empty ledger.  Further columns are left out.  Spans are in code points, end exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEDGER = "blob string, rule string, rule_version int, spans array<struct<start: int, end: int>>"


@dataclass(frozen=True)
class Rule:
    """A pattern, the group whose length counts, and cheap substrings of the lower-cased text one of which every match holds."""
    name: str
    version: int
    pattern: str
    group: int
    at_least: int
    hints: tuple[str, ...] = ()


# The base rules, in the order in which findings at the same place are listed.  Runs that are too short never hide a longer one
# in the last two, so their least length stands in the pattern.
RULES = (
    Rule("assign", 1, r"""((?i)password|passwd|secret|token|api_?key(?-i))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12,
         ("password", "passwd", "secret", "token", "apikey", "api_key")),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}", 0, 18, ("akia",)),
    Rule("hex", 1, r"[0-9a-f]{16,}", 0, 16),
)


def _parts(rule: Rule, text: Column) -> Column:
    """All leftmost non-overlapping matches in order: characters between the one before and it, its own, and whether it is long enough."""
    gaps, found = F.split(text, rule.pattern, -1), F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    parts = F.zip_with(F.zip_with(gaps, found, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("size"))), value,
                       lambda p, v: F.struct(p["gap"].alias("gap"), p["size"].alias("size"), (F.length(v) >= rule.at_least).alias("counts")))
    parts = F.filter(parts, lambda p: p["size"].isNotNull())  # the text behind the last match has none
    held = F.lit(False)
    for hint in rule.hints:
        held = held | F.contains(F.lower(text), F.lit(hint))
    return F.when(held if rule.hints else text.rlike(rule.pattern), parts).otherwise(F.array().cast("array<struct<gap: int, size: int, counts: boolean>>"))


def _placed(found: DataFrame) -> DataFrame:
    """Spans from the parts of each (blob, rule, version): a running sum over the parts as rows, so that a text takes time in step with its
    findings.  One shuffle of numbers; pairs without a match stay as rows without spans."""
    pair = ["blob", "rule", "rule_version"]
    rows = found.select(*pair, F.posexplode_outer("parts").alias("place", "part")).select(*pair, "place", "part.*")
    # Rows that repeat a path were scanned alike: one of each place is left.
    rows = rows.repartition(*pair).groupBy(*pair, "place").agg(F.min("gap").alias("gap"), F.min("size").alias("size"), F.min("counts").alias("counts"))
    upto = Window.partitionBy(*pair).orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(upto).cast("int"))
    span = F.when(F.col("counts"), F.struct((F.col("end") - F.col("size")).alias("start"), F.col("end").alias("end")))
    return rows.groupBy(*pair).agg(F.array_sort(F.collect_list(span)).alias("spans"))


def _ledger(spark, path: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def scan(versions: DataFrame, ledger: str, path: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Brings the ledger up to date and returns path, blob and findings (array of rule, rule_version, spans) of every row of versions.

    path: the column that names a version of a file (a struct of path and version, or a single id).
    """
    spark = versions.sparkSession
    named = versions.select(F.col(path).alias("path"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("blob", F.sha2("text", 256))
    wanted = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("rule_version")) for r in rules])
    seen = _ledger(spark, ledger).groupBy("blob").agg(F.collect_set(F.struct("rule", "rule_version")).alias("seen"))  # at most one per rule version
    # The copy with the smallest path stands for its blob.  Narrow rows only; the sum combines before the shuffle.
    blobs = named.groupBy("blob").agg(F.min(F.struct("path")).alias("one")).join(seen, "blob", "left")
    unseen = blobs.select("blob", F.col("one.path").alias("one"), F.array_except(wanted, F.coalesce("seen", F.array().cast("array<struct<rule: string, rule_version: int>>"))).alias("todo"))
    unseen = unseen.filter(F.size("todo") > 0).withColumnRenamed("blob", "unseen")
    texts = named.join(unseen, (F.col("blob") == F.col("unseen")) & F.col("path").eqNullSafe(F.col("one"))).select("blob", "text", "todo")
    each = [F.when(F.array_contains("todo", F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("rule_version"))), F.struct(
        F.lit(r.name).alias("rule"), F.lit(r.version).alias("rule_version"), _parts(r, F.col("text")).alias("parts"))) for r in rules]
    found = texts.select("blob", F.explode(F.filter(F.array(*each), lambda x: x.isNotNull())).alias("f")).select("blob", "f.*")
    _placed(found).write.mode("append").parquet(ledger)
    current = F.array_contains(wanted, F.struct("rule", "rule_version"))
    by_blob = (spark.read.schema(LEDGER).parquet(ledger).filter(current)
               .groupBy("blob", "rule", "rule_version").agg(F.min("spans").alias("spans"))  # two runs at the same time may both have scanned a blob
               .filter(F.size("spans") > 0).groupBy("blob").agg(F.collect_list(F.struct("rule", "rule_version", "spans")).alias("findings")))
    return named.select("path", "blob").join(by_blob, "blob", "left").select(
        F.col("path").alias(path), "blob", F.coalesce("findings", F.array().cast("array<struct<rule: string, rule_version: int, spans: array<struct<start: int, end: int>>>>")).alias("findings"))


def digest(found: DataFrame, path: str = "doc_id", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts, the spans as kind:start:end by place, and the hash of the base spans."""
    order = F.array(*[F.lit(r.name) for r in rules])
    flat = F.flatten(F.transform("findings", lambda f: F.transform(f["spans"], lambda s: F.struct(
        s["start"].alias("start"), F.array_position(order, f["rule"]).alias("kind"), f["rule"].alias("rule"), s["end"].alias("end")))))
    spans = F.array_join(F.transform(F.array_sort(flat), lambda s: F.concat_ws(":", s["rule"], s["start"], s["end"])), ",")

    def count(name: str) -> Column:
        mine = F.transform("findings", lambda f: F.when(f["rule"] == name, F.size(f["spans"])).otherwise(F.lit(0)))
        return F.aggregate(mine, F.lit(0), lambda a, n: a + n).cast("long").alias(f"n_{name}")

    counts = [count(r.name) for r in rules]
    return found.select(path, *counts, F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))
