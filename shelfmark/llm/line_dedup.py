"""Line dedup by a deletion-neighbourhood join, in DataFrame operations only.

A line's text is the line without spaces at its ends; its words stand between single spaces.  Two lines are near if one word replaced, put in or
taken out makes one the other, and both have at least `near_words` words.  A line goes if the same text, or a near one, occurs earlier, by
doc_id and then by place in the text; what is earlier is judged on the input.  Lines of fewer than `least_words` words always stay.

A line's neighbourhood is its text and every text with one word left out, as hashed keys.  Lines whose keys are equal meet: with the same word
left out they differ in that word, and a text that equals another one less a word differs by it.  Only the earliest line of a key is compared
with the others, word by word, so a key that very many lines share gives no pairs among them.  Lines with no possible partner emit no keys:
a single edit leaves the first or the last half of the words as they were, so a line none of whose halves occurs in another line is left out first.

A null text stays null, and a document that has lost every line that is not blank has an empty text.  A row without a doc_id comes after all
others.  Rows that repeat a doc_id share its places, so equal rows both stay.  An empty table gives an empty result; all other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import delete, free_names, written

LEAST_WORDS, NEAR_WORDS = 3, 8
_LAST = 9223372036854775807  # stands for a missing doc_id


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _split_lines(docs: DataFrame, least_words: int) -> DataFrame:
    """A narrow row for each line that counts: whose it is, where, hashes of its text (k1, k2) and of its halves."""
    rows = docs.select("id", "h", F.posexplode(_lines("text")).alias("pos", "line")).withColumn("line", F.trim("line"))
    n = F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    rows = rows.withColumn("n", n).filter((F.col("n") >= least_words) & (F.col("line") != ""))

    def half(side: int, more: int) -> Column:
        m = F.floor((F.col("n") + more) / 2) if side == 0 else -F.ceil((F.col("n") + more) / 2)
        return F.xxhash64(F.lit(side), F.col("n") + more, F.call_function("substring_index", "line", F.lit(" "), m.cast("int")))

    return rows.select("id", "h", "pos", "n", F.xxhash64("line").alias("k1"), F.xxhash64(F.lit(1), "line").alias("k2"),
                       half(0, 0).alias("p0"), half(0, 1).alias("p1"), half(1, 0).alias("s0"), half(1, 1).alias("s1"))


def _place(id_: Column, pos: Column) -> Column:
    """One number that orders by document and line."""
    return (id_.cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(11,0)") + pos.cast("decimal(11,0)")).cast("decimal(38,0)")


def _near(docs: DataFrame, distinct: DataFrame, near_words: int) -> DataFrame:
    """k1, k2 of the distinct lines that have an earlier near one."""
    able = distinct.filter(F.col("n") >= near_words)
    halves = able.select("k1", "k2", F.explode(F.array("p0", "p1", "s0", "s1")).alias("half"))
    shared = halves.groupBy("half").agg(F.min("k1").alias("a"), F.max("k1").alias("b")).filter("a <> b").select("half")
    able = able.join(halves.join(shared, "half").select("k1", "k2").distinct(), ["k1", "k2"])
    able = able.select("k1", "k2", "first", "n", F.floor(F.col("first") / (1 << 32)).cast("long").alias("of"), F.pmod("first", F.lit(1 << 32).cast("decimal(38,0)")).cast("int").alias("at"))
    texts = able.join(docs, able.of == docs.id).select("k1", "k2", "first", "n", F.trim(F.get(_lines("text"), F.col("at"))).alias("line"))
    texts = texts.filter((F.xxhash64("line") == F.col("k1")) & (F.xxhash64(F.lit(1), "line") == F.col("k2"))).dropDuplicates(["k1", "k2"])
    texts = written(texts, "line-texts")

    # The key of a text less its word j: words before j as they stand, words behind it one place further left.
    w = texts.select("k1", "k2", "first", "n", F.posexplode(F.split("line", " ", -1)).alias("j", "word"))
    w = w.select("k1", "k2", "first", "n", "j", F.xxhash64("word", "j").alias("here"), F.xxhash64("word", F.col("j") - 1).alias("left"))
    line = Window.partitionBy("k1", "k2")
    upto = line.orderBy("j").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w = w.select("k1", "k2", "first", "n", "j", F.bit_xor("here").over(upto).bitwiseXOR(F.col("here")).bitwiseXOR(F.bit_xor("left").over(upto)).bitwiseXOR(F.bit_xor("left").over(line)).alias("key"),
                 F.bit_xor("here").over(line).alias("whole"))
    w = written(w, "line-keys")
    me = F.struct("first", "k1", "k2")
    swapped = w.groupBy("key", "n", "j").agg(F.min(me).alias("early"), F.count("*").alias("c")).filter("c > 1")
    pairs = w.join(swapped.select("key", "n", "j", "early"), ["key", "n", "j"]).filter("first > early.first").select("k1", "k2", "early.k1", "early.k2")
    whole = w.filter("j = 0").select("k1", "k2", "first", F.col("whole").alias("key"), F.col("n").alias("m"))
    less = w.select("k1", "k2", "first", "key", (F.col("n") - 1).alias("m"))
    taken = less.join(whole.select("key", "m", F.col("k1").alias("w1"), F.col("k2").alias("w2"), F.col("first").alias("wf")), ["key", "m"])
    longer_late = taken.filter("wf < first").select("k1", "k2", "w1", "w2")
    shorter_late = taken.filter("first < wf").select(F.col("w1"), F.col("w2"), "k1", "k2")
    pairs = pairs.toDF("k1", "k2", "e1", "e2").union(longer_late).union(shorter_late).distinct()
    a, b = F.split("line", " ", -1), F.split("early", " ", -1)
    late = texts.select("k1", "k2", "line")
    early = texts.select(F.col("k1").alias("e1"), F.col("k2").alias("e2"), F.col("line").alias("early"))
    both = pairs.join(late, ["k1", "k2"]).join(early, ["e1", "e2"]).select("k1", "k2", a.alias("a"), b.alias("b"))
    near = written(both.filter(_one_edit(F.col("a"), F.col("b"))).select("k1", "k2").distinct(), "line-near")
    delete(w)
    return near


def _one_edit(a: Column, b: Column) -> Column:
    """Whether two word arrays are one edit apart: behind their first difference they go on alike."""
    long, short = F.when(F.size(a) >= F.size(b), a).otherwise(b), F.when(F.size(a) >= F.size(b), b).otherwise(a)
    differs = F.array_position(F.zip_with(long, short, lambda x, y: x.eqNullSafe(y)), False).cast("int")  # 1-based, over the longer one
    n, m = F.size(long), F.size(short)
    rest = F.slice(long, differs + 1, n)
    return (differs > 0) & F.when(n == m, rest == F.slice(short, differs + 1, n)).when(n == m + 1, rest == F.slice(short, differs, n)).otherwise(False)


def removed_lines(docs: DataFrame, least_words: int = LEAST_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """doc_id (a missing one as the largest long), h (hash of the text) and the places of the lines that go, for documents that lose some."""
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("id"), F.xxhash64("text").alias("h"), F.coalesce("text", F.lit("")).alias("text"))
    lines = written(_split_lines(keyed, least_words), "lines")
    distinct = written(lines.groupBy("k1", "k2").agg(F.min(_place(F.col("id"), F.col("pos"))).alias("first"), F.count("*").alias("times"), F.min("n").alias("n"),
                                                     *[F.min(c).alias(c) for c in ("p0", "p1", "s0", "s1")]), "line-distinct")
    near = _near(keyed, distinct, near_words).withColumn("near", F.lit(True))
    going = distinct.join(near, ["k1", "k2"], "left").filter("near OR times > 1").select("k1", "k2", "first", "near")
    gone = lines.join(going, ["k1", "k2"]).filter(F.coalesce("near", F.lit(False)) | (_place(F.col("id"), F.col("pos")) > F.col("first")))
    return gone.groupBy("id", "h").agg(F.collect_set("pos").alias("places"))  # at most a document's lines


def dedup_lines(docs: DataFrame, least_words: int = LEAST_WORDS, near_words: int = NEAR_WORDS, counts: tuple[str, str] = ("n_lines", "n_removed")) -> DataFrame:
    """docs with the lines cut out of text, and two more columns (a column of such a name is replaced): lines before, and lines removed."""
    docs = docs.drop(*counts)
    doc, group, places = free_names(docs.columns, "line_doc", "line_group", "line_places")
    gone = removed_lines(docs, least_words, near_words).select(F.col("id").alias(doc), F.col("h").alias(group), F.col("places").alias(places))
    mine = (F.coalesce(docs["doc_id"].cast("long"), F.lit(_LAST)) == F.col(doc)) & (F.xxhash64(docs["text"]) == F.col(group))
    left = F.filter(_lines("text"), lambda x, i: ~F.array_contains(F.col(places), i))
    left = F.when(F.exists(left, lambda x: F.trim(x) != ""), F.array_join(left, "\n")).otherwise(F.lit(""))
    hit = F.col(places).isNotNull()
    return docs.join(gone, mine, "left").select(
        *[F.when(hit, left).otherwise(F.col("text")).alias("text") if c == "text" else F.col(c) for c in docs.columns],
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(_lines("text"))).cast("long").alias(counts[0]),
        F.when(hit, F.size(places)).otherwise(F.lit(0)).cast("long").alias(counts[1]))
