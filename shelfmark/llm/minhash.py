"""Near-dedup by MinHash with sequential Bayesian verification.

A document is the set of its distinct 5-word shingles (words: lower-cased A-Z, split at ASCII white space); fewer words are one shingle.
Signatures have 256 values, of which 32 bands of four find candidates: a pair at a threshold of 0.85 shares no band with a probability below 1e-10, at 0.8 below 1e-7.  Documents with equal sets
are one class.  A pair goes if, after some batch of 64 signature values, the posterior probability (uniform prior) that it reaches the threshold
is below `miss`; of those that are left the full sets decide (of 64-bit hashes of the shingles: two of a pair of ten thousand shingles each
collide once in 1e11 such pairs).

Candidates of a bucket are taken in two steps, so that a group of copies costs rows in step with its size.  First every member is compared with the
bucket's smallest document.  Then only members that this did not link are compared with the others, in pairs of blocks of bounded size, on
signatures alone, and only where the first step left two documents in different components.  Texts are fetched for the survivors of a step.
What is found are links that join the documents of a component, not every linked pair.

Null and empty texts, and texts of white space only, have no shingles and are linked with nothing; each is its own component.  A row without a
doc_id is linked with nothing and has no component.  Rows that repeat a doc_id are versions of one document, so they share its component.  Texts
are read whole, whatever their length; an empty table gives an empty result; further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise, repeat
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import delete, flat, id_text, mix, ragged, written
from shelfmark.llm.components import components
from shelfmark.llm.words import LOWER, NOT_SPACE, groups, window_hashes, words

WIDTH, VALUES, BATCH, ROWS = 5, 256, 64, 4
BANDS = 32
BLOCK = 512  # documents of a bucket that are compared with each other in one go

_random = np.random.default_rng(1729)
_A = (_random.integers(0, 1 << 32, VALUES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
_B = _random.integers(0, 1 << 32, VALUES, dtype=np.uint64).astype(np.uint32)[:, None]


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    data, offs = flat(texts)
    for i, j in groups(offs):
        _, _, hashes, upto = words(LOWER[data[offs[i]:offs[j]]], offs[i:j + 1] - offs[i], NOT_SPACE)
        every = window_hashes(hashes, width)
        for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True):
            yield np.unique(every[a:b - width + 1]) if b - a >= width else window_hashes(hashes[a:b], b - a) if b > a else np.zeros(0, np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Upper 16 bits of the least value of each of 256 hash functions."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(x), 2048):
        np.minimum(least, (x[k:k + 2048] * _A + _B).min(axis=1), out=least)
    return (least >> np.uint32(16)).astype(np.uint16)


def least_matches(threshold: float, miss: float) -> list[tuple[int, int]]:
    """(n, m): after n values a pair with fewer than m matches has P(similarity >= threshold | matches) < miss.

    With a uniform prior that probability is P(Bin(n + 1, threshold) <= matches)."""
    out = []
    for n in range(BATCH, VALUES + 1, BATCH):
        total, m = 0.0, 0
        while (total := total + comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)) < miss:
            m += 1
        out.append((n, m))
    return out


def survivors(sigs: np.ndarray, a: np.ndarray, b: np.ndarray, least: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that no batch of signature values rules out."""
    matches, done = np.zeros(len(a), np.int64), 0
    for n, m in least:
        step = 1 << 11  # pairs whose values fit a core's cache
        for k in range(0, len(a), step):
            matches[k:k + step] += (sigs[a[k:k + step], done:n] == sigs[b[k:k + step], done:n]).sum(axis=1)
        keep = matches >= m
        a, b, matches, done = a[keep], b[keep], matches[keep], n
    return a, b


def _crossing(sides: np.ndarray, same: bool, labels: np.ndarray, sigs: np.ndarray, least) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one block pair between different components that their signatures do not rule out."""
    if same:
        a, b = np.triu_indices(len(sides), 1)
    else:
        left, right = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
        a, b = np.repeat(left, len(right)), np.tile(right, len(left))
    apart = labels[a] != labels[b]
    return survivors(sigs, a[apart], b[apart], least)


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    small, large = min(len(x), len(y)), max(len(x), len(y))
    if not small or 100 * small < percent * large:
        return False
    at = np.minimum(np.searchsorted(x, y), len(x) - 1)
    common = int((x[at] == y).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def _links(a: np.ndarray, b: np.ndarray, labels: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Of the pairs' components, links that suffice to join what is linked."""
    root = {x: x for x in labels}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    sizes = np.array([len(x) for x in sets])
    distinct, ids = np.unique(np.concatenate(sets), return_inverse=True)
    begins, mine = np.cumsum(sizes) - sizes, np.zeros(len(distinct), bool)
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    out = []
    for lo, hi in pairwise([*np.flatnonzero(np.append(True, a[1:] != a[:-1])).tolist(), len(a)] if len(a) else []):
        x = int(a[lo])
        others = np.array([y for y in b[lo:hi].tolist() if find(labels[y]) != find(labels[x])], np.int64)
        others = others[100 * np.minimum(sizes[others], sizes[x]) >= percent * np.maximum(sizes[others], sizes[x])]
        if not len(others):
            continue
        # What x has in common with all others in one pass over their sets.
        own = ids[begins[x]:begins[x] + sizes[x]]
        mine[own] = True
        hits = mine[ids[ragged(sizes[others], begins[others])]]
        common = np.add.reduceat(hits, np.cumsum(sizes[others]) - sizes[others], dtype=np.int64)
        mine[own] = False
        for y in others[100 * common >= percent * (sizes[others] + sizes[x] - common)].tolist():
            p, q = find(labels[x]), find(labels[y])
            if p != q:
                root[q] = p
                out.append((labels[x], labels[y]))
    return out


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, low, high, sigs = [], [], [], []
        for s in shingle_sets(batch.column("text")):
            n.append(len(s))
            low.append(int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)))
            high.append(int(mix(s + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64)))
            sigs.append(signature(s).astype("<u2").tobytes() if len(s) else None)
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_shingles": pa.array(n, pa.int64()), "set_low": pa.array(np.array(low, np.uint64).view(np.int64)),
                                          "set_high": pa.array(np.array(high, np.uint64).view(np.int64)), "sig": pa.array(sigs, pa.binary())})


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    salt = mix(np.arange(BANDS, dtype=np.uint64))
    for batch in batches:
        if batch.num_rows:
            sigs = np.frombuffer(b"".join(batch.column("sig").to_pylist()), "<u8").reshape(batch.num_rows, -1)[:, :BANDS]  # four values are one number
            keys = mix(sigs ^ salt).view(np.int64)
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys.ravel()), "doc": pa.array(np.repeat(batch.column("doc_id").to_numpy(zero_copy_only=False), BANDS))})


def _near_hub(percent: int, miss: float):
    """Rows come sorted by (hub, salt, member), the hub itself first: the members whose signatures do not rule out a link with it."""
    least = least_matches(percent / 100, miss)

    def run(batches):
        kept = None  # the hub rows of the last group, which the next batch may go on with
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("hub", "salt", "doc")], axis=1)
            sigs = np.frombuffer(b"".join(batch.column("sig").to_pylist()), "<u2").reshape(len(ids), -1)
            if kept is not None:
                ids, sigs = np.concatenate([kept[0], ids]), np.concatenate([kept[1], sigs])
            is_hub = ids[:, 0] == ids[:, 2]
            starts = np.flatnonzero(np.append(True, (ids[1:, :2] != ids[:-1, :2]).any(axis=1)))
            sizes = np.diff(np.append(starts, len(ids)))
            hubs = np.add.reduceat(is_hub.astype(np.int64), starts)  # more than one if rows repeat its doc_id
            group = np.repeat(np.arange(len(starts)), sizes)
            member = np.flatnonzero(~is_hub)
            b = np.repeat(member, hubs[group[member]])
            a = ragged(hubs[group[member]], starts[group[member]])
            _, b = survivors(sigs, a, b, least)
            out = ids[np.unique(b)]
            yield pa.RecordBatch.from_pydict({"hub": pa.array(out[:, 0]), "salt": pa.array(out[:, 1]), "doc": pa.array(out[:, 2])})
            last = slice(int(starts[-1]), int(starts[-1] + hubs[-1]))
            kept = ids[last].copy(), sigs[last].copy()
    return run


def _hub_links(percent: int):
    """Rows come sorted as above, with texts: a link for every member that the full sets confirm."""
    def run(batches):
        key, hubs = None, []
        for batch in batches:
            a, b = [], []
            for hub, salt, doc, mine in zip(*(batch.column(c).to_pylist() for c in ("hub", "salt", "doc")), shingle_sets(batch.column("text")), strict=True):
                if (hub, salt) != key:
                    key, hubs = (hub, salt), []
                if doc == hub:
                    hubs.append(mine)
                elif any(_linked(x, mine, percent) for x in hubs):
                    a.append(hub)
                    b.append(doc)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


_OPEN = pa.schema([("key", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("block", pa.int32()), ("doc", pa.int64()), ("label", pa.int64()), ("sig", pa.binary())])
# Of the documents that some pair of a block pair needs: the place among them, and a bit for every place that it pairs with.
_LEFT = pa.schema([("key", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("place", pa.int32()), ("doc", pa.int64()), ("label", pa.int64()), ("partners", pa.binary())])


def _needed(key: tuple, rows: list[tuple], least) -> pa.RecordBatch:
    labels = np.array([r[5] for r in rows], np.int64)
    sigs = np.frombuffer(b"".join(r[6] for r in rows), "<u2").reshape(len(rows), -1)
    a, b = _crossing(np.array([int(r[3] != r[1]) for r in rows]), key[1] == key[2], labels, sigs, least)
    held = np.union1d(a, b)
    pairs = np.zeros((len(held), len(held)), bool)
    pairs[np.searchsorted(held, a), np.searchsorted(held, b)] = True
    out = [(*key, place, *rows[x][4:6], bits.tobytes()) for place, (x, bits) in enumerate(zip(held.tolist(), np.packbits(pairs, axis=1), strict=True))]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(_LEFT)], schema=_LEFT)


def _confirmed(rows: list[tuple], sets: list[np.ndarray], percent: int) -> pa.RecordBatch:
    """Versions of a document stand at one place, each with its pairs."""
    bits = np.unpackbits(np.frombuffer(b"".join(r[6] for r in rows), np.uint8).reshape(len(rows), -1), axis=1)
    a, b = np.nonzero(bits[:, [r[3] for r in rows]])
    found = _links(a, b, [r[5] for r in rows], sets, percent)
    return pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})


def _block_pairs(percent: int, miss: float, with_texts: bool):
    """Rows come sorted by (key, i, j), one block pair after the other.  Without texts: the rows of documents that some pair needs; with texts: links."""
    least, names = least_matches(percent / 100, miss), (_LEFT if with_texts else _OPEN).names

    def run(batches):
        key, rows, sets = None, [], []

        def done():
            return _confirmed(rows, sets, percent) if with_texts else _needed(key, rows, least)

        for batch in batches:
            every = shingle_sets(batch.column("text")) if with_texts else repeat(None, batch.num_rows)
            for row, shingles in zip(zip(*(batch.column(x).to_pylist() for x in names), strict=True), every, strict=True):
                if row[:3] != key:
                    if rows:
                        yield done()
                    key, rows, sets = row[:3], [], []
                rows.append(row)
                sets.append(shingles)
        if rows:
            yield done()
    return run


def near_duplicates(docs: DataFrame, percent: int = 85, miss: float = 1e-9) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.  Documents are linked if 100 * common >= percent * union."""
    docs = id_text(docs)
    wide = written(docs.mapInArrow(_signed, "doc_id long, n_shingles long, set_low long, set_high long, sig binary"), "minhash-signatures")
    same = ["n_shingles", "set_low", "set_high"]
    # One row and one signature for each class, for equal sets have equal ones: from here on it is the only table that holds signatures.
    classes = wide.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*same).agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"))
    classes = written(classes, "minhash-classes")  # a table of its own, so that a set with very many documents can be split in the join
    signed = written(wide.drop("sig"), "minhash-sets")
    delete(wide)
    members = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL").join(classes.drop("sig"), same)
    reps = classes.select(F.col("rep").alias("doc_id"), "sig")
    bands = written(reps.mapInArrow(_banded, "key long, doc long"), "minhash-bands")
    buckets = bands.groupBy("key").agg(F.count("*").alias("n"), F.min("doc").alias("hub"), F.bit_xor(F.xxhash64("doc")).alias("all")).filter("n > 1")
    buckets = buckets.groupBy("n", "hub", "all").agg(F.min("key").alias("key")).drop("all")  # equal buckets of several bands once
    placed = written(bands.join(buckets, "key").filter("doc <> hub"), "minhash-buckets")
    delete(bands)
    star = _star(docs, reps, placed, percent, miss)
    versions = members.filter("doc_id <> rep").select(F.col("doc_id").alias("node"), "rep")
    repeated = versions.groupBy("node").agg(F.min("rep").alias("a"), F.max("rep").alias("b"))
    # Equal sets are linked through the class; versions of one doc_id through their classes' representatives.
    labels = components(star.union(repeated.filter("a <> b").select("a", "b")))
    rest = _rest(docs, reps, placed, star, labels, percent, miss)
    if not rest.isEmpty():
        tops = components(rest)
        labels = labels.withColumnRenamed("component", "label").join(tops.withColumnRenamed("node", "label"), "label", "left").select(
            "node", F.coalesce("component", "label").alias("component")).union(tops.join(labels, "node", "left_anti"))
    return _labelled(signed, members, labels)


def _with_texts(rows: DataFrame, docs: DataFrame) -> DataFrame:
    # The wanted ids grow with the corpus, so this is one merge join at every size.
    return rows.join(docs.select(F.col("doc_id").alias("doc"), "text").hint("merge"), "doc")


def _star(docs: DataFrame, reps: DataFrame, placed: DataFrame, percent: int, miss: float) -> DataFrame:
    """Links (a, b) between the smallest document of a bucket and its members.  A hub of many members stands in a part for each block of them."""
    salt = F.pmod(F.xxhash64("doc"), F.ceil(F.col("n") / BLOCK))
    pairs = placed.groupBy("hub", "doc").agg(F.min(salt).alias("salt"))

    def with_hubs(rows: DataFrame) -> DataFrame:
        return rows.select("hub", "salt", "doc").union(rows.select("hub", "salt", F.col("hub").alias("doc")).distinct())

    def in_order(rows: DataFrame) -> DataFrame:
        return rows.repartition("hub", "salt").sortWithinPartitions("hub", "salt", F.col("doc") != F.col("hub"))

    signs = with_hubs(pairs).join(reps.withColumnRenamed("doc_id", "doc"), "doc")
    near = written(in_order(signs).mapInArrow(_near_hub(percent, miss), "hub long, salt long, doc long"), "minhash-near-hub")
    found = in_order(_with_texts(with_hubs(near), docs)).mapInArrow(_hub_links(percent), "a long, b long")
    links = written(found, "minhash-hub-links")
    delete(near)
    return links


def _rest(docs: DataFrame, reps: DataFrame, placed: DataFrame, star: DataFrame, labels: DataFrame, percent: int, miss: float) -> DataFrame:
    """Links (a, b) between components, of documents that share a bucket without a link to its smallest document."""
    tied = star.distinct().select(F.col("a").alias("hub"), F.col("b").alias("doc"), F.lit(True).alias("tied"))
    named = placed.join(tied, ["hub", "doc"], "left").join(labels.select(F.col("node").alias("doc"), F.col("component").alias("label")), "doc", "left")
    named = written(named.select("key", "doc", F.col("tied").isNull().alias("free"), F.coalesce("label", "doc").alias("label")), "minhash-open")
    delete(placed)
    delete(star)
    wide = named.groupBy("key").agg(F.count_if("free").alias("free_n"), F.count_if(~F.col("free")).alias("tied_n"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    wide = wide.filter("free_n > 0 AND lo <> hi").select("key", F.ceil(F.col("free_n") / BLOCK).cast("int").alias("f"), F.ceil(F.col("tied_n") / BLOCK).cast("int").alias("t"))
    h = F.xxhash64("doc")
    block = F.when(F.col("free"), F.pmod(h, F.col("f"))).otherwise(F.col("f") + F.pmod(h, F.greatest("t", F.lit(1)))).cast("int")
    last = F.when(F.col("free"), F.col("f") + F.col("t")).otherwise(F.col("f")) - 1  # blocks of tied documents meet those of free ones only
    rows = named.join(wide, "key").withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    rows = rows.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "doc", "label")

    def in_order(rows: DataFrame) -> DataFrame:
        return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    signs = rows.join(reps.withColumnRenamed("doc_id", "doc"), "doc").select(*_OPEN.names)
    left = written(in_order(signs).mapInArrow(_block_pairs(percent, miss, False), "key long, i int, j int, place int, doc long, label long, partners binary"), "minhash-block-pairs")
    delete(named)
    wanted = left.select("doc").distinct()
    texts = docs.select(F.col("doc_id").alias("doc"), "text").join(wanted, "doc", "left_semi")
    links = written(in_order(left.join(texts, "doc")).mapInArrow(_block_pairs(percent, miss, True), "a long, b long"), "minhash-links")
    delete(left)
    return links


def _labelled(signed: DataFrame, members: DataFrame, labels: DataFrame) -> DataFrame:
    out = signed.select("doc_id", "n_shingles", "set_low", "set_high")
    reps = members.select("doc_id", "rep").groupBy("doc_id").agg(F.min("rep").alias("rep"))
    out = out.join(reps, "doc_id", "left").join(labels, F.col("rep") == F.col("node"), "left")
    out = out.withColumn("component_id", F.coalesce("component", "rep", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
