"""Periodic runs of words, by a dictionary of basic factors.

A run is a stretch of consecutive words with smallest period p (words p apart are identical), at least max(least, times * p) words long, that
no neighbouring word extends.  For every power of two, each stretch of that many words gets a name; equal stretches have equal names.  Where
a stretch occurs next within twice its length, the distance proposes a period, and neighbouring places with one distance are one proposal,
since the occurrences of a stretch this near form an arithmetic progression.  A distance to the next occurrence is the smallest period of what
lies between, so proposals need no further test than to be extended to both sides and told apart.  With times >= 3, a run of period p holds the
stretch of 2^k words, p <= 2^k < 2p, twice at distance p, so none is missed.

Words are compared as Arrow dictionary codes, which stand for whole words, not for hashes.  Documents are handled in batches of some
megabytes inside the task that reads them; nothing is shuffled.  Stretches that occur once in their document are dropped from level to level,
so ordinary prose costs two or three sorts of its words.

A null text has no words.  Empty texts, texts of white space, repeated rows, null doc_ids and empty tables give a row per row; further columns
are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import flat, id_text, ragged
from shelfmark.llm.words import NOT_SPACE, groups

RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def word_codes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and codes of all words, and the first word of each document (n + 1 numbers).  Equal codes are equal words."""
    inside = NOT_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    starts = np.flatnonzero(inside & (edge[:-1] | ~np.append(False, inside[:-1]))) if len(data) else np.zeros(0, np.int64)
    ends = np.flatnonzero(inside & (edge[1:] | ~np.append(inside[1:], False))) + 1 if len(data) else np.zeros(0, np.int64)
    first = np.searchsorted(starts, offs)
    if not len(starts):
        return starts, ends, np.zeros(0, np.int64), first
    letters = np.ascontiguousarray(data[inside])
    bounds = np.append(0, np.cumsum(ends - starts)).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(letters)])
    return starts, ends, words.dictionary_encode().indices.to_numpy().astype(np.int64), first


def _names(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(name of each key, 0 for one that occurs once; order of the keys by name, then place)."""
    order = np.argsort(keys, kind="stable")
    by = keys[order]
    new = np.append(True, by[1:] != by[:-1])
    group = np.cumsum(new)
    names = np.empty(len(keys), np.int64)
    names[order] = np.where(np.bincount(group)[group] > 1, group, 0)
    return names, order


def proposals(codes: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, distances): for each power of two, where a stretch of that many words occurs next within twice its length; of neighbouring
    places with one distance only the first."""
    n, width = len(codes), 1
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    places = np.arange(n)
    names, order = _names(doc << np.int64(32) | codes)
    while True:
        follow, same = order[1:], names[order[1:]] == names[order[:-1]]
        hit = same & (names[follow] > 0) & (places[follow] - places[order[:-1]] <= 2 * width)
        at = places[order[:-1][hit]]
        gap = places[follow[hit]] - at
        by = np.argsort(at, kind="stable")
        at, gap = at[by], gap[by]
        head = np.append(True, (at[1:] != at[:-1] + 1) | (gap[1:] != gap[:-1])) if len(at) else np.zeros(0, bool)
        yield at[head], gap[head]
        # The stretch of twice the width at i is the pair of names at i and i + width; where either occurs once, so does the pair.
        name_at = np.zeros(n + width, np.int64)
        name_at[places] = names
        left, right = names, name_at[places + width]
        live = (left > 0) & (right > 0)
        if not live.any():
            return
        places, width = places[live], 2 * width
        names, order = _names(left[live] << np.int64(32) | right[live])


def _reach(codes: np.ndarray, at: np.ndarray, gap: np.ndarray, stop: np.ndarray, step: int) -> np.ndarray:
    """How many words from `at` on (to the right or left) equal the word `gap` further right, up to `stop`."""
    far = np.zeros(len(at), np.int64)
    live = np.arange(len(at))
    room = np.abs(stop - at)
    for _ in range(64):  # most proposals end at once
        live = live[far[live] < room[live]]
        here = at[live] + step * far[live]
        live = live[codes[here] == codes[here + gap[live]]]
        if not len(live):
            return far
        far[live] += 1
    for i in live.tolist():  # the rest by doubling pieces
        piece = 128
        while far[i] < room[i]:
            m = int(min(piece, room[i] - far[i]))
            lo = at[i] + far[i] if step > 0 else at[i] - far[i] - m + 1
            equal = codes[lo:lo + m] == codes[lo + gap[i]:lo + gap[i] + m]
            equal = equal if step > 0 else equal[::-1]
            if not equal.all():
                far[i] += int(np.argmin(equal))
                break
            far[i] += m
            piece *= 2
    return far


def runs_of(codes: np.ndarray, first: np.ndarray, least: int = 24, times: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start in the batch, length, period) of all runs, by document, start and period."""
    if times < 3:
        raise ValueError("times must be 3 or more")
    found = [np.zeros((0, 4), np.int64)]
    for at, gap in proposals(codes, first) if len(codes) else ():
        doc = np.searchsorted(first, at, "right") - 1
        fits = times * gap <= first[doc + 1] - first[doc]
        at, gap, doc = at[fits], gap[fits], doc[fits]
        right = _reach(codes, at, gap, first[doc + 1] - gap, 1)
        left = _reach(codes, at - 1, gap, first[doc] - 1, -1)
        length = left + right + gap
        whole = length >= np.maximum(least, times * gap)
        found.append(np.stack([doc, at - left, length, gap], 1)[whole])
    rows = np.unique(np.concatenate(found), axis=0)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1]))]
    return rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 3]


def _batches(least: int, times: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = flat(batch.column("text"))
            for lo, hi in groups(offs):
                part, bounds = data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
                starts, ends, codes, first = word_codes(part, bounds)
                doc, start, length, period = runs_of(codes, first, least, times)
                # Words to leave out: those of a run after its first period.
                change = np.zeros(len(codes) + 1, np.int64)
                np.add.at(change, start + period, 1)
                np.add.at(change, start + length, -1)
                keep = np.cumsum(change[:-1]) == 0
                sizes = (ends - starts)[keep]
                left = np.append(0, np.cumsum(keep))[first]
                spaced = np.full(int(sizes.sum() + len(sizes)), 32, np.uint8)
                to = np.append(0, np.cumsum(sizes + 1))
                spaced[ragged(sizes, to[:-1])] = part[ragged(sizes, starts[keep])]
                # Every word is followed by a space; the last one of a document is left out.
                last = np.where(left[1:] > left[:-1], to[left[1:]] - 1, to[left[1:]])
                gone = np.zeros(len(spaced), bool)
                gone[last[left[1:] > left[:-1]]] = True
                text_offs = np.append(0, np.cumsum(np.maximum(to[left[1:]] - to[left[:-1]] - 1, 0)))
                texts = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(text_offs.astype(np.int64)), pa.py_buffer(spaced[~gone]))
                values = pa.StructArray.from_arrays([pa.array(start - first[doc]), pa.array(length), pa.array(period)], fields=list(_RUN))
                at = np.searchsorted(doc, np.arange(len(bounds)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[lo:hi], pa.array(np.diff(first)), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), values),
                     pc.cast(texts, pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])
    return run


def periodic_runs(docs: DataFrame, least: int = 24, times: int = 3) -> DataFrame:
    """Per document its runs (start and length in words, period), by start and period, and the text collapsed: without the words of each run
    that follow its first period, the others joined by one space."""
    return id_text(docs).mapInArrow(_batches(least, times), RUNS)


def digest(found: DataFrame) -> DataFrame:
    """Counts, the run of greatest length in periods, and hashes."""
    beats = lambda x, y: x["length"] * y["period"] > y["length"] * x["period"]
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    best = F.aggregate("runs", none, lambda acc, x: F.when(acc.isNull() | beats(x, acc), x).otherwise(acc))
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    rows = found.withColumn("best", best)
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Documents of which one in ten repeats a passage of its own to the end, as their number decides; the others are left as they are."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.withColumn("words", F.when(h % 10 == 0, words)).withColumns({"n": F.size("words").cast("long"), "g": F.floor(h / 10).cast("long")})
    rows = rows.withColumn("a", F.expr("CASE WHEN n > 0 THEN g % n END")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    planted = F.expr("array_join(transform(words, (w, i) -> CASE WHEN i < a THEN w ELSE words[CAST(a + (i - a) % p AS INT)] END), ' ')")
    return rows.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))

