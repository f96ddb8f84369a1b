"""Exact dedup by Grace hashing: of rows with equal texts, the one with the largest doc_id stays.

Every task first groups the rows it reads in an open-addressing table that compares complete contents, so a text that a third of all rows
share leaves each task once.  The heads of these local groups are then dealt by content hash to as many buckets as their measured bytes ask for
(a quarter of `fit_bytes` each on average); a task takes its buckets one after the other, each with a table of its own.  A content that finds no
room in its bucket's table is spilled, and only what was spilled is dealt anew, by another hash, to buckets measured again.  At worst, with
texts just over half a table, a level leaves less than a quarter of its bytes, so levels grow with the logarithm of the data and the bytes
rewritten stay below a third of them.  Spill files are tables in the folder that all executors share.

A null text is an empty one, and empty texts are equal to each other.  Null doc_ids are the smallest; of rows with the same doc_id and text
exactly one stays.  Rows that repeat are rows of their own.  An empty table gives an empty result; further columns are left out.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import delete, flat, id_text, written

FIT_BYTES = 64 << 20
OUT_BYTES = 8 << 20
RECORD_BYTES = 64  # of a table's entry, besides its content

HEAD = "n long, max_id long, max_row long, hash long, size long, content binary"


class OpenTable:
    """Contents by linear probing; the hash finds the slot, the complete content decides."""

    def __init__(self):
        self.slots, self.hashes, self.contents, self.bytes = array("q", [-1]) * 1024, [], [], 0

    def find(self, h: int, content: bytes) -> tuple[int, int]:
        """(entry or -1, slot where the search ended)."""
        mask = len(self.slots) - 1
        i = h & mask
        while (e := self.slots[i]) >= 0:
            if self.hashes[e] == h and self.contents[e] == content:
                return e, i
            i = (i + 1) & mask
        return -1, i

    def add(self, h: int, content: bytes, slot: int) -> int:
        e = len(self.hashes)
        self.slots[slot] = e
        self.hashes.append(h)
        self.contents.append(content)
        self.bytes += len(content) + RECORD_BYTES
        if (e + 1) * 10 > len(self.slots) * 6:
            self.slots = array("q", [-1]) * (len(self.slots) * 2)
            mask = len(self.slots) - 1
            for k, x in enumerate(self.hashes):
                i = x & mask
                while self.slots[i] >= 0:
                    i = (i + 1) & mask
                self.slots[i] = k
        return e


def _later(a: tuple, b: tuple) -> tuple:
    """The (doc_id, row) that stays; a null id is the smallest."""
    return max(a, b, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))


def _batches(rows: Iterator[tuple], schema: pa.Schema, weight: int) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += RECORD_BYTES + len(r[weight] or b"")
        if size >= OUT_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


_LOCAL = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("lid", pa.int64()), ("text_sha256", pa.string()), ("n", pa.int64()),
                    ("max_id", pa.int64()), ("max_row", pa.int64()), ("hash", pa.int64()), ("size", pa.int64()), ("content", pa.binary())])


def _local(fit_bytes: int):
    """Member rows (doc_id, row, lid, sha), and for each local group a head row with its content."""
    def rows(batches):
        base = TaskContext.get().partitionId() << 33
        table, row, groups, tops, shas, first = OpenTable(), 0, [], [], [], 0

        def heads():
            for e, (n, top) in enumerate(zip(groups, tops, strict=True)):
                content = table.contents[e]
                yield None, None, base + first + e, None, n, *top, table.hashes[e], len(content) + RECORD_BYTES, content

        for batch in batches:
            data, offs = flat(batch.column("text"))
            raw = data.tobytes()
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                content = raw[offs[i]:offs[i + 1]]
                digest = hashlib.sha256(content).digest()
                h = int.from_bytes(digest[:8], "little", signed=True)
                e, slot = table.find(h, content)
                at = (doc, base + row)
                if e < 0:
                    e = table.add(h, content, slot)
                    groups.append(0)
                    tops.append(at)
                    shas.append(digest.hex())
                groups[e] += 1
                tops[e] = _later(tops[e], at)
                yield doc, base + row, base + first + e, shas[e], None, None, None, None, None, None
                row += 1
                if table.bytes > fit_bytes:
                    yield from heads()
                    first += len(groups)
                    table, groups, tops, shas = OpenTable(), [], [], []
        yield from heads()

    return lambda batches: _batches(rows(batches), _LOCAL, 9)


_LEVEL = pa.schema([("lid", pa.int64()), ("cid", pa.int64()), ("n", pa.int64()), ("max_id", pa.int64()), ("max_row", pa.int64()),
                    ("hash", pa.int64()), ("size", pa.int64()), ("content", pa.binary())])


def _buckets(fit_bytes: int):
    """(lid, cid) for each record whose content is in its bucket's table; a record that finds no room goes on with its content and without a
    cid.  Rows come bucket after bucket."""
    def rows(batches):
        now, table, heads = None, OpenTable(), []
        for batch in batches:
            *numbers, contents = (batch.column(c) for c in ("bucket", "lid", "n", "max_id", "max_row", "hash", "size", "content"))
            for bucket, lid, n, doc, top, h, size, content in zip(*(c.to_pylist() for c in numbers), contents, strict=True):
                if bucket != now:
                    now, table, heads = bucket, OpenTable(), []
                content = content.as_py()
                e, slot = table.find(h, content)
                if e < 0 and (table.bytes + size <= fit_bytes or not heads):
                    e = table.add(h, content, slot)
                    heads.append(lid)
                yield (lid, heads[e], n, doc, top, None, None, None) if e >= 0 else (lid, None, n, doc, top, h, size, content)

    return lambda batches: _batches(rows(batches), _LEVEL, 7)


def exact_dedup(docs: DataFrame, fit_bytes: int = FIT_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per row of docs.  A text is read, written and dealt once."""
    local = written(id_text(docs).mapInArrow(_local(fit_bytes), "doc_id long, row long, lid long, text_sha256 string, " + HEAD), "exact-local")
    members = local.filter("row IS NOT NULL").select("doc_id", "row", "lid", "text_sha256")
    records = local.filter("n IS NOT NULL").select("lid", "n", "max_id", "max_row", "hash", "size", "content")
    levels, level = [], 0
    while True:
        size = records.agg(F.sum("size")).first()[0] or 0
        if levels and not size:
            break
        if levels:
            records, level = written(records, f"exact-spill{level}"), level + 1
        buckets = -(-4 * size // fit_bytes) + 1
        dealt = records.withColumn("bucket", F.pmod(F.xxhash64(F.col("hash"), F.lit(level)), F.lit(buckets)))
        dealt = dealt.repartition("bucket").sortWithinPartitions("bucket")
        done = written(dealt.mapInArrow(_buckets(fit_bytes), "lid long, cid long, " + HEAD), f"exact-level{level}")
        if level:
            delete(records)
        levels.append(done)
        records = done.filter("cid IS NULL").drop("cid")
    placed = levels[0]
    for more in levels[1:]:
        placed = placed.union(more)
    placed = placed.filter("cid IS NOT NULL").select("lid", "cid", "n", "max_id", "max_row")
    groups = placed.groupBy("cid").agg(F.max(F.struct("max_id", "max_row")).alias("top"), F.sum("n").alias("group_size"))
    by_local = placed.select("lid", "cid").join(groups, "cid").select("lid", "top", "group_size")
    return members.join(by_local, "lid").select("doc_id", F.col("top.max_id").alias("keep_id"), "group_size",
                                                (F.col("row") == F.col("top.max_row")).alias("kept"), "text_sha256")
