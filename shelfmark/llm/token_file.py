"""Token-id output: documents in doc_id order as Simple-8b segments, and back.

A row of the file is a segment: consecutive documents of one shard (their ids and lengths), the Simple-8b words of all their token ids
(little-endian) and the word offset of every block of 256 ids.  Shards follow each other in doc_id order; a document lies in one segment.

Null texts are empty, rows with a null doc_id come first, rows that repeat a doc_id follow each other by a hash of their text, an empty table
gives an empty file, and any further columns are left out.  A text is encoded whole, whatever its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm import simple8b
from shelfmark.llm.byte_ids import byte_ids
from shelfmark.llm.common import id_text

SEGMENT_IDS = 1 << 18
SEGMENT = ("shard int, segment int, before long, n_ids long, doc_ids array<long>, lengths array<long>, words binary, block_offsets binary")


def _segments(tokenizer: str, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        encoder, shard = byte_ids(tokenizer), TaskContext.get().partitionId()
        docs, parts, held, segment, before = [], [], 0, 0, 0

        def row():
            words, offsets = simple8b.encode(np.concatenate(parts))
            return pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "segment": pa.array([segment], pa.int32()), "before": pa.array([before], pa.int64()),
                "n_ids": pa.array([held], pa.int64()), "doc_ids": pa.array([docs], pa.list_(pa.int64())),
                "lengths": pa.array([[len(p) for p in parts]], pa.list_(pa.int64())),
                "words": pa.array([words.astype("<u8").tobytes()], pa.binary()),
                "block_offsets": pa.array([offsets.astype("<u4").tobytes()], pa.binary())})

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for i, tokens in encoder.encode(batch.column("text")):
                docs.append(ids[i])
                parts.append(np.append(tokens, np.int32(end_id)))
                held += len(parts[-1])
                if held >= SEGMENT_IDS:
                    yield row()
                    docs, parts, held, segment, before = [], [], 0, segment + 1, before + held
        if parts:
            yield row()
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Encodes every text, ends each document with end_id and writes the file.  One shuffle, of the texts, by doc_id."""
    ordered = id_text(docs).withColumn("h", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")
    ordered.select("doc_id", "text").mapInArrow(_segments(tokenizer, end_id), SEGMENT).write.option("compression", "zstd").parquet(path)


def _documents(kind: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                x = {name: batch.column(name)[r].as_py() for name in batch.schema.names}
                ids = simple8b.decode(np.frombuffer(x["words"], "<u8"), np.frombuffer(x["block_offsets"], "<u4"), x["n_ids"]).astype("<u4")
                lengths = np.array(x["lengths"], np.int64)
                ends = np.cumsum(lengths)
                parts = [ids[a:b] for a, b in zip((ends - lengths).tolist(), ends.tolist(), strict=True)]
                out = {"shard": pa.array([x["shard"]] * len(parts), pa.int32()), "doc_id": pa.array(x["doc_ids"], pa.int64()),
                       "start": pa.array(x["before"] + ends - lengths, pa.int64()), "n_tokens": pa.array(lengths, pa.int64())}
                if kind == "digest":
                    out["ids_crc32"] = pa.array([zlib.crc32(p) for p in parts], pa.int64())
                else:
                    out["ids"] = pa.array([p.astype(np.int64) for p in parts], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(out)
    return run


def read_tokens(spark: SparkSession, path: str, kind: str = "ids") -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, and ids (kind "ids") or their crc32 (kind "digest")."""
    file = spark.read.schema(SEGMENT).parquet(path)
    last = "ids array<long>" if kind == "ids" else "ids_crc32 long"
    docs = file.mapInArrow(_documents(kind), f"shard int, doc_id long, start long, n_tokens long, {last}")
    # one row per shard: the running total over them is the only step in one task
    shards = file.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    shards = shards.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("earlier"))
    return (docs.join(shards, "shard").withColumn("start", F.col("start") + F.col("earlier")).drop("shard", "earlier"))
