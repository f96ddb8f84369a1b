"""What the operators share: documents as (doc_id, text), written tables, Arrow texts as flat bytes."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20  # text handled at once by the vectorised code of a task


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """The two columns that every operator reads; a null text is an empty one."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


_here: list[str] = []  # the folder of a session on one machine that names none


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the cluster names it.  A session on one machine (tests) may leave it unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        if not _here:
            _here.append("file://" + tempfile.mkdtemp(prefix="shelfmark-"))
        base = _here[0]
    return base


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """df as a table in the shared folder: lineage ends here, and a lost executor costs a reread.  Shuffle files of the job that wrote it
    are of no more use, so the session is told to drop them when that job ends."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    clean = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(clean, "false")
    spark.conf.set(clean, "true")
    try:
        df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    finally:
        spark.conf.set(clean, before)
    return spark.read.schema(df.schema).parquet(path)


def delete(df: DataFrame) -> None:
    """Deletes a table made by written() that nothing reads any more."""
    spark = df.sparkSession
    root = shared_dir(spark).rstrip("/")
    for path in {os.path.dirname(f) for f in df.inputFiles()}:
        if path.removeprefix("file:").lstrip("/").startswith(root.removeprefix("file:").lstrip("/") + "/"):
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def flat(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in one array, and the n + 1 offsets."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    wide = texts.cast(pa.large_binary())
    if not len(wide):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = wide.buffers()
    offs = np.frombuffer(offsets, np.int64, len(wide) + 1, wide.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True


def _cuts(data: np.ndarray, lo: int, hi: int, limit: int) -> Iterator[tuple[int, int]]:
    """[lo, hi) in pieces of about limit bytes, cut only before a space between two ASCII letters or digits: no word or token of any
    splitter used here crosses such a place.  A text without one stays whole."""
    while hi - lo > limit:
        at, step = lo + limit, limit
        while True:
            end = min(hi - 1, at + step)
            w = data[at:end + 1]
            ok = np.flatnonzero((w[1:-1] == 32) & _ALNUM[w[:-2]] & _ALNUM[w[2:]]) if len(w) > 2 else ()
            if len(ok):
                yield lo, (lo := at + 1 + int(ok[0]))
                break
            if end >= hi - 1:
                yield lo, hi
                return
            at = end - 2
    yield lo, hi


def slices(data: np.ndarray, offs: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Parts of documents as (their bytes, starts and end of the parts, document index of each part); long documents come in several parts."""
    parts: list[tuple[int, int, int]] = []
    size = 0

    def out():
        lo, hi = parts[0][1], parts[-1][2]
        return data[lo:hi], np.array([p[1] for p in parts] + [hi], np.int64) - lo, np.array([p[0] for p in parts], np.int64)

    for i in range(len(offs) - 1):
        for lo, hi in _cuts(data, int(offs[i]), int(offs[i + 1]), limit):
            if parts and size + hi - lo > limit:
                yield out()
                parts, size = [], 0
            parts.append((i, lo, hi))
            size += hi - lo
    if parts:
        yield out()


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser over 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end] for all spans: eight bytes at a time are mixed with their place in the span, the sum with its length.
    No sum of products, so that no pattern of letters cancels out; where a result hangs on equality, contents are compared all the same."""
    sizes = ends - starts
    parts = -(-sizes // 8)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))
    place = ragged(parts, np.zeros(len(parts), np.int64))
    at = np.repeat(starts, parts) + 8 * place
    rest = np.minimum(np.repeat(ends, parts) - at, 8).astype(np.uint64)
    value = words[at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * rest))
    turn = mix(np.arange(int(parts.max()) if len(parts) else 0, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(0x9E3779B97F4A7C15))
    mixed = mix(mix(value + np.uint64(0x2545F4914F6CDD1D)) ^ turn[place])
    sums = np.zeros(len(sizes), np.uint64)
    some = parts > 0
    if some.any():
        sums[some] = np.add.reduceat(mixed, (np.cumsum(parts) - parts)[some])
    return mix(sums + sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))


def free_names(columns: list[str], *wanted: str) -> list[str]:
    """Names for helper columns that no column of a table has."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name in taken:
            name += "_"
        taken.add(name)
        out.append(name)
    return out


def ragged(lengths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each of the runs, one after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
