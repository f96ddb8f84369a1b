"""Toxicity: a bidirectional gated recurrent network over words and characters, trained in numpy, scoring all overlapping windows of a text.

A word's input is its own embedding (words seen in several training documents) and the means of its character runs (of three and of five bytes).  Windows of 64 words
begin every 32 words and cover the whole text; attention pools the states of a window, and the highest window is the document's.  Training
weighs a document's windows by how toxic they look, so that a label of a long text finds its place; a logistic fit over held-back training
documents then turns logits into probabilities.

What was never seen speaks for neither side: runs of characters that no training text has are zero, and clean training texts are also shown
with some, many or all of their words unknown.

Labels are learnt from at most `most_docs` rows, half of each class where there are enough, taken by the hash of doc_id, and from all windows of
each.  Only text is an input of a score.  Texts without words (null, empty, punctuation)
score 0.  Rows that repeat, or have a null doc_id, are scored like any other.  Without labels of both classes every score is 0; an empty table
gives an empty result.  Further columns are left out by scores(), and kept by drop_toxic().
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import gru
from shelfmark.llm.common import flat, id_text, mix, ragged
from shelfmark.llm.words import ALNUM, LOWER, groups, words

WINDOW, STRIDE, AT_ONCE, BATCH = 64, 32, 1024, 32
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3


@dataclass
class Model:
    params: dict[str, np.ndarray]
    kept: np.ndarray  # sorted hashes of the words that have an embedding row of their own
    grams: np.ndarray  # of each row of letter groups, whether it was learnt
    scale: float
    shift: float


def _grams(part: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the runs of three and of five bytes around each byte of each word, with marks beyond its ends, and where each word's begin."""
    sizes = ends - starts
    at, first, last = ragged(sizes, starts), np.repeat(starts, sizes), np.repeat(ends, sizes) - 1
    codes = []
    for reach in (1, 2):
        code = np.full(len(at), reach, np.uint64)
        for k in range(-reach, reach + 1):
            p = at + k
            byte = part[np.clip(p, 0, max(len(part) - 1, 0))].astype(np.uint64)
            code = (code << np.uint64(8)) | np.where(p < first, np.uint64(1), np.where(p > last, np.uint64(2), byte))
        codes.append((mix(code) % np.uint64(gru.CHAR_ROWS)).astype(np.int64))
    return np.stack(codes, axis=1), np.cumsum(sizes) - sizes


class Texts:
    """Distinct words of some texts, and each text's words as numbers of these."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        part = LOWER[data]
        starts, ends, hashes, self.upto = words(part, offs, ALNUM)
        self.hashes, one, self.number = np.unique(hashes, return_index=True, return_inverse=True)
        self.grams, self.begins = _grams(part, starts[one], ends[one]) if len(one) else (np.zeros((0, 2), np.int64), np.zeros(0, np.int64))

    def rows(self, kept: np.ndarray) -> np.ndarray:
        if not len(kept):
            return np.zeros(len(self.hashes), np.int64)
        known = kept[np.minimum(np.searchsorted(kept, self.hashes), len(kept) - 1)] == self.hashes
        return np.where(known, 1 + (self.hashes % np.uint64(gru.WORD_ROWS - 1)).astype(np.int64), 0)

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, size and text of every window."""
        n = np.diff(self.upto)
        each = np.where(n == 0, 0, np.maximum(1, -(-(n - WINDOW + STRIDE) // STRIDE)))
        k = ragged(each, np.zeros(len(n), np.int64))
        text = np.repeat(np.arange(len(n)), each)
        first = self.upto[text] + k * STRIDE
        return first, np.minimum(WINDOW, self.upto[text + 1] - first), text

    def grid(self, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        step = np.arange(int(size.max()))[:, None]
        inside = step < size
        return self.number[np.where(inside, first + step, first)], inside


def _inputs(model: Model, texts: Texts, rows: np.ndarray) -> np.ndarray:
    """Inputs of the distinct words, and of a word of which nothing is known as the last one."""
    known = model.grams[np.arange(2), texts.grams] if len(texts.grams) else np.zeros((0, 2), bool)
    return gru.word_inputs(model.params, np.append(rows, 0), texts.grams, texts.begins, known)


def _logits(model: Model, texts: Texts) -> np.ndarray:
    """The highest window of each text; -inf without words."""
    out = np.full(len(texts.upto) - 1, -np.inf)
    first, size, text = texts.windows()
    if not len(first):
        return out
    inputs = _inputs(model, texts, texts.rows(model.kept))
    order = np.argsort(-size, kind="stable")
    for k in range(0, len(order), AT_ONCE):
        some = order[k:k + AT_ONCE]
        z, _ = gru.forward(model.params, inputs, *texts.grid(first[some], size[some]))
        np.maximum.at(out, text[some], z)
    return out


def _step(model: Model, batch: Texts, y: np.ndarray, random: np.random.Generator) -> dict[str, np.ndarray] | None:
    """Gradients of one batch over all windows of its texts; windows are taken AT_ONCE at a time, so a long text needs no more memory."""
    first, size, text = batch.windows()
    if not len(first):
        return None
    rows_of = batch.rows(model.kept)
    rows_of = np.where(random.random(len(rows_of)) < 0.1, 0, rows_of)  # some words are seen by their characters alone
    inputs = _inputs(model, batch, rows_of)
    unknown = len(inputs) - 1
    # Clean texts are also seen with some, many or all words unknown, so that what was never seen speaks for neither side.
    share = np.where((y == 0) & (random.random(len(y)) < 0.5), random.random(len(y)) * 1.2, 0.0)
    parts = [slice(k, k + AT_ONCE) for k in range(0, len(first), AT_ONCE)]
    grids = []
    for part in parts:
        index, inside = batch.grid(first[part], size[part])
        grids.append((np.where(random.random(index.shape) < share[text[part]], unknown, index), inside))
    done = [gru.forward(model.params, inputs, *g, keep=len(parts) == 1) for g in grids]
    z = np.concatenate([x for x, _ in done])
    top = np.full(len(y), -np.inf)
    np.maximum.at(top, text, z)
    e = np.exp(z - top[text])
    total = np.bincount(text, e, len(y))
    soft = np.where(np.isfinite(top), top + np.log(np.maximum(total, 1e-9)), 0)
    d = ((gru.sigmoid(soft) - y)[text] * e / total[text] / len(y)).astype(np.float32)
    grads, dwords = None, 0
    for part, g, (_, kept) in zip(parts, grids, done):
        kept = kept or gru.forward(model.params, inputs, *g, keep=True)[1]
        some, dw = gru.backward(model.params, inputs, *g, kept, d[part])
        grads = some if grads is None else {k: grads[k] + some[k] for k in grads}
        dwords = dwords + dw
    gw, gc = np.zeros_like(model.params["word"]), np.zeros_like(model.params["char"])
    np.add.at(gw, np.append(rows_of, 0), dwords[:, :gru.WORD_DIM])
    sizes = np.diff(np.append(batch.begins, len(batch.grams)))
    each = np.repeat(dwords[:-1, gru.WORD_DIM:] / sizes[:, None], sizes, axis=0)
    for k in range(2):
        np.add.at(gc[k], batch.grams[:, k], each[:, k * gru.CHAR_DIM:(k + 1) * gru.CHAR_DIM] * model.grams[k, batch.grams[:, k]][:, None])
    return grads | {"word": gw, "char": gc}


def fit(rows: list[tuple[str, int]], epochs: int = 5, least_steps: int = 200, seed: int = 7) -> Model:
    """rows: (text, label) of the training documents, in a fixed order; all windows of each are learnt from.  Few rows are seen more often, for
    least_steps batches in all."""
    y = np.array([r[1] for r in rows], np.float32)
    raw = [r[0].encode() for r in rows]
    model = Model(gru.initial(seed), np.zeros(0, np.uint64), np.zeros((2, gru.CHAR_ROWS), bool), 1.0, 0.0)
    if not len(y) or y.min() == y.max():
        return replace(model, scale=0.0, shift=-np.inf)

    def texts(which):
        part = [raw[i] for i in which]
        return Texts(np.frombuffer(b"".join(part), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in part])]).astype(np.int64))

    random = np.random.default_rng(seed)
    order = random.permutation(len(raw))
    back, front = order[: len(order) // 5], order[len(order) // 5:]
    if y[back].min() == y[back].max():
        back = front = order
    every = texts(front)
    doc = np.repeat(np.arange(len(front)), np.diff(every.upto))
    pairs = np.unique(np.stack([every.number, doc]), axis=1)[0]
    common = np.bincount(pairs, minlength=len(every.hashes)) >= 3
    model.kept = every.hashes[common]
    model.grams[np.arange(2), every.grams] = True
    adam = gru.Adam(model.params, 0.01)
    epochs = max(epochs, -(-least_steps // -(-len(front) // BATCH)))
    for epoch in range(epochs):
        adam.rate = 0.01 * (1 - 0.8 * epoch / epochs)
        shuffled = random.permutation(front)
        for k in range(0, len(shuffled), BATCH):
            which = shuffled[k:k + BATCH]
            grads = _step(model, texts(which), y[which], random)
            if grads is not None:
                adam.step(grads)
    z = _logits(model, texts(back))
    ok = np.isfinite(z)
    model.scale, model.shift = _calibrated(z[ok], y[back][ok])
    return model


def _calibrated(z: np.ndarray, t: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic fit that stays near 1 and 0 where there is little evidence: Newton steps, halved until they help."""
    def loss(p):
        x = p[0] * z + p[1]
        return float((np.logaddexp(0, x) - t * x).sum() + 2 * (p[0] - 1) ** 2 + 0.25 * p[1] ** 2)

    p = np.array([1.0, 0.0])
    for _ in range(50):
        q = gru.sigmoid(p[0] * z + p[1])
        w = q * (1 - q)
        slope = np.array([((q - t) * z).sum() + 4 * (p[0] - 1), (q - t).sum() + 0.5 * p[1]])
        bend = np.array([[(w * z * z).sum() + 4, (w * z).sum()], [(w * z).sum(), w.sum() + 0.5]])
        step, size = np.linalg.solve(bend, slope), 1.0
        while size > 1e-6 and loss(p - size * step) > loss(p):
            size /= 2
        p = p - size * step
    return max(float(p[0]), 0.05), float(p[1])


def held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT


def train(docs: DataFrame, labels: DataFrame, most_docs: int = 2400, all_folds: bool = False) -> Model:
    """Fits on labelled rows outside the held-out fold (with all_folds, on all).  Half of most_docs of each class, by hash of doc_id."""
    known = labels.select("doc_id", "toxic").filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    if not all_folds:
        known = known.filter(F.crc32(F.col("doc_id").cast("string")) % FOLDS != HELD_OUT)
    picked = [known.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_docs // 2) for k in (1, 0)]
    picked = F.broadcast(picked[0].union(picked[1]))  # at most most_docs rows
    texts = id_text(docs).join(picked, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    rows = sorted(tuple(r) for r in texts.collect())
    return fit([(text, toxic) for _, toxic, text in rows])


def _scores(model: Model, texts: pa.Array) -> np.ndarray:
    data, offs = flat(texts)
    out = []
    for i, j in groups(offs):
        z = _logits(model, Texts(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]))
        out.append(np.where(np.isfinite(z), gru.sigmoid(model.scale * np.where(np.isfinite(z), z, 0) + model.shift), 0.0))
    return np.concatenate(out) if out else np.zeros(0)


def scores(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; no shuffle.  The model's size is fixed by its dimensions (under 3 MB)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = _scores(shared.value, batch.column("text"))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "held_out": pa.array([d is not None and held_out(d) for d in batch.column("doc_id").to_pylist()], pa.bool_()),
                                              "score": pa.array(s, pa.float64()), "predicted": pa.array((s >= threshold).astype(np.int32))})
    return id_text(docs).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """docs without the rows that score at or above threshold; all columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(shared.value, batch.column(text)) < threshold))
    return docs.mapInArrow(run, docs.schema)
