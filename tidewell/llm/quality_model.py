"""Quality scores: random-indexing word vectors, pooled, and a two-layer network.

1. *Word vectors.* A unit of text (a word, or the shape of one) has a sparse random index vector, given by
   its hash; its word vector is the sum of the index vectors of its neighbours, over all documents. Units
   share a table of WORDS + SHAPES rows, so the table has the same size for any corpus.
2. *Pooling.* A document is the mean of its units' vectors and index vectors, their lengths (which tell
   repetition) and the log of its words.
3. *Network.* Two layers in numpy, fitted on a bounded sample of SAMPLE labelled rows (those of least
   hash); a part of the sample sets the temperature by which scores are divided, so that they are probabilities.

Nulls: a null, empty or blank text has the zero vector and its score. Labels that are null, repeated or
without a document don't count (of several, the largest). Without labels of both kinds every score is the
share of label 1, or 1. Rows with equal ids are scored each by its text. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textnp
from .common import mapped, small_batches, table

SAMPLE = 20_000
#: Rows of the table for words and for shapes, numbers in a vector, and neighbours on each side.
WORDS, SHAPES, DIM, REACH = 1 << 14, 1 << 10, 24, 2
#: Rows of the table that travel together.
BLOCK = 256
HIDDEN, EPOCHS, RATE = 24, 60, 3e-3
#: Kinds of bytes in a shape: lower case, upper case, digit, other letters; a sign stands for itself.
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[97:123], SHAPE[65:91], SHAPE[48:58], SHAPE[128:] = ord("a"), ord("A"), ord("0"), ord("a")


def index_vectors() -> np.ndarray:
    """Of each row of the table: two entries of 1 and two of -1."""
    rng = np.random.Generator(np.random.PCG64(7))
    out = np.zeros((WORDS + SHAPES, DIM), np.float32)
    places = np.argsort(rng.random(out.shape), axis=1)[:, :4]
    np.put_along_axis(out, places, np.array([1, 1, -1, -1], np.float32), axis=1)
    return out


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word its row of the table, the row of its shape, and the text that it is in."""
    starts, ends, first = textnp.spans(~textnp.IS_SPACE[data], offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    if not len(starts):
        return starts, starts, row
    word = textnp.span_hashes(data, starts, ends) % np.uint64(WORDS)
    shape = SHAPE[data]
    inner = np.zeros(len(data), bool)
    inner[1:] = shape[1:] != shape[:-1]
    inner[starts] = True
    inner &= ~textnp.IS_SPACE[data]
    at = np.flatnonzero(inner)
    begin = np.searchsorted(at, starts)
    kinds = shape[at]
    form = textnp.span_hashes(kinds, begin, np.r_[begin[1:], len(at)]) % np.uint64(SHAPES)
    return word.astype(np.int64), form.astype(np.int64) + WORDS, row


def neighbours(index: np.ndarray, row: np.ndarray) -> np.ndarray:
    """For each unit the sum of ``index`` over its neighbours in the same text."""
    out = np.zeros_like(index)
    for d in range(1, REACH + 1):
        same = (row[d:] == row[:-d])[:, None]
        out[d:] += np.where(same, index[:-d], 0)
        out[:-d] += np.where(same, index[d:], 0)
    return out


def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The table of this partition, in compressed blocks."""
    index, total = index_vectors(), np.zeros((WORDS + SHAPES, DIM), np.float64)
    for batch in batches:
        for _, _, data, offsets in textnp.pieces(textnp.column(batch, "text")):
            for unit, row in _both(data, offsets):
                near = neighbours(index[unit], row)
                for d in range(DIM):
                    total[:, d] += np.bincount(unit, near[:, d], WORDS + SHAPES)
    yield from _packed(total)


def _both(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    word, form, row = units(data, offsets)
    yield word, row
    yield form, row


def _packed(total: np.ndarray) -> Iterator[pa.RecordBatch]:
    used = [b for b in range(len(total) // BLOCK) if total[b * BLOCK : (b + 1) * BLOCK].any()]
    sums = [zlib.compress(total[b * BLOCK : (b + 1) * BLOCK].astype(np.int64).tobytes(), 1) for b in used]
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(sums, pa.binary())], ["block", "sums"])


def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((WORDS + SHAPES, DIM), np.int64)
    for batch in batches:
        for b, sums in zip(textnp.column(batch, "block").to_pylist(), textnp.column(batch, "sums")):
            total[b * BLOCK : (b + 1) * BLOCK] += np.frombuffer(zlib.decompress(sums.as_py()), np.int64).reshape(BLOCK, DIM)
    yield from _packed(total)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The table of unit-length word vectors, from all documents."""
    made = docs.select("text").transform(mapped, gather, "block int, sums binary").repartition("block").transform(mapped, add_up, "block int, sums binary")
    total = np.zeros((WORDS + SHAPES, DIM))
    for r in made.toLocalIterator():
        total[r.block * BLOCK : (r.block + 1) * BLOCK] += np.frombuffer(zlib.decompress(r.sums), np.int64).reshape(BLOCK, DIM)
    return (total / np.maximum(1e-9, np.linalg.norm(total, axis=1, keepdims=True))).astype(np.float32)


def pooled(data: np.ndarray, offsets: np.ndarray, vectors: np.ndarray, index: np.ndarray) -> np.ndarray:
    """A row of numbers for each text."""
    n = len(offsets) - 1
    out = []
    for unit, row in _both(data, offsets):
        count = np.maximum(1, np.bincount(row, minlength=n))[:, None]
        for values in (vectors, index):
            mean = np.stack([np.bincount(row, values[unit, d], n) for d in range(DIM)], axis=1) / count
            out += [mean, np.log1p(np.linalg.norm(mean, axis=1, keepdims=True))]
    out.append(np.log1p(count) / 8)
    return np.concatenate(out, axis=1)


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.scale) @ self.w1 + self.b1) @ self.w2 + self.b2

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def train(x: np.ndarray, y: np.ndarray) -> Network:
    """A network by Adam in batches, then its temperature on every fifth row, which the weights never see."""
    rng = np.random.Generator(np.random.PCG64(11))
    aside = np.arange(len(x)) % 5 == 4
    net = Network(x.mean(0), x.std(0) + 1e-6, rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), 0.0)
    z, t = ((x - net.mean) / net.scale)[~aside], y[~aside].astype(float)
    params = [net.w1, net.b1, net.w2, np.zeros(1)]
    m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(max(EPOCHS, 200_000 // max(1, len(z))) if len(z) < 4000 else EPOCHS):
        order = rng.permutation(len(z))
        for at in range(0, len(z), 128):
            b = order[at : at + 128]
            h = np.tanh(z[b] @ params[0] + params[1])
            d = (1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -30, 30))) - t[b]) / len(b)
            back = d[:, None] * params[2] * (1 - h * h)
            grads = [z[b].T @ back + 1e-3 * params[0], back.sum(0), h.T @ d + 1e-3 * params[2], d.sum(keepdims=True)]
            step += 1
            for i, g in enumerate(grads):
                m[i] += 0.1 * (g - m[i])
                v[i] += 0.001 * (g * g - v[i])
                params[i] -= RATE * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = *params[:3], float(params[3][0])
    if aside.any():
        s, own = net.logits(x[aside]), y[aside]
        loss = lambda c: np.logaddexp(0, np.where(own == 1, -s, s) / c).mean()
        net.temperature = float(min(np.geomspace(0.25, 8, 41), key=loss))
    return net


@dataclass
class Model:
    vectors: np.ndarray
    network: Network | None = None
    share: float = 1.0

    def score(self, data: np.ndarray, offsets: np.ndarray, index: np.ndarray) -> np.ndarray:
        if self.network is None:
            return np.full(len(offsets) - 1, self.share)
        return self.network(pooled(data, offsets, self.vectors, index))


def labelled(labels: DataFrame, name: str) -> DataFrame:
    """(doc_id, y) of the labels that may be learned from."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(name).isin(0, 1) & (F.crc32(F.col("doc_id").cast("string")) % 5 != 0))
    return usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(name).cast("int").alias("y"))


def fit(docs: DataFrame, labels: DataFrame, name: str = "quality", sample: int = SAMPLE) -> Model:
    model = Model(word_vectors(small_batches(docs)))
    chosen = F.broadcast(labelled(labels, name).orderBy(F.xxhash64("doc_id")).limit(sample))  # at most ``sample`` rows
    vectors = model.vectors

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_vectors()
        for batch in batches:
            for at, to, data, offsets in textnp.pieces(textnp.column(batch, "text")):
                x = [r.astype(np.float32).tobytes() for r in pooled(data, offsets, vectors, index)]
                yield pa.RecordBatch.from_arrays([textnp.column(batch, c).slice(at, to - at) for c in ("doc_id", "y")] + [pa.array(x, pa.binary())], ["doc_id", "y", "x"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(chosen, "doc_id")
    rows = sorted(found.transform(mapped, pool, "doc_id long, y int, x binary").collect(), key=lambda r: (textnp.mix(np.array([r.doc_id]).astype(np.uint64))[0], r.x))
    y = np.array([r.y for r in rows])
    if len(set(y)) == 2:
        model.network = train(np.stack([np.frombuffer(r.x, np.float32) for r in rows]).astype(float), y)
    elif len(y):
        model.share = float(y.mean())
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score), the probability of label 1."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_vectors()
        for batch in batches:
            for at, to, data, offsets in textnp.pieces(textnp.column(batch, "text")):
                yield pa.RecordBatch.from_arrays([textnp.column(batch, "doc_id").slice(at, to - at), pa.array(model.score(data, offsets, index))], ["doc_id", "score"])

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").transform(mapped, score, "doc_id long, score double")


def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = scored(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
