"""Toxicity by a noisy channel: disguised words are restored, then the restored text is scored.

1. A *character model*: counts of three characters in a row over all documents, gathered as a table of
   fixed size.
2. A *channel*: letters may be written as digits and signs (leetspeak), repeated, or set apart by spaces
   and marks. Where a text has such places, the writings stand in a lattice, and Viterbi finds its likeliest
   path under the character model. Elsewhere there is one path, the text itself.
3. A *score*: the evidence of restored words and of their beginnings, learned from labelled documents, and
   a logistic model of the strongest and the summed evidence of a document.

The model is fitted on a bounded sample of labelled rows (SAMPLE of each label, those of least hash); the
counts of characters and of labels are of all rows.

Nulls: a null or empty text has no evidence and gets the score of that. Labels that are null, repeated or
without a document don't count (of several, the largest). Without labels of both kinds every score is the
share of label 1, or 0. Rows with equal ids are scored each by its text. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textnp
from .common import mapped, rest_driver, small_batches, table

#: Labelled documents of each label for the fit.
SAMPLE = 2000
#: Kinds of bytes for the character model: 0 none of these, 1 to 26 letters, 27 bytes of other letters.
N = 28
KIND = np.zeros(256, np.int64)
KIND[97:123] = np.arange(1, 27)
KIND[65:91] = np.arange(1, 27)
KIND[128:] = 27
#: Letters that a digit or sign may stand for.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t"}
IS_LEET = np.zeros(256, bool)
IS_LEET[[ord(c) for c in LEET]] = True
#: Marks that may set letters apart, besides the space.
MARKS = ".-_*~"
IS_MARK = np.zeros(256, bool)
IS_MARK[[ord(c) for c in MARKS]] = True
#: Bytes of the beginnings of words that are evidence besides the whole word.
PREFIXES = (4, 5, 6)
#: Log odds, less their error, from which a word or beginning is evidence.
SURE = 1.0
#: Costs of the channel, in nats: a sign for a letter, a letter dropped from or left in a repeat, a break put into letters set apart.
SIGN, REPEAT, BREAK = 0.5, 0.5, 1.0


def character_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each three kinds of characters follow each other in a text and in the blanks about it."""
    total = np.zeros(N**3, np.int64)
    for batch in batches:
        for _, _, data, offsets in textnp.pieces(textnp.column(batch, "text")):
            kinds = np.zeros(len(data) + 2 * len(offsets), np.int64)
            kinds[np.arange(len(data)) + 2 * np.repeat(np.arange(1, len(offsets)), np.diff(offsets))] = KIND[data]
            total += np.bincount((kinds[:-2] * N + kinds[1:-1]) * N + kinds[2:], minlength=N**3)
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([found, total[found]], ["code", "n"])


def character_model(docs: DataFrame) -> np.ndarray:
    """log P(third | first two), from all documents."""
    counts = np.zeros(N**3)
    for r in docs.select("text").transform(mapped, character_counts, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect():
        counts[r.code] = r.n
    counts = counts.reshape(N, N, N) + 0.1
    return np.log(counts / counts.sum(axis=2, keepdims=True))


def _kind(c: str) -> int:
    return int(KIND[ord(c)]) if c < "\x80" else 27


def decode(nodes: list[list[tuple[str, float]]], model: np.ndarray) -> str:
    """The likeliest string through a lattice: each node offers (letters, cost), and a blank ends a word."""
    best = {(0, 0): (0.0, "")}
    for node in [*nodes, [(" ", 0.0)]]:
        step: dict = {}
        for (a, b), (score, said) in best.items():
            for letters, cost in node:
                x, y, s = a, b, score - cost
                for c in letters:
                    k = _kind(c)
                    s += model[x, y, k]
                    x, y = (y, k) if k else (0, 0)
                if (x, y) not in step or step[x, y][0] < s:
                    step[x, y] = (s, said + letters)
        best = step
    return max(best.values())[1].strip()


def lattice(word: str, apart: bool = False) -> list[list[tuple[str, float]]]:
    """The readings of a disguised word; ``apart``: its letters were set apart, so words may end within."""
    nodes, i = [], 0
    while i < len(word):
        c, j = word[i], i + 1
        while j < len(word) and word[j] == c:
            j += 1
        reads = [(x, SIGN) for x in LEET.get(c, "")] or ([(c, 0.0)] if c.isalpha() else [])
        if reads:
            if j - i > 1:
                reads = [(x * n, cost + REPEAT * (min(j - i, 3) - n)) for x, cost in reads for n in (1, 2)]
            if apart and nodes:
                reads += [(" " + x, cost + BREAK) for x, cost in reads]
            nodes.append(reads)
        i = j
    return nodes


def restored(word: str, apart: bool, model: np.ndarray, known: dict) -> str:
    """The readings of a disguised word, a blank between them.

    Letters that were set apart are read as one word, with and without the letters at its ends, which may be
    words of their own, and as the likeliest words.
    """
    key = (apart, word)
    if key not in known:
        if len(known) > 50_000:
            known.clear()
        reads = [(word, False), (word[1:], False), (word[:-1], False), (word, True)] if apart else [(word, False)]
        known[key] = " ".join(dict.fromkeys(decode(lattice(*r), model) for r in reads))
    return known[key]


def lowered(data: np.ndarray) -> np.ndarray:
    """Letters of ASCII and Latin-1 in lower case."""
    low = textnp.LOWER[data]
    after = np.zeros(len(data), bool)
    after[1:] = data[:-1] == 0xC3
    low[after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)] += 0x20
    return low


def disguised(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, str, bool]]:
    """(row, letters, whether they were set apart) of the places with several readings."""
    starts, ends, first = textnp.spans(~textnp.IS_SPACE[data], offsets)
    if not len(starts):
        return
    letter = KIND[data] > 0
    odd = np.zeros(len(data), bool)
    odd[1:] = (letter[1:] & IS_LEET[data[:-1]]) | (letter[:-1] & IS_LEET[data[1:]] & np.r_[letter[2:] | IS_LEET[data[2:]], False])
    odd[2:] |= (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & (KIND[data[2:]] > 0) & (KIND[data[2:]] < 27)
    odd[2:] |= letter[2:] & IS_MARK[data[1:-1]] & letter[:-2]
    where = np.searchsorted(starts, np.flatnonzero(odd), "right") - 1
    row_of = lambda k: int(np.searchsorted(first, k, "right")) - 1
    for k in np.unique(where):
        word = data[starts[k] : ends[k]].tobytes().decode("utf-8", "ignore").lower().strip(".,;:!?\"'()[]|")
        marks = sum(word.count(m) for m in MARKS)
        for part in [word.translate({ord(m): None for m in MARKS})] if 2 * marks >= len(word) - marks - 2 else word.translate({ord(m): " " for m in MARKS}).split():
            if len(part) > 1:
                yield row_of(k), part, 2 * marks >= len(word) - marks - 2
    # Single characters in a row, two and more.
    size = ends - starts
    single = ((size == 1) & (letter[starts] | IS_LEET[data[starts]])) | ((size == 2) & (data[starts] >= 0xC3))
    single = np.r_[False, single, False]
    edge = np.flatnonzero(single[1:] != single[:-1])
    for a, b in zip(edge[::2], edge[1::2]):
        for x, y in zip([a, *first[(first > a) & (first < b)]], [*first[(first > a) & (first < b)], b]):
            if y - x >= 2:
                text = data[starts[x] : ends[y - 1]].tobytes().decode("utf-8", "ignore").lower()
                yield row_of(x), "".join(text.split()), True


def features(data: np.ndarray, offsets: np.ndarray, model: np.ndarray, known: dict) -> tuple[np.ndarray, np.ndarray]:
    """(row, hashes) of the words of restored texts: a column for the whole word, then one for each beginning."""
    parts, rows = [], []
    for row, word, apart in disguised(data, offsets):
        for w in restored(word, apart, model, known).split():
            parts.append(w.encode())
            rows.append(row)
    more = np.frombuffer(b" ".join(parts), np.uint8)
    low = lowered(np.concatenate([data, more]))
    edges = np.r_[offsets, len(low)] if len(more) else offsets
    starts, ends, first = textnp.spans(KIND[low] > 0, edges)
    row = np.repeat(np.arange(len(edges) - 1), np.diff(first))
    row[row == len(offsets) - 1] = rows
    if not len(starts):
        return row, np.zeros((0, 1 + len(PREFIXES)), np.uint64)
    size = ends - starts
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    value = textnp.BYTE[low[at + np.repeat(starts, size)]]
    value *= textnp.powers(int(size.max()))[at]
    sums = np.zeros(len(value) + 1, np.uint64)
    np.cumsum(value, out=sums[1:])
    begin = np.cumsum(size) - size
    out = [textnp.mix(sums[begin + size] - sums[begin])]
    for k in PREFIXES:  # words shorter than any beginning have themselves alone
        start = textnp.mix(sums[begin + np.minimum(size, k)] - sums[begin] + np.uint64(k))
        out.append(np.where(size >= PREFIXES[0], start, out[0]))
    return row, np.stack(out, axis=1)


@dataclass
class Model:
    """Evidence by hash, in order of the hashes, and the weights of a document's measures."""

    characters: np.ndarray
    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    evidence: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray | None = None
    share: float = 0.0

    def measures(self, row: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
        """For each of n texts: 1, the strongest evidence, the log of the summed evidence, the log of its words."""
        out = np.zeros((n, 4))
        out[:, 0] = 1
        out[:, 3] = np.log1p(np.bincount(row, minlength=n)) / 8
        if not len(row) or not len(self.hashes):
            return out
        bits = np.zeros(1 << 20, bool)
        bits[(self.hashes & np.uint64(0xFFFFF)).astype(np.int64)] = True
        maybe = np.flatnonzero(bits[(hashes & np.uint64(0xFFFFF)).astype(np.int64)].any(axis=1))
        at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
        found = np.where(self.hashes[at] == hashes[maybe], self.evidence[at], 0).max(axis=1)
        words = np.unique(np.stack([row[maybe].astype(np.uint64), hashes[maybe, 0]]), axis=1, return_index=True)[1]
        each, own = found[words], row[maybe][words]
        np.maximum.at(out[:, 1], own, each)
        out[:, 2] = np.log1p(np.bincount(own, each, minlength=n))
        return out

    def score(self, row: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
        if self.weights is None:
            return np.full(n, self.share)
        return 1 / (1 + np.exp(-np.clip(self.measures(row, hashes, n) @ self.weights, -30, 30)))


def fit_evidence(docs: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes that speak for label 1, and how surely: the log of the odds less its error."""
    found, n = [], []
    for label in (1, 0):
        own = [np.unique(d) for d, y in zip(docs, labels) if y == label]
        h, c = np.unique(np.concatenate(own) if own else np.zeros(0, np.uint64), return_counts=True)
        found.append((h, c))
        n.append(len(own))
    hashes, ones = found[0]
    hashes, ones = hashes[ones > 1], ones[ones > 1]
    zeros = np.zeros(len(hashes))
    if len(found[1][0]):
        at = np.minimum(np.searchsorted(found[1][0], hashes), len(found[1][0]) - 1)
        zeros = np.where(found[1][0][at] == hashes, found[1][1][at], 0)
    odds = np.log((ones + 0.5) / (n[0] + 1)) - np.log((zeros + 0.5) / (n[1] + 1))
    sure = odds - 1.64 * np.sqrt(1 / (ones + 0.5) + 1 / (zeros + 0.5))
    good = sure > SURE
    return hashes[good], sure[good]


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights by Newton's method, held back a little towards 0."""
    w = np.zeros(x.shape[1])
    hold = np.diag([1e-3] + [0.05] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + hold, x.T @ (weight * (y - p)) - hold @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def labelled(labels: DataFrame, name: str) -> DataFrame:
    """(doc_id, y) of the labels that may be learned from."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(name).isin(0, 1) & (F.crc32(F.col("doc_id").cast("string")) % 5 != 0))
    return usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(name).cast("int").alias("y"))


def fit(docs: DataFrame, labels: DataFrame, name: str = "toxic", sample: int = SAMPLE) -> Model:
    model = Model(character_model(small_batches(docs)))
    rest_driver(docs.sparkSession)
    every = labelled(labels, name)
    counts = {r.y: r.n for r in every.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not counts.get(0) or not counts.get(1):
        model.share = float(bool(counts.get(1)))
        return model
    own = [every.where(F.col("y") == y).orderBy(F.xxhash64("doc_id")).limit(sample) for y in (0, 1)]
    chosen = F.broadcast(own[0].unionByName(own[1]))  # at most 2 * sample rows
    characters = model.characters

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            for at, to, data, offsets in textnp.pieces(textnp.column(batch, "text")):
                row, hashes = features(data, offsets, characters, known)
                own = [hashes[row == i] for i in range(to - at)]
                each = [h[np.unique(h[:, 0], return_index=True)[1]].tobytes() for h in own]
                yield pa.RecordBatch.from_arrays([textnp.column(batch, "doc_id").slice(at, to - at), textnp.column(batch, "y").slice(at, to - at), pa.array(map(len, own), pa.int64()), pa.array(each, pa.binary())], ["doc_id", "y", "n", "h"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(chosen, "doc_id")
    rows = found.transform(mapped, hashed, "doc_id long, y int, n long, h binary").orderBy("doc_id").collect()
    y = np.array([r.y for r in rows])
    if len(set(y)) < 2:
        model.share = float(np.mean(y)) if len(y) else 0.0
        return model
    each = [np.frombuffer(r.h, np.uint64).reshape(-1, 1 + len(PREFIXES)) for r in rows]
    flat = [e.ravel() for e in each]
    # Measures of a document come from the evidence of the other part, so that they are as those of new texts.
    part = np.array([hash_part(r.doc_id) for r in rows])
    x = np.zeros((len(rows), 4))
    for k in (0, 1):
        model.hashes, model.evidence = fit_evidence([f for f, p in zip(flat, part) if p != k], y[part != k])
        for i in np.flatnonzero(part == k):
            x[i] = model.measures(np.zeros(len(each[i]), np.int64), each[i], 1)[0]
            x[i, 3] = np.log1p(rows[i].n) / 8
    weight = np.array([counts[0] / max(1, (y == 0).sum()), counts[1] / max(1, (y == 1).sum())])[y]
    model.weights = fit_logistic(x, y, weight)
    model.hashes, model.evidence = fit_evidence(flat, y)
    del rows, each, flat
    rest_driver(docs.sparkSession)
    return model


def hash_part(doc_id: int) -> int:
    return int(textnp.mix(np.array([doc_id]).astype(np.uint64))[0] >> np.uint64(63))


def scored(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with a score of 0 to 1 as the column ``name``, which it mustn't have yet."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for at, to, data, offsets in textnp.pieces(textnp.column(batch, "text")):
                out[at:to] = model.score(*features(data, offsets, model.characters, known), to - at)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], [*batch.schema.names, name])

    return small_batches(docs).transform(mapped, score, schema)



def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = scored(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
