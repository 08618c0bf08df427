"""Repeated byte strings: names of growing length at positions, until they are unique or past the threshold.

A byte goes if a string of ``length`` bytes over it also starts anywhere else, in the same document too.

``doubled`` is prefix doubling as it is known: every position has the rank of the h bytes from it; Spark joins the ranks h
apart to pairs, sorts the pairs and numbers them anew, and positions whose pair is unique leave, until h reaches ``length``.
It moves each position several times, far more than the text (README has the figures), so the query uses ``removed``, which
gives the same rows **by another method**: content hashes of growing length, at few positions first, in place of ranks:

1. *Names of GRAM bytes at anchors.* The anchor of the string at p is the leftmost gram of least hash in
   it, which depends on the string alone: equal strings have equal anchors at equal places. All strings
   with one anchor are a run, a row of its own. Runs whose anchor's name is unique are dropped.
2. *Names of whole runs*: all bytes of all strings of a run. A run that occurs twice is repeated
   throughout. What is left are runs at the edges of repeats.
3. *Longer names for those* and for one copy of each repeated run with such an anchor. They are parted
   into blocks of BLOCK strings, counted from the anchor. The name of the bytes that all strings of a block
   share drops blocks in which nothing is repeated, the name of the whole block settles those repeated
   throughout, and in the few left each string of ``length`` bytes gets its name.

Names that decide have 64 bits within a name of 64 bits of a shorter part, or twice 64 bits. They are polynomials modulo 2**64,
so that equal names mean equal bytes but for chance, and for texts that are made to collide.

Besides, ``has_passage`` tells rows that share a passage of over 50 words with another row, which is often of fewer than
``length`` bytes and then removes nothing.

Nulls: a null text is empty. Texts of under ``length`` bytes lose nothing. Repeated rows count as
occurrences of each other, also with equal or null doc_id; each row is returned. Other columns are ignored. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textnp
from .common import WRITTEN, done_with, mapped, settled, small_batches, table, written

LENGTH, GRAM, BLOCK = 400, 128, 32
#: A passage is so many words; what is compared of it are grams of so many, one of which every passage holds.
PASSAGE, PRINT = 51, 36
#: Words that are searched for prints at a time.
WORDS = 1 << 20
#: Bits for the place of a gram within a piece, so a piece of a long text has at most half as many bytes.
PLACE_BITS = 24
#: Bytes of text hashed at a time.
PIECE = 1 << 19
MULT2 = np.uint64(0xD1342543DE82EF95)

RUNS = pa.schema([("gram", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("doc_id", pa.int64()), ("dk", pa.int64()), ("p0", pa.int64()), ("n", pa.int32()), ("ahead", pa.int32()), ("times", pa.int32()), ("all", pa.int64())])
RUNS_DDL = "gram long, c1 long, c2 long, doc_id long, dk long, p0 long, n int, ahead int, times int, all long"
RESULT = "doc_id long, dk long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


class Rolling:
    """Hashes of any substrings of ``data``, from sums of prefixes modulo 2**64."""

    def __init__(self, data: np.ndarray, mult: np.uint64 = textnp.MULT):
        n = len(data) + 1
        self.up = textnp.powers(n, mult)
        value = textnp.BYTE[data]
        value *= textnp.powers(n, np.uint64(pow(int(mult), -1, 2**64)))[:-1]
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(value, out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = self.sums[ends] - self.sums[starts]
        out *= self.up[starts]
        return textnp.mix(out)

    def every(self, length: int) -> np.ndarray:
        """The hash of ``length`` bytes at each position where they fit."""
        out = self.sums[length:] - self.sums[:-length]
        out *= self.up[: len(out)]
        return textnp.mix(out)


def least_in_window(x: np.ndarray, width: int) -> np.ndarray:
    """min(x[i : i + width]) at each i where the window fits."""
    blocks = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[: len(x)] = x
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(x) - width + 1
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, length: int, gram: int) -> tuple[Rolling, np.ndarray, np.ndarray]:
    """Hashes of ``data``, the names of its grams, and the anchor of the string at each position.

    Bytes of several documents may stand together: the caller drops strings that cross their borders.
    """
    first = Rolling(data)
    names = first.every(gram)
    low = np.uint64((1 << PLACE_BITS) - 1)
    keyed = (names & ~low) | np.arange(len(names), dtype=np.uint64)
    anchor = (least_in_window(keyed, length - gram + 1) & low).astype(np.int64)
    return first, names, anchor


def _segments(batch: pa.RecordBatch, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(bytes, offsets, rows, base): runs of documents, or a part of a long one that starts at ``base``."""
    most = 1 << (PLACE_BITS - 1)
    for at, to, data, offsets in textnp.pieces(textnp.column(batch, "text"), PIECE):
        if len(data) <= most:
            yield data, offsets, np.arange(at, to), 0
        else:
            step = most - length
            for base in range(0, len(data), step):
                part = data[base : base + step + length - 1]
                yield part, np.array([0, len(part)]), np.array([at]), base


def anchored_runs(batches: Iterator[pa.RecordBatch], length: int = LENGTH, gram: int = GRAM) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc_id, dk = textnp.column(batch, "doc_id"), textnp.column(batch, "dk")
        for data, offsets, rows, base in _segments(batch, length):
            if len(data) < length:
                continue
            first, names, anchor = anchors(data, length, gram)
            second = Rolling(data, MULT2)
            inside = np.zeros(len(anchor), bool)
            for s, e in zip(offsets[:-1], offsets[1:]):
                if e - s >= length:
                    inside[s : e - length + 1] = True
            p = np.flatnonzero(inside)
            if not len(p):
                continue
            a = anchor[p]
            new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (p[1:] != p[:-1] + 1)])
            p0, n, a = p[new], np.diff(np.r_[new, len(p)]), a[new]
            end = p0 + n - 1 + length
            shape = (a - p0).astype(np.uint64) * np.uint64(length) + n.astype(np.uint64)
            c1, c2 = first(p0, end) ^ textnp.mix(shape.copy()), second(p0, end) + shape
            doc = np.searchsorted(offsets, p0, "right") - 1
            # Equal runs one after the other, as in texts with a period, are one row.
            other = np.flatnonzero(np.r_[True, (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1]) | (doc[1:] != doc[:-1])])
            times, whole = np.diff(np.r_[other, len(p0)]), np.add.reduceat(n, other)
            p0, n, a, c1, c2, doc = (x[other] for x in (p0, n, a, c1, c2, doc))
            row = pa.array(rows[doc])
            yield pa.RecordBatch.from_arrays([names[a].view(np.int64), c1.view(np.int64), c2.view(np.int64), doc_id.take(row), dk.take(row), p0 + base - offsets[doc], n.astype(np.int32), (a - p0).astype(np.int32), times.astype(np.int32), whole], schema=RUNS)


def _merge(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs of the union; starts ascend."""
    if not len(starts):
        return starts, ends
    most = np.maximum.accumulate(ends)
    new = np.flatnonzero(np.r_[True, starts[1:] > most[:-1]])
    return starts[new], most[np.r_[new[1:] - 1, len(starts) - 1]]


def cut(text: bytes, windows: list[tuple[int, int]], length: int) -> tuple[int, int, int, str]:
    """(n_bytes, n_removed, n_spans, kept_sha256) where strings start at p0 .. p0 + n - 1 for each (p0, n)."""
    pairs = np.array(sorted(windows), np.int64).reshape(-1, 2)
    starts, ends = _merge(pairs[:, 0], pairs[:, 0] + pairs[:, 1] - 1 + length)
    kept, at = hashlib.sha256(), 0
    for s, e in zip(starts.tolist(), ends.tolist()):
        kept.update(text[at:s])
        at = e
    kept.update(text[at:])
    return len(text), int((ends - starts).sum()), len(starts), kept.hexdigest()


FULL, HARD, PARTNER = 0, 1, 2
#: Rows of the second pass: a result, a block to be named, or a document that waits for its blocks.
SECOND = "step int, " + RESULT + ", text binary, done array<struct<p0: long, n: long>>, hard boolean, p0 long, n int, core long, w1 long, w2 long, names binary"
_SECOND = pa.schema([
    ("step", pa.int32()), ("doc_id", pa.int64()), ("dk", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
    ("text", pa.binary()), ("done", pa.list_(pa.struct([("p0", pa.int64()), ("n", pa.int64())]))),
    ("hard", pa.bool_()), ("p0", pa.int64()), ("n", pa.int32()), ("core", pa.int64()), ("w1", pa.int64()), ("w2", pa.int64()), ("names", pa.binary()),
])


def _rows(size: int, /, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in _SECOND], schema=_SECOND)


def blocks(text: bytes, runs: list[dict], length: int) -> dict:
    """The blocks of strings of ``runs``, with the names of what they share, of the whole and of each string."""
    p = np.concatenate([np.arange(r["p0"], r["p0"] + r["n"]) for r in runs])
    n = [r["n"] for r in runs]
    anchor = np.repeat([r["p0"] + r["ahead"] for r in runs], n)
    hard = np.repeat([r["kind"] == HARD for r in runs], n)
    block = (anchor - p) // BLOCK
    new = np.flatnonzero(np.r_[True, (block[1:] != block[:-1]) | (anchor[1:] != anchor[:-1])])
    size = np.diff(np.r_[new, len(p)])
    data = np.frombuffer(text, np.uint8)
    first, second = Rolling(data), Rolling(data, MULT2)
    names = first(p, p + length)
    start, end = p[new], p[new] + size - 1 + length
    core = anchor[new] - block[new] * BLOCK
    shape = (anchor[new] - start).astype(np.uint64) * np.uint64(length) + size.astype(np.uint64)
    w1, w2 = first(start, end) ^ textnp.mix(shape.copy()), second(start, end) + shape
    return {
        "hard": hard[new], "p0": start, "n": size.astype(np.int32), "core": first(core, core - BLOCK + 1 + length).view(np.int64),
        "w1": w1.view(np.int64), "w2": w2.view(np.int64), "names": [names[i : i + k].tobytes() for i, k in zip(new, size)],
    }


def _second_pass(length: int):
    def pass_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {k: [] for k in ("doc_id", "dk", "n_bytes", "n_removed", "n_spans", "kept_sha256")}
            for doc_id, dk, text, runs in zip(*(textnp.column(batch, c) for c in ("doc_id", "dk", "text", "runs"))):
                doc_id, dk, text, runs = doc_id.as_py(), dk.as_py(), text.as_py().encode(), runs.as_py() or []
                done = [(r["p0"], r["all"]) for r in runs if r["kind"] != HARD]
                if named := [r for r in runs if r["kind"] != FULL]:
                    own = blocks(text, named, length)
                    n = len(own["n"])
                    yield _rows(n, step=np.full(n, 1, np.int32), doc_id=[doc_id] * n, dk=[dk] * n, **own)
                if any(r["kind"] == HARD for r in runs):
                    yield _rows(1, step=[2], doc_id=[doc_id], dk=[dk], text=[text], done=[[{"p0": a, "n": n} for a, n in done]])
                else:
                    for k, v in zip(out, (doc_id, dk, *cut(text, done, length))):
                        out[k].append(v)
            n = len(out["doc_id"])
            yield _rows(n, step=np.zeros(n, np.int32), **out)

    return pass_


def each_string(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The strings of blocks, a row for each: (doc_id, dk, hard, p, core, name)."""
    for batch in batches:
        size = textnp.column(batch, "n").to_numpy()
        row = np.repeat(np.arange(batch.num_rows), size)
        p = np.repeat(textnp.column(batch, "p0").to_numpy(), size) + np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        names = np.frombuffer(b"".join(textnp.column(batch, "names").to_pylist()), np.int64)
        own = [textnp.column(batch, c).take(pa.array(row)) for c in ("doc_id", "dk", "hard", "core")]
        yield pa.RecordBatch.from_arrays([*own, pa.array(p, pa.int64()), pa.array(names)], ["doc_id", "dk", "hard", "core", "p", "name"])


def _last_pass(length: int):
    schema = pa.schema([("doc_id", pa.int64()), ("dk", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def pass_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, dk, text, done, found in zip(*(textnp.column(batch, c) for c in ("doc_id", "dk", "text", "done", "found"))):
                windows = [(d["p0"], d["n"]) for d in [*(done.as_py() or []), *(found.as_py() or [])]]
                out.append(dict(zip(schema.names, (doc_id.as_py(), dk.as_py(), *cut(text.as_py(), windows, length)))))
            yield pa.RecordBatch.from_pylist(out, schema)

    return pass_


def passage_prints(batches: Iterator[pa.RecordBatch], passage: int, print_: int) -> Iterator[pa.RecordBatch]:
    """(print, key): of each ``passage`` words in a row of a row's text the least hash of ``print_`` words in a row."""
    width = passage - print_ + 1
    low = np.uint64((1 << PLACE_BITS) - 1)
    with np.errstate(over="ignore"):
        for batch in batches:
            for at, to, data, offsets in textnp.pieces(textnp.column(batch, "text"), PIECE):
                starts, ends, first = textnp.spans(~textnp.IS_SPACE[data], offsets)
                every, row = textnp.span_sums(data, starts, ends), np.repeat(np.arange(to - at), np.diff(first))
                found, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
                for base in range(0, len(every) - passage + 1, WORDS):
                    words, own = every[base : base + WORDS + passage - 1], row[base : base + WORDS + passage - 1]
                    sums = np.zeros(len(words) + 1, np.uint64)
                    np.cumsum(words * textnp.powers(len(words), textnp.MULT_INV), out=sums[1:])
                    grams = textnp.mix((sums[print_:] - sums[:-print_]) * textnp.powers(len(words) - print_ + 1))
                    keyed = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
                    least = (least_in_window(keyed, width) & low).astype(np.int64)
                    p = np.unique(least[own[: len(least)] == own[passage - 1 :]])
                    found.append(grams[p])
                    rows.append(own[p])
                # Once for each row of the table, so that what is there twice is in two rows.
                prints, rows = np.unique(np.stack([np.concatenate(found), np.concatenate(rows).astype(np.uint64)]), axis=1)
                key = textnp.column(batch, "key").take(pa.array(rows.astype(np.int64) + at))
                yield pa.RecordBatch.from_arrays([pa.array(prints.view(np.int64)), key], ["print", "key"])


def with_passages(docs: DataFrame, passage: int = PASSAGE, print_: int = PRINT) -> DataFrame:
    """The keys (column ``key``) of the rows of ``docs`` that share a passage with another row.

    Every passage of ``passage`` words that two rows share is found, and none of under ``print_`` words.
    """
    prints = written(docs.select("key", "text").transform(mapped, lambda b: passage_prints(b, passage, print_), "print long, key long"))
    several = written(prints.groupBy("print").count().where("count > 1").select("print"), True)
    keys = written(prints.join(several, "print").select("key").distinct(), True)
    done_with(prints, several)
    return keys


def removed(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, has_passage.

    ``has_passage``: whether the row shares a passage of PASSAGE words with another (it may be one of PRINT words already),
    whatever the bytes of it: such a passage is reported and loses bytes only where ``length`` bytes repeat.
    """
    before = len(WRITTEN)
    docs = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("dk", F.xxhash64("text"))
    passages = with_passages(docs.withColumn("key", F.xxhash64("doc_id", "dk"))).withColumn("has_passage", F.lit(True))
    every = written(docs.transform(mapped, lambda b: anchored_runs(b, length, gram), RUNS_DDL))

    # Names of grams, then of runs. A hot name has many rows, so it is counted, and the counts written, before they are joined.
    again = written(every.groupBy("gram").agg(F.sum("times").alias("times")).where("times > 1").select("gram"), True)
    runs = written(every.join(again, "gram"))
    done_with(every, again)
    counted = runs.groupBy("gram", "c1", "c2").agg(F.sum("times").alias("times"), F.min(F.struct("doc_id", "dk", "p0")).alias("copy"))
    counted = written(counted, True)
    edges = written(counted.groupBy("gram").agg((F.min("times") == 1).alias("edge")), True)
    whole = written(counted.join(edges, "gram"), True)
    mine = F.struct("doc_id", "dk", "p0").eqNullSafe(F.col("copy"))
    kind = F.when(F.col("times") == 1, HARD).when(F.col("edge") & mine, PARTNER).otherwise(FULL)
    # Copies that share an id have the same runs, which are theirs once.
    by_doc = runs.drop("times").join(whole, ["gram", "c1", "c2"]).select("doc_id", "dk", F.struct("p0", "n", "ahead", "all", kind.alias("kind")).alias("run")).groupBy("doc_id", "dk").agg(F.collect_set("run").alias("runs"))

    null_safe = lambda a, b: a.doc_id.eqNullSafe(b.doc_id) & (a.dk == b.dk)
    second = docs.join(by_doc, null_safe(docs, by_doc), "left").select(docs.doc_id, docs.dk, "text", "runs")
    second = written(second.transform(mapped, _second_pass(length), SECOND))
    done_with(runs, counted, edges, whole)

    # Names of blocks, then of single strings.
    every = second.where("step = 1").select("doc_id", "dk", "hard", "p0", "n", "core", "w1", "w2", "names")
    again = written(every.groupBy("core").agg(F.count("*").alias("count"), F.max("hard").alias("any_hard")).where("count > 1 AND any_hard").select("core"), True)
    some = written(every.join(again, "core"))
    counted = written(some.groupBy("core", "w1", "w2").agg(F.count("*").alias("times"), F.min(F.struct("doc_id", "dk", "p0")).alias("copy")), True)
    parts = written(some.join(counted, ["core", "w1", "w2"]))
    done_with(again, some, counted)
    sure = parts.where("hard AND times > 1").select("doc_id", "dk", "p0", "n")
    rest = parts.where((F.col("times") == 1) | F.struct("doc_id", "dk", "p0").eqNullSafe(F.col("copy"))).select("doc_id", "dk", (F.col("hard") & (F.col("times") == 1)).alias("hard"), "p0", "n", "core", "names")
    strings = written(rest.transform(mapped, each_string, "doc_id long, dk long, hard boolean, core long, p long, name long"))
    again = written(strings.groupBy("core", "name").count().where("count > 1").select("core", "name"), True)
    found = strings.where("hard").join(again, ["core", "name"]).select("doc_id", "dk", F.col("p").alias("p0"), F.lit(1).alias("n"))
    found = sure.unionByName(found).groupBy("doc_id", "dk").agg(F.collect_set(F.struct("p0", "n")).alias("found"))
    waiting = second.where("step = 2").select("doc_id", "dk", "text", "done")
    last = waiting.join(found, null_safe(waiting, found), "left").select(waiting.doc_id, waiting.dk, "text", "done", "found").transform(mapped, _last_pass(length), RESULT)
    out = second.where("step = 0").select("doc_id", "dk", "n_bytes", "n_removed", "n_spans", "kept_sha256").unionByName(last)
    out = out.withColumn("key", F.xxhash64("doc_id", "dk")).join(passages, "key", "left")
    return settled(out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.coalesce("has_passage", F.lit(False)).alias("has_passage")), before)


def position_names(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """(row, p, rank): the name of the ``size`` bytes at each position where they fit."""
    for batch in batches:
        for at, to, data, offsets in textnp.pieces(textnp.column(batch, "text"), PIECE):
            if len(data) < size:
                continue
            names = Rolling(data).every(size)
            row = np.repeat(np.arange(to - at), np.diff(offsets))[: len(names)]
            p = np.arange(len(names)) - offsets[row]
            fits = p + size <= np.diff(offsets)[row]
            yield pa.RecordBatch.from_arrays([textnp.column(batch, "row").take(pa.array(row[fits] + at)), pa.array(p[fits]), pa.array(names[fits].view(np.int64))], ["row", "p", "rank"])


def doubled(docs: DataFrame, length: int = LENGTH, first: int = 100) -> DataFrame:
    """As ``removed``, without passages, by prefix doubling from names of ``first`` bytes at all positions."""
    before = len(WRITTEN)
    docs = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = written(docs.select(F.monotonically_increasing_id().alias("row"), "*"))
    ranks = written(docs.select("row", "text").transform(mapped, lambda b: position_names(b, first), "row long, p long, rank long"))
    same = written(ranks.groupBy("rank").count().where("count > 1").select("rank"))
    now, h = written(ranks.join(same, "rank").select("row", "p", "rank")), first
    done_with(ranks, same)
    while h < length:
        step = min(h, length - h)
        # A position whose partner has left has a unique string itself.
        pairs = written(now.join(now.select("row", (F.col("p") - step).alias("p"), F.col("rank").alias("second")), ["row", "p"]))
        several = pairs.groupBy("rank", "second").count().where("count > 1").select("rank", "second")
        # Sorted pairs, numbered in their order.
        numbered = written(written(several.repartitionByRange("rank", "second").sortWithinPartitions("rank", "second")).withColumn("new", F.monotonically_increasing_id()))
        now, old = written(pairs.join(numbered, ["rank", "second"]).select("row", "p", F.col("new").alias("rank"))), now
        done_with(old, pairs)
        h += step
    # Starts of repeated strings as runs, then the cut texts.
    apart = Window.partitionBy("row").orderBy("p")
    starts = now.withColumn("island", F.col("p") - F.row_number().over(apart)).groupBy("row", "island").agg(F.min("p").alias("p0"), F.count("*").alias("n"))
    found = starts.groupBy("row").agg(F.collect_list(F.struct("p0", "n")).alias("found"))
    cuts = docs.join(found, "row", "left").select("doc_id", F.lit(0).cast("long").alias("dk"), F.encode("text", "utf-8").alias("text"), F.lit(None).cast("array<struct<p0: long, n: long>>").alias("done"), "found")
    return settled(cuts.transform(mapped, _last_pass(length), RESULT).drop("dk"), before)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed(table(spark, sf_dir, "documents"))
