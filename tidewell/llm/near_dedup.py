"""Near duplicates by bottom-k sketches from one hash function.

A document's set holds its distinct shingles; the K least hashes of it are its sketch. Documents with
equal sets are one class, represented by its least id. Between classes:

1. *Inverted lists.* Retained values fall into K buckets by other bits of their hash, and the values of a
   bucket that holds two or more are a list's key: single values are shared by chance too often. Sets of
   similarity 0.8 share some 11 of 17 such keys, and none in one of 10**8 pairs. A set of at most
   K / similarity shingles has its rarest values as keys besides, as many as any linked set must meet.
2. *Links.* In rounds, each list has PIVOTS of its members, and each member is held against that pivot of its
   lists which its digest is most like and it hasn't met, until that finds few links. Members of a component need
   no more links, so a list whose members are in one component is done, and a group of near copies of any size
   makes one pair for each copy and round. Then the members of lists that are still in
   several components are compared in full: under one order of their values, the rarest first, two linked sets share one of their
   first n - ceil(0.8 n) + 1 values, and have enough left behind the first that they share. Only sets that
   meet so are pairs, and of these only those whose bitmaps differ in no more bits than linked sets may differ in values,
   so near copies that differ too much make few or none, and no link is lost.
3. A pair is held against the other by size, by a 256-bit digest of both sketches (which loses a linked pair in
   10**9 at most), by the estimate from the sketch of their union, and at last by the full sets.

Nulls: a null or blank text has an empty set, linked with nothing; so has a row with a null doc_id.
Rows with equal doc_id are one node: they share a component, whatever their texts, and each row is
returned. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, reduce
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textnp
from .common import WRITTEN, apart_by_bits, bucketed, done_with, mapped, rest_driver, settled, small_batches, table, written
from .graph import components

K = 64
DIGEST = ("d0", "d1", "d2", "d3")


@dataclass(frozen=True)
class Settings:
    """Shingles of ``width`` words; linked where 100 * intersection >= ``percent`` * union."""

    width: int = 5
    percent: int = 80
    k: int = K

    @property
    def fewest(self) -> int:
        """Of K retained values of a union, those in both sets of a linked pair, less six deviations."""
        t = self.percent / 100
        return max(1, int(self.k * t - 6.5 * (self.k * t * (1 - t)) ** 0.5))


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted distinct 63-bit hashes of each text's shingles; fewer words than ``width`` are one."""
    starts, ends, first = textnp.spans(~textnp.IS_SPACE[data], offsets)
    words = textnp.span_hashes(textnp.LOWER[data], starts, ends)
    rolled = words.copy()
    for i in range(1, width):
        rolled = rolled[: len(words) - i] * textnp.MULT + words[i:] if len(words) > i else rolled[:0]
    rolled = textnp.mix(rolled) >> np.uint64(1)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:  # the whole sequence, told apart by its length
            h = np.uint64(b - a)
            for w in words[a:b]:
                h = h * textnp.MULT + w
            out.append(textnp.mix(np.array([h])) >> np.uint64(1))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


SKETCH_DDL = "doc_id long, n long, s1 long, s2 long, keys array<long>, small array<long>, d0 long, d1 long, d2 long, d3 long"
_SKETCH = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("keys", pa.list_(pa.int64())), ("small", pa.list_(pa.int64())), *((d, pa.int64()) for d in DIGEST)])


def bucket_keys(sketch: np.ndarray, k: int) -> np.ndarray:
    """A hash of the values of each bucket that holds two or more."""
    bucket = (textnp.mix(sketch.copy()) % np.uint64(k)).astype(np.int64)
    count = np.bincount(bucket, minlength=k)
    sums = np.zeros(k, np.uint64)
    np.add.at(sums, bucket, textnp.mix(sketch * textnp.MULT))
    full = np.flatnonzero(count > 1)
    return textnp.mix(sums[full] + full.astype(np.uint64)).view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int64), pa.int64()))


def sketches(batches: Iterator[pa.RecordBatch], width: int, k: int, exact: int) -> Iterator[pa.RecordBatch]:
    """Of each document the size and a hash of its set, and of its sketch the keys and a digest; of a set of at most ``exact`` all values."""
    none = np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        for batch in batches:
            ids = textnp.column(batch, "doc_id")
            for at, to, data, offsets in textnp.pieces(textnp.column(batch, "text")):
                sets = shingle_hashes(data, offsets, width)
                n = np.array([len(s) for s in sets])
                s1 = np.array([textnp.mix(s.copy()).sum(dtype=np.uint64) for s in sets], np.uint64)
                s2 = np.array([textnp.mix(s * textnp.MULT).sum(dtype=np.uint64) for s in sets], np.uint64)
                bits = np.zeros((len(sets), 4), np.uint64)
                for i, s in enumerate(sets):
                    np.bitwise_or.at(bits[i], ((s[:k] >> np.uint64(6)) & np.uint64(3)).astype(np.int64), np.uint64(1) << (s[:k] & np.uint64(63)))
                keys = _lists([bucket_keys(s[:k], k) if len(s) > k else none for s in sets])
                small = _lists([s.view(np.int64) if len(s) <= exact else none for s in sets])
                yield pa.RecordBatch.from_arrays([ids.slice(at, to - at), n, s1.view(np.int64), s2.view(np.int64), keys, small, *(bits[:, i].copy().view(np.int64) for i in range(4))], schema=_SKETCH)


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) with compressed texts, which then travel at half the size."""
    import zstandard

    compress = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        texts = [compress((t.as_py() or "").encode()) for t in textnp.column(batch, "text")]
        yield pa.RecordBatch.from_arrays([textnp.column(batch, "doc_id"), pa.array(texts, pa.binary())], ["doc_id", "z"])


def sets_of(texts: list[bytes], settings: Settings) -> list[np.ndarray]:
    """The sets of packed texts."""
    import zstandard

    plain = zstandard.ZstdDecompressor().decompress
    data, offsets = textnp.text_bytes(pa.array([plain(t) for t in texts], pa.large_binary()))
    with np.errstate(over="ignore"):
        return shingle_hashes(data, offsets, settings.width)


def verifier(settings: Settings):
    """Pairs (a, b, ca, cb, za, zb) to (a, b, ca, cb) of the linked: by the union's sketch, then by the full sets."""
    columns = ("a", "b", "ca", "cb")

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, last = [], (None, None)
            for i, (za, zb) in enumerate(zip(textnp.column(batch, "za"), textnp.column(batch, "zb"))):
                if last[0] != (za := za.as_py()):
                    last = (za, sets_of([za], settings)[0])
                s, t = last[1], sets_of([zb.as_py()], settings)[0]
                union = np.union1d(s[: settings.k], t[: settings.k])[: settings.k]
                both = np.isin(union, s[: settings.k], assume_unique=True) & np.isin(union, t[: settings.k], assume_unique=True)
                if both.sum() < min(settings.fewest, len(union) * settings.percent / 100):
                    continue
                shared = len(np.intersect1d(s, t, assume_unique=True))
                if 100 * shared >= settings.percent * (len(s) + len(t) - shared):
                    found.append(i)
            yield pa.RecordBatch.from_arrays([textnp.column(batch, c).take(pa.array(found, pa.int64())) for c in columns], list(columns))

    return links


ROW = ["rep", "n", *DIGEST]


#: The share of linked pairs that the digests may lose, at most.
LOST = 1e-9


@cache
def fewest_bits(settings: Settings) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """The least numbers of digest bits that a linked pair's shared values occupy, but for a share LOST of the pairs.

    The first for 0 to K shared values of sets that are their own sketches; the second for sketches of larger sets,
    by the hundredths of the smaller size over the larger from ``percent`` on: of K values each is shared with the same chance.
    """
    k, r = settings.k, settings.percent / (100 + settings.percent)
    occupied = np.zeros((k + 1, k + 2))  # by values, by the bits that they take
    occupied[0, 0] = 1.0
    taken = np.arange(k + 2) / (64 * len(DIGEST))
    for v in range(k):
        occupied[v + 1] = occupied[v] * taken + np.r_[0.0, (occupied[v] * (1 - taken))[:-1]]
    least = lambda chance: int(np.searchsorted(np.cumsum(chance), LOST, "right"))
    large = []
    for q in range(settings.percent, 101):
        p = r * (1 + q / 100)
        large.append(least(np.array([comb(k, v) * p**v * (1 - p) ** (k - v) for v in range(k + 1)]) @ occupied))
    return tuple(map(least, occupied)), tuple(large)


def _alike(settings: Settings, x: str, y: str) -> Column:
    """Whether sizes and digests of the aliases allow a link."""
    low, high = f"least({x}.n, {y}.n)", f"greatest({x}.n, {y}.n)"
    bits = " + ".join(f"bit_count({x}.{d} & {y}.{d})" for d in DIGEST)
    small, large = (f"array({', '.join(map(str, t))})" for t in fewest_bits(settings))
    shared = f"({settings.percent} * ({low} + {high}) + {99 + settings.percent}) DIV {100 + settings.percent}"
    least = f"CASE WHEN {high} <= {settings.k} THEN get({small}, CAST({shared} AS INT)) ELSE get({large}, CAST(100 * {low} DIV {high} - {settings.percent} AS INT)) END"
    # Sizes that allow no link have no entry.
    return F.expr(f"100 * {low} >= {settings.percent} * {high} AND {bits} >= coalesce({least}, 0)")


def inverted_lists(classes: DataFrame, settings: Settings) -> DataFrame:
    """(key, rep, n, digest): each class in its lists, of those that hold two classes or more."""
    k, p = settings.k, settings.percent
    exact = k * 100 // p
    keyed = classes.where(F.col("n") > k).select(*ROW, F.explode("keys").alias("key"))
    # Small sets: of all their values the rarest that any linked set must meet; those of one class alone come first and need no list.
    small = classes.where(F.col("n") <= exact)
    values = small.select("rep", F.explode("small").alias("value"))
    counts = values.groupBy("value").count().where("count > 1")
    common = values.join(counts, "value").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("count", "value"))).alias("common"))
    room = F.expr(f"CAST(greatest(0, n - ceil(n * {p} / 100) + 1 - (n - size(common))) AS INT)")
    small = small.select(*ROW).join(common, "rep").select(*ROW, F.explode(F.slice("common", 1, room)).alias("v")).select(*ROW, F.col("v.value").alias("key"))
    every = keyed.unionByName(small)
    several = written(every.groupBy("key").count().where("count > 1").select("key"), True)
    return every.join(several, "key").select("key", *ROW)


#: Longs of a set's bitmap.
MARKS = 16


def marks(batches: Iterator[pa.RecordBatch], settings: Settings) -> Iterator[pa.RecordBatch]:
    """(rep, z) to (rep, size, bits): the size of each set, and a bitmap in which each of its values sets a bit.

    Each bit that two bitmaps differ in is of a value that one of the sets lacks, and no value makes two bits differ, so
    their number is never above that of the values that the sets don't share.
    """
    for batch in batches:
        sets = sets_of(textnp.column(batch, "z").to_pylist(), settings)
        bits = np.zeros((len(sets), MARKS), np.uint64)
        for row, s in zip(bits, sets):
            np.bitwise_or.at(row, ((s >> np.uint64(6)) % np.uint64(MARKS)).astype(np.int64), np.uint64(1) << (s & np.uint64(63)))
        yield pa.RecordBatch.from_arrays([textnp.column(batch, "rep"), pa.array([len(s) for s in sets], pa.int64()), _lists(list(bits.view(np.int64)))], ["rep", "size", "bits"])


def _near_enough(settings: Settings, x: str, y: str) -> Column:
    """Whether sizes and bitmaps of the aliases allow a link: a linked pair's sets differ in few values for their sizes."""
    differ = " + ".join(f"bit_count({x}.bits[{i}] ^ {y}.bits[{i}])" for i in range(MARKS))
    return F.expr(f"{100 + settings.percent} * ({differ}) <= {100 - settings.percent} * ({x}.size + {y}.size)")


def rare_meetings(members: DataFrame, settings: Settings) -> DataFrame:
    """(key, pos, rep, n, component, digest, size, bits) of ``members`` (with packed texts z): the first values of each that others have too.

    The order is by the number of members that have a value, then by the value; ``pos`` counts from 0.
    """

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rep, s in zip(textnp.column(batch, "rep").to_pylist(), sets_of(textnp.column(batch, "z").to_pylist(), settings)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), rep, np.int64)), pa.array(s.view(np.int64))], ["rep", "value"])

    every = members.select("rep", "z").transform(mapped, values, "rep long, value long")
    marked = members.select("rep", "z").transform(mapped, lambda b: marks(b, settings), "rep long, size long, bits array<long>").distinct()
    counts = written(every.groupBy("value").count().where("count > 1"), True)
    common = every.join(counts, "value").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("count", "value"))).alias("common"))
    rows = members.select(*ROW, "component").join(marked, "rep").join(common, "rep").withColumn("alone", (F.col("n") - F.size("common")).cast("int"))
    room = F.expr(f"CAST(greatest(0, n - ceil(n * {settings.percent} / 100) + 1 - alone) AS INT)")
    return rows.select(*ROW, "component", "size", "bits", "alone", F.posexplode(F.slice("common", 1, room)).alias("at", "v")).select(F.col("v.value").alias("key"), (F.col("alone") + F.col("at")).alias("pos"), *ROW, "component", "size", "bits")


#: Members that each list is held against in a round; rounds at most; and a share of the first round's links,
#: one in so many, below which rounds end. What is left then is compared in full.
PIVOTS, ROUNDS, FEW = 1, 8, 200


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_shingles, component_id, kept."""
    before = len(WRITTEN)
    docs = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    made = written(docs.transform(mapped, lambda b: sketches(b, settings.width, settings.k, settings.k * 100 // settings.percent), SKETCH_DDL))
    some = made.where("n > 0 AND doc_id IS NOT NULL")
    classes = written(some.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep")), True)
    members = written(some.select("doc_id", "s1", "s2", "n").join(classes, ["s1", "s2", "n"]).select("doc_id", "rep"), True)
    reps = some.join(members.where("doc_id = rep").select("rep").distinct(), F.col("doc_id") == F.col("rep"), "left_semi").withColumnRenamed("doc_id", "rep")
    lists = written(inverted_lists(reps, settings), True)
    of = lists.select(F.col("rep").alias("node"), F.col("rep").alias("component")).distinct()
    listed = apart_by_bits(docs, "doc_id", of.select("node"))[1]
    texts = bucketed(listed.transform(mapped, packed, "doc_id long, z binary").join(of, F.col("doc_id") == F.col("node"), "left_semi"), "doc_id")
    rest_driver(docs.sparkSession)
    found, tried = [], []

    def linked(pairs: DataFrame) -> DataFrame:
        """The links among ``pairs``. Of the texts only those in pairs are moved, that of ``a`` once before it meets its pairs."""
        tried.append(pairs := written(pairs, True))
        near = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("z").alias("zb")), "b")
        other = pairs.select("a").distinct().join(texts.select(F.col("doc_id").alias("a"), F.col("z").alias("za")), "a")
        full = near.join(other, "a").select("a", "b", "ca", "cb", "za", "zb")
        found.append(written(full.transform(mapped, verifier(settings), "a long, b long, ca long, cb long").distinct(), True))
        return found[-1]

    def untried(met: DataFrame) -> DataFrame:
        """Of pairs (lo, hi) those that no earlier round held against each other."""
        if tried:
            old = reduce(DataFrame.unionAll, (t.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")) for t in tried))
            met = met.join(old, ["lo", "hi"], "left_anti")
        return met

    def apart(lists: DataFrame, of: DataFrame) -> DataFrame:
        """The lists whose members are in several components."""
        rows = lists.join(of, lists.rep == of.node).select(*lists.columns, "component")
        several = written(rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key"), True)
        out = written(rows.join(several, "key"), True)
        done_with(several)
        return out

    def held(pivots: DataFrame, members: DataFrame, turn: int) -> DataFrame:
        """Each member with the one of its lists' pivots that its digest is most like: as many pairs as members at most."""
        met = pivots.alias("x").join(members.alias("y"), F.expr("x.key = y.key AND x.component <> y.component") & _alike(settings, "x", "y"))
        bits = F.expr(" + ".join(f"bit_count(x.{d} & y.{d})" for d in DIGEST)).alias("bits")
        # Near copies meet one pivot in many lists: each pair is one row, whichever its lists, before it is looked for among those tried.
        once = met.select(bits, F.col("x.rep").alias("a"), F.col("x.component").alias("ca"), F.col("y.rep").alias("b"), F.col("y.component").alias("cb")).groupBy(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
        sides = [F.expr(f"max({v}) AS {n}") for v, n in (("bits", "bits"), ("IF(a < b, ca, cb)", "clo"), ("IF(a < b, cb, ca)", "chi"), ("b > a", "up"), ("b < a", "down"))]
        ways = "IF(up, named_struct('a', lo, 'ca', clo, 'b', hi, 'cb', chi), NULL), IF(down, named_struct('a', hi, 'ca', chi, 'b', lo, 'cb', clo), NULL)"
        met = untried(once.agg(*sides)).select("bits", F.expr(f"inline(filter(array({ways}), w -> w IS NOT NULL))"))
        best = met.groupBy("b").agg(F.max(F.struct("bits", F.xxhash64(F.lit(turn), "a").alias("h"), "a", "ca", "cb")).alias("m"))
        return best.select("m.a", "b", "m.ca", "m.cb")

    def every(meet: DataFrame) -> DataFrame:
        """The pairs that may be linked: what two sets share lies behind the first value that they share, and bitmaps differ little."""
        each = f"x.key = y.key AND x.component <> y.component AND x.rep < y.rep AND {settings.percent} * (x.n + y.n) <= {100 + settings.percent} * least(x.n - x.pos, y.n - y.pos)"
        met = meet.alias("x").join(meet.alias("y"), F.expr(each) & _alike(settings, "x", "y") & _near_enough(settings, "x", "y"))
        once = met.groupBy(F.col("x.rep").alias("lo"), F.col("y.rep").alias("hi")).agg(F.max("x.component").alias("ca"), F.max("y.component").alias("cb"))
        return untried(once).select(F.col("lo").alias("a"), F.col("hi").alias("b"), "ca", "cb")

    sizes: list[int] = []
    for turn in range(ROUNDS):
        open_ = apart(lists, of) if turn else lists.withColumn("component", F.col("rep"))
        pick = [F.min_by(F.struct(*ROW, "component"), F.xxhash64(F.lit(turn * PIVOTS + i), "rep")) for i in range(PIVOTS)]
        pivots = written(open_.groupBy("key").agg(F.array_distinct(F.array(*pick)).alias("p")).select("key", F.explode("p").alias("p")).select("key", "p.*"), True)
        links = linked(held(pivots, open_, turn))
        done_with(pivots)
        # A component joins the least that it is linked to, and that one's; nodes of one label are linked, if not yet all that are.
        step = links.select(F.greatest("ca", "cb").alias("c"), F.least("ca", "cb").alias("m")).groupBy("c").agg(F.min("m").alias("m"))
        jump = step.join(step.select(F.col("c").alias("m"), F.col("m").alias("mm")), "m", "left").select("c", F.coalesce("mm", "m").alias("m"))
        of = written(of.join(jump, of.component == jump.c, "left").select("node", F.coalesce("m", "component").alias("component")), True)
        lists = open_.drop("component")
        rest_driver(docs.sparkSession)
        sizes.append(links.count())
        if sizes[-1] * FEW <= sizes[0]:
            break
    open_ = apart(lists, of)
    some_partner = F.expr("x.key = y.key AND x.component <> y.component") & _alike(settings, "x", "y")
    left = open_.alias("x").join(open_.alias("y"), some_partner, "left_semi").select(*ROW, "component").distinct()
    left = written(left.join(texts, left.rep == texts.doc_id).select(*ROW, "component", "z"))
    meet = written(rare_meetings(left, settings), True)
    linked(every(meet))

    rest_driver(docs.sparkSession)
    # Rows of one doc_id with different texts are one node.
    nodes = members.groupBy("doc_id").agg(F.min("rep").alias("u"), F.max("rep").alias("v")).where("u <> v")
    edges = members.join(nodes.select("doc_id"), "doc_id").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    for links in found:
        edges = edges.unionByName(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    whole = components(edges)
    placed = members.join(whole, members.rep == whole.node, "left").select("doc_id", F.coalesce("component", "rep").alias("component_id")).distinct()
    out = made.select("doc_id", F.col("n").alias("n_shingles")).join(placed, "doc_id", "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"))
    return settled(out, before)


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), Settings(width=2))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 1 THEN w ELSE [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] END) AS s FROM d),
x AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS u, b.doc_id AS v FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
e AS (SELECT u, v FROM p UNION SELECT v, u FROM p),
r AS (SELECT u, v FROM e UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u),
c AS (SELECT u, min(v) AS least FROM r GROUP BY u)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(c.least, doc_id)) AS component_id, doc_id <= coalesce(c.least, doc_id) AS kept
FROM s LEFT JOIN c ON doc_id = u
"""
