"""Benchmark decontamination by winnowing, in DataFrame functions alone.

The least of WINDOW - GRAM + 1 gram hashes in a row is a fingerprint, so any WINDOW words that a document
shares with an item hold a common fingerprint. Fingerprints of documents meet those of the benchmark in a
join, and each hit is extended to both sides: it counts if the words around make up a whole window.
An item of fewer words than a window is one window of its own length, met by the hash of all its words.

Only fingerprints and counts leave a document's row. The benchmark's side is broadcast if it is at most
BROADCAST_BYTES, and joined by shuffle otherwise.

Nulls: a null or empty text has no words; null items have none either. Equal documents give equal rows, one
for each; rows of one doc_id with different texts are judged apart. Items with one item_id count as one.
Columns besides doc_id, text and item_id are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, lower_ascii, table

WINDOW, GRAM = 13, 5
#: Words around a gram within a window.
AROUND = WINDOW - GRAM
BROADCAST_BYTES = 32 << 20
#: Bytes of a broadcast row: a hash, an id, and the hashes of the words around.
ROW_BYTES = 64 + 16 * AROUND
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def hashes(text: Column) -> Column:
    """The hashes of a text's words, A-Z lower-cased."""
    words = F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NO_WORD), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _gram(h: Column, i: Column, n: int) -> Column:
    return F.xxhash64(F.lit(n), *(F.get(h, i + k) for k in range(n)))


def _least(x: Column, step: int) -> Column:
    """At each place the least of three, ``step`` apart to the right."""
    return F.transform(x, lambda v, i: F.least(v, F.get(x, i + step), F.get(x, i + 2 * step)))


def _greatest(x: Column, step: int) -> Column:
    return F.transform(x, lambda v, i: F.greatest(v, F.get(x, i - step), F.get(x, i - 2 * step)))


def fingerprints(h: Column) -> Column:
    """(p, g) of the grams that are least in some window of nine: with ties, all of them."""
    assert AROUND + 1 == 9

    def chosen(g: Column) -> Column:
        def by_min(least: Column) -> Column:
            # A gram is least in a window if it is the greatest of the minima of all windows that hold it.
            padded = F.concat(F.slice(least, 1, F.size(g) - AROUND), F.array_repeat(F.lit(None).cast("long"), AROUND))
            return let(padded, lambda m: let(_greatest(m, 1), lambda u: F.filter(F.transform(g, lambda x, i: F.when(x == F.greatest(F.get(u, i), F.get(u, i - 3), F.get(u, i - 6)), F.struct(i.alias("p"), x.alias("g")))), lambda s: s.isNotNull())))

        return let(_least(g, 1), lambda t: let(_least(t, 3), by_min))

    grams = F.transform(F.slice(h, 1, F.size(h) - GRAM + 1), lambda _, i: _gram(h, i, GRAM))
    return F.when(F.size(h) >= WINDOW, let(grams, chosen)).otherwise(F.array().cast("array<struct<p:int,g:long>>"))


def _short(h: Column, n: int) -> Column:
    """(p, g) of all runs of n words."""
    return F.when(F.size(h) >= n, F.transform(F.slice(h, 1, F.size(h) - n + 1), lambda _, i: F.struct(i.alias("p"), _gram(h, i, n).alias("g")))).otherwise(F.array().cast("array<struct<p:int,g:long>>"))


def benchmark_prints(items: DataFrame) -> DataFrame:
    """(g, item_id, span, need, left, right): a fingerprint, its words, the words of a window, the words around."""
    rows = items.select("item_id", hashes(F.col("text")).alias("h")).where("size(h) > 0")
    long = rows.where(F.size("h") >= WINDOW).withColumn("f", F.explode(fingerprints(F.col("h"))))
    around = lambda sign, first: F.filter(F.transform(F.sequence(F.lit(0), F.lit(AROUND - 1)), lambda i: F.get("h", F.col("f.p") + first + sign * i)), lambda x: x.isNotNull())
    long = long.select("f.g", "item_id", F.lit(GRAM).alias("span"), F.lit(WINDOW).alias("need"), around(-1, -1).alias("left"), around(1, GRAM).alias("right"))
    none = F.array().cast("array<long>")
    whole = F.coalesce(*(F.when(F.size("h") == n, _gram(F.col("h"), F.lit(0), n)) for n in range(1, WINDOW)))
    short = rows.where(F.size("h") < WINDOW).select(whole.alias("g"), "item_id", F.size("h").alias("span"), F.size("h").alias("need"), none.alias("left"), none.alias("right"))
    return long.unionByName(short).distinct()


def _matched(around: Column, at) -> Column:
    """How many of the words ``around``, from the first, stand in ``h`` at ``at(i)``."""
    same = F.transform(around, lambda x, i: x.eqNullSafe(F.get("h", at(i))))
    return let(F.array_position(same, F.lit(False)), lambda p: F.when(p == 0, F.size(around)).otherwise(p.cast("int") - 1))


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_words, n_hit, n_items, item_ids (sorted as strings)."""
    prints = benchmark_prints(items)
    sizes = prints.groupBy("need").count().collect()  # WINDOW rows at most
    short = sorted(r.need for r in sizes if r.need < WINDOW)
    small = sum(r["count"] for r in sizes) * ROW_BYTES <= BROADCAST_BYTES

    texts = docs.select("doc_id", F.xxhash64("text").alias("dk"), hashes(F.col("text")).alias("h"))
    found = F.concat(fingerprints(F.col("h")), *(_short(F.col("h"), n) for n in short))
    # The first row of each document stands for itself, so that those without hits stay.
    own = F.array(F.struct(F.lit(None).cast("int").alias("p"), F.lit(None).cast("long").alias("g")))
    if small:
        rows = texts.select("doc_id", "dk", "h", F.explode(F.concat(own, found)).alias("f"))
        rows = rows.join(F.broadcast(prints), F.col("f.g") == prints.g, "left").where("f.p IS NULL OR g IS NOT NULL")
    else:
        hits = texts.select("doc_id", "dk", F.explode(found).alias("f")).join(prints, F.col("f.g") == prints.g).distinct()
        heads = texts.select("doc_id", "dk", "h", F.lit(None).cast("struct<p:int,g:long>").alias("f"))
        again = texts.join(hits.withColumnRenamed("dk", "dk2").withColumnRenamed("doc_id", "doc_id2"), F.col("doc_id").eqNullSafe(F.col("doc_id2")) & (F.col("dk") == F.col("dk2"))).drop("doc_id2", "dk2")
        rows = heads.unionByName(again, allowMissingColumns=True)
    p = F.col("f.p")
    rows = rows.select("doc_id", "dk", F.size("h").alias("n_words"), p.alias("p"), "item_id", "span", "need", _matched(F.col("left"), lambda i: p - 1 - i).alias("before"), _matched(F.col("right"), lambda i: p + F.col("span") + i).alias("after"))
    hit = F.when(F.col("before") + F.col("span") + F.col("after") >= F.col("need"), F.struct((F.col("p") - F.col("before")).alias("s"), (F.col("p") + F.col("span") + F.col("after")).alias("e")))
    rows = rows.select("doc_id", "dk", "n_words", F.col("p").isNull().alias("own"), hit.alias("hit"), F.when(hit.isNotNull(), F.col("item_id").cast("string")).alias("item"))
    docs = rows.groupBy("doc_id", "dk", "n_words").agg(F.count_if("own").alias("copies"), F.collect_set("hit").alias("hits"), F.sort_array(F.collect_set("item")).alias("item_ids"))
    covered = F.aggregate(F.sort_array("hits"), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], a["end"]))).alias("n"), F.greatest(a["end"], x["e"]).alias("end")))["n"]
    docs = docs.select("doc_id", F.col("n_words").cast("long").alias("n_words"), covered.cast("long").alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"), "item_ids", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return docs.drop("copy")


CONTAMINATED = "n_hit > 0 AND 20 * n_hit >= n_words"


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), F.expr(CONTAMINATED).alias("contaminated"))


_WORDS = "list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
ORACLE = f"""
WITH i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
n AS (SELECT item_id, w, least(len(w), {WINDOW}) AS k FROM i WHERE len(w) > 0),
v AS (SELECT DISTINCT item_id, k, array_to_string(w[s : s + k - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS s FROM n)),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
k AS (SELECT DISTINCT k FROM n),
p AS (SELECT doc_id, k, s, array_to_string(w[s : s + k - 1], ' ') AS g FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, k WHERE len(w) >= k)),
h AS (SELECT doc_id, s, k, item_id FROM p JOIN v USING (k, g)),
a AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(s, s + k)) AS j FROM h) GROUP BY doc_id),
b AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN a USING (doc_id) LEFT JOIN b USING (doc_id)
"""
