"""URL filters: given rules of hosts and paths, and rules that FP-growth mines from labelled pages.

A given rule fits its host and all subdomains where the path starts with the rule's; the longest wins.
Where none fits, mined rules decide: combinations of URL tokens that are frequent enough among labelled
pages (support) and mostly on pages of low quality (confidence, lift), without those that a part of them
already gives. Tokens that the same labelled pages have stand for each other, the least for all, so copies
of a page don't give all combinations of what they share. Both kinds match by an inverted index: a URL's keys (host suffixes; tokens) are joined with
the rules' keys, and a combination fits where all its tokens were met. The rules' side is broadcast if it
has at most BROADCAST_RULES rows.

Nulls: a null URL, or one without ``://``, has an empty host and path, no rule, and no tokens, so it is
allowed. Equal rows are judged alike, and each is returned. Labels that are null or of no page don't count.
Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import lower_ascii, table, written

BROADCAST_RULES = 100_000
BAD = "label:bad"


@dataclass(frozen=True)
class Mining:
    """At least ``support`` of all labelled pages and ``least`` pages; ``confidence`` of them bad, ``lift`` times the share of all."""

    support: float = 0.0005
    least: int = 3
    confidence: float = 0.5
    lift: float = 2.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return lower_ascii(host), F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)


def suffixes(host: Column) -> Column:
    """The host and its parent domains."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def tokens(url: Column) -> Column:
    """Distinct tokens: host labels, path segments and query names, numbers as #."""
    host, path = host_and_path(url)
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)

    def parts(text: Column, by: str, kind: str) -> Column:
        own = F.transform(F.split(lower_ascii(text), by), lambda x: F.regexp_replace(x, "^[0-9]+", "#"))
        return F.transform(F.filter(own, lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))

    return F.array_distinct(F.concat(parts(host, r"\.", "host:"), parts(path, "[/._-]+", "path:"), parts(F.regexp_replace(query, "=[^&]*", ""), "&", "query:")))


def mine(pages: DataFrame, labels: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """(rule, items, confidence, support): the combinations that tell bad pages."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    seen = pages.join(usable, pages.page_id == usable.doc_id).select("quality", tokens(F.col("url")).alias("tokens"))
    seen = written(seen.select(F.monotonically_increasing_id().alias("id"), (F.col("quality") == 0).alias("bad"), "tokens"))
    n, bad = seen.agg(F.count("*"), F.count_if("bad")).head()
    if not bad:
        return pages.sparkSession.createDataFrame([], "rule string, items array<string>, confidence double, support double")
    fewest = max(mining.least, ceil(mining.support * n))
    each = seen.select("id", "bad", F.explode("tokens").alias("token"))
    having = each.groupBy("token").agg(F.count("*").alias("n"), F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("who")).where(F.col("n") >= fewest)
    # Tokens of the same pages: the least of them.
    named = written(having.select("token", F.min("token").over(Window.partitionBy("n", "who")).alias("item")))
    baskets = each.join(named, "token").groupBy("id", "bad").agg(F.collect_set("item").alias("items")).select(F.array_append("items", F.when(F.col("bad"), BAD).otherwise("label:good")).alias("items"))
    baskets = written(baskets)
    sets = FPGrowth(itemsCol="items", minSupport=(fewest - 0.5) / max(1, baskets.count())).fit(baskets).freqItemsets
    sets = written(sets.where(~F.array_contains("items", "label:good")).select(F.array_sort(F.array_remove("items", BAD)).alias("items"), F.array_contains("items", BAD).alias("bad"), "freq"))
    own = sets.where("bad AND size(items) > 0").select("items", F.col("freq").alias("hits"))
    rules = own.join(sets.where("NOT bad"), "items").select("items", (F.col("hits") / F.col("freq")).alias("confidence"), (F.col("hits") / n).alias("support"))
    rules = written(rules.where((F.col("confidence") >= mining.confidence) & (F.col("confidence") >= mining.lift * bad / n)))
    # A rule is needless if leaving out one token gives another that is as sure.
    parts = rules.where("size(items) > 1").select(F.col("items").alias("whole"), F.col("confidence").alias("sure"), F.explode("items").alias("out")).withColumn("part", F.array_remove("whole", F.col("out")))
    needless = parts.join(rules, (F.col("part") == F.col("items")) & (F.col("confidence") >= F.col("sure"))).select(F.col("whole").alias("items")).distinct()
    return rules.join(needless, "items", "left_anti").select(F.array_join("items", " ").alias("rule"), "items", "confidence", "support")


def _side(rules: DataFrame) -> DataFrame:
    return F.broadcast(rules) if rules.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES else rules


def judged(pages: DataFrame, given: list[tuple[str, str]], mined: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict and mined_rule of each page, under ``given`` (allow or block, host and path)."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    base = pages.select("page_id", "url", host.alias("host"), path.alias("path"), tokens(F.col("url")).alias("tokens"))
    parted = [(verdict, rule, *rule.partition("/")[::2]) for verdict, rule in given]
    fixed = spark.createDataFrame([(f"= {h}", v, r, f"/{p}", 1, 0.0) for v, r, h, p in parted], "key string, verdict string, rule string, start string, size int, confidence double")
    index = mined.select(F.explode("items").alias("key"), F.lit("block").alias("verdict"), "rule", F.lit(None).cast("string").alias("start"), F.size("items").alias("size"), "confidence")
    keys = F.concat(F.array(F.lit(None).cast("string")), F.transform(suffixes(F.col("host")), lambda s: F.concat(F.lit("= "), s)), F.col("tokens"))
    rows = base.select("page_id", "url", "host", "path", F.explode(keys).alias("key"))
    rows = rows.join(_side(fixed.unionByName(index)), "key", "left").where(F.col("key").isNull() | F.col("start").isNull() & F.col("rule").isNotNull() | F.startswith("path", "start"))
    met = rows.groupBy("page_id", "url", "host", "path", "rule", "verdict", "size", "confidence", F.col("start").isNotNull().alias("fixed")).agg(F.count("*").alias("met"))
    # Copies of a row meet each token as often as there are copies.
    met = met.groupBy("page_id", "url", "host", "path").agg(
        F.max(F.when(F.col("rule").isNull(), F.col("met"))).alias("copies"),
        F.max(F.when(F.col("fixed"), F.struct(F.length("rule").alias("n"), F.col("rule").alias("rule"), F.col("verdict").alias("verdict")))).alias("own"),
        F.collect_list(F.when(~F.col("fixed") & F.col("rule").isNotNull(), F.struct("confidence", "rule", "size", "met"))).alias("mined"),
    )
    fit = F.array_max(F.filter("mined", lambda r: r["met"] >= r["size"] * F.col("copies")))["rule"]
    out = met.select("page_id", "url", "host", "path", F.col("own.rule").alias("rule"), F.col("own.verdict").alias("given"), fit.alias("mined_rule"), F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("given", F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow")).alias("verdict"), "mined_rule")


#: The rules of the production filter.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judged(pages, RULES, mine(pages, table(spark, sf_dir, "labels")))
