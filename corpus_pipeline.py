"""From documents to token ids: each stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import decontaminate, mixture, near_dedup, token_output, toxicity
from tidewell.llm.common import WRITTEN, apart_by_bits, drop, rest, shared_dir, table, written


def _unused(docs: DataFrame, name: str) -> str:
    """``name``, or that with underscores which no column of ``docs`` has."""
    while name in docs.columns:
        name += "_"
    return name


#: Numbers from here on stand for rows that no doc_id of their own tells apart.
OWN = 1 << 62


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely toxic than not go. Each row is judged by its own text; a null one has no evidence.

    An empty table stays empty, and columns of any name stay as they are.
    """
    name = _unused(docs, "score")
    scored = toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), name)
    return scored.where(F.col(name) < 0.5).drop(name)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, on five-word shingles: the one of the least doc_id.

    A document is a text under an id: rows of one id and one text are copies, of which one stays, but texts that share
    an id are documents of their own, as are texts without one, after all that have one. Texts without words are alike only
    in having none: each of them stays, once for each id.
    """
    rest(spark)
    key, h = _unused(docs, "key"), F.xxhash64("doc_id", "text")
    least = docs.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("i")).agg(F.min(h).alias("lo"), F.max(h).alias("hi")).where("lo <> hi").select("i", "lo")
    shared = written(least, True)  # the ids of several texts, and the text that keeps the id
    named = docs.join(shared, docs.doc_id == shared.i, "left") if shared.take(1) else docs.withColumns({"i": F.lit(None).cast("long"), "lo": F.lit(None).cast("long")})
    own = F.col("doc_id").isNull() | F.col("lo").isNotNull() & (F.col("lo") != h)
    number = F.when(own, F.lit(OWN) + h.bitwiseAND(F.lit(OWN - 1))).otherwise(F.col("doc_id"))
    keyed = named.select(*(docs[f"`{c}`"] for c in docs.columns), number.alias(key))
    found = near_dedup.near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text")).groupBy(F.col("doc_id").alias(key)).agg(F.count("*").alias("rows"), F.bool_or("kept").alias("kept"))
    # Most rows stay and are the only ones of their key: those of which this is sure don't move.
    others = written(found.where("rows > 1 OR NOT kept"), True)
    sure, open_ = apart_by_bits(keyed, key, others.select(key))
    once = sure.unionByName(open_.join(others.select(key), key, "left_anti"))
    several = others.where("kept").select(key)
    if several.take(1):
        once = once.unionByName(open_.join(several, key, "left_semi").dropDuplicates([key]))
    return once.select(*(F.col(f"`{c}`") for c in docs.columns))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more of the words are in benchmark windows go, each row by its own text.

    Null and empty texts stay, with and without an id; without benchmark items all stay.
    """
    rest(spark)
    key = _unused(docs, "key")
    keyed = docs.withColumn(key, F.xxhash64("text"))
    found = decontaminate.contamination(docs.select(F.xxhash64("text").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return keyed.join(found.where(decontaminate.CONTAMINATED).select(F.col("doc_id").alias(key)).distinct(), key, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def mixture_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Four fifths of the tokens by the production weights, no document twice.

    A null lang or source is a leaf like any other; a null text has no tokens. An empty table stays empty.
    """
    rest(spark)
    once = mixture.Mixture(mixture.PRODUCTION.weights, mixture.PRODUCTION.budget, max_epochs=1)
    return mixture.mixed(docs, once)


def token_output_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, written and read back: a null text has the end id alone; null ids come first."""
    rest(spark)
    path = shared_dir(spark)
    WRITTEN.append(path)  # it goes once the result is written
    token_output.write(docs, path)
    return token_output.read(spark, path)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixture", mixture_stage),
    ("token_output", token_output_stage),
]

#: SQL can say neither the scores of the first stage nor the ids of the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, own = table(spark, sf_dir, "documents"), len(WRITTEN)
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
        drop(spark, WRITTEN[own:-1])  # all but this stage's result
    return docs
