"""Quality rules: a table of thresholds compiled into one Spark projection, without user functions.

Every measure is an integer; a rule compares two of them as ``a * x <= b * y``, so no rounding decides.

Nulls: a null text has no words and fails the base rule. Empty and blank texts likewise. Rows with the
same id, or without one, are judged each by itself. Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, sql_list, table, words

# Common function words of English, French, German and Spanish.
STOP_WORDS = (
    "a", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the", "this", "to", "was", "with",
    "au", "aux", "avec", "dans", "de", "des", "du", "elle", "en", "est", "et", "il", "la", "le", "les", "par", "pas", "pour", "qui", "sur", "un", "une",
    "auf", "das", "dem", "den", "der", "die", "ein", "eine", "ist", "mit", "nicht", "sich", "und", "von", "zu",
    "con", "del", "el", "es", "los", "por", "que", "se", "y",
)


@dataclass(frozen=True)
class Rule:
    """Kept while ``left * measure <= right * of``."""

    name: str
    left: int
    measure: str
    right: int
    of: str


#: A document is kept if it passes all of these besides the base rule.
RULES = (
    Rule("words_short", 2, "n_words", 1, "word_chars"),
    Rule("words_long", 1, "word_chars", 15, "n_words"),
    Rule("symbols", 10, "n_symbols", 1, "n_words"),
    Rule("duplicate_lines", 10, "n_dup_lines", 3, "n_lines"),
    Rule("ellipsis_lines", 10, "n_ellipsis_lines", 3, "n_lines"),
    Rule("bullet_lines", 10, "n_bullet_lines", 9, "n_lines"),
    Rule("stop_words_few", 2, "one", 1, "n_stop_words"),
)

BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def _gram(s: Column, i: Column) -> Column:
    return F.get(s, i)["g"]


def _repeated(w: Column) -> Column:
    """Words in windows of three that occur twice or more among the words ``w``."""

    def covered(starts: Column) -> Column:
        own = F.transform(starts, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(starts, i + 1) - p, F.lit(3))))
        return F.aggregate(own, F.lit(0), lambda a, x: a + x)

    def twice(s: Column) -> Column:
        same = F.filter(s, lambda x, i: _gram(s, i - 1).eqNullSafe(x["g"]) | _gram(s, i + 1).eqNullSafe(x["g"]))
        return let(F.sort_array(F.transform(same, lambda x: x["i"])), covered)

    def windows(g: Column) -> Column:
        ordered = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(let(ordered, twice))

    def hashes(h: Column) -> Column:
        grams = F.transform(F.slice(h, 1, F.greatest(F.size(h) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)))
        return let(grams, windows)

    return let(F.transform(w, lambda x: F.xxhash64(x)), hashes)


def measures(docs: DataFrame) -> DataFrame:
    """doc_id and the measures that the rules compare."""
    text = F.coalesce("text", F.lit(""))
    n = lambda array, test: F.size(F.filter(array, test)).cast("long")
    split = docs.select("doc_id", text.alias("t"), words(F.col("text")).alias("w"), F.filter(F.split(text, "\n"), lambda x: F.translate(x, " \t\x0b\x0c\r", "") != "").alias("l"))
    return split.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.translate("t", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        _repeated(F.col("w")).cast("long").alias("n_repeat_words"),
        F.size("l").cast("long").alias("n_lines"),
        n(F.col("l"), lambda x: F.endswith(F.rtrim(x), F.lit("...")) | F.endswith(F.rtrim(x), F.lit("…"))).alias("n_ellipsis_lines"),
        n(F.col("l"), lambda x: F.ltrim(x).rlike("^[-*•]")).alias("n_bullet_lines"),
        n(F.col("w"), lambda x: F.lower(x).isin(*STOP_WORDS)).alias("n_stop_words"),
        F.lit(1).cast("long").alias("one"),
    )


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The measures, ``base_failed``, the names of failed rules and ``kept``."""
    failed = F.expr("array_compact(array(" + ", ".join(f"CASE WHEN {r.left} * {r.measure} > {r.right} * {r.of} THEN '{r.name}' END" for r in rules) + "))")
    return measures(docs).withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("failed_rules", failed).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judged(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"))


ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT *, [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)] AS g FROM s),
p AS (SELECT doc_id, unnest(g) AS gram, generate_subscripts(g, 1) AS i FROM (SELECT DISTINCT doc_id, g FROM g)),
q AS (SELECT doc_id, i FROM p QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
c AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM q) GROUP BY doc_id),
m AS (SELECT g.doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
  len(l) AS n_lines, len(list_filter(l, lambda x: rtrim(x, ' ') LIKE '%...' OR rtrim(x, ' ') LIKE '%…')) AS n_ellipsis_lines,
  len(list_filter(l, lambda x: regexp_matches(ltrim(x, ' '), '^[-*•]'))) AS n_bullet_lines,
  len(list_filter(w, lambda x: lower(x) IN ({sql_list(STOP_WORDS)}))) AS n_stop_words, 1 AS one
  FROM g LEFT JOIN c USING (doc_id)),
f AS (SELECT *, ({BASE_FAILED}) AS base_failed,
  array_to_string(list_filter([{", ".join(f"CASE WHEN {r.left} * {r.measure} > {r.right} * {r.of} THEN '{r.name}' END" for r in RULES)}], lambda x: x IS NOT NULL), ',') AS failed_rules FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND failed_rules = '' AS kept, failed_rules FROM f
"""
