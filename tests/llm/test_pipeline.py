"""The pipeline, stage by stage against plain versions, and the registered queries' columns."""

from __future__ import annotations

import zlib

import brute
import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

import corpus_pipeline
from tidewell.llm import common, mixture, toxicity
from tidewell.llm.queries import ORACLE_SQL, QUERIES


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA).cache()
        seen[name] = (docs, out)
        docs = out
        if name != "token_output":
            assert out.columns == columns
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    texts = lambda df: [(r.doc_id, r.text) for r in df.collect()]

    before, after = seen["toxicity"]
    scores = {r.doc_id: r.score for r in toxicity.scored(before, toxicity.fit(before, spark.read.parquet(f"{DATA}/labels.parquet"))).collect()}
    assert ids(after) == sorted(i for i, s in scores.items() if s < 0.5)

    before, after = seen["near_dedup"]
    five = lambda t: frozenset(zip(*(w[k:] for k in range(5)))) if len(w := brute.WORD.findall(brute.lower(t or ""))) > 4 else frozenset([tuple(w)] if w else [])
    sets, leaders = {i: five(t) for i, t in texts(before)}, {}
    for i in sorted(sets):
        near = [j for j in leaders if sets[i] and len(sets[i] & sets[j]) * 100 >= 80 * len(sets[i] | sets[j])]
        root = min((leaders[j] for j in near), default=i)
        olds = {leaders[j] for j in near}
        leaders = {j: root if r in olds else r for j, r in leaders.items()} | {i: root}
    assert ids(after) == sorted(i for i, r in leaders.items() if i == r)

    before, after = seen["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    bad = {i for i, n, hit, _ in brute.contamination(texts(before), items) if hit and 20 * hit >= n}
    assert bad and ids(after) == [i for i in ids(before) if i not in bad]

    before, after = seen["mixture"]
    words = lambda df: sum(len(brute.WORD.findall(t or "")) for _, t in texts(df))
    assert 0.6 * words(before) < words(after) <= 0.8 * words(before)
    assert len(set(ids(after))) == after.count()

    before, after = seen["token_output"]
    from tokenizers import Tokenizer

    from tidewell.llm.token_output import tokenizer_path

    library, start = Tokenizer.from_file(tokenizer_path()), 0
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in after.collect()}
    for i, text in sorted(texts(before)):
        own = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        assert got[i] == (start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        start += len(own)


@pytest.mark.parametrize("empty", [True, False])
def test_stages_on_odd_tables(spark, odd, nothing, empty):
    for name, stage in corpus_pipeline.STAGES:
        docs = nothing if empty else odd
        out = stage(spark, docs, DATA)
        assert name == "token_output" or out.columns == docs.columns
        assert out.count() <= docs.count()


def test_near_dedup_stage_on_odd_rows(spark, odd):
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_dedup_stage(spark, odd, DATA).collect()]
    ids = [i for i, _ in kept]
    # Of the copies under 900_012 one stays, and the other text under it; a text without an id stays, as does one without words.
    assert sorted(t for i, t in kept if i == 900_012) == ["another text of one id", "one"]
    assert ids.count(900_006) == 1 and ids.count(900_007) == 0 and ids.count(None) == 2
    copies = odd.where("doc_id IS NULL").union(odd.where("doc_id IS NULL")).union(odd.where("doc_id = 900006").selectExpr("CAST(NULL AS LONG)", "text", *odd.columns[2:]))
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_dedup_stage(spark, odd.where("doc_id = 900006").union(copies), DATA).collect()]
    assert sorted(kept, key=str) == sorted([(900_006, "same text here, twice over and over"), (None, "a row without an id, and some words in it"), (None, None)], key=str)


def moved_texts(df):
    """Runs ``df``; the rows with a text that its shuffles moved."""

    def of(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return of(node.executedPlan())
        if kind == "ShuffleQueryStageExec":
            return of(node.plan())
        own = node.metrics().apply("shuffleRecordsWritten").value() if kind == "ShuffleExchangeExec" and "text#" in node.output().toString() else 0
        return own + sum(of(node.children().apply(i)) for i in range(node.children().size()))

    plan = df._jdf.queryExecution()
    plan.toRdd().count()
    return of(plan.executedPlan())


def test_near_dedup_stage_moves_few_texts(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *(F.sha1((F.col("id") * 10 + i).cast("string")) for i in range(10))).alias("text"))
    copies = docs.where("doc_id < 100").withColumn("doc_id", F.col("doc_id") + 5000)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = corpus_pipeline.near_dedup_stage(spark, docs.union(copies), DATA)
        assert moved_texts(out) < 300
        assert sorted(r.doc_id for r in out.collect()) == list(range(2000))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("rows", [common.BIT_ROWS, 1])
def test_apart_by_bits(spark, monkeypatch, rows):
    monkeypatch.setattr(common, "BIT_ROWS", rows)
    df = spark.createDataFrame([(i if i % 10 else None, "k", i) for i in range(-300, 300)], "doc_id long, bits_set string, `a.b` int")
    some = spark.createDataFrame([(i,) for i in (*range(-300, 300, 7), None, 7, 7)], "i long")
    surely, may = common.apart_by_bits(df, "doc_id", some)
    assert surely.columns == may.columns == df.columns
    key = lambda rows: sorted(map(tuple, rows), key=str)
    assert key(surely.union(may).collect()) == key(df.collect())
    inside = {r.i for r in some.where("i IS NOT NULL").collect()}
    first = surely.collect()
    assert not inside & {r.doc_id for r in first} and len(first) > (450 if rows > 1 else 59)
    none = common.apart_by_bits(df, "doc_id", some.where("false"))
    assert none[0].count() == 600 and none[1].count() == 0


def test_decontamination_stage_on_odd_rows(spark, odd):
    text = spark.read.parquet(f"{DATA}/benchmark.parquet").where("text IS NOT NULL").head().text
    bad = spark.createDataFrame([(None, text), (900_012, text)], "doc_id long, text string")
    docs = odd.unionByName(bad, allowMissingColumns=True)
    out = corpus_pipeline.decontamination_stage(spark, docs, DATA)
    assert out.columns == odd.columns and out.count() == odd.count() and out.where(F.col("text") == text).count() == 0


def test_registered():
    import __spark_entry__

    names = list(__spark_entry__.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want, got = con.sql(ORACLE_SQL[name]).df(), QUERIES[name](spark, DATA).toPandas()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    key = lambda df: sorted(map(str, df[cols].itertuples(index=False, name=None)))
    assert key(got) == key(want)


def test_default_domain(spark):
    assert {r.d for r in spark.range(20).select(F.concat(F.lit("src"), "id").alias("source")).select(mixture.default_domain().alias("d")).collect()} <= {"web", "books", "news", "forum"}
