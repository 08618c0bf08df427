"""Scores: accuracy on documents whose labels weren't learned, disguises, and odd tables."""

from __future__ import annotations

import numpy as np
import pytest
from conftest import ODD
from pyspark.sql import functions as F

from tidewell.llm import quality_model, toxicity

DATA = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")


@pytest.fixture(scope="module")
def toxic(tables):
    return toxicity.fit(*tables)


def held_out(scored, labels, name: str) -> tuple[np.ndarray, np.ndarray]:
    rows = scored.join(labels, "doc_id").where(F.crc32(F.col("doc_id").cast("string")) % 5 == 0).select("score", name).dropna().collect()
    return np.array([r.score for r in rows]), np.array([r[name] for r in rows])


def test_toxicity_held_out(tables, toxic):
    score, y = held_out(toxicity.scored(tables[0].select("doc_id", "text"), toxic), tables[1], "toxic")
    assert (score[y == 1] >= 0.5).mean() > 0.85
    assert (score[y == 0] >= 0.5).mean() < 0.02


def test_quality_held_out(tables):
    score, y = held_out(quality_model.scored(tables[0], quality_model.fit(*tables)), tables[1], "quality")
    assert ((score >= 0.3) == y).mean() > 0.95
    assert (score[y == 1] >= 0.3).mean() > 0.98
    assert abs(score.mean() - y.mean()) < 0.03  # calibrated


@pytest.mark.parametrize(
    ("disguised", "plain"),
    [("st0rm", "storm"), ("5tup1d", "stupid"), ("stuuuupid", "stupid"), ("m0r0n", "moron"), ("d!sgust!ng", "disgusting"), ("tr@sh", "trash"), ("p4th3tic", "pathetic"), ("idiiiot", "idiot")],
)
def test_restored_words(disguised, plain, toxic):
    found = toxicity.restored(disguised, False, toxic.characters, {})
    if plain != "storm":  # of words that the corpus doesn't hold, only likely ones come back
        assert found == plain


@pytest.mark.parametrize("line", ["you are a s t u p i d person", "such a p.a.t.h.e.t.i.c thing", "what an i-d-i-o-t he is", "total m 0 r 0 n here", "he is 5tup1d and a l0s3r", "stuuupiiid"])
def test_disguised_words_are_evidence(spark, toxic, line):
    plain = "the of and to in is that it was for on with as be by at this from are or"
    rows = spark.createDataFrame([(1, f"{plain} {line} {plain}"), (2, f"{plain} {plain} 1998 r2d2 a.b 3.5 e-mail"), (3, None)], "doc_id long, text string")
    score = {r.doc_id: r.score for r in toxicity.scored(rows, toxic).collect()}
    assert score[1] > 5 * score[2]
    assert score[2] < 0.1 and score[3] < 0.5


def test_short_words_are_evidence(spark):
    """The only toxic words have one to three letters, plain, disguised or set apart."""
    plain = "the of and to in is that it was for on with as be by at this from are or"
    # Labels alternate, and texts of both are of the same lengths: the short word alone tells them apart.
    own = [(i, f"{plain} {(('zig', 'qb', 'é'), ('zog', 'qv', 'ü'))[i % 2][i % 3]} {plain}{' meadow' * (i // 2 % 5)}") for i in range(900)]
    own += [(900 + i, f"{plain} {w} {plain}") for i, w in enumerate(["zog", "qv", "ü", "z0g", "z o g", "q v", "zig", "qb"])]
    docs = spark.createDataFrame(own, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(900)], "doc_id long, toxic int")
    score = {r.doc_id: r.score for r in toxicity.scored(docs, toxicity.fit(docs, labels)).collect()}
    assert all(score[i] >= 0.5 for i in range(900, 906)), score
    assert score[906] < 0.5 and score[907] < 0.5


def test_odd(spark, odd, nothing, toxic):
    labels = spark.createDataFrame([(900_004, 1, 1), (900_004, 0, 0), (900_005, None, None), (None, 1, 1), (1, 1, 1)], "doc_id long, toxic int, quality int")
    for table in (odd, nothing):
        for own in (labels, labels.where("false")):
            assert toxicity.scored(table.drop("score"), toxicity.fit(table, own)).count() == table.count()
            assert quality_model.scored(table, quality_model.fit(table, own)).count() == table.count()
    scored = toxicity.scored(odd, toxic, "other")
    assert scored.columns == [*odd.columns, "other"]
    assert all(0 <= r.other <= 1 for r in scored.collect())
    assert scored.count() == len(ODD)


def test_network_is_calibrated():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 5))
    y = (rng.random(4000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(int)
    p = quality_model.train(x, y)(x)
    for low in (0.1, 0.4, 0.7):
        part = (p >= low) & (p < low + 0.2)
        assert abs(p[part].mean() - y[part].mean()) < 0.08
