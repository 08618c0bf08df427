from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

#: Nulls, empty, blank, long, repeated, tied and odd texts.
ODD = [
    (900_001, None), (900_002, ""), (900_003, " \n\t"), (900_004, "word"), (900_005, "a a a a a a a a " * 200), (900_006, "same text here, twice over and over"),
    (900_007, "same text here, twice over and over"), (900_008, "SAME text here, twice over and over"), (900_009, "é ü 日本 \x00 \x1c naïve\u00a0text  two  spaces\r\n end "),
    (900_010, "x" * 5000), (900_011, "long words and lines " * 3000), (None, "a row without an id, and some words in it"), (None, None), (900_012, "one"), (900_012, "one"), (900_012, "another text of one id"),
]
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd(spark):
    """Rows of ODD among columns whose names the operators use themselves."""
    rows = [(i, t, "en", "src0", 1.0, "k", [1], 2, "h") for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double, key string, h array<long>, n int, `row` string")


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
