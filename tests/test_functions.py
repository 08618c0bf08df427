"""Containment and Bloom filters: golden cases, and properties on random arrays."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewell import __version__
from tidewell.functions import bloom


def one(spark, text):
    return spark.sql(f"SELECT {text} AS x").head().x


@pytest.mark.parametrize(
    ("hay", "needles", "found"),
    [
        ("array('a','b','c')", "array('a','b')", True),
        ("array('a','b','c')", "array('a','d')", False),
        ("array('a','b','c')", "array()", True),
        ("array()", "array('a')", False),
        ("array()", "array()", True),
        ("NULL", "array('a')", None),
        ("array('a')", "NULL", None),
        ("array('a')", "array(CAST(NULL AS STRING))", True),
        ("array()", "array(CAST(NULL AS STRING))", False),
        ("array('a',NULL)", "array('x')", False),
        ("array('a',NULL,'b')", "array('a',NULL)", True),
        ("array('A')", "array('a')", False),
        ("array('a','a','b')", "array('b','b')", True),
        ("array('ünïcode','日本')", "array('日本')", True),
    ],
)
def test_contains_all(spark, hay, needles, found):
    h, n = f"CAST({hay} AS ARRAY<STRING>)", f"CAST({needles} AS ARRAY<STRING>)"
    assert one(spark, f"array_contains_all({h}, {n})") is found
    assert one(spark, f"array_contains_all({h}, {n}, false)") is found
    assert one(spark, f"array_contains_all_bloom({h}, {n}, bloom_filter_create({h}))") is found


def test_contains_all_with_a_bad_filter(spark):
    call = "array_contains_all_bloom({}, {}, {})"
    a = "array('a')"
    for bad in ("X'00'", "unhex(repeat('00', 40))", "substring(bloom_filter_create(array('a')), 1, 20)"):
        assert one(spark, call.format(a, a, bad)) is None
        assert one(spark, call.format(a, "CAST(array() AS ARRAY<STRING>)", bad)) is True
        assert one(spark, f"bloom_filter_contains({bad}, 'a')") is None
        assert one(spark, f"bloom_filter_contains_all({bad}, {a})") is None
        assert one(spark, f"bloom_filter_contains_all({bad}, CAST(array() AS ARRAY<STRING>))") is True
    assert one(spark, call.format(a, a, "CAST(NULL AS BINARY)")) is None


def test_bloom_layout(spark):
    blob = one(spark, "bloom_filter_create(array('hello', 'world'))")
    assert blob[:16] == bloom.MAGIC.to_bytes(4, "little") + (64).to_bytes(4, "little") + (3).to_bytes(4, "little") + bytes(4)
    assert len(blob) == 16 + 8
    assert one(spark, "bloom_filter_create(CAST(NULL AS ARRAY<STRING>))") is None
    assert one(spark, "octet_length(bloom_filter_create(CAST(array() AS ARRAY<STRING>)))") == 24
    many = "transform(sequence(1, 19), x -> CAST(x AS STRING))"
    assert one(spark, f"octet_length(bloom_filter_create({many}, 10)) < octet_length(bloom_filter_create({many}, 64))")
    assert one(spark, "octet_length(bloom_filter_create(array('a'), 1000, 99))") == 24  # 64 bits and 16 functions at most
    assert one(spark, "hex(substring(bloom_filter_create(array('a'), 1000, 99), 9, 4))") == "10000000"


def test_bloom_membership(spark):
    made = "bloom_filter_create(transform(sequence(1, 100), x -> concat('item_', x)))"
    assert one(spark, f"bloom_filter_contains({made}, 'item_50')") is True
    assert one(spark, f"bloom_filter_contains({made}, 'item_999')") is False
    assert one(spark, f"bloom_filter_contains({made}, CAST(NULL AS STRING))") is None
    assert one(spark, f"bloom_filter_contains_all({made}, array('item_1', NULL, 'item_100'))") is True
    assert one(spark, "bloom_filter_contains(bloom_filter_create(CAST(array() AS ARRAY<STRING>)), 'a')") is False


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=12)), max_size=60), st.integers(1, 64), st.integers(1, 16))
def test_no_false_negatives(spark, items, bits, hashes):
    df = spark.createDataFrame([(items,)], "items array<string>").withColumn("f", bloom.bloom_filter_create("items", bits, hashes))
    assert df.select(bloom.bloom_filter_contains_all("f", "items").alias("x")).head().x is True


def test_search_hint_and_version(spark):
    assert one(spark, "search_hint(CAST(NULL AS STRING), array('x'))") is True
    assert spark.range(5).where("search_hint('a', array('b'))").count() == 5
    assert one(spark, "engine_version()") == __version__
