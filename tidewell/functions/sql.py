"""The engine's functions under SQL names: temporary SQL functions, whose text Catalyst puts in place, and one for Arrow batches."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .. import __version__
from . import arrays, bloom


def search_hint(column: Column, values: Column) -> Column:
    """Always true: a hint that a server may use to search. Catalyst drops it from a filter."""
    return F.lit(True)


def version() -> Column:
    return F.lit(__version__)


FUNCTIONS = {
    "array_contains_all(h ARRAY<STRING>, n ARRAY<STRING>, columnar BOOLEAN DEFAULT true) RETURNS BOOLEAN": arrays.contains_all_sql("h", "n"),
    "array_contains_all_bloom(h ARRAY<STRING>, n ARRAY<STRING>, f BINARY) RETURNS BOOLEAN": arrays.contains_all_bloom_sql("h", "n", "f"),
    "bloom_filter_contains(f BINARY, item STRING) RETURNS BOOLEAN": bloom.contains_sql("f", "item"),
    "bloom_filter_contains_all(f BINARY, items ARRAY<STRING>) RETURNS BOOLEAN": bloom.contains_all_sql("f", "items"),
    "search_hint(c STRING, v ARRAY<STRING>) RETURNS BOOLEAN": "true",
    "engine_version() RETURNS STRING": f"'{__version__}'",
}


def register(spark: SparkSession) -> None:
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    spark.udf.register("bloom_filter_create", bloom.create)
