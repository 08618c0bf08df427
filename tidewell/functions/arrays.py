"""Containment of arrays of strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import bloom


def contains_all_sql(hay: str, needles: str) -> str:
    """Whether every needle that isn't null is in ``hay``. Null arrays give null; no needles, true; else an empty ``hay``, false."""
    return (
        f"CASE WHEN {hay} IS NULL OR {needles} IS NULL THEN NULL WHEN size({needles}) = 0 THEN true WHEN size({hay}) = 0 THEN false "
        f"ELSE size(array_except(array_compact({needles}), {hay})) = 0 END"
    )


def contains_all_bloom_sql(hay: str, needles: str, blob: str) -> str:
    """As ``contains_all_sql``, with a Bloom filter of ``hay`` that rules out most misses first; an invalid one gives null."""
    return (
        f"CASE WHEN {hay} IS NULL OR {needles} IS NULL OR {blob} IS NULL THEN NULL WHEN size({needles}) = 0 THEN true WHEN size({hay}) = 0 THEN false "
        f"ELSE {bloom.contains_all_sql(blob, needles)} AND size(array_except(array_compact({needles}), {hay})) = 0 END"
    )


def array_contains_all(hay: str, needles: str, columnar: bool | None = None, blob: str | None = None) -> Column:
    """Over columns or SQL expressions. ``columnar`` chose an implementation once and changes nothing."""
    return F.expr(contains_all_sql(hay, needles) if blob is None else contains_all_bloom_sql(hay, needles, blob))
