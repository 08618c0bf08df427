"""Bloom filters of whole texts against brute force, the empty and the null text among them."""

from __future__ import annotations

import hashlib
import math

import pytest

from tidewell.queries import QUERIES


def hashes(item: str, m: int) -> list[int]:
    b = int(hashlib.md5(item.encode()).hexdigest()[:12], 16)
    return [(b + i * (b >> 16) + i * i) % m for i in range(3)]


def made(text: str | None) -> bytes | None:
    if text is None:
        return None
    items = text.split(" ")
    m = math.ceil(min(max(len(items) * 10, 64), 8_388_608) / 8) * 8
    bits = bytearray(m // 8)
    for item in set(items):
        for p in hashes(item, m):
            bits[p // 8] |= 1 << p % 8
    return b"MOLB" + m.to_bytes(4, "little") + (3).to_bytes(4, "little") + bytes(4) + bytes(bits)


def has(blob: bytes | None, words: tuple) -> bool | None:
    if blob is None:
        return None
    bits = blob[16:]
    return all(bits[p // 8] >> p % 8 & 1 for w in words for p in hashes(w, 8 * len(bits)))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("bloom"))
    filler = " ".join(f"w{i}" for i in range(40))
    own = [(-1, None), (-2, ""), (-3, f"{filler} the"), (-4, f"{filler} of x the"), (-5, " ".join(f"v{i}" for i in range(3000)))]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs.unionByName(spark.createDataFrame(own, "doc_id long, text string")).coalesce(4).write.parquet(f"{d}/documents.parquet")
    return d, {r.doc_id: made(r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()}


def test_bytes(spark, tables):
    got = {r.doc_id: r.filter and bytes.fromhex(r.filter) for r in QUERIES["bloom_create_bytes"](spark, tables[0]).collect()}
    assert got == tables[1]


@pytest.mark.parametrize(("name", "words"), [("bloom_contains", ("the",)), ("bloom_contains_all", ("the", "of"))])
def test_contains(spark, tables, name, words):
    got = {r.doc_id: r.may for r in QUERIES[name](spark, tables[0]).collect()}
    assert got == {i: has(blob, words) for i, blob in tables[1].items()}
    assert got[-4] and (got[-3] or len(words) > 1)  # words behind the fortieth
