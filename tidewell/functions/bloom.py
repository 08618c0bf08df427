"""Bloom filters of string arrays as binary values: made for whole Arrow batches at once, asked in SQL expressions alone.

Layout, little-endian: four 32-bit words (magic, bits, hash functions, 0), then the bits, lowest first. The
i-th hash of an item is ``b + i * (b >> 16) + i * i`` with b the first 48 bits of its MD5, so that any engine
with MD5 can read a filter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

# Fixed values of the layout.
MAGIC, HEADER = 0x424C4F4D, 16
BITS, HASHES = 10, 3
MIN_BITS, MAX_BITS = 64, 8_388_608


def _base(item: str) -> str:
    return f"CAST(conv(substr(md5(CAST({item} AS BINARY)), 1, 12), 16, 10) AS BIGINT)"


def _or(values: pa.Array | None, size: int, default: int, most: int) -> np.ndarray:
    """``values`` within 1 and ``most``, and ``default`` for nulls and where there are none."""
    if values is None:
        return np.full(size, default, np.int64)
    return np.clip(values.cast(pa.int64()).fill_null(default).to_numpy(zero_copy_only=False), 1, most)


def filters(items: pa.Array, bits: pa.Array | None = None, hashes: pa.Array | None = None) -> pa.Array:
    """A filter of each array's items that aren't null; null for a null array.

    It has ten (or ``bits``) bits for each item, nulls too, within the limits and in whole bytes.
    """
    n = len(items)
    sizes = items.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    room = np.clip(np.maximum(sizes, 1) * _or(bits, n, BITS, 64), MIN_BITS, MAX_BITS)
    room, k = -(-room // 8) * 8, _or(hashes, n, HASHES, 16)
    words = items.flatten().dictionary_encode()
    base = np.array([int.from_bytes(hashlib.md5(w.encode()).digest()[:6], "big") for w in words.dictionary.to_pylist()], np.int64)
    own = words.indices.is_valid().to_numpy(zero_copy_only=False)
    row, b = np.repeat(np.arange(n), sizes)[own], base[words.indices.fill_null(0).to_numpy(zero_copy_only=False)[own]] if len(base) else base
    ends = np.cumsum(HEADER + room // 8)
    starts = ends - HEADER - room // 8
    out = np.zeros(int(ends[-1]) if n else 0, np.uint8)
    head = np.stack([np.full(n, MAGIC), room, k, np.zeros(n, np.int64)], axis=1).astype("<u4").view(np.uint8).reshape(n, HEADER)
    out[starts[:, None] + np.arange(HEADER)] = head
    for i in range(int(k.max(initial=0))):
        some = k[row] > i
        bit = (b[some] + i * (b[some] >> 16) + i * i) % room[row[some]]
        np.bitwise_or.at(out, starts[row[some]] + HEADER + bit // 8, (1 << (bit % 8)).astype(np.uint8))
    made = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(np.r_[0, ends].astype(np.int64).tobytes()), pa.py_buffer(out)])
    return pa.compute.if_else(items.is_valid(), made, pa.scalar(None, pa.large_binary())).cast(pa.binary())


@F.arrow_udf(BinaryType())
def create(items: pa.Array, bits: pa.Array = None, hashes: pa.Array = None) -> pa.Array:
    return filters(items, bits, hashes)


def _word(blob: str, at: int) -> str:
    return f"CAST(conv(hex(concat(substring({blob}, {at + 4}, 1), substring({blob}, {at + 3}, 1), substring({blob}, {at + 2}, 1), substring({blob}, {at + 1}, 1))), 16, 10) AS BIGINT)"


def valid_sql(blob: str) -> str:
    """Whether the header and the length are those of a filter."""
    return (
        f"(octet_length({blob}) >= {HEADER} AND substring({blob}, 1, 4) = X'{MAGIC.to_bytes(4, 'little').hex()}' "
        f"AND {_word(blob, 4)} > 0 AND octet_length({blob}) >= {HEADER} + CAST(ceil({_word(blob, 4)} / 8) AS BIGINT))"
    )


def _has(blob: str, item: str) -> str:
    bit = "(b + i * shiftrightunsigned(b, 16) + i * i) % m"
    byte = f"CAST(conv(hex(substring({blob}, CAST({HEADER} + 1 + ({bit}) DIV 8 AS INT), 1)), 16, 10) AS INT)"
    return (
        f"transform(array({_word(blob, 4)}), m -> transform(array({_base(item)}), b -> forall(sequence(0, CAST(least({_word(blob, 8)}, 16) AS INT) - 1), "
        f"i -> ({byte} & shiftleft(1, CAST(({bit}) % 8 AS INT))) <> 0))[0])[0]"
    )


def contains_sql(blob: str, item: str) -> str:
    """Whether ``item`` may be in the filter; null for nulls and invalid filters."""
    return f"CASE WHEN {blob} IS NULL OR {item} IS NULL OR NOT {valid_sql(blob)} THEN NULL ELSE {_has(blob, item)} END"


def contains_all_sql(blob: str, items: str) -> str:
    """Whether all items that aren't null may be in the filter; true for no items, even of an invalid filter."""
    return (
        f"CASE WHEN {blob} IS NULL OR {items} IS NULL THEN NULL WHEN size({items}) = 0 THEN true WHEN NOT {valid_sql(blob)} THEN NULL "
        f"ELSE forall(array_compact({items}), z -> {_has(blob, 'z')}) END"
    )


def bloom_filter_create(items: str, bits: str | int = BITS, hashes: str | int = HASHES) -> Column:
    return create(F.expr(items).cast("array<string>"), F.expr(str(bits)).cast("int"), F.expr(str(hashes)).cast("int"))


def bloom_filter_contains(blob: str, item: str) -> Column:
    return F.expr(contains_sql(blob, item))


def bloom_filter_contains_all(blob: str, items: str) -> Column:
    return F.expr(contains_all_sql(blob, items))
