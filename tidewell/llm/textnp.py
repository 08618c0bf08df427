"""Text of Arrow columns as numpy bytes: words and their hashes for a whole batch at once."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_rng = np.random.Generator(np.random.PCG64(20240229))
#: A random 64-bit value for each byte.
BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
#: An odd multiplier, and its inverse modulo 2**64.
MULT = np.uint64(0x9E3779B97F4A7C15)
MULT_INV = np.uint64(pow(int(MULT), -1, 2**64))
#: Space and \t to \r.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of text worked on at a time; a longer text is one piece.
PIECE = 1 << 19
#: Powers that a worker keeps. They are made there: a module's tables travel with each function that is sent to the workers.
POWERS = 1 << 20


def kept(key: str, make):
    """``make()``, once for each Python worker: its later tasks get the same object."""
    own = sys.modules.setdefault("tidewell_worker", types.ModuleType("tidewell_worker")).__dict__
    if key not in own:
        own[key] = make()
    return own[key]


def powers(n: int, base: np.uint64 = MULT) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """The finisher of splitmix64, in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the offsets between them; null is empty."""
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    texts = texts.cast(pa.large_binary())
    _, ends, data = texts.buffers()
    if ends is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    every = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return every[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(texts: pa.Array, size: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of texts of about ``size`` bytes."""
    data, offsets = text_bytes(texts)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def spans(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of word bytes, none crossing texts, and for each text the index of its first run."""
    n = len(is_word)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = is_word[:-1]
    starts = np.flatnonzero(is_word & (~before | edge[:-1]))
    after = np.zeros(n, bool)
    after[:-1] = is_word[1:]
    ends = np.flatnonzero(is_word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans are in order and don't overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    length = ends - starts
    at = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    value = BYTE[data[at + np.repeat(starts, length)]]
    value *= powers(int(length.max()))[at]
    return mix(np.add.reduceat(value, np.cumsum(length) - length) + length.astype(np.uint64))


def span_sums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, by sums over all of ``data``: of few temporary numbers for each byte."""
    n = len(data)
    up, down = kept("powers", lambda: (powers(POWERS), powers(POWERS, MULT_INV))) if n <= POWERS else (powers(n), powers(n, MULT_INV))
    sums = np.zeros(n + 1, np.uint64)
    value = BYTE[data]
    value *= down[:n]
    np.cumsum(value, out=sums[1:])
    out = sums[ends] - sums[starts]
    out *= up[np.minimum(starts, max(0, n - 1))] if n else np.uint64(1)
    return mix(out + (ends - starts).astype(np.uint64))
