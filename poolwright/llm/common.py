"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word rules: space, \t, \n, \v, \f, \r.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"


def column(df: DataFrame, name: str, kind: str) -> Column:
    """Column ``name`` of ``df`` as ``kind``; nulls of that kind where ``df`` has none."""
    names = [c for c in df.columns if c.lower() == name.lower()]
    return (df[names[0]] if names else F.lit(None)).cast(kind)


def utf8(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a string array and the offsets of each; null is empty."""
    values = values.fill_null("") if values.null_count else values
    values = values.cast(pa.large_string())
    _, offsets, data = values.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(values) + 1, values.offset * 8)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[bounds[0] : bounds[-1]] if len(values) else flat[:0], bounds - bounds[0]


@contextmanager
def frugal(spark: SparkSession, most: int = 8 << 20):
    """Settings for the steps that an operator runs at once.

    Batches that go to Python have about ``most`` bytes, which bounds a task's memory, and
    shuffle files go when the step that wrote them has ended, not when the driver
    happens to collect its garbage.
    """
    wanted = {"spark.sql.execution.arrow.maxBytesPerBatch": str(most), "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def in_slices(batches: Iterator[pa.RecordBatch], text: str, most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds about ``most`` bytes of ``text``, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, bounds = utf8(batch.column(text))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(bounds, bounds[start] + most, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: Odd multiplier of the word hash, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


@lru_cache(maxsize=4)
def _powers(base: int, bits: int) -> np.ndarray:
    out = np.full(1 << bits, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept for the lengths of usual blocks."""
    bits = max(12, n.bit_length())
    return (_powers if bits <= 20 else _powers.__wrapped__)(base, bits)[:n]


def word_bounds(flat: np.ndarray, bounds: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every run of bytes that ``inside`` holds, and the words before each text."""
    held = inside[flat]
    first = np.zeros(len(flat) + 1, bool)
    first[bounds] = True  # a text begins a word
    starts = np.flatnonzero(held & (first[:-1] | ~np.concatenate([[False], held[:-1]])))
    ends = np.flatnonzero(held & (first[1:] | ~np.concatenate([held[1:], [False]]))) + 1
    return starts, ends, np.searchsorted(starts, bounds)


#: Bytes of words, white space aside.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[list(SPACES)] = False


def word_hashes(flat: np.ndarray, bounds: np.ndarray, inside: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, A-Z in lower case, and the words before each text."""
    n = len(flat)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    starts, ends, at = word_bounds(flat, bounds, inside)
    table = np.arange(1, 257, dtype=np.uint64)
    table[65:91] += np.uint64(32)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(table[flat] * powers(BASE, n), out=sums[1:])
    value = (sums[ends] - sums[starts]) * powers(INVERSE, n)[starts]
    value += (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mixed(value), at


def shingles(flat: np.ndarray, bounds: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``size``-word shingles of every text; a shorter text is one shingle, an empty one none."""
    words, at = word_hashes(flat, bounds)
    n = len(words)
    rolled = np.zeros(max(0, n - size + 1), np.uint64)
    for k in range(size):
        rolled += words[k : n - size + 1 + k] * np.uint64((0xA24BAED4963EE407 * (2 * k + 1)) % (1 << 64))
    rolled = mixed(rolled)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            value = 0
            for k, w in enumerate(words[a:b].tolist()):
                value += w * (0xA24BAED4963EE407 * (2 * k + 1))
            out.append(mixed(np.array([(value + b - a) % (1 << 64)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
