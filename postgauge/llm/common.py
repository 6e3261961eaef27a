"""Helpers shared by the operators: table access and words of Arrow text as arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text handled at once inside a task; a longer single text is handled alone.
SLICE_BYTES = 1 << 20

#: Bits of the bitmap that a large table is reduced with before it is joined.
BITMAP_BITS = 1 << 22
_BUCKET_BYTES = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def maybe_among(keys: DataFrame) -> Callable[[Column], Column]:
    """A test whether a number may be among those of ``keys`` (one long column).

    The numbers are hashed into a bitmap of fixed size, built by a combinable aggregate and
    sent to the tasks. The test has no false negatives; with many more numbers than bits it
    only lets more rows through. Null is never among them.
    """

    def spot(number: Column) -> Column:
        return F.pmod(F.xxhash64(number.cast("long")), F.lit(BITMAP_BITS))

    name = keys.columns[0]
    found = (
        keys.filter(F.col(name).isNotNull())
        .select(spot(F.col(name)).alias("spot"))
        .groupBy(F.bitmap_bucket_number("spot").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits"))
        .collect()
    )
    bits = np.zeros(BITMAP_BITS // 8 + 2 * _BUCKET_BYTES, dtype=np.uint8)
    for row in found:
        start = row["bucket"] * _BUCKET_BYTES
        bits[start : start + _BUCKET_BYTES] = np.frombuffer(row["bits"], np.uint8)
    sent = keys.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def held(bucket: pd.Series, position: pd.Series) -> pd.Series:
        bit = position.to_numpy()
        byte = sent.value[bucket.to_numpy() * _BUCKET_BYTES + bit // 8]
        return pd.Series((byte >> (bit % 8).astype(np.uint8) & 1).astype(bool))

    def test(number: Column) -> Column:
        at = spot(number)
        return number.isNotNull() & held(F.bitmap_bucket_number(at), F.bitmap_bit_position(at))

    return test


def without_ids(docs: DataFrame, gone: DataFrame, id_column: str) -> DataFrame:
    """The rows whose id is not in ``gone`` (one distinct long column); null ids stay.

    Only rows the bitmap cannot clear are shuffled to be compared with the ids.
    """
    maybe = maybe_among(gone)(docs[id_column].cast("long"))
    name = gone.columns[0]
    doubtful = docs.filter(maybe)
    sure = docs.filter(~maybe)
    return sure.unionByName(
        doubtful.join(gone, doubtful[id_column].cast("long") == gone[name], "left_anti")
    )


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over the result."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


#: One 64-bit number for each byte value, made by the rule above.
_BYTE_CODES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, size: int) -> np.ndarray:
    out = np.empty(size, dtype=np.uint64)
    out[0] = 1
    done = 1
    with np.errstate(over="ignore"):
        while done < size:
            step = min(done, size - done)
            out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
            done += step
    return out


_up = _down = np.ones(1, dtype=np.uint64)


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; kept only up to the usual slice size."""
    global _up, _down
    if len(_up) >= size:
        return _up, _down
    up, down = _powers(_BASE, size), _powers(_BASE_INVERSE, size)
    if size <= 2 * SLICE_BYTES:
        _up, _down = up, down
    return up, down


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def is_word_byte(separators: str) -> np.ndarray:
    """True for the bytes of words; ``separators`` are ASCII characters, so UTF-8 bytes suffice."""
    out = np.ones(256, dtype=bool)
    out[list(separators.encode("ascii"))] = False
    return out


#: Words are runs of anything but space and \x09-\x0D.
SPACED = is_word_byte(" \t\n\x0b\x0c\r")
#: Words are runs of a-z, 0-9 and everything beyond ASCII (text is lower-cased first).
ALNUM = is_word_byte(
    "".join(chr(c) for c in range(128) if not (48 <= c <= 57 or 97 <= c <= 122))
)


class Words:
    """Words of a slice of texts: byte span, row within the slice and 64-bit hash of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray):
        self.offsets = offsets
        self.data = data = LOWER[data]
        n = len(data)
        inside = word_bytes[data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1] | edge[1:n]
        last[:-1] &= ~inside[1:] | edge[1:n]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        rows = len(offsets) - 1
        #: Word range of row i: bounds[i] to bounds[i + 1].
        self.bounds = np.searchsorted(self.starts, offsets)
        self.rows = np.repeat(np.arange(rows), np.diff(self.bounds))
        self.hashes = self._hash()

    def _hash(self) -> np.ndarray:
        n = len(self.data)
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        up, down = _power_tables(n + 1)
        with np.errstate(over="ignore"):
            total = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(_BYTE_CODES[self.data] * down[:n], out=total[1:])
            spans = (total[self.ends] - total[self.starts]) * up[self.ends]
            spans += (self.ends - self.starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return mix64(spans)

    def text(self, start: int, end: int) -> list[bytes]:
        """The lower-cased words numbered ``start`` to ``end``."""
        return [
            self.data[a:b].tobytes()
            for a, b in zip(self.starts[start:end], self.ends[start:end], strict=True)
        ]


def text_slices(
    column: pa.Array, limit: int = SLICE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows [start, end) with their UTF-8 bytes and local offsets; null counts as empty.

    A slice holds about ``limit`` bytes, or a single longer text.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    marks = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    start = 0
    while start < len(column):
        end = int(np.searchsorted(marks, marks[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), len(column))
        local = marks[start : end + 1] - marks[start]
        yield start, end, raw[marks[start] : marks[end]], local
        start = end
