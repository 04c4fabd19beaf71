"""Whole-batch text helpers used inside tasks.

An Arrow string column is one byte buffer with offsets, so words, lines and
their hashes are found for many documents at once with numpy. Work goes in
chunks of bounded size; a single text is never cut.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20
#: For passes that hold many numbers a byte: a worker process keeps what its largest chunk took.
SMALL_BYTES = 1 << 18

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Word separators: 0x20 and 0x09-0x0D.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_rng = np.random.default_rng(20240607)
_BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
#: A second polynomial, modulo a prime: modulo 2 ** 64 alone, long texts of one self-similar
#: pattern and its opposite would agree for any base.
_PRIME = (1 << 31) - 1
_PRIME_CODE = _rng.integers(1, _PRIME, 256, dtype=np.uint64)
_PRIME_BASE = 1_000_003_579
_prime_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x = x * np.uint64(0xA0761D6478BD642F)
    x ^= x >> np.uint64(32)
    return x


def _table_size(n: int) -> int:
    return SMALL_BYTES + 2 if n <= SMALL_BYTES + 2 else max(n, CHUNK_BYTES + 2)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = _table_size(n)
        for k, base in enumerate((_BASE, _BASE_INV)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0], _powers[1]


def _prime_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_prime_powers[0]) < n:
        size = _table_size(n)
        for k, base in enumerate((_PRIME_BASE, pow(_PRIME_BASE, -1, _PRIME))):
            table = np.ones(1, np.uint64)
            while len(table) < size:   # powers below 2 ** 31, so products fit
                step = np.uint64(pow(base, len(table), _PRIME))
                table = np.concatenate([table, table * step % np.uint64(_PRIME)])
            _prime_powers[k] = table[:size]
    return _prime_powers[0], _prime_powers[1]


class Chunk:
    """The texts of some rows as one byte array with offsets."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = LOWER[data] if lower else data
        self.offsets = offsets.astype(np.int64)
        self.n = len(offsets) - 1
        self._sums = self._prime_sums = self._words = None

    def sums_by_row(self, flags: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flags) + 1, dtype=np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def span_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of each byte span; equal bytes give equal hashes."""
        power, inverse = _power_tables(len(self.data) + 1)
        prime_power, prime_inverse = _prime_tables(len(self.data) + 1)
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
            np.cumsum(_BYTE_CODE[self.data] * power[:len(self.data)], out=self._sums[1:])
            prime = np.uint64(_PRIME)
            self._prime_sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
            np.cumsum(_PRIME_CODE[self.data] * prime_power[:len(self.data)] % prime,
                      out=self._prime_sums[1:])
        second = (self._prime_sums[ends] - self._prime_sums[starts]) % np.uint64(_PRIME)
        second = second * prime_inverse[starts] % np.uint64(_PRIME)
        return mix64((self._sums[ends] - self._sums[starts]) * inverse[starts]
                     + mix64(second + np.uint64(1)))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and row of each word, in text order."""
        if self._words is None:
            space = IS_SPACE[self.data]
            edge = np.zeros(len(self.data) + 1, dtype=bool)
            edge[self.offsets] = True
            before = np.ones(len(self.data) + 1, dtype=bool)
            before[1:] = space
            after = np.ones(len(self.data) + 1, dtype=bool)
            after[:-1] = space
            starts = np.flatnonzero(~after & (before | edge))
            ends = np.flatnonzero(~before & (after | edge))
            rows = np.searchsorted(self.offsets, starts, side="right") - 1
            self._words = (starts, ends, rows)
        return self._words

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.words()[2], minlength=self.n)

    def word_hashes(self) -> np.ndarray:
        starts, ends, _ = self.words()
        return self.span_hash(starts, ends)

    def keep(self, rows: np.ndarray) -> "Chunk":
        """The chunk of the given rows (ascending row numbers)."""
        sizes = self.offsets[rows + 1] - self.offsets[rows]
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(self.offsets[rows] - offsets[:-1], sizes) + np.arange(offsets[-1])
        return Chunk(self.data[at], offsets)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = pc.fill_null(column, pa.scalar(b"" if "binary" in str(column.type) else "",
                                               column.type))
    _, at, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if at is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(at, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, lower: bool = False,
           limit: int = CHUNK_BYTES, rows: int | None = None) -> Iterator[tuple[int, int, Chunk]]:
    """Yield ``(first row, end row, Chunk)`` pieces of about ``limit`` bytes and ``rows`` rows at most."""
    data, offsets = buffers(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), n, first + (rows or n))
        yield first, end, Chunk(data[offsets[first]:offsets[end]],
                                offsets[first:end + 1] - offsets[first], lower)
        first = end


def shingles(chunk: Chunk, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``(row, hash)`` of the k-word shingles, sorted by row and hash.

    A text of fewer than ``k`` words has its whole word sequence as one
    shingle; a text without words has none.
    """
    hashes, rows = chunk.word_hashes(), chunk.words()[2]
    counts = chunk.word_counts()
    ends = np.cumsum(counts)[rows] if len(rows) else rows
    left = ends - np.arange(len(rows))
    value = np.zeros(len(rows), dtype=np.uint64)
    for j in range(k):
        part = np.zeros(len(rows), dtype=np.uint64)
        part[:len(rows) - j] = hashes[j:] if j else hashes
        inside = left > j
        value[inside] = mix64(value[inside] * np.uint64(0x9E3779B97F4A7C15) + part[inside])
    whole = np.minimum(counts, k)[rows] if len(rows) else rows
    pick = left >= whole
    rows, value = rows[pick], value[pick]
    order = np.lexsort((value, rows))
    rows, value = rows[order], value[order]
    fresh = np.ones(len(rows), dtype=bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (value[1:] != value[:-1])
    return rows[fresh], value[fresh]


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None],
                schema: str) -> DataFrame:
    """``mapInArrow`` with a function from one record batch to one."""
    def run(batches):
        for batch in batches:
            out = fn(batch)
            if out is not None:
                yield out
    return df.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(column, n: int):
    """``crc32`` of the id written as text, modulo ``n``: the held-out split."""
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(n))
