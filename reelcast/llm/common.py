"""Helpers shared by the operators of this subpackage: checked broadcasts, text blocks, hashes, vector sums."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelcast.session import settled, stage_table  # noqa: F401

# rows up to which a small side is broadcast after it was counted; beyond it Spark plans a shuffled join
BROADCAST_ROWS = 200_000
# bytes of text that one vectorised block holds at most (a longer single text is its own block)
BLOCK_BYTES = (1 << 20) - 1
# the same for operators that share an executor with the pipeline's other stages
SMALL_BLOCK = (1 << 18) - 1

# bytes of rows that Spark hands to a Python worker at a time; a batch is held by the JVM and by the worker, on every core
ARROW_BYTES = 4 << 20
_ARROW_KEY, _ARROW_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def small_batches(df: DataFrame) -> DataFrame:
    """``df`` as it is; its session cuts Arrow batches at ``ARROW_BYTES`` from now on, unless it has a bound of its
    own already."""
    conf = df.sparkSession.conf
    if conf.get(_ARROW_KEY, _ARROW_DEFAULT) == _ARROW_DEFAULT:
        conf.set(_ARROW_KEY, str(ARROW_BYTES))
    return df


# what a Python worker keeps from one task of an operator to the next, by operator
_KEPT: dict[str, dict] = {}


def kept(operator: str) -> dict:
    """The objects that this worker keeps for ``operator``; they go when a ``lean`` task of another operator begins."""
    return _KEPT.setdefault(operator, {})


def _trim() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim is not None:
        trim(0)


def lean(run, operator: str | None = None):
    """``run`` as a function of a Python worker that gives the memory it has freed back to the system when a task ends:
    the worker lives on beside the next stages.  What it kept for operators other than ``operator`` goes first."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        others = [name for name in _KEPT if name != operator]
        if others:
            for name in others:
                del _KEPT[name]
            gc.collect()
            _trim()
        try:
            yield from run(batches)
        finally:
            _trim()
    return task


def sized_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only after counting at most ``max_rows + 1`` rows; a larger side is left to a shuffled join."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def lower_ascii(col):
    """A-Z to a-z only; every other character stays."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def utf8_blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut an Arrow text column into blocks of whole texts: (first row, end row, bytes, offsets from 0).
    Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=column.offset + n + 1)[column.offset:]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + block_bytes, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    s = np.uint64(33)
    x = (x ^ (x >> s)) * _MIX1
    x = (x ^ (x >> s)) * _MIX2
    return x ^ (x >> s)


class RollingHash:
    """Polynomial hash (mod 2**64, bytes mapped to random odd 64-bit values) of any substring from one prefix sum:
    ``h(a, b) = (P[b] - P[a]) * base**-a``, mixed.  Equal bytes give equal hashes wherever they stand."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rng.integers(0, 2**62)) * 4 + 1 | 0x10
        self.inverse = pow(self.base, -1, 2**64)
        self._up = self._powers(self.base, 1 << 16)
        self._down = self._powers(self.inverse, 1 << 16)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if n > len(self._up):
            size = 1 << (n - 1).bit_length()
            self._up, self._down = self._powers(self.base, size), self._powers(self.inverse, size)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.table[data] * self._up[:len(data)], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64((prefix[ends] - prefix[starts]) * self._down[starts])

    def windows(self, prefix: np.ndarray, width: int) -> np.ndarray:
        """Hash of every window of ``width`` bytes."""
        n = len(prefix) - width
        return mix64((prefix[width:] - prefix[:n]) * self._down[:n]) if n > 0 else np.zeros(0, np.uint64)


def i64(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64) if values.dtype == np.uint64
                    else values.astype(np.int64))


def sum_vectors(rows: DataFrame, key: str, key_type: str) -> DataFrame:
    """(key, total binary): element-wise sums of the int64 vectors in ``counts``, first over the rows of one of 64
    ``task`` classes, then over classes, so no group holds more than a 64th of a key's rows."""
    schema = f"{key} {key_type}, task int, counts binary"

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in table["counts"].to_pylist())
        return pa.table({key: table[key][:1], "task": table["task"][:1],
                         "counts": pa.array([np.asarray(total).tobytes()], pa.binary())})

    return rows.groupBy(key, "task").applyInArrow(add, schema).groupBy(key).applyInArrow(add, schema).select(
        key, "counts")
