"""Shared pieces: durable tables, prefix names, and vectorised word hashing of Arrow text.

Words of the near-duplicate and classifier stages are maximal runs of ASCII letters (lower-cased),
ASCII digits and bytes of non-ASCII characters; everything else separates.
"""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

SLICE = 1 << 20  # bytes hashed at once: bounds the arrays whatever a text's length
_P = 0x9E3779B97F4A7C15 | 1
_U = np.uint64


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, from spark.checkpoint.dir. A session on one machine gets a new one where that is
    unset; on a cluster an unset folder is an error, as executors would not see each other's files."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="checkpoints-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def shared_path(spark: SparkSession, kind: str) -> str:
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"


_SCOPES: list[list[DataFrame]] = []


@contextmanager
def scratch() -> Iterator[None]:
    """Deletes the tables that durable() writes inside, but for those that stay; no result may still need them."""
    _SCOPES.append([])
    try:
        yield
    finally:
        release(*_SCOPES.pop())


def durable(df: DataFrame, kind: str = "t", stays: bool = False) -> DataFrame:
    """df written to the shared folder and read again: lineage is cut and a lost executor loses nothing."""
    path = shared_path(df.sparkSession, kind)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.durable_path = path
    if _SCOPES and not stays:
        _SCOPES[-1].append(out)
    return out


def release(*frames: DataFrame) -> None:
    """Deletes the tables of durable() that nothing will read again."""
    for df in frames:
        if path := getattr(df, "durable_path", None):
            spark = df.sparkSession
            own = spark._jvm.org.apache.hadoop.fs.Path(path)
            own.getFileSystem(spark._jsc.hadoopConfiguration()).delete(own, True)


@contextmanager
def short_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Whole texts go to Python in batches of so many rows in the actions inside; a batch is held on both sides."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def tidy(run: Callable) -> Callable:
    """A function for mapInArrow that gives freed memory back at its end, as its worker waits for further tasks with what it holds."""

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc's
                trim(0)

    return wrapped


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix64(x: np.ndarray) -> np.ndarray:
    """A full-avalanche permutation of 64-bit values."""
    out = x >> _U(30)
    out ^= x
    out *= _U(0xBF58476D1CE4E5B9)
    high = out >> _U(27)
    out ^= high
    out *= _U(0x94D049BB133111EB)
    np.right_shift(out, _U(31), out=high)
    out ^= high
    return out


def utf8(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = pa.large_binary() if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else pa.large_string()
    col = col.cast(kind).fill_null(b"" if kind == pa.large_binary() else "")
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def _fold_table() -> np.ndarray:
    t = np.zeros(256, np.uint8)
    for lo, hi in ((48, 57), (97, 122), (128, 255)):
        t[lo : hi + 1] = np.arange(lo, hi + 1)
    t[65:91] = np.arange(97, 123)
    return t


FOLD = _fold_table()
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^0.. and P^-0.. modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        n = max(n, SLICE + 4096)
        inverse = pow(_P, -1, 1 << 64)
        _POWERS[:] = [np.multiply.accumulate(np.r_[_U(1), np.full(n - 1, _U(b))]) for b in (_P, inverse)]
    return _POWERS[0], _POWERS[1]


def word_hashes(col, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """64-bit hash of every word in order, the row each word stands in, and the hashes of the words' first
    bytes, of each length in prefixes (0 where the word is not longer)."""
    data, off = utf8(col)
    hashes, places, more = [], [], [[] for _ in prefixes]
    at, n = 0, len(data)
    opens = np.zeros(n + 1, bool)
    opens[off[:-1]] = True
    while at < n:
        end = min(n, at + SLICE)
        while end < n:  # a slice ends where no word runs on
            ahead = FOLD[data[end : end + 4096]] == 0
            ahead |= opens[end : end + len(ahead)]
            if ahead.any():
                end += int(ahead.argmax())
                break
            end += len(ahead)
        x = FOLD[data[at:end]]
        word = x != 0
        edge = opens[at:end]
        first = word.copy()
        first[1:] &= ~word[:-1] | edge[1:]
        last = word.copy()
        last[:-1] &= ~word[1:] | edge[1:]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        up, down = _powers(len(x) + 1)
        total = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(x.astype(np.uint64) * up[: len(x)], out=total[1:])
        hashes.append(mix64((total[e] - total[s]) * down[s]))
        places.append(s + at)
        for n_bytes, own in zip(prefixes, more, strict=True):
            on = e - s > n_bytes
            h = np.zeros(len(s), np.uint64)
            h[on] = mix64((total[s[on] + n_bytes] - total[s[on]]) * down[s[on]] + _U(n_bytes))
            own.append(h)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), *(np.zeros(0, np.uint64) for _ in prefixes)
    where = np.concatenate(places)
    return np.concatenate(hashes), np.searchsorted(off, where, "right") - 1, *(np.concatenate(x) for x in more)


def shingles(col, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of k words, and its row; a text of 1 to k-1 words is one shingle."""
    w, row = word_hashes(col)
    n = len(w)
    if not n:
        return w, row
    q = [pow(0xD6E8FEB86659FD93 | 1, j + 1, 1 << 64) for j in range(k)]
    m = max(0, n - k + 1)
    total = np.zeros(m, np.uint64)
    for j in range(k):
        total += w[j : j + m] * _U(q[j])
    whole = row[:m] == row[k - 1 :] if m else np.zeros(0, bool)
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    length = np.diff(np.r_[first, n])
    short = np.flatnonzero(length < k)
    extra = np.zeros(len(short), np.uint64)
    for j in range(k - 1):
        on = length[short] > j
        extra[on] += w[first[short][on] + j] * _U(q[j])
    h = mix64(np.r_[total[whole], extra + _U(k)])
    r = np.r_[row[:m][whole], row[first[short]]]
    order = np.argsort(r, kind="stable")
    return h[order], r[order]


def row_slices(col, size: int = 4 * SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about size bytes of text each (a longer text stands alone)."""
    _, off = utf8(col)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + size, "right")) - 1)
        yield lo, min(hi, n)
        lo = hi
