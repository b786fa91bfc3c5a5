"""Vectorised text kernels shared by the operators of this package.

They run inside ``mapInArrow`` tasks on the raw UTF-8 buffer of an Arrow string column, a bounded slice at a
time, so a task's memory does not depend on the size of its partition (a single text longer than a slice is a
slice of its own).
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from finlens.session import scratch_path

SLICE_BYTES = 2 << 20  # text bytes handled at once in a task
_RNG = np.random.default_rng(20240607)  # fixed seed: hashes are the same in every worker and run


def _odd(n: int) -> np.ndarray:
    return _RNG.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_BYTE_KEY = _odd(256)
_POS_KEY = _odd(1 << 12)
_LEN_KEY, _MIX_A, _MIX_B = _odd(3)
_SHINGLE_KEY = _odd(64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# Bytes of a word when words end at ASCII white space: everything but 0x20 and 0x09-0x0D.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
# Bytes of a word of letters and digits, every non-ASCII byte counting as a letter.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX_A
    h = (h ^ (h >> np.uint64(29))) * _MIX_B
    return h ^ (h >> np.uint64(32))


def text_slices(column, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets into the bytes) for runs of rows of about ``limit`` bytes; a null
    text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1)
        yield lo, hi, raw[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def span_hashes(keys: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """64-bit hash of consecutive runs of byte (or other) keys; ``lens`` are the run lengths, all positive."""
    if not len(lens):
        return np.zeros(0, np.uint64)
    end = np.cumsum(lens)
    at = np.arange(len(keys)) - np.repeat(end - lens, lens)
    far = at >= len(_POS_KEY)
    part = keys * _POS_KEY[at & (len(_POS_KEY) - 1)]
    if far.any():
        part[far] *= (2 * (at[far] // len(_POS_KEY)) + 1).astype(np.uint64) * _LEN_KEY
    return mix(np.add.reduceat(part, end - lens) + lens.astype(np.uint64) * _LEN_KEY)


def byte_words(data: np.ndarray, offs: np.ndarray, keep: np.ndarray, lower: bool = True):
    """Words of a slice: start and end bytes, 64-bit hashes, and for each text its first word (one more at the
    end).  Only A-Z is lower-cased.  Words never cross texts."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64), np.zeros(len(offs), np.int64)
    low = _LOWER[data] if lower else data
    k = keep[low]
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    st, en = k.copy(), k.copy()
    st[1:] &= ~k[:-1] | edge[1:-1]
    en[:-1] &= ~k[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(st), np.flatnonzero(en) + 1
    hashes = span_hashes(_BYTE_KEY[low[k]], ends - starts)
    return starts, ends, hashes, np.searchsorted(starts, offs)


def word_hash(words: list[bytes]) -> np.ndarray:
    """The hashes that byte_words() gives to these words."""
    if not words:
        return np.zeros(0, np.uint64)
    return span_hashes(_BYTE_KEY[np.frombuffer(b"".join(words), np.uint8)], np.array([len(w) for w in words]))


def shingle_sets(hashes: np.ndarray, first: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's ``width``-word shingles; with fewer words, of the whole sequence."""
    n = len(hashes)
    if n >= width:
        s = np.zeros(n - width + 1, np.uint64)
        for k in range(width):
            s += hashes[k : n - width + 1 + k] * _SHINGLE_KEY[k]
        s = mix(s)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= width:
            v = np.sort(s[a : b - width + 1])
            out.append(v[np.concatenate(([True], v[1:] != v[:-1]))])
        elif b > a:
            v = (hashes[a:b] * _SHINGLE_KEY[: b - a]).sum(dtype=np.uint64, keepdims=True)
            out.append(mix(v + np.array([b - a], np.uint64) * _LEN_KEY))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices of consecutive runs: starts[0], starts[0]+1, ... for each run."""
    end = np.cumsum(lens)
    return np.arange(end[-1] if len(end) else 0) + np.repeat(starts - (end - lens), lens)


def ship(spark: SparkSession) -> None:
    """Send this library to the executors (through Spark's file server), once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_finlens_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = os.path.join(tempfile.mkdtemp(prefix="finlens-ship-"), "finlens_lib.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(top):
            for name in files:
                if name.endswith(".py"):
                    z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), os.path.dirname(top)))
    sc.addPyFile(out)
    sc._finlens_shipped = True


BATCH_BYTES = 8 << 20  # of an Arrow batch, which the JVM and the Python worker hold at once


def arrow_map(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """mapInArrow with this library at hand in the tasks, in batches of bounded bytes (a session setting)."""
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def run(batches):
        try:
            yield from fn(batches)
        finally:
            _give_back()
    return df.mapInArrow(run, schema)


def _give_back() -> None:
    """Workers live on for other tasks: hand the memory that this one freed back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
