"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

from tradelake.session import scratch_path

#: Text bytes that a task holds decoded at once.
BLOCK_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read back: the
    lineage ends there, so a lost executor costs no more than its own tasks."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    if scopes := getattr(_SCOPES, "open", None):
        scopes[-1].append((back, path))
    return back


_SCOPES = threading.local()


@contextmanager
def released(spark: SparkSession) -> Iterator[Callable]:
    """Tables that ``written`` makes inside are deleted at the end, but for those
    handed to the function it yields (which returns them); those pass to the scope
    around it.  Nothing that is used later may read a deleted table."""
    scopes = _SCOPES.__dict__.setdefault("open", [])
    made: list[tuple[DataFrame, str]] = []
    kept: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df)
        return df

    scopes.append(made)
    try:
        yield keep
    finally:
        scopes.pop()
        for df, path in made:
            if any(df is k for k in kept):
                if scopes:
                    scopes[-1].append((df, path))
            else:
                folder = spark._jvm.org.apache.hadoop.fs.Path(path)
                folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        made.clear()
        spark._jvm.System.gc()         # lets Spark drop shuffle files of plans that are gone


def give_back() -> None:
    """Return freed memory of this worker process to the system: workers are
    used again by later stages, beside others."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):      # another C library
        pass


def blocks(batch: pa.RecordBatch, columns: list[str], limit: int = BLOCK_BYTES
           ) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each (one row at least)."""
    sizes = np.zeros(batch.num_rows, dtype=np.int64)
    for name in columns:
        sizes += pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(
            zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        base = int(ends[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end
    give_back()


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts (no nulls) one after the other, and their offsets."""
    buffers, n = texts.buffers(), len(texts)
    offsets = np.frombuffer(buffers[1], np.int32, n + 1, texts.offset * 4).astype(np.int64)
    size = int(offsets[-1] - offsets[0])
    data = (np.frombuffer(buffers[2], np.uint8, size, int(offsets[0])) if size
            else np.zeros(0, np.uint8))
    return data, offsets - offsets[0]


def split_words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text (null: none).

    Returns word codes in text order, the offsets of each text's words in
    them, and the distinct words that the codes name.  ``lower`` lower-cases
    A-Z first.
    """
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = offsets - offsets[0]
    blank = pc.index(coded.dictionary, "").as_py() if len(coded.dictionary) else -1
    if blank >= 0:                       # from space at either end of a text
        keep = codes != blank
        before = np.concatenate([[0], np.cumsum(keep)])
        codes, offsets = codes[keep], before[offsets]
    return codes, offsets, coded.dictionary


def hash_strings(words: pa.Array) -> np.ndarray:
    """64-bit hash of each string, alike on every machine."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w) for w in words.cast(pa.binary()).to_pylist()), np.uint64,
                       len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit hashes (xor-shift and odd multipliers)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(32))


def mix_int(x: int) -> int:
    """``mix`` of one small integer."""
    return int(mix(np.array([x + 1], np.uint64))[0])


_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """First ``n`` powers of the hash base and of its inverse mod 2^64."""
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[:1] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def window_hashes(hashes: np.ndarray, offsets: np.ndarray, width: int
                  ) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp hashes of all ``width``-word windows inside one text.

    A window's polynomial mod 2^64 is the difference of two prefix sums,
    brought to a common origin by an inverse power.  Returns the hashes and
    their start positions in ``hashes``.
    """
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    up, down = _powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up, dtype=np.uint64, out=sums[1:])
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(n)
    starts = np.flatnonzero(left >= width)
    return mix((sums[starts + width] - sums[starts]) * down[starts]), starts
