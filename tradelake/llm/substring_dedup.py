"""Exact substring dedup: Rabin-Karp hashes of every word window, counted in Spark.

Texts are shuffled once, to groups of a bounded size.  Every group sends the
leading bits of its windows' hashes, sorted and as differences, to hash
buckets, which tell each group what other groups have too.  Only of those
windows a group sends whole hashes, each with its smallest id, and learns which
of them start under a smaller id elsewhere.  With the smallest ids of its own it
then marks all repeated windows, and each text's are merged into maximal
removal intervals.

A window that a third of all texts share leaves a group once, whatever ids
they have.  Everything is linear in the number of windows, and groups and
buckets grow in number with the input.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.llm.common import give_back, hash_strings, split_words, window_hashes

#: Text bytes whose windows share a hash bucket, and whose texts share a group.
BUCKET_BYTES = 3_000_000
GROUP_BYTES = 4_000_000
#: Bits of a hash beyond those that number all windows.
SPARE_BITS = 10
_TOP = np.iinfo(np.int64).max


def pack(*columns: np.ndarray) -> bytes:
    """Equally long integer columns as byte planes above their minimum."""
    out = []
    for column in columns:
        column = np.ascontiguousarray(column, np.int64)
        low = int(column.min()) if len(column) else 0
        rest = column.view(np.uint64) - np.array([low], np.int64).view(np.uint64)
        width = (int(rest.max()).bit_length() + 7) // 8 if len(column) else 0
        planes = rest.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
        out.append(struct.pack("<QqB", len(column), low, width) + planes)
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpack(blob: bytes) -> list[np.ndarray]:
    data, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    while at < len(data):
        n, low, width = struct.unpack_from("<QqB", data, at)
        at += struct.calcsize("<QqB")
        rest = np.zeros((n, 8), np.uint8)
        rest[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n).T
        at += n * width
        out.append((rest.reshape(-1).view(np.uint64)
                    + np.array([low], np.int64).view(np.uint64)).view(np.int64))
    return out


def removal_intervals(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal intervals [from, to) covered by windows at the sorted ``starts``."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > window) + 1
    firsts = starts[np.concatenate([[0], cut])]
    lasts = starts[np.concatenate([cut - 1, [len(starts) - 1]])]
    return list(zip(firsts.tolist(), (lasts + window).tolist(), strict=True))


def _packed_buckets(values: np.ndarray, top: np.ndarray, n_buckets: int, *columns: np.ndarray
                    ) -> tuple[list[int], list[bytes]]:
    """Sorted ``values`` and their ``columns`` as one packed row per bucket; ``top`` are the
    leading 32 bits, which the buckets divide evenly."""
    bucket = (top * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)
    first = _news(bucket)
    bounds = [*first.tolist(), len(bucket)]
    return bucket[first].tolist(), [
        pack(_steps(values[a:b]), *(c[a:b] for c in columns))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _news(ordered: np.ndarray) -> np.ndarray:
    """Places where a new value begins."""
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[:len(ordered)])


def _steps(values: np.ndarray) -> np.ndarray:
    """Sorted 64-bit values as their differences, which pack into fewer bytes."""
    return np.diff(values, prepend=np.uint64(0)).view(np.int64)


def _summed(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps.view(np.uint64), dtype=np.uint64)


def _holds(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which ``values`` are among ``sorted_values``."""
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[at] == values


def _lists(group: list[int], blobs: list[bytes]) -> pa.Table:
    return pa.table({"group": pa.array(group, pa.int64()), "entries": pa.array(blobs, pa.binary())})


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = 13) -> DataFrame:
    """``docs`` plus ``n_words``, ``n_removed`` and ``kept_text``.

    Words are ``[^\\x20\\x09-\\x0D]+``.  A word is removed if a window of
    ``window`` words over it also starts in a text with a smaller id; windows
    are those of the input.  ``kept_text`` has the other words, joined by one
    space.  Null texts have no words and a ``kept_text`` of "".  Rows that
    repeat an id don't remove each other's words; a null id counts as larger
    than any other.  Input columns that bear a result's name are replaced.

    Hashes have 64 bits: two different windows among n are taken for one
    with a probability of about n^2 / 2^65.  ``docs`` is scanned more than once if
    an executor is lost, and should be a stored table or give its rows in one order.
    """
    results = ("n_words", "n_removed", "kept_text")
    others = [c for c in docs.columns if c not in (id_col, text_col, *results)]
    source = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"),
                         F.struct(*(F.col(f"`{c}`") for c in others)).alias("rest") if others
                         else F.lit(0).alias("rest"))
    octets = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets, n_groups = 1 + octets // BUCKET_BYTES, 1 + octets // GROUP_BYTES
    # leading bits that make two different windows of the corpus rarely alike
    bits = min(64, max(32, (octets // 4 + 1).bit_length() + SPARE_BITS))
    shift, to_top = np.uint64(64 - bits), np.uint64(bits - 32)
    # rows go to groups by their number, whatever their ids and texts
    grouped = source.withColumn("group", F.pmod(
        F.xxhash64(F.monotonically_increasing_id()), F.lit(n_groups)))

    def hashed(texts: pa.Table) -> tuple[np.ndarray, ...]:
        """Hash, row, word place and id of every window of a group."""
        give_back()
        codes, offsets, words = split_words(texts.column("text").combine_chunks())
        hashes, starts = window_hashes(hash_strings(words)[codes], offsets, window)
        doc = np.searchsorted(offsets, starts, side="right") - 1
        ids = pc.fill_null(texts.column("id").combine_chunks(), _TOP).to_numpy()
        return hashes, doc, starts - offsets[doc], ids[doc]

    def counted(key: tuple, texts: pa.Table) -> pa.Table:
        """Leading bits of a group's hashes, each once, by bucket."""
        short = np.sort(hashed(texts)[0] >> shift)
        short = short[_news(short)]
        names, blobs = _packed_buckets(short, short >> to_top, n_buckets)
        return pa.table({"bucket": pa.array(names, pa.int64()),
                         "group": pa.array([key[0].as_py()] * len(names), pa.int64()),
                         "entries": pa.array(blobs, pa.binary())})

    def shared(bucket: pa.Table) -> pa.Table:
        """Those that several groups have, to each of them."""
        own = [_summed(unpack(b)[0]) for b in bucket.column("entries").to_pylist()]
        ordered = np.sort(np.concatenate(own))
        several = ordered[1:][ordered[1:] == ordered[:-1]]
        sent = [(g, s) for g, v in zip(bucket.column("group").to_pylist(), own, strict=True)
                if len(s := v[_holds(several, v)])]
        return _lists([g for g, _ in sent], [pack(_steps(s)) for _, s in sent])

    def listed(lists: pa.Table) -> np.ndarray:
        parts = [_summed(unpack(b)[0]) for b in lists.column("entries").to_pylist()]
        return np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)

    def asked(key: tuple, texts: pa.Table, lists: pa.Table) -> pa.Table:
        """Whole hashes of such windows and the smallest id each has in a group."""
        names, blobs = [], []
        if lists.num_rows:
            hashes, _, _, ids = hashed(texts)
            found = _holds(listed(lists), hashes >> shift)
            order = np.argsort(hashes[found])
            hashes, ids = hashes[found][order], ids[found][order]
            new = _news(hashes)
            hashes, least = hashes[new], np.minimum.reduceat(ids, new)
            names, blobs = _packed_buckets(hashes, hashes >> np.uint64(32), n_buckets, least)
        return pa.table({"bucket": pa.array(names, pa.int64()),
                         "group": pa.array([key[0].as_py()] * len(names), pa.int64()),
                         "entries": pa.array(blobs, pa.binary())})

    def later(bucket: pa.Table) -> pa.Table:
        """Hashes that start under a smaller id elsewhere, to each group that has them."""
        parts = [unpack(b) for b in bucket.column("entries").to_pylist()]
        own = [_summed(steps) for steps, _ in parts]
        hashes, ids = np.concatenate(own), np.concatenate([p[1] for p in parts])
        order = np.argsort(hashes)
        hashes, ids = hashes[order], ids[order]
        new = _news(hashes)
        least, known = np.minimum.reduceat(ids, new), hashes[new]
        sent = [(g, s) for g, v, (_, i) in zip(
            bucket.column("group").to_pylist(), own, parts, strict=True)
            if len(s := v[i > least[np.searchsorted(known, v)]])]
        return _lists([g for g, _ in sent], [pack(_steps(s)) for _, s in sent])

    to_buckets, to_groups = "bucket bigint, group bigint, entries binary", "group bigint, entries binary"
    repeats = (grouped.groupBy("group").applyInArrow(counted, to_buckets)
               .groupBy("bucket").applyInArrow(shared, to_groups))
    hits = (grouped.groupBy("group").cogroup(repeats.groupBy("group")).applyInArrow(asked, to_buckets)
            .groupBy("bucket").applyInArrow(later, to_groups))

    out = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()),
                        source.schema["rest"], T.StructField("n_words", T.LongType()),
                        T.StructField("n_removed", T.LongType()),
                        T.StructField("kept_text", T.StringType())])

    def applied(texts: pa.Table, lists: pa.Table) -> pa.Table:
        hashes, doc, places, ids = hashed(texts)
        order = np.argsort(hashes)
        ordered = hashes[order]
        late = _holds(listed(lists), hashes)
        if len(order):
            new = _news(ordered)
            least = np.repeat(np.minimum.reduceat(ids[order], new),
                              np.diff(np.append(new, len(order))))
            late[order] |= ids[order] > least
        doc, places = doc[late], places[late]               # in order of rows and places
        at = np.searchsorted(doc, np.arange(texts.num_rows + 1))
        n_words, n_removed, kept = [], [], []
        for i, text in enumerate(texts.column("text").to_pylist()):
            words = (text or "").encode().split()
            stay, done = [], 0
            for a, b in removal_intervals(places[at[i]:at[i + 1]], window):
                stay += words[done:a]
                done = b
            stay += words[done:]
            n_words.append(len(words))
            n_removed.append(len(words) - len(stay))
            kept.append(b" ".join(stay).decode())
        return pa.table([*(texts.column(c) for c in ("id", "text", "rest")),
                         pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                         pa.array(kept, pa.string())], names=out.names)

    result = (grouped.groupBy("group").cogroup(hits.groupBy("group")).applyInArrow(applied, out))
    back = [F.col("id").alias(id_col), F.col("text").alias(text_col),
            *(F.col(f"rest.`{c}`").alias(c) for c in others)]
    named = {c: x for c, x in zip([id_col, text_col, *others], back, strict=True)}
    return result.select(*(named[c] for c in docs.columns if c in named),
                         *results)
