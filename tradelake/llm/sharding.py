"""Shards of near-equal bytes by best-fit-decreasing bin packing.

Rows of equal text form a group that no shard splits.  Groups that hold at
least 1/GRAIN of all bytes are packed one by one; there are at most GRAIN of
them.  Smaller ones are packed in GRAIN parcels dealt by a hash of their text,
so the list that is packed has at most 2 * GRAIN sizes whatever the input.  It
is packed on the driver: sizes in falling order each enter the bin with the
least room that still holds them, found in a balanced tree of rooms.

Rows carry no text past the first scan.  The list goes back to them as two
broadcast tables of at most GRAIN rows each, and places in a shard are numbered
by input split, so a hot group stays spread over its splits.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradelake.llm.common import mix_int, written

#: Groups of at least this share of all bytes are packed by themselves.
GRAIN = 1 << 15


class Rooms:
    """Room left per bin: a treap over (room, bin), balanced by hashed priorities."""

    def __init__(self) -> None:
        self.root = None

    def _split(self, node, key):
        """Nodes below ``key``, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], rest = self._split(node[3], key)
            return node, rest
        below, node[2] = self._split(node[2], key)
        return below, node

    def _merge(self, a, b):
        """All of ``a`` is below ``b``."""
        if a is None or b is None:
            return a or b
        if a[1] < b[1]:
            a[3] = self._merge(a[3], b)
            return a
        b[2] = self._merge(a, b[2])
        return b

    def add(self, room: int, name: int) -> None:
        below, above = self._split(self.root, (room, name))
        node = [(room, name), mix_int(name), None, None]
        self.root = self._merge(self._merge(below, node), above)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the least (room, bin) with room >= size."""
        below, above = self._split(self.root, (size, -1))
        if above is None:
            self.root = below
            return None
        parent, node = None, above
        while node[2] is not None:
            parent, node = node, node[2]
        if parent is None:
            above = node[3]
        else:
            parent[2] = node[3]
        self.root = self._merge(below, above)
        return node[0]


def best_fit(sizes: list[int], capacity: int) -> list[int]:
    """Bin of every size (sizes in falling order).  A size above ``capacity``
    has a bin of its own."""
    rooms, bins, n = Rooms(), [], 0
    for size in sizes:
        found = rooms.take_tightest(size)
        if found is None:
            found, n = (max(capacity, size), n), n + 1
        rooms.add(found[0] - size, found[1])
        bins.append(found[1])
    return bins


def even_bins(sizes: list[int], n: int) -> list[int]:
    """At most ``n`` bins of near-equal fill (sizes in falling order).

    A size above an even share of what is left has a bin of its own; the
    others are packed at the least capacity found that needs no more bins.
    """
    own, rest = 0, sum(sizes)
    while own < min(n, len(sizes)) and sizes[own] * (n - own) > rest:
        rest -= sizes[own]
        own += 1
    if own == len(sizes):
        return list(range(own))
    others, bins = sizes[own:], n - own
    low = max(-(-rest // bins), others[0]) - 1
    step, packed = 1, None
    while packed is None:                     # grow until the sizes fit ...
        found = best_fit(others, low + step)
        if max(found) < bins:
            high, packed = low + step, found
        else:
            low, step = low + step, 4 * step
    while high - low > max(1, high >> 14):     # ... then narrow it down
        middle = (low + high) // 2
        found = best_fit(others, middle)
        if max(found) < bins:
            high, packed = middle, found
        else:
            low = middle
    return [*range(own), *(own + b for b in packed)]


def crc32_of(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def rows_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One narrow row per document, written: id, size, crc32, text key and number."""
    text = F.col(f"`{text_col}`")
    return written(docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        crc32_of(text).alias("text_crc32"),
        F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary"))).alias("key"),
        F.monotonically_increasing_id().alias("row")), "shard-rows")


def packed_rows(rows: DataFrame, pack, grain: int = GRAIN) -> DataFrame:
    """``rows`` plus ``shard``: ``pack(sizes in falling order)`` gives the bins."""
    spark = rows.sparkSession
    total = rows.agg(F.sum("size")).first()[0] or 0
    least = max(1, -(-total // grain))
    parcel = F.pmod(F.xxhash64("key"), F.lit(grain)).cast("int")
    large = F.col("bytes") >= least
    items = (rows.groupBy("key").agg(F.sum("size").alias("bytes"))
             .select(F.when(large, F.col("key")).alias("key"),
                     F.when(~large, parcel).alias("parcel"), "bytes")
             .groupBy("key", "parcel").agg(F.sum("bytes").alias("bytes")).toArrow())
    order = sorted(zip(*(items.column(c).to_pylist() for c in ("bytes", "parcel", "key")),
                       strict=True),
                   key=lambda x: (-x[0], -1 if x[1] is None else x[1], x[2] or b""))
    shards = pack([x[0] for x in order]) if order else []
    own = [(x[2], s) for x, s in zip(order, shards, strict=True) if x[2] is not None]
    dealt = [(x[1], s) for x, s in zip(order, shards, strict=True) if x[2] is None]
    groups = spark.createDataFrame(pa.table(
        {"key": pa.array([k for k, _ in own], pa.binary()),
         "own": pa.array([s for _, s in own], pa.int32())}))
    parcels = spark.createDataFrame(pa.table(
        {"parcel": pa.array([k for k, _ in dealt], pa.int32()),
         "dealt": pa.array([s for _, s in dealt], pa.int32())}))
    # both have at most ``grain`` rows
    return (rows.join(F.broadcast(groups), "key", "left").withColumn("parcel", parcel)
            .join(F.broadcast(parcels), "parcel", "left")
            .withColumn("shard", F.coalesce("own", "dealt")).drop("own", "dealt", "parcel", "key"))


def numbered(rows: DataFrame) -> DataFrame:
    """``slot``: the place of a row in its shard, gapless from 0.  Rows are
    numbered within (input split, shard); a running sum over the splits, a few
    numbers each, says what lies before."""
    rows = rows.withColumn("split", F.shiftrightunsigned("row", 33))
    within = W.partitionBy("split", "shard").orderBy("row")
    before = W.partitionBy("shard").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    starts = (rows.groupBy("split", "shard").agg(F.count("*").alias("n"))
              .select("split", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    return (rows.withColumn("own", F.row_number().over(within) - 1)
            .join(starts.hint("merge"), ["split", "shard"])
            .withColumn("slot", (F.col("start") + F.col("own")).cast("bigint"))
            .drop("own", "start", "split", "row"))


def shard_evenly(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row, in ``n_shards``
    shards of near-equal bytes.

    ``size`` is the text's UTF-8 bytes plus one.  Equal texts share a shard;
    null texts count as empty ones and form one group with them.  A group of
    more than an even share has a shard of its own and the others are even
    among themselves.  Fewer groups than shards leave shards empty, as does an
    empty table.  Repeated rows and null ids are rows like others; columns other
    than the two named are not read.
    """
    rows = rows_of(docs, id_col, text_col)
    return numbered(packed_rows(rows, lambda sizes: even_bins(sizes, n_shards)))


def shard_by_capacity(docs: DataFrame, capacity: int, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """As ``shard_evenly``, but in as few shards of ``capacity`` bytes as best
    fit finds.  A group larger than that has a shard of its own."""
    rows = rows_of(docs, id_col, text_col)
    return numbered(packed_rows(rows, lambda sizes: best_fit(sizes, capacity)))
