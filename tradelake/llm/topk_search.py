"""Exact top-k inner-product search with block-at-a-time pruning.

Vectors are ordered by their nearest two centres (k-means on a bounded
sample), and ranges of that order are blocks; a block stores its vectors
(forward index) and, per dimension, the largest and smallest component.  A
query's bound for a block is the sum over dimensions of the larger product
with these two.  Blocks are scored in descending order of bounds until a
bound falls below the query's k-th score.

Neighbouring blocks form cells with extremes of their own.  A query first
searches the cell with its highest bound, and the k-th score found there tells
which other cells it has to search at all.  Cells of blocks and queries are
groups of a bounded size, so neither side is held whole anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Accumulator, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradelake.llm.common import written

BLOCK, BLOCKS_PER_CELL, QUERIES_PER_CELL, QUERIES_AT_ONCE = 512, 32, 8192, 256
#: Vectors that centres are fitted to, centres of a dimension, and bytes of cells'
#: extremes that every task may hold.
SAMPLE_ROWS, CENTRES, CELL_BYTES = 4096, 64, 64 << 20
_LOWEST = np.iinfo(np.int64).min + 1       # its negative is in range


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int = 256) -> DataFrame:
    """(id, dim, x array<bigint>): components as floor(scale * value).  Null ids
    and vectors, and vectors with a null or non-finite component take no part."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (vectors.filter(F.col(id_col).isNotNull() & x.isNotNull() & finite)
            .select(F.col(id_col).cast("bigint").alias("id"), F.size(x).alias("dim"),
                    F.transform(x, lambda v: F.floor(F.lit(scale) * v.cast("double"))).alias("x")))


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dim, places in the batch, vectors) for every dimension of a batch."""
    dims = batch.column("dim").to_numpy()
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(dims)])
    for dim in np.unique(dims).tolist():
        own = np.flatnonzero(dims == dim)
        yield dim, own, flat[ends[own][:, None] + np.arange(dim)[None, :]].astype(np.int64)


def centres(vectors: DataFrame, rounds: int = 8) -> dict[int, np.ndarray]:
    """Per dimension up to CENTRES centres of a sample of SAMPLE_ROWS vectors."""
    sample = vectors.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("dim", "x").collect()
    out = {}
    for dim in {r["dim"] for r in sample} - {0}:
        x = np.array([r["x"] for r in sample if r["dim"] == dim], np.float64).reshape(-1, dim)
        x = np.unique(x, axis=0)
        middle = x[np.linspace(0, len(x) - 1, min(CENTRES, len(x))).astype(int)]
        for _ in range(rounds):
            near = _nearest(x, middle)[:, 0]
            middle = np.stack([x[near == c].mean(0) if (near == c).any() else middle[c]
                               for c in range(len(middle))])
        out[dim] = middle
    return out


def _nearest(x: np.ndarray, middle: np.ndarray) -> np.ndarray:
    """The nearest two centres of every vector (the same one twice, if it is alone)."""
    far = (middle ** 2).sum(1)[None, :] - 2 * (x @ middle.T)
    order = np.argsort(far, axis=1, kind="stable")
    return order[:, [0, min(1, order.shape[1] - 1)]]


def _blocks(vectors: DataFrame, middles: dict[int, np.ndarray], size: int) -> DataFrame:
    """Blocks of ``size`` vectors of one dimension, neighbours in the order by
    centres: (dim, r, ids, data), ids ascending; ``r`` names the cell."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.zeros(batch.num_rows, np.int64)
            for dim, own, x in _rows(batch):
                if dim in middles:
                    first, second = _nearest(x.astype(np.float64), middles[dim]).T
                    place[own] = first * CENTRES + second
            yield batch.append_column("place", pa.array(place))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            for dim, own, x in _rows(batch):
                ids = batch.column("id").to_numpy()[own]
                for at in range(0, len(own), size):
                    order = np.argsort(ids[at:at + size], kind="stable")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([dim], pa.int32()), pa.array([part + n // BLOCKS_PER_CELL], pa.int64()),
                         pa.array([ids[at:at + size][order].tobytes()], pa.binary()),
                         pa.array([x[at:at + size][order].tobytes()], pa.binary())],
                        names=["dim", "r", "ids", "data"])
                    n += 1

    return (vectors.mapInArrow(placed, "id bigint, dim int, x array<bigint>, place bigint")
            .repartitionByRange("dim", "place", "id").sortWithinPartitions("dim", "place", "id")
            .mapInArrow(run, "dim int, r bigint, ids binary, data binary"))


def _matrices(table: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(np.frombuffer(i, np.int64), np.frombuffer(d, np.int64).reshape(-1, n) if n
             else np.zeros((len(i) // 8, 0), np.int64))
            for n, i, d in zip(*(table.column(c).to_pylist() for c in ("dim", "ids", "data")),
                               strict=True)]


def search_blocks(q_ids: np.ndarray, q: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray]],
                  k: int, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """Top k of some queries over blocks: (ids, scores, query-block pairs scored).

    Blocks whose bound is below a query's ``floor``, a k-th score that it has
    elsewhere, are left out.
    Missing places have the lowest score.  A row with the query's own id is no
    candidate; ties go to smaller ids.
    """
    # products stay exact in doubles if no sum can pass 2^53
    large = max([1, *(int(np.abs(m).max(initial=0)) for _, m in blocks)])
    exact = int(np.abs(q).max(initial=0)) * large * max(1, q.shape[1]) < 1 << 53
    kind = np.float64 if exact else np.int64
    queries = q.astype(kind)
    up = np.stack([m.max(0) for _, m in blocks]).astype(kind)
    low = np.stack([m.min(0) for _, m in blocks]).astype(kind)
    bounds = (np.maximum(queries, 0) @ up.T + np.minimum(queries, 0) @ low.T).astype(np.int64)
    order = np.argsort(-bounds, axis=1, kind="stable")
    ids = np.full((len(q), k), np.iinfo(np.int64).max)
    scores = np.full((len(q), k), _LOWEST)
    floor = scores[:, -1] if floor is None else floor
    scored = 0
    for turn in range(len(blocks)):
        pick = order[:, turn]
        live = np.flatnonzero(bounds[np.arange(len(q)), pick] >= np.maximum(scores[:, -1], floor))
        if not len(live):
            break
        for b in np.unique(pick[live]).tolist():
            own = live[pick[live] == b]
            scored += len(own)
            names, data = blocks[b]
            s = (queries[own] @ data.astype(kind).T).astype(np.int64)
            s[q_ids[own][:, None] == names[None, :]] = _LOWEST
            top = np.argsort(-s, axis=1, kind="stable")[:, :k]     # ids ascend in a block
            all_s = np.concatenate([scores[own], np.take_along_axis(s, top, 1)], 1)
            all_i = np.concatenate([ids[own], names[top]], 1)
            best = np.lexsort((all_i, -all_s), axis=1)[:, :k]
            scores[own] = np.take_along_axis(all_s, best, 1)
            ids[own] = np.take_along_axis(all_i, best, 1)
    return ids, scores, scored


def _cells(blocks: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] | None:
    """Per dimension the names and extremes of all cells; None if they are too
    many to be held by every task (a cell stands for some 16 000 vectors)."""

    def extremes(table: pa.Table) -> pa.Table:
        data = np.concatenate([m for _, m in _matrices(table)])
        return pa.table({"dim": table.column("dim")[:1], "r": table.column("r")[:1],
                         "up": pa.array([data.max(0).tobytes()], pa.binary()),
                         "low": pa.array([data.min(0).tobytes()], pa.binary())})

    sizes = blocks.groupBy("dim").agg(F.countDistinct("r").alias("n")).collect()
    if sum(16 * r["dim"] * r["n"] for r in sizes) > CELL_BYTES:
        return None
    rows = blocks.groupBy("dim", "r").applyInArrow(
        extremes, "dim int, r bigint, up binary, low binary").orderBy("dim", "r").collect()
    return {dim: (np.array([r["r"] for r in rows if r["dim"] == dim]),
                  *(np.array([np.frombuffer(r[c], np.int64) if dim else [] for r in rows
                              if r["dim"] == dim], np.int64) for c in ("up", "low")))
            for dim in {r["dim"] for r in rows}}


def _routed(queries: DataFrame, cells, first: bool) -> DataFrame:
    """A row (dim, r, c, id, x, floor) for every cell that a query has to search:
    the one with its highest bound, or else all others whose bound reaches its floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, own, x in _rows(batch):
                if dim not in cells:
                    continue
                names, up, low = cells[dim]
                for at in range(0, len(own), QUERIES_AT_ONCE):
                    rows, part = own[at:at + QUERIES_AT_ONCE], x[at:at + QUERIES_AT_ONCE]
                    bounds = np.maximum(part, 0) @ up.T + np.minimum(part, 0) @ low.T
                    best = bounds.argmax(1)
                    if first:
                        query, cell = np.arange(len(rows)), best
                    else:
                        floor = batch.column("floor").to_numpy()[rows]
                        wanted = bounds >= floor[:, None]
                        wanted[np.arange(len(rows)), best] = False
                        query, cell = np.nonzero(wanted)
                    picked = batch.take(pa.array(rows[query]))
                    yield pa.RecordBatch.from_arrays(
                        [picked.column("dim"), pa.array(names[cell], pa.int64()),
                         *(picked.column(c) for c in ("c", "id", "x", "floor"))],
                        names=["dim", "r", "c", "id", "x", "floor"])

    return queries.mapInArrow(
        run, "dim int, r bigint, c bigint, id bigint, x array<bigint>, floor bigint")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
          vector_col: str = "embedding", scored: Accumulator | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of ``vectors`` with the
    highest integer inner product for every row of ``queries`` (all, if fewer).

    Ties go to the smaller id; rows that bear the query's id are its own and
    no candidates; only vectors of the query's dimension are.  Rows that repeat
    an id are candidates one by one, and queries of one id share its places.
    Other columns are ignored; an empty table on either side gives an empty
    result.  ``scored`` counts the query-block pairs that were scored.
    """
    base = written(quantised(vectors, id_col, vector_col), "topk-vectors")
    blocks = written(_blocks(base, centres(base), BLOCK), "topk-blocks")
    asked = quantised(queries, id_col, vector_col)
    n_columns = 1 + asked.count() // QUERIES_PER_CELL
    asked = written(asked.withColumn("c", F.pmod(F.xxhash64("id"), F.lit(n_columns))),
                    "topk-queries")
    columns = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_columns - 1).cast("bigint")))

    def cell(queries_: pa.Table, blocks_: pa.Table) -> pa.Table:
        own = _matrices(blocks_)
        out = ([], [], [])
        pairs = 0
        for batch in queries_.combine_chunks().to_batches() if own else ():
            for _, rows, x in _rows(batch):
                ids_, floors = (batch.column(c).to_numpy()[rows] for c in ("id", "floor"))
                for at in range(0, len(rows), QUERIES_AT_ONCE):
                    part = slice(at, at + QUERIES_AT_ONCE)
                    ids, scores, n = search_blocks(ids_[part], x[part], own, k, floors[part])
                    found = scores > _LOWEST
                    out[0].append(np.repeat(ids_[part], found.sum(1)))
                    out[1].append(ids[found])
                    out[2].append(scores[found])
                    pairs += n
        if scored is not None:
            scored.add(pairs)
        return pa.table([pa.array(np.concatenate(c) if c else [], pa.int64()) for c in out],
                        names=["query_id", "vec_id", "score"])

    def searched(routed: DataFrame) -> DataFrame:
        right = blocks.withColumn("c", columns)
        keys = ("dim", "r", "c")
        return routed.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
            cell, "query_id bigint, vec_id bigint, score bigint")

    def best(found: DataFrame) -> DataFrame:
        ranked = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return (found.withColumn("rank", ranked).filter(F.col("rank") <= k)
                .select("query_id", "rank", "vec_id", "score"))

    cells = _cells(blocks)
    lowest = F.lit(_LOWEST).cast("bigint")
    if cells is None:                          # every query with every cell
        every = blocks.select(F.col("dim").alias("of"), F.col("r").alias("to")).distinct()
        return best(searched(
            asked.join(every.hint("merge"), F.col("dim") == F.col("of")).select(
                "dim", F.col("to").alias("r"), "c", "id", "x", lowest.alias("floor"))))
    near = written(best(searched(_routed(asked.withColumn("floor", lowest), cells, True))),
                   "topk-near")
    floors = near.filter(F.col("rank") == k).select(F.col("query_id").alias("id"),
                                                    F.col("score").alias("floor"))
    rest = (asked.join(floors.hint("merge"), "id", "left")
            .select("id", "dim", "x", "c", F.coalesce("floor", lowest).alias("floor")))
    return best(near.drop("rank").unionByName(searched(_routed(rest, cells, False))))
