"""Products of dimensions of any size (the core of N1 / N2 request plans).

A request plan is by definition the product of request dimensions.  It is
planned as an equi-join on a grid of (row, column) cells: every row of one
side goes to all columns of its own row, every row of the other side to all
rows of its own column, so each pair of rows meets in one cell.  The grid has
a few cells per task slot, whatever the data hold: no side is gathered in one
task or broadcast, a cell streams through a sort-merge join that spills, and
both sides are replicated ``sqrt(cells)`` times.  Rows and columns are content
hashes, so a recomputed task finds the same cells.

A sort-merge join holds the rows that one row meets, and all that the operators
above make of them, before it hands any on.  So the rows of a cell's small side
are numbered off into blocks, and a row of the big side meets a block at a time.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.session import parallelism

#: Grid cells for each task slot.
CELLS_PER_SLOT = 8
_ROW = "_tl_row"
_COLUMN = "_tl_column"
_CELL = "_tl_cell"
#: Rows of the small side that a row of the big side meets at once.
BLOCK_ROWS = 1000
_BLOCK = "_tl_block"
_LAST = "_tl_last"
#: Bits of ``monotonically_increasing_id`` that number the rows of a partition.
_PLACE = (1 << 33) - 1


def attach_dimension(big: DataFrame, small: DataFrame, side: int | None = None) -> DataFrame:
    """Every row of ``big`` combined with every row of ``small``.

    Output columns: ``big.columns + small.columns`` (names must not clash).
    ``side`` is the number of grid rows and of grid columns.  A cell's number is
    its partition, which AQE does not coalesce: the expansion runs in a task per
    cell, however few bytes the dimensions hold, and no two cells share a task.
    ``small`` is read twice, to count its blocks too, and has to be the same rows.
    """
    clash = set(big.columns) & set(small.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    side = side or math.ceil(math.sqrt(CELLS_PER_SLOT * parallelism(big.sparkSession)))

    def bucket(df: DataFrame, name: str) -> DataFrame:
        return df.withColumn(name, F.pmod(F.xxhash64(*df.columns), F.lit(side)))

    def cells(df: DataFrame, other: str) -> DataFrame:
        return (df.withColumn(other, F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                          F.lit(side - 1).cast("bigint"))))
                .withColumn(_CELL, (F.col(_ROW) * side + F.col(_COLUMN)).cast("int"))
                .drop(_ROW, _COLUMN).repartitionById(side * side, _CELL))

    columns = bucket(small, _COLUMN)
    last = columns.groupBy(_COLUMN).agg(F.expr(f"(count(*) - 1) div {BLOCK_ROWS}").alias(_LAST))
    rows = cells(bucket(big, _ROW), _COLUMN).join(cells(last, _ROW).hint("merge"), _CELL)
    rows = rows.withColumn(_BLOCK, F.explode(F.sequence(F.lit(0).cast("bigint"), _LAST)))
    blocks = cells(columns, _ROW).withColumn(
        _BLOCK, F.expr(f"(monotonically_increasing_id() & {_PLACE}L) div {BLOCK_ROWS}"))
    joined = rows.join(blocks.hint("merge"), [_CELL, _BLOCK])
    return joined.select(*big.columns, *small.columns)


def with_sequence(df: DataFrame, name: str, start: int, end_exclusive: int,
                  dtype: str = "int") -> DataFrame:
    """Expand each row over the integers ``start .. end_exclusive-1`` (a
    generator; the range is a parameter, not data), as values of ``dtype``."""
    if end_exclusive <= start:
        return df.select("*", F.lit(None).cast(dtype).alias(name)).limit(0)
    seq = F.sequence(F.lit(start), F.lit(end_exclusive - 1)).cast(f"array<{dtype}>")
    return df.select("*", F.explode(seq).alias(name))
