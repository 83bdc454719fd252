"""Filters, limits and partitioning (F1-F8) and row counting (A3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.schemas import DETAIL_RECORD_CEILING


def filter_threshold(df: DataFrame, col: str = "totalRecords",
                     ceiling: int = DETAIL_RECORD_CEILING) -> DataFrame:
    """keep rows with ``col <= ceiling`` (pushed to the Parquet scan)."""
    return df.filter(F.col(col) <= F.lit(ceiling))


def filter_in_list(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """``col IN (values)``."""
    return df.filter(F.col(col).isin(list(values)))


def filter_equals(df: DataFrame, col: str, value) -> DataFrame:
    """``col = value``."""
    return df.filter(F.col(col) == F.lit(value))


def filter_column_neq(df: DataFrame, left: str, right: str) -> DataFrame:
    """column-to-column inequality; a null on either side drops the row."""
    return df.filter(F.col(left) != F.col(right))


def filter_nonempty_json(df: DataFrame, col: str = "json_data") -> DataFrame:
    """drop responses whose text is exactly ``[]``."""
    return df.filter(F.col(col) != F.lit("[]"))


def drop_failed_rows(df: DataFrame, col: str = "json_data") -> DataFrame:
    """keep answered requests only (null / empty answer = failed)."""
    return df.filter(F.col(col).isNotNull() & (F.length(F.col(col)) > 0))


def limit_rows(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """deterministic top-n by key (planned as TakeOrderedAndProject:
    per-partition top-n, then one merge of at most n rows per partition)."""
    return df.orderBy(*order_by).limit(n)


def repartition_for_fetch(df: DataFrame, n: int) -> DataFrame:
    """F8: spread request rows round-robin over ``n`` tasks so a slow
    per-row call runs ``n``-wide."""
    return df.repartition(n)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Guarantee a floor of parallelism for CPU-heavy work after a scan.

    A file written as one Parquet row group is read by one task however it
    is split; when the planned input has fewer partitions than the session
    can run at once, rows are spread round-robin.  Large inputs already have
    at least that many splits, so this is a no-op for them.
    """
    from tradelake.session import parallelism
    target = min_partitions or parallelism(df.sparkSession)
    try:
        planned = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD view in a remote session
        return df
    return df.repartition(target) if planned < target else df


def count_rows(df: DataFrame) -> DataFrame:
    """A3: one-row ``n bigint`` count, computed distributed (no collect)."""
    return df.agg(F.count(F.lit(1)).alias("n"))
