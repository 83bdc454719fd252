"""Request plans (S9, S10, N1, N2, P1-style renames, F2/F3/F4 predicates).

A plan is the list of requests a fetch job will issue: every combination of
request dimensions.  Products of dimensions meet on a grid of cells (see
``tradelake.operators.product``); year ranges are generators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.operators.filters import spread
from tradelake.operators.product import attach_dimension, with_sequence
from tradelake.schemas import BILATERAL_YEARS, REPORTER_YEARS


def year_dimension(spark: SparkSession, start: int, end_exclusive: int) -> DataFrame:
    """``year int`` for ``start .. end_exclusive-1`` (Python range)."""
    return spark.range(start, end_exclusive, numPartitions=1).select(
        F.col("id").cast("int").alias("year"))


def year_span(df: DataFrame, ts_col: str) -> DataFrame:
    """S9 derived from data: every year between the first and last year of
    ``ts_col`` (one aggregate row, then a generator)."""
    y = F.year(F.col(ts_col))
    bounds = df.agg(F.min(y).alias("lo"), F.max(y).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi").cast("array<int>")).alias("year"))


def stage_tables(spark: SparkSession, tables: dict[str, DataFrame]) -> dict[str, str]:
    """Register named intermediates as temp views (lazy, no copy)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return {name: name for name in tables}


def dimension(df: DataFrame, id_col: str, id_alias: str, name_col: str | None = None,
              name_alias: str | None = None, ids: list | None = None,
              where=None) -> DataFrame:
    """P1 + F2/F3: pick and rename a reference dimension, filtered by an id
    list and/or an extra predicate (pushed to the scan)."""
    if ids is not None:
        df = df.filter(F.col(id_col).isin(list(ids)))
    if where is not None:
        df = df.filter(where)
    cols = [F.col(id_col).alias(id_alias)]
    if name_col is not None:
        cols.append(F.col(name_col).alias(name_alias or name_col))
    return df.select(*cols)


def reporter_year_plan(reporters: DataFrame, years: tuple[int, int] = REPORTER_YEARS
                       ) -> DataFrame:
    """``reporter_id, reporter_name, year`` for every reporter x year
    (the reporter input is spread over the task slots before expansion)."""
    return with_sequence(spread(reporters.select("reporter_id", "reporter_name")), "year",
                         *years)


def bilateral_plan(reporters: DataFrame, partners: DataFrame, flows: DataFrame,
                   commodities: DataFrame, years: tuple[int, int] = BILATERAL_YEARS,
                   nested: bool = False, year_type: str = "int") -> DataFrame:
    """Reporters x partners x flows x commodities x years, reporter != partner.

    The inequality is applied to the reporter-partner pairs first (the
    smallest product), so the large commodity side is expanded only by the
    surviving combinations.  Rows with a null reporter or partner id drop
    out, as in SQL.

    ``nested`` gives the distinct request keys with ``year`` as the array of all years, a
    row per combination: ids are made distinct in the dimensions, where they are few.
    """
    if nested:
        reporters, partners, flows, commodities = (
            df.select(key).distinct() for df, key in (
                (reporters, "reporter_id"), (partners, "partner_id"), (flows, "flow_id"),
                (commodities, "cmdCode")))
    else:
        reporters = reporters.select("reporter_id", "reporter_name")
        partners = partners.select("partner_id", "partner_name")
        flows, commodities = flows.select("flow_id", "flow_name"), commodities.select("cmdCode")
    pairs = attach_dimension(reporters, partners)
    pairs = pairs.filter(F.col("reporter_id") != F.col("partner_id"))
    plan = attach_dimension(attach_dimension(pairs, flows), commodities)
    if nested:
        return plan.withColumn("year", F.lit(list(range(*years))).cast(f"array<{year_type}>"))
    return with_sequence(plan, "year", *years, dtype=year_type).select(
        "reporter_id", "reporter_name", "partner_id", "partner_name", "flow_id", "flow_name",
        "cmdCode", "year")


def distinct_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """A1: ``SELECT DISTINCT`` over the given columns (partial aggregation
    on the map side, one shuffle on the pair key)."""
    return df.select(*cols).distinct()
