"""Projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.schemas import PREVIEW_REQUEST_DEFAULTS


def project_rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep only ``mapping`` keys, renamed to its values (in order)."""
    return df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])


def with_envelope_literals(df: DataFrame, elapsed_time: Column | str | None,
                           count: Column | int | None, error: Column | str | None
                           ) -> DataFrame:
    """Attach envelope members to every row as typed columns.

    Values may be Python literals or columns (e.g. the parsed envelope's
    own members).  ``error`` is always a string column, never ``void``, so
    a null error still round-trips through Parquet with a real type.
    """
    def as_col(v, dtype):
        return (v if isinstance(v, Column) else F.lit(v)).cast(dtype)
    return df.withColumns({
        "elapsedTime": as_col(elapsed_time, "string"),
        "count": as_col(count, "int"),
        "error": as_col(error, "string"),
    })


# FIXED VALUES: characters that become "_" in column names.  The basic rule
# replaces spaces only; the reference-table rule also dots and colons.
SPACE_CHARS = " "
PUNCT_CHARS = " .:"

_SPACE_TABLE = str.maketrans({c: "_" for c in SPACE_CHARS})
_PUNCT_TABLE = str.maketrans({c: "_" for c in PUNCT_CHARS})


def sanitize_name_spaces(name: str) -> str:
    """P4 rule: every space becomes ``_`` one-for-one (outer ones too)."""
    return name.translate(_SPACE_TABLE)


def sanitize_name_punct(name: str) -> str:
    """P5 rule: each space, ``.`` and ``:`` becomes ``_``."""
    return name.translate(_PUNCT_TABLE)


def sanitize_columns(columns: Sequence[str]) -> list[str]:
    """P4 on a list of names (the unit-tested helper)."""
    return [sanitize_name_spaces(c) for c in columns]


def _rename_all(df: DataFrame, rule) -> DataFrame:
    new = [rule(c) for c in df.columns]
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        name = n if exact else n.lower()       # as a writer of the columns compares them
        if name in seen:
            raise ValueError(f"sanitised names collide: {seen[name]!r} and {old!r} -> {n!r}")
        seen[name] = old
    return df.toDF(*new)


def sanitize_columns_space(df: DataFrame) -> DataFrame:
    """Rename every column by the space rule (metadata only, no job)."""
    return _rename_all(df, sanitize_name_spaces)


def sanitize_columns_punct(df: DataFrame) -> DataFrame:
    """P5: rename by the space/dot/colon rule; colliding results fail."""
    return _rename_all(df, sanitize_name_punct)


def project_request_params(plan: DataFrame, year_col: str = "year",
                           reporter_col: str = "reporter_id", partner_col: str = "partner_id",
                           flow_col: str = "flow_id", cmd_col: str = "cmdCode",
                           keep: Sequence[str] = ()) -> DataFrame:
    """Typed plan keys -> string request parameters with fixed defaults.

    Unlike the historical job, the reporter is part of the request (it is
    also the label of the answer).
    """
    return plan.select(
        *keep,
        F.lit(PREVIEW_REQUEST_DEFAULTS["typeCode"]).alias("typeCode"),
        F.lit(PREVIEW_REQUEST_DEFAULTS["freqCode"]).alias("freqCode"),
        F.lit(PREVIEW_REQUEST_DEFAULTS["clCode"]).alias("clCode"),
        F.col(year_col).cast("string").alias("period"),
        F.col(reporter_col).cast("string").alias("reporterCode"),
        F.col(cmd_col).cast("string").alias("cmdCode"),
        F.col(flow_col).cast("string").alias("flowCode"),
        F.col(partner_col).cast("string").alias("partnerCode"),
        F.lit(None).cast("string").alias("partner2Code"),
        F.lit(None).cast("string").alias("customsCode"),
        F.lit(None).cast("string").alias("motCode"),
    )


#: Reporters of a list that are read from the rows ahead; longer lists are grouped.
MOST_AHEAD = 16


def coalesce_requests(plan: DataFrame, max_reporters: int, year_col: str = "year",
                      reporter_col: str = "reporter_id",
                      others: Sequence[str] = ("partner_id", "flow_id", "cmdCode")) -> DataFrame:
    """P6 for whole plans: as few requests as ranges of years and lists of
    reporters allow.

    Consecutive years of one (reporter, *others) become a range, and reporters
    with the same range and others are packed in lists of up to ``max_reporters``, in
    ascending order.  Returns ``others``, ``from_year``, ``to_year``, ``reporters`` (array) and
    ``n_requests`` (plan rows covered); expanded again they are the distinct plan.

    ``year_col`` may be an array: the years of a row, each once, whose reporter and others do not
    repeat.  Ranges are then found within the row.
    """
    # last first: sorts that begin with the largest dimension seldom compare further
    back = list(reversed(others))
    if isinstance(plan.schema[year_col].dataType, T.ArrayType):
        ranges = plan.select(reporter_col, *back, F.sort_array(year_col).alias("_years"))
        ranges = ranges.select(reporter_col, *back, F.explode(_year_ranges("_years")).alias("_range"))
        ranges = ranges.select(reporter_col, *back, "_range.from_year", "_range.to_year")
    else:
        rows = (plan.select(reporter_col, *others, year_col).repartition(*back, reporter_col)
                .distinct())
        by_year = W.partitionBy(*back, reporter_col).orderBy(year_col)
        runs = rows.withColumn("_run", F.col(year_col) - F.row_number().over(by_year))
        ranges = runs.groupBy(*back, reporter_col, "_run").agg(
            F.min(year_col).alias("from_year"), F.max(year_col).alias("to_year"))
    alike = W.partitionBy(*back, "from_year", "to_year").orderBy(reporter_col)
    packed = ranges.withColumn("_at", F.row_number().over(alike) - 1)
    if max_reporters <= MOST_AHEAD:      # the rows of a list follow each other
        ahead = [F.lead(reporter_col, i).over(alike) for i in range(1, max_reporters)]
        lists = packed.withColumn("reporters", F.array(reporter_col, *ahead)).filter(
            F.col("_at") % max_reporters == 0).withColumn("reporters", F.array_compact("reporters"))
    else:
        packed = packed.withColumn("_list", F.floor(F.col("_at") / max_reporters))
        lists = packed.groupBy(*back, "from_year", "to_year", "_list").agg(
            F.array_sort(F.collect_list(reporter_col)).alias("reporters"))
    n = F.size("reporters") * (F.col("to_year") - F.col("from_year") + 1)
    return lists.select(*others, "from_year", "to_year", "reporters", n.cast("bigint").alias("n_requests"))


def _year_ranges(years: str) -> Column:
    """Ranges of consecutive years in a sorted array of distinct ones."""
    all_years, n = F.col(years), F.size(years)
    first, last = F.get(all_years, F.lit(0)), F.get(all_years, n - 1)
    starts = F.array_except(all_years, F.transform(all_years, lambda y: y + 1))
    ends = F.array_except(all_years, F.transform(all_years, lambda y: y - 1))
    gaps = F.arrays_zip(starts.alias("from_year"), ends.alias("to_year"))
    whole = F.array(F.struct(first.alias("from_year"), last.alias("to_year")))
    return F.when(last - first == n - 1, whole).otherwise(gaps)


def expand_requests(requests: DataFrame, year_col: str = "year", reporter_col: str = "reporter_id",
                    others: Sequence[str] = ("partner_id", "flow_id", "cmdCode")) -> DataFrame:
    """The plan rows that coalesced requests stand for."""
    each = requests.select(F.explode("reporters").alias(reporter_col), *others, "from_year", "to_year")
    return each.select(reporter_col, *others,
                       F.explode(F.sequence("from_year", "to_year")).alias(year_col))


def drop_parent_duplicates(df: DataFrame, parent: str, child: str,
                           parent_fields: Sequence[str], child_fields: Sequence[str],
                           keep: Sequence[str] = ()) -> DataFrame:
    """Flatten parent and child structs; where both carry a field the
    parent's value wins and the child's copy is dropped."""
    child_only = [f for f in child_fields if f not in set(parent_fields)]
    return df.select(*keep,
                     *[F.col(f"{parent}.{f}").alias(f) for f in parent_fields],
                     *[F.col(f"{child}.{f}").alias(f) for f in child_only])
