"""Reference tables (§3 entry D): index -> per-category documents ->
first non-empty list -> one dataset per category, failures isolated.

All categories are handled by one scan and one write: documents that
cannot be unwrapped are routed to a reject dataset instead of stopping the
others, and a per-category outcome table is returned.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.functions.json import member_or_empty
from tradelake.functions.text import replace_literal
from tradelake.operators.flow import category_outcomes, route_documents
from tradelake.operators.ledger import open_rejects, record_outcomes
from tradelake.operators.project import sanitize_name_punct
from tradelake.session import checkpoint_root
from tradelake.sinks.writers import read_category, sink_fanout_json


def reference_index(raw: DataFrame, json_col: str = "json_data") -> DataFrame:
    """Index document(s) -> ``category, fileuri`` rows (``results`` member)."""
    rows = member_or_empty(raw, json_col, "results", "category string, fileuri string",
                           alias="r")
    return rows.select("r.category", "r.fileuri")


def ingest_reference_tables(landed: DataFrame, output_dir: str,
                            category_col: str = "category",
                            json_col: str = "json_data", run: str | None = None) -> DataFrame:
    """Write every category's rows as typed Parquet under
    ``output_dir/tables/category=<name>`` (``:`` -> ``_``), names sanitised, and
    return per-category outcomes.

    A category's schema is aggregated over all its rows, and conditions on a
    table read later reach its Parquet scan.  A category that is rejected or
    absent keeps its earlier table.  Unreadable documents are under
    ``output_dir/rejected``; categories that a run rejected, and later brought
    through, are in the ledger ``output_dir/reject_ledger`` (``run``: default now, UTC).

    The routed documents are checkpointed (lineage cut to the shared
    checkpoint folder) because several outputs read them.
    """
    run = run or datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    routed = route_documents(
        landed.withColumn(category_col, replace_literal(category_col, ":", "_")), json_col)
    checkpoint_root(landed.sparkSession)
    routed = routed.checkpoint(eager=True)
    rows = routed.filter("ok").select(category_col, F.explode("rows").alias("value"))
    sink_fanout_json(rows.checkpoint(eager=True), f"{output_dir}/tables", category_col,
                     renamed=lambda names: [sanitize_name_punct(n) for n in names])
    (routed.filter(~F.col("ok")).drop("rows", "ok")
        .write.mode("overwrite").json(f"{output_dir}/rejected"))
    record_outcomes(routed.withColumn("reason", F.lit("no non-empty list")),
                    f"{output_dir}/reject_ledger", [category_col], run)
    return category_outcomes(routed, category_col)


def rejected_categories(spark: SparkSession, output_dir: str, category_col: str = "category"
                        ) -> DataFrame:
    """Categories whose last run was rejected, with attempts and reason."""
    return open_rejects(spark, f"{output_dir}/reject_ledger", [category_col],
                        f"{category_col} string")


def reference_table(spark: SparkSession, output_dir: str, category: str,
                    schema: str | None = None) -> DataFrame:
    """One category as a typed table (``schema`` overrides the stored one)."""
    return read_category(spark, f"{output_dir}/tables", category, schema)
