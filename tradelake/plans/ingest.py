"""Ingest compositions (X5) and the threshold-driven extract (§3 entry B)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.functions.text import format_key
from tradelake.operators.filters import filter_threshold
from tradelake.operators.flow import RowFn, enrich_partitions, split_failures
from tradelake.operators.project import sanitize_columns_space
from tradelake.schemas import DETAIL_RECORD_CEILING
from tradelake.session import checkpoint_root
from tradelake.sinks.writers import sink_json_per_key, sink_parquet_overwrite
from tradelake.sources.readers import scan_csv_strings, scan_parquet


def ingest_csv_to_parquet(spark: SparkSession, csv_path: str, parquet_path: str) -> None:
    """CSV (all strings, header kept verbatim) -> sanitised names -> Parquet."""
    sink_parquet_overwrite(sanitize_columns_space(scan_csv_strings(spark, csv_path)),
                           parquet_path)


def detail_requests(spark: SparkSession, availability_path: str,
                    ceiling: int = DETAIL_RECORD_CEILING) -> DataFrame:
    """Entry B plan: reporter/period pairs whose dataset is small enough for
    one detailed request (``totalRecords <= ceiling``), filter and
    projection pushed into the Parquet scan; nothing is collected."""
    avail = scan_parquet(spark, availability_path)
    return (filter_threshold(avail, "totalRecords", ceiling)
            .select("reporterCode", "period")
            .withColumn("file_name", format_key("reporter_%d_period_%d.json",
                                                "reporterCode", "period")))


def extract_details(spark: SparkSession, availability_path: str, fetch: RowFn,
                    output_path: str, ceiling: int = DETAIL_RECORD_CEILING,
                    partitions: int | None = None, min_interval_s: float = 0.0
                    ) -> DataFrame:
    """Entry B end to end: plan -> per-row fetch on executors -> the answer
    documents themselves under ``reporterCode=<r>/period=<p>/`` (read them
    with ``spark.read.json`` or ``scan_landed_json``).  Failed or empty
    answers are skipped; the rejected rows are returned for reporting.

    Answers are checkpointed to the shared checkpoint folder right after the
    fetch: both outputs read them, and neither a second action nor a lost
    executor may call the (rate-limited) service again.
    """
    checkpoint_root(spark)
    plan = detail_requests(spark, availability_path, ceiling)
    answers = enrich_partitions(plan, fetch, ["reporterCode", "period"],
                                partitions=partitions,
                                min_interval_s=min_interval_s).checkpoint(eager=True)
    ok, rejected = split_failures(answers)
    sink_json_per_key(ok, output_path, ["reporterCode", "period"], document_col="json_data")
    return rejected
