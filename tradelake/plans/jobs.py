"""Small end-to-end jobs: word count (S5 -> T1 -> A2 -> O1 -> K4) and trip
distance (S1 -> M1 -> K1)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tradelake.functions.geo import add_trip_distance
from tradelake.functions.text import word_count
from tradelake.sinks.writers import sink_csv_quoted_single, sink_parquet_overwrite
from tradelake.sources.readers import scan_parquet, scan_text_lines


def run_word_count(spark: SparkSession, input_path: str, output_path: str) -> None:
    """Count words of a text file; one quoted CSV ``word,count`` sorted by word."""
    sink_csv_quoted_single(word_count(scan_text_lines(spark, input_path), "value"),
                           output_path)


def run_trip_distance(spark: SparkSession, input_path: str, output_path: str) -> None:
    """Add ``distance`` (miles, 2 decimals) to a trips dataset."""
    sink_parquet_overwrite(add_trip_distance(scan_parquet(spark, input_path)), output_path)


# --------------------------------------------------------------------------
# Jobs over landed response documents (one per original job).  Documents
# are files whose names carry the request keys; the patterns below are the
# defaults and can be changed per call.
# --------------------------------------------------------------------------

WORLD_SHARE_FILES = r"world_share_([A-Z])_([A-Z])\.json$"          # typeCode, freqCode
NOTES_FILES = r"notes_([A-Z])_([A-Z])_([A-Z]+)\.json$"              # typeCode, freqCode, clCode


def run_world_share(spark: SparkSession, landed_path: str, output_path: str,
                    file_pattern: str = WORLD_SHARE_FILES, on_empty: str = "write") -> str:
    """World share documents -> typed table -> Parquet.  An empty answer
    writes an empty dataset (the original behaviour); pass ``on_empty``
    to change that."""
    from tradelake.operators.flow import write_with_empty_policy
    from tradelake.plans.responses import world_share_table
    from tradelake.sources.readers import scan_landed_json
    raw = scan_landed_json(spark, landed_path, key_pattern=file_pattern,
                           key_names=["typeCode", "freqCode"], recursive=True,
                           file_glob="*.json")
    return write_with_empty_policy(world_share_table(raw), output_path, on_empty)


def run_publication_notes(spark: SparkSession, landed_path: str, output_path: str,
                          file_pattern: str = NOTES_FILES, on_empty: str = "write") -> str:
    """Publication-note documents -> one row per note -> Parquet."""
    from tradelake.operators.flow import write_with_empty_policy
    from tradelake.plans.responses import notes_table
    from tradelake.sources.readers import scan_landed_json
    raw = scan_landed_json(spark, landed_path, key_pattern=file_pattern,
                           key_names=["typeCode", "freqCode", "clCode"], recursive=True,
                           file_glob="*.json")
    return write_with_empty_policy(notes_table(raw), output_path, on_empty)


def run_availability(spark: SparkSession, landed_path: str, output_path: str,
                     tariffline: bool = False, on_empty: str = "fail") -> str:
    """Data-availability documents -> typed table with envelope members ->
    Parquet.  No data fails by default (the original raised), so an outage
    cannot replace a good dataset."""
    from tradelake.operators.flow import write_with_empty_policy
    from tradelake.plans.responses import availability_table
    from tradelake.schemas import AVAILABILITY_SCHEMA, TARIFFLINE_AVAILABILITY_SCHEMA
    from tradelake.sources.readers import scan_landed_json
    raw = scan_landed_json(spark, landed_path, recursive=True, file_glob="*.json")
    schema = TARIFFLINE_AVAILABILITY_SCHEMA if tariffline else AVAILABILITY_SCHEMA
    return write_with_empty_policy(availability_table(raw, schema), output_path, on_empty)


def run_reference_tables(spark: SparkSession, landed_dir: str, output_dir: str):
    """Reference documents named ``<category>.json`` (``:`` allowed) under
    ``landed_dir`` -> one dataset per category plus rejects; returns the
    per-category outcome table."""
    from tradelake.plans.reference import ingest_reference_tables
    from tradelake.sources.readers import scan_landed_json
    raw = scan_landed_json(spark, landed_dir, key_pattern=r"([^/]+)\.json$",
                           key_names=["category"], recursive=True, file_glob="*.json")
    return ingest_reference_tables(raw.drop("source_file"), output_dir)


def run_reference_index(spark: SparkSession, landed_dir: str, output_path: str,
                        on_empty: str = "skip") -> str:
    """The list of reference tables -> ``category, fileuri`` and whatever else its
    entries hold, names sanitised by the space rule -> Parquet.  An empty list
    leaves the earlier index as it is."""
    from tradelake.functions.json import schemas_of
    from tradelake.operators.flow import write_with_empty_policy
    from tradelake.operators.project import sanitize_columns_space
    from tradelake.plans.reference import reference_index
    from tradelake.sources.readers import scan_landed_json
    from pyspark.sql import functions as F
    raw = scan_landed_json(spark, landed_dir, recursive=True, file_glob="*.json")
    entries = raw.select(F.explode(F.from_json("json_data", "results array<string>")["results"])
                         .alias("value"))
    schema = schemas_of(entries, "value", F.lit("all").alias("k")).first()
    if schema is None or not schema["schema"]:
        return write_with_empty_policy(reference_index(raw), output_path, on_empty)
    rows = entries.select(F.from_json("value", schema["schema"]).alias("r")).select("r.*")
    return write_with_empty_policy(sanitize_columns_space(rows), output_path, on_empty)


def run_preview(spark: SparkSession, plan_path: str, answer, ledger_path: str, output_path: str,
                run: str, on_empty: str = "skip") -> str:
    """Request plan -> what no earlier run was answered -> answers landed in the
    ledger -> the table of all answered records (24 fields as JSON text) -> Parquet."""
    from tradelake.operators.flow import write_with_empty_policy
    from tradelake.plans.fetch import resumable_extract
    from tradelake.sources.readers import scan_parquet
    rows, _ = resumable_extract(scan_parquet(spark, plan_path), answer, ledger_path, run)
    return write_with_empty_policy(rows, output_path, on_empty)


#: typeCode, freqCode, clCode, cmdCode, then reporter, partner and period of a document.
PREVIEW_FILES = r"^preview_[^_]+_[^_]+_[^_]+_[^_]+_([^_]+)_([^_]+)_(\d+)(?:_.*)?\.json$"


def preview_records(spark: SparkSession, landed_path: str, reporters: str, partners: str,
                    start_year: int, end_year: int, commodity_code: str = "TOTAL",
                    trade_flow: str = "M", classification: str = "HS"):
    """Records of the landed preview answers that a query string asks for.

    ``reporters`` and ``partners`` are comma-separated codes, the years are
    inclusive.  Documents are in containers under names such as
    ``preview_M_A_HS_TOTAL_156_842_2020.json``; the fixed part of the name reaches the scan.
    Records are typed by the schema that all of them agree with, columns are
    sanitised by the space rule; None if there are no records.
    """
    from pyspark.sql import functions as F
    from tradelake.functions.json import schemas_of
    from tradelake.operators.project import sanitize_columns_space
    from tradelake.sources.containers import scan_containers
    docs = scan_containers(spark, landed_path, key_pattern=PREVIEW_FILES,
                           key_names=["reporter", "partner", "period"],
                           key_types=["string", "string", "int"],
                           prefix=f"preview_{trade_flow}_A_{classification}_{commodity_code}_")
    asked = docs.filter(F.col("reporter").isin([c.strip() for c in reporters.split(",")])
                        & F.col("partner").isin([c.strip() for c in partners.split(",")])
                        & F.col("period").between(start_year, end_year))
    records = asked.select(F.explode(F.from_json("json_data", "data array<string>")["data"])
                           .alias("value"))
    schema = schemas_of(records, "value", F.lit("all").alias("k")).first()
    if schema is None or not schema["schema"]:
        return None
    return sanitize_columns_space(
        records.select(F.from_json("value", schema["schema"]).alias("r")).select("r.*"))


def run_preview_query(spark: SparkSession, landed_path: str, output_path: str, reporters: str,
                      partners: str, start_year: int, end_year: int,
                      commodity_code: str = "TOTAL", trade_flow: str = "M",
                      classification: str = "HS") -> str:
    """``preview_records`` -> Parquet; without records the output stays as it is."""
    from tradelake.sinks.writers import sink_parquet_overwrite
    records = preview_records(spark, landed_path, reporters, partners, start_year, end_year,
                              commodity_code, trade_flow, classification)
    if records is None:
        return "skipped"
    sink_parquet_overwrite(records, output_path)
    return "written"


def run_bilateral_plan(spark: SparkSession, reference_dir: str, output_path: str,
                       reporter_ids: list, partner_ids: list, flow_ids: list,
                       commodity_level: int = 0, years: tuple[int, int] | None = None) -> None:
    """Request plan from ingested reference tables (reporter, partner, flow,
    cmd_HS) -> one Parquet file."""
    from tradelake.plans.reference import reference_table
    from tradelake.plans.request_plan import bilateral_plan, dimension
    from tradelake.schemas import BILATERAL_YEARS
    from tradelake.sinks.writers import sink_single_parquet
    from pyspark.sql import functions as F
    ref = lambda name: reference_table(spark, reference_dir, name)
    plan = bilateral_plan(
        dimension(ref("reporter"), "id", "reporter_id", "text", "reporter_name", ids=reporter_ids),
        dimension(ref("partner"), "id", "partner_id", "text", "partner_name", ids=partner_ids),
        dimension(ref("flow"), "id", "flow_id", "text", "flow_name", ids=flow_ids),
        dimension(ref("cmd_HS"), "id", "cmdCode", where=F.col("aggrLevel") == commodity_level),
        years or BILATERAL_YEARS)
    sink_single_parquet(plan, output_path)


def run_reporter_year_plan(spark: SparkSession, reference_dir: str, output_path: str,
                           years: tuple[int, int] | None = None) -> None:
    """Every reporter x year (1962-2024 by default) -> one Parquet file."""
    from tradelake.plans.reference import reference_table
    from tradelake.plans.request_plan import dimension, reporter_year_plan
    from tradelake.schemas import REPORTER_YEARS
    from tradelake.sinks.writers import sink_single_parquet
    reporters = dimension(reference_table(spark, reference_dir, "reporter"), "id",
                          "reporter_id", "text", "reporter_name")
    sink_single_parquet(reporter_year_plan(reporters, years or REPORTER_YEARS), output_path)
