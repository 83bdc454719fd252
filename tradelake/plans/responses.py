"""Response documents -> typed tables (the §3 entry points).

Every function takes a DataFrame of landed documents (request key columns +
``json_data``) and returns the flattened table; pair it with
``sources.readers.scan_landed_json`` and a sink.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.functions.json import first_nonempty_list, unnest_extract_json_text
from tradelake.operators.filters import filter_nonempty_json
from tradelake.operators.project import with_envelope_literals
from tradelake.schemas import (NOTE_TEXT_FIELDS, NOTES_PARENT_DDL, PREVIEW_FIELDS,
                               WORLD_SHARE_COLUMNS, WORLD_SHARE_ELEMENT_DDL, struct_ddl)


def world_share_table(raw: DataFrame, json_col: str = "json_data") -> DataFrame:
    """Entry A: ``data[]`` of world-share responses, request keys win.

    Only ``data`` is parsed (the envelope's other members are unused).
    """
    parsed = F.from_json(F.col(json_col), f"data array<{struct_ddl(WORLD_SHARE_ELEMENT_DDL)}>")
    rows = raw.select("typeCode", "freqCode", F.explode(parsed["data"]).alias("d"))
    return rows.select("typeCode", "freqCode",
                       *[F.col(f"d.{c}").alias(c) for c in WORLD_SHARE_COLUMNS[2:]])


def notes_table(raw: DataFrame, json_col: str = "json_data") -> DataFrame:
    """Publication notes: ``data[].notes[]``; parent keys win over the
    note's copies, only ``clCode`` comes from the request."""
    parsed = F.from_json(F.col(json_col), f"data array<{struct_ddl(NOTES_PARENT_DDL)}>")
    parents = raw.select("clCode", F.explode(parsed["data"]).alias("d"))
    notes = parents.select("clCode", "d", F.explode("d.notes").alias("n"))
    return notes.select(
        F.col("d.typeCode").alias("typeCode"), F.col("d.freqCode").alias("freqCode"),
        "clCode",
        F.col("d.reporterCode").alias("reporterCode"), F.col("d.period").alias("period"),
        F.col("d.datasetCode").alias("datasetCode"),
        *[F.col(f"n.{f}").alias(f) for f in NOTE_TEXT_FIELDS])


def availability_table(raw: DataFrame, schema: T.StructType,
                       json_col: str = "json_data") -> DataFrame:
    """Availability / tariff-line availability: ``data[]`` by a declared
    schema, plus the envelope's elapsedTime, count and error per row."""
    env = F.from_json(F.col(json_col),
                      T.StructType([T.StructField("elapsedTime", T.StringType()),
                                    T.StructField("count", T.IntegerType()),
                                    T.StructField("data", T.ArrayType(schema)),
                                    T.StructField("error", T.StringType())]))
    rows = raw.select(env.alias("e")).select("e.elapsedTime", "e.count", "e.error",
                                             F.explode("e.data").alias("d"))
    flat = rows.select(*[F.col(f"d.{f.name}").alias(f.name) for f in schema.fields],
                       "elapsedTime", "count", "error")
    return with_envelope_literals(flat, F.col("elapsedTime"), F.col("count"), F.col("error"))


def preview_extract(raw: DataFrame, keys: Sequence[str] = ("reporter_id", "partner_id",
                                                            "flow_id", "cmdCode", "year"),
                    fields: Sequence[str] = PREVIEW_FIELDS,
                    json_col: str = "json_data") -> DataFrame:
    """Bilateral preview answers (JSON arrays) -> one row per record with
    each field as JSON text; empty answers ``[]`` are skipped first."""
    return unnest_extract_json_text(filter_nonempty_json(raw, json_col), json_col,
                                    list(fields), keep=list(keys))


def reference_rows(raw: DataFrame, element_schema: T.StructType | str,
                   keys: Sequence[str] = (), json_col: str = "json_data") -> DataFrame:
    """Reference table documents: rows of the first non-empty list (or the
    top-level list), parsed with a declared schema.  Documents without a
    list produce no rows; use ``operators.flow.route_documents`` to report
    them."""
    elems = raw.select(*keys, F.explode(first_nonempty_list(json_col)).alias("_e"))
    return elems.select(*keys, F.from_json("_e", element_schema).alias("_r")).select(
        *keys, "_r.*")
