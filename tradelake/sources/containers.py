"""Landed documents in container files (S8 at scale).

One file per document makes as many files as documents, all of which a driver
lists.  A container holds many documents, ordered by name, so the number of
files follows the bytes.  Containers are Parquet with small pages and page
indexes; together with the index rows (document, file, place in it, length) a
read by name opens the files that hold those names and, in them, the pages.

A document's name carries its request keys as a file name would, and keys are
recovered from it in the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a page: the least that a read by name takes from a file.
PAGE_ROWS = 20
ROW_GROUP_BYTES = 16 << 20
SCHEMA = "doc string, landed_at timestamp, n_bytes bigint, json_data string"


def land_containers(docs: DataFrame, path: str, name: Column, json_col: str = "json_data",
                    landed_at: Column | None = None, mode: str = "append") -> None:
    """Land ``docs`` as containers under ``path`` (added to those there).

    Documents are range-partitioned by name; no number of partitions is set,
    so AQE joins small ones by their bytes.  ``landed_at`` orders documents of one
    name that land again (default: now).
    """
    when = F.current_timestamp() if landed_at is None else landed_at
    rows = docs.select(name.cast("string").alias("doc"), when.cast("timestamp").alias("landed_at"),
                       F.octet_length(json_col).cast("bigint").alias("n_bytes"),
                       F.col(json_col).alias("json_data"))
    (rows.repartitionByRange("doc").sortWithinPartitions("doc").write.mode(mode)
     .option("parquet.block.size", ROW_GROUP_BYTES)
     .option("parquet.page.row.count.limit", PAGE_ROWS).parquet(path))


def container_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc, landed_at, file, place, length) of every landed document: the file
    that holds it, its row there and its bytes.  Documents are not read."""
    return spark.read.schema(SCHEMA).parquet(path).select(
        "doc", "landed_at", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("place"), F.col("n_bytes").alias("length"))


def _with_keys(df: DataFrame, key_pattern: str | None, key_names: Sequence[str],
               key_types: Sequence[str], json_col: str) -> DataFrame:
    keys = []
    if key_pattern:
        types = list(key_types) or ["string"] * len(key_names)
        keys = [F.nullif(F.regexp_extract("doc", key_pattern, i + 1), F.lit("")).try_cast(t).alias(n)
                for i, (n, t) in enumerate(zip(key_names, types, strict=True))]
    return df.select(*keys, F.col("doc").alias("source_file"), "landed_at",
                     F.col("json_data").alias(json_col))


def scan_containers(spark: SparkSession, path: str, key_pattern: str | None = None,
                    key_names: Sequence[str] = (), key_types: Sequence[str] = (),
                    json_col: str = "json_data", prefix: str | None = None) -> DataFrame:
    """One row per landed document: keys from its name (null where the pattern
    does not match), ``source_file`` (the name), ``landed_at`` and the document.

    ``prefix`` keeps the names that begin with it; the condition reaches the
    Parquet scan, which skips files, row groups and pages without such names.
    """
    df = spark.read.schema(SCHEMA).parquet(path)
    if prefix is not None:
        df = df.filter(F.col("doc").startswith(prefix))
    return _with_keys(df, key_pattern, key_names, key_types, json_col)


def scan_container_stream(spark: SparkSession, path: str, key_pattern: str | None = None,
                          key_names: Sequence[str] = (), key_types: Sequence[str] = (),
                          json_col: str = "json_data", max_files_per_trigger: int | None = None
                          ) -> DataFrame:
    """Streaming twin of ``scan_containers``: documents of new containers."""
    reader = spark.readStream.schema(SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _with_keys(reader.parquet(path), key_pattern, key_names, key_types, json_col)


def read_documents(spark: SparkSession, path: str, names: Sequence[str],
                   json_col: str = "json_data") -> DataFrame:
    """The documents of the given names, from only the files that hold them."""
    wanted = F.col("doc").isin([str(n) for n in names])
    files = [r.file for r in container_index(spark, path).filter(wanted).select("file")
             .distinct().collect()]
    df = spark.read.schema(SCHEMA)
    df = df.parquet(*files) if files else df.parquet(path).limit(0)
    return _with_keys(df.filter(wanted), None, (), (), json_col)
