"""Sources (S1-S8).

Readers are lazy: nothing is read until an action, and Catalyst pushes
filters and column pruning into the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Parquet dataset; ``path`` may be a glob such as ``data/DA/*.parquet``."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.parquet(*paths)


def scan_parquet_sql(spark: SparkSession, query_template: str, **paths: str) -> DataFrame:
    """SQL over Parquet addressed by path, e.g.
    ``scan_parquet_sql(spark, "SELECT * FROM {t} WHERE x > 1", t=path)``
    expands to ``parquet.`path```."""
    quoted = {k: "parquet.`" + v.replace("`", "``") + "`" for k, v in paths.items()}
    return spark.sql(query_template.format(**quoted))


def scan_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """S3: CSV with header; every column a string, header and value
    whitespace preserved (sanitise names afterwards with P4)."""
    return (spark.read.option("header", True).option("inferSchema", False)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .csv(path))


def scan_csv_inferred(spark: SparkSession, path: str, sampling_ratio: float = 1.0
                      ) -> DataFrame:
    """CSV with header and type inference (one extra pass over the
    sampled data; use a declared schema for production-size inputs)."""
    return (spark.read.option("header", True).option("inferSchema", True)
            .option("samplingRatio", sampling_ratio).csv(path))


def scan_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def rows_declared_schema(spark: SparkSession, rows: Sequence, schema: T.StructType | str
                         ) -> DataFrame:
    """S6 (driver-side records): small in-memory records with a declared
    schema; missing keys are null, extra keys ignored."""
    return spark.createDataFrame(list(rows), schema=schema)


def json_rows_declared_schema(df: DataFrame, json_col: str, schema: T.StructType | str,
                              keep: Sequence[str] = ()) -> DataFrame:
    """S6 at scale: JSON records in a column parsed with a declared schema
    (missing keys null, extra keys ignored, unreadable fields null)."""
    parsed = F.from_json(F.col(json_col), schema)
    return df.select(*keep, parsed.alias("_r")).select(*keep, "_r.*")


def rows_inferred_schema(spark: SparkSession, source: DataFrame | str,
                         json_col: str = "value", sampling_ratio: float = 1.0) -> DataFrame:
    """JSON records with an inferred schema.

    ``source`` is a path of JSON-lines files or a DataFrame holding one
    JSON record per row in ``json_col``.  A DataFrame is first landed as
    JSON lines under the shared scratch folder, so inference and parsing
    run in the JVM (never through Python row objects).  Inference orders
    columns by name; integers become bigint and a missing value is null.
    """
    reader = spark.read.option("samplingRatio", sampling_ratio)
    if isinstance(source, str):
        return reader.json(source)
    from tradelake.session import scratch_path
    landed = scratch_path(spark, "json-lines")
    source.select(F.col(json_col).alias("value")).write.text(landed)
    return reader.json(landed)


def scan_landed_json(spark: SparkSession, path: str, key_pattern: str | None = None,
                     key_names: Sequence[str] = (), key_types: Sequence[str] = (),
                     json_col: str = "json_data", file_glob: str | None = None,
                     recursive: bool = False, per_line: bool = False) -> DataFrame:
    """Landed response documents, one document per file.

    Each file is one row (read whole, UTF-8), so parse/explode parallelism is
    the number of documents; ``per_line=True`` reads files that hold one
    compact JSON document per line (JSON lines) instead, and splits large
    files.  ``path`` is a file, glob or directory;
    ``recursive`` walks a directory tree and ``file_glob`` (e.g.
    ``"*.json"``) filters file names.  Request keys are recovered from the
    file path with ``key_pattern`` (one capture group per name), e.g.
    ``r"reporter_(\\d+)_period_(\\d+)\\.json$"``; a path that does not
    match gives null keys.
    """
    # Whole files come from the binaryFile source: the text source's
    # ``wholetext`` is not honoured together with ``recursiveFileLookup``
    # (a pretty-printed document would be split into lines).
    reader = spark.read.format("text" if per_line else "binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    raw = reader.load(path)
    if per_line:
        # the metadata path is URI-encoded; a literal "+" must survive decoding
        source = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        text = F.col("value")
    else:
        source, text = F.col("path"), F.decode("content", "UTF-8")
    df = raw.select(source.alias("source_file"), text.alias(json_col))
    if key_pattern:
        types = list(key_types) or ["string"] * len(key_names)
        df = df.select(*[F.nullif(F.regexp_extract("source_file", key_pattern, i + 1), F.lit(""))
                         .try_cast(t).alias(n)
                         for i, (n, t) in enumerate(zip(key_names, types))],
                       "source_file", json_col)
    return df
