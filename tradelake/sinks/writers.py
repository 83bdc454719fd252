"""Sinks (K1-K5).  All writers take any Hadoop URI."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from tradelake.functions.json import schemas_of
from tradelake.functions.text import replace_literal

#: Buffer of a copied stream.
COPY_BYTES = 4 << 20


def sink_parquet_overwrite(df: DataFrame, path: str) -> None:
    """K1: replace a Parquet dataset."""
    df.write.mode("overwrite").parquet(path)


def sink_single_parquet(df: DataFrame, path: str) -> None:
    """K2: one Parquet dataset (a directory of parallel parts) for plans and
    reference indexes of any size; read it back as one path."""
    df.write.mode("overwrite").parquet(path)


def _replacing(df: DataFrame, *keys: str) -> DataFrameWriter:
    """Writer that replaces only the partitions it writes."""
    return (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*keys))


def sink_json_per_key(df: DataFrame, path: str, keys: Sequence[str],
                      document_col: str | None = None) -> None:
    """K3: one JSON dataset per key, the key in the directory name
    (``reporterCode=.../period=...``).  The keys written replace their
    earlier output; other keys, and everything on an empty input, stay.

    Rows are written as JSON records, or - with ``document_col`` - that
    column is written as is, one JSON document per line (for answers that
    already are JSON text, so they are not encoded twice).

    Rows are clustered by key with a REBALANCE hint: normally one file per
    key, while AQE splits a hot key over several files instead of one task.
    """
    clustered = df.hint("rebalance", *keys)
    if document_col is None:
        _replacing(clustered, *keys).json(path)
        return
    # one document per line: raw line breaks in valid JSON can only be
    # whitespace between tokens (inside strings they are escaped), so
    # turning them into spaces keeps every document exactly
    one_line = F.translate(F.col(document_col), "\r\n", "  ")
    _replacing(clustered.select(*keys, one_line.alias("value")), *keys).text(path)


def sink_csv_quoted_single(df: DataFrame, path: str) -> str:
    """K4: one CSV file with one header and every field quoted; returns it.

    Parts are written in parallel (a sorted input is range-partitioned, so its
    order is that of the part names) behind a first part that holds the header,
    and the parts are joined in that order under ``path``: by the file system's
    own ``concat`` where it has one, which moves no data, or else by copying
    streams in fixed buffers.  An earlier file is replaced once the new one is whole.
    """
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}.parts-{uuid.uuid4().hex[:12]}"
    df.write.option("quoteAll", True).csv(staged)
    columns = ",".join('"' + c.replace("\\", "\\\\").replace('"', '\\"') + '"' for c in df.columns)
    hadoop = spark._jvm.org.apache.hadoop
    conf = spark._jsc.hadoopConfiguration()
    folder = hadoop.fs.Path(staged)
    fs = folder.getFileSystem(conf)
    parts = sorted(str(f.getPath().getName()) for f in fs.listStatus(folder)
                   if f.getPath().getName().startswith("part-"))
    whole = hadoop.fs.Path(folder, "whole.csv")
    out = fs.create(whole, True)
    out.write(bytearray(f"{columns}\n".encode()))
    try:
        out.close()
        array = spark.sparkContext._gateway.new_array(hadoop.fs.Path, len(parts))
        for i, name in enumerate(parts):
            array[i] = hadoop.fs.Path(folder, name)
        fs.concat(whole, array)
    except UnsupportedOperationException:
        out = fs.create(whole, True)
        try:
            out.write(bytearray(f"{columns}\n".encode()))
            for name in parts:
                part = fs.open(hadoop.fs.Path(folder, name))
                try:
                    hadoop.io.IOUtils.copyBytes(part, out, COPY_BYTES, False)
                finally:
                    part.close()
        finally:
            out.close()
    target = hadoop.fs.Path(path)
    fs.mkdirs(target)
    name = hadoop.fs.Path(target, "part-00000.csv")
    for old in fs.listStatus(target):
        fs.delete(old.getPath(), True)
    if not fs.rename(whole, name):
        raise OSError(f"could not move {whole} to {name}")
    fs.delete(folder, True)
    return str(name)


def sink_fanout_by_category(df: DataFrame, path: str, category_col: str = "category"
                            ) -> None:
    """K5: every category to its own typed Parquet dataset in one job.

    Rows keep their columns' types; ``:`` in a category becomes ``_``.
    Categories that are not written keep their earlier output.
    """
    others = [c for c in df.columns if c != category_col]
    rows = df.select(replace_literal(category_col, ":", "_").alias(category_col), *others)
    _replacing(rows.hint("rebalance", category_col), category_col).parquet(path)


def sink_fanout_json(df: DataFrame, path: str, category_col: str = "category",
                     json_col: str = "value", renamed=None) -> DataFrame:
    """K5 for rows that are JSON objects: typed Parquet, each category by a
    schema of its own; returns (category, schema).

    The schema of a category is aggregated over all of its rows (see
    ``functions.json.schemas_of``), and categories of one schema are written
    together, so there are as many jobs as different schemas.  ``renamed`` maps
    column names to those written.  Categories that are not written keep their
    earlier output.  ``df`` is read twice and more: pass a written table.
    """
    rows = df.select(replace_literal(category_col, ":", "_").alias(category_col), json_col)
    schemas = schemas_of(rows, json_col, category_col)
    # one row per category
    found = sorted((r[category_col], r["schema"]) for r in schemas.collect() if r["schema"])
    for schema in sorted({s for _, s in found}):
        own = [c for c, s in found if s == schema]
        typed = rows.filter(F.col(category_col).isin(own)).select(
            category_col, F.from_json(json_col, schema).alias("_r")).select(
            F.col(category_col).alias("_category"), "_r.*")
        names = [c for c in typed.columns if c != "_category"]
        new = renamed(names) if renamed else names
        typed = typed.toDF("_category", *new).hint("rebalance", "_category")
        clash = [n for n in new if n.lower() == category_col.lower()]
        if clash:
            raise ValueError(f"rows of {own} have a member {clash[0]!r}, the partition's name")
        _replacing(typed.withColumnRenamed("_category", category_col), category_col).parquet(path)
    return schemas


def read_category(spark, path: str, category: str, schema: str | None = None,
                  category_col: str = "category") -> DataFrame:
    """One fan-out category; conditions on its columns reach the Parquet scan."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{path}/{category_col}={category.replace(':', '_')}")
