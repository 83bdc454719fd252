"""Dataflow control: per-partition enrichment with row-level failure
isolation (X1, X2), table-level failure routing (X3) and empty-input
policies (X4)."""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.functions.json import first_nonempty_list

log = logging.getLogger(__name__)

RowFn = Callable[[dict], object]
BatchFn = Callable[[pa.RecordBatch], Sequence[object] | pa.Array]


def enrich_partitions(df: DataFrame, fn: RowFn, keys: Sequence[str],
                      result_col: str = "json_data",
                      partitions: int | None = None,
                      min_interval_s: float = 0.0) -> DataFrame:
    """Call ``fn(row_dict)`` for every row, emit ``keys + result + error``.

    ``fn`` is the per-request call (a fetch in production, a deterministic
    function in tests).  Its answer is kept as text: strings as they are,
    anything else JSON-encoded.  An exception fails only that row (X2): its
    result is null and ``error`` carries the message.  Rows stream through
    Arrow batches (``mapInArrow``), so a partition is never materialised as
    one list, and ``fn`` sees native Python values (an int key stays an int
    even when other rows are null).

    ``min_interval_s`` paces calls inside each task, so the whole job never
    sends more than ``partitions / min_interval_s`` requests per second to
    the service, however many executors run it.

    Project and filter *before* calling this: the Python boundary is opaque
    to Catalyst pushdown.
    """
    src = df.select(*keys)
    if partitions:
        src = src.repartition(partitions)
    key_fields = [src.schema[k] for k in keys]
    out_schema = T.StructType(key_fields + [
        T.StructField(result_col, T.StringType()),
        T.StructField("error", T.StringType())])

    names = [*keys, result_col, "error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_call = float("-inf")
        for batch in batches:
            results, errors = [], []
            # native Python values: ints stay ints even beside nulls
            for row in batch.to_pylist():
                if min_interval_s > 0:
                    wait = last_call + min_interval_s - time.monotonic()
                    if wait > 0:
                        time.sleep(wait)
                    last_call = time.monotonic()
                try:
                    answer = fn(row)
                    if answer is None:
                        results.append(None)
                        errors.append("empty answer")
                    else:
                        results.append(answer if isinstance(answer, str) else json.dumps(answer))
                        errors.append(None)
                except Exception as exc:  # noqa: BLE001 - row isolation is the feature
                    log.error("request failed for %s: %s", {k: row[k] for k in keys}, exc)
                    results.append(None)
                    errors.append(f"{type(exc).__name__}: {exc}")
            columns = [batch.column(batch.schema.get_field_index(k)) for k in keys]
            yield pa.RecordBatch.from_arrays(
                columns + [pa.array(results, pa.string()), pa.array(errors, pa.string())],
                names=names)

    return src.mapInArrow(run, out_schema)


def _text(answer: object) -> str | None:
    return answer if answer is None or isinstance(answer, str) else json.dumps(answer)


def answer_batch(batch: pa.RecordBatch, fn: BatchFn) -> tuple[list, list]:
    """Answers and errors of every row of ``batch`` by calls on batches.

    A call that fails is repeated on both halves of its rows, down to single
    rows: of n rows with k bad ones, about ``2 k log2(n / k)`` calls find them,
    and the others are answered in the largest batches without a bad row.
    """
    n = batch.num_rows
    results, errors = [None] * n, [None] * n
    pending = [(0, n)] if n else []
    while pending:
        start, end = pending.pop()
        try:
            answers = fn(batch.slice(start, end - start))
            answers = answers.to_pylist() if hasattr(answers, "to_pylist") else list(answers)
            if len(answers) != end - start:
                raise ValueError(f"{len(answers)} answers to {end - start} requests")
            texts = [_text(a) for a in answers]
        except Exception as exc:  # noqa: BLE001 - row isolation is the feature
            if end - start > 1:
                middle = (start + end) // 2
                pending += [(middle, end), (start, middle)]
                continue
            log.error("request failed: %s", exc)
            errors[start] = f"{type(exc).__name__}: {exc}"
            continue
        results[start:end] = texts
        errors[start:end] = ["empty answer" if t is None else None for t in texts]
    return results, errors


def enrich_batches(df: DataFrame, fn: BatchFn, keys: Sequence[str], result_col: str = "json_data",
                   partitions: int | None = None, batch_rows: int = 1000) -> DataFrame:
    """X1 by Arrow batches: ``fn`` answers up to ``batch_rows`` rows a call.

    Same output and failures as ``enrich_partitions``: ``keys + result + error``, one
    answer a row, a failing row fails alone (X2).  ``fn`` may be called again for
    rows of a batch that failed, so it should not depend on being called once.
    """
    src = df.select(*keys)
    if partitions:
        src = src.repartition(partitions)
    out_schema = T.StructType([src.schema[k] for k in keys] + [
        T.StructField(result_col, T.StringType()), T.StructField("error", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, batch_rows):
                part = batch.slice(at, batch_rows)
                results, errors = answer_batch(part, fn)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(results, pa.string()), pa.array(errors, pa.string())],
                    names=[*keys, result_col, "error"])

    return src.mapInArrow(run, out_schema)


def split_failures(enriched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(answered rows without the error column, rejected rows)."""
    ok = enriched.filter(F.col("error").isNull()).drop("error")
    rejected = enriched.filter(F.col("error").isNotNull())
    return ok, rejected


def route_documents(docs: DataFrame, json_col: str = "json_data") -> DataFrame:
    """Flag each landed document: ``rows`` (element texts) and ``ok``.

    A document that is unreadable or has no non-empty list is rejected
    without stopping the others.
    """
    return (docs.withColumn("rows", first_nonempty_list(json_col))
            .withColumn("ok", F.coalesce(F.size("rows") > 0, F.lit(False))))


def category_outcomes(routed: DataFrame, category_col: str = "category") -> DataFrame:
    """X3 report: per category, documents accepted and rejected and rows
    carried by the accepted ones (one aggregation pass)."""
    return routed.groupBy(category_col).agg(
        F.count(F.when(F.col("ok"), 1)).alias("ok_docs"),
        F.count(F.when(~F.col("ok"), 1)).alias("rejected_docs"),
        F.coalesce(F.sum(F.when(F.col("ok"), F.size("rows"))), F.lit(0)).cast("bigint")
        .alias("ok_rows"))


EMPTY_POLICIES = ("fail", "skip", "write")


def write_with_empty_policy(df: DataFrame, path: str, on_empty: str = "fail",
                            fmt: str = "parquet", mode: str = "overwrite") -> str:
    """Decide what an empty input does to an existing dataset.

    ``fail`` raises (default: an outage must not wipe a good dataset),
    ``skip`` leaves the target untouched, ``write`` replaces it with an
    empty dataset that still carries the schema.  Returns the outcome.
    """
    if on_empty not in EMPTY_POLICIES:
        raise ValueError(f"on_empty must be one of {EMPTY_POLICIES}")
    if df.isEmpty():
        if on_empty == "fail":
            raise RuntimeError(f"empty input, refusing to overwrite {path}")
        if on_empty == "skip":
            log.warning("empty input, %s left unchanged", path)
            return "skipped"
        df.write.mode(mode).format(fmt).save(path)
        return "written_empty"
    df.write.mode(mode).format(fmt).save(path)
    return "written"
