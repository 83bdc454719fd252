"""Append-only ledgers of requests and of rejected documents.

A run only adds rows, below ``run=<name>``; what is answered, open or
resolved is derived from all runs.  A run that is repeated under its name
replaces its own rows, so a retry leaves no double entries.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

Answer = Callable[[DataFrame], DataFrame]


def _with_run(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("run", T.StringType())])


def _written(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """Rows of all runs; None where no run has written yet."""
    try:
        return spark.read.schema(_with_run(schema)).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of all runs; none where no run has written yet."""
    rows = _written(spark, path, schema)
    return spark.createDataFrame([], _with_run(schema)) if rows is None else rows


def _append(rows: DataFrame, path: str, run: str) -> None:
    (rows.withColumn("run", F.lit(run)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path))


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def outstanding(plan: DataFrame, answers: DataFrame, keys: Sequence[str],
                nested: str | None = None) -> DataFrame:
    """Requests of ``plan`` without an answer, each once.  The answers' keys are
    made distinct where they are first, so a key answered many times is one row.

    The key ``nested`` is an array in ``plan``, whose other keys do not repeat: a row stands
    for a request per element and keeps those without an answer.  Answers are
    then met by row, so the requests are never shuffled one by one.
    """
    if nested is None:
        return plan.join(answers.select(*keys).distinct().hint("merge"), list(keys), "left_anti")
    heads = nested_heads(keys, nested)
    value = F.col(nested).try_cast(plan.schema[nested].dataType.elementType)
    # a window, as one sort serves it and the join
    in_order = W.partitionBy(*heads).orderBy("_value")
    done = answers.select(*heads, value.alias("_value")).repartition(*heads).select(
        *heads, F.row_number().over(in_order).alias("_at"), F.collect_set("_value").over(
            in_order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("_done"))
    done = done.filter("_at = 1").drop("_at")
    left = F.array_except(nested, "_done")
    rows = plan.join(done.hint("merge"), heads, "left").filter(
        (F.size(nested) > F.coalesce(F.size("_done"), F.lit(0))) | (F.size(left) > 0))
    left = F.when(F.col("_done").isNull(), F.col(nested)).otherwise(left)
    return rows.withColumn(nested, left).select(*plan.columns)


def nested_heads(keys: Sequence[str], nested: str) -> list[str]:
    """Keys of a nested plan but ``nested``, last first: a plan's last dimension is
    mostly its largest, so sorts that begin with it seldom compare further."""
    return [k for k in reversed(list(keys)) if k != nested]


def run_requests(plan: DataFrame, answer: Answer, path: str, keys: Sequence[str], run: str,
                 result_col: str = "json_data", nested: str | None = None
                 ) -> tuple[DataFrame, DataFrame]:
    """X6 core: ask what no earlier run has been answered; returns (answers of
    all runs, requests of the plan that are still missing).

    ``answer`` maps a DataFrame of requests (``keys``, distinct) to the answers
    that came back: ``keys`` and ``result_col``; null answers count as missing.  It
    may be a join with landed documents or a fetch per row or batch.  Answers
    are written before anything else reads them, so nothing is asked twice.

    With ``nested`` the plan and the requests are nested as in ``outstanding``; answers and
    missing requests have a row each.
    """
    spark = plan.sparkSession
    requests = plan.select(*keys)
    fields = [requests.schema[k] for k in keys]
    if nested is None:
        requests = requests.distinct()
    else:
        fields = [T.StructField(f.name, f.dataType.elementType) if f.name == nested else f
                  for f in fields]
    schema = _nullable(T.StructType([*fields, T.StructField(result_col, T.StringType())]))
    earlier = _written(spark, path, schema)
    pending = requests if earlier is None else outstanding(
        requests, earlier.filter(F.col("run") != run), keys, nested)
    got = answer(pending).select(*keys, result_col).filter(F.col(result_col).isNotNull())
    _append(got, path, run)
    answers = _read(spark, path, schema)
    missing = outstanding(requests, answers, keys, nested)
    if nested is not None:
        missing = missing.select(*(F.explode(k).alias(k) if k == nested else k for k in keys))
    return answers.drop("run"), missing


def record_outcomes(outcomes: DataFrame, path: str, keys: Sequence[str], run: str,
                    ok_col: str = "ok", reason_col: str = "reason") -> None:
    """X3 ledger: add what a run rejected, and what it brought through that an
    earlier run had rejected.

    ``outcomes`` has one or more rows per item (``keys``) with ``ok_col`` and
    ``reason_col``; an item of this run is ok if any of its rows is.  Items that were never
    rejected leave no entry.
    """
    spark = outcomes.sparkSession
    items = outcomes.groupBy(*keys).agg(
        F.max(ok_col).alias("ok"), F.count("*").alias("attempts"),
        F.max(F.when(~F.col(ok_col), F.col(reason_col))).alias("reason"))
    items = items.withColumn("reason", F.when(~F.col("ok"), F.col("reason")))
    items = items.withColumn("attempts", F.col("attempts").cast("bigint"))
    schema = _nullable(items.schema)
    earlier = _read(spark, path, schema).filter((F.col("run") != run) & ~F.col("ok"))
    known = earlier.select(*keys).distinct().withColumn("_known", F.lit(True))
    entries = (items.join(known.hint("merge"), list(keys), "left")
               .filter(~F.col("ok") | F.col("_known")).drop("_known"))
    _append(entries, path, run)


def reject_history(spark: SparkSession, path: str, keys: Sequence[str], key_ddl: str) -> DataFrame:
    """Per item that was ever rejected: ``attempts`` that failed, ``first_run``,
    ``last_run``, the last ``reason`` and ``resolved_in`` (null while it is open).  Runs
    are ordered by name."""
    schema = T.StructType.fromDDL(f"{key_ddl}, ok boolean, attempts bigint, reason string")
    failed = ~F.col("ok")
    return _read(spark, path, schema).groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(failed, F.col("attempts"))), F.lit(0)).alias("attempts"),
        F.min(F.when(failed, F.col("run"))).alias("first_run"),
        F.max(F.when(failed, F.col("run"))).alias("last_run"),
        F.max_by("reason", F.when(failed, F.col("run"))).alias("reason"),
        F.max(F.struct("run", "ok")).alias("_last")).select(
        *keys, "attempts", "first_run", "last_run", "reason",
        F.when(F.col("_last.ok"), F.col("_last.run")).alias("resolved_in"))


def open_rejects(spark: SparkSession, path: str, keys: Sequence[str], key_ddl: str) -> DataFrame:
    """Items whose last run rejected them."""
    return reject_history(spark, path, keys, key_ddl).filter("resolved_in is null").drop(
        "resolved_in")
