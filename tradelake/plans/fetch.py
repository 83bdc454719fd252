"""Plan-driven fetch flows (§3 entry C and the per-reporter world share).

A plan DataFrame drives an injected per-request function on executors; the
answers stay JSON text next to the request keys, ready for a sink or for
extraction.  Answers are kept whole; failed requests are returned apart.
Answers are checkpointed right after the fetch, so reading both outputs, or a
lost executor later on, does not call the service again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tradelake.operators.filters import filter_nonempty_json
from tradelake.operators.flow import (BatchFn, RowFn, enrich_batches, enrich_partitions,
                                      split_failures)
from tradelake.operators.ledger import Answer, run_requests
from tradelake.plans.request_plan import distinct_pairs
from tradelake.plans.responses import preview_extract
from tradelake.schemas import PREVIEW_FIELDS
from tradelake.session import checkpoint_root, parallelism


def _fetched(plan: DataFrame, fetch: RowFn | None, keys: list[str], partitions: int | None,
             min_interval_s: float, batch_fetch: BatchFn | None = None
             ) -> tuple[DataFrame, DataFrame]:
    spark = plan.sparkSession
    checkpoint_root(spark)
    tasks = partitions or parallelism(spark)
    asked = (enrich_batches(plan, batch_fetch, keys, partitions=tasks) if batch_fetch else
             enrich_partitions(plan, fetch, keys, partitions=tasks, min_interval_s=min_interval_s))
    return split_failures(asked.checkpoint(eager=True))


PREVIEW_KEYS = ("reporter_id", "partner_id", "flow_id", "cmdCode", "year")


def fetch_per_reporter(plan: DataFrame, fetch: RowFn | None = None,
                       partitions: int | None = None, min_interval_s: float = 0.0,
                       batch_fetch: BatchFn | None = None) -> tuple[DataFrame, DataFrame]:
    """Distinct ``(reporter_id, reporter_name)`` of a plan -> one request
    each -> ``reporter_id, reporter_name, json_data`` (raw answer text).
    ``fetch`` answers a row, ``batch_fetch`` an Arrow batch.  Returns (answers, rejected)."""
    reporters = distinct_pairs(plan, ["reporter_id", "reporter_name"])
    return _fetched(reporters, fetch, ["reporter_id", "reporter_name"], partitions,
                    min_interval_s, batch_fetch)


def fetch_preview(plan: DataFrame, fetch: RowFn, keys: Sequence[str] = PREVIEW_KEYS,
                  partitions: int | None = None, min_interval_s: float = 0.0
                  ) -> tuple[DataFrame, DataFrame]:
    """X6 first half: one preview request per plan row (keys + JSON array
    answer).  Returns (answers, rejected)."""
    return _fetched(plan, fetch, list(keys), partitions, min_interval_s)


def plan_fetch_extract(plan: DataFrame, fetch: RowFn, fields: Sequence[str] = PREVIEW_FIELDS,
                       keys: Sequence[str] = PREVIEW_KEYS,
                       partitions: int | None = None,
                       min_interval_s: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """Plan -> fetch -> drop empty answers -> one row per returned
    record with each field as JSON text.  Returns (rows, rejected requests)."""
    answers, rejected = fetch_preview(plan, fetch, keys, partitions, min_interval_s)
    return preview_extract(filter_nonempty_json(answers), keys, fields), rejected


def resumable_extract(plan: DataFrame, answer: Answer, ledger_path: str, run: str,
                      fields: Sequence[str] = PREVIEW_FIELDS, keys: Sequence[str] = PREVIEW_KEYS,
                      nested: str | None = None) -> tuple[DataFrame, DataFrame]:
    """X6 over a request ledger: plan -> what no earlier run was answered ->
    answers landed -> one row per returned record of all runs.

    Returns (rows, requests still without an answer); a later run under another
    name asks only those.  ``answer`` and ``nested`` are as in
    ``operators.ledger.run_requests``.
    """
    answers, missing = run_requests(plan, answer, ledger_path, keys, run, nested=nested)
    return preview_extract(answers, keys, fields), missing
