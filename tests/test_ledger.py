"""Request and reject ledgers, coalesced requests, and the jobs built on them."""

import json

import pytest
from pyspark.sql import functions as F

from tradelake.operators.ledger import (open_rejects, outstanding, record_outcomes, reject_history,
                                        run_requests)
from tradelake.operators.project import coalesce_requests, expand_requests
from tradelake.plans.fetch import PREVIEW_KEYS, resumable_extract
from tradelake.plans.jobs import run_preview, run_reference_index
from tradelake.plans.reference import (ingest_reference_tables, reference_table,
                                       rejected_categories)


def test_a_second_run_asks_only_what_is_missing(spark, tmp_path):
    path, asked = str(tmp_path / "ledger"), []
    plan = spark.range(20).selectExpr("id AS k", "id % 2 AS side").unionByName(
        spark.range(3).selectExpr("id AS k", "id % 2 AS side"))          # repeated requests

    def service(limit):
        def answer(requests):
            asked.append(sorted(r.k for r in requests.collect()))
            return requests.withColumn("json_data", F.when(
                F.col("k") < limit, F.concat(F.lit("[") , F.col("k").cast("string"), F.lit("]"))))
        return answer

    for run, limit in (("a", 5), ("b", 12), ("b", 15), ("c", 15)):       # b is repeated whole
        answers, missing = run_requests(plan, service(limit), path, ["k", "side"], run)
        assert sorted(r.k for r in answers.collect()) == list(range(limit))
        assert sorted(r.k for r in missing.collect()) == list(range(limit, 20))
    assert asked == [list(range(20)), list(range(5, 20)), list(range(5, 20)), list(range(15, 20))]


def test_resumed_rows_are_those_of_all_runs(spark, tmp_path):
    plan = spark.createDataFrame([(4, 8, "M", "01", y) for y in (2010, 2011, 2012)],
                                 "reporter_id int, partner_id int, flow_id string, cmdCode string, year int")
    landed = spark.createDataFrame([(2010, '[{"typeCode":"C"},{"typeCode":"S"}]'), (2011, "[]")],
                                   "year int, json_data string")

    def answer(requests):
        return requests.join(landed, "year").select(*PREVIEW_KEYS, "json_data")
    rows, missing = resumable_extract(plan, answer, str(tmp_path / "l"), "r1", ["typeCode"])
    assert sorted((r.year, r.typeCode) for r in rows.collect()) == [(2010, '"C"'), (2010, '"S"')]
    assert [r.year for r in missing.collect()] == [2012]
    plan.write.parquet(str(tmp_path / "plan"))
    run_preview(spark, str(tmp_path / "plan"), answer, str(tmp_path / "l"), str(tmp_path / "t"), "r2")
    table = spark.read.parquet(str(tmp_path / "t"))
    assert table.count() == 2 and len(table.columns) == len(PREVIEW_KEYS) + 24 - 2 + 2


def test_reject_ledger_over_three_runs(spark, tmp_path):
    path = str(tmp_path / "rejects")

    def run(name, rows):
        record_outcomes(spark.createDataFrame(rows, "k string, ok boolean, reason string"), path, ["k"], name)
    run("r1", [("a", False, "html"), ("b", False, "empty"), ("b", False, "empty"), ("c", True, None)])
    run("r2", [("a", True, None), ("b", False, "html"), ("c", True, None)])
    run("r2", [("a", True, None), ("b", False, "html"), ("c", True, None)])     # a retry
    run("r3", [("a", True, None), ("c", False, "late")])
    got = {r.k: tuple(r)[1:] for r in reject_history(spark, path, ["k"], "k string").collect()}
    assert got == {"a": (1, "r1", "r1", "html", "r3"), "b": (3, "r1", "r2", "html", None),
                   "c": (1, "r3", "r3", "late", None)}
    assert sorted(r.k for r in open_rejects(spark, path, ["k"], "k string").collect()) == ["b", "c"]
    spark.read.parquet(path).createOrReplaceTempView("rejects")
    assert spark.sql("select count(distinct run) from rejects").first()[0] == 3
    assert open_rejects(spark, str(tmp_path / "none"), ["k"], "k string").count() == 0


def test_reference_runs_keep_a_ledger(spark, tmp_path):
    out = str(tmp_path / "ref")

    def run(name, **docs):
        ingest_reference_tables(spark.createDataFrame(
            list(docs.items()), "category string, json_data string"), out, run=name)
    good = json.dumps([{"id": 1, "text": "x"}])
    run("r1", flow=good, reporter="<html>", partner="<html>")
    run("r2", flow=good, reporter=json.dumps({"results": [{"id": 2}]}), partner="[]")
    open_now = rejected_categories(spark, out).collect()
    assert [(r.category, r.attempts, r.first_run, r.last_run) for r in open_now] == [
        ("partner", 2, "r1", "r2")]
    assert [r.id for r in reference_table(spark, out, "reporter").collect()] == [2]


def test_reference_index_job(spark, tmp_path):
    landed, out = tmp_path / "landed", str(tmp_path / "index")
    landed.mkdir()
    (landed / "list.json").write_text(json.dumps({"results": [
        {"category": "reporter", "fileuri": "u1", "file name": "R"},
        {"category": "flow", "fileuri": "u2", "file name": None}]}, indent=2))
    assert run_reference_index(spark, str(landed), out) == "written"
    index = spark.read.parquet(out)
    assert sorted(index.columns) == ["category", "file_name", "fileuri"]
    assert sorted(r.category for r in index.collect()) == ["flow", "reporter"]
    (landed / "list.json").write_text('{"results": []}')
    assert run_reference_index(spark, str(landed), out) == "skipped"
    assert spark.read.parquet(out).count() == 2


@pytest.mark.parametrize("most", [1, 3, 100])
def test_coalesced_requests_expand_to_the_plan(spark, most):
    rows = [(r, p, "M", "01", y) for r in range(7) for p in (1, 2) for y in range(2010, 2024)
            if not (r % 3 == 0 and y in (2013, 2017)) and not (r == 5 and y > 2011)]
    plan = spark.createDataFrame(rows + rows[:9], "reporter_id int, partner_id int, flow_id string, "
                                                  "cmdCode string, year int")
    asked = coalesce_requests(plan, most)
    back = [tuple(r) for r in expand_requests(asked).select(*PREVIEW_KEYS).collect()]
    assert sorted(back) == sorted(rows)
    got = asked.collect()
    assert all(1 <= len(r.reporters) <= most for r in got)
    assert sum(r.n_requests for r in got) == len(rows)
    if most == 100:                      # ranges of three kinds of reporters, two partners
        assert len(got) == 2 * (3 + 1 + 1)
    assert coalesce_requests(plan.limit(0), most).count() == 0


def _nested_world(spark):
    """A plan in rows and nested, and answers; keys repeat and may be null."""
    heads = [(r, p, f, c) for r in range(3) for p in range(2) for f in ("M", None) for c in range(5)]
    years = [2010, 2011, 2012, 2013]
    ddl = "reporter_id bigint, partner_id int, flow_id string, cmdCode bigint, "
    rows = spark.createDataFrame([(*h, y) for h in heads for y in years] * 2, ddl + "year int")
    nested = spark.createDataFrame([(*h, years) for h in heads], ddl + "year array<int>")
    answers = [(*h, y, "[]" if y == 2011 else '[{"typeCode":"C"}]') for h in heads if h[3] < 4
               for y in (2011, 2012, 2030, None) if (h[0] + h[3]) % 3] * 2
    answers += [(*h, y, "[]") for h in heads if h[3] == 4 for y in years]
    return rows, nested, spark.createDataFrame(answers, ddl + "year bigint, json_data string")


def test_nested_requests_are_never_shuffled_one_by_one(spark, tmp_path):
    rows, nested, landed = _nested_world(spark)
    heads = list(PREVIEW_KEYS[:-1])

    def by_row(requests):
        return requests.join(landed.hint("merge"), list(PREVIEW_KEYS)).select(*PREVIEW_KEYS, "json_data")

    def by_head(requests):
        asked = requests.withColumnRenamed("year", "years").join(landed.hint("merge"), heads)
        return asked.filter("array_contains(years, cast(year as int))").select(
            *heads, F.col("year").cast("int").alias("year"), "json_data")
    for run, only in (("r1", "cmdCode <= 1"), ("r2", "true")):
        got, missing = run_requests(nested, lambda q, only=only: by_head(q).filter(only),
                                    str(tmp_path / "nested"), PREVIEW_KEYS, run, nested="year")
        want, left = run_requests(rows, lambda q, only=only: by_row(q).filter(only),
                                  str(tmp_path / "rows"), PREVIEW_KEYS, run)
        assert missing.columns == left.columns and missing.schema["year"].dataType.typeName() == "integer"
        assert sorted(map(repr, missing.collect())) == sorted(map(repr, left.collect()))
        assert sorted(map(repr, got.select(want.columns).collect())) == sorted(map(repr, want.collect()))
    plan = missing._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanges and not any("year" in line for line in exchanges)


def test_nested_extract_gives_the_rows_of_the_plan(spark, tmp_path):
    rows, nested, landed = _nested_world(spark)
    landed = landed.filter("year is not null").withColumn("year", F.col("year").cast("int"))

    def by_head(requests):
        asked = requests.withColumnRenamed("year", "years").join(landed, list(PREVIEW_KEYS[:-1]))
        return asked.filter("array_contains(years, year)").select(*PREVIEW_KEYS, "json_data")
    got, _ = resumable_extract(nested, by_head, str(tmp_path / "n"), "r1", ["typeCode"], nested="year")
    want, _ = resumable_extract(rows, lambda q: q.join(landed, list(PREVIEW_KEYS)),
                                str(tmp_path / "r"), "r1", ["typeCode"])
    assert got.count() > 0
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


@pytest.mark.parametrize("most", [1, 3, 100])
def test_coalesced_nested_requests_are_those_of_the_rows(spark, most):
    rows, nested, landed = _nested_world(spark)
    missing = outstanding(nested, landed, PREVIEW_KEYS, nested="year")
    by_row = outstanding(rows, landed, PREVIEW_KEYS)
    got, want = coalesce_requests(missing, most), coalesce_requests(by_row, most)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert any(r.from_year == r.to_year == 2013 for r in got.collect())
