import itertools
import os
import re
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tradelake.operators import product
from tradelake.operators.product import attach_dimension, with_sequence
from tradelake.plans.request_plan import (bilateral_plan, distinct_pairs, reporter_year_plan,
                                          year_dimension, year_span)
from tradelake.schemas import BILATERAL_PLAN_COLUMNS


def _plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_year_dimension_end_exclusive(spark):
    assert [r.year for r in year_dimension(spark, 2010, 2024).collect()] == list(range(2010, 2024))
    assert year_dimension(spark, 2010, 2024).schema["year"].dataType.simpleString() == "int"


def test_year_span_from_data(spark):
    df = spark.createDataFrame([("2001-05-01",), ("1998-01-01",)], "d string").select(
        F.to_date("d").alias("d"))
    assert [r.year for r in year_span(df, "d").collect()] == [1998, 1999, 2000, 2001]


def test_attach_dimension_equals_product(spark):
    big = spark.range(30).withColumnRenamed("id", "b")
    small = spark.createDataFrame([(i, f"n{i}") for i in range(45)] + [(1, "n1")],
                                  "s int, name string")
    out = attach_dimension(big, small, side=4)
    got = sorted(tuple(r) for r in out.collect())
    want = sorted((b, s, n) for b in range(30) for s, n in [(i, f"n{i}") for i in range(45)]
                  + [(1, "n1")])
    assert got == want
    plan = _plan_text(out)
    assert "CartesianProduct" not in plan and "Broadcast" not in plan


def test_attach_dimension_rejects_clashing_names(spark):
    with pytest.raises(ValueError):
        attach_dimension(spark.range(2), spark.range(2))


def test_with_sequence_empty_range(spark):
    assert with_sequence(spark.range(3), "year", 5, 5).count() == 0


def test_bilateral_plan_matches_brute_force(spark):
    reporters = spark.createDataFrame([(156, "China"), (842, "USA"), (None, "nil")],
                                      "reporter_id int, reporter_name string")
    partners = spark.createDataFrame([(156, "China"), (842, "USA"), (0, "World")],
                                     "partner_id int, partner_name string")
    flows = spark.createDataFrame([("X", "Export"), ("M", "Import")],
                                  "flow_id string, flow_name string")
    cmds = spark.createDataFrame([("01",), ("02",), ("TOTAL",)], "cmdCode string")
    plan = bilateral_plan(reporters, partners, flows, cmds)
    assert plan.columns == BILATERAL_PLAN_COLUMNS
    got = sorted(tuple(r) for r in plan.collect())
    want = sorted(
        (r[0], r[1], p[0], p[1], f[0], f[1], c, y)
        for r, p, f, c, y in itertools.product(
            [(156, "China"), (842, "USA")], [(156, "China"), (842, "USA"), (0, "World")],
            [("X", "Export"), ("M", "Import")], ["01", "02", "TOTAL"], range(2010, 2024))
        if r[0] != p[0])
    assert got == want
    assert len(got) == 4 * 2 * 3 * 14
    plan_text = _plan_text(plan)
    assert "NestedLoopJoin" not in plan_text and "CartesianProduct" not in plan_text


def test_reporter_year_plan(spark):
    reporters = spark.createDataFrame([(4, "A"), (8, "B")], "reporter_id int, reporter_name string")
    plan = reporter_year_plan(reporters)
    assert plan.count() == 2 * 63
    assert plan.agg(F.min("year"), F.max("year")).collect()[0] == (1962, 2024)


def test_distinct_pairs(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "reporter_id int, reporter_name string")
    assert sorted(tuple(r) for r in distinct_pairs(df, ["reporter_id", "reporter_name"]).collect()) == [
        (1, "a"), (2, "b")]


def test_product_with_hot_duplicates_and_nulls(spark):
    big = spark.createDataFrame([(i % 3,) for i in range(12)], "b int")     # repeated rows
    dim = [(7, "hot")] * 40 + [(i, f"n{i}") for i in range(25)] + [(None, None)] * 3
    small = spark.createDataFrame(dim, "s int, name string")
    out = attach_dimension(big, small, side=3)
    got = sorted(out.collect(), key=repr)
    want = sorted(((i % 3, s, n) for i in range(12) for s, n in dim), key=repr)
    assert [tuple(r) for r in got] == [tuple(w) for w in want]


def test_product_default_grid_and_empty_sides(spark):
    big = spark.range(20).withColumnRenamed("id", "b")
    small = spark.range(100).withColumnRenamed("id", "s")
    out = attach_dimension(big, small)
    assert out.count() == 2000
    assert out.distinct().count() == 2000
    assert attach_dimension(big.limit(0), small).count() == 0
    assert attach_dimension(big, small.limit(0)).count() == 0


@pytest.mark.parametrize("commodities", [2, 300])
def test_large_plan_is_parallel_and_broadcasts_nothing(spark, commodities):
    reporters = spark.range(60).selectExpr("id AS reporter_id", "'r' AS reporter_name")
    partners = spark.range(60).selectExpr("id AS partner_id", "'p' AS partner_name")
    flows = spark.range(4).selectExpr("id AS flow_id", "'f' AS flow_name")
    cmds = spark.range(0, commodities, numPartitions=1).selectExpr("id AS cmdCode")
    plan = bilateral_plan(reporters, partners, flows, cmds, years=(2020, 2021))
    sizes = [r["count"] for r in plan.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 60 * 59 * 4 * commodities
    text = _plan_text(plan)
    assert "Broadcast" not in text and "CartesianProduct" not in text
    if commodities > 100:
        assert len(sizes) >= spark.sparkContext.defaultParallelism
        assert max(sizes) < sum(sizes) / 4


def test_bilateral_plan_rows(spark):
    reporters = spark.createDataFrame([(i, f"r{i}") for i in range(4)] + [(None, "x")],
                                      "reporter_id int, reporter_name string")
    partners = spark.createDataFrame([(i, f"p{i}") for i in range(5)],
                                     "partner_id int, partner_name string")
    flows = spark.createDataFrame([("X", "Export"), ("M", "Import")],
                                  "flow_id string, flow_name string")
    cmds = spark.createDataFrame([("01",), ("02",)], "cmdCode string")
    plan = bilateral_plan(reporters, partners, flows, cmds, years=(2020, 2022))
    want = [(r, f"r{r}", p, f"p{p}", *f, c, y) for r in range(4) for p in range(5) if r != p
            for f in (("X", "Export"), ("M", "Import")) for c in ("01", "02") for y in (2020, 2021)]
    assert sorted(map(tuple, plan.collect())) == sorted(want)


def test_nested_plan_holds_the_distinct_keys(spark):
    reporters = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "x")],
                                      "reporter_id int, reporter_name string")
    partners = reporters.toDF("partner_id", "partner_name")
    flows = spark.createDataFrame([("X", "Export"), (None, "n")], "flow_id string, flow_name string")
    cmds = spark.createDataFrame([("01",), ("01",), (None,)], "cmdCode string")
    keys = ["reporter_id", "partner_id", "flow_id", "cmdCode", "year"]
    rows = bilateral_plan(reporters, partners, flows, cmds, (2020, 2023)).select(*keys).distinct()
    nested = bilateral_plan(reporters, partners, flows, cmds, (2020, 2023), nested=True)
    each = nested.select(*keys[:-1], F.explode("year").alias("year"))
    assert nested.count() == 8
    assert sorted(map(repr, each.collect())) == sorted(map(repr, rows.collect()))


def test_every_grid_cell_has_a_task_of_its_own(spark):
    big = spark.range(2000).withColumnRenamed("id", "b")
    small = spark.range(100, 400).withColumnRenamed("id", "s")
    out = attach_dimension(big, small, side=5)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == 25 and sum(sizes) == 600_000
    assert max(sizes) < 2 * 600_000 / 25


_SMALL_HEAP = """
from pyspark.sql import SparkSession, functions as F
from tradelake.operators.product import attach_dimension, with_sequence
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
big = spark.createDataFrame([(1, "r1", 2, "p2", "X", "Export")],
                            "r int, rn string, p int, pn string, f string, fn string")
small = spark.range(1_500_000).withColumnRenamed("id", "cmdCode")
plan = with_sequence(attach_dimension(big, small, side=3), "year", 2010, 2024)
plan.write.format("noop").mode("overwrite").save()
print("written")
"""


def test_product_with_a_long_dimension_runs_in_a_small_heap(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "PYTHONPATH": root, "SPARK_LOCAL_DIRS": str(tmp_path),
           "PYSPARK_SUBMIT_ARGS": "--driver-memory 512m "
           "--driver-java-options '-XX:+UseParallelGC' pyspark-shell"}
    run = subprocess.run([sys.executable, "-c", _SMALL_HEAP], env=env, cwd=tmp_path, text=True,
                         capture_output=True, timeout=120)
    assert "written" in run.stdout, run.stderr[-2000:]


def test_product_in_blocks_has_every_pair_once(spark, monkeypatch):
    monkeypatch.setattr(product, "BLOCK_ROWS", 3)
    big = spark.createDataFrame([(i % 5, None) for i in range(12)], "b int, x string")
    dim = [(7, "hot")] * 40 + [(i, f"n{i}") for i in range(25)] + [(None, None)] * 4
    small = spark.createDataFrame(dim, "s int, name string")
    want = sorted(((i % 5, None, s, n) for i in range(12) for s, n in dim), key=repr)
    for side in (1, 2, 5):
        got = attach_dimension(big, small, side=side)
        assert got.columns == ["b", "x", "s", "name"]
        assert sorted(map(tuple, got.collect()), key=repr) == want


def test_bilateral_plan_meets_every_dimension_in_blocks(spark):
    dims = [spark.createDataFrame([(i, "n") for i in range(3)], f"{k}_id int, {k}_name string")
            for k in ("reporter", "partner", "flow")]
    plan = bilateral_plan(*dims, spark.range(50).withColumnRenamed("id", "cmdCode"))
    assert plan.count() == 3 * 2 * 3 * 50 * 14
    text = _plan_text(plan)
    products = re.findall(r"SortMergeJoin \[_tl_cell#\w+, _tl_block#\w+\]", text)
    assert len(set(products)) == 3
    assert not re.search(r"hashpartitioning\(_tl_(cell|block)", text)
