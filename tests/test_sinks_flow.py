import csv
import json
import glob
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tradelake.operators.flow import (answer_batch, category_outcomes, enrich_batches,
                                      enrich_partitions, route_documents, split_failures,
                                      write_with_empty_policy)
from tradelake.operators.project import sanitize_columns_punct
from tradelake.sinks.writers import (read_category, sink_csv_quoted_single,
                                     sink_fanout_by_category, sink_fanout_json, sink_json_per_key,
                                     sink_parquet_overwrite, sink_single_parquet)
from tradelake.sources.readers import scan_landed_json


def test_parquet_overwrite_replaces(spark, tmp_path):
    p = str(tmp_path / "o")
    sink_parquet_overwrite(spark.range(10), p)
    sink_parquet_overwrite(spark.range(3), p)
    assert spark.read.parquet(p).count() == 3


def test_single_parquet_has_no_row_limit(spark, tmp_path):
    p = str(tmp_path / "one")
    sink_single_parquet(spark.range(0, 6_000_000, numPartitions=8), p)
    assert spark.read.parquet(p).count() == 6_000_000


def test_rerun_keeps_keys_it_does_not_write(spark, tmp_path):
    p, q = str(tmp_path / "k"), str(tmp_path / "f")
    both = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    for rows in (both, both.filter("k = 1").withColumn("v", F.lit("c")), both.limit(0)):
        sink_json_per_key(rows, p, ["k"])
        sink_fanout_by_category(rows.withColumn("category", F.col("k").cast("string")), q)
    assert sorted((r.k, r.v) for r in spark.read.json(p).collect()) == [(1, "c"), (2, "b")]
    assert sorted((r.k, r.v) for r in spark.read.parquet(q).select("k", "v").collect()) == [
        (1, "c"), (2, "b")]


def test_empty_list_is_rejected(spark):
    docs = spark.createDataFrame([("[]",), ("[1]",), ('{"a":[]}',)], "json_data string")
    assert {r.json_data: r.ok for r in route_documents(docs).collect()} == {
        "[]": False, "[1]": True, '{"a":[]}': False}


def test_json_per_key_and_landed_scan(spark, tmp_path):
    p = str(tmp_path / "k")
    df = spark.createDataFrame([(4, 2020, '{"a":1}'), (4, 2021, '{"a":2}'), (8, 2020, '{"a":3}')],
                               "reporterCode int, period int, response string")
    sink_json_per_key(df, p, ["reporterCode", "period"])
    dirs = sorted(os.path.relpath(d, p) for d in glob.glob(f"{p}/*/*"))
    assert dirs == ["reporterCode=4/period=2020", "reporterCode=4/period=2021",
                    "reporterCode=8/period=2020"]
    back = spark.read.json(p)
    assert back.count() == 3
    landed = scan_landed_json(spark, p, recursive=True, file_glob="*.json",
                              key_pattern=r"reporterCode=(\d+)/period=(\d+)/",
                              key_names=["reporterCode", "period"], key_types=["int", "int"])
    assert sorted((r.reporterCode, r.period) for r in landed.collect()) == [
        (4, 2020), (4, 2021), (8, 2020)]


def test_fanout_by_category(spark, tmp_path):
    p = str(tmp_path / "f")
    df = spark.createDataFrame([("cmd:HS", 1, "x"), ("cmd:HS", 2, "y"), ("flow", 3, None)],
                               "category string, id int, text string")
    sink_fanout_by_category(df, p)
    assert sorted(os.path.basename(d) for d in glob.glob(f"{p}/category=*")) == [
        "category=cmd_HS", "category=flow"]
    cmd = read_category(spark, p, "cmd:HS", "id int, text string")
    assert sorted(tuple(r) for r in cmd.collect()) == [(1, "x"), (2, "y")]


def test_sanitize_punct_collision(spark):
    with pytest.raises(ValueError):
        sanitize_columns_punct(spark.createDataFrame([(1, 2)], "`a b` int, `a.b` int"))
    for names in ("`A b` int, `a.b` int", "`a b` int, `a b` int"):
        with pytest.raises(ValueError):
            sanitize_columns_punct(spark.createDataFrame([(1, 2)], names))
    out = sanitize_columns_punct(spark.createDataFrame([(1, 2)], "`a b` int, `c:d` int"))
    assert out.columns == ["a_b", "c_d"]


def test_enrich_isolates_row_failures(spark):
    def fetch(row):
        if row["k"] % 3 == 0:
            raise RuntimeError("boom")
        if row["k"] == 4:
            return None
        return [{"k": row["k"]}]
    df = spark.range(10).withColumnRenamed("id", "k")
    enriched = enrich_partitions(df, fetch, ["k"], partitions=3)
    ok, rejected = split_failures(enriched)
    assert sorted(r.k for r in ok.collect()) == [1, 2, 5, 7, 8]
    assert sorted(r.k for r in rejected.collect()) == [0, 3, 4, 6, 9]
    assert ok.filter(F.col("k") == 1).collect()[0].json_data == '[{"k": 1}]'


def test_route_documents_and_outcomes(spark):
    docs = spark.createDataFrame([("a", '{"r":[1,2]}'), ("a", "{broken"), ("b", "[3]")],
                                 "category string, json_data string")
    out = {r.category: (r.ok_docs, r.rejected_docs)
           for r in category_outcomes(route_documents(docs)).collect()}
    assert out == {"a": (1, 1), "b": (1, 0)}


def test_empty_input_policies(spark, tmp_path):
    p = str(tmp_path / "e")
    assert write_with_empty_policy(spark.range(5), p, "fail") == "written"
    empty = spark.range(0)
    with pytest.raises(RuntimeError):
        write_with_empty_policy(empty, p, "fail")
    assert write_with_empty_policy(empty, p, "skip") == "skipped"
    assert spark.read.parquet(p).count() == 5
    assert write_with_empty_policy(empty, p, "write") == "written_empty"
    assert spark.read.parquet(p).count() == 0
    assert spark.read.parquet(p).columns == ["id"]


def test_enrich_paces_calls_per_task(spark):
    import time as _time
    df = spark.range(8).withColumnRenamed("id", "k")
    paced = enrich_partitions(df, lambda row: {"t": _time.monotonic()}, ["k"], partitions=1,
                              min_interval_s=0.05)
    stamps = sorted(json.loads(r.json_data)["t"] for r in paced.collect())
    gaps = [b - a for a, b in zip(stamps, stamps[1:])]
    assert len(stamps) == 8 and min(gaps) >= 0.045


def test_enrich_sees_native_values(spark):
    df = spark.createDataFrame([(156, "a"), (None, "b"), (842, None)], "k int, s string")
    seen = enrich_partitions(df, lambda row: {"k": row["k"], "type": type(row["k"]).__name__},
                             ["k", "s"], partitions=1)
    got = sorted((json.loads(r.json_data)["type"], r.k) for r in seen.collect() if r.k)
    assert got == [("int", 156), ("int", 842)]
    assert seen.schema["k"].dataType.simpleString() == "int"


def test_per_key_documents_stay_one_per_line(spark, tmp_path):
    doc = json.dumps({"count": 1, "data": [{"text": "two\nlines"}]}, indent=4)
    df = spark.createDataFrame([(4, 2020, doc), (4, 2020, '{"count":0}')],
                               "reporterCode int, period int, json_data string")
    out = str(tmp_path / "docs")
    sink_json_per_key(df, out, ["reporterCode", "period"], document_col="json_data")
    back = spark.read.json(out)
    assert sorted(r["count"] for r in back.collect()) == [0, 1]
    texts = [r.data[0].text for r in back.filter("count = 1").collect()]
    assert texts == ["two\nlines"]


def test_quoted_csv_is_one_sorted_file_with_one_header(spark, tmp_path):
    out = str(tmp_path / "words")
    df = (spark.range(5000).select(F.format_string('w%05d "q"', "id").alias("the word"),
                                   F.col("id").alias("n")).repartition(8).orderBy("the word"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert df.rdd.getNumPartitions() > 1
        for _ in range(2):                       # a second run replaces the file
            path = sink_csv_quoted_single(df, out)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [f for f in os.listdir(out) if not f.startswith(".")] == [os.path.basename(path)]
    assert len(os.listdir(tmp_path)) == 1        # no parts are left behind
    with open(path, newline="") as f:
        lines = f.read().splitlines()
    assert lines[0] == '"the word","n"' and len(lines) == 5001
    rows = list(csv.reader(lines, escapechar="\\"))
    assert [int(n) for _, n in rows[1:]] == list(range(5000))
    empty = sink_csv_quoted_single(df.limit(0), str(tmp_path / "none"))
    with open(empty) as f:
        assert f.read() == '"the word","n"\n'


def test_fanout_json_gives_each_category_its_own_types(spark, tmp_path):
    p = str(tmp_path / "f")
    rows = [("cmd:HS", '{"id":"01","aggr Level":2,"w":1}'), ("cmd:HS", '{"id":"TOTAL","aggr Level":0,"w":2.5}'),
            ("reporter", '{"id":4,"iso":null,"m":1}'), ("reporter", '{"id":8,"m":"x","tags":["a"]}'),
            ("broken", "<html>")]
    df = spark.createDataFrame(rows, "category string, value string")
    schemas = {r.category: r.schema for r in sink_fanout_json(
        df, p, renamed=lambda ns: [n.replace(" ", "_") for n in ns]).collect()}
    assert schemas["broken"] is None
    cmd = read_category(spark, p, "cmd:HS")
    assert dict(cmd.dtypes) == {"aggr_Level": "bigint", "id": "string", "w": "double"}
    total = cmd.filter((F.col("aggr_Level") == 0) & F.col("id").isin("TOTAL", "02"))
    plan = total._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(aggr_Level,0)" in plan and "In(id, [02,TOTAL])" in plan
    assert [r.w for r in total.collect()] == [2.5]
    rep = read_category(spark, p, "reporter")
    assert dict(rep.dtypes) == {"id": "bigint", "iso": "string", "m": "string", "tags": "array<string>"}
    assert sorted((r.id, r.m) for r in rep.collect()) == [(4, "1"), (8, "x")]
    with pytest.raises(ValueError):
        sink_fanout_json(spark.createDataFrame([("a", '{"category":1}')], "category string, value string"), p)


def test_bad_rows_of_a_batch_are_found_by_bisection():
    batch = pa.RecordBatch.from_pydict({"k": list(range(1024))})
    for bad, most in (({5}, 2 * 11), ({5, 900}, 2 * 2 * 11), (set(), 1)):
        calls = []

        def fn(part):
            calls.append(part.num_rows)
            if bad & set(part.column("k").to_pylist()):
                raise ValueError("no")
            return [{"k": k} for k in part.column("k").to_pylist()]
        results, errors = answer_batch(batch, fn)
        assert len(calls) <= most
        assert [i for i, e in enumerate(errors) if e] == sorted(bad)
        assert all(json.loads(r)["k"] == i for i, r in enumerate(results) if i not in bad)


def test_batches_and_rows_fail_alike(spark):
    def by_row(row):
        if row["k"] % 7 == 0:
            raise RuntimeError("boom")
        return None if row["k"] == 4 else [row["k"]]

    def by_batch(batch):
        return [by_row(r) for r in batch.to_pylist()]
    df = spark.range(200).withColumnRenamed("id", "k")
    one = enrich_partitions(df, by_row, ["k"], partitions=3)
    many = enrich_batches(df, by_batch, ["k"], partitions=3, batch_rows=16)
    assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, many.collect()), key=repr)
    short = split_failures(enrich_batches(df.limit(3), lambda b: [1], ["k"], partitions=1))
    assert short[0].count() == 3                 # wrong counts are split down to rows
    assert enrich_batches(df.limit(0), by_batch, ["k"]).count() == 0
