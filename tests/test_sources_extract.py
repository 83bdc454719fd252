import glob
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.operators.filters import limit_rows
from tradelake.plans.ingest import detail_requests, extract_details
from tradelake.schemas import AVAILABILITY_SCHEMA
from tradelake.sources.readers import (json_rows_declared_schema, rows_declared_schema,
                                       rows_inferred_schema, scan_csv_inferred,
                                       scan_landed_json, scan_parquet_sql)

SCHEMA = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("s", T.StringType()),
                       T.StructField("m", T.StringType())])


def test_declared_schema_records(spark):
    rows = rows_declared_schema(spark, [{"a": 1, "s": 5, "x": 9}], SCHEMA).collect()
    assert [tuple(r) for r in rows] == [(1, "5", None)]    # extra ignored, int stringified
    with pytest.raises(Exception):
        rows_declared_schema(spark, [{"a": "7"}], SCHEMA)
    with pytest.raises(Exception):
        rows_declared_schema(spark, [{"a": 2 ** 40}], SCHEMA)


def test_declared_schema_json_at_scale(spark):
    df = spark.createDataFrame([('{"a": 1, "s": 5, "x": 9}',), ('{"a": "7", "s": "t"}',),
                                ('{"a": 1099511627776}',), ("broken",)], "j string")
    rows = json_rows_declared_schema(df, "j", SCHEMA).collect()
    assert [tuple(r) for r in rows] == [(1, "5", None), (None, "t", None),
                                        (None, None, None), (None, None, None)]


def test_inferred_schema_orders_by_name_and_keeps_nulls(spark, tmp_path):
    p = tmp_path / "j.json"
    p.write_text('{"z": 1, "a": "x"}\n{"a": "y"}\n')
    df = rows_inferred_schema(spark, str(p))
    assert df.columns == ["a", "z"]
    assert df.schema["z"].dataType == T.LongType()
    assert sorted((r.a, r.z) for r in df.collect()) == [("x", 1), ("y", None)]


def test_csv_inferred_and_sql_scan(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_text("word,count\nthe,24\na,4\n")
    df = scan_csv_inferred(spark, str(p))
    assert [(f.name, f.dataType) for f in df.schema.fields] == [
        ("word", T.StringType()), ("count", T.IntegerType())]
    spark.range(10).write.parquet(str(tmp_path / "pq"))
    out = scan_parquet_sql(spark, "SELECT id FROM {t} WHERE id >= 7", t=str(tmp_path / "pq"))
    assert sorted(r.id for r in out.collect()) == [7, 8, 9]


def test_limit_rows_is_deterministic(spark):
    df = spark.range(0, 1000, numPartitions=7).select(((F.col("id") * 7919) % 1000).alias("k"))
    assert [r.k for r in limit_rows(df, 5, ["k"]).collect()] == [0, 1, 2, 3, 4]


def test_threshold_driven_detail_extract(spark, tmp_path):
    avail = str(tmp_path / "da")
    rows = [{"reporterCode": r, "period": p, "totalRecords": n}
            for r, p, n in [(4, 2020, 10), (4, 2021, 250_000), (8, 2020, 250_001), (12, 2020, 5),
                            (16, 2020, 7)]]
    spark.createDataFrame(rows, AVAILABILITY_SCHEMA).write.parquet(avail)
    plan = detail_requests(spark, avail)
    assert sorted((r.reporterCode, r.period, r.file_name) for r in plan.collect()) == [
        (4, 2020, "reporter_4_period_2020.json"), (4, 2021, "reporter_4_period_2021.json"),
        (12, 2020, "reporter_12_period_2020.json"), (16, 2020, "reporter_16_period_2020.json")]
    scan = plan._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(totalRecords,250000)" in scan

    def fetch(row):
        if row["reporterCode"] == 12:
            raise ConnectionError("timeout")
        if row["reporterCode"] == 16:
            return None
        return {"count": 1, "data": [{"reporterCode": row["reporterCode"], "period": row["period"]}]}

    out = str(tmp_path / "json")
    rejected = extract_details(spark, avail, fetch, out, partitions=2)
    assert sorted(r.reporterCode for r in rejected.collect()) == [12, 16]
    dirs = sorted(os.path.relpath(d, out) for d in glob.glob(f"{out}/*/*"))
    assert dirs == ["reporterCode=4/period=2020", "reporterCode=4/period=2021"]
    docs = spark.read.json(out)
    row = docs.filter("period = 2021").collect()[0]
    assert row["count"] == 1 and row.data[0].reporterCode == 4 and row.reporterCode == 4
    raw = scan_landed_json(spark, out, recursive=True, file_glob="*.txt",
                           key_pattern=r"reporterCode=(\d+)/period=(\d+)/",
                           key_names=["reporterCode", "period"], key_types=["int", "int"])
    got = sorted((r.reporterCode, r.period, json.loads(r.json_data)["data"][0]["period"])
                 for r in raw.collect())
    assert got == [(4, 2020, 2020), (4, 2021, 2021)]


def test_extract_fetches_each_request_once(spark, tmp_path):
    avail = str(tmp_path / "da")
    spark.createDataFrame([{"reporterCode": r, "period": 2020, "totalRecords": 1}
                           for r in range(6)], AVAILABILITY_SCHEMA).write.parquet(avail)
    calls = str(tmp_path / "calls")
    os.makedirs(calls)

    def fetch(row):
        with open(os.path.join(calls, f"{row['reporterCode']}-{os.getpid()}-{id(row)}"), "w"):
            pass
        if row["reporterCode"] == 0:
            raise ValueError("refused")
        return "{}"

    rejected = extract_details(spark, avail, fetch, str(tmp_path / "out"))
    assert rejected.count() == 1 and rejected.count() == 1
    assert len(os.listdir(calls)) == 6


def test_landed_json_lines_mode(spark, tmp_path):
    d = tmp_path / "reporter_4_period_2020"
    d.mkdir()
    (d / "part.json").write_text('{"count":1,"data":[{"a":1}]}\n{"count":2,"data":[{"a":2},{"a":3}]}\n')
    whole = scan_landed_json(spark, str(tmp_path), recursive=True, file_glob="*.json")
    lines = scan_landed_json(spark, str(tmp_path), recursive=True, file_glob="*.json",
                             per_line=True, key_pattern=r"reporter_(\d+)_period_(\d+)/",
                             key_names=["reporterCode", "period"], key_types=["int", "int"])
    assert whole.count() == 1
    got = sorted((r.reporterCode, r.period, json.loads(r.json_data)["count"])
                 for r in lines.collect())
    assert got == [(4, 2020, 1), (4, 2020, 2)]


def test_landed_pretty_documents_read_whole_recursively(spark, tmp_path):
    d = tmp_path / "landing" / "reporter_8_period_2021"
    d.mkdir(parents=True)
    doc = {"count": 2, "data": [{"a": "é"}, {"a": "ü"}]}
    (d / "reporter_8_period_2021.json").write_text(json.dumps(doc, indent=4), encoding="utf-8")
    raw = scan_landed_json(spark, str(tmp_path / "landing"), recursive=True, file_glob="*.json",
                           key_pattern=r"reporter_(\d+)_period_(\d+)\.json$",
                           key_names=["reporterCode", "period"], key_types=["int", "int"])
    rows = raw.collect()
    assert len(rows) == 1 and (rows[0].reporterCode, rows[0].period) == (8, 2021)
    assert json.loads(rows[0].json_data) == doc


def test_landed_keys_from_names_with_special_characters(spark, tmp_path):
    d = tmp_path / "landing" / "cat one"
    d.mkdir(parents=True)
    (d / "reporter a+b é_period_7.json").write_text('{"count":1}\n')
    pattern = r"/([^/]+)/reporter (.+)_period_(\d+)\.json$"
    for per_line in (False, True):
        raw = scan_landed_json(spark, str(tmp_path / "landing"), recursive=True,
                               file_glob="*.json", per_line=per_line, key_pattern=pattern,
                               key_names=["category", "reporter", "period"],
                               key_types=["string", "string", "int"])
        r = raw.collect()[0]
        assert (r.category, r.reporter, r.period) == ("cat one", "a+b é", 7), per_line
