"""Landed documents in containers, and the upsert of documents that land again."""

import glob
import json

from pyspark.sql import functions as F

from tradelake.sources.containers import (container_index, land_containers, read_documents,
                                          scan_container_stream, scan_containers)
from tradelake.streaming.landed import ingest_upserts, latest_rows

KEYS = {"key_pattern": r"^reporter_(\d+)_period_(\d+)\.json$", "key_names": ["reporter", "period"],
        "key_types": ["int", "int"]}


def _docs(spark, n):
    name = F.format_string("reporter_%d_period_%d.json", F.col("id") % 50, 1900 + F.floor(F.col("id") / 50))
    text = F.concat(F.lit('{\n "count": 1, "data": ["é '), F.col("id").cast("string"), F.lit('"]\n}'))
    return spark.range(n).select(name.alias("name"), text.alias("json_data"))


def test_files_follow_bytes_and_keys_come_from_names(spark, tmp_path):
    p = str(tmp_path / "landed")
    docs = _docs(spark, 4000)
    land_containers(docs, p, F.col("name"))
    assert len(glob.glob(f"{p}/*.parquet")) <= 8
    back = scan_containers(spark, p, **KEYS)
    assert back.count() == 4000 and back.select("reporter", "period").distinct().count() == 4000
    whole = {r.name: r.json_data for r in docs.collect()}
    assert {r.source_file: r.json_data for r in back.collect()} == whole
    index = container_index(spark, p).collect()
    assert len({(r.file, r.place) for r in index}) == 4000
    assert all(r.length == len(whole[r.doc].encode()) for r in index)
    land_containers(spark.createDataFrame([("odd.json", "x")], "name string, json_data string"), p,
                    F.col("name"))
    assert [(r.reporter, r.period) for r in scan_containers(spark, p, **KEYS)
            .filter("source_file = 'odd.json'").collect()] == [(None, None)]


def test_reads_by_name_open_few_files_and_push_the_name(spark, tmp_path):
    p = str(tmp_path / "landed")
    for k in range(5):
        land_containers(_docs(spark, 1000).filter(F.col("name").startswith(f"reporter_{k}")), p,
                        F.col("name"))
    names = ["reporter_3_period_1900.json", "reporter_3_period_1907.json", "none.json"]
    found = read_documents(spark, p, names)
    assert sorted(r.source_file for r in found.collect()) == names[:2]
    assert len(found.inputFiles()) == 1 < len(glob.glob(f"{p}/*.parquet"))
    assert read_documents(spark, p, ["none.json"]).count() == 0
    some = scan_containers(spark, p, prefix="reporter_2_period_19", **KEYS)
    assert "StringStartsWith(doc,reporter_2_period_19)" in \
        some._jdf.queryExecution().executedPlan().toString()
    assert {r.reporter for r in some.collect()} == {2}


def test_documents_that_land_again_replace_their_rows(spark, tmp_path):
    landing, out, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))

    def land(when, docs):
        rows = [(n, json.dumps({"data": [{"v": v} for v in vs]}, indent=1)) for n, vs in docs.items()]
        land_containers(spark.createDataFrame(rows, "name string, json_data string"), landing,
                        F.col("name"), landed_at=F.lit(when).cast("timestamp"))

    def parse(raw):
        parsed = F.from_json("json_data", "data array<struct<v:int>>")["data"]
        return raw.withColumn("rows", F.transform(parsed, lambda d: F.struct(
            F.col("source_file").alias("doc"), d["v"].alias("v"))))

    def run():
        query = ingest_upserts(spark, scan_container_stream(spark, landing), parse, out, ckpt, buckets=4)
        query.awaitTermination(120)
        assert query.exception() is None
        return sorted((r.doc, r.v) for r in latest_rows(spark, out).collect())

    land("2024-01-02", {"a": [1, 2], "b": [3], "c": [4]})
    assert run() == [("a", 1), ("a", 2), ("b", 3), ("c", 4)]
    land("2024-01-03", {"a": [7], "b": [], "d": [8]})
    land("2024-01-01", {"c": [0]})               # late: an older version loses
    assert run() == [("a", 7), ("c", 4), ("d", 8)]
    land("2024-01-02", {"b": [5]})               # older than the version without rows
    assert run() == [("a", 7), ("c", 4), ("d", 8)]
    assert run() == [("a", 7), ("c", 4), ("d", 8)]


def test_preview_by_query_string(spark, tmp_path):
    from tradelake.plans.jobs import run_preview_query
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")

    def doc(*records):
        return json.dumps({"count": len(records), "data": list(records)})
    rows = [("preview_M_A_HS_TOTAL_156_842_2020.json", doc({"trade value": 1, "q": 2.5})),
            ("preview_M_A_HS_TOTAL_156_842_2021.json", doc({"trade value": 2}, {"trade value": 3})),
            ("preview_M_A_HS_TOTAL_15_842_2021.json", doc({"trade value": 9})),
            ("preview_M_A_HS_TOTAL_156_842_2023.json", doc({"trade value": 9})),
            ("preview_M_A_HS_TOTAL_156_0_2021.json", '{"error": "none"}'),
            ("preview_X_A_HS_TOTAL_156_842_2021.json", doc({"trade value": 9}))]
    land_containers(spark.createDataFrame(rows, "name string, json_data string"), landing, F.col("name"))
    assert run_preview_query(spark, landing, out, "156, 4", "842,0", 2020, 2022) == "written"
    got = spark.read.parquet(out)
    assert dict(got.dtypes) == {"q": "double", "trade_value": "bigint"}
    assert sorted((r.trade_value, r.q) for r in got.collect()) == [(1, 2.5), (2, None), (3, None)]
    assert run_preview_query(spark, landing, out, "156", "0", 2020, 2022) == "skipped"
    assert spark.read.parquet(out).count() == 3
