import json
import os

from pyspark.sql import functions as F

from tradelake.plans.reference import (ingest_reference_tables, reference_index,
                                       reference_table)
from tradelake.plans.responses import world_share_table
from tradelake.streaming.landed import ingest_landed_stream


def test_reference_tables_flow(spark, tmp_path):
    index = spark.createDataFrame([(json.dumps({"results": [
        {"category": "reporter", "fileuri": "u1"}, {"category": "cmd:HS", "fileuri": "u2"},
        {"category": "broken", "fileuri": "u3"}]}),)], "json_data string")
    assert [tuple(r) for r in reference_index(index).collect()] == [
        ("reporter", "u1"), ("cmd:HS", "u2"), ("broken", "u3")]
    landed = spark.createDataFrame([
        ("reporter", json.dumps({"more": False, "results": [
            {"id": 4, "text": "Afghanistan", "reporter code": "AFG"},
            {"id": 8, "text": "Albania", "reporter code": "ALB"}]})),
        ("cmd:HS", json.dumps([{"id": "01", "text": "Animals", "aggrLevel": 2},
                               {"id": "TOTAL", "text": "All", "aggrLevel": 0}])),
        ("broken", "<html>oops</html>"),
    ], "category string, json_data string")
    out = str(tmp_path / "ref")
    outcomes = {r.category: (r.ok_docs, r.rejected_docs, r.ok_rows)
                for r in ingest_reference_tables(landed, out).collect()}
    assert outcomes == {"reporter": (1, 0, 2), "cmd_HS": (1, 0, 2), "broken": (0, 1, 0)}
    rep = reference_table(spark, out, "reporter")
    assert sorted(rep.columns) == ["id", "reporter_code", "text"]
    assert sorted((r.id, r.reporter_code) for r in rep.collect()) == [(4, "AFG"), (8, "ALB")]
    cmd = reference_table(spark, out, "cmd:HS")
    assert cmd.filter(F.col("aggrLevel") == 0).collect()[0].id == "TOTAL"
    assert spark.read.json(f"{out}/rejected").collect()[0].category == "broken"


def _doc(period, reporters):
    # pretty-printed, as landed by the original fetchers: must be read whole
    return json.dumps({"elapsedTime": "1s", "count": len(reporters), "error": None,
                       "data": [{"period": period, "year": period, "reporterCode": r,
                                 "worldShare": 0.1} for r in reporters]}, indent=4)


def test_streaming_ingest_is_incremental(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    out = str(tmp_path / "ws")
    (landing / "ws_C_A_1.json").write_text(_doc(2020, [4, 8]))
    (landing / "ws_S_M_1.json").write_text(_doc(2021, [4]))

    def parse(raw):
        return world_share_table(raw)

    def run():
        q = ingest_landed_stream(spark, str(landing), parse, out, name="ws_test",
                                 key_pattern=r"ws_([A-Z])_([A-Z])_",
                                 key_names=["typeCode", "freqCode"],
                                 checkpoint=str(tmp_path / "ckpt"))
        q.awaitTermination(120)
        assert q.exception() is None

    run()
    first = spark.read.parquet(out)
    assert sorted((r.typeCode, r.freqCode, r.reporterCode) for r in first.collect()) == [
        ("C", "A", 4), ("C", "A", 8), ("S", "M", 4)]
    (landing / "ws_C_M_2.json").write_text(_doc(2022, [12]))
    run()
    assert spark.read.parquet(out).count() == 4
    run()                                       # nothing new: nothing added
    assert spark.read.parquet(out).count() == 4
    assert os.path.isdir(tmp_path / "ckpt")
