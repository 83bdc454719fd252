"""The original jobs' entry points, end to end over landed documents."""

import json

import pytest

from tradelake.plans.jobs import (run_availability, run_bilateral_plan, run_publication_notes,
                                  run_reference_tables, run_reporter_year_plan,
                                  run_world_share)


def _land(folder, name, doc):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(doc if isinstance(doc, str) else json.dumps(doc))


def test_world_share_and_notes_jobs(spark, tmp_path):
    landed = tmp_path / "ws"
    _land(landed, "world_share_C_A.json", {"count": 2, "data": [
        {"period": 2020, "year": 2020, "reporterCode": 4, "worldShare": 0.1},
        {"period": 2020, "year": 2020, "reporterCode": 8, "worldShare": 0.2}]})
    _land(landed, "world_share_S_M.json", {"count": 0, "data": []})
    out = str(tmp_path / "ws_out")
    assert run_world_share(spark, str(landed), out) == "written"
    rows = spark.read.parquet(out).collect()
    assert sorted((r.typeCode, r.freqCode, r.reporterCode) for r in rows) == [
        ("C", "A", 4), ("C", "A", 8)]

    empty = tmp_path / "ws_empty"
    _land(empty, "world_share_C_M.json", {"count": 0, "data": None})
    assert run_world_share(spark, str(empty), str(tmp_path / "ws_empty_out")) == "written_empty"
    assert spark.read.parquet(str(tmp_path / "ws_empty_out")).count() == 0

    notes = tmp_path / "notes"
    _land(notes, "notes_C_A_HS.json", {"data": [
        {"reporterCode": 4, "period": 2020, "typeCode": "C", "freqCode": "A", "datasetCode": 1,
         "notes": [{"currency": "USD"}, {"currency": "EUR"}]}]})
    nout = str(tmp_path / "notes_out")
    run_publication_notes(spark, str(notes), nout)
    assert sorted((r.clCode, r.currency) for r in spark.read.parquet(nout).collect()) == [
        ("HS", "EUR"), ("HS", "USD")]


def test_availability_job_fails_on_empty(spark, tmp_path):
    landed = tmp_path / "da"
    _land(landed, "da.json", {"elapsedTime": "1s", "count": 1, "error": None, "data": [
        {"datasetCode": 7, "reporterCode": 4, "period": 2020, "totalRecords": 10}]})
    out = str(tmp_path / "da_out")
    assert run_availability(spark, str(landed), out) == "written"
    assert spark.read.parquet(out).collect()[0].totalRecords == 10
    broken = tmp_path / "da_broken"
    _land(broken, "da.json", "<html>service unavailable</html>")
    with pytest.raises(RuntimeError):
        run_availability(spark, str(broken), out)
    assert spark.read.parquet(out).count() == 1          # the good dataset survived


def test_reference_tables_then_plans(spark, tmp_path):
    landed = tmp_path / "ref"
    _land(landed, "reporter.json", {"results": [{"id": 156, "text": "China"},
                                                {"id": 842, "text": "USA"},
                                                {"id": 4, "text": "Afghanistan"}]})
    _land(landed, "partner.json", {"results": [{"id": 156, "text": "China"},
                                               {"id": 842, "text": "USA"}]})
    _land(landed, "flow.json", {"more": [], "results": [{"id": "X", "text": "Export"},
                                                        {"id": "M", "text": "Import"},
                                                        {"id": "RX", "text": "Re-export"}]})
    _land(landed, "cmd_HS.json", [{"id": "TOTAL", "text": "All", "aggrLevel": 0},
                                  {"id": "01", "text": "Animals", "aggrLevel": 2}])
    _land(landed, "broken.json", "nope")
    ref = str(tmp_path / "ref_out")
    outcomes = {r.category: (r.ok_docs, r.rejected_docs)
                for r in run_reference_tables(spark, str(landed), ref).collect()}
    assert outcomes["cmd_HS"] == (1, 0) and outcomes["broken"] == (0, 1)

    plan_path = str(tmp_path / "plan")
    run_bilateral_plan(spark, ref, plan_path, [156, 842], [156, 842], ["X", "M"])
    plan = spark.read.parquet(plan_path)
    assert plan.count() == 2 * 2 * 1 * 14            # 2 ordered pairs x 2 flows x TOTAL x 14
    assert {r.cmdCode for r in plan.collect()} == {"TOTAL"}

    ry_path = str(tmp_path / "reporter_years")
    run_reporter_year_plan(spark, ref, ry_path)
    assert spark.read.parquet(ry_path).count() == 3 * 63
