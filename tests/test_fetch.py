import json

from tradelake.plans.fetch import fetch_per_reporter, plan_fetch_extract


def test_fetch_per_reporter_dedupes_and_isolates(spark):
    plan = spark.createDataFrame([(4, "A", y) for y in range(3)] + [(8, "B", 2020), (9, "C", 1)],
                                 "reporter_id int, reporter_name string, year int")

    def fetch(row):
        if row["reporter_id"] == 9:
            raise TimeoutError("slow")
        return {"r": row["reporter_id"]}
    ok, rejected = fetch_per_reporter(plan, fetch, partitions=2)
    assert sorted((r.reporter_id, json.loads(r.json_data)["r"]) for r in ok.collect()) == [
        (4, 4), (8, 8)]
    assert [r.reporter_id for r in rejected.collect()] == [9]


def test_plan_fetch_extract_skips_empty_answers(spark):
    plan = spark.createDataFrame([("156", "842", "X", "01", 2010), ("156", "842", "M", "01", 2011)],
                                 "reporter_id string, partner_id string, flow_id string, "
                                 "cmdCode string, year int")

    def fetch(row):
        if row["flow_id"] == "X":
            return "[]"
        return [{"typeCode": "C", "refYear": row["year"], "tradeValue": 12.5, "partnerISO": None},
                {"typeCode": "C", "refYear": row["year"]}]
    out, rejected = plan_fetch_extract(
        plan, fetch, ["typeCode", "refYear", "tradeValue", "partnerISO"], partitions=2)
    rows = out.collect()
    assert rejected.count() == 0
    got = sorted(((r.flow_id, r.typeCode, r.refYear, r.tradeValue, r.partnerISO) for r in rows),
                 key=repr)
    assert got == sorted([("M", '"C"', "2011", "12.5", "null"), ("M", '"C"', "2011", None, None)],
                         key=repr)


def test_one_call_per_request_and_every_request_accounted_for(spark, tmp_path):
    plan = spark.range(10).selectExpr("id AS reporter_id", "id AS partner_id", "'X' AS flow_id",
                                      "'01' AS cmdCode", "2010 AS year")
    calls = str(tmp_path / "calls")

    def fetch(row):
        with open(calls, "a") as f:
            f.write(f"{row['reporter_id']}\n")
        if row["reporter_id"] % 5 == 0:
            raise TimeoutError("slow")
        return [{"typeCode": "C"}]
    rows, rejected = plan_fetch_extract(plan, fetch, ["typeCode"], partitions=2)
    got = [r.reporter_id for r in rows.collect()] + [r.reporter_id for r in rejected.collect()]
    assert sorted(got) == list(range(10))
    with open(calls) as f:
        assert sorted(map(int, f)) == list(range(10))
