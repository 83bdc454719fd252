from tradelake.functions.text import format_key, replace_literal
from tradelake.operators.filters import (count_rows, drop_failed_rows, filter_column_neq,
                                         filter_threshold, spread)
from tradelake.operators.project import (project_rename, project_request_params,
                                         with_envelope_literals)


def _plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_column_neq_drops_nulls(spark):
    df = spark.createDataFrame([(1, 2), (3, 3), (None, 4), (5, None)], "a int, b int")
    assert [tuple(r) for r in filter_column_neq(df, "a", "b").collect()] == [(1, 2)]


def test_envelope_literals_from_python_values(spark):
    out = with_envelope_literals(spark.range(2), "0.2s", 2, None)
    assert [(f.name, f.dataType.simpleString()) for f in out.schema.fields[1:]] == [
        ("elapsedTime", "string"), ("count", "int"), ("error", "string")]
    assert {tuple(r)[1:] for r in out.collect()} == {("0.2s", 2, None)}


def test_replace_is_literal_and_format_key(spark):
    df = spark.createDataFrame([("cmd:H.S", 4, 2020)], "c string, r int, p int")
    r = df.select(replace_literal("c", ".", "_").alias("x"),
                  replace_literal("c", ":", "_").alias("y"),
                  format_key("reporter_%d_period_%d.json", "r", "p").alias("f")).collect()[0]
    assert (r.x, r.y, r.f) == ("cmd:H_S", "cmd_H.S", "reporter_4_period_2020.json")


def test_threshold_is_inclusive_and_pushed(spark, tmp_path):
    p = str(tmp_path / "da")
    spark.createDataFrame([(1, 250_000), (2, 250_001), (3, 5)],
                          "reporterCode int, totalRecords int").write.parquet(p)
    out = filter_threshold(spark.read.parquet(p)).select("reporterCode")
    assert sorted(r.reporterCode for r in out.collect()) == [1, 3]
    assert "LessThanOrEqual(totalRecords,250000)" in _plan_text(out)
    assert count_rows(out).collect()[0].n == 2


def test_drop_failed_and_rename(spark):
    df = spark.createDataFrame([(1, "[1]"), (2, None), (3, "")], "id int, json_data string")
    assert [r.id for r in drop_failed_rows(df).collect()] == [1]
    assert project_rename(df, {"id": "reporter_id"}).columns == ["reporter_id"]


def test_request_params_strings_and_defaults(spark):
    plan = spark.createDataFrame([(156, 842, "X", "01", 2015)],
                                 "reporter_id int, partner_id int, flow_id string, "
                                 "cmdCode string, year int")
    r = project_request_params(plan).collect()[0].asDict()
    assert r == {"typeCode": "C", "freqCode": "A", "clCode": "HS", "period": "2015",
                 "reporterCode": "156", "cmdCode": "01", "flowCode": "X", "partnerCode": "842",
                 "partner2Code": None, "customsCode": None, "motCode": None}


def test_spread_only_when_under_parallel(spark):
    few = spark.range(0, 100, numPartitions=1)
    many = spark.range(0, 100, numPartitions=64)
    assert spread(few, 8).rdd.getNumPartitions() == 8
    assert spread(many, 8).rdd.getNumPartitions() == 64
    assert sorted(r.id for r in spread(few, 8).collect()) == list(range(100))
