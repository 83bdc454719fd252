import json

from pyspark.sql import functions as F

from tradelake.functions.json import (explode_nested, first_nonempty_list, member_or_empty,
                                      to_json_text, unnest_extract_json_text)
from tradelake.plans.responses import (availability_table, notes_table, reference_rows,
                                       world_share_table)
from tradelake.schemas import AVAILABILITY_SCHEMA, NOTES_COLUMNS, WORLD_SHARE_COLUMNS


def _docs(spark, docs, keys=("typeCode", "freqCode")):
    rows = [(*k, d) for k, d in docs]
    return spark.createDataFrame(rows, ", ".join(f"{k} string" for k in keys)
                                 + ", json_data string")


def _ws(period, code, share="0.5"):
    return (f'{{"typeCode":"X","freqCode":"Y","period":{period},"year":2020,"month":1,'
            f'"reporterCode":{code},"worldShare":{share},"isAvailable":true}}')


def test_world_share_edge_documents(spark):
    docs = [
        (("C", "A"), '{"elapsedTime":"1s","count":2,"data":[' + _ws(2020, 4) + "," +
         _ws(2021, 8) + '],"error":null}'),
        (("C", "M"), "this is not json"),
        (("S", "A"), '{"count":0,"data":null}'),
        (("S", "M"), '{"count":0,"data":[]}'),
        (("C", "Q"), '{"data":[' + _ws('"oops"', 7) + "]}"),       # wrong-typed field
        (("C", "Z"), '{"data":[' + _ws(7.0, 9) + "]}"),            # fractional for int
    ]
    out = world_share_table(_docs(spark, docs))
    assert out.columns == WORLD_SHARE_COLUMNS
    rows = sorted(out.collect(), key=lambda r: (r.freqCode, r.reporterCode))
    assert [(r.typeCode, r.freqCode, r.period, r.reporterCode) for r in rows] == [
        ("C", "A", 2020, 4), ("C", "A", 2021, 8), ("C", "Q", None, 7), ("C", "Z", None, 9)]
    # request keys win over the payload's own typeCode/freqCode
    assert {r.typeCode for r in rows} == {"C"}
    assert rows[0].worldShare == 0.5 and rows[0].isAvailable is True


def test_notes_two_level_and_parent_keys_win(spark):
    note = ('{"datasetCode":1,"typeCode":"N","freqCode":"N","period":1,"reporterCode":1,'
            '"currency":"USD","publicationNote":"p"}')
    doc = json.dumps({"data": [
        {"reporterCode": 4, "period": 2020, "typeCode": "C", "freqCode": "A",
         "datasetCode": 42, "notes": [json.loads(note), json.loads(note)]},
        {"reporterCode": 8, "period": 2020, "typeCode": "C", "freqCode": "A",
         "datasetCode": 43, "notes": []},
        {"reporterCode": 9, "period": 2020, "typeCode": "C", "freqCode": "A",
         "datasetCode": 44},
    ]})
    raw = spark.createDataFrame([("C", "A", "HS", doc)],
                                "typeCode string, freqCode string, clCode string, "
                                "json_data string")
    out = notes_table(raw)
    assert out.columns == NOTES_COLUMNS
    rows = out.collect()
    assert len(rows) == 2
    r = rows[0]
    assert (r.typeCode, r.freqCode, r.clCode, r.reporterCode, r.datasetCode) == (
        "C", "A", "HS", 4, 42)
    assert r.currency == "USD" and r.exportValuation is None


def test_availability_keeps_envelope_members_typed(spark, tmp_path):
    doc = json.dumps({"elapsedTime": "0.2s", "count": 1, "error": None, "data": [
        {"datasetCode": 1, "typeCode": "C", "freqCode": "A", "period": 2020,
         "reporterCode": 4, "isOriginalClassification": True, "totalRecords": 10,
         "extra": "ignored"}]})
    raw = spark.createDataFrame([(doc,)], "json_data string")
    out = availability_table(raw, AVAILABILITY_SCHEMA)
    assert out.columns[-3:] == ["elapsedTime", "count", "error"]
    assert out.schema["error"].dataType.simpleString() == "string"
    out.write.parquet(str(tmp_path / "da"))
    back = spark.read.parquet(str(tmp_path / "da"))
    assert back.schema["error"].dataType.simpleString() == "string"
    r = back.collect()[0]
    assert (r.totalRecords, r.elapsedTime, r["count"], r.error) == (10, "0.2s", 1, None)


def test_unnest_extract_json_text_semantics(spark):
    df = spark.createDataFrame(
        [(1, '[{"a":"x","b":1,"c":null},{"a":"y","b":2.5}]'), (2, "[]"), (3, "oops"),
         (4, None), (5, '{"a":1}')], "id int, j string")
    rows = unnest_extract_json_text(df, "j", ["a", "b", "c"], ["id"]).collect()
    assert sorted(tuple(r) for r in rows) == [(1, '"x"', "1", "null"), (1, '"y"', "2.5", None)]


def test_unnest_extract_keeps_number_text(spark):
    df = spark.createDataFrame(
        [('[{"a":23.0,"b":"1.50"},{"a":1.50,"b":[1.0]},{"a":-7},{"a":true},{"a":null},{}]',),
         ('[5,{"a":2}]',)], "j string")
    rows = unnest_extract_json_text(df, "j", ["a", "b"]).collect()
    assert [tuple(r) for r in rows][:6] == [
        ("23.0", '"1.50"'), ("1.5", "[1]"), ("-7", None), ("true", None), ("null", None),
        (None, None)]
    assert sorted((r.a for r in rows[6:]), key=str) == ["2", None]


def test_first_nonempty_list(spark):
    docs = spark.createDataFrame([
        (1, '[{"id":1},{"id":2}]'),
        (2, '{"s":"[1]","e":[],"rows":[{"id":3}],"z":[{"id":9}]}'),
        (3, '{"e":[]}'),
        (4, '"str"'),
        (5, "not json"),
        (6, '{"n":[null],"rows":[{"id":4}]}'),
    ], "k int, j string")
    got = {r.k: r.l for r in docs.select("k", first_nonempty_list("j").alias("l")).collect()}
    assert got[1] == ['{"id":1}', '{"id":2}']
    assert got[2] == ['{"id":3}']
    assert got[3] is None and got[4] is None and got[5] is None
    assert got[6] == ["null"]


def test_reference_rows_inferred_order_independent(spark):
    raw = spark.createDataFrame([("reporter", '{"more":false,"results":[{"id":4,"text":"A"},'
                                              '{"id":8,"text":"B","aggrLevel":0}]}')],
                                "category string, json_data string")
    out = reference_rows(raw, "id int, text string, aggrLevel int", keys=["category"])
    assert sorted(tuple(r) for r in out.collect()) == [("reporter", 4, "A", None),
                                                       ("reporter", 8, "B", 0)]


def test_member_or_empty_and_nested(spark):
    df = spark.createDataFrame([(1, '{"data":[{"a":1}]}'), (2, '{"count":0}'), (3, "{")],
                               "k int, j string")
    rows = member_or_empty(df, "j", "data", "a int", keep=["k"]).collect()
    assert [(r.k, r.elem.a) for r in rows] == [(1, 1)]
    nested = spark.createDataFrame([('[{"p":1,"c":[{"x":1},{"x":2}]},{"p":2,"c":[]}]',)], "j string")
    parsed = nested.select(F.from_json("j", "array<struct<p:int,c:array<struct<x:int>>>>")
                           .alias("arr"))
    rows = explode_nested(parsed, "arr", "c", "p", "c1").select("p.p", "c1.x").collect()
    assert sorted(tuple(r) for r in rows) == [(1, 1), (1, 2)]


def test_to_json_text_round_trip(spark):
    df = spark.createDataFrame([(1, "a", None)], "id int, s string, n double")
    txt = df.select(to_json_text("id", "s", "n").alias("j")).collect()[0].j
    assert json.loads(txt) == {"id": 1, "s": "a"}
    pretty = df.select(to_json_text("id", "s", pretty=True).alias("j")).collect()[0].j
    assert "\n" in pretty and json.loads(pretty) == {"id": 1, "s": "a"}


def test_unnest_time_is_linear_in_the_array(spark):
    import time

    from tradelake.functions.json import unnest_extract_json_text

    def seconds(n):
        items = F.transform(F.sequence(F.lit(1), F.lit(n)),
                            lambda i: F.struct(i.alias("a"), (i / 2).alias("b"), F.lit("x").alias("c")))
        docs = spark.range(1).select(F.to_json(items).alias("j"))
        start = time.perf_counter()
        found = unnest_extract_json_text(docs, "j", ["a", "b", "c"]).agg(
            F.count("*").alias("n"), F.max(F.col("a").cast("int")).alias("top"),
            F.min("c").alias("c")).collect()[0]
        assert tuple(found) == (n, n, '"x"')
        return time.perf_counter() - start
    seconds(100)
    assert seconds(100_000) < 12 * max(seconds(10_000), 0.5)


def test_unnest_of_elements_that_are_no_objects(spark):
    from tradelake.functions.json import unnest_extract_json_text
    docs = spark.createDataFrame([(1, '[1, {"a": 2.50}, null, "s", {"a": null}, {}]'), (2, "{}"),
                                  (3, "[]"), (4, "{oops"), (5, None)], "k int, j string")
    rows = unnest_extract_json_text(docs, "j", ["a"], keep=["k"]).collect()
    assert sorted(((r.k, r.a) for r in rows), key=repr) == sorted(
        [(1, None), (1, "2.5"), (1, None), (1, None), (1, "null"), (1, None)], key=repr)
