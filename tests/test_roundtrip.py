from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradelake.functions.json import explode_array, flatten_struct, parse_json_struct
from tradelake.plans.documents import envelope_documents, page_of

rows_strategy = st.lists(
    st.tuples(st.integers(0, 5), st.integers(0, 50),
              st.one_of(st.none(), st.text(max_size=8)),
              st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False))),
    max_size=40, unique_by=lambda r: (r[0], r[1]))


@settings(max_examples=15, deadline=None)
@given(rows_strategy)
def test_table_envelope_parse_explode_round_trip(spark, rows):
    df = spark.createDataFrame(rows, "k int, seq int, s string, x double")
    docs = envelope_documents(df, ["k"], page_of("seq", 7), ["seq", "s", "x"],
                              keep_nulls=True)
    parsed = docs.select("k", parse_json_struct(
        "json_data", "count int, data array<struct<seq:int,s:string,x:double>>").alias("e"))
    back = flatten_struct(explode_array(parsed, "e.data", "d", keep=["k"]), "d",
                          keep=["k"])
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(rows, key=repr)
    counts = parsed.select(F.col("e.count")).collect()
    assert sum(r[0] for r in counts) == len(rows)
