"""A key holding a large share of all rows must not become one task's or
one document's problem."""

import glob

from pyspark.sql import functions as F

from tradelake.plans.documents import envelope_documents, page_of
from tradelake.sinks.writers import sink_json_per_key


def _hot(spark, n_hot=6000, n_cold=40):
    hot = spark.range(n_hot).select(F.lit("hot").alias("k"), F.col("id").alias("seq"))
    cold = spark.range(n_cold).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("k"),
                                      F.col("id").alias("seq"))
    # incompressible payload so shuffle sizes reflect row counts
    return hot.unionByName(cold).withColumn(
        "payload", F.concat(*[F.sha2(F.concat(F.col("seq").cast("string"), F.lit(str(i))), 256)
                              for i in range(3)]))


def test_hot_key_documents_are_bounded(spark):
    df = _hot(spark)
    docs = envelope_documents(df, ["k"], page_of("seq", 500), ["seq", "payload"])
    sizes = docs.select("k", F.get_json_object("json_data", "$.count").cast("int").alias("n"))
    hot_sizes = [r.n for r in sizes.filter("k = 'hot'").collect()]
    assert len(hot_sizes) == 12 and max(hot_sizes) == 500
    assert sizes.agg(F.sum("n")).collect()[0][0] == 6040


def test_hot_key_is_split_over_files(spark, tmp_path):
    df = _hot(spark, n_hot=20000)
    keys = ["k"]
    prev = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        out = str(tmp_path / "per_key")
        sink_json_per_key(df.repartition(8), out, keys)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", prev)
    hot_files = glob.glob(f"{out}/k=hot/part-*")
    assert len(hot_files) > 1
    assert spark.read.json(out).count() == 20040


def test_hot_order_nested_documents_are_paged(spark, tmp_path):
    from tradelake.plans import registry as R
    sf = str(tmp_path)
    spark.createDataFrame([(1, 10, "F", 1.0, "5-LOW"), (2, 11, "O", 2.0, "1-URGENT")],
                          "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
                          "o_totalprice double, o_orderpriority string") \
        .withColumn("o_orderdate", F.lit("1996-01-02").cast("timestamp_ntz")) \
        .write.parquet(f"{sf}/orders.parquet")
    lines = spark.range(1, 2501).select(F.lit(1).cast("bigint").alias("l_orderkey"),
                                        F.col("id").cast("int").alias("l_linenumber"))
    lines = lines.unionByName(spark.createDataFrame([(2, 1)], "l_orderkey bigint, l_linenumber int"))
    (lines.withColumn("l_quantity", F.lit(1.0)).withColumn("l_returnflag", F.lit("N"))
          .write.parquet(f"{sf}/lineitem.parquet"))
    docs = R._nested_order_docs(spark, sf)
    per_doc = docs.select(F.expr(
        "aggregate(from_json(json_data, 'data array<struct<notes:array<string>>>').data, 0, "
        "(acc, p) -> acc + size(p.notes))").alias("n")).collect()
    assert max(r.n for r in per_doc) <= 1000 and len(per_doc) >= 3
    assert R.q_explode_nested(spark, sf).count() == 2501


def test_hot_order_is_one_row_of_its_line_count(spark, tmp_path):
    from tradelake.plans import registry as R
    sf = str(tmp_path)
    spark.createDataFrame([(1, 10, "F"), (2, 11, "O"), (3, 12, "O")],
                          "o_orderkey bigint, o_custkey bigint, o_orderstatus string") \
        .write.parquet(f"{sf}/orders.parquet")
    lines = spark.range(1, 2501).select(F.lit(1).cast("bigint").alias("l_orderkey"),
                                        F.col("id").cast("int").alias("l_linenumber"))
    lines = lines.unionByName(spark.createDataFrame([(2, 1)], "l_orderkey bigint, l_linenumber int"))
    (lines.withColumn("l_quantity", F.lit(1.0)).withColumn("l_returnflag", F.lit("N"))
          .write.parquet(f"{sf}/lineitem.parquet"))
    got = R.q_json_parse_nested(spark, sf)
    assert got.schema["n_lines"].dataType.simpleString() == "int"
    assert sorted(tuple(r) for r in got.collect()) == [(1, 2500), (2, 1), (3, 0)]


def test_nested_documents_scan_once_and_exchange_twice(spark):
    from tradelake.plans import registry as R
    plan = R._nested_order_docs(spark, "/root/testdata/sf0.001")._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert text.count("FileScan parquet") == 2 and text.count("Exchange ") <= 2
    assert text.count("lineitem.parquet") == 1


def test_nested_documents_of_orphans_gaps_and_no_children(spark):
    from tradelake.plans.documents import nested_documents
    parents = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k bigint, v string")
    lines = [(1, 2500), (1, 3), (9, 1), (9, 4000), (3, 1)]
    children = spark.createDataFrame(lines, "k bigint, seq int")
    docs = nested_documents(parents, children, "k", page_of("k", 2), "seq", 1000)
    rows = docs.select(F.explode(F.from_json(
        "json_data", "data array<struct<k:bigint,v:string,notes:array<struct<seq:int>>>>")["data"])
        .alias("d"), "child_page").collect()
    got = sorted((r.child_page, r.d.k, r.d.v, [n.seq for n in r.d.notes]) for r in rows)
    assert got == [(0, 1, "a", [3]), (0, 2, "b", []), (0, 3, None, [1]), (2, 1, "a", [2500])]
