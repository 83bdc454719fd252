"""Registered queries: one per operator key of the survey inventory.

Every query reads the given tables (or documents Spark derives from them)
in whole, so its work grows with the data.  ``ORACLES`` holds the
equivalent DuckDB SQL over the same tables; column names match.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.functions.geo import haversine_miles
from tradelake.functions.json import (explode_array, explode_nested, first_nonempty_list,
                                      flatten_struct, member_or_empty, parse_json_struct,
                                      to_json_text, unnest_extract_json_text)
from tradelake.functions.text import (explode_words, format_key, replace_literal,
                                      word_count)
from tradelake.operators.filters import (count_rows, drop_failed_rows, filter_column_neq,
                                         filter_equals, filter_in_list, filter_nonempty_json,
                                         filter_threshold, limit_rows, repartition_for_fetch,
                                         spread)
from tradelake.operators.flow import (category_outcomes, enrich_batches, route_documents,
                                      split_failures, write_with_empty_policy)
from tradelake.operators.ledger import outstanding, record_outcomes, reject_history
from tradelake.operators.project import (coalesce_requests, drop_parent_duplicates,
                                         project_rename, project_request_params,
                                         sanitize_columns_punct, sanitize_columns_space,
                                         sanitize_name_punct, with_envelope_literals)
from tradelake.plans.documents import envelope_documents, nested_documents, page_of
from tradelake.plans.request_plan import (bilateral_plan, dimension, distinct_pairs,
                                          reporter_year_plan, stage_tables, year_span)
from tradelake.schemas import BILATERAL_YEARS, struct_ddl
from tradelake.session import parallelism, scratch_path
from tradelake.sinks.writers import (read_category, sink_csv_quoted_single, sink_fanout_by_category,
                                     sink_fanout_json, sink_json_per_key,
                                     sink_parquet_overwrite, sink_single_parquet)
from tradelake.sources.containers import (container_index, land_containers,
                                          scan_container_stream, scan_containers)
from tradelake.sources.readers import (json_rows_declared_schema, rows_inferred_schema,
                                       scan_csv_inferred, scan_csv_strings, scan_parquet,
                                       scan_parquet_sql, scan_text_lines)

Query = Callable[[SparkSession, str], DataFrame]

# Page sizes of derived documents (elements per landed document).
ORDER_PAGE = 1000          # orders per document, by o_orderkey
LANDED_PAGE = 10_000       # orders per landed file (one document per file)
LINE_PAGE = 1000           # lines per document of one order, by l_linenumber
CUSTOMER_PAGE = 500        # customers per reference document, by c_custkey
PART_PAGE = 500            # parts per availability document, by p_partkey


# Tables whose rows carry heavy per-row work (tokenising, document building).
_SPREAD_TABLES = {"documents"}


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    return spread(df) if name in _SPREAD_TABLES else df


# --------------------------------------------------------------------------
# sources
# --------------------------------------------------------------------------

def q_scan_parquet(spark, sf):
    df = scan_parquet(spark, f"{sf}/lineitem*.parquet")
    return df.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")


def q_scan_parquet_sql(spark, sf):
    return scan_parquet_sql(
        spark,
        "SELECT o_orderkey, o_custkey, o_orderstatus FROM {orders}",
        orders=f"{sf}/orders.parquet")


def q_scan_csv_strings(spark, sf):
    path = scratch_path(spark, "csv-strings")
    (_t(spark, sf, "orders")
        .select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
        .write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path))
    return scan_csv_strings(spark, path)


def q_scan_csv_inferred(spark, sf):
    path = scratch_path(spark, "csv-inferred")
    (_t(spark, sf, "customer")
        .select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
        .write.option("header", True).csv(path))
    return scan_csv_inferred(spark, path)


def q_scan_text_lines(spark, sf):
    path = scratch_path(spark, "text-lines")
    _t(spark, sf, "documents").select("text").write.text(path)
    return scan_text_lines(spark, path)


def q_rows_declared_schema(spark, sf):
    records = _t(spark, sf, "customer").select(
        to_json_text("c_custkey", "c_name", "c_nationkey", "c_acctbal").alias("rec"))
    schema = ("c_custkey bigint, c_name string, c_nationkey string, c_acctbal double, "
              "c_phone string")
    return json_rows_declared_schema(records, "rec", schema)


def q_rows_inferred_schema(spark, sf):
    records = _t(spark, sf, "customer").select(
        to_json_text("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
        .alias("value"))
    return rows_inferred_schema(spark, records, json_col="value")


_LANDED_NAME = r"^reporter_([^_]+)_period_(\d+)_page_\d+\.json$"
_LANDED_KEYS = {"key_pattern": _LANDED_NAME, "key_names": ["o_orderstatus", "period"],
                "key_types": ["string", "int"]}


def _order_documents(spark, sf) -> DataFrame:
    """Orders as one envelope per (status, year, page), the keys in its name."""
    orders = _t(spark, sf, "orders").withColumn("period", F.year("o_orderdate"))
    docs = envelope_documents(orders, ["o_orderstatus", "period"],
                              page_of("o_orderkey", LANDED_PAGE),
                              ["o_orderkey", "o_custkey", "o_totalprice"])
    return docs.withColumn("name", format_key("reporter_%s_period_%d_page_%d.json",
                                              "o_orderstatus", "period", "page"))


def _orders_landing(spark, sf) -> str:
    """Those documents, landed in containers."""
    path = scratch_path(spark, "landed")
    land_containers(_order_documents(spark, sf), path, F.col("name"))
    return path


_ORDER_DDL = "o_orderkey bigint, o_custkey bigint, o_totalprice double"


def _landed_orders(raw: DataFrame) -> DataFrame:
    rows = member_or_empty(raw, "json_data", "data", _ORDER_DDL, alias="d",
                           keep=["o_orderstatus", "period"])
    return flatten_struct(rows, "d", keep=["o_orderstatus", "period"])


def q_scan_landed_json(spark, sf):
    return _landed_orders(scan_containers(spark, _orders_landing(spark, sf), **_LANDED_KEYS))


def q_landed_json_by_name(spark, sf):
    """Only the documents of finished orders of 1996: their names' beginning
    reaches the scan of the containers."""
    return _landed_orders(scan_containers(spark, _orders_landing(spark, sf),
                                          prefix="reporter_F_period_1996_", **_LANDED_KEYS))


def q_landed_json_index(spark, sf):
    """The offset index: how many documents and bytes every request has landed."""
    index = container_index(spark, _orders_landing(spark, sf))
    key = [F.regexp_extract("doc", _LANDED_NAME, i + 1) for i in range(2)]
    return index.groupBy(key[0].alias("o_orderstatus"), key[1].cast("int").alias("period")).agg(
        F.countDistinct("file", "place").alias("documents"),
        (F.sum("length") > 0).alias("has_bytes"))


def q_scan_landed_json_stream(spark, sf):
    """S8 run incrementally: a Structured Streaming query (availableNow) keeps
    the rows of every document's latest version.  All documents land, then those of open
    orders land again with what became of them, which replaces their rows."""
    from tradelake.streaming.landed import ingest_upserts, latest_rows
    landing, out = scratch_path(spark, "landed"), scratch_path(spark, "landed-upserts")
    ckpt = scratch_path(spark, "landed-stream-ckpt")

    def parse(raw):
        parsed = F.from_json("json_data", f"data array<{struct_ddl(_ORDER_DDL)}>")["data"]
        return raw.withColumn("rows", F.transform(parsed, lambda d: F.struct(
            F.col("o_orderstatus"), F.col("period"), d["o_orderkey"].alias("o_orderkey"),
            d["o_custkey"].alias("o_custkey"), d["o_totalprice"].alias("o_totalprice"))))

    docs = _order_documents(spark, sf)
    revised = envelope_documents(
        _t(spark, sf, "orders").filter("o_orderstatus = 'O' and o_totalprice >= 1000")
        .withColumn("period", F.year("o_orderdate")),
        ["o_orderstatus", "period"], page_of("o_orderkey", LANDED_PAGE),
        ["o_orderkey", "o_custkey", (F.col("o_totalprice") * 2).alias("o_totalprice")])
    open_docs = docs.filter("o_orderstatus = 'O'").select("name", "o_orderstatus", "period", "page")
    revised = open_docs.join(revised.hint("merge"), ["o_orderstatus", "period", "page"], "left")
    revised = revised.withColumn("json_data", F.coalesce("json_data", F.lit('{"count":0,"data":[]}')))
    for batch, when in ((docs, "2024-01-01"), (revised, "2024-01-02")):
        land_containers(batch, landing, F.col("name"), landed_at=F.lit(when).cast("timestamp"))
        query = ingest_upserts(spark, scan_container_stream(spark, landing, **_LANDED_KEYS), parse,
                               out, ckpt, buckets=parallelism(spark))
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))
    return latest_rows(spark, out)


def q_year_dimension(spark, sf):
    return year_span(_t(spark, sf, "orders"), "o_orderdate")


def q_staged_tables(spark, sf):
    commodities = dimension(_t(spark, sf, "part"), "p_partkey", "commodity_id")
    stage_tables(spark, {"tl_commodities": commodities})
    return spark.sql(
        "SELECT c.commodity_id AS cmdCode, CAST(y.year AS INT) AS year "
        "FROM tl_commodities c LATERAL VIEW explode(sequence(2010, 2023)) y AS year")


# --------------------------------------------------------------------------
# sinks
# --------------------------------------------------------------------------

def q_sink_parquet_overwrite(spark, sf):
    path = scratch_path(spark, "parquet-overwrite")
    orders = _t(spark, sf, "orders")
    sink_parquet_overwrite(orders.filter(F.col("o_orderstatus") == "P"), path)
    sink_parquet_overwrite(orders, path)          # replaces the first write
    return spark.read.parquet(path)


def q_sink_single_parquet(spark, sf):
    path = scratch_path(spark, "single-parquet")
    sink_single_parquet(_t(spark, sf, "supplier").select("s_nationkey").distinct(), path)
    return spark.read.parquet(path)


def q_sink_json_per_key(spark, sf):
    path = scratch_path(spark, "json-per-key")
    orders = _t(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", "o_totalprice", "o_orderstatus",
        F.year("o_orderdate").alias("period"))
    sink_json_per_key(orders, path, ["o_orderstatus", "period"])
    return spark.read.json(path)


def q_sink_csv_quoted_single(spark, sf):
    path = scratch_path(spark, "csv-quoted")
    sink_csv_quoted_single(word_count(_t(spark, sf, "documents"), "text"), path)
    return spark.read.csv(path, header=True, inferSchema=True)


def q_sink_fanout_by_category(spark, sf):
    path = scratch_path(spark, "fanout")
    orders = _t(spark, sf, "orders").select(
        F.concat_ws(":", "o_orderstatus", "o_orderpriority").alias("category"),
        "o_custkey", "o_orderkey", "o_totalprice")
    sink_fanout_by_category(orders, path)
    return spark.read.parquet(path)


def q_sink_fanout_json_typed(spark, sf):
    """JSON rows of different kinds to one typed table each; from the customers'
    table, conditions on its typed columns reach the scan."""
    path, staged = scratch_path(spark, "fanout-json"), scratch_path(spark, "fanout-rows")
    customers = _t(spark, sf, "customer").select(
        F.lit("ref:customer").alias("category"), to_json_text(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("text"),
            F.col("c_nationkey").alias("nation code"), F.col("c_acctbal").alias("balance"))
        .alias("value"))
    parts = _t(spark, sf, "part").select(
        F.lit("ref:part").alias("category"), to_json_text(
            F.col("p_partkey").alias("id"), F.col("p_brand").alias("text"),
            (F.col("p_size") % 5).alias("aggrLevel")).alias("value"))
    customers.unionByName(parts).write.parquet(staged)
    sink_fanout_json(spark.read.parquet(staged), path,
                     renamed=lambda names: [sanitize_name_punct(n) for n in names])
    table = read_category(spark, path, "ref:part")
    levels = filter_equals(table, "aggrLevel", 0).select("id", "text")
    people = read_category(spark, path, "ref:customer")
    return levels.join(people.select("id", "nation_code", "balance").hint("merge"), "id")


# --------------------------------------------------------------------------
# projections
# --------------------------------------------------------------------------

def q_project_rename(spark, sf):
    return project_rename(_t(spark, sf, "customer"),
                          {"c_custkey": "reporter_id", "c_name": "reporter_name"})


def q_project_nested(spark, sf):
    events = _t(spark, sf, "events").select(
        "event_id", "event_type", parse_json_struct("props", "k int").alias("p"))
    return flatten_struct(events, "p", ["k"], keep=["event_id", "event_type"])


def _part_availability_docs(spark, sf):
    return envelope_documents(_t(spark, sf, "part"), [], page_of("p_partkey", PART_PAGE),
                              ["p_partkey", "p_name", "p_size"], elapsed_time="0.5s")


def q_with_envelope_literals(spark, sf):
    docs = _part_availability_docs(spark, sf)
    env = parse_json_struct(
        "json_data",
        "elapsedTime string, count int, "
        "data array<struct<p_partkey:bigint,p_name:string,p_size:int>>, error string")
    parsed = docs.select(env.alias("e"))
    rows = parsed.select("e.elapsedTime", "e.count", "e.error",
                         F.explode("e.data").alias("d"))
    flat = rows.select("d.p_partkey", "d.p_name", "d.p_size",
                       "elapsedTime", "count", "error")
    return with_envelope_literals(flat, F.col("elapsedTime"), F.col("count"),
                                  F.col("error"))


def q_sanitize_columns_space(spark, sf):
    spaced = _t(spark, sf, "customer").select(
        F.col("c_custkey").alias(" c custkey "), F.col("c_name").alias("c name"),
        F.col("c_mktsegment").alias("c_mktsegment"))
    return sanitize_columns_space(spaced)


def q_sanitize_columns_punct(spark, sf):
    dotted = _t(spark, sf, "customer").select(
        F.col("c_custkey").alias("c.cust key"), F.col("c_name").alias("c:name"))
    return sanitize_columns_punct(dotted)


def _request_plan(spark, sf, key_type: str | None = None, years=BILATERAL_YEARS,
                  nested: bool = False) -> DataFrame:
    """Every region as reporter and partner, every order status as a flow and
    every part as a commodity, for 2010-2023: the plan grows with the part table.
    ``key_type="string"`` types the ids and years as
    request parameters once per dimension row instead of once per plan row;
    ``nested`` keeps the years of a request in one row."""
    region, part, orders = (_t(spark, sf, n) for n in ("region", "part", "orders"))

    def typed(df, col):
        return df.withColumn(col, F.col(col).cast(key_type)) if key_type else df
    reporters = typed(dimension(region, "r_regionkey", "reporter_id", "r_name",
                                "reporter_name"), "reporter_id")
    partners = typed(dimension(region, "r_regionkey", "partner_id", "r_name", "partner_name"),
                     "partner_id")
    flows = dimension(orders.select("o_orderstatus").distinct(), "o_orderstatus", "flow_id",
                      "o_orderstatus", "flow_name")
    commodities = typed(dimension(part, "p_partkey", "cmdCode"), "cmdCode")
    return bilateral_plan(reporters, partners, flows, commodities, years, nested,
                          key_type or "int")


#: Years of the orders, which trade answers cover.
ORDER_YEARS = (1995, 2002)


def _trade_answers(spark, sf) -> DataFrame:
    """Preview answers as they land: for every (supplier's region, customer's
    region, order status, part, year) with trade, a JSON array of one record per return flag."""
    t = {n: _t(spark, sf, n) for n in ("lineitem", "orders", "customer", "supplier", "nation")}
    regions = t["nation"].select("n_nationkey", "n_regionkey")
    partner = t["customer"].join(regions, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("o_custkey"), F.col("n_regionkey").alias("partner_id"))
    reporter = t["supplier"].join(regions, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("n_regionkey").alias("reporter_id"))
    orders = t["orders"].join(partner.hint("merge"), "o_custkey").select(
        F.col("o_orderkey").alias("l_orderkey"), "partner_id",
        F.col("o_orderstatus").alias("flow_id"), F.year("o_orderdate").alias("year"))
    lines = (t["lineitem"].join(orders.hint("merge"), "l_orderkey")
             .join(reporter.hint("merge"), "l_suppkey"))
    # dealt by the keys that answers are looked up by: both groupings need no other exchange
    heads = ["cmdCode", "flow_id", "partner_id", "reporter_id"]
    lines = lines.select(F.col("l_partkey").alias("cmdCode"), *heads[1:], "year", "l_returnflag",
                         "l_quantity").repartition(*heads)
    traded = lines.groupBy(*heads, "year", "l_returnflag").agg(
        F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("qty"))
    record = F.struct(F.lit("C").alias("typeCode"), F.col("year").alias("refYear"),
                      F.col("l_returnflag").alias("flowCode"), F.col("n").alias("tradeValue"),
                      F.col("qty").alias("altQty"), F.lit(None).cast("string").alias("qtyUnitCode"))
    return traded.groupBy(*heads, "year").agg(
        F.to_json(F.array_sort(F.collect_list(record)), {"ignoreNullFields": "false"})
        .alias("json_data"))


def q_preview_by_query(spark, sf):
    """Lines between regions, landed as preview answers per (supplier's region,
    customer's region, year, page of orders), asked by a query string."""
    from tradelake.plans.jobs import run_preview_query
    t = {n: _t(spark, sf, n) for n in ("lineitem", "orders", "customer", "supplier", "nation")}
    regions = t["nation"].select("n_nationkey", "n_regionkey")
    partner = t["customer"].join(regions, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("o_custkey"), F.col("n_regionkey").alias("partner"))
    reporter = t["supplier"].join(regions, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("n_regionkey").alias("reporter"))
    lines = (t["lineitem"].join(t["orders"].select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", F.year("o_orderdate").alias("period"))
        .hint("merge"), "l_orderkey").join(partner.hint("merge"), "o_custkey")
        .join(reporter.hint("merge"), "l_suppkey"))
    docs = envelope_documents(
        lines, ["reporter", "partner", "period"], page_of("l_orderkey", LANDED_PAGE),
        [F.col("l_partkey").alias("cmd code"), F.col("l_quantity").alias("qty"),
         F.col("l_returnflag").alias("flag"), F.col("l_orderkey").alias("order")])
    landing, out = scratch_path(spark, "previews"), scratch_path(spark, "preview-table")
    land_containers(docs, landing, format_key(
        "preview_M_A_HS_TOTAL_%d_%d_%d_%d.json", "reporter", "partner", "period", "page"))
    run_preview_query(spark, landing, out, "0,1", "2, 3,4", 1996, 1998)
    return spark.read.parquet(out)


def _asked(landed: DataFrame):
    """A service that answers a request if its document has landed; requests
    come with their years in one row."""
    from tradelake.operators.ledger import nested_heads
    from tradelake.plans.fetch import PREVIEW_KEYS
    heads = nested_heads(PREVIEW_KEYS, "year")

    def answer(requests):
        asked = requests.withColumnRenamed("year", "_years").join(landed.hint("merge"), heads)
        return asked.filter(F.array_contains("_years", F.col("year"))).select(*PREVIEW_KEYS, "json_data")
    return answer


def q_project_request_params(spark, sf):
    # request parameters are strings: type the plan's ids as strings up front
    return project_request_params(_request_plan(spark, sf, key_type="string"))


def _nested_order_docs(spark, sf):
    """Envelopes of orders, each carrying its lines as ``notes``; lines
    repeat the parent key (dropped again by P7)."""
    orders = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    lines = _t(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity", "l_returnflag")
    return nested_documents(orders, lines, "o_orderkey", page_of("o_orderkey", ORDER_PAGE),
                            "l_linenumber", LINE_PAGE)


_NESTED_DDL = ("data array<struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,"
               "notes:array<struct<o_orderkey:bigint,l_linenumber:int,l_quantity:double,"
               "l_returnflag:string>>>>")


def q_drop_parent_duplicates(spark, sf):
    docs = _nested_order_docs(spark, sf)
    parsed = docs.select(parse_json_struct("json_data", _NESTED_DDL).alias("e"))
    rows = explode_nested(parsed, "e.data", "notes", "p", "n")
    return drop_parent_duplicates(rows, "p", "n",
                                  ["o_orderkey", "o_custkey", "o_orderstatus"],
                                  ["o_orderkey", "l_linenumber", "l_quantity", "l_returnflag"])


# --------------------------------------------------------------------------
# filters, limits, partitioning, counts
# --------------------------------------------------------------------------

def _availability(spark, sf):
    orders = _t(spark, sf, "orders")
    return (orders.groupBy(F.col("o_custkey").alias("reporterCode"),
                           F.year("o_orderdate").alias("period"))
            .agg(F.count(F.lit(1)).alias("totalRecords")))


def q_filter_threshold(spark, sf):
    return filter_threshold(_availability(spark, sf), "totalRecords", 2)


def q_count_rows(spark, sf):
    return count_rows(filter_threshold(_availability(spark, sf), "totalRecords", 2))


def q_filter_in_list(spark, sf):
    return filter_in_list(_t(spark, sf, "part"), "p_size", [1, 2, 3]).select(
        "p_partkey", "p_name", "p_size")


def q_filter_equals(spark, sf):
    return filter_equals(_t(spark, sf, "orders"), "o_orderstatus", "F").select(
        "o_orderkey", "o_custkey")


def q_filter_column_neq(spark, sf):
    return filter_column_neq(_t(spark, sf, "lineitem"), "l_partkey", "l_suppkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _line_array_docs(spark, sf, only=None):
    """Per (order, line page): JSON array of its lines, of those that ``only``
    accepts where it is given; a page without one answers ``[]``."""
    lines = _t(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_returnflag", "l_quantity",
        F.when(F.col("l_quantity") > 40, F.lit("big")).alias("l_note"))
    items = F.collect_list(F.struct("l_linenumber", "l_returnflag", "l_quantity", "l_note"))
    grouped = lines.groupBy("o_orderkey", page_of("l_linenumber", LINE_PAGE).alias("page")).agg(
        items.alias("items"))
    items = F.filter("items", only) if only else F.col("items")
    return grouped.select("o_orderkey", "page", F.to_json(
        items, {"ignoreNullFields": "false"}).alias("json_data"))


def q_filter_nonempty_json(spark, sf):
    return filter_nonempty_json(
        _line_array_docs(spark, sf, lambda line: line["l_quantity"] > 25)).select(
        "o_orderkey", "page")


def _customer_profiles(batch: pa.RecordBatch) -> pa.Array:
    """JSON profiles of a batch of customers; refuses a batch with a debtor in it."""
    if pc.any(pc.less(batch.column("c_acctbal"), 0.0)).as_py():
        raise ValueError("account overdrawn")
    band = pc.cast(pc.floor(pc.divide(batch.column("c_acctbal"), 1000.0)), pa.int64())
    return pc.binary_join_element_wise(
        '{"id": ', pc.cast(batch.column("c_custkey"), pa.string()), ', "name": "',
        batch.column("c_name"), '", "band": ', pc.cast(band, pa.string()), "}", "")


def _customer_enrich(spark, sf, whole: bool = True):
    customers = _t(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    if not whole:
        customers = customers.withColumn("c_acctbal", F.abs("c_acctbal"))
    return enrich_batches(customers, _customer_profiles, ["c_custkey", "c_name", "c_acctbal"],
                          partitions=parallelism(spark))


def q_drop_failed_rows(spark, sf):
    enriched = _customer_enrich(spark, sf)
    return drop_failed_rows(enriched).select("c_custkey", "json_data")


def q_limit_rows(spark, sf):
    return limit_rows(_t(spark, sf, "orders").select("o_orderkey", "o_custkey"), 200,
                      ["o_orderkey"])


def q_repartition_for_fetch(spark, sf):
    return repartition_for_fetch(_t(spark, sf, "customer").select("c_custkey", "c_name"),
                                 parallelism(spark))


# --------------------------------------------------------------------------
# request plans
# --------------------------------------------------------------------------

def q_cross_join_reporter_year(spark, sf):
    reporters = dimension(_t(spark, sf, "customer"), "c_custkey", "reporter_id",
                          "c_name", "reporter_name")
    return reporter_year_plan(reporters)


def q_cross_join_request_plan(spark, sf):
    return _request_plan(spark, sf)


def q_distinct_pairs(spark, sf):
    return distinct_pairs(_t(spark, sf, "lineitem"), ["l_suppkey", "l_returnflag"])


# --------------------------------------------------------------------------
# text and geo
# --------------------------------------------------------------------------

def q_word_count(spark, sf):
    return word_count(_t(spark, sf, "documents"), "text", sort=False)


def q_sort_words(spark, sf):
    return word_count(_t(spark, sf, "documents"), "text", sort=True)


def q_tokenize_words(spark, sf):
    words = explode_words(_t(spark, sf, "documents"), "text", keep=("doc_id",))
    return words.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_tokens"))


def q_string_replace_names(spark, sf):
    return _t(spark, sf, "pages").select("page_id",
                                         replace_literal("url", ":", "_").alias("category"))


def q_format_key_string(spark, sf):
    return _t(spark, sf, "orders").select(
        "o_orderkey",
        format_key("reporter_%d_period_%d.json", "o_custkey",
                   F.year("o_orderdate")).alias("file_name"))


def q_haversine_distance(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        haversine_miles(F.lit(40.0) + F.col("l_discount"),
                        F.lit(-74.0) + F.col("l_tax"),
                        F.lit(40.0) + F.col("l_quantity") / F.lit(1000.0),
                        F.lit(-74.0) + F.col("l_extendedprice") / F.lit(1000000.0))
        .alias("distance"))


# --------------------------------------------------------------------------
# JSON
# --------------------------------------------------------------------------

def q_json_parse_struct(spark, sf):
    return q_project_nested(spark, sf).select("event_id", "k")


def _line_envelopes(spark, sf):
    li = _t(spark, sf, "lineitem")
    return envelope_documents(li, ["l_orderkey"], page_of("l_linenumber", LINE_PAGE),
                              ["l_linenumber", "l_partkey", "l_quantity"])


def q_explode_array(spark, sf):
    docs = _line_envelopes(spark, sf)
    parsed = docs.select("l_orderkey", parse_json_struct(
        "json_data",
        "count int, data array<struct<l_linenumber:int,l_partkey:bigint,l_quantity:double>>"
    ).alias("e"))
    rows = explode_array(parsed, "e.data", "d", keep=["l_orderkey"])
    return flatten_struct(rows, "d", ["l_linenumber", "l_partkey", "l_quantity"],
                          keep=["l_orderkey"])


def q_json_parse_nested(spark, sf):
    docs = _nested_order_docs(spark, sf)
    parsed = docs.select(parse_json_struct("json_data", _NESTED_DDL).alias("e"))
    parents = explode_array(parsed, "e.data", "p")
    # an order of several line pages is in as many documents
    return parents.groupBy(F.col("p.o_orderkey").alias("o_orderkey")).agg(
        F.sum(F.size("p.notes")).cast("int").alias("n_lines"))


def q_explode_nested(spark, sf):
    docs = _nested_order_docs(spark, sf)
    parsed = docs.select(parse_json_struct("json_data", _NESTED_DDL).alias("e"))
    rows = explode_nested(parsed, "e.data", "notes", "p", "n")
    return rows.select(F.col("p.o_orderkey").alias("o_orderkey"),
                       F.col("n.l_linenumber").alias("l_linenumber"),
                       F.col("n.l_quantity").alias("l_quantity"))


def q_json_array_unnest_extract(spark, sf):
    docs = filter_nonempty_json(_line_array_docs(spark, sf))
    return unnest_extract_json_text(docs, "json_data",
                                    ["l_linenumber", "l_returnflag", "l_quantity", "l_note",
                                     "l_comment"],
                                    keep=["o_orderkey"])


def q_json_serialize(spark, sf):
    return _t(spark, sf, "orders").select(
        "o_orderkey",
        to_json_text("o_orderkey", "o_orderstatus", "o_orderpriority").alias("json_text"))


def _reference_docs(spark, sf):
    """Reference documents: a decoy string that looks like a list, a decoy
    empty list, then the rows, then another list."""
    customers = _t(spark, sf, "customer")
    page = page_of("c_custkey", CUSTOMER_PAGE)
    grouped = customers.groupBy(page.alias("page")).agg(
        F.collect_list(F.struct("c_custkey", "c_name", "c_nationkey")).alias("results"))
    doc = F.struct(F.lit("[not a list]").alias("note"),
                   F.array().cast("array<int>").alias("empty"),
                   F.col("results"),
                   F.array(F.lit(1), F.lit(2)).alias("other"))
    return grouped.select("page", F.to_json(doc).alias("json_data"))


def q_json_first_list(spark, sf):
    docs = _reference_docs(spark, sf)
    elems = docs.select(F.explode(first_nonempty_list("json_data")).alias("e"))
    return elems.select(F.from_json("e", "c_custkey bigint, c_name string, c_nationkey int")
                        .alias("r")).select("r.*")


def q_json_member_or_empty(spark, sf):
    orders = _t(spark, sf, "orders")
    # documents of pending orders were answered without a data member
    docs = envelope_documents(orders, ["o_orderstatus"], page_of("o_orderkey", ORDER_PAGE),
                              ["o_orderkey", "o_custkey"])
    docs = docs.withColumn(
        "json_data",
        F.when(F.col("o_orderstatus") == "P", F.lit('{"count":0,"error":"pending"}'))
        .otherwise(F.col("json_data")))
    rows = member_or_empty(docs, "json_data", "data", "o_orderkey bigint, o_custkey bigint",
                           alias="d")
    return flatten_struct(rows, "d")


# --------------------------------------------------------------------------
# dataflow control
# --------------------------------------------------------------------------

def q_partition_enrich(spark, sf):
    ok, _ = split_failures(_customer_enrich(spark, sf, whole=False))
    return ok.select("c_custkey", "c_name", "json_data")


def q_isolate_row_failures(spark, sf):
    ok, _ = split_failures(_customer_enrich(spark, sf))
    return ok.select("c_custkey", "c_name", "json_data")


def q_isolate_table_failures(spark, sf):
    orders = _t(spark, sf, "orders")
    docs = envelope_documents(orders, ["o_orderstatus", "o_orderpriority"],
                              page_of("o_orderkey", ORDER_PAGE), ["o_orderkey"],
                              member="results")
    # urgent answers arrived wrapped in an HTML error page (not JSON)
    docs = docs.withColumn(
        "json_data",
        F.when(F.col("o_orderpriority") == "1-URGENT",
               F.concat(F.lit("<html><body>"), F.col("json_data"), F.lit("</body></html>")))
        .otherwise(F.col("json_data")))
    routed = route_documents(docs.withColumnRenamed("o_orderstatus", "category"))
    return category_outcomes(routed)


def q_empty_input_policy(spark, sf):
    path = scratch_path(spark, "empty-policy")
    orders = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    write_with_empty_policy(orders, path, "fail")
    # an empty answer must not wipe the dataset
    write_with_empty_policy(orders.filter(F.col("o_orderstatus") == "none"), path, "skip")
    return spark.read.parquet(path).select("o_orderkey", "o_custkey")


def q_ingest_csv_to_parquet(spark, sf):
    from tradelake.plans.ingest import ingest_csv_to_parquet
    src = scratch_path(spark, "ingest-csv")
    dst = scratch_path(spark, "ingest-parquet")
    (_t(spark, sf, "customer")
        .select(F.col("c_custkey").alias(" c custkey "), F.col("c_name").alias("c name"),
                F.col("c_mktsegment").alias("c_mktsegment"))
        .write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(src))
    ingest_csv_to_parquet(spark, src, dst)
    return spark.read.parquet(dst)


def _resumed(spark, sf) -> tuple[DataFrame, DataFrame]:
    from tradelake.plans.fetch import resumable_extract
    plan = _request_plan(spark, sf, years=ORDER_YEARS, nested=True)
    return resumable_extract(plan, _asked(_trade_answers(spark, sf)),
                             scratch_path(spark, "requests"), "run-1",
                             ["typeCode", "refYear", "flowCode", "tradeValue", "altQty",
                              "qtyUnitCode", "partnerISO"], nested="year")


def q_plan_fetch_extract(spark, sf):
    """The bilateral plan asked through a request ledger: rows of all answers."""
    return _resumed(spark, sf)[0]


def q_plan_fetch_missing(spark, sf):
    """The same flow's requests that are still without an answer."""
    return _resumed(spark, sf)[1]


def q_coalesced_requests(spark, sf):
    """What the plan still misses, as few requests: ranges of years, lists of
    up to three reporters."""
    from tradelake.plans.fetch import PREVIEW_KEYS
    plan = _request_plan(spark, sf, years=ORDER_YEARS, nested=True).select(*PREVIEW_KEYS)
    missing = outstanding(plan, _trade_answers(spark, sf), PREVIEW_KEYS, nested="year")
    lists = coalesce_requests(missing, 3)
    return lists.withColumn("reporters", F.concat_ws(",", F.transform(
        "reporters", lambda r: r.cast("string"))))


def q_reject_ledger(spark, sf):
    """Three runs over the customers' accounts: run k takes the customers whose
    id leaves k or less modulo 3, the second run with the lines of credit
    that clear debts up to 500, the third with those up to 900."""
    path = scratch_path(spark, "reject-ledger")
    customers = _t(spark, sf, "customer")
    for run, credit in enumerate((0, 500, 900)):
        seen = customers.filter(F.col("c_custkey") % 3 <= run)
        balance = F.col("c_acctbal") + credit
        record_outcomes(seen.select("c_custkey", (balance >= 0).alias("ok"),
                                    F.when(balance < 0, F.lit("overdrawn")).alias("reason")),
                        path, ["c_custkey"], f"run-{run}")
    return reject_history(spark, path, ["c_custkey"], "c_custkey bigint")


def _reporter_share(batch: pa.RecordBatch) -> pa.Array:
    """JSON answers to a batch of reporters: their id and name."""
    return pc.binary_join_element_wise(
        '{"reporter": ', pc.cast(batch.column("reporter_id"), pa.string()), ', "name": "',
        batch.column("reporter_name"), '"}', "")


def q_world_share_by_reporter(spark, sf):
    from tradelake.plans.fetch import fetch_per_reporter
    reporters = dimension(_t(spark, sf, "customer"), "c_custkey", "reporter_id",
                          "c_name", "reporter_name")
    answers, _ = fetch_per_reporter(reporter_year_plan(reporters), batch_fetch=_reporter_share)
    return answers


# --------------------------------------------------------------------------
# response kinds (the original jobs' typed tables)
# --------------------------------------------------------------------------

def _world_share_raw(spark, sf):
    """World-share answers: one request per (typeCode, freqCode), paged."""
    o = _t(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("typeCode"),
        F.col("o_orderpriority").alias("freqCode"),
        "o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice", "o_orderstatus",
        F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"),
        F.dayofyear("o_orderdate").alias("day"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"))
    elements = [F.lit("X").alias("typeCode"), F.lit("Y").alias("freqCode"),
                (F.col("y") * 100 + F.col("m")).alias("period"), F.col("y").alias("year"),
                F.col("m").alias("month"), F.col("o_orderpriority").alias("datasetDesc"),
                F.col("day").alias("reporterCode"),
                F.col("o_totalprice").alias("worldShare"),
                (F.col("o_orderstatus") == "F").alias("isAvailable"),
                F.col("y").alias("dataCount"),
                F.col("d").alias("firstReleased")]
    return envelope_documents(o, ["typeCode", "freqCode"], page_of("o_orderkey", ORDER_PAGE),
                              elements)


def q_world_share_table(spark, sf):
    from tradelake.plans.responses import world_share_table
    return world_share_table(_world_share_raw(spark, sf))


def q_publication_notes_table(spark, sf):
    from tradelake.plans.responses import notes_table
    parents = _t(spark, sf, "orders").select(
        "o_orderkey", F.dayofyear("o_orderdate").alias("reporterCode"),
        F.year("o_orderdate").alias("period"), F.col("o_orderstatus").alias("typeCode"),
        F.col("o_orderpriority").alias("freqCode"), F.col("o_orderkey").alias("datasetCode"))
    notes = _t(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber",
        F.col("l_orderkey").alias("datasetCode"), F.lit("N").alias("typeCode"),
        F.lit(-1).alias("period"), F.col("l_returnflag").alias("currency"),
        F.col("l_linestatus").alias("tradeSystem"),
        F.col("l_linenumber").cast("string").alias("publicationNote"))
    docs = nested_documents(parents, notes, "o_orderkey", page_of("o_orderkey", ORDER_PAGE),
                            "l_linenumber", LINE_PAGE)
    raw = docs.select(F.lit("HS").alias("clCode"), "json_data")
    return notes_table(raw)


def _availability_raw(spark, sf):
    part = _t(spark, sf, "part")
    elements = [F.col("p_partkey").alias("datasetCode"), F.lit("C").alias("typeCode"),
                F.lit("A").alias("freqCode"), (F.lit(2000) + F.col("p_size")).alias("period"),
                F.col("p_size").alias("reporterCode"),
                F.col("p_brand").alias("reporterISO"), F.col("p_name").alias("reporterDesc"),
                F.lit("HS").alias("classificationCode"),
                (F.col("p_size") > 25).alias("isOriginalClassification"),
                (F.col("p_size") * 1000).alias("totalRecords"),
                F.col("p_type").alias("firstReleased"),
                F.col("p_size").alias("lengthCmdCode")]
    return envelope_documents(part, [], page_of("p_partkey", PART_PAGE), elements,
                              elapsed_time="0.5s")


def q_availability_table(spark, sf):
    from tradelake.plans.responses import availability_table
    from tradelake.schemas import AVAILABILITY_SCHEMA
    return availability_table(_availability_raw(spark, sf), AVAILABILITY_SCHEMA)


def q_tariffline_availability_table(spark, sf):
    from tradelake.plans.responses import availability_table
    from tradelake.schemas import TARIFFLINE_AVAILABILITY_SCHEMA
    return availability_table(_availability_raw(spark, sf), TARIFFLINE_AVAILABILITY_SCHEMA)


QUERIES: dict[str, Query] = {
    "scan_parquet": q_scan_parquet,
    "scan_parquet_sql": q_scan_parquet_sql,
    "scan_csv_strings": q_scan_csv_strings,
    "scan_csv_inferred": q_scan_csv_inferred,
    "scan_text_lines": q_scan_text_lines,
    "rows_declared_schema": q_rows_declared_schema,
    "rows_inferred_schema": q_rows_inferred_schema,
    "scan_landed_json": q_scan_landed_json,
    "scan_landed_json_stream": q_scan_landed_json_stream,
    "landed_json_by_name": q_landed_json_by_name,
    "landed_json_index": q_landed_json_index,
    "year_dimension": q_year_dimension,
    "staged_tables": q_staged_tables,
    "sink_parquet_overwrite": q_sink_parquet_overwrite,
    "sink_single_parquet": q_sink_single_parquet,
    "sink_json_per_key": q_sink_json_per_key,
    "sink_csv_quoted_single": q_sink_csv_quoted_single,
    "sink_fanout_by_category": q_sink_fanout_by_category,
    "sink_fanout_json_typed": q_sink_fanout_json_typed,
    "project_rename": q_project_rename,
    "project_nested": q_project_nested,
    "with_envelope_literals": q_with_envelope_literals,
    "sanitize_columns_space": q_sanitize_columns_space,
    "sanitize_columns_punct": q_sanitize_columns_punct,
    "project_request_params": q_project_request_params,
    "drop_parent_duplicates": q_drop_parent_duplicates,
    "filter_threshold": q_filter_threshold,
    "filter_in_list": q_filter_in_list,
    "filter_equals": q_filter_equals,
    "filter_column_neq": q_filter_column_neq,
    "filter_nonempty_json": q_filter_nonempty_json,
    "drop_failed_rows": q_drop_failed_rows,
    "limit_rows": q_limit_rows,
    "repartition_for_fetch": q_repartition_for_fetch,
    "cross_join_reporter_year": q_cross_join_reporter_year,
    "cross_join_request_plan": q_cross_join_request_plan,
    "distinct_pairs": q_distinct_pairs,
    "word_count": q_word_count,
    "count_rows": q_count_rows,
    "sort_words": q_sort_words,
    "json_parse_struct": q_json_parse_struct,
    "json_parse_nested": q_json_parse_nested,
    "explode_array": q_explode_array,
    "explode_nested": q_explode_nested,
    "json_array_unnest_extract": q_json_array_unnest_extract,
    "json_serialize": q_json_serialize,
    "json_first_list": q_json_first_list,
    "json_member_or_empty": q_json_member_or_empty,
    "tokenize_words": q_tokenize_words,
    "string_replace_names": q_string_replace_names,
    "format_key_string": q_format_key_string,
    "haversine_distance": q_haversine_distance,
    "partition_enrich": q_partition_enrich,
    "isolate_row_failures": q_isolate_row_failures,
    "isolate_table_failures": q_isolate_table_failures,
    "empty_input_policy": q_empty_input_policy,
    "ingest_csv_to_parquet": q_ingest_csv_to_parquet,
    "plan_fetch_extract": q_plan_fetch_extract,
    "plan_fetch_missing": q_plan_fetch_missing,
    "coalesced_requests": q_coalesced_requests,
    "reject_ledger": q_reject_ledger,
    "preview_by_query": q_preview_by_query,
    "world_share_table": q_world_share_table,
    "world_share_by_reporter": q_world_share_by_reporter,
    "publication_notes_table": q_publication_notes_table,
    "availability_table": q_availability_table,
    "tariffline_availability_table": q_tariffline_availability_table,
}


# --------------------------------------------------------------------------
# DuckDB oracles
# --------------------------------------------------------------------------

def _plan_sql(years) -> str:
    return f"""
SELECT r.r_regionkey AS reporter_id, r.r_name AS reporter_name,
       p.r_regionkey AS partner_id, p.r_name AS partner_name,
       f.o_orderstatus AS flow_id, f.o_orderstatus AS flow_name,
       c.p_partkey AS cmdCode, CAST(y.range AS INTEGER) AS year
FROM region r
CROSS JOIN region p
CROSS JOIN (SELECT DISTINCT o_orderstatus FROM orders) f
CROSS JOIN part c
CROSS JOIN range({years[0]}, {years[1]}) y
WHERE r.r_regionkey != p.r_regionkey
"""


_PLAN_SQL = _plan_sql(BILATERAL_YEARS)

_TRADE_SQL = f"""
plan AS ({_plan_sql(ORDER_YEARS)}),
trade AS (SELECT s.n_regionkey AS reporter_id, c.n_regionkey AS partner_id,
                 o_orderstatus AS flow_id, l_partkey AS cmdCode, year(o_orderdate) AS year,
                 l_returnflag AS flag, count(*) AS n, sum(CAST(l_quantity AS BIGINT)) AS qty
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey
          JOIN customer ON c_custkey = o_custkey JOIN nation c ON c.n_nationkey = c_nationkey
          JOIN supplier ON s_suppkey = l_suppkey JOIN nation s ON s.n_nationkey = s_nationkey
          GROUP BY ALL)
"""

_MISSING_SQL = f"""
WITH {_TRADE_SQL}
SELECT reporter_id, partner_id, flow_id, cmdCode, year FROM plan
ANTI JOIN trade USING (reporter_id, partner_id, flow_id, cmdCode, year)
"""

_AVAIL_SQL = """
SELECT o_custkey AS reporterCode, CAST(year(o_orderdate) AS INTEGER) AS period,
       count(*) AS totalRecords
FROM orders GROUP BY 1, 2 HAVING count(*) <= 2
"""

_WORDS_SQL = """
SELECT word, count(*) AS count
FROM (SELECT unnest(string_split_regex(lower(text), '[^a-z'']+')) AS word FROM documents)
WHERE word <> ''
GROUP BY word
"""

_HAVERSINE_SQL = """
SELECT l_orderkey, l_linenumber,
  round(2 * 3958.8 * asin(sqrt(
      pow(sin(radians(lat2 - lat1) / 2), 2)
    + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2))), 2)
  AS distance
FROM (SELECT l_orderkey, l_linenumber,
             40.0::DOUBLE + l_discount AS lat1, -74.0::DOUBLE + l_tax AS lon1,
             40.0::DOUBLE + l_quantity / 1000.0::DOUBLE AS lat2,
             -74.0::DOUBLE + l_extendedprice / 1000000.0::DOUBLE AS lon2
      FROM lineitem)
"""

_PROFILE_SQL = ("'{{\"id\": ' || c_custkey || ', \"name\": \"' || c_name || '\", \"band\": ' || "
                "CAST(floor({} / 1000) AS BIGINT) || '}}'")

ORACLES: dict[str, str] = {
    "scan_parquet": "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag "
                    "FROM lineitem",
    "scan_parquet_sql": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
    "scan_csv_strings": "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, "
                        "CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, "
                        "o_orderpriority FROM orders",
    "scan_csv_inferred": "SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_nationkey, "
                         "c_acctbal, c_mktsegment FROM customer",
    "scan_text_lines": "SELECT unnest(string_split(text, chr(10))) AS value FROM documents",
    "rows_declared_schema": "SELECT c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS "
                            "c_nationkey, c_acctbal, CAST(NULL AS VARCHAR) AS c_phone "
                            "FROM customer",
    "rows_inferred_schema": "SELECT c_acctbal, c_custkey, c_mktsegment, c_name, "
                            "CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer",
    "scan_landed_json": "SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS period, "
                        "o_orderkey, o_custkey, o_totalprice FROM orders",
    "year_dimension": "SELECT CAST(unnest(range(min(year(o_orderdate)), "
                      "max(year(o_orderdate)) + 1)) AS INTEGER) AS year FROM orders",
    "staged_tables": "SELECT p_partkey AS cmdCode, CAST(y.range AS INTEGER) AS year "
                     "FROM part CROSS JOIN range(2010, 2024) y",
    "sink_parquet_overwrite": "SELECT * FROM orders",
    "sink_single_parquet": "SELECT DISTINCT s_nationkey FROM supplier",
    "sink_json_per_key": "SELECT o_orderkey, o_orderpriority, o_totalprice, o_orderstatus, "
                         "CAST(year(o_orderdate) AS INTEGER) AS period FROM orders",
    "sink_csv_quoted_single": _WORDS_SQL,
    "sink_fanout_by_category": "SELECT replace(o_orderstatus || ':' || o_orderpriority, ':', "
                               "'_') AS category, o_custkey, o_orderkey, o_totalprice "
                               "FROM orders",
    "project_rename": "SELECT c_custkey AS reporter_id, c_name AS reporter_name FROM customer",
    "project_nested": "SELECT event_id, event_type, "
                      "CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
    "with_envelope_literals": "SELECT p_partkey, p_name, p_size, '0.5s' AS elapsedTime, "
                              "CAST(count(*) OVER (PARTITION BY p_partkey // 500) AS INTEGER) "
                              "AS count, CAST(NULL AS VARCHAR) AS error FROM part",
    "sanitize_columns_space": "SELECT c_custkey AS _c_custkey_, c_name AS c_name, "
                              "c_mktsegment FROM customer",
    "sanitize_columns_punct": "SELECT c_custkey AS c_cust_key, c_name AS c_name FROM customer",
    "project_request_params": "SELECT 'C' AS typeCode, 'A' AS freqCode, 'HS' AS clCode, "
                              "CAST(year AS VARCHAR) AS period, "
                              "CAST(reporter_id AS VARCHAR) AS reporterCode, "
                              "CAST(cmdCode AS VARCHAR) AS cmdCode, "
                              "CAST(flow_id AS VARCHAR) AS flowCode, "
                              "CAST(partner_id AS VARCHAR) AS partnerCode, "
                              "CAST(NULL AS VARCHAR) AS partner2Code, "
                              "CAST(NULL AS VARCHAR) AS customsCode, "
                              "CAST(NULL AS VARCHAR) AS motCode "
                              f"FROM ({_PLAN_SQL})",
    "drop_parent_duplicates": "SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, "
                              "l.l_linenumber, l.l_quantity, l.l_returnflag "
                              "FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey",
    "filter_threshold": _AVAIL_SQL,
    "filter_in_list": "SELECT p_partkey, p_name, p_size FROM part WHERE p_size IN (1, 2, 3)",
    "filter_equals": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'",
    "filter_column_neq": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey "
                         "FROM lineitem WHERE l_partkey != l_suppkey",
    "filter_nonempty_json": "SELECT DISTINCT l_orderkey AS o_orderkey, "
                            "CAST(l_linenumber // 1000 AS BIGINT) AS page "
                            "FROM lineitem WHERE l_quantity > 25",
    "drop_failed_rows": f"SELECT c_custkey, {_PROFILE_SQL.format('c_acctbal')} AS json_data "
                        "FROM customer WHERE c_acctbal >= 0",
    "limit_rows": "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 200",
    "repartition_for_fetch": "SELECT c_custkey, c_name FROM customer",
    "cross_join_reporter_year": "SELECT c_custkey AS reporter_id, c_name AS reporter_name, "
                                "CAST(y.range AS INTEGER) AS year "
                                "FROM customer CROSS JOIN range(1962, 2025) y",
    "cross_join_request_plan": _PLAN_SQL,
    "distinct_pairs": "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem",
    "word_count": _WORDS_SQL,
    "count_rows": f"SELECT count(*) AS n FROM ({_AVAIL_SQL})",
    "sort_words": _WORDS_SQL + " ORDER BY word",
    "json_parse_struct": "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k "
                         "FROM events",
    "json_parse_nested": "SELECT o.o_orderkey, CAST(count(l.l_orderkey) AS INTEGER) AS n_lines "
                         "FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey "
                         "GROUP BY o.o_orderkey",
    "explode_array": "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem",
    "explode_nested": "SELECT l_orderkey AS o_orderkey, l_linenumber, l_quantity FROM lineitem",
    "json_array_unnest_extract": "SELECT l_orderkey AS o_orderkey, "
                                 "CAST(l_linenumber AS VARCHAR) AS l_linenumber, "
                                 "CAST(l_quantity AS VARCHAR) AS l_quantity, "
                                 "'\"' || l_returnflag || '\"' AS l_returnflag, "
                                 "CASE WHEN l_quantity > 40 THEN '\"big\"' ELSE 'null' END "
                                 "AS l_note, CAST(NULL AS VARCHAR) AS l_comment "
                                 "FROM lineitem",
    "json_serialize": "SELECT o_orderkey, '{\"o_orderkey\":' || o_orderkey || "
                      "',\"o_orderstatus\":\"' || o_orderstatus || "
                      "'\",\"o_orderpriority\":\"' || o_orderpriority || '\"}' AS json_text "
                      "FROM orders",
    "json_first_list": "SELECT c_custkey, c_name, c_nationkey FROM customer",
    "json_member_or_empty": "SELECT o_orderkey, o_custkey FROM orders "
                            "WHERE o_orderstatus <> 'P'",
    "tokenize_words": "SELECT doc_id, count(*) AS n_tokens FROM (SELECT doc_id, "
                      "unnest(string_split_regex(lower(text), '[^a-z'']+')) AS word "
                      "FROM documents) WHERE word <> '' GROUP BY doc_id",
    "string_replace_names": "SELECT page_id, replace(url, ':', '_') AS category FROM pages",
    "format_key_string": "SELECT o_orderkey, 'reporter_' || o_custkey || '_period_' || "
                         "year(o_orderdate) || '.json' AS file_name FROM orders",
    "haversine_distance": _HAVERSINE_SQL,
    "partition_enrich": "SELECT c_custkey, c_name, "
                        f"{_PROFILE_SQL.format('abs(c_acctbal)')} AS json_data FROM customer",
    "isolate_row_failures": "SELECT c_custkey, c_name, "
                            f"{_PROFILE_SQL.format('c_acctbal')} AS json_data FROM customer "
                            "WHERE c_acctbal >= 0",
    "isolate_table_failures": "SELECT o_orderstatus AS category, "
                              "count(DISTINCT CASE WHEN o_orderpriority <> '1-URGENT' THEN "
                              "o_orderpriority || '/' || (o_orderkey // 1000) END) AS ok_docs, "
                              "count(DISTINCT CASE WHEN o_orderpriority = '1-URGENT' THEN "
                              "o_orderpriority || '/' || (o_orderkey // 1000) END) "
                              "AS rejected_docs, "
                              "count(*) FILTER (WHERE o_orderpriority <> '1-URGENT') AS ok_rows "
                              "FROM orders GROUP BY o_orderstatus",
    "empty_input_policy": "SELECT o_orderkey, o_custkey FROM orders",
    "ingest_csv_to_parquet": "SELECT CAST(c_custkey AS VARCHAR) AS _c_custkey_, "
                             "c_name AS c_name, c_mktsegment FROM customer",
    "plan_fetch_extract": f"WITH {_TRADE_SQL} SELECT reporter_id, partner_id, flow_id, cmdCode, "
                          "year, '\"C\"' AS typeCode, CAST(year AS VARCHAR) AS refYear, "
                          "'\"' || flag || '\"' AS flowCode, CAST(n AS VARCHAR) AS tradeValue, "
                          "CAST(qty AS VARCHAR) AS altQty, 'null' AS qtyUnitCode, "
                          "CAST(NULL AS VARCHAR) AS partnerISO FROM plan "
                          "JOIN trade USING (reporter_id, partner_id, flow_id, cmdCode, year)",
    "plan_fetch_missing": _MISSING_SQL,
    "coalesced_requests": f"""
WITH missing AS ({_MISSING_SQL}),
runs AS (SELECT *, year - row_number() OVER (
             PARTITION BY reporter_id, partner_id, flow_id, cmdCode ORDER BY year) AS run
         FROM missing),
ranges AS (SELECT reporter_id, partner_id, flow_id, cmdCode, min(year) AS from_year,
                  max(year) AS to_year
           FROM runs GROUP BY reporter_id, partner_id, flow_id, cmdCode, run),
packed AS (SELECT *, (row_number() OVER (PARTITION BY partner_id, flow_id, cmdCode, from_year,
                                         to_year ORDER BY reporter_id) - 1) // 3 AS list
           FROM ranges)
SELECT partner_id, flow_id, cmdCode, from_year, to_year,
       string_agg(CAST(reporter_id AS VARCHAR), ',' ORDER BY reporter_id) AS reporters,
       CAST(count(*) * (to_year - from_year + 1) AS BIGINT) AS n_requests
FROM packed GROUP BY partner_id, flow_id, cmdCode, from_year, to_year, list
""",
    "reject_ledger": """
WITH runs AS (SELECT c_custkey, 'run-' || run AS run, c_acctbal + credit >= 0 AS ok
              FROM customer JOIN (VALUES (0, 0), (1, 500), (2, 900)) r(run, credit)
                ON c_custkey % 3 <= run),
failed AS (SELECT c_custkey, count(*) AS attempts, min(run) AS first_run, max(run) AS last_run
           FROM runs WHERE NOT ok GROUP BY c_custkey)
SELECT failed.*, 'overdrawn' AS reason,
       (SELECT CASE WHEN arg_max(ok, run) THEN max(run) END FROM runs
        WHERE runs.c_custkey = failed.c_custkey) AS resolved_in
FROM failed
""",
    "sink_fanout_json_typed": "SELECT p_partkey AS id, p_brand AS text, "
                              "CAST(c_nationkey AS BIGINT) AS nation_code, c_acctbal AS balance "
                              "FROM part JOIN customer ON c_custkey = p_partkey "
                              "WHERE p_size % 5 = 0",
    "preview_by_query": """
SELECT l_partkey AS cmd_code, l_quantity AS qty, l_returnflag AS flag, l_orderkey AS "order"
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON c_custkey = o_custkey JOIN nation c ON c.n_nationkey = c_nationkey
JOIN supplier ON s_suppkey = l_suppkey JOIN nation s ON s.n_nationkey = s_nationkey
WHERE s.n_regionkey IN (0, 1) AND c.n_regionkey IN (2, 3, 4)
  AND year(o_orderdate) BETWEEN 1996 AND 1998
""",
    "landed_json_by_name": "SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS period, "
                           "o_orderkey, o_custkey, o_totalprice FROM orders "
                           "WHERE o_orderstatus = 'F' AND year(o_orderdate) = 1996",
    "landed_json_index": "SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS period, "
                         "count(DISTINCT o_orderkey // 10000) AS documents, true AS has_bytes "
                         "FROM orders GROUP BY ALL",
}

_NULL_TEXT_NOTE_FIELDS = ["reporterDescription", "importConvFactor", "exportConvFactor",
                          "classificationCode", "importValuation", "exportValuation",
                          "importPartnerCountry", "exportPartnerCountry",
                          "importPartner2Country", "exportPartner2Country",
                          "publicationDate", "publicationDateShort"]

_AVAIL_FLAGS_NULL = ", ".join(f"CAST(NULL AS BOOLEAN) AS {f}" for f in [
    "isExtendedFlowCode", "isExtendedPartnerCode", "isExtendedPartner2Code",
    "isExtendedCmdCode", "isExtendedCustomsCode", "isExtendedMotCode"])

_AVAIL_COMMON = ("p_partkey AS datasetCode, 'C' AS typeCode, 'A' AS freqCode, "
                 "CAST(2000 + p_size AS INTEGER) AS period, "
                 "p_size AS reporterCode, p_brand AS reporterISO, "
                 "'HS' AS classificationCode, p_size > 25 AS isOriginalClassification, "
                 f"{_AVAIL_FLAGS_NULL}, CAST(p_size * 1000 AS INTEGER) AS totalRecords, "
                 "CAST(NULL AS BIGINT) AS datasetChecksum, p_type AS firstReleased, "
                 "CAST(NULL AS VARCHAR) AS lastReleased, '0.5s' AS elapsedTime, "
                 "CAST(count(*) OVER (PARTITION BY p_partkey // 500) AS INTEGER) AS count, "
                 "CAST(NULL AS VARCHAR) AS error")

ORACLES["scan_landed_json_stream"] = (
    "SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS period, o_orderkey, o_custkey, "
    "CASE WHEN o_orderstatus = 'O' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice "
    "FROM orders WHERE o_orderstatus <> 'O' OR o_totalprice >= 1000")

ORACLES.update({
    "world_share_by_reporter":
        "SELECT c_custkey AS reporter_id, c_name AS reporter_name, "
        "'{\"reporter\": ' || c_custkey || ', \"name\": \"' || c_name || '\"}' AS json_data "
        "FROM customer",
    "world_share_table":
        "SELECT o_orderstatus AS typeCode, o_orderpriority AS freqCode, "
        "CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS period, "
        "CAST(year(o_orderdate) AS INTEGER) AS year, "
        "CAST(month(o_orderdate) AS INTEGER) AS month, o_orderpriority AS datasetDesc, "
        "CAST(dayofyear(o_orderdate) AS INTEGER) AS reporterCode, CAST(NULL AS VARCHAR) AS reporterISO, "
        "CAST(NULL AS VARCHAR) AS reporterDesc, o_totalprice AS worldShare, "
        "o_orderstatus = 'F' AS isAvailable, CAST(year(o_orderdate) AS INTEGER) AS dataCount, "
        "strftime(o_orderdate, '%Y-%m-%d') AS firstReleased, "
        "CAST(NULL AS VARCHAR) AS lastReleased, CAST(NULL AS VARCHAR) AS created, "
        "CAST(NULL AS VARCHAR) AS updated FROM orders",
    "publication_notes_table":
        "SELECT o.o_orderstatus AS typeCode, o.o_orderpriority AS freqCode, "
        "'HS' AS clCode, CAST(dayofyear(o.o_orderdate) AS INTEGER) AS reporterCode, "
        "CAST(year(o.o_orderdate) AS INTEGER) AS period, o.o_orderkey AS datasetCode, "
        + ", ".join(f"CAST(NULL AS VARCHAR) AS {f}" for f in _NULL_TEXT_NOTE_FIELDS[:1]) + ", "
        "l.l_returnflag AS currency, "
        + ", ".join(f"CAST(NULL AS VARCHAR) AS {f}" for f in _NULL_TEXT_NOTE_FIELDS[1:3]) + ", "
        "l.l_linestatus AS tradeSystem, "
        + ", ".join(f"CAST(NULL AS VARCHAR) AS {f}" for f in _NULL_TEXT_NOTE_FIELDS[3:10]) + ", "
        "CAST(l.l_linenumber AS VARCHAR) AS publicationNote, "
        + ", ".join(f"CAST(NULL AS VARCHAR) AS {f}" for f in _NULL_TEXT_NOTE_FIELDS[10:]) +
        " FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey",
    "availability_table":
        f"SELECT {_AVAIL_COMMON}, p_name AS reporterDesc, "
        "CAST(NULL AS VARCHAR) AS classificationSearchCode FROM part",
    "tariffline_availability_table":
        f"SELECT {_AVAIL_COMMON}, CAST(p_size AS INTEGER) AS lengthCmdCode FROM part",
})
