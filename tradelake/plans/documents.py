"""Landed response documents derived from tables (J6 in bulk).

The fetch side of the reference produced JSON envelopes from a remote
service; here the same documents are derived from tables with Spark so
every parser runs over whole tables.  Envelopes are *paged*: a document
holds the elements of one ``(keys, page)`` group, where the page comes from
a per-row sequence number, so a hot key becomes many bounded documents,
never one unbounded array in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def page_of(seq_col: str, page_size: int) -> Column:
    """Page number of a row from its sequence number (``seq div size``)."""
    return F.floor(F.col(seq_col) / F.lit(page_size)).cast("bigint")


def envelope_documents(df: DataFrame, keys: Sequence[str], page: Column,
                       elements: Sequence[Column | str], member: str = "data",
                       elapsed_time: str = "0.01s", json_col: str = "json_data",
                       keep_nulls: bool = False) -> DataFrame:
    """One envelope ``{elapsedTime, count, <member>: [...]}`` per
    ``(keys, page)`` group, serialised with ``to_json``."""
    items = F.collect_list(F.struct(*elements)).alias("_items")
    grouped = df.groupBy(*keys, page.alias("page")).agg(items)
    env = F.struct(F.lit(elapsed_time).alias("elapsedTime"),
                   F.size("_items").alias("count"),
                   F.col("_items").alias(member))
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return grouped.select(*keys, "page", F.to_json(env, opts).alias(json_col))


def nested_documents(parents: DataFrame, children: DataFrame, key: str, page: Column,
                     child_seq: str, child_page: int, member: str = "notes",
                     data: str = "data", json_col: str = "json_data") -> DataFrame:
    """Envelopes of parents that carry their children as ``member``.

    ``parents`` has unique ``key``s; ``children`` name their parent by ``key``
    and their place by ``child_seq``.  One row per (page of parents, page of
    children): a document holds the parents of one ``page`` with up to
    ``child_page`` children each, and a parent of more has its further children
    in further documents.  A parent without children has an empty list; children
    without a parent drop out.

    Either table is scanned once: tagged, united and exchanged by (key, page of
    children), which splits a key of many children, then pages are exchanged by
    page of parents, where the parent's own columns reach its further pages in
    a running window that holds one row.
    """
    parent, note = F.struct(*parents.columns), F.struct(*children.columns)
    fields = [c for c in parents.columns if c != key]
    part = page_of(child_seq, child_page)
    tagged = parents.select(
        key, F.lit(0).cast("bigint").alias("_part"), parent.alias("_parent"),
        F.lit(None).cast(children.select(note.alias("n")).schema["n"].dataType).alias("_child"))
    tagged = tagged.unionByName(children.select(
        key, part.alias("_part"),
        F.lit(None).cast(parents.select(parent.alias("p")).schema["p"].dataType).alias("_parent"),
        note.alias("_child")))
    # null children of parents are left out of the list
    pages = tagged.groupBy(key, "_part").agg(
        F.first("_parent", ignorenulls=True).alias("_parent"), F.collect_list("_child").alias(member))
    pages = pages.withColumn("page", page)
    earlier = W.partitionBy("page", key).orderBy("_part")
    whole = (pages.repartition("page")
             .withColumn("_parent", F.first("_parent", ignorenulls=True).over(earlier))
             .filter(F.col("_parent").isNotNull()
                     & ((F.col("_part") == 0) | (F.size(member) > 0))))
    element = F.struct(key, *(F.col(f"_parent.`{c}`").alias(c) for c in fields), member)
    docs = whole.groupBy("page", "_part").agg(F.collect_list(element).alias("_items"))
    env = F.struct(F.lit("0.01s").alias("elapsedTime"), F.size("_items").alias("count"),
                   F.col("_items").alias(data))
    return docs.select(F.col("_part").alias("child_page"), "page", F.to_json(env).alias(json_col))
