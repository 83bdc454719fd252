"""Preference formatting: shared prompt and paired masked completions."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelake.llm.common import written

#: Template of a turn.
OPEN, BODY, CLOSE = "<|", "|>\n", "<|end|>\n"


def conversations_as_rows(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                          role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turns): turns in order as array<struct<role, text>>.

    Rows without an id are left out; a null role reads "unknown", a null text
    "".  Rows that repeat a turn number follow each other by role and text.
    """
    turn = F.struct(F.col(turn_col).alias("turn"),
                    F.coalesce(F.col(role_col), F.lit("unknown")).alias("role"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return (turns.filter(F.col(id_col).isNotNull())
            .groupBy(F.col(id_col).cast("bigint").alias("conv_id"))
            .agg(F.array_sort(F.collect_list(turn)).alias("turns"))
            .select("conv_id", F.transform("turns", lambda t: F.struct(t["role"], t["text"]))
                    .alias("turns")))


def replies(turns: Column) -> Column:
    """1-based places of the assistant turns."""
    return F.filter(F.sequence(F.lit(1), F.size(turns)),
                    lambda i: F.element_at(turns, i)["role"] == "assistant")


def following(ids: DataFrame) -> DataFrame:
    """(conv_id, rejected_from): every id of ``ids`` (distinct, one bigint column
    ``conv_id``) with the next larger one, the largest with the smallest; a
    lone id has no row.

    Ranges of ids are read in order, each by its own task.  What follows the
    last id of a range is found from the ends of all ranges: two rows each.
    """
    n = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = pa.array([None], pa.int64())               # (null, first id of the range)
        for batch in batches:
            if batch.num_rows:
                own = batch.column("conv_id")
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([last, own.slice(0, len(own) - 1)]), own],
                    names=["conv_id", "rejected_from"])
                last = own.slice(len(own) - 1)
        if last.null_count == 0:                          # (last id of the range, null)
            yield pa.RecordBatch.from_arrays([last, pa.array([None], pa.int64())],
                                             names=["conv_id", "rejected_from"])

    steps = written(ids.repartitionByRange(n, "conv_id").sortWithinPartitions("conv_id")
                    .mapInArrow(run, "conv_id bigint, rejected_from bigint"), "chat-next")
    inside = F.col("conv_id").isNotNull() & F.col("rejected_from").isNotNull()
    ends = steps.filter(~inside).select(F.coalesce("conv_id", "rejected_from").alias("end"),
                                        F.col("conv_id").isNotNull().alias("is_last"))
    ordered = Window.orderBy("end", "is_last")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wrapped = (ends.select("end", "is_last", F.coalesce(
        F.lead("end").over(ordered), F.min("end").over(whole)).alias("rejected_from"))
        .filter("is_last").select(F.col("end").alias("conv_id"), "rejected_from"))
    return steps.filter(inside).unionByName(wrapped).filter("conv_id <> rejected_from")


def swapped_replies(conversations: DataFrame, links: DataFrame) -> DataFrame:
    """One row (conv_id, rejected_from, reason, chosen, rejected) a conversation.

    ``links`` (conv_id, rejected_from) name the conversation that gives the
    rejected side.  The whole conversation is chosen.  The rejected one parts
    from it at one of its replies, number ``crc32(id as text) mod replies``
    from 0: there the other conversation goes on from its reply of that number
    (its last, if it has fewer) to its end.

    ``reason`` is null for a pair.  Otherwise it is "no assistant turn" or "no
    other conversation", and rejected is null, or "equal" if both sides are.
    """
    other = (conversations.join(
        links.select(F.col("conv_id").alias("_to"), F.col("rejected_from").alias("conv_id"))
        .hint("merge"), "conv_id")
        .select(F.col("_to").alias("conv_id"), F.col("conv_id").alias("rejected_from"),
                F.col("turns").alias("others")))
    both = conversations.join(other.hint("merge"), "conv_id", "left").withColumn(
        "own_at", replies(F.col("turns"))).withColumn("other_at", replies(F.col("others")))
    part = F.when(F.size("own_at") > 0, F.pmod(
        F.crc32(F.col("conv_id").cast("string").cast("binary")),
        F.size("own_at").cast("bigint")).cast("int"))
    start = F.get("other_at", F.least(F.col("part"), F.size("other_at") - 1))
    rejected = F.when(F.col("rejected_from").isNotNull(), F.concat(
        F.slice("turns", F.lit(1), F.get("own_at", F.col("part")) - 1),
        F.slice("others", start, F.size("others"))))
    return (both.withColumn("part", part).withColumn("rejected", rejected).select(
        "conv_id", "rejected_from",
        F.when(F.size("own_at") == 0, "no assistant turn")
        .when(F.col("rejected_from").isNull(), "no other conversation")
        .when(F.col("rejected") == F.col("turns"), "equal").alias("reason"),
        F.col("turns").alias("chosen"), "rejected"))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(OPEN), t["role"], F.lit(BODY), t["text"], F.lit(CLOSE))), "")


def _spans(turns: Column, start: Column) -> Column:
    """[from, to) of what assistant turns say, end mark included, in characters
    behind ``start``: the part of a completion that bears loss."""
    step = F.aggregate(
        turns, F.struct(start.cast("int").alias("at"),
                        F.array().cast("array<struct<first:int,last:int>>").alias("spans")),
        lambda s, t: F.struct(
            (s["at"] + F.length(t["role"]) + F.length(t["text"])
             + len(OPEN + BODY + CLOSE)).cast("int").alias("at"),
            F.when(t["role"] == "assistant", F.concat(s["spans"], F.array(F.struct(
                (s["at"] + F.length(t["role"]) + len(OPEN + BODY)).cast("int").alias("first"),
                (s["at"] + F.length(t["role"]) + F.length(t["text"])
                 + len(OPEN + BODY + CLOSE)).cast("int").alias("last")))))
            .otherwise(s["spans"]).alias("spans")))
    return step["spans"]


def format_preferences(pairs: DataFrame, chosen_col: str = "chosen",
                       rejected_col: str = "rejected") -> DataFrame:
    """``pairs`` with their turn arrays replaced by rendered texts: ``n_prompt``
    (turns of the longest common prefix), ``prompt`` (that prefix, once),
    ``chosen`` and ``rejected`` (the turns after it) and ``chosen_spans`` and
    ``rejected_spans``, the characters of prompt + completion that bear loss;
    all others are masked, the whole prompt among them.

    Equal conversations have empty completions, and so has one that is a
    prefix of the other.  A null array counts as one without turns.
    """
    none = F.array().cast("array<struct<role:string,text:string>>")
    others = [F.col(f"`{c}`") for c in pairs.columns
              if c not in (chosen_col, rejected_col, "n_prompt", "prompt", "chosen", "rejected",
                           "chosen_spans", "rejected_spans")]
    a, b = F.col("_a"), F.col("_b")
    short = F.least(F.size(a), F.size(b))
    places = F.when(short > 0, F.sequence(F.lit(1), short)).otherwise(
        F.array().cast("array<int>"))
    differs = F.filter(places, lambda i: ~F.element_at(a, i).eqNullSafe(F.element_at(b, i)))
    n = F.coalesce(F.array_min(differs) - 1, short)

    def rest(x: Column) -> Column:
        return F.slice(x, F.col("n_prompt") + 1, F.size(x))

    cut = pairs.select(*others, F.coalesce(F.col(chosen_col), none).alias("_a"),
                       F.coalesce(F.col(rejected_col), none).alias("_b")).withColumn("n_prompt", n)
    cut = cut.withColumn("prompt", _rendered(F.slice(a, F.lit(1), F.col("n_prompt"))))
    start = F.length("prompt")
    return cut.select(*others, "n_prompt", "prompt", _rendered(rest(a)).alias("chosen"),
                      _rendered(rest(b)).alias("rejected"),
                      _spans(rest(a), start).alias("chosen_spans"),
                      _spans(rest(b), start).alias("rejected_spans"))
