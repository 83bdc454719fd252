"""Benchmark decontamination with a distributed positional inverted index.

The index stores one posting (row, position, term) for every corpus token
that is a benchmark term, and one header posting per text.  A benchmark
window is looked up from its rarest term: that term's postings, shifted by
its offset in the window, are the candidate starts; they are intersected
with the postings of the next rarest term, and what is left with those of all
other terms at their offsets.  DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradelake.llm.common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Runs that separate words: ASCII without letters and digits.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A term that no text can hold; its posting carries a text's word count.
HEADER = "\x00"
#: Benchmark tables of at most so many rows are broadcast (terms and offsets: some
#: 50 bytes a row); larger ones are joined by key.
BROADCAST_ROWS = 200_000


def words_of(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; the first and last may be ""."""
    ascii_only = F.length(text) == F.octet_length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.split(low, SEPARATORS, -1)


def n_words_of(words: Column) -> Column:
    blank = (F.element_at(words, 1) == "").cast("bigint")
    last = ((F.size(words) > 1) & (F.element_at(words, -1) == "")).cast("bigint")
    return F.size(words).cast("bigint") - blank - last


def small(df: DataFrame) -> DataFrame:
    """``df``, a written table, marked for broadcast if its row count allows it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df.hint("merge")


@dataclass
class Windows:
    """Distinct windows of the test items, as written tables."""

    terms: DataFrame          # term, word
    slots: DataFrame          # win, off, term, n
    items: DataFrame          # win, item_id


def item_windows(items: DataFrame, item_col: str = "item_id", text_col: str = "text",
                 width: int = 10) -> Windows:
    """Windows of ``width`` consecutive words of each item; an item of fewer
    words, but not none, is one window.  Null texts give none; an item without an
    id gives its windows, but no row of ``items``."""
    w = F.filter(words_of(F.col("text")), lambda x: x != "")
    split = (items.select(F.col(item_col).alias("item_id"), F.col(text_col).alias("text"))
             .filter("text is not null")
             .select("item_id", w.alias("words")).filter(F.size("words") > 0))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (width - 1)))
    cut = split.select("item_id", "words", F.explode(starts).alias("at")).select(
        "item_id", F.slice("words", F.col("at"), F.lit(width)).alias("words"))
    wins = written(cut.groupBy("words").agg(F.collect_set("item_id").alias("ids"))
                   .withColumn("win", F.monotonically_increasing_id()), "leak-windows")
    slots = wins.select("win", F.size("words").alias("n"), F.posexplode("words").alias("off", "word"))
    terms = written(slots.select("word").distinct()
                    .withColumn("term", F.monotonically_increasing_id()), "leak-terms")
    slots = written(slots.join(small(terms), "word").select("win", "off", "term", "n"), "leak-slots")
    return Windows(terms, slots, wins.select("win", F.explode("ids").alias("item_id")))


def build_index(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Postings (term, row, pos, doc_id, n_words) of the benchmark terms; each
    row of ``docs`` also has a header posting of term -1 at position 0."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    read = docs.select(F.monotonically_increasing_id().alias("row"),
                       F.col(id_col).alias("doc_id"), words_of(text).alias("words"))
    tokens = read.select("row", "doc_id", n_words_of(F.col("words")).alias("n_words"),
                         F.posexplode(F.concat(F.array(F.lit(HEADER)), "words"))
                         .alias("pos", "word"))
    known = written(terms.select("word", "term").union(
        docs.sparkSession.sql(f"select '{HEADER}', -1L")), "leak-known")
    return written(tokens.join(small(known), "word")
                   .select("term", "row", "pos", "doc_id", "n_words"), "leak-index")


def exact_matches(index: DataFrame, windows: Windows) -> DataFrame:
    """Every occurrence of every window: (row, start, win, n)."""
    postings = index.filter("term >= 0").select("term", "row", "pos")
    counts = postings.groupBy("term").agg(F.count("*").alias("cf"))
    ranked = (windows.slots.join(counts.hint("merge"), "term", "left")
              .withColumn("cf", F.coalesce("cf", F.lit(0)))
              .withColumn("rank", F.row_number().over(W.partitionBy("win").orderBy("cf", "off"))))
    ranked = written(ranked, "leak-ranked")
    # a window whose rarest term is not in the corpus can't occur
    rarest = written(ranked.filter("rank = 1 and cf > 0").select("win", "off", "term", "n"),
                     "leak-rarest")
    candidates = written(
        postings.join(small(rarest), "term")
        .select("row", "win", "n", (F.col("pos") - F.col("off")).alias("start"))
        .filter("start >= 1"), "leak-candidates")
    second, others = (
        written(ranked.filter(r).select("win", "off", "term"), f"leak-{name}")
        for r, name in (("rank = 2", "second"), ("rank > 2", "others")))
    place = (F.col("start") + F.col("off")).alias("pos")
    # first with the next rarest term; what is left, with all others
    asked = (candidates.filter("n > 1").join(small(second), "win")
             .select("row", "win", "start", "n", place, "term"))

    def looked_up(asked: DataFrame, how: str) -> DataFrame:
        """``asked`` with the postings at its places; both calls read one shuffle of them."""
        on = [F.col(f"a.{c}") == F.col(f"p.{c}") for c in ("row", "pos", "term")]
        return (asked.alias("a").join(postings.alias("p").hint("merge"), on, how)
                .select("a.row", "a.win", "a.start", "a.n", F.col("p.term").alias("found")))

    left = looked_up(asked, "inner").drop("found")
    asked = (left.join(small(others), "win", "left")
             .select("row", "win", "start", "n", place, "term"))
    met = (looked_up(asked, "left").groupBy("row", "win", "start", "n")
           .agg(F.count("found").alias("met")).filter("met = n - 2").drop("met"))
    single = candidates.filter("n = 1").select("row", "win", "start", "n")
    return met.union(single)


def proximity_matches(index: DataFrame, windows: Windows, terms: int = 3, span: int = 30
                      ) -> DataFrame:
    """(row, item_id, pos): places of an item's rarest term with all its
    ``terms`` rarest distinct terms (all, if fewer) within ``span`` words."""
    postings = index.filter("term >= 0").select("term", "row", "pos")
    counts = postings.groupBy("term").agg(F.count("*").alias("cf"))
    of_item = (windows.slots.join(windows.items.hint("merge"), "win").select("item_id", "term")
               .distinct().join(counts.hint("merge"), "term", "left").withColumn("cf", F.coalesce("cf", F.lit(0)))
               .withColumn("rank", F.row_number().over(
                   W.partitionBy("item_id").orderBy("cf", "term"))).filter(F.col("rank") <= terms))
    of_item = written(of_item.withColumn("k", F.count("*").over(W.partitionBy("item_id"))),
                      "leak-near")
    first = written(of_item.filter("rank = 1 and cf > 0").select("item_id", "term", "k"),
                    "leak-near-first")
    lead = postings.join(small(first), "term").select("row", "item_id", "pos", "k")
    rest = written(of_item.filter("rank > 1").select("item_id", F.col("term").alias("other")),
                   "leak-near-rest")
    block = (F.col("pos") / span).cast("bigint")
    wanted = (lead.join(small(rest), "item_id")
              .withColumn("block", F.explode(F.array(block - 1, block, block + 1))))
    near = (wanted.join(postings.select(F.col("term").alias("other"), "row",
                                        F.col("pos").alias("at"),
                                        (F.col("pos") / span).cast("bigint").alias("block"))
                        .hint("merge"), ["row", "other", "block"])
            .filter(F.abs(F.col("at") - F.col("pos")) <= span)
            .groupBy("row", "item_id", "pos", "k").agg(F.countDistinct("other").alias("found"))
            .filter("found = k - 1").select("row", "item_id", "pos"))
    return near.union(lead.filter("k = 1").select("row", "item_id", "pos"))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", width: int = 10) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``n_hit`` (words inside any
    occurrence of a window), ``item_ids`` (items with occurring windows, as
    sorted strings) and ``contaminated`` (``n_hit`` > 0).

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased.
    Null and blank texts have none; repeated rows are judged one by one, null
    ids too; repeated items count once; an item without an id hits words but is
    in no list; other columns are ignored.
    """
    windows = item_windows(items, item_col, item_text_col, width)
    index = build_index(docs, windows.terms, id_col, text_col)
    found = written(exact_matches(index, windows), "leak-found")
    before = F.max(F.col("start") + F.col("n")).over(
        W.partitionBy("row").orderBy("start", "n").rowsBetween(W.unboundedPreceding, -1))
    end = F.col("start") + F.col("n")
    hit = (found.select("row", "start", "n").distinct().withColumn("before", before)
           .select("row", F.greatest(F.lit(0), end - F.greatest(
               "start", F.coalesce("before", "start"))).cast("bigint").alias("new"))
           .groupBy("row").agg(F.sum("new").alias("n_hit")))
    ids = (found.select("row", "win").distinct().join(windows.items.hint("merge"), "win")
           .groupBy("row").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string")))
                               .alias("item_ids")))
    head = index.filter("term = -1").select("row", F.col("doc_id").alias(id_col), "n_words")
    return (reduce(lambda x, y: x.join(y.hint("merge"), "row", "left"), (hit, ids), head)
            .select(id_col, "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                    F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))
            .withColumn("contaminated", F.col("n_hit") > 0))
