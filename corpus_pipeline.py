"""Corpus pipeline: five stages, each calling one operator of ``tradelake.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next stage's ``docs``.  All but the last keep
the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.llm import (decontaminate, near_dedup, piece_codec, quality_rules,
                           substring_dedup)
from tradelake.llm.common import read_table, released, written

#: A text whose quality score is below this is rejected.
MIN_QUALITY = 0.7
#: Bits of a row's number within its file.
ROW_BITS = 40
#: Words of a benchmark passage that a text must not have in a row.
LEAK_WORDS = 10


def row_keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number for every row, the same whenever it is read, and
    that column's name.

    Rows of stored files are numbered by file and place in it; the table of files
    has a row per input file.  Other rows are written first.
    """
    row = "_row"
    while row in docs.columns:
        row += "_"
    try:
        meta = docs.metadataColumn("_metadata")
        placed = docs.withColumns({f"{row}_file": meta["file_path"], f"{row}_at": meta["row_index"]})
    except AnalysisException:
        return written(docs.withColumn(row, F.monotonically_increasing_id()), "pipeline-docs"), row
    files = sorted(r[0] for r in placed.select(f"{row}_file").distinct().collect())
    numbers = docs.sparkSession.createDataFrame(
        list(enumerate(files)), f"{row}_n bigint, {row}_file string")
    number = (F.shiftleft(F.col(f"{row}_n"), ROW_BITS) + F.col(f"{row}_at")).alias(row)
    return (placed.join(F.broadcast(numbers), f"{row}_file")
            .select(*(F.col(f"`{c}`") for c in docs.columns), number)), row


def apart(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns``, and all others in ``_rest``, so that an operator's results meet
    no column of the same name."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in columns]
    return docs.select(*(F.col(f"`{c}`") for c in columns), F.struct(*others).alias("_rest"))


def together(docs: DataFrame, *columns: str, **changed: Column) -> list[Column]:
    """The columns of ``docs`` from a table made by ``apart``; some ``changed``."""
    return [changed.get(c, F.col(f"`{c}`") if c in columns else F.col(f"_rest.`{c}`")).alias(c)
            for c in docs.columns]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the rule ensemble, fitted on all ``labels``, scores at
    MIN_QUALITY or more.  It learns from the texts of ``documents``.  Null and
    empty texts are scored by their statistics, which are zeros."""
    with released(spark):
        model = quality_rules.fit(read_table(spark, sf_dir, "documents"),
                                  read_table(spark, sf_dir, "labels"))
    scored = quality_rules.score(apart(docs, "text"), model)
    return scored.filter(F.col("score") >= MIN_QUALITY).select(*together(docs, "text"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: five-word shingles, similarity 0.8 or
    more.  Rows are compared one by one, also those that repeat a doc_id or
    have none; the smallest doc_id stays, a null one only if all are null."""
    keyed, row = row_keyed(docs)
    with released(spark) as keep:
        found = near_dedup.near_duplicates(keyed, id_col=row, shingle=5, percent=80)
        least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id",
                               F.col(row).alias("row")))
        first = keep(written(
            found.join(keyed.select(row, "doc_id").hint("merge"), row).groupBy("component_id")
            .agg(least.alias("first")).select(F.col("first.row").alias(row)), "pipeline-first"))
    return keyed.join(first.hint("merge"), row, "left_semi").select(
        *(F.col(f"`{c}`") for c in docs.columns))


def repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that an earlier text has are cut out; a text
    with a cut has its other words joined by one space, others stay as they
    are.  Texts of which nothing is left go.  ``n_chars`` follows the text."""
    kept = substring_dedup.remove_repeats(apart(docs, "doc_id", "text"), window=50)
    cut = F.col("n_removed") > 0
    text = F.when(cut, F.col("kept_text")).otherwise(F.col("text"))
    n_chars = F.when(cut, F.length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(
        F.col("_rest.n_chars"))
    return kept.filter(~cut | (F.col("n_removed") < F.col("n_words"))).select(
        *together(docs, "doc_id", "text", text=text, n_chars=n_chars))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a word inside an occurrence of a window of ten benchmark
    words.  Rows with a null doc_id are judged like others.  Benchmark items of
    fewer words have no such window and remove nothing here: a text that says
    three words of a test has not seen it."""
    keyed, row = row_keyed(docs)
    words = decontaminate.n_words_of(decontaminate.words_of(F.col("text")))
    items = read_table(spark, sf_dir, "benchmark").filter(words >= LEAK_WORDS)
    with released(spark) as keep:
        judged = decontaminate.contamination(keyed, items, id_col=row, width=LEAK_WORDS)
        gone = keep(written(judged.filter("contaminated").select(row), "pipeline-gone"))
    return keyed.join(gone.hint("merge"), row, "left_anti").select(
        *(F.col(f"`{c}`") for c in docs.columns))


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and the SentencePiece ids of the whole text; null and
    empty texts have no ids."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return piece_codec.encode(docs.select("doc_id", "lang", "source", "text"), model).select(
        "doc_id", "lang", "source", F.size("pieces").cast("bigint").alias("n_pieces"), "pieces")


STAGES = [("quality classifier", quality), ("near-duplicates", near_duplicates),
          ("substring dedup", repeated_substrings), ("decontamination", decontaminated),
          ("sentencepiece", piece_ids)]

#: The classifier and the segmentation are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
