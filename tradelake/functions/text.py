"""Text functions (T1-T3) and the word count aggregate (A2, O1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# FIXED VALUE: a token is a maximal run of lower-case ASCII letters and
# apostrophes after lower-casing ("sailors'", "i've" stay whole).
WORD_SPLIT_PATTERN = "[^a-z']+"


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def tokenize_words(text: Column | str) -> Column:
    """Lower-case then split into tokens; returns array<string> that may
    contain empty strings at the edges (drop them after explode)."""
    return F.split(F.lower(_col(text)), WORD_SPLIT_PATTERN)


def explode_words(df: DataFrame, text_col: str = "value", keep: tuple[str, ...] = (),
                  alias: str = "word") -> DataFrame:
    """T1 as rows: one row per non-empty token."""
    words = df.select(*keep, F.explode(tokenize_words(text_col)).alias(alias))
    return words.filter(F.col(alias) != "")


def word_count(df: DataFrame, text_col: str = "value", sort: bool = True) -> DataFrame:
    """A2 (+O1): ``word string, count bigint`` per token, ascending by word.

    The aggregate is a hash aggregate with map-side partial counts, so a
    very frequent word costs one partial row per task, not one shuffle row
    per occurrence.
    """
    counts = (explode_words(df, text_col)
              .groupBy("word")
              .agg(F.count(F.lit(1)).alias("count")))
    return counts.orderBy("word") if sort else counts


def replace_literal(c: Column | str, old: str, new: str) -> Column:
    """Literal (not regex) replacement in values, e.g. ':' -> '_'."""
    return F.replace(_col(c), F.lit(old), F.lit(new))


def format_key(template: str, *cols: Column | str) -> Column:
    """Printf-style key / file-name templating from columns, e.g.
    ``format_key('reporter_%d_period_%d.json', 'reporterCode', 'period')``."""
    return F.format_string(template, *[_col(c) for c in cols])
