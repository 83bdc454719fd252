"""Spelling variants: words one edit apart, joined through pivotal grams.

Every word lists its positional bigrams in one order, rarest first.  Its
prefix holds the bigrams up to the third (all places of the third included);
two disjoint ones of least total frequency, found by dynamic programming, are
its pivots.  One edit destroys at most one of two disjoint bigrams, so of two
near words the one whose prefix ends first has a pivot that the other has in
its prefix, at a place moved by no more than the edit moves it.

A surviving pivot has the edit on its left or on its right, so the other side,
counted from its own end of the word, stands in the same place with the same
letters: that is the join's position limit.  A short side is joined with a half
of the other, since one edit leaves one half whole.  Pairs that meet are verified.

All steps after the count of words work on the vocabulary; bigrams over the
given letters are few (at most 90 * 90), which bounds the table of their
frequencies.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import written

LETTERS = r"a-zÀ-ÿ"
#: Every MISSPELT-th run by crc32 loses one letter (the query's fixed rule).
MISSPELT = 199
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Letters that make a pivot's own side of the word a key by themselves.
CONTEXT = 4
#: Longest word that is verified where keys meet; longer ones meet by number.
CARRIED = 64
WORDS_AT_ONCE = 2000
_POSTS = "key bigint, id bigint, word string, size int, last int"


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_length: int = 6, min_count: int = 5) -> DataFrame:
    """(word, n) of letter runs of whole texts, A-Z lower-cased, after the
    fixed misspelling rule; words of at least ``min_length`` letters and
    ``min_count`` occurrences.  Null texts have none; a null id misspells none."""
    run, length = F.col("run"), F.length("run")
    h = F.crc32(F.concat(F.col("id"), F.lit(":"), run).cast("binary"))
    at = (h % length).cast("int")
    runs = docs.select(
        F.col(f"`{id_col}`").cast("string").alias("id"),
        F.explode(F.regexp_extract_all(F.translate(F.col(f"`{text_col}`"), UPPER, LOWER),
                                       F.lit(f"([{LETTERS}]{{{min_length},}})"), 1)).alias("run"))
    word = F.when(h % MISSPELT == 0, F.concat(
        F.substring(run, F.lit(1), at), F.substring(run, at + 2, length))).otherwise(run)
    return (runs.select(word.alias("word")).filter(F.length("word") >= min_length)
            .groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count))


def prefix_and_pivots(word: str, rank: dict[str, int], weight: list[int]
                      ) -> tuple[list[int], tuple[int, int], int]:
    """Places of the prefix bigrams, of the two pivots, and the prefix's last rank."""
    ranks = [rank[word[i:i + 2]] for i in range(len(word) - 1)]
    last = sorted(ranks)[2]
    prefix = [i for i, r in enumerate(ranks) if r <= last]
    best, cheapest, ready = None, None, []
    for i in prefix:                         # cheapest: best single bigram ending before i
        while ready and ready[0] <= i - 2:
            j = ready.pop(0)
            if cheapest is None or weight[ranks[j]] < weight[ranks[cheapest]]:
                cheapest = j
        if cheapest is not None:
            cost = weight[ranks[cheapest]] + weight[ranks[i]]
            if best is None or cost < best[0]:
                best = (cost, (cheapest, i))
        ready.append(i)
    return prefix, best[1], last


def _key(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def posts(word: str, places: set[int]) -> set[int]:
    """Join keys of the bigrams at ``places``: each with all letters before it
    (the edit is on its right), and each with all letters after it.

    Where those are fewer than CONTEXT letters, the key also holds a half of the
    other side, which one edit leaves whole on one of its halves.  The halves
    are those of the shorter of two words: this one, or one of a letter less.
    """
    out, n = set(), len(word)
    ahead, back = xxhash.xxh3_64("<"), xxhash.xxh3_64(">")
    for i in range(n):                       # one pass from either end
        ahead.update(word[i])
        if i - 1 in places and i + 1 >= CONTEXT:
            out.add(ahead.intdigest() - (1 << 63))
    for i in range(n - 1, -1, -1):
        back.update(word[i])
        if i in places and n - i >= CONTEXT:
            out.add(back.intdigest() - (1 << 63))
    for i in places:
        for side, near, other in (("<", word[:i + 2], word[i + 2:]), ("[", word[i:], word[:i])):
            if (i + 2 if side == "<" else n - i) >= CONTEXT:
                continue
            for least in {len(other), max(0, len(other) - 1)}:
                half = least // 2
                out.add(_key(f"{side}{near}|{least}<{other[:half]}"))
                out.add(_key(f"{side}{near}|{least}>{other[len(other) - (least - half):]}"))
    return out


def near_pairs(words: DataFrame) -> DataFrame:
    """Pairs (a, b) of ``id``s, a < b, of words one inserted, deleted or replaced
    letter apart, each once.  ``words`` has (id, word); words need four letters
    or more."""
    gram = F.explode(F.expr("transform(sequence(1, length(word) - 1), i -> substring(word, i, 2))"))
    # at most (letters squared) rows
    counted = words.select(gram.alias("gram")).groupBy("gram").count().collect()
    ordered = sorted((r["count"], r["gram"]) for r in counted)
    rank = {g: i for i, (_, g) in enumerate(ordered)}
    weight = [n for n, _ in ordered]

    def posted(pivot: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32())
            for batch in batches:
                for at in range(0, batch.num_rows, WORDS_AT_ONCE):
                    rows = []
                    part = batch.slice(at, WORDS_AT_ONCE)
                    for name, word in zip(part.column("id").to_pylist(),
                                          part.column("word").to_pylist(), strict=True):
                        prefix, pivots, last = prefix_and_pivots(word, rank, weight)
                        own = word if len(word) <= CARRIED else None
                        rows += [(k, name, own, len(word), last)
                                 for k in posts(word, set(pivots if pivot else prefix))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                        names=["key", "id", "word", "size", "last"])

        return words.select("id", "word").mapInArrow(run, _POSTS)

    a, b = posted(True).alias("a"), posted(False).alias("b")
    met = a.hint("merge").join(
        b, (F.col("a.key") == F.col("b.key")) & (F.col("a.id") != F.col("b.id"))
        & (F.abs(F.col("a.size") - F.col("b.size")) <= 1) & (F.col("a.last") <= F.col("b.last"))
        & F.coalesce(F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1, F.lit(True)))
    pairs = met.select(F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b"),
                       (F.col("a.word").isNotNull() & F.col("b.word").isNotNull()).alias("sure"))
    pairs = written(pairs.distinct(), "spelling-met")
    left, right = (words.select(F.col("id").alias(c), F.col("word").alias(f"{c}_word")).hint("merge")
                   for c in "ab")
    long = (pairs.filter("not sure").join(left, "a").join(right, "b")
            .filter(F.levenshtein("a_word", "b_word", 1) == 1))
    return pairs.filter("sure").select("a", "b").unionByName(long.select("a", "b"))


def variant_groups(words: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of ``words`` (word, n).

    ``form`` is the near word of largest n (ties: the smallest in code-point
    order) if that is at least ``ratio`` times the word's own; ``root`` follows
    forms to the last.  Words without near words have n_near 0; an empty table
    gives an empty one.
    """
    words = written(words.select("word", "n", F.monotonically_increasing_id().alias("id")),
                    "spelling-words")
    pairs = near_pairs(words)
    sides = pairs.select(F.col("a").alias("id"), F.col("b").alias("other")).unionByName(
        pairs.select(F.col("b").alias("id"), F.col("a").alias("other")))
    others = words.select(F.col("id").alias("other"), F.col("word").alias("near"), F.col("n").alias("m"))
    best = sides.join(others.hint("merge"), "other").groupBy("id").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("best"))
    joined = words.join(best.hint("merge"), "id", "left")
    is_form = -F.col("best.m") >= ratio * F.col("n")
    formed = written(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"),
        F.when(is_form, -F.col("best.m")).alias("form_n")), "spelling-forms")

    # a form's n is at least ``ratio`` times its word's, which bounds the chains
    top = words.agg(F.max("n")).first()[0] or 1
    hops = 1 + int(math.log(top, ratio)) if ratio > 1 else top
    links = formed.filter("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(hops)))):        # each round doubles the hops
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = written(links.join(further.hint("merge"), "root", "left")
                        .select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
    return (formed.join(links.hint("merge"), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
