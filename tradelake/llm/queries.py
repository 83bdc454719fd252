"""Registered queries of the training-data operators: each applies one
operator to its whole table and derives the digest columns from its output."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.llm import (alignment, chat_format, language_id, piece_codec, quality_rules,
                           sharding, spelling, topk_search, toxicity)
from tradelake.llm.common import read_table
from tradelake.llm.decontaminate import contamination
from tradelake.llm.near_dedup import near_duplicates
from tradelake.llm.substring_dedup import remove_repeats
from tradelake.llm.token_store import checksums, read_store, write_store
from tradelake.session import scratch_path


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), shingle=4, percent=80)


def _fold(modulus: int) -> Column:
    """crc32 of the id as text, modulo: the folds of the labelled tables."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    texts, labels = language_id.sample(docs.filter(_fold(4) != 2), "text", "lang",
                                       F.xxhash64("doc_id"))
    found = language_id.predict(docs.select("doc_id", "text"), language_id.train(texts, labels))
    return found.select("doc_id", F.coalesce(_fold(4) == 2, F.lit(False)).alias("held_out"),
                        "lang_pred", "score")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(read_table(spark, sf_dir, "documents"), window=13)
    return kept.select("doc_id", "n_words", "n_removed",
                       F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


def op4_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations")
    talks = chat_format.conversations_as_rows(turns)
    links = chat_format.following(
        turns.filter("role = 'assistant' and conv_id is not null")
        .select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct())
    formatted = chat_format.format_preferences(chat_format.swapped_replies(talks, links))

    def listed(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["first"], s["last"])), ",")

    return formatted.select(
        "conv_id", "rejected_from", "reason", F.col("n_prompt").cast("bigint").alias("n_prompt"), "prompt",
        "chosen", "rejected", listed("chosen_spans").alias("chosen_spans"),
        listed("rejected_spans").alias("rejected_spans"))


def op5_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    both = piece_codec.decode(piece_codec.encode(docs, model), model)
    return both.select("doc_id", F.size("pieces").cast("bigint").alias("n_pieces"), "pieces",
                       (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return topk_search.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-store")
    write_store(read_table(spark, sf_dir, "documents"), path,
                public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return checksums(read_store(spark, path))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = contamination(read_table(spark, sf_dir, "documents"),
                           read_table(spark, sf_dir, "benchmark"), width=10)
    return judged.select("doc_id", "n_words", "n_hit",
                         F.size("item_ids").cast("bigint").alias("n_items"),
                         F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
                         "contaminated")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").filter(_fold(5) != 0)
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").filter(_fold(4) != 2)
    scored = quality_rules.score(docs, quality_rules.fit(docs, labels))
    return scored.select("doc_id", F.coalesce(_fold(4) == 2, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(read_table(spark, sf_dir, "documents"))
    return spelling.variant_groups(words, ratio=5)


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(read_table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("byte_bpe_50k.json"),
                                     public_tokenizers.path("piece_bpe_32k.model"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_evenly(read_table(spark, sf_dir, "documents"), n_shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         "slot", F.lit(None).cast("int").alias("grown_shard"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_minhash_near_dedup, op2_language_id, op3_substring_dedup, op4_preference_pairs,
    op5_piece_codec, op6_topk_search, op7_token_store, op8_decontamination, op9_toxicity,
    op10_quality_rules, op11_spelling_variants, op12_tokenizer_alignment, op13_sharding, pipeline)}


def _run(width: int) -> str:
    """SQL for the words from a row of ``p`` on, joined by spaces; null where
    the document has fewer than ``width`` left."""
    words = ", ".join(["word", *(f"lead(word, {i}) OVER w" for i in range(1, width))])
    last = "word" if width == 1 else f"lead(word, {width - 1}) OVER w"
    return f"CASE WHEN {last} IS NOT NULL THEN concat_ws(' ', {words}) END"


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"[^\x20\x09-\x0D]+"
_PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(table: str, id_col: str, text: str, pattern: str) -> str:
    return (f"SELECT {id_col}, unnest(l) AS word, generate_subscripts(l, 1) AS pos, len(l) AS n "
            f"FROM (SELECT {id_col}, regexp_extract_all({text}, '{pattern}') AS l FROM {table})")


_NEAR_SQL = f"""
WITH RECURSIVE p AS ({_words("documents", "doc_id", _LOWER.format("text"), _SPACED)}),
runs AS (SELECT doc_id, n, pos, {_run(4)} AS s FROM p WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
short AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS s FROM p WHERE n < 4 GROUP BY doc_id),
sets AS (SELECT DISTINCT doc_id, s FROM runs WHERE s IS NOT NULL UNION SELECT doc_id, s FROM short),
keyed AS (SELECT doc_id, count(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS k
          FROM sets GROUP BY doc_id),
classes AS (SELECT k, min(doc_id) AS rep, any_value(n) AS n FROM keyed GROUP BY k),
own AS (SELECT rep, n, s FROM classes JOIN sets ON doc_id = rep),
links AS (SELECT a.rep AS x, b.rep AS y FROM own a JOIN own b ON a.s = b.s AND a.rep < b.rep
          GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (SELECT rep AS node, rep AS other FROM classes
            UNION SELECT node, y FROM reached JOIN both_ways ON other = x),
lowest AS (SELECT node, min(other) AS c FROM reached GROUP BY node)
SELECT d.doc_id, coalesce(keyed.n, 0) AS n_shingles, coalesce(c, d.doc_id) AS component_id,
       coalesce(c, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN keyed ON keyed.doc_id = d.doc_id
LEFT JOIN classes ON classes.k = keyed.k LEFT JOIN lowest ON node = rep
"""

_REPEATS_SQL = f"""
WITH p AS ({_words("documents", "doc_id", "text", _SPACED)}),
runs AS (SELECT doc_id, pos, word, {_run(13)} AS run
         FROM p WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
firsts AS (SELECT run, min(doc_id) AS first FROM runs WHERE run IS NOT NULL GROUP BY run),
judged AS (SELECT doc_id, pos, word, coalesce(doc_id > first, false) AS again
           FROM runs LEFT JOIN firsts USING (run)),
marked AS (SELECT doc_id, pos, word, max(CASE WHEN again THEN 1 ELSE 0 END) OVER (
             PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone
           FROM judged),
kept AS (SELECT doc_id, count(*) AS n_words, CAST(sum(gone) AS BIGINT) AS n_removed,
                string_agg(word, ' ' ORDER BY pos) FILTER (WHERE gone = 0) AS text
         FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""

_TOP_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding,
                    lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(
                    embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS query_id, b.vec_id,
                  CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
           FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM scored) WHERE rank <= 5
"""

_LEAKS_SQL = f"""
WITH p AS ({_words("documents", "doc_id", _LOWER.format("text"), _PLAIN)}),
b AS ({_words("benchmark", "item_id", _LOWER.format("text"), _PLAIN)}),
long AS (SELECT item_id, {_run(10)} AS run FROM b WHERE n >= 10
         WINDOW w AS (PARTITION BY item_id ORDER BY pos)),
wanted AS (SELECT DISTINCT item_id, 10 AS width, run FROM long WHERE run IS NOT NULL
           UNION ALL SELECT item_id, count(*), string_agg(word, ' ' ORDER BY pos)
                     FROM b WHERE n < 10 GROUP BY item_id),
runs AS ({" UNION ALL ".join(
    f"SELECT doc_id, pos, {k} AS width, {_run(k)} AS run FROM p "
    "WINDOW w AS (PARTITION BY doc_id ORDER BY pos)" for k in range(1, 11))}),
found AS (SELECT doc_id, pos, width, item_id FROM runs JOIN wanted USING (width, run)),
ends AS (SELECT doc_id, pos, max(pos + width) AS stop FROM found GROUP BY doc_id, pos),
covered AS (SELECT p.doc_id, p.pos, max(stop) OVER (PARTITION BY p.doc_id ORDER BY p.pos
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stop
            FROM p LEFT JOIN ends ON ends.doc_id = p.doc_id AND ends.pos = p.pos),
hits AS (SELECT doc_id, count(*) AS n_words, count(CASE WHEN stop > pos THEN 1 END) AS n_hit
         FROM covered GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS names
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM documents d LEFT JOIN hits ON hits.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""

#: crc32 by its table, the fixed misspelling rule, and near words by the strings they
#: give with one letter deleted or masked.
_SPELLING_SQL = f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(
    list_prepend(i, range(8)), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) AS t),
runs AS (SELECT CAST(doc_id AS VARCHAR) AS id, run, count(*) AS times
         FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("text")}, '[a-zÀ-ÿ]+')) AS run
               FROM documents) WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (SELECT run, times, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(
    list_transform(string_split(concat(id, ':', run), ''),
                   lambda c: CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)] ELSE [195, ord(c) - 64] END))),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]))) AS h, id IS NULL AS bare FROM runs, crc),
words AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT CASE WHEN NOT bare AND h % 199 = 0 THEN concat(left(run, h % length(run)),
                substr(run, h % length(run) + 2)) ELSE run END AS word, times FROM hashed)
    WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
cut AS (SELECT word, n, i, concat(left(word, i), substr(word, i + 2)) AS part
        FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (SELECT a.word, b.word AS near, b.n AS m FROM cut a JOIN cut b
           ON a.part = b.part AND a.i = b.i AND a.word <> b.word
         UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.part = b.word
         UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.part = b.word),
best AS (SELECT word, count(*) AS n_near, max(m) AS m, min(near) FILTER (WHERE m = top) AS form
         FROM (SELECT *, max(m) OVER (PARTITION BY word) AS top FROM near) GROUP BY word),
formed AS (SELECT words.word, n, coalesce(n_near, 0) AS n_near,
                  CASE WHEN m >= 5 * n THEN form END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n
           FROM words LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root, 0 AS hops FROM formed
          UNION ALL SELECT chain.word, form, hops + 1 FROM chain JOIN formed ON formed.word = root
                    WHERE form IS NOT NULL),
roots AS (SELECT word, arg_max(root, hops) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
"""

#: The other operators and the pipeline are beyond SQL; see tests/llm.
ORACLES: dict[str, str] = {
    "op1_minhash_near_dedup": _NEAR_SQL, "op3_substring_dedup": _REPEATS_SQL,
    "op6_topk_search": _TOP_SQL, "op8_decontamination": _LEAKS_SQL,
    "op11_spelling_variants": _SPELLING_SQL}
