"""Operators against brute force in the cases that need it most: hot keys, null
ids, special tokens, pruning, linear scans, and the pipeline stage by stage."""

import glob
import re
import sys
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tradelake.llm import (chat_format, decontaminate, language_id, piece_codec,
                           quality_rules, substring_dedup, token_store, topk_search, toxicity)

SF = "/root/testdata/sf0.001"
A = public_tokenizers.path("byte_bpe_50k.json")


# --- substring dedup -----------------------------------------------------------------

def plain_repeats(rows, window):
    texts = [(float("inf") if i is None else i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, w in texts:
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            least[key] = min(least.get(key, i), i)
    out = []
    for (i, t), (n, w) in zip(rows, texts, strict=True):
        gone = set()
        for k in range(len(w) - window + 1):
            if least[tuple(w[k:k + window])] < n:
                gone |= set(range(k, k + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone).decode()
        out.append((i, len(w), len(gone), kept))
    return sorted(out, key=repr)


@pytest.mark.parametrize("group", [500, 10_000_000])
def test_substring_dedup_matches_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(substring_dedup, "GROUP_BYTES", group)
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", group // 2)
    monkeypatch.setattr(substring_dedup, "SPARE_BITS", 0)        # leading bits do collide
    rng = np.random.default_rng(4)
    words = [f"w{k}" for k in range(12)]
    shared = " ".join(rng.choice(words, 9))
    rows = [(int(i) if i < 40 else None, " ".join(rng.choice(words, rng.integers(0, 25)))
             + (f" {shared}" if i % 3 else "")) for i in rng.integers(0, 60, 150)]
    rows += [(7, None), (8, ""), (None, shared), (None, shared), (3, shared), (3, shared)]
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in rows],
                                  "doc_id bigint, text string, n_words int, `a b` string")
    kept = substring_dedup.remove_repeats(frame.repartition(5), window=4)
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in kept.collect()), key=repr)
    assert got == plain_repeats(rows, 4)
    assert kept.columns == ["doc_id", "text", "a b", "n_words", "n_removed", "kept_text"]


def test_texts_of_substring_dedup_are_shuffled_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = substring_dedup.remove_repeats(docs)
    kept.collect()
    final = kept._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1 and final.count("ReusedExchange") == 2


# --- token store -----------------------------------------------------------------------

SPECIAL = [(1, "<|endoftext|>"), (2, "a <|endoftext|> b"), (3, "x<|endoftext|><|endoftext|>y z"),
           (4, "< |endoftext| >"), (None, "null one"), (None, None), (6, ""), (5, "plain words here")]


def test_token_store_equals_the_plain_call(spark, scratch):
    from tokenizers import Tokenizer

    out = scratch("tokens")
    frame = spark.createDataFrame(SPECIAL, "doc_id bigint, text string").withColumn("ids", F.lit("x"))
    token_store.write_store(frame, out, A)
    got = {(r.doc_id, r.n_tokens, r.ids_crc32) for r in token_store.checksums(
        token_store.read_store(spark, out)).collect()}
    tok = Tokenizer.from_file(A)
    expected = set()
    for i, t in SPECIAL:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        expected.add((i, len(ids), zlib.crc32(ids.tobytes())))
    assert got == expected
    assert 50256 in [x for r in token_store.read_store(spark, out).collect() for x in r.ids]
    token_store.write_store(frame.limit(0), scratch("none"), A)


def test_a_hot_id_is_split_over_files(spark, scratch):
    out = scratch("tokens")
    rows = spark.range(6000).select(F.when(F.col("id") < 5000, F.lit(7)).otherwise(F.col("id"))
                                    .alias("doc_id"), F.concat(F.lit("text number "), F.col("id"), F.lit(" ")).alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_store.write_store(rows.repartition(4), out, A)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    store = token_store.read_store(spark, out)
    assert store.filter("doc_id = 7").select("file").distinct().count() > 1
    sums = sorted((r.start, r.n_tokens, r.doc_id) for r in token_store.checksums(store).collect())
    assert [s for s, _, _ in sums] == [0, *np.cumsum([n for _, n, _ in sums])[:-1].tolist()]
    assert [i for _, _, i in sums] == sorted(i for _, _, i in sums)


def test_store_files_have_the_encodings_and_indexes(spark, scratch):
    out = scratch("tokens")
    token_store.write_store(spark.read.parquet(f"{SF}/documents.parquet"), out, A)
    meta = pq.ParquetFile(glob.glob(f"{out.removeprefix('file:')}/part-*")[0]).metadata
    columns = {meta.row_group(0).column(i).path_in_schema: meta.row_group(0).column(i)
               for i in range(meta.num_columns)}
    ids = next(c for n, c in columns.items() if n.startswith("ids"))
    assert any("DICTIONARY" in e for e in ids.encodings)
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert columns["doc_id"].has_column_index and columns["doc_id"].has_offset_index
    one = token_store.read_store(spark, out).filter("doc_id = 11").select("n_tokens")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,11)" in plan and "ids:array" not in plan.split("ReadSchema")[1]


def test_words_are_encoded_once_while_they_are_kept(monkeypatch):
    with open(A, encoding="utf-8") as f:
        spec = f.read()
    load, asked = token_store.load_tokenizer, []

    class Counted:
        def __init__(self, tok):
            self.tok = tok

        def __getattr__(self, name):
            return getattr(self.tok, name)

        def encode_batch_fast(self, parts, **options):
            asked.extend(w for p in parts for w in p.split(" ")[1:])
            return self.tok.encode_batch_fast(parts, **options)

    monkeypatch.setattr(sys, "_tradelake_known_words", {}, raising=False)
    monkeypatch.setattr(token_store, "load_tokenizer", lambda *a, **b: Counted(load(*a, **b)))
    for text in ("x alpha beta", "x gamma", "x alpha beta gamma"):
        token_store.encode_texts(pa.array([text]), spec)
    assert sorted(asked) == ["alpha", "beta", "gamma", "x"]


@pytest.mark.parametrize("limit", [1, 3000, 8 << 20])
def test_known_words_are_bounded_and_change_no_ids(monkeypatch, limit):
    from tokenizers import Tokenizer

    with open(A, encoding="utf-8") as f:
        spec = f.read()
    tok, rng = Tokenizer.from_file(A), np.random.default_rng(7)
    monkeypatch.setattr(sys, "_tradelake_known_words", {}, raising=False)
    monkeypatch.setattr(token_store, "KNOWN_BYTES", limit, raising=False)
    syllables = ["the", "Ä", "ß", "'s", "1", "23", ".", ",\n", "\t", "中", "Ġ", "\x00", "<|endoftext|>"]
    for _ in range(12):
        texts = [" ".join("".join(rng.choice(syllables[:12 + (k == 0)], rng.integers(0, 4)))
                          for _ in range(rng.integers(0, 9))) for k in range(30)]
        texts += [None, "", "y" * 2000 + " " + "z" * 2000]
        ids, ends = token_store.encode_texts(pa.array(texts), spec)
        for i, t in enumerate(texts):
            assert ids[ends[i]:ends[i + 1]].tolist() == tok.encode(t or "", add_special_tokens=False).ids
        known = token_store.known_words(spec)
        assert known.words.nbytes + known.ids.nbytes <= limit


# --- decontamination, toxicity, language, quality ------------------------------------------

def test_items_without_an_id_still_hit(spark):
    items = spark.createDataFrame([(None, "alpha beta gamma delta"), (5, "beta gamma")],
                                  "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "x Alpha beta gamma DELTA y"), (2, "beta gamma"), (3, "alpha")],
                                 "doc_id bigint, text string")
    got = {r.doc_id: (r.n_hit, r.item_ids, r.contaminated)
           for r in decontaminate.contamination(docs, items).collect()}
    assert got == {1: (4, ["5"], True), 2: (2, ["5"], True), 3: (0, [], False)}


def plain_segments(x):
    """All maximal scoring segments by their definition: the best segment (the
    shortest, the first), then those of what is left and right of it."""
    out, pending = [], [(0, len(x))]
    while pending:
        a, b = pending.pop()
        best = max(((round(sum(x[i:j]), 9), -(j - i), -i) for i in range(a, b) for j in range(i + 1, b + 1)),
                   default=(0, 0, 0))
        if best[0] > 0:
            i, j = -best[2], -best[2] - best[1]
            out.append((i, j, best[0]))
            pending += [(a, i), (j, b)]
    return sorted(out)


def test_all_maximal_segments_match_their_definition():
    rng = np.random.default_rng(8)
    for _ in range(150):
        x = np.round(rng.normal(-0.1, 1, rng.integers(0, 22)), 6)
        got = [(a, b, round(s, 6)) for a, b, s in toxicity.maximal_segments(x)]
        assert got == [(a, b, round(s, 6)) for a, b, s in plain_segments(x.tolist())]


def test_segment_scan_is_linear():
    def seconds(n):
        start = time.perf_counter()
        assert toxicity.maximal_segments(np.tile([1.0, -1.5], n // 2))
        assert toxicity.maximal_segments(np.tile([1.0, -0.5], n // 2))
        return time.perf_counter() - start
    assert seconds(1_000_000) < 30 * max(seconds(100_000), 0.05)


def test_repeated_labels_and_long_texts(spark):
    docs = spark.createDataFrame([(i, f"fine words {i} here") for i in range(60)]
                                 + [(100 + i, f"awful slur words {i}") for i in range(60)]
                                 + [(300, "awful slur " * 20_000), (301, None)],
                                 "doc_id bigint, text string")
    labels = spark.createDataFrame(
        [(i, 0, 1) for i in range(60)] + [(100 + i, 1, 0) for i in range(60)]
        + [(3, 1, 0), (None, 1, 1), (4, None, None)], "doc_id bigint, toxic int, quality int")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert len(got) == 122 and got[300] > 0.5 > got[10] and got[301] < 0.5
    scored = quality_rules.score(docs, quality_rules.fit(docs, labels)).collect()
    assert len(scored) == 122 and all(0 <= r.score <= 1 for r in scored)


def test_scorer_equals_the_plain_convolution():
    rng = np.random.default_rng(2)
    net = language_id.train(["abc def ghi jkl", "xyz zyx yxz"], ["a", "b"], epochs=1, least_steps=3)
    windows = rng.integers(0, 256, (20, language_id.WINDOW)).astype(np.uint8)
    span = language_id.WINDOW - max(language_id.WIDTHS) + 1
    pooled = []
    for w, table in zip(language_id.WIDTHS, net.tables, strict=True):
        one_hot = np.eye(256)[windows]
        pooled.append(np.stack([[max(sum(one_hot[n, i + o] @ table[o][:, f] for o in range(w))
                                     for i in range(span)) for f in range(language_id.FILTERS)]
                                for n in range(20)]))
    hidden = np.maximum(np.concatenate(pooled, 1) + net.bias, 0)
    logits = hidden @ net.weights + net.offset
    p = np.exp(logits) / np.exp(logits).sum(1, keepdims=True)
    assert np.allclose(language_id.Scorer(net)(windows), p, atol=1e-4)


def test_every_language_can_be_learned(spark):
    rows = [(f"{chr(0x4e00 + k)}{chr(0x4e00 + k)} text {chr(97 + k % 26)}", f"l{k}") for k in range(600)]
    texts, labels = language_id.sample(spark.createDataFrame(rows, "text string, lang string"),
                                       "text", "lang", F.xxhash64("text"))
    assert len(set(labels)) == 600
    long = spark.createDataFrame([("word " * 5000, "en"), ("x", "fr")], "text string, lang string")
    texts, _ = language_id.sample(long, "text", "lang", F.xxhash64("text"))
    assert sorted(map(len, texts)) == [1, 25000]


def test_preferences_of_odd_turns(spark):
    rows = [(1, 1, None, "q"), (1, 2, "assistant", None), (1, 2, "assistant", "a"),
            (None, 1, "user", "x"), (2, 1, "user", None), (2, 2, "assistant", "b")]
    turns = spark.createDataFrame([(*r, "c", 1) for r in rows], "conv_id int, turn int, role string, "
                                  "text string, turns string, chosen int")
    talks = chat_format.conversations_as_rows(turns)
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in talks.collect()}
    assert got == {1: [("unknown", "q"), ("assistant", ""), ("assistant", "a")],
                   2: [("user", ""), ("assistant", "b")]}
    pairs = chat_format.swapped_replies(talks, chat_format.following(talks.select("conv_id")))
    made = chat_format.format_preferences(
        pairs.withColumn("prompt", F.lit(5)).withColumn("_c", F.lit("kept"))).collect()
    assert {r.conv_id: r["_c"] for r in made} == {1: "kept", 2: "kept"}
    assert all(isinstance(r.prompt, str) and r.rejected for r in made)
    none = chat_format.conversations_as_rows(turns.limit(0))
    assert chat_format.following(none.select("conv_id")).count() == 0
    assert chat_format.format_preferences(
        chat_format.swapped_replies(none, none.selectExpr("conv_id", "conv_id as rejected_from"))).count() == 0


@pytest.mark.parametrize("width", [1, 3, 17])
def test_pieces_of_long_words_are_found_in_slices(monkeypatch, width):
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        pieces = piece_codec.load_pieces(f.read())
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdenorstéß日\U0001f600 "), rng.integers(1, 90))).replace(" ", "▁")
             for _ in range(60)]
    flat, ends = piece_codec.encode_words(words, pieces)
    monkeypatch.setattr(piece_codec, "SLICE", width)
    again, same = piece_codec.encode_words(words, pieces)
    assert (flat == again).all() and (ends == same).all()


def test_pieces_edges_on_frames(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = [(1, None), (2, ""), (3, " a  b "), (4, "x" * 30000), (None, "é\n"), (5, "  ")]
    frame = spark.createDataFrame([(i, t, 1, "d") for i, t in rows],
                                  "doc_id bigint, text string, pieces int, decoded string")
    both = piece_codec.decode(piece_codec.encode(frame, path), path)
    assert {(r.doc_id, r.decoded) for r in both.collect()} == {(i, t or "") for i, t in rows}
    assert piece_codec.decode(piece_codec.encode(frame.limit(0), path), path).count() == 0
    nulls = both.withColumn("pieces", F.lit(None).cast("array<int>"))
    assert {r.decoded for r in piece_codec.decode(nulls, path).collect()} == {""}


# --- top-k search -----------------------------------------------------------------------

def plain_top(rows, queries, k):
    data = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in rows
            if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    out = []
    for q in queries:
        own = [v for i, v in data if i == q]
        every = sorted((-int(x @ v), i) for x in own for i, v in data if i != q and len(v) == len(x))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(every[:k])]
    return sorted(out)


def test_search_prunes_clustered_vectors_and_stays_exact(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "BLOCK", 32)
    monkeypatch.setattr(topk_search, "BLOCKS_PER_CELL", 4)
    rng = np.random.default_rng(3)
    middles = rng.normal(0, 1, (24, 16))
    rows = [(int(i), (middles[rng.integers(24)] + rng.normal(0, 0.05, 16)).astype(np.float32).tolist())
            for i in rng.permutation(3000)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3)
    scored = spark.sparkContext.accumulator(0)
    got = topk_search.top_k(vectors, vectors.filter("vec_id % 50 = 0"), k=5, scored=scored)
    assert sorted(tuple(r) for r in got.collect()) == plain_top(rows, range(0, 3000, 50), 5)
    pairs = 60 * (3000 // 32)
    assert 0 < scored.value < 0.35 * pairs
    monkeypatch.setattr(topk_search, "CELL_BYTES", 0)            # extremes not held: all cells
    whole = topk_search.top_k(vectors, vectors.filter("vec_id % 50 = 0"), k=5)
    assert sorted(tuple(r) for r in whole.collect()) == sorted(tuple(r) for r in got.collect())


def test_search_edges(spark):
    rows = [(0, [1.0, 2.0]), (50, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [0.5, 0.0]), (None, [9.0, 9.0]),
            (3, None), (4, [None, 1.0]), (5, [float("inf"), 1.0]), (6, [1.0]), (100, []), (7, [])]
    vectors = spark.createDataFrame([(i, v, i, "x") for i, v in rows],
                                    "vec_id bigint, embedding array<float>, id bigint, dim string")
    asked = vectors.filter("vec_id % 50 = 0")
    got = sorted(tuple(r) for r in topk_search.top_k(vectors, asked, k=2).collect())
    assert got == plain_top(rows, (0, 50, 100), 2)
    assert topk_search.top_k(vectors.limit(0), asked, k=2).count() == 0
    assert topk_search.top_k(vectors, asked.limit(0), k=2).count() == 0
    twice = topk_search.top_k(vectors, asked.filter("vec_id = 0").unionByName(asked.filter("vec_id = 0")), k=3)
    assert twice.count() == 3


# --- pipeline --------------------------------------------------------------------------

def test_stages_keep_columns_with_clashing_names(spark, tmp_path):
    sf = str(tmp_path)
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{sf}/{t}.parquet")
    names = ["stats", "score", "_row", "n_words", "n_removed", "kept_text", "id", "rest", "row",
             "component_id", "pieces", "decoded", "_rest", "rep", "group"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for k, n in enumerate(names):
        docs = docs.withColumn(n, F.lit(-k))
    docs.write.parquet(f"{sf}/documents.parquet")
    plain = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, sf), name.replace(" ", "-"))
        assert docs.columns[-len(names):] == names, name
        assert docs.filter(" or ".join(f"{n} <> {-k}" for k, n in enumerate(names))).count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert sorted(map(tuple, last.collect()), key=repr) == sorted(map(tuple, plain), key=repr)


def test_stages_decide_as_plain_code(spark, tmp_path):
    sf = str(tmp_path)
    rng = np.random.default_rng(6)
    vocab = [f"word{k}" for k in range(400)]

    def prose(n):
        return " ".join(rng.choice(vocab, n))
    passage, test, short = prose(60), prose(14), "one two three"
    rows = [(1, prose(100)), (2, f"{prose(80)} {passage} {prose(20)}"), (3, f"{prose(90)} {passage}"),
            (4, f"{prose(50)} {test} {prose(40)}"), (5, f"{prose(60)} {short}"), (None, passage),
            (6, None), (7, ""), (8, f"{prose(30)}  {prose(30)}")]
    rows += [(20 + k, rows[0][1]) for k in range(5)] + [(30, rows[0][1] + " more")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars int")
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([("t", test), ("s", short), (None, "nothing")],
                          "item_id string, text string").write.parquet(f"{sf}/benchmark.parquet")

    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} - {()}

    stage = dict(corpus_pipeline.STAGES)
    near = corpus_pipeline.written(stage["near-duplicates"](spark, docs, sf), "near")
    kept = []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        s = shingles(t)
        if not any(s and 100 * len(s & u) >= 80 * len(s | u) for _, u in kept):
            kept.append((i, s))
    assert sorted((r.doc_id for r in near.collect()), key=repr) == sorted((i for i, _ in kept), key=repr)

    cut = corpus_pipeline.written(stage["substring dedup"](spark, near, sf), "cut")
    rest = [(r.doc_id, r.text) for r in near.collect()]
    expected = {}
    for (i, n, gone, text), (j, old) in zip(plain_repeats(rest, 50), sorted(rest, key=lambda r: repr(r[0])),
                                            strict=False):
        if not (gone and gone == n):
            expected[i] = text if gone else dict(rest)[i]
    assert {r.doc_id: r.text for r in cut.collect()} == expected
    assert all(r.n_chars == len(r.text or "") for r in cut.collect())
    assert None not in expected and passage not in expected[3] and passage in expected[2]

    clean = corpus_pipeline.written(stage["decontamination"](spark, cut, sf), "clean")
    assert {r.doc_id for r in clean.collect()} == set(expected) - {4}
    ids = stage["sentencepiece"](spark, clean, sf).collect()
    assert {r.doc_id for r in ids} == set(expected) - {4}
    assert all(r.n_pieces == len(r.pieces) for r in ids)
