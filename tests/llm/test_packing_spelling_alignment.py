"""Sharding, spelling variants and tokenizer alignment against brute force,
and their defined results on nulls, empty and long texts, ties and repeats."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradelake.llm import alignment, queries, sharding, spelling

SF = "/root/testdata/sf0.001"
A, B = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = [(1, None), (2, ""), (3, " \n"), (4, "a"), (4, "a"), (None, "a b"), (5, "x " * 3000),
       (6, "É é 日本 ok"), (7, None), (8, "z" * 4000), (9, "a ▁ b"), (10, "<s> <|endoftext|> \0 </s>")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Edge rows beside columns that bear names the operators use."""
    names = "key string, size string, shard string, row string, digest string, word string, n string"
    rows = [(i, t, *"abcdefg") for i, t in ODD]
    return spark.createDataFrame(rows, f"doc_id bigint, text string, {names}")


# --- sharding ---------------------------------------------------------------------

def plain_best_fit(sizes, capacity):
    room, out = [], []
    for s in sizes:
        fits = [(r, i) for i, r in enumerate(room) if r >= s]
        if fits:
            i = min(fits)[1]
        else:
            room.append(max(capacity, s))
            i = len(room) - 1
        room[i] -= s
        out.append(i)
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=80), st.integers(1, 90))
def test_best_fit_takes_the_tightest_bin(sizes, capacity):
    sizes = sorted(sizes, reverse=True)
    assert sharding.best_fit(sizes, capacity) == plain_best_fit(sizes, capacity)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=200), st.integers(1, 9))
def test_even_bins_differ_by_no_more_than_large_groups(sizes, n):
    sizes = sorted(sizes, reverse=True)
    bins = sharding.even_bins(sizes, n)
    fill = Counter()
    for s, b in zip(sizes, bins):
        fill[b] += s
    assert set(bins) <= set(range(n))
    assert max(fill.values()) <= sum(sizes) / n + 2 * sizes[0]


def check_shards(rows, got, n):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    slots, of_text = defaultdict(list), defaultdict(set)
    for r in got:
        assert 0 <= r.shard < n
        slots[r.shard].append(r.slot)
        of_text[r.size, r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in of_text.values())


def test_shards_are_even_and_groups_whole(spark, docs):
    got = queries.op13_sharding(spark, "/root/testdata/sf0.01").collect()
    rows = [(r.doc_id, r.text) for r in
            spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    check_shards(rows, got, 8)
    fill = Counter()
    for r in got:
        fill[r.shard] += r.size
        assert r.law == "bytes" and r.grown_shard is None
    assert max(fill.values()) - min(fill.values()) <= 0.01 * sum(fill.values()) / 8
    copies = docs.unionByName(docs.filter("doc_id < 20").crossJoin(F.broadcast(
        spark.range(40)).select()))
    check_shards([(r.doc_id, r.text) for r in copies.collect()],
                 sharding.shard_evenly(copies, 3).collect(), 3)


def test_small_groups_are_packed_in_parcels(spark):
    random.seed(3)
    rows = [(i, "w" * random.randint(0, 30) + str(i % 700)) for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    kept = sharding.packed_rows(sharding.rows_of(frame, "doc_id", "text"),
                                lambda s: sharding.even_bins(s, 4), grain=64)
    got = sharding.numbered(kept).collect()
    check_shards(rows, got, 4)


def test_a_hot_group_has_its_own_shard_and_others_are_even(spark):
    rows = [(k, "same text of some length") for k in range(900)]
    rows += [(1000 + k, f"other text number {k}") for k in range(1000)]
    got = sharding.shard_evenly(spark.createDataFrame(rows, "doc_id bigint, text string"), 8).collect()
    check_shards(rows, got, 8)
    fill = Counter()
    for r in got:
        fill[r.shard] += r.size
    hot = {r.shard for r in got if r.doc_id < 900}
    others = [n for s, n in fill.items() if s not in hot]
    assert len(hot) == 1 and len(others) == 7 and max(others) - min(others) < 200


def test_shards_of_odd_rows(spark, odd):
    check_shards(ODD, sharding.shard_evenly(odd, 8).collect(), 8)
    assert sharding.shard_evenly(odd.limit(0), 8).count() == 0
    got = sharding.shard_by_capacity(odd, 100).collect()
    check_shards(ODD, got, len(ODD))
    fill = Counter()
    for r in got:
        fill[r.shard] += r.size
    alone = Counter(r.shard for r in got)
    assert all(n <= 100 or alone[s] == 1 for s, n in fill.items())


# --- spelling -----------------------------------------------------------------------

def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def plain_groups(n):
    out = {}
    for w in n:
        close = [x for x in n if near(w, x)]
        form = min(close, key=lambda x: (-n[x], x)) if close else None
        if form is not None and n[form] < 5 * n[w]:
            form = None
        out[w] = (form, n[w], len(close), n.get(form))
    roots = {}
    for w in out:
        r = w
        while out[r][0]:
            r = out[r][0]
        roots[w] = r
    return {w: (f, roots[w], k, m, fn) for w, (f, k, m, fn) in out.items()}


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def test_spelling_query_matches_brute_force(spark, docs):
    n = Counter()
    for r in docs.collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = lower(run)
            h = zlib.crc32(f"{r.doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += len(run) >= 6
    expected = plain_groups({w: c for w, c in n.items() if c >= 5})
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n)
           for r in queries.op11_spelling_variants(spark, SF).collect()}
    assert got == expected and any(f for f, *_ in got.values())


def test_pivots_find_all_near_words_of_few_letters(spark):
    random.seed(5)
    words = {"".join(random.choices("ab", k=random.randint(6, 9))) for _ in range(150)}
    words |= {"".join(random.choices("abcÀé", k=6)) for _ in range(300)}
    words |= {"a" * 3000, "a" * 2999, "a" * 2998 + "b"}
    n = {w: random.choice([5, 30, 200, 2000]) for w in words}
    frame = spark.createDataFrame(list(n.items()), "word string, n bigint")
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n)
           for r in spelling.variant_groups(frame).collect()}
    assert got == plain_groups(n)


@settings(max_examples=80, deadline=None)
@given(st.text("abc", min_size=4, max_size=12))
def test_pivots_are_disjoint_and_cheapest(word):
    grams = sorted({word[i:i + 2] for i in range(len(word) - 1)})
    rank = {g: i for i, g in enumerate(grams)}
    weight = [i * i for i in range(len(grams))]
    prefix, pivots, _ = spelling.prefix_and_pivots(word, rank, weight)
    w = {i: weight[rank[word[i:i + 2]]] for i in prefix}
    assert w[pivots[0]] + w[pivots[1]] == min(w[i] + w[j] for i in prefix for j in prefix if j - i >= 2)
    assert pivots[1] - pivots[0] >= 2


def test_spelling_of_odd_rows(spark, odd):
    counted = spelling.word_counts(odd, min_count=1).collect()
    assert {(r.word, r.n) for r in counted} == {("z" * 4000, 1), ("endoftext", 1)}
    assert spelling.variant_groups(spelling.word_counts(odd.limit(0))).count() == 0
    hot = spark.createDataFrame([(None, "spelling Spelling spellin")] * 5, "doc_id bigint, text string")
    got = {r.word: (r.n, r.n_near, r.form) for r in
           spelling.variant_groups(spelling.word_counts(hot)).collect()}
    assert got == {"spelling": (10, 1, None), "spellin": (5, 1, None)}


# --- alignment ------------------------------------------------------------------------

def plain_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    a_tok = Tokenizer.from_file(A)
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=B)
    to_byte = alignment.byte_alphabet()
    a_of = {i: bytes(to_byte[c] for c in t) for t, i in a_tok.get_vocab().items()}

    def b_of(i):
        piece = b_tok.id_to_piece(i)
        byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    parts, counts = [], Counter()
    for i, t in rows:
        a = a_tok.encode(f" {t}", add_special_tokens=False).ids if t else []
        b = b_tok.encode(t) if t else []
        raw = f" {t}".encode()
        if b"".join(a_of[x] for x in a) != raw or b"".join(b_of(x) for x in b) != raw:
            a, b = [], []
        spans = []
        for ids, of in ((a, lambda x: a_of[x]), (b, b_of)):
            at, own = 0, []
            for x in ids:
                own.append((at, at + len(of(x)), x))
                at += len(of(x))
            spans.append(own)
        both = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, start = [], 0
        for end in both:
            groups.append("|".join(",".join(str(x) for s, e, x in own if start <= s and e <= end)
                                   for own in spans))
            start = end
        links, k = [], 0
        for s, e, x in spans[0]:
            while k and spans[1][k][0] > s:
                k -= 1
            j = k
            while j < len(spans[1]) and spans[1][j][0] < e:
                if spans[1][j][1] > s:
                    links.append((x, spans[1][j][2]))
                k, j = j, j + 1
        counts.update(links)
        parts.append((i, len(a), len(b), groups, links))
    best = defaultdict(int)
    for (_, y), c in counts.items():
        best[y] = max(best[y], c)
    return Counter((i, n_a, n_b, len(groups), len(links),
                    sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(";".join(groups).encode()).hexdigest() if links else "")
                   for i, n_a, n_b, groups, links in parts)


def aligned(frame):
    return Counter(tuple(r) for r in alignment.align_documents(frame, A, B).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
        "groups_sha256").collect())


def test_alignment_matches_plain_code(spark, docs):
    got = Counter(tuple(r) for r in queries.op12_tokenizer_alignment(spark, SF).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())
    assert got == plain_alignment([(r.doc_id, r.text) for r in docs.collect()])


def test_alignment_of_odd_rows(odd):
    rows = [(i, t) for i, t in ODD] * 3
    frame = odd.unionByName(odd).unionByName(odd)
    assert aligned(frame) == plain_alignment(rows)
    assert sum(aligned(odd.limit(0)).values()) == 0


def test_alignment_in_many_blocks(docs, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 30_000)
    monkeypatch.setattr(alignment, "PART_BYTES", 7_000)
    some = docs.filter("doc_id % 3 = 0")
    assert aligned(some) == plain_alignment([(r.doc_id, r.text) for r in some.collect()])
