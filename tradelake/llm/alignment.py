"""Alignment of two tokenizers' tokens over the bytes of every text.

Texts are shuffled whole and each distinct one is tokenised and aligned once,
and within a block each distinct word; link counts weigh as many times as the text occurs.  Tasks align blocks of
texts: a block holds its distinct id pairs with their weighted counts, and per
text which of those pairs it has and how often.  Pairs of blocks are summed
over the corpus, the sums go back to the blocks (one row per block and pair),
and each block turns them into measures of its texts.  Those are joined to the
documents by the SHA-256 of the text; texts with a thousandth of all rows, a
thousand at most, are joined by broadcast and never share a task.
"""

from __future__ import annotations

import hashlib
import os
import sys
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import blocks, written
from tradelake.llm.substring_dedup import pack, unpack
from tradelake.llm.token_store import _LOOSE, _SPACE

#: Text bytes of a block, and of what is tokenised at once.
BLOCK_BYTES = 3 << 20
PART_BYTES = 1 << 20
STRINGS_AT_ONCE = 2000
_SHIFT = 32
_ALIGNED = ("block bigint, texts array<struct<digest: binary, n_a: bigint, n_b: bigint, "
            "n_groups: bigint, n_links: bigint, sha: string>>, weights array<bigint>, "
            "pairs array<bigint>, totals array<bigint>, uses binary")
_MEASURES = ("digest binary, weight bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
             "n_best bigint, count_sum bigint, groups_sha256 string")


def byte_alphabet() -> dict[str, int]:
    """Byte of each character of byte-level vocabularies: printable Latin-1
    characters stand for themselves, other bytes for characters from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers and the bytes of their tokens; A from its JSON
    specification, B from its serialized model."""

    def __init__(self, spec: str, model: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # the tasks use all cores
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(spec)
        self.a.encode_special_tokens = True                 # their strings in a text are text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        alphabet = byte_alphabet()
        vocab = self.a.get_vocab()
        a_bytes = [b""] * (1 + max(vocab.values()))
        for token, i in vocab.items():
            a_bytes[i] = bytes(alphabet[c] for c in token)
        b_bytes = [
            bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
            else self.b.id_to_piece(i).replace("▁", " ").encode()
            for i in range(self.b.get_piece_size())]
        self.a_bytes, self.b_bytes = TokenBytes(a_bytes), TokenBytes(b_bytes)
        #: decimal id and what follows it, at 3 * id + kind
        self.words = [f"{i}{end}" for i in range(max(len(a_bytes), len(b_bytes))) for end in ",|;"]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Flat ids and text offsets of A and of B, each text behind a space; no
        ids for texts whose tokens' bytes differ from that, or that are empty."""
        lists = []
        for i in range(0, len(texts), STRINGS_AT_ONCE):     # the library's results are large
            lists += [e.ids for e in self.a.encode_batch_fast(
                [f" {t}" for t in texts[i:i + STRINGS_AT_ONCE]], add_special_tokens=False)]
        a, a_at = _flat(lists)
        b, b_at = _flat(self.b.encode(texts, num_threads=1))
        raw = [f" {t}".encode() for t in texts]
        size = np.array([len(r) for r in raw])
        fits = size > 1
        for tokens, ids, at in ((self.a_bytes, a, a_at), (self.b_bytes, b, b_at)):
            ends = np.concatenate([[0], np.cumsum(tokens.sizes[ids])])
            fits &= np.diff(ends[at]) == size
        while True:                    # texts of fitting lengths stand at the same bytes
            if not fits.all():
                (a, a_at), (b, b_at) = _without(a, a_at, fits), _without(b, b_at, fits)
            data = np.frombuffer(b"".join(r for r, f in zip(raw, fits, strict=True) if f), np.uint8)
            wrong = (self.a_bytes.joined(a) != data) | (self.b_bytes.joined(b) != data)
            if not wrong.any():
                return a, a_at, b, b_at
            kept = np.flatnonzero(fits)
            fits = fits.copy()
            fits[kept[np.searchsorted(np.cumsum(size[kept]), np.flatnonzero(wrong), "right")]] = False


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    at = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)])
    return np.fromiter(chain.from_iterable(lists), np.int64, int(at[-1])), at


class TokenBytes:
    """Bytes of every token, one after the other."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.sizes[ids]
        ends = np.cumsum(size)
        shift = np.repeat(self.starts[ids] - (ends - size), size)
        return self.data[shift + np.arange(len(shift))]


def _without(ids: np.ndarray, at: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and offsets with those of the texts that are not ``kept`` left out."""
    size = np.diff(at)
    return (ids[np.repeat(kept, size)],
            np.concatenate([[0], np.cumsum(np.where(kept, size, 0))]))


def tokenizers(spec: str, model: bytes) -> Tokenizers:
    """The pair of tokenizers, once per worker process."""
    loaded = sys.__dict__.setdefault("_tradelake_aligned_tokenizers", {})
    key = (hash(spec), hash(model))
    if key not in loaded:
        loaded.clear()
        loaded[key] = Tokenizers(spec, model)
    return loaded[key]


def align(tok: Tokenizers, texts: list[str]) -> tuple[np.ndarray, list[str], tuple]:
    """Counts (n_a, n_b, n_groups, n_links) and written groups of every text, and
    its links as (text number, pair, times) with pairs ``a << 32 | b``.

    The texts stand one after the other, and token ends are marked on their
    bytes.  Two tokens overlap in exactly one stretch between neighbouring ends
    of either kind, so links are those stretches; ends of both kinds close groups.
    """
    a, a_at, b, b_at = tok.encode(texts)
    end_a, end_b = np.cumsum(tok.a_bytes.sizes[a]), np.cumsum(tok.b_bytes.sizes[b])
    marks = np.zeros((2, 1 + (int(end_a[-1]) if len(a) else 0)), bool)
    marks[0, end_a] = marks[1, end_b] = True
    upto_a, upto_b = np.cumsum(marks[0]), np.cumsum(marks[1])   # tokens that end by a byte
    both, either = marks[0] & marks[1], marks[0] | marks[1]
    upto_both = np.cumsum(both)
    common, ends = np.flatnonzero(both), np.flatnonzero(either)
    text_ends = np.concatenate([[0], end_a])[a_at]
    counts = np.stack([np.diff(a_at), np.diff(b_at), np.diff(upto_both[text_ends]),
                       np.diff(np.cumsum(either)[text_ends])])

    # all ids in the order they are written: a group's A tokens, then its B tokens
    group_a, group_b = (upto_both[e] - both[e] for e in (end_a, end_b))
    starts = np.concatenate([[0], common])
    codes = np.empty(len(a) + len(b), np.int64)
    codes[np.arange(len(a)) + upto_b[starts[group_a]]] = 3 * a + both[end_a]
    codes[np.arange(len(b)) + upto_a[starts[group_b + 1]]] = 3 * b + 2 * both[end_b]
    words = list(map(tok.words.__getitem__, codes.tolist()))
    cuts = (a_at + b_at).tolist()
    groups = ["".join(words[s:e])[:-1] for s, e in zip(cuts[:-1], cuts[1:], strict=True)]

    pairs = a[upto_a[ends] - marks[0, ends]] << _SHIFT | b[upto_b[ends] - marks[1, ends]]
    return counts, groups, _counted(np.repeat(np.arange(len(texts)), counts[3]), pairs)


def _counted(text: np.ndarray, pair: np.ndarray, times: np.ndarray | None = None) -> tuple:
    """(text, pair, times) with each text's pairs once, in order of texts."""
    known, code = np.unique(pair, return_inverse=True)
    n = max(1, len(known))
    keys = text * n + code
    if times is None:
        keys = np.sort(keys)
        new = np.flatnonzero(np.diff(keys, prepend=-1))
        times = np.diff(np.append(new, len(keys)))
    else:
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        new = np.flatnonzero(np.diff(keys, prepend=-1))
        times = np.add.reduceat(times[order], new) if len(new) else times
    return keys[new] // n, known[keys[new] % n], times


def align_by_words(tok: Tokenizers, texts: pa.Array) -> tuple[np.ndarray, list[str], tuple]:
    """As ``align``, with the digests of the groups in place of the groups.

    Both tokenizers begin a token at a single space inside a text, so there ends
    a group.  Distinct words are aligned once; a text is the sum of its words.
    Texts with other white space beside a space, or with U+2581, which B writes
    for a space, are units of their own.
    """
    n = len(texts)
    loose = pc.match_substring_regex(texts, f"^{_SPACE}|{_LOOSE}|▁").to_numpy(zero_copy_only=False)
    loose = loose.astype(bool)
    lists = pc.split_pattern(texts.filter(pa.array(~loose)), " ")
    coded = lists.flatten().dictionary_encode()
    units = pa.concat_arrays([coded.dictionary, texts.filter(pa.array(loose))])
    code = np.empty(len(coded.indices) + int(loose.sum()), np.int64)
    size = np.ones(n, np.int64)
    size[~loose] = pc.list_value_length(lists).to_numpy()
    in_loose = np.repeat(loose, size)
    code[~in_loose] = coded.indices.to_numpy()
    code[in_loose] = len(coded.dictionary) + np.arange(int(loose.sum()))
    at = np.concatenate([[0], np.cumsum(size)])

    counts, groups, links, done = [], [], [], 0
    batch = pa.RecordBatch.from_arrays([units], names=["unit"])
    for part in blocks(batch, ["unit"], PART_BYTES):
        c, g, (unit, pair, times) = align(tok, part.column(0).to_pylist())
        counts.append(c)
        groups += g
        links.append((unit + done, pair, times))
        done += part.num_rows
    counts = np.concatenate(counts, axis=1)
    unit, pair, times = (np.concatenate(c) for c in zip(*links, strict=True))

    # a unit without tokens leaves its text without any
    text = np.repeat(np.arange(n), size)
    valid = np.bincount(text[counts[0][code] == 0], minlength=n) == 0
    sums = np.stack([np.diff(np.concatenate([[0], np.cumsum(c[code])])[at]) for c in counts])
    sums[:, ~valid] = 0
    digests = [
        hashlib.sha256(";".join(map(groups.__getitem__, code[s:e].tolist())).encode()).hexdigest()
        if ok else "" for s, e, ok in zip(at[:-1].tolist(), at[1:].tolist(), valid.tolist(), strict=True)]

    # each text's distinct units, and the links of each
    keep = valid[text]
    own, unit_of, often = _counted(text[keep], code[keep])
    first = np.searchsorted(unit, np.arange(len(units) + 1))
    many = np.diff(first)[unit_of]
    ends = np.cumsum(many)
    take = np.repeat(first[unit_of] - (ends - many), many) + np.arange(int(many.sum()))
    return sums, digests, _counted(np.repeat(own, many), pair[take],
                                   times[take] * np.repeat(often, many))


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches joined to about BLOCK_BYTES."""
    held, size = [], 0
    for batch in batches:
        for part in blocks(batch, ["text"], PART_BYTES):
            held.append(part)
            size += pc.sum(pc.binary_length(part.column("text"))).as_py()
            if size >= BLOCK_BYTES:
                yield pa.concat_batches(held)
                held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def aligned_blocks(texts: DataFrame, spec: str, model: bytes) -> DataFrame:
    """Blocks of distinct texts (text, weight), aligned (see the module's text)."""

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizers(spec, model)
        block = TaskContext.get().partitionId() << 33
        for held in _blocks_of(batches):
            counts, digests, (text, pair, times) = align_by_words(tok, held.column("text"))
            rows = [dict(zip(("digest", "n_a", "n_b", "n_groups", "n_links", "sha"), r, strict=True))
                    for r in zip((hashlib.sha256(t.encode()).digest()
                                  for t in held.column("text").to_pylist()),
                                 *counts.tolist(), digests, strict=True)]
            weights = held.column("weight").to_numpy()
            pairs, code = np.unique(pair, return_inverse=True)
            totals = np.zeros(len(pairs), np.int64)
            np.add.at(totals, code, times * weights[text])
            steps = np.diff(code, prepend=0)                # small within a text
            yield pa.RecordBatch.from_pylist([{
                "block": block, "texts": rows, "weights": weights.tolist(),
                "pairs": pairs.tolist(), "totals": totals.tolist(),
                "uses": pack(text, steps, times)}], schema=_arrow_schema())
            block += 1

    return written(texts.mapInArrow(aligned, _ALIGNED), "aligned-texts")


def _arrow_schema() -> pa.Schema:
    text = pa.struct([("digest", pa.binary()), *((c, pa.int64()) for c in (
        "n_a", "n_b", "n_groups", "n_links")), ("sha", pa.string())])
    return pa.schema([("block", pa.int64()), ("texts", pa.list_(text)),
                      ("weights", pa.list_(pa.int64())), ("pairs", pa.list_(pa.int64())),
                      ("totals", pa.list_(pa.int64())), ("uses", pa.binary())])


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, best): links of each id pair over all documents, and whether
    no pair of the same B id has more."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "totals")).alias("p"))
    counts = each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.totals").alias("count"))
    b_id = F.col("pair").bitwiseAND(F.lit((1 << _SHIFT) - 1)).alias("b")
    most = counts.groupBy(b_id).agg(F.max("count").alias("most"))
    return (counts.withColumn("b", b_id).join(most.hint("merge"), "b")
            .select("pair", "count", (F.col("count") == F.col("most")).alias("best")))


def text_measures(aligned: DataFrame) -> DataFrame:
    """One row per distinct text (see ``_MEASURES``)."""
    asked = aligned.select(F.col("block").alias("asker"), F.posexplode("pairs").alias("place", "pair"))
    answers = (asked.join(pair_counts(aligned).hint("merge"), "pair")
               .select("asker", "place", "count", "best"))

    def measured(block: pa.Table, known: pa.Table) -> pa.Table:
        count = np.zeros(known.num_rows, np.int64)
        best = np.zeros(known.num_rows, bool)
        place = known.column("place").to_numpy()
        count[place] = known.column("count").to_numpy()
        best[place] = known.column("best").to_numpy()
        out = []
        for row in block.to_pylist():
            text, steps, times = unpack(row["uses"])
            code = np.cumsum(steps)
            at = np.searchsorted(text, np.arange(len(row["texts"]) + 1))
            sums = [np.concatenate([[0], np.cumsum(x)])[at] for x in (
                times * best[code], times * count[code])]
            n_best, count_sum = (np.diff(s).tolist() for s in sums)
            out += [{**{k: t[k] for k in ("digest", "n_a", "n_b", "n_groups", "n_links")},
                     "weight": w, "n_best": x, "count_sum": y, "groups_sha256": t["sha"]}
                    for t, w, x, y in zip(row["texts"], row["weights"], n_best, count_sum,
                                          strict=True)]
        return pa.Table.from_pylist(out, schema=pa.schema(
            [("digest", pa.binary()), *((c, pa.int64()) for c in (
                "weight", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")),
             ("groups_sha256", pa.string())]))

    return written(aligned.groupBy("block").cogroup(answers.groupBy("asker"))
                   .applyInArrow(measured, _MEASURES), "text-measures")


def align_documents(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Alignment measures of every row: doc_id, n_a, n_b, n_groups, n_links,
    n_best, count_sum and groups_sha256.

    A reads the text behind a space, B adds one itself; strings of special
    tokens are plain text.  Null and empty texts, and texts whose joined token
    bytes differ from space + text, have no tokens: zeros and ''.  Repeated rows
    each count and each have a row; rows with a null id are kept.  An empty table
    gives an empty one.  Columns other than the two named are not read.
    """
    with open(a_path, encoding="utf-8") as f:
        spec = f.read()
    with open(b_path, "rb") as f:
        model = f.read()
    text = F.col(f"`{text_col}`")
    texts = (docs.select(text.alias("text")).filter("text is not null and text <> ''")
             .groupBy("text").agg(F.count("*").alias("weight")))
    measures = text_measures(aligned_blocks(texts, spec, model))
    rows = measures.agg(F.sum("weight")).first()[0] or 0
    # a thousand texts at most hold a thousandth of all rows each
    frequent = F.col("weight") * 1000 >= rows
    values = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

    def named(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(F.col("digest").alias(f"{prefix}key"),
                         *(F.col(c).alias(prefix + c) for c in values))

    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                         F.when(text != "", F.unhex(F.sha2(text.cast("binary"), 256))).alias("digest"))
    found = source.join(F.broadcast(named(measures.filter(frequent), "f_")),
                        F.col("digest") == F.col("f_key"), "left")
    # rows that are answered, or have no text, ask for a key of their own that nothing has
    own = F.concat(F.lit("row "), F.monotonically_increasing_id().cast("string")).cast("binary")
    found = found.withColumn("asked", F.when(F.col("f_key").isNull() & F.col("digest").isNotNull(),
                                             F.col("digest")).otherwise(own))
    joined = found.join(named(measures.filter(~frequent), "s_").hint("merge"),
                        F.col("asked") == F.col("s_key"), "left")
    return joined.select("doc_id", *(
        F.coalesce(F.col(f"f_{c}"), F.col(f"s_{c}"), F.lit("" if c == "groups_sha256" else 0))
        .alias(c) for c in values))
