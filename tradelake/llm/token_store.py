"""Token ids as Parquet list columns.

Texts are ordered by id over range partitions and encoded there, so file
order is id order.  Token lists are dictionary-encoded (ids of one vocabulary
are few), ids and counts are delta-encoded; row groups and pages have a set
size and carry column and offset indexes, so a reader of counts or of a few
ids opens only their pages.
"""

from __future__ import annotations

import os
import sys
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tradelake.llm.common import blocks

SCHEMA = "file bigint, doc_id bigint, first bigint, n_tokens bigint, ids array<int>"
#: Row-group bytes and rows of a page: a page is the least that a selective read takes.
ROW_GROUP_BYTES = 16 << 20
PAGE_ROWS = 2000
#: Bytes of words and their token ids that a worker process keeps.
KNOWN_BYTES = 8 << 20
#: Words that are tokenized as one string, and strings at once.
WORDS_AT_ONCE, STRINGS_AT_ONCE = 500, 16

#: A space next to other white space, or at either end of a text (fixed list:
#: Unicode white space).  Elsewhere a space always begins a new pre-token.
_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_LOOSE = f"^ | $|{_SPACE} | {_SPACE}"


def load_tokenizer(spec: str, specials: bool = True):
    """The tokenizer of a JSON specification, once per worker process.  Without
    ``specials`` it does not look for special tokens, which is faster."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"    # the tasks use all cores
    from tokenizers import Tokenizer

    loaded = sys.__dict__.setdefault("_tradelake_tokenizers", {})
    if (spec, specials) not in loaded:
        for key in [k for k in loaded if k[0] != spec]:
            del loaded[key]
        loaded[spec, specials] = Tokenizer.from_str(spec)
        loaded[spec, specials].encode_special_tokens = not specials
    return loaded[spec, specials]


def _added(tok) -> list[str]:
    """Strings that a tokenizer takes out of a text before all else."""
    return [t.content for t in tok.get_added_tokens_decoder().values()]


class KnownWords:
    """Token ids of words behind a space that this worker process has encoded,
    as bytes beside the words.  Beyond ``KNOWN_BYTES`` those stay that the last
    block had, if they fit."""

    def __init__(self) -> None:
        self.words = pa.array([], pa.large_string())
        self.ids = pa.array([], pa.large_binary())

    def places(self, words: pa.Array, encode: Callable[[pa.Array], pa.Array]
               ) -> tuple[np.ndarray, pa.Array]:
        """Place of every distinct word of a block in a list of token ids, and
        that list; ``encode`` gives the ids of new words."""
        words = words.cast(pa.large_string())
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().astype(np.int64)
        is_new = at < 0
        new = words.filter(pa.array(is_new))
        at[is_new] = len(self.words) + np.arange(len(new))
        ids = pa.concat_arrays([self.ids, encode(new)])
        self.words, self.ids = pa.concat_arrays([self.words, new]), ids
        if self.words.nbytes + self.ids.nbytes > KNOWN_BYTES:
            self.words, self.ids = words, ids.take(pa.array(at))
            if self.words.nbytes + self.ids.nbytes > KNOWN_BYTES:
                self.__init__()
        return at, ids


def known_words(spec: str) -> KnownWords:
    known = sys.__dict__.setdefault("_tradelake_known_words", {})
    return known.setdefault(spec, KnownWords())


def _begins(spec: str) -> np.ndarray:
    """Whether each token begins with a space."""
    begins = sys.__dict__.setdefault("_tradelake_begins", {})
    if spec not in begins:
        tok = load_tokenizer(spec, specials=False)
        begins[spec] = np.zeros(tok.get_vocab_size(), bool)
        begins[spec][[i for t, i in tok.get_vocab().items() if t.startswith("Ġ")]] = True
    return begins[spec]


def _id_bytes(ids: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Token ids as one binary value for each part; parts begin at ``starts``."""
    offsets = 4 * np.append(starts, len(ids)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(starts),
                                 [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype(np.int32))])


def encode_texts(texts: pa.Array, spec: str) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of every text (null: none): (flat ids, offsets), those of the
    library's own call.

    A byte-level pre-tokenizer always begins a pre-token at a single space
    inside a text.  So distinct space-separated words are encoded once and
    their ids copied to where they occur; texts with other white space beside a
    space, or with the string of an added token, are encoded as they are.
    """
    tok = load_tokenizer(spec, specials=False)

    def encode(parts: list[str], tok=tok) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in tok.encode_batch_fast(parts, add_special_tokens=False)]

    def one_by_one(lists: list[np.ndarray]) -> pa.Array:
        return _id_bytes(np.concatenate([np.zeros(0, np.int32), *lists]),
                         np.cumsum([0, *map(len, lists)])[:-1])

    texts = pc.fill_null(texts, "")
    n = len(texts)
    loose = pc.match_substring_regex(texts, _LOOSE).to_numpy(zero_copy_only=False).astype(bool)
    loose |= pc.equal(texts, "").to_numpy(zero_copy_only=False).astype(bool)
    special = np.zeros(n, bool)
    for string in _added(tok):
        special |= pc.match_substring(texts, string).to_numpy(zero_copy_only=False).astype(bool)
    loose |= special
    lists = pc.split_pattern(texts.filter(pa.array(~loose)), " ")
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    words = coded.dictionary
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]

    def encode_spaced(new: pa.Array) -> pa.Array:
        """Ids of words behind a space, many to a string: a token with a space
        begins a word."""
        out, begins = [pa.array([], pa.large_binary())], _begins(spec)
        for at in range(0, len(new), WORDS_AT_ONCE * STRINGS_AT_ONCE):
            part = new.slice(at, WORDS_AT_ONCE * STRINGS_AT_ONCE).cast(pa.string())
            cuts = np.append(np.arange(0, len(part), WORDS_AT_ONCE), len(part))
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), part), " ")
            ids = np.concatenate(encode([f" {j}" for j in joined.to_pylist()]))
            bounds = np.flatnonzero(begins[ids])
            if len(bounds) == len(part):
                out.append(_id_bytes(ids, bounds))
            else:
                out.append(one_by_one(encode([f" {w}" for w in part.to_pylist()])))
        return pa.concat_arrays(out)

    # distinct words behind a space; those met in earlier blocks are known
    places, ids = known_words(spec).places(words, encode_spaced)
    # the first word of a text stands without a space; loose texts are one unit each
    heads = offsets[:-1]
    own = words.take(pa.array(codes[heads])).to_pylist()
    alone = encode(own + texts.filter(pa.array(loose)).to_pylist())
    for i, place in enumerate(np.flatnonzero(special[loose]).tolist()):
        if not i:
            whole = encode(texts.filter(pa.array(special)).to_pylist(), load_tokenizer(spec))
        alone[len(own) + place] = whole[i]
    at = places[codes]
    at[heads] = len(ids) + np.arange(len(heads))

    units = np.zeros(n, np.int64)
    units[~loose] = np.diff(offsets)
    units[loose] = 1
    unit_ends = np.concatenate([[0], np.cumsum(units)])
    order = np.empty(unit_ends[-1], np.int64)
    is_loose = np.repeat(loose, units)
    order[~is_loose] = at
    order[is_loose] = len(ids) + len(heads) + np.arange(int(loose.sum()))
    taken = pa.concat_arrays([ids, one_by_one(alone)]).take(pa.array(order))
    ends = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1) // 4
    flat = np.frombuffer(taken.buffers()[2], np.int32, ends[-1]) if ends[-1] else np.zeros(0, np.int32)
    return flat, ends[unit_ends]


def write_store(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id",
                text_col: str = "text", end_id: int = 2) -> None:
    """Encode every text (null: empty), append ``end_id`` and write the store.

    Rows are in ascending id order (null ids first; rows of one id by a hash of
    their texts, which splits an id of many rows over files), within files and
    from file to file.  Other columns are not stored.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, first = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in blocks(batch, ["text"]):
                ids, ends = encode_texts(part.column("text"), spec)
                rows = np.arange(len(ends) - 1)
                ids = np.insert(ids, ends[1:], end_id)     # one more after each text
                ends = ends + np.arange(len(ends))
                n = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, file)), part.column("doc_id"),
                     pa.array(first + ends[:-1]), pa.array(np.diff(ends)),
                     pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))],
                    names=["file", "doc_id", "first", "n_tokens", "ids"])
                first += int(ends[-1])

    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    source = source.withColumn("tie", F.xxhash64("text"))
    (source.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
     .drop("tie").mapInArrow(encoded, SCHEMA).write
     .option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.enable.dictionary", "true")
     .option("parquet.enable.dictionary#doc_id", "false")
     .option("parquet.enable.dictionary#first", "false")
     .option("parquet.enable.dictionary#n_tokens", "false")
     .option("parquet.block.size", ROW_GROUP_BYTES)
     .option("parquet.page.row.count.limit", PAGE_ROWS)
     .option("compression", "zstd").parquet(path))


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a store as written; select and filter before use, since only
    the columns and pages asked for are read."""
    return spark.read.schema(SCHEMA).parquet(path)


def starts(store: DataFrame) -> DataFrame:
    """Tokens before each file: (file, before).  One row per file, so the
    running sum over all files is a small one."""
    files = store.groupBy("file").agg(F.max(F.col("first") + F.col("n_tokens")).alias("n"))
    running = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    return files.select("file", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("before"))


def checksums(store: DataFrame) -> DataFrame:
    """Per row of a store: doc_id, start (ids of all rows before it), n_tokens
    and ids_crc32 (of the ids as little-endian unsigned 32-bit integers)."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4").tobytes()
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())]) * 4
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("file", "doc_id", "first", "n_tokens")]
                + [pa.array(crc, pa.int64())],
                names=["file", "doc_id", "first", "n_tokens", "ids_crc32"])

    # one row per file of the store
    before = F.broadcast(starts(store.select("file", "first", "n_tokens")))
    return (store.mapInArrow(summed, "file bigint, doc_id bigint, first bigint, n_tokens bigint, "
                                     "ids_crc32 bigint")
            .join(before, "file").select("doc_id", (F.col("first") + F.col("before")).alias("start"),
                                         "n_tokens", "ids_crc32"))
