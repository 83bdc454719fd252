"""SentencePiece encoding and decoding by batched Viterbi search in numpy.

A text is cut into words before every run of spaces.  The distinct words of a
block are grouped by length and advance together: for every piece length the
polynomial hashes of all substrings are probed in the sorted hashes of the
pieces, and each position takes the best-scoring last piece by a vectorised
maximum, which stores the backpointer.  Characters without a piece fall back
to byte pieces.
"""

from __future__ import annotations

import struct
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.llm.common import blocks

SPACE = "▁"
#: Kinds of pieces in a model file (fixed values of the format).
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: A character without a piece scores so much less than the lowest piece.
PENALTY = 10.0
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Characters of the words that are searched at once.
AT_ONCE = 1 << 18
#: Pieces that are decoded at once (one text at least).
PIECES_AT_ONCE = 1 << 18
#: Places of a word whose pieces are looked up at once.
SLICE = 1 << 13
_NO_PIECE = np.iinfo(np.int32).min


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of every field of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 2:
            size = varint()
            yield key >> 3, data[at:at + size]
            at += size
        else:
            size = 8 if kind == 1 else 4
            yield key >> 3, data[at:at + size]
            at += size


@dataclass
class Pieces:
    """Vocabulary of a model file, as tables for search and decoding."""

    names: list[str]
    kinds: np.ndarray
    keys: np.ndarray           # sorted hashes of the searchable pieces
    ids: np.ndarray            # their ids
    scores: np.ndarray         # their scores
    longest: int
    unknown: int
    lowest: float
    byte_ids: np.ndarray       # id of every byte piece (-1: none)
    prefix: bool
    spelled: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None


def _hash_codes(codes: np.ndarray) -> np.ndarray:
    """Polynomial hashes of code-point rows, with the length mixed in."""
    out = np.full(len(codes), codes.shape[1], np.uint64)
    for j in range(codes.shape[1]):
        out = out * _BASE + codes[:, j].astype(np.uint64) + np.uint64(1)
    return out


def load_pieces(model: bytes) -> Pieces:
    """Read pieces, scores and kinds of a serialised model."""
    names, scores, kinds, prefix = [], [], [], True
    for number, value in _fields(model):
        if number == 1:
            piece = dict(_fields(value))
            names.append(piece[1].decode())
            scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            kinds.append(piece.get(3, NORMAL))
        elif number == 3:
            normaliser = dict(_fields(value))
            prefix = bool(normaliser.get(3, 1))
            if normaliser.get(2) or normaliser.get(4, 1):
                raise ValueError("only models without normalisation rules are supported")
    kinds = np.array(kinds)
    usable = [i for i, (n, t) in enumerate(zip(names, kinds.tolist(), strict=True))
              if t in (NORMAL, USER) and n]
    if any(SPACE in names[i].lstrip(SPACE) for i in usable):
        raise ValueError("pieces that reach over a space are not supported")
    hashes = np.zeros(len(usable), np.uint64)
    by_length: dict[int, list[int]] = {}
    for at, i in enumerate(usable):
        by_length.setdefault(len(names[i]), []).append(at)
    for places in by_length.values():
        hashes[places] = _hash_codes(np.array([[ord(c) for c in names[usable[p]]]
                                               for p in places]))
    order = np.argsort(hashes)
    if len(np.unique(hashes)) < len(hashes):
        raise ValueError("two pieces share a hash")
    own = np.array([scores[i] for i in usable])
    byte_ids = np.full(256, -1)
    for i in np.flatnonzero(kinds == BYTE).tolist():
        byte_ids[int(names[i][1:-1], 16)] = i
    unknown = np.flatnonzero(kinds == UNKNOWN)
    return Pieces(names, kinds, hashes[order], np.array(usable)[order], own[order],
                  max(by_length, default=1), int(unknown[0]) if len(unknown) else 0,
                  float(own.min()) - PENALTY if len(own) else -PENALTY, byte_ids, prefix)


def _pieces(model: bytes) -> Pieces:
    """Loaded once per worker process."""
    loaded = sys.__dict__.setdefault("_tradelake_pieces", {})
    if model not in loaded:
        loaded.clear()
        loaded[model] = load_pieces(model)
    return loaded[model]


def _entries(words: np.ndarray, first: int, last: int, longest: int, p: Pieces
             ) -> tuple[np.ndarray, np.ndarray]:
    """Score and id of the piece of every length that starts at each place from
    ``first`` to before ``last``, found by hash."""
    n, length = words.shape
    gain = np.full((longest + 1, n, last - first), -np.inf)
    entry = np.full((longest + 1, n, last - first), -1)
    rolled = np.zeros((n, last - first), np.uint64)
    for m in range(1, longest + 1):
        span = min(last, length - m + 1) - first
        if span <= 0:
            break
        rolled = (rolled[:, :span] * _BASE + words[:, first + m - 1:first + m - 1 + span]
                  .astype(np.uint64) + np.uint64(1))
        # the length enters as the leading coefficient
        key = rolled + np.uint64(m * pow(int(_BASE), m, 1 << 64) % (1 << 64))
        if len(p.keys):
            at = np.minimum(np.searchsorted(p.keys, key.ravel()), len(p.keys) - 1).reshape(key.shape)
            hit = p.keys[at] == key
            gain[m, :, :span][hit] = p.scores[at[hit]]
            entry[m, :, :span][hit] = p.ids[at[hit]]
    none = entry[1] < 0
    gain[1][none] = p.lowest
    entry[1][none] = -1 - words[:, first:last][none]
    return gain, entry


def _search(words: np.ndarray, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Viterbi over words of one length (rows of code points): flat piece ids
    and their number per word.  An id of -1 - c is character c without a piece.

    Long words are searched in slices: entries are held for one slice and the
    places before it that a piece can reach back to.
    """
    n, length = words.shape
    longest = min(p.longest, length)
    score = np.full((n, length + 1), -np.inf)
    score[:, 0] = 0.0
    back = np.zeros((n, length + 1), np.int32)            # length of the last piece
    piece = np.zeros((n, length + 1), np.int32)
    rows = np.arange(n)
    gain, entry = (np.zeros((longest + 1, n, 0), t) for t in (float, int))
    for first in range(0, length, SLICE):
        last, kept = min(length, first + SLICE), gain.shape[2]
        more = _entries(words, first, last, longest, p)
        gain, entry = more if not kept else (
            np.concatenate(x, 2) for x in zip((gain, entry), more, strict=True))
        origin = first - kept
        for end in range(first + 1, last + 1):
            sizes = np.arange(1, min(longest, end) + 1)
            total = score[:, end - sizes] + gain[sizes, :, end - sizes - origin].T
            best = total.argmax(1)
            score[:, end] = total[rows, best]
            back[:, end] = best + 1
            piece[:, end] = entry[best + 1, rows, end - best - 1 - origin]
        if last < length:
            gain, entry = gain[:, :, -longest:].copy(), entry[:, :, -longest:].copy()
    place = np.full(n, length)
    found = []
    while (place > 0).any():
        live = place > 0
        found.append(np.where(live, piece[rows, place], _NO_PIECE))
        place = place - np.where(live, back[rows, place], 0)
    path = np.stack(found[::-1], 1) if found else np.zeros((n, 0), np.int32)
    used = path != _NO_PIECE
    return path[used].astype(np.int64), used.sum(1)


def encode_words(words: list[str], p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of every word: (flat ids, offsets)."""
    lengths = np.array([len(w) for w in words], np.int64)
    out: list = [np.zeros(0, np.int64)] * len(words)
    for length in np.unique(lengths[lengths > 0]).tolist():
        places = np.flatnonzero(lengths == length)
        step = max(1, AT_ONCE // (length * min(length, p.longest)))
        for at in range(0, len(places), step):
            own = places[at:at + step]
            codes = np.frombuffer("".join(words[i] for i in own.tolist()).encode(
                "utf-32-le", "surrogatepass"), np.uint32).reshape(len(own), length)
            flat, counts = _search(codes.astype(np.int64), p)
            if (flat < 0).any():
                flat, counts = _fallback(flat, counts, p)
            for i, ids in zip(own.tolist(), np.split(flat, np.cumsum(counts)[:-1]), strict=True):
                out[i] = ids
    ends = np.concatenate([[0], np.cumsum([len(o) for o in out], dtype=np.int64)])
    return np.concatenate([np.zeros(0, np.int64), *out]), ends


def _fallback(flat: np.ndarray, counts: np.ndarray, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Byte pieces for characters without a piece, or one unknown for a run."""
    owner = np.repeat(np.arange(len(counts)), counts)
    ids, words, before = [], [], (-1, False)
    for i, w in zip(flat.tolist(), owner.tolist(), strict=True):
        if i >= 0:
            own = [i]
        else:
            own = p.byte_ids[list(chr(-1 - i).encode("utf-8", "surrogatepass"))].tolist()
            if min(own) < 0:
                own = [] if before == (w, True) else [p.unknown]
        before = (w, i < 0)
        ids += own
        words += [w] * len(own)
    return np.array(ids, np.int64), np.bincount(np.array(words, np.int64), minlength=len(counts))


def encode_texts(texts: pa.Array, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of every text (null: none): (flat ids, offsets)."""
    texts = pc.fill_null(texts, "")
    lists = pc.split_pattern(texts, " ")
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    names = coded.dictionary.to_pylist()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    blank = np.array([w == "" for w in names], bool)[codes] if len(codes) else np.zeros(0, bool)
    first = np.zeros(len(codes), bool)
    first[offsets[:-1]] = True
    last = np.zeros(len(codes), bool)
    last[offsets[1:] - 1] = True
    empty = pc.equal(texts, "").to_numpy(zero_copy_only=False).astype(bool)
    # spaces before each part: one each, none before the first unless the model adds one
    marks = np.where(first, int(p.prefix), 1)
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    keep = ~empty[owner] if len(owner) else np.zeros(0, bool)
    # a blank part hands its spaces to the next one; at the end they are a word
    unit_at = np.flatnonzero(keep & (~blank | last))
    runs = np.concatenate([[0], np.cumsum(np.where(keep, marks, 0))])
    begin = np.concatenate([[0], unit_at[:-1] + 1]) if len(unit_at) else unit_at
    spaces = runs[unit_at + 1] - runs[begin]
    pair = spaces * max(1, len(names)) + codes[unit_at]
    distinct, which = np.unique(pair, return_inverse=True)
    words = [SPACE * int(v // len(names)) + names[int(v % len(names))] for v in distinct.tolist()]
    flat, ends = encode_words(words, p)
    size = np.diff(ends)[which] if len(which) else np.zeros(0, np.int64)
    stops = np.concatenate([[0], np.cumsum(size)])
    take = np.repeat(ends[:-1][which] - stops[:-1], size) + np.arange(stops[-1]) if len(which) \
        else np.zeros(0, np.int64)
    per_text = np.bincount(owner[unit_at], minlength=len(texts)) if len(unit_at) \
        else np.zeros(len(texts), np.int64)
    return flat[take].astype(np.int32), stops[np.concatenate([[0], np.cumsum(per_text)])]


def _spelling(p: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all pieces one after the other, their starts and lengths."""
    parts = [b"" if k == CONTROL else bytes([int(n[1:-1], 16)]) if k == BYTE
             else b" \xe2\x81\x87 " if k == UNKNOWN else n.replace(SPACE, " ").encode()
             for n, k in zip(p.names, p.kinds.tolist(), strict=True)]
    sizes = np.array([len(x) for x in parts])
    return (np.frombuffer(b"".join(parts), np.uint8),
            np.concatenate([[0], np.cumsum(sizes)])[:-1], sizes)


def decode_ids(flat: np.ndarray, ends: np.ndarray, p: Pieces) -> list[str]:
    """Texts of id lists: pieces joined, byte pieces as UTF-8, spaces restored
    and the added first one taken off; control pieces give nothing."""
    if p.spelled is None:
        p.spelled = _spelling(p)
    pool, begin, sizes = p.spelled
    own = sizes[flat] if len(flat) else np.zeros(0, np.int64)
    stops = np.concatenate([[0], np.cumsum(own)])
    data = pool[np.repeat(begin[flat] - stops[:-1], own) + np.arange(stops[-1])].tobytes() \
        if len(flat) else b""
    texts = [data[stops[a]:stops[b]].decode("utf-8", "replace")
             for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
    return [t[1:] if p.prefix and t.startswith(" ") else t for t in texts]


def encode(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``pieces`` (array<int>), the best-scoring segmentation of the
    whole text; null and empty texts have none.  ``pieces`` is replaced."""
    with open(model_path, "rb") as f:
        model = f.read()
    kept = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c != "pieces"))
    schema = T.StructType([*kept.schema.fields, T.StructField("pieces", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = _pieces(model)
        for batch in batches:
            for part in blocks(batch, [text_col]):
                flat, ends = encode_texts(part.column(text_col), p)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)),
                                                             pa.array(flat))],
                    names=[*part.schema.names, "pieces"])

    return kept.mapInArrow(run, schema)


def decode(encoded: DataFrame, model_path: str, pieces_col: str = "pieces") -> DataFrame:
    """``encoded`` with ``decoded``, the text of the pieces (null pieces: "")."""
    with open(model_path, "rb") as f:
        model = f.read()
    kept = encoded.select(*(F.col(f"`{c}`") for c in encoded.columns if c != "decoded"))
    schema = T.StructType([*kept.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = _pieces(model)
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(pieces_col)), 0)
            ends = np.concatenate([[0], np.cumsum(sizes.to_numpy(zero_copy_only=False))])
            start = 0
            while start < batch.num_rows:
                stop = max(start + 1, int(np.searchsorted(
                    ends, ends[start] + PIECES_AT_ONCE, side="right")) - 1)
                part = batch.slice(start, stop - start)
                flat = part.column(pieces_col).flatten().to_numpy(zero_copy_only=False)
                texts = decode_ids(flat, ends[start:stop + 1] - ends[start], p)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())],
                                                 names=[*part.schema.names, "decoded"])
                start = stop

    return kept.mapInArrow(run, schema)
