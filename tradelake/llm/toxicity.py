"""Toxic passages as maximum-scoring segments of token log-odds.

Tokens and their beginnings get log-odds of occurring in toxic against other
texts, smoothed by a Dirichlet prior.  A token whose own form or beginning is
significantly toxic takes the largest of these; all others share a small
negative score, so a text is a walk with negative drift.  A linear-time scan finds all maximal segments; an
extreme-value law for the walk's best segment tells which are significant
and makes scores of short and long texts comparable, and a logistic
calibration on labelled texts turns them into probabilities.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.llm.common import blocks, split_words, text_bytes, written

#: Bound of the fit: labelled rows.
SAMPLE_ROWS = 20_000
#: Dirichlet prior of a form: a flat part and a part in proportion to its joint
#: count; standard errors above 0 that the log-odds of a toxic form need.
FLAT, PRIOR = 0.5, 200.0
MIN_Z = 3.3
#: Characters of the beginnings of a token that count as forms of their own.
BEGINNINGS = range(4, 9)
EULER = 0.5772156649

_TABLE = np.full(256, 32, np.uint8)      # ASCII other than letters and digits: space
_TABLE[128:] = np.arange(128, 256)
_TABLE[48:58] = np.arange(48, 58)
_TABLE[97:123] = _TABLE[65:91] = np.arange(97, 123)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Tokens (runs of letters, digits and non-ASCII; A-Z lower-cased) as by
    ``split_words``; null texts have none."""
    data, offsets = text_bytes(pc.fill_null(texts, ""))
    plain = pa.Array.from_buffers(pa.string(), len(texts), [
        None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(_TABLE[data])])
    return split_words(plain)


def forms(word: str) -> list[str]:
    """A token and its beginnings."""
    return [word, *(f"{word[:k]}*" for k in BEGINNINGS if k < len(word))]


@dataclass
class ToxicModel:
    scores: dict[str, float] = field(default_factory=dict)
    other: float = -0.1
    decay: float = 1.0            # lambda of the extreme-value law
    log_k: float = 0.0
    weights: tuple[float, ...] = (-3.0, 0.0, 0.0, 0.0)

    def walk(self, codes: np.ndarray, words: pa.Array) -> np.ndarray:
        """Score of every token."""
        get, none = self.scores.get, -math.inf
        best = [max(get(f, none) for f in forms(w)) for w in words.to_pylist()]
        values = np.array([self.other if b == none else b for b in best] or [0.0])
        return values[codes] if len(codes) else np.zeros(0)


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (from, to, score) of a sequence, left to
    right, in linear time.

    Candidates are kept with the running sums at both ends, and a new one
    swallows those that it outgrows.  Each also knows the nearest earlier one
    with a lower sum at its beginning, where its own search ended, so a search
    goes from one such to the next and passes no candidate twice.
    """
    out: list[tuple[int, int, float, float, int]] = []
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    for i in np.flatnonzero(scores > 0).tolist():
        start, low, total, j = i, float(sums[i]), float(sums[i + 1]), len(out) - 1
        while True:
            while j >= 0 and out[j][2] >= low:
                j = out[j][4]
            if j < 0 or out[j][3] >= total:
                break
            start, low, lower = out[j][0], out[j][2], out[j][4]
            del out[j:]
            j = lower
        out.append((start, i + 1, low, total, j))
    return [(a, b, high - low) for a, b, low, high, _ in out]


def features(texts: pa.Array, model: ToxicModel) -> tuple[np.ndarray, list[list]]:
    """Per text: normalised best segment, number of significant segments and
    their summed bits; and the significant segments (from, to, score)."""
    codes, offsets, words = tokens(texts)
    walk = model.walk(codes, words)
    toxic = np.concatenate([[0], np.cumsum(walk > 0)])
    out, passages = np.zeros((len(texts), 3)), [[] for _ in range(len(texts))]
    for i in np.flatnonzero(toxic[offsets[1:]] > toxic[offsets[:-1]]).tolist():
        own = walk[offsets[i]:offsets[i + 1]]
        found = maximal_segments(own)
        bits = np.array([model.decay * s - model.log_k - math.log(len(own)) for _, _, s in found])
        best = float(bits.max())
        # P(best >= bits) = 1 - exp(-exp(-bits)); significant below 5 %
        strong = [f for f, b in zip(found, bits, strict=True) if b > 2.97]
        passages[i] = strong
        out[i] = (max(0.0, best + 10.0), len(strong), max(0.0, float(bits[bits > 0].sum())))
    return np.log1p(out), passages


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Ridge logistic regression by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + 1e-2 * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w -= np.linalg.solve(hess, grad)
    return tuple(w.tolist())


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> ToxicModel:
    """Learn from at most SAMPLE_ROWS rows of ``labels`` (null ids and labels are
    left out, repeated ids count once, by their largest label and first text)."""
    bounded = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
               .dropna().groupBy("id").agg(F.max("y").alias("y"))
               .orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS))
    # one text an id (the first in order), so the bound holds for rows too
    train = written(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
                    .join(F.broadcast(bounded), "id").groupBy("id", "y")
                    .agg(F.min("text").alias("text")).select("text", "y"), "toxic-train")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, ["text"]):
                codes, offsets, words = tokens(part.column("text"))
                every = [forms(w) for w in words.to_pylist()]
                coded = pa.array([f for own in every for f in own],
                                 pa.string()).dictionary_encode()
                names = coded.dictionary
                ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                ends = np.concatenate([[0], np.cumsum([len(own) for own in every])]).astype(int)
                doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
                size = np.diff(ends)[codes]
                at = np.repeat(ends[codes] - np.cumsum(size) + size, size) + np.arange(size.sum())
                width = max(1, len(names))
                pair = np.unique(np.repeat(doc, size) * width + ids[at])   # once a text
                toxic = part.column("y").to_numpy()[pair // width] == 1
                yes = np.bincount(pair[toxic] % width, minlength=len(names))
                no = np.bincount(pair[~toxic] % width, minlength=len(names))
                yield pa.RecordBatch.from_arrays([names, pa.array(yes, pa.int64()), pa.array(
                    no, pa.int64())], names=["word", "yes", "no"])

    counts = written(train.mapInArrow(count, "word string, yes bigint, no bigint")
                     .groupBy("word").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
                     .filter("yes + no > 0"), "toxic-counts")
    n1, n0 = (float(v or 0) for v in counts.agg(F.sum("yes"), F.sum("no")).first())
    if not n1 or not n0:
        return ToxicModel()
    prior = F.lit(FLAT) + F.lit(PRIOR) * (F.col("yes") + F.col("no")) / (n1 + n0)
    a, b = F.col("yes") + prior, F.col("no") + prior
    odds = F.log(a / (n1 + PRIOR - a)) - F.log(b / (n0 + PRIOR - b))
    # forms of the bounded sample
    chosen = (counts.select("word", "yes", "no", odds.alias("odds"),
                            (odds / F.sqrt(1 / a + 1 / b)).alias("z"))
              .filter(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "word").collect())
    if not chosen:
        return ToxicModel()
    q1, q0 = (sum(r[c] for r in chosen) / n for c, n in (("yes", n1), ("no", n0)))
    model = ToxicModel({r["word"]: r["odds"] for r in chosen})
    model.other = min(-0.01, math.log((1 - q1) / (1 - q0)))
    weights = np.array([max(r["no"], 0.5) / n0 for r in chosen])
    steps = np.array([r["odds"] for r in chosen])
    if float(weights @ steps) + (1 - weights.sum()) * model.other >= 0:   # keep the drift negative
        model.other = -1.5 * float(weights @ steps) / max(1e-9, 1 - weights.sum())
    low, high = 1e-6, 50.0
    for _ in range(200):                # the positive root of E[exp(lambda * score)] = 1
        mid = (low + high) / 2
        grown = float(weights @ np.exp(np.minimum(mid * steps, 500.0)))
        if grown + (1 - weights.sum()) * math.exp(mid * model.other) > 1:
            high = mid
        else:
            low = mid
    model.decay = (low + high) / 2

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, ["text"]):
                codes, offsets, words = tokens(part.column("text"))
                walk = model.walk(codes, words)
                top = [max((s for _, _, s in maximal_segments(walk[i:j])), default=0.0)
                       for i, j in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(top, pa.float64()), pa.array(np.diff(offsets), pa.int64()),
                     part.column("y")], names=["top", "n", "y"])

    # mean of the law over clean texts with a positive segment: (log K n + gamma) / lambda
    shift = (train.mapInArrow(best, "top double, n bigint, y int").filter("y = 0 and top > 0")
             .agg(F.avg(F.lit(model.decay) * F.col("top") - F.log("n"))).first()[0])
    model.log_k = (shift if shift is not None else 0.0) - EULER

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, ["text"]):
                x, _ = features(part.column("text"), model)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[:, i]) for i in range(3)] + [part.column("y")],
                    names=["a", "b", "c", "y"])

    rows = train.mapInArrow(table, "a double, b double, c double, y int").orderBy(
        "a", "b", "c", "y").collect()
    model.weights = _logistic(np.array([r[:3] for r in rows]), np.array([float(r[3]) for r in rows]))
    return model


def score(docs: DataFrame, model: ToxicModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (probability of a toxic label) and ``passages``
    (significant toxic segments: first token, token after the last, score).

    Null and empty texts have no passage and the score of a text without
    toxic tokens.  Columns of these names are replaced.
    """
    others = [c for c in docs.columns if c not in ("score", "passages")]
    kept = docs.select(*(F.col(f"`{c}`") for c in others))
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType()),
                          T.StructField("passages", T.ArrayType(T.StructType([
                              T.StructField("first", T.IntegerType()),
                              T.StructField("last", T.IntegerType()),
                              T.StructField("score", T.DoubleType())])))])
    shape = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()),
                                ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.array(model.weights)
        for batch in batches:
            for part in blocks(batch, [text_col]):
                x, passages = features(part.column(text_col), model)
                p = 1 / (1 + np.exp(-np.clip(x @ w[1:] + w[0], -30, 30)))
                found = [[{"first": a, "last": b, "score": s} for a, b, s in own]
                         for own in passages]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(p), pa.array(found, shape)],
                    names=[*part.schema.names, "score", "passages"])

    return kept.mapInArrow(run, schema)
