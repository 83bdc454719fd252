"""Language identification with a byte convolutional network.

Filters of several widths slide over the UTF-8 bytes of fixed-length windows;
their rectified maxima over a window feed a softmax.  Training is plain numpy
on a bounded sample of labelled texts.  A filter over one-hot bytes is a sum
of table rows, so in tasks two neighbouring bytes are looked up at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.llm.common import blocks, text_bytes

WINDOW = 96
WIDTHS = (2, 3, 4)
FILTERS = 8
#: Bound of the training sample: rows per language, on average.  Their texts are
#: read whole, and every language has its rows.
PER_LANGUAGE = 300


@dataclass
class ByteNet:
    languages: list[str]
    tables: list[np.ndarray]      # per width: (width, 256, FILTERS)
    bias: np.ndarray              # (len(WIDTHS) * FILTERS,)
    weights: np.ndarray           # (len(WIDTHS) * FILTERS, languages)
    offset: np.ndarray            # (languages,)


def byte_windows(texts: pa.Array, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Zero-padded windows over all bytes of each text: (windows, text index)."""
    texts = pc.fill_null(texts, "")
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    counts = np.maximum(1, -(-sizes // window))
    flat = text_bytes(texts)[0]
    first = np.concatenate([[0], np.cumsum(counts)])
    out = np.zeros(first[-1] * window, np.uint8)
    begin = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    out[np.arange(len(flat)) + np.repeat(first[:-1] * window - begin, sizes)] = flat
    return out.reshape(-1, window), np.repeat(np.arange(len(sizes)), counts)


def train(texts: list[str], labels: list[str], epochs: int = 4, least_steps: int = 400,
          batch: int = 256, rate: float = 0.01, seed: int = 20) -> ByteNet | None:
    """Fit the network by Adam on windows of the texts, in ``epochs`` rounds or
    more until ``least_steps`` are made; None without texts."""
    languages = sorted(set(labels))
    if not languages:
        return None
    x, owner = byte_windows(pa.array(texts, pa.string()))
    y = np.array([languages.index(v) for v in labels])[owner]
    rng = np.random.default_rng(seed)
    total = len(WIDTHS) * FILTERS
    net = ByteNet(languages, [rng.normal(0, 0.3, (w, 256, FILTERS)) for w in WIDTHS],
                  np.zeros(total), rng.normal(0, 0.3, (total, len(languages))),
                  np.zeros(len(languages)))
    params = [*net.tables, net.bias, net.weights, net.offset]
    moment = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    span, step = WINDOW - max(WIDTHS) + 1, 0
    rounds = max(epochs, -(-least_steps * batch // max(1, len(x))))
    rounds = min(rounds, least_steps)
    for _ in range(rounds):
        order = rng.permutation(len(x))
        for at in range(0, len(x), batch):
            xb, yb = x[order[at:at + batch]], y[order[at:at + batch]]
            pooled, where = [], []
            for w, table in zip(WIDTHS, net.tables, strict=True):
                pre = sum(table[o][xb[:, o:o + span]] for o in range(w))
                where.append(pre.argmax(1))
                pooled.append(pre.max(1))
            raw = np.concatenate(pooled, 1) + net.bias
            hidden = np.maximum(raw, 0)
            logits = hidden @ net.weights + net.offset
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(yb)), yb] -= 1
            p /= len(yb)
            back = (p @ net.weights.T) * (raw > 0)
            grads = []
            rows = np.arange(len(yb))[:, None]
            for i, w in enumerate(WIDTHS):
                g = back[:, i * FILTERS:(i + 1) * FILTERS]
                grad = np.zeros_like(net.tables[i])
                for o in range(w):
                    np.add.at(grad[o], (xb[rows, where[i] + o], np.arange(FILTERS)[None, :]), g)
                grads.append(grad)
            grads += [back.sum(0), hidden.T @ p + 1e-4 * net.weights, p.sum(0)]
            step += 1
            for param, grad, (m, v) in zip(params, grads, moment, strict=True):
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                param -= rate * (m / (1 - 0.9 ** step)) / (
                    np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return net


class Scorer:
    """Window probabilities of a trained network from two-byte tables."""

    def __init__(self, net: ByteNet):
        two, three, four = (t.astype(np.float32) for t in net.tables)

        def pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
            return (left[:, None, :] + right[None, :, :]).reshape(65536, FILTERS)

        self.net = net
        self.pairs = np.concatenate([pairs(two[0], two[1]), pairs(three[0], three[1]),
                                     pairs(four[0], four[1]), pairs(four[2], four[3])], 1)
        self.third = np.ascontiguousarray(three[2])

    def __call__(self, windows: np.ndarray) -> np.ndarray:
        n, f, span = len(windows), FILTERS, WINDOW - max(WIDTHS) + 1
        wide = windows.astype(np.int32)
        looked = self.pairs[wide[:, :-1] * 256 + wide[:, 1:]]
        pooled = np.empty((n, 3 * f), np.float32)
        pooled[:, :f] = looked[:, :span, :f].max(1)
        pooled[:, f:2 * f] = (looked[:, :span, f:2 * f]
                              + self.third[windows[:, 2:2 + span]]).max(1)
        pooled[:, 2 * f:] = (looked[:, :span, 2 * f:3 * f]
                             + looked[:, 2:2 + span, 3 * f:]).max(1)
        logits = np.maximum(pooled + self.net.bias, 0) @ self.net.weights + self.net.offset
        p = np.exp(logits - logits.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)


def sample(docs: DataFrame, text_col: str, lang_col: str, order: Column) -> tuple[list, list]:
    """PER_LANGUAGE rows (on average) of every language, all of a rarer one, chosen
    by the hash ``order``, with their whole texts; twice as many in all at most."""
    labelled = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
                           F.pmod(order, F.lit(1_000_003)).alias("h")).filter(
        F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull())
    counts = labelled.groupBy("lang").count()
    share = {r["lang"]: min(1.0, PER_LANGUAGE / r["count"]) for r in counts.collect()}
    if not share:
        return [], []
    part = F.create_map(*(F.lit(v) for kv in share.items() for v in kv))[F.col("lang")]
    rows = (labelled.filter(F.col("h") < part * 1_000_003).orderBy("h", "text")
            .limit(2 * PER_LANGUAGE * len(share))
            .select("text", "lang").collect())
    return [r["text"] for r in rows], [r["lang"] for r in rows]


def predict(docs: DataFrame, net: ByteNet | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (mean window probability of it).

    All windows of the whole text count, by their bytes.  Null texts, texts
    without a letter, and all texts without a network are ``und`` with a
    score of 0.  Columns of these names are replaced.
    """
    others = [c for c in docs.columns if c not in ("lang_pred", "score")]
    kept = docs.select(*(F.col(f"`{c}`") for c in others))
    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()),
                          T.StructField("score", T.DoubleType())])
    letter = regex.compile(r"\p{L}").search

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net) if net else None
        for batch in batches:
            for part in blocks(batch, [text_col]):
                texts = part.column(text_col)
                lang, score = ["und"] * len(texts), np.zeros(len(texts))
                if scorer:
                    windows, owner = byte_windows(texts)
                    weight = (windows != 0).sum(1)
                    p = np.concatenate([scorer(windows[i:i + 1024])
                                        for i in range(0, len(windows), 1024)]
                                       or [np.zeros((0, len(net.languages)))])
                    first = np.flatnonzero(np.diff(owner, prepend=-1))
                    if len(first):
                        mean = np.add.reduceat(p * weight[:, None], first, axis=0) / np.maximum(
                            1, np.add.reduceat(weight, first))[:, None]
                        for i, t in enumerate(texts.to_pylist()):
                            if t and letter(t):
                                best = int(mean[i].argmax())
                                lang[i], score[i] = net.languages[best], min(1.0, mean[i][best])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(lang, pa.string()), pa.array(score)],
                    names=[*part.schema.names, "lang_pred", "score"])

    return kept.mapInArrow(run, schema)
