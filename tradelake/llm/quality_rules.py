"""Quality classifier as a sparse rule ensemble over text statistics.

Small boosted trees are grown on a bounded sample of labelled texts; every
path from a root is a conjunctive rule, rules get weights by a lasso logistic
fit, and those left are compiled into one Spark column expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.llm.common import blocks, split_words, text_bytes, window_hashes, written

#: Bound of the fit: labelled rows.
SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS, LASSO = 24, 3, 32, 0.002

STATISTICS = ("n_bytes", "n_words", "word_bytes", "upper", "digit", "symbol", "pipe", "exclaim",
              "stop", "line_break", "non_ascii", "unique_words", "unique_runs", "unique_lines",
              "line_words", "long_words")
_CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789",
            "symbol": b"#$%&*@^~_=+<>\\{}[]`", "pipe": b"|/", "exclaim": b"!?",
            "stop": b".,;:", "line_break": b"\n"}


def _distinct(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Share of distinct values of each text (1 without values)."""
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    return np.where(sizes > 0, np.bincount(o[new], minlength=len(sizes)) / np.maximum(sizes, 1), 1.0)


def statistics(texts: pa.Array) -> np.ndarray:
    """STATISTICS of every text (null: as empty), one row each."""
    texts = pc.fill_null(texts, "")
    data, ends = text_bytes(texts)
    sizes = np.diff(ends)
    kinds = np.zeros(256, np.uint8)
    for i, chars in enumerate(_CLASSES.values(), 1):
        kinds[list(chars)] = i
    kinds[128:] = len(_CLASSES) + 1
    owner = np.repeat(np.arange(len(sizes)), sizes)
    shares = np.bincount(owner * 16 + kinds[data], minlength=len(sizes) * 16).reshape(-1, 16) \
        / np.maximum(sizes, 1)[:, None]
    codes, offsets, words = split_words(texts, lower=True)
    counts = np.diff(offsets)
    lengths = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    own = lengths[codes] if len(codes) else np.zeros(0, np.int64)
    sums = np.concatenate([[0], np.cumsum(own > 14)])
    marks = codes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1)
    rolled, starts = window_hashes(marks, offsets, 3)
    lists = pc.split_pattern(texts, "\n")
    lines = lists.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    bounds = lists.offsets.to_numpy().astype(np.int64)
    bounds -= bounds[0]
    many = np.maximum(counts, 1)
    return np.column_stack([
        sizes, counts, sizes / many, shares[:, 1:len(_CLASSES) + 2],
        _distinct(codes, offsets), _distinct(rolled, np.searchsorted(starts, offsets)),
        _distinct(lines, bounds), counts / np.maximum(np.diff(bounds), 1),
        (sums[offsets[1:]] - sums[offsets[:-1]]) / many]).astype(np.float64)


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus a column ``stats``, array<double> in the order of STATISTICS
    (a column of this name is replaced)."""
    kept = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c != "stats"))
    schema = T.StructType([*kept.schema.fields, T.StructField("stats", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, [text_col]):
                x = statistics(part.column(text_col))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.ListArray.from_arrays(
                        pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))],
                    names=[*part.schema.names, "stats"])

    return kept.mapInArrow(run, schema)


#: A rule: conditions (statistic index, "<=" or ">", threshold) that all hold.
Rule = tuple[tuple[int, str, float], ...]


@dataclass
class RuleEnsemble:
    rules: list[Rule]
    weights: list[float]
    intercept: float

    def column(self, stats: Column) -> Column:
        """The probability as an expression over a ``stats`` array."""
        total = F.lit(float(self.intercept))
        for rule, weight in zip(self.rules, self.weights, strict=True):
            holds = F.lit(True)
            for i, op, at in rule:
                value = stats[i]
                holds = holds & ((value <= F.lit(at)) if op == "<=" else (value > F.lit(at)))
            total = total + F.when(holds, F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _grow(binned: np.ndarray, cuts: list[np.ndarray], grad: np.ndarray, hess: np.ndarray,
          rows: np.ndarray, path: Rule, depth: int, found: list, step: np.ndarray) -> None:
    """Grow one tree by second-order gain; adds every path to ``found`` and the
    leaf values to ``step``."""
    if path:
        found.append(path)
    g, h = grad[rows], hess[rows]
    best = (1e-6, -1, 0)
    if depth and len(rows) >= 20:
        for f in range(binned.shape[1]):
            gs = np.cumsum(np.bincount(binned[rows, f], g, BINS + 1))[:-1]
            hs = np.cumsum(np.bincount(binned[rows, f], h, BINS + 1))[:-1]
            ns = np.cumsum(np.bincount(binned[rows, f], minlength=BINS + 1))[:-1]
            gain = gs ** 2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) \
                - g.sum() ** 2 / (h.sum() + 1)
            gain[(ns < 5) | (len(rows) - ns < 5)] = 0
            gain = gain[:len(cuts[f])]
            if len(gain) and gain.max() > best[0]:
                best = (float(gain.max()), f, int(gain.argmax()))
    _, f, cut = best
    if f < 0:
        step[rows] = -g.sum() / (h.sum() + 1)
        return
    low = binned[rows, f] <= cut
    at = float(cuts[f][cut])
    _grow(binned, cuts, grad, hess, rows[low], (*path, (f, "<=", at)), depth - 1, found, step)
    _grow(binned, cuts, grad, hess, rows[~low], (*path, (f, ">", at)), depth - 1, found, step)


def fit_rules(x: np.ndarray, y: np.ndarray) -> RuleEnsemble:
    """Boosted trees, their paths as rules, lasso logistic weights for the rules."""
    if not len(y) or y.min() == y.max():
        return RuleEnsemble([], [], 0.0 if not len(y) else (6.0 if y[0] else -6.0))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)])
    margin, found = np.zeros(len(y)), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        step = np.zeros(len(y))
        _grow(binned, cuts, p - y, p * (1 - p), np.arange(len(y)), (), DEPTH, found, step)
        margin += 0.5 * step
    rules, columns, seen = [], [], set()
    for rule in found:
        holds = np.logical_and.reduce([(x[:, f] <= at) if op == "<=" else (x[:, f] > at)
                                       for f, op, at in rule])
        if holds.tobytes() not in seen and (~holds).tobytes() not in seen:
            seen.add(holds.tobytes())
            rules.append(rule)
            columns.append(holds)
    if not rules:
        return RuleEnsemble([], [], float(np.log(y.mean() / (1 - y.mean()))))
    a = np.column_stack(columns).astype(np.float32)
    mean = a.mean(0)
    scale = np.maximum(a.std(0), 1e-3)
    a = (a - mean) / scale
    w, b, v, t = np.zeros(a.shape[1], np.float32), 0.0, None, 1.0
    rate = 4.0 * len(y) / float(np.linalg.norm(a, 2) ** 2 + len(y))
    ahead = w
    for _ in range(300):                  # proximal gradient with momentum
        p = 1 / (1 + np.exp(-np.clip(a @ ahead + b, -30, 30)))
        b -= float((p - y).mean())
        new = ahead - rate * (a.T @ (p - y).astype(np.float32)) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * LASSO, 0)
        t, old = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        ahead = new + (old - 1) / t * (new - w)
        w = new
    keep = np.flatnonzero(np.abs(w) > 1e-6)
    weights = (w / scale)[keep]
    return RuleEnsemble([rules[i] for i in keep], [float(v) for v in weights],
                        float(b - (w * mean / scale)[keep].sum()))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality") -> RuleEnsemble:
    """Learn from at most SAMPLE_ROWS rows of ``labels`` (null ids and labels are
    left out, repeated ids count once, by their smallest label and text)."""
    bounded = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
               .dropna().groupBy("id").agg(F.min("y").alias("y"))
               .orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS))
    # one text an id (the first in order), so the bound holds for rows too
    train = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(bounded), "id").groupBy("id", "y").agg(F.min("text").alias("text"))
    rows = written(with_statistics(train).select("id", "stats", "y"), "quality-train").orderBy(
        "id", "stats").collect()
    return fit_rules(np.array([r["stats"] for r in rows]).reshape(len(rows), len(STATISTICS)),
                     np.array([float(r["y"]) for r in rows]))


def score(docs: DataFrame, model: RuleEnsemble, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score``, the probability of good quality, by the compiled
    rules.  Null texts are scored as empty ones.  ``stats`` and ``score`` of
    the input are replaced."""
    return (with_statistics(docs.drop("score"), text_col)
            .withColumn("score", model.column(F.col("stats"))).drop("stats"))
