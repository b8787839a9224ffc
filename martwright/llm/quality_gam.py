"""Quality by a generalised additive model with pairwise interactions.

Each feature of a text is cut into quantile bins, and a score is the sum of one looked-up number per feature and per
chosen pair of features. The lookup tables are learned by boosting shallow trees in turn: every round visits all
features one after the other, fits a small tree to the loss gradient over that feature's bins alone, and adds a
fraction of it to the feature's table. Then the pairs whose joint bins explain most of what is left are boosted alike.

Features are made in one pass over whole texts and written to the shared folder; training takes a bounded sample of
labelled rows of them, and scoring is vectorised additions of table entries.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from .textkit import add_columns, bounded_sample, grams, slices, stage, text_buffers, words_of

FEATURES = (
    "log_words", "word_length", "upper", "digits", "symbols", "stops", "exclamations", "bars", "spaces", "wide",
    "distinct_words", "top_word", "repeated_runs", "same_as_previous", "log_line", "repeated_lines", "log_sentence",
    "short_words",
)
#: Bounds of training: labelled rows, rounds, bins of a feature alone and in a pair, pairs.
SAMPLE, ROUNDS, PAIR_ROUNDS, BINS, PAIR_BINS, PAIRS = 20_000, 150, 60, 32, 8, 8
RATE, LEAST_ROWS = 0.1, 5.0

_KINDS = {
    "upper": range(ord("A"), ord("Z") + 1),
    "digits": range(ord("0"), ord("9") + 1),
    "symbols": [ord(c) for c in "#*$%&<>@^~=_+\\/{}[]"],
    "stops": [ord(c) for c in ".,;:?"],
    "exclamations": [ord("!")],
    "bars": [ord("|")],
    "spaces": [ord(c) for c in " \t\r"],
    "wide": range(0xC0, 0x100),
    "lines": [ord("\n")],
    "ends": [ord(c) for c in ".!?"],
}


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """FEATURES of each text; all 0 for a text without characters."""
    base = int(offsets[0])
    raw = data[base : int(offsets[-1])]
    at = offsets - base
    words = words_of(data, offsets)
    n = np.diff(words.first).astype(np.float64)
    size = np.maximum(np.diff(at), 1).astype(np.float64)
    count = {}
    for name, members in _KINDS.items():
        table = np.zeros(256, np.int64)
        table[list(members)] = 1
        total = np.concatenate([[0], np.cumsum(table[raw])])
        count[name] = (total[at[1:]] - total[at[:-1]]).astype(np.float64)
    out = {name: count[name] / size for name in _KINDS if name in FEATURES}
    some = np.maximum(n, 1)
    length = (words.end - words.start).astype(np.float64)
    out["log_words"] = np.log1p(n)
    out["word_length"] = np.bincount(words.doc, length, len(n)) / some
    out["short_words"] = np.bincount(words.doc, length <= 2, len(n)) / some
    h = words.hashes()
    same = (h[1:] == h[:-1]) & (words.doc[1:] == words.doc[:-1]) if len(h) else np.empty(0, bool)
    out["same_as_previous"] = np.bincount(words.doc[1:][same], minlength=len(n)) / some if len(h) else np.zeros(len(n))
    runs = grams(h, 5, 41)
    distinct, top, repeated, lines_again = (np.zeros(len(n)) for _ in range(4))
    breaks = np.flatnonzero(raw == ord("\n"))
    for d in range(len(n)):
        a, b = int(words.first[d]), int(words.first[d + 1])
        if b > a:
            _, k = np.unique(h[a:b], return_counts=True)
            distinct[d], top[d] = len(k) / np.sqrt(b - a), k.max() / (b - a)
        if b - a >= 5:
            _, k = np.unique(runs[a : b - 4], return_counts=True)
            repeated[d] = (k[k > 1].sum()) / (b - a - 4)
        low, high = np.searchsorted(breaks, [at[d], at[d + 1]])
        if high > low:
            lines = [x for x in raw[at[d] : at[d + 1]].tobytes().split(b"\n") if x.strip()]
            lines_again[d] = 1 - len(set(lines)) / max(len(lines), 1)
    out["distinct_words"], out["top_word"], out["repeated_runs"], out["repeated_lines"] = distinct, top, repeated, lines_again
    out["log_line"] = np.log1p(size / (count["lines"] + 1))
    out["log_sentence"] = np.log1p(n / (count["ends"] + 1))
    table = np.stack([out[f] for f in FEATURES], axis=1)
    table[np.diff(at) == 0] = 0
    return table


def features(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Add the FEATURES of each whole text as columns. Columns of ``docs`` with these names are replaced."""

    def work(column: pa.Array) -> dict[str, pa.Array]:
        data, offsets, _ = text_buffers(column)
        parts = [text_features(data, offsets[i : j + 1]) for i, j in slices(offsets)]
        table = np.concatenate(parts) if parts else np.empty((0, len(FEATURES)))
        return {f: pa.array(np.ascontiguousarray(table[:, k])) for k, f in enumerate(FEATURES)}

    return add_columns(docs, text, [StructField(f, DoubleType()) for f in FEATURES], work, keep)


@dataclass
class Model:
    cuts: list[np.ndarray]  #: bin borders of each feature
    tables: list[np.ndarray]  #: a number for each bin
    pair_cuts: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        for k, (cuts, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            total += table[np.searchsorted(cuts, x[:, k], "right")]
        for a, b, table in self.pairs:
            total += table[_bins(self.pair_cuts[a], x[:, a]), _bins(self.pair_cuts[b], x[:, b])]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def _bins(cuts: np.ndarray, values: np.ndarray) -> np.ndarray:
    return np.searchsorted(cuts, values, "right")


def _cuts(values: np.ndarray, n: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, n) / n))


def _value(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return -g / (h + 1.0)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _split(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> int:
    """Best border between bins, 0 if none helps."""
    left_g, left_h, left_n = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gain = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
    gain = np.where((left_n >= LEAST_ROWS) & (n.sum() - left_n >= LEAST_ROWS), gain, 0)
    return int(gain.argmax()) + 1 if len(gain) and gain.max() > 1e-9 else 0


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int = 2) -> np.ndarray:
    """A tree over the bins of one feature, as a number for each bin."""
    cut = _split(g, h, n) if depth and len(g) > 1 else 0
    if not cut:
        return np.full(len(g), _value(g.sum(), h.sum()))
    return np.concatenate(
        [_tree(g[:cut], h[:cut], n[:cut], depth - 1), _tree(g[cut:], h[cut:], n[cut:], depth - 1)]
    )


def _pair_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A tree over the joint bins of two features: the better feature first, then each half by the other."""
    out = np.empty_like(g)
    best, choice = -1.0, (0, 0)
    for axis in (0, 1):
        sums = [x.sum(axis=1 - axis) for x in (g, h, n)]
        cut = _split(*sums)
        if cut:
            a, b = sums[0][:cut].sum(), sums[0][cut:].sum()
            gain = _gain(a, sums[1][:cut].sum()) + _gain(b, sums[1][cut:].sum())
            if gain > best:
                best, choice = gain, (axis, cut)
    axis, cut = choice
    if not cut:
        return np.full_like(g, _value(g.sum(), h.sum()))
    for half in (slice(0, cut), slice(cut, None)):
        part = (half, slice(None)) if axis == 0 else (slice(None), half)
        values = _tree(*(x[part].sum(axis=axis) for x in (g, h, n)), depth=1)
        out[part] = values[None, :] if axis == 0 else values[:, None]
    return out


def fit_rows(x: np.ndarray, label: np.ndarray) -> Model:
    """Fit to feature rows. Without two classes, scores are the share of ones."""
    n_features = len(FEATURES)
    empty = [np.empty(0) for _ in range(n_features)]
    if not len(x) or label.min() == label.max():
        share = float(np.clip(label.mean() if len(x) else 0.5, 0.01, 0.99))
        return Model(empty, [np.zeros(1)] * n_features, empty, [], float(np.log(share / (1 - share))))
    cuts = [_cuts(x[:, k], BINS) for k in range(n_features)]
    binned = [_bins(c, x[:, k]) for k, c in enumerate(cuts)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    weight = [np.bincount(b, minlength=len(t)).astype(float) for b, t in zip(binned, tables, strict=True)]
    bias = float(np.log(label.mean() / (1 - label.mean())))
    logit = np.full(len(x), bias)
    for _ in range(ROUNDS):
        for k in range(n_features):
            p = 1 / (1 + np.exp(-logit))
            g, h = (np.bincount(binned[k], w, len(tables[k])) for w in (p - label, p * (1 - p)))
            step = RATE * _tree(g, h, weight[k])
            tables[k] += step
            logit += step[binned[k]]
    pair_cuts = [_cuts(x[:, k], PAIR_BINS) for k in range(n_features)]
    coarse = [_bins(c, x[:, k]) for k, c in enumerate(pair_cuts)]
    size = [len(c) + 1 for c in pair_cuts]
    ranked = []
    p = 1 / (1 + np.exp(-logit))
    for a, b in combinations(range(n_features), 2):
        joint = coarse[a] * size[b] + coarse[b]
        g, h = (np.bincount(joint, w, size[a] * size[b]) for w in (p - label, p * (1 - p)))
        ranked.append((-float(_gain(g, h).sum()), a, b))
    pairs = [[a, b, np.zeros((size[a], size[b]))] for _, a, b in sorted(ranked)[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for a, b, table in pairs:
            p = 1 / (1 + np.exp(-logit))
            joint = coarse[a] * size[b] + coarse[b]
            g, h, n = (
                np.bincount(joint, w, size[a] * size[b]).reshape(table.shape)
                for w in (p - label, p * (1 - p), np.ones(len(x)))
            )
            step = RATE * _pair_tree(g, h, n)
            table += step
            logit += step[coarse[a], coarse[b]]
    return Model(cuts, tables, pair_cuts, [tuple(p) for p in pairs], bias)


def fit(table: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality", limit: int = SAMPLE) -> Model:
    """Train on at most ``limit`` labelled rows of :func:`features` that are not held out.

    Rows are those of smallest id hash. Null labels are left out; of repeated labels for an id the largest counts, and of
    repeated documents the one whose features come first in order.
    """
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("_label")).na.drop()
    single = known.groupBy("doc_id").agg(F.max("_label").alias("_label")).filter(~held_out(F.col("doc_id")))
    picked = bounded_sample(single, F.xxhash64("doc_id"), limit)
    rows = table.select(F.col(doc_id).alias("doc_id"), *FEATURES).join(picked, "doc_id")
    one = rows.groupBy("doc_id").agg(F.min(F.struct("_label", *FEATURES)).alias("_row")).select("doc_id", "_row.*")
    found = np.array(sorted(tuple(r) for r in one.collect()), np.float64)
    found = found.reshape(-1, len(FEATURES) + 2)
    return fit_rows(found[:, 2:], found[:, 1])


def score(table: DataFrame, model: Model, keep: Sequence[str]) -> DataFrame:
    """``keep`` and ``score`` (0 to 1, higher: label 1 likelier) of each row of :func:`features`."""
    shared = table.sparkSession.sparkContext.broadcast(model)
    names = list(keep)

    def run(batches):
        for batch in batches:
            x = np.stack([np.asarray(batch.column(k)) for k in range(len(names), batch.num_columns)], axis=1)
            columns = [*batch.columns[: len(names)], pa.array(shared.value.score(x))]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "score"])

    source = table.select(*names, *FEATURES)
    schema = source.select(*names).schema.add("score", DoubleType())
    return source.mapInArrow(run, schema)


def quality(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality") -> DataFrame:
    """(doc_id, score): every document scored by a model learned from the labels that are not held out.

    * A null or empty text has the features of nothing, and the score that the model gives to these.
    * Repeated documents are scored row by row. Labels of unknown documents are ignored.
    * Without labels, or with one class only, all scores are the share of label 1 (0.5 without labels).
    * Other columns of ``docs`` are ignored. An empty table gives an empty result.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    table = stage(features(source, "text", ["doc_id"]), "quality")
    model = fit(table, labels.select(F.col(doc_id).alias("doc_id"), label), "doc_id", label)
    return score(table, model, ["doc_id"])


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned: crc32 of the id as text, modulo 5, is 0. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
