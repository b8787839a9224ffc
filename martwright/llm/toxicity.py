"""Toxicity by a counterfactually regularised linear classifier.

A document is a set of hashed features: its words, and the first 5 to 8 bytes of each word, which stand for word
families. Each feature counts as ``log(1 + occurrences)``. A logistic regression over the most telling features is
fitted with one more penalty: in every labelled sentence that names a group of people, the name is swapped for others
of its kind, and the squared change of the sentence's score is added to the loss. What remains can't rest on which
group is named, so neutral mentions don't raise a score.

Training is on a bounded sample of labelled documents; features are made in Spark tasks, from whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructField

from .textkit import BYTE_CODE, Powers, Words, add_columns, bounded_sample, mix, slices, text_buffers, words_of

# Kinds of group names in English, German, French and Spanish, in lower case; a name is swapped for the
# others of its kinds.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "lesbian", "bisexual", "transgender", "straight"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("deaf", "blind", "disabled"),
    ("old", "young", "elderly"),
    ("frauen", "männer"),
    ("mädchen", "jungen"),
    ("christen", "muslime", "juden", "hindus", "buddhisten", "atheisten"),
    ("schwarze", "weiße", "asiaten", "afrikaner", "europäer"),
    ("schwule", "lesben", "bisexuelle", "heterosexuelle"),
    ("einwanderer", "flüchtlinge", "einheimische", "ausländer"),
    ("gehörlose", "blinde", "behinderte"),
    ("femmes", "hommes"),
    ("filles", "garçons"),
    ("chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "athées"),
    ("noirs", "blancs", "asiatiques", "africains", "européens"),
    ("homosexuels", "lesbiennes", "bisexuels", "hétérosexuels"),
    ("immigrés", "réfugiés", "autochtones", "étrangers"),
    ("sourds", "aveugles", "handicapés"),
    ("mujeres", "hombres"),
    ("niñas", "niños"),
    ("cristianos", "musulmanes", "judíos", "hindúes", "budistas", "ateos"),
    ("negros", "blancos", "asiáticos", "africanos", "europeos"),
    ("homosexuales", "lesbianas", "bisexuales", "heterosexuales"),
    ("inmigrantes", "refugiados", "nativos", "extranjeros"),
    ("sordos", "ciegos", "discapacitados"),
)
Terms = Sequence[Sequence[str]]
PREFIXES = (5, 6, 7, 8)
SPACE_BITS = 20  #: hashed feature space
#: Bounds of training: labelled documents, features kept, steps.
SAMPLE, FEATURES, STEPS = 6000, 4000, 250
LEAST_DOCS = 3  #: documents of the sample that a feature must stand in
RIDGE, FAIRNESS = 2e-4, 1.0


def _hash_words(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(word number, feature) of every word and word beginning."""
    n = len(words.stream)
    up, down = Powers.get(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_CODE[words.stream] * up[:n], out=total[1:])
    size = words.end - words.start
    shift = np.uint64(64 - SPACE_BITS)
    number = np.arange(len(size))
    at, feature = [number], [mix((total[words.end] - total[words.start]) * down[words.start]) >> shift]
    for k in PREFIXES:
        long = number[size >= k]
        start = words.start[long]
        at.append(long)
        feature.append(mix((total[start + k] - total[start]) * down[start] + np.uint64(k)) >> shift)
    return np.concatenate(at), np.concatenate(feature).astype(np.int64)


def _features_of(word: str) -> np.ndarray:
    raw = np.frombuffer(word.encode(), np.uint8)
    return _hash_words(words_of(raw, np.array([0, len(raw)])))[1]


def _counted(doc: np.ndarray, feature: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, occurrences), sorted."""
    key, n = np.unique(doc * width + feature, return_counts=True)
    return key // width, key % width, n


def _others(terms: Terms) -> dict[str, list[str]]:
    """What each name is swapped for; a name may be of several kinds."""
    kinds: dict[str, list[str]] = {}
    for kind in terms:
        for name in kind:
            others = kinds.setdefault(name, [])
            others += [x for x in kind if x != name and x not in others]
    return kinds


def _sentence_swaps(text: str, terms: Terms = IDENTITY_TERMS) -> list[tuple[list[int], list[float]]]:
    """For each swap of a group name in each sentence: which features change, and by how much."""
    others = _others(terms)
    out = []
    for sentence in re.split(r"[.!?\n]+", text.lower()):
        for name in sorted(set(re.findall(r"[^\W_]+", sentence)) & others.keys()):
            for other in others[name]:
                features, n = np.unique(np.concatenate([_features_of(name), _features_of(other)]), return_counts=True)
                sign = np.where(np.isin(features, _features_of(other)), 1.0, -1.0) * (n == 1) * np.log(2)
                out.append((features[n == 1].tolist(), sign[n == 1].tolist()))
    return out


def _training_rows(column: pa.Array, terms: Terms = IDENTITY_TERMS) -> dict[str, pa.Array]:
    data, offsets, nulls = text_buffers(column)
    made: dict[str, list[bytes]] = {"features": [], "weights": [], "swaps": [], "changes": []}
    for i, j in slices(offsets):
        words = words_of(data, offsets[i : j + 1])
        at, feature = _hash_words(words)
        doc, feature, n = _counted(words.doc[at], feature, 1 << SPACE_BITS)
        edges = np.searchsorted(doc, np.arange(j - i + 1))
        weight = np.log1p(n)
        for d in range(j - i):
            low, high = edges[d], edges[d + 1]
            text = "" if nulls[i + d] else data[offsets[i + d] : offsets[i + d + 1]].tobytes().decode()
            pairs = sorted({(tuple(f), tuple(c)) for f, c in _sentence_swaps(text, terms)})
            # Swaps are laid end to end; -1 ends each.
            made["features"].append(feature[low:high].astype("<i4").tobytes())
            made["weights"].append(weight[low:high].astype("<f4").tobytes())
            made["swaps"].append(np.array([x for f, _ in pairs for x in (*f, -1)], "<i4").tobytes())
            made["changes"].append(np.array([x for _, c in pairs for x in (*c, 0.0)], "<f4").tobytes())
    return {name: pa.array(parts, pa.binary()) for name, parts in made.items()}


def unpack(label: int, features: bytes, weights: bytes, swaps: bytes, changes: bytes) -> tuple:
    """A training row for :func:`fit_rows` from what a task has made of a document."""
    return (
        label,
        np.frombuffer(features, "<i4"),
        np.frombuffer(weights, "<f4"),
        np.frombuffer(swaps, "<i4"),
        np.frombuffer(changes, "<f4"),
    )


@dataclass
class Model:
    slot: np.ndarray  #: place of each hashed feature in ``weight``, or -1
    weight: np.ndarray
    bias: float

    def score(self, words: Words) -> np.ndarray:
        n = len(words.first) - 1
        at, feature = _hash_words(words)
        slot = self.slot[feature]
        known = slot >= 0
        doc, slot, count = _counted(words.doc[at[known]], slot[known], max(len(self.weight), 1))
        total = np.bincount(doc, self.weight[slot] * np.log1p(count), n) if len(doc) else np.zeros(n)
        return 1 / (1 + np.exp(-np.clip(total + self.bias, -40, 40)))


def fit_rows(rows: Sequence[tuple], fairness: float = FAIRNESS, seed: int = 1, terms: Terms = IDENTITY_TERMS) -> Model:
    """``rows``: (label, features, weights, swaps, changes) as arrays. Without two classes, scores are the share of ones."""
    slot = np.full(1 << SPACE_BITS, -1, np.int32)
    label = np.array([r[0] for r in rows], np.float64)
    if not len(rows) or label.min() == label.max():
        share = float(np.clip(label.mean() if len(rows) else 0.0, 0.01, 0.99))
        return Model(slot, np.zeros(0), float(np.log(share / (1 - share))))
    sizes = np.array([len(r[1]) for r in rows])
    row = np.repeat(np.arange(len(rows), dtype=np.int32), sizes)
    column = np.concatenate([r[1] for r in rows])
    value = np.concatenate([r[2] for r in rows])
    # Telling features: the mean differs most between the classes, measured in standard deviations.
    width = 1 << SPACE_BITS
    n = np.bincount(column, minlength=width)
    one = label[row] == 1
    up, down = np.bincount(column[one], value[one], width) / label.sum(), np.bincount(column[~one], value[~one], width)
    down /= (1 - label).sum()
    mean = (np.bincount(column, value, width)) / len(rows)
    spread = np.sqrt(np.maximum(np.bincount(column, value**2, width) / len(rows) - mean**2, 1e-12))
    telling = np.where(n >= LEAST_DOCS, np.abs(up - down) / (spread + 0.02), 0)
    chosen = np.argsort(-telling, kind="stable")[:FEATURES]
    chosen = chosen[telling[chosen] > 0]
    names = np.unique(np.concatenate([_features_of(w) for kind in terms for w in kind] or [np.empty(0, np.int64)]))
    chosen = np.unique(np.concatenate([chosen, names]))
    slot[chosen] = np.arange(len(chosen))
    keep = slot[column] >= 0
    row, column, value = row[keep], slot[column[keep]].astype(np.int64), value[keep]
    s_row, s_column, s_value = _swap_matrix(rows, slot)
    n_swaps = int(s_row.max()) + 1 if len(s_row) else 0
    w, bias, k = np.zeros(len(chosen)), float(np.log(label.mean() / (1 - label.mean()))), len(chosen)
    importance = np.where(label == 1, np.sqrt((1 - label.mean()) / label.mean()), 1.0)
    importance /= importance.sum()
    m, v = np.zeros(k + 1), np.zeros(k + 1)
    for step in range(1, STEPS + 1):
        logit = np.bincount(row, value * w[column], len(rows)) + bias
        error = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - label) * importance
        grad = np.append(np.bincount(column, value * error[row], k) + RIDGE * w, error.sum())
        if n_swaps:
            change = np.bincount(s_row, s_value * w[s_column], n_swaps)
            grad[:k] += 2 * fairness / n_swaps * np.bincount(s_column, s_value * change[s_row], k)
        m += 0.1 * (grad - m)
        v += 0.01 * (grad**2 - v)
        move = 0.1 * (1 - 0.9 * step / STEPS) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w -= move[:k]
        bias -= float(move[k])
    return Model(slot, w, bias)


def _swap_matrix(rows: Sequence[tuple], slot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at, column, value, n = [], [], [], 0
    for r in rows:
        for feature, change in zip(r[3].tolist(), r[4].tolist(), strict=True):
            if feature < 0:
                n += 1
            elif slot[feature] >= 0:
                at.append(n)
                column.append(int(slot[feature]))
                value.append(change)
    return np.array(at, np.int64), np.array(column, np.int64), np.array(value, np.float64)


def training_sample(docs: DataFrame, labels: DataFrame, label: str, doc_id: str = "doc_id", limit: int = SAMPLE) -> DataFrame:
    """Labelled documents (doc_id, text, label) of smallest id hash, ``limit`` at most. Null labels are left out; of
    repeated labels for an id the largest counts."""
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label")).na.drop()
    single = known.groupBy("doc_id").agg(F.max("label").alias("label")).filter(~held_out(F.col("doc_id")))
    picked = bounded_sample(single, F.xxhash64("doc_id"), limit)
    return docs.join(picked, docs[doc_id] == picked["doc_id"], "inner").drop(picked["doc_id"])


def fit(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", limit: int = SAMPLE,
    terms: Terms = IDENTITY_TERMS,
) -> Model:
    """Train on at most ``limit`` labelled documents that are not held out; ``terms`` are the kinds of names to swap.

    An id that stands in several rows counts once, with the row whose features come first in order.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    fields = [StructField(name, BinaryType()) for name in ("features", "weights", "swaps", "changes")]
    sample = training_sample(plain, labels, label, limit=limit)
    made = add_columns(sample, "text", fields, partial(_training_rows, terms=terms), ["doc_id", "label"])
    one = made.groupBy("doc_id").agg(F.min(F.struct("label", *(f.name for f in fields))).alias("row")).select("doc_id", "row.*")
    plain = lambda v: bytes(v) if isinstance(v, bytearray) else v
    rows = sorted(tuple(plain(v) for v in r) for r in one.toLocalIterator())
    return fit_rows([unpack(*r[1:]) for r in rows], terms=terms)


def score(docs: DataFrame, model: Model, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Add ``score`` (0 to 1, higher: toxic likelier) to each document; a null or empty text has the model's base score.

    Repeated rows are scored alike. A column of ``docs`` named ``score`` is replaced; all others are returned (or those
    in ``keep``). One narrow pass over whole texts.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(column: pa.Array) -> dict[str, pa.Array]:
        data, offsets, _ = text_buffers(column)
        parts = [shared.value.score(words_of(data, offsets[i : j + 1])) for i, j in slices(offsets)]
        return {"score": pa.array(np.concatenate(parts) if parts else np.empty(0))}

    return add_columns(docs, text, [StructField("score", DoubleType())], work, keep)


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned: crc32 of the id as text, modulo 5, is 0. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
