"""Passages that repeat across documents, by a sparse suffix array.

A passage is a run of 50 words or more that also stands in another document.

1. Suffixes are retained only at *content-selected* positions: each window of 50 words selects the position of the
   smallest hash (leftmost if equal) among its first 24 runs of 8 words. Equal windows select the same place, so every
   repeat has a retained suffix in common, with 27 words to the right of it at least: the suffix's *head*.
2. Retained suffixes are *sorted* by head and *neighbours compared*: within each task's stretch first, which leaves at
   most two rows of a head, then over all of them. A head in two documents is a match to extend.
3. Matches are *extended left and right*: a suffix carries one hash for each window that selected it, that is, for
   each way to reach 50 words by going left of the head and right of it. Suffixes with equal extensions are compared
   as one; only different extensions of one head are compared window by window.

The result is the same as that of comparing all windows of 50 words. Nothing is grouped by passage in one task: groups
are pre-aggregated map-side and joined back in a form that adaptive execution can split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.operators.joins import attach

from .textkit import Powers, Words, mix, slices, stage, text_buffers, words_of

WINDOW = 50
CHOICE, GRAM = 24, 8
HEAD = WINDOW - CHOICE + 1

_SUFFIX = "head long, doc long, place int, reach int, windows binary"


def _runs(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive word hashes."""
    k = len(h) - n + 1
    if k <= 0:
        return np.empty(0, np.uint64)
    up, down = Powers.get(len(h) + 1)
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * up[: len(h)], out=total[1:])
    return mix((total[n:] - total[:k]) * down[:k])


def _choose(gram: np.ndarray, n: int) -> np.ndarray:
    """Position of the smallest of ``gram[s : s + CHOICE]``, leftmost if equal, for each s below n."""
    value, place, width = gram, np.arange(len(gram)), 1
    while width < CHOICE:
        step = min(width, CHOICE - width)
        left, right = value[: len(value) - step], value[step:]
        later = right < left
        value = np.where(later, right, left)
        place = np.where(later, place[step:], place[: len(place) - step])
        width += step
    return place[:n]


def suffixes(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Retained suffixes: (text, place, reach, head, windows, first window).

    ``place`` is the suffix's word in its text and ``reach`` how far left of it the first of its windows begins;
    ``windows`` are 32-bit hashes of all windows, of which a suffix's own begin at its ``first window``.
    """
    h = words.hashes()
    n = max(len(h) - WINDOW + 1, 0)
    none = np.empty(0, np.int64)
    if not n:
        return none, none, none, np.empty(0, np.uint64), np.empty(0, "<u4"), np.zeros(1, np.int64)
    start = np.flatnonzero(words.doc[:n] == words.doc[WINDOW - 1 :])
    place = _choose(_runs(h, GRAM), n)[start]
    window = (_runs(h, WINDOW)[start] >> np.uint64(32)).astype("<u4")
    fresh = np.ones(len(start), bool)
    fresh[1:] = (place[1:] != place[:-1]) | (words.doc[start[1:]] != words.doc[start[:-1]])
    first = np.flatnonzero(fresh)
    at, begin = place[first], start[first]
    text = words.doc[begin]
    head = _runs(h, HEAD)[at]
    return text, at - words.first[text], at - begin, head, window, np.append(first, len(start))


def _retain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = np.asarray(batch.column(0))
        data, offsets, _ = text_buffers(batch.column(1))
        for i, j in slices(offsets):
            text, place, reach, head, window, first = suffixes(words_of(data, offsets[i : j + 1]))
            if len(text):
                where = pa.py_buffer((first * 4).astype(np.int32).tobytes())
                windows = pa.Array.from_buffers(pa.binary(), len(text), [None, where, pa.py_buffer(window.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(head.view(np.int64)),
                        pa.array(ids[i:j][text]),
                        pa.array(place.astype(np.int32)),
                        pa.array(reach.astype(np.int32)),
                        windows,
                    ],
                    names=["head", "doc", "place", "reach", "windows"],
                )


def _sorted_heads(head: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes in sorted order, with the first and last document of each head."""
    order = np.lexsort((doc, head))
    head, doc = head[order], doc[order]
    new = np.ones(len(head), bool)
    new[1:] = head[1:] != head[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(head)) - 1
    return head[first], doc[first], doc[last]


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sort a batch's suffixes and compare neighbours: one row for each head, with its first and last document."""
    for batch in batches:
        head, first, last = _sorted_heads(np.asarray(batch.column(0)), np.asarray(batch.column(1)))
        yield pa.RecordBatch.from_arrays([pa.array(head), pa.array(first), pa.array(last)], names=["head", "lo", "hi"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Heads in two documents, from rows sorted by head; a head may go on in the next batch."""
    held: tuple[int, int, int] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        head, lo, hi = (np.asarray(c) for c in batch.columns)
        if held:
            head, lo, hi = (np.concatenate([[x], c]) for x, c in zip(held, (head, lo, hi), strict=True))
        new = np.ones(len(head), bool)
        new[1:] = head[1:] != head[:-1]
        first = np.flatnonzero(new)
        head, lo, hi = head[first], np.minimum.reduceat(lo, first), np.maximum.reduceat(hi, first)
        held = int(head[-1]), int(lo[-1]), int(hi[-1])
        both = lo[:-1] != hi[:-1]
        yield pa.RecordBatch.from_arrays([pa.array(head[:-1][both])], names=["head"])
    if held and held[1] != held[2]:
        yield pa.RecordBatch.from_arrays([pa.array([held[0]], pa.int64())], names=["head"])


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, first_word, end_word, first_doc_id): the runs of words that windows of 50 repeated words cover.

    ``first_doc_id`` is the smallest id of a document that has one of the run's windows, so a run whose
    ``first_doc_id`` is its own ``doc_id`` is the one to keep. Word numbers count from 0; the end is exclusive.

    * A null, empty or shorter text has no passages, and no rows. Words are those of :mod:`textkit`.
    * Rows with one id are one document: a passage must repeat under another id. A null id counts as one id,
      smaller than all others.
    * Other columns are ignored. An empty table gives an empty result.
    """
    lowest = F.lit(-(1 << 63)).cast("long")
    source = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), lowest).alias("doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    kept = source.mapInArrow(_retain, _SUFFIX)
    heads = kept.select("head", "doc").mapInArrow(_neighbours, "head long, lo long, hi long")
    shared = heads.repartition("head").sortWithinPartitions("head", "lo").mapInArrow(_compare, "head long")
    matches = stage(attach(kept, shared, "head", "inner"), "suffixes")

    # Equal extensions of a head are one variant. A head's only variant has all of its windows in two documents.
    variants = matches.groupBy("head", "reach", "windows").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
    counts = variants.groupBy("head").agg(F.count(F.lit(1)).alias("n"), F.min("lo").alias("low"))
    variants = stage(attach(variants, counts, "head", "inner"), "variants")
    whole = F.sequence(F.lit(0), (F.length("windows") / 4).cast("int") - 1)
    same = variants.filter("n = 1").select(
        "head", "reach", "windows", F.transform(whole, lambda k: F.struct(k.alias("window"), F.col("low").alias("low"))).alias("found")
    )
    several = variants.filter("n > 1").select("head", "reach", "windows", "lo", "hi", F.explode(whole).alias("window"))
    several = several.withColumns(
        {"left": F.col("reach") - F.col("window"), "hash": F.expr("substring(windows, 4 * window + 1, 4)")}
    )
    key = ["head", "left", "hash"]
    common = several.groupBy(*key).agg(F.min("lo").alias("low"), F.max("hi").alias("high")).filter("low <> high")
    extended = (
        attach(several, common.drop("high"), key, "inner")
        .groupBy("head", "reach", "windows")
        .agg(F.collect_list(F.struct("window", "low")).alias("found"))
    )
    found = attach(matches, same.unionByName(extended), ["head", "reach", "windows"], "inner")

    window = F.struct(
        (F.col("place") - F.col("reach") + F.col("hit.window")).alias("first_word"), F.col("hit.low").alias("low")
    )
    per_doc = (
        found.select("doc", "place", "reach", F.explode("found").alias("hit"))
        .select("doc", window.alias("w"))
        .groupBy("doc")
        .agg(F.array_sort(F.collect_set("w")).alias("w"))
    )
    return per_doc.mapInArrow(_join_windows, "doc_id long, first_word int, end_word int, first_doc_id long").withColumns(
        {
            "doc_id": F.when(F.col("doc_id") != lowest, F.col("doc_id")),
            "first_doc_id": F.when(F.col("first_doc_id") != lowest, F.col("first_doc_id")),
        }
    )


def _join_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join a document's windows that overlap or touch."""
    for batch in batches:
        w = batch.column(1)
        counts = np.asarray(w.value_lengths())
        doc = np.repeat(np.asarray(batch.column(0)), counts)
        flat = w.flatten()
        start, low = np.asarray(flat.field(0)), np.asarray(flat.field(1))
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + WINDOW)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(doc)) - 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(doc[first]),
                pa.array(start[first].astype(np.int32)),
                pa.array((start[last] + WINDOW).astype(np.int32)),
                pa.array(np.minimum.reduceat(low, first) if len(first) else low),
            ],
            names=["doc_id", "first_word", "end_word", "first_doc_id"],
        )
