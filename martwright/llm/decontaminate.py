"""Benchmark decontamination by Wu-Manber multi-pattern search.

The patterns are the windows of 13 consecutive words of all benchmark items (an item of fewer words is one window),
searched in the word stream of each whole text:

* blocks of a few bytes are hashed into a *shift table*: how far a search position can be moved on without passing
  the end of an occurrence; positions whose block is in no pattern are skipped by nearly a pattern's length;
* where the shift is 0, the block's *suffix bucket* names the patterns that have this block at their prefix's end;
* *direct comparison* of the bytes confirms occurrences, which must begin and end on word borders.

Patterns are searched in classes of similar length, since the shortest one bounds the shifts of its class. Search
positions of many stretches of text move on together in numpy.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from .textkit import Words, add_columns, slices, stage, text_buffers, words_of

WINDOW = 13
#: Benchmark text held by a task at a time. A larger benchmark is searched in several blocks, one pass over the texts each.
BLOCK_BYTES = 32 << 20
#: Pattern classes by least length in bytes.
CLASSES = (48, 24, 12, 6, 1)
STRIDE = 512

_SPAN = StructType([StructField("first_word", IntegerType()), StructField("end_word", IntegerType())])
RESULT = [
    StructField("n_words", LongType()),
    StructField("n_hit", LongType()),
    StructField("hit_spans", ArrayType(_SPAN)),
    StructField("hit_items", ArrayType(StringType())),
]
_UNNAMED = StructField("_hit_unnamed", BooleanType())


def _load8(stream: np.ndarray) -> np.ndarray:
    """The 8 bytes at each position as one number; ``stream`` must end in 7 spare bytes."""
    return np.ndarray((max(len(stream) - 7, 0),), "<u8", buffer=stream, strides=(1,))


class PatternClass:
    """Shift table and suffix buckets of patterns (offset, length) in ``stream``."""

    def __init__(self, stream: np.ndarray, offset: np.ndarray, length: np.ndarray) -> None:
        self.offset, self.length = offset, length
        self.least = m = int(length.min())
        self.block = b = min(m, 8)
        self.mask = np.uint64((1 << (8 * b)) - 1)
        spots = (offset[:, None] + np.arange(m - b + 1)).ravel() if len(offset) * (m - b + 1) < 1 << 24 else None
        count = len(np.unique(spots)) if spots is not None else len(offset) * (m - b + 1)
        self.shift_bits = np.uint64(64 - min(22, max(10, int(count * 8).bit_length())))
        loads = _load8(stream)
        self.shift = np.full(1 << (64 - int(self.shift_bits)), m - b + 1, np.int32)
        for j in range(m - b + 1):
            np.minimum.at(self.shift, self._bucket(loads[offset + j]), m - b - j)
        last = self._bucket(loads[offset + m - b])
        self.order = np.argsort(last, kind="stable")
        self.sorted = last[self.order]

    def _bucket(self, block: np.ndarray) -> np.ndarray:
        return (((block & self.mask) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift_bits).astype(np.int64)

    def candidates(self, stream: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(start, pattern) of possible occurrences in the first ``size`` bytes."""
        m, b = self.least, self.block
        loads = _load8(stream)
        # A position is the start of the last block of a pattern's prefix.
        at = np.arange(m - b, size - b + 1, STRIDE)
        stop = np.minimum(at + STRIDE, size - b + 1)
        found = []
        while len(at):
            bucket = self._bucket(loads[at])
            shift = self.shift[bucket]
            hit = np.flatnonzero(shift == 0)
            if len(hit):
                found.append((at[hit] - (m - b), bucket[hit]))
            at = at + np.maximum(shift, 1)
            alive = at < stop
            if not alive.all():
                at, stop = at[alive], stop[alive]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        start, bucket = (np.concatenate(x) for x in zip(*found, strict=True))
        low, high = np.searchsorted(self.sorted, bucket, "left"), np.searchsorted(self.sorted, bucket, "right")
        n = high - low
        rank = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(start, n), self.order[np.repeat(low, n) + rank]


class Patterns:
    """All windows of some items, ready to be searched."""

    def __init__(self, items: Sequence[tuple[str | None, str]], window: int = WINDOW) -> None:
        texts = [text.encode("utf-8", "surrogatepass") for _, text in items]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        words = words_of(np.frombuffer(b"".join(texts), np.uint8), offsets)
        self.names = sorted({name for name, _ in items}, key=lambda n: (n is not None, n or ""))
        rank = {name: i for i, name in enumerate(self.names)}
        seen: dict[bytes, int] = {}
        offset, length, n_words, pairs = [], [], [], set()
        raw = words.stream.tobytes()
        for i, (name, _) in enumerate(items):
            low, high = int(words.first[i]), int(words.first[i + 1])
            for w in range(low, max(high - window, low) + 1 if high > low else low):
                last = min(w + window, high) - 1
                at, end = int(words.start[w]), int(words.end[last])
                k = seen.setdefault(raw[at:end], len(offset))
                if k == len(offset):
                    offset.append(at)
                    length.append(end - at)
                    n_words.append(last - w + 1)
                pairs.add((k, rank[name]))
        self.stream = np.concatenate([words.stream, np.zeros(8, np.uint8)])
        self.offset, self.length = np.array(offset, np.int64), np.array(length, np.int64)
        self.n_words = np.array(n_words, np.int64)
        both = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.item = both[:, 1]
        self.item_at = np.searchsorted(both[:, 0], np.arange(len(offset) + 1))
        self.classes = []
        upper = 1 << 62
        for lower in CLASSES:
            mine = np.flatnonzero((self.length >= lower) & (self.length < upper))
            upper = lower
            if len(mine):
                self.classes.append((mine, PatternClass(self.stream, self.offset[mine], self.length[mine])))

    def search(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(first word, pattern) of every occurrence."""
        size = len(words.stream)
        stream = np.concatenate([words.stream, np.zeros(8, np.uint8)])
        border = np.full(size + 1, -1, np.int64)
        border[words.start] = np.arange(len(words.start))
        ends = np.full(size + 1, -1, np.int64)
        ends[words.end] = np.arange(len(words.end))
        text, mine = _load8(stream), _load8(self.stream)
        found = []
        for which, patterns in self.classes:
            if size < patterns.least:
                continue
            start, pattern = patterns.candidates(stream, size)
            pattern = which[pattern]
            fits = (border[start] >= 0) & (start + self.length[pattern] <= size)
            start, pattern = start[fits], pattern[fits]
            fits = ends[start + self.length[pattern]] >= 0
            start, pattern = start[fits], pattern[fits]
            fits = words.doc[border[start]] == words.doc[ends[start + self.length[pattern]]]
            start, pattern = start[fits], pattern[fits]
            done = [(start[:0], pattern[:0])]
            for k in range(0, int(self.length[pattern].max()) if len(pattern) else 0, 8):
                left = self.length[pattern] - k
                over = left <= 0
                if over.any():
                    done.append((start[over], pattern[over]))
                    start, pattern, left = start[~over], pattern[~over], left[~over]
                unequal = text[start + k] ^ mine[self.offset[pattern] + k]
                tail = np.minimum(left, 8).astype(np.uint64) * np.uint64(8)
                unequal &= np.where(tail < 64, (np.uint64(1) << (tail & np.uint64(63))) - np.uint64(1), ~np.uint64(0))
                same = unequal == 0
                start, pattern = start[same], pattern[same]
            done.append((start, pattern))
            found += done
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        start, pattern = (np.concatenate(x) for x in zip(*found, strict=True))
        return border[start], pattern

    def hits(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which words are hit; texts and item ranks of the items found."""
        first, pattern = self.search(words)
        n = len(words.start)
        edge = np.bincount(first, minlength=n + 1) - np.bincount(first + self.n_words[pattern], minlength=n + 1)
        covered = np.cumsum(edge[:n]) > 0
        low, high = self.item_at[pattern], self.item_at[pattern + 1]
        k = high - low
        rank = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        key = np.repeat(words.doc[first], k) * len(self.names) + self.item[np.repeat(low, k) + rank]
        key = np.unique(key)
        return covered, key // max(len(self.names), 1), key % max(len(self.names), 1)


def _work(patterns: Patterns):
    def work(column: pa.Array) -> dict[str, pa.Array]:
        data, offsets, _ = text_buffers(column)
        n_words, n_hit, spans, items, unnamed = [], [], [], [], []
        for i, j in slices(offsets):
            words = words_of(data, offsets[i : j + 1])
            covered, docs, ranks = patterns.hits(words)
            n_words.append(np.diff(words.first))
            n_hit.append(np.bincount(words.doc[covered], minlength=j - i))
            mine: list[list] = [[] for _ in range(j - i)]
            runs: list[list] = [[] for _ in range(j - i)]
            nameless = [False] * (j - i)
            for d, r in zip(docs.tolist(), ranks.tolist(), strict=True):
                if patterns.names[r] is None:
                    nameless[d] = True
                else:
                    mine[d].append(patterns.names[r])
            for d in np.unique(words.doc[covered]).tolist():
                low, high = words.first[d], words.first[d + 1]
                edge = np.flatnonzero(np.diff(np.concatenate([[0], covered[low:high].astype(np.int8), [0]])))
                runs[d] = [{"first_word": int(a), "end_word": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)]
            spans += runs
            items += mine
            unnamed += nameless
        flat = lambda parts: np.concatenate(parts).astype(np.int64) if parts else np.empty(0, np.int64)
        span = pa.list_(pa.struct([("first_word", pa.int32()), ("end_word", pa.int32())]))
        return {
            "n_words": pa.array(flat(n_words)),
            "n_hit": pa.array(flat(n_hit)),
            "hit_spans": pa.array(spans, span),
            "hit_items": pa.array(items, pa.list_(pa.string())),
            "_hit_unnamed": pa.array(unnamed, pa.bool_()),
        }

    return work


def benchmark_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", limit: int = BLOCK_BYTES):
    """The items in blocks of about ``limit`` bytes of text, as lists of (id as text, text).

    Rows with a null text have no windows. Rows of one id count as one item, and so do all rows without an id.
    """
    items = benchmark.select(F.col(item_id).cast("string").alias("name"), F.col(text).cast("string").alias("text")).na.drop(subset=["text"])
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-int(total) // limit))
    part = F.pmod(F.xxhash64("name", "text"), F.lit(n))
    for k in range(n):
        yield [(r.name, r.text) for r in items.filter(part == k).toLocalIterator()]


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    keep: Sequence[str] | None = None,
    unnamed: str | None = None,
) -> DataFrame:
    """Add n_words, n_hit, hit_spans (word ranges inside occurrences), hit_items and contaminated to each document.

    * A null or empty text has no words: 0, 0, no spans, no items, not contaminated.
    * An empty benchmark, or items without words, hit nothing. Benchmark rows with a null text are left out.
    * Benchmark rows without an id hit like all others, but have no name in hit_items. ``unnamed`` names a further
      result column: whether such a row was hit.
    * Repeated documents are judged row by row; repeated benchmark rows change nothing.
    * Columns of ``docs`` named like a result are replaced; all others are returned (or those in ``keep``).

    A benchmark of up to ``block_bytes`` goes to every task as a broadcast; beyond that it is searched block by block,
    and the rows of each pass are written to the shared folder before the next, which joins its hits to them.
    """
    kept = list(docs.columns if keep is None else keep)
    results = [f.name for f in RESULT] + ["contaminated"] + ([unnamed] if unnamed else [])
    final = [c for c in kept if c.lower() not in [r.lower() for r in results]]
    with_text = [*final, *((text,) if text not in final else ())]
    found, held = None, []
    for items in benchmark_blocks(benchmark, item_id, "text", block_bytes):
        source = docs
        if found is not None:  # another block: its hits join those found so far
            held = ["_spans", "_items", "_unnamed"]
            source = stage(found, "decontaminate").withColumnsRenamed(
                {"hit_spans": "_spans", "hit_items": "_items", _UNNAMED.name: "_unnamed"}
            )
        patterns = docs.sparkSession.sparkContext.broadcast(Patterns(items, window))
        found = add_columns(source, text, [*RESULT, _UNNAMED], lambda c, p=patterns: _work(p.value)(c), [*with_text, *held])
        found = _merged(found) if held else found
    marked = found.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
    marked = marked.withColumnRenamed(_UNNAMED.name, unnamed) if unnamed else marked
    return marked.select(*final, *results)


def _merged(found: DataFrame) -> DataFrame:
    """Union of the word ranges and items of two passes over the same row."""
    spans = F.array_sort(F.concat("_spans", "hit_spans"))
    empty = F.array().cast("array<struct<first_word:int,end_word:int>>")
    joined = F.aggregate(
        spans,
        empty,
        lambda done, s: F.when(
            (F.size(done) > 0) & (s["first_word"] <= F.element_at(done, -1)["end_word"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["first_word"].alias("first_word"),
                        F.greatest(F.element_at(done, -1)["end_word"], s["end_word"]).alias("end_word"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
    total = F.aggregate(
        "hit_spans", F.lit(0).cast("long"), lambda a, s: a + (s["end_word"] - s["first_word"]).cast("long")
    )
    return (
        found.withColumn("hit_spans", joined)
        .withColumn("n_hit", total)
        .withColumn("hit_items", F.array_sort(F.array_union("_items", "hit_items")))
        .withColumn(_UNNAMED.name, F.col("_unnamed") | F.col(_UNNAMED.name))
        .drop("_spans", "_items", "_unnamed")
    )


def items_digest(items: F.Column) -> F.Column:
    """SHA-256 of the sorted item ids, comma-joined."""
    return F.sha2(F.array_join(F.array_sort(F.array_distinct(items)), ","), 256)
