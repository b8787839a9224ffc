"""Periodic runs of words in a text, by an enhanced suffix array.

A run is a stretch of consecutive words of smallest period q, of at least 24 words and three periods, that no
neighbouring word extends at this period: a phrase said over and over, a table row without end. Words are runs of bytes
other than space and tab to carriage return.

Every run ends with exactly one *branching tandem*: a square of two periods whose second half is followed by another word
than its first. The suffixes at its two halves share q words and no more, so both lie in the LCP interval of depth q that
joins them, in different children. The search goes over LCP intervals and builds no tree:

1. A suffix array of all texts of a slice, by prefix doubling over the suffixes that are still alike. Words of
   different texts have different numbers, so no interval goes over the end of a text.
2. Depths of neighbours (the LCP array), from the classes that doubling went through; then each interval's ends, as the
   nearest smaller depth on both sides, by binary descent over minima of blocks.
3. For each interval of depth q, the suffixes i of all children but the largest: where the inverse suffix array puts i + q
   or i - q into the interval, outside i's own child, a branching tandem stands there. A suffix is looked at in at most
   log2(n) intervals.
4. *Rotate*: squares are moved left as long as the word before them equals the one a period later, which gives the run.
   Stretches found at several periods keep the smallest.

A text in which no 16 words stand twice has no run, and needs no suffix array.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .textkit import SPACE, Powers, Words, add_columns, mix, odd_numbers, slices, text_buffers, words_of

LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Suffixes looked at in one go; bounds the arrays of step 3.
BLOCK = 1 << 21

#: Spaces, tabs and line ends become a space; all other bytes belong to words.
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[0x09 : 0x0D + 1] = SPACE
_TEXT_CODE = odd_numbers(1, 23)[0]


@dataclass
class SuffixArray:
    """Suffixes of a sequence in order, with the classes of equal starts of 1, 2, 4, ... words."""

    order: np.ndarray  #: suffixes, smallest first
    place: np.ndarray  #: its inverse
    classes: list[np.ndarray]  #: entry k: equal numbers where 2**k words are equal, for as long as any are

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of words that the suffixes at a and b share."""
        n = np.zeros(len(a), np.int64)
        for k in range(len(self.classes) - 1, -1, -1):
            n += (self.classes[k][a + n] == self.classes[k][b + n]).astype(np.int64) << k
        return n


def suffix_array(sequence: np.ndarray) -> SuffixArray:
    """Prefix doubling. Equal numbers must not reach the end of ``sequence``: its last entry stands nowhere else."""
    n = len(sequence)
    kinds, sizes = np.unique(sequence, return_inverse=True, return_counts=True)[1:]
    rank = (np.cumsum(sizes) - sizes)[kinds]
    alike = np.flatnonzero(sizes[kinds] > 1)
    classes, h = [], 1
    while len(alike):
        classes.append(rank.astype(np.int32))
        key = rank[alike] * np.int64(n) + rank[alike + h]
        by = np.argsort(key, kind="stable")
        key, alike = key[by], alike[by]
        old = rank[alike]
        new, group = np.ones(len(key), bool), np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        group[1:] = old[1:] != old[:-1]
        at = np.arange(len(key))
        first, begin = np.flatnonzero(new), np.flatnonzero(group)
        count = np.diff(first, append=len(key))
        rank[alike] = old + np.repeat(first, count) - np.repeat(begin, np.diff(begin, append=len(key)))
        alike = alike[np.repeat(count > 1, count)] if len(at) else alike
        h *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return SuffixArray(order, rank, classes)


def nearest_smaller(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each place in ``at``, the nearest place to its left with a smaller value; there must be one.

    Goes up the minima of blocks of 2, 4, 8, ... values until a block to the left holds a smaller one, then down in it.
    """
    levels = [values]
    while len(levels[-1]) > 1:
        low = levels[-1]
        if len(low) % 2:
            low = np.append(low, low[-1])
        levels.append(np.minimum(low[::2], low[1::2]))
    bound = values[at]
    block, level = at.copy(), np.full(len(at), -1, np.int64)
    going = np.arange(len(at))
    for k, low in enumerate(levels):
        here = block[going]
        left = (here % 2 == 1) & (low[here - 1] < bound[going])
        level[going[left]] = k
        block[going[left]] -= 1
        going = going[~left]
        if not len(going):
            break
        block[going] >>= 1
    for k in range(len(levels) - 1, 0, -1):
        down = np.flatnonzero(level >= k)
        right = 2 * block[down] + 1
        low = levels[k - 1]
        inside = right < len(low)
        inside[inside] = low[right[inside]] < bound[down][inside]
        block[down] = right - ~inside
    return block


def _spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of each span, one after the other."""
    begin = np.cumsum(size) - size
    return np.repeat(first - begin, size) + np.arange(int(size.sum()))


def branching_tandems(suffixes: SuffixArray, deepest: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of all squares whose halves are followed by different words, of periods up to ``deepest``."""
    order, place = suffixes.order, suffixes.place
    n = len(order)
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    depth = np.full(n + 1, -1, np.int64)
    depth[1:n] = 0
    if suffixes.classes:
        start = suffixes.classes[0]
        near = np.flatnonzero(start[order[1:]] == start[order[:-1]]) + 1
        depth[near] = suffixes.common(order[near - 1], order[near])
    border = np.flatnonzero((depth > 0) & (depth <= deepest))
    if not len(border):
        return none
    low = nearest_smaller(depth, border)
    high = n - nearest_smaller(depth[::-1], n - border)  # exclusive
    # Borders with one left end and depth part the children of one interval.
    by = np.lexsort((border, depth[border], low))
    border, low, high = border[by], low[by], high[by]
    q = depth[border]
    new = np.ones(len(border), bool)
    new[1:] = (low[1:] != low[:-1]) | (q[1:] != q[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(border))
    child_low, child_high = np.insert(border, first, low[first]), np.insert(border, last, high[first])
    of = np.repeat(np.arange(len(first)), last - first + 1)
    size = child_high - child_low
    head = first + np.arange(len(first))
    largest = np.flatnonzero(size == np.maximum.reduceat(size, head)[of])
    largest = largest[np.unique(of[largest], return_index=True)[1]]
    small = np.ones(len(of), bool)
    small[largest] = False
    child_low, child_high, of, size = child_low[small], child_high[small], of[small], size[small]

    found = []
    total = np.cumsum(size)
    i = 0
    while i < len(size):
        done = total[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(total, done + BLOCK, "right")))
        at = _spans(child_low[i:j], size[i:j])
        child = np.repeat(np.arange(i, j), size[i:j])
        one, period = order[at], q[first[of[child]]]
        for other in (one + period, one - period):
            inside = (other >= 0) & (other < n)
            where = place[np.where(inside, other, 0)]
            inside &= (where >= low[first[of[child]]]) & (where < high[first[of[child]]])
            inside &= (where < child_low[child]) | (where >= child_high[child])
            found.append(np.stack([np.minimum(one, other)[inside], period[inside]]))
        i = j
    return tuple(np.unique(np.concatenate(found, axis=1), axis=1)) if found else none


def rotate_left(suffixes: SuffixArray, place: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Where the squares get to if moved left while the word before them equals the one a period later."""
    at = place.copy()
    for k in range(len(suffixes.classes) - 1, -1, -1):
        before = at - (1 << k)
        inside = before >= 0
        same = suffixes.classes[k]
        inside[inside] = same[before[inside]] == same[(before + period)[inside]]
        at -= inside.astype(np.int64) << k
    return at


def runs_of(
    words: Words, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs, in order of text, start and period; starts count from the text's first word.

    Words of a text are told apart by 64-bit hashes.
    """
    none = (np.empty(0, np.int64),) * 4
    # A run's first suffix and the one a period later share so many words.
    shared = min(least - least // periods, (periods - 1) * (least // periods + 1))
    n = len(words.start)
    if n <= shared:
        return none
    number = words.hashes() + words.doc.astype(np.uint64) * _TEXT_CODE
    up, down = Powers.get(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(number * up[:n], out=total[1:])
    gram = mix((total[shared:] - total[: n - shared + 1]) * down[: n - shared + 1])
    by = np.argsort(gram)
    twice = np.flatnonzero(gram[by[1:]] == gram[by[:-1]])
    texts = np.unique(words.doc[by[twice]])
    if not len(texts):
        return none
    # The words of these texts, with an entry of its own behind each text.
    begin, size = words.first[texts], words.first[texts + 1] - words.first[texts]
    kinds = np.unique(number[_spans(begin, size)], return_inverse=True)[1]
    end = np.cumsum(size + 1) - 1
    sequence = np.empty(end[-1] + 1, np.int64)
    behind = np.zeros(len(sequence), bool)
    behind[end] = True
    sequence[~behind] = kinds
    sequence[behind] = len(kinds) + np.arange(len(texts))
    suffixes = suffix_array(sequence)
    place, period = branching_tandems(suffixes, int(size.max()) // periods)
    start = rotate_left(suffixes, place, period)
    stop = place + 2 * period
    long = stop - start >= np.maximum(least, periods * period)
    start, stop, period = start[long], stop[long], period[long]
    by = np.lexsort((period, stop, start))
    start, stop, period = start[by], stop[by], period[by]
    smallest = np.ones(len(start), bool)
    smallest[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    start, stop, period = start[smallest], stop[smallest], period[smallest]
    by = np.lexsort((period, start))
    start, stop, period = start[by], stop[by], period[by]
    of = np.searchsorted(end, start)
    return texts[of], start - (end[of] - size[of]), stop - start, period


def collapse(words: Words, text: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts without the words behind a run's first period; words are joined by one space."""
    n, texts = len(words.start), len(words.first) - 1
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, words.first[text] + start + period, 1)
    np.add.at(change, words.first[text] + start + length, -1)
    kept = np.flatnonzero(np.cumsum(change[:n]) == 0)
    size = words.end[kept] - words.start[kept]
    last = np.ones(len(kept), bool)
    last[:-1] = words.doc[kept[1:]] != words.doc[kept[:-1]]
    room = size + ~last
    offsets = np.zeros(texts + 1, np.int64)
    np.cumsum(np.bincount(words.doc[kept], room, texts).astype(np.int64), out=offsets[1:])
    out = np.full(int(offsets[-1]), SPACE, np.uint8)
    begin = np.cumsum(room) - room
    out[_spans(begin, size)] = words.stream[_spans(words.start[kept], size)]
    return out, offsets


_RUN = StructType([StructField(n, LongType()) for n in ("start", "length", "period")])
_RESULT = [StructField("n_words", LongType()), StructField("runs", ArrayType(_RUN)), StructField("collapsed", StringType())]


def _chunks(column: pa.Array, least: int, periods: int) -> Iterator[tuple[pa.Array, pa.Array, pa.Array]]:
    data, offsets, _ = text_buffers(column)
    for i, j in slices(offsets):
        words = words_of(data, offsets[i : j + 1], _PLAIN)
        text, start, length, period = runs_of(words, least, periods)
        where = np.searchsorted(text, np.arange(j - i + 1)).astype(np.int32)
        runs = pa.StructArray.from_arrays([pa.array(c) for c in (start, length, period)], names=_RUN.names)
        raw, ends = collapse(words, text, start, length, period)
        short = pa.Array.from_buffers(pa.large_string(), j - i, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw.tobytes())])
        yield pa.array(np.diff(words.first)), pa.ListArray.from_arrays(pa.array(where), runs), short.cast(pa.string())


def periodic_runs(
    docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS
) -> DataFrame:
    """Add ``n_words``, ``runs`` (start, length, period in words, by start and period) and ``collapsed`` to each document.

    ``collapsed`` is the text without the words that any run holds behind its first period, joined by single spaces.
    ``least`` and ``periods`` (2 at least) say how many words and periods a run must have.

    * A null or empty text, or one without words, has no words, no runs and an empty ``collapsed``.
    * Each row is judged by itself, so repeated rows have equal results. Columns named like a result are replaced, all
      others returned (or those in ``keep``). An empty table gives an empty result.
    * Texts are handled about a megabyte at a time, and whole: one longer text is handled alone.
    """
    if periods < 2 or least < periods:
        raise ValueError("a run needs two periods at least, and a word in each")

    def work(column: pa.Array) -> dict[str, pa.Array]:
        parts = list(zip(*_chunks(column, least, periods), strict=True))
        if not parts:
            return {f.name: pa.array([], t) for f, t in zip(_RESULT, _TYPES, strict=True)}
        return {f.name: pa.concat_arrays(p) for f, p in zip(_RESULT, parts, strict=True)}

    return add_columns(docs, text, _RESULT, work, keep)


_TYPES = [pa.int64(), pa.list_(pa.struct([(n, pa.int64()) for n in _RUN.names])), pa.string()]
