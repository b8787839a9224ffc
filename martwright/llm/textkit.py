"""Words of whole texts as flat byte and hash arrays, and the plumbing that maps texts in Arrow batches.

A word is a longest run of digits, ASCII letters (A-Z folded to a-z) and non-ASCII characters:
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. Every UTF-8 byte of a non-ASCII character is above
0x7F, so words can be cut on bytes. Null and empty texts have no words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from martwright.session import written

#: Bytes of text handled at a time; bounds the arrays of a task. A longer text is handled alone.
SLICE_BYTES = 1 << 20

SPACE = 0x20
FOLD = np.full(256, SPACE, np.uint8)
FOLD[ord("0") : ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
FOLD[0x80:] = np.arange(0x80, 0x100)


def odd_numbers(n: int, seed: int, bits: int = 64) -> np.ndarray:
    """Fixed random odd multipliers."""
    kind = np.uint64 if bits == 64 else np.uint32
    return np.random.default_rng(seed).integers(0, 1 << bits, n, dtype=kind) | kind(1)


BYTE_CODE = odd_numbers(256, 11)
BYTE_CODE[SPACE] = 0
_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 1 << 64)


class Powers:
    """Powers of the hash base and of its inverse modulo 2**64, made longer on demand."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(cls.up) < n:
            k = len(cls.up)
            cls.up = np.concatenate([cls.up, cls.up * np.uint64(pow(_BASE, k, 1 << 64))])
            cls.down = np.concatenate([cls.down, cls.down * np.uint64(pow(_UNBASE, k, 1 << 64))])
        return cls.up, cls.down


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (a bijection)."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


@dataclass
class Words:
    """Words of some texts, in order. ``stream`` holds them with a space behind each but, at times, a text's last."""

    stream: np.ndarray  #: uint8
    start: np.ndarray  #: byte offset of each word in the stream
    end: np.ndarray
    doc: np.ndarray  #: text of each word
    first: np.ndarray  #: first word of each text; one more entry than texts

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        n = len(self.stream)
        up, down = Powers.get(n + 1)
        total = np.empty(n + 1, np.uint64)
        total[0] = 0
        np.cumsum(BYTE_CODE[self.stream] * up[:n], out=total[1:])
        return mix((total[self.end] - total[self.start]) * down[self.start])


def words_of(data: np.ndarray, offsets: np.ndarray, fold: np.ndarray = FOLD) -> Words:
    """``data``: UTF-8 bytes of all texts; ``offsets``: where each begins, and the end.

    ``fold`` maps bytes; those that become a space stand between words.
    """
    n = len(offsets) - 1
    base, stop = int(offsets[0]), int(offsets[-1])
    folded = fold[data[base:stop]]
    inside = folded != SPACE
    cut = (offsets[1:-1] - base).astype(np.int64)
    cut = cut[(cut > 0) & (cut < len(folded))]
    starts, ends = inside.copy(), inside.copy()
    if len(folded):
        starts[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        starts[cut] = inside[cut]
        ends[cut - 1] = inside[cut - 1]
    keep = inside.copy()
    if len(folded):
        keep[1:] |= inside[:-1]
    at = np.flatnonzero(starts)
    place = np.cumsum(keep, dtype=np.int64) - 1
    first = np.searchsorted(at, offsets - base).astype(np.int64)
    return Words(
        stream=folded[keep],
        start=place[at],
        end=place[np.flatnonzero(ends)] + 1,
        doc=np.repeat(np.arange(n), np.diff(first)),
        first=first,
    )


def grams(h: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive word hashes; runs over the end of a text are for the caller to leave out."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    total = np.zeros(len(h) - n + 1, np.uint64)
    for j, c in enumerate(odd_numbers(n, seed)):
        total += h[j : len(h) - n + 1 + j] * c
    return mix(total)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 bytes, offsets and null mask of a string column, without copying the bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    nulls = np.asarray(column.is_null())
    column = column.cast(pa.large_string())
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64, len(column) + column.offset + 1)[column.offset :] if where else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8), offsets, nulls


def slices(offsets: np.ndarray, limit: int | None = None) -> Iterator[tuple[int, int]]:
    """Ranges of texts with at most ``limit`` bytes each, or one text."""
    limit = limit or SLICE_BYTES
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop the columns that a result is about to add; names are compared as Spark does, without case."""
    taken = {n.lower() for n in names}
    return df.select(*(f"`{c}`" for c in df.columns if c.lower() not in taken))


def add_columns(
    df: DataFrame,
    text: str,
    result: Sequence[StructField],
    work: Callable[[pa.Array], dict[str, pa.Array]],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add to each row what ``work`` makes of a batch of texts. Columns that have the name of a result are replaced.

    ``keep``: the columns of ``df`` to return (all). One narrow pass; no shuffle.
    """
    taken = {f.name.lower() for f in result}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]
    names = [f"c{i}" for i in range(len(kept))]
    source = df.select(df[text].cast("string").alias("_text"), *(df[c].alias(n) for c, n in zip(kept, names, strict=True)))
    schema = StructType([*(StructField(n, source.schema[n].dataType) for n in names), *result])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = work(batch.column(0))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *(made[f.name] for f in result)], names=[*names, *(f.name for f in result)]
            )

    done = source.mapInArrow(run, schema)
    return done.select(*(done[n].alias(c) for c, n in zip(kept, names, strict=True)), *(f.name for f in result))


def bounded_sample(rows: DataFrame, hashed: Column, limit: int) -> DataFrame:
    """The ``limit`` rows of smallest hash, then of smallest other columns; ``rows`` must be cheap to count.

    All but about one and a half times ``limit`` rows are left out by their hash before anything is sorted, so the one
    task that picks the rest gets as many rows from a table of any size.
    """
    total = rows.count()
    place = F.shiftrightunsigned(hashed, 1).cast("double") / float(1 << 63)
    near = rows.filter(place < (1.5 * limit + 200) / max(total, 1))
    return near.orderBy(hashed, *near.columns).limit(limit)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the folder that all executors share and read it back: later uses don't recompute it."""
    return written(df, f"llm-{name}")[0]
