"""Rows in and out of Arrow batches, one at a time."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa


def rows_in(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of all batches, in order."""
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def rows_out(
    rows: Iterable[Sequence], names: Sequence[str], kinds: Sequence[pa.DataType], most_rows: int = 2000, most_chars: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """Gather rows into batches of at most so many rows and about so many characters."""
    held: list = []
    chars = 0
    for row in rows:
        held.append(row)
        chars += sum(len(v) for v in row if isinstance(v, (str, bytes)))
        if len(held) >= most_rows or chars >= most_chars:
            yield _batch(held, names, kinds)
            held, chars = [], 0
    if held:
        yield _batch(held, names, kinds)


def _batch(rows, names, kinds) -> pa.RecordBatch:
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=list(names))
