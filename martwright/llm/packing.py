"""Packing token sequences along a space-filling curve.

A document's words are hashed into a vector, the vector is projected to a few dimensions, and its cell's place on the
Hilbert curve through these dimensions is the document's key. A range sort by key puts similar documents next to each
other; each task then cuts the token stream of its stretch of the curve into sequences without gaps.
"""

from __future__ import annotations

import ctypes
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField

from .batches import rows_in, rows_out
from .textkit import Words, add_columns, slices, stage, text_buffers, words_of

SEQUENCE = 1024
HASHED = 256  #: size of a hashed document vector
DIMS, BITS = 4, 12  #: projected dimensions, and bits of a coordinate
#: Bytes of tokenized stretches of each of the two generations that a worker remembers, and what an entry takes besides its
#: text and ids. A full generation takes the place of the one before. Results don't depend on it.
REMEMBERED, ENTRY = 48 << 20, 220

_PROJECTION = np.random.default_rng(5).standard_normal((HASHED, DIMS))


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of integer cells, shape (n, dims); dims * bits must be below 64."""
    x = cells.astype(np.uint64).T.copy()
    dims = len(x)
    one = np.uint64(1)
    q = one << np.uint64(bits - 1)
    while q > one:
        p = q - one
        for i in range(dims):
            flip = (x[i] & q) != 0
            swap = np.where(flip, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] ^= np.where(flip, p, swap)
            x[i] ^= swap
        q >>= one
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = one << np.uint64(bits - 1)
    while q > one:
        turn ^= np.where((x[-1] & q) != 0, q - one, np.uint64(0))
        q >>= one
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << one) | ((x[i] >> np.uint64(b)) & one)
    return key.astype(np.int64)


def document_keys(words: Words) -> np.ndarray:
    """Hilbert key of each text: signed word counts hashed to a unit vector, projected, and put into cells."""
    n = len(words.first) - 1
    h = words.hashes()
    slot = words.doc * HASHED + (h & np.uint64(HASHED - 1)).astype(np.int64)
    sign = np.where(h >> np.uint64(63), 1.0, -1.0)
    vectors = np.bincount(slot, weights=sign, minlength=n * HASHED).astype(float).reshape(n, HASHED)
    vectors /= np.maximum(np.sqrt((vectors**2).sum(axis=1, keepdims=True)), 1e-9)
    spread = 1 / (1 + np.exp(-1.702 * (vectors @ _PROJECTION)))
    return hilbert_key(np.minimum(spread * (1 << BITS), (1 << BITS) - 1), BITS)


class _Tokens:
    """Token ids of whole texts. Stretches between single spaces are tokenized once and remembered.

    Byte-level BPE never merges across a space that a printed character follows: that space begins a new stretch.
    Texts where a space is followed by something else are cut only at such spaces. A stretch with the vocabulary's
    special token in it goes to the ``tokenizers`` library, others to ``tiktoken`` with the same vocabulary.
    """

    def __init__(self, name: str) -> None:
        import base64
        import re

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self._load = lambda: Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        full = self._load()
        self._full: Tokenizer | None = None  # kept from the first text on that needs it
        self._special = [t.content for t in full.get_added_tokens_decoder().values()]
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._fast = tiktoken.Encoding(
            name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.kind = "<u2" if full.get_vocab_size() <= 1 << 16 else "<u4"
        self._code = "H" if self.kind == "<u2" else "I"
        self._odd = re.compile(r" (?![!-~]|\w)")
        self._cut = re.compile(r" (?=[!-~]|\w)")
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._weight = 0

    def _plain(self, stretch: str) -> bytes:
        ids = self._fast.encode_ordinary(stretch)
        return struct.pack(f"<{len(ids)}{self._code}", *ids)

    def _any(self, stretch: str) -> bytes:
        if not any(s in stretch for s in self._special):
            return self._plain(stretch)
        self._full = self._full or self._load()
        return np.array(self._full.encode(stretch, add_special_tokens=False).ids, self.kind).tobytes()

    def encode(self, text: str) -> bytes:
        parts = self._cut.split(text) if self._odd.search(text) else text.split(" ")
        ids_of = self._any if any(s in text for s in self._special) else self._plain
        head = ids_of(parts[0])
        rest = parts[1:]
        if self._weight > REMEMBERED:
            self._known, self._older, self._weight = {}, self._known, 0
        known, older = self._known, self._older
        try:
            return head + b"".join(map(known.__getitem__, rest))
        except KeyError:
            for part in set(rest).difference(known):
                known[part] = ids = older.get(part) or ids_of(" " + part)
                self._weight += ENTRY + 2 * len(part) + len(ids)
            return head + b"".join(map(known.__getitem__, rest))


def give_back() -> None:
    """Return freed memory to the system: a worker lives on after its task, beside the tasks of other operators."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


@lru_cache(maxsize=1)
def _tokens(name: str) -> _Tokens:
    return _Tokens(name)


def _prepare(name: str, last: int):
    def work(column: pa.Array) -> dict[str, pa.Array]:
        data, offsets, nulls = text_buffers(column)
        tokens = _tokens(name)
        end = np.array([last], tokens.kind).tobytes()
        width = len(end)
        keys, blobs = [], []
        for i, j in slices(offsets):
            keys.append(document_keys(words_of(data, offsets[i : j + 1])))
            for k in range(i, j):
                text = "" if nulls[k] else data[offsets[k] : offsets[k + 1]].tobytes().decode()
                blobs.append((tokens.encode(text) if text else b"") + end)
        made = {
            "curve_key": pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64)),
            "ids": pa.array(blobs, pa.binary()),
            "id_bytes": pa.array([width] * len(blobs), pa.int64()),
        }
        del blobs
        give_back()
        return made

    return work


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    sequence: int = SEQUENCE,
    tokenizer: str = "byte_bpe_50k",
    separator_id: int = 0,
) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): the pieces of all documents in their sequences.

    ``ids`` are unsigned 32-bit little-endian numbers. A document's tokens are those of its whole text and then
    ``separator_id``; a null or empty text has the separator only. Repeated rows are packed each for itself, and a null
    id stays null. Other columns are ignored. An empty table gives an empty result. Ties on the curve go by id and text.

    Sequences have no gaps and are full, but for the end of each task's stretch of the curve: there the rest is cut into
    sequences whose lengths are powers of two, which need no padding.

    Tokens are written once to the shared folder, as the range sort reads its input twice. Ranges are cut by (key, id),
    so a group of copies with one key spreads over as many tasks as it needs.
    """
    source = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    ).withColumn("tie", F.xxhash64("text"))
    fields = [
        StructField("curve_key", LongType()),
        StructField("ids", BinaryType()),
        StructField("id_bytes", LongType()),
    ]
    made = stage(add_columns(source, "text", fields, _prepare(tokenizer, separator_id), ["doc_id", "tie"]), "tokens")
    order = ["curve_key", "doc_id", "tie"]
    ranged = made.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids", "id_bytes")
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    schema = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        return rows_out(_fill(rows_in(batches), sequence, first), names, kinds)

    return ranged.mapInArrow(run, schema)


def _fill(rows: Iterator[tuple], size: int, sequence_id: int) -> Iterator[tuple]:
    """Cut the tokens of all rows, end to end, into sequences; the pieces of an unfinished one are held back."""
    held: list[tuple] = []
    filled = 0
    for doc_id, blob, width in rows:
        ids = np.frombuffer(blob, f"<u{width}").astype("<u4")
        at = 0
        while at < len(ids):
            n = min(size - filled, len(ids) - at)
            held.append((doc_id, at, ids[at : at + n], len(ids)))
            at += n
            filled += n
            if filled == size:
                yield from _sequence(held, sequence_id)
                held, filled, sequence_id = [], 0, sequence_id + 1
    while filled:
        part = 1 << (filled.bit_length() - 1)
        now, later, room = [], [], part
        for doc_id, start, ids, total in held:
            if room:
                now.append((doc_id, start, ids[:room], total))
            if len(ids) > room:
                later.append((doc_id, start + room, ids[room:], total))
            room = max(0, room - len(ids))
        yield from _sequence(now, sequence_id)
        held, filled, sequence_id = later, filled - part, sequence_id + 1


def _sequence(pieces: list[tuple], sequence_id: int) -> Iterator[tuple]:
    offset = 0
    for doc_id, start, ids, total in pieces:
        yield doc_id, start, len(ids), ids.tobytes(), total, sequence_id, offset
        offset += len(ids)
