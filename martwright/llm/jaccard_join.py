"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of five-word shingles; two are linked if the Jaccard similarity of their sets is 0.8 or more.

1. Documents with equal sets form one *class*, and only classes are compared: copies cost nothing further.
2. Each class has 128 MinHash values. Classes that agree on one of 32 bands of 4 values are candidates; a pair at the
   threshold meets in no band with probability (1 - 0.8^4)^32, less than 1 in 10 million.
3. Candidate pairs compare their MinHash values eight at a time. After each step the posterior probability of reaching
   the threshold, from a uniform prior, is known from the count of agreements; a pair whose posterior is below
   TOLERANCE is dropped. What survives joins classes into *clusters*.
4. Inside clusters all pairs are verified exactly on the shingle sets.

Buckets and clusters of any size are split into blocks of bounded size, and every block meets every other one in a task
of its own, so no group is left out, capped or collected. Pairs exist only inside a task's arrays.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import groupby
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField

from martwright.operators.joins import attach

from .batches import rows_in, rows_out
from .components import components
from .textkit import Words, add_columns, grams, mix, odd_numbers, slices, stage, text_buffers, words_of

SHINGLE = 5
THRESHOLD = (4, 5)  #: least similarity, as a fraction
HASHES, STEP, ROWS = 128, 8, 4
TOLERANCE = 1e-6
BUCKET_BLOCK = 256  #: classes of a bucket compared at a time
CLUSTER_BLOCK = 512  #: classes of a cluster verified at a time,
CLUSTER_SHINGLES = 2_000_000  #: and about so many shingles

_SLOPE = odd_numbers(HASHES, 21, 32)
_FLIP = odd_numbers(HASHES, 22, 32)


def shingle_sets(words: Words) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text. One to four words are a single shingle; no words, none."""
    h = words.hashes()
    runs = grams(h, SHINGLE, 31)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(runs[a : b - SHINGLE + 1]))
        elif b > a:
            out.append(grams(h[a:b], b - a, 31) ^ np.uint64(b - a))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def minhash(shingles: np.ndarray) -> np.ndarray:
    """The 128 MinHash values of a set, 16 bits each."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(x), 512):
        np.minimum(least, ((x[k : k + 512, None] ^ _FLIP) * _SLOPE).min(axis=0), out=least)
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype("<u2")


def least_agreements(threshold: float, tolerance: float = TOLERANCE) -> list[int]:
    """Per step, the fewest agreements with which a pair may still reach the threshold.

    With a uniform prior and m of n values equal, the similarity has a Beta(m + 1, n - m + 1) posterior, and the
    probability that it is at least t is that of at most m successes in n + 1 trials with chance t.
    """
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def surviving_pairs(a: np.ndarray, b: np.ndarray | None, least: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows (of ``a``, or of ``a`` and ``b``) that no step drops."""
    i, j = np.triu_indices(len(a), 1) if b is None else (x.ravel() for x in np.indices((len(a), len(b))))
    other = a if b is None else b
    agree = np.zeros(len(i), np.int16)
    for step, fewest in enumerate(least):
        part = slice(step * STEP, (step + 1) * STEP)
        agree += (a[i, part] == other[j, part]).sum(axis=1, dtype=np.int16)
        stay = agree >= fewest
        i, j, agree = i[stay], j[stay], agree[stay]
    return i, j


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest row that each row hangs together with."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = np.minimum(new, new[new])
        if (new == root).all():
            break
        root = new
    return root


def _signatures(column: pa.Array) -> dict[str, pa.Array]:
    data, offsets, _ = text_buffers(column)
    prints, sizes, values = [], [], []
    for i, j in slices(offsets):
        for s in shingle_sets(words_of(data, offsets[i : j + 1])):
            sizes.append(len(s))
            whole = np.array([mix(s).sum(dtype=np.uint64), mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)])
            prints.append((whole + np.uint64(len(s))).astype("<u8").tobytes())
            values.append(minhash(s).tobytes())
    return {
        "print": pa.array(prints, pa.binary()),
        "n_shingles": pa.array(sizes, pa.int64()),
        "minhash": pa.array(values, pa.binary()),
    }


def _blocks(size: Column, block: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(size / F.lit(block))).cast("int")


def _in_blocks(rows: DataFrame, group: str, key: str, n_blocks: str) -> DataFrame:
    """Give every row to the tasks (group, low, high) of its block with each block of its group, itself included."""
    mine = F.pmod(F.xxhash64(key), F.col(n_blocks)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col(n_blocks) - 1)).alias("other")
    return (
        rows.withColumn("block", mine)
        .select("*", other)
        .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
        .drop("other", n_blocks)
    )


def _groups(rows: Iterator[tuple], width: int) -> Iterator[tuple[tuple, list[tuple]]]:
    for key, members in groupby(rows, key=lambda r: r[:width]):
        yield key, list(members)


def _clusters(classes: DataFrame) -> DataFrame:
    """Star links (a, b) between classes that may be similar: candidates of the bands, pruned."""
    bands = [
        F.xxhash64(F.lit(b), F.substring("minhash", 2 * ROWS * b + 1, 2 * ROWS)) for b in range(HASHES // ROWS)
    ]
    members = classes.select("print", F.explode(F.array(*bands)).alias("bucket"))
    sizes = (
        members.groupBy("bucket")
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.bit_xor(F.xxhash64("print")).alias("one"),
            F.bit_xor(F.xxhash64(F.lit(1), "print")).alias("two"),
        )
        .filter("size > 1")
    )
    # The same classes often meet in many bands; one bucket of each such set is enough.
    buckets = sizes.groupBy("size", "one", "two").agg(F.min("bucket").alias("bucket"))
    buckets = buckets.select("bucket", _blocks(F.col("size"), BUCKET_BLOCK).alias("n_blocks"))
    rows = _in_blocks(attach(members, buckets, "bucket", "inner"), "bucket", "print", "n_blocks")
    rows = rows.join(classes.select("print", "minhash"), "print")
    key = ["bucket", "low", "high"]
    dealt = rows.select(*key, "block", "print", "minhash").repartition(*key).sortWithinPartitions(*key, "block", "print")
    least = least_agreements(THRESHOLD[0] / THRESHOLD[1])

    def links(rows: Iterator[tuple]) -> Iterator[tuple]:
        for (_, low, high), group in _groups(rows, 3):
            prints = [r[4] for r in group]
            values = np.frombuffer(b"".join(r[5] for r in group), "<u2").reshape(-1, HASHES)
            first = sum(r[3] == low for r in group)
            if low == high:
                i, j = surviving_pairs(values, None, least)
            else:
                i, j = surviving_pairs(values[:first], values[first:], least)
                j = j + first
            root = _roots(len(group), i, j)
            for k in np.flatnonzero(root != np.arange(len(group))):
                yield prints[k], prints[root[k]]

    kinds = [pa.binary(), pa.binary()]
    return dealt.mapInArrow(lambda b: rows_out(links(rows_in(b)), ["a", "b"], kinds), "a binary, b binary")


def linked_pairs(sets: Sequence[np.ndarray], first: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets with similarity at or above the threshold, by exact intersection sizes.

    ``first``: only pairs between the first so many sets and the others.
    """
    n = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(n), size)
    shared = np.bincount(column, minlength=len(values)) > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    row, column = row[keep], place[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((n, n), np.float64)
    width = max(256, (8 << 20) // max(n, 1) // 4)
    for low in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [low, low + width])
        table = np.zeros((n, width), np.float32)
        table[row[a:b], column[a:b] - low] = 1
        common += table @ table.T
    p, q = THRESHOLD
    both = common.astype(np.int64)
    i, j = np.nonzero(np.triu((p + q) * both >= p * (size[:, None] + size[None, :]), 1))
    if first is not None:
        across = (i < first) & (j >= first)
        i, j = i[across], j[across]
    return i, j


def _verify(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(print, links, root): per class and task the linked documents outside the class, and a star link."""
    sizes = members.groupBy("cluster").agg(
        F.greatest(
            _blocks(F.count(F.lit(1)), CLUSTER_BLOCK), _blocks(F.sum("n_shingles"), CLUSTER_SHINGLES)
        ).alias("n_blocks")
    )
    rows = _in_blocks(attach(members, sizes, "cluster", "inner"), "cluster", "print", "n_blocks")
    # One document of each class brings the text; documents of no cluster stay behind in this join.
    found = docs.join(rows.hint("shuffle_hash"), ["_id", "_hash"])
    key = ["cluster", "low", "high"]
    dealt = (
        found.select(*key, "block", "print", "copies", "_text")
        .repartition(*key)
        .sortWithinPartitions(*key, "block", "print")
    )

    def links(rows: Iterator[tuple]) -> Iterator[tuple]:
        for (_, low, high), group in _groups(rows, 3):
            group = [next(same) for _, same in groupby(group, key=lambda r: r[4])]
            texts = [r[6].encode() for r in group]
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
            data = np.frombuffer(b"".join(texts), np.uint8)
            sets: list[np.ndarray] = []
            for a, b in slices(offsets):
                sets += shingle_sets(words_of(data, offsets[a : b + 1]))
            first = None if low == high else sum(r[3] == low for r in group)
            i, j = linked_pairs(sets, first)
            copies = np.array([r[5] for r in group], np.float64)
            n = np.bincount(i, copies[j], len(group)) + np.bincount(j, copies[i], len(group))
            root = _roots(len(group), i, j)
            for k in np.flatnonzero(n):
                yield group[k][4], int(n[k]), group[root[k]][4]

    kinds = [pa.binary(), pa.int64(), pa.binary()]
    names = ["print", "links", "root"]
    return dealt.mapInArrow(
        lambda b: rows_out(links(rows_in(b)), names, kinds), "print binary, links long, root binary"
    )


def jaccard_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, class_id, n_links, n_copies, keeps): one row per document row.

    ``class_id`` is the smallest id among all documents that links hang together; ``n_links`` counts the other document
    rows with similarity 0.8 or more, copies included; ``n_copies`` counts rows with the same shingle set. ``text_hash``
    is ``xxhash64`` of the text. ``keeps`` is true for one document of each group: that of the smallest id, and among
    rows of that id the smallest text hash (equal rows all carry it).

    * Texts of one to four words are one shingle, so they are linked to equal word lists only.
    * A null text or one without words has no links and is a group of its own, kept.
    * A null id counts as smaller than all others.
    * Repeated rows are copies of each other. Other columns are ignored. An empty table gives an empty result.
    """
    source = docs.select(
        F.col(doc_id).cast("long").alias("_id"), F.col(text).cast("string").alias("_text")
    ).withColumn("_hash", F.xxhash64("_text"))
    fields = [
        StructField("print", BinaryType()),
        StructField("n_shingles", LongType()),
        StructField("minhash", BinaryType()),
    ]
    # A null id is worked on as the smallest number, so that joins find it.
    lowest = F.lit(-(1 << 63)).cast("long")
    source = source.withColumn("_id", F.coalesce("_id", lowest))
    signed = stage(add_columns(source, "_text", fields, _signatures, ["_id", "_hash"]), "signatures")
    classes = stage(
        signed.filter("n_shingles > 0")
        .groupBy("print")
        .agg(
            F.min(F.struct("_id", "_hash")).alias("first"),
            F.count(F.lit(1)).alias("copies"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("minhash").alias("minhash"),
        )
        .select("print", "first._id", "first._hash", "copies", "n_shingles", "minhash"),
        "classes",
    )
    clusters = components(_clusters(classes))
    members = classes.drop("minhash").join(
        clusters.select(F.col("node").alias("print"), F.col("root").alias("cluster")), "print"
    )
    checked = stage(_verify(source, members), "verified")
    groups = components(checked.select(F.col("print").alias("a"), F.col("root").alias("b")))
    links = checked.groupBy("print").agg(F.sum("links").alias("links"))
    known = (
        classes.select("print", "_id", "_hash", "copies")
        .join(links, "print", "left")
        .join(groups.withColumnRenamed("node", "print"), "print", "left")
        .withColumn("root", F.coalesce("root", "print"))
    )
    heads = known.groupBy("root").agg(F.min(F.struct("_id", "_hash")).alias("head"))
    known = attach(known, heads, "root").select(
        "print",
        "head",
        "copies",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    rows = attach(signed.select("_id", "_hash", "n_shingles", "print"), known, "print")
    alone = F.col("n_shingles") == 0
    given = lambda c: F.when(c != lowest, c)
    return rows.select(
        given(F.col("_id")).alias("doc_id"),
        F.col("_hash").alias("text_hash"),
        given(F.when(alone, F.col("_id")).otherwise(F.col("head._id"))).alias("class_id"),
        F.when(alone, 0).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        F.when(alone, 1).otherwise(F.col("copies")).cast("long").alias("n_copies"),
        (alone | (F.struct("_id", "_hash") == F.col("head"))).alias("keeps"),
    )
