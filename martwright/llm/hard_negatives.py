"""Hard negatives of anchor vectors: rows of another label that score just below an anchor's positives.

Scores are exact integer inner products of quantised vectors, computed as Kronecker-packed products: a bias makes all
components of several candidates non-negative, and each candidate's k-th component goes into a field of its own of one wide
integer. A multiplication by an anchor's k-th component then multiplies all of them at once; the sum over k holds the
candidates' biased scores side by side, as every field is wide enough for the largest sum that it can get. Unpacking
takes the fields apart and the bias out.

    (a + m) . (c + m)  =  a . c  +  m (sum a + sum c)  +  dims m m

The search is a stated query set (the anchors) against all rows, in blocks: anchors are dealt into blocks of bounded
size, rows into slices, and a task streams a slice past a block and keeps the best few rows of each anchor. Positives
come first; their scores bound the second pass, for negatives. Dealing is by hash of the whole row, so no label, group of
equal vectors or source makes a block or slice large.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .textkit import stage

SCALE = 256
ANCHORS = 2048  #: of a block, about
TILE_ANCHORS, TILE_ROWS = 256, 4096  #: scored at a time
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1

_FOUND = "anchor long, anchor_key long, bound int, score long, id long, key long"


@dataclass(frozen=True)
class Fields:
    """How candidates are packed into 64 bits; ``largest`` bounds the amount of every component."""

    largest: int
    dims: int

    @property
    def width(self) -> int:
        return max(1, (self.dims * (2 * self.largest) ** 2).bit_length())

    @property
    def count(self) -> int:
        """Candidates in one integer. A field wider than 64 bits wraps around, which a single score survives."""
        return max(1, 64 // self.width)

    def pack(self, rows: np.ndarray) -> np.ndarray:
        """One row of wide integers for each ``count`` rows of components, the last filled up with zeros."""
        room = np.zeros((-(-len(rows) // self.count) * self.count, self.dims), np.uint64)
        room[: len(rows)] = self.biased(rows)
        fields = room.reshape(-1, self.count, self.dims)
        wide = fields[:, 0].copy()
        for j in range(1, self.count):
            wide |= fields[:, j] << np.uint64(j * self.width)
        return wide

    def biased(self, rows: np.ndarray) -> np.ndarray:
        return (rows + np.int64(self.largest)).astype(np.uint64)

    def scores(self, anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Inner products of all anchors with all rows, both int64, through the packed product."""
        product = self.biased(anchors) @ self.pack(rows).T
        mask = np.uint64((1 << min(self.width, 64)) - 1)
        out = np.empty((len(anchors), product.shape[1], self.count), np.uint64)
        for j in range(self.count):
            out[:, :, j] = (product >> np.uint64(j * self.width)) & mask
        score = out.reshape(len(anchors), -1)[:, : len(rows)].view(np.int64)
        m = self.largest
        with np.errstate(over="ignore"):
            apart = m * (anchors.sum(axis=1)[:, None] + rows.sum(axis=1)[None, :])
            return score - apart - np.uint64(self.dims * m * m % (1 << 64)).astype(np.int64)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Lists of numbers as rows, filled up with zeros."""
    sizes = np.asarray(column.value_lengths()).astype(np.int64)
    out = np.zeros((len(column), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = np.asarray(column.flatten())
    return out


class _Block:
    """Anchors of a block, and the best rows so far for each of their bounds."""

    def __init__(self, fields: Fields, most: int, alike: bool):
        self.fields, self.most, self.alike = fields, most, alike
        self.parts: list[pa.RecordBatch] = []
        self.id = np.empty(0, np.int64)
        self.held = [np.empty(0, np.int64)] * 4  # place of the bound, score, id, key

    def add_anchors(self, batch: pa.RecordBatch) -> None:
        self.parts.append(batch)

    def close(self) -> None:
        all_ = pa.Table.from_batches(self.parts).combine_chunks().to_batches()[0]
        self.parts = []
        self.id, self.key, self.label = (np.asarray(all_.column(n)) for n in ("id", "key", "label"))
        self.vector = _matrix(all_.column("vector"), self.fields.dims)
        sizes = np.asarray(all_.column("low").value_lengths()).astype(np.int64)
        self.bounds = int(sizes.max())
        inside = np.arange(self.bounds) < sizes[:, None]
        self.low = np.full(inside.shape, _MOST, np.int64)
        self.high = np.full(inside.shape, _LEAST, np.int64)
        self.low[inside] = np.asarray(all_.column("low").flatten())
        self.high[inside] = np.asarray(all_.column("high").flatten())

    def add_rows(self, batch: pa.RecordBatch) -> None:
        if self.parts:
            self.close()
        for i in range(0, batch.num_rows, TILE_ROWS):
            tile = batch.slice(i, TILE_ROWS)
            id_, key, label = (np.asarray(tile.column(n)) for n in ("id", "key", "label"))
            rows = _matrix(tile.column("vector"), self.fields.dims)
            found = [self.held]
            for j in range(0, len(self.id), TILE_ANCHORS):
                some = slice(j, j + TILE_ANCHORS)
                score = self.fields.scores(self.vector[some], rows)
                fits = (self.label[some, None] == label) == self.alike
                fits &= (self.id[some, None] != id_) | (self.key[some, None] != key)
                for b in range(self.bounds):
                    inside = fits & (score >= self.low[some, b, None]) & (score <= self.high[some, b, None])
                    a, r = np.nonzero(inside)
                    found.append([(a + j) * self.bounds + b, score[a, r], id_[r], key[r]])
            self.keep([np.concatenate(c) for c in zip(*found, strict=True)])

    def keep(self, found: list[np.ndarray]) -> None:
        """Hold the best ``most`` of each bound, and look for nothing below them from now on."""
        bound, score, id_, key = found
        by = np.lexsort((key, id_, -score, bound))
        bound = bound[by]
        new = np.ones(len(bound), bool)
        new[1:] = bound[1:] != bound[:-1]
        first = np.flatnonzero(new)
        rank = np.arange(len(bound)) - np.repeat(first, np.diff(first, append=len(bound)))
        best = by[rank < self.most]
        self.held = [c[best] for c in found]
        full = by[rank == self.most - 1]
        low = self.low.reshape(-1)
        low[found[0][full]] = np.maximum(low[found[0][full]], found[1][full])

    def result(self) -> pa.RecordBatch:
        bound, score, id_, key = self.held
        a = bound // max(self.bounds, 1) if len(bound) else bound
        place = (bound - a * self.bounds if len(bound) else bound).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (self.id[a], self.key[a] if len(a) else a, place, score, id_, key)],
            names=["anchor", "anchor_key", "bound", "score", "id", "key"],
        )


def _search(anchors: DataFrame, rows: DataFrame, fields: Fields, n_anchors: int, most: int, alike: bool) -> DataFrame:
    """The first ``most`` rows of each anchor within each of its bounds (``low``, ``high``: lists), as _FOUND with a rank.

    ``alike``: rows of the anchor's label, other than itself; else rows of other labels.
    """
    blocks = -(-n_anchors // ANCHORS)
    slices = max(1, -(-2 * rows.sparkSession.sparkContext.defaultParallelism // blocks))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    deal = lambda n, seed: F.pmod(F.xxhash64("key", "id", F.lit(seed)), F.lit(n)).cast("int")
    common = ["id", "key", "label", "vector"]
    left = anchors.select(deal(blocks, 1).alias("block"), numbers(slices).alias("slice"), F.lit(0).alias("kind"), *common, "low", "high")
    none = F.lit(None).cast("array<long>")
    right = rows.select(
        numbers(blocks).alias("block"), deal(slices, 2).alias("slice"), F.lit(1).alias("kind"), *common, none.alias("low"), none.alias("high")
    )
    dealt = left.unionByName(right).repartition("block", "slice").sortWithinPartitions("block", "slice", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, block = None, None
        for batch in batches:
            where = np.stack([np.asarray(batch.column(n)) for n in ("block", "slice", "kind")])
            new = np.flatnonzero(np.any(where[:, 1:] != where[:, :-1], axis=0)) + 1
            for i, j in zip([0, *new], [*new, batch.num_rows], strict=True):
                if i == j:
                    continue
                if tuple(where[:2, i]) != at:
                    if block:
                        yield block.result()
                    at, block = tuple(where[:2, i]), _Block(fields, most, alike)
                part = batch.slice(i, j - i)
                if where[2, i] == 0:
                    block.add_anchors(part)
                elif block.parts or len(block.id):
                    block.add_rows(part)
        if block:
            yield block.result()

    found = dealt.mapInArrow(run, _FOUND)
    return _first(found, most)


def _first(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("anchor", "anchor_key", "bound").orderBy(F.desc("score"), "id", "key")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def mine(
    vectors: DataFrame,
    anchor: Column | str,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = 5,
    negatives: int = 5,
    least_percent: int = 80,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for each anchor and positive.

    ``anchor`` says which rows are anchors. Components become ``floor(256 x)``; a score is the inner product of these.
    An anchor's positives are the ``positives`` other rows of its label of the highest scores. The negatives of a positive
    are the ``negatives`` rows of other labels of the highest scores between ``least_percent`` of the positive's score
    and that score. Ties go to the smaller id.

    * Rows with a null label, a null vector, or a null or non-finite component take no part. Shorter vectors count as
      filled up with zeros.
    * Rows alike in id, label and quantised vector are one row. Rows that share an id but differ are rows of their own.
    * A null id comes after all other ids (as the largest long does).
    * An anchor without positives, or a positive without negatives, has no rows. Other columns are ignored.
    * An empty table, or one without anchors, gives an empty result. If a score might not fit a long, a ValueError says so.
    """
    whole = F.col(vector).cast("array<double>")
    finite = F.forall(whole, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    kind = F.col(label)
    kind = kind.cast("long") if isinstance(vectors.schema[label].dataType, IntegralType) else F.xxhash64(kind)
    taken = vectors.filter(F.col(label).isNotNull() & F.col(vector).isNotNull() & finite).select(
        F.coalesce(F.col(vec_id).cast("long"), F.lit(_MOST)).alias("id"),
        kind.alias("label"),
        F.transform(whole, lambda x: F.floor(x * SCALE)).alias("vector"),
        F.coalesce(F.expr(anchor) if isinstance(anchor, str) else anchor, F.lit(False)).alias("is_anchor"),
    )
    rows = taken.groupBy("id", "label", "vector").agg(F.max("is_anchor").alias("is_anchor"))
    rows = stage(rows.withColumn("key", F.xxhash64("id", "label", "vector")), "vectors")
    size = F.transform("vector", lambda x: F.abs(x.cast("double")))
    facts = rows.agg(
        F.count_if("is_anchor").alias("anchors"), F.max(F.size("vector")).alias("dims"), F.max(F.array_max(size)).alias("largest")
    ).first()
    fields = Fields(int(facts.largest or 0) or 1, facts.dims or 1)
    if fields.dims * fields.largest**2 >= 1 << 63:
        raise ValueError(f"scores of {fields.dims} components of up to {fields.largest} may not fit a long")
    spark = vectors.sparkSession
    if not facts.anchors:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")

    every = lambda x: F.array(F.lit(x).cast("long"))
    anchors = rows.filter("is_anchor")
    near = _search(anchors.withColumns({"low": every(_LEAST), "high": every(_MOST)}), rows, fields, facts.anchors, positives, True)
    near = stage(near.select("anchor", "anchor_key", (F.col("rank") - 1).alias("bound"), "id", "score"), "positives")

    inner = lambda p: F.ceil(p["score"] * F.lit(least_percent).cast("decimal(3,0)") / 100)
    ranked = near.groupBy(F.col("anchor").alias("id"), F.col("anchor_key").alias("key")).agg(
        F.array_sort(F.collect_list(F.struct("bound", "score"))).alias("p")
    )
    limits = ranked.select(
        "id", "key", F.transform("p", lambda p: inner(p).cast("long")).alias("low"), F.transform("p", lambda p: p["score"]).alias("high")
    )
    far = _search(anchors.join(limits, ["id", "key"]), rows, fields, facts.anchors, negatives, False)

    named = lambda c: F.when(F.col(c) != _MOST, F.col(c))
    far = far.select("anchor", "anchor_key", "bound", "rank", named("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return far.join(near, ["anchor", "anchor_key", "bound"]).select(
        named("anchor").alias("anchor_id"), named("id").alias("positive_id"), "rank", "negative_id",
        F.col("score").alias("positive_score"), "negative_score",
    )
