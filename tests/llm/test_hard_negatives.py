import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from martwright.llm import hard_negatives as H

DDL = "vec_id long, embedding array<float>, label int, note string"


@pytest.mark.parametrize("largest, dims", [(1, 1), (3, 2), (100, 64), (160, 64), (256, 64), (5000, 7), (1 << 20, 3), (1 << 30, 2), (1 << 31, 1)])
def test_packed_products_equal_plain_ones(largest, dims):
    g = np.random.default_rng(dims)
    anchors = g.integers(-largest, largest, (9, dims), endpoint=True)
    rows = g.integers(-largest, largest, (23, dims), endpoint=True)
    anchors[0], rows[0], rows[1] = largest, largest, -largest
    fields = H.Fields(largest, dims)
    plain = [[sum(int(x) * int(y) for x, y in zip(a, c, strict=True)) for c in rows] for a in anchors]
    assert fields.scores(anchors, rows).tolist() == plain


def test_several_candidates_share_an_integer():
    assert H.Fields(100, 64).count == 2 and H.Fields(40, 4).count == 4 and H.Fields(1 << 31, 1).count == 1
    wide = H.Fields(100, 1).pack(np.array([[5], [-7], [100]]))
    assert wide.tolist()[0][0] & ((1 << H.Fields(100, 1).width) - 1) == 105


def brute(rows, every, positives=5, negatives=5):
    """All scores of every anchor; a null id comes last."""
    last = lambda k: math.inf if k is None else k
    items = set()
    for k, v, label, *_ in rows:
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            items.add((k, tuple(math.floor(256 * float(np.float32(x))) for x in v), label))
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    for a in items:
        if a[0] is None or a[0] % every:
            continue
        scored = sorted(((-dot(a[1], b[1]), last(b[0]), b) for b in items if b != a), key=lambda s: s[:2])
        for s, _, p in [x for x in scored if x[2][2] == a[2]][:positives]:
            fits = [x for x in scored if x[2][2] != a[2] and 80 * -s <= 100 * -x[0] <= 100 * -s]
            for rank, (t, _, n) in enumerate(fits[:negatives], 1):
                out.append((a[0], p[0], rank, n[0], -s, -t))
    return sorted(out, key=str)


def vectors(g, n, dims=6, labels=3):
    centres = [[g.uniform(-1, 1) for _ in range(dims)] for _ in range(4)]
    rows = [(k, [x + g.uniform(-0.3, 0.3) for x in g.choice(centres)], g.randrange(labels), "x") for k in range(n)]
    copy = rows[3][1]
    rows += [(1000 + k, copy, g.randrange(labels), "hot") for k in range(n // 3)]  # a third of all rows are one vector
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(frame, monkeypatch, small):
    if small:
        monkeypatch.setattr(H, "ANCHORS", 4)
        monkeypatch.setattr(H, "TILE_ANCHORS", 3)
        monkeypatch.setattr(H, "TILE_ROWS", 5)
    g = random.Random(2)
    rows = vectors(g, 120)
    rows += rows[10:14]  # repeated rows
    rows += [(10, [0.0] * 6, 1, "same id"), (10, [0.9] * 6, 1, "same id"), (None, rows[0][1], 0, ""), (None, rows[0][1], 1, "")]
    rows += [(2000, None, 1, ""), (2010, [1.0] * 6, None, ""), (2020, [math.nan] + [1.0] * 5, 1, ""), (2030, [math.inf] + [1.0] * 5, 1, "")]
    rows += [(2040, [None] + [1.0] * 5, 1, ""), (2050, [0.5, 0.5], 2, "short"), (2060, [], 0, "none"), (2070, [-1.0] * 6, 2, "")]
    docs = frame(DDL, rows).withColumnRenamed("note", "anchor").withColumn("RANK", F.lit(9))
    got = sorted((tuple(r) for r in H.mine(docs, F.col("vec_id") % 10 == 0).collect()), key=str)
    assert got == brute(rows, 10) and len(got) > 100


def test_positives_of_negative_score_have_no_negatives(frame):
    rows = [(0, [1.0, 0.0], 0, ""), (1, [-1.0, 0.0], 0, ""), (2, [-0.9, 0.0], 1, ""), (3, [-1.0, 0.1], 1, "")]
    assert H.mine(frame(DDL, rows), "vec_id = 0").count() == 0
    zero = [(0, [1.0, 0.0], 0, ""), (1, [0.0, 1.0], 0, ""), (2, [0.0, 0.5], 1, ""), (4, [0.001, 0.0], 1, ""), (3, [-0.5, 0.0], 1, "")]
    assert [tuple(r) for r in H.mine(frame(DDL, zero), "vec_id = 0").collect()] == [(0, 1, k, n, 0, 0) for k, n in ((1, 2), (2, 4))]


def test_large_components(frame):
    rows = [(k, [1e5 * (k % 7 - 3), 3e4 * (k % 5)], k % 2, "") for k in range(40)]
    assert sorted((tuple(r) for r in H.mine(frame(DDL, rows), "vec_id % 10 = 0").collect()), key=str) == brute(rows, 10)
    with pytest.raises(ValueError, match="may not fit"):
        H.mine(frame(DDL, [(0, [1e30], 1, "")]), "vec_id = 0")


def test_labels_of_any_type_and_anchors_of_none(frame):
    rows = vectors(random.Random(1), 60)
    docs = frame(DDL, rows)
    plain = sorted((tuple(r) for r in H.mine(docs, "vec_id % 10 = 0").collect()), key=str)
    named = docs.withColumn("label", F.concat(F.lit("class "), "label"))
    assert sorted((tuple(r) for r in H.mine(named, "vec_id % 10 = 0").collect()), key=str) == plain
    empty = H.mine(docs.limit(0), "vec_id % 10 = 0")
    assert empty.count() == 0 and H.mine(docs, "vec_id < 0").count() == 0
    assert empty.schema.simpleString() == H.mine(docs, "vec_id = 0").schema.simpleString()
