import random
import re

import numpy as np
import pytest

from martwright.llm import jaccard_join as J
from martwright.llm.components import components


def shingles(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", folded)
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def brute_force(docs):
    sets = [shingles(t) for _, t in docs]
    n = len(docs)
    near = [[j for j in range(n) if j != i and sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(n)]
    group = list(range(n))
    moved = True
    while moved:
        moved = False
        for i in range(n):
            low = min([group[i], *(group[j] for j in near[i])])
            moved, group[i] = moved or low != group[i], low
    rank = lambda k: (k is not None, k or 0)
    least = {g: min((docs[i][0] for i in range(n) if group[i] == g), key=rank) for g in set(group)}
    return sorted(
        ((docs[i][0], least[group[i]], len(near[i]), 1 if not sets[i] else sum(s == sets[i] for s in sets)) for i in range(n)),
        key=lambda r: (rank(r[0]), rank(r[1]), r[2:]),
    )


def corpus(seed):
    g = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    docs = []
    for _ in range(25):
        base = [g.choice(vocabulary) for _ in range(g.choice([6, 20, 60, 150]))]
        for _ in range(g.choice([1, 1, 2, 6])):
            copy = list(base)
            for _ in range(g.choice([0, 0, 1, 2, 3])):
                copy[g.randrange(len(copy))] = g.choice(vocabulary)
            docs.append(" ".join(copy))
    return [(k, t) for k, t in enumerate(docs)]


HARD = [(900, None), (901, ""), (902, " .,;"), (903, "one two"), (904, "One, two!"), (905, "two one"), (906, "a b c d"),
        (907, "a b c d e"), (908, "x y " * 4000), (909, "y x " * 4000), (3, "w1 w2 w3 w4 w5 w6"), (910, "w1 w2 w3 w4 w5 w6")]


@pytest.mark.parametrize("blocks", [None, (3, 4)])
def test_equals_brute_force(frame, monkeypatch, blocks):
    if blocks:
        monkeypatch.setattr(J, "BUCKET_BLOCK", blocks[0])
        monkeypatch.setattr(J, "CLUSTER_BLOCK", blocks[1])
    docs = corpus(1) + HARD + corpus(1)[:3] + [(None, corpus(1)[5][1])]
    rows = J.jaccard_join(frame("doc_id long, text string, PRINT string, links int", [(*d, "x", 1) for d in docs])).collect()
    got = [(r.doc_id, r.class_id, r.n_links, r.n_copies) for r in rows]
    rank = lambda k: (k is not None, k or 0)
    assert sorted(got, key=lambda r: (rank(r[0]), rank(r[1]), r[2:])) == brute_force(docs)
    for c in {r.class_id for r in rows}:
        mine = {(r.doc_id, r.text_hash, r.keeps) for r in rows if r.class_id == c}
        if c is not None and c < 900 and c != 3:  # two groups begin with an id 3
            assert sum(k for *_, k in mine) == 1


def test_large_group_of_near_copies(documents, monkeypatch):
    """Every pair of a group counts, though its buckets and its cluster are cut into blocks."""
    monkeypatch.setattr(J, "BUCKET_BLOCK", 16)
    monkeypatch.setattr(J, "CLUSTER_BLOCK", 16)
    base = [f"w{k}" for k in range(200)]
    docs = [" ".join([*base[:k], f"own{k}", *base[k + 1 :]]) for k in range(60)]
    rows = J.jaccard_join(documents(dict(enumerate(docs)))).collect()
    assert {(r.class_id, r.n_links) for r in rows} == {(0, 59)}


def test_empty_table(documents):
    assert J.jaccard_join(documents({})).count() == 0


def test_posterior():
    """A pair is dropped only if a beta posterior, summed up numerically, is below the tolerance."""
    x = (np.arange(200_000) + 0.5) / 200_000
    for step, fewest in enumerate(J.least_agreements(0.8)):
        n = (step + 1) * J.STEP
        for m in (fewest - 1, fewest):
            if m >= 0:
                density = np.exp(m * np.log(x) + (n - m) * np.log1p(-x) + 0)
                tail = density[x >= 0.8].sum() / density.sum()
                assert (tail < J.TOLERANCE) == (m < fewest)


def test_minhash_agreement_estimates_similarity():
    g = np.random.default_rng(0)
    for share in (0.2, 0.5, 0.8, 0.95):
        agree = []
        for _ in range(60):
            both = g.integers(0, 1 << 63, int(share * 300), dtype=np.uint64)
            rest = g.integers(0, 1 << 63, (2, (300 - len(both)) // 2), dtype=np.uint64)
            a, b = (J.minhash(np.concatenate([both, r])) for r in rest)
            agree.append((a == b).mean())
        assert abs(np.mean(agree) - share) < 0.03


def test_components_of_a_long_chain(spark):
    n = 300
    edges = spark.createDataFrame([(k, k + 1) for k in range(n)] + [(1000, 1001), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{k: 0 for k in range(n + 1)}, 1000: 1000, 1001: 1000}
