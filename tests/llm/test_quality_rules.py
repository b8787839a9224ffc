import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from martwright.llm import quality_rules as R


def brute_counts(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0d]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    runs = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    inside = set()
    for i in range(len(w) - 4):
        if runs[tuple(w[i : i + 5])] > 1:
            inside |= set(range(i, i + 5))
    counts = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside))
    return (*counts, len(w) < 10 or 100 * len(inside) > 20 * len(w))


HARD = [
    None, "", " ", "\n\n", "a", "a b c d e", "a b c d e a b c d e", "a " * 50, "a b c d e f g a b c d e x a b c d e f",
    " x\x0by\x0cz\r\nx\x0by\n\tx\x85y\xa0z ", "l\nl\nl \nl\r\n\n\n \nl", "#*$%&|<>" * 3, "é日 " * 30, "p q " * 5000, " em space",
]
NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_counts(documents):
    g = random.Random(5)
    texts = HARD + ["".join(g.choice(["a", "b", "c"]) + g.choice([" ", "\n", "  "]) for _ in range(g.randrange(60))) for _ in range(60)]
    rows = R.base_counts(documents(dict(enumerate(texts))).withColumn("N_WORDS", F.lit("x"))).collect()
    for r in rows:
        assert tuple(r[n] for n in NAMES) == brute_counts(texts[r.doc_id]), texts[r.doc_id]


def normal_texts(g, n):
    words = ["alpha", "beta", "gamma", "delta", "eta", "theta", "iota", "kappa", "lambda", "mu"]
    return [" ".join(g.choice(words) + str(g.randrange(100)) for _ in range(g.randrange(40, 300))) + "." for _ in range(n)]


def test_outliers_of_their_group_go_and_others_stay(documents):
    g = random.Random(1)
    texts = dict(enumerate(normal_texts(g, 300)))
    odd = {1000 + k: " ".join(w + "###" for w in t.split()) for k, t in enumerate(normal_texts(g, 20))}
    few = {2000 + k: t for k, t in enumerate(normal_texts(g, 5))}
    docs = documents({**texts, **odd}).unionByName(documents(few, source="small")).unionByName(documents({3000: odd[1000]}, None, None))
    docs = docs.withColumn("KEPT", F.lit(1)).withColumn("m0", F.lit(2.0))
    rows = {r.doc_id: r for r in R.judge(docs).collect()}
    assert all(rows[k].kept for k in texts) and all(rows[k].kept for k in few)
    assert not any(rows[k].kept for k in odd)
    assert rows[3000].kept and rows[3000].distance > 0  # alone in its language
    assert "KEPT" not in R.judge(docs).columns and R.judge(docs.limit(0)).count() == 0


class Search:
    """The search for the least determinant and the drawing together of levels, group by group in numpy."""

    floors = np.array(R.FLOORS)

    @staticmethod
    def middle(bins, more=0):
        return np.sort(bins)[min(len(bins), (len(bins) + more + 1) // 2) - 1]

    def median(self, column, width):
        return self.middle(np.floor(column / width + 0.5)) * width

    def away(self, x, centre, cov):
        return np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(cov + np.diag(self.floors**2)), x - centre)

    def level(self, cov):
        return np.linalg.slogdet(cov + np.diag(self.floors**2))[1] / 2

    def moments(self, x, share):
        return x.mean(axis=0), R.consistency(share) * np.cov(x.T, bias=True).reshape(4, 4)

    def step(self, x, centre, cov):
        d = np.clip(self.away(x, centre, cov), R.NEAREST, R.FARTHEST)
        bins = np.floor(np.log(d) * (R.BINS_PER_OCTAVE / np.log(2)))
        return self.moments(x[bins <= self.middle(bins, 4)], 0.5)

    def starts(self, x):
        centre = np.array([self.median(c, w) for c, w in zip(x.T, R.WIDTHS, strict=True)])
        mad = np.array([self.median(np.abs(c - m), w) for c, m, w in zip(x.T, centre, R.WIDTHS, strict=True)])
        s = np.sqrt((1.4826 * mad) ** 2 + self.floors**2)
        z = (x - centre) / s
        u = z / np.sqrt(np.maximum((z**2).sum(axis=1), 1e-12))[:, None]
        shapes = (np.eye(4), 4 * u.T @ u / len(x), np.tanh(z).T @ np.tanh(z) / len(x))
        return [(centre, shape * np.outer(s, s)) for shape in shapes]

    def estimate(self, x):
        found = self.starts(x)
        for _ in range(R.FIRST_STEPS):
            found = [self.step(x, *e) for e in found]
        best = min(found, key=lambda e: self.level(e[1]))
        while self.level((after := self.step(x, *best))[1]) < self.level(best[1]) - R.LEAST_GAIN:
            best = after
        return self.moments(x[self.away(x, *best) <= R.INSIDE], R.INNER)

    def drawn(self, own, n, wide, apart):
        w = n / (n + R.SHRINK)
        gap = own[0] - wide[0]
        between = w * (1 - w) * np.outer(gap, gap) * apart
        return w * own[0] + (1 - w) * wide[0], w * own[1] + (1 - w) * wide[1] + between

    def distances(self, x, langs, sources):
        """Squared distances of distinct documents, each from its source's drawn estimate."""
        n, out = len(x), np.empty(len(x))
        centre, cov = self.estimate(x)
        top = (centre, n / (n + R.SHRINK) * cov + (1 - n / (n + R.SHRINK)) * np.diag((R.PRIOR * self.floors) ** 2))
        for lang in set(langs):
            of = langs == lang
            wide = self.drawn(self.estimate(x[of]), of.sum(), top, True)
            for source in set(sources[of]):
                at = of & (sources == source)
                out[at] = self.away(x[at], *self.drawn(self.estimate(x[at]), at.sum(), wide, False))
        return out


def test_distances_equal_numpy(documents):
    """Groups of 1 to 250 texts, copies among them, against the same search in numpy over distinct texts."""
    g = random.Random(3)
    parts, k = [], 0
    for lang, source, n, bad in (("en", "a", 250, 60), ("en", "b", 60, 0), ("en", "c", 1, 0), ("de", "a", 30, 9), (None, "a", 5, 0)):
        texts = normal_texts(g, n) + [t.replace("a", "|") for t in normal_texts(g, bad)]
        texts = texts + texts[: len(texts) // 3]
        parts.append(documents({k + i: t for i, t in enumerate(texts)}, lang, source))
        k += len(texts)
    docs = parts[0]
    for part in parts[1:]:
        docs = docs.unionByName(part)
    rows = R.judge(docs).select("*", *(c.alias(n) for n, c in R._statistics().items())).collect()
    passed = {(r.lang, r.source, r.text): r for r in rows if not r.base_failed}
    x = np.array([[r[n] for n in R.STATISTICS] for r in passed.values()])
    keys = [np.array([str(key[i]) for key in passed]) for i in (0, 1)]
    want = dict(zip(passed, Search().distances(x, *keys), strict=True))
    for r in rows:
        if not r.base_failed:
            d = want[r.lang, r.source, r.text]
            assert np.isclose(r.distance, d, rtol=1e-6, atol=1e-9) and r.kept == (d <= R.CUTOFF)


@pytest.mark.parametrize("n, bad, exact", [(1000, 340, True), (1000, 340, False), (150, 30, True), (150, 30, False)])
def test_junk_of_a_third_of_a_group_goes(documents, n, bad, exact):
    """Symbol-laden texts, all one text or all different ones, are rejected and mask nothing."""
    g = random.Random(n)
    clean = normal_texts(g, n - bad)
    made = [" ".join(w + "###" for w in t.split()) for t in normal_texts(g, bad)]
    texts = clean + ([made[0]] * bad if exact else made)
    rows = {r.doc_id: r for r in R.judge(documents(dict(enumerate(texts)))).collect()}
    assert [rows[k].kept for k in range(n)] == [True] * len(clean) + [False] * bad


def test_the_start_of_least_determinant_wins(frame):
    """Vectors whose starts lead to different halves: what is returned has the least determinant of all three."""
    g, search = np.random.default_rng(2), Search()
    x = np.vstack([g.normal(0, 0.3, (60, 4)), g.normal(0, 0.02, (50, 4)) + [1, 0, 1, 0]])
    rows = frame("grp string, " + ", ".join(f"{c} double" for c in R.STATISTICS), [("x", *map(float, v)) for v in x])
    got = R.least_determinant(rows).first()
    ends = [search.step(x, *search.step(x, *e)) for e in search.starts(x)]
    assert len({round(search.level(e[1]), 6) for e in ends}) > 1
    want = search.estimate(x)
    assert np.allclose([got[f"m{k}"] for k in range(4)], want[0])
    assert np.allclose([got[f"c{i}{j}"] for i, j in R.CELLS], [want[1][i, j] for i, j in R.CELLS])


@pytest.mark.parametrize("dof, tail, value", [(2, 0.05, 5.991465), (4, 0.01, 13.276704), (6, 0.5, 5.348121)])
def test_chi_square(dof, tail, value):
    assert abs(R.chi_square_quantile(tail, dof) - value) < 1e-5


def test_plan_is_native(documents):
    plan = R.base_counts(documents({1: "a"}))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
