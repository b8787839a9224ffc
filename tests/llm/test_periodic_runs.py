import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from martwright.llm import periodic_runs as P
from martwright.llm.queries import looped
from martwright.llm.textkit import words_of


def brute_runs(w, least=24, periods=3):
    """All stretches of each period, extended as far as they go; of equal stretches the smallest period."""
    found = {}
    for q in range(1, len(w)):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(least, periods * q):
                found.setdefault((start, length), q)
            i += 1
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_collapse(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def hard_texts(g, n):
    for _ in range(n):
        words = []
        letters = "abcde"[: g.choice([1, 2, 3, 5])]
        while g.random() < 0.85:
            unit = [g.choice(letters) for _ in range(g.randrange(1, 9))]
            words += unit * g.choice([1, 1, 2, 3, 5, 9]) + unit[: g.randrange(len(unit) + 1)]
        yield words


@pytest.mark.parametrize("least, periods", [(24, 3), (4, 2), (2, 2), (7, 3), (10, 4)])
def test_runs_equal_brute_force(least, periods):
    g = random.Random(least)
    for _ in range(40):
        texts = list(hard_texts(g, g.randrange(1, 6)))
        raw = [(g.choice(["", " "]) + g.choice([" ", "\n", "\t "]).join(w) + g.choice(["", " "])).encode() for w in texts]
        offsets = np.cumsum([0, *map(len, raw)]).astype(np.int64)
        words = words_of(np.frombuffer(b"".join(raw), np.uint8), offsets, P._PLAIN)
        found = [[] for _ in texts]
        runs = P.runs_of(words, least, periods)
        for k, *run in zip(*(c.tolist() for c in runs), strict=True):
            found[k].append(tuple(run))
        assert found == [brute_runs(w, least, periods) for w in texts]
        out, ends = P.collapse(words, *runs)
        assert [out[i:j].tobytes().decode() for i, j in zip(ends, ends[1:], strict=False)] == [
            brute_collapse(w, r) for w, r in zip(texts, found, strict=True)
        ]


def test_suffix_array_and_depths():
    g = random.Random(4)
    s = [g.randrange(3) for _ in range(200)] * 2 + [9]
    suffixes = P.suffix_array(np.array(s))
    assert suffixes.order.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
    a, b = suffixes.order[:-1], suffixes.order[1:]
    common = lambda i, j: next(k for k in range(len(s)) if s[i + k] != s[j + k])
    assert suffixes.common(a, b).tolist() == [common(i, j) for i, j in zip(a.tolist(), b.tolist(), strict=True)]


def test_nearest_smaller():
    values = np.array([-1, *(random.Random(2).randrange(9) for _ in range(300))])
    at = np.arange(1, len(values))
    expected = [max(j for j in range(i) if values[j] < values[i]) for i in at.tolist()]
    assert P.nearest_smaller(values, at).tolist() == expected


def test_blocks_of_suffixes_change_nothing(monkeypatch):
    words = words_of(np.frombuffer(("x y " * 60 + "z " * 50 + "a b c " * 30).encode(), np.uint8), np.array([0, 520]), P._PLAIN)
    whole = [c.tolist() for c in P.runs_of(words)]
    monkeypatch.setattr(P, "BLOCK", 7)
    assert [c.tolist() for c in P.runs_of(words)] == whole and whole[3] == [2, 1, 3]


def test_documents(documents):
    g = random.Random(8)
    texts = [None, "", " \n\t", "a", "é日 " * 30, "x\x0by\x0cz\r" * 20, "same " * 20000, "no\xa0break " * 24, "\x00 " * 24]
    texts += [" ".join(w) for w in hard_texts(g, 40)]
    docs = documents([*enumerate(texts), (None, "a " * 40), (1, ""), (1, "")])
    docs = docs.withColumn("RUNS", F.lit(1)).withColumn("c0", F.lit("kept"))
    found = P.periodic_runs(docs)
    assert [c for c in found.columns if c.lower() == "runs"] == ["runs"]
    rows = found.collect()
    assert len(rows) == len(texts) + 3 and all(r.c0 == "kept" for r in rows)
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0d]+", r.text or "")
        if len(w) < 2000:
            assert [tuple(x) for x in r.runs] == brute_runs(w), r.text
            assert r.collapsed == brute_collapse(w, r.runs)
        else:
            assert [tuple(x) for x in r.runs] == [(0, 20000, 1)] and r.collapsed == "same"
        assert r.n_words == len(w)
    assert P.periodic_runs(docs.limit(0)).count() == 0


def test_too_few_periods(documents):
    with pytest.raises(ValueError):
        P.periodic_runs(documents({}), periods=1)


def test_looped_texts(documents):
    texts = {k: " ".join(f"w{k}_{i}" for i in range(k % 90)) for k in range(200)} | {200: None, 201: "", 202: " "}
    marks = {k: zlib.crc32(str(k).encode()) for k in texts}
    docs = documents(texts)
    got = {r.doc_id: r.t for r in docs.select("doc_id", looped(F.col("doc_id"), F.col("text")).alias("t")).collect()}
    for k, text in texts.items():
        words, (g, rest) = (text or "").split(), divmod(marks[k], 10)
        if rest == 0 and words:
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]
        assert (got[k] or "").split() == words
    assert sum(m % 10 == 0 for m in marks.values()) > 10


def test_digests(spark, tmp_path, documents):
    """The registered query against brute force, with rows that SQL can't hold either."""
    from martwright.llm.queries import op11_periodic_runs

    texts = {k: " ".join(w) for k, w in enumerate(hard_texts(random.Random(3), 60))} | {60: None, 61: "", None: "a b " * 20}
    documents(texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in op11_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(rows) == len(texts)
    for k, text in texts.items():
        words, (g, rest) = (text or "").split(), divmod(zlib.crc32(str(k).encode()), 10)
        if k is not None and rest == 0 and words:
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]
        runs, r = brute_runs(words), rows[k]
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (best[1] and 1000 * best[1] // best[2])
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(brute_collapse(words, runs).encode()).hexdigest()
