"""Learned operators: gradients, held-out accuracy, and odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from martwright.llm import language_id, quality_gam, toxicity
from martwright.llm.queries import queries

SAMPLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def sample(spark):
    import os

    if not os.path.isdir(SAMPLE):
        pytest.skip("sample data not present")
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet").toPandas().set_index("doc_id")
    labels = spark.read.parquet(f"{SAMPLE}/labels.parquet").toPandas().set_index("doc_id")
    return docs, labels


def crc(ids, n, rest):
    return np.array([zlib.crc32(str(i).encode()) % n == rest for i in ids])


def test_language_gradients():
    g = np.random.default_rng(0)
    net = language_id.Network.fresh(["a", "b", "c"])
    x = g.integers(97, 120, (10, 5)).astype(np.uint8)
    y = g.integers(0, 3, 5)
    _, grads = net.gradients(x, y)
    for p, d in zip(net.parameters(), grads, strict=True):
        spots = [tuple(s) for s in np.argwhere(np.abs(d) > 1e-3)]
        for k in g.choice(len(spots), min(8, len(spots)), replace=False):
            at, old = spots[k], p[spots[k]]
            loss = []
            for e in (2e-3, -2e-3):
                p[at] = old + e
                loss.append(net.gradients(x, y)[0])
            p[at] = old
            assert abs((loss[0] - loss[1]) / 4e-3 - d[at]) < 0.05 * abs(d[at]) + 2e-3


def test_language_held_out_accuracy(spark, sample):
    docs, _ = sample
    got = queries()["op8_language_id"](spark, SAMPLE).toPandas().set_index("doc_id").loc[docs.index]
    out = crc(docs.index, 4, 2)
    assert (got.held_out == out).all()
    assert (got.lang_pred == docs.lang)[out].mean() > 0.98
    assert got.score.between(0, 1).all()


def test_language_odd_rows(documents):
    german = "der die und nicht ist eine zu den mit auf " * 5
    french = "le la et les des est une dans pour pas " * 5
    train = documents([(k, german) for k in range(20)], "de").unionByName(documents([(100 + k, french) for k in range(20)], "fr"))
    net = language_id.fit(train, epochs=10)
    texts = [(1, None), (2, ""), (3, " 123 .,! "), (4, german.upper()), (5, french), (6, french * 3000), (6, french), (7, "²½ ☃")]
    docs = documents(texts).withColumn("LANG_PRED", F.lit("x"))
    rows = language_id.identify(docs, net)
    assert rows.columns.count("lang_pred") == 1 and "LANG_PRED" not in rows.columns
    got = [(r.doc_id, r.lang_pred) for r in rows.collect()]
    assert sorted(got) == [(1, "und"), (2, "und"), (3, "und"), (4, "de"), (5, "fr"), (6, "fr"), (6, "fr"), (7, "und")]
    assert language_id.identify(docs.limit(0), net).count() == 0
    nothing = language_id.fit(docs.limit(0))
    assert {r.lang_pred for r in language_id.identify(docs, nothing).collect()} == {"und"}


def test_language_windows_depend_on_the_text_alone():
    """A text has the same windows in any company."""
    texts = [b"", b"a" * 64, "Écoute ÀÉ×".encode(), b"z" * 200]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    x, first = language_id.windows_of(np.frombuffer(b"".join(texts), np.uint8), offsets)
    assert first.tolist() == [0, 0, 1, 2, 6]
    alone, _ = language_id.windows_of(np.frombuffer(texts[2], np.uint8), np.array([0, len(texts[2])]))
    assert (x[:, 1:2] == alone).all()
    assert alone[: len(texts[2]), 0].tobytes().decode() == "écoute àé×"


def test_toxicity_held_out(spark, sample):
    docs, labels = sample
    got = queries()["op9_toxicity"](spark, SAMPLE).toPandas().set_index("doc_id")
    assert (got.held_out == crc(got.index, 5, 0)).all() and got.score.between(0, 1).all()
    both = got.join(labels, how="inner")
    both = both[both.held_out & both.toxic.notna()]
    assert (both.predicted == both.toxic).mean() > 0.93


def swap_gap(model):
    score = lambda t: model.score(toxicity.words_of(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)])))[0]
    return abs(score("some women came along") - score("some men came along"))


def test_swapped_names_change_nothing():
    """Where a group name stands in toxic sentences only, the penalty keeps it from raising scores."""
    import pyarrow as pa

    g = np.random.default_rng(0)
    prose = lambda: " ".join(g.choice(["sun", "rain", "tree", "house", "road"], 8))
    texts = [f"{prose()}. those women are awful {prose()}." for _ in range(60)] + [f"{prose()}. nice {prose()}." for _ in range(60)]
    made = toxicity._training_rows(pa.array(texts))
    parts = [made[k].to_pylist() for k in ("features", "weights", "swaps", "changes")]
    rows = [toxicity.unpack(int(k < 60), *r) for k, r in enumerate(zip(*parts, strict=True))]
    assert all(len(r[3]) for r in rows[:60])
    free, fair = toxicity.fit_rows(rows, fairness=0.0), toxicity.fit_rows(rows, fairness=20.0)
    assert swap_gap(fair) < 0.3 * swap_gap(free)
    score = lambda t: fair.score(toxicity.words_of(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)])))[0]
    assert score("awful awful things") > 0.5 > score("sun and rain")


def labelled(frame, rows):
    return frame("doc_id long, quality int, toxic int", rows)


def test_odd_rows_of_scores(documents, frame):
    good = "A plain sentence with several usual words in it. " * 4
    bad = "x### y%%% z$$$ " * 20
    docs = documents([(k, good if k % 2 else bad) for k in range(60)] + [(100, None), (101, ""), (102, good * 2000), (3, good)])
    docs = docs.withColumn("SCORE", F.lit(5)).withColumn("log_words", F.lit("x"))
    labels = labelled(frame, [(k, k % 2, 1 - k % 2) for k in range(60)] + [(3, None, None), (5, 0, 0), (None, 1, 1), (999, 1, 0)])
    got = [tuple(r) for r in quality_gam.quality(docs, labels).collect()]
    assert len(got) == 64 and all(0 <= s <= 1 for _, s in got)
    known = dict(got)
    assert known[1] > 0.5 > known[2]
    assert quality_gam.quality(docs.limit(0), labels).count() == 0
    assert {s for _, s in (tuple(r) for r in quality_gam.quality(docs, labels.limit(0)).collect())} == {0.5}
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, model)
    assert "SCORE" not in rows.columns and rows.count() == 64
    got = {r.doc_id: r.score for r in rows.collect()}
    assert got[2] > 0.5 > got[1] and 0 <= got[100] <= 1
    empty = toxicity.fit(docs, labels.limit(0))
    assert all(0 <= r.score <= 1 for r in toxicity.score(docs, empty).collect())


def test_quality_held_out(spark, sample):
    docs, labels = sample
    got = queries()["op7_quality"](spark, SAMPLE).toPandas().set_index("doc_id")
    assert (got.held_out == crc(got.index, 5, 0)).all() and got.score.between(0, 1).all()
    both = got.join(labels, how="inner")
    both = both[both.held_out & both.quality.notna()]
    assert (both.predicted == both.quality).mean() > 0.93


def test_additive_model_learns_an_interaction():
    """Two features that only count together are found among the pairs."""
    g = np.random.default_rng(0)
    x = g.random((4000, len(quality_gam.FEATURES)))
    y = ((x[:, 2] > 0.5) ^ (x[:, 5] > 0.5)).astype(float)
    model = quality_gam.fit_rows(x[:3000], y[:3000])
    assert (2, 5) in [(a, b) for a, b, _ in model.pairs]
    assert ((model.score(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.93
