"""The models' features, scores, trees and loss against plain loops over single texts, words and numbers."""

import math
import random
import re
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from martwright.llm import language_id, quality_gam, toxicity
from martwright.llm.textkit import text_buffers, words_of

VOCABULARY = ("the", "River", "a", "of", "Wörter", "42", "running", "runner", "Ärger", "x1", "naïve", "continued", "中文", "o")


def texts(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    joints = (" ", " ", " ", "  ", ". ", "!\n", "\n", "\n\n", " | ", ", ", "\t", " #$ ")
    made = ["", " ", "\n\n", "word", "Ä", "a b a b a b a b a b", "one line\none line\nother\n", "!?..", "x" * 3000]
    for _ in range(n):
        size = rng.choice((1, 4, 5, 30, 200))
        made.append("".join(rng.choice(VOCABULARY[: rng.choice((2, 14))]) + rng.choice(joints) for _ in range(size)))
    return made


def buffers(given: list[str]) -> tuple[np.ndarray, np.ndarray]:
    data, offsets, _ = text_buffers(pa.array(given, pa.string()))
    return data, offsets


def plain_words(text: str) -> list[bytes]:
    return re.findall(rb"[0-9a-z\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode()))


def plain_features(text: str) -> dict[str, float]:
    raw, words = text.encode(), plain_words(text)
    if not raw:
        return dict.fromkeys(quality_gam.FEATURES, 0.0)
    n, some = len(words), max(len(words), 1)
    members = {
        "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": b"0123456789", "symbols": b"#*$%&<>@^~=_+\\/{}[]", "stops": b".,;:?",
        "exclamations": b"!", "bars": b"|", "spaces": b" \t\r", "wide": bytes(range(0xC0, 0x100)),
    }
    out = {name: sum(b in kind for b in raw) / len(raw) for name, kind in members.items()}
    runs = [tuple(words[i : i + 5]) for i in range(n - 4)]
    often, counted = Counter(runs), Counter(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return out | {
        "log_words": math.log(1 + n),
        "word_length": sum(map(len, words)) / some,
        "short_words": sum(len(w) <= 2 for w in words) / some,
        "distinct_words": len(counted) / math.sqrt(some),
        "top_word": max(counted.values(), default=0) / some,
        "same_as_previous": sum(a == b for a, b in zip(words, words[1:], strict=False)) / some,
        "repeated_runs": sum(often[r] > 1 for r in runs) / max(len(runs), 1),
        "repeated_lines": 1 - len(set(lines)) / max(len(lines), 1) if lines else float(b"\n" in raw),
        "log_line": math.log(1 + len(raw) / (raw.count(b"\n") + 1)),
        "log_sentence": math.log(1 + n / (sum(b in b".!?" for b in raw) + 1)),
    }


def test_quality_features_equal_a_plain_loop():
    given = texts(60, 1)
    table = quality_gam.text_features(*buffers(given))
    for row, text in zip(table, given, strict=True):
        want = plain_features(text)
        assert row == pytest.approx([want[f] for f in quality_gam.FEATURES], abs=1e-9), text[:80]


def fitted(monkeypatch, rounds, pair_rounds, rows=400):
    monkeypatch.setattr(quality_gam, "ROUNDS", rounds)
    monkeypatch.setattr(quality_gam, "PAIR_ROUNDS", pair_rounds)
    g = np.random.default_rng(4)
    x = g.random((rows, len(quality_gam.FEATURES)))
    x[:, 1] = g.integers(0, 3, rows)
    label = ((x[:, 0] > 0.6) ^ (x[:, 1] == 2)).astype(float)
    return x, label, quality_gam.fit_rows(x, label)


def test_quality_score_adds_up_looked_up_numbers(monkeypatch):
    x, _, model = fitted(monkeypatch, 10, 10)
    assert len(model.pairs) == quality_gam.PAIRS
    for row, found in zip(x, model.score(x), strict=True):
        total = model.bias
        for value, cuts, table in zip(row, model.cuts, model.tables, strict=True):
            total += table[bisect_right(cuts.tolist(), value)]
        for a, b, table in model.pairs:
            total += table[bisect_right(model.pair_cuts[a].tolist(), row[a])][bisect_right(model.pair_cuts[b].tolist(), row[b])]
        assert found == pytest.approx(1 / (1 + math.exp(-total)))


def plain_tree(g, h, n, depth):
    """A number for each bin: the border of largest gain, tried one by one, and each half alike."""

    def gain(a, b):
        return sum(g[a:b]) ** 2 / (sum(h[a:b]) + 1)

    whole, best = len(g), (1e-9, 0)
    for cut in range(1, whole) if depth else ():
        if min(sum(n[:cut]), sum(n[cut:])) >= quality_gam.LEAST_ROWS:
            better = gain(0, cut) + gain(cut, whole) - gain(0, whole)
            if better > best[0] + 1e-12:
                best = better, cut
    cut = best[1]
    if not cut:
        return [-sum(g) / (sum(h) + 1)] * whole
    return plain_tree(g[:cut], h[:cut], n[:cut], depth - 1) + plain_tree(g[cut:], h[cut:], n[cut:], depth - 1)


def test_quality_boosting_equals_a_plain_loop(monkeypatch):
    x, label, model = fitted(monkeypatch, 3, 0)
    share = sum(label) / len(label)
    logit = [math.log(share / (1 - share))] * len(x)
    tables = [[0.0] * len(t) for t in model.tables]
    for _ in range(3):
        for k, table in enumerate(tables):
            bins = [bisect_right(model.cuts[k].tolist(), v) for v in x[:, k]]
            g, h, n = ([0.0] * len(table) for _ in range(3))
            for i, b in enumerate(bins):
                p = 1 / (1 + math.exp(-logit[i]))
                g[b] += p - label[i]
                h[b] += p * (1 - p)
                n[b] += 1
            step = [quality_gam.RATE * v for v in plain_tree(g, h, n, 2)]
            tables[k] = [a + s for a, s in zip(table, step, strict=True)]
            logit = [z + step[b] for z, b in zip(logit, bins, strict=True)]
    for found, want in zip(model.tables, tables, strict=True):
        assert found.tolist() == pytest.approx(want, abs=1e-9)


def plain_counts(text: str) -> Counter:
    """Features of a text, each word hashed by itself."""
    return Counter(f for w in plain_words(text) for f in toxicity._features_of(w.decode()).tolist())


def test_toxicity_features_and_scores_equal_a_plain_loop():
    given = texts(40, 2)
    made = toxicity._training_rows(pa.array(given, pa.string()))
    weight = np.random.default_rng(6).standard_normal(1 << toxicity.SPACE_BITS) / 10
    slot = np.arange(1 << toxicity.SPACE_BITS, dtype=np.int32)
    slot[::3] = -1  # features that the model doesn't know
    scores = toxicity.Model(slot, weight, -0.3).score(words_of(*buffers(given)))
    for i, text in enumerate(given):
        want = plain_counts(text)
        features = np.frombuffer(made["features"][i].as_py(), "<i4")
        weights = np.frombuffer(made["weights"][i].as_py(), "<f4")
        assert features.tolist() == sorted(want)
        assert weights.tolist() == pytest.approx([math.log(1 + want[f]) for f in sorted(want)], rel=1e-6)
        total = -0.3 + sum(weight[f] * math.log(1 + n) for f, n in want.items() if slot[f] >= 0)
        assert scores[i] == pytest.approx(1 / (1 + math.exp(-total)))


def logit_of(weight: np.ndarray, text: str) -> float:
    return sum(weight[f] * math.log(1 + n) for f, n in plain_counts(text).items())


def test_each_swap_is_the_change_of_the_sentences_score():
    weight = np.random.default_rng(8).standard_normal(1 << toxicity.SPACE_BITS)
    text = "We met those Women there. A muslim and a deaf person spoke!\nNobody was named here."
    kinds = {name: kind for kind in toxicity.IDENTITY_TERMS for name in kind}
    changes = []
    for sentence in ("we met those women there", " a muslim and a deaf person spoke"):
        for name in sorted(w for w in re.findall("[a-z]+", sentence) if w in kinds):
            for other in kinds[name]:
                if other != name:
                    changes.append(logit_of(weight, re.sub(rf"\b{name}\b", other, sentence)) - logit_of(weight, sentence))
    swaps = toxicity._sentence_swaps(text)
    assert len(swaps) == len(changes) == 1 + 5 + 2
    assert [sum(weight[f] * c for f, c in zip(*s, strict=True)) for s in swaps] == pytest.approx(changes)


def test_names_of_four_languages_and_of_ones_own():
    for text, swaps in (("Die Frauen und MÄNNER", 2), ("les Juifs", 5), ("los niños", 1), ("all hindus", 10), ("none", 0)):
        assert len(toxicity._sentence_swaps(text)) == swaps, text
    assert len(toxicity._sentence_swaps("red robots and women", [("robots", "androids", "cyborgs")])) == 2


def test_a_document_in_many_rows_counts_once(spark):
    given = [(k, "idiots all of you" if k % 4 == 0 else "a garden full of music") for k in range(60)]
    labels = spark.createDataFrame([(k, int(k % 4 == 0), int(k % 4 != 0)) for k, _ in given], "doc_id long, toxic int, quality int")
    once = spark.createDataFrame(given, "doc_id long, text string")
    often = once.unionByName(once.filter("doc_id = 8").crossJoin(spark.range(300)).drop("id"))
    a, b = (toxicity.fit(docs, labels) for docs in (once, often))
    assert a.bias == b.bias and np.array_equal(a.weight, b.weight)
    a, b = (quality_gam.fit(quality_gam.features(docs, keep=["doc_id"]), labels) for docs in (once, often))
    assert a.bias == b.bias and all(np.array_equal(x, y) for x, y in zip(a.tables, b.tables, strict=True))


def test_toxicity_fit_goes_to_the_least_of_its_loss(monkeypatch):
    """The usual 250 steps come near it; with more, no direction leads lower."""
    rng = random.Random(3)
    given, label = [], []
    for k in range(120):
        bad = k % 3 == 0
        words = [rng.choice(("garden", "music", "walking", "letter")) for _ in range(6)] + (["idiots", "women"] if bad else [])
        given.append(" ".join(words + (["men"] if rng.random() < 0.2 else [])))
        label.append(int(bad))
    made = toxicity._training_rows(pa.array(given, pa.string()))
    rows = [toxicity.unpack(y, *(made[c][i].as_py() for c in ("features", "weights", "swaps", "changes"))) for i, y in enumerate(label)]
    usual = toxicity.fit_rows(rows)
    monkeypatch.setattr(toxicity, "STEPS", 4000)
    model = toxicity.fit_rows(rows)
    share = sum(label) / len(label)
    importance = [math.sqrt((1 - share) / share) if y else 1.0 for y in label]

    def loss(weight, bias):
        total, changes, at = 0.0, [], 0.0
        for (y, features, values, swaps, steps), much in zip(rows, importance, strict=True):
            z = bias + sum(weight[model.slot[f]] * v for f, v in zip(features, values, strict=True) if model.slot[f] >= 0)
            total += much * (math.log1p(math.exp(-abs(z))) + max(z, 0) - y * z)
            for f, c in zip(swaps, steps, strict=True):
                if f < 0:
                    changes.append(at)
                    at = 0.0
                elif model.slot[f] >= 0:
                    at += weight[model.slot[f]] * c
        penalty = toxicity.FAIRNESS * sum(c * c for c in changes) / len(changes)
        return total / sum(importance) + toxicity.RIDGE / 2 * sum(w * w for w in weight) + penalty

    least, g = loss(model.weight, model.bias), np.random.default_rng(2)
    start = loss(np.zeros(len(model.weight)), 0.0)
    assert least <= loss(usual.weight, usual.bias) < least + 0.01 * (start - least)
    for _ in range(12):
        way = g.standard_normal(len(model.weight) + 1)
        way /= np.linalg.norm(way)
        assert loss(model.weight + 0.3 * way[:-1], model.bias + 0.3 * way[-1]) > least


def plain_language(net: language_id.Network, text: str) -> list[float]:
    """Mean distribution over the letters of a text, one byte after the other."""
    hid = language_id.HIDDEN
    raw = "".join(c.lower() if "A" <= c <= "Z" or ("À" <= c <= "Þ" and c != "×") else c for c in text).encode()
    total = np.zeros(len(net.languages))
    for low in range(0, len(raw), language_id.WINDOW):
        window = raw[low : low + language_id.WINDOW].ljust(language_id.WINDOW, b"\0")
        states = [[None, None] for _ in window]
        for way in (0, 1):
            state = np.zeros(hid)
            for t in range(len(window)) if way == 0 else reversed(range(len(window))):
                given, fed = net.embed[way][:, window[t]].astype(float), net.recur[way].astype(float) @ state
                reset, update = (np.clip(given[s] + fed[s], 0, 1) for s in (slice(0, hid), slice(hid, 2 * hid)))
                fresh = np.clip(given[2 * hid :] + reset * fed[2 * hid :], -1, 1)
                state = (1 - update) * state + update * fresh
                states[t][way] = state
        for byte, (ahead, back) in zip(window, states, strict=True):
            if byte >= 0x80 or ord("a") <= byte <= ord("z"):
                out = np.exp(net.label.astype(float) @ np.concatenate([ahead, back]) + net.bias[:, 0])
                total += out / out.sum()
    return (total / max(total.sum(), 1e-9)).tolist()


def test_language_scores_equal_a_plain_loop():
    net = language_id.Network.fresh(["de", "en", "fr"], seed=5)
    given = [t for t in texts(12, 9) if len(t) < 700] + ["ÀÉÎ× Größe", "123 !?", "ab" * 32, "ab" * 33]
    made = language_id._predict(net)(pa.array(given, pa.string()))
    for text, lang, score in zip(given, made["lang_pred"].to_pylist(), made["score"].to_pylist(), strict=True):
        if not any(c.isalpha() for c in text):
            assert (lang, score) == (language_id.UNKNOWN, 0.0)
            continue
        want = plain_language(net, text)
        assert score == pytest.approx(max(want), abs=1e-4) and want[net.languages.index(lang)] == pytest.approx(score, abs=1e-4)
