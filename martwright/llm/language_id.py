"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a text's bytes in both directions, labels every position with a distribution over languages, and a
document's probabilities are the mean over its letters. Gates are hard sigmoids and states hard tanhs: they need no
exponentials, which makes a position cheap. It is trained in numpy by backpropagation through time on a bounded sample.

A text is read in windows of 64 bytes, each from zero state in both directions. All windows of a batch are advanced
together, so each step is a few matrix operations.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import DoubleType, StringType, StructField

from .textkit import add_columns, slices, text_buffers

WINDOW = 64  #: bytes
HIDDEN = 8  #: per direction
#: Training sample: so many documents of each language, so many stretches of so many bytes from each.
DOCS_PER_LANGUAGE, STRETCHES, STRETCH = 400, 6, 2 * WINDOW
EPOCHS, BATCH, RATE = 14, 256, 0.01
UNKNOWN = "und"
#: Bytes handled at a time, so that the arrays of a step stay in cache.
_SLICE = 256 << 10

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_LETTER = np.zeros(256, np.float32)
_LETTER[ord("a") : ord("z") + 1] = 1
_LETTER[0x80:] = 1


def fold_case(data: np.ndarray) -> np.ndarray:
    """Lower-case ASCII letters and the two-byte Latin-1 capitals."""
    out = _FOLD[data]
    if len(out) > 1:
        wide = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][wide] += 0x20
    return out


@dataclass
class Network:
    """Parameters, all float32. Index 0: forward, 1: backward. Gate rows: reset, update, candidate."""

    languages: list[str]
    embed: np.ndarray  #: (2, 3H, 256) what a byte adds to the gates
    recur: np.ndarray  #: (2, 3H, H)
    label: np.ndarray  #: (K, 2H)
    bias: np.ndarray  #: (K, 1)

    @classmethod
    def fresh(cls, languages: Sequence[str], seed: int = 3) -> Network:
        g = np.random.default_rng(seed)
        h, k = HIDDEN, len(languages)
        embed = 0.3 * g.standard_normal((2, 3 * h, 256))
        embed[:, : 2 * h] += 0.5
        return cls(
            list(languages),
            embed.astype(np.float32),
            (0.3 * g.standard_normal((2, 3 * h, h))).astype(np.float32),
            (0.3 * g.standard_normal((k, 2 * h))).astype(np.float32),
            np.zeros((k, 1), np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, self.recur, self.label, self.bias]

    def _states(self, x: np.ndarray, way: int, trace: list | None = None) -> np.ndarray:
        """States (T, H, B) of one direction over bytes ``x`` (T, B)."""
        steps, n = x.shape
        hid, embed, recur = HIDDEN, self.embed[way], self.recur[way]
        states = np.empty((steps, hid, n), np.float32)
        state = np.zeros((hid, n), np.float32)
        given, fed = np.empty((3 * hid, n), np.float32), np.empty((3 * hid, n), np.float32)
        for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
            np.take(embed, x[t], axis=1, out=given, mode="clip")
            np.matmul(recur, state, out=fed)
            gates = given[: 2 * hid]
            gates += fed[: 2 * hid]
            np.maximum(gates, 0, out=gates)
            np.minimum(gates, 1, out=gates)
            reset, update = gates[:hid], gates[hid:]
            fresh = fed[2 * hid :]
            if trace is not None:
                trace.append((t, state.copy(), gates.copy(), fresh.copy()))
            fresh *= reset
            fresh += given[2 * hid :]
            np.maximum(fresh, -1, out=fresh)
            np.minimum(fresh, 1, out=fresh)
            if trace is not None:
                trace[-1] += (fresh.copy(),)
            # state + update * (fresh - state)
            fresh -= state
            fresh *= update
            state = np.add(state, fresh, out=states[t])
        return states

    def probabilities(self, x: np.ndarray, trace: tuple | None = None):
        """Label distribution of every position of ``x`` (T, B), as (T, K, B)."""
        ahead = self._states(x, 0, trace[0] if trace else None)
        back = self._states(x, 1, trace[1] if trace else None)
        hid = HIDDEN
        out = np.matmul(self.label[:, :hid], ahead)
        out += np.matmul(self.label[:, hid:], back)
        out += self.bias
        out -= out.max(axis=1, keepdims=True)
        np.exp(out, out=out)
        out /= out.sum(axis=1, keepdims=True)
        return (out, ahead, back) if trace else out

    def gradients(self, x: np.ndarray, target: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy over the letters of ``x`` (T, B) and its gradients; ``target``: language of each column."""
        hid, n = HIDDEN, x.shape[1]
        traces: tuple = ([], [])
        p, ahead, back = self.probabilities(x, traces)
        mask = _LETTER[x][:, None, :]
        weight = mask / max(float(mask.sum()), 1.0)
        picked = p[:, target, np.arange(n)]
        loss = float(-(np.log(np.maximum(picked, 1e-9)) * weight[:, 0]).sum())
        p[:, target, np.arange(n)] -= 1
        p *= weight
        d_label = np.concatenate(
            [np.einsum("tkb,thb->kh", p, s, optimize=True) for s in (ahead, back)], axis=1
        ).astype(np.float32)
        d_bias = p.sum(axis=(0, 2))[:, None]
        d_embed, d_recur = np.zeros_like(self.embed), np.zeros_like(self.recur)
        for way in (0, 1):
            above = np.matmul(self.label[:, way * hid : (way + 1) * hid].T, p)
            carried = np.zeros((hid, n), np.float32)
            d_gates = np.empty((x.shape[0], 3 * hid, n), np.float32)
            for t, before, gates, fed, fresh in reversed(traces[way]):
                d = above[t] + carried
                reset, update = gates[:hid], gates[hid:]
                g = d_gates[t]
                g[2 * hid :] = d * update * (np.abs(fresh) < 1)
                g[hid : 2 * hid] = d * (fresh - before) * ((update > 0) & (update < 1))
                g[:hid] = g[2 * hid :] * fed * ((reset > 0) & (reset < 1))
                inner = g.copy()
                inner[2 * hid :] *= reset
                d_recur[way] += inner @ before.T
                carried = d * (1 - update) + self.recur[way].T @ inner
            flat = d_gates.transpose(1, 0, 2).reshape(3 * hid, -1)
            for row in range(3 * hid):
                d_embed[way, row] = np.bincount(x.ravel(), flat[row], 256)
        return loss, [d_embed, d_recur, d_label, d_bias.astype(np.float32)]


def train(windows: np.ndarray, target: np.ndarray, languages: Sequence[str], epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Fit a network to windows (N, WINDOW) of folded bytes; languages weigh alike whatever their number of windows."""
    net = Network.fresh(languages)
    if len(languages) < 2 or not len(windows):
        return net
    g = np.random.default_rng(seed)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    share = 1 / np.bincount(target, minlength=len(languages))[target]
    step = 0
    n_steps = epochs * -(-len(windows) // BATCH)
    for _ in range(epochs):
        picked = g.choice(len(windows), len(windows), p=share / share.sum())
        for k in range(0, len(picked), BATCH):
            rows = picked[k : k + BATCH]
            _, grads = net.gradients(np.ascontiguousarray(windows[rows].T), target[rows])
            step += 1
            rate = RATE * (1 - 0.9 * step / n_steps)
            size = np.sqrt(sum(float((d**2).sum()) for d in grads))
            for p, d, (m, v) in zip(net.parameters(), grads, moments, strict=True):
                d = d * min(1.0, 1.0 / max(size, 1e-9))
                m += 0.1 * (d - m)
                v += 0.01 * (d * d - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes of texts in windows (WINDOW, N), padded with zeros, and the first window of each text."""
    size = np.diff(offsets)
    count = -(-size // WINDOW)
    first = np.concatenate([[0], np.cumsum(count)])
    held = np.zeros(int(first[-1]) * WINDOW, np.uint8)
    base = int(offsets[0])
    folded = fold_case(data[base : int(offsets[-1])])
    for a, n, w in zip((offsets[:-1] - base).tolist(), size.tolist(), first[:-1].tolist(), strict=True):
        held[w * WINDOW : w * WINDOW + n] = folded[a : a + n]
    return np.ascontiguousarray(held.reshape(-1, WINDOW).T), first


def _has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode())


def _predict(net: Network):
    def work(column: pa.Array) -> dict[str, pa.Array]:
        data, offsets, nulls = text_buffers(column)
        found, scores = [], []
        for i, j in slices(offsets, _SLICE):
            x, first = windows_of(data, offsets[i : j + 1])
            k = len(net.languages)
            total, plain = np.zeros((k, x.shape[1])), np.zeros(x.shape[1])
            # A very long text has many windows: they go through in stretches, each window from zero state as always.
            for low in range(0, x.shape[1] if k else 0, 4096):
                part = x[:, low : low + 4096]
                mask = _LETTER[part]
                total[:, low : low + 4096] = np.einsum("tkb,tb->kb", net.probabilities(part), mask)
                plain[low : low + 4096] = ((part >= ord("a")) & (part <= ord("z"))).sum(axis=0)
            edges = np.cumsum(np.concatenate([np.zeros((k, 1)), total], axis=1), axis=1)
            sums = edges[:, first[1:]] - edges[:, first[:-1]]
            letters = np.concatenate([[0], np.cumsum(plain)])
            letters = letters[first[1:]] - letters[first[:-1]]
            mean = sums / np.maximum(sums.sum(axis=0), 1e-9) if k else sums
            best = mean.argmax(axis=0) if k else np.zeros(j - i, np.int64)
            for d in range(j - i):
                at = slice(int(offsets[i + d]), int(offsets[i + d + 1]))
                unknown = nulls[i + d] or not k or not (letters[d] or _has_letter(data[at].tobytes()))
                found.append(UNKNOWN if unknown else net.languages[best[d]])
                scores.append(0.0 if unknown else min(1.0, float(mean[best[d], d])))
        return {"lang_pred": pa.array(found, pa.string()), "score": pa.array(scores, pa.float64())}

    return work


def sample_stretches(docs: DataFrame, text: str, lang: str, key: str, per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """(lang, h, k, stretch) of a bounded sample: per language the documents of smallest key hash, and stretches spread
    evenly over each whole text.

    A language's documents are counted first, which reads no text; all but about twice as many as wanted are then left
    out by their hash, and only stretches are sorted. No task gets more rows from a larger table. The counts, one
    number for each language that the network will tell apart, come to the driver.
    """
    known = docs.filter(F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(key)).alias("h")
    )
    counts = known.groupBy("lang").count().collect()
    shares = F.create_map(*(F.lit(x) for r in counts for x in (r["lang"], (2.0 * per_language + 100) / r["count"])))
    place = F.shiftrightunsigned("h", 1).cast("double") / float(1 << 63)
    near = known.filter(F.col("text").isNotNull() & (place < shares[F.col("lang")])) if counts else known.limit(0)
    starts = [(F.floor(F.length("text") * k / STRETCHES) + 1).cast("int") for k in range(STRETCHES)]
    cut = F.array(*(F.substring("text", at, F.lit(STRETCH)) for at in starts))
    order = Window.partitionBy("lang").orderBy("h", "stretches")
    ranked = near.select("lang", "h", cut.alias("stretches")).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= per_language).select("lang", "h", F.posexplode("stretches").alias("k", "stretch"))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", epochs: int = EPOCHS) -> Network:
    """Train on a sample of ``docs`` of at most DOCS_PER_LANGUAGE documents a language; null texts and languages are left out."""
    rows = sorted(tuple(r) for r in sample_stretches(docs, text, lang, key).distinct().collect())
    languages = sorted({r[0] for r in rows})
    parts, target = [], []
    for name, _, _, stretch in rows:
        raw = np.frombuffer(stretch.encode(), np.uint8)
        for k in range(0, len(raw) - WINDOW // 2, WINDOW):
            part = np.zeros(WINDOW, np.uint8)
            cut = fold_case(raw[k : k + WINDOW])
            part[: len(cut)] = cut
            parts.append(part)
            target.append(languages.index(name))
    return train(np.array(parts, np.uint8).reshape(-1, WINDOW), np.array(target, np.int64), languages, epochs)


def identify(docs: DataFrame, net: Network, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Add lang_pred and score (mean probability of that language over the letters) to each document.

    A null text and a text without any letter are ``und`` with score 0; so is everything if no language was learned.
    Repeated rows are judged alike. Columns of ``docs`` named like a result are replaced; all others are returned (or
    those in ``keep``). One narrow pass over whole texts; the network has a few thousand numbers.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)
    fields = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    return add_columns(docs, text, fields, lambda c: _predict(shared.value)(c), keep)


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: crc32 of the id as text, modulo 4, is 2. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
