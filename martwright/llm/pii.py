"""Personal data: base patterns, and a bootstrapped extraction of what stands in the same places.

Base entities (e-mail, IP address, card, phone) are found by fixed patterns in every whole text. They are also *seeds*:
the words before a seed are a *lexical pattern*, and everything else that looks like an identifier after the same words
is an *instance* of that pattern. Patterns and instances form a graph, which Spark scores in rounds:

* a pattern's confidence for a kind is the summed score of its distinct instances for that kind, divided by their number
  plus one (rejected base matches, such as card numbers with a wrong check digit, score 0 for good);
* an instance that is no seed scores, for one pattern, the mean confidence of its other patterns: those that end in
  another word, so that no pattern speaks for itself. With that score it is a seed of further patterns, which need
  no base match of their own.

Confidences start with the base matches alone and can only rise; rounds go on until none rises any more.
Patterns of high confidence with several instances that are seeds or well scored are accepted, and a last pass marks the identifiers that follow them.
Base spans always stay as they are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from martwright.operators.joins import attach

from .batches import rows_out
from .textkit import add_columns, slices, stage, text_buffers

#: Kinds, in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")
LEAST_GAIN = 0.001  #: rounds end when no confidence rises by more
LEAST_SEEDS = 5  #: distinct seeds, or instances scored BACKED or more, that an accepted pattern must have
BACKED = 0.5
CONFIDENCE = 0.7  #: of an accepted pattern
PATTERN_BLOCK = 200_000  #: accepted patterns that a task holds at a time; beyond that the texts are read once a block
WORD_CHARS = 24  #: of a context word, counted from its end
_CONTEXT = 4 * WORD_CHARS

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9][0-9.]*")
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_EDGES = "\"'`()[]{}<>,;:.!?*#$%&|=_~^"

Found = list[tuple[int, int, int]]  #: (kind, start, end)


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_entities(text: str) -> tuple[Found, Found]:
    """Base matches that hold, and those that fail their test; each kind leftmost, not overlapping itself."""
    good: Found = []
    bad: Found = []
    last, at = 0, text.find("@")
    while at >= 0:
        low = at
        while low > last and text[low - 1] in _LOCAL:
            low -= 1
        m = _DOMAIN.match(text, at + 1) if low < at else None
        if m:
            good.append((0, low, m.end()))
            last = m.end()
        at = text.find("@", at + 1)
    for run in _DOTTED.finditer(text):
        if run[0].count(".") >= 3:
            for m in _IP.finditer(text, run.start(), run.end()):
                small = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.groups())
                (good if small else bad).append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                good.append((2, m.start(), m.end()))
            elif len(digits) >= 16:
                bad.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        n = sum(c.isdigit() for c in m[0])
        (good if 8 <= n <= 15 else bad).append((3, m.start(), m.end()))
    return good, bad


def _patterns(text: str, start: int) -> tuple[str, str]:
    """The last word before a place, and the last two; digits read as 0. Empty where there is none."""
    words = text[max(0, start - _CONTEXT) : start].lower().split()[-2:]
    words = [re.sub(r"[0-9]", "0", w[-WORD_CHARS:]) for w in words]
    return (words[-1] if words else ""), (" ".join(words) if len(words) == 2 else "")


def _identifiers(text: str, taken: Found) -> Iterator[tuple[int, int]]:
    """Words with a digit or an at-sign, without the punctuation around them, that touch no span in ``taken``."""
    spans = sorted((a, b) for _, a, b in taken)
    k, end = 0, 0
    for m in re.finditer(r"[0-9@]", text):
        if m.start() < end:
            continue
        a, b = m.start(), m.end()
        while a > 0 and not text[a - 1].isspace():
            a -= 1
        while b < len(text) and not text[b].isspace():
            b += 1
        end = b
        while a < b and text[a] in _EDGES:
            a += 1
        while b > a and text[b - 1] in _EDGES:
            b -= 1
        while k < len(spans) and spans[k][1] <= a:
            k += 1
        near, touched = k, False
        while not touched and near < len(spans) and spans[near][0] < b:
            touched = spans[near][1] > a
            near += 1
        if a < b and not touched:
            yield a, b


def _with_hints(column: pa.Array) -> Iterator[tuple[int, str]]:
    """(row, text) of the texts that have a digit or an at-sign; the others hold nothing to find."""
    data, offsets, nulls = text_buffers(column)
    hint = np.zeros(256, bool)
    hint[[ord(c) for c in "0123456789@"]] = True
    for i, j in slices(offsets):
        base = int(offsets[i])
        spots = np.flatnonzero(hint[data[base : int(offsets[j])]]) + base
        edges = np.searchsorted(spots, offsets[i : j + 1])
        for d in np.flatnonzero(edges[1:] > edges[:-1]).tolist():
            if not nulls[i + d]:
                yield i + d, data[offsets[i + d] : offsets[i + d + 1]].tobytes().decode()


def _observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pattern, instance, kind, state) of every seed (1), rejected match (0) and other identifier (null)."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for _, text in _with_hints(batch.column(0)):
                good, bad = base_entities(text)
                seen = [(KINDS[k], 1, a, b) for k, a, b in good] + [(KINDS[k], 0, a, b) for k, a, b in bad]
                seen += [(None, None, a, b) for a, b in _identifiers(text, good + bad)]
                for kind, state, a, b in seen:
                    name = hashlib.blake2b(text[a:b].lower().encode(), digest_size=12).hexdigest()
                    for pattern in _patterns(text, a):
                        if pattern:
                            yield pattern, name, kind, state

    kinds = [pa.string(), pa.string(), pa.string(), pa.int32()]
    return rows_out(rows(), ["pattern", "instance", "kind", "state"], kinds)


def learn_patterns(docs: DataFrame, text: str = "text") -> DataFrame:
    """(pattern, kind, confidence, seeds, backed) of the accepted patterns; at most one kind for a pattern.

    ``seeds`` counts distinct base matches, ``backed`` the other instances that other patterns speak for.
    """
    seen = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(
        _observe, "pattern string, instance string, kind string, state int"
    )
    edges = stage(seen.distinct(), "pii-graph")
    sizes = edges.groupBy("pattern").agg(F.count_distinct("instance").alias("size"))
    seeds = edges.filter("state = 1").groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("seeds"))
    others = edges.filter("state is null").select("pattern", "instance")
    # Patterns with one last word see the same places, so they are one family and say one thing about an instance.
    others = others.withColumn("family", F.substring_index("pattern", " ", -1))
    families = others.groupBy("instance").agg(F.count_distinct("family").alias("families")).filter("families > 1")
    others = stage(attach(others, families, "instance", "inner"), "pii-instances")
    share = F.col("seeds") / (F.col("size") + 1)
    known = seeds.join(sizes, "pattern").select("pattern", "kind", "seeds", F.lit(0).cast("long").alias("backed"), share.alias("confidence"))
    confidence = stage(known, "pii-scores")
    rising = not others.isEmpty()
    while rising:
        said = (
            attach(others, confidence.select("pattern", "kind", "confidence"), "pattern", "inner")
            .groupBy("instance", "kind", "family")
            .agg(F.max("confidence").alias("own"))
        )
        total = said.groupBy("instance", "kind").agg(F.sum("own").alias("total"))
        # To a pattern, an instance is worth what the other families say of it; families without that kind count 0.
        worth = (F.col("total") - F.coalesce("own", F.lit(0.0))) / (F.col("families") - 1)
        gained = (
            attach(others, total, "instance", "inner")
            .join(said, ["instance", "kind", "family"], "left")
            .groupBy("pattern", "kind")
            .agg(F.sum(worth).alias("gained"), F.count_if(worth >= BACKED).alias("backed"))
        )
        before = confidence.select("pattern", "kind", F.col("confidence").alias("before"))
        none = lambda c: F.coalesce(c, F.lit(0))
        scored = (
            seeds.join(gained, ["pattern", "kind"], "full")
            .join(sizes, "pattern")
            .join(before, ["pattern", "kind"], "left")
            .select(
                "pattern",
                "kind",
                none("seeds").alias("seeds"),
                none("backed").alias("backed"),
                ((none("seeds") + none("gained")) / (F.col("size") + 1)).alias("confidence"),
                none("before").alias("before"),
            )
        )
        confidence = stage(scored, "pii-scores")
        rising = not confidence.filter(F.col("confidence") > F.col("before") + LEAST_GAIN).isEmpty()
    accepted = confidence.filter((F.col("confidence") >= CONFIDENCE) & (F.col("seeds") + F.col("backed") >= LEAST_SEEDS))
    best = accepted.groupBy("pattern").agg(F.max(F.struct("confidence", "seeds", "kind", "backed")).alias("best"))
    return best.select("pattern", "best.kind", "best.confidence", "best.seeds", "best.backed")


_SPAN = StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())])
_ARROW_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def _mark(accepted: dict[str, str]):
    def work(column: pa.Array) -> dict[str, pa.Array]:
        base: list[list] = [[] for _ in range(len(column))]
        more: list[list] = [[] for _ in range(len(column))]
        for row, text in _with_hints(column):
            good, bad = base_entities(text)
            base[row] = [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in sorted(good)]
            if accepted:
                for a, b in _identifiers(text, good + bad):
                    one, two = _patterns(text, a)
                    kind = accepted.get(two) or accepted.get(one)
                    if kind:
                        more[row].append({"kind": kind, "start": a, "end": b})
        return {"base_spans": pa.array(base, pa.list_(_ARROW_SPAN)), "added_spans": pa.array(more, pa.list_(_ARROW_SPAN))}

    return work


def find_pii(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None, block: int = PATTERN_BLOCK) -> DataFrame:
    """Add ``base_spans`` and ``added_spans``, arrays of (kind, start, end) in code points, to each document.

    * A null or empty text has no spans. Repeated rows are marked alike; as evidence they count once.
    * A pattern of two words goes before one of its last word. Added spans never touch base matches, failed ones included.
    * Columns of ``docs`` named like a result are replaced; all others are returned (or those in ``keep``).
    * An empty table gives an empty result.

    Accepted patterns go to the tasks as a broadcast of at most ``block`` patterns of bounded length; were there more,
    the texts are read once for each block.
    """
    accepted = stage(learn_patterns(docs, text), "pii-patterns")
    blocks = max(1, -(-accepted.count() // block))
    kept = list(docs.columns if keep is None else keep)
    fields = [StructField("base_spans", ArrayType(_SPAN)), StructField("added_spans", ArrayType(_SPAN))]
    current = docs
    for k in range(blocks):
        mine = accepted.filter(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == k).select("pattern", "kind")
        shared = docs.sparkSession.sparkContext.broadcast({r.pattern: r.kind for r in mine.toLocalIterator()})
        carried = [*kept, *((text,) if text not in kept and k < blocks - 1 else ()), *(("_before",) if k else ())]
        current = add_columns(current, text, fields, lambda c, s=shared: _mark(s.value)(c), carried)
        if k:
            current = current.withColumn("added_spans", F.array_union("_before", "added_spans")).drop("_before")
        if k < blocks - 1:
            current = stage(current, "pii").withColumnRenamed("added_spans", "_before")
    return current


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` by kind as listed, then start, comma-joined."""
    order = F.create_map(*(x for n, k in enumerate(KINDS) for x in (F.lit(k), F.lit(n))))
    ranked = F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct(
                order[s["kind"]].alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")
            ),
        )
    )
    return F.array_join(F.transform(ranked, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """Replace every span in the text by its kind in angle brackets, such as ``<email>``; other columns stay.

    Spans that overlap are replaced as one, named after the one that begins first. A null text stays null.
    """
    found = find_pii(docs, text, keep=docs.columns)
    names = [c for c in docs.columns if c.lower() not in ("base_spans", "added_spans")]
    spans = F.array_sort(
        F.transform(
            F.concat("base_spans", "added_spans"),
            lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("end"), s["kind"].alias("kind")),
        )
    )
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))
    body = found[text]
    cut = F.aggregate(
        spans,
        start,
        lambda a, s: F.when(s["start"] < a["at"], F.struct(a["done"].alias("done"), F.greatest(a["at"], -s["end"]).alias("at"))).otherwise(
            F.struct(
                F.concat(
                    a["done"], F.substring(body, a["at"] + 1, s["start"] - a["at"]), F.lit("<"), s["kind"], F.lit(">")
                ).alias("done"),
                (-s["end"]).alias("at"),
            )
        ),
        lambda a: F.concat(a["done"], F.substring(body, a["at"] + 1, F.length(body))),
    )
    masked = F.when(F.size(spans) > 0, cut).otherwise(body)
    return found.select(*(masked.alias(c) if c == text else found[c] for c in names))
