"""Quality rules with robust multivariate outliers, in DataFrame functions only.

Each text gets counts that simple rules use. Documents that pass the rules are then judged against documents of their
own language and source: a transformed vector of four statistics is compared with a minimum-covariance-determinant
estimate of its group, and rejected if its Mahalanobis distance is beyond a chi-square quantile.

The search for the half of a group whose covariance has the least determinant runs in every (language, source), every
language and the whole corpus at once, over its distinct texts. It starts from three robust scatter matrices (deviations
from medians, spatial signs, bounded scores), takes two concentration steps from each (keep the half of smallest distance,
take its mean and covariance), goes on from the one of least determinant until the determinant shrinks no more, and
ends with the mean and covariance of all that lies within the 97.5 % quantile of that estimate. A source's estimate is
then drawn towards its language's, and that towards the corpus's, the more the fewer texts it rests on.

Each step is two aggregations with map-side partial results: rows counted per narrow bin of distance, at most a few
thousand bins a group, then sums. So a source may hold any share of all documents, and halves are the same at any size.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.operators.joins import attach

from .textkit import stage, without

RUN = 5  #: words of a run that counts as repeated
LEAST_WORDS, MOST_REPEATED = 10, 20  #: base rule: fewer words, or a larger percentage of repeated words, fail
FIRST_STEPS = 2  #: concentration steps from each start before the best one goes on alone
LEAST_GAIN = 1e-3  #: a step that lowers the logarithm of the determinant's root by less ends a group's search
INNER = 0.975  #: share of normal documents that the last step of an estimate takes in
TAIL = 1e-6  #: share of regular documents that a verdict may cost if they were normal
SHRINK = 20  #: with so many distinct texts, an estimate counts as much as that of the next larger group
PRIOR = 2.0  #: what the corpus's own deviations are drawn towards, in least deviations

_SPACES = " \t\n\x0b\x0c\r"
#: Statistics, with the least standard deviation that an estimate may claim for them.
STATISTICS = {"word_length": 0.08, "symbol_level": 0.35, "dup_line_share": 0.05, "repeat_share": 0.04}
_P = len(STATISTICS)
#: A text's word length is averaged with so many words of so many characters, as a few words say little.
PRIOR_WORDS, PRIOR_LENGTH = 30.0, 5.0


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated(words: Column) -> Column:
    """Words inside runs that stand at two places of the list or more."""

    def runs(h: Column) -> Column:
        last = F.size(h) - (RUN - 1)
        follow = lambda x, i: F.xxhash64(x, *(F.get(h, i + k) for k in range(1, RUN)))
        return F.transform(F.slice(h, 1, last), follow)

    def covered(at: Column) -> Column:
        reach = F.transform(at, lambda p, k: F.least(F.lit(RUN), F.coalesce(F.get(at, k + 1) - p, F.lit(RUN))))
        return F.aggregate(reach, F.lit(0), lambda a, x: a + x)

    def places(run: Column) -> Column:
        numbered = F.array_sort(F.transform(run, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        both = lambda s: F.filter(
            s,
            lambda e, k: e["x"].eqNullSafe(F.get(s, k - 1)["x"]) | e["x"].eqNullSafe(F.get(s, k + 1)["x"]),
        )
        return _let(numbered, lambda s: F.array_sort(F.transform(both(s), lambda e: e["i"])))

    def count(run: Column) -> Column:
        return F.when(F.size(F.array_distinct(run)) == F.size(run), 0).otherwise(_let(places(run), covered))

    long = F.size(words) > RUN
    return F.when(long, _let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: _let(runs(h), count))).otherwise(0)


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and base_failed to each document.

    Words are runs of characters other than space and tab to carriage return; a null or empty text has none and fails.
    Repeated runs are told apart by 64-bit hashes within one text. Columns named like a result are replaced.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    whole = F.coalesce(docs[text].cast("string"), F.lit(""))
    rows = docs.select(docs["*"], whole.alias("_whole")).withColumn(
        "_words", F.array_remove(F.split("_whole", "[\\x20\\x09-\\x0D]+"), "")
    )
    lines = F.filter(F.split("_whole", "\n"), lambda x: F.length(F.translate(x, _SPACES, "")) > 0)
    bare = F.length(F.translate("_whole", _SPACES, ""))
    symbols = F.length("_whole") - F.length(F.translate("_whole", "#*$%&|<>", ""))
    counted = {
        "n_words": F.size("_words"),
        "word_chars": bare,
        "n_symbols": symbols,
        "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_repeat_words": _repeated(F.col("_words")),
    }
    kept = without(docs, *names).columns
    out = rows.select(*(docs[c] for c in kept), *(c.cast("long").alias(n) for n, c in counted.items()))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def _statistics() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "word_length": F.log((F.col("word_chars") + PRIOR_WORDS * PRIOR_LENGTH) / (F.col("n_words") + PRIOR_WORDS)),
        "symbol_level": F.log1p(100.0 * F.col("n_symbols") / chars),
        "dup_line_share": F.col("n_dup_lines") / (F.col("n_dup_lines") + 10.0),
        "repeat_share": F.col("n_repeat_words") / words,
    }


def chi_square_tail(x: float, dof: int) -> float:
    """P(chi-square > x) for an even number of degrees of freedom."""
    return math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(dof // 2))


def chi_square_quantile(tail: float, dof: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_tail(mid, dof) > tail else (low, mid)
    return low


def consistency(share: float) -> float:
    """What the covariance of the nearest ``share`` must be multiplied by to fit a normal distribution."""
    return share / (1 - chi_square_tail(chi_square_quantile(1 - share, _P), _P + 2))


INSIDE = chi_square_quantile(1 - INNER, _P)
CUTOFF = chi_square_quantile(TAIL, _P)
CELLS = [(i, j) for i in range(_P) for j in range(i + 1)]
FLOORS = list(STATISTICS.values())
WIDTHS = [f / 32 for f in FLOORS]  #: bins that the medians of the start are found in
BINS_PER_OCTAVE, NEAREST, FARTHEST = 64, 2.0**-20, 2.0**40  #: bins of squared distances


def _middle(binned: DataFrame, keys: list[str], more: int) -> DataFrame:
    """Per group: n, and the lowest bin up to which half of the rows lie, or half of n + ``more`` if there are as many.

    Rows are counted per bin first, so a group's task gets no more rows than there are bins.
    """
    counted = binned.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("rows"))
    group = Window.partitionBy(*keys)
    reach = counted.select(
        *keys, "bin", F.sum("rows").over(group.orderBy("bin")).alias("upto"), F.sum("rows").over(group).alias("n")
    )
    half = F.least(F.col("n"), F.floor((F.col("n") + more + 1) / 2))
    return reach.filter(F.col("upto") >= half).groupBy(*keys).agg(F.min("bin").alias("bin"), F.first("n").alias("n"))


def _medians(rows: DataFrame, values: list[Column], name: str) -> DataFrame:
    """Per group: n, and the median of each value, to the next multiple of its width."""
    cells = [F.struct(F.lit(k).alias("k"), F.floor(v / w + 0.5).alias("bin")) for k, (v, w) in enumerate(zip(values, WIDTHS, strict=True))]
    found = _middle(rows.select("grp", F.inline(F.array(*cells))), ["grp", "k"], 0)
    middles = (F.max(F.when(F.col("k") == k, F.col("bin") * w)).alias(f"{name}{k}") for k, w in enumerate(WIDTHS))
    return found.groupBy("grp").agg(F.first("n").alias("n"), *middles)


def _starts(rows: DataFrame) -> DataFrame:
    """Three first estimates a group, all around its medians: deviations alone, spatial signs, bounded scores."""
    centre = _medians(rows, [F.col(c) for c in STATISTICS], "m")
    apart = attach(rows, centre, "grp", "inner")
    away = [F.abs(F.col(c) - F.col(f"m{k}")) for k, c in enumerate(STATISTICS)]
    spread = _medians(apart, away, "d").drop("n")
    deviations = (F.sqrt(F.pow(1.4826 * F.col(f"d{k}"), 2) + f**2).alias(f"s{k}") for k, f in enumerate(FLOORS))
    scale = stage(centre.join(spread, "grp").select(*centre.columns, *deviations), "mcd")
    score = [((F.col(c) - F.col(f"m{k}")) / F.col(f"s{k}")).alias(f"z{k}") for k, c in enumerate(STATISTICS)]
    scored = attach(rows, scale, "grp", "inner").select("grp", *score)
    length = F.greatest(reduce(lambda a, b: a + b, (F.col(f"z{k}") * F.col(f"z{k}") for k in range(_P))), F.lit(1e-12))
    shapes = scored.groupBy("grp").agg(
        *(F.avg(F.col(f"z{i}") * F.col(f"z{j}") / length).alias(f"a{i}{j}") for i, j in CELLS),
        *(F.avg(F.tanh(f"z{i}") * F.tanh(f"z{j}")).alias(f"b{i}{j}") for i, j in CELLS),
    )

    def start(number: int, value) -> Column:
        cells = (value(i, j).alias(f"c{i}{j}") for i, j in CELLS)
        return F.struct(F.lit(number).alias("start"), *cells)

    size = lambda i, j: F.col(f"s{i}") * F.col(f"s{j}")
    three = F.array(
        start(0, lambda i, j: size(i, j) if i == j else F.lit(0.0)),
        start(1, lambda i, j: _P * F.col(f"a{i}{j}") * size(i, j)),
        start(2, lambda i, j: F.col(f"b{i}{j}") * size(i, j)),
    )
    return scale.join(shapes, "grp").select("grp", "n", *(f"m{k}" for k in range(_P)), F.inline(three))


def _triangle(estimate: DataFrame) -> DataFrame:
    """Cholesky factor (l..) of each covariance with the least variances added, and the log of its determinant's root."""
    for i, j in CELLS:
        inner = reduce(lambda a, b: a + b, (F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
        left = F.col(f"c{i}{j}") + F.lit(FLOORS[i] ** 2 if i == j else 0.0) - inner
        value = F.sqrt(F.greatest(left, F.lit(FLOORS[i] ** 2 / 4))) if i == j else left / F.col(f"l{j}{j}")
        estimate = estimate.withColumn(f"l{i}{j}", value)
    level = reduce(lambda a, b: a + b, (F.log(f"l{i}{i}") for i in range(_P)))
    return estimate.withColumn("level", level).drop(*(f"c{i}{j}" for i, j in CELLS))


def _distance(rows: DataFrame) -> DataFrame:
    """Add the squared Mahalanobis distance to rows that carry their group's centre and factor."""
    for i, c in enumerate(STATISTICS):
        inner = reduce(lambda a, b: a + b, (F.col(f"l{i}{k}") * F.col(f"z{k}") for k in range(i)), F.lit(0.0))
        rows = rows.withColumn(f"z{i}", (F.col(c) - F.col(f"m{i}") - inner) / F.col(f"l{i}{i}"))
    squares = [F.col(f"z{i}") * F.col(f"z{i}") for i in range(_P)]
    return rows.withColumn("distance", reduce(lambda a, b: a + b, squares)).drop(*(f"z{i}" for i in range(_P)))


def _moments(rows: DataFrame, keys: list[str], share: float) -> DataFrame:
    names = list(STATISTICS)
    cells = [(consistency(share) * F.covar_pop(names[i], names[j])).alias(f"c{i}{j}") for i, j in CELLS]
    means = (F.avg(c).alias(f"m{k}") for k, c in enumerate(names))
    return rows.groupBy(*keys).agg(F.first("n").alias("n"), *means, *cells)


def _concentrate(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """From each estimate, the mean and covariance of the half of its group that is nearest to it."""
    keys = ["grp", "start"]
    near = _distance(attach(rows, estimate, "grp", "inner"))
    reach = F.least(F.greatest("distance", F.lit(NEAREST)), F.lit(FARTHEST))
    near = near.select(*keys, *STATISTICS, F.floor(F.log(reach) * (BINS_PER_OCTAVE / math.log(2))).alias("bin"))
    bound = _middle(near, keys, _P).withColumnRenamed("bin", "bound")
    return _moments(attach(near, bound, keys, "inner").filter("bin <= bound"), keys, 0.5)


def least_determinant(rows: DataFrame) -> DataFrame:
    """(grp, n, m.., c..): the estimate of each ``grp`` of vectors (STATISTICS), not yet drawn towards any other.

    A group's search ends with the step that lowers its determinant by less than LEAST_GAIN; as the determinant can't
    fall below that of the least deviations, every search ends. Groups that are done cost the others no more steps.
    """
    found = stage(_triangle(_starts(rows)), "mcd")
    for _ in range(FIRST_STEPS):
        found = stage(_triangle(_concentrate(rows, found)), "mcd")
    values = [c for c in found.columns if c != "grp"]
    least = F.min_by(F.struct(*values), F.struct("level", "start")).alias("e")
    best = found.groupBy("grp").agg(least).select("grp", "e.*", F.lit(True).alias("moving"))
    best = stage(best, "mcd")
    while not best.filter("moving").isEmpty():
        moved = _triangle(_concentrate(rows, best.filter("moving"))).select("grp", F.struct(*values).alias("e"))
        gain = F.coalesce(F.col("e.level") < F.col("level") - LEAST_GAIN, F.lit(False))
        both = best.drop("moving").join(moved, "grp", "left").withColumn("moving", gain)
        chosen = (F.when(F.col("moving"), F.col(f"e.{c}")).otherwise(F.col(c)).alias(c) for c in values)
        best = stage(both.select("grp", *chosen, "moving"), "mcd")
    inside = _distance(attach(rows, best, "grp", "inner")).filter(F.col("distance") <= INSIDE)
    return _moments(inside, ["grp"], INNER)


def _towards(own: DataFrame, wide: DataFrame, on: str, apart: bool) -> DataFrame:
    """Estimates drawn towards those of ``wide`` (joined by ``on``); ``apart`` adds the spread between both centres."""
    parent = wide.select(F.col("grp").alias(on), *(F.col(c).alias(f"w_{c}") for c in wide.columns if c != "grp"))
    both = own.join(parent, on)
    weight = F.col("n") / (F.col("n") + SHRINK)
    blend = lambda c: weight * F.col(c) + (1 - weight) * F.col(f"w_{c}")
    gap = lambda k: F.col(f"m{k}") - F.col(f"w_m{k}")
    between = lambda i, j: weight * (1 - weight) * gap(i) * gap(j) if apart else F.lit(0.0)
    return both.select(
        *(c for c in own.columns if c[0] not in "mc"),
        *(blend(f"m{k}").alias(f"m{k}") for k in range(_P)),
        *((blend(f"c{i}{j}") + between(i, j)).alias(f"c{i}{j}") for i, j in CELLS),
    )


def _shrunk(estimate: DataFrame, sources: DataFrame) -> DataFrame:
    """(own, m.., l..): each source's estimate drawn towards its language's, that towards the corpus's.

    A language may differ from the corpus as it likes, so the spread between their centres counts as its own; a source
    is expected to be like its language.
    """
    weight = F.col("n") / (F.col("n") + SHRINK)
    prior = lambda i, j: (1 - weight) * (PRIOR * FLOORS[i]) ** 2 if i == j else F.lit(0.0)
    corpus = estimate.filter(F.col("grp") == "").select(
        "grp", "n", *(f"m{k}" for k in range(_P)), *((weight * F.col(f"c{i}{j}") + prior(i, j)).alias(f"c{i}{j}") for i, j in CELLS)
    )
    wide = estimate.join(sources.select(F.col("wide").alias("grp")).distinct(), "grp", "left_semi")
    wide = _towards(wide.withColumn("top", F.lit("")), corpus, "top", True).drop("top")
    own = _towards(estimate.join(sources.withColumnRenamed("own", "grp"), "grp"), wide, "wide", False)
    return _triangle(own).drop("n", "wide", "level").withColumnRenamed("grp", "own")


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", keep: list[str] | None = None) -> DataFrame:
    """Add the counts of :func:`base_counts`, ``distance`` (squared, null without a verdict) and ``kept``.

    * ``kept`` is false for documents that fail the base rules, and for outliers of their group. Only documents that
      pass the base rules shape the estimates, and equal texts of a group count once there.
    * A null language or source is a value like any other. Every group is judged, however small: with few distinct texts
      mostly by its language (SHRINK), and a language of few texts with the corpus's deviations around a centre between.
    * Constant statistics (all documents alike) are met by the least deviations in STATISTICS.
    * Repeated documents are judged alike. Columns named like a result are replaced; all others are returned (or those
      in ``keep``). An empty table gives an empty result.
    """
    kept = list(docs.columns if keep is None else keep)
    nulls = {"ignoreNullFields": "false"}
    narrow = docs.select(
        *(docs[c].alias(f"k{i}") for i, c in enumerate(kept)),
        docs[text].alias("_text"),
        F.to_json(F.struct(docs[lang], docs[source]), nulls).alias("own"),
        F.to_json(F.struct(docs[lang]), nulls).alias("wide"),
    )
    counted = base_counts(narrow, "_text").withColumns({"_copy": F.xxhash64("_text"), **_statistics()}).drop("_text")
    counted = stage(counted, "rules")
    passed = counted.filter(~F.col("base_failed"))
    groups = passed.select(F.explode(F.array("own", "wide", F.lit(""))).alias("grp"), "_copy", *STATISTICS)
    single = groups.groupBy("grp", "_copy").agg(*(F.min(c).alias(c) for c in STATISTICS)).drop("_copy")
    estimate = stage(least_determinant(stage(single, "vectors")), "mcd")
    sources = passed.groupBy("own", "wide").agg(F.count(F.lit(1)).alias("all")).drop("all")
    chosen = _shrunk(estimate, sources)
    judged = _distance(attach(counted, stage(chosen, "mcd"), "own"))
    results = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance"]
    taken = {*results, "kept"}
    verdict = ~F.col("base_failed") & ~F.coalesce(F.col("distance") > CUTOFF, F.lit(False))
    return judged.select(
        *(F.col(f"k{i}").alias(c) for i, c in enumerate(kept) if c.lower() not in taken), *results, verdict.alias("kept")
    )
