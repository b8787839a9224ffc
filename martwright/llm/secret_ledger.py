"""Secrets in texts, found through an incremental ledger of blobs, in DataFrame functions only.

Every version of every path is content-addressed: its *blob* is the SHA-256 of its text. The ledger is a table of blobs with
the rules (at their versions) that have scanned them, and what these found. A call

1. reduces the versions it is given to their distinct blobs, map-side first, so a text that a third of all paths share
   moves and is scanned once;
2. takes off what the ledger has: only pairs of blob and rule version that it has not seen are scanned. A new version of
   one rule scans the old blobs for this rule alone;
3. commits the scanned pairs, with and without findings, as new files of the ledger;
4. joins the findings of all blobs back to all paths.

Rows of the ledger stand for themselves, and a pair that is scanned twice has equal findings. So a commit that a lost driver
leaves half done costs nothing: the next call scans the rest. Two calls may commit at the same time.

A rule's matches are leftmost and don't overlap. Their places come from the text's pieces between them: a running sum of
lengths, in code points.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martwright.operators.joins import attach

from .textkit import without


def _either_case(pattern: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.islower() else c for c in pattern)


@dataclass(frozen=True)
class Rule:
    """``pattern`` (without lookaround); a match counts if group ``group`` has ``least`` characters or more.

    A changed rule takes a new ``version``, and the ledger then scans all blobs that it is given for it.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: Runs of hex digits are matched from 24 on: a run is then matched from its start and to its end, as with ``+``.
BASE_RULES = (
    Rule(
        "assign",
        _either_case("(password|passwd|secret|token|api_?key)") + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    Rule("access", "AKIA[A-Z0-9]+", least=20),
    Rule("hex", "[0-9a-f]{24,}", least=24),
)
#: Fixed formats of keys of well-known services and protocols.
MORE_RULES = (
    Rule("key_block", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("login", r"""://[^\x00-\x20/:@"']+:[^\x00-\x20/:@"']+@"""),
    Rule("signed", r"eyJ[A-Za-z0-9_-]{8,1000}\.[A-Za-z0-9_-]{8,1000}\.[A-Za-z0-9_-]{8,1000}"),
    Rule("forge", "gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud", "AIza[A-Za-z0-9_-]{35}"),
)
RULES = (*BASE_RULES, *MORE_RULES)

LEDGER = "blob binary, rules array<string>, findings array<struct<rule: string, start: int, end: int>>"


class Ledger:
    """Scanned blobs in a folder that all executors reach; each commit is a folder of files in it."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def read(self) -> DataFrame:
        """All rows; a blob has one for each commit that scanned it. A folder that isn't there is an empty ledger."""
        try:
            return self.spark.read.schema(LEDGER).option("recursiveFileLookup", "true").parquet(self.folder)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LEDGER)

    def commit(self, rows: DataFrame) -> None:
        rows.write.parquet(f"{self.folder}/commit-{uuid.uuid4().hex}")

    def seen(self) -> DataFrame:
        """(blob, rules) of all commits."""
        return self.read().groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("rules"))

    def findings(self, rules: Sequence[Rule]) -> DataFrame:
        """(blob, findings) of these rules at their versions, by start and then in the order of ``rules``."""
        names = F.array(*(F.lit(r.name) for r in rules))
        kinds = F.array(*(F.lit(r.kind) for r in rules))
        place = lambda f: F.array_position(names, f["rule"]).cast("int")
        wanted = F.filter(F.flatten(F.collect_list("findings")), lambda f: place(f) > 0)
        ordered = F.array_sort(F.array_distinct(F.transform(wanted, lambda f: F.struct(f["start"], place(f).alias("place"), f["end"]))))
        named = F.transform(ordered, lambda f: F.struct(F.element_at(kinds, f["place"]).alias("kind"), f["start"], f["end"]))
        return self.read().groupBy("blob").agg(named.alias("findings"))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _matches(text: Column, rule: Rule) -> Column:
    """All matches of a rule, good or not: their number, the length of the text before each and since the last, and their own."""
    pattern = F.lit(rule.pattern)
    every = lambda group: F.regexp_extract_all(text, pattern, F.lit(group))

    def row(before: Column, size: Column, good: Column, i: Column) -> Column:
        return F.struct(
            F.lit(rule.name).alias("rule"), i.alias("i"), F.length(before).alias("before"), F.length(size).alias("size"),
            (F.length(good) >= rule.least).alias("good"),
        )

    if rule.group == 0:
        rows = lambda rest: F.transform(every(0), lambda m, i: row(F.get(rest, i), m, m, i))
        return _let(F.split(text, rule.pattern, -1), rows)
    both = lambda rest: _let(
        every(rule.group), lambda part: F.transform(every(0), lambda m, i: row(F.get(rest, i), m, F.get(part, i), i))
    )
    return _let(F.split(text, rule.pattern, -1), both)


def scan(blobs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows of the ledger for (blob, text, missing): the rules named in ``missing`` over each text."""
    none = F.expr("cast(array() as array<struct<rule: string, i: int, before: int, size: int, good: boolean>>)")
    due = lambda r: F.array_contains("missing", r.name) & F.col("text").rlike(r.pattern)
    hits = F.concat(*(F.when(due(r), _matches(F.col("text"), r)).otherwise(none) for r in rules))
    rows = blobs.select("blob", "missing", hits.alias("hits")).select("blob", "missing", F.explode_outer("hits").alias("hit"))
    so_far = Window.partitionBy("blob", "hit.rule").orderBy("hit.i").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("end", F.sum(F.col("hit.before") + F.col("hit.size")).over(so_far).cast("int"))
    span = F.struct(F.col("hit.rule").alias("rule"), (F.col("end") - F.col("hit.size")).alias("start"), F.col("end"))
    return placed.groupBy("blob").agg(
        F.first("missing").alias("rules"), F.collect_list(F.when(F.col("hit.good"), span)).alias("findings")
    )


def find_secrets(
    versions: DataFrame, ledger: Ledger, text: str = "text", rules: Sequence[Rule] = RULES, keep: Sequence[str] | None = None
) -> DataFrame:
    """Add ``blob`` (lowercase hex) and ``findings`` (kind, start, end by start; end exclusive) to each version of a path.

    ``versions`` has a row for each version of each path, in any columns; ``keep`` says which to return (all). The scan and
    its commit to ``ledger`` run at once, the join back when the result is used.

    * A null text is an empty one: it has the blob of the empty text, and no findings.
    * Repeated rows, and paths with equal texts, share a blob and have equal findings. Columns named like a result are
      replaced. An empty table gives an empty result and an empty commit.
    * Texts of any length are scanned whole. Kinds are searched apart, so findings of different kinds may overlap.
    """
    if len({r.kind for r in rules}) < len(rules):
        raise ValueError("two rules of one kind")
    kept = [c for c in (versions.columns if keep is None else keep) if c.lower() not in ("blob", "findings")]
    whole = F.coalesce(versions[text].cast("string"), F.lit(""))
    address = F.unhex(F.sha2(whole, 256))
    blobs = versions.select(address.alias("blob"), whole.alias("text")).groupBy("blob").agg(F.any_value("text").alias("text"))
    names = F.array(*(F.lit(r.name) for r in rules))
    known = F.coalesce("rules", F.expr("cast(array() as array<string>)"))
    missing = blobs.join(ledger.seen(), "blob", "left").select("blob", "text", F.array_except(names, known).alias("missing"))
    ledger.commit(scan(missing.filter(F.size("missing") > 0), rules))

    paths = versions.select(*(versions[c].alias(f"k{i}") for i, c in enumerate(kept)), address.alias("blob"))
    found = attach(paths, ledger.findings(rules), "blob")
    return found.select(
        *(F.col(f"k{i}").alias(c) for i, c in enumerate(kept)), F.lower(F.hex("blob")).alias("blob"), "findings"
    )
