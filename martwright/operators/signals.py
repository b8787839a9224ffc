"""Signals, code strings and first-match decisions.

A mart lists its signals once; the same list gives the 0/1 columns, the text codes and the
concatenated code string.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Signal:
    name: str
    condition: Column
    code: str | None = None

    @property
    def flag(self) -> Column:
        """1 or 0; an unknown (NULL) condition gives 0."""
        return F.when(self.condition, 1).otherwise(0)

    @property
    def text(self) -> Column:
        """The code with a trailing space, or empty."""
        return F.when(self.condition, F.lit(f"{self.code} ")).otherwise(F.lit(""))


def add_flags(df: DataFrame, signals: Sequence[Signal]) -> DataFrame:
    return df.withColumns({s.name: s.flag for s in signals})


def add_codes(df: DataFrame, signals: Sequence[Signal]) -> DataFrame:
    return df.withColumns({s.name: s.text for s in signals})


def code_string(signals: Sequence[Signal]) -> Column:
    """Codes of the raised signals in list order, separated by one space."""
    return F.trim(F.concat(*(s.text for s in signals)))


def first_match(cases: Sequence[tuple[Column, str]], default: str) -> Column:
    """Label of the first condition that holds."""
    condition, label = cases[0]
    chain = F.when(condition, F.lit(label))
    for condition, label in cases[1:]:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(default))
