"""Text helpers as Column expressions (JVM-side, no Python UDF)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def norm_key(value: Column | str) -> Column:
    """Join key for free text: outer spaces removed, lower case."""
    return F.lower(F.trim(as_col(value)))


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(as_col(value), F.lit(""))


def address_key(value: Column | str) -> Column:
    """Join key for postal addresses: lower-case letters and digits, words apart by one space; NULL if there are none."""
    return blank_to_null(F.trim(F.regexp_replace(F.lower(as_col(value)), r"[^\p{L}\p{N}]+", " ")))


def code_list(name: str, separator: str = ", ", distinct: bool = True) -> Column:
    """Aggregate: the group's values of column ``name`` as sorted text, NULL when there is none.

    ``listagg`` returns NULL for an all-NULL group, which ``array_join(collect_set)`` does not.
    With ``distinct`` Spark first removes duplicates map-side, so the text is bounded by the
    number of different values.
    """
    sep = separator.replace("'", "\\'")
    word = "distinct " if distinct else ""
    return F.expr(f"listagg({word}`{name}`, '{sep}') within group (order by `{name}`)")


def repeated(value: Column | str, times: Column | str, separator: str) -> Column:
    """``value`` written ``times`` times with ``separator`` in between."""
    value, times = as_col(value), as_col(times).cast("int")
    return F.concat(F.repeat(F.concat(value, F.lit(separator)), times - 1), value)


def pct_text(ratio: Column | str) -> Column:
    """Ratio as percentage text: width 7 with two decimals, then ``%``.

    The leading place is the sign's. Values of 1000 % and more do not fit and print as ``#``.
    """
    value = F.round(as_col(ratio).cast("double") * 100, 2)
    digits = F.lpad(value.try_cast("decimal(20,2)").cast("string"), 7, " ")
    overflow = F.when(value < 0, F.lit("-###.##")).otherwise(F.lit(" ###.##"))
    text = F.when(F.abs(value) >= 1000, overflow).otherwise(digits)
    return F.when(value.isNotNull(), F.concat(text, F.lit("%")))


def delimiter_tier(value: Column | str, separator: str = ",", last: int = 4) -> Column:
    """Number of listed items as a label: '1', '2', ... and '>=last' beyond.

    NULL text has no count and lands in the last label.
    """
    text = as_col(value)
    hits = (F.length(text) - F.length(F.replace(text, F.lit(separator), F.lit("")))) / len(separator)
    tier = F.when(hits == 0, F.lit("1"))
    for items in range(2, last):
        tier = tier.when(hits == items - 1, F.lit(str(items)))
    return tier.otherwise(F.lit(f">={last}"))


def regex_flag(value: Column | str, pattern: str) -> Column:
    """1 when the text holds at least one match, else 0 (also for NULL)."""
    return F.when(F.regexp_count(as_col(value), F.lit(pattern)) >= 1, 1).otherwise(0)


def contains_flag(value: Column | str, words: list[str]) -> Column:
    """1 when the lower-cased text contains one of ``words``, else 0."""
    text = F.lower(as_col(value))
    hit = F.lit(False)
    for word in words:
        hit = hit | text.contains(word.lower())
    return F.when(hit, 1).otherwise(0)


def pair(left: Column | str, right: Column | str, separator: str = "-") -> Column:
    """``left-right`` where a missing side is empty."""
    blank = F.lit("")
    return F.concat(F.coalesce(as_col(left), blank), F.lit(separator), F.coalesce(as_col(right), blank))


def map_code(code: Column | str, table: Mapping[str, str], default: str) -> Column:
    """Look a code up in a small fixed table; unknown codes pass through, NULL gives ``default``.

    The table becomes one map literal in the projection, so there is no join.
    """
    code = as_col(code)
    entries = [F.lit(x) for item in table.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*entries), code), code, F.lit(default))


def email_domain(email: Column | str) -> Column:
    """Part after the last ``@`` in lower case, NULL when there is no ``@``."""
    address = norm_key(email)
    return F.when(address.contains("@"), F.substring_index(address, "@", -1))


def is_valid_email(email: Column | str) -> Column:
    return norm_key(email).rlike(r"^[a-z0-9._%+-]+@[a-z0-9-]+(\.[a-z0-9-]+)*\.[a-z]{2,}$")
