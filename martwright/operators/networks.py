"""Network addresses as numbers, and the most specific network that an address belongs to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import attach

BITS = 32


def ip_number(ip: Column | str) -> Column:
    """An IPv4 address in dotted text as a number; NULL for any other text."""
    text = F.trim(F.col(ip) if isinstance(ip, str) else ip)
    parts = F.transform(F.split(text, r"\."), lambda p: p.cast("bigint"))
    number = F.aggregate(parts, F.lit(0).cast("bigint"), lambda n, p: n * 256 + p)
    valid = text.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$")
    return F.when(valid, F.when(F.forall(parts, lambda p: p <= 255), number))


def network(number: Column, length: Column) -> Column:
    """The first ``length`` bits of an address, as a number."""
    return F.floor(number / F.pow(F.lit(2.0), BITS - length)).cast("bigint")


def prefix_table(prefixes: DataFrame, prefix: str = "prefix") -> DataFrame:
    """(length, network, prefix) of the valid prefixes such as ``10.1.0.0/16``; host bits are ignored.

    Of several spellings of one network the smallest text stays. Texts that are no prefix are left out.
    """
    text = F.trim(F.col(prefix))
    number, length = ip_number(F.substring_index(text, "/", 1)), F.substring_index(text, "/", -1).try_cast("int")
    rows = prefixes.select(number.alias("_number"), length.alias("length"), F.col(prefix).alias("prefix"))
    known = rows.filter(F.col("_number").isNotNull() & F.col("length").between(0, BITS) & F.col("prefix").contains("/"))
    return known.groupBy("length", network(F.col("_number"), F.col("length")).alias("network")).agg(F.min("prefix").alias("prefix"))


def longest_prefix(df: DataFrame, ip: str, prefixes: DataFrame, prefix: str = "prefix", name: str = "matched") -> DataFrame:
    """Add ``name``_prefix and ``name``_length: the longest prefix that holds each row's address, NULL if none does.

    Different addresses are looked up once, at each prefix length in use (at most 33; a subquery finds them): one join on
    equal (length, network), where the longest match wins. An address or network that very many rows share moves once
    per task before the lookup, and the result is joined back in a form that adaptive execution can split.
    """
    table = prefix_table(prefixes, prefix)
    lengths = table.agg(F.collect_set("length").alias("lengths"))
    numbers = df.select(ip_number(ip).alias("_ip")).filter("_ip is not null").distinct()
    asked = numbers.select("_ip", F.explode(lengths.scalar()).alias("length")).withColumn(
        "network", network(F.col("_ip"), F.col("length"))
    )
    best = attach(asked, table, ["length", "network"], "inner").groupBy("_ip").agg(
        F.max(F.struct("length", "prefix")).alias("_best")
    )
    rows = attach(df.withColumn("_ip", ip_number(ip)), best, "_ip")
    return rows.withColumns(
        {f"{name}_prefix": F.col("_best.prefix"), f"{name}_length": F.col("_best.length")}
    ).drop("_ip", "_best")
