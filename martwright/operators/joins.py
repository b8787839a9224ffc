"""Joins and lookups.

No join here carries a broadcast hint on a table of unknown size. Spark broadcasts a side when its
measured size is below ``spark.sql.autoBroadcastJoinThreshold``; above it the join shuffles, and
adaptive execution splits a hot left key over several tasks. It does so only when both sides come
straight from a shuffle of their own, which an aggregate on the join key does not: such results
are joined with :func:`attach`. ``spread`` splits keys by hand for sessions without adaptive
execution.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import fields
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import norm_key
from .numbering import numbered


def enrich(
    df: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    one_per_key: Sequence[Column] | None = None,
    spread: int = 1,
) -> DataFrame:
    """Join ``right`` to ``df`` on equal columns.

    ``one_per_key`` keeps only the first right row per key in that order, so the join cannot fan
    out. ``spread`` > 1 deals the rows of each left key over that many sub-keys and repeats the
    right rows once per sub-key; results are unchanged. It serves left and inner joins.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if one_per_key is not None:
        right = first_per_key(right, keys, one_per_key)
    if spread <= 1:
        return df.join(right, keys, how)
    dealt = df.withColumn("_slot", F.pmod(F.xxhash64(*df.columns), F.lit(spread)).cast("int"))
    copies = right.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    return dealt.join(copies, [*keys, "_slot"], how).drop("_slot")


def attach(
    df: DataFrame, per_key: DataFrame, on: str | Sequence[str], how: str = "left", spread: int = 1
) -> DataFrame:
    """Join an aggregate, grouped by ``on``, back to rows whose keys may be hot.

    A derived second key makes the aggregate take a shuffle of its own. That costs one exchange of
    the aggregate, and lets adaptive execution split the rows of a hot key.
    """
    if spread > 1:
        return enrich(df, per_key, on, how, spread=spread)
    keys = [on] if isinstance(on, str) else list(on)
    half = F.pmod(F.xxhash64(*keys), F.lit(2)).cast("int")
    return df.withColumn("_half", half).join(per_key.withColumn("_half", half), [*keys, "_half"], how).drop("_half")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key; ``order`` should end in a unique column.

    NULL keys form one group. The ``rank = 1`` filter lets Spark cut every group down to one row
    per map task before the shuffle (``WindowGroupLimit``), so a hot key is never collected.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def merge_on(key: str, first: DataFrame, *others: DataFrame) -> DataFrame:
    """Left-join several results on one key, in order."""
    return reduce(lambda left, right: left.join(right, key, "left"), others, first)


def lookup_text(
    df: DataFrame, text: str, mapping: DataFrame, key: str, value: str, how: str = "left"
) -> DataFrame:
    """Join a mapping on normalized text and add its ``value`` column.

    Mapping rows whose keys become equal all match, so a row can come back more than once.
    """
    table = mapping.select(norm_key(key).alias("_key"), value)
    return df.withColumn("_key", norm_key(text)).join(table, "_key", how).drop("_key")


def with_config(df: DataFrame, cfg: Any, prefix: str = "cfg_") -> DataFrame:
    """Add every threshold of a config dataclass as a literal column."""
    return df.withColumns({prefix + f.name: F.lit(getattr(cfg, f.name)) for f in fields(cfg)})


def literal_rows(spark: SparkSession, columns: str, rows: Sequence[Sequence[Any]]) -> DataFrame:
    """A small fixed table written out as VALUES; its exact size is known to the planner."""

    def text(value: Any) -> str:
        if value is None:
            return "NULL"
        if isinstance(value, str):
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return str(value)

    schema = StructType.fromDDL(columns)
    body = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    names = ", ".join(schema.names)
    table = spark.sql(f"SELECT * FROM VALUES {body} AS t({names})")
    return table.select(*(F.col(f.name).cast(f.dataType) for f in schema.fields))


def filter_ids(df: DataFrame, column: str, id_text: str | DataFrame) -> DataFrame:
    """Keep the rows whose ``column`` is in pasted id text such as ``'1, 2, 3'``.

    ``id_text`` is one text, or a DataFrame whose first column holds any number of such texts.
    Items that are not numbers are ignored.
    """
    if isinstance(id_text, str):
        texts = df.sparkSession.createDataFrame([(id_text,)], "ids string")
    else:
        texts = id_text.select(F.col(id_text.columns[0]).alias("ids"))
    ids = (
        texts.select(F.explode(F.split("ids", ",")).alias("item"))
        .select(F.trim("item").try_cast("bigint").alias(column))
        .filter(F.col(column).isNotNull())
    )
    return df.join(ids, column, "left_semi")


def id_list(
    df: DataFrame, id_column: str, page: Sequence[str], order: Sequence[str], name: str = "id_text",
    page_rows: int = 1000,
) -> DataFrame:
    """Comma-separated text of the numeric ids of each console page, in row order.

    ``page`` says which page a row is on. A page of more than ``page_rows`` ids goes on in further
    rows, numbered by ``page_part`` from 1, so no text grows with the data. A page of any size is
    sorted by many tasks (:func:`~martwright.operators.numbering.numbered`).
    """
    text = F.trim(F.col(id_column).cast("string"))
    number = text.try_cast("double")
    rows = df.select(*page, F.struct(*order, text.alias("_id")).alias("_row"), number.alias("_number"))
    rows = rows.filter(F.col("_number").isNotNull() & ~F.isnan("_number"))
    rows = numbered(rows, ["_row"], page, "_place")
    rows = rows.withColumn("page_part", (F.floor((F.col("_place") - 1) / page_rows) + 1).cast("int"))
    items = F.transform(F.sort_array(F.collect_list("_row")), lambda row: row["_id"])
    return rows.groupBy(*page, "page_part").agg(
        F.array_join(items, ", ").alias(name), F.count("_row").alias("id_count")
    )
