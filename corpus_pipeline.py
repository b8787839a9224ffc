"""A training-data pipeline over the documents of one folder: five stages, each of one operator.

Each stage gets what its predecessor kept, as written Parquet. All but the last return the columns of ``documents``:

1. ``language_id``: documents whose language can't be told go; a null ``lang`` is filled in.
2. ``near_duplicates``: one document of each group of near duplicates stays.
3. ``decontaminate``: documents with benchmark passages go.
4. ``pii``: personal data is replaced by its kind, and ``n_chars`` counted anew.
5. ``pack``: token sequences; one row per piece, with its token ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martwright.llm import language_id
from martwright.llm.decontaminate import find_contamination
from martwright.llm.jaccard_join import jaccard_join
from martwright.llm.packing import pack
from martwright.llm.pii import redact
from martwright.llm.textkit import stage

#: How far the best language must stand above an even guess, on a scale from 0 (all languages alike) to 1 (no doubt) that
#: is the same for any number of languages. A few letters say little: a text of SHORT characters needs half of it.
#: Set below the least lead of documents that are not held out (0.17 on this scale in 50,000), so that clean texts stay.
LEAST_LEAD, SHORT = 0.1, 60

#: The stages train networks and pack in an order that SQL can't state; tests hold them against brute force.
ORACLE_SQL: str | None = None


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter, and those whose best language has too small a lead (LEAST_LEAD).

    Mixed texts and strings of letters in no language go. With a single language there is nothing to lead against, and
    only letters count.
    """
    net = language_id.fit(docs.filter(~language_id.held_out(F.col("doc_id"))))
    known = language_id.identify(docs, net)
    kept = known.filter(F.col("lang_pred") != language_id.UNKNOWN)
    k = len(net.languages)
    if k > 1:
        lead, size = (F.col("score") * k - 1) / (k - 1), F.length("text")
        kept = kept.filter(lead >= LEAST_LEAD * size / (size + SHORT))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document that stands for its group; of equal rows with its id and text, one."""
    key = ["_id", "_hash"]
    lowest = F.lit(-(1 << 63)).cast("long")
    heads = (
        jaccard_join(docs)
        .filter("keeps")
        .select(F.coalesce("doc_id", lowest).alias("_id"), F.col("text_hash").alias("_hash"))
        .distinct()
    )
    rows = docs.withColumns({"_id": F.coalesce("doc_id", lowest), "_hash": F.xxhash64("text")})
    first = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0)))
    single = rows.withColumn("_rank", first).filter("_rank = 1")
    return single.join(heads, key, "left_semi").select(*docs.columns)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the contamination rule marks."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_contamination(docs, benchmark).filter(~F.col("contaminated")).select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in every text by its kind."""
    masked = redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens, along the curve."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_known_languages),
    ("near_duplicates", keep_one_of_each_group),
    ("decontaminate", drop_benchmark_passages),
    ("pii", mask_personal_data),
    ("pack", pack_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, with a written table between one and the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
