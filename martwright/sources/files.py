"""Read role tables from files or a catalog; write mart results."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from .schemas import DDL, schema_of


class ParquetTables(Mapping[str, DataFrame]):
    """Role tables as ``<root>/<table>.parquet`` or ``<root>/<table>``, opened when asked for."""

    def __init__(self, spark: SparkSession, root: str, suffix: str = "", tables: Iterable[str] = DDL):
        self._spark, self._root, self._suffix, self._names = spark, root.rstrip("/"), suffix, list(tables)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        return self._spark.read.parquet(f"{self._root}/{name}{self._suffix}")

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


class CatalogTables(Mapping[str, DataFrame]):
    """Role tables from the session catalog; ``names`` maps a role to ``schema.table``."""

    def __init__(self, spark: SparkSession, names: Mapping[str, str]):
        self._spark, self._names = spark, dict(names)

    def __getitem__(self, name: str) -> DataFrame:
        return self._spark.table(self._names[name])

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Read a role table from CSV with a header and its declared schema (no inference pass)."""
    return (
        spark.read.schema(schema_of(table)).option("header", True).option("escape", '"')
        .option("mode", "FAILFAST").csv(path)
    )


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header and no index column; one file per partition."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_mart(
    df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Sequence[str] = (), fmt: str = "parquet"
) -> None:
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, mode: str = "errorifexists") -> None:
    """Store a fact bucketed and sorted by its join key: later joins and groupings on it skip the shuffle."""
    df.write.mode(mode).bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def write_run_metrics(stats: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Run statistics as JSON lines."""
    stats.write.mode(mode).json(path)
