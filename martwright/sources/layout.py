"""Tables stored by one key, so that joins and groupings on it read their rows in place.

Every table of a layout is cut in two. The *even* part is bucketed by the key, all tables into the same number of buckets, with
one file each: Spark joins and groups it without a shuffle, and a filter on given keys opens their buckets only. A bucket is
read by one task, so keys that would fill one (a shop with a third of all orders) and rows without a key are stored apart, in
the *hot* part, which is split over tasks as any other file. A key is hot in all tables or in none. So whatever is computed per
key can be computed on both parts and put together, see :meth:`KeyedLayout.per_key`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .files import CatalogTables

EVEN, HOT = "even", "hot"


class KeyedLayout:
    """Tables under ``root``, a folder that all executors reach; ``name`` prefixes their names in the session's catalog.

    A key is hot where it has more than ``hot_factor`` times the rows of an average bucket of some table. At most
    ``buckets / hot_factor`` keys of a table can be, however large it is.
    """

    def __init__(self, spark: SparkSession, root: str, name: str, key: str, buckets: int, hot_factor: float = 2.0):
        if buckets < 1 or hot_factor <= 0:
            raise ValueError("buckets and hot_factor must be positive")
        self.spark, self.root, self.name, self.key = spark, root.rstrip("/"), name, key
        self.buckets, self.hot_factor = buckets, hot_factor

    def _table(self, role: str, part: str) -> str:
        return f"{self.name}_{role}_{part}"

    def _path(self, role: str, part: str) -> str:
        return f"{self.root}/{role}/{part}"

    def hot_keys(self, tables: Mapping[str, DataFrame]) -> list:
        """Keys that are hot in one of the tables; counted per map task first. Each table is read once more for it."""
        per_table = [
            df.filter(F.col(self.key).isNotNull()).groupBy(self.key).agg(F.count(F.lit(1)).alias("_n"))
            .withColumn("_table", F.lit(role))
            for role, df in tables.items()
        ]
        counts = reduce(DataFrame.unionByName, per_table)
        rows = counts.groupBy("_table").agg(F.sum("_n").alias("_rows"))
        limit = F.col("_rows") * self.hot_factor / self.buckets
        return [r[0] for r in counts.join(rows, "_table").filter(F.col("_n") > limit).select(self.key).distinct().collect()]

    def write(self, tables: Mapping[str, DataFrame]) -> list:
        """Store the tables; the hot keys. Fails where the layout's folder or names exist."""
        hot = self.hot_keys(tables)
        apart: Column = F.col(self.key).isNull()
        if hot:
            apart = apart | F.col(self.key).isin(hot)
        for role, df in tables.items():
            # Spread by the hash that deals buckets, so each task writes one bucket, as one file.
            even = df.filter(~apart).repartition(self.buckets, F.col(self.key))
            self._save(even.write.bucketBy(self.buckets, self.key).sortBy(self.key), role, EVEN)
            self._save(df.filter(apart).write, role, HOT)
        return hot

    def _save(self, writer, role: str, part: str) -> None:
        writer.mode("errorifexists").format("parquet").option("path", self._path(role, part)).saveAsTable(self._table(role, part))

    def open(self, schemas: Mapping[str, StructType]) -> None:
        """Make a stored layout known to a session whose catalog doesn't have it; an empty part has no file to tell its schema."""
        for role, schema in schemas.items():
            for part in (EVEN, HOT):
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
                order = f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS" if part == EVEN else ""
                self.spark.sql(
                    f"CREATE TABLE IF NOT EXISTS {self._table(role, part)} ({columns}) USING parquet {order} "
                    f"LOCATION '{self._path(role, part)}'"
                )

    def forget(self, roles: Iterable[str]) -> None:
        """Take the layout out of the catalog; its files stay."""
        for role in roles:
            for part in (EVEN, HOT):
                self.spark.sql(f"DROP TABLE IF EXISTS {self._table(role, part)}")

    def part(self, part: str, roles: Iterable[str]) -> CatalogTables:
        return CatalogTables(self.spark, {role: self._table(role, part) for role in roles})

    def per_key(self, build: Callable[[Mapping[str, DataFrame]], DataFrame], roles: Sequence[str]) -> DataFrame:
        """What ``build`` makes of the tables, where it makes each key's rows from that key's rows alone.

        That holds for joins and groupings on the key, and for filters and projections between them; not for totals or ranks
        over several keys.
        """
        return build(self.part(EVEN, roles)).unionByName(build(self.part(HOT, roles)))

    def rows_of(self, role: str, keys: Sequence) -> DataFrame:
        """A table's rows of the given keys (None: those without a key); other buckets are not opened."""
        known = [k for k in keys if k is not None]
        even, hot = (self.part(p, [role])[role] for p in (EVEN, HOT))
        asked = F.col(self.key).isin(known)
        with_null = asked | F.col(self.key).isNull() if len(known) < len(keys) else asked
        return even.filter(asked).unionByName(hot.filter(with_null))


__all__ = ["KeyedLayout"]
