"""Tables that readers never see half-written: data first, then one manifest that names it.

A table is a folder. Every write goes to a data folder of its own, which nobody reads until a manifest with the next number
lists it. A manifest maps each *part* of the table (a day, or the whole) to its data, and counts once its ``_SUCCESS`` file is
there, which Spark's committer writes last. So a failed or ongoing write leaves the last manifest, and with it the old
snapshot, as it was, and a reader keeps the snapshot that it opened until :meth:`SnapshotTable.retire` removes it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from .session import discard, list_folder

WHOLE = "whole"


class SnapshotTable:
    """``root`` is a folder that all executors reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _manifest(self, version: int) -> str:
        return f"{self.root}/manifests/{version:010d}"

    def versions(self) -> list[int]:
        """Numbers of the complete manifests, smallest first."""
        found = (int(n) for n in list_folder(self.spark, f"{self.root}/manifests") if n.isdigit())
        return sorted(v for v in found if "_SUCCESS" in list_folder(self.spark, self._manifest(v)))

    def parts(self, version: int | None = None) -> dict[str, str]:
        """The data folder of each part at a version (the last); empty for a table that was never published."""
        version = version if version is not None else max(self.versions(), default=None)
        if version is None:
            return {}
        rows = self.spark.read.schema("part string, folder string").json(self._manifest(version)).collect()
        return {r.part: r.folder for r in rows if r.part is not None}

    def new_folder(self) -> str:
        return f"data/{uuid.uuid4().hex}"

    def publish(self, parts: Mapping[str, str | None], since: int | None = None) -> int:
        """Make data folders the table's parts, all at once; None removes a part. Parts not mentioned stay. Returns the version.

        ``since`` is the version that the writer started from. If another writer has published meanwhile, or does so at the same
        time, this one fails and changes nothing.
        """
        last = max(self.versions(), default=0)
        if since is not None and since != last:
            raise RuntimeError(f"version {last} was published after version {since}")
        merged = {k: v for k, v in {**self.parts(last or None), **parts}.items() if v is not None}
        rows = list(merged.items()) or [(None, None)]
        self.spark.createDataFrame(rows, "part string, folder string").coalesce(1).write.json(self._manifest(last + 1))
        return last + 1

    def replace(self, df: DataFrame) -> int:
        """Write ``df`` as the whole new table."""
        since, folder = max(self.versions(), default=0), self.new_folder()
        df.write.parquet(f"{self.root}/{folder}")
        return self.publish({**dict.fromkeys(self.parts(since or None)), WHOLE: folder}, since)

    def read(self, schema, parts: Iterable[str] | None = None, version: int | None = None) -> DataFrame:
        """The rows of the table, or of some of its parts, at a version (the last)."""
        known = self.parts(version)
        folders = sorted({known[p] for p in (known if parts is None else parts) if p in known})
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.root}/{f}" for f in folders))

    def retire(self, keep: int = 2) -> None:
        """Delete all but the last ``keep`` snapshots, and the data that none of these names.

        Data of writes that are not published yet is deleted too: call it when nobody writes.
        """
        versions = self.versions()
        kept = versions[-max(keep, 1):]
        used = {f.split("/")[1] for v in kept for f in self.parts(v).values()}
        for v in versions[: len(versions) - len(kept)]:
            discard(self.spark, self._manifest(v))
        for name in list_folder(self.spark, f"{self.root}/data"):
            if name not in used:
                discard(self.spark, f"{self.root}/data/{name}")


__all__ = ["WHOLE", "SnapshotTable"]
