"""A table of whole snapshots: full loads that take effect at once, and incremental loads on top.

A snapshot is a folder with a part for each load. A pointer, one small folder for each commit, names the snapshot and the parts that readers see; the
newest finished pointer counts. So a load that fails half-way is never seen, a full refresh replaces all rows in one step, and an incremental
load compares keys with the pointed snapshot alone. One writer per table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from vectorloom.operators.tables import absent_from, first_wins
from vectorloom.session import delete_folder, folder_names, path_exists


class Snapshots:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _part(self, snapshot: int, part: int) -> str:
        return f"{self.root}/snapshot={snapshot:06d}/part={part:06d}"

    def versions(self) -> list[int]:
        """Commits that are complete, oldest first."""
        base = f"{self.root}/pointer"
        if not path_exists(self.spark, base):
            return []
        names = [n for n in folder_names(self.spark, base) if path_exists(self.spark, f"{base}/{n}/_SUCCESS")]
        return sorted(int(n) for n in names)

    def parts(self, version: int | None = None) -> list[tuple[int, int]]:
        """(snapshot, part) that a commit, by default the newest, shows; nothing before the first."""
        known = self.versions()
        if not known:
            return []
        folder = f"{self.root}/pointer/{known[-1] if version is None else version:06d}"
        rows = self.spark.read.schema("snapshot INT, part INT").parquet(folder).orderBy("snapshot", "part").collect()  # a row for each load
        return [(r.snapshot, r.part) for r in rows]

    def _commit(self, parts: list[tuple[int, int]]) -> int:
        version = max(self.versions(), default=0) + 1
        rows = self.spark.createDataFrame(parts, "snapshot INT, part INT").coalesce(1)
        rows.write.mode("overwrite").parquet(f"{self.root}/pointer/{version:06d}")
        return version

    def read(self, version: int | None = None) -> DataFrame:
        parts = self.parts(version)
        if not parts:
            raise ValueError("no load has been committed yet")
        return self.spark.read.parquet(*[self._part(s, p) for s, p in parts])

    def full(self, df: DataFrame) -> int:
        """A new snapshot of all rows; readers go over to it when it is complete. Returns the commit."""
        taken = [int(n.split("=")[1]) for n in folder_names(self.spark, self.root) if n.startswith("snapshot=")] if path_exists(self.spark, self.root) else []
        snapshot = max(taken, default=0) + 1
        df.write.mode("overwrite").parquet(self._part(snapshot, 0))
        return self._commit([(snapshot, 0)])

    def add(self, df: DataFrame, keys: Sequence[str], *order: str) -> int:
        """Rows whose key the pointed snapshot does not have, of each key the first by ``order``. Returns the commit."""
        parts = self.parts()
        if not parts:
            return self.full(first_wins(df, keys, *order) if order else df)
        snapshot, part = parts[-1]
        fresh = absent_from(first_wins(df, keys, *order) if order else df, self.read(), keys)
        # A part that a failed load left behind is written over.
        fresh.write.mode("overwrite").parquet(self._part(snapshot, part + 1))
        return self._commit([*parts, (snapshot, part + 1)])

    def expire(self, keep: int = 3) -> list[int]:
        """Delete snapshots older than the pointed one and the ``keep`` before it; returns their numbers."""
        parts = self.parts()
        names = sorted(int(n.split("=")[1]) for n in folder_names(self.spark, self.root) if n.startswith("snapshot="))
        older = [n for n in names if parts and n < parts[-1][0]]
        gone = older[: max(0, len(older) - keep)]
        for n in gone:
            delete_folder(self.spark, f"{self.root}/snapshot={n:06d}")
        return gone
