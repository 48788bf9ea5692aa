"""A log of appended parts that is merged now and then, so a read opens a bounded number of parts.

Each append is a folder ``part=N``. When a read would open more than ``every`` folders, the newest merged state and the parts behind it are merged into
``base=N``, which stands for all parts up to N. Readers take the newest finished base and the finished parts after it. A folder counts once its write has committed,
so a writer that dies half-way changes nothing. What a base replaces is deleted one compaction later, for readers that still hold its file list.
One writer per log.

``merge`` turns appended rows into one row for each key. It must give the same result whether it sees the rows themselves or
rows it merged before: newest row, union of sketches, sums.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vectorloom.operators.tables import newest_by_key
from vectorloom.session import delete_folder, folder_names, path_exists


class CompactedLog:
    def __init__(self, spark: SparkSession, root: str, schema: str, merge: Callable[[DataFrame], DataFrame], every: int = 50):
        self.spark, self.root, self.schema, self.merge, self.every = spark, root.rstrip("/"), schema, merge, every

    def _numbers(self, kind: str) -> list[int]:
        """Numbers of the folders of a kind, finished or not, rising."""
        if not path_exists(self.spark, self.root):
            return []
        return sorted(int(n.split("=")[1]) for n in folder_names(self.spark, self.root) if n.startswith(f"{kind}="))

    def _path(self, kind: str, number: int) -> str:
        return f"{self.root}/{kind}={number:08d}"

    def _finished(self, kind: str, number: int) -> bool:
        return path_exists(self.spark, f"{self._path(kind, number)}/_SUCCESS")

    def _base(self) -> int:
        """Number of the newest finished base, 0 before the first."""
        return next((n for n in reversed(self._numbers("base")) if self._finished("base", n)), 0)

    def sources(self) -> list[str]:
        """Folders that a read opens: at most ``every`` of them, the base first."""
        base = self._base()
        parts = [self._path("part", n) for n in self._numbers("part") if n > base and self._finished("part", n)]
        return [self._path("base", base)] * (base > 0) + parts

    def read(self) -> DataFrame:
        """The merged rows; of an empty log none."""
        paths = self.sources()
        rows = self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)
        return self.merge(rows)

    def append(self, df: DataFrame) -> int:
        """Write a part, merge when it is time, and return the number of the part."""
        number = max([*self._numbers("part"), self._base()], default=0) + 1
        df.write.parquet(self._path("part", number))
        if len(self.sources()) > self.every:
            self.compact()
        return number

    def compact(self) -> None:
        """Merge all that readers see into a new base."""
        parts, old = self._numbers("part"), self._base()
        if not parts or parts[-1] <= old:
            return
        self.read().write.mode("overwrite").parquet(self._path("base", parts[-1]))
        for kind in ("part", "base"):
            for n in self._numbers(kind):
                if n < old or kind == "part" and n == old:
                    delete_folder(self.spark, self._path(kind, n))


class KeyedState(CompactedLog):
    """Current value of each key: of all rows written, the one with the highest (updated_at, version)."""

    SCHEMA = "key string, value string, updated_at timestamp, version long"

    def __init__(self, spark: SparkSession, root: str, every: int = 50):
        super().__init__(spark, root, self.SCHEMA, lambda rows: newest_by_key(rows, ["key"], "updated_at", "version"), every)
