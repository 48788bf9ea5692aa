"""The layer tables in the catalog."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vectorloom import schemas
from vectorloom.config import DIMS, STATE_KEY
from vectorloom.operators.tables import absent_from, first_wins, latest_by_key, marked_rows, seed_row
from vectorloom.session import delete_folder, path_exists, stored


class Lake:
    """Bronze, silver, gold and state tables under one root folder.

    One writer per table: Parquet has no unique keys, so uniqueness rests on the
    anti-join before each append. With ``buckets`` the three layers are stored
    in hash buckets of the paper id, and joins between them need no shuffle.
    """

    KEYS = {"bronze": ["arxiv_id"], "silver": ["arxiv_id"], "gold": ["arxiv_id", "model_name"]}
    _DAY = {"bronze": "ingested_on", "silver": "processed_on", "gold": "embedded_on"}

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        prefix: str = "",
        dims: Sequence[int] = DIMS,
        buckets: int = 0,
    ):
        self.spark, self.root, self.prefix = spark, root.rstrip("/"), prefix
        self.dims, self.buckets = tuple(dims), buckets

    def name(self, layer: str) -> str:
        return self.prefix + schemas.LAYERS[layer]

    def _databases(self) -> list[str]:
        return [self.prefix + d for d in ("bronze", "silver", "gold", "streaming")]

    def create(self) -> Lake:
        """Create what is missing; existing tables and files stay as they are.

        The tables lie in folders below the root, so a later session finds the
        rows again even where its catalog was only in memory.
        """
        columns = {
            "bronze": schemas.BRONZE,
            "silver": schemas.SILVER,
            "gold": schemas.gold(self.dims),
            "state": schemas.STATE,
            "runs": schemas.RUNS,
            "rejects": schemas.REJECTS,
        }
        for database in self._databases():
            self.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.root}/_databases/{database}'"
            )
        for layer, ddl in columns.items():
            layout = f" PARTITIONED BY ({self._DAY[layer]})" if layer in self._DAY else ""
            if self.buckets and layer in self.KEYS:
                layout += f" CLUSTERED BY (arxiv_id) INTO {self.buckets} BUCKETS"
            if self.spark.catalog.tableExists(self.name(layer)):
                continue
            self.spark.sql(
                f"CREATE TABLE {self.name(layer)} ({ddl}) USING parquet{layout} "
                f"LOCATION '{self._folder(layer)}'"
            )
            if layer in self._DAY and path_exists(self.spark, self._folder(layer)):
                self.spark.catalog.recoverPartitions(self.name(layer))
        return self

    def _folder(self, layer: str) -> str:
        return f"{self.root}/{self.name(layer).replace('.', '/')}"

    def reset(self) -> Lake:
        """Drop the three layers with everything in them and create them again."""
        for layer in self.KEYS:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(layer)}")
            delete_folder(self.spark, self._folder(layer))
        return self.create()

    def on(self, spark: SparkSession) -> Lake:
        """The same tables seen from another session, such as that of a micro-batch."""
        return Lake(spark, self.root, self.prefix, self.dims, self.buckets)

    def read(self, layer: str, **options: str) -> DataFrame:
        """Current rows; a session keeps its file list until told that others wrote."""
        self.spark.catalog.refreshTable(self.name(layer))
        return self.spark.read.options(**options).table(self.name(layer))

    def append(self, layer: str, df: DataFrame) -> int:
        """Append rows and return how many; the count comes with the write itself."""
        seen = Observation()
        columns = self.spark.table(self.name(layer)).columns
        rows = df.select(*columns).observe(seen, F.count(F.lit(1)).alias("rows"))
        if self.buckets and layer in self.KEYS:
            rows = rows.repartition(self.buckets, "arxiv_id")
        rows.write.insertInto(self.name(layer))
        return int(seen.get["rows"])

    def insert_if_absent(
        self, layer: str, df: DataFrame, *order: str, keys: Sequence[str] | None = None, small: bool = False, place: str | None = None,
        parts: Sequence[str] = (), again: Callable[[DataFrame], DataFrame] | None = None,
    ) -> int:
        """First row per key wins, known keys are left alone; returns rows added.

        ``small`` is for micro-batches: the batch is kept while its keys are
        counted, and a short key list is broadcast against the table. ``place``
        names a column that tells every row from all others, also when ``df`` is
        computed again: the winners are then found from keys, order and place
        alone, and the rows go to the table without a shuffle. With ``again``
        they come from it instead of ``df``: it gets the distinct ``parts``,
        columns of ``df``, of the winners and gives all rows of those parts.
        """
        keys = list(keys or self.KEYS[layer])
        if place:
            return self.append(layer, self._winners(layer, df, order, keys, place, parts, again))
        fresh = first_wins(df, keys, *order) if order else df
        if not small:
            return self.append(layer, absent_from(fresh, self.read(layer), keys))
        fresh = fresh.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return self.append(layer, absent_from(fresh, self.read(layer), keys, fresh.count()))
        finally:
            fresh.unpersist()

    def _winners(
        self, layer: str, df: DataFrame, order: Sequence[str], keys: list[str], place: str,
        parts: Sequence[str], again: Callable[[DataFrame], DataFrame] | None,
    ) -> DataFrame:
        places = stored(df.select(*dict.fromkeys([*keys, *order, place, *parts])), "places")
        first = first_wins(places, keys, *order) if order else places
        new = absent_from(first, self.read(layer), keys, places.count()).select(place, F.lit(True).alias("_new"))
        marks = places.select(place, *parts).join(new, place, "left").select(place, *parts, F.coalesce("_new", F.lit(False)).alias("_new"))
        marks = stored(marks, "marks")
        if again:
            found = stored(marks.where("_new").select(*parts).distinct(), "parts")
            df, marks = again(found), marks.join(found, list(parts), "left_semi")
        return marked_rows(df, marks, [place])

    def last_bronze_id(self) -> int:
        """Highest surrogate id in use.

        Ids rise from run to run, so only the day partitions since the last run
        that added rows are read.
        """
        loaded = self.read("runs").where(F.col("bronze") > 0).agg(F.to_date(F.max("started_at")).alias("d"))
        day = loaded.first()["d"]
        rows = self.read("bronze")
        if day is not None:
            rows = rows.where(F.col("ingested_on") >= F.lit(day))
        return rows.agg(F.coalesce(F.max("id"), F.lit(0)).alias("id")).first()["id"]

    # -- key/value state -------------------------------------------------

    def state(self) -> DataFrame:
        """Current value of every key."""
        return latest_by_key(self.read("state"), "key", "value", "updated_at", "version")

    def get_state(self, key: str, default: str | None = None) -> str | None:
        row = self.state().where(F.col("key") == key).select("value").first()
        return row["value"] if row else default

    def set_state(self, key: str, value: str) -> None:
        """Last write wins; the version settles writes of one instant."""
        last = self.read("state").where(F.col("key") == key).agg(F.max("version").alias("v"))
        row = last.select(
            F.lit(key).alias("key"),
            F.lit(value).alias("value"),
            (F.coalesce("v", F.lit(0)) + 1).alias("version"),
            F.current_timestamp().alias("updated_at"),
        )
        self.append("state", row)

    @staticmethod
    def _start():
        return F.date_format(F.current_timestamp() - F.expr("INTERVAL 24 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")

    def seed_state(self, key: str = STATE_KEY) -> int:
        """Start 24 hours back where no checkpoint is stored."""
        return self.append("state", absent_from(seed_row(self.spark, key, self._start()), self.read("state"), ["key"]))

    def seed_states(self, keys: DataFrame) -> int:
        """The same for a column ``key`` of many sources."""
        rows = keys.select("key").distinct().select(
            "key", self._start().alias("value"), F.lit(0).cast("long").alias("version"), F.current_timestamp().alias("updated_at")
        )
        return self.append("state", absent_from(rows, self.read("state"), ["key"]))
