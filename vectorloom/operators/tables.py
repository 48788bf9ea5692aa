"""Writes that keep keys unique, key/value state, snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vectorloom.config import MAX_BROADCAST_KEYS
from vectorloom.session import delete_folder, folder_names, stored


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that a later filter must not compute a second time.

    Filters on plain columns are pushed below their projection, where the whole
    expression is evaluated again; they stop at a generator.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def first_wins(df: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    """The first row of each key.

    Every task keeps one row per key before the shuffle, so a key that fills a
    third of the input sends one row per task.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def absent_from(
    df: DataFrame, existing: DataFrame, keys: Sequence[str], key_count: int | None = None
) -> DataFrame:
    """Rows whose key the table does not have yet.

    With ``key_count`` known and small (a micro-batch), the table is first cut
    to the keys of the batch by a broadcast, so the table is only scanned, never
    shuffled; what is left is no more than the batch and is broadcast too, so the
    rows stay where they are. Otherwise both sides meet by a shuffle on the key.
    """
    present = existing.select(*keys)
    if key_count is not None and key_count <= MAX_BROADCAST_KEYS:
        present = F.broadcast(present.join(F.broadcast(df.select(*keys)), list(keys), "left_semi").distinct())
    return df.join(present, list(keys), "left_anti")


def marked_rows(df: DataFrame, marks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key ``marks`` marks as ``_new``.

    ``marks`` is a stored, narrow table with a row for each key of ``df``. Its
    shorter list, of the new keys or of the others, is broadcast, so ``df`` is
    not shuffled; only if both are long do the rows meet the keys by a shuffle.
    """
    fresh, known = marks.agg(F.count_if("_new"), F.count_if(~F.col("_new"))).first()
    if not known:
        return df
    if known <= MAX_BROADCAST_KEYS:
        return df.join(F.broadcast(marks.where(~F.col("_new")).select(*keys)), list(keys), "left_anti")
    kept = marks.where("_new").select(*[F.col(k).alias(f"_{k}") for k in keys])
    if fresh <= MAX_BROADCAST_KEYS:
        kept = F.broadcast(kept)
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return df.join(kept, reduce(Column.__and__, same), "left_semi")


def absent_rows(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same as ``absent_from`` for wide rows in any number: keys alone are shuffled, compared and stored."""
    there = existing.select(*keys).distinct().withColumn("_there", F.lit(True))
    given = df.select(*keys).distinct().join(there, list(keys), "left")
    return marked_rows(df, stored(given.select(*keys, F.col("_there").isNull().alias("_new")), "keys"), keys)


def latest_by_key(log: DataFrame, key: str, value: str, *order: str) -> DataFrame:
    """Last written value of each key of an append-only log."""
    newest = F.struct(*order)
    return log.groupBy(key).agg(F.max_by(value, newest).alias(value), F.max(newest).alias("_at")).select(
        key, value, *[F.col(f"_at.{c}").alias(c) for c in order]
    )


def newest_by_key(log: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """Whole newest row of each key; merged rows may be merged again with later ones."""
    rest = [c for c in log.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return log.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*log.columns)


def seed_row(spark, key: str, value: Column) -> DataFrame:
    """A state row to insert when the key is absent."""
    return spark.range(1).select(
        F.lit(key).alias("key"),
        value.cast("string").alias("value"),
        F.lit(0).cast("long").alias("version"),
        F.current_timestamp().alias("updated_at"),
    )


def kept_snapshots(snapshots: DataFrame, column: str, keep: int = 3) -> DataFrame:
    """Dates of the current snapshot and the ``keep`` before it.

    Only the distinct dates are ranked, never the rows behind them.
    """
    dates = snapshots.select(column).distinct()
    return dates.orderBy(F.col(column).desc()).limit(keep + 1)


def expired_snapshots(snapshots: DataFrame, column: str, keep: int = 3) -> DataFrame:
    dates = snapshots.select(column).distinct()
    return dates.join(F.broadcast(kept_snapshots(dates, column, keep)), column, "left_anti")


def full_refresh(df: DataFrame, path: str, snapshot: str) -> str:
    """Write a whole new snapshot next to the older ones; returns its folder."""
    folder = f"{path.rstrip('/')}/snapshot={snapshot}"
    df.write.mode("overwrite").parquet(folder)
    return folder


def drop_expired(spark, path: str, keep: int = 3) -> list[str]:
    """Delete snapshot folders beyond the retention; returns their dates."""
    snapshots = [n for n in folder_names(spark, path) if n.startswith("snapshot=")]
    names = sorted(n.split("=", 1)[1] for n in snapshots)
    expired = names[: max(0, len(names) - keep - 1)]
    for name in expired:
        delete_folder(spark, f"{path.rstrip('/')}/snapshot={name}")
    return expired
