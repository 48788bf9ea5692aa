"""Loaded files put away under their names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from vectorloom.session import _place, path_exists


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Rename within one file system; the target's folder is made."""
    here, files = _place(spark, source)
    there, _ = _place(spark, target)
    files.mkdirs(there.getParent())
    if not files.rename(here, there):
        raise OSError(f"cannot move {source} to {target}")


def archive_name(spark: SparkSession, folder: str, name: str) -> str:
    """A path of that name in the folder that is free: ``a.jsonl``, ``a_1.jsonl``, ``a_2.jsonl``..."""
    stem, dot, suffix = name.rpartition(".") if "." in name else (name, "", "")
    path, n = f"{folder}/{name}", 0
    while path_exists(spark, path):
        n += 1
        path = f"{folder}/{stem}_{n}{dot}{suffix}"
    return path


def archive_files(spark: SparkSession, paths: Iterable[str], folder: str) -> list[str]:
    """Move files into the folder, a taken name gets a number; a file that is gone already was moved by an earlier try."""
    moved = []
    for path in paths:
        if path_exists(spark, path):
            moved.append(archive_name(spark, folder.rstrip("/"), path.rsplit("/", 1)[1]))
            move_file(spark, path, moved[-1])
    return moved


def plain_path(column: str):
    """Column: a path as it is, from the percent-encoded form that Spark gives."""
    return F.url_decode(F.replace(column, F.lit("+"), F.lit("%2B")))
