"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from vectorloom.config import ARROW_BYTES, LAYER_SPLIT


def build_session(app: str = "vectorloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; arguments come on top."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **{k: str(v) for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once per application.

    The encoder and the nearest-neighbour kernel run in Python workers, which
    import it. Not needed where it is installed or given by ``--py-files``.
    """
    app_id = spark.sparkContext.applicationId
    package = Path(__file__).resolve().parent
    if app_id not in _shipped and package.is_dir():
        target = f"{tempfile.mkdtemp(prefix='run-', dir='/tmp')}/{package.name}"
        spark.sparkContext.addPyFile(
            shutil.make_archive(target, "zip", root_dir=package.parent, base_dir=package.name)
        )
        _shipped.add(app_id)
    return spark


@cache
def _local_dir(app_id: str) -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_dir(spark.sparkContext.applicationId)


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a fresh, not yet existing folder below the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def spread(df: DataFrame) -> DataFrame:
    """Spread a frame over the cluster when its scan has too few splits.

    A scan with at least one split per core is left alone, so large inputs
    are never shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def scan_tasks(df: DataFrame) -> int:
    """Number of tasks to expect, from the size the optimizer assumes for a frame."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    split = df.sparkSession.conf.get("spark.sql.files.maxPartitionBytes").lower().rstrip("b")
    return max(1, size // (int(split) if split.isdigit() else 128 << 20))


@contextmanager
def short_splits(spark: SparkSession, size: int = LAYER_SPLIT) -> Iterator[None]:
    """Scans that start meanwhile put at most ``size`` bytes of files into a task, or less if the session says so.

    A scan that keeps only the newest files of a day is dealt by all of them: with long splits the new
    ones, alike in size, share a few tasks and the other cores wait.
    """
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    given = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before))
    spark.conf.set(name, str(min(size, given)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: Parquet files are read without vectored reads. Those go through threads that never end, each with a buffer outside
#: the heap as long as the longest column chunk it has read.
PLAIN_READS = {"parquet.hadoop.vectored.io.enabled": "false"}


@contextmanager
def small_buffers(spark: SparkSession) -> Iterator[None]:
    """Executors keep no large buffers outside the heap for what starts meanwhile.

    Reads are plain ones, and batches for Python are cut at ``ARROW_BYTES``, as both sides hold several of them.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = {name: spark.conf.get(name), **{plain: spark.conf.get(plain, None) for plain in PLAIN_READS}}
    given = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before[name]))
    settings = {name: str(min(ARROW_BYTES, given) if given > 0 else ARROW_BYTES), **PLAIN_READS}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    For a result used more than once: it is computed one time, its plan ends
    here, and it survives the loss of an executor.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system its path names."""
    place, files = _place(spark, path)
    return files.exists(place)


def delete_folder(spark: SparkSession, path: str) -> None:
    place, files = _place(spark, path)
    files.delete(place, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder."""
    place, files = _place(spark, path)
    return [entry.getPath().getName() for entry in files.listStatus(place)]
