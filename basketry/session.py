"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import AbstractContextManager, contextmanager, nullcontext
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import types as T

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_SHUFFLE = "spark.sql.shuffle.partitions"
_local_scratch: dict[str, str] = {}
# Folders of the runs that are open, the innermost last.
_open_runs: list[str] = []


def prepare(spark: SparkSession) -> SparkSession:
    """Set what the results depend on: days, months and hashes are taken in UTC.

    Times are written as Parquet microseconds: the default INT96 has no statistics, so a filter on
    the invoice date could not skip row groups.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    return spark


# Settings that hold from one core to a large cluster; what the submitter sets comes first.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
}
_PARTITION_BYTES = 256 * 1024 * 1024
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Of what a load stages and stores: row hashes are text of 16 different letters, which the default codec stores at full length.
COMPRESSION = "zstd"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting that holds inside the block only."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def dropping_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Shuffle files of a query inside the block go when it ends, not when the driver next collects its garbage.

    For what runs once, as writes do: a frame that is run again would be shuffled again.
    """
    return setting(spark, _DROP_SHUFFLES, "true")


def job_session(name: str) -> SparkSession:
    """Session of a job, with settings that hold from one core to a large cluster."""
    spark = SparkSession.builder.appName(name).getOrCreate()
    given = spark.sparkContext.getConf()
    for key, value in _DEFAULTS.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    return prepare(spark)


def read_if_exists(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """A Parquet table, or ``None`` before anything has been written to it."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own: a machine-local folder would
    be lost with its executor.
    """
    shared = spark.conf.get(_CHECKPOINT_DIR, None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_CHECKPOINT_DIR} to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="basketry-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, in the run's own one while a run is open; never used twice."""
    app = spark.sparkContext.applicationId
    base = _open_runs[-1] if _open_runs else f"{scratch_dir(spark)}/basketry/{app}"
    return f"{base}/{name}-{uuid.uuid4().hex}"


@contextmanager
def run_scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """All that is staged inside lies in one folder, which goes when the block ends, well or not."""
    folder = scratch_path(spark, name)
    _open_runs.append(folder)
    try:
        yield folder
    finally:
        _open_runs.remove(folder)
        delete_path(spark, folder)


def _file_system(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; nothing happens if there is none."""
    files, hadoop = _file_system(spark, path)
    files.delete(hadoop, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if there is no such folder."""
    files, hadoop = _file_system(spark, path)
    return sorted(entry.getPath().getName() for entry in files.listStatus(hadoop)) if files.exists(hadoop) else []


def path_exists(spark: SparkSession, path: str) -> bool:
    files, hadoop = _file_system(spark, path)
    return files.exists(hadoop)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, on the driver."""
    files, hadoop = _file_system(spark, path)
    stream = files.open(hadoop)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, from the driver."""
    files, hadoop = _file_system(spark, path)
    stream = files.create(hadoop, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; the folder it goes to is made."""
    files, hadoop = _file_system(spark, source)
    _, aim = _file_system(spark, target)
    files.mkdirs(aim.getParent())
    if not files.rename(hadoop, aim):
        raise OSError(f"cannot move {source} to {target}")


def input_bytes(spark: SparkSession, paths: Iterable[str]) -> int:
    """Size of the files at these paths or patterns; 0 for what is not there."""
    total = 0
    for path in paths:
        files, hadoop = _file_system(spark, path)
        total += sum(files.getContentSummary(found.getPath()).getLength() for found in files.globStatus(hadoop) or ())
    return total


def fit_shuffles(spark: SparkSession, paths: Iterable[str]) -> None:
    """Let shuffles start with partitions of 256 MB of the input, unless the submitter has set their number.

    Adaptive execution merges what turns out small; it cannot split the partition of an aggregate.
    """
    if spark.sparkContext.getConf().contains(_SHUFFLE):
        return
    wanted = max(4 * spark.sparkContext.defaultParallelism, -(-input_bytes(spark, paths) // _PARTITION_BYTES))
    spark.conf.set(_SHUFFLE, str(wanted))


def stage(df: DataFrame, name: str, path: str | None = None, packed: bool = False) -> DataFrame:
    """Write ``df`` as Parquet and read it back: a restart point that outlives any executor.

    ``packed``: take less disk, by a slower codec, and drop the shuffle files of the write when it ends.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    with dropping_shuffles(spark) if packed else nullcontext():
        df.write.parquet(path, compression=COMPRESSION if packed else None)
    return spark.read.schema(df.schema).parquet(path)


def stage_observed(
    df: DataFrame, name: str, metrics: dict[str, Column], path: str | None = None
) -> tuple[DataFrame, dict[str, Any]]:
    """``stage``, packed, and aggregates of the rows, taken while these are written instead of by a scan of their own.

    The tasks that write also count, and Spark takes up one success of each such task. So a task that runs again
    after its executor was lost counts once, which would not hold for a task before a shuffle.
    """
    seen = Observation()
    staged = stage(df.observe(seen, *[metric.alias(label) for label, metric in metrics.items()]), name, path, packed=True)
    return staged, dict(seen.get)
