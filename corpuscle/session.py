"""Session and shared-folder helpers."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_fresh: dict[str, list[str]] = {}  # paths given out, by application


def local_session(cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpuscle")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of the session.

    Needed once per application unless the package is installed on the
    executors or was passed with ``--py-files``.
    """
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="corpuscle-")) / "corpuscle"
        spark.sparkContext.addPyFile(shutil.make_archive(str(archive), "zip", package.parent, package.name))
        _shipped.add(application)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the session.

    Only a local session without ``spark.checkpoint.dir`` falls back to a
    folder of this machine: on a cluster that folder would be lost with the
    executor that wrote it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if context.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="corpuscle-")
        context.setCheckpointDir(folder)
        return folder
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has been written to yet."""
    path = f"{shared_folder(spark)}/corpuscle/{name}-{uuid.uuid4().hex}"
    _fresh.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, keeps the columns
    prunable and makes every later pass see the same rows.  Results read the
    staged tables when they are used, so these stay until ``discard_staged``.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard_staged(spark: SparkSession) -> int:
    """Delete what this application has put below the shared folder; returns how many folders went.

    Call it when the results that read them have been written or collected.
    """
    return sum(discard(spark, path) for path in _fresh.pop(spark.sparkContext.applicationId, []))


def discard(spark: SparkSession, path: str) -> bool:
    """Delete a folder that ``fresh_path`` gave and nothing will read again; whether it was there."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return bool(place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True))


def spread(scan: DataFrame, few: int = 8) -> DataFrame:
    """Rebalance a scan of fewer splits than ``few`` and than the session has cores.

    Only small tables are, those of a few files; others pass through unchanged,
    however many cores there are.  Call it on plain scans only, where the split
    count is known without running a job.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < min(cores, few) else scan
