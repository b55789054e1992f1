"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# One local work folder per Spark application; used in local mode only.
_LOCAL_FOLDERS: dict[str, str] = {}


def local_session(cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine.

    On a cluster the session comes from ``spark-submit``; nothing in this package
    needs these settings there.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ferryline")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new, unused path below the folder that all executors share.

    The folder is the session's ``spark.checkpoint.dir``. Where that is unset and
    the master is local, a temporary folder stands in for it. Elsewhere a missing
    setting is an error: a path on one machine would be invisible to the others.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = _LOCAL_FOLDERS.get(context.applicationId)
        if base is None:
            base = tempfile.mkdtemp(prefix="ferryline-")
            _LOCAL_FOLDERS[context.applicationId] = base
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


# Some jobs take a setting from the session only, which all threads share.
SETTINGS = threading.RLock()


@contextmanager
def session_settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Settings for one job. Jobs that need some take turns, so none sees another's settings."""
    with SETTINGS:
        before = {name: spark.conf.get(name) for name in values}
        try:
            for name, value in values.items():
                spark.conf.set(name, value)
            yield
        finally:
            for name, value in before.items():
                spark.conf.set(name, value)


def scratch_database(spark: SparkSession) -> str:
    """A new database whose managed tables lie in the shared folder."""
    name = f"ferryline_{uuid.uuid4().hex[:12]}"
    location = shared_folder(spark, name).replace("'", "\\'")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{location}'")
    return name


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a later step must see the same rows again (a partition number, a
    staged load). The written table survives the loss of executors, unlike cached
    blocks.
    """
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of staged data, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def folders_with(spark: SparkSession, parent: str, name: str) -> list[str]:
    """Names, in order, of the folders directly below ``parent`` that hold a file ``name``."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(parent, f"*/{name}")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(f.getPath().getParent().getName() for f in found or [])


def data_file_names(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Paths, in order, of the files directly in ``folder`` whose names match a glob pattern."""
    target = spark._jvm.org.apache.hadoop.fs.Path(folder, pattern)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return sorted(f.getPath().toString() for f in found or [])


def depth(spark: SparkSession, path: str) -> int:
    """Number of folder names in a path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).depth()


def data_files(spark: SparkSession, folder: str) -> int:
    """Files directly in a folder, without hidden ones and markers; 0 if there is no such folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(target):
        return 0
    return sum(1 for f in system.listStatus(target) if not f.getPath().getName().startswith(("_", ".")))


def folder_state(spark: SparkSession, folder: str) -> str:
    """Number, bytes and latest change of the files directly in a folder, hidden ones apart; changes when its data do."""
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    listed = system.listStatus(target) if system.exists(target) else []
    files = [f for f in listed if not f.getPath().getName().startswith(("_", "."))]
    return f"{len(files)} {sum(f.getLen() for f in files)} {max((f.getModificationTime() for f in files), default=0)}"
