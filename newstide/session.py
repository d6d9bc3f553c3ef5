"""Session settings and the shared folder that tables between steps go to."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a rerun of a batch replaces the partitions it writes and nothing else
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the jobs rely on to a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session on this machine, for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("newstide")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: work folders of this process that have not been released
_FOLDERS: list[str] = []


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="newstide-")


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    Every executor must see what one of them writes, so on a cluster the setting has
    to name a shared folder. Only a local session may fall back to a temporary one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        root = _local_root()
    folder = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _FOLDERS.append(folder)
    return folder


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever it is stored; one that is not there is no error."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Delete the work folders made so far: when all results that read them are stored."""
    while _FOLDERS:
        remove_folder(spark, _FOLDERS.pop())
