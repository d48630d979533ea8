"""Intermediate tables as parquet in the folder that driver and executors share.

The folder is the one the session names in ``spark.checkpoint.dir``.  Where it is unset (tests, one machine) a folder of
this process is set; on a cluster an unset folder is an error, because no path is known that every executor can reach.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_made: dict[str, str] = {}
_FOLDERS: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``."""
    named = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _made:
        _made[app] = tempfile.mkdtemp(prefix="stagewatch-scratch-")
    return _made[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses; it is deleted when the driver ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if not _FOLDERS:
        atexit.register(_delete_all)
    _FOLDERS.append((spark, path))
    return path


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once and read it back: short lineage, column pruning and known sizes for what follows."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete_all() -> None:
    """Delete this process's scratch tables; a session that has ended already leaves them to the folder's owner."""
    for spark, path in _FOLDERS:
        context = spark.sparkContext
        if context._jsc is None or context._jsc.sc().isStopped():
            continue
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
