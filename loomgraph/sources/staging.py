"""Where intermediate tables go: the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``.  Where it is unset, a temporary folder if driver and executors are one process, else an error."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    sc = spark.sparkContext
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    if sc.applicationId not in _own:
        _own[sc.applicationId] = folder = tempfile.mkdtemp(prefix="loomgraph-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return "file:" + _own[sc.applicationId]


def reliable(df: DataFrame) -> DataFrame:
    """A checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_dir(df.sparkSession) + "/checkpoints")
    return df.checkpoint()


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, which goes when the driver ends."""
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def clean() -> None:
        try:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
        except Exception:  # noqa: BLE001  the session may have ended before the interpreter does
            pass

    atexit.register(clean)
    return path
