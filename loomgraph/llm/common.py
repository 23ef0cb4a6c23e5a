"""What the operators share: reading tables, staging results in the shared folder, shipping code."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.sources.staging import shared_dir

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of a batch for a Python worker.
BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
#: Bytes up to which a table is broadcast.
BROADCAST_BYTES = 16 << 20

_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, so that their Python workers can import it, and bounds the
    batches that they are sent by bytes (the bound of records alone would let long texts fill a worker)."""
    most = int(spark.conf.get(BATCH_CONF, str(BATCH_BYTES)).rstrip("b"))
    if not 0 < most <= BATCH_BYTES:
        spark.conf.set(BATCH_CONF, BATCH_BYTES)
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix="loomgraph-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    target = os.path.join(folder, "loomgraph.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent).as_posix())
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def lean(go: Callable) -> Callable:
    """A function over the batches of a task that leaves little behind in its Python worker, which serves later tasks, too: words that
    tokenizers keep from an earlier operator go before it, and free memory goes back to the system after it."""

    @wraps(go)
    def run(batches: Iterator) -> Iterator:
        import ctypes

        import pyarrow

        from loomgraph.llm import tokens

        tokens.words_of.cache_clear()
        tokens.library.cache_clear()
        yield from go(batches)
        pyarrow.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)

    return run


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Stage:
    """Tables written to the shared folder to cut lineage.

    A lost executor loses none of them.  ``drop`` removes those that nothing lazy still reads; the
    rest go when the driver ends, or by ``remove`` after the results have been written.  All lie below one
    folder per application, by which the tables of a killed driver can be told and removed."""

    made: list[Stage] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
        self.n = 0
        Stage.made.append(self)
        atexit.register(self._clean)

    def remove(self) -> None:
        self._clean()
        Stage.made.remove(self)

    def _clean(self) -> None:
        try:
            _remove(self.spark, self.root)
        except Exception:  # noqa: BLE001  the session may have ended before the interpreter does
            pass

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n:03d}-{name}"
        schema = df.schema
        df.write.parquet(path)
        out = self.spark.read.schema(schema).parquet(path)
        out.staged_path = path
        return out

    def cut(self, df: DataFrame) -> DataFrame:
        return self.write(df, "cut")

    def drop(self, *dfs: DataFrame) -> None:
        for df in dfs:
            if path := getattr(df, "staged_path", None):
                _remove(self.spark, path)


def _bytes(df: DataFrame) -> Column:
    """About as many as a row takes in memory."""
    def of(c: Column, kind: T.DataType) -> Column:
        if isinstance(kind, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(c), F.lit(0)) + 24
        if isinstance(kind, T.StructType):
            return sum((of(c[f.name], f.dataType) for f in kind.fields), F.lit(8))
        if isinstance(kind, T.ArrayType):
            return F.lit(16) + F.coalesce(F.size(c), F.lit(0)) * 24
        return F.lit(8)

    return sum((of(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(32))


def few(df: DataFrame, most: int = BROADCAST_BYTES) -> bool:
    """Whether a table has at most ``most`` bytes: the check before any broadcast."""
    return (df.agg(F.sum(_bytes(df).cast("long"))).head()[0] or 0) <= most


def small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``most`` bytes, else as it is (a shuffled join, which
    adaptive execution splits where a key is hot)."""
    return F.broadcast(df) if few(df, most) else df


def join_counted(rows: DataFrame, keys: DataFrame, on: list[str], how: str = "inner", hot: int = 1000) -> DataFrame:
    """Join with ``keys``, which has a row per key, with n, how many rows hold it.  Where the keys are too many to broadcast, those that more than
    one row in ``hot`` holds, of which there are fewer than ``hot``, are, and only rows of other keys are shuffled."""
    if few(keys):
        return rows.join(F.broadcast(keys.drop("n")), on, how)
    total = keys.agg(F.sum("n")).head()[0]
    common = F.broadcast(keys.filter(F.col("n") * hot > total))
    rest = rows.join(common.select(on), on, "left_anti").join(keys.filter(F.col("n") * hot <= total).drop("n"), on, how)
    return rows.join(common.drop("n"), on, how).unionByName(rest)
