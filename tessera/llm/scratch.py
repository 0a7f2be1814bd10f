"""Tables written between the phases of one operator, in the shared folder.

Every phase boundary is a Parquet table under ``spark.checkpoint.dir`` (never a
machine-local folder on a cluster, never ``localCheckpoint``), so a lost
executor only costs its running tasks. A folder of our own is made only where
the setting is absent, as in local tests.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import re
import sys
import tempfile
import time
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Masters that are one process.
LOCAL = r"local(\[|$)"


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one where it is unset and the master is this machine alone."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        path = getattr(spark.sparkContext, "_tessera_scratch", None)
        if path is None:
            if not re.match(LOCAL, spark.sparkContext.master):
                raise ValueError("spark.checkpoint.dir is unset: it must name a folder that driver and executors share")
            path = "file://" + tempfile.mkdtemp(prefix="tessera-")
            spark.sparkContext._tessera_scratch = path
    return path


def named(df: DataFrame, name: str) -> Column:
    """A column by its whole name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def added(df: DataFrame, names: list[str]) -> dict[str, str]:
    """Names for new columns: ``_`` is put behind those that the frame has already."""
    taken, out = {c.lower() for c in df.columns}, {}
    for name in names:
        free = name
        while free.lower() in taken:
            free += "_"
        taken.add(free.lower())
        out[name] = free
    return out


class Scratch:
    """Tables of one operator call: ``put`` writes one and reads it back, ``drop`` and ``keep`` delete.

    An operator leaves its result, which is read later, and nothing else.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.tables: set[str] = set()

    def put(self, df: DataFrame, table: str, row_group: int | None = None) -> DataFrame:
        path = f"{self.root}/{table}"
        self.tables.add(table)
        writer = df.write.option("compression", "zstd")
        (writer.option("parquet.block.size", row_group) if row_group else writer).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *tables: str) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{table}")
            path.getFileSystem(conf).delete(path, True)
            self.tables.discard(table)

    def keep(self, *tables: str) -> None:
        """Deletes all tables but these: what a result that is written needs no longer."""
        self.drop(*sorted(self.tables.difference(tables)))

    def settle(self) -> None:
        """Let Spark delete the shuffle files of finished phases now, not when the driver next collects garbage.

        The first collection releases what listeners still held, the second
        the shuffles themselves; files go in the background. Where everything
        runs in this process, its own collections come soon enough.
        """
        if re.match(LOCAL, self.spark.sparkContext.master):
            return
        for _ in range(2):
            gc.collect()
            self.spark.sparkContext._jvm.System.gc()
            time.sleep(0.5)


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None


def release() -> None:
    """Gives back what a worker's allocators hold unused: workers outlive tasks, and an executor's share one limit."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


@contextlib.contextmanager
def one_a_batch(spark: SparkSession):
    """What is planned and run inside sends large rows to Python one by one, so that neither side holds several."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "1")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def ship(spark: SparkSession) -> None:
    """Make this package importable on the executors (once per application)."""
    sc = spark.sparkContext
    if getattr(sc, "_tessera_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    top = os.path.dirname(os.path.dirname(here))
    target = os.path.join(tempfile.mkdtemp(prefix="tessera-ship-"), "tessera_llm_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        z.write(os.path.join(top, "tessera", "__init__.py"), "tessera/__init__.py")
        for name in sorted(os.listdir(here)):
            if name.endswith(".py"):
                z.write(os.path.join(here, name), f"tessera/llm/{name}")
    sc.addPyFile(target)
    sc._tessera_shipped = True


__all__ = ["Scratch", "added", "named", "one_a_batch", "release", "shared_dir", "ship"]
