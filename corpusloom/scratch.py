"""Intermediate tables in the shared folder of ``spark.checkpoint.dir``.

A written table cuts lineage and survives lost executors: whatever is recomputed starts from files that every
executor sees. The folder comes from the session; only where the setting is absent (tests) is a local one made.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by the session."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir isn't set: executors need a folder that all of them see")
    made = f"file://{tempfile.mkdtemp(prefix='corpusloom-')}"
    spark.conf.set("spark.checkpoint.dir", made)
    return made


class Scratch:
    """Tables of one operator run, under a folder of their own."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as Parquet and read it back."""
        path = self.path(name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables whose readers have all been written."""
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def release(self) -> None:
        """Let Spark remove the shuffle files of plans that nothing refers to any more, and executors hand back heap that they don't use.

        A heap that has grown keeps memory that Python workers in the same container will need; a collection shrinks it.
        """
        import gc

        gc.collect()
        self.spark._jvm.System.gc()
        context = self.spark.sparkContext
        if not context.master.startswith("local["):
            n = context.defaultParallelism
            self.spark.range(0, n, 1, n).select(F.expr("java_method('java.lang.System', 'gc')").alias("done")).write.format("noop").mode("overwrite").save()
