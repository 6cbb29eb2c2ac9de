"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``.  Where it is unset, a temporary folder if driver and executors are one process; on a
    cluster an error, since each executor would write to a disk of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir is unset: intermediate tables need a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="strandflow-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _remove_quietly(spark: SparkSession, path: str) -> None:
    try:
        remove(spark, path)
    except Exception:  # noqa: BLE001 - at exit the JVM may be gone; the folder is the cluster's scratch space
        pass


#: In a file:// folder Hadoop writes a checksum file beside each file and starts a chmod process for every step; its raw
#: local file system does neither.  Other stores do not read these options.
RAW_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
#: Rows of a file, where the caller knows how many rows there are at most.
FILE_ROWS = 250_000


class Scratch:
    """Written intermediate tables of one operator call; ``drop`` frees those that no result reads any more."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, f"{shared_dir(spark)}/strandflow/{name}-{uuid.uuid4().hex}", 0
        atexit.register(_remove_quietly, spark, self.root)

    def write(self, df: DataFrame, rows: int | None = None) -> DataFrame:
        """Cut the lineage: write ``df`` as Parquet to the shared folder and read it back.

        ``rows``: a bound on its rows; a small table then gets few files, and a large one as many as it needs.
        """
        self.n += 1
        df = df if rows is None else df.coalesce(rows // FILE_ROWS + 1)
        path = f"{self.root}/{self.n}"
        df.write.options(compression="zstd", **RAW_FILES).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._strandflow_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            remove(self.spark, t._strandflow_path)

    def tidy(self) -> None:
        """Let the driver forget shuffles that nothing reads any more, so that their files are deleted."""
        self.spark.sparkContext._jvm.System.gc()


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """``df`` written and read back: what several branches of a plan use is computed once, and survives lost executors."""
    return Scratch(df.sparkSession, name).write(df)
