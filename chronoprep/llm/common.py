"""Shared helpers: the shared scratch folder, written tables, table readers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Where the setting is absent a temporary folder is used, which only a local
    master can share with its executors; any other master raises.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder shared by driver and executors")
        folder = "file://" + tempfile.mkdtemp(prefix="chronoprep-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stash(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts lineage in a way that survives lost executors, gives the optimiser
    true sizes to choose joins by, and drops the partitioning of the producer so
    that a later join deals both sides itself (and may split a skewed key).
    """
    spark = df.sparkSession
    path = f"{scratch(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stash_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete stashed tables that nothing reads any more: what was computed from them must be stashed itself."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stash_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(df: DataFrame, rows: int = 1000, size: int = 8 << 20) -> DataFrame:
    """``df``, after bounding what Arrow hands over at once.

    Whole texts pass through Arrow buffers on both sides, beside the heap, and the
    default of 10,000 rows makes them large.  The settings are the session's and are
    only ever lowered.
    """
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    now = conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None)
    if now and now.rstrip("b").isdigit() and int(now.rstrip("b")) > size:
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{size}b")
    return df


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
