"""What several operators of this folder share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, through Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.voltweave.shared.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="spark-voltweave-")
        spark.conf.set("spark.voltweave.shared.dir", folder)
    return folder.rstrip("/")


def staged(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Writes df to the shared folder and reads it again: cuts the lineage, and a lost executor loses nothing.

    What planning and scheduling the write left behind in the driver goes at once. Left to itself its heap grows to its limit in operators
    of many steps, and keeps that size for the rest of the session.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/voltweave-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    free_shuffles(spark)
    return out


def free_shuffles(spark: SparkSession) -> None:
    """Spark drops the shuffles and broadcasts of queries that are done when the driver collects garbage, by itself every half hour; here they go at once,
    and the heap shrinks to what its live data need."""
    spark._jvm.System.gc()


def discard(*tables: DataFrame) -> None:
    """Removes staged tables that nothing will read again, not even lazily, and the shuffles that made them."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t.staged_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    if tables:
        free_shuffles(tables[0].sparkSession)


#: Rows that Python workers get at once; whole texts of 10,000 rows, Spark's default, and what is made of them take too much of an executor's memory.
BATCH = 1000


def small_batches(spark: SparkSession) -> None:
    """Sets the session's rows per Arrow batch to BATCH, unless it already has another number than Spark's default."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH))


def give_back() -> None:
    """Returns what this Python worker has freed to the system. Spark keeps workers for later tasks, and freed arrays stay with them, about as much again as what they use."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's; other allocators do it by themselves
    if trim:
        trim(0)


def short_plans(spark: SparkSession, most: int = 20_000) -> None:
    """Bounds the texts of plans, where the session has Spark's own limit of 2 GB: the driver keeps those of its last thousand queries, and
    an operator of many steps has long ones."""
    key = "spark.sql.maxPlanStringLength"
    if int(spark.conf.get(key).rstrip("b")) > 2_000_000_000:
        spark.conf.set(key, str(most))


def words(text: Column) -> Column:
    """Number of maximal runs of other than ASCII white space; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def crc_fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id written as text, modulo folds; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % folds
