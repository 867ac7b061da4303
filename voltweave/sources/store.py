"""Tables on shared storage: partitioned outputs, what has been done already, and caches that know what they were built from."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_by_month(df: DataFrame, path: str, month: str = "YM") -> None:
    """Parquet in a folder per month; only the months in df are replaced. Large months are split over tasks."""
    writer = df.hint("rebalance", month).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("compression", "snappy").partitionBy(month).parquet(path)


def read_months(spark: SparkSession, path: str, months: list[int] | None = None, month: str = "YM") -> DataFrame:
    """A table written by month; a list of months reads only their folders."""
    df = spark.read.parquet(path)
    return df if months is None else df.where(F.col(month).isin(months))


def read_or_empty(spark: SparkSession, path: str, schema: str, nested: bool = True) -> DataFrame:
    """The Parquet table, at any depth of folders, or an empty one with the schema where nothing is there; not nested: folders give columns."""
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", str(nested).lower()).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header, for reports."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def remove_folder(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Done:
    """What has been done under which version: an append-only table beside the outputs."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def items(self, version: str) -> set[str]:
        rows = read_or_empty(self.spark, self.path, "item string, version string").where(F.col("version") == version)
        return {r["item"] for r in rows.select("item").distinct().collect()}

    def add(self, items: list[str], version: str) -> None:
        if items:
            self.spark.createDataFrame([(i, version) for i in items], "item string, version string").coalesce(1).write.mode("append").parquet(self.path)


class Published:
    """Tables that are published month by month, all tables of a run at once.

    A run writes its months into folders of its own (RUN=.../YM=...) of each table, and then adds one file to the manifest: table, month,
    run, stamp. Readers take for each month the run that the manifest names last, so a run that fails midway, or a month that is being replaced, is never
    seen. A stamp tells from what a month was made; months whose stamp hasn't changed needn't be made again.
    """

    _MANIFEST = "name string, ym int, run string, stamp string, turn long, columns string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _latest(self) -> DataFrame:
        rows = read_or_empty(self.spark, f"{self.path}/manifest", self._MANIFEST)
        return rows.groupBy("name", "ym").agg(F.max_by(F.struct("run", "stamp", "turn", "columns"), "turn").alias("m")).select("name", "ym", "m.*")

    def stamps(self, name: str) -> dict[int, str]:
        """Month: stamp of what readers see of a table; withdrawn months aren't there."""
        return {r["ym"]: r["stamp"] for r in self._latest().where((F.col("name") == name) & F.col("run").isNotNull()).collect()}

    def publish(self, tables: dict[str, DataFrame], stamps: dict[int, str], withdrawn: list[int] | None = None) -> None:
        """Writes these months of all tables (each with its month YM), then shows all of them at once; withdrawn months are shown no longer. One run at a time."""
        run = f"r{uuid.uuid4().hex}"
        for name, df in tables.items():
            rows = df.where(F.col("YM").isin(list(stamps))).withColumn("RUN", F.lit(run))
            rows.hint("rebalance", "YM").write.mode("append").option("compression", "snappy").partitionBy("RUN", "YM").parquet(f"{self.path}/{name}")
        turn = (self._latest().agg(F.max("turn")).first()[0] or 0) + 1
        made = [(name, ym, run, stamp, turn, ", ".join(f"`{c}` {kind}" for c, kind in df.dtypes)) for name, df in tables.items() for ym, stamp in stamps.items()]
        made += [(name, ym, None, None, turn, None) for name in tables for ym in withdrawn or ()]
        if made:
            self.spark.createDataFrame(made, self._MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")

    def read(self, name: str, months: list[int] | None = None) -> DataFrame:
        """A table as it was published last; a list of months reads only their folders."""
        shown = [r for r in self._latest().where((F.col("name") == name) & F.col("run").isNotNull()).collect() if months is None or r["ym"] in months]
        columns = max(((r["turn"], r["columns"]) for r in shown), default=(0, None))[1]
        if columns is None:
            raise ValueError(f"nothing is published as {name} under {self.path} for these months")
        by_run: dict[str, list[int]] = {}
        for r in shown:
            by_run.setdefault(r["run"], []).append(r["ym"])
        wanted = F.lit(False)
        for run, yms in by_run.items():
            wanted = wanted | ((F.col("RUN") == run) & F.col("YM").isin(sorted(yms)))
        return self.spark.read.schema(f"{columns}, RUN string").parquet(f"{self.path}/{name}").where(wanted).drop("RUN")

    def vacuum(self, names: list[str]) -> int:
        """Removes folders of months that no reader is shown any more; their number. Not while others read or publish."""
        kept = {(r["name"], r["run"], r["ym"]) for r in self._latest().collect()}
        removed = 0
        for name in names:
            # Without a file there is no schema, and nothing to remove.
            there = read_or_empty(self.spark, f"{self.path}/{name}", "x int, RUN string, YM int", nested=False).select("RUN", "YM").distinct().collect()
            for run, ym in [(r["RUN"], r["YM"]) for r in there if (name, r["RUN"], r["YM"]) not in kept]:
                removed += remove_folder(self.spark, f"{self.path}/{name}/RUN={run}/YM={ym}")
        return removed


def cache_by_month(spark: SparkSession, path: str, stamps: dict[int, str], build: Callable[[list[int]], DataFrame], name: str = "table") -> DataFrame:
    """A table with a month YM, of which only months with a new stamp are built: build gives the rows of the months that it is asked for.

    What the table holds of a month must follow from that month alone (peaks, band hours, daily sums); years are made of months. Months without a stamp any more are left out.
    """
    cache = Published(spark, path)
    held = cache.stamps(name)
    changed = sorted(m for m, stamp in stamps.items() if held.get(m) != stamp)
    gone = sorted(m for m in held if m not in stamps)
    if changed or gone:
        rows = build(changed) if changed else cache.read(name)
        cache.publish({name: rows}, {m: stamps[m] for m in changed}, gone)
    return cache.read(name, sorted(stamps))


def month_stamps(rows: DataFrame, month: Column, version: str = "1") -> dict[int, str]:
    """Month: a stamp of its rows, whatever their order, from their number and the sums of two hashes of each."""
    first, second = F.xxhash64(*rows.columns).cast("decimal(20,0)"), F.xxhash64(F.lit(7), *rows.columns).cast("decimal(20,0)")
    sums = rows.groupBy(month.alias("ym")).agg(F.concat_ws(":", F.lit(version), F.count("*").cast("string"), F.sum(first).cast("string"), F.sum(second).cast("string")).alias("stamp"))
    return {r["ym"]: r["stamp"] for r in sums.where("ym is not null").collect()}


def cache_table(spark: SparkSession, path: str, signature: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table at path if it was built under this signature, else what build gives, written there first."""
    done = Done(spark, f"{path}.built")
    latest = read_or_empty(spark, done.path, "item string, version string")
    if latest.where(F.col("version") == signature).limit(1).count() == 0:
        build().write.mode("overwrite").parquet(path)
        spark.createDataFrame([("table", signature)], "item string, version string").coalesce(1).write.mode("overwrite").parquet(done.path)
    return spark.read.parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new place in the folder that driver and executors share (spark.checkpoint.dir); a folder of its own in a local session without one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="spark-scratch-")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def months_signature(months: list[int], version: str = "1") -> str:
    return f"{version}:{','.join(str(m) for m in sorted(months))}"
