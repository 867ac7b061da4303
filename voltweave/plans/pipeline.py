"""The batch pipeline: CSV to month-partitioned readings, readings and master to the five outputs."""

from __future__ import annotations

import hashlib
import logging
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltweave.constants import PARAMETERS
from voltweave.functions.columns import month_of
from voltweave.operators import coverage, master, readings, rules, thresholds
from voltweave.sources.csv import file_stamps, raw_readings
from voltweave.sources.store import Published, remove_folder, write_by_month

SCHEMA_VERSION, LOGIC_VERSION = "1", "1"
OUTPUTS = ("clean_data", "hard_anomalies", "threshold_anomalies", "missing_slot_days", "missing_slot_days_dt")


RAW = f"MTR_NO string, OCCUR_D_RAW date, TIME_SLOT string, {', '.join(f'{p} double' for p in PARAMETERS)}, SOURCE_FILE string, SOURCE_YM int"
LEDGER = "file string, stamp string, version string, source_ym int, date_ym int, first_day date, last_day date, n_rows long"


def _file_month(file: str) -> int | None:
    name = file.rsplit("/", 1)[-1]
    found = re.search(r"20\d{4}", name)
    return int(found[0]) if found else None


def ledger(spark: SparkSession, raw_path: str) -> DataFrame:
    """What the raw table holds of each file: its stamp, the folders its readings lie in, and by month of their dates how many and from when to when."""
    return Published(spark, f"{raw_path}.ledger").read("files") if _has_ledger(spark, raw_path) else spark.createDataFrame([], LEDGER)


def _has_ledger(spark: SparkSession, raw_path: str) -> bool:
    return bool(Published(spark, f"{raw_path}.ledger").stamps("files"))


def ingest_raw(spark: SparkSession, csv_path: str, raw_path: str, version: str = SCHEMA_VERSION) -> list[int]:
    """Reads the CSV files that are new, changed or gone under this version, with the others of their months, into folders per month; the months written.

    A file's month is that in its name. Readings of files without one lie in the month of their dates; such files are read again with every month
    that one of them has. The ledger keeps each file's stamp (time and length) and the dates that it has.
    """
    stamps = file_stamps(spark, csv_path)
    known = ledger(spark, raw_path).where(F.col("version") == version)
    held: dict[str, tuple[str, set[int]]] = {}
    for r in known.select("file", "stamp", "source_ym").distinct().collect():
        held.setdefault(r["file"], (r["stamp"], set()))[1].add(r["source_ym"])
    fresh = [f for f, stamp in stamps.items() if held.get(f, ("",))[0] != stamp]
    months = {m for f in [*fresh, *(f for f in held if f not in stamps)] for m in (held[f][1] if f in held else ())} | {_file_month(f) for f in fresh} - {None}
    unnamed = sorted(f for f in stamps if _file_month(f) is None)
    if new := [f for f in fresh if f in unnamed]:
        logging.getLogger(__name__).warning("%d files have no month in their name, their readings go by date: %s", len(new), new[0])
        months |= {r["SOURCE_YM"] for r in raw_readings(spark, new).select("SOURCE_YM").distinct().collect()}
    months = sorted(m for m in months if m is not None)
    if not months and not fresh:
        return []
    files = sorted(f for f in stamps if _file_month(f) in months) + unnamed
    write_by_month(raw_readings(spark, files).where(F.col("SOURCE_YM").isin(months)), raw_path, "SOURCE_YM")
    if not unnamed:
        for m in set(months) - {_file_month(f) for f in files}:  # all its files are gone
            remove_folder(spark, f"{raw_path}/SOURCE_YM={m}")
    _record(spark, raw_path, stamps, months, files, version)
    return months


def _record(spark: SparkSession, raw_path: str, stamps: dict[str, str], months: list[int], files: list[str], version: str) -> None:
    """Writes the ledger of these months anew, from the readings as they lie in the raw table."""
    raw = spark.read.schema(RAW).parquet(raw_path).where(F.col("SOURCE_YM").isin(months))
    day = F.col("OCCUR_D_RAW")
    seen = raw.groupBy(F.col("SOURCE_FILE").alias("file"), F.col("SOURCE_YM").alias("source_ym"), month_of(day).alias("date_ym")).agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count("*").alias("n_rows"))
    known = spark.createDataFrame([(f, s, version) for f, s in stamps.items()], "file string, stamp string, version string")
    rows = seen.join(known, "file").select(*[c.split()[0] for c in LEDGER.split(", ")])
    current = known.select("file", "stamp")
    before = ledger(spark, raw_path).where((F.col("version") == version) & F.col("source_ym").isNotNull() & ~F.col("source_ym").isin(months)).join(current, ["file", "stamp"], "left_semi")
    both = rows.unionByName(before.select(*rows.columns))
    # Files without a reading are known, too.
    seen_before = ledger(spark, raw_path).where((F.col("version") == version) & F.col("source_ym").isNull()).select("file")
    read = spark.createDataFrame([(f,) for f in files], "file string").union(seen_before).distinct()
    bare = known.join(read, "file", "left_semi").join(both.select("file").distinct(), "file", "left_anti")
    both = both.unionByName(bare, allowMissingColumns=True).withColumn("YM", F.lit(0))
    Published(spark, f"{raw_path}.ledger").publish({"files": both}, {0: version})


def readings_of(raw: DataFrame) -> DataFrame:
    """Raw readings under the names that operators use, with a key that breaks ties between duplicates."""
    cols = ["MTR_NO", "TIME_SLOT", *PARAMETERS]
    return raw.select(*cols, F.col("OCCUR_D_RAW").alias("DATE"), F.xxhash64(*PARAMETERS).alias("event_id")).where("DATE is not null")


def prepared(raw: DataFrame, master_rows: DataFrame, ct_enabled: bool = True) -> DataFrame:
    """Deduplicated, placed and scaled readings of all months that raw holds."""
    sequence = master.meter_sequence(master_rows)
    placed = readings.asof_master_join(readings.raw_dedup(readings_of(raw)), master_rows, master.earliest_master(master_rows), sequence)
    return readings.ct_scaling(placed, ct_enabled).drop("event_id")


def outputs(scaled: DataFrame) -> dict[str, DataFrame]:
    """The five outputs of scaled readings, each with its month YM."""
    flags = rules.hard_flags(scaled)
    counts = coverage.daily_slot_counts(scaled.withColumn("YM", month_of(F.col("DATE"))), ("YM", *coverage.METER))
    stitched = coverage.daily_slot_counts(readings.dt_stitched_readings(scaled).withColumn("YM", month_of(F.col("DATE"))), ("YM", *coverage.DT))
    found = {"clean_data": rules.clean_readings(flags), "hard_anomalies": rules.hard_anomalies(flags), "threshold_anomalies": thresholds.threshold_anomalies(thresholds.rolling_thresholds(scaled))}
    found = {name: df.withColumn("YM", month_of(F.col("DATE"))) for name, df in found.items()}
    for name, c, key in (("missing_slot_days", counts, "MTR_NO"), ("missing_slot_days_dt", stitched, "DT_CODE_NEW")):
        # Expected slots are those of the month.
        c = c.withColumn("_key", F.concat_ws("|", "YM", key))
        found[name] = coverage.missing_slot_days(c, coverage.expected_slots(c, "_key"), "_key").drop("_key")
    return found


def export_months(found: dict[str, DataFrame], path: str, stamps: dict[int, str]) -> None:
    """Writes the outputs of these months and then shows all of them at once; readers see the months as they were until the last output is written."""
    first = next(iter(found.values()))
    Published(first.sparkSession, path).publish(found, stamps)


def read_output(spark: SparkSession, path: str, name: str, months: list[int] | None = None) -> DataFrame:
    """One of the five outputs as it was published last."""
    return Published(spark, path).read(name, months)


def month_inputs(spark: SparkSession, raw_path: str, version: str) -> dict[int, tuple[str, list[int]]]:
    """For each month of the raw table: a stamp of the files that its outputs are made from, and the folders in which their readings lie.

    A month is made from all readings of its dates and of the seven days before, whatever file or folder they came in.
    """
    rows = ledger(spark, raw_path).where("date_ym is not null").select("file", "stamp", "source_ym", "date_ym", "last_day").collect()
    out = {}
    for m in sorted({r["source_ym"] for r in rows}):
        before, _, _, start = readings.month_window(m)
        used = [r for r in rows if r["date_ym"] == m or (r["date_ym"] == before and r["last_day"] >= start)]
        parts = sorted({(r["file"], r["stamp"]) for r in used})
        text = "|".join([version, *(f"{f}:{s}" for f, s in parts)])
        out[m] = hashlib.sha256(text.encode()).hexdigest(), sorted({r["source_ym"] for r in used})
    return out


def run_pipeline(spark: SparkSession, raw_path: str, master_rows: DataFrame, out_path: str, version: str = LOGIC_VERSION) -> list[int]:
    """Brings up to date all months whose inputs have changed since they were published under this version; the months done.

    The ledger of the raw table tells which files a month is made from, so a late or changed file, or a reading filed under another
    month, makes just the months anew that it touches. They are read with the seven days before, which rolling thresholds look back to, in one
    job each output. Scaled readings serve all five outputs, so they are kept while those are written.
    """
    inputs = month_inputs(spark, raw_path, version)
    held = Published(spark, out_path).stamps(OUTPUTS[0])
    months = [m for m, (stamp, _) in inputs.items() if held.get(m) != stamp]
    if not months:
        return []
    folders = sorted({f for m in months for f in inputs[m][1]})
    dates = None
    for m in months:
        _, _, last, start = readings.month_window(m)
        needed = F.col("OCCUR_D_RAW").between(F.lit(start), F.lit(last))
        dates = needed if dates is None else dates | needed
    scaled = prepared(spark.read.parquet(raw_path).where(F.col("SOURCE_YM").isin(folders) & dates), master_rows).persist()
    try:
        export_months(outputs(scaled), out_path, {m: inputs[m][0] for m in months})
    finally:
        scaled.unpersist()
    return months


DETAIL_ORDER = ("SOURCE_YM", "DT_CODE_NEW", "MTR_NO", "OCCUR_D_RAW", "TIME_SLOT")


def raw_detail(raw: DataFrame, master_rows: DataFrame, fl: str) -> DataFrame:
    """Readings of one location, each meter under one DT: the first where the master has several."""
    one = master_rows.groupBy("MTR_NO").agg(F.min(F.struct("DT_CODE_NEW", "SDO_CD")).alias("p")).select("MTR_NO", F.col("p.DT_CODE_NEW").alias("DT_CODE_NEW"), F.col("p.SDO_CD").alias("SDO_CD"))
    return raw.join(one.where(F.col("SDO_CD") == fl), "MTR_NO")


def raw_detail_export(raw: DataFrame, master_rows: DataFrame, fl: str) -> DataFrame:
    """raw_detail in the order of month, DT, meter, date and slot."""
    return raw_detail(raw, master_rows, fl).orderBy(*DETAIL_ORDER)


def export_detail(raw: DataFrame, master_rows: DataFrame, fl: str, path: str) -> None:
    """Writes raw_detail as CSV files with headers, a folder per month.

    Tasks write ranges of the order, so a month is as many files as its readings need; each is sorted, and read in the order of their
    names they are sorted as a whole.
    """
    ranged = raw_detail(raw, master_rows, fl).repartitionByRange(*DETAIL_ORDER).sortWithinPartitions(*DETAIL_ORDER)
    ranged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("header", True).partitionBy("SOURCE_YM").csv(path)
