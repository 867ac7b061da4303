"""Raw readings from CSV files whose headers may differ."""

from __future__ import annotations

import logging
import re
from csv import reader as csv_rows

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltweave.constants import ENERGY, PARAMETERS
from voltweave.functions.columns import month_of, normalize_meter_id


def files_under(spark: SparkSession, path: str, pattern: str = "*.csv") -> list[str]:
    """Paths of the files, found by Spark's reader; none for a folder without any."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select("path")
    return sorted(r["path"] for r in listed.collect())


def file_stamps(spark: SparkSession, path: str, pattern: str = "*.csv") -> dict[str, str]:
    """File: when it was changed and how long it is; the contents aren't read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select("path", F.unix_micros("modificationTime").alias("t"), "length")
    return {r["path"]: f"{r['t']}:{r['length']}" for r in listed.collect()}


def path_of(metadata_path: Column) -> Column:
    """A file's path as readers take it, from the encoded one in its metadata."""
    return F.url_decode(F.replace(metadata_path, F.lit("+"), F.lit("%2B")))


def headers_of(spark: SparkSession, files: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Header: the files that have it, found in one job over the first lines of all files, which are read as text by blocks."""
    if not files:
        return {}
    lines = spark.read.text(files).where("_metadata.file_block_start = 0").select(path_of(F.col("_metadata.file_path")).alias("file"), F.monotonically_increasing_id().alias("at"), "value")
    firsts = lines.groupBy("file").agg(F.min_by("value", "at").alias("line")).groupBy("line").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    out: dict[tuple[str, ...], list[str]] = {}
    for r in firsts:
        head = next(csv_rows([r["line"].lstrip("\ufeff")]))
        out.setdefault(tuple(head), []).extend(r["files"])
    return dict(sorted(out.items(), key=lambda x: min(x[1])))


#: Names under which files give the meter.
METER_NAMES = ("MTR_NO", "METER_NO", "MTR NO", "METER NO", "DT_METER_NO", "DT METER NO")


def plain(name: str) -> str:
    """A column's name without blanks and underscores, in upper case: files differ in these."""
    return re.sub(r"[\s_]", "", name).upper()


def named(header: tuple[str, ...], names: tuple[str, ...]) -> str | None:
    """The column of a header that has the first of these names it holds: as it is, else whatever its case, blanks and underscores."""
    by_name = {plain(c): c for c in reversed(header)}
    return next((n if n in header else by_name[plain(n)] for n in names if plain(n) in by_name), None)


def read_csv_by_name(spark: SparkSession, files: list[str], columns: list[str] | None = None, aliases: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """CSV files as strings, put together by column name; SOURCE_FILE is the file's path.

    Spark matches a schema to columns by position, so files are read per header, one scan for all files that share it. Malformed rows
    are dropped. columns: only these, whatever their case, blanks and underscores, null where a file lacks them; none: all that any file has. aliases: other names of some of the columns, by
    preference; files that have none of a column's names are left out, with a warning. All headers are found in one job.
    """
    out = None
    for header, same in headers_of(spark, files).items():
        source = {c: named(header, names) for c, names in (aliases or {}).items()}
        if lacking := [c for c, found in source.items() if found is None]:
            logging.getLogger(__name__).warning("%d files without %s are left out: %s", len(same), ", ".join(lacking), same[0])
            continue
        source = {c: c for c in header} | {c: found for c in columns or () if (found := named(header, (c,)))} | source
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
        part = spark.read.schema(schema).option("header", True).option("mode", "DROPMALFORMED").csv(same)
        names = columns if columns is not None else list(header)
        # DROPMALFORMED counts columns only where all are read, so a row's width is checked by reading them all.
        part = part.select("*", path_of(F.col("_metadata.file_path")).alias("SOURCE_FILE"))
        part = part.select(*[F.col(f"`{source[c]}`").alias(c) if c in source else F.lit(None).cast("string").alias(c) for c in names], "SOURCE_FILE")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        out = spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in (*(columns or ()), "SOURCE_FILE")]))
    return out


def month_of_file(name: str = "SOURCE_FILE") -> F.Column:
    """yyyymm from the name of a file, whatever folder it lies in; null without one."""
    return F.expr(rf"try_cast(nullif(regexp_extract(substring_index({name}, '/', -1), '(20[0-9]{{4}})', 1), '') as int)")


def raw_readings(spark: SparkSession, files: list[str]) -> DataFrame:
    """Typed readings: MTR_NO, OCCUR_D_RAW, TIME_SLOT 'HH:mm', 13 parameters, SOURCE_FILE, SOURCE_YM.

    Values that can't be read, and NaN, are null. SOURCE_YM is the month in the file's name or, where that has none, of the reading's date.
    """
    values = {p: "KWH_ABS" if p == ENERGY else p for p in PARAMETERS}
    raw = read_csv_by_name(spark, files, ["MTR_NO", "OCCUR_D", "OCCUR_T", *values.values()], {"MTR_NO": METER_NAMES})
    number = lambda c: F.nanvl(F.expr(f"try_cast({c} as double)"), F.lit(None).cast("double"))
    return raw.select(
        normalize_meter_id(F.col("MTR_NO")).alias("MTR_NO"), F.expr("try_cast(OCCUR_D as date)").alias("OCCUR_D_RAW"), F.substring("OCCUR_T", 1, 5).alias("TIME_SLOT"),
        *[number(source).alias(p) for p, source in values.items()], "SOURCE_FILE", F.coalesce(month_of_file(), month_of(F.expr("try_cast(OCCUR_D as date)"))).alias("SOURCE_YM"),
    )
