"""The time-aware master, the meters' replacement chains and the hierarchy of locations, transformers and meters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltweave.functions.columns import normalize_meter_id

#: Columns of the master and their types; those a source lacks are null.
MASTER = {"MTR_NO": "string", "MONTH": "int", "DT_CODE_NEW": "string", "SDO_CD": "string", "CT_RATIO": "double", "KVA_RATING": "double", "DT_STS": "string", "DT_CAT": "string", "CONSUMER_COUNT": "double"}


def master_timeaware(rows: DataFrame) -> DataFrame:
    """Distinct master rows with a meter and a month, typed; numbers that can't be read are null, meter ids are normalised."""
    have = {c.upper(): c for c in rows.columns}
    meter = next(c for c in ("MTR_NO", "DT_METER_NO", "METER_NO") if c in have)
    cols = []
    for name, kind in MASTER.items():
        source = have.get(meter if name == "MTR_NO" else name) or (have.get("DT_STS") if name == "DT_CAT" else None)
        if name == "MTR_NO":
            cols.append(normalize_meter_id(F.col(f"`{source}`")).alias(name))
        else:
            cols.append((F.expr(f"try_cast(`{source}` as {kind})") if source else F.lit(None).cast(kind)).alias(name))
    return rows.select(*cols).where("MTR_NO is not null and MONTH is not null").distinct()


def earliest_master(master: DataFrame) -> DataFrame:
    """Each meter's row of its first month; ties go to the smaller DT code."""
    cols = [c for c in ("DT_CODE_NEW", "SDO_CD", "CT_RATIO", "DT_CAT") if c in master.columns]
    first = Window.partitionBy("MTR_NO").orderBy("MONTH", *[F.asc_nulls_last(c) for c in cols])
    return master.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").select("MTR_NO", *cols)


def meter_sequence(master: DataFrame) -> DataFrame:
    """Meters of a DT in the order of their first month, then id; is_meter_replaced: the DT has had more than one."""
    first = master.groupBy("DT_CODE_NEW", "MTR_NO").agg(F.min("MONTH").alias("first_month"))
    order, whole = Window.partitionBy("DT_CODE_NEW").orderBy("first_month", "MTR_NO"), Window.partitionBy("DT_CODE_NEW")
    seq = first.withColumn("meter_seq", F.row_number().over(order))
    return seq.select("DT_CODE_NEW", "MTR_NO", "meter_seq", F.concat(F.lit("meter_"), F.col("meter_seq").cast("string")).alias("dt_meter_rank"), (F.count("*").over(whole) > 1).alias("is_meter_replaced"))


def replacement_stats(sequence: DataFrame) -> DataFrame:
    return sequence.agg(F.count_distinct(F.when(F.col("is_meter_replaced"), F.col("DT_CODE_NEW"))).alias("replaced_dts"), F.count_distinct("DT_CODE_NEW").alias("all_dts"))


def category_distribution(master: DataFrame) -> DataFrame:
    """Distinct meters per category, most first."""
    return master.groupBy("DT_CAT").agg(F.count_distinct("MTR_NO").alias("meters")).orderBy(F.desc("meters"), F.asc_nulls_last("DT_CAT"))


def hierarchy(master: DataFrame, sequence: DataFrame) -> DataFrame:
    """One row per meter and DT (of its lowest month) with location, rating, ratio, category, place in the DT and replacement flag."""
    cols = [c for c in ("SDO_CD", "KVA_RATING", "CT_RATIO", "DT_CAT", "DT_STS") if c in master.columns]
    first = Window.partitionBy("MTR_NO", "DT_CODE_NEW").orderBy("MONTH", *[F.asc_nulls_last(c) for c in cols])
    rows = master.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").select("MTR_NO", "DT_CODE_NEW", *cols)
    rows = rows.join(sequence.select("MTR_NO", "DT_CODE_NEW", "meter_seq"), ["MTR_NO", "DT_CODE_NEW"], "left").withColumn("meter_seq", F.coalesce("meter_seq", F.lit(1)))
    in_dt = Window.partitionBy("DT_CODE_NEW")
    rows = rows.withColumn("dt_meter_rank", F.row_number().over(in_dt.orderBy("meter_seq", "MTR_NO")))
    return rows.withColumn("is_meter_replaced", F.count("*").over(in_dt) > 1)  # meters are unique within a DT here


def fleet_summary(h: DataFrame) -> DataFrame:
    return h.agg(F.count_distinct("SDO_CD").alias("n_fl"), F.count_distinct("DT_CODE_NEW").alias("n_dt"), F.count_distinct("MTR_NO").alias("n_meters"), F.count_distinct(F.when(F.col("is_meter_replaced"), F.col("DT_CODE_NEW"))).alias("n_replaced"))


def dt_summary(h: DataFrame, fl: str = "All", page: int | None = None, per_page: int = 50) -> DataFrame:
    """Per location and DT: meters, rating, category and status of the first meter that has one, and whether a meter was replaced."""
    h = h if fl == "All" else h.where(F.col("SDO_CD") == fl)
    of_first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.struct("meter_seq", "MTR_NO"))).alias(c)
    cols = [c for c in ("KVA_RATING", "DT_CAT", "DT_STS") if c in h.columns]
    out = h.where("SDO_CD is not null and DT_CODE_NEW is not null").groupBy("SDO_CD", "DT_CODE_NEW").agg(F.count_distinct("MTR_NO").alias("N_METERS"), *[of_first(c) for c in cols], F.max("is_meter_replaced").alias("is_meter_replaced"))
    out = out.orderBy("SDO_CD", "DT_CODE_NEW")
    return out if page is None else out.offset((page - 1) * per_page).limit(per_page)


def meters_of_dt(h: DataFrame, dt_code: str) -> DataFrame:
    return h.where(F.col("DT_CODE_NEW") == dt_code).orderBy("meter_seq", "MTR_NO")


def ambiguous_meters(master: DataFrame) -> DataFrame:
    """Meters with more than one (DT, location), with their number and the one that counts: the first in order."""
    places = master.select("MTR_NO", "DT_CODE_NEW", "SDO_CD").distinct()
    n = places.groupBy("MTR_NO").agg(F.count("*").alias("n_places"), F.min(F.struct("DT_CODE_NEW", "SDO_CD")).alias("kept"))
    return n.where("n_places > 1").select("MTR_NO", "n_places", F.col("kept.DT_CODE_NEW").alias("DT_CODE_NEW"), F.col("kept.SDO_CD").alias("SDO_CD"))
