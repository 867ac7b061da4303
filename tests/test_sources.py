"""CSV ingestion, the batch pipeline, caches and streams on files."""

import datetime as dt

import pytest

from voltweave.operators import rules
from voltweave.plans import pipeline
from voltweave.sources import csv, master, store
from voltweave.streaming import rules as stream_rules

HEAD = ["MTR_NO", "OCCUR_D", "OCCUR_T", "VR", "VY", "VB", "IR", "IY", "IB", "KW_R", "KW_Y", "KW_B", "KVAR_R", "KVAR_Y", "KVAR_B", "KWH_ABS"]


def line(head, **values):
    row = {"MTR_NO": "7.0", "OCCUR_D": "2024-01-05", "OCCUR_T": "00:30:00"} | dict.fromkeys(HEAD[3:], "1") | values
    return ",".join(row.get(h, "") for h in head)


@pytest.fixture
def folder(tmp_path):
    other = [h for h in reversed(HEAD) if h != "IB"]
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv/load_202401.csv").write_text("\n".join([",".join(HEAD), line(HEAD, VR="240", IR="nan"), line(HEAD, OCCUR_T="01:00:00", VR="abc")]))
    (tmp_path / "csv/load_202402.csv").write_text("\n".join([",".join(other), line(other, OCCUR_D="2024-02-01", VR="0", VY="0", VB="0"), "broken,row"]))
    return tmp_path


def test_union_by_name(spark, folder):
    rows = csv.raw_readings(spark, csv.files_under(spark, str(folder / "csv"))).collect()
    by = {(r["OCCUR_D_RAW"], r["TIME_SLOT"]): r for r in rows if r["OCCUR_D_RAW"]}
    first, second, third = by[(dt.date(2024, 1, 5), "00:30")], by[(dt.date(2024, 1, 5), "01:00")], by[(dt.date(2024, 2, 1), "00:30")]
    assert (first["MTR_NO"], first["VR"], first["IR"], first["SOURCE_YM"]) == ("7", 240.0, None, 202401)
    assert second["VR"] is None and third["IB"] is None and third["VR"] == 0.0 and third["SOURCE_YM"] == 202402


def test_meters_under_other_names(spark, tmp_path):
    for name, head in (("a_202401", "METER NO"), ("b_202401", " mtr_no "), ("c_202401", "SERIAL"), ("d_202401", "DT_METER_NO,METER_NO")):
        (tmp_path / f"{name}.csv").write_text(f"{head},OCCUR_D,OCCUR_T,VR\n{name[0]}{',other' if ',' in head else ''},2024-01-05,00:30:00,230\n")
    rows = csv.raw_readings(spark, csv.files_under(spark, str(tmp_path))).collect()
    assert sorted((r["MTR_NO"].lower(), r["VR"]) for r in rows) == [("a", 230.0), ("b", 230.0), ("other", 230.0)]
    assert csv.named(("x", "METER_NO", "MTR_NO"), csv.METER_NAMES) == "MTR_NO" and csv.named(("x",), csv.METER_NAMES) is None


MASTER = "MTR_NO string, MONTH int, DT_CODE_NEW string, SDO_CD string, CT_RATIO double, KVA_RATING double, DT_STS string, DT_CAT string, CONSUMER_COUNT double"


def test_pipeline_runs_once_and_takes_new_months(spark, folder):
    raw, out = str(folder / "raw"), str(folder / "out")
    m = spark.createDataFrame([("7", 202401, "D1", "F1", 2.0, 100.0, None, None, None)], MASTER)
    assert pipeline.ingest_raw(spark, str(folder / "csv"), raw) == [202401, 202402]
    assert pipeline.ingest_raw(spark, str(folder / "csv"), raw) == []
    assert pipeline.run_pipeline(spark, raw, m, out) == [202401, 202402]
    assert pipeline.run_pipeline(spark, raw, m, out) == []
    hard = store.read_months(spark, f"{out}/hard_anomalies", [202402])
    assert "ZERO_VOLTAGE" in {r["ANOMALY_TYPE"] for r in hard.collect()}
    assert "YM" in hard._jdf.queryExecution().executedPlan().toString().split("PartitionFilters:")[1][:60]
    clean = store.read_months(spark, f"{out}/clean_data")
    assert clean.count() == 3 and clean.where("YM = 202401 and IY = 2.0").count() == 2
    (folder / "csv/late_202401.csv").write_text("\n".join([",".join(HEAD), line(HEAD, OCCUR_T="02:00:00")]))
    assert pipeline.ingest_raw(spark, str(folder / "csv"), raw) == [202401]
    assert spark.read.parquet(raw).where("SOURCE_YM = 202401").count() == 3
    detail = pipeline.raw_detail_export(spark.read.parquet(raw), m, "F1")
    assert detail.count() == 4
    store.write_csv(detail, str(folder / "report"))
    assert spark.read.option("header", True).csv(str(folder / "report")).count() == 4


def test_master_workbooks(spark, tmp_path):
    (tmp_path / "master 2024.csv").write_text("dt meter no,Month,DT_CODE NEW,sdo_cd,ct ratio\n9.0,202401,D1,F1,x\n9.0,202401,D1,F1,x\n,202401,D1,F1,1\n")
    (tmp_path / "~$master 2024.csv").write_text("a\n1\n")
    (tmp_path / "other 2024.csv").write_text("a,b\n1,2\n")
    rows = master.read_master_csv(spark, str(tmp_path)).collect()
    assert [(r["MTR_NO"], r["MONTH"], r["DT_CODE_NEW"], r["CT_RATIO"]) for r in rows] == [("9", 202401, "D1", None)]


def test_cache_is_built_once_per_signature(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(len(calls))

    path = str(tmp_path / "cache")
    counts = [store.cache_table(spark, path, s, build).count() for s in ("1:a", "1:a", "1:b", "1:b", "1:a")]
    assert counts == [1, 1, 2, 2, 3] and store.months_signature([202402, 202401]) == "1:202401,202402"


def test_empty_table_has_its_schema(spark, tmp_path):
    assert store.read_or_empty(spark, str(tmp_path / "nothing"), "a int, b string").columns == ["a", "b"]


def test_stream_equals_batch(spark, tmp_path):
    from tests.test_operators import table

    df = table(spark, {"VR": 300.0}, {"VR": 300.0}, {"TIME_SLOT": 2, "IR": 6000.0}).selectExpr("*", "cast(DATE as timestamp) as READ_AT")
    df.write.parquet(str(tmp_path / "in"))
    stream = stream_rules.anomaly_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    for _ in range(2):
        query = stream_rules.to_table(stream, str(tmp_path / "out"), str(tmp_path / "state"))
        assert query.awaitTermination(120)
    batch = rules.hard_anomalies(rules.hard_flags(df.dropDuplicates(["MTR_NO", "DATE", "TIME_SLOT"])))
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "out")).collect())) == sorted(map(str, batch.collect()))


def test_a_large_month_is_split_over_tasks(spark, tmp_path):
    from voltweave.sources import store

    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        store.write_by_month(spark.range(0, 200_000, 1, 8).selectExpr("id", "uuid() as u", "202401 as YM"), str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "YM=202401").glob("*.parquet"))) > 1
    assert store.read_months(spark, str(tmp_path / "t"), [202401]).count() == 200_000


def test_recomputation_finds_a_changed_cache(spark, tmp_path):
    """Raw, then clean peaks through the cache; a value that no longer holds, and a row that is gone, are told."""
    from voltweave.operators.checks import recomputed
    from voltweave.sources.store import cache_table

    fresh = spark.createDataFrame([("m1", 202401, 5.0), ("m2", 202401, None), ("m3", 202402, 7.5)], "MTR_NO string, YM int, PEAK double")
    raw = cache_table(spark, str(tmp_path / "raw"), "1:202401,202402", lambda: fresh)
    clean = cache_table(spark, str(tmp_path / "clean"), "1:202401,202402", lambda: raw.where("PEAK < 6 or PEAK is null"))
    assert recomputed(raw, fresh, ["MTR_NO", "YM"], "PEAK").first().asDict() == {"n": 3, "n_different": 0}
    assert recomputed(clean, fresh, ["MTR_NO", "YM"], "PEAK").first()["n_different"] == 1
    assert recomputed(raw, fresh.replace(5.0, 5.1, "PEAK"), ["MTR_NO", "YM"], "PEAK").first()["n_different"] == 1
    again = cache_table(spark, str(tmp_path / "raw"), "1:202401,202402", lambda: fresh.limit(0))
    assert again.count() == 3
