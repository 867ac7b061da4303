"""Late and changed files, outputs that are shown all at once, caches by month, headers in one job."""

import datetime as dt

import pytest

from voltweave.plans import pipeline
from voltweave.sources import csv, store
from voltweave.sources.store import Published
from tests.test_sources import HEAD, MASTER, line


def file(folder, name, *rows, head=HEAD):
    (folder / "csv").mkdir(exist_ok=True)
    (folder / "csv" / name).write_text("\n".join([",".join(head), *(line(head, **r) for r in rows)]))


def day(text, slot="00:30:00", **values):
    return {"OCCUR_D": text, "OCCUR_T": slot} | values


@pytest.fixture
def site(spark, tmp_path):
    """A folder of three months, ingested and run; step() brings everything up to date and gives the months done."""
    master = spark.createDataFrame([("7", 202401, "D1", "F1", 2.0, 100.0, None, None, None)], MASTER)
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    for m in (1, 2, 3):
        file(tmp_path, f"load_20240{m}.csv", day(f"2024-0{m}-05"), day(f"2024-0{m}-06"))

    def step():
        return pipeline.ingest_raw(spark, str(tmp_path / "csv"), raw), pipeline.run_pipeline(spark, raw, master, out)

    def clean(month):
        return sorted((str(r["DATE"]), r["TIME_SLOT"]) for r in pipeline.read_output(spark, out, "clean_data", [month]).collect())

    assert step() == ([202401, 202402, 202403], [202401, 202402, 202403]) and step() == ([], [])
    return tmp_path, step, clean, out


def test_a_late_file_reaches_the_outputs_of_its_month_alone(site):
    folder, step, clean, _ = site
    file(folder, "late_202402.csv", day("2024-02-07"))
    assert step() == ([202402], [202402])
    assert clean(202402) == [("2024-02-05", "00:30"), ("2024-02-06", "00:30"), ("2024-02-07", "00:30")] and len(clean(202401)) == 2
    file(folder, "late_202402.csv", day("2024-02-07"), day("2024-02-27"))  # now also in the days that March looks back to
    assert step() == ([202402], [202402, 202403]) and len(clean(202402)) == 4 and step() == ([], [])


def test_a_reading_filed_under_the_next_month_is_not_lost(site):
    folder, step, clean, _ = site
    file(folder, "more_202403.csv", day("2024-01-31", "05:00:00"))
    ingested, done = step()
    assert ingested == [202403] and done == [202401, 202402] and ("2024-01-31", "05:00") in clean(202401)


def test_files_without_a_month_go_by_date(site, caplog):
    folder, step, clean, _ = site
    file(folder, "loose.csv", day("2024-01-09"), day("2024-03-09"), day("no date"))
    assert step() == ([202401, 202403], [202401, 202403]) and "loose.csv" in caplog.text
    assert ("2024-01-09", "00:30") in clean(202401) and ("2024-03-09", "00:30") in clean(202403) and step() == ([], [])


def test_changed_and_removed_files(site):
    folder, step, clean, _ = site
    file(folder, "load_202401.csv", day("2024-01-05"), day("2024-01-08"), day("2024-01-09", "10:00:00"))
    assert step() == ([202401], [202401]) and len(clean(202401)) == 3
    file(folder, "late_202401.csv", day("2024-01-20"))
    assert step() == ([202401], [202401]) and len(clean(202401)) == 4
    (folder / "csv/late_202401.csv").unlink()
    assert step() == ([202401], [202401]) and len(clean(202401)) == 3


def test_a_failure_between_two_outputs_shows_none(spark, site, monkeypatch):
    folder, step, clean, out = site
    file(folder, "late_202402.csv", day("2024-02-07", VR="0", VY="0", VB="0"))
    before = {name: sorted(map(str, pipeline.read_output(spark, out, name).collect())) for name in pipeline.OUTPUTS}
    whole = pipeline.outputs

    def broken(scaled):
        found = whole(scaled)
        found["threshold_anomalies"] = found["threshold_anomalies"].selectExpr("*", "raise_error('killed') as x")
        found["threshold_anomalies"] = found["threshold_anomalies"].unionByName(scaled.selectExpr("DATE as x").selectExpr("raise_error(cast(x as string)) as x", "202402 as YM"), allowMissingColumns=True)
        return found

    monkeypatch.setattr(pipeline, "outputs", broken)
    with pytest.raises(Exception, match="2024"):
        step()
    after = {name: sorted(map(str, pipeline.read_output(spark, out, name).collect())) for name in pipeline.OUTPUTS}
    assert after == before and len(clean(202402)) == 2
    monkeypatch.setattr(pipeline, "outputs", whole)
    assert step() == ([], [202402]) and len(clean(202402)) == 3
    assert "ZERO_VOLTAGE" in {r["ANOMALY_TYPE"] for r in pipeline.read_output(spark, out, "hard_anomalies", [202402]).collect()}
    assert Published(spark, out).vacuum(list(pipeline.OUTPUTS)) > 0 and len(clean(202402)) == 3 and len(clean(202401)) == 2


def test_a_cache_builds_changed_months_only(spark, tmp_path):
    rows = spark.createDataFrame([(m, d, float(d)) for m in (202401, 202402, 202403) for d in range(5)], "YM int, d int, v double")
    asked = []

    def cached(rows):
        def build(months):
            asked.append(months)
            return rows.where(rows["YM"].isin(months)).groupBy("YM").max("v").toDF("YM", "PEAK")

        return {r["YM"]: r["PEAK"] for r in store.cache_by_month(spark, str(tmp_path / "peaks"), store.month_stamps(rows, rows["YM"]), build).collect()}

    assert cached(rows) == {202401: 4, 202402: 4, 202403: 4} and cached(rows.repartition(3)) == {202401: 4, 202402: 4, 202403: 4}
    changed = rows.union(spark.createDataFrame([(202402, 9, 9.0), (202404, 1, 1.0)], rows.schema))
    assert cached(changed) == {202401: 4, 202402: 9, 202403: 4, 202404: 1}
    assert cached(rows.where("YM > 202401")) == {202402: 4, 202403: 4}
    assert asked == [[202401, 202402, 202403], [202402, 202404], [202402]]


def test_nothing_published(spark, tmp_path):
    with pytest.raises(ValueError, match="nothing is published"):
        Published(spark, str(tmp_path)).read("clean_data")


def test_headers_of_many_files_in_one_job(spark, tmp_path):
    for i in range(200):
        head = HEAD if i % 2 else [h.replace("_", " ").lower() for h in reversed(HEAD)]
        file(tmp_path, f"a b+{i}_202401.csv", day("2024-01-05", MTR_NO=str(i), VR=str(200 + i % 9), **({} if i % 2 else {"mtr no": str(i), "occur d": "2024-01-05", "occur t": "00:30:00", "vr": "201", "kw r": "3"})), head=head)
    files = csv.files_under(spark, str(tmp_path / "csv"))
    tracker, group = spark.sparkContext.statusTracker(), f"headers-{dt.datetime.now().timestamp()}"
    spark.sparkContext.setJobGroup(group, "headers")
    try:
        grouped = csv.headers_of(spark, files)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(map(len, grouped.values())) == [100, 100] and len(tracker.getJobIdsForGroup(group)) <= 5  # one query, however many files
    rows = csv.raw_readings(spark, files).collect()
    assert len(rows) == 200 and {r["MTR_NO"] for r in rows} == {str(i) for i in range(200)}
    assert {r["KW_R"] for r in rows} == {1.0, 3.0} and {r["SOURCE_YM"] for r in rows} == {202401}
    assert csv.named(("KW R", "KW_R"), ("KW_R",)) == "KW_R"
