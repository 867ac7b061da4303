"""Excel masters from their XML, the sorted detail export, calendar days, counts observed while a query runs."""

import datetime as dt
import zipfile

from pyspark.sql import functions as F

from voltweave.operators import checks, coverage
from voltweave.plans import pipeline
from voltweave.sources import master

SHEET = '<?xml version="1.0"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{}</sheetData></worksheet>'


def cell(at, value, shared):
    if isinstance(value, str):
        if value not in shared:
            shared.append(value)
        return f'<c r="{at}" t="s"><v>{shared.index(value)}</v></c>'
    return f'<c r="{at}"><v>{value}</v></c>'


def workbook(path, sheets, inline=False):
    """sheets: name to rows of cells, None for an empty cell."""
    shared, names = [], list(sheets)
    with zipfile.ZipFile(path, "w") as z:
        for n, rows in enumerate(sheets.values(), 1):
            made = []
            for r, row in enumerate(rows, 1):
                cells = [f'<c r="{chr(65 + i)}{r}" t="inlineStr"><is><t>{v}</t></is></c>' if inline and isinstance(v, str) else cell(f"{chr(65 + i)}{r}", v, shared) for i, v in enumerate(row) if v is not None]
                made.append(f'<row r="{r}">{"".join(cells)}</row>')
            z.writestr(f"xl/worksheets/sheet{n}.xml", SHEET.format("".join(made)))
        z.writestr("xl/workbook.xml", '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>' + "".join(f'<sheet name="{name}" sheetId="{n}" r:id="rId{n}"/>' for n, name in enumerate(names, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="rId{n}" Type="sheet" Target="worksheets/sheet{n}.xml"/>' for n in range(1, len(names) + 1)) + "</Relationships>")
        if shared:
            z.writestr("xl/sharedStrings.xml", '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">' + "".join(f"<si><t>{s[:1]}</t><t>{s[1:]}</t></si>" for s in shared) + "</sst>")


def test_workbooks_of_several_sheets(spark, tmp_path):
    head = ["DT METER NO", "Month", "DT_CODE NEW", "sdo cd", "ct ratio", "note"]
    workbook(tmp_path / "master 2024.xlsx", {"jan": [head, ["9.0", 202401, "D1", "F1", 2, "x"], [None, 202401, "D2", "F1", 1, None]], "legend": [["a", "b"], ["c", "d"]], "feb": [["MONTH", "MTR_NO", "DT_CODE_NEW"], [202402, "9", "D3"], [], [202402, 12.0, "D3"]]})
    workbook(tmp_path / "old 2023.xlsx", {"all": [head, ["7", 202312, "D9", "F2", 1.5]]}, inline=True)
    for name in ("~$master 2024.xlsx", "readme.xlsx"):
        (tmp_path / name).write_bytes(b"not a workbook")
    rows = sorted((r["MTR_NO"], r["MONTH"], r["DT_CODE_NEW"], r["SDO_CD"], r["CT_RATIO"]) for r in master.read_master_excel(spark, str(tmp_path)).collect())
    assert rows == [("12", 202402, "D3", None, None), ("7", 202312, "D9", "F2", 1.5), ("9", 202401, "D1", "F1", 2.0), ("9", 202402, "D3", None, None)]
    assert master.workbook_records(spark, str(tmp_path)).select("file", "sheet").distinct().count() == 3


def test_a_folder_without_workbooks(spark, tmp_path):
    assert master.read_master_excel(spark, str(tmp_path)).columns and master.read_master_excel(spark, str(tmp_path)).count() == 0


def test_detail_export_is_sorted_across_files(spark, tmp_path):
    raw = spark.range(3000).selectExpr("concat('M', cast(id * 7 % 40 as string)) as MTR_NO", "date_add(date'2024-01-01', cast(id * 13 % 60 as int)) as OCCUR_D_RAW", "cast(id % 48 as string) as TIME_SLOT", "cast(id as double) as VR").withColumn("SOURCE_YM", F.expr("year(OCCUR_D_RAW) * 100 + month(OCCUR_D_RAW)"))
    m = spark.range(40).selectExpr("concat('M', cast(id as string)) as MTR_NO", "concat('D', cast(id % 7 as string)) as DT_CODE_NEW", "case when id % 5 = 0 then 'F2' else 'F1' end as SDO_CD")
    pipeline.export_detail(raw.repartition(6), m, "F1", str(tmp_path / "out"))
    wanted = [tuple(map(str, r)) for r in pipeline.raw_detail_export(raw, m, "F1").select(*pipeline.DETAIL_ORDER).collect()]
    found = []
    for month in (202401, 202402):
        files = sorted((tmp_path / "out" / f"SOURCE_YM={month}").glob("*.csv"))
        for f in files:
            head, *lines = f.read_text().splitlines()
            at = [head.split(",").index(c) for c in pipeline.DETAIL_ORDER[1:]]
            found += [(str(month), *[line.split(",")[i] for i in at]) for line in lines]
    assert found == wanted and len(found) == 2400


def test_days_without_a_reading_and_their_runs(spark):
    day = lambda n: dt.date(2024, 1, n)
    counts = spark.createDataFrame([("A", "D", day(1), 4), ("A", "D", day(2), 4), ("A", "D", day(5), 3), ("A", "D", day(7), 4), ("B", None, day(3), 2), ("B", None, day(5), 2)], "MTR_NO string, DT_CODE_NEW string, DATE date, slots_present long")
    calendar = coverage.calendar_counts(counts)
    missing = {(r["MTR_NO"], r["DATE"].day): r["GAP_TYPE"] for r in coverage.missing_slot_days(calendar, coverage.expected_slots(calendar)).collect()}
    assert missing == {("A", 3): "FULL_DAY_OFFLINE", ("A", 4): "FULL_DAY_OFFLINE", ("A", 5): "PARTIAL_3_OF_4", ("A", 6): "FULL_DAY_OFFLINE", ("B", 4): "FULL_DAY_OFFLINE"}
    runs = sorted((r["MTR_NO"], r["first_day"].day, r["last_day"].day, r["n_days"]) for r in coverage.offline_runs(calendar).collect())
    assert runs == [("A", 3, 4, 2), ("A", 6, 6, 1), ("B", 4, 4, 1)] and coverage.calendar_counts(counts.limit(0)).count() == 0


def test_stages_are_counted_in_one_run(spark):
    rows = spark.range(100)
    group = "observed"
    spark.sparkContext.setJobGroup(group, group)
    try:
        found = checks.observed_counts(rows, {"all": lambda df: df, "even": lambda df: df.where("id % 2 = 0"), "large": lambda df: df}, {"large": F.col("id") > 50})
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {r["stage"]: r["n_rows"] for r in found.collect()} == {"all": 100, "even": 50, "large": 24}
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == 1
