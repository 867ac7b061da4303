"""DuckDB SQL for the registered queries, written apart from the operators: plain UNION ALL branches, ASOF joins and self-joins where
the operators use arrays, periods and windows."""

from __future__ import annotations

from voltweave.constants import AMPS, KVAR, KW, PARAMETERS, VOLTS
from voltweave.plans import fixtures
from voltweave.plans.queries import FULL

_KVA = "case when SLOT_MINUTES = 15 then (VR*IR + VY*IY + VB*IB) / 1000.0::double else sqrt(power(KW_R+KW_Y+KW_B, 2) + power(KVAR_R+KVAR_Y+KVAR_B, 2)) end"
_NE = "(DT_CAT is null or DT_CAT not in ('MHVD', 'HVDAF'))"


def _rules() -> list[tuple[str, str, str, str]]:
    out = [("f_zero_v", "VR = 0 and VY = 0 and VB = 0", "ZERO_VOLTAGE", "HIGH")]
    out += [(f"f_ext_v_{c.lower()}", f"{_NE} and {c} > 0 and ({c} < 180 or {c} > 290)", f"EXTREME_VOLTAGE_{c}", "HIGH") for c in VOLTS]
    out += [(f"f_ext_i_{c.lower()}", f"{_NE} and {c} > 5000", f"EXTREME_CURRENT_{c}", "CRITICAL") for c in AMPS]
    out += [("f_missing_kwh", "KWH_TOTAL is null and VR is not null and VR > 0", "MISSING_KWH", "MEDIUM"), ("f_zero_kwh_load", "KWH_TOTAL = 0 and (IR > 0 or IY > 0 or IB > 0)", "ZERO_KWH_WITH_LOAD", "HIGH")]
    out += [(f"f_neg_{c.lower()}", f"{c} < -10", f"NEGATIVE_KVAR_{c}", "LOW") for c in KVAR]
    for phases in (KW, KVAR):
        out += [(f"f_ploss_{c.lower()}", f"abs({c}) <= 0.02 and ({' or '.join(f'abs({o}) > 0.02' for o in phases if o != c)})", f"PHASE_LOSS_{c}", "HIGH") for c in phases]
    return out


_BREACHES = " union all ".join(
    f"select MTR_NO, DT_CODE_NEW, DATE, TIME_SLOT, '{p}' as PARAMETER, {p} as VALUE, {p}_HI as THRESH_HI, {p}_LO as THRESH_LO, case when {p} > {p}_HI * 1.05::double then 'HIGH' else 'LOW' end as DIRECTION from rolling"
    f" where {p}_HI is not null and ({p} > {p}_HI * 1.05::double or ({p}_LO > 0 and {p} < {p}_LO * 0.95::double))"
    for p in PARAMETERS
)
_HARD = " union all ".join(f"select MTR_NO, DT_CODE_NEW, DT_CAT, DATE, TIME_SLOT, '{name}' as ANOMALY_TYPE, '{severity}' as SEVERITY from flags where {flag}" for flag, _, name, severity in _rules())
_CLEANED = ", ".join([f"case when f_zero_v then null when f_ext_v_{c.lower()} then null else {c} end as {c}" for c in VOLTS] + [f"case when f_ext_i_{c.lower()} then null else {c} end as {c}" for c in AMPS] + [f"case when f_neg_{c.lower()} then null else {c} end as {c}" for c in KVAR])
_BANDS = "case when loading < 0.8 then '70-80%' when loading < 0.9 then '80-90%' when loading < 1.0 then '90-100%' when loading < 1.1 then '100-110%' when loading < 1.2 then '110-120%' else '>120%' end"
_GAP = "expected_slots_per_day - slots_present as missing_slot_count, case when slots_present = 0 then 'FULL_DAY_OFFLINE' else concat('PARTIAL_', slots_present, '_OF_', expected_slots_per_day) end as GAP_TYPE"


def _mode(source: str, key: str) -> str:
    return f"select {key}, slots_present as expected_slots_per_day from (select {key}, slots_present, row_number() over (partition by {key} order by count(*) desc, slots_present) as rk from {source} group by {key}, slots_present) where rk = 1"


#: Tables that the queries start from, each after those it reads.
_WITH = {
    "readings": fixtures.READINGS,
    "dedup": "select * exclude (rk) from (select r.*, row_number() over (partition by MTR_NO, DATE, TIME_SLOT order by (case when VR is null then 1 else 0 end + case when IR is null then 1 else 0 end + case when KWH_TOTAL is null then 1 else 0 end), event_id) as rk from readings r) where rk = 1",
    "flags": f"select *, {', '.join(f'({c}) as {f}' for f, c, _, _ in _rules())} from dedup",
    "hard": _HARD,
    "clean": f"select MTR_NO, DT_CODE_NEW, meter_seq, DATE, TIME_SLOT, DT_CAT, {_CLEANED}, KW_R, KW_Y, KW_B, KWH_TOTAL, f_zero_v as was_zero_voltage from flags",
    "rolling": f"select *, {', '.join(f'max({p}) over w as {p}_HI, min({p}) over w as {p}_LO' for p in PARAMETERS)} from dedup window w as (partition by MTR_NO, TIME_SLOT order by DATE rows between 7 preceding and 1 preceding)",
    "threshold": _BREACHES,
    "bad": "select MTR_NO, DATE, TIME_SLOT from hard union select MTR_NO, DATE, TIME_SLOT from threshold",
    "counts": "select MTR_NO, DT_CODE_NEW, DATE, count(*) as slots_present from dedup group by all",
    "minutes": "select MTR_NO, case when avg(slots_present) > 9 then 15 else 30 end::integer as SLOT_MINUTES from counts group by MTR_NO",
    "expected": _mode("counts", "MTR_NO"),
    "stitched": "select * exclude (rk) from (select *, row_number() over (partition by DT_CODE_NEW, DATE, TIME_SLOT order by meter_seq desc, MTR_NO) as rk from dedup) where rk = 1",
    "counts_dt": "select DT_CODE_NEW, DATE, count(*) as slots_present from stitched group by all",
    "expected_dt": _mode("counts_dt", "DT_CODE_NEW"),
    "missing_dt": f"select DT_CODE_NEW, DATE, slots_present, expected_slots_per_day, {_GAP} from counts_dt join expected_dt using (DT_CODE_NEW) where slots_present < expected_slots_per_day",
    "loads": fixtures.LOADS,
    "load_days": "select MTR_NO, DT_CODE_NEW, DATE, count(*) as slots_present from loads group by all",
    "calendar": "select d.*, coalesce(slots_present, 0)::bigint as slots_present from (select MTR_NO, DT_CODE_NEW, unnest(generate_series(a, b, interval 1 day))::date as DATE from (select MTR_NO, DT_CODE_NEW, min(DATE) as a, max(DATE) as b from load_days group by all)) d left join load_days using (MTR_NO, DT_CODE_NEW, DATE)",
    "load_expected": _mode("load_days", "MTR_NO"),
    "places": fixtures.PLACES,
    "master": fixtures.MASTER,
    "earliest": "select MTR_NO, DT_CODE_NEW, SDO_CD, CT_RATIO, DT_CAT from (select *, row_number() over (partition by MTR_NO order by MONTH, DT_CODE_NEW) as rk from master) where rk = 1",
    "seq": "select DT_CODE_NEW, MTR_NO, cast(row_number() over (partition by DT_CODE_NEW order by min(MONTH), MTR_NO) as integer) as meter_seq from master group by DT_CODE_NEW, MTR_NO",
    "sequence": "select DT_CODE_NEW, MTR_NO, meter_seq, concat('meter_', meter_seq) as dt_meter_rank, (select max(meter_seq) from seq o where o.DT_CODE_NEW = s.DT_CODE_NEW) > 1 as is_meter_replaced from seq s",
    "placed": """select a.* exclude (DT_CODE_NEW, SDO_CD, CT_RATIO, DT_CAT), s.meter_seq, s.dt_meter_rank, coalesce(s.is_meter_replaced, false) as is_meter_replaced,
      coalesce(a.DT_CODE_NEW, e.DT_CODE_NEW) as DT_CODE_NEW, coalesce(a.SDO_CD, e.SDO_CD) as SDO_CD, coalesce(a.CT_RATIO, e.CT_RATIO) as CT_RATIO, coalesce(a.DT_CAT, e.DT_CAT) as DT_CAT
      from (select r.* exclude (DT_CODE_NEW, SDO_CD), m.DT_CODE_NEW, m.SDO_CD, m.CT_RATIO, m.DT_CAT from (select *, year(DATE)*100+month(DATE) as ym from loads) r asof left join master m on r.MTR_NO = m.MTR_NO and r.ym >= m.MONTH) a
      left join earliest e on a.MTR_NO = e.MTR_NO left join sequence s on a.MTR_NO = s.MTR_NO and coalesce(a.DT_CODE_NEW, e.DT_CODE_NEW) = s.DT_CODE_NEW""",
    "hierarchy": """select h.* exclude (rk, MONTH, CONSUMER_COUNT), s.meter_seq, cast(row_number() over (partition by h.DT_CODE_NEW order by s.meter_seq, h.MTR_NO) as integer) as dt_meter_rank, count(*) over (partition by h.DT_CODE_NEW) > 1 as is_meter_replaced
      from (select *, row_number() over (partition by MTR_NO, DT_CODE_NEW order by MONTH) as rk from master) h join seq s on h.MTR_NO = s.MTR_NO and h.DT_CODE_NEW = s.DT_CODE_NEW where rk = 1""",
    "summary": "select SDO_CD, DT_CODE_NEW, count(distinct MTR_NO) as N_METERS, arg_min(KVA_RATING, [meter_seq::varchar.lpad(9, '0'), MTR_NO]) as KVA_RATING, arg_min(DT_CAT, [meter_seq::varchar.lpad(9, '0'), MTR_NO]) filter (where DT_CAT is not null) as DT_CAT, bool_or(is_meter_replaced) as is_meter_replaced from hierarchy group by SDO_CD, DT_CODE_NEW",
    "load_kva": f"select *, year(DATE)::integer as YEAR, (year(DATE)*100+month(DATE))::integer as YM, {_KVA} as KVA from (select l.* exclude (DT_CODE_NEW, SDO_CD), p.* exclude (MTR_NO), case when is_15 then 15 else 30 end as SLOT_MINUTES from loads l join places p using (MTR_NO))",
    "daily": "select MTR_NO, DT_CODE_NEW, SDO_CD, DT_CAT, DATE, sum(KVA) as DAILY_KVA_SUM from load_kva group by all",
    "coincidental": """select LEVEL, KEY, (YM // 100)::integer as YEAR, YM, (YM % 100)::integer as MONTH, PEAK from (
      select 'DT' as LEVEL, DT_CODE_NEW as KEY, (year(DATE)*100+month(DATE))::integer as YM, max(DAILY_KVA_SUM) as PEAK from daily group by all
      union all select 'FL', SDO_CD, YM, max(s) from (select SDO_CD, DATE, (year(DATE)*100+month(DATE))::integer as YM, sum(DAILY_KVA_SUM) as s from daily group by all) group by all
      union all select 'CAT', DT_CAT, YM, max(s) from (select DT_CAT, DATE, (year(DATE)*100+month(DATE))::integer as YM, sum(DAILY_KVA_SUM) as s from daily where DT_CAT is not null group by all) group by all)""",
    "monthly": "select MTR_NO, DT_CODE_NEW, YEAR, YM, max(KVA * CT_RATIO) as PEAK_KVA_RAW from load_kva group by all",
    "read_kva": f"select d.MTR_NO, d.DT_CODE_NEW, DATE, TIME_SLOT, (year(DATE)*100+month(DATE))::integer as YM, KW_R, {_KVA} as KVA from dedup d join minutes using (MTR_NO)",
    "clean_kva": f"select c.*, SLOT_MINUTES, (year(DATE)*100+month(DATE))::integer as YM, case when b.MTR_NO is not null then null else {_KVA} end as KVA from (select c.*, SLOT_MINUTES from clean c join minutes using (MTR_NO)) c left join bad b using (MTR_NO, DATE, TIME_SLOT)",
    "clean_peaks": "select r.*, c.PEAK_KVA_CLEAN from (select MTR_NO, DT_CODE_NEW, YM, max(KVA) as PEAK_KVA_RAW from read_kva group by all) r left join (select MTR_NO, YM, max(KVA) as PEAK_KVA_CLEAN from clean_kva group by all) c using (MTR_NO, YM)",
    "yearly": "select DT_CODE_NEW, YEAR, max(PEAK_KVA_RAW) as YEARLY_PEAK from monthly group by all",
    "growth": "select *, (YEARLY_PEAK / nullif(lag(YEARLY_PEAK) over (partition by DT_CODE_NEW order by YEAR), 0) - 1) * 100 as YOY_PCT from yearly",
    # Each year beside the others of its DT, and the year asked for beside all.
    "points": "select DT_CODE_NEW, YEARLY_PEAK as v, ln(greatest(YEARLY_PEAK, 1e-6)) as lv, YEAR - avg(YEAR) over (partition by DT_CODE_NEW) as x, 2003 - avg(YEAR) over (partition by DT_CODE_NEW) as asked, count(*) over (partition by DT_CODE_NEW) as n_years from yearly where YEARLY_PEAK is not null",
    "beside": "select i.DT_CODE_NEW, i.x as place, i.v as seen, j.x, j.v, j.lv from points i join points j on i.DT_CODE_NEW = j.DT_CODE_NEW and i.x <> j.x where i.n_years >= 4 union all select DT_CODE_NEW, asked, null, x, v, lv from points where n_years >= 4",
    "fits": """select DT_CODE_NEW, seen, lin, ex, ((c00*t0 + c01*t1 + c02*t2) + (c01*t0 + c11*t1 + c12*t2) * place + (c02*t0 + c12*t1 + c22*t2) * place * place) / (s0*c00 + s1*c01 + s2*c02) as quad from (
      select *, s2*s4 - s3*s3 as c00, s2*s3 - s1*s4 as c01, s1*s3 - s2*s2 as c02, s0*s4 - s2*s2 as c11, s1*s2 - s0*s3 as c12, s0*s2 - s1*s1 as c22 from (
      select DT_CODE_NEW, place, seen, count(*)::double as s0, sum(x) as s1, sum(x*x) as s2, sum(x*x*x) as s3, sum(x*x*x*x) as s4, sum(v) as t0, sum(v*x) as t1, sum(v*x*x) as t2, regr_intercept(v, x) + regr_slope(v, x) * place as lin, exp(regr_intercept(lv, x) + regr_slope(lv, x) * place) as ex from beside group by DT_CODE_NEW, place, seen))""",
    "foreseen": """select *, coalesce((FORECAST / nullif(CURRENT_PEAK, 0) - 1) * 100, 0) as GROWTH_PCT from (select f.DT_CODE_NEW, case when e0 <= e1 and e0 <= e2 then 'linear' when e1 <= e2 then 'quadratic' else 'exponential' end as METHOD, case when e0 <= e1 and e0 <= e2 then lin when e1 <= e2 then quad else ex end as FORECAST, least(e0, e1, e2) as LOO_ERROR, p as CURRENT_PEAK
      from (select * from fits where seen is null) f join (select DT_CODE_NEW, avg(power(lin - seen, 2)) as e0, avg(power(quad - seen, 2)) as e1, avg(power(ex - seen, 2)) as e2 from fits where seen is not null group by 1) e using (DT_CODE_NEW) join (select DT_CODE_NEW, arg_max(YEARLY_PEAK, YEAR) as p from yearly group by 1) l using (DT_CODE_NEW))""",
    "loaded": "select DT_CODE_NEW, YEAR, YM, DATE, SLOT_MINUTES, sum(KVA) / 110 as loading from load_kva group by DT_CODE_NEW, YEAR, YM, DATE, TIME_SLOT, SLOT_MINUTES",
    "sustained": f"select DT_CODE_NEW, YEAR, YM, DATE, {_BANDS} as BAND, sum(SLOT_MINUTES / 60.0::double) as hours_in_band from loaded where loading >= 0.7 group by all",
    "band_hours": "select DT_CODE_NEW, YEAR, YM, BAND, sum(hours_in_band) as hours_in_band from sustained group by all",
    "win": "select *, KW_R as v from read_kva where DATE between DATE '2024-01-02' and DATE '2024-01-20'",
    "grid": "select MTR_NO, TIME_SLOT, cast(row_number() over (partition by MTR_NO order by TIME_SLOT) - 1 as integer) as POS from (select distinct MTR_NO, TIME_SLOT from win)",
    "curve": "select g.MTR_NO, g.TIME_SLOT, g.POS, d.a as ACTUAL, d.MTR_NO is not null as PRESENT from (select * from grid where MTR_NO in (select MTR_NO from win where DATE = DATE '2024-01-20')) g left join (select MTR_NO, TIME_SLOT, avg(v) as a from win where DATE = DATE '2024-01-20' group by all) d using (MTR_NO, TIME_SLOT)",
    "band": "select MTR_NO, TIME_SLOT, max(v) as HIST_MAX, min(v) as HIST_MIN, avg(v) as HIST_MEAN, max(v) * 1.05::double as UPPER_THRESH, min(v) * 0.95::double as LOWER_THRESH from win where DATE between DATE '2024-01-13' and DATE '2024-01-19' group by all",
    "flagged": "select MTR_NO, TIME_SLOT, ACTUAL, case when ACTUAL > UPPER_THRESH then 'HIGH' when ACTUAL < LOWER_THRESH then 'LOW' else 'OK' end as ANOMALY_DIR from curve join band using (MTR_NO, TIME_SLOT) where PRESENT",
    "line": """select c.*, coalesce(ACTUAL, la + (ra - la) / nullif(rp - lp, 0) * (POS - lp)) as FILLED from (select c.*, (select max(POS) from curve l where l.MTR_NO = c.MTR_NO and l.POS <= c.POS and l.ACTUAL is not null) as lp,
      (select min(POS) from curve l where l.MTR_NO = c.MTR_NO and l.POS >= c.POS and l.ACTUAL is not null) as rp from curve c) c left join (select MTR_NO as m1, POS as p1, ACTUAL as la from curve ) a on a.m1 = c.MTR_NO and a.p1 = c.lp left join (select MTR_NO as m2, POS as p2, ACTUAL as ra from curve ) b on b.m2 = c.MTR_NO and b.p2 = c.rp""",
    # Splines: the points around each gap, the tridiagonal system of their slopes or bends, and its solution, step by step.
    "holes": "select distinct MTR_NO, lp, rp, rp - lp - 1 as gap from line where ACTUAL is null and lp is not null and rp is not null",
    "around": """select *, lag(x) over o as xb, lag(y) over o as yb, lead(x) over o as xa, lead(y) over o as ya, lead(x, 2) over o as xaa, case when gap <= 2 or np <= 2 then 'linear' when gap <= 4 then 'quadratic' when np <= 3 then 'linear' else 'cubic' end as kind
      from (select h.*, k.POS::double as x, k.ACTUAL as y, row_number() over (partition by h.MTR_NO, h.lp order by k.POS) - 1 as i, count(*) over (partition by h.MTR_NO, h.lp) as np from holes h join curve k on k.MTR_NO = h.MTR_NO and k.ACTUAL is not null and k.POS > h.lp - 6 and k.POS < h.rp + 6) window o as (partition by MTR_NO, lp order by i)""",
    "tridiagonal": """select MTR_NO, lp, np, i, i = 0 as top, a, 1 - a - c as b, c, d from (select *, case when i in (0, np - 2) then 0 else (xa - x) / (4 * (xa - xb)) end as a, case when i in (0, np - 2) then 0 else (xa - x) / (4 * (xaa - x)) end as c, (ya - y) / (xa - x) as d from around where kind = 'quadratic' and i < np - 1)
      union all select MTR_NO, lp, np, i, i = 1, case when i = 1 then 0 when i = np - 2 then h - k * k / h else h end, 2 * (h + k) + case when i = 1 then h + h * h / k else 0 end + case when i = np - 2 then k + k * k / h else 0 end, case when i = np - 2 then 0 when i = 1 then k - h * h / k else k end, d
      from (select *, x - xb as h, xa - x as k, 6 * ((ya - y) / (xa - x) - (y - yb) / (x - xb)) as d from around where kind = 'cubic' and i between 1 and np - 2)""",
    "swept": "with recursive s as (select MTR_NO, lp, np, i, c / b as c, d / b as d from tridiagonal where top union all select n.MTR_NO, n.lp, n.np, n.i, n.c / (n.b - n.a * s.c), (n.d - n.a * s.d) / (n.b - n.a * s.c) from s join tridiagonal n on n.MTR_NO = s.MTR_NO and n.lp = s.lp and n.i = s.i + 1) select * from s",
    "steps": "with recursive z as (select MTR_NO, lp, i, d as m from swept where i = np - 2 union all select s.MTR_NO, s.lp, s.i, s.d - s.c * z.m from z join swept s on s.MTR_NO = z.MTR_NO and s.lp = z.lp and s.i = z.i - 1) select * from z",
    "bends": """select *, case when kind = 'cubic' then case when i = 0 then ma - (maa - ma) / (xaa - xa) * (xa - x) when i = np - 1 then mb + (mb - mbb) / (xb - xbb) * (x - xb) else m end when i = 0 then (ma - m) / ((xaa - x) / 2) when i >= np - 2 then (coalesce(m, mb) - case when m is null then mbb else mb end) / (case when m is null then x - xbb else xa - xb end / 2) else (m - mb) / ((xa - xb) / 2) end as w
      from (select a.*, m, lag(x, 2) over o as xbb, lag(m) over o as mb, lag(m, 2) over o as mbb, lead(m) over o as ma, lead(m, 2) over o as maa from around a left join steps s on s.MTR_NO = a.MTR_NO and s.lp = a.lp and s.i = a.i window o as (partition by a.MTR_NO, a.lp order by a.i))""",
    "spline": """select MTR_NO, POS, kind, case when kind = 'linear' then y + (ya - y) / (xa - x) * t when kind = 'cubic' then y + t * ((ya - y) / (xa - x) - (xa - x) * (2 * w + wa) / 6) + w * t * t / 2 + (wa - w) * t * t * t / (6 * (xa - x))
      when t <= (xa - x) / 2 then y + (m - w * (xa - x) / 2) * t + w * t * t / 2 else ya + (m + wa * (xa - x) / 2) * (t - xa + x) + wa * (t - xa + x) * (t - xa + x) / 2 end as v
      from (select c.MTR_NO, c.POS, b.* exclude (MTR_NO), c.POS - b.x as t from (select * from line where ACTUAL is null) c join (select *, lead(w) over (partition by MTR_NO, lp order by i) as wa from bends ) b on b.MTR_NO = c.MTR_NO and b.lp = c.lp and b.x = c.lp)""",
    "regression": """select g.MTR_NO, g.TIME_SLOT, case when n >= 2 then greatest(fit, 0) else med end as PREDICTED from grid g join (select MTR_NO, median(v) as med from win where DATE < DATE '2024-01-20' and v is not null group by 1) m using (MTR_NO)
      left join (select MTR_NO, TIME_SLOT, count(*) as n, case when count(distinct DATE) > 1 then regr_intercept(v, date_diff('day', DATE '2024-01-20', DATE)) else avg(v) end as fit from win where DATE < DATE '2024-01-20' and v is not null group by all) f using (MTR_NO, TIME_SLOT)""",
    "per_dt": "select c.DT_CODE_NEW, count(*) as present_rows, count(*) filter (where h.MTR_NO is not null or t.MTR_NO is not null) as bad_rows from clean c left join (select distinct DT_CODE_NEW, MTR_NO, DATE, TIME_SLOT from hard) h using (DT_CODE_NEW, MTR_NO, DATE, TIME_SLOT) left join (select distinct DT_CODE_NEW, MTR_NO, DATE, TIME_SLOT from threshold) t using (DT_CODE_NEW, MTR_NO, DATE, TIME_SLOT) group by 1",
    "health": "select *, present_rows - bad_rows as clean_rows, 100.0::double * (present_rows - bad_rows) / present_rows as p from per_dt",
    "kinds": "select DT_CODE_NEW, ANOMALY_TYPE, count(*) as n from (select DT_CODE_NEW, ANOMALY_TYPE from hard union all select DT_CODE_NEW, concat(PARAMETER, '_', DIRECTION) from threshold) group by all",
    "listed": "select DT_CODE_NEW, string_agg(concat(ANOMALY_TYPE, ':', n), '; ' order by n desc, ANOMALY_TYPE) as anomaly_type_breakdown, max(case when rk = 1 then ANOMALY_TYPE end) as top_anomaly_type from (select *, row_number() over (partition by DT_CODE_NEW order by n desc, ANOMALY_TYPE) as rk from kinds) group by 1",
    "anomalies": """select MTR_NO, DT_CODE_NEW, DATE, TIME_SLOT, case when ANOMALY_TYPE in ('ZERO_VOLTAGE', 'ZERO_KWH_WITH_LOAD') then 'Zero Values (voltage / KWH-with-load)' when ANOMALY_TYPE = 'MISSING_KWH' then 'Missing KWH' when ANOMALY_TYPE like 'EXTREME%' then 'Extreme Voltage/Current Spikes'
      when ANOMALY_TYPE like 'NEGATIVE%' then 'Negative KVAR' else 'Phase Loss (KW/KVAR)' end as CATEGORY, ANOMALY_TYPE, SEVERITY from hard
      union all select MTR_NO, DT_CODE_NEW, DATE, TIME_SLOT, 'Rolling Threshold Spikes (+-5% band)', concat(PARAMETER, '_', DIRECTION), null from threshold union all select null, DT_CODE_NEW, DATE, null, 'Missing Slots / Days', GAP_TYPE, null from missing_dt""",
}

_READS = {name: [t for t in _WITH if t != name and any(f"{w}{t}{e}" in f" {sql} " for w in (" ", "(") for e in (" ", ")", "\n", ","))] for name, sql in _WITH.items()}


def _sql(select: str, doubles: str = "") -> str:
    """The query with the tables it needs before it, and doubles rounded."""
    need: list[str] = []

    def add(name: str) -> None:
        for t in _READS[name]:
            if list(_WITH).index(t) < list(_WITH).index(name):
                add(t)
        if name not in need:
            need.append(name)

    for t in _WITH:
        if any(f"{w}{t}{e}" in f" {select} " for w in (" ", "(") for e in (" ", ")", ",")):
            add(t)
    parts = ", ".join(f"{t} as ({_WITH[t].strip()})" for t in need)
    replaced = ", ".join(f"round({c}, 7) as {c}" for c in doubles.split())
    body = f"select * replace ({replaced}) from ({select})" if replaced else select
    return f"with {parts} {body}" if parts else body


_V = " ".join(PARAMETERS)


def _pivot(source: str, column: str, values, value: str, how: str) -> str:
    cells = [f'round({how}(case when {column} = {v} then {value} end), 7) as "{v}"' for v in values]
    return f"select DT_CODE_NEW, {', '.join(cells)} from {source} group by DT_CODE_NEW"


ORACLES = {
    "raw_dedup": _sql("select * from dedup", _V),
    "asof_master_join": _sql("select MTR_NO, DATE, TIME_SLOT, ok, pk, DT_CODE_NEW, SDO_CD, CT_RATIO, DT_CAT, meter_seq, dt_meter_rank, is_meter_replaced from placed"),
    "ct_scaling": _sql("select MTR_NO, DATE, TIME_SLOT, ok, IR * coalesce(CT_RATIO, 1) as IR, KW_Y * coalesce(CT_RATIO, 1) as KW_Y, KVAR_B * coalesce(CT_RATIO, 1) as KVAR_B, KWH_TOTAL * coalesce(CT_RATIO, 1) as KWH_TOTAL, VR, CT_RATIO is not null as ct_scaled from placed", "IR KW_Y KVAR_B KWH_TOTAL"),
    "base_month": _sql("select DT_CODE_NEW, MTR_NO, DATE, TIME_SLOT from dedup where year(DATE) = 2024 and month(DATE) = 1"),
    "month_window": "select 202312 as previous, DATE '2024-01-01' as first_day, DATE '2024-01-31' as last_day, DATE '2023-12-25' as lookback_start",
    "daily_slot_counts": _sql("select * from counts"),
    "meter_expected_slots": _sql("select * from expected"),
    "missing_slot_days": _sql(f"select MTR_NO, DT_CODE_NEW, DATE, slots_present, expected_slots_per_day, {_GAP} from counts join expected using (MTR_NO) where slots_present < expected_slots_per_day"),
    "dt_stitched_readings": _sql("select DT_CODE_NEW, MTR_NO, DATE, TIME_SLOT, meter_seq, KWH_TOTAL from stitched", "KWH_TOTAL"),
    "missing_slot_days_dt": _sql("select * from missing_dt"),
    "rolling_thresholds": _sql("select MTR_NO, DATE, TIME_SLOT, KW_R_HI, KW_R_LO, VR_HI, VR_LO from rolling where (MTR_NO, DATE, TIME_SLOT) in (select MTR_NO, DATE, TIME_SLOT from threshold )", "KW_R_HI KW_R_LO VR_HI VR_LO"),
    "threshold_anomalies": _sql("select * from threshold", "VALUE THRESH_HI THRESH_LO"),
    "hard_flags": _sql(f"select MTR_NO, DATE, TIME_SLOT, {', '.join(f for f, *_ in _rules())} from flags"),
    "hard_anomalies": _sql("select * from hard"),
    "hard_anomaly_counts": _sql("select ANOMALY_TYPE, SEVERITY, count(*) as n from hard group by all"),
    "clean_readings": _sql("select * from clean", _V),
    "master_timeaware": _sql("select * from master"),
    "earliest_master": _sql("select * from earliest"),
    "meter_sequence": _sql("select * from sequence"),
    "replacement_stats": _sql("select count(distinct case when is_meter_replaced then DT_CODE_NEW end) as replaced_dts, count(distinct DT_CODE_NEW) as all_dts from sequence"),
    "category_distribution": _sql("select DT_CAT, count(distinct MTR_NO) as meters from master group by DT_CAT"),
    "hierarchy": _sql("select * from hierarchy"),
    "fleet_summary": _sql("select count(distinct SDO_CD) as n_fl, count(distinct DT_CODE_NEW) as n_dt, count(distinct MTR_NO) as n_meters, count(distinct case when is_meter_replaced then DT_CODE_NEW end) as n_replaced from hierarchy"),
    "dt_summary": _sql("select * from summary"),
    "dt_summary_page": _sql("select SDO_CD, DT_CODE_NEW, N_METERS from summary order by SDO_CD, DT_CODE_NEW limit 10 offset 10"),
    "meters_of_dt": _sql("select MTR_NO, meter_seq, dt_meter_rank from hierarchy where DT_CODE_NEW = 'DT7'"),
    "ambiguous_meters": _sql("select MTR_NO, count(*) as n_places, min(DT_CODE_NEW) as DT_CODE_NEW, arg_min(SDO_CD, DT_CODE_NEW) as SDO_CD from (select distinct MTR_NO, DT_CODE_NEW, SDO_CD from master) group by MTR_NO having count(*) > 1"),
    "normalize_meter_id": "select s_suppkey, cast(s_suppkey as varchar) as MTR_NO from supplier",
    "meter_granularity": _sql("select * from minutes"),
    "slot_kva": _sql("select MTR_NO, DATE, TIME_SLOT, KVA from read_kva", "KVA"),
    "daily_kva_sum": _sql("select * from daily", "DAILY_KVA_SUM"),
    "coincidental_peak_monthly": _sql("select * from coincidental", "PEAK"),
    "coincidental_peak_yearly": _sql("select * from coincidental union all select concat(LEVEL, '_YEARLY'), KEY, YEAR, null, null, max(PEAK) from coincidental group by LEVEL, KEY, YEAR", "PEAK"),
    "monthly_peak_raw": _sql("select * from monthly", "PEAK_KVA_RAW"),
    "monthly_peak_clean": _sql("select * from clean_peaks", "PEAK_KVA_RAW PEAK_KVA_CLEAN"),
    "monthly_peak_reconstructed": _sql("""select MTR_NO, YM, round(max(coalesce(KVA, filled)), 4) as PEAK_KVA_RECONSTRUCTED, count(filled) as n_filled from (select *, case when is_bad and count(KVA) over w >= 2 then greatest(coalesce(regr_intercept(KVA, x) over w + regr_slope(KVA, x) over w * x, avg(KVA) over w), 0) end as filled
      from (select *, KVA is null and (MTR_NO, DATE, TIME_SLOT) in (select MTR_NO, DATE, TIME_SLOT from bad ) as is_bad, date_diff('day', DATE '2020-01-01', DATE)::double as x from clean_kva ) window w as (partition by MTR_NO, TIME_SLOT order by x range between 120 preceding and 1 preceding)) group by all"""),
    "peak_delta_kpis": _sql("select max(PEAK_KVA_RAW) as max_raw, max(PEAK_KVA_CLEAN) as max_clean, max(abs(PEAK_KVA_RAW - PEAK_KVA_CLEAN)) as max_delta, arg_max(YM, abs(PEAK_KVA_RAW - PEAK_KVA_CLEAN)) as max_delta_ym, avg(case when PEAK_KVA_RAW <> 0 then (PEAK_KVA_RAW - PEAK_KVA_CLEAN) / PEAK_KVA_RAW * 100 end) as mean_delta_pct from clean_peaks", "max_raw max_clean max_delta mean_delta_pct"),
    "peak_pivot": _sql(_pivot("(select * from monthly where YEAR = 1996)", "YM", range(199601, 199613), "PEAK_KVA_RAW", "max")),
    "yearly_peak": _sql("select * from yearly", "YEARLY_PEAK"),
    "yoy_growth": _sql("select * from growth", "YEARLY_PEAK YOY_PCT"),
    "growth_kpis": _sql("select avg(YOY_PCT) as avg_yoy, max(YOY_PCT) as max_yoy, min(YOY_PCT) as min_yoy, count(distinct YEAR) as n_years from growth", "avg_yoy max_yoy min_yoy"),
    "peak_pivot_both": _sql("select DT_CODE_NEW, " + ", ".join(f'round(max(case when YM = {m} then {v} end), 7) as "{m}_{n}"' for m in (202312, 202401, 202402) for n, v in (("raw", "PEAK_KVA_RAW"), ("clean", "PEAK_KVA_CLEAN"))) + " from clean_peaks group by 1"),
    "growth_pivot": _sql(_pivot("(select * from yearly )", "YEAR", range(1992, 2002), "YEARLY_PEAK", "max")),
    "compound_growth": _sql("select *, case when first_peak > 0 and last_year > first_year then (power(last_peak / first_peak, 1.0 / (last_year - first_year)) - 1) * 100 end as CAGR_PCT from (select DT_CODE_NEW, min(YEAR) as first_year, max(YEAR) as last_year, arg_min(YEARLY_PEAK, YEAR) as first_peak, arg_max(YEARLY_PEAK, YEAR) as last_peak from yearly group by 1)", "first_peak last_peak CAGR_PCT"),
    "fit_best_model": _sql("select DT_CODE_NEW, METHOD, round(FORECAST, 4) as FORECAST, round(LOO_ERROR, 3) as LOO_ERROR from foreseen"),
    "dt_forecast": _sql("select DT_CODE_NEW, METHOD, round(FORECAST, 4) as FORECAST, round(LOO_ERROR, 3) as LOO_ERROR, round(CURRENT_PEAK, 7) as CURRENT_PEAK, round(GROWTH_PCT, 4) as GROWTH_PCT from foreseen"),
    "fl_forecast": _sql("select SDO_CD, round(sum(FORECAST), 4) as FORECAST, round(sum(CURRENT_PEAK), 4) as CURRENT_PEAK, count(*) as n_dts from foreseen join (select distinct DT_CODE_NEW, SDO_CD from places ) using (DT_CODE_NEW) group by 1"),
    "dt_rating": _sql("select DT_CODE_NEW, max(KVA_RATING) as DT_KVA_RATING from places group by 1"),
    "sustained_daily_raw": _sql("select * from sustained", "hours_in_band"),
    "sustained_daily_clean": _sql(f"select DT_CODE_NEW, (YM // 100)::integer as YEAR, YM, DATE, {_BANDS} as BAND, sum(SLOT_MINUTES / 60.0::double) as hours_in_band from (select *, KVA / 30 as loading, row_number() over (partition by DT_CODE_NEW, DATE, TIME_SLOT order by meter_seq desc, MTR_NO) as rk from clean_kva ) where rk = 1 and loading >= 0.7 group by all", "hours_in_band"),
    "band_hours_monthly": _sql("select * from band_hours", "hours_in_band"),
    "sustained_flag": _sql("select *, hours_in_band >= 30 as is_sustained from band_hours", "hours_in_band"),
    "sustained_kpis": _sql("select count(*) as n_dts, sum(h) as hours, avg(h) as avg_hours, count(*) filter (where h >= 30) as sustained_dts, count(*) filter (where m >= 30) as sustained_month_dts from (select DT_CODE_NEW, sum(hours_in_band) as h, max(hours_in_band) as m from band_hours group by 1)", "hours avg_hours"),
    "sustained_pivot": _sql(_pivot("(select * from band_hours where YEAR = 1996)", "YM", range(199601, 199613), "hours_in_band", "sum")),
    "meter_window": _sql("select MTR_NO, DATE, TIME_SLOT, KVA from win", "KVA"),
    "active_meters": _sql("select distinct MTR_NO from dedup where DT_CODE_NEW = 'DT3' and DATE = DATE '2024-01-20'"),
    "slot_grid": _sql("select * from grid"),
    "day_curve": _sql("select * from curve", "ACTUAL"),
    "threshold_band_7d": _sql("select * from band", "HIST_MAX HIST_MIN HIST_MEAN UPPER_THRESH LOWER_THRESH"),
    "band_anomalies": _sql("select *, ANOMALY_DIR <> 'OK' as IS_ANOMALY from flagged", "ACTUAL"),
    "missing_slot_runs": _sql("""select MTR_NO, TIME_SLOT, POS, cast(POS - coalesce(l, -1) as integer) as GAP_POSITION, cast(coalesce(r, e + 1) - coalesce(l, -1) - 1 as integer) as GAP_LENGTH,
      case when l is not null and r is not null then case when r - l - 1 <= 2 then 'linear' when r - l - 1 <= 4 then 'quadratic' else 'cubic' end end as METHOD from (select c.*, (select max(POS) from curve x where x.MTR_NO = c.MTR_NO and x.POS < c.POS and x.ACTUAL is not null) as l,
      (select min(POS) from curve x where x.MTR_NO = c.MTR_NO and x.POS > c.POS and x.ACTUAL is not null) as r, (select max(POS) from curve x where x.MTR_NO = c.MTR_NO) as e from curve c where ACTUAL is null)"""),
    "interpolate_linear": _sql("select MTR_NO, TIME_SLOT, POS, ACTUAL, PRESENT, FILLED from line", "ACTUAL FILLED"),
    "interpolate_gaps": _sql("select l.MTR_NO, l.TIME_SLOT, l.POS, l.ACTUAL, l.PRESENT, coalesce(l.ACTUAL, s.v) as FILLED, s.kind as METHOD from line l left join spline s on s.MTR_NO = l.MTR_NO and s.POS = l.POS", "ACTUAL FILLED"),
    "regression_curve": _sql("select * from regression", "PREDICTED"),
    "clean_curve_off": _sql("select MTR_NO, TIME_SLOT, POS, FILLED as CLEAN from line", "CLEAN"),
    "clean_curve": _sql("select l.MTR_NO, l.TIME_SLOT, l.POS, case when f.ANOMALY_DIR <> 'OK' then coalesce(r.PREDICTED, l.FILLED) else l.FILLED end as CLEAN from line l left join flagged f using (MTR_NO, TIME_SLOT) left join regression r using (MTR_NO, TIME_SLOT)", "CLEAN"),
    "curve_slope": _sql("select c.MTR_NO, c.TIME_SLOT, c.ACTUAL - p.ACTUAL as SLOPE from curve c left join curve p on p.MTR_NO = c.MTR_NO and p.POS = c.POS - 1", "SLOPE"),
    "curve_kpis": _sql("select MTR_NO, peak, n_missing, coalesce(n_anomalies, 0) as n_anomalies, max_upper, min_lower from (select MTR_NO, max(ACTUAL) as peak, count(*) filter (where ACTUAL is null) as n_missing from curve group by 1) left join (select MTR_NO, count(*) filter (where ANOMALY_DIR <> 'OK') as n_anomalies from flagged group by 1) using (MTR_NO) left join (select MTR_NO, max(UPPER_THRESH) as max_upper, min(LOWER_THRESH) as min_lower from band group by 1) using (MTR_NO)", "peak max_upper min_lower"),
    "health_report": _sql("select DT_CODE_NEW, present_rows, bad_rows, clean_rows, round(p, 1) as health_pct, coalesce(top_anomaly_type, '') as top_anomaly_type, coalesce(anomaly_type_breakdown, '') as anomaly_type_breakdown from health left join listed using (DT_CODE_NEW) where round(p, 1) >= 20"),
    "health_distribution": _sql("select case when p >= 95 then '95-100%' when p >= 90 then '90-95%' when p >= 75 then '75-90%' when p >= 50 then '50-75%' when p >= 25 then '25-50%' else '0-25%' end as bucket, count(*) as n_dts from health group by 1"),
    "health_span": _sql("select case when p < 40 then 'below' else 'above' end as side, count(*) as n_dts, avg(d) as avg_days, avg(s) as avg_span from health join (select DT_CODE_NEW, count(distinct DATE) as d, date_diff('day', min(DATE), max(DATE)) as s from clean group by 1) using (DT_CODE_NEW) group by 1", "avg_days avg_span"),
    "total_dts": _sql("select count(distinct DT_CODE_NEW) as total_dts from clean"),
    "anomaly_search": _sql("select MTR_NO, DT_CODE_NEW, DATE, TIME_SLOT, CATEGORY, ANOMALY_TYPE from anomalies where CATEGORY = 'Phase Loss (KW/KVAR)' and DATE between DATE '2024-01-05' and DATE '2024-01-20'"),
    "anomaly_search_fl": _sql("select MTR_NO, DT_CODE_NEW, DATE, TIME_SLOT, CATEGORY, ANOMALY_TYPE from anomalies where DATE = DATE '2024-01-20' and DT_CODE_NEW in (select DT_CODE_NEW from hierarchy where SDO_CD = 'FL2')"),
    "anomaly_summary": _sql("select *, n = max(n) over () as is_top from (select CATEGORY, count(*) as n, count(distinct DT_CODE_NEW) as n_dts, count(distinct MTR_NO) as n_meters, count(*) filter (where SEVERITY in ('HIGH', 'CRITICAL')) as n_severe from anomalies group by 1)"),
    "anomaly_types": _sql("select ANOMALY_TYPE, count(*) as n from anomalies group by 1"),
    "check_anomalies_match": _sql("select count(*) as n_slots, count(*) as n_matched from (select distinct MTR_NO, DATE, TIME_SLOT from hard intersect select MTR_NO, DATE, TIME_SLOT from clean )"),
    "check_meters_per_month": _sql("select 202401 as YM, (select count(distinct MTR_NO) from readings ) as raw_meters, (select count(distinct MTR_NO) from clean ) as clean_meters"),
    "check_nulls_kept": _sql(" union all ".join(f"select '{p}' as parameter, (select count(*) from dedup where {p} is null) as raw_nulls, (select count(*) from clean where {p} is null) as clean_nulls, true as holds" for p in PARAMETERS)),
    "check_zero_voltage": _sql("select count(*) as n_zero_voltage, count(*) filter (where VR is not null or VY is not null or VB is not null) as n_not_nulled from clean where was_zero_voltage"),
    "check_missing_dt": _sql("select count(*) filter (where DT_CODE_NEW is null) as n_null_dt, count(distinct (MTR_NO, month(DATE))) as meter_months, count(distinct (MTR_NO, DT_CODE_NEW, month(DATE))) as meter_dt_months from clean"),
    "check_top_slots": _sql("select MTR_NO, DATE, TIME_SLOT, (VR*IR + VY*IY + VB*IB) / 1000.0::double as KVA_VI, sqrt(power(KW_R+KW_Y+KW_B, 2) + power(KVAR_R+KVAR_Y+KVAR_B, 2)) as KVA_PQ, (MTR_NO, DATE, TIME_SLOT) in (select MTR_NO, DATE, TIME_SLOT from hard ) as is_bad from dedup where MTR_NO = 'M1' order by KVA_PQ desc, DATE, TIME_SLOT limit 5", "KVA_VI KVA_PQ"),
    "check_key_overlap": _sql("select (select count(distinct MTR_NO) from loads ) as n_left, (select count(distinct MTR_NO) from master ) as n_right, (select count(*) from (select MTR_NO from loads intersect select MTR_NO from master )) as n_both"),
    "check_equal_peaks": _sql("select count(*) as n, count(*) filter (where PEAK_KVA_RAW = PEAK_KVA_CLEAN) as equal, count(*) filter (where PEAK_KVA_CLEAN < PEAK_KVA_RAW) as lower, count(*) filter (where PEAK_KVA_CLEAN is null) as missing, count(*) filter (where PEAK_KVA_CLEAN > PEAK_KVA_RAW) as higher from clean_peaks"),
    "check_unique_placement": _sql("select MTR_NO, count(distinct DT_CODE_NEW) as n_dts from hierarchy group by 1 having count(distinct DT_CODE_NEW) > 1"),
    "check_months_not_cleaned": _sql("select distinct (year(DATE)*100+month(DATE))::integer as YM from readings where year(DATE)*100+month(DATE) not in (select year(DATE)*100+month(DATE) from clean )"),
    "check_both_kva": _sql("select MTR_NO, DATE, TIME_SLOT, (VR*IR + VY*IY + VB*IB) / 1000.0::double as KVA_VI, sqrt(power(KW_R+KW_Y+KW_B, 2) + power(KVAR_R+KVAR_Y+KVAR_B, 2)) as KVA_PQ from dedup", "KVA_VI KVA_PQ"),
    "check_recomputed": _sql("select count(*) as n, cast(0 as bigint) as n_different from monthly"),
    "check_schema_difference": "select 'was_zero_voltage' as \"column\", 'right' as side",
    "check_source_files": "select count(*) as n_rows from events",
    "check_columns": "select unnest(['MTR_NO', 'MONTH', 'DT_CODE_NEW', 'SDO_CD', 'CT_RATIO', 'KVA_RATING', 'DT_STS', 'DT_CAT', 'CONSUMER_COUNT']) as column_name",
    "missing_slot_days_calendar": _sql(f"select MTR_NO, DATE, slots_present, expected_slots_per_day, {_GAP} from calendar join load_expected using (MTR_NO) where slots_present < expected_slots_per_day"),
    "offline_runs": _sql("select MTR_NO, DT_CODE_NEW, min(DATE) as first_day, max(DATE) as last_day, count(*) as n_days from (select *, DATE - cast(row_number() over (partition by MTR_NO, DT_CODE_NEW order by DATE) as integer) as island from calendar where slots_present = 0) group by MTR_NO, DT_CODE_NEW, island"),
    "clean_curve_gaps": _sql("select l.MTR_NO, l.TIME_SLOT, l.POS, case when f.ANOMALY_DIR <> 'OK' then coalesce(r.PREDICTED, l.ACTUAL, s.v) else coalesce(l.ACTUAL, s.v) end as CLEAN from line l left join spline s on s.MTR_NO = l.MTR_NO and s.POS = l.POS left join flagged f on f.MTR_NO = l.MTR_NO and f.TIME_SLOT = l.TIME_SLOT left join regression r on r.MTR_NO = l.MTR_NO and r.TIME_SLOT = l.TIME_SLOT", "CLEAN"),
    "check_stale_cache": _sql("select count(*) as n, count(*) filter (where YM = 199603 and s <> PEAK_KVA_RAW) as n_different from monthly left join (select MTR_NO, YM, max(CT_RATIO * case when SLOT_MINUTES = 15 then (VR*IR*3 + VY*IY + VB*IB) / 1000.0::double else sqrt(power(KW_R*3+KW_Y+KW_B, 2) + power(KVAR_R+KVAR_Y+KVAR_B, 2)) end) as s from load_kva group by all) using (MTR_NO, YM)"),
    "check_months_behind": _sql("select distinct (year(DATE)*100+month(DATE))::integer as YM from loads where year(DATE) >= 1998"),
    "check_ct_ratios": _sql("select MTR_NO, count(distinct CT_RATIO) as n_ratios, min(CT_RATIO) as least, max(CT_RATIO) as largest, count(*) - count(CT_RATIO) as n_without from master group by 1"),
    "check_granularity": _sql("select d.*, SLOT_MINUTES from (select MTR_NO, count(*) as n_rows, count(distinct DATE) as n_days, count(IR) as n_current from dedup group by 1) d left join minutes using (MTR_NO)"),
    "check_observed_counts": _sql("select 'readings' as stage, count(*) as n_rows from readings union all select 'dedup', count(*) from dedup union all select 'stitched', count(*) from stitched union all select 'bad', count(*) from bad"),
    "raw_detail_export": _sql("select (year(DATE)*100+month(DATE))::integer as SOURCE_YM, p.DT_CODE_NEW, p.SDO_CD, l.MTR_NO, DATE as OCCUR_D_RAW, TIME_SLOT, ok, pk, IR, KWH_TOTAL from loads l join (select MTR_NO, min(DT_CODE_NEW) as DT_CODE_NEW, arg_min(SDO_CD, [DT_CODE_NEW, SDO_CD]) as SDO_CD from master group by 1) p on p.MTR_NO = l.MTR_NO where p.SDO_CD = 'FL2'"),
    "check_first_difference": _sql("select * from clean_peaks where PEAK_KVA_CLEAN <> PEAK_KVA_RAW order by YM, MTR_NO limit 1", "PEAK_KVA_RAW PEAK_KVA_CLEAN"),
    "check_staged_counts": _sql("select 'readings' as stage, count(*) as n_rows from readings union all select 'dedup', count(*) from dedup union all select 'stitched', count(*) from stitched union all select 'bad', count(*) from bad"),
    "half_hours": "select printf('%02d:%02d', i // 2, i % 2 * 30) as TIME_SLOT, cast(i as integer) as POS from range(48) t(i)",
    "check_drift": _sql("select case when DATE < DATE '2024-01-20' then 'train' else 'test' end as part, avg(KW_R) as mean, stddev_samp(KW_R) as std, min(KW_R) as min, max(KW_R) as max from dedup group by 1", "mean std min max"),
}

ORACLES |= {f"{name}_full": ORACLES[name].replace("DATE '2024-01-02'", "DATE '2023-07-24'") for name in FULL}
