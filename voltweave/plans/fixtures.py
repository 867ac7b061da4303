"""Load-survey tables made from the general test tables, for the registered queries and their oracles.

The SQL runs unchanged in Spark and DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

READINGS = """
with b as (select cast(floor(user_id/8) as int) as mno, cast(ts as date) as DATE, cast(floor(hour(ts)/2) as int) as TIME_SLOT, event_id as e, value as v from events)
select concat('M', cast(mno as varchar(10))) as MTR_NO, concat('DT', cast(cast(floor(mno/2) as int) as varchar(10))) as DT_CODE_NEW, mno % 2 + 1 as meter_seq, DATE, TIME_SLOT, e as event_id,
 case when mno%7=5 then 'MHVD' when mno%7=6 then 'HVDAF' when mno%7=4 then null else 'REG' end as DT_CAT,
 cast(case when e%53=0 then 0 when e%11=0 then null else 175+(e*7)%125 end as double) as VR,
 cast(case when e%53=0 then 0 else 175+(e*11)%125 end as double) as VY,
 cast(case when e%53=0 then 0 else 175+(e*13)%125 end as double) as VB,
 case when e%71=0 then cast(6000 as double) else v end as IR, case when e%73=0 then cast(6000 as double) else v end as IY, case when e%79=0 then cast(6000 as double) else v end as IB,
 case when e%29=0 then cast(0.01 as double) else v/10 end as KW_R, case when e%31=0 then cast(0.01 as double) else v/11 end as KW_Y, case when e%37=0 then cast(0.01 as double) else v/12 end as KW_B,
 case when e%41=0 then cast(-15 as double) when e%43=0 then cast(0.01 as double) else v/20 end as KVAR_R,
 case when e%47=0 then cast(-15 as double) when e%59=0 then cast(0.01 as double) else v/21 end as KVAR_Y,
 case when e%61=0 then cast(-15 as double) when e%67=0 then cast(0.01 as double) else v/22 end as KVAR_B,
 case when e%23=0 then null when e%19=0 then cast(0 as double) else v end as KWH_TOTAL from b
"""

LOADS = """
select concat('S', cast(l_suppkey as varchar(10))) as MTR_NO, concat('DT', cast(s_nationkey as varchar(10))) as DT_CODE_NEW, concat('FL', cast(n_regionkey as varchar(10))) as SDO_CD,
 cast(l_shipdate as date) as DATE, l_linenumber as TIME_SLOT, l_orderkey as ok, l_partkey as pk,
 cast(230 as double) as VR, cast(230 as double) as VY, cast(230 as double) as VB,
 cast(l_quantity as double) as IR, cast(l_quantity as double) as IY, cast(l_quantity as double) as IB,
 cast(l_quantity as double) as KW_R, cast(l_quantity*(1-l_discount) as double) as KW_Y, cast(l_quantity*(1-l_tax) as double) as KW_B,
 cast(l_quantity*l_discount as double) as KVAR_R, cast(l_quantity*l_tax as double) as KVAR_Y, cast(1 as double) as KVAR_B, cast(l_quantity as double) as KWH_TOTAL
 from lineitem join supplier on l_suppkey=s_suppkey join nation on s_nationkey=n_nationkey
"""

MASTER = """
select distinct concat('S', cast(s_suppkey as varchar(10))) as MTR_NO, cast(y*100+1 as int) as MONTH, concat('DT', cast((s_nationkey + case when s_suppkey%10=7 and y>=1999 then 1 else 0 end) % 25 as varchar(10))) as DT_CODE_NEW,
 concat('FL', cast(s_nationkey % 5 as varchar(10))) as SDO_CD, cast(1 + (s_suppkey + y) % 3 as double) as CT_RATIO, cast(110 + s_suppkey % 3 * 10 as double) as KVA_RATING,
 cast(null as varchar(10)) as DT_STS, case when s_suppkey%7=5 then 'MHVD' when s_suppkey%7=4 then null else 'REG' end as DT_CAT, cast(s_suppkey % 50 as double) as CONSUMER_COUNT
 from supplier cross join (select 1996 as y union all select 1998 as y union all select 2000 as y) z where s_suppkey%10<>9 and (s_suppkey%10<>8 or y>=1998)
"""

#: One row per meter of LOADS.
PLACES = """
select concat('S', cast(s_suppkey as varchar(10))) as MTR_NO, concat('DT', cast(s_nationkey as varchar(10))) as DT_CODE_NEW, concat('FL', cast(n_regionkey as varchar(10))) as SDO_CD, cast(110 as double) as KVA_RATING,
 cast(1 + s_suppkey % 3 as double) as CT_RATIO, case when s_suppkey%7=5 then 'MHVD' when s_suppkey%7=4 then null else 'REG' end as DT_CAT, s_suppkey % 7 = 3 as is_15 from supplier join nation on s_nationkey=n_nationkey
"""


def _run(spark: SparkSession, sf_dir: str, sql: str, *tables: str) -> DataFrame:
    for t in tables:
        sql = sql.replace(f" {t} ", f" {{{t}}} ").replace(f" {t})", f" {{{t}}})").replace(f" {t}\n", f" {{{t}}}\n")
    return spark.sql(sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables})


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, READINGS, "events")


def loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, LOADS, "lineitem", "supplier", "nation")


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, MASTER, "supplier")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, PLACES, "supplier", "nation")
