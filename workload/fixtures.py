"""Fixture tables derived from the driver's Parquet tables, in SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SQL: dict[str, str] = {
    "fx_roads": """
select c_custkey as ord,
       (case when c_nationkey < 20 then '11' else '26' end) || lpad(cast(c_nationkey as string), 3, '0') as sig_cd,
       cast(1 + c_custkey % 4 as string) as roa_cls_se,
       c_name as rn, cast(100000 + c_custkey as string) as rn_cd,
       cast(10 * (c_custkey % 13) + 5 * (c_custkey % 29) as double) as road_lt,
       cast(4 + c_custkey % 17 as double) as road_bt,
       cast(950000 + (c_custkey * 7919) % 9697 as double) as x0,
       cast(1946000 + (c_custkey * 104729) % 9689 as double) as y0,
       cast(10 * (c_custkey % 13) as double) as dx,
       cast(5 * (c_custkey % 29) as double) as dy
from {customer}
""",
    "fx_accidents": """
select o_orderkey as id, cast(year(o_orderdate) as bigint) as yr,
       case when o_orderkey % 97 = 0 then 'abc' when o_orderkey % 89 = 0 then null
            else cast(950000.37e0 + (o_orderkey * 15485863) % 9973 as string) end as x_crdnt,
       cast(1946000.61e0 + (o_orderkey * 32452843) % 9967 as string) as y_crdnt,
       case when o_orderkey % 10 = 0 then '1' else '0' end as dprs_cnt,
       cast(o_orderkey % 3 as string) as sep_cnt,
       case when o_orderkey % 17 = 0 then null else cast(o_orderkey % 5 as string) end as slp_cnt
from {orders}
""",
    "fx_links": """
select case when s_suppkey % 2 = 0 then 'L9' else 'L1' end || lpad(cast(s_suppkey as string), 6, '0') as link_id,
       s_name as road_name,
       case when s_suppkey % 23 = 5 then 'n/a' else cast(30 + 10 * (s_suppkey % 6) as string) end as max_spd,
       950000.13e0 + (floor(s_suppkey / 2) * 7919) % 8999 as x1,
       1946000.29e0 + (floor(s_suppkey / 2) * 104729) % 8971 as y1,
       950000.13e0 + (floor(s_suppkey / 2) * 7919) % 8999 + 100 + (floor(s_suppkey / 2) * 31) % 700 as x2,
       1946000.29e0 + (floor(s_suppkey / 2) * 104729) % 8971 + (floor(s_suppkey / 2) * 17) % 500 as y2
from {supplier}
""",
    "fx_shops": """
select o_orderkey as shop_id,
       case when o_orderkey % 12 = 0 then '경기도' else '서울특별시' end as sido,
       case o_orderpriority when '1-URGENT' then ' 음식' when '2-HIGH' then '소매 ' when '3-MEDIUM' then '교육'
            when '4-NOT SPECIFIED' then '숙박' else null end as major,
       case o_orderpriority when '1-URGENT' then (case o_orderstatus when 'F' then '한식' when 'O' then '중식' else '없는업종' end)
            when '2-HIGH' then '종합 소매' when '3-MEDIUM' then '일반 교육' else '일반 숙박' end as middle,
       126.934e0 + ((o_orderkey * 7907) % 9973) * 1.13e-5 as lon,
       37.512e0 + ((o_orderkey * 104723) % 9967) * 0.9e-5 as lat
from {orders}
""",
    "fx_population": """
select p_partkey % 40 as ci, cast(floor(p_partkey / 40) as bigint) % 40 as cj,
       case when p_partkey % 19 = 0 then '*' else cast(p_size + 0.5e0 as string) end as val,
       950000.37e0 + 250 * (p_partkey % 40) as xmin, 1946000.61e0 + 250 * (floor(p_partkey / 40) % 40) as ymin
from {part}
""",
    "fx_polygons": """
select 'M' || cast(k as string) as mgrnu,
       case when p_partkey % 7 = 0 then '골목상권' else '전통시장' end as kind,
       950000.23e0 + (k * 6700417) % 9887 + 20 * (p_partkey % 2) as xmin,
       1946000.71e0 + (k * 2147483) % 9883 as ymin,
       950000.23e0 + (k * 6700417) % 9887 + 20 * (p_partkey % 2) + 3 + p_size as xmax,
       1946000.71e0 + (k * 2147483) % 9883 + 2 + p_size % 11 as ymax
from (select *, cast(floor(p_partkey / 2) as bigint) as k from {part}) t
""",
    "fx_outlines": """
select 'C' || cast(k as string) as mgrnu, p_partkey % 4 as form, cast(x as double) as x, cast(y as double) as y
from (select p_partkey, cast(floor(p_partkey / 3) as bigint) as k, 950000.53e0 + (p_partkey * 5915587) % 9661 as x,
             1946000.17e0 + (p_partkey * 1500450) % 9643 as y from {part}) t
""",
    "fx_stops": """
select cast(100000 + k as string) as node_id,
       case when p_type = 'PROMO' then ' 가상정류장 ' when p_partkey % 31 = 0 then null else '일반차로' end as stop_type,
       126.934e0 + ((k * 7907) % 9973) * 1.13e-5 + (p_partkey - k) * 1e-4 as lon,
       37.512e0 + ((k * 104723) % 9967) * 0.9e-5 as lat
from (select *, case when p_partkey % 10 = 1 then p_partkey - 1 else p_partkey end as k from {part}) t
""",
    "fx_passengers": """
select cast(100000 + l_partkey as string) as stop_id, cast(l_shipdate as date) as use_date,
       case when l_orderkey % 41 = 0 then '-' else cast(cast(l_quantity as bigint) as string) end as boarding,
       cast(l_linenumber as string) as alighting
from {lineitem}
""",
    "fx_devices": """
select event_id,
       case when event_id % 29 = 0 then null when event_id % 3 = 0 then 'E' || cast(event_id as string)
            else 'D' || cast(k as string) end as device_id,
       case when event_id % 11 = 0 then x when event_id % 13 = 0 then 0e0 else y end as lat,
       case when event_id % 11 = 0 then y when event_id % 13 = 0 then 0e0 else x end as lon
from (select event_id, k, 126.934e0 + ((k * 7907) % 9973) * 1.13e-5 + (event_id % 2) * 1e-4 as x,
             37.512e0 + ((k * 104723) % 9967) * 0.9e-5 as y
      from (select event_id, cast(floor(event_id / 2) as bigint) as k from {events}) u) t
""",
    "fx_facilities": """
select s_suppkey as facility_id, s_name as facility_name,
       case when s_nationkey < 20 then ' 서울특별시 ' else '부산광역시' end as sido,
       case when s_suppkey % 9 = 0 then 'FAIL' else 'OK' end as status,
       126.934e0 + ((s_suppkey * 7907) % 9973) * 1.13e-5 as lon, 37.512e0 + ((s_suppkey * 104723) % 9967) * 0.9e-5 as lat,
       126.934e0 + ((s_suppkey * 7907) % 9973) * 1.13e-5 + 0.001e0 as lon2, 37.512e0 + ((s_suppkey * 104723) % 9967) * 0.9e-5 + 0.0005e0 as lat2
from {supplier}
""",
    "fx_planar_points": """
select 'M' || cast(k as string) as mgrnu,
       950000.41e0 + (k * 6700417) % 9973 + 7 * (event_id % 2) as x, 1946000.83e0 + (k * 2147483) % 9967 as y
from (select event_id, cast(floor(event_id / 2) as bigint) as k from {events}) t
""",
}

TABLES = ("customer", "orders", "supplier", "part", "lineitem", "events")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = SQL[name]
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def duckdb_sql(name: str) -> str:
    return "(" + SQL[name].format(**{t: t for t in TABLES}).strip() + ")"
