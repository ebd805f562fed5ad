"""Hazard tables derived from the given test tables.

Each view is one SQL text valid in Spark and in DuckDB, so both engines start from the same
rows. Placeholders name the base tables. Decimal literals are cast to double: a bare one would
switch the arithmetic to decimals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# One flood reading per line item. The reading id joins the four key columns.
READINGS = """
select
  concat_ws('-', cast(l_orderkey as varchar(20)), cast(l_partkey as varchar(20)),
    cast(l_suppkey as varchar(20)), cast(l_linenumber as varchar(20))) as reading_id,
  concat('LOC_', lpad(cast(l_suppkey % 15 + 1 as varchar(20)), 3, '0')) as location_id,
  case when l_orderkey % 17 = 0 then null else l_discount * 2500 end as rainfall_mm,
  l_quantity * cast(0.3 as double) as water_level_m,
  l_extendedprice / 20 as river_discharge,
  cast(l_partkey % 800 as double) as elevation_m,
  l_linenumber * cast(5 as double) - 6 as temperature_c,
  30 + l_tax * 875 as humidity_pct,
  case when l_partkey % 31 = 0 then null else cast(l_suppkey * 3 as double) end
    as population_density,
  cast(l_orderkey % 16 as int) as historical_floods,
  cast(l_linenumber % 3 as int) as infrastructure,
  case when l_partkey % 23 = 0 then null when l_returnflag = 'A' then 'urban'
    when l_returnflag = 'N' then 'forest' else 'agricultural' end as land_cover,
  case when l_linestatus = 'F' then 'clay' else 'sandy' end as soil_type,
  l_shipdate + l_linenumber * interval '1' hour as processing_time,
  case when l_quantity * l_discount > cast(2.5 as double) then 1 else 0 end as flood_occurred
from {lineitem}
"""

# One land cell per line item, zoned by part. All values are whole numbers, so sums are exact.
CELLS = """
select l_partkey as zone,
  l_quantity * 20 as elev,
  cast(l_suppkey % 46 as double) as slp,
  cast(l_linenumber * 100 as double) as evt,
  cast(l_orderkey % 37 as double) as evh,
  cast((l_orderkey + l_suppkey) % 101 as double) as evc,
  cast(l_suppkey % 41 as double) as cbd,
  cast(l_orderkey % 29 as double) as cbh,
  case when l_orderkey % 19 = 0 then null else cast((l_partkey + l_orderkey) % 91 as double) end
    as cc,
  cast(l_orderkey % 53 as double) as ch
from {lineitem}
"""

# Weather, place and shape of a zone, from its part row; some readings are missing.
ZONE_WEATHER = """
select p_partkey as zone,
  cast(p_size % 25 as double) as `TEMP_ave`,
  cast(p_size % 10 as double) as `TEMP_min`,
  cast(p_size as double) as `TEMP_max`,
  case when p_partkey % 7 = 0 then null else cast(p_partkey % 5 - 1 as double) end as `PRCP`,
  case when p_partkey % 3 > 0 then null else cast(p_partkey % 4 as double) end as `SNOW`,
  case when p_partkey % 11 = 0 then null else cast(p_partkey * 7 % 360 as double) end
    as `WDIR_ave`,
  cast(p_partkey % 12 as double) as `WSPD_ave`,
  case when p_partkey % 13 = 0 then null else cast(900 + p_partkey % 100 as double) end
    as `PRES_ave`,
  cast(p_partkey % 8 as double) as `WCOMP`,
  cast(p_partkey % 60 as double) as c_latitude,
  cast(p_partkey % 90 as double) - 45 as c_longitude,
  cast(p_size * 100 as double) as `Shape`,
  cast(p_partkey % 2400 as double) as acq_time
from {part}
"""

# Dirty radiative power: text that may be missing, signed, cut short, or no number at all.
DIRTY_FRP = """
select o_orderkey as fire_id,
  case when o_orderkey % 13 = 0 then null
    when o_orderkey % 11 = 0 then 'n/a'
    when o_orderkey % 7 = 0 then concat('-', amount)
    when o_orderkey % 5 = 0 then concat(whole, '.')
    when o_orderkey % 9 = 0 then concat(' ', amount, ' ')
    else amount end as frp
from (
  select o_orderkey, whole, concat(whole, '.', lpad(cents, 2, '0')) as amount
  from (
    select o_orderkey,
      cast(cast(floor(o_totalprice) as bigint) % 2500 as varchar(20)) as whole,
      cast(o_orderkey % 100 as varchar(20)) as cents
    from {orders}
  ) digits
) amounts
"""

# Real missing values: labels cover only part of the documents.
SPARSE_LABELS = """
select d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
from {documents} d left join {labels} l on d.doc_id = l.doc_id
"""

# Message payloads, partly malformed.
PAYLOADS = """
select event_id,
  case event_id % 7
    when 0 then 'not json'
    when 1 then null
    when 2 then concat('{{"a":"', event_type, '","n":3.5,"d":1}}')
    when 3 then concat('{{"a":"', event_type, '","n":', id, ',"d":"oops"}}')
    when 4 then concat('{{"a":"', event_type, '","extra":1}}')
    else concat('{{"a":"', event_type, '","n":', id, ',"d":', id, '.5}}')
  end as value
from (
  select event_id, event_type, cast(event_id as varchar(20)) as id from {events}
) e
"""

# Long points of one measurement: one field per event type, one location per user, level tag
# from the payload.
POINTS_LONG = """
select
  'flood_prediction' as measurement,
  concat('LOC_', lpad(user_no, cast(greatest(6, length(user_no)) as int), '0')) as location_id,
  concat('Site ', user_no) as location_name,
  case when k < 25 then 'LOW' when k < 50 then 'MODERATE' when k < 75 then 'HIGH'
    else 'CRITICAL' end as alert_level,
  case event_id % 6
    when 0 then 'probability' when 1 then 'prediction' when 2 then 'extreme_event'
    when 3 then 'alert_level_num' when 4 then 'latitude' else 'longitude' end as field,
  case event_id % 6
    when 0 then value / 500
    when 1 then cast(k % 2 as double)
    when 2 then case when value > 20 then cast(1 as double) else cast(0 as double) end
    when 3 then cast(floor(k / 25.0) + 1 as double)
    else value end as value,
  ts as time
from (
  select event_id, cast(user_id as varchar(20)) as user_no, ts, value,
    cast(regexp_extract(props, '[0-9]+', 0) as int) as k
  from {events}
) e
"""

# Location dimension: a place for every second location number.
LOCATIONS = """
select concat('LOC_', lpad(site, cast(greatest(3, length(site)) as int), '0')) as location_id,
  cast(n_nationkey as double) + 20 as lat,
  cast(s_suppkey % 90 as double) - 45 as lon,
  concat(n_name, ' ', s_name) as name
from (
  select cast(s_suppkey * 2 + 1 as varchar(20)) as site, s_suppkey, s_name, s_nationkey
  from {supplier}
) s join {nation} on s_nationkey = n_nationkey
"""

# Fires: every order's radiative power, each in one of the zones.
FIRES = f"""
select fire_id, frp, fire_id % (select count(*) from {{part}}) + 1 as zone
from ({DIRTY_FRP}) dirty
"""

VIEWS = {
    "readings": (READINGS, ["lineitem"]),
    "cells": (CELLS, ["lineitem"]),
    "zone_weather": (ZONE_WEATHER, ["part"]),
    "dirty_frp": (DIRTY_FRP, ["orders"]),
    "sparse_labels": (SPARSE_LABELS, ["documents", "labels"]),
    "payloads": (PAYLOADS, ["events"]),
    "points_long": (POINTS_LONG, ["events"]),
    "fires": (FIRES, ["orders", "part"]),
    "locations": (LOCATIONS, ["supplier", "nation"]),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, name: str, tables: dict[str, DataFrame]) -> DataFrame:
    """The view over given base tables, which may be streaming."""
    return spark.sql(VIEWS[name][0], **tables)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view over the Parquet tables of a folder."""
    return derive(spark, name, {t: table(spark, sf_dir, t) for t in VIEWS[name][1]})


def view_sql(name: str) -> str:
    """The view as standard SQL over tables of the same names."""
    text, tables = VIEWS[name]
    return text.format(**{t: t for t in tables}).replace("`", '"')
