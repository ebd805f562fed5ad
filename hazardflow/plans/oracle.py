"""Standard SQL for the catalogue, over the same base tables. Written apart from the operators."""

from __future__ import annotations

from hazardflow.plans.views import view_sql

# Quantities are stated here again, on purpose: this file checks the operators.
RAIN_FILL = 125
TIME_RANGE = "time >= timestamp '2024-01-05 00:00:00' and time < timestamp '2024-01-25 00:00:00'"

FEATURES = {
    "rain_water_interaction": "rainfall_mm * water_level_m",
    "discharge_waterlevel": "river_discharge * water_level_m",
    "rainfall_discharge": "rainfall_mm * river_discharge",
    "discharge_per_rain": "river_discharge / nullif(rainfall_mm + 1, 0)",
    "elevation_water_ratio": "elevation_m / nullif(water_level_m + cast(0.1 as double), 0)",
    "humidity_temp_ratio": "humidity_pct / nullif(temperature_c + 1, 0)",
    "flood_risk_index": "rainfall_mm / 100 * cast(0.3 as double)"
    " + water_level_m / 10 * cast(0.3 as double)"
    " + river_discharge / 1000 * cast(0.2 as double)"
    " + historical_floods / 10 * cast(0.2 as double)",
    "critical_rainfall": "case when rainfall_mm > 150 then 1 else 0 end",
    "critical_water": "case when water_level_m > 8 then 1 else 0 end",
    "low_elevation": "case when elevation_m < 50 then 1 else 0 end",
    "high_discharge": "case when river_discharge > 2000 then 1 else 0 end",
    "extreme_event": "case when rainfall_mm > 200 or water_level_m > 10"
    " or river_discharge > 3000 then 1 else 0 end",
}
READING_COLUMNS = [
    "reading_id", "location_id", "rainfall_mm", "water_level_m", "river_discharge",
    "elevation_m", "temperature_c", "humidity_pct", "population_density",
    "historical_floods", "infrastructure", "land_cover", "soil_type", "processing_time",
    "flood_occurred",
]
NUMERIC = [
    "rainfall_mm", "water_level_m", "river_discharge", "elevation_m", "temperature_c",
    "humidity_pct", "population_density", "historical_floods", "infrastructure",
    "flood_occurred",
]
MODEL_FEATURES = [
    "rainfall_mm", "water_level_m", "river_discharge", "elevation_m", "historical_floods",
    "rain_water_interaction", "discharge_per_rain", "flood_risk_index", "extreme_event",
]
# The order of the columns in the view.
READING_ORDER = [
    "reading_id", "location_id", "rainfall_mm", "water_level_m", "river_discharge",
    "elevation_m", "temperature_c", "humidity_pct", "population_density",
    "historical_floods", "infrastructure", "land_cover", "soil_type", "processing_time",
    "flood_occurred",
]
PAIRED = ["ELEV", "SLP", "EVT", "EVH", "EVC", "CBD", "CBH", "CC"]
SERIES = "location_id, location_name, alert_level, field"


def _named(exprs: dict[str, str]) -> str:
    return ", ".join(f'{e} as "{n}"' for n, e in exprs.items())


def _with(**parts: str) -> str:
    return "with " + ",\n".join(f"{n} as ({q})" for n, q in parts.items()) + "\n"


def _features(names: list[str]) -> str:
    picked = {n: FEATURES[n] for n in names}
    return _with(readings=view_sql("readings")) + f"select reading_id, {_named(picked)} from readings"


def _scored(fill_sql: str | None = None) -> dict[str, str]:
    """Readings filled, with features, stand-in score and level."""
    fill_sql = fill_sql or (
        f"select * replace (coalesce(rainfall_mm, {RAIN_FILL}) as rainfall_mm) from readings"
    )
    return {
        "readings": view_sql("readings"),
        "filled": fill_sql,
        "featured": f"select *, {_named(FEATURES)} from filled",
        "rated": "select *, case when flood_risk_index > 2 then 1 else flood_risk_index / 2 end"
        " as prob_flood from featured",
        "judged": "select *, case when prob_flood > 0.5 then 1 else 0 end as prediction from rated",
        "scored": "select *, case when prediction = 1 then case"
        " when prob_flood > cast(0.9 as double) then 'CRITICAL'"
        " when prob_flood > cast(0.7 as double) then 'HIGH' else 'MODERATE' end"
        " else 'LOW' end as alert_level,"
        " case when prediction = 1 then case when prob_flood > cast(0.9 as double) then 4"
        " when prob_flood > cast(0.7 as double) then 3 else 2 end else 1 end as alert_level_num"
        " from judged",
    }


def _from_scored(select: str) -> str:
    return _with(**_scored()) + select


ENRICHED = {
    "locations": view_sql("locations"),
    "enriched": "select s.*, coalesce(l.lat, 0.0::double) as latitude,"
    " coalesce(l.lon, 0.0::double) as longitude,"
    " coalesce(l.name, 'Unknown') as location_name"
    " from scored s left join locations l on s.location_id = l.location_id",
}
POINT_INTS = [
    "prediction", "alert_level_num", "elevation_m", "extreme_event", "critical_rainfall",
    "critical_water", "low_elevation", "high_discharge",
]
POINT_DOUBLES = {
    "probability": "prob_flood", "flood_risk_index": "flood_risk_index", "latitude": "latitude",
    "longitude": "longitude", "rainfall_mm": "rainfall_mm", "water_level_m": "water_level_m",
    "river_discharge": "river_discharge", "temperature_c": "temperature_c",
    "humidity_pct": "humidity_pct",
}


def _points(extra: str) -> str:
    ints = _named({n: f"cast(trunc(coalesce({n}, 0)) as bigint)" for n in POINT_INTS})
    doubles = _named({n: f"coalesce({s}, 0.0::double)" for n, s in POINT_DOUBLES.items()})
    return (
        f"select {extra}, 'flood_prediction' as measurement, location_id, alert_level,"
        f" location_name, {ints}, {doubles}, processing_time as time from enriched"
    )


def _point_parts() -> dict[str, str]:
    return {**_scored(), **ENRICHED, "points": _points("reading_id")}


def _points_long() -> str:
    each = " union all ".join(
        f"select location_id, location_name, alert_level, '{f}' as field,"
        f" cast({f} as double) as value, time from points"
        for f in [*POINT_INTS, *POINT_DOUBLES]
    )
    return (
        _with(**_point_parts(), long=each)
        + f"select {SERIES}, count(value) as n, min(value) as low, max(value) as high,"
        f" max(time) as last_time from long group by {SERIES}"
    )


def _points_dedup() -> str:
    return (
        _with(
            **_point_parts(),
            ranked="select *, row_number() over (partition by measurement, location_id,"
            " alert_level, location_name, time order by reading_id desc) as place from points",
        )
        + "select * exclude (place) from ranked where place = 1"
    )


def _points_compacted() -> str:
    """The last of three batches that brought an identity has it; in a batch, the last reading."""
    return (
        _with(
            **_point_parts(),
            batched="select *, cast('0x' || substr(md5(reading_id), 1, 4) as int) % 3 as batch from points",
            ranked="select *, row_number() over (partition by measurement, location_id,"
            " alert_level, location_name, time order by batch desc, reading_id desc) as place from batched",
        )
        + "select * exclude (place, batch) from ranked where place = 1"
    )


def _from_long(select: str, **more: str) -> str:
    return _with(long=view_sql("points_long"), **more) + select


def _last(field: str) -> str:
    return (
        f"select {SERIES}, arg_max(value, time) as value from long"
        f" where field = '{field}' group by {SERIES}"
    )


WINDOWS = (
    "select location_id, location_name,"
    " time_bucket(interval '6 hours', time) + interval '6 hours' as time,"
    " avg(value) as mean_value from long where field = 'probability' group by 1, 2, 3"
)


def _null_profile() -> str:
    each = " union all ".join(
        f"select '{c}' as \"column\", count(*) - count({c}) as nulls,"
        f" (count(*) - count({c})) * cast(100 as double) / count(*) as pct from readings"
        for c in READING_COLUMNS
    )
    return _with(readings=view_sql("readings"), counted=each) + (
        'select "column", cast(nulls as bigint) as nulls, pct from counted where nulls > 0'
    )


def _numeric_summary() -> str:
    derived = [
        "critical_rainfall", "critical_water", "low_elevation", "high_discharge",
        "extreme_event", "flood_risk_index",
    ]
    each = " union all ".join(
        f"select '{c}' as \"column\", count({c}) as n, round(avg(cast({c} as double)), 7) as mean,"
        f" round(stddev_samp(cast({c} as double)), 6) as stddev,"
        f" min(cast({c} as double)) as min, max(cast({c} as double)) as max from wide"
        for c in [*NUMERIC, *derived]
    )
    wide = f"select *, {_named({n: FEATURES[n] for n in derived})} from readings"
    return _with(readings=view_sql("readings"), wide=wide) + each


def _ingest_summary() -> str:
    nulls = " + ".join(
        f"case when count({c}) < count(*) then 1 else 0 end" for c in READING_COLUMNS
    )
    return _with(readings=view_sql("readings")) + (
        f"select count(*) as rows, {len(READING_COLUMNS)} as columns,"
        f" {len(NUMERIC)} as numeric_columns, {nulls} as null_columns from readings"
    )


NUMERIC_TEXT = "regexp_full_match(frp, '[0-9]+(\\.[0-9]+)?')"


def _cleaning_report() -> str:
    def side(stage: str, where: str) -> str:
        return (
            f"select '{stage}' as stage, count(*) as rows, cast(2 as bigint) as columns,"
            " cast((case when count(fire_id) < count(*) then 1 else 0 end)"
            " + (case when count(frp) < count(*) then 1 else 0 end) as bigint) as null_columns"
            f" from dirty {where}"
        )

    return (
        _with(
            dirty=view_sql("dirty_frp"),
            b=side("before", ""),
            a=side("after", f"where {NUMERIC_TEXT}"),
        )
        + "select * from b union all select * from a union all"
        " select 'removed', b.rows - a.rows, b.columns - a.columns,"
        " b.null_columns - a.null_columns from b, a"
    )


def _fill_one(view: str, key: str, fills: dict[str, str], rest: str = "") -> str:
    cols = _named({c: f"coalesce({c}, {e})" for c, e in fills.items()})
    return _with(t=view_sql(view)) + f"select {key}, {cols}{rest} from t"


def _median(c: str, t: str = "t") -> str:
    return f"(select quantile_disc({c}, 0.5) from {t})"


def _mode(c: str, t: str = "t") -> str:
    return (
        f"(select {c} from {t} where {c} is not null group by {c}"
        f" order by count(*) desc, cast({c} as varchar) limit 1)"
    )


def _clean_fire() -> str:
    weather = {
        "TEMP_ave": "mean", "TEMP_min": "mean", "TEMP_max": "mean", "PRCP": "0", "SNOW": "0",
        "WDIR_ave": "mean", "WSPD_ave": "mean", "PRES_ave": "mean", "WCOMP": "mean",
    }
    filled = _named(
        {
            c: f'coalesce("{c}", ' + (f'(select avg("{c}") from raw)' if how == "mean" else how) + ")"
            for c, how in weather.items()
        }
    )
    return (
        _with(
            dirty=view_sql("dirty_frp"),
            weather=view_sql("zone_weather"),
            raw="select fire_id as zone, frp, weather.* exclude (zone)"
            " from dirty left join weather on fire_id = weather.zone",
        )
        + f"select zone, cast(frp as double) as frp, {filled} from raw where {NUMERIC_TEXT}"
    )


def _normalize_names() -> str:
    kept = [
        c for c in READING_COLUMNS if c not in ("processing_time", "location_id", "infrastructure")
    ]
    return _with(readings=view_sql("readings")) + f"select {', '.join(kept)} from readings"


SAFE_INT = (
    "coalesce(try_cast(case when isfinite({0}) then trunc({0}) end as bigint), 0)".format(
        "try_cast(frp as double)"
    )
)


def _decode() -> str:
    return _with(payloads=view_sql("payloads"), ok="""
        select case when json_valid(value) then value end as j from payloads
    """) + """
        select j->>'a' as a,
          case when json_type(j, '$.n') in ('BIGINT', 'UBIGINT') then cast(j->>'n' as int) end as n,
          case when json_type(j, '$.d') in ('BIGINT', 'UBIGINT', 'DOUBLE')
            then cast(j->>'d' as double) end as d
        from ok
    """


def _zonal(variables: list[str], stats: list[str]) -> str:
    make = {
        "max": "max({0})", "min": "min({0})", "median": "median({0})", "sum": "sum({0})",
        "count": "count({0})", "mean": "avg({0})",
        "mode": "(list(u.m_{0}))[1]",
    }
    modes = [v.lower() for v in variables] if "mode" in stats else []
    parts = {"cells": view_sql("cells")}
    for v in modes:
        parts[f"mode_{v}"] = (
            f"select zone, arg_min({v}, (-n, {v})) as m from"
            f" (select zone, {v}, count(*) as n from cells where {v} is not null"
            f" group by zone, {v}) c group by zone"
        )
    plain = _named(
        {f"{v}_{s}": make[s].format(v.lower()) for v in variables for s in stats if s != "mode"}
    )
    parts["plain"] = f"select zone, {plain} from cells group by zone"
    joins = "".join(f" left join mode_{v} on plain.zone = mode_{v}.zone" for v in modes)
    extra = "".join(f', mode_{v}.m as "{v.upper()}_mode"' for v in modes)
    return _with(**parts) + f"select plain.*{extra} from plain{joins}"


def _fire_features() -> str:
    aggs = ", ".join(
        f"max({v.lower()}) as {v}_max, min({v.lower()}) as {v}_min, avg({v.lower()}) as {v}_mean"
        for v in PAIRED
    )
    near = ", ".join(f"n.{v}_mean as near_{v}" for v in PAIRED)
    out: dict[str, str] = {}
    guard = "cast(0.000001 as double)"
    for v in ("ELEV", "SLP"):
        out[f"{v}_ratio"] = f"{v}_mean / nullif(near_{v} + {guard}, 0)"
    out |= {
        "fire_weather_index": '"TEMP_max" * "WSPD_ave" / nullif("PRCP" + 1, 0)',
        "dryness_index": '"TEMP_ave" / nullif("PRCP" + 1, 0)',
        "veg_temp_interaction": '"CH_median" * "TEMP_max"',
        "lat_lon_interaction": "c_latitude * c_longitude",
    }
    for v in PAIRED:
        out[f"{v}_diff"] = f"{v}_mean - near_{v}"
        out[f"{v}_ratio"] = f"{v}_mean / nullif(near_{v} + {guard}, 0)"
        out[f"{v}_range"] = f"{v}_max - {v}_min"
        out[f"{v}_mean_sum"] = f"{v}_mean + near_{v}"
    return (
        _with(
            cells=view_sql("cells"),
            weather=view_sql("zone_weather"),
            stats=f'select zone, {aggs}, median(ch) as "CH_median" from cells group by zone',
            wide=f"select s.*, {near}, w.* exclude (zone) from stats s"
            " join weather w on s.zone = w.zone left join stats n on n.zone = s.zone + 1",
        )
        + f"select zone, {_named({n: f'round({e}, 6)' for n, e in out.items()})} from wide"
    )


FRP_CLASS = (
    "case when cast(v as double) < 800 then 0 when v < 1500 then 1 when v >= 1500 then 2 end"
)
DIRTY_VALUE = {
    "dirty": view_sql("dirty_frp"),
    "valued": "select *, try_cast(frp as double) as v from dirty",
}


FIRE_ROWS = {
    "fires": view_sql("fires"),
    "weather": view_sql("zone_weather"),
    "rows_": "select f.fire_id, f.zone as place, w.*, coalesce(\"PRCP\", 0) as wet,"
    f" {FRP_CLASS} as cls from (select *, try_cast(frp as double) as v from fires) f"
    " left join weather w on f.zone = w.zone",
}


def _fire_points() -> str:
    return (
        _with(**FIRE_ROWS)
        + """
        select fire_id, 'fire_prediction' as measurement,
          'ZONE_' || cast(place as varchar) as location_id,
          case when cls = 2 then 'HIGH' when cls = 1 then 'MEDIUM' else 'LOW' end as alert_level,
          cast(coalesce(cls, 0) as bigint) as prediction,
          cast(case when cls = 2 then 3 when cls = 1 then 2 else 1 end as bigint)
            as alert_level_num,
          coalesce("TEMP_max" * "WSPD_ave" / nullif(wet + 1, 0), 0.0::double)
            as fire_weather_index,
          coalesce("TEMP_ave" / nullif(wet + 1, 0), 0.0::double) as dryness_index,
          coalesce(c_latitude, 0) as latitude, coalesce(c_longitude, 0) as longitude,
          timestamp '2024-01-01 00:00:00' as time
        from rows_
        """
    )


def _measured_predictions() -> str:
    return (
        _with(**_point_parts(), **FIRE_ROWS)
        + "select location_id, location_name, alert_level, 'prediction' as field,"
        " count(*) as predictions, measurement from points group by all"
        " union all select 'ZONE_' || cast(place as varchar), null,"
        " case when cls = 2 then 'HIGH' when cls = 1 then 'MEDIUM' else 'LOW' end,"
        " 'prediction', count(*), 'fire_prediction' from rows_ group by all"
    )


PART = (
    f"case when {{p}} < cast(0.7 as double) then 'train'"
    f" when {{p}} < cast(0.85 as double) then 'validation' else 'test' end"
)


def _training_rows() -> str:
    """The fills leave no model feature empty, so every row is usable."""
    return (
        _with(
            readings=view_sql("readings"),
            placed=f"select flood_occurred, {_position()} as p from readings",
        )
        + f"select {PART.format(p='p')} as part, count(*) as rows,"
        " cast(sum(flood_occurred) as bigint) as floods, count(*) as usable from placed group by 1"
    )


def _report_sections() -> str:
    names = {
        "parameter": [
            "numTrees", "maxDepth", "minInstancesPerNode", "maxBins", "featureSubsetStrategy",
            "subsamplingRate", "seed",
        ],
        "feature": [str(i) for i in range(1, len(MODEL_FEATURES) + 1)],
        "importance": MODEL_FEATURES,
    }
    measured = ["accuracy", "weighted_precision", "weighted_recall", "weighted_f1", "auc"]
    names |= {"metric:validation": measured, "metric:test": measured}
    return " union all ".join(
        f"select '{section}' as section, '{n}' as name" for section, ns in names.items() for n in ns
    )


def _score_all_rows() -> str:
    cols = {c: FEATURES.get(c, c) for c in MODEL_FEATURES}
    usable = " and ".join(f"{c} is not null" for c in MODEL_FEATURES)
    return (
        _with(readings=view_sql("readings"), x=f"select {_named(cols)} from readings")
        + f"select count(*) as rows, count(*) filter (where {usable}) as scored,"
        f" count(*) filter (where not ({usable})) as unscored,"
        " cast(0 as bigint) as changed_by_reload, cast(0 as bigint) as no_probability from x"
    )


MESSAGE_PART = "cast(cast('0x' || substr(md5(reading_id), 1, 4) as int) % 4 as int)"


def _column_listing() -> str:
    kinds = " ".join(
        f"when '{duck}' then '{spark}'"
        for duck, spark in (
            ("VARCHAR", "string"), ("DOUBLE", "double"), ("INTEGER", "int"),
            ("BIGINT", "bigint"), ("TIMESTAMP", "timestamp_ntz"),
        )
    )
    order = " ".join(f"when '{c}' then {i}" for i, c in enumerate(READING_ORDER, 1))
    return (
        f"select case column_name {order} end as position, column_name as \"column\","
        f" case column_type {kinds} end as type from (describe {view_sql('readings')})"
    )


def _fire_stream() -> str:
    index = '"TEMP_max" * "WSPD_ave" / nullif(coalesce("PRCP", 0) + 1, 0)'
    return (
        _with(
            weather=view_sql("zone_weather"),
            indexed=f'select *, {index} as fwi, "TEMP_ave" / nullif(coalesce("PRCP", 0) + 1, 0)'
            " as dry from weather",
            judged="select *, case when fwi >= 100 then 2 when fwi >= 20 then 1 else 0 end as cls"
            " from indexed",
        )
        + """
        select 'fire_prediction' as measurement,
          'ZONE_' || cast(zone as varchar) as location_id,
          case cls when 2 then 'HIGH' when 1 then 'MEDIUM' else 'LOW' end as alert_level,
          cast(cls as bigint) as prediction, cast(cls + 1 as bigint) as alert_level_num,
          coalesce(fwi, 0.0::double) as fire_weather_index,
          coalesce(dry, 0.0::double) as dryness_index,
          c_latitude as latitude, c_longitude as longitude
        from judged
        """
    )


def _position() -> str:
    return "cast(('0x' || substr(md5('42:' || reading_id), 1, 8)) as bigint) / 4294967296.0::double"


def _split(edges: list[tuple[str, str]], last: str) -> str:
    tests = " ".join(f"when p < cast({e} as double) then '{n}'" for n, e in edges)
    return (
        _with(
            readings=view_sql("readings"),
            placed=f"select reading_id, {_position()} as p from readings",
        )
        + f"select reading_id, case {tests} else '{last}' end as part from placed"
    )


def _standardize() -> str:
    names = ["water_level_m", "river_discharge", "elevation_m", "historical_floods"]
    z = _named({f"{n}_z": f"round(({n} - m_{n}) / s_{n}, 6)" for n in names})
    stats = ", ".join(f"avg({n}) as m_{n}, stddev_samp({n}) as s_{n}" for n in names)
    return (
        _with(readings=view_sql("readings"), stats=f"select {stats} from readings")
        + f"select reading_id, {z} from readings, stats"
    )


CONFUSION = (
    "select cast(flood_occurred as double) as label, cast(prediction as double) as prediction,"
    " count(*) as n from scored group by 1, 2"
)


def _metrics() -> str:
    return (
        _with(
            **_scored(),
            pairs=CONFUSION,
            total="select sum(n) as t from pairs",
            actual="select label as c, sum(n) as a from pairs group by label",
            predicted="select prediction as c, sum(n) as p from pairs group by prediction",
            hits="select label as c, sum(n) as h from pairs where label = prediction group by 1",
            per_class="select a / t as w, coalesce(h, 0) / coalesce(nullif(p, 0), 1) as prec,"
            " coalesce(h, 0) / a as rec from actual left join predicted using (c)"
            " left join hits using (c), total",
        )
        + "select round((select sum(h) from hits) / (select t from total), 8) as accuracy,"
        " round(sum(w * prec), 8) as weighted_precision, round(sum(w * rec), 8) as weighted_recall,"
        " round(sum(case when prec + rec > 0 then w * 2 * prec * rec / (prec + rec) else 0 end), 8)"
        " as weighted_f1 from per_class"
    )


def _auc() -> str:
    return (
        _with(
            **_scored(),
            usable="select prob_flood as s, flood_occurred as y from scored"
            " where prob_flood is not null",
            ranked="select y, rank() over (order by s)"
            " + (count(*) over (partition by s) - 1) / 2.0::double as r from usable",
            sums="select sum(r) as rs, cast(count(*) as double) as n from ranked where y = 1",
            neg="select cast(count(*) as double) as m from ranked where y = 0",
        )
        + "select round((rs - n * (n + 1) / 2) / (n * m), 8) as auc from sums, neg"
    )


def _console(extra: str = "") -> str:
    return _from_scored(
        f"select {extra}round(avg(rainfall_mm), 6) as avg_rainfall,"
        " round(max(rainfall_mm), 6) as max_rainfall,"
        " round(avg(water_level_m), 6) as avg_water_level,"
        " round(max(water_level_m), 6) as max_water_level,"
        " round(avg(temperature_c), 6) as avg_temperature from scored"
    )


TOP_RISK = (
    "select reading_id, location_id, alert_level, flood_risk_index, rainfall_mm, water_level_m"
    " from scored where prediction = 1 order by flood_risk_index desc, reading_id limit 10"
)


def _flood_pipeline() -> str:
    medians = [
        "rainfall_mm", "temperature_c", "humidity_pct", "river_discharge", "water_level_m",
        "elevation_m", "population_density", "historical_floods", "infrastructure",
    ]
    fills = [f"coalesce({c}, {_median(c, 'readings')}) as {c}" for c in medians]
    fills += [f"coalesce({c}, {_mode(c, 'readings')}) as {c}" for c in ("land_cover", "soil_type")]
    fill_sql = f"select * replace ({', '.join(fills)}) from readings"
    return _with(**_scored(fill_sql)) + TOP_RISK


def _layer_counts() -> str:
    return " union all ".join(
        f"select '{t}' as layer, count(*) as rows from {t}"
        for t in ("lineitem", "orders", "events", "documents", "labels")
    )


def _ml_dataset() -> str:
    cols = {c: FEATURES.get(c, c) for c in [*MODEL_FEATURES, "flood_occurred"]}
    return _with(readings=view_sql("readings")) + f"select {_named(cols)} from readings"


def _model_input() -> str:
    cols = {c: FEATURES.get(c, c) for c in MODEL_FEATURES}
    return (
        _with(
            readings=view_sql("readings"),
            x=f"select reading_id, {_named(cols)} from readings",
        )
        + "select * from x where "
        + " and ".join(f"{c} is not null" for c in MODEL_FEATURES)
    )


def _land_stream() -> str:
    return _with(readings=view_sql("readings")) + (
        "select location_id, temperature_c, rainfall_mm, humidity_pct,"
        " river_discharge as river_discharge_m3s, water_level_m,"
        " cast(elevation_m as int) as elevation_m,"
        " cast(population_density as int) as population_density, historical_floods,"
        " cast(infrastructure as varchar) as infrastructure, soil_type, land_cover,"
        ' reading_id as "timestamp" from readings'
    )


HIGH = (
    "select reading_id, location_id, alert_level, prob_flood from scored"
    " where alert_level in ('CRITICAL', 'HIGH')"
)

def _alert_map(where: str) -> str:
    return _with(
        all_points=view_sql("points_long"),
        long=f"select * from all_points where {where}",
        **{
            f: f"select location_id, arg_max(value, time) as v from long where field = '{f}'"
            " group by location_id"
            for f in ("latitude", "longitude", "alert_level_num")
        },
    ) + (
        "select latitude.location_id, latitude.v as latitude, longitude.v as longitude,"
        " alert_level_num.v as alert_level_num from latitude"
        " join longitude on latitude.location_id = longitude.location_id"
        " join alert_level_num on latitude.location_id = alert_level_num.location_id"
    )


# Points are at most an hour late, and a location is silent after a day.
HEARD = (
    "location_id in (select location_id from all_points"
    " where field in ('latitude', 'longitude', 'alert_level_num') group by location_id"
    " having max(time) >= (select max(time) from all_points"
    " where field in ('latitude', 'longitude', 'alert_level_num'))"
    " - interval '1 hour' - interval '1 day')"
)

ORACLE: dict[str, str] = {
    "flood_pipeline": _flood_pipeline(),
    "null_profile": _null_profile(),
    "null_total": _with(t=view_sql("sparse_labels"))
    + "select cast(sum("
    + " + ".join(
        f"case when {c} is null then 1 else 0 end"
        for c in ("doc_id", "lang", "source", "n_chars", "quality", "toxic")
    )
    + ") as bigint) as null_total from t",
    "impute_median": _fill_one(
        "readings",
        "reading_id",
        {c: _median(c) for c in ("rainfall_mm", "population_density")},
    ),
    "impute_mode": _fill_one(
        "readings", "reading_id", {c: _mode(c) for c in ("land_cover", "soil_type")}
    ),
    "impute_mean": _fill_one(
        "zone_weather",
        "zone",
        {f'"{c}"': f'(select avg("{c}") from t)' for c in ("WDIR_ave", "PRES_ave", "TEMP_min")},
    ).replace('""', '"'),
    "impute_constant": _fill_one(
        "zone_weather", "zone", {'"PRCP"': "0", '"SNOW"': "0"}
    ).replace('""', '"'),
    "impute_labels": _with(t=view_sql("sparse_labels"))
    + f"select doc_id, lang, source, n_chars, coalesce(quality, {_mode('quality')}) as quality,"
    f" coalesce(toxic, {_median('toxic')}) as toxic from t",
    "numeric_summary": _numeric_summary(),
    "ingest_summary": _ingest_summary(),
    "cleaning_report": _cleaning_report(),
    "numeric_text_filter": _with(t=view_sql("dirty_frp"))
    + f"select fire_id, cast(frp as double) as frp from t where {NUMERIC_TEXT}",
    "numeric_text_report": _with(t=view_sql("dirty_frp"))
    + f"select count(*) as total, count(*) filter (where {NUMERIC_TEXT}) as kept,"
    f" count(*) - count(*) filter (where {NUMERIC_TEXT}) as removed from t",
    "drop_invalid": _with(t=view_sql("sparse_labels"))
    + "select * from t where n_chars is not null and quality is not null and toxic is not null",
    "model_input": _model_input(),
    "clean_fire": _clean_fire(),
    "normalize_names": _normalize_names(),
    "safe_casts": _with(t=view_sql("dirty_frp"))
    + f"select fire_id, {SAFE_INT} as whole,"
    " coalesce(try_cast(frp as double), 0.0::double) as fraction from t",
    "cast_frp": _with(t=view_sql("dirty_frp"))
    + "select fire_id, try_cast(frp as double) as frp from t",
    "local_to_utc": _with(readings=view_sql("readings"))
    + "select reading_id, processing_time,"
    " timezone('UTC', timezone('Africa/Casablanca', processing_time)) as utc_time from readings",
    "decode_payload": _decode(),
    "flood_interactions": _features(
        ["rain_water_interaction", "discharge_waterlevel", "rainfall_discharge"]
    ),
    "flood_ratios": _features(
        ["discharge_per_rain", "elevation_water_ratio", "humidity_temp_ratio"]
    ),
    "flood_risk": _features(["flood_risk_index"]),
    "flood_flags": _features(
        ["critical_rainfall", "critical_water", "low_elevation", "high_discharge", "extreme_event"]
    ),
    "flood_ml_dataset": _ml_dataset(),
    "zonal_stats": _zonal(
        [*PAIRED, "CH"], ["max", "min", "median", "sum", "mode", "count", "mean"]
    ),
    "zonal_totals": _zonal(["ELEV", "CC"], ["max", "min", "sum", "count", "mean"]),
    "fire_target": _with(**DIRTY_VALUE)
    + f"select fire_id, frp, {FRP_CLASS} as frp_class from valued",
    "fire_features": _fire_features(),
    "flood_alerts": _from_scored(
        "select reading_id, prob_flood, prediction, alert_level, alert_level_num,"
        " alert_level as label from scored"
    ),
    "fire_alerts": _with(
        **DIRTY_VALUE, classed=f"select fire_id, {FRP_CLASS} as prediction from valued"
    )
    + "select fire_id, prediction, case prediction when 2 then 'HIGH' when 1 then 'MEDIUM'"
    " else 'LOW' end as alert_level, case prediction when 2 then 3 when 1 then 2 else 1 end"
    " as alert_level_num from classed",
    "high_alerts": _from_scored(HIGH),
    "enrich_location": _with(**_scored(), **ENRICHED)
    + "select reading_id, location_id, latitude, longitude, location_name from enriched",
    "points": _with(**_point_parts()) + "select * from points",
    "fire_points": _fire_points(),
    "points_long": _points_long(),
    "points_dedup": _points_dedup(),
    "measured_predictions": _measured_predictions(),
    "stored_points": _from_long(
        "select * from long where time >= timestamp '2024-01-05 00:00:00'"
        " and time < timestamp '2024-01-07 00:00:00'"
    ),
    "alert_map": _alert_map("true"),
    "alert_map_range": _alert_map(TIME_RANGE),
    "time_range": _from_long(f"select * from long where {TIME_RANGE}"),
    "latest_values": _from_long(
        "select location_id, field, arg_max(value, time) as value, max(time) as time"
        " from long group by location_id, field"
    ),
    "field_points": _from_long("select * from long where field = 'probability'"),
    "prediction_count": _from_long(
        f"select {SERIES}, count(value) as predictions from long where field = 'prediction'"
        f" group by {SERIES}"
    ),
    "prediction_total": _from_long(
        "select count(value) as predictions from long where field = 'prediction'"
    ),
    "mean_probability": _from_long(
        f"select {SERIES}, round(avg(value), 10) as mean_probability from long"
        f" where field = 'probability' group by {SERIES}"
    ),
    "extreme_series": _from_long(
        "select count(*) as extreme_series from ends where value = 1",
        ends=_last("extreme_event"),
    ),
    "level_distribution": _from_long(
        "select alert_level, count(*) as series from ends group by alert_level",
        ends=_last("alert_level_num"),
    ),
    "windowed_mean": _from_long(
        "select location_id, location_name, time, round(mean_value, 10) as mean_value from w",
        w=WINDOWS,
    ),
    "series_legend": _from_long(
        "select location_id, location_name, round(avg(mean_value), 10) as mean,"
        " round(max(mean_value), 10) as max, round(arg_max(mean_value, time), 10) as last"
        " from w group by location_id, location_name",
        w=WINDOWS,
    ),
    "class_distribution": _with(readings=view_sql("readings"))
    + "select flood_occurred, count(*) as n from readings group by flood_occurred",
    "target_distribution": _with(t=view_sql("dirty_frp"))
    + "select frp, count(*) as n from t group by frp",
    "prediction_overview": _from_scored(
        "select count(*) as total, count(*) filter (where prediction = 1) as positive,"
        " count(*) filter (where prediction <> 1) as negative,"
        " count(*) filter (where prediction = 1) * 100.0::double / count(*) as positive_pct,"
        " count(*) filter (where prediction <> 1) * 100.0::double / count(*) as negative_pct"
        " from scored"
    ),
    "alert_distribution": _from_scored(
        "select alert_level, count(*) as n,"
        " count(*) * 100.0::double / (select count(*) from scored) as pct"
        " from scored group by alert_level"
    ),
    "condition_stats": _console(),
    "console_summary": _console(
        "count(*) as total, count(*) filter (where prediction = 1) as positive, "
    ),
    "layer_counts": _layer_counts(),
    "top_risk": _from_scored(TOP_RISK),
    "latest_predictions": _from_scored(
        "select reading_id, location_id, prediction, alert_level, flood_risk_index,"
        " processing_time from scored order by processing_time desc, reading_id limit 10"
    ),
    "latest_alerts": _from_scored(
        "select reading_id, location_id, alert_level, rainfall_mm, water_level_m,"
        " processing_time from scored where alert_level in ('CRITICAL', 'HIGH')"
        " order by processing_time desc, reading_id limit 5"
    ),
    "split_three": _split([("train", "0.7"), ("validation", "0.85")], "test"),
    "split_two": _split([("train", "0.8")], "test"),
    "standardize": _standardize(),
    "confusion_matrix": _from_scored(CONFUSION),
    "classification_metrics": _metrics(),
    "auc": _auc(),
    "sample_check": "select cast(10 as bigint) as rows, cast(0 as bigint) as strangers",
    "column_listing": _column_listing(),
    "training_rows": _training_rows(),
    "report_sections": _report_sections(),
    "score_all_rows": _score_all_rows(),
    "fire_training_rows": _with(fires=view_sql("fires"))
    + f"select {FRP_CLASS} as frp_class, count(*) as fires"
    f" from (select cast(frp as double) as v from fires where {NUMERIC_TEXT}) group by 1",
    "importance_total": " union all ".join(
        f"select '{f}' as feature, 1.0::double as total" for f in MODEL_FEATURES
    ),
    "replay_flood": _with(readings=view_sql("readings"), placed=f"select {_position()} as p from readings")
    + f"select count(*) as rows, cast(0 as bigint) as differ from placed where {PART.format(p='p')} != 'train'",
    "replay_fire": "select true as scored, cast(0 as bigint) as differ",
    "importance_ranks": f"select cast({len(MODEL_FEATURES)} as bigint) as features,"
    f" cast({len(MODEL_FEATURES)} as bigint) as ranks, cast(0 as bigint) as differ",
    "csv_by_name": _ml_dataset(),
    "csv_unparsed": _with(t=view_sql("dirty_frp"))
    + "select 'fire_id' as \"column\", cast(0 as bigint) as unparsed union all select 'frp',"
    " count(*) filter (where frp is not null and try_cast(frp as double) is null) from t",
    "layer_round_trip": _with(readings=view_sql("readings")) + "select * from readings",
    "gold_csv": _ml_dataset(),
    "multiline_csv": "select doc_id, cast(length(text) as int) as n, md5(text) as digest"
    " from documents",
    "land_stream": _land_stream(),
    "score_flood_stream": _with(
        **_scored(), **ENRICHED, points=_points('reading_id as "timestamp"')
    )
    + "select * exclude (time) from points",
    "points_identity_stream": _with(**_scored(), **ENRICHED)
    + "select distinct location_id, alert_level, location_name, cast(1 as bigint) as points,"
    " cast(1 as bigint) as stamps from enriched",
    "rate_limited_stream": _with(readings=view_sql("readings"))
    + f"select {MESSAGE_PART} as part, count(*) as rows, cast(1 as bigint) as batches,"
    " cast(1 as bigint) as stamps from readings group by 1",
    "triggered_stream": _with(readings=view_sql("readings"))
    + "select count(*) as rows, cast(4 as bigint) as batches, cast(0 as bigint) as early from readings",
    "restarted_stream": _with(readings=view_sql("readings"))
    + f"select reading_id, {MESSAGE_PART} as part from readings",
    "alerts_stream": _from_scored(HIGH),
    "alerts_once_stream": _from_scored(
        "select distinct location_id, strftime(processing_time, '%Y-%m-%d %H:%M:%S') as event,"
        " cast(1 as bigint) as alerts from scored where alert_level in ('CRITICAL', 'HIGH')"
    ),
    "score_fire_stream": _fire_stream(),
    "windowed_mean_stream": _with(
        long=view_sql("points_long"),
        p="select * from long where field = 'probability'",
        w="select location_id, location_name,"
        " time_bucket(interval '1 day', time) + interval '1 day' as time,"
        " avg(value) as m from p group by 1, 2, 3",
    )
    + "select location_id, location_name, time, round(m, 10) as mean_value from w",
    "alert_map_stream": _alert_map(HEARD),
    "points_compacted": _points_compacted(),
    "windowed_mean_rollup": _from_long(
        "select location_id, location_name, time, round(mean_value, 10) as mean_value from w",
        w=WINDOWS,
    ),
}
