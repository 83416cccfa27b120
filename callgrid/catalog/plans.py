"""Whole tables and reports."""

from pyspark.sql import functions as F

from ..operators import features as ft
from ..plans import demand, demand_features, dictionary, incident, incident_features
from ..sources.scratch import checkpointed
from .base import INCIDENTS, query
from .joins import _DEMAND
from .text import URGENCY_SQL
from .windows import _delayed_sql


@query(
    "hourly_station_demand",
    f"""
    WITH {INCIDENTS}, {_DEMAND},
    a AS (SELECT date_trunc('hour', time_created) AS h, station_name, cast(sum(m_required::int) AS bigint) AS r, cast(sum(m_sent::int) AS bigint) AS s
          FROM incidents GROUP BY ALL)
    SELECT strftime(h, '%Y-%m-%d %H:%M:%S') || '_' || station_name AS pk_demand, strftime(h, '%Y-%m-%d %H:%M:%S') AS time_created, station_name,
           year(h) AS time_year, month(h) AS time_month, day(h) AS time_day, hour(h) AS time_hour, coalesce(n, 0) AS total_incidents,
           coalesce(trns, 0) AS trns_to_hosp, coalesce(r, 0) AS m_required, coalesce(s, 0) AS m_sent
    FROM spine LEFT JOIN agg USING (station_name, h) LEFT JOIN a USING (station_name, h)
    """,
)
def _(t):
    return demand.demand_table(t.incidents, t.incidents, *demand.observed_hours(t.incidents))


@query(
    "daily_samples_with_lags",
    f"""
    WITH {INCIDENTS}, {_DEMAND},
    d AS (SELECT cast(h AS date) AS day, station_name, cast(sum(coalesce(trns, 0)) AS bigint) AS y, round(avg(coalesce(n, 0)), 6) AS total_incidents
          FROM spine LEFT JOIN agg USING (station_name, h) GROUP BY ALL)
    SELECT strftime(d.day, '%Y-%m-%d') AS day, d.station_name, d.y AS trns_to_hosp, d.total_incidents,
           strftime(d.day, '%Y-%m-%d %H:%M:%S') || '_' || d.station_name AS demand_key,
           coalesce(a.y, 0) AS trns_to_hosp_lag1, coalesce(b.y, 0) AS trns_to_hosp_lag7
    FROM d LEFT JOIN d a ON a.station_name = d.station_name AND a.day = d.day - 1 LEFT JOIN d b ON b.station_name = d.station_name AND b.day = d.day - 7
    """,
)
def _(t):
    table = demand.demand_table(t.incidents, t.incidents, *demand.observed_hours(t.incidents))
    return demand.daily_samples(table, sums=["trns_to_hosp"], means=["total_incidents"])


def _incident_inputs(t):
    """Orders as dispatched incidents, order lines as units, documents as comments."""
    word = F.array(*[F.lit(c) for c in ("TRAN1", "NCT", "AST", "DONE", "HT")])
    incidents = t.orders.select(
        F.concat(F.lit("E"), F.col("o_orderkey").cast("string")).alias("i_eventnumber"),
        F.col("o_orderdate").alias("i_ttimecreate"),
        (F.col("o_orderdate") + F.expr("interval 2 hours")).alias("i_ttimeclosed"),
        F.col("o_orderpriority").alias("i_kcallsource"),
        F.col("o_orderstatus").alias("i_callerphonetype"),
        (F.col("o_custkey") % 5).alias("i_kdisposition1"),
        (((F.col("o_orderkey") * 7919 + F.col("o_custkey")) % 10007) / 1000.0).alias("x"),
        (((F.col("o_custkey") * 104729 + F.col("o_orderkey")) % 10009) / 1000.0).alias("y"),
    )
    dispositions = t.region.select(
        F.col("r_regionkey").alias("idi_disposition_pk"),
        F.get(word, F.col("r_regionkey")).alias("idi_dispositioncode"),
        F.col("r_name").alias("idi_dispositiontext"),
    )
    units = t.lineitem.select(
        F.concat(F.lit("E"), F.col("l_orderkey").cast("string")).alias("i_eventnumber"),
        F.concat(F.substr(F.lit("MEXA"), (F.col("l_suppkey") % 4 + 1).cast("int"), F.lit(1)), F.lpad((F.col("l_suppkey") % 100).cast("string"), 2, "0")).alias("pun_unitid"),
    )
    code = F.when(F.col("o_custkey") % 10 == 0, "FADV").otherwise(
        F.concat(F.lpad((F.col("o_custkey") % 35).cast("string"), 2, "0"), F.lit("B"), (F.col("o_orderkey") % 3).cast("string"))
    )
    reports = t.orders.select(
        F.concat(F.lit("E"), F.col("o_orderkey").cast("string")).alias("i_eventnumber"),
        F.concat(F.lit("op"), (F.col("o_custkey") % 17).cast("string")).alias("poc_operatorname"),
        F.when(F.col("o_orderstatus") == "F", "by CF/2").otherwise("CP/9").alias("ico_comment"),
        code.alias("iti_typeid"),
        F.col("o_orderpriority").alias("iti_typetext"),
    )
    named = t.part.withColumn(
        "code", F.concat((F.col("p_partkey") % 35).cast("string"), F.lit("B"), (F.col("p_partkey") % 3).cast("string"))
    )
    codes = named.groupBy("code").agg(
        F.min("p_type").alias("incident_type"),
        F.when(F.min("p_partkey") % 2 == 0, "E1 MT").otherwise("E1").alias("compliment"),
    )
    return incidents, dispositions, units, reports, codes


def _incident_table(t, **more):
    places = t.areas.select(F.concat(F.lit("S"), F.col("area").cast("string")).alias("station_name"), "ring")
    groups = t.areas.select(F.col("area").cast("string").alias("geoid"), "ring")
    return incident.incident_table(*_incident_inputs(t), stations=places, block_groups=groups, start="1996-01-01", **more)


_TABLE = """
    o AS (SELECT *, ((o_orderkey * 7919 + o_custkey) % 10007) / 1000.0::double AS x, ((o_custkey * 104729 + o_orderkey) % 10009) / 1000.0::double AS y,
                 cast(o_custkey % 35 AS varchar) || 'B' || cast(o_orderkey % 3 AS varchar) AS dispatch_code
          FROM orders WHERE o_orderdate >= '1996-01-01' AND o_custkey % 10 <> 0),
    mt AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_suppkey % 4 IN (0, 3)),
    dict AS (SELECT (p_partkey % 35) || 'B' || (p_partkey % 3) AS code, min(p_type) AS kind, min(p_partkey) % 2 = 0 AS mt FROM part GROUP BY 1),
    incident_table AS (
      SELECT 'E' || o_orderkey AS incident, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS time_created,
             strftime(o_orderdate + INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS time_closed, year(o_orderdate) AS time_year, month(o_orderdate) AS time_month,
             day(o_orderdate) AS time_day, hour(o_orderdate) AS time_hour, o_orderpriority AS call_source, o_orderstatus AS call_type,
             'op' || (o_custkey % 17) AS operator_name, CASE WHEN o_orderstatus = 'F' THEN 'by CF/2' ELSE 'CP/9' END AS dispatch_comment,
             CASE WHEN o_custkey % 35 < 10 THEN dispatch_code ELSE dispatch_code END AS dispatch_code, o_orderpriority AS dispatch_text, kind AS dispatch_type,
             cast(o_custkey % 35 AS varchar) AS code_type, 'B' AS code_level, cast(o_orderkey % 3 AS varchar) AS code_rest,
             CASE WHEN x < 10 AND y < 10 THEN cast(cast(floor(x / 2) + 5 * floor(y / 2) AS bigint) AS varchar) END AS geoid,
             CASE WHEN x < 10 AND y < 10 THEN 'S' || cast(floor(x / 2) + 5 * floor(y / 2) AS bigint) END AS station_name,
             (o_custkey % 5 IN (0, 1) OR (o_custkey % 5 = 4 AND r_name NOT LIKE '%NO%'))::int AS trns_to_hosp,
             CASE WHEN o_orderstatus = 'F' THEN 'CF' ELSE 'CP' END AS operator_agency,
             (l_orderkey IS NOT NULL)::int AS m_sent, coalesce(mt, false)::int AS m_required
      FROM o JOIN region ON r_regionkey = o_custkey % 5 LEFT JOIN mt ON l_orderkey = o_orderkey LEFT JOIN dict ON code = dispatch_code)
"""


@query(
    "incident_table",
    f"WITH {_TABLE} SELECT * FROM incident_table",
)
def _(t):
    return _incident_table(t).drop("x", "y", "comments", *incident.PATIENT_COLUMNS.values())


@query(
    "incident_demand",
    f"""
    WITH {_TABLE} SELECT time_year, station_name, count(*) AS n, cast(sum(m_sent) AS bigint) AS m_sent, cast(sum(m_required) AS bigint) AS m_required
    FROM incident_table WHERE station_name IS NOT NULL GROUP BY ALL
    """,
)
def _(t):
    from ..functions.base import count_if

    rows = _incident_table(t).where("station_name is not null")
    return rows.groupBy("time_year", "station_name").agg(
        F.count("*").alias("n"), count_if("m_sent").alias("m_sent"), count_if("m_required").alias("m_required")
    )


@query(
    "patient_care_of_events",
    """
    SELECT 'E' || o_orderkey AS incident, string_agg(s_name, ' | ' ORDER BY s_name) AS comments FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1
    """,
)
def _(t):
    return incident.patient_care(t.orders.select(_event("o_orderkey").alias("incident")), _care(t))[0]


def _event(c):
    return F.concat(F.lit("E"), F.col(c).cast("string"))


def _care(t):
    """Order lines as cases, suppliers as comments and parts as patients."""
    return {
        "t_incident": t.orders.select(_event("o_orderkey").alias("INCIDENTN"), F.col("o_orderkey").alias("KEY_INCIDENT")),
        "t_case": t.lineitem.select(
            F.col("l_orderkey").alias("KEY_INCIDENT"), F.col("l_suppkey").alias("KEY_CASE"), F.col("l_partkey").alias("KEY_PATIENT")
        ),
        "t_comment": t.supplier.select(F.col("s_suppkey").alias("KEY_CASE"), F.col("s_name").alias("COMMENTTEXT")),
        "t_patient": t.part.select(
            F.col("p_partkey").alias("KEY_PATIENT"), F.col("p_brand").alias("GENDERCODE"), F.col("p_size").alias("AGE"),
            F.col("p_type").alias("RACECODE"), F.col("p_name").alias("POSTCODE"),
        ),
    }


@query(
    "patients_of_events",
    """
    SELECT 'E' || o_orderkey AS incident, max(p_brand) AS pt_gender, max(p_size) AS pt_age, max(p_type) AS pt_race, max(p_name) AS pt_postcode
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey GROUP BY 1
    """,
)
def _(t):
    return incident.patient_care(t.orders.select(_event("o_orderkey").alias("incident")), _care(t))[1]


@query(
    "incident_table_with_care",
    f"""
    WITH {_TABLE},
    c AS (SELECT 'E' || l_orderkey AS incident, string_agg(s_name, ' | ' ORDER BY s_name) AS comments
          FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1),
    p AS (SELECT 'E' || l_orderkey AS incident, max(p_brand) AS pt_gender, max(p_size) AS pt_age, max(p_type) AS pt_race, max(p_name) AS pt_postcode
          FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1)
    SELECT * FROM incident_table LEFT JOIN c USING (incident) LEFT JOIN p USING (incident)
    """,
)
def _(t):
    return _incident_table(t, care=_care(t)).drop("x", "y")


_FEATURES = [
    {"name": "weekday", "type": "cat", "deps": ["time_created"]},
    {"name": "time_weekend", "type": "bool", "deps": ["time_created"]},
    {"name": "time_of_day", "type": "cat", "deps": ["time_created"]},
    {"name": "is_holiday", "type": "bool"},
    {"name": "building_type", "type": "cat", "deps": ["call_type"]},
    {"name": "station_name", "type": "cat"},
    {"name": "operator_experience", "type": "float"},
    {"name": "total_transports_1day_bystation", "type": "float"},
    {"name": "lag_24h_station_incidents", "type": "float"},
    {"name": "value", "type": "float", "incl": False},
]

_FEATURE_SQL = f"""
    WITH {INCIDENTS}, d AS (SELECT cast(time_created AS date) AS day, station_name, sum(trns_to_hosp::int) AS v FROM incidents GROUP BY ALL)
    SELECT incident, isodow(time_created) - 1 AS weekday, (isodow(time_created) > 5)::int AS time_weekend,
           CASE WHEN hour(time_created) BETWEEN 7 AND 12 THEN '7a-1p' WHEN hour(time_created) BETWEEN 13 AND 18 THEN '1p-7p'
                WHEN hour(time_created) >= 19 OR hour(time_created) = 0 THEN '7p-1a' ELSE '1a-7a' END AS time_of_day,
           (cast(time_created AS date) IN ('2024-01-01', '2024-01-15'))::int AS is_holiday,
           CASE WHEN event_type = 'view' THEN 'other' ELSE event_type END AS building_type, i.station_name,
           row_number() OVER (PARTITION BY operator_name ORDER BY time_created, incident) - 1 AS operator_experience,
           cast(coalesce((SELECT v FROM d WHERE d.station_name = i.station_name
                AND d.day = greatest(cast(time_created AS date) - 1, DATE '2024-01-01')), 0) AS bigint) AS total_transports_1day_bystation,
           count(*) OVER (PARTITION BY i.station_name ORDER BY time_created range BETWEEN INTERVAL 24 HOUR PRECEDING
                AND INTERVAL 1 MICROSECOND PRECEDING) AS lag_24h_station_incidents
    FROM incidents i
"""


def _feature_rows(t):
    return t.incidents.withColumn("call_type", F.when(F.col("event_type") != "view", F.col("event_type")))


@query("feature_table", _FEATURE_SQL)
def _(t):
    specs, _ = ft.load_specs(_FEATURES)
    return incident_features.INCIDENT_FEATURES.apply(_feature_rows(t), specs, "incident")


@query(
    "feature_types",
    """
    SELECT event_type AS name, CASE WHEN event_type = 'view' THEN 'cat' ELSE 'float' END AS type FROM (SELECT DISTINCT event_type FROM events)
    """,
)
def _(t):
    specs = [ft.FeatureSpec("view", "cat")]
    return ft.column_types(t.events.select(F.col("event_type").alias("name")).distinct(), specs)


_WEATHER_SQL = """
    w AS (SELECT cast(ts AS date) AS day, coalesce(avg(value) FILTER (event_type = 'view'), 0) AS tmax,
                 coalesce(avg(value) FILTER (event_type = 'click'), 0) AS tmin, coalesce(avg(value) FILTER (event_type = 'purchase'), 0) AS prcp,
                 coalesce(avg(value) FILTER (event_type = 'error'), 0) AS hail, coalesce(avg(value) FILTER (event_type = 'signup'), 0) AS rain,
                 max(value) FILTER (event_type = 'view') >= 90 AS above, min(value) FILTER (event_type = 'click') <= 25 AS below FROM events GROUP BY 1),
    weather AS (SELECT w.*, w.tmax - (SELECT b.tmax FROM w b WHERE b.day = greatest(w.day - 7, DATE '2024-01-01')) AS more,
                       w.tmin - (SELECT b.tmin FROM w b WHERE b.day = greatest(w.day - 7, DATE '2024-01-01')) AS less,
                       EXISTS (SELECT 1 FROM events e WHERE e.value > 300 AND abs(date_diff('day', cast(e.ts AS date), w.day)) <= 1) AS moon FROM w)
"""
_WEATHER_COLUMNS = """
           round(tmax, 5) AS common_weather_tmax, round(tmin, 5) AS common_weather_tmin, round(prcp, 5) AS common_weather_prcp,
           round(hail, 5) AS weather_event_hail, round(rain, 5) AS weather_event_rain, above::int AS temp_above, below::int AS temp_below,
           round(more, 5) AS relative_max_temperature, round(less, 5) AS relative_min_temperature, moon::int AS within_1day_full_moon
"""
_WEATHER_NAMES = [
    "common_weather_tmax", "common_weather_tmin", "common_weather_prcp", "weather_event_hail", "weather_event_rain", "temp_above", "temp_below",
    "relative_max_temperature", "relative_min_temperature", "within_1day_full_moon",
]


def _sky(t):
    """Events as measurements, each type a kind, and the highest as full moons."""
    kinds = F.create_map(*[F.lit(x) for x in ("view", "TMAX", "click", "TMIN", "purchase", "PRCP", "error", "WT05", "signup", "WT16")])
    weather = t.events.select(F.to_date("ts").alias("date"), kinds[F.col("event_type")].alias("datatype"), "value")
    moon = t.events.select(F.to_date("ts").alias("date"), F.when(F.col("value") > 300, "Full Moon").otherwise("none").alias("phase"))
    return {"weather": weather, "weather_kinds": ["TMAX", "TMIN", "PRCP"], "moon": moon}


@query(
    "weather_and_moon_features",
    f"""
    WITH {INCIDENTS}, {_WEATHER_SQL}
    SELECT incident, {_WEATHER_COLUMNS} FROM incidents JOIN weather ON day = cast(time_created AS date)
    """,
    digits=5,
)
def _(t):
    names = ["common_weather", "weather_event", "temp_above", "temp_below", "relative_max_temperature", "relative_min_temperature", "within_1day_full_moon"]
    specs, _ = ft.load_specs([{"name": n} for n in names])
    return incident_features.INCIDENT_FEATURES.apply(t.incidents, specs, "incident", _sky(t)).select("incident", *_WEATHER_NAMES)


@query(
    "demand_feature_table",
    f"""
    WITH {INCIDENTS}, {_DEMAND}, {_WEATHER_SQL},
    r AS (SELECT date_trunc('hour', time_created) AS h, station_name, cast(sum(m_required::int) AS bigint) AS r FROM incidents GROUP BY ALL)
    SELECT strftime(h, '%Y-%m-%d %H:%M:%S') || '_' || station_name AS pk_demand, station_name, isodow(h) - 1 AS weekday, (isodow(h) > 5)::int AS time_weekend,
           CASE WHEN hour(h) BETWEEN 7 AND 12 THEN '7a-1p' WHEN hour(h) BETWEEN 13 AND 18 THEN '1p-7p'
                WHEN hour(h) >= 19 OR hour(h) = 0 THEN '7p-1a' ELSE '1a-7a' END AS time_of_day,
           year(h) AS time_year, month(h) AS time_month, day(h) AS time_day, coalesce(r, 0) AS m_required, coalesce(trns, 0) AS trns_to_hosp,
           {_WEATHER_COLUMNS}
    FROM spine LEFT JOIN agg USING (station_name, h) LEFT JOIN r USING (station_name, h) JOIN weather w ON w.day = cast(h AS date)
    """,
    digits=5,
)
def _(t):
    rows = demand.demand_table(t.incidents, t.incidents, *demand.observed_hours(t.incidents))
    found = demand_features.demand_features(rows, _sky(t))
    names = ["pk_demand", "station_name", "weekday", "time_weekend", "time_of_day", "time_year", "time_month", "time_day", "m_required", "trns_to_hosp"]
    return found.select(*names, *_WEATHER_NAMES)


def _feature_days(t):
    """Samples from a stored feature table, as models are trained from one."""
    rows = checkpointed(demand.demand_table(t.incidents, t.incidents, *demand.observed_hours(t.incidents)))
    found = checkpointed(demand_features.demand_features(rows, _sky(t), store=False))
    days, names = demand_features.daily_feature_samples(rows, found)
    return checkpointed(days), names


@query(
    "daily_feature_samples",
    f"""
    WITH {INCIDENTS}, {_DEMAND}, {_WEATHER_SQL},
    r AS (SELECT date_trunc('hour', time_created) AS h, station_name, cast(sum(m_required::int) AS bigint) AS r FROM incidents GROUP BY ALL),
    d AS (SELECT cast(h AS date) AS day, station_name, cast(sum(coalesce(trns, 0)) AS bigint) AS y, cast(sum(coalesce(r, 0)) AS bigint) AS r
          FROM spine LEFT JOIN agg USING (station_name, h) LEFT JOIN r USING (station_name, h) GROUP BY ALL)
    SELECT strftime(d.day, '%Y-%m-%d') AS day, d.station_name, d.y AS trns_to_hosp, d.r AS m_required, coalesce(a.y, 0) AS trns_to_hosp_lag1,
           coalesce(b.y, 0) AS trns_to_hosp_lag7, (isodow(d.day) - 1)::double AS weekday, (isodow(d.day) > 5)::double AS time_weekend,
           round(tmax, 5) AS common_weather_tmax, above::double AS temp_above, round(more, 5) AS relative_max_temperature,
           round(hail, 5) AS weather_event_hail, round(rain, 5) AS weather_event_rain
    FROM d JOIN weather w ON w.day = d.day LEFT JOIN d a ON a.station_name = d.station_name AND a.day = d.day - 1
    LEFT JOIN d b ON b.station_name = d.station_name AND b.day = d.day - 7
    """,
    digits=5,
)
def _(t):
    return _feature_days(t)[0].select(
        "day", "station_name", "trns_to_hosp", "m_required", "trns_to_hosp_lag1", "trns_to_hosp_lag7", "weekday", "time_weekend",
        "common_weather_tmax", "temp_above", "relative_max_temperature", "weather_event_hail", "weather_event_rain",
    )


@query("regressor_metrics_features", digits=4)
def _(t):
    from ..plans.training import run_regressors

    days, names = _feature_days(t)
    return run_regressors(days, "trns_to_hosp", names, first_year=2013, grid={"LASSO": {"alpha": [0.01, 0.1]}, "LINEAR": {}})


_DELAYED = {
    "frac_trans_1day": ("avg(trns_to_hosp::int)", 1, 1, None, "double"),
    "frac_trans_1week": ("avg(trns_to_hosp::int)", 7, 1, None, "double"),
    "total_transports_1month": ("sum(trns_to_hosp::int)", 1, 30, None, "bigint"),
    "total_transports_lastweek_bystation": ("sum(trns_to_hosp::int)", 1, 7, "station_name", "bigint"),
    "total_transports_lastweek_bycode": ("sum(trns_to_hosp::int)", 1, 7, "code_type", "bigint"),
}


def _delayed_parts() -> tuple[str, str, str]:
    """CTEs, joins and columns of the delayed features."""
    ctes, joined, columns = [], [], []
    for i, (name, (agg, days, roll, group, kind)) in enumerate(_DELAYED.items()):
        sql = _delayed_sql(agg, days, roll, group)
        for word in ("daily", "known"):
            sql = sql.replace(f"{word} ", f"{word}{i} ")
        ctes.append(sql.replace("m AS (", f"m{i} AS (").replace(" q, m)", f" q, m{i} m)").replace("FROM daily)", f"FROM daily{i})"))
        on = f"k{i}.day = cast(time_created AS date)" + (f" AND k{i}.{group} = i.{group}" if group else "")
        joined.append(f"JOIN known{i} k{i} ON {on}")
        columns.append(f"round(k{i}.delayed, 6)::{kind} AS {name}")
    return ", ".join(ctes), " ".join(joined), ", ".join(columns)


_CTES, _JOINS, _COLUMNS = _delayed_parts()
_STATION_WINDOWS = """
    WINDOW d AS (PARTITION BY i.station_name ORDER BY time_created range BETWEEN INTERVAL 24 HOUR PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING),
           w AS (PARTITION BY i.station_name ORDER BY time_created range BETWEEN INTERVAL 168 HOUR PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING),
           l AS (PARTITION BY operator_name % 10, k % 5 ORDER BY time_created range BETWEEN INTERVAL 24 HOUR PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)
"""


@query(
    "feature_table_trailing",
    f"""
    WITH {INCIDENTS}, {_CTES},
    hourly AS (SELECT date_trunc('hour', time_created) AS h, cast(sum(trns_to_hosp::int) AS bigint) AS v FROM incidents GROUP BY 1)
    SELECT incident, {_COLUMNS}, coalesce(h.v, 0) AS total_transports_lasthour, count(*) OVER l AS repeated_loc_24h,
           cast(coalesce(sum(trns_to_hosp::int) OVER d, 0) AS bigint) AS lag_24h_station_trns, count(*) OVER w AS lag_1w_station_incidents,
           cast(coalesce(sum(trns_to_hosp::int) OVER w, 0) AS bigint) AS lag_1w_station_trns, round(k % 90 + 0.5, 6)::double AS incident_duration,
           (trns_to_hosp OR k % 7 = 0)::int AS trns_or_refused
    FROM incidents i {_JOINS} LEFT JOIN hourly h ON h.h = date_trunc('hour', time_created) - INTERVAL 1 HOUR
    {_STATION_WINDOWS}
    """,
)
def _(t):
    rows = t.incidents.withColumns(
        {
            "x": F.col("operator_name") % 10,
            "y": F.col("k") % 5,
            "time_closed": F.col("time_created") + F.expr("make_dt_interval(0, 0, cast(k % 90 as int), 30)"),
            "comments": F.when(F.col("k") % 7 == 0, "patient refusal at scene").when(F.col("k") % 7 == 1, "moved"),
        }
    )
    names = [*_DELAYED, "total_transports_lasthour", "repeated_loc_24h", "lag_24h_station_trns", "lag_1w_station_incidents", "lag_1w_station_trns"]
    names += ["incident_duration", "trns_or_refused"]
    specs, _ = ft.load_specs([{"name": n} for n in names])
    out = incident_features.INCIDENT_FEATURES.apply(rows, specs, "incident")
    whole = [c for c in names if c.startswith(("total", "lag", "repeated"))]
    return out.withColumns({c: F.col(c).cast("bigint") for c in whole})


# each census table has the sums of prices by order status; names of measures, first years, and how the parts make them up
_CENSUS_SQL = {
    "acs_income": (1997, "f"), "acs_age": (1997, "f"), "acs_no_insurance": (2000, "(4 * f)"), "acs_edu": (1999, "(4 * f)"),
    "acs_white": (1997, "f"), "acs_black": (1997, "o"),
}


def _census_column(name: str, floor: int, part: str) -> str:
    value = part if name in ("acs_income", "acs_age") else f"{part} / total"
    return f"""round((SELECT CASE WHEN total > 0 THEN {value} END FROM ref WHERE nation = c_nationkey
               AND y = greatest(year(o_orderdate) - 2, {floor})), 5) AS {name}"""


@query(
    "census_features",
    f"""
    WITH ref AS (SELECT year(o_orderdate) AS y, c_nationkey AS nation, sum(o_totalprice) AS total,
                        coalesce(sum(o_totalprice) FILTER (o_orderstatus = 'F'), 0) AS f, coalesce(sum(o_totalprice) FILTER (o_orderstatus = 'O'), 0) AS o
                 FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
    SELECT o_orderkey AS incident, {', '.join(_census_column(n, *v) for n, v in _CENSUS_SQL.items())}
    FROM orders JOIN customer ON o_custkey = c_custkey
    """,
    digits=5,
)
def _(t):
    facts = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    # years are moved on so that the census years of the features apply
    year = F.year("o_orderdate") + 13
    status = lambda s: F.sum(F.when(F.col("o_orderstatus") == s, F.col("o_totalprice")).otherwise(0.0))
    sums = facts.groupBy(year.alias("year"), F.concat(F.lit("15000US"), F.col("c_nationkey").cast("string")).alias("geoid")).agg(
        F.sum("o_totalprice").alias("total"), status("F").alias("f"), status("O").alias("o")
    )
    census = {}
    for table, _, parts, total in incident_features.CENSUS.values():
        have = census.get(table, sums)
        part = "o" if parts == ["b02001003"] else "f"
        have = have.withColumns({p: F.col(part) for p in parts})
        census[table] = have.withColumn(total, F.col("total")) if total else have
    rows = facts.select(F.col("o_orderkey").alias("incident"), year.alias("time_year"), F.col("c_nationkey").cast("string").alias("geoid"))
    specs, _ = ft.load_specs([{"name": n} for n in _CENSUS_SQL])
    return incident_features.INCIDENT_FEATURES.apply(rows, specs, "incident", {"census": census})


_CODES = f"""
    y AS (SELECT *, year(o_orderdate) AS ty, cast(o_custkey % 35 AS varchar) AS code_type, (o_custkey % 35) || 'B' || (o_custkey % 2) AS dispatch_code,
                 o_totalprice > 250000 AS trns FROM orders),
    tr AS (SELECT dispatch_code, code_type, avg(trns::int) AS f FROM y WHERE ty IN (1997, 1998) GROUP BY ALL),
    te AS (SELECT dispatch_code, code_type, avg(trns::int) AS f, count(*) AS n FROM y WHERE ty = 1999 GROUP BY ALL),
    sg AS (SELECT dispatch_code, {URGENCY_SQL} AS urgency, f FROM tr),
    dict AS (SELECT dispatch_code, te.code_type, te.f, te.n, urgency, te.code_type::int % 2 = 0 AS old,
                    CASE WHEN urgency = 'high' THEN true WHEN urgency = 'medium' THEN sg.f * 3 - (1 - sg.f) > sg.f * -3 + (1 - sg.f)
                         WHEN urgency = 'low' THEN sg.f - (1 - sg.f) > -sg.f + (1 - sg.f) * 1.7 ELSE sg.f - (1 - sg.f) > -sg.f + (1 - sg.f) END AS new
             FROM te JOIN sg USING (dispatch_code))
"""


def _dictionary(t):
    code = F.concat((F.col("o_custkey") % 35).cast("string"), F.lit("B"), (F.col("o_custkey") % 2).cast("string"))
    rows = t.orders.select(
        F.year("o_orderdate").alias("time_year"),
        code.alias("dispatch_code"),
        (F.col("o_custkey") % 35).cast("string").alias("code_type"),
        (F.col("o_totalprice") > 250000).alias("trns_to_hosp"),
        ((F.col("o_custkey") % 35) % 2 == 0).alias("m_required"),
    )
    return dictionary.dispatch_dictionary(rows, (1997, 1998), (1999, 1999), codes=["dispatch_code", "code_type"])


@query(
    "dispatch_dictionary",
    f"""
    WITH {_CODES} SELECT dispatch_code, code_type, round(f, 6) AS frac_trans, n AS n_incidents, old::int AS mt_required, urgency, new::int AS mt_suggested
    FROM dict
    """,
)
def _(t):
    return _dictionary(t)


@query(
    "dispatch_dictionary_effects",
    f"""
    WITH {_CODES}
    SELECT 'old' AS rule, round(sum(n * f) FILTER (old) / sum(n), 6) AS tp, round(sum(n * f) FILTER (NOT old) / sum(n), 6) AS fn,
           round(sum(n * (1 - f)) FILTER (old) / sum(n), 6) AS fp, round(sum(n * (1 - f)) FILTER (NOT old) / sum(n), 6) AS tn FROM dict
    UNION ALL
    SELECT 'new', round(coalesce(sum(n * f) FILTER (new), 0) / sum(n), 6), round(coalesce(sum(n * f) FILTER (NOT new), 0) / sum(n), 6),
           round(coalesce(sum(n * (1 - f)) FILTER (new), 0) / sum(n), 6), round(coalesce(sum(n * (1 - f)) FILTER (NOT new), 0) / sum(n), 6) FROM dict
    """,
)
def _(t):
    e = dictionary.effects(_dictionary(t))
    named = lambda key, rule: e[key].select(F.lit(rule).alias("rule"), "tp", "fn", "fp", "tn")
    return named("confusion_old", "old").unionByName(named("confusion_new", "new"))


@query(
    "dispatch_dictionary_changes",
    f"WITH {_CODES} SELECT dispatch_code, urgency, new::int AS mt_suggested FROM dict WHERE old <> new",
)
def _(t):
    return dictionary.effects(_dictionary(t))["changes"].select("dispatch_code", "urgency", "mt_suggested")
