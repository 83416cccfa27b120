"""Regular series."""

from pyspark.sql import functions as F

from ..operators import series as s
from .base import INCIDENTS, query

_DAILY = "daily AS (SELECT cast(o_orderdate AS date) AS day, o_orderstatus AS g, count(*) AS n FROM orders GROUP BY ALL)"


def _daily(t):
    return t.orders.groupBy(F.to_date("o_orderdate").alias("day"), F.col("o_orderstatus").alias("g")).agg(F.count("*").alias("n"))


@query(
    "label_lags",
    f"""
    WITH {_DAILY}
    SELECT strftime(a.day, '%Y-%m-%d') AS day, a.g, a.n, coalesce(b.n, 0) AS n_lag1, coalesce(c.n, 0) AS n_lag7
    FROM daily a LEFT JOIN daily b ON b.g = a.g AND b.day = a.day - 1 LEFT JOIN daily c ON c.g = a.g AND c.day = a.day - 7
    """,
)
def _(t):
    return s.label_lags(_daily(t), "day", "g", "n")


@query(
    "lag1_predictor",
    f"""
    WITH {_DAILY}
    SELECT strftime(day, '%Y-%m-%d') AS day, g, n, pred FROM (SELECT *, lag(n) OVER (PARTITION BY g ORDER BY day) AS pred FROM daily)
    WHERE pred IS NOT NULL AND n <> 0
    """,
)
def _(t):
    return s.lag1_predictor(_daily(t), "g", "day", "n")


@query(
    "rolling_mean_daily",
    f"""
    WITH {_DAILY}, r AS (SELECT day, g, avg(n) OVER w AS mean, count(*) OVER w AS k FROM daily
                        WINDOW w AS (PARTITION BY g ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)),
    f AS (SELECT * FROM r WHERE k = 7),
    cal AS (SELECT g, unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS day FROM f GROUP BY g)
    SELECT g, strftime(cal.day, '%Y-%m-%d %H:%M:%S') AS t, round(coalesce(mean, 0), 6) AS mean FROM cal LEFT JOIN f USING (g, day)
    """,
)
def _(t):
    return s.rolling_mean_daily(t.orders.withColumnRenamed("o_orderstatus", "g"), "g", "o_orderdate")


@query(
    "regular_hourly_series",
    f"""
    WITH {INCIDENTS}, c AS (SELECT station_name, date_trunc('hour', time_created) AS t, count(*) AS n FROM incidents GROUP BY ALL),
    cal AS (SELECT station_name, unnest(generate_series(min(t), max(t), INTERVAL 1 HOUR)) AS t FROM c GROUP BY 1)
    SELECT station_name, strftime(t, '%Y-%m-%d %H:%M:%S') AS t, coalesce(n, 0) AS n FROM cal LEFT JOIN c USING (station_name, t)
    """,
)
def _(t):
    return s.regular_series(t.incidents, "time_created", "hour", "station_name")


_SERIES = """
    c AS (SELECT date_trunc('day', ts) AS t, count(*) AS n FROM events GROUP BY 1),
    series AS (SELECT t, coalesce(n, 0) AS n FROM (SELECT unnest(generate_series((SELECT min(t) FROM c), (SELECT max(t) FROM c), INTERVAL 1 DAY)) AS t)
               LEFT JOIN c USING (t))
"""


@query(
    "first_difference_and_back",
    f"""
    WITH {_SERIES}
    SELECT strftime(t, '%Y-%m-%d %H:%M:%S') AS t, n - lag(n) OVER (ORDER BY t) AS diff, n AS level FROM series
    QUALIFY lag(n) OVER (ORDER BY t) IS NOT NULL
    """,
)
def _(t):
    series = s.regular_series(t.events, "ts", "day")
    start = series.agg(F.min_by("n", "t").alias("n")).scalar()
    diff = s.first_difference(series, None, "t", "n").select("t", "diff", start.alias("start"))
    return s.integrate(diff, None, "t", "diff", "start").drop("start")


@query(
    "moving_average",
    f"""
    WITH {_SERIES}
    SELECT strftime(t, '%Y-%m-%d %H:%M:%S') AS t, n, round(sum(n) OVER (ORDER BY t ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING) / 7, 6) AS mean
    FROM series
    """,
)
def _(t):
    return s.moving_average(s.regular_series(t.events, "ts", "day"), None, "t", "n")


@query(
    "moving_average_in_stretches",
    f"""
    WITH {_SERIES}
    SELECT strftime(t, '%Y-%m-%d %H:%M:%S') AS t, n, round(sum(n) OVER (ORDER BY t ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING) / 7, 6) AS mean
    FROM series
    """,
)
def _(t):
    return s.moving_average(s.regular_series(t.events, "ts", "day"), None, "t", "n", stretch=5)


_ACF = """
    h AS (SELECT date_trunc('hour', ts) AS t, count(*) AS n FROM events GROUP BY 1),
    hs AS (SELECT row_number() OVER (ORDER BY t) AS i, coalesce(n, 0) AS n
           FROM (SELECT unnest(generate_series((SELECT min(t) FROM h), (SELECT max(t) FROM h), INTERVAL 1 HOUR)) AS t) LEFT JOIN h USING (t)),
    d AS (SELECT i, n - (SELECT avg(n) FROM hs) AS d FROM hs),
    acf AS (SELECT k AS lag, (SELECT sum(a.d * b.d) FROM d a JOIN d b ON b.i = a.i - k) / (SELECT sum(d * d) FROM d) AS acf
            FROM (SELECT unnest(range(41)) AS k))
"""


@query("autocorrelation", f"WITH {_ACF} SELECT lag, round(acf, 6) AS acf FROM acf")
def _(t):
    return s.acf(s.regular_series(t.events, "ts", "hour"), "t", "n")


@query("autocorrelation_in_stretches", f"WITH {_ACF} SELECT lag, round(acf, 6) AS acf FROM acf")
def _(t):
    return s.acf(s.regular_series(t.events, "ts", "hour"), "t", "n", stretch=100)


@query(
    "autocorrelation_per_group",
    f"""
    WITH {INCIDENTS}, c AS (SELECT station_name, date_trunc('hour', time_created) AS t, count(*) AS n FROM incidents GROUP BY ALL),
    cal AS (SELECT station_name, unnest(generate_series(min(t), max(t), INTERVAL 1 HOUR)) AS t FROM c GROUP BY 1),
    s AS (SELECT station_name, t, coalesce(n, 0) - avg(coalesce(n, 0)) OVER (PARTITION BY station_name) AS d FROM cal LEFT JOIN c USING (station_name, t)),
    v AS (SELECT station_name, sum(d * d) AS v FROM s GROUP BY 1),
    k AS (SELECT unnest(range(25)) AS k),
    p AS (SELECT a.station_name, k, sum(a.d * b.d) AS p FROM s a CROSS JOIN k JOIN s b ON b.station_name = a.station_name AND b.t = a.t - to_hours(k) GROUP BY ALL)
    SELECT station_name, k AS lag, round(p / v, 6) AS acf FROM p JOIN v USING (station_name)
    """,
)
def _(t):
    return s.acf(s.regular_series(t.incidents, "time_created", "hour", "station_name"), "t", "n", 24, "station_name")


@query(
    "autocorrelation_per_group_in_stretches",
    f"""
    WITH {INCIDENTS}, c AS (SELECT station_name, date_trunc('hour', time_created) AS t, count(*) AS n FROM incidents GROUP BY ALL),
    cal AS (SELECT station_name, unnest(generate_series(min(t), max(t), INTERVAL 1 HOUR)) AS t FROM c GROUP BY 1),
    s AS (SELECT station_name, t, coalesce(n, 0) - avg(coalesce(n, 0)) OVER (PARTITION BY station_name) AS d FROM cal LEFT JOIN c USING (station_name, t)),
    v AS (SELECT station_name, sum(d * d) AS v FROM s GROUP BY 1),
    k AS (SELECT unnest(range(25)) AS k),
    p AS (SELECT a.station_name, k, sum(a.d * b.d) AS p FROM s a CROSS JOIN k JOIN s b ON b.station_name = a.station_name AND b.t = a.t - to_hours(k) GROUP BY ALL)
    SELECT station_name, k AS lag, round(p / v, 6) AS acf FROM p JOIN v USING (station_name)
    """,
)
def _(t):
    return s.acf(s.regular_series(t.incidents, "time_created", "hour", "station_name"), "t", "n", 24, "station_name", stretch=50)


@query(
    "partial_autocorrelation",
    f"""
    WITH {_ACF}, r AS (SELECT (SELECT acf FROM acf WHERE lag = 1) AS a, (SELECT acf FROM acf WHERE lag = 2) AS b)
    SELECT 0 AS lag, 1.0::double AS pacf UNION ALL SELECT 1, round(a, 6) FROM r
    UNION ALL SELECT 2, round((b - a * a) / (1 - a * a), 6) FROM r
    """,
)
def _(t):
    return s.pacf(s.regular_series(t.events, "ts", "hour"), "t", "n", 2)


@query("partial_autocorrelation_per_group")
def _(t):
    return s.pacf(s.regular_series(t.incidents, "time_created", "hour", "station_name"), "t", "n", 12, "station_name")


@query(
    "granger_f",
    """
    WITH a AS (SELECT cast(o_orderdate AS date) AS day, count(*) FILTER (o_orderstatus = 'F') AS y, count(*) FILTER (o_orderstatus = 'O') AS x
               FROM orders GROUP BY 1),
    l AS (SELECT y::double AS y, lag(y) OVER (ORDER BY day)::double AS y1, lag(x) OVER (ORDER BY day)::double AS x1 FROM a),
    s AS (SELECT count(*) AS n, covar_pop(y, y) AS yy, covar_pop(y1, y1) AS aa, covar_pop(x1, x1) AS bb, covar_pop(y, y1) AS ya,
                 covar_pop(y, x1) AS yb, covar_pop(y1, x1) AS ab FROM l WHERE y1 IS NOT NULL),
    r AS (SELECT n, n * (yy - ya * ya / aa) AS restricted,
                 n * (yy - (ya * (ya * bb - yb * ab) + yb * (yb * aa - ya * ab)) / (aa * bb - ab * ab)) AS full_ FROM s)
    SELECT 1 AS lag, n, round(restricted, 4) AS ssr_restricted, round(full_, 4) AS ssr_full, 1 AS df_num, n - 3 AS df_denom,
           round((restricted - full_) / (full_ / (n - 3)), 4) AS f_stat FROM r
    """,
    digits=4,
)
def _(t):
    status = lambda v: F.sum((F.col("o_orderstatus") == v).cast("int"))
    days = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(status("F").alias("y"), status("O").alias("x"))
    return s.granger_f(days, "day", "y", "x", 1)


@query(
    "granger_f_in_stretches",
    """
    WITH a AS (SELECT cast(o_orderdate AS date) AS day, count(*) FILTER (o_orderstatus = 'F') AS y, count(*) FILTER (o_orderstatus = 'O') AS x
               FROM orders GROUP BY 1),
    l AS (SELECT y::double AS y, lag(y) OVER (ORDER BY day)::double AS y1, lag(x) OVER (ORDER BY day)::double AS x1 FROM a),
    s AS (SELECT count(*) AS n, covar_pop(y, y) AS yy, covar_pop(y1, y1) AS aa, covar_pop(x1, x1) AS bb, covar_pop(y, y1) AS ya,
                 covar_pop(y, x1) AS yb, covar_pop(y1, x1) AS ab FROM l WHERE y1 IS NOT NULL),
    r AS (SELECT n, n * (yy - ya * ya / aa) AS restricted,
                 n * (yy - (ya * (ya * bb - yb * ab) + yb * (yb * aa - ya * ab)) / (aa * bb - ab * ab)) AS full_ FROM s)
    SELECT 1 AS lag, n, round(restricted, 4) AS ssr_restricted, round(full_, 4) AS ssr_full, 1 AS df_num, n - 3 AS df_denom,
           round((restricted - full_) / (full_ / (n - 3)), 4) AS f_stat FROM r
    """,
    digits=4,
)
def _(t):
    status = lambda v: F.sum((F.col("o_orderstatus") == v).cast("int"))
    days = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(status("F").alias("y"), status("O").alias("x"))
    return s.granger_f(days, "day", "y", "x", 1, stretch=40)


@query("granger_f_five_lags")
def _(t):
    status = lambda v: F.sum((F.col("o_orderstatus") == v).cast("int"))
    days = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(status("F").alias("y"), status("O").alias("x"))
    return s.granger_f(days, "day", "y", "x", 5)
