"""Unit activity."""

from pyspark.sql import functions as F

from ..operators import intervals as iv
from .base import DISPATCHES, query

SHIFT0 = "1995-01-01 07:00:00"


@query(
    "shift_number",
    f"""
    WITH {DISPATCHES}
    SELECT event, unit, line, l_partkey, cast(floor((epoch_us(sent) - epoch_us(TIMESTAMP '{SHIFT0}')) / 86400000000) AS bigint) + 1 AS shift
    FROM dispatches
    """,
)
def _(t):
    return t.dispatches.select("event", "unit", "line", "l_partkey", iv.shift_number("sent", SHIFT0).alias("shift"))


@query(
    "duration_minutes",
    f"WITH {DISPATCHES} SELECT unit, cast(sum((epoch_us(clear) - epoch_us(sent)) / 60000000) AS bigint) AS minutes FROM dispatches GROUP BY 1",
)
def _(t):
    timed = iv.duration_minutes(t.dispatches, "sent", "clear")
    return timed.groupBy("unit").agg(F.sum("minutes").cast("bigint").alias("minutes"))


_IDLE = f"""
    x AS (SELECT unit, cast(floor((epoch_us(sent) - epoch_us(TIMESTAMP '{SHIFT0}')) / 86400000000) AS bigint) + 1 AS shift, sent, clear FROM dispatches),
    e AS (SELECT DISTINCT unit, shift, "at", state FROM (
            SELECT unit, shift, epoch_us(sent) AS "at", 1 AS state FROM x UNION ALL SELECT unit, shift, epoch_us(clear), 0 FROM x) WHERE shift > 0),
    p AS (SELECT *, lag("at") OVER w AS pat, lag(state) OVER w AS pst FROM e WINDOW w AS (PARTITION BY unit, shift ORDER BY "at", state)),
    idle AS (SELECT unit, shift, coalesce(sum(CASE WHEN state = 1 AND pst IS NULL THEN "at" - (epoch_us(TIMESTAMP '{SHIFT0}') + (shift - 1) * 86400000000)
                                   WHEN state = 1 AND pst = 0 THEN "at" - pat END), 0) / 3.6e9 AS h FROM p GROUP BY ALL)
"""


@query("idle_time", f"WITH {DISPATCHES}, {_IDLE} SELECT unit, shift, round(h, 6) AS idle_hours FROM idle")
def _(t):
    return iv.idle_time(t.dispatches, "unit", "sent", "clear", SHIFT0)


@query("median_idle_time", f"WITH {DISPATCHES}, {_IDLE} SELECT unit, round(median(h), 6) AS median_idle_hours FROM idle GROUP BY 1")
def _(t):
    return iv.median_idle(iv.idle_time(t.dispatches, "unit", "sent", "clear", SHIFT0))


_CONC = """
    e AS (SELECT DISTINCT unit, "at", state FROM (
            SELECT unit, epoch_us(sent) AS "at", 1 AS state FROM dispatches UNION ALL SELECT unit, epoch_us(clear), 0 FROM dispatches)),
    ch AS (SELECT unit, "at", state - coalesce(lag(state) OVER (PARTITION BY unit ORDER BY "at", state), 0) AS delta FROM e),
    conc AS (SELECT "at", unit, delta, cast(sum(delta) OVER (ORDER BY "at", delta, unit ROWS UNBOUNDED PRECEDING) AS bigint) AS busy FROM ch WHERE delta <> 0)
"""


def _conc(t, n=None):
    return iv.concurrency(t.dispatches, "unit", "sent", "clear", n)


@query("busy_units", f'WITH {DISPATCHES}, {_CONC} SELECT "at", unit, delta, busy FROM conc')
def _(t):
    return _conc(t)


@query("busy_units_in_buckets", f'WITH {DISPATCHES}, {_CONC} SELECT "at", unit, delta, busy FROM conc')
def _(t):
    return _conc(t, 8)


_RUSH = """
dispatches AS (
  SELECT l_orderkey AS unit, sent, sent + to_hours(cast(l_quantity AS bigint)) AS clear
  FROM (SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN TIMESTAMP '1997-01-01' ELSE l_shipdate + to_minutes(l_orderkey % 60) END AS sent FROM lineitem)
)"""


@query("busy_units_in_a_rush", f'WITH {_RUSH}, {_CONC} SELECT "at", unit, delta, busy FROM conc')
def _(t):
    """A third of all units is sent at one instant."""
    minutes = F.expr("make_dt_interval(0, 0, cast(l_orderkey % 60 as int))")
    sent = F.when(F.col("l_orderkey") % 3 == 0, F.to_timestamp_ntz(F.lit("1997-01-01 00:00:00"))).otherwise(F.col("l_shipdate").cast("timestamp_ntz") + minutes)
    stay = F.expr("make_dt_interval(0, cast(l_quantity as int))")
    rows = t.lineitem.select(F.col("l_orderkey").alias("unit"), sent.alias("sent"), (sent + stay).alias("clear"))
    return iv.concurrency(rows, "unit", "sent", "clear", 8)


@query(
    "saturation_episodes",
    f"""
    WITH {DISPATCHES}, {_CONC},
    turns AS (SELECT *, cast(sum((busy >= 30 AND busy - delta < 30)::int) OVER (ORDER BY "at", delta, unit ROWS UNBOUNDED PRECEDING) AS bigint) AS episode
              FROM conc WHERE (busy >= 30) <> (busy - delta >= 30))
    SELECT episode, min("at") FILTER (delta = 1) AS start, min("at") FILTER (delta = -1) AS "end" FROM turns GROUP BY 1
    """,
)
def _(t):
    return iv.saturation_episodes(_conc(t), 30)


@query(
    "load_band_share",
    f"""
    WITH {DISPATCHES}, {_CONC}, s AS (SELECT busy, coalesce(lead("at") OVER (ORDER BY "at", delta, unit) - "at", 0) AS d FROM conc)
    SELECT round(coalesce(sum(d) FILTER (busy <= 15), 0) / sum(d), 6) AS low_share, round(coalesce(sum(d) FILTER (busy > 15 AND busy <= 22), 0) / sum(d), 6) AS mid_share,
           round(coalesce(sum(d) FILTER (busy > 22), 0) / sum(d), 6) AS high_share FROM s
    """,
)
def _(t):
    return iv.load_band_share(_conc(t), (15, 22))


@query(
    "load_band_share_by_load_after",
    f"""
    WITH {DISPATCHES}, {_CONC}, s AS (SELECT busy, coalesce("at" - lag("at") OVER (ORDER BY "at", delta, unit), 0) AS d FROM conc)
    SELECT round(coalesce(sum(d) FILTER (busy <= 15), 0) / sum(d), 6) AS low_share, round(coalesce(sum(d) FILTER (busy > 15 AND busy <= 22), 0) / sum(d), 6) AS mid_share,
           round(coalesce(sum(d) FILTER (busy > 22), 0) / sum(d), 6) AS high_share FROM s
    """,
)
def _(t):
    return iv.load_band_share(_conc(t), (15, 22), load="after")


@query(
    "created_while_saturated",
    f"""
    WITH {DISPATCHES}, {_CONC}, steps AS (SELECT "at", sum(delta) AS d FROM conc GROUP BY 1),
    lv AS (SELECT "at", sum(d) OVER (ORDER BY "at") AS busy FROM steps)
    SELECT o_orderkey, cast(coalesce(busy, 0) >= 24 AS int) AS saturated
    FROM (SELECT o_orderkey, epoch_us(o_orderdate) - 1 AS q FROM orders) ASOF LEFT JOIN lv ON q >= lv."at"
    """,
)
def _(t):
    return iv.created_while_saturated(t.orders, "o_orderdate", _conc(t), 24).select("o_orderkey", "saturated")


@query("busy_samples", f'WITH {DISPATCHES}, {_CONC} SELECT "at", unit, delta, busy FROM conc WHERE busy >= 28')
def _(t):
    return iv.busy_samples(_conc(t), 28)


@query(
    "median_busy_by_daypart",
    f"""
    WITH {DISPATCHES}, {_CONC}, h AS (SELECT busy, "at" // 3600000000 % 24 AS h FROM conc)
    SELECT CASE WHEN h BETWEEN 7 AND 12 THEN '7a-1p' WHEN h BETWEEN 13 AND 18 THEN '1p-7p' WHEN h >= 19 OR h = 0 THEN '7p-1a' ELSE '1a-7a' END AS daypart,
           round(median(busy), 6) AS median FROM h GROUP BY 1
    """,
)
def _(t):
    from ..operators.aggregates import median_by_daypart

    return median_by_daypart(_conc(t).withColumn("ts", F.timestamp_micros("at")), "ts", "busy")


@query(
    "itinerary",
    f"""
    WITH {DISPATCHES}, d AS (SELECT unit, event AS key, sent, clear, l_partkey, CASE WHEN l_quantity > 40 THEN NULL ELSE sent + to_hours(1) END AS h,
                                    CASE WHEN l_returnflag <> 'N' THEN l_partkey % 7 END AS hospital FROM dispatches)
    SELECT unit, key, strftime(sent, '%Y-%m-%d %H:%M:%S') AS "at", 'p' AS purpose, l_partkey AS location FROM d
    UNION ALL SELECT unit, key, strftime(coalesce(h, clear), '%Y-%m-%d %H:%M:%S'), CASE WHEN h IS NULL THEN 'h_notime' ELSE 'h' END, hospital
    FROM d WHERE hospital IS NOT NULL
    """,
)
def _(t):
    d = t.dispatches.withColumns(
        {
            "h": F.when(F.col("l_quantity") <= 40, F.col("sent") + F.expr("interval 1 hour")),
            "hospital": F.when(F.col("l_returnflag") != "N", F.col("l_partkey") % 7),
        }
    )
    return iv.itinerary(d, "unit", "event", "sent", "h", "clear", "l_partkey", "hospital")
