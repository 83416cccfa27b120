"""Aggregates, pivots, heat maps and rates."""

from pyspark.sql import functions as F

from ..functions.text import urgency
from ..operators import aggregates as a
from .base import DISPATCHES, INCIDENTS, query
from .text import URGENCY_SQL


@query(
    "hourly_counts",
    f"""
    WITH {INCIDENTS}
    SELECT strftime(date_trunc('hour', time_created), '%Y-%m-%d %H:%M:%S') AS time_created, station_name,
           count(*) AS total_incidents, cast(sum(trns_to_hosp::int) AS bigint) AS trns_to_hosp,
           cast(sum(m_required::int) AS bigint) AS m_required
    FROM incidents GROUP BY ALL
    """,
)
def _(t):
    return a.hourly_demand(t.incidents, "time_created", "station_name", ["trns_to_hosp", "m_required"])


@query("distinct_values", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def _(t):
    return a.distinct_values(t.lineitem, ["l_returnflag", "l_linestatus"])


@query(
    "first_per_key",
    """
    SELECT conv_id, turn, role, length(text) AS n FROM conversations
    QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1
    """,
)
def _(t):
    return a.first_per_key(t.conversations, "conv_id", ["turn"]).select("conv_id", "turn", "role", F.length("text").alias("n"))


@query(
    "concat_text",
    "SELECT conv_id, string_agg(text, ' | ' ORDER BY turn) AS comments FROM conversations GROUP BY 1",
)
def _(t):
    return a.concat_text(t.conversations, "conv_id", "text", ["turn"])


@query(
    "concat_text_in_pieces",
    """
    SELECT user_id, md5(string_agg(cast(event_id AS varchar), ',' ORDER BY ts)) AS digest FROM events GROUP BY 1
    """,
)
def _(t):
    ids = t.events.select("user_id", F.col("event_id").cast("string").alias("id"), "ts")
    return a.concat_text(ids, "user_id", "id", ["ts"], ",", n=6).select("user_id", F.md5("comments").alias("digest"))


@query(
    "max_per_key",
    """
    SELECT o_custkey, max(o_orderstatus) AS o_orderstatus, round(max(o_totalprice), 6) AS o_totalprice,
           max(o_orderpriority) AS o_orderpriority FROM orders GROUP BY 1
    """,
)
def _(t):
    return a.max_per_key(t.orders, "o_custkey", ["o_orderstatus", "o_totalprice", "o_orderpriority"])


@query(
    "daily_pivot",
    """
    SELECT strftime(ts, '%Y-%m-%d') AS date,
           coalesce(round(avg(value) FILTER (event_type = 'view'), 6), 0) AS view,
           coalesce(round(avg(value) FILTER (event_type = 'click'), 6), 0) AS click,
           coalesce(round(avg(value) FILTER (event_type = 'error'), 6), 0) AS error
    FROM events GROUP BY 1
    """,
)
def _(t):
    return a.daily_pivot(t.events.withColumn("kind", F.upper("event_type")), "ts", "kind", "value", ["VIEW", "CLICK", "ERROR"])


@query(
    "daily_event_pivot",
    """
    SELECT strftime(ts, '%Y-%m-%d') AS date,
           coalesce(round(avg(value) FILTER (event_type IN ('view', 'signup')), 6), 0) AS ice_fog,
           coalesce(round(avg(value) FILTER (event_type = 'click'), 6), 0) AS thunder
    FROM events WHERE event_type IN ('view', 'signup', 'click') GROUP BY 1
    """,
)
def _(t):
    return a.daily_event_pivot(t.events, "ts", "event_type", "value", {"view": "ice_fog", "signup": "ice_fog", "click": "thunder"})


@query(
    "daily_threshold",
    """
    SELECT strftime(ts, '%Y-%m-%d') AS date, cast(max(value) FILTER (event_type = 'view') >= 90 AS int) AS above,
           cast(min(value) FILTER (event_type = 'click') <= 0.05 AS int) AS below
    FROM events WHERE event_type IN ('view', 'click') GROUP BY 1
    """,
)
def _(t):
    above = a.daily_threshold(t.events.where("event_type = 'view'"), "ts", "value", "max", ">=", 90, "above")
    below = a.daily_threshold(t.events.where("event_type = 'click'"), "ts", "value", "min", "<=", 0.05, "below")
    return above.join(below, "date", "full_outer")


@query(
    "code_summary",
    f"""
    WITH {INCIDENTS}
    SELECT dispatch_code, code_type, round(avg(trns_to_hosp::int), 6) AS frac_trans, count(*) AS n_incidents,
           round(avg(m_required::int), 6) AS mt_required
    FROM incidents GROUP BY ALL
    """,
)
def _(t):
    return a.code_summary(t.incidents, ["dispatch_code", "code_type"])


@query(
    "ratio_of_sums_by_urgency",
    f"""
    WITH {INCIDENTS}, c AS (SELECT code_type, avg(m_required::int) AS req, count(*) AS n FROM incidents GROUP BY 1)
    SELECT {URGENCY_SQL} AS urgency, round(sum(req * n) / sum(n), 6) AS ratio FROM c GROUP BY 1
    """,
)
def _(t):
    codes = a.code_summary(t.incidents, "code_type").withColumn("urgency", urgency("code_type"))
    return a.ratio_of_sums(codes, "urgency", "mt_required", "n_incidents")


_CODES = """c AS (SELECT dispatch_code, avg(trns_to_hosp::int) AS f, count(*) AS n, max((m_required)::int) AS old,
                 (avg(trns_to_hosp::int) > 0.2)::int AS new FROM incidents GROUP BY 1)"""


def _rules(t):
    return t.incidents.groupBy("dispatch_code").agg(
        F.avg(F.col("trns_to_hosp").cast("int")).alias("f"),
        F.count("*").alias("n"),
        F.max("m_required").alias("old"),
        (F.avg(F.col("trns_to_hosp").cast("int")) > 0.2).alias("new"),
    )


@query(
    "weighted_confusion",
    f"""
    WITH {INCIDENTS}, {_CODES}
    SELECT round(sum(n * new * f) / sum(n), 6) AS tp, round(sum(n * (1 - new) * f) / sum(n), 6) AS fn,
           round(sum(n * new * (1 - f)) / sum(n), 6) AS fp, round(sum(n * (1 - new) * (1 - f)) / sum(n), 6) AS tn
    FROM c
    """,
)
def _(t):
    return a.weighted_confusion(_rules(t), "new", "f", "n")


@query(
    "increase_ratio",
    f"""
    WITH {INCIDENTS}, {_CODES},
    s AS (SELECT sum(old * n) AS o, sum(new * n) AS w, sum((1 - old) * f * n) AS om, sum((1 - new) * f * n) AS wm FROM c)
    SELECT round((w - o) / o, 6) AS dispatch_increase, round(((w + wm) - (o + om)) / (o + om), 6) AS transport_increase FROM s
    """,
)
def _(t):
    return a.increase_ratio(_rules(t), "old", "new", "f", "n")


@query(
    "confusion_delta",
    f"""
    WITH {INCIDENTS}, {_CODES}
    SELECT round(sum((new - old) * n * f), 6) AS tp, round(sum((old - new) * n * f), 6) AS fn,
           round(sum((new - old) * n * (1 - f)), 6) AS fp, round(sum((old - new) * n * (1 - f)), 6) AS tn FROM c
    """,
)
def _(t):
    return a.confusion_delta(_rules(t), "old", "new", "f", "n")


@query(
    "daily_rollup",
    f"""
    WITH {INCIDENTS}
    SELECT strftime(time_created, '%Y-%m-%d') AS day, station_name, cast(sum(trns_to_hosp::int) AS bigint) AS trns,
           round(avg(value), 6) AS value FROM incidents GROUP BY ALL
    """,
)
def _(t):
    rows = t.incidents.withColumn("trns", F.col("trns_to_hosp").cast("int"))
    return a.daily_rollup(rows, "time_created", "station_name", ["trns"], ["value"])


@query(
    "rollup_sum",
    f"""
    WITH {INCIDENTS}
    SELECT strftime(date_trunc('day', time_created), '%Y-%m-%d %H:%M:%S') AS day, station_name, count(*) AS total_incidents
    FROM incidents GROUP BY ALL
    """,
)
def _(t):
    hourly = a.hourly_demand(t.incidents, "time_created", "station_name")
    return a.rollup_sum(hourly, "time_created", "day", "station_name", ["total_incidents"])


@query(
    "counts_by_year",
    """
    SELECT year(o_orderdate) AS time_year, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS required,
           count(*) FILTER (o_orderstatus = 'F' AND o_totalprice < 1e5) AS wrongly_sent FROM orders GROUP BY 1
    """,
)
def _(t):
    closed = F.col("o_orderstatus") == "F"
    return a.counts_by_year(t.orders, "o_orderdate", {"required": closed, "wrongly_sent": closed & (F.col("o_totalprice") < 1e5)})


_RATES = """round(avg((m_required AND trns_to_hosp)::int), 6) AS tp, round(avg((m_required AND NOT trns_to_hosp)::int), 6) AS fp,
            round(avg((NOT m_required AND trns_to_hosp)::int), 6) AS fn, round(avg((NOT m_required AND NOT trns_to_hosp)::int), 6) AS tn"""


@query(
    "confusion_rates",
    f"WITH {INCIDENTS} SELECT station_name, count(*) AS n, {_RATES} FROM incidents GROUP BY 1",
)
def _(t):
    return a.confusion_rates(t.incidents, "m_required", "trns_to_hosp", "station_name")


@query(
    "agreement_rates",
    f"""
    WITH {INCIDENTS}
    SELECT round(avg((m_required = m_sent)::int), 6) AS required_sent, round(avg((m_required = trns_to_hosp)::int), 6) AS required_trns,
           round(avg((m_sent = trns_to_hosp)::int), 6) AS sent_trns FROM incidents
    """,
)
def _(t):
    pairs = {
        "required_sent": ("m_required", "m_sent"),
        "required_trns": ("m_required", "trns_to_hosp"),
        "sent_trns": ("m_sent", "trns_to_hosp"),
    }
    return a.agreement_rates(t.incidents, pairs)


@query(
    "confusion_of_most_frequent_codes",
    f"""
    WITH {INCIDENTS} SELECT code_type, count(*) AS n, {_RATES} FROM incidents GROUP BY 1 ORDER BY n DESC, code_type LIMIT 10
    """,
)
def _(t):
    return a.confusion_top_groups(t.incidents, "code_type", "m_required", "trns_to_hosp")


@query("frequency", "SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, user_id LIMIT 5")
def _(t):
    return a.frequency(t.events, "user_id", 5)


@query(
    "stats_of_one_code",
    f"""
    WITH {INCIDENTS}
    SELECT count(*) AS n, {_RATES}, round(count(*) / (SELECT count(*) FROM incidents), 6) AS share FROM incidents WHERE code_type = '26'
    """,
)
def _(t):
    return a.group_stats(t.incidents, "code_type", "26", "m_required", "trns_to_hosp")


_UNITS = """
    ev AS (SELECT event, arg_min(l_returnflag, (sent, unit, l_partkey)) AS kind, cast(sum((l_quantity > 25)::int) AS bigint) AS needed,
                  cast(sum((unit % 3 = 0)::int) AS bigint) AS medics, count(*) FILTER (late) AS late
           FROM (SELECT *, epoch_us(sent) > min(epoch_us(sent)) OVER (PARTITION BY event) + 60000000 AS late FROM dispatches) GROUP BY 1)
"""


def _unit_events(t):
    from ..operators.joins import late_events

    marked = t.dispatches.withColumns(
        {"needed": (F.col("l_quantity") > 25).cast("int"), "medics": (F.col("unit") % 3 == 0).cast("int"), "kind": F.col("l_returnflag")}
    )
    events = a.per_event(marked, "event", ["sent", "unit", "l_partkey"], ["kind"], ["needed", "medics"])
    return events.join(late_events(t.dispatches, "event", "sent", 60, "late"), "event", "left").na.fill(0, ["late"])


@query(
    "per_event",
    f"WITH {DISPATCHES}, {_UNITS} SELECT event, kind, needed, medics, late FROM ev",
)
def _(t):
    return _unit_events(t)


@query(
    "undersend_and_oversend",
    f"""
    WITH {DISPATCHES}, {_UNITS}
    SELECT kind, round(avg((late > 0)::int), 6) AS undersend, round(avg((needed < medics)::int), 6) AS oversend FROM ev GROUP BY 1
    """,
)
def _(t):
    events = _unit_events(t)
    return a.undersend_rate(events, "kind", "late").join(a.oversend_rate(events, "kind", "needed", "medics"), "kind")


@query(
    "pct_distribution",
    "SELECT event_type, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM events GROUP BY 1",
)
def _(t):
    return a.pct_distribution(t.events, "event_type")


@query(
    "unit_share",
    "SELECT l_suppkey, count(*) AS n, round(100 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM lineitem GROUP BY 1",
)
def _(t):
    return a.unit_share(t.lineitem, "l_suppkey")


@query(
    "heat_dow_hour",
    """
    SELECT dow AS day_of_week, h AS hour, round(avg(n), 6) AS mean_count
    FROM (SELECT isodow(ts) - 1 AS dow, hour(ts) AS h, week(ts) AS w, year(ts) AS y, count(*) AS n FROM events GROUP BY ALL) GROUP BY ALL
    """,
)
def _(t):
    return a.heat_dow_hour(t.events, "ts")


_HOURS = ", ".join(f"round(count(*) FILTER (hour(ts) = {h}) / 52, 6) AS h{h:02d}" for h in range(24))


@query("heat_dow_hour_pivot", f"SELECT isodow(ts) - 1 AS day_of_week, {_HOURS} FROM events GROUP BY 1")
def _(t):
    return a.heat_dow_hour_pivot(t.events, "ts")


@query(
    "heat_month_day",
    """
    SELECT m AS month, d AS day, round(avg(n), 6) AS value
    FROM (SELECT month(o_orderdate) AS m, day(o_orderdate) AS d, year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY ALL) GROUP BY ALL
    """,
)
def _(t):
    return a.heat_month_day(t.orders, "o_orderdate")


_DAYS = ", ".join(f"cast(max(v) FILTER (d = {d}) AS bigint) AS d{d:02d}" for d in range(1, 32))


@query(
    "heat_month_day_capped",
    f"""
    SELECT m AS month, {_DAYS}
    FROM (SELECT month(o_orderdate) AS m, day(o_orderdate) AS d, CASE WHEN count(*) <= 45 THEN count(*) END AS v FROM orders GROUP BY ALL)
    GROUP BY 1
    """,
)
def _(t):
    return a.widen_days(a.heat_month_day(t.orders, "o_orderdate", cap=45))


@query(
    "median_runs",
    """
    SELECT l_suppkey, round(median(n), 6) AS median_runs
    FROM (SELECT l_suppkey, cast(l_shipdate AS date) AS d, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY 1
    """,
)
def _(t):
    return a.median_runs(t.lineitem.withColumn("shift", F.to_date("l_shipdate")), "l_suppkey", "shift")


@query(
    "distinct_units_hist",
    """
    SELECT units, count(*) AS days FROM (SELECT cast(l_shipdate AS date) AS d, count(DISTINCT l_suppkey) AS units FROM lineitem GROUP BY 1)
    GROUP BY 1
    """,
)
def _(t):
    return a.distinct_units_hist(t.lineitem, "l_shipdate", "l_suppkey")


@query(
    "outcome_class",
    """
    SELECT l_orderkey, 2 * max((l_returnflag = 'A')::int) + max((l_linestatus = 'O')::int) AS outcome FROM lineitem GROUP BY 1
    """,
)
def _(t):
    return a.outcome_class(t.lineitem, "l_orderkey", F.col("l_returnflag") == "A", F.col("l_linestatus") == "O")


@query(
    "daily_fraction_of_code_family",
    f"""
    WITH {INCIDENTS} SELECT strftime(time_created, '%Y-%m-%d') AS day, round(avg(trns_to_hosp::int), 6) AS fraction
    FROM incidents WHERE dispatch_code LIKE '06__' AND m_sent GROUP BY 1
    """,
)
def _(t):
    return a.daily_fraction(t.incidents.where("dispatch_code like '06__' and m_sent"), "time_created", "trns_to_hosp")


@query(
    "type_probability",
    f"""
    WITH {INCIDENTS} SELECT code_type, round(avg(trns_to_hosp::int), 6) AS p_trns,
           round(count(*) / (SELECT count(*) FROM incidents), 6) AS p_type FROM incidents GROUP BY 1
    """,
)
def _(t):
    return a.type_probability(t.incidents, "code_type", "trns_to_hosp")


@query(
    "base_accuracy",
    f"""
    WITH {INCIDENTS}, b AS (SELECT code_type, avg(trns_to_hosp::int) AS p FROM incidents GROUP BY 1)
    SELECT code_type, round(p * p + (1 - p) * (1 - p), 6) AS base_acc, round(greatest(p, 1 - p), 6) AS majority,
           round((greatest(p, 1 - p) - (p * p + (1 - p) * (1 - p))) / (p * p + (1 - p) * (1 - p)), 6) AS pct_acc_gain FROM b
    """,
)
def _(t):
    guess = a.base_accuracy(t.incidents, "code_type", "trns_to_hosp")
    majority = a.base_accuracy(t.incidents, "code_type", "trns_to_hosp", "majority").withColumnRenamed("base_acc", "majority")
    return a.accuracy_gain(guess.join(majority, "code_type"), "majority")


@query(
    "min_group_size",
    "SELECT event_id, user_id FROM events QUALIFY count(*) OVER (PARTITION BY user_id) >= 65",
)
def _(t):
    return a.min_group_size(t.events, "user_id", 65).select("event_id", "user_id")


@query(
    "argmax_code_of_false_positives",
    f"""
    WITH {INCIDENTS} SELECT code_type, count(*) AS n FROM incidents WHERE m_required AND NOT trns_to_hosp GROUP BY 1
    ORDER BY n DESC, code_type LIMIT 1
    """,
)
def _(t):
    return a.argmax_group(t.incidents, "code_type", F.col("m_required") & ~F.col("trns_to_hosp"))


@query(
    "daily_share",
    f"""
    WITH {INCIDENTS} SELECT strftime(time_created, '%Y-%m-%d') AS day, round(count(*) / (SELECT count(*) FROM incidents), 6) AS share,
           round(avg(trns_to_hosp::int), 6) AS positive_rate FROM incidents GROUP BY 1
    """,
)
def _(t):
    return a.daily_share(t.incidents, "time_created", "trns_to_hosp")


@query(
    "day_of_month_hist",
    """
    SELECT day(o_orderdate) AS day, count(*) AS n FROM orders
    WHERE month(o_orderdate) <> 2 AND day(o_orderdate) < 31 AND o_orderstatus = 'F' GROUP BY 1
    """,
)
def _(t):
    return a.day_of_month_hist(t.orders, "o_orderdate", F.col("o_orderstatus") == "F")


@query(
    "histogram",
    """
    WITH e AS (SELECT min(value) AS lo, (max(value) - min(value)) / 100 AS w FROM events),
    c AS (SELECT least(cast(floor((value - lo) / w) AS int), 99) AS bin, count(*) AS n FROM events, e GROUP BY 1)
    SELECT b.bin, round(lo + b.bin * w, 6) AS "from", round(lo + (b.bin + 1) * w, 6) AS "to", coalesce(n, 0) AS n
    FROM (SELECT unnest(range(100)) AS bin) b CROSS JOIN e LEFT JOIN c ON c.bin = b.bin
    """,
)
def _(t):
    return a.histogram(t.events, "value")
