"""Evaluation of scores and rules."""

from pyspark.sql import functions as F

from ..functions.text import urgency
from ..operators import scoring as sc
from .base import INCIDENTS, SCORED, query
from .text import URGENCY_SQL

_K = "(SELECT unnest([0.05, 0.3, 0.6, 0.9]::double[]) AS k)"


def _metrics_sql(source: str, y: str, key: str | None, weights) -> str:
    part = f"PARTITION BY {key}" if key else ""
    g = f"{key}, " if key else ""
    on = f"AND s.{key} = t.{key}" if key else ""
    return f"""
    s AS (SELECT {g}{y} AS y, score, row_number() OVER ({part} ORDER BY score DESC) - 1 AS i, count(*) OVER ({part}) AS n,
                 rank() OVER ({part} ORDER BY score) + (count(*) OVER ({'PARTITION BY ' + key + ', score' if key else 'PARTITION BY score'}) - 1) / 2 AS r
          FROM {source}),
    th AS (SELECT {g}k, max(score) AS threshold FROM s, {_K} WHERE i = floor(k * n) GROUP BY ALL),
    auc AS (SELECT {g}(sum(r) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2) / nullif(sum(y) * (count(*) - sum(y)), 0) AS auc FROM s GROUP BY ALL),
    c AS (SELECT {'t.' + key + ', ' if key else ''}k, threshold, sum((y = 1 AND score >= threshold)::int) AS tp, sum((y = 0 AND score >= threshold)::int) AS fp,
                 sum((y = 1 AND score < threshold)::int) AS fn, sum((y = 0 AND score < threshold)::int) AS tn
          FROM s JOIN th t ON true {on} GROUP BY ALL)
    SELECT {'c.' + key + ', ' if key else ''}k, round(threshold, 6) AS threshold, round(tp / (tp + fp), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall,
           round(auc, 6) AS auc, round(({weights[0]} * tp + {weights[1]} * fn + {weights[2]} * fp + {weights[3]} * tn) / (tp + fp + fn + tn), 6) AS score
    FROM c JOIN auc a ON {f'a.{key} = c.{key}' if key else 'true'}
    """


@query("metrics_at_k", f"WITH {SCORED}, {_metrics_sql('scored', 'quality', None, (2.0, -3.0, -3.0, 2.0))}")
def _(t):
    return sc.metrics_at_k(t.scored, "quality", "score", weights=sc.SCORE_WEIGHTS["medium"])


_EV = "ev AS (SELECT event_type, (user_id % 3 = 0)::int AS y, value AS score FROM events)"


def _ev(t):
    return t.events.select("event_type", (F.col("user_id") % 3 == 0).cast("int").alias("y"), F.col("value").alias("score"))


@query("metrics_at_k_per_group", f"WITH {_EV}, {_metrics_sql('ev', 'y', 'event_type', (1.0, -1.0, -5.0, 3.0))}")
def _(t):
    return sc.metrics_at_k(_ev(t), "y", "score", weights=sc.SCORE_WEIGHTS["low"], keys="event_type")


@query("metrics_at_k_in_buckets", f"WITH {_EV}, {_metrics_sql('ev', 'y', None, (1.0, -1.0, -1.0, 1.0))}")
def _(t):
    return sc.metrics_at_k(_ev(t), "y", "score", n=8)


@query(
    "pr_curve",
    f"""
    WITH {_EV}, h AS (SELECT score, count(*) AS n, sum(y) AS pos FROM ev GROUP BY 1),
    c AS (SELECT score, pos, sum(n) OVER w AS cn, sum(pos) OVER w AS cp, sum(n) OVER () AS rows_, sum(pos) OVER () AS p FROM h WINDOW w AS (ORDER BY score DESC))
    SELECT round(score, 6) AS threshold, round(cn / rows_, 6) AS pct_above, round(cp / cn, 6) AS precision, round(cp / p, 6) AS recall
    FROM c WHERE cp - pos < p
    """,
)
def _(t):
    return sc.pr_curve(_ev(t), "y", "score")


@query(
    "bucket_weights",
    f"""
    WITH {INCIDENTS}, u AS (SELECT incident, {URGENCY_SQL} AS urgency FROM incidents)
    SELECT incident, urgency, CASE urgency WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END::double AS w_tp,
           CASE urgency WHEN 'high' THEN -5 WHEN 'medium' THEN -3 ELSE -1 END::double AS w_fn,
           CASE urgency WHEN 'high' THEN -1 WHEN 'medium' THEN -3 WHEN 'low' THEN -5 ELSE -1 END::double AS w_fp,
           CASE urgency WHEN 'high' THEN 1 WHEN 'medium' THEN 2 WHEN 'low' THEN 3 ELSE 1 END::double AS w_tn FROM u
    """,
)
def _(t):
    return sc.bucket_weights(t.incidents.select("incident", urgency("code_type").alias("urgency")), "urgency")


_SUGGEST = f"""
    c AS (SELECT code_type, {URGENCY_SQL} AS urgency, avg(trns_to_hosp::int) AS f, count(*) AS n FROM incidents GROUP BY ALL),
    s AS (SELECT *, CASE WHEN urgency = 'high' THEN true WHEN urgency = 'medium' THEN f * 3 - (1 - f) > f * -3 + (1 - f)
                 WHEN urgency = 'low' THEN f - (1 - f) > -f + (1 - f) * 1.7 ELSE f - (1 - f) > -f + (1 - f) END AS suggested FROM c)
"""


@query(
    "suggest_transport",
    f"WITH {INCIDENTS}, {_SUGGEST} SELECT code_type, urgency, round(f, 6) AS f, cast(suggested AS int) AS mt_suggested FROM s",
)
def _(t):
    rates = t.incidents.groupBy("code_type").agg(F.avg(F.col("trns_to_hosp").cast("int")).alias("f"))
    return sc.suggest(rates.withColumn("urgency", urgency("code_type")), "f", "urgency")


_REG = """
    d AS (SELECT event_type AS g, cast(ts AS date) AS day, count(*) AS y FROM events GROUP BY ALL),
    p AS (SELECT *, lag(y) OVER (PARTITION BY g ORDER BY day) AS yhat FROM d),
    i AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY day) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM p WHERE yhat IS NOT NULL)
"""


def _predictions(t):
    from ..operators.series import lag1_predictor

    days = t.events.groupBy(F.col("event_type").alias("g"), F.to_date("ts").alias("day")).agg(F.count("*").alias("y"))
    return lag1_predictor(days, "g", "day", "y", "yhat")


@query(
    "reg_metrics_exp",
    f"""
    WITH {_REG}
    SELECT g, round(avg(abs(yhat - y) / y), 6) AS mape, round(sqrt(avg((yhat - y) ** 2)), 6) AS mse, round(avg(abs(yhat - y)), 6) AS mae,
           round(avg(CASE WHEN y < yhat THEN 1 ELSE 3 END * abs(yhat - y) / y * exp(-ln(10.0::double) * i / (n - 1))), 6) AS twscore
    FROM i GROUP BY g
    """,
)
def _(t):
    return sc.reg_metrics(_predictions(t), "y", "yhat", ["day"], 0.1, "exp", (1, 3), "g")


@query(
    "reg_metrics_lin",
    f"""
    WITH {_REG}
    SELECT g, round(avg(abs(yhat - y) / y), 6) AS mape, round(sqrt(avg((yhat - y) ** 2)), 6) AS mse, round(avg(abs(yhat - y)), 6) AS mae,
           round(avg(CASE WHEN y < yhat THEN 2 ELSE 1 END * abs(yhat - y) / y * ((i + 1) * -0.8::double / n + 1)), 6) AS twscore
    FROM i GROUP BY g
    """,
)
def _(t):
    return sc.reg_metrics(_predictions(t), "y", "yhat", ["day"], 0.2, "lin", (2, 1), "g")


_CODED = """
    coded AS (SELECT cast(k % 35 AS varchar) AS code_type, (user_id % 3 = 0)::int AS y, value AS score, event_type IN ('purchase', 'click') AS m_required
              FROM (SELECT *, cast(regexp_extract(props, '(\\d+)', 1) AS bigint) AS k FROM events))
"""


def _coded(t):
    return t.incidents.select(
        "code_type", (F.col("operator_name") % 3 == 0).cast("int").alias("y"), F.col("value").alias("score"), "m_required"
    )


@query(
    "lift_by_code",
    f"""
    WITH {_CODED}, u AS (SELECT *, {URGENCY_SQL} AS urgency FROM coded),
    k AS (SELECT *, CASE urgency WHEN 'high' THEN 0.9 WHEN 'medium' THEN 0.6 ELSE 0.3 END::double AS k FROM u WHERE urgency <> 'other'),
    cut AS (SELECT code_type, quantile_cont(score, CASE WHEN max(urgency) = 'high' THEN 0.1 WHEN max(urgency) = 'medium' THEN 0.4 ELSE 0.7 END) AS c
            FROM k WHERE urgency = 'high' GROUP BY 1),
    cuts AS (SELECT code_type, quantile_cont(score, 0.1) AS c FROM k WHERE urgency = 'high' GROUP BY 1
             UNION ALL SELECT code_type, quantile_cont(score, 0.4) FROM k WHERE urgency = 'medium' GROUP BY 1
             UNION ALL SELECT code_type, quantile_cont(score, 0.7) FROM k WHERE urgency = 'low' GROUP BY 1),
    g AS (SELECT code_type, max(k) AS k, count(*) AS n, avg((y = (score > c)::int)::int) AS correct, avg(y) AS base,
                 sum((y = 1 AND score > c)::int) AS tp, sum(y) AS p FROM k JOIN cuts USING (code_type) GROUP BY 1)
    SELECT code_type, round((correct - base) / base, 5) AS precision_gain, round((tp / p - k) / k, 5) AS recall_gain,
           round((correct - base) / base * n, 5) AS precision_gain_n, round((tp / p - k) / k * n, 5) AS recall_gain_n FROM g
    """.replace(
        """    cut AS (SELECT code_type, quantile_cont(score, CASE WHEN max(urgency) = 'high' THEN 0.1 WHEN max(urgency) = 'medium' THEN 0.4 ELSE 0.7 END) AS c
            FROM k WHERE urgency = 'high' GROUP BY 1),
""",
        "",
    ),
    digits=5,
)
def _(t):
    return sc.lift_by_code(_coded(t), "code_type", "score", "y")


_SHARES = "round(avg((p AND y = 1)::int), 6) AS {0}_tp, round(avg((p AND y = 0)::int), 6) AS {0}_fp, round(avg((NOT p AND y = 1)::int), 6) AS {0}_fn, round(avg((NOT p AND y = 0)::int), 6) AS {0}_tn"


@query(
    "confusion_by_code",
    f"""
    WITH {_CODED}, cuts AS (SELECT code_type, quantile_cont(score, 0.555) AS c FROM coded GROUP BY 1),
    old AS (SELECT code_type, {_SHARES.format('protocol')} FROM (SELECT code_type, m_required AS p, y FROM coded) GROUP BY 1),
    new AS (SELECT code_type, {_SHARES.format('model')} FROM (SELECT code_type, score >= c AS p, y FROM coded JOIN cuts USING (code_type)) GROUP BY 1)
    SELECT * FROM old JOIN new USING (code_type)
    """,
)
def _(t):
    return sc.confusion_by_code(_coded(t), "code_type", "score", "y", "m_required")


@query(
    "compare_to_protocol",
    f"""
    WITH {_CODED}, c AS (SELECT quantile_cont(score, 0.6) AS c FROM coded)
    SELECT 'protocol' AS rule, round(avg((m_required AND y = 1)::int), 6) AS tp, round(avg((m_required AND y = 0)::int), 6) AS fp,
           round(avg((NOT m_required AND y = 1)::int), 6) AS fn, round(avg((NOT m_required AND y = 0)::int), 6) AS tn FROM coded
    UNION ALL SELECT 'model', round(avg((score >= c AND y = 1)::int), 6), round(avg((score >= c AND y = 0)::int), 6),
           round(avg((score < c AND y = 1)::int), 6), round(avg((score < c AND y = 0)::int), 6) FROM coded, c
    """,
)
def _(t):
    return sc.compare_to_protocol(_coded(t), "score", "y", "m_required", 0.4)


def _cuts(first: int, last: int) -> str:
    return str([round(1 - k / 100, 2) for k in range(first, last + 1)])


@query(
    "k_search",
    f"""
    WITH e AS (SELECT event_type <> 'error' AS low, (user_id % 3 = 0)::int AS y, value AS score FROM events),
    l AS (SELECT unnest(range(30, 81)) / 100.0::double AS k, unnest(quantile_cont(score, {_cuts(30, 80)})) AS level FROM e WHERE low),
    m AS (SELECT unnest(range(60, 91)) / 100.0::double AS k, unnest(quantile_cont(score, {_cuts(60, 90)})) AS level FROM e WHERE NOT low),
    ls AS (SELECT k, level, sum((y = 0 AND score < level)::int) AS tn,
                  sum(CASE WHEN score >= level THEN CASE WHEN y = 1 THEN 1 ELSE -1 END ELSE CASE WHEN y = 1 THEN -1 ELSE 1.7 END END) AS w
           FROM l, e WHERE low GROUP BY ALL),
    ms AS (SELECT k, level, sum((y = 0 AND score < level)::int) AS tn,
                  sum(CASE WHEN score >= level THEN CASE WHEN y = 1 THEN 3 ELSE -1 END ELSE CASE WHEN y = 1 THEN -3 ELSE 1 END END) AS w
           FROM m, e WHERE NOT low GROUP BY ALL),
    t AS (SELECT count(*) AS n FROM e)
    SELECT ls.k AS k_low, ms.k AS k_medium, round(ls.level, 4) AS level_low, round(ms.level, 4) AS level_medium,
           round((ls.w + ms.w)::double, 4) AS score, round((ls.tn + ms.tn) / n, 4) AS tn_share
    FROM ls, ms, t WHERE (ls.tn + ms.tn) / n BETWEEN 0.35 AND 0.45 ORDER BY (ls.w + ms.w) DESC, 1, 2 LIMIT 1
    """,
    digits=4,
)
def _(t):
    low = (F.col("event_type") != "error").alias("low")
    e = t.events.select(low, (F.col("user_id") % 3 == 0).cast("int").alias("y"), F.col("value").alias("score"))
    total = e.agg(F.count("*").alias("n")).scalar()
    return sc.k_search(e.where("low"), e.where("not low"), "y", "score", total)


@query(
    "complete_scores",
    """
    SELECT event_id, round(value, 6) AS s_all, user_id % 7 AS s_some FROM events WHERE event_type = 'view' AND user_id % 2 = 0
    """,
)
def _(t):
    some = F.when(F.col("user_id") % 2 == 0, F.col("user_id") % 7)
    wide = t.events.select(
        "event_id", "event_type", F.col("value").alias("s_all"), some.alias("s_some"), F.lit(None).cast("double").alias("s_none")
    )
    return sc.complete_scores(wide, "event_type", "view", ["s_all", "s_some", "s_none"]).drop("event_type")


@query(
    "importance_by_family",
    """
    WITH f AS (SELECT CASE WHEN p_name LIKE '%red%' THEN 'red' WHEN p_name LIKE '%blue%' THEN 'blue' ELSE 'other' END AS family,
                      abs((p_size % 11) - 5.0::double) AS w FROM part)
    SELECT family, round(sum(w), 6) AS total, round(median(w), 6) AS median, round(sum(w) / (SELECT sum(w) FROM f), 6) AS share FROM f GROUP BY 1
    """,
)
def _(t):
    return sc.importance_by_family(t.part.withColumn("w", F.col("p_size") % 11 - 5.0), "p_name", "w", ["red", "blue"])


@query(
    "summarize_models",
    """
    WITH r AS (SELECT p_type AS bucket_name, p_brand AS model_str, p_name AS feats, round(p_retailprice * 100) % 1000 AS auc FROM part),
    mf AS (SELECT bucket_name, feats, median(auc) AS m FROM r GROUP BY ALL),
    mm AS (SELECT bucket_name, model_str, median(auc) AS m FROM r GROUP BY ALL)
    SELECT bucket_name, (SELECT arg_min(feats, (-m, md5(feats))) FROM mf WHERE mf.bucket_name = r.bucket_name) AS top_features,
           (SELECT arg_min(model_str, (-m, md5(model_str))) FROM mm WHERE mm.bucket_name = r.bucket_name) AS top_model,
           round(max(auc), 6) AS best_metric, arg_max(model_str || ': ' || feats, (auc, model_str, feats)) AS best_run
    FROM r GROUP BY bucket_name
    """,
)
def _(t):
    runs = t.part.select(
        F.col("p_type").alias("bucket_name"),
        F.col("p_brand").alias("model_str"),
        F.md5("p_brand").alias("model_hash"),
        F.md5("p_name").alias("feature_hash"),
        F.array("p_name").alias("features_list_alpha"),
        F.array(F.struct(F.col("p_name").alias("feature"), F.lit(1.0).alias("importance"))).alias("features_sorted"),
        (F.round(F.col("p_retailprice") * 100) % 1000).alias("auc"),
    )
    return sc.summarize_models(runs, "auc", ["bucket_name"], feature_k=100).drop("feature_counts")


@query(
    "feature_counts_of_best_models",
    """
    WITH r AS (SELECT p_type AS bucket_name, p_name AS f, round(p_retailprice * 100) % 1000 AS auc FROM part),
    cut AS (SELECT bucket_name, quantile_cont(auc, 0.8) AS c FROM r GROUP BY 1),
    n AS (SELECT bucket_name, f, count(*) AS n FROM r JOIN cut USING (bucket_name) WHERE auc >= c GROUP BY ALL)
    SELECT bucket_name, string_agg(f || ': ' || n, ', ' ORDER BY n DESC, f) AS feature_counts FROM n GROUP BY 1
    """,
)
def _(t):
    runs = t.part.select(
        F.col("p_type").alias("bucket_name"),
        F.col("p_brand").alias("model_str"),
        F.md5("p_brand").alias("model_hash"),
        F.md5("p_name").alias("feature_hash"),
        F.array("p_name").alias("features_list_alpha"),
        F.array(F.struct(F.col("p_name").alias("feature"), F.lit(1.0).alias("importance"))).alias("features_sorted"),
        (F.round(F.col("p_retailprice") * 100) % 1000).alias("auc"),
    )
    return sc.summarize_models(runs, "auc", ["bucket_name"], feature_k=100).select("bucket_name", "feature_counts")
