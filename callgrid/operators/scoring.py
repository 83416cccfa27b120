"""Evaluation of scores and rules.

Scores are first merged to one row per distinct score; cumulative counts over those rows give thresholds, curves and
the exact area under the ROC curve, without a window over unmerged rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.base import Col, as_list, col, count_if, flag
from ..functions.text import family, lookup, urgency
from .ordered import bucket_count, running_sums, row_positions

# Weight of a true positive, false negative, false positive and true negative per urgency bucket.
SCORE_WEIGHTS = {
    "high": (3.0, -5.0, -1.0, 1.0),
    "medium": (2.0, -3.0, -3.0, 2.0),
    "low": (1.0, -1.0, -5.0, 3.0),
    "other": (1.0, -1.0, -1.0, 1.0),
}
# The same for the dispatch dictionary.
DICTIONARY_WEIGHTS = {
    "high": (10.0, -10.0, -1.0, 1.0),
    "medium": (3.0, -3.0, -1.0, 1.0),
    "low": (1.0, -1.0, -1.0, 1.7),
    "other": (1.0, -1.0, -1.0, 1.0),
}
# The same for the search over two buckets.
SEARCH_WEIGHTS = {"medium": (3.0, -3.0, -1.0, 1.0), "low": (1.0, -1.0, -1.0, 1.7)}
# Shares of the population at which metrics are reported.
CUTS = (0.05, 0.3, 0.6, 0.9)
# Percent of a code's calls to predict positive, by urgency.
CUT_BY_URGENCY = {"low": 30, "medium": 60, "high": 90}


def score_counts(df: DataFrame, y: Col, score: Col, keys=()) -> DataFrame:
    """(keys, score, n, pos): rows and positive rows per distinct score; rows without label or score are left out."""
    present = df.select(*as_list(keys), col(score).cast("double").alias("score"), col(y).alias("__y"))
    return (
        present.where("score is not null and __y is not null")
        .groupBy(*as_list(keys), "score")
        .agg(F.count(F.lit(1)).alias("n"), count_if("__y").alias("pos"))
    )


def _ranked(df: DataFrame, y: Col, score: Col, keys, down: bool, n: int | None) -> DataFrame:
    counts = score_counts(df, y, score, keys)
    sign = -F.col("score") if down else F.col("score")
    return running_sums(
        counts.withColumn("__order", sign),
        {"cum_n": "n", "cum_pos": "pos"},
        ["__order"],
        keys,
        totals={"cum_n": "rows", "cum_pos": "positives"},
        n=n or bucket_count(df),
    ).drop("__order")


def metrics_at_k(
    df: DataFrame, y: Col, score: Col, ks=CUTS, weights=SCORE_WEIGHTS["other"], keys=(), n: int | None = None
) -> DataFrame:
    """Per key and k: threshold, precision, recall, AUC and weighted score per row.

    The threshold is the score at position int(k * rows) from the highest; everything at or above it counts as
    predicted positive. AUC is NULL when only one class occurs.
    """
    keys = as_list(keys)
    ranked = _ranked(df, y, score, keys, True, n)
    neg = F.col("n") - F.col("pos")
    won = neg.cast("double") * (F.col("cum_pos") - F.col("pos") / 2)
    aggs = [F.max("rows").alias("rows"), F.max("positives").alias("positives"), F.sum(won).alias("__won")]
    for i, k in enumerate(ks):
        reached = F.col("cum_n") > F.floor(F.lit(float(k)) * F.col("rows"))
        aggs += [
            F.max(F.when(reached, F.col("score"))).alias(f"__s{i}"),
            F.min(F.when(reached, F.col("cum_n"))).alias(f"__n{i}"),
            F.min(F.when(reached, F.col("cum_pos"))).alias(f"__p{i}"),
        ]
    wide = ranked.groupBy(*keys).agg(*aggs)
    cuts = F.array(
        *[
            F.struct(
                F.lit(float(k)).alias("k"),
                F.col(f"__s{i}").alias("threshold"),
                F.col(f"__n{i}").alias("predicted"),
                F.col(f"__p{i}").alias("tp"),
            )
            for i, k in enumerate(ks)
        ]
    )
    rows, positives = F.col("rows"), F.col("positives")
    long = wide.select(*keys, "rows", "positives", "__won", F.explode(cuts).alias("c"))
    tp, predicted = F.col("c.tp"), F.col("c.predicted")
    fn, fp = positives - tp, predicted - tp
    tn = rows - positives - fp
    w_tp, w_fn, w_fp, w_tn = weights
    return long.select(
        *keys,
        "c.k",
        "c.threshold",
        F.try_divide(tp.cast("double"), predicted).alias("precision"),
        F.try_divide(tp.cast("double"), positives).alias("recall"),
        F.try_divide(F.col("__won"), positives.cast("double") * (rows - positives)).alias("auc"),
        F.try_divide(w_tp * tp + w_fn * fn + w_fp * fp + w_tn * tn, rows.cast("double")).alias("score"),
    )


def pr_curve(df: DataFrame, y: Col, score: Col, keys=(), n: int | None = None) -> DataFrame:
    """Precision and recall by share of the population at each threshold, down to where recall first reaches 1."""
    ranked = _ranked(df, y, score, keys, True, n)
    return ranked.where(F.col("cum_pos") - F.col("pos") < F.col("positives")).select(
        *as_list(keys),
        F.col("score").alias("threshold"),
        (F.col("cum_n") / F.col("rows")).alias("pct_above"),
        (F.col("cum_pos") / F.col("cum_n")).alias("precision"),
        (F.col("cum_pos") / F.col("positives")).alias("recall"),
    )


def cut_stats(df: DataFrame, y: Col, score: Col, shares, keys=(), n: int | None = None) -> DataFrame:
    """Per key and share k: the (1 - k) percentile of the scores and the rows at or above, and above, that level.

    Every distinct score knows which ranks it covers, so each cut is found on the one or two rows it falls on.
    """
    keys = as_list(keys)
    ranked = _ranked(df, y, score, keys, False, n)
    start, end = F.col("cum_n") - F.col("n"), F.col("cum_n")

    def place(k: Column) -> Column:
        at = F.round((1 - k) * (F.col("rows") - 1), 9)
        return F.struct(k.alias("k"), at.alias("at"), F.floor(at).alias("lo"), F.ceil(at).alias("hi"))

    cuts = [k if isinstance(k, Column) else F.lit(float(k)) for k in as_list(shares)]
    covers = lambda rank: (rank >= start) & (rank < end)
    met = F.filter(F.transform(F.array(*cuts), place), lambda c: covers(c["lo"]) | covers(c["hi"]))
    hits = ranked.withColumn("c", F.explode(met))
    at_lo, at_hi = covers(F.col("c.lo")), covers(F.col("c.hi"))
    found = hits.groupBy(*keys, F.col("c.k").alias("k")).agg(
        F.max("rows").alias("rows"),
        F.max("positives").alias("positives"),
        F.max(F.col("c.at") - F.col("c.lo")).alias("share"),
        F.max(F.when(at_lo, F.col("score"))).alias("low"),
        F.max(F.when(at_hi, F.col("score"))).alias("high"),
        F.max(F.when(at_hi, start)).alias("n_below"),
        F.max(F.when(at_hi, F.col("cum_pos") - F.col("pos"))).alias("pos_below"),
        F.max(F.when(at_hi, end)).alias("n_upto"),
        F.max(F.when(at_hi, F.col("cum_pos"))).alias("pos_upto"),
    )
    # above the level lie the upper neighbour and beyond, unless the level is that neighbour itself
    on_it = (F.col("share") == 0) | (F.col("low") == F.col("high"))
    return found.select(
        *keys,
        "k",
        "rows",
        "positives",
        (F.col("low") + (F.col("high") - F.col("low")) * F.col("share")).alias("level"),
        (F.col("rows") - F.col("n_below")).alias("n_ge"),
        (F.col("positives") - F.col("pos_below")).alias("pos_ge"),
        (F.col("rows") - F.when(on_it, F.col("n_upto")).otherwise(F.col("n_below"))).alias("n_gt"),
        (F.col("positives") - F.when(on_it, F.col("pos_upto")).otherwise(F.col("pos_below"))).alias("pos_gt"),
    )


def bucket_weights(df: DataFrame, bucket: str, weights: dict | None = None) -> DataFrame:
    """Add w_tp, w_fn, w_fp, w_tn of the row's urgency bucket."""
    out = {}
    for i, name in enumerate(("w_tp", "w_fn", "w_fp", "w_tn")):
        value = F.lit(None).cast("double")
        for key, w in (weights or SCORE_WEIGHTS).items():
            value = F.when(F.col(bucket) == key, F.lit(float(w[i]))).otherwise(value)
        out[name] = value
    return df.withColumns(out)


def suggest(
    df: DataFrame, frac: str, bucket: str, weights: dict | None = None, out: str = "mt_suggested", always=("high",)
) -> DataFrame:
    """Whether sending scores higher than not sending, given the share of calls that end in a transport."""
    weighted = bucket_weights(df, bucket, weights or DICTIONARY_WEIGHTS)
    f = F.col(frac)
    sent = f * F.col("w_tp") + (1 - f) * F.col("w_fp")
    kept = f * F.col("w_fn") + (1 - f) * F.col("w_tn")
    decided = F.col(bucket).isin(*as_list(always)) | F.coalesce(sent > kept, F.lit(False))
    return weighted.withColumn(out, decided).drop("w_tp", "w_fn", "w_fp", "w_tn")


def reg_metrics(
    df: DataFrame,
    y: str,
    yhat: str,
    order,
    final_weight: float = 0.1,
    schedule: str = "exp",
    overunder=(1.0, 1.0),
    keys=(),
    n: int | None = None,
) -> DataFrame:
    """mape, mse (the root of the mean squared error), mae and twscore per key.

    twscore weights relative errors by position, falling from 1 to `final_weight`, and by direction: the first
    `overunder` weight where the prediction is too high, the second elsewhere. Rows with a true value of 0 have no
    relative error.
    """
    import math

    keys = as_list(keys)
    at = row_positions(df, order, keys, "__i", n)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    if keys:
        at = at.join(sizes, keys)
        rows = F.col("__rows")
    else:
        rows = sizes.select("__rows").scalar()
    i = F.col("__i")
    if schedule == "exp":
        weight = F.exp(-F.coalesce(F.try_divide(i * F.lit(math.log(1 / final_weight)), rows - 1), F.lit(0.0)))
    else:
        weight = (i + 1) * F.lit(final_weight - 1.0) / rows + 1
    true, guess = F.col(y).cast("double"), F.col(yhat).cast("double")
    error = F.abs(guess - true)
    over, under = overunder
    side = F.when(true < guess, F.lit(float(over))).otherwise(F.lit(float(under)))
    relative = F.when(true != 0, error / true)
    return at.groupBy(*keys).agg(
        F.avg(relative).alias("mape"),
        F.sqrt(F.avg(error * error)).alias("mse"),
        F.avg(error).alias("mae"),
        F.avg(side * relative * weight).alias("twscore"),
    )


def lift_by_code(
    df: DataFrame, code: str, score: Col, label: Col, k_by_urgency: dict | None = None, n: int | None = None
) -> DataFrame:
    """Per code: gain of accuracy over the base rate, and of recall over k, and both times the code's size.

    The share k predicted positive depends on the code's urgency; codes without one are left out.
    """
    cuts = {name: k / 100 for name, k in (k_by_urgency or CUT_BY_URGENCY).items()}
    wanted = lookup(urgency(code), cuts)
    ranked = df.where(wanted.isNotNull())
    stats = cut_stats(ranked, label, score, sorted(set(cuts.values())), [code], n).where(F.col("k") == wanted)
    rows, positives = F.col("rows").cast("double"), F.col("positives").cast("double")
    tp, fp = F.col("pos_gt"), F.col("n_gt") - F.col("pos_gt")
    correct = (tp + (rows - positives - fp)) / rows
    base = positives / rows
    precision_gain = F.try_divide(correct - base, base)
    recall_gain = (F.try_divide(tp.cast("double"), positives) - F.col("k")) / F.col("k")
    return stats.select(
        code,
        precision_gain.alias("precision_gain"),
        recall_gain.alias("recall_gain"),
        (precision_gain * rows).alias("precision_gain_n"),
        (recall_gain * rows).alias("recall_gain_n"),
    )


def confusion_by_code(
    df: DataFrame, code: str, score: Col, label: Col, protocol: Col, share: float = 0.445, n: int | None = None
) -> DataFrame:
    """Per code: confusion shares of the protocol, and of predicting the given share with the highest scores."""
    model = cut_stats(df, label, score, [share], [code], n).select(
        code,
        (F.col("pos_ge") / F.col("rows")).alias("model_tp"),
        ((F.col("n_ge") - F.col("pos_ge")) / F.col("rows")).alias("model_fp"),
        ((F.col("positives") - F.col("pos_ge")) / F.col("rows")).alias("model_fn"),
        ((F.col("rows") - F.col("positives") - F.col("n_ge") + F.col("pos_ge")) / F.col("rows")).alias("model_tn"),
    )
    known = df.where(col(protocol).isNotNull() & col(label).isNotNull())
    p, o = flag(protocol), flag(label)
    old = known.groupBy(code).agg(
        F.avg(p * o).alias("protocol_tp"),
        F.avg(p * (1 - o)).alias("protocol_fp"),
        F.avg((1 - p) * o).alias("protocol_fn"),
        F.avg((1 - p) * (1 - o)).alias("protocol_tn"),
    )
    return old.join(model, code, "full_outer")


def compare_to_protocol(df: DataFrame, score: Col, label: Col, protocol: Col, share: float | None = None) -> DataFrame:
    """Confusion shares of the protocol and of the model when both send equally often (or to the given share)."""
    p, o = flag(protocol), flag(label)
    rates = df.agg(
        F.lit("protocol").alias("rule"),
        F.avg(p * o).alias("tp"),
        F.avg(p * (1 - o)).alias("fp"),
        F.avg((1 - p) * o).alias("fn"),
        F.avg((1 - p) * (1 - o)).alias("tn"),
    )
    k = share if share is not None else df.agg(F.avg(p).alias("k")).scalar()
    m = cut_stats(df, label, score, [k])
    rows = F.col("rows")
    model = m.select(
        F.lit("model").alias("rule"),
        (F.col("pos_ge") / rows).alias("tp"),
        ((F.col("n_ge") - F.col("pos_ge")) / rows).alias("fp"),
        ((F.col("positives") - F.col("pos_ge")) / rows).alias("fn"),
        ((rows - F.col("positives") - F.col("n_ge") + F.col("pos_ge")) / rows).alias("tn"),
    )
    return rates.unionByName(model)


def k_search(
    low: DataFrame,
    medium: DataFrame,
    label: str,
    score: str,
    total: Column | int,
    low_range=(0.3, 0.8),
    medium_range=(0.6, 0.9),
    step: float = 0.01,
    weights: dict | None = None,
    goal: float = 0.4,
    margin: float = 0.05,
    n: int | None = None,
) -> DataFrame:
    """The pair of cuts for two buckets with the best weighted score among those near a true negative share.

    Every pair of the grid is tried. Each bucket is reduced to one line per cut first; the pairs are formed by
    exploding the second bucket's lines (one per cut) next to the first's.
    """
    weights = weights or SEARCH_WEIGHTS

    def lines(df: DataFrame, span, w) -> DataFrame:
        steps = int(round((span[1] - span[0]) / step)) + 1
        cuts = [round(span[0] + i * step, 10) for i in range(steps)]
        s = cut_stats(df, label, score, cuts, n=n)
        tp, fp = F.col("pos_ge"), F.col("n_ge") - F.col("pos_ge")
        fn = F.col("positives") - tp
        tn = F.col("rows") - F.col("positives") - fp
        return s.select("k", "level", tn.alias("tn"), (w[0] * tp + w[1] * fn + w[2] * fp + w[3] * tn).alias("wsc"))

    second = lines(medium, medium_range, weights["medium"])
    packed = second.agg(F.collect_list(F.struct("k", "level", "tn", "wsc")).alias("m")).scalar()
    pairs = lines(low, low_range, weights["low"]).withColumn("m", F.explode(packed))
    share = (F.col("tn") + F.col("m.tn")) / (F.lit(total) if isinstance(total, int) else total)
    found = pairs.select(
        F.col("k").alias("k_low"),
        F.col("m.k").alias("k_medium"),
        F.col("level").alias("level_low"),
        F.col("m.level").alias("level_medium"),
        (F.col("wsc") + F.col("m.wsc")).alias("score"),
        share.alias("tn_share"),
    )
    near = found.where(F.col("tn_share").between(goal - margin, goal + margin))
    return near.orderBy(F.desc("score"), "k_low", "k_medium").limit(1)


def complete_scores(df: DataFrame, bucket_col: str, bucket: str, score_cols) -> DataFrame:
    """Rows of a bucket with the most scores any of its rows has, and the score columns none of them lacks."""
    scores = as_list(score_cols)
    present = sum((F.col(c).isNotNull().cast("int") for c in scores), F.lit(0))
    rows = df.where(F.col(bucket_col) == bucket).withColumn("__n", present)
    full = rows.where(F.col("__n") == rows.agg(F.max("__n").alias("n")).scalar()).drop("__n")
    gaps = full.agg(*[F.max(F.col(c).isNull()).alias(c) for c in scores]).first()
    return full.drop(*[c for c in scores if gaps[c] is not False])


def summarize_models(
    df: DataFrame, metric: str, group=("bucket_name", "weights_str"), model_k: float = 80, feature_k: float = 10
) -> DataFrame:
    """Per bucket and weights: best feature set and best model by median metric, best single run, frequent features.

    The frame has one row per trained model: feature_hash, model_hash, model_str, features_list_alpha,
    features_sorted (as of `sort_by_abs`) and the metric. Equal medians go to the smaller hash.
    """
    from ..functions.model_json import top_share

    group = as_list(group)
    df = df.withColumn("__f", F.array_join("features_list_alpha", ", "))

    def best(hash_col: str, text: str, out: str) -> DataFrame:
        medians = df.groupBy(*group, hash_col).agg(F.median(metric).alias("m"), F.min(text).alias("t"))
        top = F.struct((-F.col("m")).alias("a"), F.col(hash_col).alias("b"))
        return medians.groupBy(*group).agg(F.min_by("t", top).alias(out))

    single = df.groupBy(*group).agg(
        F.max_by(F.concat_ws(": ", "model_str", "__f"), F.struct(metric, "model_str", "__f")).alias("best_run"),
        F.max(metric).alias("best_metric"),
        F.percentile(metric, F.lit(model_k / 100)).alias("__cut"),
    )
    kept = df.join(single.select(*group, "__cut"), group).where(F.col(metric) >= F.col("__cut"))
    counts = (
        kept.select(*group, F.explode(top_share(F.col("features_sorted"), feature_k)).alias("f"))
        .groupBy(*group, F.col("f.feature").alias("feature"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*group)
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("a"), F.col("feature").alias("b")))).alias("c"))
    )
    joined = F.array_join(
        F.transform("c", lambda x: F.concat(x["b"], F.lit(": "), (-x["a"]).cast("string"))), ", "
    )
    return (
        best("feature_hash", "__f", "top_features")
        .join(best("model_hash", "model_str", "top_model"), group)
        .join(single.drop("__cut"), group)
        .join(counts.select(*group, joined.alias("feature_counts")), group, "left")
    )


def importance_by_family(df: DataFrame, feature: str, importance: str, families, group=()) -> DataFrame:
    """Sum, median and share of the absolute importance per feature family."""
    keys = as_list(group)
    size = F.abs(F.col(importance))
    per_family = df.groupBy(*keys, family(feature, families).alias("family")).agg(
        F.sum(size).alias("total"), F.median(size).alias("median")
    )
    if not keys:
        whole = df.agg(F.sum(size).alias("t")).scalar()
        return per_family.withColumn("share", F.try_divide(F.col("total"), whole))
    sums = df.groupBy(*keys).agg(F.sum(size).alias("__t"))
    return per_family.join(sums, keys).withColumn("share", F.try_divide(F.col("total"), F.col("__t"))).drop("__t")
