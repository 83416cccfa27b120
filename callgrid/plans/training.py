"""Grids of classifiers on incidents and of regressors on daily demand."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, functions as F

from ..functions.base import as_list
from ..operators import modeling, scoring
from ..operators.filters import split_by_year, split_last_days, subset_bucket


def sample_incidents(
    features: DataFrame, categories, code: str = "code_type", year: str = "time_year", years=(2013, 2, 2015, 1)
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by years with one-hot categories; the code column itself stays for the buckets."""
    cats = [c for c in as_list(categories) if c != code]
    levels = {c: modeling.levels_of(features, c) for c in cats}
    train, test = split_by_year(features, year, *years)
    return modeling.one_hot(train, cats, levels=levels), modeling.one_hot(test, cats, levels=levels)


def bucket_features(features, codes=None, code: str = "code_type") -> list[str]:
    """The features of a bucket: those given, and one column per code of the bucket but the first."""
    return [*as_list(features), *[f"{code}_is_{v}" for v in sorted(codes or [])[1:]]]


def prepare_bucket(train: DataFrame, test: DataFrame, features, label: str, codes=None, code: str = "code_type"):
    """Train and test rows of one urgency bucket with its code columns, imputed and scaled by its train rows.

    Which columns are scaled is seen from all train rows as they come: before the bucket is cut out and before
    NULLs, which count as a value, are imputed. Code columns are 0 and 1 and stay so.
    """
    scaled = modeling.scaled_columns(train, [c for c in as_list(features) if c != label])
    if codes:
        train, test = subset_bucket(train, code, codes), subset_bucket(test, code, codes)
        dummies = {f"{code}_is_{v}": (F.col(code) == F.lit(v)).cast("int") for v in sorted(codes)[1:]}
        train, test = train.withColumns(dummies), test.withColumns(dummies)
    train, test = modeling.impute_median(train, test, features)
    return modeling.standardise(train, test, scaled, label, chosen=scaled)


def run_classifier(
    train: DataFrame, test: DataFrame, label: str, key: str, features, model: str, params: dict, weights
) -> tuple[DataFrame, DataFrame]:
    """(scores, metrics of the test scores) of one run on prepared rows."""
    scores = modeling.fit_score(train, test, label, key, features, model, **params)
    tested = scores.where("split = 'test'").join(test.select(key, label), key)
    return scores, scoring.metrics_at_k(tested, label, "score", weights=weights)


def run_grid(
    train, test, label, key, features, models, buckets, code: str = "code_type", grid=None, weights: dict | None = None, workers: int = 4
) -> DataFrame:
    """Metrics of every (model, parameters, bucket).

    Rows are prepared once per bucket and kept while models are trained; each run is a set of Spark jobs that
    leaves one line per cut. `workers` runs go on at a time, in a scheduler pool for each bucket; lines come in the order of the
    runs, whichever ends first.
    """
    spark, weights = train.sparkSession, weights or scoring.SCORE_WEIGHTS
    jobs, kept = [], []
    for bucket, codes in buckets.items():
        ready = [df.persist() for df in prepare_bucket(train, test, features, label, codes, code)]
        kept += ready
        jobs += [(bucket, ready, bucket_features(features, codes, code), run) for run in modeling.expand_grid(models, grid)]

    def trained(job):
        bucket, ready, names, run = job
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", str(bucket))
        _, metrics = run_classifier(*ready, label, key, names, run["model"], run["params"], weights.get(bucket, weights["other"]))
        named = {"model": run["model"], "params": str(run["params"]), "bucket": bucket}
        metrics = metrics.select(*[F.lit(v).alias(k) for k, v in named.items()], "*")
        return metrics.schema, metrics.collect()

    try:
        with ThreadPoolExecutor(max(1, workers)) as pool:
            done = list(pool.map(inheritable_thread_target(trained), jobs))
    finally:
        for df in kept:
            df.unpersist()
    if not done:
        raise ValueError("no models or no buckets")
    return spark.createDataFrame([r for _, rows in done for r in rows], done[0][0])


def run_regressors(
    days: DataFrame,
    label: str,
    features,
    group: str = "station_name",
    day: str = "day",
    first_year: int = 2013,
    test_days: int = 7,
    models=("LASSO", "LINEAR"),
    grid=None,
    final_weight: float = 0.1,
    schedule: str = "exp",
    overunder=(1.0, 3.0),
) -> DataFrame:
    """Metrics per station of every (model, parameters) on the last days; one pass over the train rows fits them all."""
    train, test = split_last_days(days, day, first_year, test_days)
    baseline = "YES" if all("lag" in f for f in as_list(features)) else "NO"
    runs = modeling.expand_grid(models, grid or modeling.REGRESSOR_GRID)
    fitted = modeling.fit_grid_per_group(train, group, label, features, runs)
    predicted = modeling.predict_per_group(test, fitted, group, features).where("pred is not null")
    keys = ["model", "params", group]
    metrics = scoring.reg_metrics(predicted, label, "pred", [day], final_weight, schedule, overunder, keys)
    return metrics.withColumn("baseline", F.lit(baseline))
