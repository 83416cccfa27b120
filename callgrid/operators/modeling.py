"""Preparation, training and scoring of models.

Classifiers are those of ``pyspark.ml``. Per-group linear models are fitted from sums of cross products, which Spark
adds up per group before any shuffle, so the size of a group does not matter.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, functions as F

from ..functions.base import as_list, flag
from .boosting import RealAdaBoost
from .neighbours import neighbour_scores
from .ordered import bucket_count, exact_quantiles

# Parameter grids tried per classifier.
CLASSIFIER_GRID = {
    "RF": {
        "n_estimators": [10, 100, 1000, 2500],
        "max_depth": [10, 20, 50, 100],
        "max_features": ["sqrt", "log2"],
        "min_samples_split": [2, 5, 10],
    },
    "LR": {"penalty": ["l1", "l2"], "C": [0.01, 0.1, 1, 10]},
    "AB": {"algorithm": ["SAMME", "SAMME.R"], "n_estimators": [1, 10, 100]},
    "GB": {
        "n_estimators": [10, 100, 1000, 2500],
        "learning_rate": [0.001, 0.01, 0.05, 0.1, 0.5],
        "subsample": [0.1, 0.5, 1.0],
        "max_depth": [5, 10, 20, 50, 100],
    },
    "NB": {},
    # A single tree looks at all features: Spark offers subsets of them to forests only.
    "DT": {"criterion": ["gini", "entropy"], "max_depth": [1, 5, 10, 20, 50, 100], "min_samples_split": [2, 5, 10]},
    "SVM": {},
    # Ways to search that give the same neighbours are one here.
    "KNN": {"n_neighbors": [1, 5, 10, 25, 50, 100], "weights": ["uniform", "distance"]},
}
# Parameter grids tried per regressor.
REGRESSOR_GRID = {
    "RIDGE": {"alpha": [0.01, 0.1, 1, 10]},
    "LINEAR": {},
    "LASSO": {"alpha": [0.01, 0.1, 1, 10]},
    "ELNET": {"alpha": [0.01, 0.1, 1, 10], "l1_ratio": [0.25, 0.5, 0.75]},
    "LARS": {},
    "LLARS": {},
    "BRIDGE": {},
}


#: The deepest tree Spark trains.
MOST_DEPTH = 30


def levels_of(df: DataFrame, column: str, most: int = 10_000) -> list:
    """Distinct values of a categorical column, sorted. More than `most` are an error, not cut off."""
    rows = df.where(F.col(column).isNotNull()).select(column).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{column} has more than {most} levels; it is no category")
    return sorted(r[0] for r in rows)


def one_hot(df: DataFrame, cats, keep_all=(), levels: dict[str, list] | None = None, most: int = 10_000) -> DataFrame:
    """Columns `{col}_is_{value}` of 0 and 1 in place of each categorical column.

    The first level in sort order is dropped, except for columns in `keep_all`. A NULL is 0 in every column. A column with
    more than `most` levels is an error; for such, ``pyspark.ml``'s StringIndexer and OneHotEncoder make one sparse vector.
    """
    levels, out = levels or {}, []
    for c in as_list(cats):
        values = levels.get(c) or levels_of(df, c, most)
        for v in values if c in as_list(keep_all) else values[1:]:
            out.append(F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_is_{v}"))
    return df.select("*", *out).drop(*as_list(cats))


def impute_median(train: DataFrame, test: DataFrame, cols) -> tuple[DataFrame, DataFrame]:
    """NULLs replaced by the exact median of the train set, in both sets."""
    names, n = as_list(cols), bucket_count(train)
    if n <= 1:
        row = train.agg(*[F.median(F.col(c).cast("double")).alias(f"m_{i}") for i, c in enumerate(names)]).first()
        medians = {c: row[f"m_{i}"] for i, c in enumerate(names)}
    else:
        medians = {c: exact_quantiles(train, c, {"m": 0.5}, n=n).first()[0] for c in names}
    known = {c: m for c, m in medians.items() if m is not None}
    fill = lambda df: df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in known.items()})
    return fill(train), fill(test)


def scaled_columns(train: DataFrame, cols) -> list[str]:
    """The columns with at least 3 distinct values, NULL counted as one; found by two aggregates without a shuffle."""
    names = as_list(cols)
    ends = train.agg(
        *[f(F.col(c).cast("double")).alias(f"{n}_{i}") for i, c in enumerate(names) for n, f in (("lo", F.min), ("hi", F.max))],
        *[F.max(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(names)],
    ).first()
    spread = [i for i in range(len(names)) if ends[f"lo_{i}"] is not None and ends[f"lo_{i}"] < ends[f"hi_{i}"]]
    if not spread:
        return []
    between = train.agg(
        *[
            F.max((F.col(names[i]) > ends[f"lo_{i}"]) & (F.col(names[i]) < ends[f"hi_{i}"])).alias(f"b_{i}")
            for i in spread
        ]
    ).first()
    return [names[i] for i in spread if between[f"b_{i}"] or ends[f"null_{i}"]]


def standardise(
    train: DataFrame, test: DataFrame, cols, label: str | None = None, chosen: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Mean 0 and population standard deviation 1 by the train set, for columns with at least 3 distinct values.

    `chosen` names the columns where that is known from elsewhere.
    """
    if chosen is None:
        chosen = scaled_columns(train, [c for c in as_list(cols) if c != label])
    if not chosen:
        return train, test
    s = train.agg(
        *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(chosen)],
        *[F.stddev_pop(c).alias(f"d_{i}") for i, c in enumerate(chosen)],
    ).first()
    scale = {c: (F.col(c) - F.lit(s[f"m_{i}"])) / F.lit(s[f"d_{i}"] or 1.0) for i, c in enumerate(chosen)}
    return train.withColumns(scale), test.withColumns(scale)


def expand_grid(models, grid: dict | None = None, buckets: dict[str, list] | None = None) -> list[dict]:
    """Every (model, parameters, bucket) to be trained. Depths beyond Spark's limit of 30 cannot be and are left out."""
    grid = grid or CLASSIFIER_GRID
    runs = []
    for model in as_list(models):
        names = sorted(grid[model])
        allowed = [[v for v in grid[model][n] if n != "max_depth" or v <= MOST_DEPTH] for n in names]
        for values in itertools.product(*allowed):
            for bucket in buckets or {"all": []}:
                runs.append({"model": model, "params": dict(zip(names, values)), "bucket": bucket})
    return runs


def classifier(name: str, label: str = "label", features: str = "features", rows: int | None = None, **p):
    """A ``pyspark.ml`` classifier by its short name and parameters.

    For LR, `C` is the weight of the data against the penalty summed over rows, so Spark's penalty per row is
    1 / (C * rows); give the number of train rows. A tree depth beyond Spark's limit of 30 is an error.
    """
    from pyspark.ml import classification as ml

    common = {"labelCol": label, "featuresCol": features}
    if (p.get("max_depth") or 0) > MOST_DEPTH:
        raise ValueError(f"trees of depth {p['max_depth']} cannot be trained; the limit is {MOST_DEPTH}")
    depth = {"maxDepth": int(p["max_depth"])} if p.get("max_depth") else {}
    leaves = {"minInstancesPerNode": max(1, int(p.get("min_samples_split", 2)) // 2)}
    if name == "LR":
        strength = 1.0 / (float(p.get("C", 1e5)) * (rows or 1))
        return ml.LogisticRegression(
            regParam=strength, elasticNetParam=1.0 if p.get("penalty", "l1") == "l1" else 0.0, standardization=False, **common
        )
    if name == "RF":
        subset = p.get("max_features", "sqrt")
        return ml.RandomForestClassifier(
            numTrees=int(p.get("n_estimators", 50)), featureSubsetStrategy=subset, seed=0, **depth, **leaves, **common
        )
    if name == "GB":
        return ml.GBTClassifier(
            maxIter=int(p.get("n_estimators", 10)),
            stepSize=float(p.get("learning_rate", 0.05)),
            subsamplingRate=float(p.get("subsample", 0.5)),
            seed=0,
            **(depth or {"maxDepth": 6}),
            **common,
        )
    if name == "DT":
        return ml.DecisionTreeClassifier(impurity=p.get("criterion", "gini"), seed=0, **depth, **leaves, **common)
    if name == "NB":
        return ml.NaiveBayes(modelType="gaussian", **common)
    if name == "SVM":
        return ml.LinearSVC(regParam=1.0 / (float(p.get("C", 1.0)) * (rows or 1)), standardization=False, **common)
    if name == "AB":
        # by class votes, or by the probabilities of the leaves
        kind = {"SAMME": AdaBoost, "SAMME.R": RealAdaBoost}[p.get("algorithm", "SAMME")]
        return kind(int(p.get("n_estimators", 200)), label, features)
    raise ValueError(f"no classifier {name}")


class AdaBoost:
    """Boosted one-level trees for two classes: each round reweights the rows the last tree got wrong."""

    def __init__(self, rounds: int, label: str = "label", features: str = "features", every: int = 10):
        self.rounds, self.label, self.features, self.every = rounds, label, features, every

    def fit(self, df: DataFrame) -> "AdaBoostModel":
        from pyspark.ml.classification import DecisionTreeClassifier

        from ..sources.scratch import checkpointed

        stump = DecisionTreeClassifier(
            maxDepth=1, labelCol=self.label, featuresCol=self.features, weightCol="__w", predictionCol="__p", seed=0
        )
        rows = df.select(self.label, self.features).withColumn("__w", F.lit(1.0)).persist()
        trees, weights = [], []
        for i in range(self.rounds):
            tree = stump.fit(rows)
            judged = tree.transform(rows).withColumn("__wrong", (F.col("__p") != F.col(self.label)).cast("double"))
            error = judged.agg(F.sum(F.col("__w") * F.col("__wrong")) / F.sum("__w")).first()[0]
            if error >= 0.5:
                break
            import math

            alpha = math.log((1 - error) / error) if error > 0 else 1.0
            trees.append(tree)
            weights.append(alpha)
            if error <= 0:
                break
            before, rows = rows, judged.select(
                self.label, self.features, (F.col("__w") * F.exp(F.lit(alpha) * F.col("__wrong"))).alias("__w")
            )
            rows = (checkpointed(rows) if (i + 1) % self.every == 0 else rows).persist()
            rows.count()
            before.unpersist()
        rows.unpersist()
        return AdaBoostModel(trees, weights)


class AdaBoostModel:
    def __init__(self, trees, weights):
        self.trees, self.weights = trees, weights

    def transform(self, df: DataFrame) -> DataFrame:
        """Add `score`: the weighted share of trees that vote for class 1."""
        out, votes = df, F.lit(0.0)
        for i, (tree, alpha) in enumerate(zip(self.trees, self.weights)):
            name = f"__vote{i}"
            out = tree.copy({tree.predictionCol: name, tree.probabilityCol: "", tree.rawPredictionCol: ""}).transform(out)
            votes = votes + F.lit(alpha) * F.col(name)
        total = sum(self.weights) or 1.0
        return out.withColumn("score", votes / F.lit(total)).drop(*[f"__vote{i}" for i in range(len(self.trees))])


def fit_score(
    train: DataFrame, test: DataFrame, label: str, key: str, features, estimator="LR", **params
) -> DataFrame:
    """Train a classifier and return (key, score, split) with the score of class 1 for both sets.

    For SVM the score is the margin, which orders rows as a probability would. KNN keeps the train rows: the score is
    the share of class 1 among a row's nearest ones.
    """
    if estimator == "KNN":
        both = test.select(key, *as_list(features), F.lit("test").alias("split")).unionByName(
            train.select(key, *as_list(features), F.lit("train").alias("split"))
        )
        keyed = both.withColumn("__row", F.struct("split", key))
        known = train.withColumn("__row", F.struct(F.lit("train").alias("split"), key))
        scored = neighbour_scores(known, keyed, label, "__row", features, **params)
        return scored.select(f"__row.{key}", "score", "__row.split")
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    pack = VectorAssembler(inputCols=as_list(features), outputCol="__features", handleInvalid="error")
    ready = lambda df: pack.transform(df.withColumn("__label", flag(F.col(label).cast("boolean")).cast("double")))
    fitted = ready(train).select("__label", "__features")
    rows = fitted.count() if estimator in ("LR", "SVM") else None
    model = classifier(estimator, "__label", "__features", rows, **params).fit(fitted)
    out = []
    for split, df in (("test", test), ("train", train)):
        scored = model.transform(ready(df))
        if estimator != "AB":
            raw = "rawPrediction" if estimator == "SVM" else "probability"
            scored = scored.withColumn("score", vector_to_array(raw)[1])
        out.append(scored.select(key, "score", F.lit(split).alias("split")))
    return out[0].unionByName(out[1])


def fit_per_group(
    df: DataFrame, group, label: str, features, model: str = "LINEAR", alpha: float = 1.0, l1_ratio: float = 0.5
) -> DataFrame:
    """One linear model per group: (group, rows, intercept, coefficients) for features scaled to mean 0, deviation 1.

    `model` is LINEAR, RIDGE, LASSO, ELNET, LARS (least angles to the end), LLARS (to the lasso of `alpha`) or BRIDGE (Bayesian
    ridge), with the usual penalties (ridge: |y - Xw|^2 + alpha |w|^2; lasso and
    elastic net: |y - Xw|^2 / 2n + alpha (l1 |w|_1 + (1 - l1) |w|^2 / 2)). Rows with a NULL are left out.
    """
    run = {"model": model, "params": {"alpha": alpha, "l1_ratio": l1_ratio}}
    return fit_grid_per_group(df, group, label, features, [run]).drop("model", "params")


def least_angle_path(q, r, stop: float = 0.0, lasso: bool = False):
    """Weights where the path of least angles has brought every feature's covariance with the residual down to `stop`.

    `q` and `r` are covariances of scaled features with each other and with the label. From the largest on, features join as
    their covariance equals that of the ones in use, which all fall together. With `lasso` a feature leaves when its weight
    returns to 0: then the weights minimise half the mean square plus `stop` times the sum of sizes. A feature that the ones in
    use determine never joins.
    """
    import numpy as np

    w, used, out = np.zeros(len(r)), [], set()
    level = float(np.abs(r).max(initial=0.0))
    joining = int(np.abs(r).argmax()) if len(r) and level > stop else None
    for _ in range(8 * len(r) + 8):
        if joining is not None:
            part = q[np.ix_(used, used)]
            rest = q[joining, joining] - (q[joining, used] @ np.linalg.lstsq(part, q[used, joining], rcond=None)[0] if used else 0.0)
            if rest <= 1e-12 * max(q[joining, joining], 1e-300):
                out.add(joining)
            else:
                used.append(joining)
        if not used or level <= stop:
            return w
        c = r - q @ w
        step = np.linalg.solve(q[np.ix_(used, used)], np.sign(c[used]))
        fall = q[:, used] @ step
        best, joining, leaving = level - stop, None, None
        for j in set(range(len(r))) - set(used) - out:
            for ahead, speed in ((level - c[j], 1 - fall[j]), (level + c[j], 1 + fall[j])):
                if speed > 1e-12 and 0 <= ahead / speed < best:
                    best, joining = max(ahead / speed, 0.0), j
        if lasso:
            for i, j in enumerate(used):
                if step[i] and 1e-14 < -w[j] / step[i] < best:
                    best, joining, leaving = -w[j] / step[i], None, j
        w[used] += best * step
        level -= best
        if leaving is not None:
            w[leaving] = 0.0
            used.remove(leaving)
        elif joining is None:
            return w
    raise ArithmeticError("the path of least angles has not ended")


def evidence_weights(q, r, spread: float, n: int, prior: float = 1e-6):
    """Bayesian ridge: weights under the noise and the spread of weights that the data make most likely.

    `spread` is the label's variance over `n` rows; the label is scaled to a variance of 1, so that its unit does not matter to
    the priors. Both precisions have gamma priors of shape and rate `prior`; they are found by fixed-point iteration on the
    eigenvalues of `q`.
    """
    import numpy as np

    if spread <= 0:
        return np.zeros(len(r))
    size = spread**0.5
    r, spread = r / size, 1.0
    values, vectors = np.linalg.eigh(q)
    values, turned = np.clip(values, 0, None) * n, vectors.T @ r * n
    alpha, beta = 1.0, 1.0
    for _ in range(10_000):
        z = alpha * turned / (beta + alpha * values)
        known = float((alpha * values / (beta + alpha * values)).sum())
        left = max(n * spread - 2 * z @ turned + (values * z) @ z, 0.0)
        new_beta = (known + 2 * prior) / (z @ z + 2 * prior)
        new_alpha = (n - known + 2 * prior) / (left + 2 * prior)
        if abs(new_alpha - alpha) <= 1e-12 * new_alpha and abs(new_beta - beta) <= 1e-12 * new_beta:
            break
        alpha, beta = new_alpha, new_beta
    return size * (vectors @ (alpha * turned / (beta + alpha * values)))


#: Up to so many features and label, moments are Spark's aggregates; a plan with one for each pair of more is dear to optimise.
FEW_TERMS = 12


def _moments_of_few(rows: DataFrame, groups: list[str], pairs: list[tuple[int, int]]) -> DataFrame:
    """(groups, rows, __avg, __cov): means of the terms `__t`, and covariances of the pairs."""
    t = [F.col("__t")[i] for i in range(pairs[-1][0] + 1)]
    return rows.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("rows"),
        F.array(*[F.avg(x) for x in t]).alias("__avg"),
        F.array(*[F.covar_pop(t[i], t[j]) for i, j in pairs]).alias("__cov"),
    )


def _moments_of_many(rows: DataFrame, groups: list[str], pairs: list[tuple[int, int]]) -> DataFrame:
    """As `_moments_of_few`: every task adds up what it has of each group, one row of sums per task and group meets the others.

    Sums are taken around means and put together around the common mean, so large values do not cancel.
    """
    import numpy as np
    import pyarrow as pa

    left, right = (np.array(x) for x in zip(*pairs, strict=True))
    lists = pa.list_(pa.float64())

    def added(a, b):
        n = a[0] + b[0]
        step = b[1] - a[1]
        return n, a[1] + step * (b[0] / n), a[2] + b[2] + np.outer(step, step) * (a[0] * b[0] / n)

    def as_table(keys: pa.Table, found: list) -> pa.Table:
        covs = [(c / n)[left, right].tolist() for n, _, c in found]
        keys = keys.append_column("rows", pa.array([n for n, _, _ in found], pa.int64()))
        keys = keys.append_column("__avg", pa.array([m.tolist() for _, m, _ in found], lists))
        return keys.append_column("__cov", pa.array(covs, lists))

    def partial(batches):
        held, where = {}, []
        for batch in batches:
            table = pa.Table.from_batches([batch])
            t = batch.column("__t").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            names = list(zip(*(table[g].to_pylist() for g in groups), strict=True))
            of = {}
            for i, name in enumerate(names):
                of.setdefault(name, []).append(i)
            for name, at in of.items():
                x = t[at]
                mean = x.mean(axis=0)
                own = (len(at), mean, (x - mean).T @ (x - mean))
                if name in held:
                    held[name] = added(held[name], own)
                else:
                    held[name] = own
                    where.append(table.select(groups).slice(at[0], 1))
        if held:
            yield from as_table(pa.concat_tables(where), list(held.values())).to_batches()

    def merged(table: pa.Table) -> pa.Table:
        total = None
        for n, m, c in zip(*(table[k].to_pylist() for k in ("rows", "__avg", "__cov")), strict=True):
            cov = np.zeros((len(m), len(m)))
            cov[left, right] = cov[right, left] = np.array(c) * n
            own = (n, np.array(m), cov)
            total = own if total is None else added(total, own)
        return as_table(table.select(groups).slice(0, 1), [total])

    kinds = ", ".join(f"`{g}` {rows.schema[g].dataType.simpleString()}" for g in groups)
    schema = f"{kinds}, rows bigint, __avg array<double>, __cov array<double>"
    return rows.mapInArrow(partial, schema).groupBy(*groups).applyInArrow(merged, schema)


def fit_grid_per_group(df: DataFrame, group, label: str, features, runs: list[dict]) -> DataFrame:
    """The linear models of every run for every group, as rows (group, model, params, rows, intercept, ...).

    The data is read once, into cross products per group; all models of a group are solved from these small sums, so
    rows of a group never meet in one place.
    """
    groups, names = as_list(group), as_list(features)
    size = len(names) + 1
    # one column of all terms: a plan with a column for each is dear to optimise
    terms = F.array(*[F.col(c).cast("double") for c in (*names, label)]).alias("__t")
    rows = df.select(*groups, terms).where(~F.exists("__t", lambda x: x.isNull() | F.isnan(x)))
    pairs = [(i, j) for i in range(size) for j in range(i + 1)]
    sums = (_moments_of_few if size <= FEW_TERMS else _moments_of_many)(rows, groups, pairs)
    kinds = ", ".join(f"`{g}` {df.schema[g].dataType.simpleString()}" for g in groups)
    schema = (
        f"{kinds}, rows bigint, model string, params string, intercept double, "
        "coefficients array<double>, means array<double>, scales array<double>"
    )

    def solve(batches):
        import numpy as np
        import pandas as pd

        def descent(q, r, l1, l2):
            """Coordinate descent on the scaled covariances q = X'X/n, r = X'y/n."""
            w = np.zeros(len(r))
            for _ in range(10_000):
                largest = 0.0
                for j in range(len(w)):
                    if q[j, j] <= 0:
                        continue
                    rho = r[j] - q[j] @ w + q[j, j] * w[j]
                    new = np.sign(rho) * max(abs(rho) - l1, 0.0) / (q[j, j] + l2)
                    largest = max(largest, abs(new - w[j]))
                    w[j] = new
                if largest < 1e-10:
                    return w
            raise ArithmeticError("coordinate descent has not converged in 10 000 sweeps")

        def weights(q, r, n, kind, p, spread):
            alpha = float(p.get("alpha", 1.0))
            if kind == "LARS":
                return least_angle_path(q, r)
            if kind == "LLARS":
                return least_angle_path(q, r, alpha, lasso=True)
            if kind == "BRIDGE":
                return evidence_weights(q, r, spread, n)
            if kind == "LINEAR":
                return np.linalg.lstsq(q, r, rcond=1e-12)[0]
            if kind == "RIDGE":
                return np.linalg.solve(q + np.eye(len(r)) * alpha / n, r)
            l1 = 1.0 if kind == "LASSO" else float(p.get("l1_ratio", 0.5))
            return descent(q, r, alpha * l1, alpha * (1.0 - l1))

        for pdf in batches:
            found = []
            for row in pdf.to_dict("records"):
                cov = np.zeros((size, size))
                for (i, j), c in zip(pairs, row.pop("__cov")):
                    cov[i, j] = cov[j, i] = c
                means = np.array(row.pop("__avg"), dtype=float)
                scale = np.sqrt(np.clip(np.diag(cov)[:-1], 0, None))
                scale[scale == 0] = 1.0
                q, r = cov[:-1, :-1] / np.outer(scale, scale), cov[:-1, -1] / scale
                for run in runs:
                    w = weights(q, r, row["rows"], run["model"], run["params"], cov[-1, -1])
                    found.append(
                        {
                            **row,
                            "model": run["model"],
                            "params": str(run["params"]),
                            "intercept": means[-1],
                            "coefficients": w.tolist(),
                            "means": means[:-1].tolist(),
                            "scales": scale.tolist(),
                        }
                    )
            yield pd.DataFrame(found, columns=[*groups, "rows", "model", "params", "intercept", "coefficients", "means", "scales"])

    return sums.mapInPandas(solve, schema)


def predict_per_group(df: DataFrame, models: DataFrame, group, features, out: str = "pred") -> DataFrame:
    """Rows with the prediction of their group's linear model."""
    names = as_list(features)
    given = F.array(*[F.col(f).cast("double") for f in names])
    terms = F.transform(given, lambda x, i: F.col("coefficients")[i] * (x - F.col("means")[i]) / F.col("scales")[i])
    guess = F.aggregate(terms, F.col("intercept"), lambda sum, x: sum + x)
    joined = df.join(models.drop("rows"), as_list(group), "left").withColumn(out, guess)
    return joined.drop("intercept", "coefficients", "means", "scales")


def logistic_gain_by_type(
    train: DataFrame, test: DataFrame, kind: str, x: str, label: str, min_rows: int = 50, c: float = 1.0
) -> DataFrame:
    """Per type with enough rows: accuracy on test of a logistic regression on one predictor, against the base rate.

    The predictor takes few values (the hour), so train and test shrink to one line per (type, value) before the fit.
    The squared weights are penalised, the intercept too, against `c` times the log loss.
    """
    part = lambda df, i: df.where(F.col(label).isNotNull() & F.col(x).isNotNull()).select(
        F.col(kind).alias("kind"), F.col(x).cast("double").alias("x"), flag(label).alias("y"), F.lit(i).alias("split")
    )
    lines = (
        part(train, 0)
        .unionByName(part(test, 1))
        .groupBy("kind", "x")
        .agg(
            *[
                F.sum(F.when((F.col("split") == i) & (F.col("y") == j), 1).otherwise(0)).cast("double").alias(name)
                for name, i, j in (("n0", 0, 0), ("n1", 0, 1), ("m0", 1, 0), ("m1", 1, 1))
            ]
        )
    )

    def fit(pdf):
        import numpy as np
        import pandas as pd

        x_, n0, n1, m0, m1 = (pdf[k].to_numpy(dtype=float) for k in ("x", "n0", "n1", "m0", "m1"))
        rows, tested = (n0 + n1 + m0 + m1).sum(), (m0 + m1).sum()
        answer = pd.DataFrame({"inc_type_id": [pdf["kind"].iloc[0]], "logistic_acc": [np.nan], "base_acc": [np.nan]})
        if rows < min_rows or n0.sum() == 0 or n1.sum() == 0 or tested == 0:
            return answer
        design, n, w = np.stack([np.ones_like(x_), x_], 1), n0 + n1, np.zeros(2)
        for _ in range(100):
            p = 1 / (1 + np.exp(-design @ w))
            gradient = w + c * design.T @ (n * p - n1)
            hessian = np.eye(2) + c * (design * (n * p * (1 - p))[:, None]).T @ design
            step = np.linalg.solve(hessian, gradient)
            w = w - step
            if np.abs(step).max() < 1e-10:
                break
        else:
            raise ArithmeticError("Newton's method has not converged in 100 steps")
        right = np.where(design @ w > 0, m1, m0).sum()
        base = n1.sum() / n.sum()
        answer["logistic_acc"], answer["base_acc"] = right / tested, base**2 + (1 - base) ** 2
        return answer

    kind_type = train.schema[kind].dataType.simpleString()
    fitted = lines.groupBy("kind").applyInPandas(fit, f"inc_type_id {kind_type}, logistic_acc double, base_acc double")
    gain = (F.col("logistic_acc") - F.col("base_acc")) / F.col("base_acc")
    return fitted.where(F.col("logistic_acc").isNotNull() & ~F.isnan("logistic_acc")).withColumn("pct_acc_gain", gain)
