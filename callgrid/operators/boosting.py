"""Boosting of one-cut trees by leaf probabilities (the real-valued variant), for two classes.

Features are put into bins once, and rows equal in bins and class become one with a count. A round is one pass: the weights of
each (feature, bin, class) are added up in Spark, the driver picks the best cut from these few sums. A row's weight follows
from the log odds of the leaves it fell into, so no weights are stored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.scratch import checkpointed

#: Bins of a feature.
BINS = 32
#: Probabilities of a leaf are no closer than this to 0 and 1.
LEAST_SHARE = 2.0**-52


def cut_points(df: DataFrame, names: list[str], bins: int = BINS) -> list[list[float]]:
    """For each column the values that end a bin: up to `bins` - 1 approximate quantiles."""
    found = df.approxQuantile(names, [i / bins for i in range(1, bins)], 0.1 / bins)
    return [sorted(set(x)) for x in found]


def binned(x: Column, cuts: list[float]) -> Column:
    """How many of the cuts a value lies beyond."""
    return F.size(F.filter(F.lit(cuts), lambda c: c < x)) if cuts else F.lit(0)


def best_cut(sums: dict[tuple[int, int], list[float]]) -> tuple[int, int, float, float]:
    """(feature, last bin on the left, log odds on the left, on the right) of the cut that leaves the least Gini impurity.

    `sums` has the weights of class 0 and 1 for each (feature, bin). Ties go to the first feature, then to the first bin; where
    nothing can be cut, both sides are the whole.
    """

    def impurity(a: float, b: float) -> float:
        return 2 * a * b / (a + b) if a + b > 0 else 0.0

    def odds(a: float, b: float) -> float:
        share = min(max(b / (a + b), LEAST_SHARE), 1 - LEAST_SHARE) if a + b > 0 else 0.5
        return math.log(share) - math.log1p(-share)

    features = sorted({f for f, _ in sums})
    best, least = None, math.inf
    for f in features:
        own = sorted((b, *w) for (g, b), w in sums.items() if g == f)
        total = [math.fsum(w[1] for w in own), math.fsum(w[2] for w in own)]
        if best is None:
            best, least = (f, own[-1][0], odds(*total), odds(*total)), impurity(*total)
        left = [0.0, 0.0]
        for b, zero, one in own[:-1]:
            left = [left[0] + zero, left[1] + one]
            right = [max(total[0] - left[0], 0.0), max(total[1] - left[1], 0.0)]
            found = impurity(*left) + impurity(*right)
            if found < least * (1 - 1e-12):
                best, least = (f, b, odds(*left), odds(*right)), found
    return best


class RealAdaBoost:
    """`rounds` cuts, each fitted to rows weighted by how wrong the ones before are."""

    def __init__(self, rounds: int, label: str = "label", features: str = "features", every: int = 10):
        self.rounds, self.label, self.features, self.every = rounds, label, features, every

    def fit(self, df: DataFrame) -> RealAdaBoostModel:
        from pyspark.ml.functions import vector_to_array

        wide = df.select(F.col(self.label).cast("int").alias("y"), vector_to_array(self.features).alias("x"))
        first = wide.select(F.size("x")).first()
        if first is None:
            raise ValueError("no rows to train with")
        names = [f"x{i}" for i in range(first[0])]
        cuts = cut_points(wide.select(*[F.col("x")[i].alias(n) for i, n in enumerate(names)]), names)
        bins = F.array(*[binned(F.col("x")[i], c) for i, c in enumerate(cuts)]).alias("bins")
        rows = wide.select("y", bins).groupBy("y", "bins").agg(F.count(F.lit(1)).cast("double").alias("n"))
        rows = checkpointed(rows.withColumn("margin", F.lit(0.0)))
        stumps: list[tuple[int, int, float, float]] = []
        new: list[tuple[int, int, float, float]] = []
        for _ in range(self.rounds):
            margin = F.col("margin") + margin_of(F.col("bins"), new)
            weight = F.col("n") * F.exp(-(F.col("y") - 0.5) * margin)
            each = rows.select("y", weight.alias("w"), F.posexplode("bins").alias("f", "b"))
            side = lambda k: F.sum(F.when(F.col("y") == k, F.col("w")).otherwise(0.0))
            sums = each.groupBy("f", "b").agg(side(0).alias("zero"), side(1).alias("one"))  # a row for each bin
            stump = best_cut({(r["f"], r["b"]): [r["zero"], r["one"]] for r in sums.collect()})
            stumps.append(stump)
            new.append(stump)
            if len(new) == self.every:
                rows = checkpointed(rows.withColumn("margin", margin + margin_of(F.col("bins"), [stump])))
                new = []
        return RealAdaBoostModel(stumps, cuts, self.features)


def margin_of(bins: Column, stumps: list[tuple[int, int, float, float]]) -> Column:
    """The sum of the leaves' log odds."""
    out = F.lit(0.0)
    for f, b, left, right in stumps:
        out = out + F.when(bins[f] <= b, F.lit(left)).otherwise(F.lit(right))
    return out


class RealAdaBoostModel:
    def __init__(self, stumps, cuts, features: str):
        self.stumps, self.cuts, self.features = stumps, cuts, features

    def transform(self, df: DataFrame) -> DataFrame:
        """Add `score`: the probability of class 1 by the mean of the leaves' log odds."""
        from pyspark.ml.functions import vector_to_array

        bins = F.array(*[binned(F.col("__x")[i], c) for i, c in enumerate(self.cuts)])
        held = df.withColumn("__x", vector_to_array(self.features)).withColumn("__bins", bins)
        margin = margin_of(F.col("__bins"), self.stumps) / max(1, len(self.stumps))
        return held.withColumn("score", 1 / (1 + F.exp(-margin))).drop("__x", "__bins")
