"""Mixing sources to target weights: temperature, then block permutations that use up each source's budget."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from .tables import written

WORD = r"[^\x20\x09-\x0D]+"


def temperature(sources: DataFrame, budget: float, total: float, evenness: float | None, repeats: float | None) -> float:
    """The largest exponent in 0 .. 1 at which weights ~ share ** exponent reach the entropy, raised if need be to
    the smallest at which no source is repeated more than the limit. `sources` has a `share` per source; each step of the
    bisection is one row of sums. If even the natural shares break the limit, they are used.
    """

    def sums(a: float):
        p = F.pow("share", F.lit(a))
        z, plogp, n, low = sources.agg(F.sum(p), F.sum(p * F.log("share")), F.count("*"), F.min("share")).first()
        return math.log(z) - a * plogp / z, math.log(n), budget / total * low ** (a - 1) / z

    def bisect(fits) -> float:
        """The boundary between exponents that fit and those that do not; 0 fits."""
        low, high = 0.0, 1.0
        if fits(high):
            return high
        for _ in range(30):
            mid = (low + high) / 2
            low, high = (mid, high) if fits(mid) else (low, mid)
        return low

    a = 1.0
    if evenness is not None:

        def even(x: float) -> bool:
            entropy, most, _ = sums(x)
            return entropy >= evenness * most - 1e-12

        a = bisect(even)
    if repeats is not None and sums(a)[2] > repeats:
        # mirrored: a distance of 0 from the natural shares fits best
        a = 1 - bisect(lambda x: sums(1 - x)[2] <= repeats)
    return a


def mixed_sources(
    docs: DataFrame,
    budget_share: float = 1.0,
    evenness: float | None = 0.97,
    repeats: float | None = 4.0,
    whole_first: bool = False,
    block_words: int = 1 << 16,
    most_blocks: int = 4096,
    seed: int = 0,
) -> DataFrame:
    """The rows of `docs` (doc_id, text, source, other columns) as often as the mixture wants them.

    Weights are token shares of the sources to an exponent (see `temperature`): `evenness` is the target entropy as a part of
    that of equal weights, `repeats` the most often a source is read. A source's budget is its weight times `budget_share`
    times all tokens; with `whole_first` the total is raised until each source is read once at least, so that
    no row is lost, and `repeats` limits the reading of a source against the least read one. A budget is used up by whole
    epochs and the start of one more; every epoch permutes the source's blocks, and the rows in each block, by hash.
    A row is taken if it starts within the budget.

    Added columns: mix_tokens (words of the text), mix_weight, mix_epoch, mix_block, mix_slot (0, 1, ... in the epoch of the
    source), mix_before (tokens before it there), mix_at (0 to 1: sorting by it interleaves the sources). Given columns of
    these names are replaced. A null source is a source; null texts have no tokens; a source without tokens is read once in
    full. Rows that are equal are permuted like others.
    """
    made = ["tokens", "weight", "epoch", "block", "slot", "before", "at"]
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in [f"mix_{m}" for m in made]])
    names = docs.columns
    inner = docs.select(
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)],
        F.struct(F.col("source").isNull(), F.coalesce("source", F.lit(""))).alias("src"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
        F.xxhash64("doc_id", "text").alias("key"),
    ).withColumn("tokens", F.coalesce("words", F.lit(0).cast("long")))
    sizes = written(inner.groupBy("src").agg(F.sum("tokens").alias("size"), F.count("*").alias("rows")), "sources")
    total, n = sizes.agg(F.sum("size"), F.count("*")).first()
    total = float(total or 0)
    shares = sizes.where("size > 0").select("src", "size", (F.col("size") / F.lit(total or 1.0)).alias("share"))
    a, z, spread = 1.0, 1.0, budget_share
    if total:
        base = total
        if whole_first and repeats is not None:
            high = shares.agg(F.max("share")).first()[0]
            low = shares.agg(F.min("share")).first()[0]
            a = 1.0 if evenness is None else temperature(shares, base, total, evenness, None)
            if high > low:  # the least read source is the largest one
                a = max(a, 1 - math.log(repeats) / math.log(high / low))
            a = min(1.0, a)
        else:
            a = temperature(shares, base * budget_share, total, evenness, repeats)
        z, most = shares.agg(F.sum(F.pow("share", F.lit(a))), F.max("share")).first()
        if whole_first:
            spread = max(budget_share, z * most ** (1 - a) * (1 + 1e-12))
    weight = F.coalesce(F.pow(F.col("share"), F.lit(a)) / F.lit(z), F.lit(0.0))
    plan = sizes.join(shares.select("src", "share"), "src", "left").withColumn("weight", weight)
    budget = F.round(F.col("weight") * F.lit(spread * total)).cast("long")
    if whole_first:
        budget = F.greatest(budget, F.col("size"))
    plan = plan.withColumn("budget", budget).withColumn(
        "blocks",
        F.greatest(F.lit(1), F.least(F.lit(most_blocks), F.ceil(F.col("size") / block_words), F.col("rows"))).cast("int"),
    )

    # a row's block by hash; sources without tokens are one epoch
    rows = inner.join(plan.select("src", "size", "weight", "budget", "blocks"), "src")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("key", F.lit(seed)), F.col("blocks")).cast("int"))
    blocks = rows.groupBy("src", "block").agg(
        F.sum("tokens").alias("block_tokens"),
        F.count("*").alias("block_rows"),
        F.first("size").alias("size"),
        F.first("budget").alias("budget"),
    )
    last = F.when(F.col("size") > 0, F.ceil(F.col("budget") / F.col("size")) - 1).otherwise(F.lit(0)).cast("int")
    epochs = blocks.where("size = 0 or budget > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.greatest(last, F.lit(0)))))
    limit = F.least("size", F.col("budget") - F.col("epoch") * F.col("size"))
    turn = Window.partitionBy("src", "epoch").orderBy(F.xxhash64(F.lit(seed), "epoch", "block"), "block")
    turn = turn.rowsBetween(Window.unboundedPreceding, -1)
    epochs = epochs.withColumn("limit", F.when(F.col("size") > 0, limit).otherwise(0)).withColumn("all", F.expr("limit = size")).select(
        F.col("src").alias("s"),
        F.col("block").alias("b"),
        "epoch",
        "limit",
        "all",
        F.coalesce(F.sum("block_tokens").over(turn), F.lit(0)).alias("tokens_before"),
        F.coalesce(F.sum("block_rows").over(turn), F.lit(0)).alias("rows_before"),
    )
    epochs = epochs.where("all or tokens_before < limit")
    copies = rows.join(epochs, (F.col("src") == F.col("s")) & (F.col("block") == F.col("b")))
    turn = Window.partitionBy("src", "epoch", "block").orderBy(F.xxhash64(F.lit(seed), "epoch", "key"), "key")
    before = F.coalesce(F.sum("tokens").over(turn.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    copies = copies.withColumn("before", F.col("tokens_before") + before)
    copies = copies.withColumn("slot", F.col("rows_before") + F.row_number().over(turn) - 1)
    copies = copies.where("all or before < limit")
    at = (F.col("epoch") * F.col("size") + F.col("before")) / F.greatest(F.col("budget"), F.lit(1))
    return copies.withColumn("at", at).select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], *[F.col(m).alias(f"mix_{m}") for m in made]
    )
