"""Permutation attribution (M7): how much worse a model's predictions get when one feature is shuffled.

The shuffle is a join: every row has its number in a fixed global order, and its number in the order of a seeded hash;
the row with number i takes the feature of the row whose hash number is i. Both numberings are range sorts
(``ordered.numbered``), so that no task or driver holds the permutation, and one join per seed serves all features: each
pair of rows is turned into one row per feature, with that feature alone taken from the partner, scored in one pass, and
the losses are averaged by feature (map-side combine). Work: rows x features x seeds scores.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.operators.metrics import LOG_LOSS_EPS
from riskflow.operators.ordered import numbered
from riskflow.session import materialize

SEEDS = (1, 2, 3)


def log_loss(label: Column, p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(LOG_LOSS_EPS)), F.lit(1 - LOG_LOSS_EPS))
    return -(label * F.log(p) + (F.lit(1.0) - label) * F.log(F.lit(1.0) - p))


def permuted(rows: DataFrame, features: Sequence[str], seed: int, keep: Sequence[str]) -> DataFrame:
    """For each row of ``rows`` (with ``_number``) one row per feature, named in ``feature``, that has this one feature
    of another row; ``keep`` columns go along."""
    partner = numbered(rows.select(*[F.col(f).alias(f"_p{i}") for i, f in enumerate(features)],
                                   F.xxhash64(F.lit(seed), F.col("_number")).alias("_hash"), F.col("_number").alias("_from")),
                       ["_hash", "_from"], "_to").drop("_hash", "_from")
    pairs = rows.join(partner, F.col("_number") == F.col("_to"))
    variants = [F.struct(F.lit(f).alias("feature"), *[(F.col(f"_p{j}") if i == j else F.col(g)).alias(g) for j, g in enumerate(features)])
                for i, f in enumerate(features)]
    return pairs.select(*keep, F.explode(F.array(*variants)).alias("_v")).select(*keep, "_v.*")


def numbered_rows(data: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """The labelled rows with their number, stored; features are doubles."""
    rows = data.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias(label), *[F.col(f).cast("double").alias(f) for f in features])
    return numbered(rows.withColumn("_key", F.xxhash64(*rows.columns)), ["_key", label, *features], "_number").drop("_key")


def permutation_losses(score: Callable[[DataFrame], DataFrame], rows: DataFrame, features: Sequence[str], label: str,
                       prob: str, seed: int) -> DataFrame:
    """(feature, seed, loss): the mean log loss with that feature shuffled."""
    scored = score(permuted(rows, features, seed, [label]))
    return scored.groupBy("feature").agg(F.avg(log_loss(F.col(label), F.col(prob))).alias("loss")).select("feature", F.lit(seed).alias("seed"), "loss")


def permutation_importance(score: Callable[[DataFrame], DataFrame], data: DataFrame, features: Sequence[str], label: str,
                           prob: str = "fraud_probability", seeds: Sequence[int] = SEEDS) -> DataFrame:
    """(feature, attribution, attribution_sd, baseline): the mean rise of the log loss over the seeds, its standard
    deviation, and the loss without shuffling. ``score`` adds ``prob`` to rows that have the features."""
    rows = numbered_rows(data, features, label)
    losses = permutation_losses(score, rows, features, label, prob, seeds[0])
    for seed in seeds[1:]:
        losses = losses.unionByName(permutation_losses(score, rows, features, label, prob, seed))
    losses = materialize(losses, "permutation-losses")
    baseline = score(rows).agg(F.avg(log_loss(F.col(label), F.col(prob)))).first()[0]  # one scalar
    base = F.lit(baseline).cast("double")
    return losses.groupBy("feature").agg(F.avg(F.col("loss") - base).alias("attribution"),
                                         F.coalesce(F.stddev_samp("loss"), F.lit(0.0)).alias("attribution_sd")).withColumn("baseline", base)
