"""Global orderings without a single-partition window.

Running totals over all distinct values of a column, row numbers, and the exact discrete percentile. For totals the rows are
range-partitioned by value and written once to the checkpoint folder, so that every row's range is fixed; each range
has a total (one row a partition), the totals of the ranges before give its offset, and a window partitioned by range
finishes the running totals. The plan is the same at every size: the number of ranges is the number of shuffle
partitions, and nothing but the range totals is ordered in one place.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskflow.session import materialize

#: Distinct values that one task may order to finish a selection, and the share of rows by which a sketch may be off.
MOST_ORDERED, SKETCH_ERROR = 100_000, 0.001
_POSITION_BITS = 33  # of monotonically_increasing_id: the row's place in its partition


def numbered(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``df`` with the number (0, 1, ...) of each row in the order of the columns ``order``, stored.

    A range sort fixes every row's partition and place; the rows of the partitions before (one row a partition, thus a
    broadcast of bounded size) are added. Rows that are equal in ``order`` stay in one range: end it with a column that
    tells them apart where very many can be equal.
    """
    keys = [F.col(c).asc_nulls_first() for c in order]
    stored = materialize(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", _POSITION_BITS)
    counts = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (stored.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .select(*df.columns, (F.col("_before") + place).alias(name)))


def running_totals(distinct_values: DataFrame, value: str, columns: Sequence[str],
                   buckets: int | None = None) -> DataFrame:
    """For a table with one row per distinct ``value``, add ``{c}_cum`` = sum of ``c`` over
    rows with value <= this value, for each ``c`` in ``columns``.

    Up to ``MOST_ORDERED`` rows are ordered by one task; more are cut into ``buckets`` value ranges (default: the
    session's shuffle partitions), at any size where the number is given.
    """
    by = [F.col(value)]
    distinct_values = materialize(distinct_values, "totals")  # read by the sample and by the sort
    if not buckets and distinct_values.count() <= MOST_ORDERED:
        whole = Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
        return distinct_values.select("*", *[F.sum(c).over(whole).alias(f"{c}_cum") for c in columns])
    ranged = materialize(distinct_values.repartitionByRange(*([buckets] if buckets else []), *by)
                         .withColumn("_range", F.spark_partition_id()), "ranges")  # the ranges are drawn once
    totals = ranged.groupBy("_range").agg(*[F.sum(c).alias(f"_t_{c}") for c in columns])
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = totals.select("_range", *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}")
                                        for c in columns])
    inside = Window.partitionBy("_range").orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.select("*", *[F.sum(c).over(inside).alias(f"_l_{c}") for c in columns])
    out = local.join(offsets, "_range")
    return out.select(*distinct_values.columns,
                      *[(F.col(f"_o_{c}") + F.col(f"_l_{c}")).alias(f"{c}_cum") for c in columns])


def exact_quantile(df: DataFrame, value: str, q: float, buckets: int | None = None, most: int = MOST_ORDERED,
                   error: float = SKETCH_ERROR) -> DataFrame:
    """One row ``(n, quantile)``: the smallest value whose cumulative count reaches
    ``ceil(q * n)`` (the discrete percentile; NULL values are ignored).

    Selection without ordering: a quantile sketch gives two values between which the wanted one must lie, one
    aggregation counts the rows below and checks that, and only the values inside are ordered. A bracket with more
    than ``most`` different values is narrowed by a sketch of its own; each round keeps a few thousandths of the rows.
    """
    rows = materialize(df.where(F.col(value).isNotNull()).select(F.col(value).alias("v")), "quantile-values")
    n = rows.count()
    if not n:
        return rows.agg(F.lit(0).cast("long").alias("n"), F.min("v").alias("quantile"))
    target = max(1, math.ceil(q * n))
    skipped, v, inside, size = 0, F.col("v"), rows, n
    while True:
        share = (target - skipped) / size
        # the sketch's ranks are off by at most error * size; twice that on either side, and the ends are exact
        a, b = inside.select(v.cast("double").alias("v")).approxQuantile("v", [max(0.0, share - 2 * error), min(1.0, share + 2 * error)], error)
        a = None if share - 2 * error <= 0 else a
        b = None if share + 2 * error >= 1 else b
        lower = v < F.lit(a) if a is not None else F.lit(False)
        upper = v > F.lit(b) if b is not None else F.lit(False)
        counted = inside.agg(F.count_if(lower).alias("below"), F.count_if(upper).alias("above")).first()
        if skipped + counted["below"] < target <= skipped + size - counted["above"]:
            kept = inside.where(~lower & ~upper)
            skipped += counted["below"]
        else:  # the sketch was off by more: order what there is
            kept, most = inside, float("inf")
        counts = kept.groupBy("v").agg(F.count(F.lit(1)).alias("_n"))
        different = counts.count() if most < size else 0
        if different <= most or different == size:
            break
        inside = materialize(kept, "quantile-values")
        before, size = size, inside.count()
        if size == before:  # no narrower: the sketch cannot tell these values apart
            break
    cum = running_totals(counts, "v", ["_n"], buckets)
    return cum.where(F.col("_n_cum") >= F.lit(target - skipped)).agg(F.lit(n).cast("long").alias("n"), F.min("v").alias("quantile"))
