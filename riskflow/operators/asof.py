"""Point-in-time joins: exact (key, timestamp) and as-of (latest not later).

Spark has no as-of join in the DataFrame API. The reference does it per
transaction with ``ROW_NUMBER() OVER (PARTITION BY key ORDER BY ts DESC) = 1``
after filtering ``ts <= probe``. Here it is done for a whole set of probes at
once, without pairing probes with candidates:

1. both sides are reduced to distinct (key, instant) rows -- a key then holds at
   most one row per distinct instant of its history, however many
   transactions (or copies of one) it has;
2. a key's time is cut into spans of ``SPAN_MICROS``; the newest right row before
   each span comes from a table of one row per (key, span), so that no window
   has to hold a key's whole history;
3. per (key, span) in time order (right rows before left rows at equal instants,
   so ``<=`` holds), ``last(payload, ignorenulls)`` over a growing frame carries
   the newest right row forward -- one linear pass;
4. the answers, unique per (key, instant), are equi-joined back to the left
   rows; AQE's skew-join splitting applies to that join if a key is hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SPAN_MICROS = 86_400_000_000  # one day


def point_in_time_join(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str],
                       how: str = "left") -> DataFrame:
    """``left JOIN right ON left_on[i] = right_on[i]`` (the reference's exact feature join).

    ``right`` should be unique on ``right_on`` (per-second features are), which
    keeps the output one row per left row.
    """
    cond = [left[a] == right[b] for a, b in zip(left_on, right_on)]
    return left.join(right, on=cond, how=how)


def asof_join(left: DataFrame, right: DataFrame, left_key: str, left_ts: str, right_key: str, right_ts: str,
              columns: Sequence[str] | None = None, fill=None, keep_right_ts: bool = True,
              right_unique: bool = False, compact_left: bool = True, by_span: bool = True) -> DataFrame:
    """For every ``left`` row, the newest ``right`` row of the same key with
    ``right_ts <= left_ts`` (left outer: no such row gives NULLs, or ``fill``).

    Adds ``columns`` of ``right`` (default: all but the key) to ``left``.
    Several right rows at the same instant of one key are reduced to their
    maximum (value-equal copies for per-second feature tables); pass
    ``right_unique=True`` when ``right`` is unique per (key, instant) already.
    ``compact_left=False`` sends the left rows through the window themselves
    instead of their distinct (key, instant) pairs plus a join back: fewer
    stages, for left sides whose size is bounded (a stream micro-batch).
    ``by_span=False`` leaves the spans out, for right sides that are bounded themselves (a few days of features): a
    window then holds a key's distinct instants, and nothing but the rows themselves is shuffled.
    """
    columns = list(columns) if columns is not None else [c for c in right.columns if c != right_key]
    payload_cols = [c for c in columns if c != right_ts] + ([right_ts] if keep_right_ts else [])
    k, t = "_asof_key", "_asof_t"
    span = F.floor(F.col(t) / F.lit(SPAN_MICROS)).alias("_span")
    rights = right.where(F.col(right_key).isNotNull()).select(  # NULL keys match nothing
        F.col(right_key).alias(k), F.unix_micros(F.col(right_ts).cast("timestamp")).alias(t),
        F.struct(*[F.col(c) for c in payload_cols]).alias("_p"))
    if not right_unique:
        rights = rights.groupBy(k, t).agg(F.max("_p").alias("_p"))
    rights = rights.select(k, t, "_p", F.lit(0).alias("_side"), span)
    none = F.lit(None).cast(rights.schema["_p"].dataType)
    probe = [F.col(left_key).alias(k), F.unix_micros(F.col(left_ts).cast("timestamp")).alias(t)]
    probes = left.select(*probe).where(F.col(k).isNotNull())

    candidates = rights
    if by_span:
        # the newest right row before each span: one row per key and span with rights or probes
        newest = rights.groupBy(k, "_span").agg(F.max_by("_p", t).alias("_p"))
        spans = newest.unionByName(probes.select(k, span).distinct().select(k, "_span", none.alias("_p")))
        spans = spans.groupBy(k, "_span").agg(F.first("_p", ignorenulls=True).alias("_p"))
        before = Window.partitionBy(k).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
        carried = (spans.select(k, (F.col("_span") * F.lit(SPAN_MICROS) - 1).alias(t), F.last("_p", ignorenulls=True).over(before).alias("_p"),
                                F.lit(0).alias("_side"), "_span").where(F.col("_p").isNotNull()))
        candidates = rights.unionByName(carried)

    w = (Window.partitionBy(k, *["_span"] * by_span).orderBy(F.col(t), F.col("_side"))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    if not compact_left:
        names = [f"_l{i}" for i in range(len(left.columns))]  # the left rows may have columns of any name
        lcols = [F.lit(None).cast(f.dataType).alias(n) for n, f in zip(names, left.schema.fields)]
        rows = left.select(*probe, none.alias("_p"), F.lit(1).alias("_side"), *[F.col(f"`{c}`").alias(n) for n, c in zip(names, left.columns)])
        rows = rows.select("*", span)
        joined = (candidates.select("*", *lcols).unionByName(rows)
                  .withColumn("_hit", F.when(F.col(k).isNotNull(), F.last("_p", ignorenulls=True).over(w)))
                  .where(F.col("_side") == 1))
        left_out = [F.col(n).alias(c) for n, c in zip(names, left.columns)]
    else:
        points = probes.distinct().select(k, t, none.alias("_p"), F.lit(1).alias("_side"), span)
        found = (candidates.unionByName(points)
                 .withColumn("_hit", F.last("_p", ignorenulls=True).over(w))
                 .where(F.col("_side") == 1)
                 .select(k, t, "_hit"))
        joined = left.join(found, on=[left[left_key] == found[k],
                                      F.unix_micros(left[left_ts].cast("timestamp")) == found[t]], how="left")
        left_out = [left[c] for c in left.columns]
    out = [F.col(f"_hit.{c}").alias(c) for c in payload_cols]
    if fill is not None:
        out = [F.coalesce(F.col(f"_hit.{c}"), F.lit(fill)).alias(c) if c != right_ts else F.col(f"_hit.{c}").alias(c)
               for c in payload_cols]
    return joined.select(*left_out, *out)

