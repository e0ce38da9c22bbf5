"""Range frames over whole seconds, built to survive hot keys.

The reference computes trailing RANGE frames (``n PRECEDING AND CURRENT ROW``
over ``UNIX_SECONDS(ts)``) per customer or terminal on raw transactions. Done
literally in Spark that has two problems at scale:

* one hot key puts all its rows into one window partition, and
* a sliding frame is re-aggregated whenever it moves, so the cost grows with
  rows x rows-per-frame.

Here the work is split into three linear steps:

1. ``compact_by_second`` -- ``groupBy(key, second)`` with partial aggregation.
   Same-second rows are peers of each other in a RANGE frame, so every
   frame value is a function of these per-second totals. After this step a
   key holds at most one row per second of its history (1,296,000 for the
   15-day history), whatever the volume or duplication of its transactions.
2. ``frame_totals`` -- per key, prefix totals ``P(x) = sum(sec' <= x)`` from
   growing frames (``unboundedPreceding .. offset``), which Spark evaluates in
   one pass each; a frame ``[t+start, t+end]`` is ``P(t+end) - P(t+start-1)``.
   Exact, because the totals are integers (counts) and decimals (amounts).
3. ``replicate_rows`` -- turn per-second results back into one row per
   transaction where the caller needs that cardinality, in place and in
   bounded chunks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.functions import epoch_seconds

SEC = "_sec"
REPLICATE_CHUNK = 1 << 16


def compact_by_second(df: DataFrame, key: str, ts: str, measures: Mapping[str, Column],
                      sec_col: str = SEC) -> DataFrame:
    """One row per (key, whole second) with the given aggregate ``measures``."""
    return (df.groupBy(F.col(key), epoch_seconds(ts).alias(sec_col))
            .agg(*[c.alias(name) for name, c in measures.items()]))


def frame_totals(compact: DataFrame, key: str, columns: Sequence[str], frames: Mapping[str, tuple[int, int]],
                 sec_col: str = SEC, form: str = "prefix", by_span: bool = False) -> DataFrame:
    """Add ``{column}__{frame}`` = sum of ``column`` over rows of the same key whose
    second lies in ``[sec + start, sec + end]`` (inclusive, ``start <= end <= 0``).

    ``form='prefix'`` (default) uses growing frames and differences, linear in the
    number of rows. ``form='sliding'`` uses ``rangeBetween(start, end)`` directly;
    it is kept for equivalence tests.
    All frames share one partitioning and ordering, so Spark plans a single
    Exchange, Sort and Window node for them.

    ``by_span`` cuts a key's time into spans as long as the longest frame: each row goes to its own span and, as a
    halo, to the next one, and the windows are partitioned by (key, span). A window partition then holds two spans
    however long the history is; each row is windowed twice. Histories that are themselves bounded by a few spans
    (the 15-day views) need no spans.
    """
    keys = [key]
    columns_in = compact.columns
    if by_span:
        longest = max(1 - start for start, _ in frames.values())
        own = F.floor(F.col(sec_col) / F.lit(longest))
        compact = (compact.withColumn("_halo", F.explode(F.array(F.lit(0), F.lit(1))))
                   .withColumn("_span", own + F.col("_halo")))
        keys.append("_span")
    w = Window.partitionBy(*keys).orderBy(F.col(sec_col))
    out = []
    if form == "sliding":
        for name, (start, end) in frames.items():
            wf = w.rangeBetween(start, end)
            for c in columns:
                out.append(F.coalesce(F.sum(c).over(wf), F.lit(0)).alias(f"{c}__{name}"))
        return _own_rows(compact.select("*", *out), by_span)
    if form != "prefix":
        raise ValueError(f"unknown form {form!r}")
    needed: dict[tuple[str, int], str] = {}  # each distinct prefix is computed once
    for name, (start, end) in frames.items():
        if not start <= end <= 0:
            raise ValueError(f"frame {name}: need start <= end <= 0, got {(start, end)}")
        for c in columns:
            for off in (end, start - 1):
                needed.setdefault((c, off), f"_p{len(needed)}")
    # the running sum keeps its column's type, so that differences of decimals lose no digit
    prefixes = [F.coalesce(F.sum(c).over(w.rangeBetween(Window.unboundedPreceding, off)), F.lit(0)).cast(compact.schema[c].dataType).alias(alias)
                for (c, off), alias in needed.items()]
    with_prefix = compact.select("*", *prefixes)
    for name, (start, end) in frames.items():
        for c in columns:
            out.append((F.col(needed[(c, end)]) - F.col(needed[(c, start - 1)])).alias(f"{c}__{name}"))
    return _own_rows(with_prefix, by_span).select(*[F.col(c) for c in columns_in], *out)


def _own_rows(df: DataFrame, by_span: bool) -> DataFrame:
    return df.where("_halo = 0").drop("_halo", "_span") if by_span else df


def replicate_rows(df: DataFrame, count_col: str, chunk: int = REPLICATE_CHUNK) -> DataFrame:
    """Emit each row ``count_col`` times (rows with count <= 0 vanish).

    Copies are generated where the row is, ``chunk`` at a time, so that no wide row is shuffled for the sake of
    copies that almost never exist: the transactions of one key within one second.
    """
    n = F.col(count_col).cast("long")
    n_chunks = F.ceil(n / F.lit(chunk)).cast("int")
    parts = df.where(n > 0).withColumn("_chunk", F.explode(F.sequence(F.lit(0), n_chunks - 1)))
    size = F.least(F.lit(chunk).cast("long"), n - F.col("_chunk").cast("long") * F.lit(chunk)).cast("int")
    return (parts.withColumn("_copy", F.explode(F.array_repeat(F.lit(True), size)))
            .drop("_chunk", "_copy"))
