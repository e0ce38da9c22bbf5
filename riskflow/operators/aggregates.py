"""Key/value aggregates: arrays of structs per group and key -> column pivots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def collect_structs(df: DataFrame, group: str, name: str = "feature", value: str = "numerical_value",
                    digits: int = 1, out: str = "cluster") -> DataFrame:
    """Per group, the sorted array of ``struct(name, round(value, digits))``.

    The reference orders by the group key inside its group (no order at all);
    here the array is sorted by name so the result is deterministic. Meant for
    groups holding one row per name (a centroid table: k x features rows), so
    the array is bounded by the number of names.
    """
    item = F.struct(F.col(name).alias("name"), F.round(F.col(value), digits).alias("value"))
    return df.groupBy(group).agg(F.sort_array(F.collect_list(item)).alias(out))


def render_structs(arr: str = "cluster") -> F.Column:
    """``name=value;...`` text of an array of (name, value) structs, value as %.1f."""
    return F.concat_ws(";", F.transform(F.col(arr), lambda s: F.concat(
        s["name"], F.lit("="), F.format_string("%.1f", s["value"]))))


def pivot_values(df: DataFrame, group: str, name: str, value: str, names: Sequence[str],
                 rename: dict[str, str] | None = None) -> DataFrame:
    """One row per group, one column per entry of ``names`` (NULL where a group lacks it).

    ``names`` is passed to ``pivot`` explicitly, so Spark needs no extra job to
    find the distinct values, and the output schema is fixed.
    """
    wide = df.groupBy(group).pivot(name, list(names)).agg(F.first(F.col(value)))
    rename = rename or {}
    return wide.select(group, *[F.col(f"`{n}`").alias(rename.get(n, n)) for n in names])
