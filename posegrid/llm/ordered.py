"""Rows in global key order across partitions, with one shuffle."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cut_points(df: DataFrame, key: str, parts: int) -> list[int]:
    """Existing keys that begin the second and later of about even ranges.

    Reads the key column only; at most ``parts - 1`` values reach the driver.
    The least key is never a cut, so no range is empty (the first one holds it,
    or the null keys).
    """
    probs = [i / parts for i in range(1, parts)] or [0.5]
    row = df.agg(F.min(key).alias("low"), F.percentile_approx(key, probs, 100 * max(parts, 100)).alias("p")).first()
    return sorted({c for c in row["p"] or [] if c > row["low"]}) if parts > 1 else []


def range_id(key: str, cuts: list[int]):
    """The number of cuts at or below the key; 0 for null keys."""
    if not cuts:
        return F.lit(0)
    below = lambda values: F.size(F.filter(values, lambda c: c <= F.col(key)))
    step = math.isqrt(len(cuts))
    groups = [F.array(*[F.lit(c).cast("long") for c in cuts[i : i + step]]) for i in range(0, len(cuts), step)]
    # two short searches: the last group that begins at or below the key, then in it
    full = below(F.array(*[F.lit(c).cast("long") for c in cuts[::step]])) - 1
    found = F.when(full < 0, 0).otherwise(full * step + below(F.get(F.array(*groups), full)))
    return F.when(F.col(key).isNull(), 0).otherwise(found)


def parts_of(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def in_ranges(df: DataFrame, key: str, *ties: str, parts: int | None = None) -> tuple[DataFrame, list[int]]:
    """One partition a range, in order, each sorted by key and ties (nulls
    first); column ``part`` says which.  Also the cuts."""
    cuts = cut_points(df, key, parts or parts_of(df))
    out = df.withColumn("part", range_id(key, cuts))
    return out.repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions("part", key, *ties), cuts


def with_next_first(df: DataFrame, key: str, *ties: str, parts: int | None = None) -> DataFrame:
    """As ``in_ranges``, and after each range a copy of the first rows of the
    next one (after the last, of the first): column ``tail`` is true there.

    Copies are picked by key: a range begins at a cut, the first one at the
    least key, or at null if there is one.
    """
    cuts = cut_points(df, key, parts or parts_of(df))
    least = df.agg(F.min(key).alias("low"), F.count_if(F.col(key).isNull()).alias("nulls")).first()
    at = F.col("part")
    first = F.col(key).isNull() if least["nulls"] else F.col(key) == F.lit(least["low"])
    begins = F.lit(False)
    if cuts:
        begins = F.coalesce(F.array_contains(F.array(*[F.lit(c).cast("long") for c in cuts]), F.col(key)), F.lit(False))
    copies = F.when(first, F.lit(len(cuts))).when(begins, at - 1)
    placed = df.withColumn("part", range_id(key, cuts)).withColumn("copy", copies)
    both = placed.select(
        *df.columns,
        F.explode(
            F.when(
                F.col("copy").isNull(), F.array(F.struct(at.alias("part"), F.lit(False).alias("tail")))
            ).otherwise(
                F.array(
                    F.struct(at.alias("part"), F.lit(False).alias("tail")),
                    F.struct(F.col("copy").alias("part"), F.lit(True).alias("tail")),
                )
            )
        ).alias("to"),
    ).select(*df.columns, "to.part", "to.tail")
    return both.repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions("part", "tail", key, *ties)
