"""Running sums and maxima of long ordered groups, without a group in one task.

Rows are sorted into ranges. Each range runs over its own rows; what the ranges
before or after it add is worked out on one row per range and group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.storage import settle

PART = "_part"


def in_ranges(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The rows in ranges of a strict total order, with the number of their range."""
    keys = [*map(F.col, by), *order]
    return settle(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(PART, F.spark_partition_id()), "ranges")


def running_sums(ranged: DataFrame, by: Sequence[str], order: Sequence[Column], values: Mapping[str, Column]) -> DataFrame:
    """Adds the sum of each value over the row and those before it in its group."""
    totals = ranged.groupBy(*by, PART).agg(*[F.sum(v).alias(f"_{n}") for n, v in values.items()])
    before = Window.partitionBy(*by).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*by, PART, *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n in values])
    own = Window.partitionBy(*by, PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = ranged.withColumns({n: F.sum(v).over(own) for n, v in values.items()}).join(starts, [*by, PART])
    return summed.withColumns({n: F.col(n) + F.col(f"_{n}") for n in values}).drop(*[f"_{n}" for n in values])


def following_maximum(ranged: DataFrame, by: Sequence[str], order: Sequence[Column], value: str, name: str) -> DataFrame:
    """Adds the largest value of the row and those after it in its group."""
    largest = ranged.groupBy(*by, PART).agg(F.max(value).alias("_largest"))
    after = Window.partitionBy(*by).orderBy(PART).rowsBetween(1, Window.unboundedFollowing)
    ends = largest.select(*by, PART, F.max("_largest").over(after).alias("_after"))
    # a frame that ends with the partition is worked out anew for every row; one that begins with it grows
    placed = ranged.withColumn("_place", F.row_number().over(Window.partitionBy(*by, PART).orderBy(*order)))
    own = Window.partitionBy(*by, PART).orderBy(F.desc("_place")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return placed.withColumn(name, F.max(value).over(own)).join(ends, [*by, PART]).withColumn(name, F.greatest(name, "_after")).drop("_after", "_place")
