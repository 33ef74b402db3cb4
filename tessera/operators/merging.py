"""How a component's result becomes part of the objects so far."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .fusion import numbered

GEOMETRY = ("xmin", "ymin", "xmax", "ymax")


def merge_key(result: DataFrame, existing: DataFrame, keys: tuple[str, str] = ("object_id", "tile_path")) -> str | None:
    """object_id if every row of both has one, else tile_path if it is unique in the result, else none: one aggregation."""
    first, second = keys
    if first in result.columns and first in existing.columns:
        whole = result.agg(F.count_if(F.col(first).isNull()).alias("n")).union(existing.agg(F.count_if(F.col(first).isNull()))).agg(F.max("n")).first()[0]
        if not whole:
            return first
    if second in result.columns and second in existing.columns:
        n = result.agg(F.count("*").alias("n"), F.count_distinct(second).alias("kinds")).first()
        if n.n == n.kinds:
            return second
    return None


def carry_over(result: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """New geometry is the base; columns that only the existing objects have come along, once for each key."""
    more = [c for c in existing.columns if c not in result.columns]
    one = existing.select(key, *more).groupBy(key).agg(*[F.first(c, ignorenulls=False).alias(c) for c in more]) if more else None
    return result.join(one, key, "left") if more else result


def attach(result: DataFrame, existing: DataFrame, key: str, suffix: str = "_new") -> DataFrame:
    """Attributes go to the existing objects; those of a name that is taken get a suffix."""
    names = {c: f"{c}{suffix}" if c in existing.columns else c for c in result.columns if c != key and c not in GEOMETRY}
    return existing.join(result.select(key, *[F.col(c).alias(n) for c, n in names.items()]), key, "left")


def fresh_ids(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of a repeated id keeps it; the others, and rows without one, get the numbers after the largest."""
    own = Window.partitionBy(key).orderBy(order)
    marked = df.withColumn("_again", (F.row_number().over(own) > 1) | F.col(key).isNull())
    largest = df.agg(F.coalesce(F.max(key), F.lit(-1)).cast("long").alias("_largest"))
    again = marked.where("_again").drop("_again")
    more = numbered(again, order, "_n", 1).join(F.broadcast(largest)).withColumn(key, F.col("_largest") + F.col("_n"))
    return marked.where("not _again").drop("_again").unionByName(more.select(*df.columns))


def merge_result(result: DataFrame, existing: DataFrame | None, objects_are_new: bool = False, key: str | None = None) -> DataFrame:
    """The five rules: new objects replace; without existing ones the result stands; geometry with a key takes columns over,
    geometry without one replaces; attributes with a key are attached, attributes without one are an error."""
    if objects_are_new or existing is None:
        return result
    geometry = all(c in result.columns for c in GEOMETRY)
    key = key or merge_key(result, existing)
    if geometry:
        return carry_over(result, existing, key) if key else result
    if not key:
        raise ValueError("no valid merge key: the result has neither geometry nor a key")
    return attach(result, existing, key)
