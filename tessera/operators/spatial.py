"""Joins by place. Boxes meet in the cells of a grid, which makes a range join an equi-join.

A pair that shares several cells is kept in one of them only: the cell of the lower
corner of the common box. No distinct is needed, and dense cells are split by
adaptive execution, or by ``salt`` where one cell holds a large share of all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions.polygons import boolean_area


def choose_cell(df: DataFrame, prefix: str = "", share: float = 0.95) -> float:
    """A cell about as wide as all but the largest boxes."""
    x0, y0, x1, y1 = g.box(prefix)
    side = df.agg(F.percentile_approx(F.greatest(x1 - x0, y1 - y0), share).alias("side")).first().side
    return max(float(side or 0.0), 1e-6)


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in df.columns])


def _cells(low: Column, high: Column, cell: float) -> Column:
    at = lambda v: F.floor(v / cell).cast("long")
    return F.sequence(at(low), F.greatest(at(low), at(high)))


def spatial_join(left: DataFrame, right: DataFrame, cell: float, on: Sequence[str] = (), salt: int = 1) -> DataFrame:
    """Pairs of overlapping boxes: columns a_* of the left, b_* of the right; equal in the columns ``on``."""
    a, b = prefixed(left, "a_"), prefixed(right, "b_")
    (ax0, ay0, ax1, ay1), (bx0, by0, bx1, by1) = g.box("a_"), g.box("b_")
    a = a.withColumn("_cx", F.explode(_cells(ax0, ax1, cell))).withColumn("_cy", F.explode(_cells(ay0, ay1, cell)))
    b = b.withColumn("_cx", F.explode(_cells(bx0, bx1, cell))).withColumn("_cy", F.explode(_cells(by0, by1, cell)))
    keys = ["_cx", "_cy"]
    if salt > 1:
        a = a.withColumn("_salt", F.pmod(F.xxhash64(*a.columns), F.lit(salt)).cast("int"))
        b = b.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        keys.append("_salt")
    for k in on:
        a, b = a.withColumn(f"_on_{k}", F.col(f"a_{k}")), b.withColumn(f"_on_{k}", F.col(f"b_{k}"))
        keys.append(f"_on_{k}")
    x, y = F.greatest(ax0, bx0), F.greatest(ay0, by0)
    meet = (ax0 < bx1) & (bx0 < ax1) & (ay0 < by1) & (by0 < ay1)
    first = (F.floor(x / cell).cast("long") == F.col("_cx")) & (F.floor(y / cell).cast("long") == F.col("_cy"))
    return a.join(b, keys).where(meet & first).drop(*keys)


def overlap_pairs(boxes: DataFrame, key: str, cell: float, on: Sequence[str] = (), salt: int = 1) -> DataFrame:
    """Each pair of overlapping boxes of one table once, the smaller key as a."""
    return spatial_join(boxes, boxes, cell, on, salt).where(F.col(f"a_{key}") < F.col(f"b_{key}"))


def ring_overlaps(pairs: DataFrame, ring: str, least: float | Column = 0.0, of: str = "union") -> DataFrame:
    """Pairs of overlapping boxes with _area_a, _area_b and _both, the areas of their rings and what these share.

    least, of: pairs go whose rings cannot share so much of their union, or of the smaller one. What their boxes
    share is the most that rings can, so most pairs go before a ring is cut.
    """
    a, b = F.col(f"a_{ring}"), F.col(f"b_{ring}")
    pairs = pairs.withColumn("_area_a", g.ring_area(a)).withColumn("_area_b", g.ring_area(b))
    return pairs.where(_possible(least, of)).withColumn("_both", boolean_area(a, b)["both"])


def _possible(least: float | Column, of: str) -> Column:
    most = g.overlap(g.box("a_"), g.box("b_")) * (1 + 1e-9)
    if of == "union":
        return most * (1 + least) >= least * (F.col("_area_a") + F.col("_area_b"))
    return most >= least * F.least("_area_a", "_area_b")


def overlapping_rings(boxes: DataFrame, key: str, ring: str, cell: float, least: float | Column, differ: str, of: str = "union") -> DataFrame:
    """ring_overlaps of the pairs of a table that has a unique key and whose rows differ in a column.

    Pairs are found by boxes and areas alone, an area being worked out once for a ring;
    rings are fetched by key for those pairs only that can reach the threshold.
    """
    flat = boxes.select(key, differ, *g.SIDES, g.ring_area(F.col(ring)).alias("_area"))
    pairs = overlap_pairs(flat, key, cell).where(F.col(f"a_{differ}") != F.col(f"b_{differ}"))
    pairs = pairs.withColumnsRenamed({"a__area": "_area_a", "b__area": "_area_b"}).where(_possible(least, of))
    pairs = pairs.select(f"a_{key}", f"b_{key}", "a_xmin", "a_ymin", "_area_a", "_area_b")
    for side in ("a_", "b_"):
        pairs = pairs.join(boxes.select(F.col(key).alias(f"{side}{key}"), F.col(ring).alias(f"{side}{ring}")), f"{side}{key}")
    return pairs.withColumn("_both", boolean_area(F.col(f"a_{ring}"), F.col(f"b_{ring}"))["both"])


def ring_iou() -> Column:
    return g.ratio(F.col("_both"), F.col("_area_a") + F.col("_area_b") - F.col("_both"))


def distance_join(left: DataFrame, right: DataFrame, within: float, on: Sequence[str] = ()) -> DataFrame:
    """Pairs of points x, y no further apart than ``within``, with their distance; a point looks into its own and the eight cells around."""
    a, b = prefixed(left, "a_"), prefixed(right, "b_")
    at = lambda v: F.floor(F.col(v) / within).cast("long")
    a = a.withColumn("_cx", at("a_x")).withColumn("_cy", at("a_y"))
    step = F.sequence(F.lit(-1), F.lit(1))
    b = b.withColumn("_dx", F.explode(step)).withColumn("_dy", F.explode(step)).withColumn("_cx", at("b_x") + F.col("_dx")).withColumn("_cy", at("b_y") + F.col("_dy")).drop("_dx", "_dy")
    keys = ["_cx", "_cy"]
    for k in on:
        a, b = a.withColumn(f"_on_{k}", F.col(f"a_{k}")), b.withColumn(f"_on_{k}", F.col(f"b_{k}"))
        keys.append(f"_on_{k}")
    far = g.distance((F.col("a_x"), F.col("a_y")), (F.col("b_x"), F.col("b_y")))
    return a.join(b, keys).withColumn("distance", far).where(F.col("distance") <= within).drop(*keys)


def points_in_boxes(points: DataFrame, boxes: DataFrame, cell: float) -> DataFrame:
    """Pairs of points x, y and the boxes that hold them, lower sides included."""
    x, y = F.col("a_x"), F.col("a_y")
    x0, y0, x1, y1 = g.box("b_")
    a = prefixed(points, "a_").withColumn("_cx", F.floor(x / cell).cast("long")).withColumn("_cy", F.floor(y / cell).cast("long"))
    b = prefixed(boxes, "b_").withColumn("_cx", F.explode(_cells(x0, x1, cell))).withColumn("_cy", F.explode(_cells(y0, y1, cell)))
    return a.join(b, ["_cx", "_cy"]).where((x >= x0) & (x < x1) & (y >= y0) & (y < y1)).drop("_cx", "_cy")


def min_overlap(boxes: DataFrame, areas: DataFrame, least: float, cell: float, key: str) -> DataFrame:
    """Boxes of which at least a share lies in the areas, which don't overlap each other; empty boxes go."""
    pairs = spatial_join(boxes, areas, cell)
    inside = pairs.groupBy(F.col(f"a_{key}").alias(key)).agg(F.sum(g.overlap(g.box("a_"), g.box("b_"))).alias("_inside"))
    return boxes.join(inside, key).where(F.try_divide(F.col("_inside"), g.area(g.box())) >= least).drop("_inside")


def clip_to(boxes: DataFrame, areas: DataFrame, cell: float) -> DataFrame:
    """Boxes cut to each area that they overlap; columns of the boxes, then area_* of the areas."""
    pairs = spatial_join(boxes, areas, cell)
    cut = g.clip(g.box("a_"), g.box("b_"))
    own = [F.col(f"a_{c}").alias(c) for c in boxes.columns if c not in g.SIDES]
    other = [F.col(f"b_{c}").alias(f"area_{c}") for c in areas.columns if c not in g.SIDES]
    return pairs.select(*own, *[v.alias(s) for v, s in zip(cut, g.SIDES, strict=True)], *other)


def cover_ratio(tiles: DataFrame, labels: DataFrame, cell: float, least: float) -> DataFrame:
    """Tile and label pairs where at least a share of the label lies in the tile, with that share."""
    pairs = spatial_join(tiles, labels, cell)
    share = g.ratio(g.overlap(g.box("a_"), g.box("b_")), g.area(g.box("b_")))
    return pairs.withColumn("share", share).where(F.col("share") >= least)
