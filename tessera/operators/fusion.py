"""Score fusion, suppression, box fusion and merging of runs.

Definitions of ours, where nothing else fixes them: fused scores are weighted
geometric means; suppression ranks by score, best first, then by object id; with
``ioa-disambiguate`` a worse box yields if its overlap with a kept better one
exceeds the threshold as a share of the smaller of the two, and what is left of it
is less than ``keep_ratio`` of its area; boxes keep their shape. A box whose centre
lies in its tile's edge band ranks after all others. Where a column of rings is
named, overlaps are those of the rings, and the boxes are their envelopes.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..plans.storage import settle
from .graph import connected_components, greedy_suppress
from .spatial import overlap_pairs, overlapping_rings, ring_iou, ring_overlaps


def area_penalty(area: Column, least: float | None, most: float | None, floor: float = 0.1) -> Column:
    """1 within the range; below it the area's share of the least, above it the most's share of the area, but never under the floor."""
    out = F.lit(1.0)
    if most is not None:
        out = F.when(area > most, F.greatest(F.lit(floor), F.lit(float(most)) / area)).otherwise(out)
    if least is not None:
        out = F.when(area < least, F.greatest(F.lit(floor), area / F.lit(float(least)))).otherwise(out)
    return out


def fused_score(weights: Mapping[str, float], method: str = "weighted_geometric_mean") -> Column:
    """Of the columns with a weight: exp of the weighted mean of logarithms, zero where a score isn't positive; or the weighted mean."""
    active = {c: float(w) for c, w in weights.items() if w}
    total = sum(active.values())
    if method == "weighted_arithmetic_mean":
        return sum((F.col(c) * w for c, w in active.items()), F.lit(0.0)) / total
    if method != "weighted_geometric_mean":
        raise ValueError(f"no fusion method {method}")
    none = F.lit(False)
    for c in active:
        none = none | (F.col(c) <= 0)
    logs = sum((F.log(F.when(F.col(c) > 0, F.col(c)).otherwise(1.0)) * w for c, w in active.items()), F.lit(0.0))
    return F.when(none, 0.0).otherwise(F.exp(logs / total))


def score_column(df: DataFrame, priority: Sequence[str]) -> str | None:
    """The first of the columns that exists and isn't all null."""
    there = [c for c in priority if c in df.columns]
    if not there:
        return None
    counts = df.agg(*[F.count(c).alias(c) for c in there]).first()
    return next((c for c in there if counts[c]), None)


def in_edge_band(band: float, tile: tuple, prefix: str = "") -> Column:
    """Whether a box's centre lies within a share of the tile's size of its border."""
    x, y = g.centroid(g.box(prefix))
    x0, y0, x1, y1 = tile
    dx, dy = (x1 - x0) * band, (y1 - y0) * band
    return (x < x0 + dx) | (x > x1 - dx) | (y < y0 + dy) | (y > y1 - dy)


def conflicts(boxes: DataFrame, threshold: float | Column, cell: float, key: str = "object_id", score: str = "score", by: Sequence[str] = (), algorithm: str = "iou", keep_ratio: float = 0.5, late: str | None = None, ring: str | None = None) -> DataFrame:
    """Edges hi, lo between boxes, or rings, of which the better one suppresses the worse one."""
    columns = list(dict.fromkeys([key, score, *by, *g.SIDES, *([late] if late else []), *([ring] if ring else [])]))
    pairs = overlap_pairs(boxes.select(*columns), key, cell, by)
    a, b = g.box("a_"), g.box("b_")
    rank = lambda p: F.struct(*([F.col(f"{p}{late}").cast("int").alias("late")] if late else []), (-F.col(f"{p}{score}")).alias("score"), F.col(f"{p}{key}").alias("key"))
    a_first = rank("a_") < rank("b_")
    if algorithm not in ("iou", "ioa-disambiguate"):
        raise ValueError(f"no suppression algorithm {algorithm}")
    area_a, area_b, both, iou, ioa = g.area(a), g.area(b), g.overlap(a, b), g.iou(a, b), g.ioa(a, b)
    if ring:
        pairs = ring_overlaps(pairs, ring, threshold, "union" if algorithm == "iou" else "smaller")
        area_a, area_b, both = F.col("_area_a"), F.col("_area_b"), F.col("_both")
        iou, ioa = ring_iou(), g.ratio(both, F.least(area_a, area_b))
    conflict = iou >= threshold
    if algorithm == "ioa-disambiguate":
        left = 1 - g.ratio(both, F.when(a_first, area_b).otherwise(area_a))
        conflict = (ioa > threshold) & (left < keep_ratio)
    out = pairs.where(conflict)
    return out.select(*[F.col(f"a_{c}").alias(c) for c in by], F.when(a_first, F.col(f"a_{key}")).otherwise(F.col(f"b_{key}")).alias("hi"), F.when(a_first, F.col(f"b_{key}")).otherwise(F.col(f"a_{key}")).alias("lo"))


def suppress(boxes: DataFrame, threshold: float, cell: float, key: str = "object_id", by: Sequence[str] = (), **how) -> DataFrame:
    """Non-maximum suppression: the boxes that are kept."""
    lost = greedy_suppress(conflicts(boxes, threshold, cell, key, by=by, **how), by)
    return boxes.join(lost.withColumnRenamed("lo", key), [*by, key], "left_anti")


@dataclass
class AggregatorConfig:
    """Parameters of the aggregation of scored boxes, with their usual values."""

    weights: Mapping[str, float]
    method: str = "weighted_geometric_mean"
    score_threshold: float = 0.5
    nms_algorithm: str = "iou"
    nms_threshold: float = 0.5
    keep_ratio: float = 0.5
    least_area: float | None = None
    most_area: float | None = None
    penalty_floor: float = 0.1
    penalise: bool = True
    cell: float = 10.0

    def __post_init__(self):
        for name in ("score_threshold", "nms_threshold", "keep_ratio", "penalty_floor"):
            if not 0 <= getattr(self, name) <= 1:
                raise ValueError(f"{name} must be from 0 to 1")


def aggregate(boxes: DataFrame, config: AggregatorConfig, key: str = "object_id", by: Sequence[str] = ()) -> DataFrame:
    """Penalty, fusion, threshold, suppression, hard area limits: the boxes that are left, with aggregator_score."""
    boxes = boxes.drop("aggregator_score", "tile_id")
    if config.penalise and (config.least_area is not None or config.most_area is not None):
        factor = area_penalty(g.area(g.box()), config.least_area, config.most_area, config.penalty_floor)
        boxes = boxes.withColumns({c: F.col(c) * factor for c, w in config.weights.items() if w})
    scored = boxes.withColumn("aggregator_score", fused_score(config.weights, config.method)).where(F.col("aggregator_score") >= config.score_threshold)
    kept = suppress(scored, config.nms_threshold, config.cell, key, by, score="aggregator_score", algorithm=config.nms_algorithm, keep_ratio=config.keep_ratio)
    area = g.area(g.box())
    if config.least_area is not None:
        kept = kept.where(area >= config.least_area)
    if config.most_area is not None:
        kept = kept.where(area <= config.most_area)
    return kept


def fuse_boxes(boxes: DataFrame, threshold: float = 0.4, cell: float = 10.0, by: Sequence[str] = ("tile",), key: str = "object_id", score: str = "score") -> DataFrame:
    """Weighted box fusion in each group: by, anchor, the fused box, score, members.

    Boxes in order of their scores absorb the unused ones that overlap them enough.
    The anchors are the boxes that suppression keeps, and a suppressed box belongs
    to the best anchor it conflicts with. Sides are means weighted by score; the
    score is the largest.
    """
    edges = settle(conflicts(boxes, threshold, cell, key, score, by), "fusing")
    lost = settle(greedy_suppress(edges, by), "absorbed")
    ranks = boxes.select(*by, F.col(key).alias("hi"), F.struct((-F.col(score)).alias("s"), F.col(key).alias("k")).alias("rank"))
    held = edges.join(lost.withColumnRenamed("lo", "hi"), [*by, "hi"], "left_anti").join(ranks, [*by, "hi"])
    owner = held.groupBy(*by, "lo").agg(F.min_by("hi", "rank").alias("anchor")).withColumnRenamed("lo", key)
    member = boxes.join(owner, [*by, key], "left").withColumn("anchor", F.coalesce("anchor", key))
    weight = F.col(score)
    sides = [(F.sum(F.col(s) * weight) / F.sum(weight)).alias(s) for s in g.SIDES]
    return member.groupBy(*by, "anchor").agg(*sides, F.max(weight).alias(score), F.count("*").alias("members"))


def union_area(boxes) -> float:
    """Area of the union of boxes, by strips between their vertical sides."""
    edges = sorted({x for b in boxes for x in (b[0], b[2])})
    total = 0.0
    for x0, x1 in zip(edges, edges[1:]):
        top, covered = None, 0.0
        for y0, y1 in sorted((b[1], b[3]) for b in boxes if b[0] <= x0 and b[2] >= x1):
            if top is None or y0 > top:
                covered += y1 - y0
                top = y1
            elif y1 > top:
                covered += y1 - top
                top = y1
        total += covered * (x1 - x0)
    return total


def union_boxes(boxes) -> list[tuple[float, float, float, float]]:
    """The union of boxes as boxes that don't overlap: strips between their vertical sides."""
    edges = sorted({x for b in boxes for x in (b[0], b[2])})
    out = []
    for x0, x1 in zip(edges, edges[1:]):
        runs: list[list[float]] = []
        for y0, y1 in sorted((b[1], b[3]) for b in boxes if b[0] <= x0 and b[2] >= x1):
            if runs and y0 <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], y1)
            else:
                runs.append([y0, y1])
        out += [(x0, y0, x1, y1) for y0, y1 in runs]
    return out


def consensus_boxes(boxes, runs, method: str, share: float = 0.4, blend: float = 0.1) -> list[tuple[float, float, float, float]]:
    """A cluster's geometry as boxes that don't overlap.

    union: of all members. intersection_union_blend: what all members share, grown on
    each side by a share of the root of the area that they don't, or the union where
    they share nothing. majority_union: of the members of runs that have at least the
    given share of the number of runs in the cluster, or of all where no run has.
    """
    if method == "union":
        return union_boxes(boxes)
    if method == "intersection_union_blend":
        x0, y0, x1, y1 = max(b[0] for b in boxes), max(b[1] for b in boxes), min(b[2] for b in boxes), min(b[3] for b in boxes)
        if x1 <= x0 or y1 <= y0:
            return union_boxes(boxes)
        by = blend * math.sqrt(max(union_area(boxes) - (x1 - x0) * (y1 - y0), 0.0))
        return [(x0 - by, y0 - by, x1 + by, y1 + by)]
    if method == "majority_union":
        counts = Counter(runs)
        need = max(1, math.ceil(len(counts) * share))
        return union_boxes([b for b, run in zip(boxes, runs, strict=True) if counts[run] >= need] or boxes)
    raise ValueError(f"no consensus geometry {method}")


def consensus_parts(members: DataFrame, method: str, component: str = "component", run: str = "run_index", share: float = 0.4) -> DataFrame:
    """component and parts (array of boxes) of every cluster; a cluster's members are gathered in one row."""

    def made(column: pd.Series) -> pd.Series:
        shapes = (consensus_boxes([(m["xmin"], m["ymin"], m["xmax"], m["ymax"]) for m in own], [m["run"] for m in own], method, share) for own in column)
        return pd.Series([[dict(zip(g.SIDES, b, strict=True)) for b in shape] for shape in shapes])

    member = F.struct(*[F.col(s) for s in g.SIDES], F.col(run).alias("run"))
    kind = f"array<struct<{','.join(f'{s}:double' for s in g.SIDES)}>>"
    return members.groupBy(component).agg(F.collect_list(member).alias("own")).select(component, F.pandas_udf(made, kind)("own").alias("parts"))


def covered_areas(members: DataFrame, by: str = "component") -> DataFrame:
    """``by`` and area: what the boxes of each group cover together.

    The sides of a group's boxes cut it into strips; in each strip the boxes across it
    are spans, which are added up in order but for what earlier ones cover. Work is by
    strip, so a group may be of any size.
    """
    sides = members.select(by, F.col("xmin").alias("x0")).union(members.select(by, F.col("xmax").alias("x0"))).distinct()
    strips = sides.withColumn("x1", F.lead("x0").over(Window.partitionBy(by).orderBy("x0"))).where(F.col("x1").isNotNull()).alias("s")
    own = members.select(by, *g.SIDES).alias("m")
    spans = strips.join(own, by).where("m.xmin <= s.x0 AND m.xmax >= s.x1").select(by, "x0", "x1", "ymin", "ymax")
    earlier = Window.partitionBy(by, "x0").orderBy("ymin", "ymax").rowsBetween(Window.unboundedPreceding, -1)
    new = F.greatest(F.col("ymax") - F.greatest("ymin", F.coalesce("so_far", "ymin")), F.lit(0.0))
    return spans.withColumn("so_far", F.max("ymax").over(earlier)).groupBy(by).agg(F.sum((F.col("x1") - F.col("x0")) * new).alias("area"))


def consensus(members: DataFrame, component: str = "component", run: str = "run_index", score: str | None = "segmenter_score", order: str = "flat_index", geometry: str = "best_score", aggregate_score: str = "mean", min_observations: int = 1, agreement: bool = True, ring: str | None = None) -> DataFrame:
    """One row per component: the chosen box, its score, tile, runs and how far the runs agree.

    geometry: best_score or largest. Ties go to the first member. Scores that are
    null don't count; without any the score is one over the number of runs. The
    agreement is the area common to all members over the area of their union. A
    ring comes along with its box, and areas are the rings'; their agreement isn't
    worked out.
    """
    if geometry not in ("best_score", "largest"):
        raise ValueError(f"no consensus geometry {geometry} for boxes")
    if ring and agreement:
        raise ValueError("the agreement of rings isn't worked out")
    b, a = g.box(), g.ring_area(F.col(ring)) if ring else g.area(g.box())
    box = F.struct(*[F.col(s) for s in g.SIDES], *([F.col(ring)] if ring else []))
    by_area = F.max_by(box, F.struct(a, -F.col(order)))
    observed = F.count_distinct(F.col(run))
    none = F.lit(None).cast("double")
    own = F.col(score) if score else none
    by_score = F.max_by(box, F.when(own.isNotNull(), F.struct(own, -F.col(order))))
    tile = F.coalesce(F.max_by("tile", F.when(own.isNotNull(), F.struct(own, -F.col(order)))), F.min_by("tile", order))
    total = {"mean": F.avg(own), "max": F.max(own), "area_weighted_mean": F.try_divide(F.sum(own * a), F.sum(F.when(own.isNotNull(), a)))}[aggregate_score]
    common = F.greatest(F.min(b[2]) - F.max(b[0]), F.lit(0.0)) * F.greatest(F.min(b[3]) - F.max(b[1]), F.lit(0.0))
    grouped = members.groupBy(component).agg(
        F.coalesce(by_score, by_area).alias("_box") if geometry == "best_score" else by_area.alias("_box"),
        F.coalesce(total, 1 / observed).alias("segmenter_score"),
        tile.alias("tile"), observed.alias("observation_count"), F.count("*").alias("members"),
        F.sort_array(F.collect_set(run)).alias("source_runs"), F.min(order).alias("first_member"),
        common.alias("_common"), F.max(a).alias("_largest"),
    )
    kept = grouped.where(F.col("observation_count") >= min_observations)
    if agreement:
        several = members.join(grouped.where("members > 1").select(component), component, "left_semi")
        kept = kept.join(covered_areas(several, component).withColumnRenamed("area", "_union"), component, "left")
        kept = kept.withColumn("run_agreement", F.when(F.col("members") == 1, 1.0).otherwise(g.ratio(F.col("_common"), F.col("_union")))).drop("_union")
    return kept.select("*", "_box.*").drop("_box", "_common", "_largest")


def merge_runs(boxes: DataFrame, threshold: float = 0.3, cell: float = 10.0, key: str = "object_id", run: str = "run_index", ring: str | None = None, **how) -> DataFrame:
    """Objects seen in several runs as one: overlapping boxes of different runs are linked, linked boxes are one object, numbered by first member."""
    flat = settle(numbered(boxes.withColumn("_order", F.struct(run, key)), "_order", "flat_index").drop("_order"), "runs")
    if ring:
        linked = overlapping_rings(flat, "flat_index", ring, cell, threshold, run).where(ring_iou() >= threshold)
    else:
        pairs = overlap_pairs(flat.select("flat_index", run, *g.SIDES), "flat_index", cell).where(F.col(f"a_{run}") != F.col(f"b_{run}"))
        linked = pairs.where(g.iou(g.box("a_"), g.box("b_")) >= threshold)
    # links of one place meet in one task, where most of what they join is joined at once
    place = [F.floor(F.col(c) / (100 * cell)) for c in ("a_xmin", "a_ymin")]
    edges = linked.select(F.col("a_flat_index").alias("a"), F.col("b_flat_index").alias("b"), *[p.alias(n) for p, n in zip(place, ("px", "py"), strict=True)])
    groups = connected_components(edges.repartition("px", "py").select("a", "b")).withColumnRenamed("node", "flat_index")
    members = flat.join(groups, "flat_index", "left").withColumn("component", F.coalesce("component", "flat_index"))
    return numbered(consensus(members, run=run, ring=ring, **how), "first_member", "object_id")


def numbered(df: DataFrame, order: str, name: str, first: int = 0) -> DataFrame:
    """Dense numbers in the order of a unique column, without sending all rows through one task.

    Rows are sorted into ranges; each range counts its own rows, and the counts of
    the ranges before it, a few numbers, are added.
    """
    ordered = settle(df.repartitionByRange(F.col(order)).sortWithinPartitions(order).withColumn("_part", F.spark_partition_id()), "ordered")
    sizes = ordered.groupBy("_part").agg(F.count("*").alias("n")).orderBy("_part").collect()
    begin, at = {}, first
    for r in sizes:
        begin[r["_part"]] = at
        at += r["n"]
    own = Window.partitionBy("_part").orderBy(order)
    starts = df.sparkSession.createDataFrame(list(begin.items()) or [(-1, 0)], "_part int, _start long")
    return ordered.join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + F.row_number().over(own) - 1).drop("_part", "_start")
