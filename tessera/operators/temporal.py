"""Objects over time: identity by overlap and nearness, zonal statistics, trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..plans.storage import settle
from .fusion import covered_areas, numbered
from .graph import connected_components, greedy_match
from .spatial import distance_join, overlap_pairs


def date_positions(df: DataFrame, date: str = "date", name: str = "position") -> DataFrame:
    """Adds each date's place among all dates, from 1; the dates are few and joined as a small table."""
    dates = df.select(date).where(F.col(date).isNotNull()).distinct()
    return df.join(F.broadcast(dates.withColumn(name, F.dense_rank().over(Window.orderBy(date)))), date, "left")


def match_over_time(objects: DataFrame, key: str = "object_id", position: str = "position", metric: str = "ioa", least: float = 0.2, within: float = 2.0, gap: int = 1, cell: float = 10.0) -> DataFrame:
    """object key and component: objects of different dates that are the same one.

    First, for each pair of dates no further apart than ``gap``, overlapping objects
    are assigned 1:1, best overlap first, ties to the larger keys. Then members of
    groups of a single date are assigned 1:1 to the nearest such member of another
    date within reach, ties to the smaller keys. Assigned objects are linked.
    """
    columns = [key, position, *g.SIDES]
    pairs = overlap_pairs(objects.select(*columns), key, cell)
    value = {"iou": g.iou, "ioa": g.ioa}[metric](g.box("a_"), g.box("b_"))
    apart = F.abs(F.col(f"a_{position}") - F.col(f"b_{position}"))
    swap = F.col(f"a_{position}") > F.col(f"b_{position}")
    pick = lambda c, early: F.when(swap == F.lit(early), F.col(f"b_{c}")).otherwise(F.col(f"a_{c}"))
    edges = pairs.withColumn("value", value).where((F.col("value") >= least) & apart.between(1, gap)).select(pick(key, True).alias("a"), pick(key, False).alias("b"), pick(position, True).alias("pa"), pick(position, False).alias("pb"), "value")
    first = settle(greedy_match(edges, [F.desc("value"), F.desc("a"), F.desc("b")], by=["pa", "pb"]).select("a", "b"), "overlapping")
    groups = connected_components(first).withColumnRenamed("node", key)
    links = first
    if within > 0:
        # a matched object's group spans two dates at least, so what is left is alone
        x, y = g.centroid(g.box())
        alone = objects.join(groups.select(key), key, "left_anti").select(key, position, x.alias("x"), y.alias("y"))
        near = distance_join(alone, alone, within).where((F.col(f"a_{key}") < F.col(f"b_{key}")) & apart.between(1, gap))
        near = near.select(F.col(f"a_{key}").alias("a"), F.col(f"b_{key}").alias("b"), "distance")
        second = _one_sided(near)
        links = links.union(second.select("a", "b"))
    groups = connected_components(links).withColumnRenamed("node", key)
    return objects.select(key).join(groups, key, "left").select(key, F.coalesce("component", key).alias("component"))


def _one_sided(edges: DataFrame) -> DataFrame:
    """Greedy assignment by distance where an object may stand on either side of an edge: it is used once on both together."""
    left = settle(edges, "near")
    taken = left.limit(0)
    while not left.isEmpty():
        ends = left.select(F.explode(F.array("a", "b")).alias("node"), F.struct("distance", "a", "b").alias("e")).groupBy("node").agg(F.min("e").alias("e"))
        now = settle(ends.groupBy("e").agg(F.count("*").alias("n")).where("n = 2").select("e.a", "e.b", "e.distance"), "picked")
        taken = taken.union(now.select(*left.columns))
        used = now.select(F.explode(F.array("a", "b")).alias("node"))
        left = settle(left.join(used.withColumnRenamed("node", "a"), "a", "left_anti").join(used.withColumnRenamed("node", "b"), "b", "left_anti").select(*edges.columns), "near")
    return taken


def reference_objects(objects: DataFrame, groups: DataFrame, key: str = "object_id", position: str = "position", score: str | None = "segmenter_score", site: str = "SITE", min_dates: int = 1) -> DataFrame:
    """One row per identity: crown_id, the best box, dates, agreement, ambiguity, confidence, mean score."""
    members = settle(objects.join(groups, key), "members")
    own = F.col(score) if score else F.lit(None).cast("double")
    box = F.struct(*[F.col(s) for s in g.SIDES])
    b, a = g.box(), g.area(g.box())
    by_date = members.groupBy("component", position).agg(F.count("*").alias("n"))
    double = by_date.groupBy("component").agg(F.sum(F.greatest(F.col("n") - 1, F.lit(0))).alias("surplus"), F.max("n").alias("most"))
    common = F.greatest(F.min(b[2]) - F.max(b[0]), F.lit(0.0)) * F.greatest(F.min(b[3]) - F.max(b[1]), F.lit(0.0))
    grouped = members.groupBy("component").agg(
        F.max_by(box, F.struct(F.coalesce(own, F.lit(float("-inf"))), -F.col(key))).alias("box"), F.count_distinct(position).alias("observation_count"), F.array_join(F.sort_array(F.collect_set(position)), ",").alias("date_coverage"),
        F.count("*").alias("members"), F.min(key).alias("first_member"), F.round(F.avg(own), 4).alias("mean_segmenter_score"), common.alias("common"), F.max(a).alias("largest"),
    )
    covered = covered_areas(members.join(grouped.where("members > 1").select("component"), "component", "left_semi")).withColumnRenamed("area", "union")
    found = grouped.join(covered, "component", "left").withColumn("run_agreement", F.when(F.col("members") == 1, 1.0).otherwise(g.ratio(F.col("common"), F.col("union"))))
    found = found.join(double, "component").withColumn("merge_ambiguity", F.col("most") > 1)
    found = found.withColumn("temporal_confidence", F.round(F.col("run_agreement") * (1 - F.col("surplus") / F.col("members")), 4)).withColumn("run_agreement", F.round("run_agreement", 4))
    named = numbered(found.drop("common", "largest", "union", "most"), "first_member", "number")
    named = named.withColumn("crown_id", F.concat(F.lit(f"{site}_"), F.lpad(F.col("number").cast("string"), 6, "0"))).drop("number")
    return named.where(F.col("observation_count") >= min_dates).select("crown_id", "component", "box.*", "observation_count", "date_coverage", "members", "run_agreement", "merge_ambiguity", "temporal_confidence", "mean_segmenter_score")


def zonal_median(pixels: DataFrame, zone: str, values: list[str], least: int = 3) -> DataFrame:
    """Median of each value per zone over its valid pixels, null with fewer than ``least``; zones with a valid value stay."""
    sound = lambda c: F.when(F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")), F.col(c))
    out = pixels.groupBy(zone).agg(*[F.when(F.count(sound(c)) >= least, F.median(sound(c))).alias(f"{c}_median") for c in values])
    return out.where(F.coalesce(*[F.col(f"{c}_median") for c in values]).isNotNull())


def complete_trend(series: DataFrame, key: str, date: str, value: str) -> DataFrame:
    """Median and quartiles by date over the keys that have a value on every date."""
    dates = series.where(F.col(value).isNotNull()).select(F.count_distinct(date).alias("dates"))
    whole = series.where(F.col(value).isNotNull()).groupBy(key).agg(F.count_distinct(date).alias("own")).join(F.broadcast(dates)).where("own = dates").select(key)
    quartiles: Column = F.percentile(F.col(value), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    out = series.join(whole, key, "left_semi").where(F.col(value).isNotNull()).groupBy(date).agg(quartiles.alias("q"), F.count("*").alias("n"))
    return out.select(date, F.col("q")[0].alias("q25"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q75"), "n")


def wide(series: DataFrame, key: str, date: str, value: str, dates: list[str]) -> DataFrame:
    """A column for each date; the dates are given, so that the plan is one aggregation."""
    return series.groupBy(key).pivot(date, dates).agg(F.first(value))
