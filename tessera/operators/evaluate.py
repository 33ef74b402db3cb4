"""Precision, recall and F1 at overlap thresholds and sizes, average precision, roll-ups and grid search."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..plans.storage import settle
from .graph import greedy_match
from .running import following_maximum, in_ranges, running_sums
from .spatial import ring_iou, ring_overlaps, spatial_join


def rates(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    """Precision, recall and F1; zero where nothing could be found."""
    p, r = g.ratio(tp, tp + fp), g.ratio(tp, tp + fn)
    return {"precision": p, "recall": r, "f1": g.ratio(2 * p * r, p + r)}


def overlaps(preds: DataFrame, truths: DataFrame, cell: float, by: Sequence[str] = (), pred: Sequence[str] = (), truth: Sequence[str] = (), ring: str | None = None, least: float = 0.0) -> DataFrame:
    """by, pred, truth, iou of overlapping predictions and truths; other columns of theirs come along as pred_* and truth_*.

    With a column of rings the overlap is that of the rings, and pairs that cannot reach ``least`` may be left out.
    """
    shape = [*g.SIDES, *([ring] if ring else [])]
    own, other = preds.select(*by, "pred", *pred, *shape), truths.select(*by, "truth", *truth, *shape)
    pairs, iou = spatial_join(own, other, cell, by), g.iou(g.box("a_"), g.box("b_"))
    if ring:
        pairs, iou = ring_overlaps(pairs, ring, least), ring_iou()
    more = [*[F.col(f"a_{c}").alias(f"pred_{c}") for c in pred], *[F.col(f"b_{c}").alias(f"truth_{c}") for c in truth]]
    return pairs.select(*[F.col(f"a_{c}").alias(c) for c in by], F.col("a_pred").alias("pred"), F.col("b_truth").alias("truth"), iou.alias("iou"), *more)


def evaluate(preds: DataFrame, truths: DataFrame, thresholds: Sequence[float], cell: float, gsd: float = 1.0, by: Sequence[str] = (), sizes: bool = True, ring: str | None = None) -> DataFrame:
    """by, size, threshold, tp, fp, fn, precision, recall, f1.

    preds: by, pred, score, box; truths: by, truth, box. Predictions, best score
    first, take the free truth that they overlap most. Within a size class only
    predictions and truths of that class meet; the class all holds every one.
    Overlaps are computed once for all thresholds and sizes. With a column of rings,
    overlaps and sizes are theirs.
    """
    thresholds = sorted(set(thresholds))
    label = g.size_label(g.ring_area(F.col(ring)) if ring else g.area(g.box()), gsd)
    p, t = preds.withColumn("size", label), truths.withColumn("size", label)
    each = F.explode(F.array(*map(F.lit, thresholds)))
    edges = overlaps(p, t, cell, by, ["score", "size"], ["size"], ring, thresholds[0]).where(F.col("iou") >= thresholds[0])
    both = F.array(F.lit("all"), F.col("pred_size"))
    classes = F.when(F.col("pred_size") == F.col("truth_size"), both).otherwise(F.array(F.lit("all"))) if sizes else F.array(F.lit("all"))
    edges = edges.select(*by, "pred", "truth", "iou", F.col("pred_score").alias("score"), F.explode(classes).alias("size")).withColumn("threshold", each).where("iou >= threshold")
    group = [*by, "size", "threshold"]
    hits = greedy_match(edges, [F.desc("score"), "pred", F.desc("iou"), "truth"], by=group, a="pred", b="truth").groupBy(*group).agg(F.count("*").alias("tp"))
    keys = [*by, "size"]
    sized = lambda df: df.withColumn("size", F.explode(F.array(F.lit("all"), "size") if sizes else F.array(F.lit("all")))).groupBy(*keys)
    counts = sized(p).agg(F.count("*").alias("preds")).join(sized(t).agg(F.count("*").alias("truths")), keys, "full").withColumn("threshold", each)
    out = counts.join(hits, group, "left")
    tp = F.coalesce("tp", F.lit(0))
    out = out.select(*group, tp.alias("tp"), (F.coalesce("preds", F.lit(0)) - tp).alias("fp"), (F.coalesce("truths", F.lit(0)) - tp).alias("fn"))
    return out.withColumns(rates(F.col("tp"), F.col("fp"), F.col("fn")))


def presets(preds: DataFrame, truths: DataFrame, least: Mapping[str, float], thresholds: Sequence[float], cell: float, gsd: float = 1.0) -> DataFrame:
    """evaluate by preset: each looks at the predictions that reach its least score, all in one plan."""
    kinds = F.array(*[F.struct(F.lit(n).alias("preset"), F.lit(float(v)).alias("least")) for n, v in least.items()])
    p = preds.withColumn("preset", F.explode(F.transform(F.filter(kinds, lambda k: F.col("score") >= k.least), lambda k: k.preset)))
    t = truths.withColumn("preset", F.explode(F.array(*map(F.lit, least))))
    return evaluate(p, t, thresholds, cell, gsd, ["preset"], sizes=False)


def match_prompts(preds: DataFrame, truths: DataFrame, cell: float, by: Sequence[str] = (), above: float = 0.3) -> DataFrame:
    """by, pred, truth, iou: predictions, in the order of their numbers, take the free truth that they overlap most, if by more than ``above``.

    Truths without a mask are left out by the caller. The overlap is of the union plus a millionth.
    """
    own, other = preds.select(*by, "pred", *g.SIDES), truths.select(*by, "truth", *g.SIDES)
    pairs = spatial_join(own, other, cell, by).withColumn("iou", g.iou(g.box("a_"), g.box("b_"), 1e-6)).where(F.col("iou") > above)
    edges = pairs.select(*[F.col(f"a_{c}").alias(c) for c in by], F.col("a_pred").alias("pred"), F.col("b_truth").alias("truth"), "iou")
    return greedy_match(edges, ["pred", F.desc("iou"), "truth"], by, "pred", "truth")


def summary(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Means over the thresholds, the lists by threshold, the values at 50 and 75, and the counts at the lowest threshold."""
    keys = [*by, "size"]
    listed = lambda c: F.transform(F.sort_array(F.collect_list(F.struct("threshold", c))), lambda x: x[c])
    at = lambda c, t: F.max(F.when(F.col("threshold") == t, F.col(c)))
    metrics = ("precision", "recall", "f1")
    return table.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in metrics], *[listed(c).alias(f"{c}_list") for c in metrics], *[at(c, t).alias(f"{c}_{round(t * 100)}") for c in metrics for t in (0.5, 0.75)], *[F.min_by(c, "threshold").alias(c) for c in ("tp", "fp", "fn")])


def average_precision(preds: DataFrame, truths: DataFrame, thresholds: Sequence[float], cell: float, by: Sequence[str] = ("image", "category"), image: str = "image", most: int = 100, area: tuple[float, float] = (0.0, 1e10)) -> DataFrame:
    """category, threshold, ap, ar by the usual rules of box evaluation.

    In each image and category the ``most`` best predictions, best first, take the
    free truth that they overlap most, truths inside the area range before others;
    matches with truths outside it and unmatched predictions outside it don't count.
    Precision is made non-increasing from the right and read at 101 recalls. -1
    where there is no truth.
    """
    rank = Window.partitionBy(*by).orderBy(F.desc("score"), "pred")
    best = settle(preds.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= most), "best")
    inside = g.area(g.box()).between(*area)
    truths = truths.withColumn("ignored", ~inside)
    each = F.explode(F.array(*map(F.lit, thresholds)))
    edges = overlaps(best, truths, cell, by, ["rank"], ["ignored"]).withColumnsRenamed({"pred_rank": "rank", "truth_ignored": "ignored"})
    edges = edges.withColumn("threshold", each).where("iou >= threshold")
    hit = greedy_match(edges, ["rank", "ignored", F.desc("iou"), "truth"], by=[*by, "threshold"], a="pred", b="truth").select(*by, "threshold", "pred", "ignored")
    kinds = [c for c in by if c != image]
    all_preds = best.select(*by, "pred", "score", (~inside).alias("outside")).withColumn("threshold", each)
    judged = all_preds.join(hit, [*by, "threshold", "pred"], "left").where(~F.coalesce("ignored", F.col("outside")))
    judged = judged.withColumn("tp", F.col("ignored").isNotNull().cast("long"))
    group, order = [*kinds, "threshold"], [F.desc("score"), F.col(image), F.col("pred")]
    n = truths.where(~F.col("ignored")).groupBy(*kinds).agg(F.count("*").alias("n")) if kinds else truths.where(~F.col("ignored")).agg(F.count("*").alias("n"))
    curve = running_sums(in_ranges(judged.select(*group, "score", image, "pred", "tp"), group, order), group, order, {"hits": F.col("tp"), "seen": F.lit(1).cast("long")})
    curve = (curve.join(F.broadcast(n), kinds) if kinds else curve.crossJoin(F.broadcast(n))).withColumn("precision", F.col("hits") / F.col("seen")).withColumn("recall", F.try_divide("hits", "n"))
    curve = following_maximum(curve, group, order, "precision", "envelope")
    # each recall mark takes the envelope of the first point that reaches it: a point serves the marks since its predecessor
    reached = lambda hits: F.floor(F.try_divide(hits, F.col("n")) * 100 + 1e-9)
    marks = reached(F.col("hits")) - F.when(F.col("seen") == 1, -1).otherwise(reached(F.col("hits") - F.col("tp")))
    area_under = curve.withColumn("marks", marks).groupBy(*kinds, "threshold").agg((F.sum(F.col("marks") * F.col("envelope")) / 101).alias("ap"), F.max("recall").alias("ar"))
    base = (n if kinds else n.where("n > 0")).withColumn("threshold", each)
    return base.join(area_under, [*kinds, "threshold"], "left").select(*kinds, "threshold", *[F.when(F.col("n") == 0, -1.0).otherwise(F.coalesce(c, F.lit(0.0))).alias(c) for c in ("ap", "ar")])


def weighted_rows(table: DataFrame, by: Sequence[str], metrics: Sequence[str], weight: str, sums: Sequence[str] = (), total: str | None = None) -> DataFrame:
    """Means weighted by a count, plain where the counts are zero; sums of other columns."""
    w = F.col(weight)
    mean = lambda c: F.coalesce(F.try_divide(F.sum(F.col(c) * w), F.sum(F.when(F.col(c).isNotNull(), w))), F.avg(c))
    out = table.groupBy(*by).agg(*[mean(c).alias(c) for c in metrics], F.sum(w).alias(weight), *[F.sum(c).alias(c) for c in sums])
    return out.withColumn(total, F.lit("average")) if total else out


def with_average(table: DataFrame, by: Sequence[str], name: str, metrics: Sequence[str], weight: str) -> DataFrame:
    """The rows and, for each group, their weighted average under the name ``average``."""
    return table.unionByName(weighted_rows(table, by, metrics, weight, total=name), allowMissingColumns=True)


def best_row(table: DataFrame, by: str = "f1", name: str | None = None, order: Sequence = ()) -> DataFrame:
    """The row with the largest value, among the average rows if there are such."""
    if name:
        averages = table.where(F.col(name) == "average")
        table = averages if not averages.isEmpty() else table
    return table.orderBy(F.desc(by), *order).limit(1)


def weighted_lists(table: DataFrame, by: Sequence[str], values: str, weight: str) -> DataFrame:
    """Element-wise weighted means of lists of one length."""
    each = table.select(*by, weight, F.posexplode(values).alias("at", "value"))
    mean = each.groupBy(*by, "at").agg(F.try_divide(F.sum(F.col("value") * F.col(weight)), F.sum(weight)).alias("value"))
    return mean.groupBy(*by).agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]).alias(values))


def mean_and_spread(table: DataFrame, by: Sequence[str], metrics: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Mean and population deviation of metrics over repeated runs; other columns as in the first run."""
    return table.groupBy(*by).agg(*[f(c).alias(f"{c}_{n}") for c in metrics for n, f in (("mean", F.avg), ("std", F.stddev_pop))], *[F.min_by(c, "run").alias(c) for c in keep])


def joined_summaries(tiles: DataFrame, rasters: DataFrame, keys: Sequence[str] = ("location", "product_name"), prefixes: tuple[str, str] = ("", "")) -> DataFrame:
    """Tile rows with the raster columns that they lack, by place and product; with prefixes all columns of both."""
    left = tiles.select(*keys, *[F.col(c).alias(f"{prefixes[0]}{c}") for c in tiles.columns if c not in keys])
    right = rasters.select(*keys, *[F.col(c).alias(f"{prefixes[1]}{c}") for c in rasters.columns if c not in keys and f"{prefixes[1]}{c}" not in left.columns])
    return left.join(right, list(keys), "left")


def micro_f1(table: DataFrame, predicted: str, truth: str) -> DataFrame:
    """Over all classes together, where precision, recall and F1 are the share of right predictions."""
    return table.where(F.col(predicted).isNotNull() & F.col(truth).isNotNull()).agg(g.ratio(F.count_if(F.col(predicted) == F.col(truth)).cast("double"), F.count("*").cast("double")).alias("micro_f1"), F.count("*").alias("n"))


def grid_search(boxes: DataFrame, truths: DataFrame, nms: Sequence[float], scores: Sequence[float], cell: float, by: str = "raster", key: str = "object_id", score: str = "score", at: float = 0.5) -> DataFrame:
    """raster, nms_threshold, score_threshold, counts and rates for every pair of parameters, and an average row for each pair.

    Overlaps don't depend on the parameters and are computed once; all pairs of
    parameters are suppressed and evaluated in one plan, keyed by them.
    """
    from .fusion import conflicts
    from .graph import greedy_suppress

    grid = [(n, s) for n in sorted(set(nms)) for s in sorted(set(scores))]
    params = F.explode(F.array(*[F.struct(F.lit(n).alias("nms_threshold"), F.lit(s).alias("score_threshold")) for n, s in grid])).alias("p")
    group = [by, "nms_threshold", "score_threshold"]
    edges = spatial_edges(boxes, min(nms), cell, by, key, score)
    conflict = edges.select("*", params).select("*", "p.*").where((F.col("iou") >= F.col("nms_threshold")) & (F.col("low_score") >= F.col("score_threshold")))
    lost = greedy_suppress(settle(conflict.select(*group, "hi", "lo"), "grid"), group)
    kept = boxes.select("*", params).select("*", "p.*").drop("p").where(F.col(score) >= F.col("score_threshold")).join(lost.withColumnRenamed("lo", key), [*group, key], "left_anti")
    kept = settle(kept.withColumnRenamed(key, "pred").withColumn("score", F.col(score)), "kept")
    pairs = overlaps(boxes.withColumnRenamed(key, "pred"), truths, cell, [by]).where(F.col("iou") >= at)
    hits = greedy_match(kept.select(*group, "pred", "score").join(pairs, [by, "pred"]), [F.desc("score"), "pred", F.desc("iou"), "truth"], by=group, a="pred", b="truth").groupBy(*group).agg(F.count("*").alias("tp"))
    there = truths.groupBy(by).agg(F.count("*").alias("num_truths")).select("*", params).select(by, "num_truths", "p.*")
    table = there.join(kept.groupBy(*group).agg(F.count("*").alias("num_preds")), group, "left").join(hits, group, "left").na.fill(0, ["num_preds", "tp"])
    table = table.withColumns(rates(F.col("tp"), F.col("num_preds") - F.col("tp"), F.col("num_truths") - F.col("tp")))
    table = table.select(F.col(by).cast("string").alias(by), "nms_threshold", "score_threshold", "precision", "recall", "f1", "num_truths", "num_preds", "tp")
    average = weighted_rows(table, group[1:], ("precision", "recall", "f1"), "num_truths", sums=("num_preds", "tp"), total=by)
    return table.unionByName(average)


def spatial_edges(boxes: DataFrame, least: float, cell: float, by: str, key: str, score: str) -> DataFrame:
    """by, hi, lo, iou and the worse score of overlapping boxes, whatever the parameters."""
    from .spatial import overlap_pairs

    pairs = overlap_pairs(boxes.select(by, key, score, *g.SIDES), key, cell, [by]).withColumn("iou", g.iou(g.box("a_"), g.box("b_"))).where(F.col("iou") >= least)
    a_first = F.struct(-F.col(f"a_{score}"), F.col(f"a_{key}")) < F.struct(-F.col(f"b_{score}"), F.col(f"b_{key}"))
    return pairs.select(F.col(f"a_{by}").alias(by), F.when(a_first, F.col(f"a_{key}")).otherwise(F.col(f"b_{key}")).alias("hi"), F.when(a_first, F.col(f"b_{key}")).otherwise(F.col(f"a_{key}")).alias("lo"), "iou", F.least(f"a_{score}", f"b_{score}").alias("low_score"))
