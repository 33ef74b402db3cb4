"""Composite components and the functions that users plug in."""

from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import models
from ..functions import raster as ras
from ..operators import evaluate, fusion, imagery, spatial, temporal, tiling
from ..plans import components as plan
from ..plans.storage import settle
from ..views import duck, table, view
from .aggregations import AGREE, AP, COMP, SIZED
from .joins import PAIRS, PROMPTS, RING_LEAST, TRUE_PAIRS, on_corners, pairs, with_ring
from .registry import COMMON, IOU, MEET, cells, in_first_cell, matched, query, r, reached, suppressed
from .rasters import difference

AREA = "((xmax - xmin) * (ymax - ymin))"


def tile_boxes(s, d):
    t = view(s, d, "truth")
    x, y = F.col("tile") % 32 * 100.0, F.floor(F.col("tile") / 32) * 100.0
    return t.select("tile").distinct().select("tile", x.alias("xmin"), y.alias("ymin"), (x + 100).alias("xmax"), (y + 100).alias("ymax"))


@query("cmp01_tilerizer", duck("truth") + f"SELECT a.t AS tile, b.truth, {r('greatest(b.xmin, a.xmin) - a.xmin')} AS x0 FROM (SELECT tile AS t, tile % 32 * 100.0 AS xmin, floor(tile / 32) * 100.0 AS ymin, tile % 32 * 100.0 + 100 AS xmax, floor(tile / 32) * 100.0 + 100 AS ymax FROM (SELECT DISTINCT tile FROM truth) q) a JOIN truth b ON {MEET} WHERE {COMMON} / ((b.xmax - b.xmin) * (b.ymax - b.ymin)) >= 0.6")
def _(s, d):
    return tiling.labelled(tile_boxes(s, d), view(s, d, "truth"), 0.6, 100.0).select(F.col("a_tile").alias("tile"), F.col("b_truth").alias("truth"), "x0")


@query("cmp02_enhancer", duck("bands") + f", q AS (SELECT tile, quantile_cont(nir, 0.02) AS lo, quantile_cont(nir, 0.98) AS hi FROM bands GROUP BY tile) SELECT tile, 'cir' AS method, sum(trunc(least(greatest((nir - lo) / (hi - lo + 1e-9), 0), 1) * 255.0)) AS red FROM bands JOIN q USING (tile) GROUP BY tile")
def _(s, d):
    return imagery.enhancements(view(s, d, "bands"), ["cir"]).groupBy("tile", "method").agg(F.sum("red").alias("red"))


def tile_paths(s, d):
    return table(s, d, "supplier").select(F.concat(F.lit("tile_"), "s_suppkey").alias("tile_path"))


def detections(s, d, model="faster_rcnn"):
    return models.detect(tile_paths(s, d), model)


@query("cmp03_detector")
def _(s, d):
    found = detections(s, d).withColumn("object_id", F.xxhash64("tile_path", "xmin", "ymin", "xmax", "ymax", "detector_score"))
    fused = fusion.fuse_boxes(found.withColumnRenamed("detector_score", "score"), 0.4, 20.0, by=["tile_path"])
    return fused.groupBy("tile_path").agg(F.count("*").alias("boxes"), F.max("score").alias("best"))


PEN = f"CASE WHEN {AREA} < 1 THEN greatest(0.1, {AREA} / 1) WHEN {AREA} > 64 THEN greatest(0.1, 64 / {AREA}) ELSE 1.0 END"
AGG = f"sc AS MATERIALIZED (SELECT * FROM (SELECT *, CASE WHEN detector_score * {PEN} <= 0 OR segmenter_score * {PEN} <= 0 THEN 0 ELSE exp((ln(detector_score * {PEN}) + ln(segmenter_score * {PEN})) / 2) END AS score FROM det) q WHERE score >= 0.5)"
HILO = "CASE WHEN (-a.score, a.object_id) < (-b.score, b.object_id) THEN a.object_id ELSE b.object_id END AS hi, CASE WHEN (-a.score, a.object_id) < (-b.score, b.object_id) THEN b.object_id ELSE a.object_id END AS lo"


@query("cmp04_aggregator", duck("det") + f", {AGG}, {cells('sc', 'k')}, edges AS (SELECT {HILO} FROM k a JOIN k b ON {in_first_cell()} AND a.object_id < b.object_id AND {IOU} >= 0.5), {suppressed('edges')} SELECT object_id, {r('score')} AS aggregator_score FROM sc WHERE object_id NOT IN (SELECT lo FROM s) AND {AREA} >= 1 AND {AREA} <= 64")
def cmp04(s, d):
    config = fusion.AggregatorConfig({"detector_score": 1.0, "segmenter_score": 1.0}, least_area=1.0, most_area=64.0)
    return fusion.aggregate(view(s, d, "det").select("object_id", "detector_score", "segmenter_score", *g.SIDES), config).select("object_id", "aggregator_score")


@query("cmp05_segmenter")
def _(s, d):
    return models.segment(detections(s, d), "sam2").groupBy("tile_path").agg(F.count("*").alias("n"), F.avg("segmenter_score").alias("score"))


@query("cmp05_unprompted_segmenter")
def _(s, d):
    made = models.segment_tiles(tile_paths(s, d), "unet_treecrown")
    return made.groupBy("tile_path").agg(F.count("*").alias("n"), F.avg("segmenter_score").alias("score"), F.sum(g.area(g.box())).alias("boxes"), F.sum(F.size("ring")).alias("corners"))


@query("cmp06_classifier")
def _(s, d):
    rows = table(s, d, "part").select("p_partkey", "p_name")
    return models.classify(rows, "p_name", "resnet").groupBy("classifier_class").agg(F.count("*").alias("n"), F.avg("classifier_score").alias("score"))


@query("cmp07_multirun_merger", COMP + f", c AS (SELECT component, arg_max(object_id, (segmenter_score, -run_index, -object_id)) AS best, avg(segmenter_score) AS score, count(DISTINCT run_index) AS observation_count, min((run_index, object_id)) AS first FROM mem GROUP BY component) SELECT row_number() OVER (ORDER BY first) - 1 AS object_id, {r('score')} AS segmenter_score, observation_count, {r('xmin')} AS xmin FROM c JOIN det ON det.object_id = c.best")
def _(s, d):
    merged = fusion.merge_runs(view(s, d, "det").select("object_id", "run_index", "tile", "segmenter_score", *g.SIDES), agreement=False)
    return merged.select("object_id", "segmenter_score", "observation_count", "xmin")


RING_COMP = COMP.replace(duck("det").replace("WITH ", "WITH RECURSIVE ", 1), on_corners("det").replace("WITH ", "WITH RECURSIVE ", 1)).replace("iou >= 0.3", f"iou >= {RING_LEAST}")


@query("cmp07_ring_merger", RING_COMP + f", c AS (SELECT component, arg_max(object_id, (segmenter_score, -run_index, -object_id)) AS best, avg(segmenter_score) AS score, count(DISTINCT run_index) AS observation_count, min((run_index, object_id)) AS first FROM mem GROUP BY component) SELECT row_number() OVER (ORDER BY first) - 1 AS object_id, {r('score')} AS segmenter_score, observation_count, {r(AREA + ' / 2')} AS area FROM c JOIN det ON det.object_id = c.best")
def _(s, d):
    merged = fusion.merge_runs(with_ring(view(s, d, "det").select("object_id", "run_index", "tile", "segmenter_score", *g.SIDES)), RING_LEAST, agreement=False, ring="ring")
    return merged.select("object_id", "segmenter_score", "observation_count", g.ring_area(F.col("ring")).alias("area"))


GAP = ", ".join(f"({a}, {a + 1})" for a in range(1, 7))
OVER = f"x AS (SELECT least(pa, pb) AS p1, greatest(pa, pb) AS p2, CASE WHEN pa < pb THEN ia ELSE ib END AS a, CASE WHEN pa < pb THEN ib ELSE ia END AS b, ioa FROM (SELECT ia, ib, ra + 1 AS pa, rb + 1 AS pb, ioa FROM pairs) q WHERE abs(pa - pb) = 1 AND ioa >= 0.2)"


@query("cmp08_temporal_matcher", duck("det").replace("WITH ", "WITH RECURSIVE ", 1) + f", {PAIRS}, {OVER}, {matched('x', 'ioa DESC, a DESC, b DESC', ('p1', 'p2'))}, {reached('m')}, t AS (SELECT object_id, coalesce(component, object_id) AS component FROM det LEFT JOIN comp ON node = object_id) SELECT object_id, component FROM t")
def _(s, d):
    return temporal.match_over_time(view(s, d, "det").withColumnRenamed("date_pos", "position"), within=0)


@query("cmp08_reference_objects")
def _(s, d):
    objects = view(s, d, "truth").select(F.col("truth").alias("object_id"), (F.col("truth") % 5 + 1).alias("position"), *g.SIDES, F.lit(0.5).alias("segmenter_score"))
    return temporal.reference_objects(objects, temporal.match_over_time(objects))


@query("cmp09_vegetation_statistics", duck("bands") + f"SELECT tile, {r('median(' + difference('nir', 'red') + ')')} AS ndvi_median, {r('median(' + difference('nir', 'green') + ')')} AS gndvi_median FROM (SELECT tile, floor(\"row\" / 2) AS r2, floor(col / 2) AS c2, avg(nir) AS nir, avg(red) AS red, avg(green) AS green FROM bands GROUP BY ALL) q GROUP BY tile")
def _(s, d):
    small = imagery.block_average(view(s, d, "bands"), 2, ["nir", "red", "green"])
    own = {b: F.col(b) for b in ("nir", "red", "green")}
    return temporal.zonal_median(small.withColumns({n: ras.vegetation_index(n, own) for n in ("ndvi", "gndvi")}), "tile", ["ndvi", "gndvi"])


SIZES = duck("det", "truth") + f""", sd AS (SELECT object_id AS pred, detector_score AS score, {SIZED} AS size, xmin, ymin, xmax, ymax FROM (SELECT *, {AREA} AS a FROM det) q), st AS (SELECT truth, {SIZED} AS size, xmin, ymin, xmax, ymax FROM (SELECT *, {AREA} AS a FROM truth) q),
    {cells('sd', 'k')}, {cells('st', 'u')}, x AS (SELECT a.size, a.pred AS a, b.truth AS b, a.score, {IOU} AS iou FROM k a JOIN u b ON {in_first_cell()} AND a.size = b.size WHERE {IOU} >= 0.5), {matched('x', 'score DESC, a, iou DESC, b', ('size',))}
    SELECT size, count(*) FILTER (kind = 'm') AS tp, count(*) FILTER (kind = 'p') - count(*) FILTER (kind = 'm') AS fp, count(*) FILTER (kind = 't') - count(*) FILTER (kind = 'm') AS fn FROM (SELECT size, 'm' AS kind FROM m UNION ALL SELECT size, 'p' FROM sd UNION ALL SELECT size, 't' FROM st) q GROUP BY size"""


@query("cmp10_raster_evaluator", SIZES)
def _(s, d):
    p = view(s, d, "det").select(F.col("object_id").alias("pred"), F.col("detector_score").alias("score"), *g.SIDES)
    t = evaluate.evaluate(p, view(s, d, "truth").select("truth", *g.SIDES), [0.5], 10.0, 0.5)
    return t.where("size <> 'all'").select("size", "tp", "fp", "fn")


@query("cmp10_ring_evaluator", on_corners("det", "truth") + f", {TRUE_PAIRS}, x AS (SELECT pred AS a, truth AS b, score, iou FROM hits WHERE iou >= {RING_LEAST}), {matched('x', 'score DESC, a, iou DESC, b')} SELECT (SELECT count(*) FROM m) AS tp, (SELECT count(*) FROM det) - (SELECT count(*) FROM m) AS fp, (SELECT count(*) FROM truth) - (SELECT count(*) FROM m) AS fn")
def _(s, d):
    p = with_ring(view(s, d, "det").select(F.col("object_id").alias("pred"), F.col("detector_score").alias("score"), *g.SIDES))
    t = evaluate.evaluate(p, with_ring(view(s, d, "truth").select("truth", *g.SIDES)), [RING_LEAST], 10.0, sizes=False, ring="ring")
    return t.select("tp", "fp", "fn")


@query("cmp11_tile_evaluator")
def _(s, d):
    p = view(s, d, "det").select(F.col("tile").alias("image"), F.col("class").alias("category"), F.col("object_id").alias("pred"), F.col("detector_score").alias("score"), *g.SIDES)
    t = view(s, d, "truth").select(F.col("tile").alias("image"), F.when(F.col("truth") % 2 == 0, "R").otherwise("N").alias("category"), "truth", *g.SIDES)
    return evaluate.average_precision(p, t, [round(0.5 + 0.05 * i, 2) for i in range(10)], 10.0, most=400, area=(4.0, 100.0))


GRID = duck("det", "truth") + f""", b0 AS MATERIALIZED (SELECT tile % 4 AS raster, object_id, detector_score AS score, xmin, ymin, xmax, ymax FROM det), t0 AS MATERIALIZED (SELECT tile % 4 AS raster, truth, xmin, ymin, xmax, ymax FROM truth), g AS (SELECT * FROM (VALUES (0.3), (0.6)) n(nms), (VALUES (0.6), (0.8)) c(least)),
    {cells('b0', 'k')}, {cells('t0', 'u')}, pe AS MATERIALIZED (SELECT a.raster, {HILO}, least(a.score, b.score) AS low, {IOU} AS iou FROM k a JOIN k b ON {in_first_cell()} AND a.raster = b.raster AND a.object_id < b.object_id),
    edges AS (SELECT raster, nms, least, hi, lo FROM pe, g WHERE iou >= nms AND low >= least), {suppressed('edges', ('raster', 'nms', 'least'))},
    kept AS MATERIALIZED (SELECT b0.*, nms, g.least FROM b0, g WHERE score >= g.least AND NOT EXISTS (SELECT 1 FROM s WHERE s.raster = b0.raster AND s.nms = g.nms AND s.least = g.least AND s.lo = b0.object_id)),
    h AS MATERIALIZED (SELECT a.raster, a.object_id, b.truth, {IOU} AS iou FROM k a JOIN u b ON {in_first_cell()} AND a.raster = b.raster WHERE {IOU} >= 0.5), x AS (SELECT kept.raster, nms, least, kept.object_id AS a, truth AS b, score, iou FROM kept JOIN h ON h.raster = kept.raster AND h.object_id = kept.object_id),
    {matched('x', 'score DESC, a, iou DESC, b', ('raster', 'nms', 'least'))},
    n AS (SELECT raster, nms, least, count(*) AS preds FROM kept GROUP BY ALL), tt AS (SELECT raster, count(*) AS truths FROM t0 GROUP BY raster), mm AS (SELECT raster, nms, least, count(*) AS tp FROM m GROUP BY ALL),
    f AS (SELECT raster, nms, least, preds, truths, coalesce(tp, 0) AS tp, 2.0 * coalesce(tp, 0) / (preds + truths) AS f1 FROM n JOIN tt USING (raster) LEFT JOIN mm USING (raster, nms, least))
    SELECT CAST(raster AS VARCHAR) AS raster, CAST(nms AS DOUBLE) AS nms_threshold, CAST(least AS DOUBLE) AS score_threshold, {r('f1')} AS f1, truths AS num_truths, preds AS num_preds, tp FROM f
    UNION ALL SELECT 'average', CAST(nms AS DOUBLE), CAST(least AS DOUBLE), {r('sum(f1 * truths) / sum(truths)')}, sum(truths), sum(preds), sum(tp) FROM f GROUP BY nms, least"""


@query("cmp12_grid_search", GRID)
def _(s, d):
    b = view(s, d, "det").select((F.col("tile") % 4).alias("raster"), "object_id", F.col("detector_score").alias("score"), *g.SIDES)
    t = view(s, d, "truth").select((F.col("tile") % 4).alias("raster"), "truth", *g.SIDES)
    return evaluate.grid_search(b, t, [0.3, 0.6], [0.6, 0.8], 10.0).select("raster", "nms_threshold", "score_threshold", "f1", "num_truths", "num_preds", "tp")


@query("cmp13_dataset_benchmark", duck("metrics") + f"SELECT product, {r('sum(f1 * num_truths) / sum(num_truths)')} AS f1, {r('sum(precision_50 * num_truths) / sum(num_truths)')} AS precision_50, sum(num_truths) AS num_truths, sum(tp) AS tp FROM metrics GROUP BY product")
def _(s, d):
    return evaluate.weighted_rows(view(s, d, "metrics"), ["product"], ["f1", "precision_50"], "num_truths", ["tp"])


PRESETS = {"base": 0.0, "trusted": 0.7}
PRESET = duck("det", "truth") + f""", {TRUE_PAIRS}, g AS (SELECT * FROM (VALUES (0.5), (0.75)) t(threshold), (VALUES {', '.join(f"('{n}', {v})" for n, v in PRESETS.items())}) p(preset, least)),
    x AS (SELECT preset, threshold, pred AS a, truth AS b, score, iou FROM hits, g WHERE iou >= threshold AND score >= least), {matched('x', 'score DESC, a, iou DESC, b', ('preset', 'threshold'))},
    n AS (SELECT preset, count(*) AS preds FROM det, (SELECT DISTINCT preset, least FROM g) q WHERE detector_score >= least GROUP BY preset), mm AS (SELECT preset, threshold, count(*) AS tp FROM m GROUP BY ALL)
    SELECT preset, CAST(threshold AS DOUBLE) AS threshold, coalesce(tp, 0) AS tp, preds - coalesce(tp, 0) AS fp, (SELECT count(*) FROM truth) - coalesce(tp, 0) AS fn FROM g JOIN n USING (preset) LEFT JOIN mm USING (preset, threshold)"""


@query("cmp14_preset_benchmark", PRESET)
def _(s, d):
    p = view(s, d, "det").select(F.col("object_id").alias("pred"), F.col("detector_score").alias("score"), *g.SIDES)
    t = evaluate.presets(p, view(s, d, "truth").select("truth", *g.SIDES), PRESETS, [0.5, 0.75], 10.0)
    return t.select("preset", "threshold", "tp", "fp", "fn")


@query("cmp15_standalone_component", duck("det") + "SELECT count(*) AS n, 1 AS has_score FROM det")
def _(s, d):
    scored = plan.Component("scorer", plan.Contract(frozenset(["objects"]), frozenset(["object_id", "detector_score"]), frozenset(), frozenset(["twice"])), lambda state: plan.Result(state.tables["objects"].select("object_id", (F.col("detector_score") * 2).alias("twice"))))
    state = plan.run_standalone(scored, objects=view(s, d, "det").select("object_id", "detector_score", *g.SIDES))
    objects = state.tables["objects"]
    return objects.agg(F.count("*").alias("n")).withColumn("has_score", F.lit(int("twice" in objects.columns)))


@query("cmp16_plot_data", duck("det") + f"SELECT run_index, count(*) AS n, {r('quantile_cont(detector_score, 0.5)')} AS median FROM det GROUP BY run_index")
def _(s, d):
    return view(s, d, "det").groupBy("run_index").agg(F.count("*").alias("n"), F.percentile("detector_score", F.lit(0.5)).alias("median"))


@query("cmp17_training_pairs", duck("det", "truth") + f", {PROMPTS}, x AS (SELECT pred AS a, truth AS b, iou FROM hits WHERE iou > 0.3 AND score >= 0.7), {matched('x', 'a, iou DESC, b')} SELECT a AS pred, b AS truth FROM m")
def _(s, d):
    trusted = view(s, d, "det").where("detector_score >= 0.7").withColumnRenamed("object_id", "pred")
    return evaluate.match_prompts(trusted, view(s, d, "truth"), 10.0).select("pred", "truth")


@query("udf01_registry", "SELECT * FROM (VALUES ('resnet', true), ('swin', true), ('missing', false)) t(name, there)")
def _(s, d):
    return s.createDataFrame([(n, n in models.CLASSIFIERS) for n in ("resnet", "swin", "missing")], "name string, there boolean")


@query("udf02_detectors")
def _(s, d):
    out = None
    for model in models.DETECTORS.names():
        own = detections(s, d, model).agg(F.count("*").alias("n")).select(F.lit(model).alias("model"), "n")
        out = own if out is None else out.union(own)
    return out


@query("udf03_segmenters")
def _(s, d):
    out = None
    for model in models.SEGMENTERS.names():
        made = models.segment(detections(s, d), model) if model in models.PROMPTED else models.segment_tiles(tile_paths(s, d), model)
        own = made.agg(F.count("*").alias("n"), F.min("segmenter_score").alias("low")).select(F.lit(model).alias("model"), "n", "low")
        out = own if out is None else out.union(own)
    return out


@query("udf04_classifiers")
def _(s, d):
    rows = table(s, d, "supplier").select("s_suppkey", "s_name")
    return models.classify(rows, "s_name", "swin").select("s_suppkey", "classifier_class", "classifier_score")


@query("udf05_mask_polygons", duck("pixels") + "SELECT tile, count(*) > 0 AS traced FROM pixels WHERE value > 0.5 GROUP BY tile")
def _(s, d):
    def trace(group):
        import numpy as np
        import pandas as pd

        from tessera.functions.polygons import traced

        mask = np.zeros((8, 8), bool)
        mask[group.row, group.col] = group.value > 0.5
        return pd.DataFrame({"tile": [int(group.tile.iloc[0])], "traced": [len(traced(mask)) >= 5]})

    return view(s, d, "pixels").groupBy("tile").applyInPandas(trace, "tile long, traced boolean").where("traced")


@query("udf06_ensemble_callback", duck("pixels") + f'SELECT CAST(floor(tile / 3) AS BIGINT) AS obj, arg_max(CAST(tile % 3 AS BIGINT), (score, -(tile % 3))) AS run FROM (SELECT tile, avg(value) AS score FROM pixels GROUP BY tile) q GROUP BY CAST(floor(tile / 3) AS BIGINT)')
def _(s, d):
    p = view(s, d, "pixels").select(F.floor(F.col("tile") / 3).alias("obj"), (F.col("tile") % 3).alias("run"), F.col("value").alias("score"))
    return imagery.best_run(p, "obj").select("obj", "run")


@query("udaf01_consensus", COMP + "SELECT count(*) AS n, max(k) AS largest FROM (SELECT component, count(*) AS k FROM mem GROUP BY component) q")
def _(s, d):
    from .aggregations import members

    found = fusion.consensus(members(s, d).withColumn("flat_index", F.col("object_id")))
    return found.agg(F.count("*").alias("n"), F.max("members").alias("largest"))


@query("udtf01_expansion", "SELECT p_partkey, k FROM part, generate_series(0, 6) t(k) WHERE k < p_size % 4")
def _(s, d):
    p = table(s, d, "part").where("p_size % 4 > 0")
    return p.select("p_partkey", F.explode(F.sequence(F.lit(0), (F.col("p_size") % 4 - 1).cast("int"))).alias("k"))
