"""Joins, and the set operations beside them."""

from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import names
from ..operators import evaluate, fusion, graph, merging, spatial
from ..sources import annotations as ann
from ..sources import files
from ..views import duck, table, view
from .registry import COMMON, IOU, IOU_ADDED, MEET, cells, in_first_cell, matched, query, r, suppressed

PAIRS = f"{cells('det', 'k')}, pairs AS MATERIALIZED (SELECT a.object_id AS ia, b.object_id AS ib, a.run_index AS ra, b.run_index AS rb, {IOU} AS iou, {COMMON} / least((a.xmax - a.xmin) * (a.ymax - a.ymin), (b.xmax - b.xmin) * (b.ymax - b.ymin)) AS ioa FROM k a JOIN k b ON {in_first_cell()} AND a.object_id < b.object_id)"
TRUE_PAIRS = f"{cells('det', 'k')}, {cells('truth', 'u')}, hits AS MATERIALIZED (SELECT a.object_id AS pred, b.truth, a.detector_score AS score, {IOU} AS iou FROM k a JOIN u b ON {in_first_cell()})"

#: An overlap that no two squares on their corners in det and truth have exactly, so that rounding decides nothing.
RING_LEAST = 0.4321


def on_corners(*names: str) -> str:
    """The views for DuckDB with squares on their corners in place of boxes. By x + y and x - y such a square is a box, of twice its area."""
    text = duck(*names)
    for n in names:
        text = text.replace(f"{n} AS (", f"{n}_boxes AS (", 1)
    middle, half = "(xmin + xmax) / 2 {} (ymin + ymax) / 2", "(xmax - xmin) / 2"
    u, v = middle.format("+"), middle.format("-")
    return text + ", ".join(["", *[f"{n} AS (SELECT * REPLACE ({u} - {half} AS xmin, {v} - {half} AS ymin, {u} + {half} AS xmax, {v} + {half} AS ymax) FROM {n}_boxes)" for n in names]])


def with_ring(boxes):
    """Boxes with the square that stands on its corner within them."""
    (x, y), half = g.centroid(g.box()), (F.col("xmax") - F.col("xmin")) / 2
    corners = ((x, y - half), (x + half, y), (x, y + half), (x - half, y), (x, y - half))
    return boxes.withColumn("ring", F.array(*[F.struct(a.alias("x"), b.alias("y")) for a, b in corners])).withColumn("ymax", F.col("ymin") + 2 * half)


def pairs(s, d):
    return spatial.overlap_pairs(view(s, d, "det").select("object_id", "run_index", *g.SIDES), "object_id", 10.0).withColumns({"iou": g.iou(g.box("a_"), g.box("b_")), "ioa": g.ioa(g.box("a_"), g.box("b_"))})


def true_pairs(s, d):
    p = view(s, d, "det").select(F.col("object_id").alias("pred"), F.col("detector_score").alias("score"), *g.SIDES)
    return spatial.spatial_join(p, view(s, d, "truth"), 10.0).select(F.col("a_pred").alias("pred"), F.col("b_truth").alias("truth"), F.col("a_score").alias("score"), g.iou(g.box("a_"), g.box("b_")).alias("iou"))


RESULT = "SELECT object_id, xmin + 1 AS xmin, ymin, xmax, ymax, round(detector_score / 2, 6) AS segmenter_score FROM det WHERE object_id % 3 > 0"


@query("jon01_merge_new_geometry", duck("det") + f", res AS ({RESULT}) SELECT res.object_id, {r('res.xmin')} AS xmin, {r('segmenter_score')} AS segmenter_score, det.class, det.tile FROM (SELECT * FROM res) res LEFT JOIN (SELECT object_id, class, tile FROM det) det USING (object_id)")
def _(s, d):
    old = view(s, d, "det").select("object_id", "class", "tile", *g.SIDES, "detector_score")
    new = old.where("object_id % 3 > 0").select("object_id", (F.col("xmin") + 1).alias("xmin"), "ymin", "xmax", "ymax", F.round(F.col("detector_score") / 2, 6).alias("segmenter_score"))
    return merging.carry_over(new, old, "object_id").select("object_id", "xmin", "segmenter_score", "class", "tile")


@query("jon02_merge_attributes", duck("det") + f"SELECT object_id, class, CASE WHEN object_id % 2 = 0 THEN 'x' END AS class_new, {r('CASE WHEN object_id % 2 = 0 THEN detector_score END')} AS classifier_score FROM det")
def _(s, d):
    old = view(s, d, "det").select("object_id", "class", *g.SIDES)
    new = view(s, d, "det").where("object_id % 2 = 0").select("object_id", F.lit("x").alias("class"), F.col("detector_score").alias("classifier_score"))
    return merging.attach(new, old, "object_id").select("object_id", "class", "class_new", "classifier_score")


@query("jon03_merge_key", "SELECT 'object_id' AS whole, 'tile_path' AS unique_tiles, 'none' AS neither")
def _(s, d):
    old = view(s, d, "det").select("object_id", "tile_path")
    holes = old.withColumn("object_id", F.when(F.col("object_id") % 2 == 0, F.col("object_id")))
    keys = merging.merge_key(old, old), merging.merge_key(holes.dropDuplicates(["tile_path"]), holes), merging.merge_key(holes, holes)
    return s.createDataFrame([tuple(k or "none" for k in keys)], "whole string, unique_tiles string, neither string")


@query("jon04_merge_dispatch", duck("det") + "SELECT 'replace' AS rule, count(*) AS n FROM det WHERE object_id % 3 > 0 UNION ALL SELECT 'carry', count(*) FROM det WHERE object_id % 3 > 0 UNION ALL SELECT 'attach', count(*) FROM det")
def _(s, d):
    old = view(s, d, "det").select("object_id", "class", *g.SIDES)
    new = old.where("object_id % 3 > 0").drop("class")
    made = {"replace": merging.merge_result(new, old, True), "carry": merging.merge_result(new, old, key="object_id"), "attach": merging.merge_result(new.select("object_id"), old, key="object_id")}
    out = None
    for rule, df in made.items():
        own = df.agg(F.count("*").alias("n")).select(F.lit(rule).alias("rule"), "n")
        out = own if out is None else out.union(own)
    return out


@query("jon05_overlap_self_join", duck("det") + f", {PAIRS} SELECT ia, ib, {r('iou')} AS iou FROM pairs WHERE ra <> rb AND iou >= 0.3")
def _(s, d):
    return pairs(s, d).where("a_run_index <> b_run_index and iou >= 0.3").select(F.col("a_object_id").alias("ia"), F.col("b_object_id").alias("ib"), "iou")


@query("jon06_overlap_join", duck("det", "truth") + f", {TRUE_PAIRS} SELECT pred, truth, {r('iou')} AS iou FROM hits WHERE iou >= 0.1")
def _(s, d):
    return true_pairs(s, d).where("iou >= 0.1").select("pred", "truth", "iou")


@query("jon07_date_gap_join", duck("det") + f", {PAIRS} SELECT ia, ib, {r('ioa')} AS ioa FROM pairs WHERE abs(ra - rb) BETWEEN 1 AND 1 AND ioa >= 0.2")
def _(s, d):
    return pairs(s, d).where("abs(a_run_index - b_run_index) between 1 and 1 and ioa >= 0.2").select(F.col("a_object_id").alias("ia"), F.col("b_object_id").alias("ib"), "ioa")


POINTS = "c AS MATERIALIZED (SELECT truth, (xmin + xmax) / 2 AS x, (ymin + ymax) / 2 AS y, CAST(floor((xmin + xmax) / 2 / 2) AS BIGINT) AS cx, CAST(floor((ymin + ymax) / 2 / 2) AS BIGINT) AS cy FROM truth), n AS (SELECT c.*, cx + dx AS nx, cy + dy AS ny FROM c, (VALUES (-1), (0), (1)) p(dx), (VALUES (-1), (0), (1)) q(dy))"
DIST = "sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))"


@query("jon08_distance_join", duck("truth") + f", {POINTS} SELECT a.truth AS ta, b.truth AS tb, {r(DIST)} AS distance FROM c a JOIN n b ON a.cx = b.nx AND a.cy = b.ny AND a.truth < b.truth WHERE {DIST} <= 2")
def _(s, d):
    x, y = g.centroid(g.box())
    p = view(s, d, "truth").select("truth", x.alias("x"), y.alias("y"))
    return spatial.distance_join(p, p, 2.0).where("a_truth < b_truth").select(F.col("a_truth").alias("ta"), F.col("b_truth").alias("tb"), "distance")


@query("jon09_greedy_assignment", duck("det") + f", {PAIRS}, x AS (SELECT CASE WHEN ra < rb THEN ia ELSE ib END AS a, CASE WHEN ra < rb THEN ib ELSE ia END AS b, ioa FROM pairs WHERE (ra, rb) IN ((0, 1), (1, 0)) AND ioa >= 0.2), {matched('x', 'ioa DESC, a DESC, b DESC')} SELECT a, b, {r('ioa')} AS ioa FROM m")
def _(s, d):
    swap = F.col("a_run_index") > F.col("b_run_index")
    e = pairs(s, d).where("least(a_run_index, b_run_index) = 0 and greatest(a_run_index, b_run_index) = 1 and ioa >= 0.2")
    e = e.select(F.when(swap, F.col("b_object_id")).otherwise(F.col("a_object_id")).alias("a"), F.when(swap, F.col("a_object_id")).otherwise(F.col("b_object_id")).alias("b"), "ioa")
    return graph.greedy_match(e, [F.desc("ioa"), F.desc("a"), F.desc("b")])


@query("jon10_match_predictions", duck("det", "truth") + f", {TRUE_PAIRS}, x AS (SELECT t.threshold, pred AS a, truth AS b, score, iou FROM hits, (VALUES (0.3), (0.5)) t(threshold) WHERE iou >= t.threshold), {matched('x', 'score DESC, a, iou DESC, b', ('threshold',))} SELECT CAST(threshold AS DOUBLE) AS threshold, a AS pred, b AS truth FROM m")
def _(s, d):
    e = true_pairs(s, d).withColumn("threshold", F.explode(F.array(F.lit(0.3), F.lit(0.5)))).where("iou >= threshold")
    return graph.greedy_match(e, [F.desc("score"), "pred", F.desc("iou"), "truth"], ["threshold"], "pred", "truth").select("threshold", "pred", "truth")


PROMPTS = TRUE_PAIRS.replace(IOU, IOU_ADDED)


@query("jon11_match_in_input_order", duck("det", "truth") + f", {PROMPTS}, x AS (SELECT pred AS a, truth AS b, iou FROM hits WHERE iou > 0.3 AND truth % 9 > 0), {matched('x', 'a, iou DESC, b')} SELECT a AS pred, b AS truth, {r('iou')} AS iou FROM m")
def _(s, d):
    masked = view(s, d, "truth").where("truth % 9 > 0")
    return evaluate.match_prompts(view(s, d, "det").withColumnRenamed("object_id", "pred"), masked, 10.0)


@query("jon12_box_fusion", duck("det") + """, {k}, edges AS (SELECT a.tile, CASE WHEN (-a.detector_score, a.object_id) < (-b.detector_score, b.object_id) THEN a.object_id ELSE b.object_id END AS hi, CASE WHEN (-a.detector_score, a.object_id) < (-b.detector_score, b.object_id) THEN b.object_id ELSE a.object_id END AS lo FROM k a JOIN k b ON {m} AND a.tile = b.tile AND a.object_id < b.object_id AND {i} >= 0.4), {s},
    own AS (SELECT e.tile, e.lo, arg_min(e.hi, (-h.detector_score, h.object_id)) AS anchor FROM edges e JOIN det h ON h.object_id = e.hi WHERE e.hi NOT IN (SELECT lo FROM s) AND e.lo IN (SELECT lo FROM s) GROUP BY e.tile, e.lo)
    SELECT d.tile, coalesce(o.anchor, d.object_id) AS anchor, {x} AS xmin, {y} AS ymax, max(detector_score) AS score, count(*) AS members FROM det d LEFT JOIN own o ON o.lo = d.object_id GROUP BY d.tile, coalesce(o.anchor, d.object_id)""".format(k=cells("det", "k"), m=in_first_cell(), i=IOU, s=suppressed("edges", ("tile",)), x=r("sum(xmin * detector_score) / sum(detector_score)"), y=r("sum(ymax * detector_score) / sum(detector_score)")))
def _(s, d):
    b = view(s, d, "det").select("tile", "object_id", F.col("detector_score").alias("score"), *g.SIDES)
    return fusion.fuse_boxes(b, 0.4, 10.0).select("tile", "anchor", "xmin", "ymax", "score", "members")


@query("jon13_zonal_join", duck("bands", "truth") + f"""SELECT truth, count(*) AS pixels, {r('avg(nir)')} AS nir FROM (SELECT tile, tile % 32 * 100 + col * 12.5 AS x, floor(tile / 32) * 100 + "row" * 12.5 AS y, nir FROM bands) p JOIN truth t ON p.x >= t.xmin AND p.x < t.xmax AND p.y >= t.ymin AND p.y < t.ymax GROUP BY truth""")
def _(s, d):
    p = view(s, d, "bands").select((F.col("tile") % 32 * 100 + F.col("col") * 12.5).alias("x"), (F.floor(F.col("tile") / 32) * 100 + F.col("row") * 12.5).alias("y"), "nir")
    found = spatial.points_in_boxes(p, view(s, d, "truth").select("truth", *g.SIDES), 10.0)
    return found.groupBy(F.col("b_truth").alias("truth")).agg(F.count("*").alias("pixels"), F.avg("a_nir").alias("nir"))


TILES = "(SELECT tile AS t, tile % 32 * 100.0 AS xmin, floor(tile / 32) * 100.0 AS ymin, tile % 32 * 100.0 + 100 AS xmax, floor(tile / 32) * 100.0 + 100 AS ymax FROM (SELECT DISTINCT tile FROM truth) q)"


@query("jon14_tiles_and_labels", duck("truth") + f"SELECT a.t AS tile, b.truth, {r(COMMON + ' / ((b.xmax - b.xmin) * (b.ymax - b.ymin))')} AS share FROM {TILES} a JOIN truth b ON {MEET} WHERE {COMMON} / ((b.xmax - b.xmin) * (b.ymax - b.ymin)) >= 0.5")
def _(s, d):
    t = view(s, d, "truth")
    x, y = F.col("tile") % 32 * 100.0, F.floor(F.col("tile") / 32) * 100.0
    tiles = t.select("tile").distinct().select("tile", x.alias("xmin"), y.alias("ymin"), (x + 100).alias("xmax"), (y + 100).alias("ymax"))
    return spatial.cover_ratio(tiles, t, 100.0, 0.5).select(F.col("a_tile").alias("tile"), F.col("b_truth").alias("truth"), "share")


@query("jon15_co_registration", "SELECT a.p_partkey AS rgb, b.p_partkey AS ms FROM part a LEFT JOIN part b ON a.p_partkey = b.p_partkey AND b.p_partkey % 4 > 0")
def _(s, d):
    p = table(s, d, "part").select("p_partkey")
    rgb = p.select(F.col("p_partkey").alias("rgb"), F.concat(F.lit("/rgb/t_"), "p_partkey", F.lit(".tif")).alias("path"))
    ms = p.where("p_partkey % 4 > 0").select(F.col("p_partkey").alias("ms"), F.concat(F.lit("/ms/x/t_"), "p_partkey", F.lit(".tif")).alias("path"))
    return rgb.withColumn("k", names.basename(F.col("path"))).join(ms.withColumn("k", names.basename(F.col("path"))).select("k", "ms"), "k", "left").select("rgb", "ms")


@query("jon16_original_path", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN concat('/orig/', p_partkey, '.tif') ELSE concat('/enh/', p_partkey, '.tif') END AS path FROM part")
def _(s, d):
    p = table(s, d, "part").select("p_partkey", F.concat(F.lit("/enh/"), "p_partkey", F.lit(".tif")).alias("enhanced"))
    lookup = p.where("p_partkey % 3 = 0").select(names.basename(F.col("enhanced")).alias("k"), F.concat(F.lit("/orig/"), "p_partkey", F.lit(".tif")).alias("path"))
    return p.withColumn("k", names.basename(F.col("enhanced"))).join(lookup, "k", "left").select("p_partkey", F.coalesce("path", "enhanced").alias("path"))


@query("jon17_metric_tables", duck("metrics") + f"SELECT a.location, a.product AS product_name, {r('a.f1')} AS tile_f1, {r('b.p')} AS raster_p FROM (SELECT location, product, avg(f1) AS f1 FROM metrics GROUP BY ALL) a LEFT JOIN (SELECT location, product, avg(precision_50) AS p FROM metrics WHERE location < 4 GROUP BY ALL) b USING (location, product)")
def _(s, d):
    m = view(s, d, "metrics").withColumnRenamed("product", "product_name")
    tiles = m.groupBy("location", "product_name").agg(F.avg("f1").alias("f1"))
    rasters = m.where("location < 4").groupBy("location", "product_name").agg(F.avg("precision_50").alias("p"))
    return evaluate.joined_summaries(tiles, rasters, prefixes=("tile_", "raster_"))


@query("jon18_join_back", duck("det") + "SELECT object_id, 'SITE_' || lpad(CAST(dense_rank() OVER (ORDER BY tile) - 1 AS VARCHAR), 6, '0') AS crown_id FROM det")
def _(s, d):
    det = view(s, d, "det").select("object_id", "tile", "run_index")
    ids = fusion.numbered(det.select("tile").distinct(), "tile", "n").select("tile", names.padded_id("SITE", F.col("n")).alias("crown_id"))
    return det.join(ids, "tile").select("object_id", "crown_id")


@query("jon19_parameter_grid", "SELECT r_regionkey, CAST(n AS DOUBLE) AS nms, CAST(c AS DOUBLE) AS score FROM region, (VALUES (0.3), (0.5), (0.7)) a(n), (VALUES (0.4), (0.6)) b(c)")
def _(s, d):
    grid = F.explode(F.array(*[F.struct(F.lit(n).alias("nms"), F.lit(c).alias("score")) for n in (0.3, 0.5, 0.7) for c in (0.4, 0.6)]))
    return table(s, d, "region").select("r_regionkey", grid.alias("p")).select("r_regionkey", "p.*")


@query("jon20_unmatched", duck("det", "truth") + f", {TRUE_PAIRS}, x AS (SELECT pred AS a, truth AS b, score, iou FROM hits WHERE iou >= 0.5), {matched('x', 'score DESC, a, iou DESC, b')} SELECT 'fn' AS kind, count(*) AS n FROM truth WHERE truth NOT IN (SELECT b FROM m) UNION ALL SELECT 'fp', count(*) FROM det WHERE object_id NOT IN (SELECT a FROM m)")
def _(s, d):
    m = graph.greedy_match(true_pairs(s, d).where("iou >= 0.5"), [F.desc("score"), "pred", F.desc("iou"), "truth"], (), "pred", "truth")
    fn = view(s, d, "truth").join(m, "truth", "left_anti").agg(F.count("*").alias("n")).select(F.lit("fn").alias("kind"), "n")
    return fn.union(view(s, d, "det").join(m, F.col("object_id") == F.col("pred"), "left_anti").agg(F.count("*")).select(F.lit("fp"), "*"))


@query("jon21_overlay_union", duck("det", "truth") + f", {TRUE_PAIRS.replace(IOU, COMMON)} SELECT {r('sum(iou)')} AS both FROM hits")
def _(s, d):
    from ..functions import polygons

    p = view(s, d, "det").select(F.col("object_id").alias("pred"), *g.SIDES)
    both = spatial.spatial_join(p, view(s, d, "truth"), 10.0).select(polygons.boolean_area(g.ring_of(g.box("a_")), g.ring_of(g.box("b_"))).alias("x"))
    return both.agg(F.sum("x.both").alias("both"))


@query("jon22_referential_integrity", "SELECT count(*) AS dangling FROM conversations WHERE conv_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 2 = 0)")
def _(s, d):
    notes = table(s, d, "conversations").select(F.col("conv_id").alias("image_id"))
    return notes.join(table(s, d, "documents").where("doc_id % 2 = 0").select(F.col("doc_id").alias("image_id")), "image_id", "left_anti").agg(F.count("*").alias("dangling"))


@query("set01_tagged_union", duck("det") + "SELECT run_index, count(*) AS n, count(segmenter_score) AS with_score FROM (SELECT object_id, run_index, segmenter_score FROM det WHERE run_index < 3 UNION ALL SELECT object_id, run_index, NULL FROM det WHERE run_index >= 3) q GROUP BY run_index")
def _(s, d):
    det = view(s, d, "det")
    both = det.where("run_index < 3").select("object_id", "run_index", "segmenter_score").unionByName(det.where("run_index >= 3").select("object_id", "run_index"), allowMissingColumns=True)
    return both.groupBy("run_index").agg(F.count("*").alias("n"), F.count("segmenter_score").alias("with_score"))


@query("set02_append_summary", duck("metrics") + f"SELECT CAST(location AS VARCHAR) AS location, product, {r('f1')} AS f1, num_truths FROM metrics UNION ALL SELECT 'average', product, {r('sum(f1 * num_truths) / sum(num_truths)')}, sum(num_truths) FROM metrics GROUP BY product")
def _(s, d):
    m = view(s, d, "metrics").select(F.col("location").cast("string").alias("location"), "product", "f1", "num_truths")
    return evaluate.with_average(m, ["product"], "location", ["f1"], "num_truths")


@query("set03_column_sets", "SELECT * FROM (VALUES ('detector_score')) t(missing)")
def _(s, d):
    from ..plans.components import Contract

    have = set(view(s, d, "truth").columns)
    return s.createDataFrame([(m.split()[1],) for m in Contract(requires_columns=frozenset(["truth", "detector_score"])).missing([], have)], "missing string")


@query("set04_distinct", "SELECT DISTINCT source FROM documents")
def _(s, d):
    return table(s, d, "documents").select("source").distinct()


@query("set05_folds_in_use", "SELECT DISTINCT lang AS fold FROM documents WHERE lang IN ('en', 'de', 'xx')")
def _(s, d):
    folds = s.createDataFrame([("en",), ("de",), ("xx",)], "fold string")
    return table(s, d, "documents").select(F.col("lang").alias("fold")).distinct().join(F.broadcast(folds), "fold", "left_semi")


@query("set06_overlay_areas", duck("det", "truth") + f", {TRUE_PAIRS.replace(IOU, COMMON)} SELECT pred, truth, {r('iou')} AS both FROM hits WHERE iou > 1")
def _(s, d):
    p = view(s, d, "det").select(F.col("object_id").alias("pred"), *g.SIDES)
    common = g.overlap(g.box("a_"), g.box("b_"))
    return spatial.spatial_join(p, view(s, d, "truth"), 10.0).select(F.col("a_pred").alias("pred"), F.col("b_truth").alias("truth"), common.alias("both")).where("both > 1")


@query("set07_skip_existing", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(s, d):
    return files.unprocessed(table(s, d, "documents").select("doc_id"), table(s, d, "labels"), ["doc_id"])
