"""Projections, filters, predicates, validation."""

from pyspark.sql import functions as F

from ..functions import geometry as g
from ..operators import fusion, imagery, spatial
from ..plans import components as plan
from ..sources import annotations as ann
from ..views import duck, table, view
from .registry import query, r

AREA = "((xmax - xmin) * (ymax - ymin))"
NOTES = "SELECT event_id, user_id, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"
CAST_PENALTY = "CASE WHEN {a} < 4 THEN greatest(0.1, {a} / 4) WHEN {a} > 64 THEN greatest(0.1, 64 / {a}) ELSE 1.0 END"


@query("flt01_score_threshold", duck("det") + "SELECT object_id, detector_score FROM det WHERE detector_score >= 0.8")
def _(s, d):
    return view(s, d, "det").where(F.col("detector_score") >= 0.8).select("object_id", "detector_score")


@query("flt02_area_range", duck("det") + f"SELECT object_id, {r(AREA)} AS area FROM det WHERE {AREA} >= 4 AND {AREA} <= 64")
def _(s, d):
    a = g.area(g.box())
    return view(s, d, "det").where((a >= 4) & (a <= 64)).select("object_id", a.alias("area"))


@query("flt03_area_penalty", duck("det") + f"SELECT object_id, {r(CAST_PENALTY.format(a=AREA))} AS penalty, {r('detector_score * ' + CAST_PENALTY.format(a=AREA))} AS score FROM det")
def _(s, d):
    p = fusion.area_penalty(g.area(g.box()), 4, 64)
    return view(s, d, "det").select("object_id", p.alias("penalty"), (F.col("detector_score") * p).alias("score"))


@query("flt04_drop_columns", duck("det") + "SELECT object_id, tile FROM det")
def _(s, d):
    df = view(s, d, "det").select("object_id", "tile").withColumns({"aggregator_score": F.lit(1.0), "tile_id": F.col("tile")})
    return df.drop("aggregator_score", "tile_id")


@query("flt05_valid_boxes", duck("truth") + "SELECT truth FROM truth WHERE xmax > xmin AND ymax > ymin")
def _(s, d):
    return view(s, d, "truth").where(g.valid(g.box())).select("truth")


@query("flt06_envelope", duck("det") + f"SELECT object_id, {r('xmin')} AS x0, {r('ymin')} AS y0, {r('xmax')} AS x1, {r('ymax')} AS y1 FROM det")
def _(s, d):
    b = g.ring_envelope(g.ring_of(g.box()))
    return view(s, d, "det").select("object_id", *[c.alias(n) for c, n in zip(b, ("x0", "y0", "x1", "y1"))])


INSIDE = "greatest(least(t.xmax, a.xmax) - greatest(t.xmin, a.xmin), 0) * greatest(least(t.ymax, a.ymax) - greatest(t.ymin, a.ymin), 0)"


@query("flt07_aoi_overlap", duck("truth", "aoi") + f"SELECT truth FROM truth t JOIN aoi a ON t.xmin < a.xmax AND a.xmin < t.xmax AND t.ymin < a.ymax AND a.ymin < t.ymax GROUP BY truth HAVING sum({INSIDE} / nullif((t.xmax - t.xmin) * (t.ymax - t.ymin), 0)) >= 0.4")
def _(s, d):
    return spatial.min_overlap(view(s, d, "truth"), view(s, d, "aoi"), 0.4, 100.0, "truth").select("truth")


@query("flt08_aoi_clip", duck("truth", "aoi") + f"SELECT truth, area, {r('greatest(t.xmin, a.xmin)')} AS xmin, {r('greatest(t.ymin, a.ymin)')} AS ymin, {r('least(t.xmax, a.xmax)')} AS xmax, {r('least(t.ymax, a.ymax)')} AS ymax FROM truth t JOIN aoi a ON t.xmin < a.xmax AND a.xmin < t.xmax AND t.ymin < a.ymax AND a.ymin < t.ymax")
def _(s, d):
    return spatial.clip_to(view(s, d, "truth"), view(s, d, "aoi"), 100.0).select("truth", F.col("area_area").alias("area"), *g.SIDES)


@query("flt09_geometry_repair")
def _(s, d):
    from ..functions import polygons

    b = g.box()
    bow = F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in ((b[0], b[1]), (b[2], b[3]), (b[2], b[1]), (b[0], b[3]))])
    ring = F.when(F.col("object_id") % 2 == 0, bow).otherwise(g.ring_of(b))
    fixed = view(s, d, "det").select("object_id", polygons.repair(ring).alias("ring")).where(F.col("ring").isNotNull())
    return fixed.select("object_id", F.size("ring").alias("points"), g.ring_area(F.col("ring")).alias("area"))


@query("flt10_min_observations", duck("det") + "SELECT tile, count(DISTINCT run_index) AS runs FROM det GROUP BY tile HAVING count(DISTINCT run_index) >= 5")
def _(s, d):
    return view(s, d, "det").groupBy("tile").agg(F.count_distinct("run_index").alias("runs")).where("runs >= 5")


@query("flt11_min_area_annotations", "SELECT event_id, coalesce(try_cast(CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE CAST(CAST(value AS DECIMAL(18, 2)) AS VARCHAR) END AS DOUBLE), 0) AS area FROM events WHERE coalesce(try_cast(CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE CAST(CAST(value AS DECIMAL(18, 2)) AS VARCHAR) END AS DOUBLE), 0) >= 10")
def _(s, d):
    raw = F.when(F.col("event_id") % 7 == 0, "n/a").otherwise(F.col("value").cast("decimal(18,2)").cast("string"))
    area = ann.usable_area(raw)
    return table(s, d, "events").select("event_id", area.alias("area")).where("area >= 10")


SEG_DUCK = "WITH n AS (SELECT doc_id, string_split(substr(text, 1, 200), ' ') AS words FROM documents) "


@query("flt12_valid_segmentation", "SELECT doc_id, n_chars % 9 >= 6 AS valid FROM documents")
def _(s, d):
    polygons = F.array(F.sequence(F.lit(1.0).cast("int"), F.greatest((F.col("n_chars") % 9).cast("int"), F.lit(1))))
    return table(s, d, "documents").select("doc_id", ann.has_segmentation(polygons).alias("valid"))


@query("flt13_segmentation_documents", "SELECT doc_id, source FROM documents d WHERE n_chars % 40 >= 30 AND source IN (SELECT source FROM documents WHERE n_chars % 40 >= 30)")
def _(s, d):
    size = F.when(F.col("n_chars") % 40 >= 30, 6).otherwise(2)
    notes = table(s, d, "documents").select("doc_id", "source", F.array(F.array_repeat(F.lit(1.0), size)).alias("segmentation"))
    return ann.segmentation_documents(notes, "source").select("doc_id", "source")


@query("flt14_remove_category", "WITH n AS (SELECT event_id, user_id, event_id % 4 AS category_id FROM events WHERE user_id % 3 > 0 OR event_id % 4 = 2), l AS (SELECT event_id, user_id, category_id - CASE WHEN category_id > 2 THEN 1 ELSE 0 END AS category_id FROM n WHERE category_id <> 2) SELECT event_id, user_id, category_id FROM l WHERE user_id IN (SELECT user_id FROM l)")
def _(s, d):
    notes = table(s, d, "events").where("user_id % 3 > 0 or event_id % 4 = 2").select("event_id", F.col("user_id").alias("image_id"), (F.col("event_id") % 4).alias("category_id"))
    images, left = ann.without_category(notes.select("image_id").distinct(), notes, 2)
    return left.join(images, "image_id", "left_semi").withColumnRenamed("image_id", "user_id").select("event_id", "user_id", "category_id")


BYTES = "floor({b} * 255)"


@query("flt15_blank_tiles", duck("bands") + 'SELECT tile, ' + r("avg(CASE WHEN red < 0.5 AND green < 0.5 THEN 1.0 ELSE 0.0 END)") + " AS black FROM bands GROUP BY tile HAVING avg(CASE WHEN red < 0.5 AND green < 0.5 THEN 1.0 ELSE 0.0 END) > 0.3")
def _(s, d):
    dark = view(s, d, "bands").withColumns({b: F.when(F.col(b) < 0.5, 0.0).otherwise(F.col(b)) for b in ("red", "green")})
    return imagery.blank_tiles(dark, ["red", "green"], 0.3).select("tile", "black")


CROPS = "(SELECT tile AS crop, tile % 32 * 100.0 + 10 AS xmin, floor(tile / 32) * 100.0 + 10 AS ymin, tile % 32 * 100.0 + 90 AS xmax, floor(tile / 32) * 100.0 + 90 AS ymax FROM (SELECT DISTINCT tile FROM truth) q)"


@query("flt16_crop_inclusion", duck("truth") + f"SELECT crop, truth, {r(INSIDE + ' / ((t.xmax - t.xmin) * (t.ymax - t.ymin))')} AS share FROM truth t JOIN {CROPS} a ON t.xmin < a.xmax AND a.xmin < t.xmax AND t.ymin < a.ymax AND a.ymin < t.ymax WHERE {INSIDE} / ((t.xmax - t.xmin) * (t.ymax - t.ymin)) >= 0.4")
def _(s, d):
    t = view(s, d, "truth")
    x, y = F.col("tile") % 32 * 100.0, F.floor(F.col("tile") / 32) * 100.0
    crops = t.select("tile").distinct().select(F.col("tile").alias("crop"), (x + 10).alias("xmin"), (y + 10).alias("ymin"), (x + 90).alias("xmax"), (y + 90).alias("ymax"))
    return spatial.cover_ratio(crops, t, 100.0, 0.4).select(F.col("a_crop").alias("crop"), F.col("b_truth").alias("truth"), "share")


@query("flt17_clip_and_drop", duck("truth") + f"SELECT truth, {r('greatest(xmin, 50)')} AS x0, {r('greatest(ymin, 50)')} AS y0, {r('least(xmax, 1000)')} AS x1, {r('least(ymax, 200)')} AS y1 FROM truth WHERE least(xmax, 1000) > greatest(xmin, 50) AND least(ymax, 200) > greatest(ymin, 50)")
def _(s, d):
    b = g.clip(g.box(), tuple(map(F.lit, (50.0, 50.0, 1000.0, 200.0))))
    return view(s, d, "truth").where(g.valid(b)).select("truth", *[c.alias(n) for c, n in zip(b, ("x0", "y0", "x1", "y1"))])


@query("flt18_polygon_area_band", duck("truth") + f"SELECT truth, {r(AREA)} AS area FROM truth WHERE {AREA} > 1 AND {AREA} < 30")
def _(s, d):
    a = g.ring_area(g.ring_of(g.box()))
    return view(s, d, "truth").select("truth", a.alias("area")).where("area > 1 and area < 30")


@query("flt19_dummy_masks", duck("truth") + f"SELECT truth, {r('CASE WHEN xmax - xmin < 1 THEN 0 ELSE xmin END')} AS xmin, {r('CASE WHEN xmax - xmin < 1 THEN 1 ELSE xmax END')} AS xmax, {r('CASE WHEN xmax - xmin < 1 THEN 0 ELSE 0.9 END')} AS score FROM truth")
def _(s, d):
    bad = F.col("xmax") - F.col("xmin") < 1
    return view(s, d, "truth").select("truth", F.when(bad, 0.0).otherwise(F.col("xmin")).alias("xmin"), F.when(bad, 1.0).otherwise(F.col("xmax")).alias("xmax"), F.when(bad, 0.0).otherwise(0.9).alias("score"))


@query("flt20_band_validation", duck("bands") + "SELECT count(*) AS pixels, min(floor(red * 255)) >= 0 AND max(floor(red * 255)) <= 255 AND min(floor(green * 255)) >= 0 AND max(floor(green * 255)) <= 255 AND min(floor(blue * 255)) >= 0 AND max(floor(blue * 255)) <= 255 AS valid FROM bands")
def _(s, d):
    b = view(s, d, "bands").withColumns({c: F.floor(F.col(c) * 255).cast("double") for c in ("red", "green", "blue")})
    return imagery.band_checks(b).select("pixels", "valid")


@query("flt21_srid_match", "SELECT 32618 = 32618 AS same, 4326 = 32618 AS other")
def _(s, d):
    one = s.range(1)
    return one.select((F.lit(32618) == F.lit(32618)).alias("same"), (F.lit(4326) == F.lit(32618)).alias("other"))


@query("flt22_contract_check", "SELECT * FROM (VALUES ('column detector_score'), ('state tiles')) t(missing)")
def _(s, d):
    c = plan.Contract(frozenset(["tiles"]), frozenset(["object_id", "detector_score"]))
    return s.createDataFrame([(m,) for m in c.missing(["objects"], ["object_id"])], "missing string")


@query("flt23_pipeline_simulation", "SELECT * FROM (VALUES ('classifier: column segmenter_score')) t(problem)")
def _(s, d):
    f = frozenset
    parts = [plan.Component("detector", plan.Contract(f(["tiles"]), f(), f(["objects"]), f(["object_id", "detector_score"])), None), plan.Component("classifier", plan.Contract(f(["objects"]), f(["segmenter_score"])), None)]
    return s.createDataFrame([(p,) for p in plan.simulate(parts, ["tiles"], [])], "problem string")


SIZE = "CASE WHEN {a} < 9 / (0.5 * 0.5) THEN 'tiny' WHEN {a} < 25 / (0.5 * 0.5) THEN 'small' WHEN {a} < 49 / (0.5 * 0.5) THEN 'medium' WHEN {a} < 100 / (0.5 * 0.5) THEN 'large' ELSE 'giant' END"


@query("flt24_size_subsets", duck("det", "truth") + f"SELECT size, sum(p) AS preds, sum(t) AS truths FROM (SELECT {SIZE.format(a=AREA)} AS size, 1 AS p, 0 AS t FROM det UNION ALL SELECT {SIZE.format(a=AREA)}, 0, 1 FROM truth) q GROUP BY size")
def _(s, d):
    size = g.size_label(g.area(g.box()), 0.5).alias("size")
    both = view(s, d, "det").select(size, F.lit(1).alias("p"), F.lit(0).alias("t")).union(view(s, d, "truth").select(size, F.lit(0), F.lit(1)))
    return both.groupBy("size").agg(F.sum("p").alias("preds"), F.sum("t").alias("truths"))


@query("flt25_valid_pixels", duck("px") + f"SELECT tile, count(*) AS n, {r('avg(v)')} AS mean FROM px WHERE v > -0.2 GROUP BY tile HAVING count(*) >= 3")
def _(s, d):
    v = F.when(F.col("v") > -0.2, F.col("v")).otherwise(F.lit(float("nan")))
    return view(s, d, "px").withColumn("v", v).where(~F.isnan("v")).groupBy("tile").agg(F.count("*").alias("n"), F.avg("v").alias("mean")).where("n >= 3")


@query("flt26_prompt_scores", duck("det") + "SELECT object_id FROM det WHERE coalesce(CASE WHEN object_id % 5 = 0 THEN NULL ELSE detector_score END, 1.0) >= 0.9")
def _(s, d):
    score = F.when(F.col("object_id") % 5 == 0, F.lit(None)).otherwise(F.col("detector_score"))
    return view(s, d, "det").where(F.coalesce(score, F.lit(1.0)) >= 0.9).select("object_id")


@query("flt27_whole_records", "SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_id % 50 = 0)")
def _(s, d):
    notes = table(s, d, "events").select("event_id", F.col("user_id").alias("image_id"), F.array(F.array_repeat(F.lit(1.0), F.when(F.col("event_id") % 50 == 0, 2).otherwise(6))).alias("segmentation"))
    return ann.whole_records(notes).select("event_id", F.col("image_id").alias("user_id"))


@query("flt28_corrupt_images", "SELECT doc_id, doc_id % 3 = 0 AS corrupt FROM documents")
def _(s, d):
    from ..sources import files

    content = F.when(F.col("doc_id") % 3 == 0, F.lit(b"short")).otherwise(F.lit(files.raster_bytes([[[1, 2], [3, 4]]] * 3, (1, 0, 0, 0, -1, 0))))
    return table(s, d, "documents").select("doc_id", files.corrupt(content).alias("corrupt"))


@query("flt29_random_drop")
def _(s, d):
    return view(s, d, "truth").where(F.rand(7) >= 0.1).agg(F.count("*").alias("n"))
