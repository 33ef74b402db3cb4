"""Scalar functions: geometry, strings, JSON, arrays, maps."""

import math

from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import names
from ..operators import spatial, tiling
from ..sources import annotations as ann
from ..views import duck, table, view
from .joins import PAIRS, pairs
from .registry import query, r

AREA = "((xmax - xmin) * (ymax - ymin))"
B = g.box


def xy(pair, x="x", y="y"):
    return pair[0].alias(x), pair[1].alias(y)


@query("geo01_iou", duck("det") + f", {PAIRS} SELECT ia, ib, {r('iou')} AS iou FROM pairs")
def _(s, d):
    return pairs(s, d).select(F.col("a_object_id").alias("ia"), F.col("b_object_id").alias("ib"), "iou")


@query("geo02_ioa", duck("det") + f", {PAIRS} SELECT ia, ib, {r('ioa')} AS ioa FROM pairs")
def _(s, d):
    return pairs(s, d).select(F.col("a_object_id").alias("ia"), F.col("b_object_id").alias("ib"), "ioa")


@query("geo03_area", duck("det") + f"SELECT object_id, {r(AREA)} AS area, {r(AREA)} AS ring FROM det")
def _(s, d):
    return view(s, d, "det").select("object_id", g.area(B()).alias("area"), g.ring_area(g.ring_of(B())).alias("ring"))


@query("geo04_centroid", duck("det") + f"SELECT object_id, {r('(xmin + xmax) / 2')} AS x, {r('(ymin + ymax) / 2')} AS y FROM det")
def _(s, d):
    return view(s, d, "det").select("object_id", *xy(g.ring_centroid(g.ring_of(B()))))


@query("geo05_distance", duck("truth") + f"SELECT truth, {r('sqrt((xmin - 50) * (xmin - 50) + (ymin - 60) * (ymin - 60))')} AS distance FROM truth")
def _(s, d):
    return view(s, d, "truth").select("truth", g.distance((F.col("xmin"), F.col("ymin")), (F.lit(50.0), F.lit(60.0))).alias("distance"))


@query("geo06_bounds", duck("truth") + f"SELECT truth, {r('xmin')} AS x0, {r('ymax')} AS y1 FROM truth")
def _(s, d):
    b = g.ring_envelope(g.ring_of(B()))
    return view(s, d, "truth").select("truth", b[0].alias("x0"), b[3].alias("y1"))


@query("geo07_box_from_xywh", duck("truth") + f"SELECT truth, {r('xmin + 3')} AS x1, {r('ymin + 4')} AS y1 FROM truth")
def _(s, d):
    b = g.from_xywh(F.col("xmin"), F.col("ymin"), F.lit(3.0), F.lit(4.0))
    return view(s, d, "truth").select("truth", b[2].alias("x1"), b[3].alias("y1"))


@query("geo08_to_pixels", duck("truth") + f"SELECT truth, {r('(xmax - 10) / 0.5')} AS x, {r('(ymax - 20) / 0.5')} AS y FROM truth")
def _(s, d):
    p = g.to_pixels(g.ring_of(B()), F.lit(10.0), F.lit(20.0), F.lit(0.5))[2]
    return view(s, d, "truth").select("truth", p["x"].alias("x"), p["y"].alias("y"))


@query("geo09_scale", duck("truth") + f"SELECT truth, {r('xmax * 2')} AS x, {r('ymax * 3')} AS y FROM truth")
def _(s, d):
    p = g.scale(g.ring_of(B()), 2.0, 3.0)[2]
    return view(s, d, "truth").select("truth", p["x"].alias("x"), p["y"].alias("y"))


@query("geo10_buffer")
def _(s, d):
    from ..functions import polygons

    return view(s, d, "truth").select("truth", g.ring_area(polygons.buffer(g.ring_of(B()), 1.0)).alias("area"), F.size(polygons.simplify(g.ring_of(B()), 0.1)).alias("points"))


MERC = "6378137.0 * ln(tan({q} + radians(lat) / 2))".format(q=repr(math.pi / 4))


@query("geo11_mercator", f"WITH p AS (SELECT p_partkey, p_partkey % 360 - 180.0 AS lon, p_partkey % 170 - 85.0 AS lat FROM part) SELECT p_partkey, {r('6378137.0 * radians(lon) / 1000')} AS x, {r(MERC + ' / 1000')} AS y, {r('lat')} AS back FROM p")
def _(s, d):
    p = table(s, d, "part").select("p_partkey", (F.col("p_partkey") % 360 - 180.0).alias("lon"), (F.col("p_partkey") % 170 - 85.0).alias("lat"))
    x, y = g.to_mercator(F.col("lon"), F.col("lat"))
    return p.select("p_partkey", (x / 1000).alias("x"), (y / 1000).alias("y"), g.from_mercator(x, y)[1].alias("back"))


@query("geo12_utm_zone", "WITH p AS (SELECT p_partkey, p_partkey % 360 - 180.0 AS lon, p_partkey % 160 - 80.0 AS lat FROM part) SELECT p_partkey, CASE WHEN lat >= 0 THEN 32600 ELSE 32700 END + least(greatest(floor((lon + 180) / 6) + 1, 1), 60) AS srid FROM p")
def _(s, d):
    lon, lat = F.col("p_partkey") % 360 - 180.0, F.col("p_partkey") % 160 - 80.0
    return table(s, d, "part").select("p_partkey", g.utm_srid(lon, lat).alias("srid"))


@query("geo13_pixel_to_world", f"SELECT p_partkey, {r('0.5 * p_size + 100')} AS x, {r('-0.5 * (p_partkey % 50) + 900')} AS y, {r('p_size')} AS col FROM part")
def _(s, d):
    t = (0.5, 0.0, 100.0, 0.0, -0.5, 900.0)
    x, y = g.pixel_to_world(F.col("p_size"), F.col("p_partkey") % 50, t)
    return table(s, d, "part").select("p_partkey", *xy((x, y)), g.world_to_pixel(x, y, t)[0].alias("col"))


RLE = "WITH p AS (SELECT p_partkey, p_size % 5 AS a, p_size % 3 + 1 AS b FROM part)"


@query("geo14_run_lengths", f'{RLE}, q AS (SELECT p_partkey, unnest(generate_series(a, a + b - 1)) AS k FROM p) SELECT p_partkey, k % 4 AS "row", CAST(floor(k / 4) AS BIGINT) AS col FROM q')
def _(s, d):
    counts = F.array((F.col("p_size") % 5).cast("int"), (F.col("p_size") % 3 + 1).cast("int"), F.lit(3))
    return table(s, d, "part").select("p_partkey", F.explode(g.run_lengths_to_pixels(counts, 4)).alias("x")).select("p_partkey", "x.row", "x.col")


@query("geo15_mask_bounds", duck("pixels") + 'SELECT tile, min("row") AS r0, max("row") - min("row") AS height, min(col) AS c0, max(col) - min(col) AS width FROM pixels WHERE value > 0.5 GROUP BY tile')
def _(s, d):
    p = view(s, d, "pixels").where("value > 0.5").groupBy("tile")
    return p.agg(F.min("row").alias("r0"), (F.max("row") - F.min("row")).alias("height"), F.min("col").alias("c0"), (F.max("col") - F.min("col")).alias("width"))


@query("geo16_band_split", duck("aoi") + f"SELECT area, {r('ymax - (ymax - ymin) * 0.3')} AS cut FROM aoi")
def _(s, d):
    north, _ = g.band_split(B(), 0.3)
    return view(s, d, "aoi").select("area", north[1].alias("cut"))


@query("geo17_tile_grid", "WITH p AS (SELECT p_partkey, 300 + p_size * 7 AS w FROM part), q AS (SELECT p_partkey, w, unnest(generate_series(0, CAST(ceil((w - 256) / 192.0) AS BIGINT))) AS k FROM p) SELECT p_partkey, k AS tile_col, least(k * 192, w - 256) AS x FROM q")
def _(s, d):
    p = table(s, d, "part").select("p_partkey", (300 + F.col("p_size") * 7).alias("width"), F.lit(256).alias("height"))
    return tiling.grid(p, 256, 0.25).select("p_partkey", "tile_col", "x")


@query("geo18_window_starts", "SELECT CAST(x AS BIGINT) AS start FROM (VALUES (0), (64), (128), (192), (244)) t(x)")
def _(s, d):
    from ..operators.imagery import window_starts

    return s.createDataFrame([(x,) for x in window_starts(500, 256, 64)], "start long")


@query("geo19_size_classes", duck("truth") + f"SELECT truth, CASE WHEN {AREA} < 9 THEN 'tiny' WHEN {AREA} < 25 THEN 'small' WHEN {AREA} < 49 THEN 'medium' WHEN {AREA} < 100 THEN 'large' ELSE 'giant' END AS size FROM truth")
def _(s, d):
    return view(s, d, "truth").select("truth", g.size_label(g.area(B()), 1.0).alias("size"))


@query("geo20_jitter")
def _(s, d):
    b = g.jitter(B(), 0.1, 7)
    moved = view(s, d, "truth").select("truth", (F.abs(b[0] - F.col("xmin")) <= 0.1 * (F.col("xmax") - F.col("xmin")) + 1e-9).alias("within"))
    return moved.groupBy("within").agg(F.count("*").alias("n"))


@query("geo21_areas_of_interest", duck("aoi") + f"SELECT area, 'train' AS name, {r('ymax - (ymax - ymin) * 0.7')} AS ymin, {r('ymax')} AS ymax FROM aoi UNION ALL SELECT area, 'test', {r('ymin')}, {r('ymax - (ymax - ymin) * 0.7')} FROM aoi")
def _(s, d):
    out = None
    for row in range(5):
        own = tiling.areas_of_interest(view(s, d, "aoi").where(F.col("area") == row), {"bands": {"train": 0.7, "test": 0.3}}).select(F.lit(row).cast("long").alias("area"), "name", "ymin", "ymax")
        out = own if out is None else out.union(own)
    return out


@query("geo22_object_tiles", duck("truth") + f"SELECT truth, {r('(xmin + xmax) / 2 - 8')} AS fixed, {r('xmin - 1.5')} AS buffered, {r('xmin - (xmax - xmin) * 0.2')} AS padded FROM truth")
def _(s, d):
    t = view(s, d, "truth")
    a = tiling.object_tiles(t, size=32, gsd=0.5).select("truth", F.col("tile_xmin").alias("fixed"))
    b = tiling.object_tiles(t, buffer=3, gsd=0.5).select("truth", F.col("tile_xmin").alias("buffered"))
    return a.join(b, "truth").join(tiling.object_tiles(t, padding=0.2).select("truth", F.col("tile_xmin").alias("padded")), "truth")


@query("geo23_regular_tiler", "WITH p AS (SELECT p_partkey, 500 + p_size * 3 AS w, 400 + p_size AS h FROM part), q AS (SELECT *, unnest(generate_series(0, CAST(ceil((w - 200) / 150.0) AS BIGINT))) AS a FROM p), s AS (SELECT *, unnest(generate_series(0, CAST(ceil((h - 200) / 150.0) AS BIGINT))) AS b FROM q) SELECT p_partkey, count(*) AS tiles, sum(least(a * 150, w - 200)) AS xs FROM s GROUP BY p_partkey")
def _(s, d):
    p = table(s, d, "part").select("p_partkey", (500 + F.col("p_size") * 3).alias("width"), (400 + F.col("p_size")).alias("height"))
    return tiling.grid(p, 200, 0.25).groupBy("p_partkey").agg(F.count("*").alias("tiles"), F.sum("x").alias("xs"))


@query("str01_folder_keys", "SELECT p_partkey, concat(p_partkey, '_', p_brand) AS key, p_partkey AS back FROM part")
def _(s, d):
    p = table(s, d, "part").withColumn("key", names.folder_key(F.col("p_partkey"), F.col("p_brand")))
    return p.select("p_partkey", "key", names.folder_number(F.col("key")).alias("back"))


@query("str02_padded_ids", "SELECT p_partkey, concat('SITE_', lpad(CAST(p_partkey AS VARCHAR), 6, '0')) AS id FROM part")
def _(s, d):
    return table(s, d, "part").select("p_partkey", names.padded_id("SITE", F.col("p_partkey")).alias("id"))


@query("str03_fixed_lists", "SELECT p_partkey, printf('%.2f,%.2f', p_size / 100.0, 0.75) AS list FROM part")
def _(s, d):
    return table(s, d, "part").select("p_partkey", names.fixed_list(F.array(F.col("p_size") / 100.0, F.lit(0.75))).alias("list"))


@query("str04_date_folders", "SELECT event_id, regexp_full_match(strftime(ts, '%Y%m%d'), '[0-9]{8}') AS yes, regexp_full_match(event_type, '[0-9]{8}') AS no FROM events")
def _(s, d):
    return table(s, d, "events").select("event_id", names.is_date_folder(F.date_format("ts", "yyyyMMdd")).alias("yes"), names.is_date_folder(F.col("event_type")).alias("no"))


@query("str05_prefix_and_split", "SELECT p_partkey, coalesce(starts_with(p_type, 'S'), false) AS starts, ends_with(p_type, 'L') AS ends, trim(split_part(concat(p_brand, ' | ', p_type), '|', 2)) AS second FROM part")
def _(s, d):
    parts = F.transform(F.split(F.concat("p_brand", F.lit(" | "), "p_type"), r"\|"), lambda x: F.trim(x))
    return table(s, d, "part").select("p_partkey", F.coalesce(F.startswith("p_type", F.lit("S")), F.lit(False)).alias("starts"), F.endswith("p_type", F.lit("L")).alias("ends"), parts[1].alias("second"))


@query("str06_file_names", "SELECT page_id, parse_filename(p) AS name, regexp_replace(parse_filename(p), '(.)\\.[^.]*$', '\\1') AS stem FROM (SELECT page_id, concat('/a/b.c/', page_id, '.tar.gz') AS p FROM pages) q")
def _(s, d):
    p = F.concat(F.lit("/a/b.c/"), "page_id", F.lit(".tar.gz"))
    return table(s, d, "pages").select("page_id", names.basename(p).alias("name"), names.stem(p).alias("stem"))


@query("str07_point_tokens", "SELECT l_discount, replace(CAST(l_discount AS VARCHAR), '.', 'p') AS token FROM (SELECT DISTINCT l_discount FROM lineitem) q")
def _(s, d):
    return table(s, d, "lineitem").select("l_discount").distinct().select("l_discount", names.point_token(F.col("l_discount")).alias("token"))


@query("str08_threshold_strings", "SELECT * FROM (VALUES ('0.5:0.95:0.05', 10, '50:95'), ('0.75', 1, '75'), ('0.3, 0.5', 2, '30:50')) t(text, n, label)")
def _(s, d):
    t = s.createDataFrame([("0.5:0.95:0.05",), ("0.75",), ("0.3, 0.5",)], "text string")
    return t.withColumn("x", names.parse_thresholds(F.col("text"))).select("text", F.size("x").alias("n"), names.iou_label(F.col("x")).alias("label"))


@query("str09_label_map", "SELECT p_brand, CASE WHEN p_brand LIKE '%1' THEN 'first' ELSE regexp_replace(p_brand, 'Brand#', 'b', 'g') END AS label FROM (SELECT DISTINCT p_brand FROM part) q")
def _(s, d):
    b = table(s, d, "part").select("p_brand").distinct()
    return b.select("p_brand", F.when(F.endswith("p_brand", F.lit("1")), "first").otherwise(F.regexp_replace("p_brand", "Brand#", "b")).alias("label"))


@query("str10_date_tokens", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y%m%d') ELSE '20240101' END AS date FROM events")
def _(s, d):
    folder = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyyMMdd")).otherwise("ortho")
    return table(s, d, "events").select("event_id", names.date_token(folder, F.lit("/x/20240101_site.tif")).alias("date"))


@query("jsn01_nested_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, concat('{\"k\":', CAST(json_extract(props, '$.k') AS BIGINT), '}') AS again FROM events")
def _(s, d):
    x = F.from_json("props", "k long")
    return table(s, d, "events").select("event_id", x["k"].alias("k"), F.to_json(x).alias("again"))


@query("jsn02_fold_map", "SELECT doc_id, CASE WHEN doc_id % 5 = 4 THEN 'valid' ELSE 'train' END AS fold FROM documents")
def _(s, d):
    lines = table(s, d, "documents").select(F.to_json(F.struct(F.col("doc_id").alias("image"), (F.col("doc_id") % 5).alias("fold"))).alias("line"))
    x = F.from_json("line", "image long, fold int")
    return lines.select(x["image"].alias("doc_id"), F.when(x["fold"] == 4, "valid").otherwise("train").alias("fold"))


@query("arr01_elementwise_means", f"WITH q AS (SELECT label, unnest(generate_series(0, len(embedding) - 1)) AS k, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings) SELECT label, k, {r('avg(v)')} AS mean, {r('stddev_pop(v)')} AS std FROM q GROUP BY label, k")
def _(s, d):
    each = table(s, d, "embeddings").select("label", F.posexplode("embedding").alias("k", "v"))
    return each.groupBy("label", "k").agg(F.avg(F.col("v").cast("double")).alias("mean"), F.stddev_pop(F.col("v").cast("double")).alias("std"))


@query("arr02_parallel_arrays", "SELECT o_orderkey, k AS place, CASE k WHEN 0 THEN o_custkey ELSE o_orderkey END AS box, CASE k WHEN 0 THEN 'a' ELSE 'b' END AS class FROM orders, (VALUES (0), (1)) t(k)")
def _(s, d):
    o = table(s, d, "orders").select("o_orderkey", F.array("o_custkey", "o_orderkey").alias("box"), F.array(F.lit("a"), F.lit("b")).alias("class"))
    return o.select("o_orderkey", F.posexplode(F.arrays_zip("box", "class")).alias("place", "x")).select("o_orderkey", "place", "x.box", "x.class")


@query("arr03_predicted_score", f"SELECT vec_id, {r('CAST(embedding[label % 64 + 1] AS DOUBLE)')} AS score FROM embeddings")
def _(s, d):
    return table(s, d, "embeddings").select("vec_id", F.element_at("embedding", F.col("label") % 64 + 1).cast("double").alias("score"))


@query("map01_weights", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 0.5 ELSE 0.0 END AS detector, CAST(1 AS DOUBLE) AS segmenter FROM part")
def _(s, d):
    weights = F.when(F.col("p_size") % 2 == 0, F.create_map(F.lit("detector"), F.lit(0.5), F.lit("segmenter"), F.lit(1.0))).otherwise(F.create_map(F.lit("segmenter"), F.lit(1.0)))
    w = table(s, d, "part").select("p_partkey", weights.alias("w"))
    return w.select("p_partkey", *[F.coalesce(F.try_element_at("w", F.lit(n)), F.lit(0.0)).alias(n) for n in ("detector", "segmenter")])
