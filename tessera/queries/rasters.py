"""Raster arithmetic."""

from pyspark.sql import functions as F

from ..functions import raster as ras
from ..operators import imagery
from ..views import duck, table, view
from .aggregations import WB
from .registry import query, r

KEY = 'tile, "row", col'


def index(name):
    def run(s, d):
        return view(s, d, "bands").select("tile", "row", "col", ras.vegetation_index(name, {b: F.col(b) for b in ras.ROLES}).alias("value"))

    return run


def difference(a, b):
    return f"CASE WHEN abs({a} + {b}) > 1e-8 THEN ({a} - {b}) / ({a} + {b}) ELSE 0 END"


EVI = "nir + 6.0 * red - 7.5 * blue + 1.0"
for number, name, formula in (
    ("01", "ndvi", difference("nir", "red")), ("02", "nir", "nir"), ("03", "pri", difference("green", "blue")), ("04", "ndre", difference("nir", "red_edge")),
    ("05", "evi", f"CASE WHEN abs({EVI}) > 1e-8 THEN 2.5 * (nir - red) / ({EVI}) ELSE 0 END"), ("06", "gndvi", difference("nir", "green")), ("07", "ndwi", difference("green", "nir")),
):
    query(f"ras{number}_{name}", duck("bands") + f"SELECT {KEY}, {r(formula)} AS value FROM bands")(index(name))


@query("ras08_finite", duck("bands") + f"SELECT {KEY}, {r('CASE WHEN col = 0 OR col = 1 THEN 0 ELSE red END')} AS value FROM bands")
def _(s, d):
    v = F.when(F.col("col") == 0, F.lit(float("nan"))).when(F.col("col") == 1, F.lit(float("inf"))).otherwise(F.col("red"))
    return view(s, d, "bands").select("tile", "row", "col", ras.finite(v).alias("value"))


@query("ras09_reflectance", duck("bands") + f"SELECT {KEY}, {r('least(greatest(floor(red * 32768) / 32768.0, 0), 1)')} AS value FROM bands")
def _(s, d):
    b = view(s, d, "bands").withColumn("raw", F.floor(F.col("red") * 32768).cast("double"))
    return b.crossJoin(F.broadcast(b.agg(F.max("raw").alias("largest")))).select("tile", "row", "col", ras.reflectance(F.col("raw"), F.col("largest")).alias("value"))


STRETCH = "q AS (SELECT tile, quantile_cont(red, 0.02) AS lo, quantile_cont(red, 0.98) AS hi FROM bands GROUP BY tile), l AS (SELECT tile, \"row\", col, least(greatest((red - lo) / (hi - lo + 1e-9), 0), 1) AS red FROM bands JOIN q USING (tile))"


@query("ras10_linear_stretch", duck("bands") + f", {STRETCH} SELECT {KEY}, {r('red')} AS red FROM l")
def _(s, d):
    return imagery.stretched(view(s, d, "bands"), ["red"]).select("tile", "row", "col", "red")


@query("ras11_gamma", duck("bands") + f"SELECT {KEY}, {r('pow(least(greatest(red, 0), 1), 1 / 2.2)')} AS red FROM bands")
def _(s, d):
    return view(s, d, "bands").select("tile", "row", "col", ras.gamma(F.col("red")).alias("red"))


@query("ras12_gamma_white_balance", duck("bands") + f", {STRETCH}, g AS (SELECT {KEY}, pow(red, 1 / 2.2) AS red FROM l), {WB.format(src='g')} SELECT {KEY}, red FROM wb")
def _(s, d):
    return imagery.enhancements(view(s, d, "bands"), ["gamma_wb"], ["red"]).select("tile", "row", "col", "red")


@query("ras13_sigmoid", duck("bands") + f"SELECT {KEY}, {r('1 / (1 + exp(6 * (0.5 - red)))')} AS red FROM bands")
def _(s, d):
    return view(s, d, "bands").select("tile", "row", "col", ras.sigmoid_contrast(F.col("red")).alias("red"))


@query("ras14_band_remap", duck("bands") + f"SELECT {KEY}, {r('nir')} AS red, {r('red')} AS green, {r('green')} AS blue FROM bands")
def _(s, d):
    return view(s, d, "bands").select("tile", "row", "col", F.col("nir").alias("red"), F.col("red").alias("green"), F.col("green").alias("blue"))


@query("ras15_fixed_blend", duck("bands") + f"SELECT {KEY}, trunc(floor(red * 255) * 0.6 + floor(nir * 255) * (1.0 - 0.6)) AS value FROM bands")
def _(s, d):
    return view(s, d, "bands").select("tile", "row", "col", ras.blend(F.floor(F.col("red") * 255), F.floor(F.col("nir") * 255)).alias("value"))


@query("ras16_to_byte", duck("bands") + f"SELECT {KEY}, trunc(least(greatest(red * 255.0, 0), 255)) AS value FROM bands")
def _(s, d):
    return view(s, d, "bands").select("tile", "row", "col", ras.to_byte(F.col("red")).alias("value"))


SIMPLE = "x AS (SELECT 'linear' AS method, tile, \"row\", col, trunc(red * 255) AS red FROM l UNION ALL SELECT 'gamma', tile, \"row\", col, trunc(pow(red, 1 / 2.2) * 255) FROM l UNION ALL SELECT 'scurve', tile, \"row\", col, trunc(255 / (1 + exp(6 * (0.5 - red)))) FROM l)"


@query("ras17_enhancements", duck("bands") + f", {STRETCH}, {SIMPLE} SELECT method, tile, sum(red) AS red FROM x GROUP BY method, tile")
def _(s, d):
    return imagery.enhancements(view(s, d, "bands"), ["linear", "gamma", "scurve"], ["red"]).groupBy("method", "tile").agg(F.sum("red").alias("red"))


@query("ras17_composites")
def _(s, d):
    return imagery.enhancements(view(s, d, "bands"), ["blend_wb_sc", "stat_wt"]).groupBy("method", "tile").agg(F.sum("red").alias("red"), F.count("*").alias("pixels"))


@query("ras18_best_of_two", duck("det") + f"SELECT object_id, CASE WHEN segmenter_score > detector_score THEN 'ms' ELSE 'rgb' END AS source, {r('CASE WHEN segmenter_score > detector_score THEN segmenter_score ELSE detector_score END')} AS score FROM det")
def _(s, d):
    ms = F.col("segmenter_score") > F.col("detector_score")
    return view(s, d, "det").select("object_id", F.when(ms, "ms").otherwise("rgb").alias("source"), F.when(ms, F.col("segmenter_score")).otherwise(F.col("detector_score")).alias("score"))


@query("ras19_band_selection", f"SELECT vec_id, {r('CAST(embedding[3] AS DOUBLE)')} AS a, {r('CAST(embedding[1] AS DOUBLE)')} AS b FROM embeddings")
def _(s, d):
    return table(s, d, "embeddings").select("vec_id", *[F.element_at("embedding", i).cast("double").alias(n) for i, n in ((3, "a"), (1, "b"))])


@query("ras20_softmax", f"WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), m AS (SELECT vec_id, v, list_max(v) AS top FROM e) SELECT vec_id, list_position(v, top) - 1 AS class, {r('1 / list_sum(list_transform(v, lambda x: exp(x - top)))')} AS p, {r('1 / (1 + exp(-v[1]))')} AS sigmoid FROM m")
def _(s, d):
    v = F.transform("embedding", lambda x: x.cast("double"))
    return table(s, d, "embeddings").select("vec_id", v.alias("v")).select("vec_id", ras.argmax(F.col("v")).alias("class"), F.array_max(ras.softmax(F.col("v"))).alias("p"), ras.sigmoid(F.col("v")[0]).alias("sigmoid"))


@query("ras21_local_maxima")
def _(s, d):
    p = view(s, d, "pixels")
    peaks = imagery.local_maxima(p, least=0.55).groupBy("tile").agg(F.count("*").alias("peaks"))
    regions = imagery.label_regions(p.withColumn("mask", (F.col("value") > 0.5).cast("int"))).groupBy("tile").agg(F.max("region").alias("regions"))
    return regions.join(peaks, "tile", "left")


HITS = "sum(CASE WHEN value > 0.5 AND col % 2 = 0 THEN 1 ELSE 0 END)"


@query("ras22_losses", duck("pixels") + f"SELECT tile, {r(f'1 - (2 * {HITS} + 1.0) / (sum(CASE WHEN value > 0.5 THEN 1 ELSE 0 END) + 32 + 1.0)')} AS dice, {r('avg(CASE WHEN col % 2 = 0 THEN -0.25 * pow(1 - value, 2) * ln(greatest(value, 1e-12)) ELSE -0.75 * pow(value, 2) * ln(greatest(1 - value, 1e-12)) END)')} AS focal FROM pixels GROUP BY tile")
def _(s, d):
    truth = (F.col("col") % 2 == 0).cast("int")
    p = view(s, d, "pixels").withColumn("truth", truth).withColumn("mask", (F.col("value") > 0.5).cast("int"))
    return p.groupBy("tile").agg(ras.dice(F.sum(F.col("mask") * F.col("truth")), F.sum("mask"), F.sum("truth")).alias("dice"), F.avg(ras.focal(F.col("value"), F.col("truth"))).alias("focal"))


@query("ras23_camera_profiles", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 7 ELSE 4 END AS band FROM part")
def _(s, d):
    k = F.col("p_partkey") % 3
    asked = table(s, d, "part").select("p_partkey", F.when(k == 2, " MX_Dual").otherwise("RedEdge_MX").alias("profile"), F.lit("NIR").alias("role"), F.when(k == 0, 7).alias("user_band"))
    return imagery.resolve_bands(asked, imagery.profile_table(s)).select("p_partkey", "band")


@query("ras24_resize", duck("pixels") + f', n AS (SELECT tile, r2, c2 FROM (SELECT DISTINCT tile FROM pixels) t, generate_series(0, 4) a(r2), generate_series(0, 4) b(c2)) SELECT n.tile, r2 AS "row", c2 AS col, {r("value")} AS value FROM n JOIN pixels p ON p.tile = n.tile AND p."row" = floor((r2 + 0.5) * 8 / 5) AND p.col = floor((c2 + 0.5) * 8 / 5)')
def _(s, d):
    return imagery.resize_nearest(view(s, d, "pixels").withColumns({"row": F.col("row").cast("int"), "col": F.col("col").cast("int")}), 8, 8, 5, 5).select("tile", "row", "col", "value")


@query("ras25_pad_to_largest", f"SELECT vec_id, 66 AS n, {r('CASE WHEN vec_id % 2 = 0 THEN 0 ELSE CAST(embedding[64] AS DOUBLE) END')} AS v FROM embeddings")
def _(s, d):
    own = F.when(F.col("vec_id") % 2 == 0, F.slice("embedding", 1, 60)).otherwise(F.col("embedding"))
    padded = F.concat(own, F.array_repeat(F.lit(0.0).cast("float"), F.lit(66) - F.size(own)))
    return table(s, d, "embeddings").select("vec_id", padded.alias("x")).select("vec_id", F.size("x").alias("n"), F.element_at("x", 64).cast("double").alias("v"))


@query("ras26_binary_classes", "SELECT doc_id, 1 AS class, coalesce(CASE WHEN doc_id % 3 = 0 THEN NULL ELSE quality END, 0) AS category FROM labels")
def _(s, d):
    return table(s, d, "labels").select("doc_id", F.lit(1).alias("class"), F.coalesce(F.when(F.col("doc_id") % 3 > 0, F.col("quality")), F.lit(0)).alias("category"))
