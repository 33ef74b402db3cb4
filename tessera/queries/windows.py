"""Ranking, ordering, top rows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import names
from ..operators import evaluate, fusion, imagery, merging
from ..sources import annotations as ann
from ..sources import files
from ..views import duck, table, view
from .joins import TRUE_PAIRS, true_pairs
from .registry import query, r

AREA = "((xmax - xmin) * (ymax - ymin))"


@query("win01_fresh_ids", "WITH n AS (SELECT event_id, CASE WHEN event_id % 10 = 0 AND event_id > 0 THEN event_id - 1 ELSE event_id END AS id FROM events), w AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY event_id) AS k FROM n) SELECT event_id, CASE WHEN k = 1 THEN id ELSE (SELECT max(id) FROM n) + row_number() OVER (PARTITION BY k > 1 ORDER BY event_id) END AS id FROM w")
def _(s, d):
    e = table(s, d, "events").select("event_id", F.when((F.col("event_id") % 10 == 0) & (F.col("event_id") > 0), F.col("event_id") - 1).otherwise(F.col("event_id")).alias("id"))
    return merging.fresh_ids(e, "id", "event_id")


@query("win02_dense_ids", duck("det") + "SELECT object_id, row_number() OVER (ORDER BY object_id) - 1 AS n FROM det")
def _(s, d):
    return fusion.numbered(view(s, d, "det").select("object_id"), "object_id", "n")


@query("win03_running_names", "SELECT user_id, 'SITE_' || lpad(CAST(row_number() OVER (ORDER BY first) - 1 AS VARCHAR), 6, '0') AS crown_id FROM (SELECT user_id, min(event_id) AS first FROM events GROUP BY user_id) q")
def _(s, d):
    first = table(s, d, "events").groupBy("user_id").agg(F.min("event_id").alias("first"))
    return fusion.numbered(first, "first", "n").select("user_id", names.padded_id("SITE", F.col("n")).alias("crown_id"))


@query("win04_date_positions", duck("obs") + "SELECT crown, CAST(day AS VARCHAR) AS day, kind, dense_rank() OVER (ORDER BY day) AS position FROM obs")
def _(s, d):
    from ..operators.temporal import date_positions

    return date_positions(view(s, d, "obs").select("crown", F.col("day").cast("string").alias("day"), "kind"), "day")


@query("win05_score_ranks", duck("det") + "SELECT object_id, row_number() OVER (PARTITION BY tile ORDER BY detector_score DESC, object_id) AS rank FROM det")
def _(s, d):
    return view(s, d, "det").select("object_id", F.row_number().over(Window.partitionBy("tile").orderBy(F.desc("detector_score"), "object_id")).alias("rank"))


@query("win06_candidate_ranks", duck("det", "truth") + f", {TRUE_PAIRS} SELECT pred, truth, row_number() OVER (PARTITION BY pred ORDER BY iou DESC, truth) AS rank FROM hits WHERE iou >= 0.1")
def _(s, d):
    w = Window.partitionBy("pred").orderBy(F.desc("iou"), "truth")
    return true_pairs(s, d).where("iou >= 0.1").select("pred", "truth", F.row_number().over(w).alias("rank"))


@query("win07_top_per_image", duck("det") + "SELECT tile, object_id FROM (SELECT tile, object_id, row_number() OVER (PARTITION BY tile ORDER BY detector_score DESC, object_id) AS k FROM det) q WHERE k <= 10")
def _(s, d):
    w = Window.partitionBy("tile").orderBy(F.desc("detector_score"), "object_id")
    return view(s, d, "det").withColumn("k", F.row_number().over(w)).where("k <= 10").select("tile", "object_id")


CUM = "c AS (SELECT tile, object_id, sum(CASE WHEN class = 'R' THEN 1 ELSE 0 END) OVER w AS hits, row_number() OVER w AS seen FROM det WINDOW w AS (PARTITION BY tile ORDER BY detector_score DESC, object_id ROWS UNBOUNDED PRECEDING))"


@query("win08_precision_envelope", duck("det") + f", {CUM} SELECT tile, object_id, {r('hits / seen')} AS precision, {r('max(hits / seen) OVER (PARTITION BY tile ORDER BY seen ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)')} AS envelope FROM c")
def _(s, d):
    w = Window.partitionBy("tile").orderBy(F.desc("detector_score"), "object_id")
    c = view(s, d, "det").withColumn("seen", F.row_number().over(w)).withColumn("precision", F.sum((F.col("class") == "R").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)) / F.col("seen"))
    return c.select("tile", "object_id", "precision", F.max("precision").over(Window.partitionBy("tile").orderBy(F.desc("seen")).rowsBetween(Window.unboundedPreceding, 0)).alias("envelope"))


@query("win09_latest_artefact", "SELECT event_type AS kind, concat('/out/', max(event_id), '.gpkg') AS path FROM events GROUP BY event_type")
def _(s, d):
    e = table(s, d, "events").select(F.col("event_type").alias("kind"), F.col("event_id").alias("component_id"), F.concat(F.lit("/out/"), "event_id", F.lit(".gpkg")).alias("path"))
    return files.latest_artefact(e)


@query("win10_batches", "SELECT conv_id, turn, floor((row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) / 2) AS batch FROM conversations")
def _(s, d):
    return files.numbered_batches(table(s, d, "conversations").select("conv_id", "turn"), 2, "turn", ["conv_id"])


@query("win11_dense_annotation_ids", "SELECT source, lang, doc_id, row_number() OVER (PARTITION BY source, lang ORDER BY n_chars, doc_id) AS id FROM documents")
def _(s, d):
    return ann.dense_ids(table(s, d, "documents").select("source", "lang", "doc_id", "n_chars"), ["source", "lang"], ["n_chars", "doc_id"], "id").drop("n_chars")


@query("win12_forward_fill", "SELECT event_id, last_value(CASE WHEN event_id % 3 = 0 THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS stage FROM events")
def _(s, d):
    w = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)
    return table(s, d, "events").select("event_id", F.last(F.when(F.col("event_id") % 3 == 0, F.col("event_type")), True).over(w).alias("stage"))


@query("srt01_by_score", duck("det") + f"SELECT object_id, {r('detector_score')} AS score FROM det ORDER BY detector_score DESC, object_id")
def _(s, d):
    return view(s, d, "det").orderBy(F.desc("detector_score"), "object_id").select("object_id", F.col("detector_score").alias("score"))


@query("srt02_pair_order", duck("det", "truth") + f", {TRUE_PAIRS} SELECT pred, truth FROM hits ORDER BY iou DESC, pred DESC, truth DESC")
def _(s, d):
    return true_pairs(s, d).orderBy(F.desc(F.struct("iou", "pred", "truth"))).select("pred", "truth")


@query("srt03_best_configuration", duck("metrics") + f"SELECT product, run, {r('sum(f1 * num_truths) / sum(num_truths)')} AS f1 FROM metrics GROUP BY product, run ORDER BY sum(f1 * num_truths) / sum(num_truths) DESC, product, run LIMIT 1")
def _(s, d):
    m = evaluate.with_average(view(s, d, "metrics").select(F.col("location").cast("string").alias("location"), "product", "run", "f1", "num_truths"), ["product", "run"], "location", ["f1"], "num_truths")
    return evaluate.best_row(m, "f1", "location", ["product", "run"]).select("product", "run", "f1")


@query("srt04_argmax_row", duck("det") + "SELECT tile, arg_max(object_id, (detector_score, -object_id)) AS best FROM det GROUP BY tile")
def _(s, d):
    return view(s, d, "det").groupBy("tile").agg(F.max_by("object_id", F.struct("detector_score", -F.col("object_id"))).alias("best"))


@query("srt05_ordered_lists", "SELECT conv_id, string_agg(role, '>' ORDER BY turn) AS roles FROM conversations GROUP BY conv_id")
def _(s, d):
    grouped = table(s, d, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role"))).alias("x"))
    return grouped.select("conv_id", F.array_join(F.transform("x", lambda x: x["role"]), ">").alias("roles"))


@query("srt06_distinct_thresholds", "SELECT '0.3,0.5,0.75' AS thresholds")
def _(s, d):
    return s.range(1).select(F.array_join(F.transform(F.array_sort(F.array_distinct(F.array(*map(F.lit, (0.5, 0.3, 0.75, 0.5))))), lambda x: x.cast("string")), ",").alias("thresholds"))


@query("srt07_largest_box", duck("det") + f"SELECT tile, arg_max(object_id, ({AREA}, -object_id)) AS largest FROM det GROUP BY tile")
def _(s, d):
    return view(s, d, "det").groupBy("tile").agg(F.max_by("object_id", F.struct(g.area(g.box()), -F.col("object_id"))).alias("largest"))


@query("srt08_sampled_percentiles", duck("bands") + f', b AS (SELECT tile, floor("row" / 2) AS r2, floor(col / 2) AS c2, avg(red) AS red FROM bands GROUP BY ALL) SELECT tile, {r("quantile_cont(red, 0.02)")} AS low, {r("quantile_cont(red, 0.98)")} AS high FROM b GROUP BY tile')
def _(s, d):
    small = imagery.block_average(view(s, d, "bands"), 2, ["red"])
    return small.groupBy("tile").agg(F.percentile("red", F.lit(0.02)).alias("low"), F.percentile("red", F.lit(0.98)).alias("high"))
