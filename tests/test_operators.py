"""Expected values worked out by hand, and properties."""

import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import geometry as g
from tessera.functions import polygons
from tessera.functions import raster as ras
from tessera.operators import evaluate, fusion, graph, imagery, merging, spatial, temporal, tiling

BOX = "xmin double, ymin double, xmax double, ymax double"


def frame(spark, rows, schema):
    return spark.createDataFrame([tuple(float(v) if isinstance(v, int) and i >= len(r) - 4 else v for i, v in enumerate(r)) for r in rows], f"{schema}, {BOX}")


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def lits(*values):
    return tuple(F.lit(float(v)) for v in values)


# -- overlap


@pytest.mark.parametrize("a, b, iou, ioa", [((0, 0, 10, 10), (0, 0, 10, 10), 1, 1), ((0, 0, 10, 10), (20, 20, 30, 30), 0, 0), ((0, 0, 10, 10), (5, 0, 15, 10), 1 / 3, 0.5), ((0, 0, 10, 10), (2, 2, 4, 4), 0.04, 1), ((0, 0, 10, 10), (10, 0, 20, 10), 0, 0), ((0, 0, 0, 0), (0, 0, 0, 0), 0, 0)])
def test_overlap(spark, a, b, iou, ioa):
    assert one(spark, g.iou(lits(*a), lits(*b))) == pytest.approx(iou)
    assert one(spark, g.ioa(lits(*a), lits(*b))) == pytest.approx(ioa)
    assert one(spark, g.iou(lits(*b), lits(*a))) == pytest.approx(iou)


def test_grid_join_finds_each_pair_once(spark):
    rng = random.Random(1)
    boxes = [(i, x := rng.uniform(0, 60), y := rng.uniform(0, 60), x + rng.uniform(0, 25), y + rng.uniform(0, 25)) for i in range(120)]
    df = spark.createDataFrame(boxes, f"k int, {BOX}")
    want = {(a[0], b[0]) for a in boxes for b in boxes if a[0] < b[0] and a[1] < b[3] and b[1] < a[3] and a[2] < b[4] and b[2] < a[4]}
    for cell, salt in ((7.0, 1), (100.0, 1), (7.0, 3)):
        got = [(r.a_k, r.b_k) for r in spatial.overlap_pairs(df, "k", cell, salt=salt).select("a_k", "b_k").collect()]
        assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("area, label", [(0, "tiny"), (8.9, "tiny"), (9, "small"), (24.9, "small"), (25, "medium"), (36, "medium"), (49, "large"), (64, "large"), (100, "giant"), (1000, "giant")])
def test_size_classes(spark, area, label):
    assert one(spark, g.size_label(F.lit(float(area)), 1.0)) == label
    assert one(spark, g.size_label(F.lit(area * 4.0), 0.5)) == label


def test_area_of_interest_overlap(spark):
    rows = [(1, 10, 10, 20, 20), (2, 200, 200, 210, 210), (3, 95, 0, 105, 10), (4, 97, 20, 107, 30), (5, 96, 40, 106, 50), (6, 50, 50, 50, 50)]
    aoi = frame(spark, [(0, 0, 0, 100, 100)], "area int")
    kept = spatial.min_overlap(frame(spark, rows, "k int"), aoi, 0.4, 50.0, "k")
    assert sorted(r.k for r in kept.collect()) == [1, 3, 5]


# -- fixpoints


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 8), st.integers(10, 18), st.integers(0, 3)), min_size=1, max_size=30, unique_by=lambda e: e[:2]))
def test_matching_is_sequential_greedy(spark, edges):
    want, used = [], set()
    for a, b, s in sorted(edges, key=lambda e: (-e[2], e[0], e[1])):
        if a not in used and b not in used:
            want.append((a, b))
            used |= {a, b}
    for small in (0, 100):
        got = graph.greedy_match(spark.createDataFrame(edges, "a int, b int, s int"), [F.desc("s"), "a", "b"], small=small).select("a", "b").collect()
        assert sorted(map(tuple, got)) == sorted(want)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 14), st.integers(0, 14)), min_size=1, max_size=40, unique=True))
def test_suppression_is_sequential_greedy(spark, pairs):
    edges = {(min(p), max(p)) for p in pairs if p[0] != p[1]}
    kept = []
    for n in range(15):
        if not any((k, n) in edges for k in kept):
            kept.append(n)
    for small in (0, 100):
        lost = [r.lo for r in graph.greedy_suppress(spark.createDataFrame(sorted(edges), "hi int, lo int"), small=small).collect()]
        assert sorted(lost) == sorted(set(range(15)) - set(kept))


@pytest.mark.parametrize("edges", [[(1, 2), (2, 3), (5, 6)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(50, 51)], [(3, 3)], []])
def test_components(spark, edges):
    parent = {n: n for e in edges for n in e}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    linked = {n for a, b in edges if a != b for n in (a, b)}
    for small in (0, 100):
        rows = graph.connected_components(spark.createDataFrame(edges, "a int, b int"), small=small).collect()
        assert sorted((r.node, r.component) for r in rows) == sorted((n, find(n)) for n in linked)


# -- aggregation of boxes


def test_penalty(spark):
    for area, want in ((2.0, 0.5), (4.0, 1.0), (50.0, 1.0), (128.0, 0.5), (0.01, 0.1), (1e6, 0.1)):
        assert one(spark, fusion.area_penalty(F.lit(area), 4, 64)) == pytest.approx(want)


def test_fusion_of_scores(spark):
    df = spark.createDataFrame([(0.9, 0.4), (0.0, 0.5)], "a double, b double")
    got = [r.x for r in df.select(fusion.fused_score({"a": 1, "b": 2}).alias("x")).collect()]
    assert got[0] == pytest.approx((0.9 * 0.16) ** (1 / 3)) and got[1] == 0
    with pytest.raises(ValueError):
        fusion.fused_score({"a": 1}, "harmonic")


def test_suppression_ranks_by_score_then_id(spark):
    rows = [(1, 0.9, 0, 0, 10, 10), (2, 0.9, 0, 0, 10, 10), (3, 0.95, 1, 0, 11, 10), (4, 0.5, 30, 30, 40, 40)]
    kept = fusion.suppress(frame(spark, rows, "object_id int, score double"), 0.5, 20.0)
    assert sorted(r.object_id for r in kept.collect()) == [3, 4]
    same = fusion.suppress(frame(spark, rows[:2], "object_id int, score double"), 0.5, 20.0)
    assert [r.object_id for r in same.collect()] == [1]


def test_disambiguation_keeps_large_remainders(spark):
    rows = [(1, 0.9, 0, 0, 10, 10), (2, 0.8, 2, 2, 4, 4), (3, 0.7, 8, 0, 30, 10)]
    kept = fusion.suppress(frame(spark, rows, "object_id int, score double"), 0.15, 20.0, algorithm="ioa-disambiguate")
    assert sorted(r.object_id for r in kept.collect()) == [1, 3]


def test_box_fusion(spark):
    rows = [("t", 1, 0.8, 0, 0, 10, 10), ("t", 2, 0.4, 2, 0, 12, 10), ("t", 3, 0.5, 50, 50, 60, 60), ("u", 4, 0.3, 0, 0, 10, 10)]
    got = {r.anchor: r for r in fusion.fuse_boxes(frame(spark, rows, "tile string, object_id int, score double")).collect()}
    assert set(got) == {1, 3, 4} and got[1].members == 2 and got[1].score == 0.8
    assert got[1].xmin == pytest.approx(2 * 0.4 / 1.2)


def test_merging_runs(spark):
    rows = [(1, 0, "a", 0.9, 0, 0, 10, 10), (1, 1, "b", 0.8, 1, 0, 11, 10), (2, 0, "a", None, 100, 100, 110, 110), (2, 1, "b", 0.7, 300, 0, 310, 10), (3, 1, "c", 0.6, 301, 0, 311, 10)]
    df = frame(spark, rows, "object_id int, run_index int, tile string, segmenter_score double")
    got = [r.asDict() for r in fusion.merge_runs(df).orderBy("object_id").collect()]
    assert [r["object_id"] for r in got] == [0, 1, 2, 3]  # boxes of one run are never linked
    first = got[0]
    assert first["observation_count"] == 2 and first["segmenter_score"] == pytest.approx(0.85) and first["tile"] == "a"
    assert first["run_agreement"] == pytest.approx(90 / 110) and first["source_runs"] == [0, 1]
    assert got[1]["segmenter_score"] == 1.0 and got[1]["run_agreement"] == 1.0
    assert fusion.merge_runs(df, min_observations=2).count() == 1


def test_consensus_shapes():
    boxes = [(0, 0, 10, 10), (5, 0, 15, 10), (100, 0, 110, 10)]
    size = lambda parts: sum((b[2] - b[0]) * (b[3] - b[1]) for b in parts)
    assert size(fusion.consensus_boxes(boxes, [0, 1, 2], "union")) == 250
    assert size(fusion.consensus_boxes(boxes, [0, 1, 2], "intersection_union_blend")) == 250  # nothing is shared
    (x0, y0, x1, y1) = fusion.consensus_boxes(boxes[:2], [0, 1], "intersection_union_blend")[0]
    assert (x0, x1) == (5 - 1.0, 10 + 1.0) and (y0, y1) == (-1.0, 11.0)
    assert size(fusion.consensus_boxes(boxes, [0, 0, 1], "majority_union")) == 250  # two runs: one member is enough
    assert size(fusion.consensus_boxes([*boxes, (200, 0, 201, 1)], [0, 0, 1, 2], "majority_union")) == 150
    with pytest.raises(ValueError):
        fusion.consensus_boxes(boxes, [0, 1, 2], "middle")


def test_union_area():
    assert fusion.union_area([(0, 0, 10, 10), (5, 0, 15, 10), (100, 100, 101, 101)]) == 151
    assert fusion.union_area([]) == 0


# -- evaluation


def preds(spark, rows):
    return frame(spark, rows, "pred int, score double")


def truths(spark, rows):
    return frame(spark, rows, "truth int")


SQUARES = [(0, 0, 10, 10), (20, 20, 30, 30), (40, 40, 50, 50)]


def test_perfect_predictions(spark):
    t = evaluate.evaluate(preds(spark, [(i, 0.9 - i / 20, *b) for i, b in enumerate(SQUARES)]), truths(spark, [(i, *b) for i, b in enumerate(SQUARES)]), [0.5], 20.0, sizes=False).first()
    assert (t.tp, t.fp, t.fn, t.precision, t.recall, t.f1) == (3, 0, 0, 1, 1, 1)


def test_disjoint_predictions(spark):
    t = evaluate.evaluate(preds(spark, [(0, 0.9, 100, 100, 110, 110), (1, 0.8, 120, 120, 130, 130)]), truths(spark, [(0, 0, 0, 10, 10), (1, 20, 20, 30, 30)]), [0.5], 20.0, sizes=False).first()
    assert (t.tp, t.precision, t.recall, t.f1) == (0, 0, 0, 0)


def test_partial_predictions(spark):
    boxes = [*SQUARES[:2], (200, 200, 210, 210)]
    t = evaluate.evaluate(preds(spark, [(i, 0.9, *b) for i, b in enumerate(boxes)]), truths(spark, [(i, *b) for i, b in enumerate([*SQUARES, (60, 60, 70, 70)])]), [0.5], 20.0, sizes=False).first()
    assert t.precision == pytest.approx(2 / 3) and t.recall == 0.5 and t.f1 == pytest.approx(0.571, abs=1e-3)


def test_two_thresholds(spark):
    table = evaluate.evaluate(preds(spark, [(0, 0.9, 0, 0, 10, 10), (1, 0.8, 22, 20, 32, 30)]), truths(spark, [(0, *SQUARES[0]), (1, *SQUARES[1])]), [0.75, 0.5, 0.5], 20.0, sizes=False)
    s = evaluate.summary(table).first()
    assert s.f1_list == [1.0, 0.5] and s.f1_50 == 1.0 and s.f1_75 == 0.5 and s.f1 == 0.75 and s.tp == 2


def test_sizes_meet_only_their_own(spark):
    table = evaluate.evaluate(preds(spark, [(0, 0.9, 0, 0, 2.9, 2.9)]), truths(spark, [(0, 0, 0, 3, 3)]), [0.5], 5.0)
    got = {r["size"]: (r.tp, r.fp, r.fn) for r in table.collect()}
    assert got == {"all": (1, 0, 0), "tiny": (0, 1, 0), "small": (0, 0, 1)}


def test_average_precision(spark):
    p = frame(spark, [("i", "c", 0, 0.9, *SQUARES[0]), ("i", "c", 1, 0.8, 100, 100, 110, 110), ("i", "c", 2, 0.7, *SQUARES[1])], "image string, category string, pred int, score double")
    t = frame(spark, [("i", "c", 0, *SQUARES[0]), ("i", "c", 1, *SQUARES[1]), ("i", "d", 2, *SQUARES[2])], "image string, category string, truth int")
    got = {r.category: r for r in evaluate.average_precision(p, t, [0.5], 20.0).collect()}
    assert got["c"].ap == pytest.approx((51 + 50 * 2 / 3) / 101) and got["c"].ar == 1
    assert (got["d"].ap, got["d"].ar) == (0, 0)


def test_running_sums_over_many_ranges(spark):
    from tessera.operators import running

    rng = random.Random(9)
    rows = [(k, i, rng.randint(0, 3), rng.random()) for i, k in enumerate(rng.choice("ab") for _ in range(400))]
    ranged = running.in_ranges(spark.createDataFrame(rows, "k string, i int, v long, p double").repartition(7), ["k"], [F.col("i")])
    out = running.following_maximum(running.running_sums(ranged, ["k"], [F.col("i")], {"s": F.col("v")}), ["k"], [F.col("i")], "p", "m")
    for r in out.collect():
        assert r.s == sum(v for k, i, v, _ in rows if k == r.k and i <= r.i)
        assert r.m == max(p for k, i, _, p in rows if k == r.k and i >= r.i)


def test_weighted_rows_fall_back_to_means(spark):
    df = spark.createDataFrame([("a", 0.5, 10), ("a", 1.0, 30), ("b", 0.2, 0), ("b", 0.4, 0)], "k string, f1 double, n long")
    got = {r.k: r.f1 for r in evaluate.weighted_rows(df, ["k"], ["f1"], "n").collect()}
    assert got == {"a": pytest.approx(0.875), "b": pytest.approx(0.3)}


def test_mean_and_population_deviation(spark):
    df = spark.createDataFrame([(1, "x", 0.4), (2, "x", 0.6)], "run int, k string, f1 double")
    r = evaluate.mean_and_spread(df, ["k"], ["f1"]).first()
    assert r.f1_mean == pytest.approx(0.5) and r.f1_std == pytest.approx(0.1)


# -- time


def test_identity_over_time(spark):
    rows = [(1, 1, 0.5, 0, 0, 10, 10), (2, 2, 0.5, 1, 0, 11, 10), (3, 3, 0.5, 1, 1, 11, 11), (4, 1, 0.5, 50, 50, 51, 51), (5, 2, 0.5, 51.5, 50, 52.5, 51), (6, 3, 0.5, 500, 500, 510, 510)]
    df = frame(spark, rows, "object_id int, position int, segmenter_score double")
    groups = temporal.match_over_time(df)
    assert {r.object_id: r.component for r in groups.collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6}
    found = [r.asDict() for r in temporal.reference_objects(df, groups).orderBy("crown_id").collect()]
    assert [f["crown_id"] for f in found] == ["SITE_000000", "SITE_000001", "SITE_000002"]
    assert found[0]["date_coverage"] == "1,2,3" and found[0]["observation_count"] == 3 and not found[0]["merge_ambiguity"]
    assert found[2]["temporal_confidence"] == 1.0
    assert temporal.reference_objects(df, groups, min_dates=2).count() == 2


def test_zonal_median_needs_three_pixels(spark):
    df = spark.createDataFrame([(1, 0.8), (1, 0.7), (1, 0.9), (2, 0.5), (2, float("nan")), (2, 0.1)], "zone int, v double")
    assert [(r.zone, r.v_median) for r in temporal.zonal_median(df, "zone", ["v"]).collect()] == [(1, 0.8)]


# -- rasters


def test_vegetation_indices(spark):
    bands = {b: F.lit(v) for b, v in zip(ras.ROLES, (0.1, 0.2, 0.3, 0.4, 0.8))}
    assert one(spark, ras.vegetation_index("NDVI", bands)) == pytest.approx(0.5 / 1.1)
    assert one(spark, ras.vegetation_index("evi", bands)) == pytest.approx(2.5 * 0.5 / (0.8 + 1.8 - 0.75 + 1))
    assert one(spark, ras.vegetation_index("ndre", {"nir": F.lit(0.5)})) == 0
    assert one(spark, ras.vegetation_index("ndvi", {"nir": F.lit(0.0), "red": F.lit(0.0)})) == 0
    assert one(spark, ras.finite(F.lit(float("nan")))) == 0
    for name, own in (("xyz", bands), ("ndvi", {"nir": F.lit(1.0)})):
        with pytest.raises(ValueError):
            ras.vegetation_index(name, own)


def test_bytes_are_cut_off(spark):
    assert one(spark, ras.to_byte(F.lit(0.999))) == 254 and one(spark, ras.to_byte(F.lit(2.0))) == 255
    assert one(spark, ras.blend(F.lit(255), F.lit(0))) == 153 and one(spark, ras.sigmoid_contrast(F.lit(0.5))) == 0.5


def test_votes_and_best_runs(spark):
    rows = [(1, r, 0, v) for r, v in enumerate((1.0, 1.0, 0.0))] + [(1, r, 1, v) for r, v in enumerate((1.0, 0.0, 0.0))]
    df = spark.createDataFrame(rows, "obj int, run int, px int, probability double")
    assert {r.px: r["mask"] for r in imagery.ensemble_vote(df, ["obj", "px"]).collect()} == {0: 1, 1: 0}
    scores = spark.createDataFrame([(1, 0, 0.3), (1, 1, 0.9), (1, 2, 0.6)], "k int, run int, score double")
    assert imagery.best_run(scores, "k").first().run == 1


def test_white_balance_reaches_its_target(spark):
    rng = random.Random(4)
    df = spark.createDataFrame([(0, y, x, rng.gauss(0.5, 0.1)) for y in range(30) for x in range(30)], "tile int, row int, col int, green double")
    r = imagery.white_balanced(df, ["green"]).agg(F.avg("green").alias("m"), F.min("green").alias("low"), F.max("green").alias("high")).first()
    assert abs(r.m - imagery.TARGET_MEANS["green"]) < 2 and 0 <= r.low and r.high <= 255


def test_profiles(spark):
    asked = spark.createDataFrame([(" Altum ", "NIR", None), ("mx_dual", "red", 7), ("unknown", "red", None)], "profile string, role string, user_band int")
    assert sorted((r.profile.strip(), r.band) for r in imagery.resolve_bands(asked, imagery.profile_table(spark)).collect()) == [("Altum", 4), ("mx_dual", 7), ("unknown", None)]


def test_missing_bands_raise(spark):
    df = spark.createDataFrame([(0, 1.0, 300.0, 2.0)], "tile int, red double, green double, blue double")
    with pytest.raises(ValueError):
        imagery.require_bands(df)
    imagery.require_bands(df.withColumn("green", F.lit(255.0)))


def test_regions(spark):
    grid = ["11000", "01001", "00011"]
    df = spark.createDataFrame([(0, y, x, int(c)) for y, line in enumerate(grid) for x, c in enumerate(line)], "tile int, row int, col int, mask int")
    assert imagery.label_regions(df).agg(F.max("region")).first()[0] == 2


def test_tile_grid_covers_and_fits(spark):
    df = spark.createDataFrame([(1, 1000, 500), (2, 100, 90)], "k int, width int, height int")
    got = [(r.k, r.x, r.y) for r in tiling.grid(df, 256, 0.5).collect()]
    assert max(x for k, x, _ in got if k == 1) == 744 and max(y for k, _, y in got if k == 1) == 244
    assert [g_ for g_ in got if g_[0] == 2] == [(2, 0, 0)]
    with pytest.raises(ValueError):
        tiling.areas_of_interest(df, {"bands": {"a": 0.5}})


# -- rings


def test_repair_takes_the_larger_part():
    bow = [(0, 0), (10, 10), (10, 0), (0, 4)]
    fixed = polygons.repaired(bow)
    assert polygons.simple(fixed) and not polygons.simple(bow)
    assert polygons.repaired([(0, 0), (1, 1)]) is None
    square = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
    assert abs(polygons.signed_area(polygons.opened(polygons.repaired(square)))) == 16


@settings(max_examples=50, deadline=None)
@given(st.tuples(*[st.integers(0, 20)] * 4), st.tuples(*[st.integers(0, 20)] * 4))
def test_boolean_areas_of_boxes(a, b):
    ring = lambda x, y, w, h: [(x, y), (x + w + 1, y), (x + w + 1, y + h + 1), (x, y + h + 1)]
    only_a, only_b, both = polygons.boolean_areas(ring(*a), ring(*b))
    want = max(0, min(a[0] + a[2], b[0] + b[2]) + 1 - max(a[0], b[0])) * max(0, min(a[1] + a[3], b[1] + b[3]) + 1 - max(a[1], b[1]))
    assert both == pytest.approx(want) and only_a + both == pytest.approx((a[2] + 1) * (a[3] + 1)) and only_b + both == pytest.approx((b[2] + 1) * (b[3] + 1))


def test_triangles_cross():
    a, b = [(0, 0), (4, 0), (0, 4)], [(0, 4), (4, 4), (4, 0)]
    assert polygons.boolean_areas(a, b)[2] == pytest.approx(0)
    assert polygons.boolean_areas(a, [(0, 0), (4, 4), (0, 4)])[2] == pytest.approx(4)


def test_buffer_and_simplify():
    square = [(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)]
    area = abs(polygons.signed_area(polygons.opened(polygons.buffered(square, 1.0, 64))))
    assert area == pytest.approx(100 + 40 + math.pi, rel=1e-3)
    wavy = [(0, 0), (5, 0.01), (10, 0), (10, 10), (0, 10), (0, 0)]
    assert len(polygons.opened(polygons.simplified(wavy, 0.1))) == 4


def test_tracing():
    import numpy as np

    mask = np.zeros((5, 5), bool)
    mask[1:3, 1:4] = True
    assert sorted(polygons.opened(polygons.traced(mask))) == [(1, 1), (1, 3), (4, 1), (4, 3)]


def test_projections(spark):
    x, y = (one(spark, c) for c in g.to_utm(F.lit(3.0), F.lit(0.0)))
    assert x == pytest.approx(500000, abs=1e-3) and y == pytest.approx(0, abs=1e-3)
    x, y = (one(spark, c) for c in g.to_utm(F.lit(-73.5), F.lit(45.5)))
    assert x == pytest.approx(617164.0, abs=100) and y == pytest.approx(5039505, abs=500)
    assert one(spark, g.utm_srid(F.lit(-73.5), F.lit(45.5))) == 32618
    lon, lat = (one(spark, c) for c in g.from_mercator(*g.to_mercator(F.lit(12.5), F.lit(-33.25))))
    assert (lon, lat) == (pytest.approx(12.5), pytest.approx(-33.25))


# -- merging of results


def test_merge_rules(spark):
    old = frame(spark, [(1, "a", 0, 0, 1, 1), (2, "b", 0, 0, 2, 2)], "object_id int, class string")
    new = frame(spark, [(1, 0.5, 0, 0, 9, 9)], "object_id int, score double")
    merged = merging.merge_result(new, old)
    assert merged.count() == 1 and merged.first()["class"] == "a" and merged.first().xmax == 9
    attributes = spark.createDataFrame([(1, "z")], "object_id int, label string")
    assert merging.merge_result(attributes, old).count() == 2
    assert merging.merge_result(new, old, objects_are_new=True).columns == new.columns
    assert merging.merge_result(new, None) is new
    with pytest.raises(ValueError):
        merging.merge_result(spark.createDataFrame([("z",)], "label string"), old)
    assert merging.merge_result(new.drop("object_id"), old).columns == ["score", *g.SIDES]


def test_fresh_ids(spark):
    df = spark.createDataFrame([(0, 5), (1, 5), (2, 7), (3, None), (4, 5)], "o int, id long")
    assert [r.id for r in merging.fresh_ids(df, "id", "o").orderBy("o").collect()] == [5, 8, 7, 9, 10]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 12), st.integers(0, 12), st.integers(0, 6), st.integers(1, 6)), min_size=1, max_size=25))
def test_covered_areas_are_those_of_a_raster(spark, boxes):
    df = spark.createDataFrame([(k, float(x), float(y), float(x + w), float(y + h)) for k, x, y, w, h in boxes], "component int, xmin double, ymin double, xmax double, ymax double")
    want = {}
    for k, x, y, w, h in boxes:
        want.setdefault(k, set()).update((i, j) for i in range(x, x + w) for j in range(y, y + h))
    got = {r.component: r.area for r in fusion.covered_areas(df).collect()}
    assert {k: v for k, v in got.items() if v} == {k: len(v) for k, v in want.items() if v}


def test_rounds_and_the_short_end_of_a_chain_agree(spark):
    """All rounds distributed, or the last edges in one task: the same components, matches and suppressions of a real table."""
    from tessera.queries.joins import pairs
    from tessera.views import view

    sf = "/root/testdata/sf0.01"
    linked = pairs(spark, sf).where("iou >= 0.2").select(F.col("a_object_id").alias("a"), F.col("b_object_id").alias("b"), "iou").persist()
    assert linked.count() > 2 * graph.SMALL
    plain = lambda df: sorted(map(tuple, df.collect()))
    order = [F.desc("iou"), "a", "b"]
    assert plain(graph.greedy_match(linked, order, small=0)) == plain(graph.greedy_match(linked, order)) == plain(graph.greedy_match(linked, order, small=10**9))
    conflicts = linked.select(F.col("a").alias("hi"), F.col("b").alias("lo"))
    assert plain(graph.greedy_suppress(conflicts, small=0)) == plain(graph.greedy_suppress(conflicts)) == plain(graph.greedy_suppress(conflicts, small=10**9))
    assert plain(graph.connected_components(linked, small=0)) == plain(graph.connected_components(linked, small=10**9))
    linked.unpersist()
    assert view(spark, sf, "det").count() > 0


def test_rings_in_suppression_runs_and_evaluation(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(80):
        at, size = rng.uniform(0, 20, 2), rng.uniform(2, 6)
        angles = np.sort(rng.uniform(0, 2 * np.pi, 5))
        points = [(float(at[0] + size * np.cos(a)), float(at[1] + size * np.sin(a))) for a in angles]
        xs, ys = zip(*points)
        rows.append((i, float(rng.uniform()), i % 3, "t", [*points, points[0]], min(xs), min(ys), max(xs), max(ys)))
    df = spark.createDataFrame(rows, "object_id long, score double, run_index long, tile string, ring array<struct<x:double,y:double>>, xmin double, ymin double, xmax double, ymax double")

    def share(i, j):
        only_i, only_j, both = polygons.boolean_areas(rows[i][4], rows[j][4])
        return both / (only_i + only_j + both)

    kept = []
    for i in sorted(range(80), key=lambda i: (-rows[i][1], i)):
        if all(share(i, j) < 0.3 for j in kept):
            kept.append(i)
    assert 10 < len(kept) < 75
    assert sorted(r.object_id for r in fusion.suppress(df, 0.3, 5.0, ring="ring").collect()) == sorted(kept)

    group = list(range(80))
    for i in range(80):
        for j in range(i):
            if i % 3 != j % 3 and share(i, j) >= 0.3:
                group = [min(group[i], group[j]) if g in (group[i], group[j]) else g for g in group]
    merged = fusion.merge_runs(df.withColumnRenamed("score", "segmenter_score"), 0.3, 5.0, ring="ring", agreement=False).collect()
    assert sorted(r.members for r in merged) == sorted(group.count(g) for g in set(group))
    best = {max((i for i in range(80) if group[i] == g), key=lambda i: rows[i][1]) for g in set(group)}
    assert sorted([(p.x, p.y) for p in r.ring] for r in merged) == sorted(rows[i][4] for i in best)

    found = evaluate.evaluate(df.where("object_id < 40").withColumnRenamed("object_id", "pred"), df.where("object_id >= 40").withColumnRenamed("object_id", "truth"), [0.3], 5.0, sizes=False, ring="ring").first()
    free, tp = set(range(40, 80)), 0
    for i in sorted(range(40), key=lambda i: (-rows[i][1], i)):
        near = [(-share(i, j), j) for j in free if share(i, j) >= 0.3]
        if near:
            free.discard(min(near)[1])
            tp += 1
    assert tp > 3 and (found.tp, found.fp, found.fn) == (tp, 40 - tp, 40 - tp)
