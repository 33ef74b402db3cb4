"""Files, documents, contracts, models, streams."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import models, names, polygons
from tessera.plans import components as plan
from tessera.plans import config
from tessera.sources import annotations as ann
from tessera.sources import files, packages
from tessera.streaming import flows


def test_packages_round_trip(spark, tmp_path):
    boxes = spark.createDataFrame([("a", 1, 0.5, "x", 0.0, 0.0, 2.0, 3.0), ("b", 2, 0.25, "y", 1.0, 1.0, 2.0, 2.0)], "tile string, n int, s double, t string, xmin double, ymin double, xmax double, ymax double")
    packages.write_package(boxes, str(tmp_path), "tile", 32618).collect()
    rows = {r.fid: r for r in packages.read_packages(spark, f"file://{tmp_path}").where(F.col("path").endswith("a.gpkg")).collect()}
    r = rows[1]
    assert r.srid == 32618 and len(r.ring) == 5 and (r.ring[2].x, r.ring[2].y) == (2.0, 3.0)
    assert json.loads(r.attributes) == {"n": 1, "s": 0.5, "t": "x"}
    with pytest.raises(ValueError):
        packages.from_blob(b"no package at all")


def test_rasters_round_trip():
    bands = [[[1, 2, 3], [4, 5, 6]], [[7, 8, 9], [0, 1, 2]], [[9, 9, 9], [8, 8, 8]]]
    for deflate in (True, False):
        height, width, got, transform = files.raster_pixels(files.raster_bytes(bands, (0.5, 0, 100.0, 0, -0.5, 900.0), deflate))
        assert (height, width, got) == (2, 3, bands) and transform == (0.5, 0.0, 100.0, 0.0, -0.5, 900.0)
    assert files.is_corrupt(b"x" * 500) and files.is_corrupt(b"") and files.is_corrupt(files.raster_bytes(bands[:1], (1, 0, 0, 0, -1, 0)))


def document(images, notes):
    return json.dumps({"images": [{"id": i, "file_name": n} for i, n in images], "annotations": [{"id": i, "image_id": m, "bbox": [0, 0, 1, 1]} for i, m in notes]})


def test_documents_merge(spark):
    raw = spark.createDataFrame([(1, document([(7, "a"), (9, "b")], [(1, 9), (2, 7)])), (2, document([(7, "c")], [(1, 7)]))], "ord int, document string")
    parsed = raw.select("ord", ann.parse(F.col("document")).alias("x")).select("ord", "x.*")
    images, notes = ann.merge_documents(parsed, "ord")
    assert {r.file_name: r.id for r in images.collect()} == {"a": 1, "b": 2, "c": 3}
    assert sorted((r.id, r.image_id) for r in notes.collect()) == [(1, 2), (2, 1), (3, 3)]
    bad = spark.createDataFrame([(1, document([(1, "a")], [(1, 5)]))], "ord int, document string").select("ord", ann.parse(F.col("document")).alias("x")).select("ord", "x.*")
    with pytest.raises(ValueError):
        ann.merge_documents(bad, "ord")


def test_categories_go(spark):
    notes = spark.createDataFrame([(1, 1, 2), (2, 1, 3), (3, 2, 2), (4, 3, 1)], "id int, image_id int, category_id int")
    images, left = ann.without_category(spark.createDataFrame([(1,), (2,), (3,), (4,)], "image_id int"), notes, 2)
    assert sorted(r.image_id for r in images.collect()) == [1, 3, 4]
    assert sorted((r.id, r.category_id) for r in left.collect()) == [(2, 2), (4, 1)]


def test_xml(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<annotation><filename>a.tif</filename><object><name>Tree</name><bndbox><xmin>1</xmin><ymin>2</ymin><xmax>3</xmax><ymax>4</ymax></bndbox></object></annotation>")
    r = files.read_xml_boxes(spark, f"file://{tmp_path}").first()
    assert (r.file_name, r.xmin, r.ymax) == ("a.tif", 1.0, 4.0)


def test_dated_runs(spark):
    paths = spark.createDataFrame([(p,) for p in ("/o/20240101/a_inferfinal.gpkg", "/o/20240101/b_inferfinal.gpkg", "/o/x/c_inferfinal.gpkg", "/o/20240102/d.gpkg")], "path string")
    assert [(r.date, r.path) for r in files.dated_runs(paths).collect()] == [("20240101", "/o/20240101/b_inferfinal.gpkg")]


def test_tile_names(spark):
    df = spark.createDataFrame([("/x/site_tile_test_gr0p045_12_3.tif",), ("/x/site_a_tile_sf0p5_0_0.tif",), ("/x/odd.tif",)], "p string")
    got = [tuple(r) for r in df.select(*[c.alias(n) for n, c in names.parse_tile_name(F.col("p")).items()]).collect()]
    assert got == [("site", None, 0.045, "test"), ("site_a", 0.5, None, None), ("images", 1.0, None, None)]


def test_contracts(spark):
    needs = plan.Contract(frozenset(["objects"]), frozenset(["score"]), frozenset(), frozenset(["label"]))
    label = plan.Component("labels", needs, lambda s: plan.Result(s.tables["objects"].select("object_id", F.lit("x").alias("label"))))
    objects = spark.createDataFrame([(1, 0.5)], "object_id int, score double")
    assert plan.run_standalone(label, objects=objects).tables["objects"].columns == ["object_id", "score", "label"]
    with pytest.raises(plan.ContractError, match="column score"):
        plan.run_standalone(label, objects=objects.drop("score"))
    seen = []
    plan.Pipeline([label, label], persist=True, sinks=[lambda name, state: seen.append(name)]).run(plan.State({"objects": objects}))
    assert seen == ["0_labels", "1_labels"]


def test_config(tmp_path):
    from tessera.operators.fusion import AggregatorConfig

    (tmp_path / "a.json").write_text('{"weights": {"s": 1.0}, "nms_threshold": 0.7}')
    made = config.make(AggregatorConfig, config.load(config.find_config("a", [str(tmp_path)])))
    assert made.nms_threshold == 0.7
    for bad in ({"weights": {}, "unknown": 1}, {"weights": {}, "nms_threshold": 7}):
        with pytest.raises(ValueError):
            config.make(AggregatorConfig, bad)
    with pytest.raises(FileNotFoundError):
        config.find_config("missing", [str(tmp_path)])
    assert config.without_finished([("a", {}), ("b", {}), ("c", {})], ["a", "b"]) == [("c", {})]


def test_models(spark):
    assert "resnet" in models.CLASSIFIERS and len(models.DETECTORS.names()) == 7
    with pytest.raises(KeyError, match="resnet"):
        models.CLASSIFIERS.get("nothing")
    tiles = spark.createDataFrame([(f"t{i}",) for i in range(20)], "tile_path string")
    boxes = models.detect(tiles, "faster_rcnn")
    assert boxes.count() == models.detect(tiles, "retina_net").count() > 0
    assert models.segment(boxes, "sam").where("segmenter_score between 0.5 and 1").count() == boxes.count()
    with pytest.raises(ValueError):
        models.segment(boxes, "unet_treecrown")
    with pytest.raises(ValueError):
        models.segment_tiles(tiles, "sam")
    made = models.segment_tiles(tiles, "unet_treecrown").collect()
    assert len(made) == boxes.count()
    for r in made:
        points = [(p.x, p.y) for p in r.ring]
        assert points[0] == points[-1] and (min(points)[0], max(points)[0]) == (r.xmin, r.xmax)
        assert 0.6 < abs(polygons.signed_area(points[:-1])) / ((r.xmax - r.xmin) * (r.ymax - r.ymin)) < 1


def test_empty_masks_are_boxes_without_score(spark):
    models.SEGMENTERS.register("blank")(lambda: lambda tile: [(np.zeros((4, 4), bool), 0.9)])
    try:
        r = models.segment_tiles(spark.createDataFrame([("t",)], "tile_path string"), "blank").first()
    finally:
        del models.SEGMENTERS.items["blank"]
    assert (r.segmenter_score, r.xmin, r.ymin, r.xmax, r.ymax) == (0.0, 0.0, 0.0, 1.0, 1.0) and len(r.ring) == 5


def test_classifiers_take_the_best_class(spark):
    tiles = spark.createDataFrame([(f"t{i}",) for i in range(20)], "tile_path string")
    for r in models.classify(tiles, "tile_path", "swin").collect():
        assert r.classifier_score == max(r.classifier_scores)


def test_streams(spark, tmp_path):
    source, out, marks = (f"file://{tmp_path}/{n}" for n in ("in", "out", "marks"))
    rows = spark.createDataFrame([(i, f"k{i % 2}") for i in range(10)], "i long, k string")
    for part in ("i < 6", "i >= 6"):
        rows.where(part).coalesce(1).write.mode("append").parquet(source)
        flows.run_once(flows.arriving(spark, source, rows.schema), lambda b: b, out, marks).awaitTermination()
    assert spark.read.parquet(out).count() == 10


def crowns_of(spark, folder, deliveries, **how):
    """object_id and crown after each delivery of (object_id, x, y, position) was worked off."""
    source, out, marks = (f"file://{folder}/{n}" for n in ("in", "out", "marks"))
    for k, rows in enumerate(deliveries):
        df = spark.createDataFrame(rows, "object_id long, x double, y double, position long")
        df.coalesce(1).write.parquet(f"{source}/day={k}")
        flows.registry(flows.arriving(spark, source, df.schema), out, marks, **how).awaitTermination()
    return {r.object_id: r.crown for r in flows.registered(spark, out).collect()}


def test_registry_forgets(spark, tmp_path):
    crowns = crowns_of(spark, tmp_path, [[(1, 10.0, 10.0, 1), (2, 10.5, 10.0, 2), (3, 10.4, 10.0, 5), (4, 90.0, 90.0, 1)]])
    assert crowns[1] == crowns[2] != crowns[3] and crowns[4] not in (crowns[1], crowns[3])


@pytest.mark.parametrize("gap", [1, 2])
def test_registry_is_the_sequential_one(spark, tmp_path, gap):
    rng = np.random.default_rng(gap)
    deliveries, number = [], 0
    for days in ([0], [1, 2], [3], [5]):  # dates together, one without objects
        rows = []
        for day in days:
            for x, y in rng.uniform(-10, 10, (60, 2)).round(1):
                rows.append((number, float(x), float(y), day))
                number += 1
        deliveries.append(rows)
    expected, last = {}, {}
    for day in sorted({r[3] for rows in deliveries for r in rows}):
        here = [r for rows in deliveries for r in rows if r[3] == day]
        live = [(c, *at) for c, at in last.items() if 1 <= day - at[2] <= gap]
        near = sorted((far, c, o) for o, x, y, _ in here for c, kx, ky, _ in live if (far := float(np.sqrt((kx - x) ** 2 + (ky - y) ** 2))) <= 2.0)
        taken = {}
        for _, c, o in near:
            if c not in taken.values() and o not in taken:
                taken[o] = c
        for o, x, y, _ in here:
            expected[o] = taken.get(o, f"{day}_{o}")
            last[expected[o]] = (x, y, day)
    assert len(set(expected.values())) < len(expected)
    assert crowns_of(spark, tmp_path, deliveries, gap=gap) == expected


def test_late_events_and_sessions(spark):
    events = spark.createDataFrame([("2024-01-01 00:00:00", "a", 1.0), ("2024-01-01 00:10:00", "a", 2.0), ("2024-01-01 03:00:00", "a", 3.0)], "ts string, k string, v double").withColumn("ts", F.col("ts").cast("timestamp"))
    assert flows.rolled_up(events, "ts", "v", ["k"]).first().total == 6.0
    assert sorted(r.n for r in flows.sessions(events, "ts", "k").collect()) == [1, 2]


YAML = """---
# a pipeline
components_configs:
  - tilerizer:
      tile_type: tile   # a comment
      tile_size: 1777
      tile_overlap: 0.75
      names: ['a, b', "c: d", e#f]
      band: -1.5e-3
      none: ~
  - detector: detectors/one.yaml
  -
    aggregator:
      scores_weights: { 'detector_score': 1.0, nested: {x: [1, 2]} }
      edges:
      - 1
      - two words
      flag: true
      long: [1,
             2]
other: "it's"
empty: {}
"""


def test_yaml_subset(tmp_path):
    from tessera.plans import yaml_subset

    got = yaml_subset.loads(YAML)
    assert got == {
        "components_configs": [
            {"tilerizer": {"tile_type": "tile", "tile_size": 1777, "tile_overlap": 0.75, "names": ["a, b", "c: d", "e#f"], "band": -0.0015, "none": None}},
            {"detector": "detectors/one.yaml"},
            {"aggregator": {"scores_weights": {"detector_score": 1.0, "nested": {"x": [1, 2]}}, "edges": [1, "two words"], "flag": True, "long": [1, 2]}},
        ],
        "other": "it's", "empty": {},
    }
    assert yaml_subset.loads("") is None and yaml_subset.loads("- a\n- - b\n  - c") == ["a", ["b", "c"]]
    for bad in ("a: &x 1", "a: [1", "a:\n  b: 1\n c: 2", "a: 1\na: 2"):
        with pytest.raises(ValueError):
            yaml_subset.loads(bad)


def test_pipeline_files(tmp_path):
    from dataclasses import dataclass

    @dataclass
    class Any:
        model: str = ""
        size: int = 0

    for path, text in (("pipelines/main.yaml", "components_configs:\n  - detector: detectors/one\n  - detector:\n      size: 3"), ("detectors/one.yaml", "model: m"), ("old/pipeline.yaml", "components_configs: [{detector: {size: 4}}]")):
        (tmp_path / path).parent.mkdir(exist_ok=True)
        (tmp_path / path).write_text(text)
    for name in ("main", "main.yaml", "pipelines/main", str(tmp_path / "pipelines" / "main.yaml")):
        assert config.load_pipeline(name, {"detector": Any}, [str(tmp_path)]) == [("detector", Any("m", 0)), ("detector", Any("", 3))]
    assert config.load_pipeline("old", {"detector": Any}, [str(tmp_path)]) == [("detector", Any("", 4))]
    with pytest.raises(ValueError, match="no component detector"):
        config.load_pipeline("old", {"other": Any}, [str(tmp_path)])


def test_archives(spark, tmp_path):
    import io
    import tarfile
    import zipfile

    from tessera.sources import archives

    inner = io.BytesIO()
    with tarfile.open(fileobj=inner, mode="w:gz") as tar:
        info = tarfile.TarInfo("deep/x.txt")
        info.size = 2
        tar.addfile(info, io.BytesIO(b"hi"))
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("in.tar.gz", inner.getvalue())
        z.writestr("b/c.txt", "see")
    (tmp_path / "plain.txt").write_text("no archive")
    got = sorted((r.path, bytes(r.content)) for r in archives.read_archives(spark, str(tmp_path)).collect())
    assert got == [("b/c.txt", b"see"), ("in.tar.gz/deep/x.txt", b"hi")]
    assert len(archives.unpack(str(tmp_path / "a.zip"), str(tmp_path / "out"))) == 2
    assert (tmp_path / "out" / "in.tar.gz" / "deep" / "x.txt").read_bytes() == b"hi"
    with zipfile.ZipFile(tmp_path / "bad.zip", "w") as z:
        z.writestr("ok.txt", "")
        z.writestr("../out.txt", "")
    with pytest.raises(ValueError, match="leads out"):
        archives.unpack(str(tmp_path / "bad.zip"), str(tmp_path / "other"))
    assert not (tmp_path / "other").exists()
