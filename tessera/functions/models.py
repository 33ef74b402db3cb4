"""Models as batch functions: a registry, and deterministic stand-ins where weights aren't at hand.

Detectors turn a row into many, segmenters prompted by boxes or not add masks,
classifiers add class scores. Every model takes batches, so a real one loads once a task.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .polygons import RING, traced


class Registry:
    """Factories by name; several names may stand for one."""

    def __init__(self, kind: str):
        self.kind, self.items = kind, {}

    def register(self, *names: str) -> Callable:
        def keep(factory):
            for n in names:
                self.items[n] = factory
            return factory

        return keep

    def get(self, name: str) -> Callable:
        if name not in self.items:
            raise KeyError(f"no {self.kind} {name}; there are {', '.join(sorted(self.items)) or 'none'}")
        return self.items[name]

    def __contains__(self, name: str) -> bool:
        return name in self.items

    def names(self) -> list[str]:
        return sorted(self.items)


DETECTORS, SEGMENTERS, CLASSIFIERS, EMBEDDERS = (Registry(k) for k in ("detector", "segmenter", "classifier", "embedder"))
#: Segmenters that need boxes.
PROMPTED = frozenset(("sam", "sam2", "sam3"))


def _number(*parts) -> int:
    return zlib.crc32("/".join(map(str, parts)).encode())


@DETECTORS.register("faster_rcnn", "retina_net", "faster_rcnn_detectron2", "retinanet_detectron2", "dino_detrex", "detectree2", "deepforest")
def stub_detector(size: int = 100, most: int = 4) -> Callable[[str], list[tuple]]:
    """Boxes, scores and classes that depend on the tile's name alone."""

    def detect(tile: str) -> list[tuple]:
        out = []
        for i in range(_number(tile) % (most + 1)):
            n = _number(tile, i)
            x, y, w, h = n % (size - 20), n // 97 % (size - 20), 5 + n // 7 % 15, 5 + n // 11 % 15
            out.append((float(x), float(y), float(x + w), float(y + h), (n % 1000) / 1000, n % 2))
        return out

    return detect


@SEGMENTERS.register("sam", "sam2", "sam3")
def stub_segmenter(shrink: float = 0.1) -> Callable[[tuple], tuple]:
    """A box inside the given one, and a score."""

    def segment(box: tuple) -> tuple:
        x0, y0, x1, y1 = box
        dx, dy = (x1 - x0) * shrink, (y1 - y0) * shrink
        return x0 + dx, y0 + dy, x1 - dx, y1 - dy, round(0.5 + (_number(*box) % 500) / 1000, 3)

    return segment


@SEGMENTERS.register("unet_treecrown", "detectree2", "mask_rcnn_detectron2", "mask2former_detrex")
def stub_mask_segmenter(size: int = 100, most: int = 4) -> Callable[[str], list[tuple]]:
    """Masks of a whole tile and their scores, by the tile's name alone: an ellipse in each box that the stand-in detector finds."""
    found = stub_detector(size, most)
    rows, cols = np.mgrid[0:size, 0:size] + 0.5

    def segment(tile: str) -> list[tuple]:
        return [(((cols - (x0 + x1) / 2) / (x1 - x0)) ** 2 + ((rows - (y0 + y1) / 2) / (y1 - y0)) ** 2 <= 0.25, score) for x0, y0, x1, y1, score, _ in found(tile)]

    return segment


@CLASSIFIERS.register("resnet", "swin")
def stub_classifier(classes: int = 3) -> Callable[[str], list[float]]:
    def classify(name: str) -> list[float]:
        raw = [1 + _number(name, c) % 100 for c in range(classes)]
        return [v / sum(raw) for v in raw]

    return classify


def detect(tiles: DataFrame, model: str, **parameters) -> DataFrame:
    """tile_path, box, detector_score, detector_class, tile by tile."""
    factory = DETECTORS.get(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = factory(**parameters)
        for batch in batches:
            yield pd.DataFrame([(t, *d) for t in batch.tile_path for d in own(t)], columns=["tile_path", "xmin", "ymin", "xmax", "ymax", "detector_score", "detector_class"])

    return tiles.select("tile_path").mapInPandas(run, "tile_path string, xmin double, ymin double, xmax double, ymax double, detector_score double, detector_class int")


def segment(boxes: DataFrame, model: str, **parameters) -> DataFrame:
    """The prompts' rows with the segmenter's box and segmenter_score; only for models that take prompts."""
    if model not in PROMPTED:
        raise ValueError(f"{model} takes no prompts")
    factory = SEGMENTERS.get(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = factory(**parameters)
        for batch in batches:
            made = [own(b) for b in zip(batch.xmin, batch.ymin, batch.xmax, batch.ymax, strict=True)]
            yield batch.assign(**{c: [float(m[i]) for m in made] for i, c in enumerate(("xmin", "ymin", "xmax", "ymax", "segmenter_score"))})

    return boxes.drop("segmenter_score").mapInPandas(run, f"{', '.join(f'`{n}` {t}' for n, t in boxes.drop('segmenter_score').dtypes)}, segmenter_score double")


def segment_tiles(tiles: DataFrame, model: str, **parameters) -> DataFrame:
    """tile_path, ring, box, segmenter_score: new objects, for models that take no prompts. Masks become rings within the task that made them.

    An empty mask is a box of one pixel in the tile's corner with score 0.
    """
    if model in PROMPTED:
        raise ValueError(f"{model} takes prompts")
    factory = SEGMENTERS.get(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = factory(**parameters)
        for batch in batches:
            out = []
            for tile in batch.tile_path:
                for mask, score in own(tile):
                    outline = traced(mask)
                    if not outline:
                        outline, score = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)], 0.0
                    xs, ys = zip(*outline)
                    ring = [{"x": float(x), "y": float(y)} for x, y in outline]
                    out.append((tile, ring, float(min(xs)), float(min(ys)), float(max(xs)), float(max(ys)), score))
            yield pd.DataFrame(out, columns=["tile_path", "ring", "xmin", "ymin", "xmax", "ymax", "segmenter_score"])

    return tiles.select("tile_path").mapInPandas(run, f"tile_path string, ring {RING}, xmin double, ymin double, xmax double, ymax double, segmenter_score double")


def classify(rows: DataFrame, name: str, model: str, **parameters) -> DataFrame:
    """The rows with classifier_scores, classifier_class and classifier_score."""
    factory = CLASSIFIERS.get(model)

    def batch(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = factory(**parameters)
        for names in batches:
            yield names.map(own)

    scores = F.pandas_udf(batch, "array<double>")(F.col(name))
    best = (F.array_position("classifier_scores", F.array_max("classifier_scores")) - 1).cast("int")
    return rows.withColumn("classifier_scores", scores).withColumn("classifier_class", best).withColumn("classifier_score", F.element_at("classifier_scores", F.col("classifier_class") + 1))
