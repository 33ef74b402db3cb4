"""Tile grids, per-object tiles, areas of interest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g
from .spatial import cover_ratio


def grid_count(length: Column, tile: int, step: int) -> Column:
    return F.greatest(F.ceil((length - tile) / step).cast("int"), F.lit(0)) + 1


def grid(rasters: DataFrame, tile: int, overlap: float = 0.0) -> DataFrame:
    """Tiles of rasters with width and height: col, row and origin; the last ones are moved in so that they fit."""
    step = max(1, int(tile * (1 - overlap)))
    origin = lambda at, size: F.least(at * step, F.greatest(size - tile, F.lit(0)))
    cols = F.explode(F.sequence(F.lit(0), grid_count(F.col("width"), tile, step) - 1)).alias("tile_col")
    rows = F.explode(F.sequence(F.lit(0), grid_count(F.col("height"), tile, step) - 1)).alias("tile_row")
    return rasters.select("*", cols).select("*", rows).withColumn("x", origin(F.col("tile_col"), F.col("width"))).withColumn("y", origin(F.col("tile_row"), F.col("height")))


def as_boxes(tiles: DataFrame, tile: int) -> DataFrame:
    return tiles.withColumns({"xmin": F.col("x").cast("double"), "ymin": F.col("y").cast("double"), "xmax": (F.col("x") + tile).cast("double"), "ymax": (F.col("y") + tile).cast("double")})


def labelled(tiles: DataFrame, labels: DataFrame, least: float, cell: float) -> DataFrame:
    """Pairs of tiles and the labels of which at least a share lies in them, with the label's box in the tile."""
    pairs = cover_ratio(tiles, labels, cell, least)
    cut = g.clip(g.box("b_"), g.box("a_"))
    inside = [(v - F.col(f"a_{s}")).alias(n) for v, s, n in zip(cut, ("xmin", "ymin", "xmin", "ymin"), ("x0", "y0", "x1", "y1"), strict=True)]
    return pairs.select("*", *inside)


def object_tiles(objects: DataFrame, size: float | None = None, buffer: float = 0.0, gsd: float = 1.0, padding: float = 0.0) -> DataFrame:
    """A tile for each object: of a fixed size around its centre, or its box with a buffer in pixels, or padded by a share of its sides."""
    b = g.box()
    if size is not None:
        x, y = g.centroid(b)
        half = size * gsd / 2
        tile = (x - half, y - half, x + half, y + half)
    else:
        dx, dy = (b[2] - b[0]) * padding + buffer * gsd, (b[3] - b[1]) * padding + buffer * gsd
        tile = (b[0] - dx, b[1] - dy, b[2] + dx, b[3] + dy)
    return objects.withColumns({f"tile_{s}": v for s, v in zip(g.SIDES, tile, strict=True)})


def areas_of_interest(bounds: DataFrame, config: dict | None) -> DataFrame:
    """name and box of each area: all of the bounds without a config, else bands of shares from the north.

    config: {"bands": {name: share, ...}} with shares that add up to 1, or {"table": DataFrame}.
    """
    if config is None:
        config = {"bands": {"all": 1.0}}
    if "table" in config:
        return config["table"]
    if "bands" not in config or abs(sum(config["bands"].values()) - 1) > 1e-9:
        raise ValueError("areas of interest need a table or bands whose shares add up to 1")
    out, done = [], 0.0
    x0, y0, x1, y1 = g.box()
    for name, share in config["bands"].items():
        top, bottom = y1 - (y1 - y0) * done, y1 - (y1 - y0) * (done + share)
        out.append(F.struct(F.lit(name).alias("name"), x0.alias("xmin"), bottom.alias("ymin"), x1.alias("xmax"), top.alias("ymax")))
        done += share
    return bounds.select(F.explode(F.array(*out)).alias("a")).select("a.*")
