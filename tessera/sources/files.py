"""Tables in files, folders of dated runs, and rasters as rows of pixels."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import names


def round_trip(df: DataFrame, path: str, kind: str) -> DataFrame:
    """Writes and reads again as csv, json or parquet, with the schema given and never inferred."""
    options = {"csv": {"header": "true"}}.get(kind, {})
    df.write.format(kind).options(**options).mode("append").save(path)
    return df.sparkSession.read.format(kind).options(**options).schema(df.schema).load(path)


def write_tiles(pixels: DataFrame, path: str, by: str = "tile", tiles: int = 1024) -> None:
    """Pixels as a folder ``block`` for so many tiles each, a tile whole and in order in one file, its number a column.

    The rows of a block meet in one task first, so there is a file for each block and not one for each tile
    and task; files keep their tiles' range, so a reader of one tile skips the others.
    """
    block = F.floor(F.col(by) / tiles)
    dealt = pixels.withColumn("block", block).repartition("block").sortWithinPartitions("block", by, "row", "col")
    dealt.write.partitionBy("block").parquet(path)


def list_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """path and length of all files below a folder whose names fit; contents aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path).select("path", "length")


def read_xml_boxes(spark: SparkSession, path: str, transform: Sequence[float] | None = None) -> DataFrame:
    """file_name, name and box of each object of annotation files, in pixels or by an affine transform in world units."""
    box = "struct<xmin:double,ymin:double,xmax:double,ymax:double>"
    rows = spark.read.format("xml").option("rowTag", "annotation").schema(f"filename string, object array<struct<name:string,bndbox:{box}>>").load(path)
    flat = rows.select(F.col("filename").alias("file_name"), F.explode("object").alias("o")).select("file_name", "o.name", "o.bndbox.*")
    return world_boxes(flat, transform) if transform else flat


def world_boxes(boxes: DataFrame, transform: Sequence[float]) -> DataFrame:
    from ..functions import geometry as g

    x0, y0 = g.pixel_to_world(F.col("xmin"), F.col("ymin"), transform)
    x1, y1 = g.pixel_to_world(F.col("xmax"), F.col("ymax"), transform)
    return boxes.withColumns({"xmin": F.least(x0, x1), "ymin": F.least(y0, y1), "xmax": F.greatest(x0, x1), "ymax": F.greatest(y0, y1)})


def dated_runs(paths: DataFrame, marker: str = "inferfinal") -> DataFrame:
    """The last final file in each folder that is named by a date."""
    folder = F.element_at(F.split("path", "/"), -2)
    found = paths.withColumn("date", folder).where(names.is_date_folder(F.col("date")) & F.col("path").contains(marker))
    return found.groupBy("date").agg(F.max("path").alias("path"))


def latest_without(paths: DataFrame, by: str, word: str = "aoi") -> DataFrame:
    """The last path of each group whose file name lacks a word."""
    return paths.where(~F.lower(names.basename(F.col("path"))).contains(word)).groupBy(by).agg(F.max("path").alias("path"))


def latest_artefact(artefacts: DataFrame, kind: str = "kind", order: str = "component_id") -> DataFrame:
    return artefacts.groupBy(kind).agg(F.max_by("path", order).alias("path"))


def unprocessed(inputs: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What has no result yet."""
    return inputs.join(done.select(*keys).distinct(), list(keys), "left_anti")


def numbered_batches(rows: DataFrame, size: int, order: str, by: Sequence[str] = ()) -> DataFrame:
    """Adds batch: so many rows each, in order, within each group."""
    return rows.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(*by).orderBy(order)) - 1) / size).cast("int"))


# -- rasters: uncompressed or deflated GeoTIFF of one strip, enough for tiles ------------------------


def raster_bytes(bands: Sequence, transform: Sequence[float], deflate: bool = True) -> bytes:
    """A GeoTIFF of byte bands (lists of rows), pixel-interleaved, with its origin and pixel size."""
    height, width, n = len(bands[0]), len(bands[0][0]), len(bands)
    data = bytes(int(bands[b][y][x]) & 255 for y in range(height) for x in range(width) for b in range(n))
    data = zlib.compress(data) if deflate else data
    a, _, c, _, e, f = transform
    extra, at = b"", 8 + len(data) + (len(data) & 1)
    tags = [(256, 4, [width]), (257, 4, [height]), (258, 3, [8] * n), (259, 3, [8 if deflate else 1]), (262, 3, [2 if n >= 3 else 1]), (273, 4, [8]), (277, 3, [n]), (278, 4, [height]), (279, 4, [len(data)]), (284, 3, [1]), (33550, 12, [a, -e, 0.0]), (33922, 12, [0.0, 0.0, 0.0, c, f, 0.0])]
    entries = []
    for tag, kind, values in tags:
        raw = struct.pack(f"<{len(values)}{ {3: 'H', 4: 'I', 12: 'd'}[kind]}", *values)
        if len(raw) > 4:
            entries.append(struct.pack("<HHII", tag, kind, len(values), at + len(extra)))
            extra += raw
        else:
            entries.append(struct.pack("<HHI", tag, kind, len(values)) + raw.ljust(4, b"\0"))
    directory = at + len(extra)
    return struct.pack("<2sHI", b"II", 42, directory) + data + b"\0" * (len(data) & 1) + extra + struct.pack("<H", len(entries)) + b"".join(entries) + struct.pack("<I", 0)


def raster_pixels(content: bytes):
    """height, width, bands as lists of rows, and the affine transform, of what raster_bytes writes and plain strips of bytes."""
    order = {b"II": "<", b"MM": ">"}[content[:2]]
    (at,) = struct.unpack(order + "I", content[4:8])
    (count,) = struct.unpack_from(order + "H", content, at)
    tags = {}
    for i in range(count):
        tag, kind, n = struct.unpack_from(order + "HHI", content, at + 2 + 12 * i)
        code = {1: "B", 3: "H", 4: "I", 12: "d"}.get(kind)
        if code:
            size = struct.calcsize(code) * n
            place = at + 10 + 12 * i if size <= 4 else struct.unpack_from(order + "I", content, at + 10 + 12 * i)[0]
            tags[tag] = struct.unpack_from(f"{order}{n}{code}", content, place)
    data = b"".join(content[o : o + k] for o, k in zip(tags[273], tags[279], strict=True))
    data = zlib.decompress(data) if tags[259][0] in (8, 32946) else data
    width, height, n = tags[256][0], tags[257][0], tags.get(277, (1,))[0]
    bands = [[list(data[(y * width) * n + b : ((y + 1) * width) * n : n]) for y in range(height)] for b in range(n)]
    sx, sy, _ = tags.get(33550, (1.0, 1.0, 0.0))
    tie = tags.get(33922, (0.0,) * 6)
    return height, width, bands, (sx, 0.0, tie[3], 0.0, -sy, tie[4])


def read_rasters(spark: SparkSession, path: str, window: tuple[int, int, int, int] | None = None) -> DataFrame:
    """path, row, col, band, value of rasters below a folder; outside a raster a window of row, col, height, width is zero."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.tif").load(path).select("path", "content")

    def rows(batches) -> Iterator:
        for batch in batches:
            for name, content in zip(batch.path, batch.content, strict=True):
                height, width, bands, _ = raster_pixels(bytes(content))
                top, left, h, w = window or (0, 0, height, width)
                out = [(name, y, x, b, int(own[y][x]) if 0 <= y < height and 0 <= x < width else 0) for b, own in enumerate(bands) for y in range(top, top + h) for x in range(left, left + w)]
                yield pd.DataFrame(out, columns=["path", "row", "col", "band", "value"])

    return files.mapInPandas(rows, "path string, row int, col int, band int, value int")


def is_corrupt(content: bytes) -> bool:
    """Under a hundred bytes, unreadable, or fewer than three bands."""
    if content is None or len(content) < 100:
        return True
    try:
        return len(raster_pixels(bytes(content))[2]) < 3
    except (KeyError, IndexError, ValueError, struct.error, zlib.error):  # what raster_pixels raises on bytes that are no raster
        return True


def corrupt(content: Column) -> Column:
    """is_corrupt of a column of file contents."""

    def judge(batch: pd.Series) -> pd.Series:
        return batch.map(is_corrupt)

    return F.pandas_udf(judge, "boolean")(content)
