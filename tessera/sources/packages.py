"""GeoPackage files as tables: a reader that opens each file where its row is processed, and a writer of small results."""

from __future__ import annotations

import os
import sqlite3
import struct
import tempfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def box_to_wkb(xmin: float, ymin: float, xmax: float, ymax: float) -> bytes:
    ring = [(xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax), (xmin, ymin)]
    return struct.pack("<BIII", 1, 3, 1, 5) + b"".join(struct.pack("<dd", *p) for p in ring)


def to_blob(wkb: bytes, srid: int) -> bytes:
    """Well-known binary behind the package's header, without an envelope."""
    return b"GP" + struct.pack("<BBi", 0, 1, srid) + wkb


def from_blob(blob: bytes) -> tuple[int, bytes]:
    """srid and well-known binary of a package's geometry."""
    if blob[:2] != b"GP":
        raise ValueError("not a GeoPackage geometry")
    flags = blob[3]
    (srid,) = struct.unpack(("<" if flags & 1 else ">") + "i", blob[4:8])
    return srid, blob[8 + (0, 32, 48, 48, 64)[flags >> 1 & 7] :]


def rings_of(wkb: bytes) -> list[list[tuple[float, float]]]:
    """All rings of a polygon or multipolygon."""

    def polygon(at):
        order = "<" if wkb[at] else ">"
        kind, n = struct.unpack_from(order + "II", wkb, at + 1)
        at += 9
        rings = []
        if kind % 1000 == 6:
            for _ in range(n):
                at, more = polygon(at)
                rings += more
            return at, rings
        if kind % 1000 != 3:
            raise ValueError(f"geometry type {kind} is no polygon")
        for _ in range(n):
            (m,) = struct.unpack_from(order + "I", wkb, at)
            points = struct.unpack_from(f"{order}{2 * m}d", wkb, at + 4)
            rings.append(list(zip(points[::2], points[1::2], strict=True)))
            at += 4 + 16 * m
        return at, rings

    return polygon(0)[1]


def read_packages(spark: SparkSession, path: str, layer: str | None = None) -> DataFrame:
    """path, layer, fid, srid, ring (the first one), attributes (JSON) of every feature of the packages under a path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gpkg").load(path).select("path", "content")

    def rows(batches) -> Iterator:
        import json

        import pandas as pd

        for batch in batches:
            for name, content in zip(batch.path, batch.content, strict=True):
                db = sqlite3.connect(":memory:")
                db.deserialize(bytes(content))
                out = []
                for table, column in db.execute("select table_name, column_name from gpkg_geometry_columns").fetchall():
                    if layer and table != layer:
                        continue
                    cursor = db.execute(f'select * from "{table}"')
                    names = [c[0] for c in cursor.description]
                    for row in cursor:
                        own = dict(zip(names, row, strict=True))
                        srid, wkb = from_blob(own.pop(column))
                        ring = [{"x": x, "y": y} for x, y in rings_of(wkb)[0]]
                        out.append((name, table, own.pop("fid", None), srid, ring, json.dumps({k: v for k, v in own.items() if not isinstance(v, bytes)})))
                db.close()
                yield pd.DataFrame(out, columns=["path", "layer", "fid", "srid", "ring", "attributes"])

    return files.mapInPandas(rows, "path string, layer string, fid long, srid int, ring array<struct<x:double,y:double>>, attributes string")


def package_bytes(rows: list[dict], layer: str, srid: int) -> bytes:
    """A package with one layer of boxes; the rows' other values are its attributes."""
    sides = ("xmin", "ymin", "xmax", "ymax")
    names = [k for k in (rows[0] if rows else {}) if k not in sides and k != "fid"]
    kinds = ["REAL" if any(isinstance(r[k], float) for r in rows) else "INTEGER" if all(isinstance(r[k], int) or r[k] is None for r in rows) else "TEXT" for k in names]
    db = sqlite3.connect(":memory:")
    db.executescript(
        "pragma application_id=1196444487; pragma user_version=10300;"
        "create table gpkg_spatial_ref_sys(srs_name text, srs_id integer primary key, organization text, organization_coordsys_id integer, definition text, description text);"
        "create table gpkg_contents(table_name text primary key, data_type text, identifier text, srs_id integer);"
        "create table gpkg_geometry_columns(table_name text, column_name text, geometry_type_name text, srs_id integer, z integer, m integer);"
    )
    db.execute("insert into gpkg_spatial_ref_sys values(?,?,?,?,?,?)", (f"EPSG:{srid}", srid, "EPSG", srid, "undefined", None))
    db.execute("insert into gpkg_contents values(?,?,?,?)", (layer, "features", layer, srid))
    db.execute("insert into gpkg_geometry_columns values(?,?,?,?,0,0)", (layer, "geom", "POLYGON", srid))
    db.execute(f'create table "{layer}"(fid integer primary key, geom blob{"".join(f", \"{n}\" {k}" for n, k in zip(names, kinds, strict=True))})')
    for i, r in enumerate(rows, 1):
        db.execute(f'insert into "{layer}" values({",".join("?" * (len(names) + 2))})', (r.get("fid", i), to_blob(box_to_wkb(*[float(r[s]) for s in sides]), srid), *[r[k] for k in names]))
    db.commit()
    out = db.serialize()
    db.close()
    return out


def write_package(boxes: DataFrame, path: str, by: str, srid: int = 32618) -> DataFrame:
    """Writes one package for each group (a tile, a product) into a mounted folder; returns by, path and rows.

    A group is what one package holds, and is gathered by one task; for tables
    without bound Parquet is the sink.
    """
    schema = f"{boxes.select(F.col(by).cast('string').alias(by)).schema.simpleString()[7:-1].replace(':', ' ')}, path string, n long"

    def write(group):
        import pandas as pd

        name = str(group[by].iloc[0])
        rows = group.drop(columns=[by]).to_dict("records")
        os.makedirs(path, exist_ok=True)
        with tempfile.NamedTemporaryFile(dir=path, delete=False, suffix=".part") as out:
            out.write(package_bytes(rows, "objects", srid))
        os.replace(out.name, f"{path}/{name}.gpkg")
        return pd.DataFrame({by: [name], "path": [f"{path}/{name}.gpkg"], "n": [len(rows)]})

    return boxes.groupBy(by).applyInPandas(write, schema)
