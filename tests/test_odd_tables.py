"""Queries against their SQL on tables with missing values, ties and boxes that all but coincide."""

import duckdb
import pytest

from tessera.queries.registry import ORACLES, compared
from tessera.sources import files

from .test_queries import rows


def same_as_sql(spark, folder, name, **tables):
    """Whether a query gives its SQL's rows over tables that are given as DuckDB queries."""
    db = duckdb.connect()
    for t, text in tables.items():
        db.sql(f"COPY ({text}) TO '{folder}/{t}.parquet' (FORMAT parquet)")
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    got, want = rows(compared(name)(spark, str(folder)).toPandas()), rows(db.sql(ORACLES[name]).df())
    assert got[1] and got == want


#: Vectors of 64 numbers, the last tile of them without all of its five bands.
VECTORS = "SELECT CAST(i AS BIGINT) AS vec_id, list_transform(generate_series(1, 64), lambda j: CAST(sin(i * 64 + j) AS FLOAT)) AS embedding FROM range({n}) t(i)"


@pytest.mark.parametrize("n", [11, 13, 14])
@pytest.mark.parametrize("name", ["ras02_nir", "ras08_finite", "ras15_fixed_blend", "agg27_statistic_blend"])
def test_missing_bands(spark, tmp_path, name, n):
    same_as_sql(spark, tmp_path, name, embeddings=VECTORS.format(n=n))


def test_records_that_all_but_coincide(spark, tmp_path):
    """Copies of a record go; other records stay, on the same place and without a box too."""
    orders = """SELECT CAST(k AS BIGINT) AS o_orderkey, CAST(7 AS BIGINT) AS o_custkey, CAST(p AS DOUBLE) AS o_totalprice, o AS o_orderpriority
                FROM (VALUES (10, 100000, '1-URGENT'), (110, 100000, '1-URGENT'), (20, 100000, '1-URGENT'), (120, 100100, '1-URGENT'), (30, 0, '1-URGENT'), (31, -50000, '1-URGENT'),
                (40, NULL, '1-URGENT'), (NULL, 5, '1-URGENT'), (50, 100000, '2-HIGH'), (60, 100000, NULL), (1000000010, 100000, '1-URGENT')) t(k, p, o)"""
    same_as_sql(spark, tmp_path, "src19_csv_deduplicated", orders=orders)


def test_tiles_share_files(spark, tmp_path):
    """A file for each block of tiles, not one for each tile and task; every pixel comes back."""
    pixels = spark.range(64 * 700).selectExpr("id div 64 AS tile", "id % 64 div 8 AS row", "id % 8 AS col", "id / 7 AS red").repartition(4)
    files.write_tiles(pixels, f"{tmp_path}/tiles", tiles=100)
    assert len(list(tmp_path.glob("tiles/**/*.parquet"))) == 7
    back = spark.read.parquet(f"{tmp_path}/tiles").select("tile", "row", "col", "red")
    assert back.exceptAll(pixels).isEmpty() and back.count() == 64 * 700
