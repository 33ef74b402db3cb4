"""Domain tables derived from the driver's tables, the same in Spark and DuckDB.

Detections come from lineitem, truths from orders, areas from region, pixels from
embeddings, observations from events. Tiles lie on a grid 32 wide, a hundred metres
each, so density doesn't depend on the scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

_DET = """
SELECT object_id, tile, run_index, date_pos, orderkey, xmin, ymin, xmin + side AS xmax, ymin + side AS ymax, detector_score, segmenter_score, class,
       concat('tile_', CAST(tile AS VARCHAR(20)), '.tif') AS tile_path
FROM (SELECT ((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS object_id, l_suppkey AS tile, l_orderkey AS orderkey,
             CAST(l_linenumber - 1 AS BIGINT) AS run_index, CAST(l_linenumber AS BIGINT) AS date_pos,
             CAST((l_suppkey % 32) * 100 + l_partkey % 100 AS DOUBLE) AS xmin, CAST(floor(l_suppkey / 32) * 100 + l_orderkey % 100 AS DOUBLE) AS ymin,
             max(l_quantity) / 5 AS side, round(1 - 5 * max(l_discount), 6) AS detector_score, round(1 - 10 * max(l_tax), 6) AS segmenter_score, max(l_returnflag) AS class
      FROM lineitem GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey) q"""
_TRUTH = """
SELECT truth, tile, product, xmin, ymin, xmin + side AS xmax, ymin + side AS ymax
FROM (SELECT o_orderkey AS truth, CAST(floor(o_orderkey / 150) AS BIGINT) AS tile, o_orderpriority AS product,
             CAST(CAST(floor(o_orderkey / 150) AS BIGINT) % 32 * 100 + o_custkey % 100 AS DOUBLE) AS xmin,
             CAST(floor(floor(o_orderkey / 150) / 32) * 100 + (o_orderkey * 7) % 100 AS DOUBLE) AS ymin, o_totalprice / 50000 AS side FROM orders) q"""
_AOI = "SELECT CAST(r_regionkey AS BIGINT) AS area, CAST(r_regionkey * 640 + 20 AS DOUBLE) AS xmin, CAST(0 AS DOUBLE) AS ymin, CAST(r_regionkey * 640 + 600 AS DOUBLE) AS xmax, CAST(1000 AS DOUBLE) AS ymax FROM region"
_PX_SPARK = "SELECT vec_id AS tile, CAST(pos AS BIGINT) AS pos, CAST(v AS DOUBLE) AS v FROM embeddings LATERAL VIEW posexplode(embedding) t AS pos, v"
_PX_DUCK = "SELECT vec_id AS tile, unnest(generate_series(0, len(embedding) - 1)) AS pos, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings"
_PIXELS = 'SELECT tile, CAST(floor(pos / 8) AS BIGINT) AS "row", pos % 8 AS col, round((v + 1) / 2, 6) AS value FROM px'
_BANDS = 'SELECT CAST(floor(tile / 5) AS BIGINT) AS tile, CAST(floor(pos / 8) AS BIGINT) AS "row", pos % 8 AS col, ' + ", ".join(f"max(CASE WHEN tile % 5 = {i} THEN round((v + 1) / 2, 6) END) AS {b}" for i, b in enumerate(("blue", "green", "red", "red_edge", "nir"))) + " FROM px GROUP BY CAST(floor(tile / 5) AS BIGINT), pos"
_OBS = "SELECT user_id AS crown, CAST(ts AS DATE) AS day, event_type AS kind, avg(value) AS value, count(*) AS n FROM events GROUP BY user_id, CAST(ts AS DATE), event_type"
_METRICS = "SELECT l_suppkey % 7 AS location, l_returnflag AS product, CAST(l_linenumber AS BIGINT) AS run, avg(l_discount) * 10 AS f1, avg(l_tax) * 10 AS precision_50, count(*) AS num_truths, sum(CAST(l_quantity AS BIGINT)) AS tp FROM lineitem GROUP BY l_suppkey % 7, l_returnflag, l_linenumber"

#: name: (text, text in DuckDB if it differs, views that it reads)
VIEWS = {
    "det": (_DET, None, ()),
    "truth": (_TRUTH, None, ()),
    "aoi": (_AOI, None, ()),
    "px": (_PX_SPARK, _PX_DUCK, ()),
    "pixels": (_PIXELS, None, ("px",)),
    "bands": (_BANDS, None, ("px",)),
    "obs": (_OBS, None, ()),
    "metrics": (_METRICS, None, ()),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A domain table as a plan over the files."""
    text, _, needs = VIEWS[name]
    for need in needs:
        view(spark, sf_dir, need).createOrReplaceTempView(need)
    for base in TABLES:
        if f"FROM {base}" in text:
            table(spark, sf_dir, base).createOrReplaceTempView(base)
    return spark.sql(text.replace('"row"', "row").replace("VARCHAR(20)", "STRING"))


def duck(*names: str) -> str:
    """The views as the beginning of a query in DuckDB."""
    order: list[str] = []

    def add(name):
        for need in VIEWS[name][2]:
            add(need)
        if name not in order:
            order.append(name)

    for n in names:
        add(n)
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n][1] or VIEWS[n][0]})" for n in order) + " "
