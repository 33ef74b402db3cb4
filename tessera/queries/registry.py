"""Where queries register, and how results are made comparable where they are held against SQL; the queries themselves return what they compute."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
#: Queries that are compared as they are.
EXACT: set[str] = set()
#: Keeps values that lie between two rounded ones, as means of rounded values often do, from going either way.
NUDGE = 2e-10


def comparable(df: DataFrame) -> DataFrame:
    """Whole numbers as long, others as double with six decimals."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("tinyint", "smallint", "int"):
            c = c.cast("long")
        elif kind in ("float", "double"):
            c = F.round(c.cast("double") + F.lit(NUDGE), 6) + F.lit(0.0)
        out.append(c.alias(name))
    return df.select(*out)


def query(name: str, sql: str | None = None, exact: bool = False) -> Callable[[Query], Query]:
    """Registers a query under a name; sql is DuckDB's for the same rows."""

    def keep(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries {name}")
        QUERIES[name] = f
        if exact:
            EXACT.add(name)
        if sql is not None:
            ORACLES[name] = sql
        return f

    return keep


def compared(name: str) -> Query:
    """The query, its numbers as comparisons with SQL need them."""
    f = QUERIES[name]
    return f if name in EXACT else lambda spark, sf_dir: comparable(f(spark, sf_dir))


def r(expression: str) -> str:
    """A rounded value in SQL, as comparable() rounds it."""
    return f"(round(CAST({expression} AS DOUBLE) + 2e-10, 6) + 0.0)"


def matched(edges: str, order: str, by: tuple[str, ...] = (), rounds: int = 12) -> str:
    """CTEs for DuckDB: m holds the edges (by, a, b, ...) of the CTE ``edges`` that the greedy 1:1 assignment picks."""
    part = lambda end: ", ".join([*by, end])
    same = lambda end: " AND ".join(f"p.{c} = e.{c}" for c in [*by, end])
    out = [f"e0 AS MATERIALIZED (SELECT * FROM {edges})"]
    for k in range(rounds):
        out.append(f"p{k} AS MATERIALIZED (SELECT * FROM e{k} QUALIFY row_number() OVER (PARTITION BY {part('a')} ORDER BY {order}) = 1 AND row_number() OVER (PARTITION BY {part('b')} ORDER BY {order}) = 1)")
        out.append(f"e{k + 1} AS MATERIALIZED (SELECT * FROM e{k} e WHERE NOT EXISTS (SELECT 1 FROM p{k} p WHERE {same('a')}) AND NOT EXISTS (SELECT 1 FROM p{k} p WHERE {same('b')}))")
    out.append("m AS (" + " UNION ALL ".join(f"SELECT * FROM p{k}" for k in range(rounds)) + ")")
    return ", ".join(out)


def suppressed(edges: str, by: tuple[str, ...] = (), rounds: int = 10) -> str:
    """CTEs for DuckDB: s holds the nodes (by, lo) that greedy suppression drops, from the CTE ``edges`` (by, hi, lo)."""
    own = ", ".join(by) + ", " if by else ""
    on = lambda x, y, e1, e2: " AND ".join([*(f"{x}.{c} = {y}.{c}" for c in by), f"{x}.{e1} = {y}.{e2}"])
    out = [f"c0 AS MATERIALIZED (SELECT {own}hi, lo FROM {edges})"]
    for k in range(rounds):
        out.append(f"d{k} AS MATERIALIZED (SELECT DISTINCT {own}lo FROM c{k} x WHERE NOT EXISTS (SELECT 1 FROM c{k} y WHERE {on('y', 'x', 'lo', 'hi')}))")
        out.append(f"c{k + 1} AS MATERIALIZED (SELECT * FROM c{k} x WHERE NOT EXISTS (SELECT 1 FROM d{k} y WHERE {on('y', 'x', 'lo', 'lo')}) AND NOT EXISTS (SELECT 1 FROM d{k} y WHERE {on('y', 'x', 'lo', 'hi')}))")
    out.append("s AS (" + " UNION ALL ".join(f"SELECT * FROM d{k}" for k in range(rounds)) + ")")
    return ", ".join(out)


def reached(edges: str) -> str:
    """CTEs for DuckDB: comp (node, component) of the CTE ``edges`` (a, b); the query needs WITH RECURSIVE."""
    return (
        f"l AS (SELECT a, b FROM {edges} UNION SELECT b, a FROM {edges}), "
        "r(node, other) AS (SELECT DISTINCT a, a FROM l UNION SELECT r.node, l.b FROM r JOIN l ON r.other = l.a), "
        "comp AS MATERIALIZED (SELECT node, min(other) AS component FROM r GROUP BY node)"
    )


IOU = "({i}) / ((a.xmax - a.xmin) * (a.ymax - a.ymin) + (b.xmax - b.xmin) * (b.ymax - b.ymin) - ({i}))"
COMMON = "greatest(least(a.xmax, b.xmax) - greatest(a.xmin, b.xmin), 0) * greatest(least(a.ymax, b.ymax) - greatest(a.ymin, b.ymin), 0)"
IOU_ADDED = IOU.replace(" - ({i}))", " - ({i}) + 1e-6)").format(i=COMMON)
IOU = IOU.format(i=COMMON)
MEET = "a.xmin < b.xmax AND b.xmin < a.xmax AND a.ymin < b.ymax AND b.ymin < a.ymax"


def cells(source: str, name: str, size: float = 10.0) -> str:
    """A CTE for DuckDB: the rows of a table for each grid cell that they touch."""
    at = lambda c: f"CAST(floor({c} / {size}) AS BIGINT)"
    return f"{name} AS MATERIALIZED (SELECT *, unnest(generate_series({at('xmin')}, {at('xmax')})) AS cx FROM (SELECT *, unnest(generate_series({at('ymin')}, {at('ymax')})) AS cy FROM {source}) q)"


def in_first_cell(size: float = 10.0) -> str:
    return f"a.cx = b.cx AND a.cy = b.cy AND {MEET} AND CAST(floor(greatest(a.xmin, b.xmin) / {size}) AS BIGINT) = a.cx AND CAST(floor(greatest(a.ymin, b.ymin) / {size}) AS BIGINT) = a.cy"
