"""Incremental forms, run to the end of what is there."""

from pyspark.sql import functions as F

from ..plans.storage import settle, workspace
from ..streaming import flows
from ..views import duck, table, view
from .registry import matched, query, r


@query("stm01_new_files", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def _(s, d):
    source, out, marks = (workspace(s, n) for n in ("arrive", "done", "marks"))
    events = table(s, d, "events").select("event_id", "event_type")
    for half in (0, 1):  # two deliveries, the second after the first was worked off
        events.where(F.col("event_id") % 2 == half).write.mode("append").parquet(f"{source}/day={half}")
        flows.run_once(flows.arriving(s, source, events.schema), lambda b: b, out, marks).awaitTermination()
    return s.read.parquet(out).groupBy("event_type").agg(F.count("*").alias("n"))


@query("stm02_resume", "SELECT event_id FROM events WHERE event_id % 3 > 0")
def _(s, d):
    events = table(s, d, "events").select("event_id")
    done = settle(events.where("event_id % 3 = 0"), "done")
    return events.join(done, "event_id", "left_anti")


def sighted(position: int) -> str:
    """A CTE for DuckDB: the objects of a date with the crowns that they take from the date before."""
    near = f"near AS (SELECT k.crown AS a, o.object_id AS b, sqrt((k.x - o.x) * (k.x - o.x) + (k.y - o.y) * (k.y - o.y)) AS far FROM s{position - 1} k JOIN o ON o.position = {position} AND abs(k.x - o.x) <= 2 AND abs(k.y - o.y) <= 2), close AS (SELECT * FROM near WHERE far <= 2)"
    return f"s{position} AS MATERIALIZED (WITH {near}, {matched('close', 'far, a, b')} SELECT o.*, coalesce(m.a, concat('{position}_', o.object_id)) AS crown FROM o LEFT JOIN m ON m.b = o.object_id WHERE o.position = {position})"


DATES = 5
OBJECTS = duck("truth") + f", o AS MATERIALIZED (SELECT truth AS object_id, xmin AS x, ymin AS y, truth % {DATES} AS position FROM truth)"


@query("stm03_object_registry", OBJECTS + ", s0 AS (SELECT *, concat('0_', object_id) AS crown FROM o WHERE position = 0), " + ", ".join(sighted(p) for p in range(1, DATES)) + " " + " UNION ALL ".join(f"SELECT object_id, crown, position FROM s{p}" for p in range(DATES)))
def _(s, d):
    source, out, marks = (workspace(s, n) for n in ("objects", "registry", "marks"))
    t = view(s, d, "truth").select(F.col("truth").alias("object_id"), F.col("xmin").alias("x"), F.col("ymin").alias("y"), (F.col("truth") % DATES).alias("position"))
    for p in range(DATES):  # a delivery for each date
        t.where(F.col("position") == p).write.parquet(f"{source}/date={p}")
        flows.registry(flows.arriving(s, source, t.schema, files=1 << 20), out, marks).awaitTermination()
    return flows.registered(s, out).select("object_id", "crown", "position")


@query("stm04_side_output", "SELECT 'main' AS kind, count(*) AS n FROM events UNION ALL SELECT 'side', count(*) FROM events WHERE event_id % 10 = 0")
def _(s, d):
    source, out, side, marks = (workspace(s, n) for n in ("arrive", "main", "side", "marks"))
    events = table(s, d, "events").select("event_id")
    events.write.parquet(source)
    flows.run_once(flows.arriving(s, source, events.schema), lambda b: b, out, marks, [(lambda b: b.where("event_id % 10 = 0"), side)]).awaitTermination()
    counted = lambda p, k: s.read.parquet(p).agg(F.count("*").alias("n")).select(F.lit(k).alias("kind"), "n")
    return counted(out, "main").union(counted(side, "side"))


@query("stm05_daily_roll_up", f"SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n, {r('sum(value)')} AS total, {r('max(value)')} AS high FROM events GROUP BY ALL")
def _(s, d):
    rolled = flows.rolled_up(table(s, d, "events"), "ts", "value", ["event_type"])
    return rolled.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n", "total", "high")
