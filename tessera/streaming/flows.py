"""Files that arrive, results that are written once, windows over time, and a registry of objects."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.graph import greedy_match
from ..operators.spatial import distance_join


def arriving(spark: SparkSession, path: str, schema, kind: str = "parquet", files: int = 16) -> DataFrame:
    """Files below a folder as they arrive, each once for a checkpoint."""
    return spark.readStream.schema(schema).format(kind).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files).load(path)


def run_once(stream: DataFrame, stage: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, side: Sequence[tuple[Callable[[DataFrame], DataFrame], str]] = ()) -> StreamingQuery:
    """Works off what is there and stops. A batch writes below its own number, so that a repeated one replaces itself; side results go along."""

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        for work, folder in ((stage, out), *side):
            work(batch).write.mode("overwrite").parquet(f"{folder}/batch={number}")
        batch.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def rolled_up(events: DataFrame, time: str, value: str, by: Sequence[str], width: str = "1 day", slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """count, sum and extremes of a value by window; events later than allowed are dropped on a stream."""
    timed = events.withColumn(time, F.col(time).cast("timestamp"))
    timed = timed.withWatermark(time, late) if events.isStreaming else timed
    window = F.window(time, width, slide) if slide else F.window(time, width)
    rolled = timed.groupBy(window.alias("w"), *by).agg(F.count("*").alias("n"), F.sum(value).alias("total"), F.min(value).alias("low"), F.max(value).alias("high"))
    return rolled.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n", "total", "low", "high")


def sessions(events: DataFrame, time: str, by: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Runs of a key's events without a longer gap."""
    timed = events.withColumn(time, F.col(time).cast("timestamp"))
    timed = timed.withWatermark(time, late) if events.isStreaming else timed
    rolled = timed.groupBy(F.session_window(time, gap).alias("w"), by).agg(F.count("*").alias("n"))
    return rolled.select(by, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


#: What the registry writes: a row for each sighting.
SIGHTINGS = "object_id long, crown string, x double, y double, batch long, position long"


def registry(objects: DataFrame, out: str, checkpoint: str, within: float = 2.0, gap: int = 1) -> StreamingQuery:
    """A standing list of objects as dates arrive, with columns object_id, crown, x, y, batch, position below ``out``.

    An object takes the identity of the nearest one last seen 1 to ``gap`` dates before and no further away than
    ``within``, each used once, ties to the smaller crown and then the smaller object_id. Others are new, and
    named after their date and object_id, which are not null and unique together. Nothing but the last ``gap``
    dates is read, so what isn't seen for longer is forgotten and comes back as new; no state is held besides the
    list. Objects of one date that arrive in several batches choose in that order. A repeated batch replaces
    itself. Matches are joins by place and greedy rounds over all of a date's objects, without borders.
    """
    spark = objects.sparkSession
    spark.createDataFrame([], "object_id long, crown string, x double, y double").write.mode("ignore").parquet(f"{out}/batch=-1/position=-1")

    def step(batch: DataFrame, number: int) -> None:
        batch.persist()
        for position in sorted(r.position for r in batch.select("position").distinct().collect()):
            here = batch.where(F.col("position") == position).select("object_id", "x", "y")
            seen = batch.sparkSession.read.schema(SIGHTINGS).parquet(out).where((F.col("position") >= position - gap) & ((F.col("batch") < number) | (F.col("position") < position)))
            last = seen.groupBy("crown").agg(F.max_by(F.struct("x", "y", "position"), "position").alias("s")).where(F.col("s.position") < position)
            near = distance_join(last.select("crown", "s.x", "s.y"), here, within).select(F.col("a_crown").alias("crown"), F.col("b_object_id").alias("object_id"), "distance")
            taken = greedy_match(near, ["distance", "crown", "object_id"], a="crown", b="object_id").select("object_id", "crown")
            own = F.concat_ws("_", F.lit(str(position)), "object_id")
            found = here.join(taken, "object_id", "left").select("object_id", F.coalesce("crown", own).alias("crown"), "x", "y")
            found.write.mode("overwrite").parquet(f"{out}/batch={number}/position={position}")
        batch.unpersist()

    return objects.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def registered(spark: SparkSession, out: str) -> DataFrame:
    """What a registry has written."""
    return spark.read.schema(SIGHTINGS).parquet(out)
