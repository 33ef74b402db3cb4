"""Operators over pixels in long form: tile, row, col, bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import raster as r

_FIVE = {"blue": 0, "green": 1, "red": 2, "red_edge": 3, "nir": 4}
#: Band numbers by role of camera profiles, from 0, and other names of the profiles.
PROFILES = {
    "micasense_altum": _FIVE,
    "micasense_rededge_mx": _FIVE,
    "micasense_rededge_mx_dual": _FIVE,
    "micasense_altum_pt": _FIVE,
    "dji_p4_multispectral": _FIVE,
}
ALIASES = {"altum": "micasense_altum", "rededge_mx": "micasense_rededge_mx", "mx_dual": "micasense_rededge_mx_dual", "rededge_mx_dual": "micasense_rededge_mx_dual", "altum_pt": "micasense_altum_pt", "p4_multispectral": "dji_p4_multispectral"}
#: The means and deviations, in bytes, that a white balance aims at.
TARGET_MEANS = {"red": 73.1, "green": 88.2, "blue": 44.0}
TARGET_STDS = {"red": 55.2, "green": 58.2, "blue": 37.1}
#: Which simple methods a composite one is made of.
COMPOSITES = {"blend_wb_sc": ("gamma_wb", "scurve"), "stat_wt": ("linear", "gamma", "white_balance", "gamma_wb", "scurve")}


def profile_table(spark) -> DataFrame:
    """profile, role, band of all camera profiles and their other names: a small dimension."""
    rows = [(name, role, band) for name, bands in PROFILES.items() for role, band in bands.items()]
    rows += [(alias, role, band) for alias, name in ALIASES.items() for role, band in PROFILES[name].items()]
    return spark.createDataFrame(rows, "profile string, role string, band int")


def resolve_bands(requests: DataFrame, profiles: DataFrame) -> DataFrame:
    """Adds band: the request's own number if it has one, else the profile's for the role, names in any case."""
    dimension = profiles.select(F.col("profile").alias("_profile"), F.col("role").alias("_role"), F.col("band").alias("_band"))
    on = (F.lower(F.trim("profile")) == F.col("_profile")) & (F.lower("role") == F.col("_role"))
    return requests.join(F.broadcast(dimension), on, "left").withColumn("band", F.coalesce("user_band", "_band")).drop("_profile", "_role", "_band")


def block_average(pixels: DataFrame, k: int, values: Sequence[str], by: Sequence[str] = ("tile",)) -> DataFrame:
    """Means of k x k blocks: what an area-averaging reader gives."""
    block = lambda c: F.floor(F.col(c) / k).cast("int").alias(c)
    return pixels.groupBy(*by, block("row"), block("col")).agg(*[F.avg(v).alias(v) for v in values])


def band_statistics(pixels: DataFrame, bands: Sequence[str], by: Sequence[str] = ("tile",), low: float = 0.02, high: float = 0.98) -> DataFrame:
    """Per group the limits, mean and deviation of each band."""
    return pixels.groupBy(*by).agg(*[e for b in bands for e in (F.percentile(b, F.lit(low)).alias(f"{b}_low"), F.percentile(b, F.lit(high)).alias(f"{b}_high"), F.avg(b).alias(f"{b}_mean"), F.stddev_pop(b).alias(f"{b}_std"))])


def stretched(pixels: DataFrame, bands: Sequence[str], by: Sequence[str] = ("tile",)) -> DataFrame:
    """Bands stretched from their 2nd to their 98th percentile to 0..1; the statistics are a row per group and joined."""
    stats = band_statistics(pixels, bands, by)
    joined = pixels.join(stats, list(by))
    return joined.withColumns({b: r.stretch(F.col(b), F.col(f"{b}_low"), F.col(f"{b}_high")) for b in bands}).select(*pixels.columns)


def as_bytes(pixels: DataFrame, bands: Sequence[str]) -> DataFrame:
    return pixels.withColumns({b: r.to_byte(r.finite(F.col(b))) for b in bands})


def white_balanced(pixels: DataFrame, bands: Sequence[str], by: Sequence[str] = ("tile",), means: dict[str, float] = TARGET_MEANS, stds: dict[str, float] = TARGET_STDS) -> DataFrame:
    """Each band is stretched, then moved to the target mean and deviation; bytes, cut off and truncated."""
    full = stretched(pixels, bands, by).withColumns({b: F.col(b) * 255.0 for b in bands})
    stats = full.groupBy(*by).agg(*[e for b in bands for e in (F.avg(b).alias(f"{b}_mean"), F.stddev_pop(b).alias(f"{b}_std"))])
    moved = {b: F.least(F.greatest((F.col(b) - F.col(f"{b}_mean")) * (stds[b] / (F.col(f"{b}_std") + 1e-9)) + means[b], F.lit(0.0)), F.lit(255.0)).cast("int") for b in bands}
    return full.join(stats, list(by)).withColumns(moved).select(*pixels.columns)


def enhancements(pixels: DataFrame, methods: Sequence[str], bands: Sequence[str] = ("red", "green", "blue"), by: Sequence[str] = ("tile",)) -> DataFrame:
    """A row of bytes per method and pixel. Composite methods are built on the plans of the simple ones."""
    plans: dict[str, DataFrame] = {}

    def made(name: str) -> DataFrame:
        linear = stretched(pixels, bands, by)
        if name == "linear":
            return as_bytes(linear, bands)
        if name == "gamma":
            return as_bytes(linear.withColumns({b: r.gamma(F.col(b)) for b in bands}), bands)
        if name == "white_balance":
            return white_balanced(pixels, bands, by)
        if name == "gamma_wb":
            return white_balanced(linear.withColumns({b: r.gamma(F.col(b)) for b in bands}), bands, by)
        if name == "scurve":
            return as_bytes(linear.withColumns({b: r.sigmoid_contrast(F.col(b)) for b in bands}), bands)
        if name == "cir":
            if "nir" not in pixels.columns:
                raise ValueError("cir needs a nir band")
            return as_bytes(stretched(pixels.withColumns({"red": F.col("nir"), "green": F.col("red"), "blue": F.col("green")}), bands, by), bands)
        if name == "blend_wb_sc":
            first, second = plan("gamma_wb"), plan("scurve").select(*by, "row", "col", *[F.col(b).alias(f"_{b}") for b in bands])
            return first.join(second, [*by, "row", "col"]).withColumns({b: r.blend(F.col(b), F.col(f"_{b}")) for b in bands}).select(*pixels.columns)
        if name == "stat_wt":
            images = None
            for source in COMPOSITES[name]:
                own = plan(source).withColumn("method", F.lit(source))
                images = own if images is None else images.unionByName(own)
            rest = [c for c in pixels.columns if c not in (*by, "row", "col", *bands)]
            return statistic_blend(images, bands, by).join(pixels.select(*by, "row", "col", *rest), [*by, "row", "col"]).select(*pixels.columns)
        raise ValueError(f"no enhancement {name}")

    def plan(name: str) -> DataFrame:
        if name not in plans:
            plans[name] = made(name)
        return plans[name]

    out = None
    for name in methods:
        own = plan(name).withColumn("method", F.lit(name))
        out = own if out is None else out.unionByName(own)
    return out


def statistic_blend(images: DataFrame, bands: Sequence[str], by: Sequence[str] = ("tile",), means: dict[str, float] = TARGET_MEANS, stds: dict[str, float] = TARGET_STDS, least: float | None = 1e-9) -> DataFrame:
    """The methods' bytes, weighted by how near each method's statistics are to the target; one row per pixel.

    Statistics are of the pixels that are positive in all bands; the distance is the
    sum of the squared relative differences of means and deviations. A method without
    such a pixel weighs next to nothing (``least``), or with None is left out; a pixel
    that no method with a weight has is missing.
    """
    positive = F.lit(True)
    for b in bands:
        positive = positive & (F.col(b) > 0)
    own = lambda b: F.when(positive, F.col(b).cast("double"))
    stats = images.groupBy(*by, "method").agg(*[e for b in bands for e in (F.avg(own(b)).alias(f"{b}_m"), F.stddev_pop(own(b)).alias(f"{b}_s"))])
    far = F.lit(0.0)
    for b in bands:
        far = far + F.pow((F.col(f"{b}_m") - means[b]) / (means[b] + 1e-9), F.lit(2.0)) + F.pow((F.col(f"{b}_s") - stds[b]) / (stds[b] + 1e-9), F.lit(2.0))
    weights = stats.select(*by, "method", F.coalesce(1 / (far + 1e-6), F.lit(least).cast("double")).alias("_w"))
    joined = images.join(weights, [*by, "method"])
    mixed = lambda b: (F.sum(F.col(b) * F.col("_w")) / F.sum("_w") + 1e-9).cast("int")  # noqa: E731  equal bytes stay what they are
    return joined.groupBy(*by, "row", "col").agg(*[mixed(b).alias(b) for b in bands])


def min_max_byte(pixels: DataFrame, value: str, by: Sequence[str] = ("tile",)) -> DataFrame:
    """A value per group from 0 to 255; zero where it doesn't vary."""
    stats = pixels.groupBy(*by).agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    scaled = F.when(F.col("_high") > F.col("_low"), (F.col(value) - F.col("_low")) / (F.col("_high") - F.col("_low"))).otherwise(0.0)
    return pixels.join(stats, list(by)).withColumn(value, r.to_byte(scaled)).drop("_low", "_high")


def ensemble_vote(probabilities: DataFrame, by: Sequence[str], run: str = "run", value: str = "probability", threshold: float = 0.5) -> DataFrame:
    """Per pixel the mean over runs, and whether it reaches the threshold."""
    mean = probabilities.groupBy(*by).agg(F.avg(value).alias("mean"), F.count_distinct(run).alias("runs"))
    return mean.withColumn("mask", (F.col("mean") >= threshold).cast("int"))


def best_run(scores: DataFrame, key: str, run: str = "run", score: str = "score") -> DataFrame:
    """The run with the best mean score for each key, the first one among equals."""
    means = scores.groupBy(key, run).agg(F.avg(score).alias("mean"))
    return means.groupBy(key).agg(F.max_by(run, F.struct("mean", -F.col(run))).alias(run), F.max("mean").alias("mean"))


def window_average(pixels: DataFrame, window: int, step: int, size: int, value: str = "value", by: Sequence[str] = ("tile",)) -> DataFrame:
    """Each pixel's mean over the sliding windows that hold it, each window weighing its pixels by its own mean prediction."""
    starts = F.array(*map(F.lit, window_starts(size, window, step)))
    held = lambda c: F.explode(F.filter(starts, lambda s: (s <= F.col(c)) & (F.col(c) < s + window)))
    dealt = pixels.withColumn("wr", held("row")).withColumn("wc", held("col"))
    means = dealt.withColumn("prediction", F.col(value) - F.avg(value).over(Window.partitionBy(*by, "wr", "wc")))
    return means.groupBy(*by, "row", "col").agg(F.avg("prediction").alias("prediction"), F.count("*").alias("windows"))


def window_starts(size: int, window: int, step: int) -> list[int]:
    """Regular starts, and the last one that fits."""
    return sorted({*range(0, max(size - window, 0) + 1, step), max(size - window, 0)})


def band_checks(pixels: DataFrame, roles: Sequence[str] = ("red", "green", "blue")) -> DataFrame:
    """One row: whether the bands are there, in 0..255 and whole."""
    there = [c for c in roles if c in pixels.columns]
    within = [F.min(c).alias(f"{c}_min") for c in there] + [F.max(c).alias(f"{c}_max") for c in there]
    whole = [F.count_if(F.col(c) != F.floor(c)).alias(f"{c}_odd") for c in there]
    found = pixels.agg(*within, *whole, F.count("*").alias("pixels"))
    ok: Column = F.lit(len(there) == len(roles))
    for c in there:
        ok = ok & F.coalesce((F.col(f"{c}_min") >= 0) & (F.col(f"{c}_max") <= 255) & (F.col(f"{c}_odd") == 0), F.lit(False))
    return found.withColumn("valid", ok)


def require_bands(pixels: DataFrame, roles: Sequence[str] = ("red", "green", "blue")) -> None:
    """Raises if the bands are missing or aren't bytes."""
    if not band_checks(pixels, roles).first()["valid"]:
        raise ValueError(f"the raster needs byte bands {', '.join(roles)}")


def blank_tiles(pixels: DataFrame, bands: Sequence[str], most_black: float = 0.8, white: float = 255.0, by: Sequence[str] = ("tile",)) -> DataFrame:
    """Tiles that are black but for a little, or all white."""
    black, bright = F.lit(True), F.lit(True)
    for b in bands:
        black, bright = black & (F.col(b) == 0), bright & (F.col(b) >= white)
    shares = pixels.groupBy(*by).agg(F.avg(black.cast("double")).alias("black"), F.avg(bright.cast("double")).alias("white"))
    return shares.where((F.col("black") > most_black) | (F.col("white") == 1.0))


def local_maxima(pixels: DataFrame, value: str = "value", least: float = 0.0, by: Sequence[str] = ("tile",)) -> DataFrame:
    """Pixels above the limit that no neighbour of the eight exceeds, ties going to the first in row order."""

    def peaks(group):
        import numpy as np

        h, w = int(group.row.max()) + 1, int(group.col.max()) + 1
        grid = np.full((h + 2, w + 2), -np.inf)
        grid[group.row + 1, group.col + 1] = group[value]
        place = np.arange((h + 2) * (w + 2)).reshape(h + 2, w + 2)
        best = np.ones((h, w), bool)
        own, at = grid[1:-1, 1:-1], place[1:-1, 1:-1]
        for dy in (0, 1, 2):
            for dx in (0, 1, 2):
                if (dy, dx) != (1, 1):
                    other, there = grid[dy : dy + h, dx : dx + w], place[dy : dy + h, dx : dx + w]
                    best &= (own > other) | (own == other) & (at < there)
        return group[best[group.row, group.col] & (group[value] > least)]

    return pixels.groupBy(*by).applyInPandas(peaks, pixels.schema)


def label_regions(pixels: DataFrame, mask: str = "mask", by: Sequence[str] = ("tile",)) -> DataFrame:
    """Numbers of the 4-connected regions of set pixels in each tile, 0 for none."""

    def label(group):
        import numpy as np

        h, w = int(group.row.max()) + 1, int(group.col.max()) + 1
        grid = np.zeros((h, w), np.int64)
        grid[group.row, group.col] = np.where(group[mask] > 0, group.row * w + group.col + 1, 0)
        while True:  # the smallest number spreads within a region
            around = np.pad(grid, 1)
            spread = grid.copy()
            for other in (around[:-2, 1:-1], around[2:, 1:-1], around[1:-1, :-2], around[1:-1, 2:]):
                spread = np.where((other > 0) & (grid > 0), np.minimum(spread, other), spread)
            if (spread == grid).all():
                break
            grid = spread
        kinds = {v: i for i, v in enumerate(sorted(set(grid[grid > 0].tolist())), 1)}
        return group.assign(region=[kinds.get(int(v), 0) for v in grid[group.row, group.col]])

    from pyspark.sql.types import LongType, StructType

    return pixels.groupBy(*by).applyInPandas(label, StructType([*pixels.schema.fields]).add("region", LongType()))


def resize_nearest(pixels: DataFrame, height: int, width: int, new_height: int, new_width: int) -> DataFrame:
    """Nearest-neighbour resize by index arithmetic: each new pixel reads one old one."""
    rows = F.explode(F.sequence(F.lit(0), F.lit(new_height - 1)))
    cols = F.explode(F.sequence(F.lit(0), F.lit(new_width - 1)))
    new = pixels.select("tile").distinct().withColumn("new_row", rows).withColumn("new_col", cols)
    new = new.withColumn("row", F.floor((F.col("new_row") + 0.5) * height / new_height).cast("int")).withColumn("col", F.floor((F.col("new_col") + 0.5) * width / new_width).cast("int"))
    return new.join(pixels, ["tile", "row", "col"]).drop("row", "col").withColumnsRenamed({"new_row": "row", "new_col": "col"})
