"""Names of files, folders, products, thresholds and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def stem(path: Column) -> Column:
    """The file's name without its last extension."""
    return F.regexp_replace(basename(path), r"(.)\.[^.]*$", "$1")


def folder_key(number: Column, name: Column) -> Column:
    return F.concat_ws("_", number.cast("string"), name)


def folder_number(key: Column) -> Column:
    return F.split_part(key, F.lit("_"), F.lit(1)).try_cast("int") if hasattr(key, "try_cast") else F.split_part(key, F.lit("_"), F.lit(1)).cast("int")


def point_token(value: Column) -> Column:
    """0.045 as 0p045."""
    return F.replace(value.cast("string"), F.lit("."), F.lit("p"))


def padded_id(site: Column | str, number: Column, width: int = 6) -> Column:
    head = F.lit(site) if isinstance(site, str) else site
    return F.concat(head, F.lit("_"), F.lpad(number.cast("string"), width, "0"))


def is_date_folder(name: Column) -> Column:
    return name.rlike("^[0-9]{8}$")


def date_token(folder: Column, path: Column) -> Column:
    """The folder if it is a date, else the first eight characters of the file's stem."""
    return F.when(is_date_folder(folder), folder).otherwise(F.substring(stem(path), 1, 8))


def output_name(product: Column, fold: Column, scale: Column | None = None, gsd: Column | None = None, suffix: str = "infer") -> Column:
    """product_fold_[sf|gr]value_suffix with a p for the point; by scale if there is one, else by ground resolution."""
    by_scale = F.concat(F.lit("sf"), point_token(scale)) if scale is not None else F.lit(None).cast("string")
    by_gsd = F.concat(F.lit("gr"), point_token(gsd)) if gsd is not None else F.lit(None).cast("string")
    return F.concat_ws("_", product, fold, F.coalesce(by_scale, by_gsd), F.lit(suffix))


def parse_tile_name(path: Column) -> dict[str, Column]:
    """product, scale, gsd and area of interest of a tile's name; images, 1.0 and none where it doesn't tell."""
    pattern = r"^(.+)_tile_(?:([a-z0-9]+)_)?(sf|gr)([0-9]+p[0-9]+)_[0-9]+_[0-9]+$"
    name = stem(path)
    found = F.regexp_extract(name, pattern, 1)
    number = F.replace(F.nullif(F.regexp_extract(name, pattern, 4), F.lit("")), F.lit("p"), F.lit(".")).cast("double")
    kind = F.regexp_extract(name, pattern, 3)
    return {
        "product": F.when(found == "", "images").otherwise(found),
        "scale": F.when(kind == "sf", number).when(kind == "gr", F.lit(None).cast("double")).otherwise(1.0),
        "gsd": F.when(kind == "gr", number),
        "aoi": F.nullif(F.regexp_extract(name, pattern, 2), F.lit("")),
    }


def iou_label(thresholds: Column) -> Column:
    """Percent of the first and last threshold: 50:95, or 75 for one."""
    percent = lambda v: F.round(v * 100).cast("int").cast("string")
    return F.when(F.size(thresholds) == 1, percent(F.element_at(thresholds, 1))).otherwise(F.concat(percent(F.element_at(thresholds, 1)), F.lit(":"), percent(F.element_at(thresholds, -1))))


def parse_thresholds(text: Column) -> Column:
    """'0.5:0.95:0.05' as a sweep, '0.5,0.75' as a list, '0.5' as one."""
    parts = F.split(text, ":")
    number = lambda i: F.element_at(parts, i).cast("double")
    steps = F.floor((number(2) - number(1)) / number(3) + 1e-9).cast("int")
    sweep = F.transform(F.sequence(F.lit(0), steps), lambda k: F.round(number(1) + k * number(3), 6))
    return F.when(F.size(parts) == 3, sweep).otherwise(F.transform(F.split(text, ","), lambda x: F.trim(x).cast("double")))


def fixed_list(values: Column, digits: int = 2) -> Column:
    """Numbers with so many digits, joined by commas."""
    return F.array_join(F.transform(values, lambda v: F.format_string(f"%.{digits}f", v)), ",")
