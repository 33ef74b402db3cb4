"""Annotation documents with images, annotations and categories, flattened, built, merged, aligned and cleaned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.storage import settle

#: Entries of a piece of a document, at most: some megabytes.
PIECE = 10_000
#: The document's schema.
SCHEMA = (
    "images array<struct<id:bigint,file_name:string,width:int,height:int>>,"
    "annotations array<struct<id:bigint,image_id:bigint,bbox:array<double>,segmentation:array<array<double>>,area:double,iscrowd:int,category_id:int,score:double>>,"
    "categories array<struct<id:int,name:string,supercategory:string>>"
)
#: Names of the folds elsewhere and here.
FOLDS = {"validation": "valid", "val": "valid", "valid": "valid", "train": "train", "test": "test"}


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, with its path."""
    return spark.read.schema(SCHEMA).json(path, multiLine=True).withColumn("path", F.input_file_name())


def parse(text: Column) -> Column:
    return F.from_json(text, SCHEMA)


def images(documents: DataFrame, key: str = "path") -> DataFrame:
    return documents.select(key, F.explode("images").alias("i")).select(key, F.col("i.id").alias("image_id"), "i.file_name", "i.width", "i.height")


def annotations(documents: DataFrame, key: str = "path") -> DataFrame:
    return documents.select(key, F.explode("annotations").alias("a")).select(key, F.col("a.id").alias("annotation_id"), *[F.col(f"a.{c}").alias(c) for c in ("image_id", "bbox", "segmentation", "area", "iscrowd", "category_id", "score")])


def build_documents(boxes: DataFrame, by: Sequence[str], image: str = "tile_path", key: str = "object_id") -> DataFrame:
    """One JSON document per group: images in name order from 1, annotations in key order from 1, boxes as x, y, width, height."""
    image_no = F.dense_rank().over(Window.partitionBy(*by).orderBy(image))
    rows = boxes.withColumn("image_id", image_no.cast("long")).withColumn("id", F.row_number().over(Window.partitionBy(*by).orderBy(key)).cast("long"))
    w, h = F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")
    note = F.struct("id", "image_id", F.array("xmin", "ymin", w, h).alias("bbox"), (w * h).alias("area"), F.lit(0).alias("iscrowd"), F.col("category_id").cast("int").alias("category_id"), F.col("score"))
    grouped = rows.groupBy(*by).agg(F.sort_array(F.collect_set(F.struct(F.col("image_id").alias("id"), F.col(image).alias("file_name")))).alias("images"), F.sort_array(F.collect_list(note)).alias("annotations"))
    return grouped.select(*by, F.to_json(F.struct("images", "annotations")).alias("document"), F.size("images").alias("n_images"), F.size("annotations").alias("n_annotations"))


def document_pieces(boxes: DataFrame, by: Sequence[str], image: str = "tile_path", key: str = "object_id", size: int = PIECE) -> DataFrame:
    """The documents of build_documents in pieces of bounded size: by, section, piece, n, document.

    A piece is a document of so many images, or of so many annotations; in the order of section (0: images,
    1: annotations) and piece they are the group's whole document. No task holds a group: images and annotations
    are numbered over ranges, and a piece is made of the rows of one number range.
    """
    from ..operators.fusion import numbered

    own, number = boxes, lambda df, order, name: _within(numbered(df.withColumn("_at", F.struct(*by, *order)), "_at", name).drop("_at"), by, name)
    names = number(settle(own.select(*by, image).distinct(), "images"), [image], "image_id")
    ids = names.select(*by, image, "image_id")
    rows = number(own.withColumn("_tie", F.monotonically_increasing_id()), [key, "_tie"], "id").drop("_tie")
    rows = rows.alias("r").join(ids.alias("i"), [F.col(f"r.{c}").eqNullSafe(F.col(f"i.{c}")) for c in (*by, image)]).select("r.*", "i.image_id")
    w, h = F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")
    note = F.struct("id", "image_id", F.array("xmin", "ymin", w, h).alias("bbox"), (w * h).alias("area"), F.lit(0).alias("iscrowd"), F.col("category_id").cast("int").alias("category_id"), F.col("score"))
    picture = F.struct(F.col("image_id").alias("id"), F.col(image).alias("file_name"))

    def pieces(df, order, section, name, entry):
        listed = df.groupBy(*by, F.floor((F.col(order) - 1) / size).alias("piece")).agg(F.sort_array(F.collect_list(entry)).alias(name))
        return listed.select(*by, F.lit(section).alias("section"), "piece", F.size(name).cast("long").alias("n"), F.to_json(F.struct(name)).alias("document"))

    return pieces(ids, "image_id", 0, "images", picture).unionByName(pieces(rows, "id", 1, "annotations", note))


def _within(df: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Numbers over all groups in order, as numbers from 1 in each group."""
    first = df.groupBy(*by).agg(F.min(name).alias("_first"))
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"f.{c}")) for c in by]
    return df.alias("d").join(first.alias("f"), same).select("d.*", "f._first").withColumn(name, F.col(name) - F.col("_first") + 1).drop("_first")


def merge_documents(documents: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
    """Images and annotations of all documents with dense new ids from 1, in document and old id order; raises on dangling image ids."""
    old_images, old_notes = images(documents, order), annotations(documents, order)
    dangling = old_notes.join(old_images, [order, "image_id"], "left_anti")
    if not dangling.isEmpty():
        raise ValueError("an annotation names an image that its document lacks")
    from ..operators.fusion import numbered

    position = F.concat_ws("/", F.lpad(F.col(order).cast("string"), 20, "0"), F.lpad(F.col("image_id").cast("string"), 20, "0"))
    new_images = numbered(old_images.withColumn("_at", position), "_at", "id", 1).drop("_at")
    position = F.concat_ws("/", F.lpad(F.col(order).cast("string"), 20, "0"), F.lpad(F.col("annotation_id").cast("string"), 20, "0"))
    new_notes = numbered(old_notes.withColumn("_at", position), "_at", "id", 1).drop("_at")
    ids = new_images.select(order, "image_id", F.col("id").alias("new_image_id"))
    return new_images, new_notes.join(ids, [order, "image_id"]).drop("image_id").withColumnRenamed("new_image_id", "image_id")


def align(truth_images: DataFrame, pred_images: DataFrame, preds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Images by the truth's names and ids, with whether they were predicted on; predictions under the truth's image ids, orphans dropped."""
    ids = truth_images.select("file_name", F.col("image_id").alias("truth_id")).join(pred_images.select("file_name", F.col("image_id").alias("pred_id")), "file_name", "left")
    aligned = ids.select("file_name", F.col("truth_id").alias("image_id"), F.col("pred_id").isNull().alias("dummy"))
    return aligned, preds.join(ids.where("pred_id is not null").select(F.col("pred_id").alias("image_id"), "truth_id"), "image_id").drop("image_id").withColumnRenamed("truth_id", "image_id")


def has_segmentation(polygons: Column) -> Column:
    """Any polygon of six numbers at least."""
    return F.coalesce(F.exists(polygons, lambda p: F.size(p) >= 6), F.lit(False))


def usable_area(area: Column) -> Column:
    """The area as a number, zero if it isn't one."""
    return F.coalesce(area.cast("string").try_cast("double"), F.lit(0.0))


def segmentation_documents(notes: DataFrame, key: str = "path") -> DataFrame:
    """Annotations of the documents that have a segmentation at all, and of them those with a valid one."""
    any_here = F.max(has_segmentation(F.col("segmentation")).cast("int")).over(Window.partitionBy(key))
    return notes.withColumn("_any", any_here).where((F.col("_any") == 1) & has_segmentation(F.col("segmentation"))).drop("_any")


def whole_records(notes: DataFrame, image: str = "image_id") -> DataFrame:
    """Annotations of the images whose annotations all have a segmentation."""
    return notes.join(notes.where(~has_segmentation(F.col("segmentation"))).select(image).distinct(), image, "left_anti")


def without_category(image_rows: DataFrame, notes: DataFrame, category: int, image: str = "image_id") -> tuple[DataFrame, DataFrame]:
    """A category's annotations go, higher ids move down, and images that lose all of theirs go too."""
    left = notes.where(F.col("category_id") != category).withColumn("category_id", F.col("category_id") - (F.col("category_id") > category).cast("int"))
    emptied = notes.select(image).distinct().join(left.select(image).distinct(), image, "left_anti")
    return image_rows.join(emptied, image, "left_anti"), left


def fold_name(name: Column) -> Column:
    out = F.lit(None).cast("string")
    for a, b in FOLDS.items():
        out = F.when(F.lower(name) == a, b).otherwise(out)
    return F.coalesce(out, name)


def nested_tiles(notes: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """One record per tile with parallel arrays of its annotations, in order."""
    listed = lambda c: F.transform(F.sort_array(F.collect_list(F.struct(order, c))), lambda x: x[c]).alias(c)
    return notes.groupBy(*by).agg(F.struct(*[listed(c) for c in ("bbox", "area", "iscrowd", "category")]).alias("annotations"))


def flatten_tiles(tiles: DataFrame, by: Sequence[str]) -> DataFrame:
    """The annotations of nested records, a row each, with their place."""
    zipped = F.arrays_zip("annotations.bbox", "annotations.area", "annotations.iscrowd", "annotations.category")
    return tiles.select(*by, F.posexplode(zipped).alias("place", "a")).select(*by, "place", "a.bbox", "a.area", "a.iscrowd", "a.category")


def dense_ids(rows: DataFrame, by: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Ids from 1 without gaps in each group."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
