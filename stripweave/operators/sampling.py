"""What to annotate: indexes, representatives, coverage, splits, task documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scoring as S
from ..functions import text as T


def pouch_key(pair_key: Column, order_index: Column) -> Column:
    return F.concat_ws("::", pair_key.cast("string"), order_index.cast("string"))


def key_parts(key: Column) -> tuple[Column, Column]:
    return F.substring_index(key, "::", 1), F.substring_index(key, "::", -1).cast("int")


def photo_index(export: DataFrame) -> DataFrame:
    """``(crop_path, pair_key, order_index, n_seams, at)``: which pouches each photo shows."""
    each = export.select("pair_key", "order_index", F.posexplode("pill_photos").alias("at", "photo"))
    return each.select(T.forward_slashes(F.col("photo.crop_path")).alias("crop_path"), "pair_key", "order_index", F.size("photo.seam_positions").alias("n_seams"), "at")


def representatives(index: DataFrame) -> DataFrame:
    """The photo of each pouch with the upper median of seams; equal numbers in their input order."""
    w = Window.partitionBy("pair_key", "order_index")
    ranked = index.withColumn("rn", F.row_number().over(w.orderBy("n_seams", "at")) - 1).withColumn("n", F.count("*").over(w))
    return ranked.where(F.col("rn") == F.floor(F.col("n") / 2)).select("pair_key", "order_index", "crop_path", "n_seams")


def coverage(chosen: DataFrame, index: DataFrame) -> DataFrame:
    """The pouches that each chosen photo covers, its own and those that share it."""
    photos = chosen.select("crop_path").distinct()
    key = pouch_key(F.col("pair_key"), F.col("order_index"))
    return index.join(photos, "crop_path").groupBy("crop_path").agg(F.array_sort(F.collect_set(key)).alias("pouches"))


def batch_document(covered: DataFrame) -> DataFrame:
    """The batch as JSON lines ``(crop_path, document)``: each photo to annotate, and what it covers."""
    return covered.select("crop_path", F.to_json(F.struct("crop_path", "pouches")).alias("document"))


def histogram(rows: DataFrame, size: Column) -> DataFrame:
    return rows.groupBy(size.cast("long").alias("size")).agg(F.count("*").alias("n"))


def referenced_photos(export: DataFrame) -> DataFrame:
    """Distinct photos in the order in which the manifest names them first."""
    each = photo_index(export)
    first = F.min(F.struct("pair_key", "order_index", "at"))
    return each.groupBy("crop_path").agg(first.alias("first"))


def against_files(photos: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Referenced photos that are among the files ``(path)``, and those that aren't."""
    on = F.col("crop_path") == F.col("path")
    return photos.join(files, on, "left_semi"), photos.join(files, on, "left_anti")


def draw(key: str, seed: int) -> Column:
    """A seeded draw, as hexadecimal digits that order like the number."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))


def split(rows: DataFrame, key: str, *, share: float = 0.15, seed: int = 42, group: str | None = None) -> DataFrame:
    """Adds ``split``: the given share of the units, at least one, goes to ``val`` by a seeded hash.

    Units are keys, or groups of them where given (no group is in both parts). The cut is the exact rank among
    the draws: a count by their first four digits says in which of 65,536 parts it is, and only that one is sorted.
    """
    unit = group or key
    units = rows.select(unit).where(F.col(unit).isNotNull()).distinct().withColumn("draw", draw(unit, seed)).withColumn("part", F.substring("draw", 1, 4))
    parts = sorted((r["part"], r["count"]) for r in units.groupBy("part").count().collect())
    left = max(1, int(share * sum(n for _, n in parts)))
    for part, n in parts:
        if left <= n:
            break
        left -= n
    else:
        return rows.withColumn("split", F.lit(None).cast("string"))
    last = units.where(F.col("part") == part).orderBy("draw", unit).limit(left).agg(F.max(F.struct("draw", unit)).alias("last")).first()["last"]
    own = draw(unit, seed)
    first = (own < last["draw"]) | ((own == last["draw"]) & (F.col(unit) <= last[unit]))
    return rows.withColumn("split", F.when(first, "val").otherwise("train"))


def sample(rows: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """``n`` rows by a seeded hash of their keys."""
    return rows.orderBy(draw(key, seed), key).limit(n)


def yolo_labels(images: DataFrame, annotations: DataFrame) -> DataFrame:
    """Label text of each image, a line for each polygon, empty without any; flat file names.

    ``images(image_id, file_name, width, height)``, ``annotations(annotation_id, image_id, polygon array<double>)``.
    """
    rows = annotations.join(images.select("image_id", "width", "height"), "image_id")
    numbers = F.transform(S.normalized_polygon(F.col("polygon"), F.col("width"), F.col("height")), lambda p: F.format_string("%.6f", p))
    line = F.concat(F.lit("0 "), F.array_join(numbers, " "))
    lines = rows.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("annotation_id", line.alias("line")))).alias("lines"))
    text = F.array_join(F.transform("lines", lambda x: x.line), "\n")
    flat = F.replace(T.from_bags(F.col("file_name")), F.lit("/"), F.lit("__"))
    return images.join(lines, "image_id", "left").select("image_id", flat.alias("flat_name"), F.coalesce(text, F.lit("")).alias("labels"))


def task_documents(photos: DataFrame, polygons: DataFrame, covered: DataFrame, export: DataFrame) -> DataFrame:
    """Annotation tasks as JSON: the picture, readable names of its pouches, and the predicted polygons in percent.

    ``photos(crop_path, width, height)``, ``polygons(crop_path, number, polygon array<double>)``.
    """
    names = F.array_join(F.transform("label_items", lambda x: x.drug_name), ", ")
    said = F.coalesce(F.col("patient_context.weekday"), F.lit("?")), F.coalesce(F.col("patient_context.date"), F.lit("?"))
    key = pouch_key(F.col("pair_key"), F.col("order_index"))
    readable = export.select(key.alias("pouch"), F.concat(key, F.lit(" | "), said[0], F.lit(" "), said[1], F.lit(" | "), names).alias("text"))
    texts = covered.select("crop_path", F.posexplode("pouches").alias("at", "pouch")).join(readable, "pouch")
    texts = texts.groupBy("crop_path").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x.text).alias("texts"))
    result = F.struct(
        F.concat(F.lit("pastilla_"), F.col("number")).alias("id"), F.lit("polygonlabels").alias("type"), F.lit("label").alias("from_name"), F.lit("image").alias("to_name"),
        F.col("width").alias("original_width"), F.col("height").alias("original_height"),
        F.struct(S.percent_points(F.col("polygon"), F.col("width"), F.col("height")).alias("points"), F.array(F.lit("pastilla")).alias("polygonlabels")).alias("value"),
    )
    found = polygons.join(photos, "crop_path").groupBy("crop_path").agg(F.transform(F.array_sort(F.collect_list(F.struct("number", result.alias("result")))), lambda x: x.result).alias("result"))
    rows = photos.join(texts, "crop_path", "left").join(found, "crop_path", "left")
    data = F.struct(F.concat(F.lit("/data/local-files/?d="), F.col("crop_path")).alias("image"), F.array_join("texts", "\n").alias("bolsitas_texto"), F.transform("texts", lambda t: F.struct(t.alias("value"))).alias("bolsitas_asociadas"))
    task = F.struct(data.alias("data"), F.array(F.struct(F.lit("masks").alias("model_version"), F.col("result"))).alias("predictions"))
    return rows.select("crop_path", F.to_json(task).alias("task"))


def adjacent_regions(pixels: DataFrame) -> DataFrame:
    """Distinct unordered pairs of regions with neighbouring pixels ``(image_id, x, y, region)``."""
    right = pixels.select("image_id", (F.col("x") - 1).alias("x"), "y", F.col("region").alias("other"))
    below = pixels.select("image_id", "x", (F.col("y") - 1).alias("y"), F.col("region").alias("other"))
    pairs = pixels.join(right.unionByName(below), ["image_id", "x", "y"]).where("region <> other and region > 0 and other > 0")
    return pairs.select("image_id", F.least("region", "other").alias("a"), F.greatest("region", "other").alias("b")).distinct()
