"""Sources: recordings in a folder, documents, tables of the catalog, ad-hoc SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import DEFAULTS, Settings

#: One list for every command; different commands used to know different ones.
VIDEO_FILES = "*.{mp4,MP4,mov,MOV,avi,AVI,m4v,M4V,mkv,MKV}"


def stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]+?)(?:\.[^./\\]*)?$", 1)


def videos(spark: SparkSession, folder: str) -> DataFrame:
    """The recordings below a folder by name, with file times; contents aren't read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", VIDEO_FILES).option("recursiveFileLookup", "true").load(folder)
    return found.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("filename"), stem(F.col("path")).alias("stem"), F.col("modificationTime").alias("modified"), "length")


def capture_times(found: DataFrame, metadata: DataFrame) -> DataFrame:
    """The time in a recording's metadata ``(path, creation_time text)``, else the file's, and which it is.

    Both become one timestamp type in the session's zone, so that mixed batches can be sorted.
    """
    rows = found.join(metadata, "path", "left").withColumn("meta", F.try_to_timestamp("creation_time"))
    return rows.select("path", "stem", F.coalesce("meta", "modified").alias("capture_time"), F.when(F.col("meta").isNotNull(), "metadata").otherwise("mtime").alias("time_source"))


def with_duration(info: DataFrame) -> DataFrame:
    return info.withColumn("duration_seconds", F.coalesce(F.try_divide(F.col("frame_count").cast("double"), F.nullif(F.col("fps"), F.lit(0.0))), F.lit(0.0)))


def sampled_frames(info: DataFrame, readable: DataFrame | None = None, settings: Settings = DEFAULTS, *, stop_at_gap: bool = False) -> DataFrame:
    """Every n-th frame of each recording, with its time: ``(video, frame_index, timestamp_seconds)``.

    The step is the wanted seconds in frames, at least 1, and 30 without a frame rate. Frames that aren't among
    the ``readable(video, frame_index)`` don't count for the limit; with ``stop_at_gap`` the first ends the sample.
    """
    step = F.when(F.col("fps") > 0, F.greatest(F.lit(1), F.bround(F.col("fps") * settings.sample_seconds).cast("int"))).otherwise(30)
    rows = info.where("frame_count > 0").select("video", "fps", F.explode(F.sequence(F.lit(0), F.col("frame_count") - 1, step)).alias("frame_index"))
    w = Window.partitionBy("video").orderBy("frame_index")
    if readable is not None:
        rows = rows.join(readable.select("video", "frame_index", F.lit(True).alias("ok")), ["video", "frame_index"], "left").withColumn("ok", F.coalesce("ok", F.lit(False)))
        kept = F.min("ok").over(w.rowsBetween(Window.unboundedPreceding, 0)) if stop_at_gap else F.col("ok")
        rows = rows.withColumn("kept", kept).where("kept").drop("kept", "ok")
    rows = rows.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= settings.max_frames)
    return rows.select("video", "frame_index", F.coalesce(F.try_divide("frame_index", F.nullif("fps", F.lit(0.0))), F.lit(0.0)).alias("timestamp_seconds"))


def side_of(stems: Column, sides: dict[str, str]) -> Column:
    if not sides:
        return F.lit("unknown")
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in sides.items() for x in kv)), stems), F.lit("unknown"))


def unknown_sides(found: DataFrame, sides: dict[str, str], show: int = 10) -> list[str]:
    """Up to ``show`` recordings whose side isn't configured."""
    rows = found.where(side_of(F.col("stem"), sides) == "unknown").select("stem").orderBy("stem").limit(show)
    return [r["stem"] for r in rows.collect()]


def unfinished(found: DataFrame, done: DataFrame) -> DataFrame:
    """Recordings that aren't completed on their side yet: ``done(filename, side, status)``."""
    return found.join(done.where("status = 'completed'").select("filename", "side"), ["filename", "side"], "left_anti")


def missing_pan(videos_: DataFrame, frames: DataFrame) -> DataFrame:
    """Completed recordings of which no frame has a position yet."""
    having = frames.where("cumulative_pan_px is not null").select("video_id").distinct()
    return videos_.where("status = 'completed'").join(having, "video_id", "left_anti").select("filename").distinct()


def by_stem(rows: DataFrame, wanted: str) -> DataFrame:
    """Rows of one recording, by its exact stem (a LIKE pattern would take its underscores for wildcards)."""
    return rows.where(stem(F.col("filename")) == wanted)


def json_documents(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", "true")
    return (reader.schema(schema) if schema else reader).json(path)


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What ``sinks.write_json`` wrote, with the columns of its folders; a line that is no JSON is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header, all text, a byte order mark taken off its first name."""
    rows = spark.read.option("header", "true").option("encoding", "UTF-8").csv(path)
    return rows.toDF(*(c.lstrip("﻿") for c in rows.columns))


def ad_hoc(spark: SparkSession, query: str, **args) -> DataFrame:
    """A parameterised query over the registered tables."""
    return spark.sql(query, args=args)


def first_existing(candidates: DataFrame, files: DataFrame) -> DataFrame:
    """For each key the first of its candidate paths ``(key, rank, path)`` that is among the files."""
    return candidates.join(files.select("path"), "path", "left_semi").groupBy("key").agg(F.min_by("path", "rank").alias("path"))


def boxes_of(payloads: DataFrame) -> DataFrame:
    """A reader's JSON payloads ``(image_id, payload)``, flat or under ``res``, as boxes."""
    from ..functions.text import payload_field

    texts = F.from_json(payload_field(F.col("payload"), "rec_texts"), "array<string>")
    scores = F.from_json(payload_field(F.col("payload"), "rec_scores"), "array<double>")
    polys = F.coalesce(F.from_json(payload_field(F.col("payload"), "rec_polys"), "array<array<array<double>>>"), F.expr("cast(array() as array<array<array<double>>>)"))
    rows = payloads.select("image_id", F.posexplode(F.arrays_zip(texts.alias("text"), scores.alias("score"), polys.alias("poly"))).alias("box_no", "box"))
    return rows.where("box.text is not null and box.score is not null").select("image_id", F.col("box_no").cast("long").alias("box_no"), "box.text", "box.score", "box.poly")
