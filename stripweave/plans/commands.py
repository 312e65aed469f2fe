"""The commands: build a dataset, match its pairs, review, export, package, identify.

Decoding and model inference happen upstream; their outputs come as tables:

* ``video_info(path, filename, fps, width, height, frame_count)``
* ``frame_metrics(filename, frame_index, timestamp_seconds, sharpness, brightness, contrast,
  overexposed_ratio, strip_detected, dy)``, ``dy`` being the shift since the frame before
* ``bag_crops(filename, frame_index, bag_index_in_frame, crop_path, y1, y2, frame_height,
  segment_confidence, profile array<double>, descriptor array<float>)``
* ``ocr_payloads(filename, frame_index, bag_index_in_frame, payload, height)``, the reader's JSON

A command reads and writes tables of a catalog. Raw readings and merged items are separate
tables, so matching again gives the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULTS, Settings
from ..functions import scoring as S
from ..functions import text as T
from ..functions.kernels import seam_bands
from ..operators import grouping, identify, matching, review, sampling, sheets, tracking
from ..sources import readers, sinks
from ..sources.sinks import Catalog


class UnknownSides(ValueError):
    """Recordings without a configured side."""


def key_id(*columns: Column | str) -> Column:
    """A stable id from a natural key, so that tables built apart agree."""
    return F.xxhash64(*columns)


def build_dataset(catalog: Catalog, video_info: DataFrame, frame_metrics: DataFrame, bag_crops: DataFrame, ocr_payloads: DataFrame, settings: Settings = DEFAULTS, *, allow_unknown: bool = False, read_sides: tuple[str, ...] | None = None) -> DataFrame:
    """Process the recordings that aren't completed yet, then match all pairs; returns the run's counts.

    With ``read_sides`` only the payloads of those sides are read.
    """
    found = video_info.withColumn("stem", readers.stem(F.col("filename"))).withColumn("side", readers.side_of(F.col("stem"), settings.video_sides))
    if not allow_unknown and (missing := readers.unknown_sides(found, settings.video_sides)):
        raise UnknownSides(f"no side for: {', '.join(missing)}")
    todo = readers.unfinished(found, catalog.read("videos")) if catalog.exists("videos") else found
    todo = readers.with_duration(todo).withColumn("video_id", key_id("filename"))
    names = todo.select("filename", "video_id", F.col("stem").alias("video"), "side")

    frames = frame_metrics.join(names, "filename").withColumn("frame_id", key_id("filename", "frame_index"))
    frames = frames.withColumn("quality_score", S.quality(F.col("sharpness"), F.col("contrast"), F.col("overexposed_ratio")))
    frames = grouping.cumulative_pan(frames, ("video_id",)).drop("dy")
    catalog.upsert("frames", frames, ["video_id", "frame_index"])

    bags = bag_crops.join(frames.select("filename", "frame_index", "frame_id", "video_id", "video", "side", "timestamp_seconds", "quality_score"), ["filename", "frame_index"])
    bags = bags.withColumn("bag_id", key_id("filename", "frame_index", "bag_index_in_frame")).withColumn("center_norm", S.center(F.col("y1"), F.col("y2"), F.col("frame_height")))
    bags = bags.withColumn("bands", seam_bands(F.col("profile")))
    bags = bags.withColumns({"seam_positions": F.transform("bands", lambda b: b.position), "seam_position": F.get("bands", F.lit(0)).position, "seam_prominence": F.coalesce(F.get("bands", F.lit(0)).prominence, F.lit(0.0))})
    assigned = tracking.track(bags, settings)
    tracks = tracking.rollup(assigned, bags)
    bags = bags.join(assigned.select("bag_id", "track_key", "track_match_score"), "bag_id").join(tracks.select("track_key", "best_bag_id"), "track_key")
    bags = bags.withColumn("is_track_best", F.col("bag_id") == F.col("best_bag_id")).drop("best_bag_id", "profile", "bands", "descriptor")
    catalog.upsert("bags", bags, ["frame_id", "bag_index_in_frame"])
    catalog.upsert("bag_tracks", tracks, ["track_key"])
    read_labels(catalog, ocr_payloads, settings, sides=read_sides)
    catalog.upsert("videos", todo.withColumn("status", F.lit("completed")), ["filename"])
    rebuild_pairs(catalog, settings)
    return run_summary(catalog)


def read_labels(catalog: Catalog, ocr_payloads: DataFrame, settings: Settings = DEFAULTS, *, sides: tuple[str, ...] | None = None) -> None:
    """The readers' payloads as readings, headers and items of the bags they belong to."""
    bags = catalog.read("bags")
    bags = bags if sides is None else bags.where(F.col("side").isin(*sides))
    bags = bags.select("filename", "frame_index", "bag_index_in_frame", "bag_id", "seam_positions")
    read = ocr_payloads.join(bags, ["filename", "frame_index", "bag_index_in_frame"])
    boxes = readers.boxes_of(read.select(F.col("bag_id").alias("image_id"), "payload"))
    rows = sheets.rows_of_boxes(boxes, settings=settings)
    lines = rows.join(read.select(F.col("bag_id").alias("image_id"), "height"), "image_id").select(F.col("image_id").alias("reading_id"), F.col("row_no").alias("line_no"), "line", F.round(F.col("y") / F.col("height"), 4).alias("y"))
    confidence = rows.groupBy(F.col("image_id").alias("bag_id")).agg(sheets.mean_confidence(F.collect_list("score")).alias("mean_confidence"), F.count("*").alias("word_count"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_no", "line"))), lambda x: x.line), "\n").alias("raw_text"))
    found = sheets.sheets_by_seams(lines, read.select(F.col("bag_id").alias("reading_id"), "seam_positions").withColumnRenamed("seam_positions", "seams"))
    found = found.withColumnRenamed("reading_id", "bag_id").join(confidence, "bag_id").withColumn("ocr_result_id", key_id("bag_id", "sheet_index"))
    found = found.withColumn("normalized_text", T.normalized(F.col("raw_text")))
    found = found.withColumn("needs_review", S.reading_needs_review(F.col("mean_confidence"), F.size("items"), sheets.merged_line(F.col("items")), settings))
    catalog.upsert("ocr_results", found.drop("header", "items"), ["bag_id", "sheet_index"])
    catalog.upsert("label_headers", found.select("ocr_result_id", "header.*"), ["ocr_result_id"])
    catalog.replace_sets("label_items", found.select("ocr_result_id", F.inline_outer("items")).where("line_index is not null"), ["ocr_result_id"])


def _observations(catalog: Catalog, pairs: DataFrame) -> DataFrame:
    """Readings with their bag, header and items, by pair of recordings and side."""
    by_video = pairs.select("pair_key", F.explode(F.array(F.struct(F.col("pill_video").alias("video"), F.lit("pill").alias("of")), F.struct(F.col("label_video").alias("video"), F.lit("label").alias("of")))).alias("x")).select("pair_key", "x.*")
    item = F.struct("line_index", "quantity", "drug_name", "dose_value", "dose_unit", "raw_line")
    items = catalog.read("label_items").groupBy("ocr_result_id").agg(F.array_sort(F.collect_list(item)).alias("items"))
    rows = catalog.read("ocr_results").select("ocr_result_id", "bag_id", "mean_confidence").join(catalog.read("bags").select("bag_id", "video", "frame_index", "quality_score", "crop_path", "frame_id"), "bag_id")
    rows = rows.join(by_video, "video").join(catalog.read("label_headers").select("ocr_result_id", "dose_date", "dose_slot"), "ocr_result_id", "left").join(items, "ocr_result_id", "left")
    none = F.expr(f"cast(array() as array<{grouping.ITEM}>)")
    return grouping.with_center(rows.withColumn("items", F.coalesce("items", none)), ("pair_key", "of"))


def rebuild_pairs(catalog: Catalog, settings: Settings = DEFAULTS) -> DataFrame:
    """Match all configured pairs again from the stored readings; nothing is read anew."""
    spark = catalog.spark
    pairs = spark.createDataFrame([(p["pair_key"], p["pill_video"], p["label_video"], p.get("direction", "direct")) for p in settings.video_pairs], "pair_key string, pill_video string, label_video string, direction string")
    obs = _observations(catalog, pairs)
    pills = grouping.by_header(obs.where("of = 'pill'"), ("pair_key",), settings=settings)
    labels = grouping.by_header(obs.where("of = 'label'"), ("pair_key",), settings=settings)
    frames = catalog.read("frames")
    sides = pairs.select("pair_key", F.explode(F.array(F.struct(F.col("pill_video").alias("video"), F.lit("pill_side").alias("of")), F.struct(F.col("label_video").alias("video"), F.lit("label_side").alias("of")))).alias("x")).select("pair_key", "x.*")
    placed = frames.join(sides, "video").select("pair_key", F.col("of").alias("side"), "strip_detected", "cumulative_pan_px")
    bags = catalog.read("bags").join(frames.select("frame_id", "cumulative_pan_px"), "frame_id")
    labels = labels.join(bags.select(F.col("bag_id").alias("best_bag_id"), F.col("cumulative_pan_px").alias("position")), "best_bag_id", "left")
    own = bags.where("side = 'pill_side'").join(pairs.select("pair_key", F.col("pill_video").alias("video")), "video")
    photos = own.where("cumulative_pan_px is not null").select("pair_key", "bag_id", F.col("cumulative_pan_px").alias("position"))
    seams = grouping.by_seam(grouping.with_center(own, ("pair_key",)), ("pair_key",), settings)
    found = matching.match(pills, labels, photos, seams, placed, pairs, settings)
    merged = labels.select(F.col("ocr_result_id").alias("label_ocr"), "mean_confidence", "merged_items", "bag_ids")
    out = found.join(merged, "label_ocr", "left").withColumn("needs_review", S.pair_needs_review(F.col("status"), F.col("label_ocr"), F.size("merged_items"), F.col("mean_confidence"), settings))
    out = out.withColumn("track_pair_id", key_id("pair_key", "order_index")).select(
        "track_pair_id", "pair_key", "order_index", F.col("pill_track").alias("pill_track_key"), F.col("label_track").alias("label_track_key"), F.col("pill_bag").alias("pill_best_bag_id"), F.col("label_bag").alias("label_best_bag_id"),
        F.col("label_ocr").alias("label_ocr_result_id"), F.lit(None).cast("long").alias("pill_ocr_result_id"), "match_score", "status", "match_tier", F.col("mean_confidence").alias("ocr_confidence"), "needs_review", "merged_items", F.col("bag_ids").alias("label_bag_ids"),
    )
    catalog.write("track_pairs", out)
    written = catalog.read("track_pairs")
    catalog.write("merged_items", written.where("label_ocr_result_id is not null").select(F.col("label_ocr_result_id").alias("ocr_result_id"), F.inline("merged_items")))
    by_tier = pills.select("pair_key", "best_bag_id", "bag_ids", F.lit("direct").alias("of")).unionByName(seams.select("pair_key", "best_bag_id", "bag_ids", F.lit("order").alias("of")))
    by_tier = by_tier.withColumnRenamed("best_bag_id", "pill_best_bag_id")
    pill = written.where("pill_best_bag_id is not null").withColumn("of", F.when(F.col("match_tier") == "direct", "direct").when(F.col("match_tier") == "position", "alone").otherwise("order"))
    pill = pill.join(by_tier, ["pair_key", "pill_best_bag_id", "of"], "left").select("track_pair_id", F.lit("pill").alias("side"), F.explode(F.coalesce("bag_ids", F.array("pill_best_bag_id"))).alias("bag_id"))
    members = pill.unionByName(written.where("label_bag_ids is not null").select("track_pair_id", F.lit("label").alias("side"), F.explode("label_bag_ids").alias("bag_id")))
    catalog.write("pair_group_members", members.distinct())
    chosen = review.select_best(catalog.read("bags").drop("selected", "score"), settings.top_k)
    catalog.write("bags", chosen)
    return catalog.read("track_pairs")


def run_summary(catalog: Catalog) -> DataFrame:
    return review.run_counts(videos=catalog.read("videos"), frames=catalog.read("frames"), bags=catalog.read("bags"), ocr_results=catalog.read("ocr_results"), pairs=catalog.read("track_pairs"))


def _reviews(catalog: Catalog) -> tuple[DataFrame, DataFrame]:
    spark = catalog.spark
    decided = catalog.read("pair_reviews") if catalog.exists("pair_reviews") else spark.createDataFrame([], "track_pair_id long, decision string, reviewer_notes string, reviewed_at timestamp")
    items = catalog.read("pair_review_items") if catalog.exists("pair_review_items") else spark.createDataFrame([], "track_pair_id long, line_index int, quantity double, drug_name string, dose_value double, dose_unit string")
    return decided, items


def save_reviews(catalog: Catalog, decisions: DataFrame, items: DataFrame | None = None) -> None:
    """Decisions ``(track_pair_id, decision, reviewer_notes)``, and the corrected items of their pairs."""
    known = F.col("decision").isin("accepted", "corrected", "rejected", "pending")
    if bad := decisions.where(~known).limit(1).collect():
        raise ValueError(f"unknown decision: {bad[0]['decision']}")
    catalog.upsert("pair_reviews", decisions.withColumn("reviewed_at", F.current_timestamp()), ["track_pair_id"])
    if items is not None:
        old = catalog.read("pair_review_items") if catalog.exists("pair_review_items") else items.limit(0)
        catalog.write("pair_review_items", sinks.replace_sets(old, review.editor_items(items), ["track_pair_id"], emptied=decisions))


def _content(catalog: Catalog) -> DataFrame:
    pairs, bags = catalog.read("track_pairs"), catalog.read("bags").select(F.col("bag_id").alias("label_best_bag_id"), F.col("filename").alias("label_video_filename"))
    headers = catalog.read("label_headers").withColumnRenamed("ocr_result_id", "label_ocr_result_id")
    return pairs.select("track_pair_id", "label_best_bag_id", "label_ocr_result_id").join(bags, "label_best_bag_id").join(headers, "label_ocr_result_id", "left").select("track_pair_id", "label_video_filename", "dose_weekday", "dose_date", "dose_slot")


def export_reviews(catalog: Catalog, path: str) -> None:
    decided, items = _reviews(catalog)
    listed = items.groupBy("track_pair_id").agg(F.array_sort(F.collect_list(F.struct("line_index", "quantity", "drug_name", "dose_value", "dose_unit"))).alias("items"))
    rows = decided.join(_content(catalog), "track_pair_id", "left").join(listed, "track_pair_id", "left").drop("track_pair_id")
    rows.write.mode("overwrite").parquet(path)


def import_reviews(catalog: Catalog, path: str) -> DataFrame:
    """Apply exported decisions again by content; returns those whose pouch isn't found."""
    records = catalog.spark.read.parquet(path)
    found = review.reattach(records, _content(catalog))
    hits = found.where("track_pair_id is not null")
    one = hits.groupBy("track_pair_id").agg(F.max_by(F.struct("decision", "reviewer_notes", "items"), F.struct(F.coalesce("reviewed_at", F.lit(0).cast("timestamp")), "decision")).alias("r"))
    catalog.upsert("pair_reviews", one.select("track_pair_id", "r.decision", F.coalesce("r.reviewer_notes", F.lit("")).alias("reviewer_notes")).withColumn("reviewed_at", F.current_timestamp()), ["track_pair_id"])
    items = one.select("track_pair_id", F.inline("r.items"))
    catalog.replace_sets("pair_review_items", items, ["track_pair_id"])
    return found.where("track_pair_id is null").drop("track_pair_id")


def review_queue(catalog: Catalog, **filters) -> DataFrame:
    decided, _ = _reviews(catalog)
    return review.queue(catalog.read("track_pairs").drop("merged_items", "label_bag_ids"), catalog.read("bags"), catalog.read("ocr_results"), catalog.read("merged_items"), decided, **filters)


def export_dataset(catalog: Catalog, path: str | None = None, **options) -> DataFrame:
    """The final records; with a path also written as JSON lines."""
    decided, items = _reviews(catalog)
    pairs = catalog.read("track_pairs").drop("merged_items", "label_bag_ids")
    bags = catalog.read("bags").withColumn("seam_positions_json", F.to_json("seam_positions")).select("bag_id", "crop_path", "seam_position", "seam_positions_json")
    out = review.export_dataset(pairs, catalog.read("label_headers"), decided, items, catalog.read("merged_items"), catalog.read("pair_group_members"), bags, **options)
    if path:
        sinks.write_json(out.drop("track_pair_id"), path)
    return out


def package_dataset(catalog: Catalog, source: str, target: str) -> DataFrame:
    """Copy the photos that the export names; returns those that are missing."""
    return sinks.copy_files(catalog.spark, sampling.referenced_photos(export_dataset(catalog)), source, target)


def plan_sessions(spark: SparkSession, folder: str, metadata: DataFrame | None = None, settings: Settings = DEFAULTS) -> DataFrame:
    """Recordings of a folder in sessions of two."""
    found = readers.videos(spark, folder)
    said = metadata if metadata is not None else spark.createDataFrame([], "path string, creation_time string")
    return grouping.sessions(readers.capture_times(found, said), settings=settings)


def pouch_images(lines: DataFrame, frames: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Pixel intervals of every whole pouch that wasn't seen in an earlier frame: ``frames(reading_id, frame_index, height)``."""
    found = sheets.new_signatures(sheets.pouches(lines, settings).join(frames, "reading_id"))
    listed = found.groupBy("reading_id", "frame_index", "height").agg(F.array_sort(F.collect_list(F.struct("start", "end", "signature"))).alias("bounds"))
    crops = S.complete_crops(F.col("bounds"), F.col("height"), settings.margin_top, settings.margin_bottom)
    return listed.select("reading_id", "frame_index", F.explode(F.arrays_zip(F.col("bounds").signature.alias("signature"), crops.alias("crop"))).alias("x")).select("reading_id", "frame_index", "x.signature", "x.crop.y0", "x.crop.y1")


def identify_pills(pills: DataFrame, expected: DataFrame, registry: DataFrame, details: DataFrame, settings: Settings = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """The optimal assignment of each image's pills, and each pill's three best drugs.

    ``pills(image_id, pill_id, h, s, v, width, height)``, ``expected(image_id, spec)`` with ``Name:dose:quantity``.
    """
    spec = T.drug_spec(F.col("spec"))
    wanted = expected.select("image_id", spec.alias("x")).select("image_id", "x.*")
    seen = pills.select("image_id", "pill_id", S.color(F.col("h"), F.col("s"), F.col("v")).alias("color"), S.shape(S.aspect(F.col("width"), F.col("height"))).alias("shape"))
    found = identify.presentations(wanted, registry).join(wanted.groupBy("drug").agg(F.max("dose").alias("dose")), "drug")
    found = identify.soft_filter(found, F.when(F.length("dose") > 0, identify.fits_dose(F.col("name"), F.col("dose"))))
    looks = identify.appearances(found, details, most=settings.max_presentations, chars=settings.description_chars)
    shown = wanted.select("image_id", "drug").distinct().join(looks, "drug", "left").fillna({"description": "", "rank": 0})
    scores = identify.best_scores(seen, shown)
    return identify.assign(scores, wanted), identify.ranking(scores)


def annotation_batch(export: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The photo chosen for each pouch, and what each chosen photo covers."""
    index = sampling.photo_index(export)
    chosen = sampling.representatives(index)
    return chosen, sampling.coverage(chosen, index)

