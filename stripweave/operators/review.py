"""Human review as an overlay, and exports with provenance. Readings are never overwritten."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHORT_ITEM = "array<struct<drug_name: string, quantity: double, dose_value: double, dose_unit: string>>"


def item_counts(items: DataFrame) -> DataFrame:
    return items.groupBy("ocr_result_id").agg(F.count("*").alias("item_count"))


def queue(pairs: DataFrame, bags: DataFrame, ocr: DataFrame, items: DataFrame, reviews: DataFrame, *, decision: str | None = None, status: str | None = None, hide_empty: bool = True, sample: int | None = None, seed: int = 42) -> DataFrame:
    """Pairs for review with both sides' pictures and readings; filters as given, ``all`` or None meaning none.

    ``pending`` are undecided pairs and those decided as pending. Empty readings are hidden unless asked for. A
    sample is drawn by hashing the ids with the seed, so it is the same each time.
    """
    p = bags.select(F.col("bag_id").alias("pill_best_bag_id"), F.col("crop_path").alias("pill_image_path"), F.col("seam_position").alias("pill_seam_position"))
    q = bags.select(F.col("bag_id").alias("label_best_bag_id"), F.col("crop_path").alias("label_image_path"), F.col("seam_position").alias("label_seam_position"))
    op = ocr.select(F.col("ocr_result_id").alias("pill_ocr_result_id"), F.col("seam_side").alias("pill_seam_side"))
    ol = ocr.select(F.col("ocr_result_id").alias("label_ocr_result_id"), F.col("seam_side").alias("label_seam_side"))
    n = item_counts(items).withColumnRenamed("ocr_result_id", "label_ocr_result_id")
    rows = pairs.where(F.col("status") == status) if status and status != "all" else pairs
    rows = rows.join(p, "pill_best_bag_id", "left").join(q, "label_best_bag_id", "left").join(ol, "label_ocr_result_id", "left").join(op, "pill_ocr_result_id", "left")
    rows = rows.join(n, "label_ocr_result_id", "left").withColumn("item_count", F.coalesce("item_count", F.lit(0).cast("long")))
    rows = rows.join(reviews.select("track_pair_id", "decision", "reviewer_notes"), "track_pair_id", "left")
    if decision == "pending":
        rows = rows.where("decision is null or decision = 'pending'")
    elif decision and decision != "all":
        rows = rows.where(F.col("decision") == decision)
    if hide_empty:
        rows = rows.where("item_count > 0")
    if sample is not None:
        rows = rows.withColumn("draw", F.xxhash64("track_pair_id", F.lit(seed))).orderBy("draw", "track_pair_id").limit(sample).drop("draw")
    return rows


def decided(pairs: DataFrame, reviews: DataFrame) -> DataFrame:
    """``needs_review`` with the decisions applied; the pipeline's ``status`` stays."""
    d = reviews.select("track_pair_id", "decision")
    settled = F.col("decision").isin("accepted", "corrected")
    return pairs.join(d, "track_pair_id", "left").withColumn("needs_review", F.when(F.col("decision").isNull(), F.col("needs_review")).otherwise(~settled))


def summary(pairs: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row: counts by decision, total, reviewed, and pending (undecided and decided as pending)."""
    named = ("accepted", "corrected", "rejected", "pending")
    r = reviews.agg(*(F.count_if(F.col("decision") == d).alias(f"{d}_rows") for d in named), F.count("*").alias("reviewed"))
    both = r.crossJoin(pairs.agg(F.count("*").alias("total")))  # one row and one row
    return both.select(*(F.col(f"{d}_rows").alias(d) for d in named[:3]), "total", "reviewed", (F.col("total") - F.col("reviewed") + F.col("pending_rows")).alias("pending"))


def breakdown(export: DataFrame) -> DataFrame:
    """Counts by status, source and decision, most frequent first."""
    kinds = (("pipeline_status", F.col("pipeline_status")), ("label_source", F.col("label_source")), ("decision", F.coalesce("decision", F.lit("sin_revisar"))))
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), c.alias("value")) for k, c in kinds))).alias("x")
    return export.select(each).groupBy(F.col("x.kind").alias("kind"), F.col("x.value").alias("value")).agg(F.count("*").alias("n"))


def export_reviews(reviews: DataFrame, pairs: DataFrame, bags: DataFrame, frames: DataFrame, videos: DataFrame, headers: DataFrame, items: DataFrame) -> DataFrame:
    """Each decision with what identifies its pouch by content, and its corrected items in order."""
    listed = items.groupBy("track_pair_id").agg(F.array_sort(F.collect_list(F.struct("line_index", "quantity", "drug_name", "dose_value", "dose_unit"))).alias("items"))
    rows = reviews.join(pairs.select("track_pair_id", "label_best_bag_id", "label_ocr_result_id"), "track_pair_id")
    rows = rows.join(bags.select(F.col("bag_id").alias("label_best_bag_id"), "frame_id"), "label_best_bag_id", "left")
    rows = rows.join(frames.select("frame_id", "video_id"), "frame_id", "left").join(videos.select("video_id", F.col("filename").alias("label_video_filename")), "video_id", "left")
    rows = rows.join(headers.select(F.col("ocr_result_id").alias("label_ocr_result_id"), "dose_weekday", "dose_date", "dose_slot"), "label_ocr_result_id", "left")
    rows = rows.join(listed, "track_pair_id", "left")
    return rows.select("label_video_filename", "dose_weekday", "dose_date", "dose_slot", "decision", "reviewer_notes", "items")


def reattach(records: DataFrame, pairs: DataFrame) -> DataFrame:
    """Exported decisions found again by recording and header, nulls being equal; ``track_pair_id`` null where they aren't.

    ``pairs(track_pair_id, label_video_filename, dose_weekday, dose_date, dose_slot)``. Of several pairs with the
    same content the smallest id gets the decision.
    """
    content = ("dose_weekday", "dose_date", "dose_slot")
    one = pairs.groupBy("label_video_filename", *content).agg(F.min("track_pair_id").alias("track_pair_id"))
    same = F.col("r.label_video_filename") == F.col("p.label_video_filename")
    for c in content:
        same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"p.{c}"))
    return records.alias("r").join(one.alias("p"), same, "left").select("r.*", "p.track_pair_id")


def photos_of(members: DataFrame, bags: DataFrame, side: str = "pill") -> DataFrame:
    """The photos of each pair's side in the order of their ids, each with all its seams."""
    photo = F.struct("bag_id", "crop_path", "seam_position", seam_positions(F.col("seam_positions_json"), F.col("seam_position")).alias("seam_positions"))
    rows = members.where(F.col("side") == side).join(bags, "bag_id")
    listed = F.transform(F.array_sort(F.collect_list(photo)), lambda x: F.struct(x.crop_path.alias("crop_path"), x.seam_position.alias("seam_position"), x.seam_positions.alias("seam_positions")))
    return rows.groupBy("track_pair_id").agg(listed.alias("photos"))


def seam_positions(as_json: Column, single: Column) -> Column:
    """A JSON list of seams, or the single one, or none; bad JSON counts as none."""
    none = F.expr("cast(array() as array<double>)")
    listed = F.filter(F.coalesce(F.from_json(as_json, "array<double>"), none), lambda x: x.isNotNull())
    return F.when(F.size(listed) > 0, listed).when(single.isNotNull(), F.array(single.cast("double"))).otherwise(none)


def export_dataset(pairs: DataFrame, headers: DataFrame, reviews: DataFrame, review_items: DataFrame, ocr_items: DataFrame, members: DataFrame, bags: DataFrame, *, exclude_rejected: bool = True, exclude_empty: bool = True) -> DataFrame:
    """One nested record for each pouch: its context, its final items and where they come from, its photos.

    A review's items stand for the reading's if there are any; a review that empties the list doesn't.
    """
    short = lambda: F.transform(F.array_sort(F.collect_list(F.struct("line_index", "drug_name", "quantity", "dose_value", "dose_unit"))), lambda x: F.struct(x.drug_name.alias("drug_name"), x.quantity.alias("quantity"), x.dose_value.alias("dose_value"), x.dose_unit.alias("dose_unit")))
    corrected = review_items.groupBy("track_pair_id").agg(short().alias("corrected"))
    read = ocr_items.groupBy(F.col("ocr_result_id").alias("label_ocr_result_id")).agg(short().alias("read"))
    rows = pairs.join(headers.withColumnRenamed("ocr_result_id", "label_ocr_result_id"), "label_ocr_result_id", "left").join(reviews, "track_pair_id", "left")
    if exclude_rejected:
        rows = rows.where("decision is null or decision <> 'rejected'")
    rows = rows.join(corrected, "track_pair_id", "left").join(read, "label_ocr_result_id", "left").join(photos_of(members, bags), "track_pair_id", "left")
    human = F.coalesce(F.size("corrected"), F.lit(0)) > 0
    none = F.expr(f"cast(array() as {SHORT_ITEM})")
    rows = rows.withColumn("label_items", F.when(human, F.col("corrected")).otherwise(F.coalesce("read", none)))
    if exclude_empty:
        rows = rows.where(F.size("label_items") > 0)
    pictures = F.expr("cast(array() as array<struct<crop_path: string, seam_position: double, seam_positions: array<double>>>)")
    return rows.select(
        "track_pair_id", "pair_key", "order_index", F.col("status").alias("pipeline_status"), "match_score",
        F.struct("decision", "reviewer_notes", "reviewed_at").alias("review"),
        F.struct("patient_name", F.col("dose_weekday").alias("weekday"), F.col("dose_date").alias("date"), F.col("dose_slot").alias("slot")).alias("patient_context"),
        "label_items", F.when(human, "human_corrected").otherwise("ocr_raw").alias("label_source"), F.coalesce("photos", pictures).alias("pill_photos"),
    )


def editor_items(rows: DataFrame) -> DataFrame:
    """What an editor's table ``(track_pair_id, line_index, drug_name, quantity, dose_value, dose_unit)`` says.

    Rows without a name, quantity and dose go; the others keep the number they had before.
    """
    name = F.nullif(F.trim(F.coalesce("drug_name", F.lit(""))), F.lit(""))
    kept = rows.withColumn("drug_name", name).where("drug_name is not null or quantity is not null or dose_value is not null")
    return kept.withColumn("dose_unit", F.nullif(F.upper(F.trim("dose_unit")), F.lit("")))


def run_counts(**tables: DataFrame) -> DataFrame:
    """The counts of a run's report, a row each: rows of every table, and parts by a flag or status."""
    parts = {"frames": "strip_detected", "ocr_results": "needs_review", "pairs": "needs_review", "bags": "selected"}
    out = None
    for name, table in tables.items():
        aggs = [F.count("*").alias("n"), F.count_if(F.col(parts[name])).alias("flagged") if name in parts else F.lit(None).cast("long").alias("flagged")]
        row = table.agg(*aggs).select(F.lit(name).alias("table_name"), "n", "flagged")
        out = row if out is None else out.unionByName(row)
    return out


def select_best(bags: DataFrame, k: int = 20, keys: tuple[str, ...] = ("video_id", "side")) -> DataFrame:
    """The ``k`` best of each side of a recording: tracks' best first, then by score, then id."""
    score = 0.55 * F.col("quality_score") + 0.30 * F.col("segment_confidence") + 0.15 * F.col("track_match_score")
    w = Window.partitionBy(*keys).orderBy(F.desc("is_track_best"), F.desc("score"), "bag_id")
    return bags.withColumn("score", score).withColumn("selected", F.row_number().over(w) <= k)
