"""Queries over the relational model: scans, joins, counts, review, export, merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import DEFAULTS
from ..operators import grouping, review, sampling
from ..sources import readers, sinks
from .registry import register


@register(
    "frame_scan",
    """SELECT filename, frame_index, strip_detected, round(cumulative_pan_px, 4) AS pan FROM {frames} JOIN {videos} USING (video_id)
       WHERE filename = 'VID_7.mp4'""",
)
def frame_scan(t):
    """Frames of one recording, by exact name."""
    rows = readers.by_stem(t("videos"), "VID_7").join(t("frames"), "video_id")
    return rows.select("filename", "frame_index", "strip_detected", F.round("cumulative_pan_px", 4).alias("pan"))


@register(
    "pill_observations",
    """SELECT bag_id, video, frame_index, round(CAST(frame_index AS DOUBLE) / greatest(1, max(frame_index) OVER (PARTITION BY video)), 6) AS center_norm
       FROM {obs} WHERE side = 'pill_side'""",
)
def pill_observations(t):
    rows = grouping.with_center(t("obs").where("side = 'pill_side'"))
    return rows.select("bag_id", "video", "frame_index", F.round("center_norm", 6).alias("center_norm"))


@register(
    "ocr_observations",
    """SELECT o.ocr_result_id, o.video, count(i.line_index) AS n_items, max(i.drug_name) AS last_drug, o.dose_date, o.dose_slot
       FROM {obs} o LEFT JOIN {items} i ON i.ocr_result_id = o.ocr_result_id GROUP BY o.ocr_result_id, o.video, o.dose_date, o.dose_slot""",
)
def ocr_observations(t):
    """Observations with their items, aggregated before the join."""
    items = t("items").groupBy("ocr_result_id").agg(F.count("line_index").alias("n_items"), F.max("drug_name").alias("last_drug"))
    rows = t("obs").join(items, "ocr_result_id", "left")
    return rows.select("ocr_result_id", "video", F.coalesce("n_items", F.lit(0)).alias("n_items"), "last_drug", "dose_date", "dose_slot")


@register(
    "stride_sampling",
    """SELECT video, frame_index, round(timestamp_seconds, 6) AS timestamp_seconds FROM (
         SELECT video, frame_index, frame_index / fps AS timestamp_seconds, row_number() OVER (PARTITION BY video ORDER BY frame_index) AS nth
         FROM (SELECT video_id AS video, fps, unnest(range(0, frame_count, CAST(greatest(1, round_even(fps * 0.4, 0)) AS BIGINT))) AS frame_index FROM {videos} WHERE frame_count > 0))
       WHERE nth <= 30""",
)
def stride_sampling(t):
    rows = readers.sampled_frames(t("videos").withColumnRenamed("video_id", "video"))
    return rows.select("video", F.col("frame_index").cast("long").alias("frame_index"), F.round("timestamp_seconds", 6).alias("timestamp_seconds"))


@register("completed_semi", "SELECT video_id, filename FROM {videos} v WHERE EXISTS (SELECT 1 FROM {videos} d WHERE d.filename = v.filename AND d.side = 'pill_side' AND d.status = 'completed')")
def completed_semi(t):
    done = t("videos").where("side = 'pill_side' and status = 'completed'").select("filename")
    return t("videos").join(done, "filename", "left_semi").select("video_id", "filename")


@register("unfinished_anti", "SELECT filename, side FROM {videos} WHERE status <> 'completed'")
def unfinished_anti(t):
    return readers.unfinished(t("videos"), t("videos").select("filename", "side", "status")).select("filename", "side")


@register("missing_pan", "SELECT DISTINCT filename FROM {videos} WHERE status = 'completed' AND video_id NOT IN (SELECT video_id FROM {frames} WHERE cumulative_pan_px IS NOT NULL)")
def missing_pan(t):
    return readers.missing_pan(t("videos"), t("frames"))


@register(
    "side_lookup",
    "SELECT filename, CASE regexp_extract(filename, '^(.*)[.]', 1) WHEN 'VID_1' THEN 'pill_side' WHEN 'VID_2' THEN 'label_side' ELSE 'unknown' END AS configured FROM {videos}",
)
def side_lookup(t):
    return t("videos").select("filename", readers.side_of(readers.stem(F.col("filename")), {"VID_1": "pill_side", "VID_2": "label_side"}).alias("configured"))


@register(
    "review_queue",
    """SELECT tp.track_pair_id, tp.pair_key, tp.order_index, tp.status, pb.crop_path AS pill_image_path, lb.crop_path AS label_image_path,
              ol.seam_side AS label_seam_side, op.seam_side AS pill_seam_side, n.item_count, r.decision
       FROM {pairs} tp LEFT JOIN {bags} pb ON pb.bag_id = tp.pill_best_bag_id LEFT JOIN {bags} lb ON lb.bag_id = tp.label_best_bag_id
       LEFT JOIN {ocr} ol ON ol.ocr_result_id = tp.label_ocr_result_id LEFT JOIN {ocr} op ON op.ocr_result_id = tp.pill_ocr_result_id
       JOIN (SELECT ocr_result_id, count(*) AS item_count FROM {items} GROUP BY 1) n ON n.ocr_result_id = tp.label_ocr_result_id
       LEFT JOIN {reviews} r ON r.track_pair_id = tp.track_pair_id WHERE r.decision IS NULL OR r.decision = 'pending'""",
)
def review_queue(t):
    rows = review.queue(t("pairs"), t("bags"), t("ocr"), t("items"), t("reviews"), decision="pending")
    return rows.select("track_pair_id", "pair_key", "order_index", "status", "pill_image_path", "label_image_path", "label_seam_side", "pill_seam_side", "item_count", "decision")


@register("review_queue_all", "SELECT tp.track_pair_id, coalesce(n.c, 0) AS item_count FROM {pairs} tp LEFT JOIN (SELECT ocr_result_id, count(*) AS c FROM {items} GROUP BY 1) n ON n.ocr_result_id = tp.label_ocr_result_id WHERE tp.status = 'review'")
def review_queue_all(t):
    return review.queue(t("pairs"), t("bags"), t("ocr"), t("items"), t("reviews"), decision="all", status="review", hide_empty=False).select("track_pair_id", "item_count")


@register("decided", "SELECT p.track_pair_id, p.status, CASE WHEN r.decision IS NULL THEN p.needs_review ELSE r.decision NOT IN ('accepted', 'corrected') END AS needs_review FROM {pairs} p LEFT JOIN {reviews} r USING (track_pair_id)")
def decided(t):
    return review.decided(t("pairs"), t("reviews")).select("track_pair_id", "status", "needs_review")


@register(
    "review_reattach",
    """WITH content AS (SELECT p.track_pair_id, v.filename AS label_video_filename, h.dose_weekday, h.dose_date, h.dose_slot FROM {pairs} p
         LEFT JOIN {bags} b ON b.bag_id = p.label_best_bag_id LEFT JOIN {videos} v ON v.video_id = b.frame_id LEFT JOIN {headers} h ON h.ocr_result_id = p.label_ocr_result_id),
       found AS (SELECT label_video_filename, dose_weekday, dose_date, dose_slot, min(track_pair_id) AS new_id FROM content GROUP BY ALL)
       SELECT c.track_pair_id AS old_id, r.decision, f.new_id FROM {reviews} r JOIN content c USING (track_pair_id)
       LEFT JOIN found f ON f.label_video_filename = c.label_video_filename AND f.dose_weekday IS NOT DISTINCT FROM c.dose_weekday
         AND f.dose_date IS NOT DISTINCT FROM c.dose_date AND f.dose_slot IS NOT DISTINCT FROM c.dose_slot""",
)
def review_reattach(t):
    """Exported decisions found again by recording and header."""
    content = (
        t("pairs").join(t("bags").select(F.col("bag_id").alias("label_best_bag_id"), "frame_id"), "label_best_bag_id", "left")
        .join(t("videos").select(F.col("video_id").alias("frame_id"), F.col("filename").alias("label_video_filename")), "frame_id", "left")
        .join(t("headers").withColumnRenamed("ocr_result_id", "label_ocr_result_id"), "label_ocr_result_id", "left")
        .select("track_pair_id", "label_video_filename", "dose_weekday", "dose_date", "dose_slot")
    )
    records = t("reviews").select("track_pair_id", "decision").join(content, "track_pair_id").withColumnRenamed("track_pair_id", "old_id")
    return review.reattach(records, content).select("old_id", "decision", F.col("track_pair_id").alias("new_id"))


@register(
    "export_reviews",
    """SELECT v.filename AS label_video_filename, h.dose_weekday, h.dose_date, h.dose_slot, r.decision, coalesce(i.n, 0) AS n_items, i.first_drug
       FROM {reviews} r JOIN {pairs} p USING (track_pair_id) LEFT JOIN {bags} b ON b.bag_id = p.label_best_bag_id LEFT JOIN {videos} v ON v.video_id = b.frame_id
       LEFT JOIN {headers} h ON h.ocr_result_id = p.label_ocr_result_id
       LEFT JOIN (SELECT track_pair_id, count(*) AS n, arg_min(drug_name, line_index) AS first_drug FROM {review_items} GROUP BY 1) i ON i.track_pair_id = r.track_pair_id""",
)
def export_reviews(t):
    frames = t("bags").select("frame_id", F.col("frame_id").alias("video_id"))
    rows = review.export_reviews(t("reviews"), t("pairs"), t("bags"), frames, t("videos"), t("headers"), t("review_items"))
    return rows.select("label_video_filename", "dose_weekday", "dose_date", "dose_slot", "decision", F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), F.get("items", F.lit(0)).drug_name.alias("first_drug"))


@register(
    "review_summary",
    """SELECT count(*) FILTER (decision = 'accepted') AS accepted, count(*) FILTER (decision = 'corrected') AS corrected, count(*) FILTER (decision = 'rejected') AS rejected,
              (SELECT count(*) FROM {pairs}) AS total, count(*) AS reviewed, (SELECT count(*) FROM {pairs}) - count(*) + count(*) FILTER (decision = 'pending') AS pending FROM {reviews}""",
)
def review_summary(t):
    return review.summary(t("pairs"), t("reviews"))


@register(
    "run_summary",
    """SELECT 'frames' AS table_name, count(*) AS n, count(*) FILTER (strip_detected) AS flagged FROM {frames}
       UNION ALL SELECT 'pairs', count(*), count(*) FILTER (needs_review) FROM {pairs} UNION ALL SELECT 'videos', count(*), NULL FROM {videos}""",
)
def run_summary(t):
    return review.run_counts(frames=t("frames"), pairs=t("pairs"), videos=t("videos"))


EXPORT = """
  SELECT p.track_pair_id, p.pair_key, p.order_index, p.status AS pipeline_status, r.decision, h.dose_date, h.dose_slot,
         CASE WHEN c.n > 0 THEN 'human_corrected' ELSE 'ocr_raw' END AS label_source,
         CASE WHEN c.n > 0 THEN c.n ELSE o.n END AS n_items, CASE WHEN c.n > 0 THEN c.first_quantity ELSE o.first_quantity END AS first_quantity
  FROM {pairs} p LEFT JOIN {headers} h ON h.ocr_result_id = p.label_ocr_result_id LEFT JOIN {reviews} r USING (track_pair_id)
  LEFT JOIN (SELECT track_pair_id, count(*) AS n, arg_min(quantity, line_index) AS first_quantity FROM {review_items} GROUP BY 1) c ON c.track_pair_id = p.track_pair_id
  LEFT JOIN (SELECT ocr_result_id, count(*) AS n, arg_min(quantity, line_index) AS first_quantity FROM {items} GROUP BY 1) o ON o.ocr_result_id = p.label_ocr_result_id
  WHERE (r.decision IS NULL OR r.decision <> 'rejected') AND coalesce(c.n, o.n, 0) > 0"""


def exported(t):
    members = t("pairs").select("track_pair_id", F.lit("pill").alias("side"), F.col("pill_best_bag_id").alias("bag_id"))
    return review.export_dataset(t("pairs"), t("headers"), t("reviews"), t("review_items"), t("items"), members, t("bags"))


@register("export_training", EXPORT)
def export_training(t):
    return exported(t).select(
        "track_pair_id", "pair_key", "order_index", "pipeline_status", "review.decision", F.col("patient_context.date").alias("dose_date"), F.col("patient_context.slot").alias("dose_slot"),
        "label_source", F.size("label_items").cast("long").alias("n_items"), F.get("label_items", F.lit(0)).quantity.alias("first_quantity"),
    )


@register(
    "export_breakdown",
    f"""WITH e AS ({EXPORT}) SELECT 'pipeline_status' AS kind, pipeline_status AS value, count(*) AS n FROM e GROUP BY 2
        UNION ALL SELECT 'label_source', label_source, count(*) FROM e GROUP BY 2 UNION ALL SELECT 'decision', coalesce(decision, 'sin_revisar'), count(*) FROM e GROUP BY 2""",
)
def export_breakdown(t):
    return review.breakdown(exported(t).select("pipeline_status", "label_source", "review.decision"))


@register(
    "photo_seams",
    """SELECT bag_id, crop_path, CASE WHEN bag_id % 3 = 0 THEN 2 WHEN seam_position IS NULL THEN 0 ELSE 1 END AS n_seams,
              CASE WHEN bag_id % 3 = 0 THEN CAST(seam_positions_json::JSON->>'$[0]' AS DOUBLE) ELSE seam_position END AS first_seam FROM {bags}""",
)
def photo_seams(t):
    rows = t("bags").withColumn("seams", review.seam_positions(F.col("seam_positions_json"), F.col("seam_position")))
    return rows.select("bag_id", "crop_path", F.size("seams").alias("n_seams"), F.get("seams", F.lit(0)).alias("first_seam"))


@register("package_manifest", f"WITH e AS ({EXPORT}) SELECT DISTINCT b.crop_path, b.bag_id % 5 <> 0 AS there FROM e JOIN {{pairs}} p USING (track_pair_id) JOIN {{bags}} b ON b.bag_id = p.pill_best_bag_id")
def package_manifest(t):
    """Photos that the export names, and whether their files are there."""
    files = t("bags").where("bag_id % 5 <> 0").select(F.col("crop_path").alias("path"))
    there, missing = sampling.against_files(sampling.referenced_photos(exported(t)), files)
    return there.select("crop_path", F.lit(True).alias("there")).unionByName(missing.select("crop_path", F.lit(False).alias("there")))


SHARED = "SELECT o_custkey AS pair_key, o_orderkey AS order_index, o_custkey % 200 AS photo, o_orderkey % 6 AS n_seams, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS at FROM {orders}"


def shared_photos(t):
    from pyspark.sql import Window

    at = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    return t("orders").select(F.col("o_custkey").alias("pair_key"), F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 6).alias("n_seams"), at.alias("at"), F.concat(F.lit("bags/"), F.col("o_orderkey") % 500).alias("crop_path"))


@register(
    "upper_median_representative",
    """SELECT o_custkey AS pair_key, concat('bags/', CAST(o_orderkey % 500 AS STRING)) AS crop_path, n_seams FROM (
         SELECT *, o_orderkey % 6 AS n_seams, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 6, o_orderkey) - 1 AS rn, count(*) OVER (PARTITION BY o_custkey) AS n FROM {orders})
       WHERE rn = n // 2""",
)
def upper_median_representative(t):
    index = shared_photos(t).withColumn("order_index", F.lit(0))
    return sampling.representatives(index).select("pair_key", "crop_path", "n_seams")


@register(
    "coverage",
    """WITH chosen AS (SELECT DISTINCT o_orderkey % 500 AS photo FROM {orders} WHERE o_orderkey % 7 = 0)
       SELECT concat('bags/', CAST(photo AS STRING)) AS crop_path, count(DISTINCT o_custkey) AS n_pouches FROM chosen JOIN {orders} ON o_orderkey % 500 = photo GROUP BY 1""",
)
def coverage(t):
    index = shared_photos(t).withColumn("order_index", F.lit(0))
    found = sampling.coverage(index.where("id % 7 = 0"), index)
    return found.select("crop_path", F.size("pouches").cast("long").alias("n_pouches"))


@register("item_histogram", "SELECT n AS size, count(*) AS n FROM (SELECT ocr_result_id, count(*) AS n FROM {items} GROUP BY 1) GROUP BY 1")
def item_histogram(t):
    lists = t("items").groupBy("ocr_result_id").agg(F.collect_list("line_index").alias("lines"))
    return sampling.histogram(lists, F.size("lines"))


@register(
    "hash_split",
    """SELECT track_pair_id, pair_key, CASE WHEN place <= greatest(1, CAST(floor(0.15 * n) AS BIGINT)) THEN 'val' ELSE 'train' END AS split
       FROM {pairs} JOIN (SELECT pair_key, row_number() OVER (ORDER BY md5(concat('42:', pair_key)), pair_key) AS place, count(*) OVER () AS n FROM (SELECT DISTINCT pair_key FROM {pairs})) USING (pair_key)""",
)
def hash_split(t):
    """A seeded split that keeps a customer's pairs together."""
    return sampling.split(t("pairs"), "track_pair_id", group="pair_key").select("track_pair_id", "pair_key", "split")


@register("review_sample", "SELECT track_pair_id, pair_key FROM {pairs} WHERE status = 'paired' ORDER BY md5(concat('42:', CAST(track_pair_id AS STRING))), track_pair_id LIMIT 25")
def review_sample(t):
    return sampling.sample(t("pairs").where("status = 'paired'"), 25, "track_pair_id").select("track_pair_id", "pair_key")


@register(
    "upsert_merge",
    """SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM {customer}
       UNION ALL SELECT c_custkey + 1000000, c_name, c_acctbal + 1 FROM {customer} WHERE c_custkey % 3 = 0""",
)
def upsert_merge(t):
    old = t("customer").select("c_custkey", "c_name", "c_acctbal")
    some = old.where("c_custkey % 3 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    return sinks.upsert(old, some.unionByName(some.withColumn("c_custkey", F.col("c_custkey") + 1000000)), ["c_custkey"])


@register(
    "replace_sets",
    """SELECT ocr_result_id, line_index, quantity FROM {items} WHERE ocr_result_id NOT IN (SELECT track_pair_id FROM {review_items})
       UNION ALL SELECT track_pair_id, line_index, quantity FROM {review_items}""",
)
def replace_sets(t):
    new = t("review_items").select(F.col("track_pair_id").alias("ocr_result_id"), "line_index", "quantity")
    return sinks.replace_sets(t("items").select("ocr_result_id", "line_index", "quantity"), new, ["ocr_result_id"])


@register("keyed_update", "SELECT v.video_id, coalesce(f.n, v.frame_count) AS frame_count FROM {videos} v LEFT JOIN (SELECT video_id, count(*) AS n FROM {frames} GROUP BY 1) f USING (video_id)")
def keyed_update(t):
    changes = t("frames").groupBy("video_id").agg(F.count("*").alias("frame_count"))
    return sinks.update(t("videos").select("video_id", F.col("frame_count").cast("long").alias("frame_count")), changes, ["video_id"])


@register("schema_evolution", "SELECT s_suppkey, s_name, CAST(NULL AS INT) AS sheet_index, CAST(NULL AS DOUBLE) AS seam FROM {supplier}")
def schema_evolution(t):
    return sinks.evolved(t("supplier").select("s_suppkey", "s_name"), "s_suppkey long, s_name string, sheet_index int, seam double", ["s_suppkey"])


@register("history_union", "SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, CAST(NULL AS STRING) AS segment FROM {supplier} UNION ALL SELECT c_custkey, c_name, NULL, c_mktsegment FROM {customer}")
def history_union(t):
    return sinks.concatenated(t("supplier").selectExpr("s_suppkey as id", "s_name as name", "s_acctbal as balance"), t("customer").selectExpr("c_custkey as id", "c_name as name", "c_mktsegment as segment"))


@register(
    "topk_per_group",
    """SELECT bag_id, video, side FROM (SELECT *, row_number() OVER (PARTITION BY video, side ORDER BY frame_index % 4 = 0 DESC, 0.55 * quality_score + 0.30 * segment_confidence + 0.15 * 0.5 DESC, bag_id) AS rn FROM {obs}) WHERE rn <= 3""",
)
def topk_per_group(t):
    rows = t("obs").withColumns({"track_match_score": F.lit(0.5), "is_track_best": F.col("frame_index") % 4 == 0})
    return review.select_best(rows, 3, ("video", "side")).where("selected").select("bag_id", "video", "side")


@register("ad_hoc_sql", "SELECT o_orderpriority, count(*) AS n, round(avg(o_totalprice), 2) AS mean_price FROM {orders} WHERE o_totalprice > 1000 GROUP BY 1")
def ad_hoc_sql(t):
    t("orders").createOrReplaceTempView("stripweave_orders")
    spark = t("orders").sparkSession
    return readers.ad_hoc(spark, "SELECT o_orderpriority, count(*) AS n, round(avg(o_totalprice), 2) AS mean_price FROM stripweave_orders WHERE o_totalprice > :least GROUP BY 1", least=1000)


@register("capture_times", "SELECT event_id AS path, CASE WHEN event_id % 3 = 0 THEN ts ELSE TIMESTAMP '2024-02-01 00:00:00' END AS capture_time, CASE WHEN event_id % 3 = 0 THEN 'metadata' ELSE 'mtime' END AS time_source FROM {events}")
def capture_times(t):
    events = t("events")
    found = events.select(F.col("event_id").alias("path"), F.col("event_id").cast("string").alias("stem"), F.lit("2024-02-01 00:00:00").cast("timestamp").alias("modified"))
    said = events.where("event_id % 3 = 0").select(F.col("event_id").alias("path"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("creation_time"))
    rows = readers.capture_times(found, said)
    return rows.select("path", F.col("capture_time").cast("timestamp_ntz").alias("capture_time"), "time_source")


@register("durations", "SELECT video_id, round(frame_count / fps, 6) AS duration_seconds FROM {videos}")
def durations(t):
    return readers.with_duration(t("videos")).select("video_id", F.round("duration_seconds", 6).alias("duration_seconds"))


@register("editor_items", "SELECT track_pair_id, line_index, CASE WHEN line_index % 2 = 0 THEN NULL ELSE trim(drug_name) END AS drug_name, CASE WHEN line_index % 2 = 0 THEN NULL ELSE quantity END AS quantity FROM {review_items} WHERE line_index % 2 = 1")
def editor_items(t):
    even = F.col("line_index") % 2 == 0
    rows = t("review_items").withColumns({c: F.when(~even, F.col(c)) for c in ("drug_name", "quantity", "dose_value")})
    return review.editor_items(rows).select("track_pair_id", "line_index", "drug_name", "quantity")


@register("region_adjacency", """WITH p AS (SELECT p_partkey % 20 AS x, p_partkey // 20 AS y, p_size % 4 AS region FROM {part})
    SELECT DISTINCT least(a.region, b.region) AS a, greatest(a.region, b.region) AS b FROM p a JOIN p b ON (b.x = a.x + 1 AND b.y = a.y) OR (b.x = a.x AND b.y = a.y + 1) WHERE a.region <> b.region AND a.region > 0 AND b.region > 0""")
def region_adjacency(t):
    pixels = t("part").select(F.lit(0).alias("image_id"), (F.col("p_partkey") % 20).alias("x"), F.floor(F.col("p_partkey") / 20).alias("y"), (F.col("p_size") % 4).alias("region"))
    return sampling.adjacent_regions(pixels).select("a", "b")


@register("pan_ranges", "SELECT video_id, min(cumulative_pan_px) AS low, max(cumulative_pan_px) AS high FROM {frames} WHERE strip_detected AND cumulative_pan_px IS NOT NULL GROUP BY 1")
def pan_ranges(t):
    from ..operators import matching

    return matching.pan_ranges(t("frames"), ("video_id",))


SETTINGS = DEFAULTS
