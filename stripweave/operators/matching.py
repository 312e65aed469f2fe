"""The tiered matcher: content, then position, then order; what is left stays as unmatched.

Every tier is a relation over all pairs of recordings at a time. Only the position tier is
sequential within a pair of recordings, as each photo can be used once; it runs as a grouped
function on a few columns of one pair's groups and candidates.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULTS, Settings
from ..functions import scoring as S
from ..functions import text as T
from ..sources.sinks import settled


def direct(pills: DataFrame, labels: DataFrame, keys: tuple[str, ...] = ("pair_key",)) -> DataFrame:
    """Groups of both sides with one signature. ``order_index`` is by the signature's text, not by the calendar."""
    on = [*keys, "sig_date", "sig_slot"]
    p = pills.where("sig_date is not null").select(*on, F.col("best_bag_id").alias("pill_bag"), F.col("bag_ids").alias("pill_bag_ids"), F.col("ocr_result_id").alias("pill_ocr"))
    q = labels.where("sig_date is not null").select(*on, F.col("best_bag_id").alias("label_bag"), F.col("group_no").alias("label_group"), F.col("ocr_result_id").alias("label_ocr"))
    order = F.row_number().over(Window.partitionBy(*keys).orderBy("sig_date", "sig_slot")) - 1
    return p.join(q, on).withColumn("order_index", order.cast("int")).withColumns({"match_score": F.lit(1.0), "status": F.lit("paired"), "match_tier": F.lit("direct")})


def pan_ranges(frames: DataFrame, keys: tuple[str, ...] = ("pair_key", "side")) -> DataFrame:
    """The range of positions of each side, over frames in which the strip was seen."""
    return frames.where("strip_detected and cumulative_pan_px is not null").groupBy(*keys).agg(F.min("cumulative_pan_px").alias("low"), F.max("cumulative_pan_px").alias("high"))


def position_targets(labels: DataFrame, ranges: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """For each label group ``(pair_key, label_group, position)`` the place to look for it on the other side, and how far."""
    p = ranges.where("side = 'pill_side'").select("pair_key", F.col("low").alias("p_low"), F.col("high").alias("p_high"))
    q = ranges.where("side = 'label_side'").select("pair_key", F.col("low").alias("l_low"), F.col("high").alias("l_high"))
    target = S.interpolated(F.col("position"), F.col("l_low"), F.col("l_high"), F.col("p_low"), F.col("p_high"))
    found = labels.join(p, "pair_key").join(q, "pair_key").withColumn("target", target)
    return found.withColumn("tolerance", settings.position_tolerance * (F.col("p_high") - F.col("p_low"))).where("target is not null").drop("p_low", "p_high", "l_low", "l_high")


def position_candidates(targets: DataFrame, pills: DataFrame, cells: tuple[str, ...] = ("pair_key",)) -> DataFrame:
    """Photos ``(pair_key, bag_id, position)`` within the tolerance of each target, ranked by distance, then id.

    The range is joined on cells one tolerance wide, so a recording's photos aren't all compared with all its groups.
    """
    width = F.greatest(F.col("tolerance"), F.lit(1e-9))
    span = targets.groupBy(*cells).agg(F.max("tolerance").alias("cell"))
    t = targets.join(span, list(cells)).withColumn("cell", F.greatest("cell", F.lit(1e-9)))
    t = t.withColumn("bin", F.explode(F.sequence(F.floor((F.col("target") - width) / F.col("cell")), F.floor((F.col("target") + width) / F.col("cell")))))
    p = pills.join(span, list(cells)).withColumn("bin", F.floor(F.col("position") / F.greatest("cell", F.lit(1e-9)))).select(*cells, "bin", F.col("bag_id"), F.col("position").alias("bag_position"))
    near = t.drop("cell").join(p, [*cells, "bin"]).withColumn("distance", F.abs(F.col("bag_position") - F.col("target"))).where(F.col("distance") <= F.col("tolerance"))
    rank = F.row_number().over(Window.partitionBy(*cells, "label_group").orderBy("distance", "bag_id"))
    return near.drop("bin").withColumn("rank", rank.cast("int"))


def position(candidates: DataFrame, used: DataFrame) -> DataFrame:
    """Nearest photo for each label group, in the groups' order, each photo once; ``used(pair_key, bag_id)`` are taken.

    The choice is sequential within a pair of recordings, over as many free photos of a group as its pair has groups: the
    groups before it can't take more.
    """
    free = candidates.join(used.select("pair_key", "bag_id").distinct(), ["pair_key", "bag_id"], "left_anti")
    pair = Window.partitionBy("pair_key")
    nearest = F.row_number().over(Window.partitionBy("pair_key", "label_group").orderBy("distance", "bag_id"))
    free = free.withColumns({"nearest": nearest, "nth": F.dense_rank().over(pair.orderBy("label_group"))})
    free = free.withColumn("groups", F.max("nth").over(pair)).where(F.col("nearest") <= F.col("groups"))

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values(["label_group", "distance", "bag_id"], ignore_index=True)
        taken: set[int] = set()
        served, chosen = None, []
        for i, (group, bag) in enumerate(zip(rows["label_group"].tolist(), rows["bag_id"].tolist())):
            if group != served and bag not in taken:
                taken.add(bag)
                served = group
                chosen.append(i)
        return rows.iloc[chosen][["pair_key", "label_group", "bag_id", "distance"]]

    kind = dict(candidates.dtypes)["pair_key"]
    return free.select("pair_key", "label_group", "bag_id", "distance").groupBy("pair_key").applyInPandas(choose, f"pair_key {kind}, label_group int, bag_id long, distance double")


def ordinal(pills: DataFrame, labels: DataFrame, *, reverse: bool | None = None, settings: Settings = DEFAULTS) -> DataFrame:
    """The two sides zipped by rank; the longer one's rest is unmatched.

    Both have ``pair_key, track_key, best_bag_id, best_quality, center_norm``. With ``reverse`` the label side
    is counted from its end; where it is None, a boolean column ``reversed`` of the label side says so for each pair.
    """
    p_order = Window.partitionBy("pair_key").orderBy("center_norm", "track_key")
    flip = F.col("reversed") if reverse is None else F.lit(reverse)
    down = Window.partitionBy("pair_key").orderBy(F.desc("center_norm"), F.desc("track_key"))
    p = pills.select("pair_key", (F.row_number().over(p_order) - 1).cast("int").alias("order_index"), F.col("track_key").alias("pill_track"), F.col("best_bag_id").alias("pill_bag"), F.col("best_quality").alias("pill_quality"))
    rank = F.when(flip, F.row_number().over(down)).otherwise(F.row_number().over(p_order)) - 1
    q = labels.select("pair_key", rank.cast("int").alias("order_index"), F.col("track_key").alias("label_track"), F.col("best_bag_id").alias("label_bag"), F.col("best_quality").alias("label_quality"))
    both = p.join(q, ["pair_key", "order_index"], "full")
    whole = Window.partitionBy("pair_key")
    n_p, n_q = F.count("pill_track").over(whole), F.count("label_track").over(whole)
    balance = F.least(n_p, n_q) / F.greatest(F.lit(1), F.greatest(n_p, n_q))
    matched = F.col("pill_track").isNotNull() & F.col("label_track").isNotNull()
    score = F.when(matched, S.pair_score(F.col("pill_quality"), F.col("label_quality"), balance)).otherwise(0.0)
    status = F.when(matched & (score >= settings.ordinal_cut), "paired").when(matched, "review").when(F.col("pill_track").isNotNull(), "unmatched_pill").otherwise("unmatched_label")
    return both.select("pair_key", "order_index", "pill_track", "label_track", "pill_bag", "label_bag", score.alias("match_score"), status.alias("status"))


def match(pill_groups: DataFrame, label_groups: DataFrame, pill_photos: DataFrame, seam_groups: DataFrame, frames: DataFrame, pairs: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """All tiers for all pairs of recordings.

    ``pill_groups, label_groups``: as from ``by_header`` with ``pair_key``; ``label_groups`` with ``position``
    (of the representative) as well. ``pill_photos(pair_key, bag_id, position)``; ``seam_groups`` as from
    ``by_seam`` with ``pair_key``; ``frames(pair_key, side, strip_detected, cumulative_pan_px)``;
    ``pairs(pair_key, pill_video, label_video, direction)``. Returns a row for each pair of a pouch's two
    sides, or a side alone, with ``order_index`` running through the tiers.
    """
    named = pairs.select("pair_key", "pill_video", "label_video", (F.col("direction") == "reverse").alias("reversed"))
    label_groups = settled(label_groups)
    first = settled(direct(pill_groups, label_groups))
    used = first.select("pair_key", F.explode("pill_bag_ids").alias("bag_id"))
    rest = label_groups.join(first.select("pair_key", F.col("label_group").alias("group_no")), ["pair_key", "group_no"], "left_anti")
    some = rest.where(F.size("merged_items") > 0).select("pair_key", F.col("group_no").alias("label_group"), "position").where("position is not null")
    near = position_candidates(position_targets(some, pan_ranges(frames), settings), pill_photos)
    second = settled(position(near, used))
    counts = first.groupBy("pair_key").agg(F.count("*").alias("n_direct"))
    order = F.row_number().over(Window.partitionBy("pair_key").orderBy("label_group")) - 1
    second = second.withColumn("nth", order).join(counts, "pair_key", "left").withColumn("order_index", (F.col("nth") + F.coalesce("n_direct", F.lit(0))).cast("int"))
    second = second.join(rest.select("pair_key", F.col("group_no").alias("label_group"), F.col("best_bag_id").alias("label_bag"), F.col("ocr_result_id").alias("label_ocr")), ["pair_key", "label_group"])

    taken = used.unionByName(second.select("pair_key", "bag_id")).groupBy("pair_key").agg(F.collect_set("bag_id").alias("taken"))
    free = seam_groups.join(taken, "pair_key", "left").where(~F.col("in_transition") & ~F.coalesce(F.arrays_overlap("bag_ids", "taken"), F.lit(False)))
    left = free.join(named, "pair_key").withColumn("track_key", T.track_key(F.col("pill_video"), "pill_side", "seam:", F.col("group_no")))
    right = rest.join(second.select("pair_key", F.col("label_group").alias("group_no")), ["pair_key", "group_no"], "left_anti").join(named, "pair_key")
    number = F.row_number().over(Window.partitionBy("pair_key").orderBy("center_norm", "group_no")) - 1
    right = right.withColumn("track_key", T.track_key(F.col("label_video"), "label_side", "header:", number))
    third = ordinal(left, right, settings=settings)
    before = counts.join(second.groupBy("pair_key").agg(F.count("*").alias("n_position")), "pair_key", "full")
    shift = F.coalesce("n_direct", F.lit(0)) + F.coalesce("n_position", F.lit(0))
    third = third.join(before, "pair_key", "left").withColumn("order_index", (F.col("order_index") + shift).cast("int"))
    third = third.join(right.select("pair_key", F.col("track_key").alias("label_track"), F.col("ocr_result_id").alias("label_ocr")), ["pair_key", "label_track"], "left")

    def keys(rows: DataFrame, kind: str) -> DataFrame:
        rows = rows.join(named, "pair_key")
        return rows.withColumn("pill_track", T.track_key(F.col("pill_video"), "pill_side", f"{kind}:", F.col("order_index"))).withColumn("label_track", T.track_key(F.col("label_video"), "label_side", f"{kind}:", F.col("order_index")))

    columns = ["pair_key", "order_index", "pill_track", "label_track", "pill_bag", "label_bag", "label_ocr", "match_score", "status", "match_tier"]
    one = keys(first, "direct").select(columns)
    two = keys(second.withColumnRenamed("bag_id", "pill_bag"), "position").withColumns({"match_score": F.lit(settings.position_score), "status": F.lit("position_matched"), "match_tier": F.lit("position")}).select(columns)
    three = third.withColumn("match_tier", F.when(F.col("status").startswith("unmatched"), "unmatched").otherwise("ordinal")).select(columns)
    return one.unionByName(two).unionByName(three)
