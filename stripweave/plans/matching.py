"""Queries of the matcher's tiers, of grouping and of tracking."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import grouping, matching, tracking
from ..sources import readers
from .registry import register

NO_ITEMS = "cast(array() as array<struct<line_index: int, quantity: double, drug_name: string, dose_value: double, dose_unit: string, raw_line: string>>)"


def observed(t, side: str):
    """Observations of a side with a centre; their items are those of the reading with their number."""
    obs = grouping.with_center(t("obs").where(F.col("side") == side))
    return obs.withColumn("items", F.expr(NO_ITEMS)).withColumn("pair_key", F.col("video"))


def groups(t, side: str):
    return grouping.by_header(observed(t, side), ("pair_key",), merge=False)


GROUPS = "SELECT video AS pair_key, dose_date AS sig_date, dose_slot AS sig_slot, side, count(*) AS n, arg_max(bag_id, (mean_confidence, -bag_id)) AS best, max(quality_score) AS quality FROM {obs} WHERE side <> 'unknown' GROUP BY 1, 2, 3, 4"


@register(
    "direct_signature_match",
    f"""WITH g AS ({GROUPS}) SELECT p.pair_key, p.sig_date, p.sig_slot, p.n AS n_pills, q.n AS n_labels, p.best AS pill_bag, q.best AS label_bag,
              CAST(row_number() OVER (PARTITION BY p.pair_key ORDER BY p.sig_date, p.sig_slot) - 1 AS INT) AS order_index
       FROM g p JOIN g q USING (pair_key, sig_date, sig_slot) WHERE p.side = 'pill_side' AND q.side = 'label_side'""",
)
def direct_signature_match(t):
    """Which pouches of the two sides match by content."""
    pills, labels = groups(t, "pill_side"), groups(t, "label_side")
    found = matching.direct(pills, labels)
    n = labels.select("pair_key", "sig_date", "sig_slot", F.col("n_observations").alias("n_labels"))
    return found.join(n, ["pair_key", "sig_date", "sig_slot"]).select("pair_key", "sig_date", "sig_slot", F.size("pill_bag_ids").cast("long").alias("n_pills"), "n_labels", "pill_bag", "label_bag", "order_index")


@register("group_by_signature", f"SELECT pair_key, sig_date, sig_slot, n, best, round(quality, 6) AS quality FROM ({GROUPS}) WHERE side = 'pill_side'")
def group_by_signature(t):
    return groups(t, "pill_side").select("pair_key", "sig_date", "sig_slot", F.col("n_observations").alias("n"), F.col("best_bag_id").alias("best"), F.round("best_quality", 6).alias("quality"))


@register("group_without_signature", "SELECT video, CASE WHEN event_no THEN NULL ELSE dose_date END AS sig_date, count(*) AS n FROM (SELECT *, bag_id % 5 = 0 AS event_no, CASE WHEN bag_id % 5 = 0 THEN bag_id END AS own FROM {obs}) GROUP BY video, own, CASE WHEN event_no THEN NULL ELSE dose_date END, CASE WHEN event_no THEN NULL ELSE dose_slot END")
def group_without_signature(t):
    """Observations without a signature stay by themselves."""
    obs = grouping.with_center(t("obs")).withColumn("items", F.expr(NO_ITEMS)).withColumn("dose_slot", F.when(F.col("bag_id") % 5 != 0, F.col("dose_slot")))
    return grouping.by_header(obs, merge=False).select("video", "sig_date", F.col("n_observations").alias("n"))


@register(
    "transition_bridge",
    """SELECT bag_id, elevated OR (NOT elevated AND frame_index - prev <= 15 AND next - frame_index <= 15 AND prev IS NOT NULL AND next IS NOT NULL) AS in_transition FROM (
         SELECT *, max(CASE WHEN elevated THEN frame_index END) OVER (PARTITION BY video ORDER BY frame_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev,
                min(CASE WHEN elevated THEN frame_index END) OVER (PARTITION BY video ORDER BY frame_index ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next
         FROM (SELECT bag_id, video, CAST(frame_index * 9 AS INT) AS frame_index, seam_prominence >= 3.0 AS elevated FROM {obs}))""",
)
def transition_bridge(t):
    rows = t("obs").withColumn("frame_index", F.col("frame_index") * 9)
    return grouping.transitions(rows).select("bag_id", "in_transition")


@register(
    "seam_groups",
    """SELECT video, CAST(group_no AS INT) AS group_no, elevated AS in_transition, count(*) AS n, arg_max(bag_id, (quality_score, -frame_index)) AS best FROM (
         SELECT *, sum(CASE WHEN elevated <> prev THEN 1 ELSE 0 END) OVER (PARTITION BY video ORDER BY frame_index ROWS UNBOUNDED PRECEDING) AS group_no
         FROM (SELECT *, lag(elevated) OVER (PARTITION BY video ORDER BY frame_index) AS prev FROM (SELECT bag_id, video, frame_index, quality_score, seam_prominence >= 3.0 AS elevated FROM {obs}))) GROUP BY 1, 2, 3""",
)
def seam_groups(t):
    """Frames far apart, so that no gap is bridged."""
    rows = grouping.with_center(t("obs")).withColumn("frame_index", F.col("frame_index") * 100)
    return grouping.by_seam(rows).select("video", "group_no", "in_transition", F.size("bag_ids").cast("long").alias("n"), F.col("best_bag_id").alias("best"))


@register(
    "cumulative_pan",
    """SELECT bag_id, round(sum(CASE WHEN frame_index = 1 THEN 0 ELSE value - 50 END) OVER (PARTITION BY video ORDER BY frame_index ROWS UNBOUNDED PRECEDING), 4) AS pan FROM {obs}""",
)
def cumulative_pan(t):
    rows = grouping.cumulative_pan(t("obs").withColumn("dy", F.col("value") - 50))
    return rows.select("bag_id", F.round("cumulative_pan_px", 4).alias("pan"))


@register(
    "session_plan",
    """SELECT user_id, concat('session_', lpad(CAST(rn // 2 AS STRING), 4, '0'), CASE WHEN b IS NULL THEN '_incompleta' ELSE '' END) AS pair_key, a AS pill_video, b AS label_video,
              round(coalesce((epoch_us(tb) - epoch_us(ta)) / 1e6, 0), 3) AS gap_seconds, CASE WHEN b IS NULL OR (epoch_us(tb) - epoch_us(ta)) / 1e6 > 120 THEN 'needs_review' ELSE 'ok' END AS status
       FROM (SELECT user_id, event_id AS a, ts AS ta, row_number() OVER w - 1 AS rn, lead(event_id) OVER w AS b, lead(ts) OVER w AS tb FROM {events} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE rn % 2 = 0""",
)
def session_plan(t):
    """Each user's events as recordings in pairs."""
    videos = t("events").select("user_id", F.col("event_id").alias("stem"), F.col("ts").alias("capture_time"), F.lit("metadata").alias("time_source"))
    return grouping.sessions(videos, ("user_id",)).select("user_id", "pair_key", "pill_video", "label_video", F.round("gap_seconds", 3).alias("gap_seconds"), "status")


PLACED = "SELECT user_id AS pair_key, event_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM {events}"
TARGETS = """
  SELECT l.pair_key, l.event_id AS label_group, p.lo + (l.value - q.lo) / (q.hi - q.lo) * (p.hi - p.lo) AS target, 0.08 * (p.hi - p.lo) AS tolerance
  FROM (SELECT user_id AS pair_key, event_id, value FROM {events} WHERE event_type = 'click') l
  JOIN (SELECT user_id AS pair_key, min(value) AS lo, max(value) AS hi FROM {events} WHERE event_type = 'view' GROUP BY 1) p USING (pair_key)
  JOIN (SELECT user_id AS pair_key, min(value) AS lo, max(value) AS hi FROM {events} WHERE event_type = 'click' GROUP BY 1) q USING (pair_key) WHERE q.hi > q.lo"""


def targets(t):
    events = t("events").select(F.col("user_id").alias("pair_key"), "event_id", "event_type", "value")
    frames = events.select("pair_key", F.when(F.col("event_type") == "view", "pill_side").when(F.col("event_type") == "click", "label_side").otherwise("unknown").alias("side"), F.lit(True).alias("strip_detected"), F.col("value").alias("cumulative_pan_px"))
    labels = events.where("event_type = 'click'").select("pair_key", F.col("event_id").cast("int").alias("label_group"), F.col("value").alias("position"))
    photos = events.where("event_type = 'view'").select("pair_key", F.col("event_id").alias("bag_id"), F.col("value").alias("position"))
    return matching.position_targets(labels, matching.pan_ranges(frames)), photos


@register("position_targets", f"SELECT pair_key, label_group, round(target, 6) AS target, round(tolerance, 6) AS tolerance FROM ({TARGETS})")
def position_targets(t):
    return targets(t)[0].select("pair_key", F.col("label_group").cast("long").alias("label_group"), F.round("target", 6).alias("target"), F.round("tolerance", 6).alias("tolerance"))


@register(
    "position_candidates",
    f"""SELECT pair_key, label_group, event_id AS bag_id, round(distance, 6) AS distance FROM (
          SELECT t.pair_key, t.label_group, e.event_id, abs(e.value - t.target) AS distance, row_number() OVER (PARTITION BY t.pair_key, t.label_group ORDER BY abs(e.value - t.target), e.event_id) AS rank
          FROM ({TARGETS}) t JOIN {{events}} e ON e.user_id = t.pair_key AND e.event_type = 'view' AND abs(e.value - t.target) <= t.tolerance) WHERE rank <= 3""",
)
def position_candidates(t):
    wanted, photos = targets(t)
    return matching.position_candidates(wanted, photos).where("rank <= 3").select("pair_key", F.col("label_group").cast("long").alias("label_group"), "bag_id", F.round("distance", 6).alias("distance"))


#: The groups of a pair one after the other, each with the first of its photos (by distance) that none before it took.
WALK = """
  walk AS (
    SELECT pair_key, CAST(0 AS BIGINT) AS nth, CAST(NULL AS BIGINT) AS label_group, CAST(NULL AS BIGINT) AS bag_id, CAST([] AS BIGINT[]) AS taken FROM (SELECT DISTINCT pair_key FROM cand)
    UNION ALL
    SELECT pair_key, nth, label_group, bag_id, CASE WHEN bag_id IS NULL THEN taken ELSE list_append(taken, bag_id) END FROM (
      SELECT c.pair_key, c.nth, c.label_group, w.taken, list_filter(c.bags, lambda x: NOT list_contains(w.taken, x))[1] AS bag_id
      FROM walk w JOIN cand c ON c.pair_key = w.pair_key AND c.nth = w.nth + 1))"""


@register(
    "position_match_greedy",
    f"""WITH RECURSIVE near AS (
          SELECT t.pair_key, t.label_group, e.event_id AS bag_id, abs(e.value - t.target) AS distance FROM ({TARGETS}) t
          JOIN {{events}} e ON e.user_id = t.pair_key AND e.event_type = 'view' AND abs(e.value - t.target) <= t.tolerance WHERE e.event_id % 9 <> 0),
        cand AS (SELECT pair_key, label_group, list(bag_id ORDER BY distance, bag_id) AS bags, row_number() OVER (PARTITION BY pair_key ORDER BY label_group) AS nth FROM near GROUP BY 1, 2),
        {WALK}
        SELECT pair_key, label_group, bag_id, round(distance, 6) AS distance FROM walk JOIN near USING (pair_key, label_group, bag_id)""",
)
def position_match_greedy(t):
    """Each photo once, in the groups' order."""
    wanted, photos = targets(t)
    near = matching.position_candidates(wanted, photos)
    found = matching.position(near, photos.where("bag_id % 9 = 0"))
    return found.select("pair_key", F.col("label_group").cast("long").alias("label_group"), "bag_id", F.round("distance", 6).alias("distance"))


SIDES = """SELECT user_id AS pair_key, event_type, event_id, least(1.0, value / 200) AS quality, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value {down}, event_id {down}) - 1 AS rank FROM {{events}} WHERE event_type = '{kind}'"""


def zipped(down: str) -> str:
    p, q = SIDES.format(down="", kind="view"), SIDES.format(down=down, kind="click")
    return f"""WITH p AS ({p}), q AS ({q}), n AS (SELECT pair_key, count(p.event_id) AS np, count(q.event_id) AS nq FROM p FULL JOIN q USING (pair_key, rank) GROUP BY 1)
      SELECT pair_key, CAST(rank AS INT) AS order_index, p.event_id AS pill_bag, q.event_id AS label_bag,
             CASE WHEN p.event_id IS NOT NULL AND q.event_id IS NOT NULL THEN round(greatest(0.0, least(1.0, 0.55 + 0.25 * least(np, nq) / greatest(1, greatest(np, nq)) + 0.20 * (p.quality + q.quality) / 2.0)), 6) ELSE 0 END AS match_score
      FROM p FULL JOIN q USING (pair_key, rank) JOIN n USING (pair_key)"""


def zip_sides(t, reverse: bool):
    def side(kind: str):
        return t("events").where(F.col("event_type") == kind).select(F.col("user_id").alias("pair_key"), F.format_string("%010d", "event_id").alias("track_key"), F.col("event_id").alias("best_bag_id"), F.least(F.lit(1.0), F.col("value") / 200).alias("best_quality"), F.col("value").alias("center_norm"))

    return matching.ordinal(side("view"), side("click"), reverse=reverse).select("pair_key", "order_index", "pill_bag", "label_bag", "match_score")


@register("ordinal_zip", zipped(""))
def ordinal_zip(t):
    return zip_sides(t, False)


@register("ordinal_zip_reverse", zipped("DESC"))
def ordinal_zip_reverse(t):
    return zip_sides(t, True)


KEY = "concat({stem}, CAST(pair_key AS STRING), ':{side}:{kind}:', CASE WHEN {n} < 10000 THEN lpad(CAST({n} AS STRING), 4, '0') ELSE CAST({n} AS STRING) END)"


def _key(side: str, kind: str, number: str) -> str:
    return KEY.format(stem=f"'{side}'", side=f"{side}_side", kind=kind, n=number)


#: All tiers as relations, the position tier as a recursion over each pair's groups.
FULL = f"""WITH RECURSIVE o AS (SELECT bag_id, video AS pair_key, side, frame_index, value, quality_score, seam_prominence, mean_confidence, dose_date, dose_slot FROM {{obs}}),
  g AS (SELECT pair_key, side, dose_date, dose_slot, list(bag_id) AS bags, arg_max(bag_id, (mean_confidence, -bag_id)) AS best, sum(frame_index) / count(*) AS center, max(quality_score) AS quality FROM o WHERE side <> 'unknown' GROUP BY 1, 2, 3, 4),
  labs AS (SELECT g.*, row_number() OVER (PARTITION BY g.pair_key ORDER BY g.center, concat('sig|', g.dose_date, '|', g.dose_slot)) - 1 AS no, o.value AS position FROM g JOIN o ON o.bag_id = g.best WHERE g.side = 'label_side'),
  d AS (SELECT p.pair_key, l.no, p.best AS pill_bag, l.best AS label_bag, p.bags, row_number() OVER (PARTITION BY p.pair_key ORDER BY p.dose_date, p.dose_slot) - 1 AS order_index
        FROM g p JOIN labs l ON p.pair_key = l.pair_key AND p.dose_date = l.dose_date AND p.dose_slot = l.dose_slot WHERE p.side = 'pill_side'),
  used AS (SELECT pair_key, unnest(bags) AS bag_id FROM d),
  rest AS (SELECT * FROM labs l WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.pair_key = l.pair_key AND d.no = l.no)),
  r AS (SELECT pair_key, min(value) FILTER (side = 'pill_side') AS pl, max(value) FILTER (side = 'pill_side') AS ph, min(value) FILTER (side = 'label_side') AS ll, max(value) FILTER (side = 'label_side') AS lh FROM o GROUP BY 1),
  near AS (SELECT rest.pair_key, rest.no AS label_group, o.bag_id, abs(o.value - (pl + (position - ll) / (lh - ll) * (ph - pl))) AS distance FROM rest JOIN r ON r.pair_key = rest.pair_key JOIN o ON o.pair_key = rest.pair_key AND o.side = 'pill_side'
        WHERE rest.no % 4 <> 0 AND lh > ll AND abs(o.value - (pl + (position - ll) / (lh - ll) * (ph - pl))) <= 0.08 * (ph - pl) AND o.bag_id NOT IN (SELECT bag_id FROM used)),
  cand AS (SELECT pair_key, label_group, list(bag_id ORDER BY distance, bag_id) AS bags, row_number() OVER (PARTITION BY pair_key ORDER BY label_group) AS nth FROM near GROUP BY 1, 2),
  {WALK},
  nd AS (SELECT pair_key, count(*) AS n FROM d GROUP BY 1),
  s AS (SELECT w.pair_key, w.label_group AS no, w.bag_id, row_number() OVER (PARTITION BY w.pair_key ORDER BY w.label_group) - 1 + coalesce(nd.n, 0) AS order_index FROM walk w LEFT JOIN nd ON nd.pair_key = w.pair_key WHERE w.bag_id IS NOT NULL),
  ns AS (SELECT pair_key, count(*) AS n FROM s GROUP BY 1),
  e AS (SELECT *, seam_prominence >= 3.0 AS elevated FROM o WHERE side = 'pill_side'),
  z AS (SELECT *, elevated OR coalesce(frame_index - max(CASE WHEN elevated THEN frame_index END) OVER (PARTITION BY pair_key ORDER BY frame_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= 15
        AND min(CASE WHEN elevated THEN frame_index END) OVER (PARTITION BY pair_key ORDER BY frame_index ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) - frame_index <= 15, false) AS inside FROM e),
  zz AS (SELECT *, sum(CASE WHEN inside <> prev THEN 1 ELSE 0 END) OVER (PARTITION BY pair_key ORDER BY frame_index ROWS UNBOUNDED PRECEDING) AS no FROM (SELECT *, lag(inside) OVER (PARTITION BY pair_key ORDER BY frame_index) AS prev FROM z)),
  seams AS (SELECT pair_key, no, inside, list(bag_id) AS bags, arg_max(bag_id, (quality_score, -frame_index)) AS best, sum(frame_index) / count(*) AS center, max(quality_score) AS quality FROM zz GROUP BY 1, 2, 3),
  taken AS (SELECT pair_key, list(bag_id) AS ids FROM (SELECT pair_key, bag_id FROM used UNION ALL SELECT pair_key, bag_id FROM s) GROUP BY 1),
  p AS (SELECT *, row_number() OVER (PARTITION BY pair_key ORDER BY center, no) - 1 AS rank FROM (SELECT seams.* FROM seams LEFT JOIN taken ON taken.pair_key = seams.pair_key WHERE NOT inside AND NOT coalesce(list_has_any(bags, ids), false))),
  q AS (SELECT *, CASE WHEN pair_key % 2 = 0 THEN number ELSE count(*) OVER (PARTITION BY pair_key) - 1 - number END AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY pair_key ORDER BY center, no) - 1 AS number FROM rest WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.pair_key = rest.pair_key AND s.no = rest.no))),
  np AS (SELECT pair_key, count(*) AS n FROM p GROUP BY 1), nq AS (SELECT pair_key, count(*) AS n FROM q GROUP BY 1),
  m AS (SELECT coalesce(p.pair_key, q.pair_key) AS pair_key, coalesce(p.rank, q.rank) AS rank, p.no AS seam, p.best AS pill_bag, p.quality AS pq, q.number, q.best AS label_bag, q.quality AS lq FROM p FULL JOIN q ON p.pair_key = q.pair_key AND p.rank = q.rank),
  scored AS (SELECT m.*, CASE WHEN pill_bag IS NOT NULL AND label_bag IS NOT NULL THEN round(greatest(0.0, least(1.0, 0.55 + 0.25 * (least(np.n, nq.n) / greatest(1, greatest(np.n, nq.n))) + 0.20 * (pq + lq) / 2.0)), 6) ELSE 0.0 END AS score,
        rank + coalesce(nd.n, 0) + coalesce(ns.n, 0) AS order_index FROM m LEFT JOIN np ON np.pair_key = m.pair_key LEFT JOIN nq ON nq.pair_key = m.pair_key LEFT JOIN nd ON nd.pair_key = m.pair_key LEFT JOIN ns ON ns.pair_key = m.pair_key)
  SELECT pair_key, CAST(order_index AS INT) AS order_index, {_key("pill", "direct", "order_index")} AS pill_track, {_key("label", "direct", "order_index")} AS label_track, pill_bag, label_bag, label_bag AS label_ocr, CAST(1.0 AS DOUBLE) AS match_score, 'paired' AS status, 'direct' AS match_tier FROM d
  UNION ALL SELECT s.pair_key, CAST(s.order_index AS INT), {_key("pill", "position", "s.order_index").replace("CAST(pair_key", "CAST(s.pair_key")}, {_key("label", "position", "s.order_index").replace("CAST(pair_key", "CAST(s.pair_key")}, s.bag_id, labs.best, labs.best, CAST(0.75 AS DOUBLE), 'position_matched', 'position' FROM s JOIN labs ON labs.pair_key = s.pair_key AND labs.no = s.no
  UNION ALL SELECT pair_key, CAST(order_index AS INT), CASE WHEN pill_bag IS NOT NULL THEN {_key("pill", "seam", "seam")} END, CASE WHEN label_bag IS NOT NULL THEN {_key("label", "header", "number")} END, pill_bag, label_bag, label_bag, CAST(score AS DOUBLE),
        CASE WHEN pill_bag IS NULL THEN 'unmatched_label' WHEN label_bag IS NULL THEN 'unmatched_pill' WHEN score >= 0.70 THEN 'paired' ELSE 'review' END, CASE WHEN pill_bag IS NULL OR label_bag IS NULL THEN 'unmatched' ELSE 'ordinal' END FROM scored"""


@register("full_match_pipeline", FULL)
def full_match_pipeline(t):
    """All tiers over all pairs of recordings. Centres are frame numbers, so that means are exact."""

    def grouped(side: str):
        rows = t("obs").where(F.col("side") == side).withColumn("center_norm", F.col("frame_index").cast("double"))
        return grouping.by_header(rows.withColumn("items", F.expr(NO_ITEMS)).withColumn("pair_key", F.col("video")), ("pair_key",), merge=False)

    pills, labels = grouped("pill_side"), grouped("label_side")
    obs = t("obs").withColumn("pair_key", F.col("video"))
    places = obs.select(F.col("bag_id").alias("best_bag_id"), F.col("value").alias("position"))
    one = F.struct(F.lit(0).alias("line_index"), F.lit(1.0).alias("quantity"), F.lit("X").alias("drug_name"), F.lit(1.0).alias("dose_value"), F.lit("MG").alias("dose_unit"), F.lit("").alias("raw_line"))
    labels = labels.join(places, "best_bag_id").withColumn("merged_items", F.when(F.col("group_no") % 4 == 0, F.col("merged_items")).otherwise(F.array(one)))
    photos = obs.where("side = 'pill_side'").select("pair_key", "bag_id", F.col("value").alias("position"))
    seams = grouping.by_seam(obs.where("side = 'pill_side'").withColumn("center_norm", F.col("frame_index").cast("double")), ("pair_key",))
    frames = obs.select("pair_key", "side", F.lit(True).alias("strip_detected"), F.col("value").alias("cumulative_pan_px"))
    pairs = obs.select("pair_key").distinct().select("pair_key", F.concat(F.lit("pill"), F.col("pair_key").cast("string")).alias("pill_video"), F.concat(F.lit("label"), "pair_key").alias("label_video"), F.when(F.col("pair_key") % 2 == 0, "direct").otherwise("reverse").alias("direction"))
    return matching.match(pills, labels, photos, seams, frames, pairs)


@register("fuzzy_merge")
def fuzzy_merge(t):
    """Items of each brand's parts merged by name; the order decides, so there's no oracle."""
    items = t("part").select("p_brand", F.struct(F.lit(0).alias("line_index"), F.lit(1.0).alias("quantity"), F.upper("p_name").alias("drug_name"), F.when(F.col("p_size") % 3 != 0, F.col("p_size").cast("double")).alias("dose_value"), F.lit("MG").alias("dose_unit"), F.col("p_name").alias("raw_line")).alias("item"), "p_partkey")
    rows = items.groupBy("p_brand").agg(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "item"))), lambda x: x.item).alias("items")).withColumn("seq", F.lit(0).cast("long"))
    return grouping.merge_group_items(rows, ["p_brand"]).select("p_brand", F.inline("merged_items"))


@register(
    "fuzzy_merge_names",
    """SELECT p_brand, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY first) - 1 AS INT) AS line_index, 1.0::DOUBLE AS quantity, drug_name, dose_value, raw_line FROM (
         SELECT p_brand, upper(md5(concat(p_brand, CAST(p_partkey % 7 AS STRING)))) AS drug_name, min(p_partkey) AS first,
                CAST(arg_min(p_size, p_partkey) FILTER (p_size % 3 <> 0) AS DOUBLE) AS dose_value, arg_min(p_name, (p_size % 3 = 0, p_partkey)) AS raw_line FROM {part} GROUP BY 1, 2)""",
)
def fuzzy_merge_names(t):
    """Names that are equal or have little in common, so that a cluster is a name; the first with a dose stands for it."""
    name = F.upper(F.md5(F.concat("p_brand", (F.col("p_partkey") % 7).cast("string")).cast("binary")))
    item = F.struct(F.lit(0).alias("line_index"), F.lit(1.0).alias("quantity"), name.alias("drug_name"), F.when(F.col("p_size") % 3 != 0, F.col("p_size").cast("double")).alias("dose_value"), F.lit("MG").alias("dose_unit"), F.col("p_name").alias("raw_line"))
    rows = t("part").groupBy("p_brand").agg(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", item.alias("item")))), lambda x: x.item).alias("items")).withColumn("seq", F.lit(0).cast("long"))
    return grouping.merge_group_items(rows, ["p_brand"]).select("p_brand", F.inline("merged_items")).drop("dose_unit")


def tracker_input(t):
    """Vectors as observations: ten frames a label, five observations a frame."""
    e = t("embeddings")
    rn = F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1
    rows = e.withColumn("rn", rn).select(
        F.concat(F.lit("v"), "label").alias("video"), F.lit("pill_side").alias("side"), F.col("vec_id").alias("bag_id"), F.floor(F.col("rn") / 5).cast("int").alias("frame_index"),
        (F.col("rn") % 5).cast("int").alias("bag_index_in_frame"), ((F.col("rn") % 5) / 5.0 + 0.1).alias("center_norm"), ((F.col("vec_id") % 17) / 17.0).alias("quality_score"),
        F.lit(0.5).alias("segment_confidence"), F.col("embedding").alias("descriptor"),
    )
    return rows.withColumn("timestamp_seconds", F.col("frame_index") * 0.4)


@register("tracker")
def tracker(t):
    return tracking.track(tracker_input(t))


@register(
    "tracker_steady",
    """SELECT concat('v', CAST(label AS STRING)) AS video, vec_id AS bag_id, concat('v', CAST(label AS STRING), ':pill_side:track000', CAST(i + 1 AS STRING)) AS track_key,
              CASE WHEN f = 0 THEN 1.0 ELSE round(0.72 + 0.20 + 0.08 * greatest(0, 1 - abs(i - least(last, f - 1)) / last), 6) END AS score, coalesce(q > before, false) AS is_best
       FROM (SELECT *, greatest(1, count(*) OVER (PARTITION BY label, f) - 1) AS last, max(q) OVER (PARTITION BY label, i ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
             FROM (SELECT label, vec_id, rn // 5 AS f, rn % 5 AS i, (vec_id % 17) / 17.0 AS q FROM (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS rn FROM {embeddings})))""",
)
def tracker_steady(t):
    """Observations that look like their place in the frame and nothing else, so that each place is one track."""
    i = F.col("bag_index_in_frame")
    rows = tracker_input(t).withColumn("descriptor", F.array(*(F.when(i == k, 1.0).otherwise(0.0) for k in range(5))))
    return tracking.track(rows).select("video", "bag_id", "track_key", F.round("track_match_score", 6).alias("score"), "is_best")


@register("track_rollup", """SELECT concat('v', CAST(label AS STRING)) AS video, count(*) AS observation_count, arg_min(vec_id, rn) AS first_bag_id, arg_max(vec_id, rn) AS last_bag_id, arg_max(vec_id, (q, -rn)) AS best_bag_id, round(max(q), 6) AS best_quality
    FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rn, 0.65 * ((vec_id % 17) / 17.0) + 0.35 * 0.5 AS q FROM {embeddings}) GROUP BY 1""")
def track_rollup(t):
    obs = tracker_input(t)
    assigned = obs.select("video", "side", "bag_id", F.lit("k").alias("track_key"))
    return tracking.rollup(assigned, obs).select("video", "observation_count", "first_bag_id", "last_bag_id", "best_bag_id", "best_quality")


@register(
    "session_config",
    """SELECT concat('session_', lpad(CAST((rn - 1) // 2 AS STRING), 4, '0'), CASE WHEN b IS NULL THEN '_incompleta' ELSE '' END) AS pair_key, a AS pill_video, b AS label_video, CASE WHEN b IS NULL THEN 0 ELSE 1 END AS n_pairs
       FROM (SELECT CAST(event_id AS STRING) AS a, lead(CAST(event_id AS STRING)) OVER w AS b, row_number() OVER w AS rn FROM {events} WINDOW w AS (ORDER BY ts, CAST(event_id AS STRING))) WHERE rn % 2 = 1""",
)
def session_config(t):
    """The configuration of all recordings as one sequence: the sides of each session, and its pair if it is complete."""
    videos = t("events").select(F.col("event_id").cast("string").alias("stem"), F.col("ts").alias("capture_time"), F.lit("mtime").alias("time_source"))
    rows = grouping.session_config(grouping.sessions(videos))
    of = lambda side: F.get(F.map_keys(F.map_filter("video_sides", lambda k, v: v == side)), F.lit(0))
    return rows.select("pair_key", of("pill_side").alias("pill_video"), of("label_side").alias("label_video"), F.size("video_pairs").alias("n_pairs"))


@register("first_existing", "SELECT c_custkey AS key, min(CASE WHEN (c_custkey + k) % 4 = 0 THEN concat(CAST(k AS STRING), '/', CAST(c_custkey AS STRING)) END) AS path FROM {customer}, (VALUES (0), (1), (2)) AS v(k) WHERE (c_custkey + k) % 4 = 0 GROUP BY 1")
def first_existing(t):
    rank = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("rank")
    rows = t("customer").select(F.col("c_custkey").alias("key"), rank).withColumn("path", F.concat_ws("/", "rank", "key"))
    return readers.first_existing(rows, rows.where("(key + rank) % 4 = 0"))


