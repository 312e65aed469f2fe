"""Queries that write and read again, read payloads and paths, and find seams in profiles."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions import scoring as S
from ..functions import text as T
from ..operators import sampling
from ..sources import readers, sinks
from ..streaming import streams
from .registry import register
from .relational import EXPORT, exported


def target(spark: SparkSession, name: str) -> str:
    """A new folder for what a query writes, in the shared folder; only a session in one process makes its own."""
    folder = sinks.shared_folder(spark)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="stripweave-")
    return f"{folder.rstrip('/')}/stripweave-{name}-{uuid.uuid4().hex}"


@register("json_export", "SELECT ocr_result_id, ocr_result_id % 5 AS part, count(*) AS n_items, sum(quantity) AS quantity, arg_max(raw_line, line_index) AS last_line FROM {items} GROUP BY 1")
def json_export(t):
    """Nested records as JSON lines, a folder for each part, read again."""
    spark = t("items").sparkSession
    items = F.array_sort(F.collect_list(F.struct("line_index", "quantity", "raw_line")))
    rows = t("items").groupBy("ocr_result_id").agg(items.alias("items")).withColumn("part", F.col("ocr_result_id") % 5)
    path = target(spark, "json")
    sinks.write_json(rows, path, by=["part"])
    found = readers.json_lines(spark, path, "ocr_result_id long, items array<struct<line_index int, quantity double, raw_line string>>, part long")
    total = F.aggregate("items", F.lit(0.0), lambda acc, x: acc + x.quantity)
    return found.select("ocr_result_id", "part", F.size("items").cast("long").alias("n_items"), total.alias("quantity"), F.element_at("items", -1).raw_line.alias("last_line"))


@register("csv_history", """SELECT s_suppkey AS id, concat('"', s_name, '", x') AS name, s_acctbal AS balance, concat('[', CAST(s_nationkey AS STRING), ',', CAST(s_suppkey AS STRING), ']') AS places FROM {supplier}
    UNION ALL SELECT c_custkey, concat('"', c_name, '", x'), c_acctbal, concat('[', CAST(c_nationkey AS STRING), ',', CAST(c_custkey AS STRING), ']') FROM {customer}""")
def csv_history(t):
    """Rows with quotes, commas and lists as CSV, more of them appended, all read again."""
    spark = t("supplier").sparkSession
    path = target(spark, "csv")
    for table, x, mode in (("supplier", "s_", "overwrite"), ("customer", "c_", "append")):
        key = f"{x}suppkey" if x == "s_" else f"{x}custkey"
        rows = t(table).select(F.col(key).alias("id"), F.concat(F.lit('"'), f"{x}name", F.lit('", x')).alias("name"), F.col(f"{x}acctbal").alias("balance"), F.array(F.col(f"{x}nationkey").cast("long"), key).alias("places"))
        sinks.write_csv(rows, path, mode=mode)
    return readers.csv_rows(spark, path).select(F.col("id").cast("long").alias("id"), "name", F.col("balance").cast("double").alias("balance"), "places")


@register(
    "catalog_versions",
    """SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN upper(c_name) ELSE c_name END AS name, CASE WHEN c_custkey % 3 = 0 THEN c_nationkey ELSE NULL END AS nation
       FROM {customer} WHERE c_custkey % 3 <> 0 OR c_nationkey >= 12
       UNION ALL SELECT c_custkey + 1000000, 'replaced', c_nationkey FROM {customer} WHERE c_custkey % 3 = 0 AND c_nationkey < 12""",
)
def catalog_versions(t):
    """Three versions of a table: written, merged with rows that have a further column, sets of some nations replaced."""
    customer = t("customer")
    catalog = sinks.Catalog(customer.sparkSession, target(customer.sparkSession, "catalog"))
    catalog.write("t", customer.selectExpr("c_custkey as id", "c_name as name"))
    third = customer.where("c_custkey % 3 = 0")
    catalog.upsert("t", third.selectExpr("c_custkey as id", "upper(c_name) as name", "c_nationkey as nation"), ["id"])
    catalog.replace_sets("t", third.where("c_nationkey < 12").selectExpr("c_custkey + 1000000 as id", "'replaced' as name", "c_nationkey as nation"), ["nation"])
    return catalog.read("t")


@register(
    "repaired_blobs",
    """SELECT c_custkey AS bag_id, CASE WHEN c_custkey % 4 = 0 THEN c_acctbal ELSE (1 + (c_custkey % 16384) / 16384.0) * pow(2, c_nationkey % 8) END AS seam_prominence, c_custkey % 4 <> 0 AS repaired FROM {customer}""",
)
def repaired_blobs(t):
    """Numbers that were stored as the four bytes of a 32-bit float: exponent from the nation, fraction from the key."""
    bits = F.lit(127 << 23) + (F.col("c_nationkey") % 8).cast("long") * (1 << 23) + F.col("c_custkey") % 16384 * 512
    blob = F.unhex(F.concat(*(F.lpad(F.hex(F.shiftright(bits, 8 * i).bitwiseAND(255)), 2, "0") for i in range(4))))
    broken = F.col("c_custkey") % 4 != 0
    bags = t("customer").select(F.col("c_custkey").alias("bag_id"), F.when(broken, blob).alias("seam_prominence_blob"), F.when(~broken, F.col("c_acctbal")).alias("seam_prominence"))
    rows, bad = sinks.repaired_prominence(bags)
    return rows.select("bag_id", "seam_prominence", bad.alias("repaired"))


PAYLOADS = """SELECT event_id AS image_id, CASE event_id % 4
         WHEN 0 THEN concat('{"rec_texts": ["', event_type, '", "u', CAST(user_id AS STRING), '"], "rec_scores": [0.5, 0.25]}')
         WHEN 1 THEN concat('{"res": {"rec_texts": ["', event_type, '"], "rec_scores": [0.75], "rec_polys": [[[1, 2], [', CAST(user_id % 90 AS STRING), ', 4]]]}}')
         WHEN 2 THEN concat('{"rec_texts": ["', event_type, '", "no score"], "rec_scores": [0.125]}') ELSE 'no json' END AS payload FROM"""


@register(
    "payload_boxes",
    """SELECT event_id AS image_id, CAST(0 AS BIGINT) AS box_no, event_type AS text, CAST(0.5 AS DOUBLE) AS score, 0 AS n_points, NULL AS last_x FROM {events} WHERE event_id % 4 = 0
       UNION ALL SELECT event_id, 1, concat('u', CAST(user_id AS STRING)), 0.25, 0, NULL FROM {events} WHERE event_id % 4 = 0
       UNION ALL SELECT event_id, 0, event_type, 0.75, 2, CAST(user_id % 90 AS DOUBLE) FROM {events} WHERE event_id % 4 = 1
       UNION ALL SELECT event_id, 0, event_type, 0.125, 0, NULL FROM {events} WHERE event_id % 4 = 2""",
)
def payload_boxes(t):
    """A reader's JSON, flat, under ``res``, with a text too many, or none at all."""
    events = t("events")
    events.createOrReplaceTempView("stripweave_events")
    found = readers.boxes_of(events.sparkSession.sql(f"{PAYLOADS} stripweave_events"))
    return found.select("image_id", "box_no", "text", "score", F.coalesce(F.size("poly"), F.lit(0)).alias("n_points"), F.get(F.get("poly", F.lit(1)), F.lit(0)).alias("last_x"))


@register(
    "path_parts",
    """SELECT bag_id, concat('C:/x/', crop_path) AS flat, CASE WHEN bag_id % 2 = 0 THEN crop_path ELSE right(crop_path, 1) END AS below_bags,
              concat('VID_', CAST(bag_id AS STRING), ':pill_side:track', lpad(CAST(bag_id % 1000 AS STRING), 4, '0')) AS track_key,
              concat('pair_', CAST(bag_id AS STRING)) AS pair_key, bag_id % 7 AS order_index FROM {bags}""",
)
def path_parts(t):
    path = F.replace(F.concat(F.lit("C:/x/"), "crop_path"), F.lit("/"), F.lit("\\"))
    other = F.when(F.col("bag_id") % 2 == 0, path).otherwise(F.replace(path, F.lit("bags"), F.lit("photos")))
    pair, number = sampling.key_parts(sampling.pouch_key(F.concat(F.lit("pair_"), F.col("bag_id").cast("string")), F.col("bag_id") % 7))
    key = T.track_key(F.concat(F.lit("VID_"), F.col("bag_id").cast("string")), "pill_side", "track", F.col("bag_id") % 1000)
    return t("bags").select("bag_id", T.forward_slashes(path).alias("flat"), T.from_bags(other).alias("below_bags"), key.alias("track_key"), pair.alias("pair_key"), number.cast("long").alias("order_index"))


@register(
    "segment_bounds",
    """WITH p AS (SELECT p_partkey, p_size + 400 AS height, p_partkey % 5 AS kind, p_partkey % 3 AS n FROM {part}),
         c AS (SELECT *, CASE n WHEN 0 THEN [0.0, 1.0] WHEN 1 THEN [0.0, 0.5, 1.0] ELSE [0.0, 0.25, 0.75, 1.0] END AS cuts FROM p),
         w AS (SELECT *, CASE kind WHEN 0 THEN 0 WHEN 1 THEN n WHEN 2 THEN 1 WHEN 3 THEN 9 ELSE NULL END AS nth FROM c)
       SELECT p_partkey, CASE WHEN n > 0 AND nth <= n THEN CAST(floor(cuts[nth + 1] * height) AS INT) ELSE 0 END AS low,
              CASE WHEN n > 0 AND nth <= n THEN CAST(floor(cuts[nth + 2] * height) AS INT) ELSE height END AS high FROM w""",
)
def segment_bounds(t):
    """The part of an image that a side of its seams names: above, below, by number, a number too high, or none."""
    kind, n = F.col("p_partkey") % 5, F.col("p_partkey") % 3
    side = F.when(kind == 0, "above").when(kind == 1, "below").when(kind == 2, "segment_1").when(kind == 3, "segment_9")
    seams = F.when(n == 0, F.expr("cast(array() as array<double>)")).when(n == 1, F.array(F.lit(0.5))).otherwise(F.array(F.lit(0.75), F.lit(0.25)))
    return t("part").select("p_partkey", T.segment_bounds(side, seams, F.col("p_size") + 400).alias("b")).select("p_partkey", "b.low", "b.high")


@register("resize_factors", "SELECT p_partkey, CASE WHEN 480.0 / least(p_size * 20, p_retailprice) > 1.01 THEN round(480.0 / least(p_size * 20, p_retailprice), 9) ELSE 1.0 END AS factor FROM {part}")
def resize_factors(t):
    return t("part").select("p_partkey", F.round(S.resize_factor(F.col("p_size") * 20, F.col("p_retailprice")), 9).alias("factor"))


@register("dead_letters", "SELECT event_id, event_type <> 'error' AS went_well, CASE WHEN event_type = 'error' THEN concat('bad ', CAST(event_id AS STRING)) END AS error FROM {events}")
def dead_letters(t):
    rows = t("events").select("event_id", F.when(F.col("event_type") == "error", F.concat(F.lit("bad "), F.col("event_id").cast("string"))).alias("error"))
    good, bad = streams.dead_letters(rows)
    return good.select("event_id", F.lit(True).alias("went_well"), F.lit(None).cast("string").alias("error")).unionByName(bad.select("event_id", F.lit(False).alias("went_well"), "error"))


@register(
    "task_documents",
    f"""WITH e AS ({EXPORT}), shown AS (SELECT DISTINCT b.crop_path, b.bag_id, concat(e.pair_key, '::', CAST(e.order_index AS STRING)) AS pouch FROM e JOIN {{pairs}} p USING (track_pair_id) JOIN {{bags}} b ON b.bag_id = p.pill_best_bag_id)
       SELECT concat('/data/local-files/?d=', crop_path) AS image, count(*) AS n_pouches, min(pouch) AS first_pouch, 1 + bag_id % 2 AS n_results,
              'pastilla_0' AS first_id, round(CAST(bag_id % 50 AS DOUBLE) / 2, 6) AS first_x FROM shown GROUP BY crop_path, bag_id""",
)
def task_documents(t):
    """Annotation tasks of the exported photos, as read from their JSON: one or two polygons each, in percent."""
    export = exported(t)
    index = sampling.photo_index(export)
    covered = sampling.coverage(index, index)
    photos = covered.join(t("bags").select("crop_path", "bag_id"), "crop_path").select("crop_path", "bag_id", F.lit(200).alias("width"), F.lit(100).alias("height"))
    numbers = F.sequence(F.lit(0).cast("long"), F.col("bag_id") % 2)
    corner = (F.col("bag_id") % 50).cast("double")
    polygons = photos.select("crop_path", F.explode(numbers).alias("number"), F.array(corner, F.lit(10.0), F.lit(150.0), F.lit(10.0), F.lit(150.0), F.lit(90.0)).alias("polygon"))
    tasks = sampling.task_documents(photos.drop("bag_id"), polygons, covered, export)
    schema = "data struct<image string, bolsitas_asociadas array<struct<value string>>>, predictions array<struct<result array<struct<id string, value struct<points array<array<double>>>>>>>"
    read = tasks.select(F.from_json("task", schema).alias("task"))
    result, pouches = F.get("task.predictions", F.lit(0)).result, F.col("task.data.bolsitas_asociadas")
    first = F.get(result, F.lit(0))
    return read.select(
        F.col("task.data.image").alias("image"), F.size(pouches).cast("long").alias("n_pouches"), F.substring_index(F.get(pouches, F.lit(0)).value, " | ", 1).alias("first_pouch"),
        F.size(result).cast("long").alias("n_results"), first.id.alias("first_id"), F.round(F.get(F.get(first.value.points, F.lit(0)), F.lit(0)), 6).alias("first_x"),
    )


def profiles(t) -> DataFrame:
    """A user's events in order as the rows of a profile ``(user_id, profile)``."""
    rows = t("events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("ts", "event_id", "value"))).alias("rows"))
    return rows.select("user_id", F.transform("rows", lambda r: r.value).alias("profile"))


PROFILE = """p AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS place, count(*) OVER (PARTITION BY user_id) AS n FROM {events}),
  m AS (SELECT user_id, median(value) AS middle FROM {events} GROUP BY 1)"""
#: Candidates are taken from the strongest down, unless one that was taken is too near.
TAKEN = """walk AS (SELECT user_id, 0 AS nth, CAST([] AS BIGINT[]) AS kept FROM m
    UNION ALL SELECT w.user_id, w.nth + 1, CASE WHEN len(list_filter(w.kept, lambda k: abs(k - c.place) < c.apart)) = 0 THEN list_append(w.kept, c.place) ELSE w.kept END
    FROM walk w JOIN cand c ON c.user_id = w.user_id AND c.nth = w.nth + 1),
  taken AS (SELECT user_id, arg_max(kept, nth) AS kept FROM walk GROUP BY 1)"""


@register(
    "strongest_seam",
    f"""WITH {PROFILE}, top AS (SELECT user_id, max(value) AS top, arg_max(place, (value, -place)) AS place, any_value(n) AS n FROM p GROUP BY 1)
       SELECT user_id, top / middle >= 3 AS found, CASE WHEN top / middle >= 3 THEN round(place / n, 9) END AS position, round(top / middle, 6) AS prominence FROM top JOIN m USING (user_id)""",
)
def strongest_seam(t):
    """Whether the highest row of a profile stands out from its median."""
    found = profiles(t).select("user_id", kernels.seam_band(F.col("profile")).alias("b"))
    return found.select("user_id", "b.found", F.round(F.when(F.col("b.found"), F.col("b.position")), 9).alias("position"), F.round("b.prominence", 6).alias("prominence"))


@register(
    "seam_peaks",
    f"""WITH RECURSIVE {PROFILE}, near AS (SELECT *, lag(value) OVER w AS before, lead(value) OVER w AS after FROM p WINDOW w AS (PARTITION BY user_id ORDER BY place)),
       cand AS (SELECT user_id, place, value / greatest(middle, 1e-6) AS ratio, greatest(1, CAST(floor(n * 0.12) AS BIGINT)) AS apart, n,
                  row_number() OVER (PARTITION BY user_id ORDER BY value / greatest(middle, 1e-6) DESC, place) AS nth
                FROM near JOIN m USING (user_id) WHERE value >= before AND value >= after AND value / greatest(middle, 1e-6) >= 3), {TAKEN}
       SELECT t.user_id, round(c.place / c.n, 9) AS position, round(c.ratio, 6) AS prominence FROM (SELECT user_id, unnest(kept) AS place FROM taken) t JOIN cand c ON c.user_id = t.user_id AND c.place = t.place""",
)
def seam_peaks(t):
    """All rows that stand out, none too near a stronger one."""
    found = profiles(t).select("user_id", F.inline(kernels.seam_bands(F.col("profile"))))
    return found.select("user_id", F.round("position", 9).alias("position"), F.round("prominence", 6).alias("prominence"))


@register(
    "inner_seams",
    f"""WITH RECURSIVE {PROFILE}, cut AS (SELECT *, CASE WHEN place < floor(n * 0.1) OR place >= n - floor(n * 0.1) THEN -1 ELSE value END AS v FROM p),
       marked AS (SELECT *, CASE WHEN v = lag(v) OVER (PARTITION BY user_id ORDER BY place) THEN 0 ELSE 1 END AS begins FROM cut),
       numbered AS (SELECT *, sum(begins) OVER (PARTITION BY user_id ORDER BY place) AS run FROM marked),
       runs AS (SELECT user_id, run, any_value(v) AS v, (min(place) + max(place)) // 2 AS place, any_value(n) AS n FROM numbered GROUP BY 1, 2),
       near AS (SELECT *, lag(v) OVER w AS before, lead(v) OVER w AS after FROM runs WINDOW w AS (PARTITION BY user_id ORDER BY run)),
       cand AS (SELECT user_id, place, n, greatest(1, CAST(floor(n * 0.08) AS BIGINT)) AS apart, row_number() OVER (PARTITION BY user_id ORDER BY v DESC, place DESC) AS nth
                FROM near JOIN m USING (user_id) WHERE v > before AND v > after AND v >= CASE WHEN middle > 1e-6 THEN middle * 3 ELSE 1e-6 END), {TAKEN}
       SELECT t.user_id, round(c.place / c.n, 9) AS position FROM (SELECT user_id, unnest(kept) AS place FROM taken) t JOIN cand c ON c.user_id = t.user_id AND c.place = t.place""",
)
def inner_seams(t):
    """Peaks off the borders; of a plateau its middle row."""
    found = profiles(t).select("user_id", F.explode(kernels.inner_seams(F.col("profile"))).alias("position"))
    return found.select("user_id", F.round("position", 9).alias("position"))
