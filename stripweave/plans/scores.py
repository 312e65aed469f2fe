"""Queries over numbers: quality, colours, shapes, appearance, registry candidates, vectors, geometry."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scoring as S
from ..functions import text as T
from ..operators import identify, sampling
from .registry import register

WORDS = {**T.COLORS, **T.SHAPES}


@register(
    "quality_score",
    """SELECT frame_id, round(greatest(0.0, least(1.0, 0.55 * least(sharpness / 800, 1.0) + 0.35 * least(contrast / 80, 1.0) + 0.10 * (1 - least(overexposed_ratio / 0.35, 1.0)))), 4) AS quality_score FROM {frames}""",
)
def quality_score(t):
    return t("frames").select("frame_id", S.quality(F.col("sharpness"), F.col("contrast"), F.col("overexposed_ratio")).alias("quality_score"))


@register(
    "color_bucket",
    """SELECT event_id, CASE WHEN s < 30 THEN CASE WHEN v < 60 THEN 'negro' WHEN v < 120 THEN 'gris' ELSE 'blanco' END WHEN h < 10 OR h > 170 THEN 'rojo' WHEN h < 20 THEN 'naranja'
              WHEN h < 35 THEN 'amarillo' WHEN h >= 130 AND h < 170 THEN 'rosa' WHEN h >= 90 AND h < 130 THEN 'azul' WHEN h >= 35 AND h < 90 THEN 'verde' ELSE 'otro' END AS color
       FROM (SELECT event_id, event_id % 181 AS h, event_id * 7 % 256 AS s, event_id * 13 % 256 AS v FROM {events})""",
)
def color_bucket(t):
    i = F.col("event_id")
    return t("events").select("event_id", S.color(i % 181, i * 7 % 256, i * 13 % 256).alias("color"))


@register("median_color", "SELECT user_id, median(event_id % 181) AS h, median(event_id * 7 % 256) AS s, median(event_id * 13 % 256) AS v FROM {events} GROUP BY 1")
def median_color(t):
    i = F.col("event_id")
    return t("events").groupBy("user_id").agg(F.median(i % 181).alias("h"), F.median(i * 7 % 256).alias("s"), F.median(i * 13 % 256).alias("v"))


@register("robust_percentiles", "SELECT user_id, round(quantile_cont(value, 0.9), 6) AS p90, round(quantile_cont(value, 0.98), 6) AS p98, round(quantile_cont(value, 0.9) + 0.25 * (quantile_cont(value, 0.98) - quantile_cont(value, 0.9)), 6) AS threshold FROM {events} GROUP BY 1")
def robust_percentiles(t):
    p90, p98 = F.percentile("value", F.lit(0.9)), F.percentile("value", F.lit(0.98))
    return t("events").groupBy("user_id").agg(F.round(p90, 6).alias("p90"), F.round(p98, 6).alias("p98"), F.round(p90 + 0.25 * (p98 - p90), 6).alias("threshold"))


@register("shape_class", "SELECT l_orderkey, l_linenumber, l_quantity, l_tax, CASE WHEN a > 1.6 THEN 'alargado' WHEN a > 1.15 THEN 'ovalado' ELSE 'redondo' END AS shape FROM (SELECT *, greatest(l_quantity, l_linenumber * 6) / greatest(1.0, least(l_quantity, l_linenumber * 6)) AS a FROM {lineitem})")
def shape_class(t):
    ratio = S.aspect(F.col("l_quantity"), F.col("l_linenumber") * 6.0)
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", S.shape(ratio).alias("shape"))


@register("pill_filter", "SELECT event_id, area BETWEEN 0.0015 AND 0.05 AND aspect <= 3 AND extent <= 0.93 AND texture <= 15 AS is_pill, area BETWEEN 0.0005 AND 0.06 AS foreground FROM (SELECT event_id, value / 2000 AS area, 1 + event_id % 5 AS aspect, (event_id % 100) / 100.0 AS extent, event_id % 20 AS texture FROM {events})")
def pill_filter(t):
    i, area = F.col("event_id"), F.col("value") / 2000
    return t("events").select("event_id", S.is_pill(area, 1 + i % 5, (i % 100) / 100.0, i % 20).alias("is_pill"), S.is_foreground(area).alias("foreground"))


LOOKS = """SELECT p_partkey, p_brand AS drug, p_name AS presentation, p_size AS rank,
  concat('Comprimido ', CASE p_size % 5 WHEN 0 THEN 'blanco o blanquecino' WHEN 1 THEN 'rosado' WHEN 2 THEN 'azul' WHEN 3 THEN 'amarillos' ELSE 'de color crema' END, ', ',
         CASE p_partkey % 4 WHEN 0 THEN 'redondo' WHEN 1 THEN 'oblongo' WHEN 2 THEN 'capsula dura' ELSE 'ovalado' END) AS description FROM {part}"""


def looks(t):
    size, key = F.col("p_size") % 5, F.col("p_partkey") % 4
    color = F.when(size == 0, "blanco o blanquecino").when(size == 1, "rosado").when(size == 2, "azul").when(size == 3, "amarillos").otherwise("de color crema")
    shape = F.when(key == 0, "redondo").when(key == 1, "oblongo").when(key == 2, "capsula dura").otherwise("ovalado")
    return t("part").select("p_partkey", F.col("p_brand").alias("drug"), F.col("p_name").alias("presentation"), F.col("p_size").alias("rank"), F.concat(F.lit("Comprimido "), color, F.lit(", "), shape).alias("description"))



def _found(table: dict[str, str]) -> str:
    """DuckDB: the sorted distinct values as text."""
    each = ", ".join(f"CASE WHEN contains(lower(description), '{k}') THEN '{v}' END" for k, v in table.items())
    return f"array_to_string(list_sort(list_distinct([{each}])), ',')"


@register("keyword_sets", f"SELECT p_partkey, {_found(T.COLORS)} AS colors, {_found(T.SHAPES)} AS shapes FROM ({LOOKS})")
def keyword_sets(t):
    d = F.col("description")
    return looks(t).select("p_partkey", F.array_join(T.keywords(d, T.COLORS), ",").alias("colors"), F.array_join(T.keywords(d, T.SHAPES), ",").alias("shapes"))


PILLS = """SELECT * FROM (VALUES (0, 'blanco', 'redondo'), (1, 'rosa', 'alargado'), (2, 'azul', 'ovalado'), (3, 'verde', 'alargado')) AS v(pill_id, color, shape)"""

BEST = f"""
  SELECT pill_id, drug, max(score) AS score FROM (
    SELECT pill_id, drug, CASE WHEN contains(colors, color) THEN 2 ELSE 0 END + CASE WHEN contains(shapes, shape) THEN 1 ELSE 0 END
           + CASE WHEN contains(shapes, 'capsula') AND shape IN ('alargado', 'ovalado') THEN 1 ELSE 0 END AS score
    FROM ({PILLS}) CROSS JOIN (SELECT drug, {_found(T.COLORS)} AS colors, {_found(T.SHAPES)} AS shapes FROM ({LOOKS}))) GROUP BY 1, 2"""


def best(t):
    spark = t("part").sparkSession
    pills = spark.sql(PILLS).withColumn("image_id", F.lit(0))
    return identify.best_scores(pills, looks(t).withColumn("image_id", F.lit(0)))


@register("appearance_best", BEST)
def appearance_best(t):
    return best(t).select("pill_id", "drug", "score")


@register("top3_candidates", f"SELECT pill_id, drug, score, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY pill_id ORDER BY score DESC, drug) AS rank FROM ({BEST})) WHERE rank <= 3")
def top3_candidates(t):
    return identify.ranking(best(t)).select("pill_id", "drug", "score", "rank")


@register("slot_expansion", "SELECT s_suppkey, unnest(range(0, s_nationkey % 4)) AS unit FROM {supplier}")
def slot_expansion(t):
    expected = t("supplier").select(F.col("s_suppkey").alias("image_id"), F.lit("d").alias("drug"), (F.col("s_nationkey") % 4).alias("quantity"))
    return identify.slots(expected).select(F.col("image_id").alias("s_suppkey"), F.col("unit").cast("long").alias("unit"))


@register("optimal_assignment")
def optimal_assignment(t):
    """Pills of each image to expected units; equal totals leave a choice, so there's no oracle."""
    i = F.col("event_id")
    pills = t("events").select(F.col("user_id").alias("image_id"), i.alias("pill_id"), F.when(F.col("event_type") == "view", "blanco").otherwise("azul").alias("color"), F.lit("redondo").alias("shape"))
    named = looks(t).withColumns({"image_id": F.col("p_partkey") % 100, "drug": F.concat_ws("-", "drug", "p_partkey")})
    expected = named.select("image_id", "drug", (F.col("rank") % 3 + 1).alias("quantity"))
    shown = named.select("image_id", "drug", "presentation", "description", "rank")
    return identify.assign(identify.best_scores(pills, shown), expected)


@register(
    "assignment_total",
    f"""WITH sc AS (SELECT p_partkey, p_partkey % 100 AS bucket, rank % 3 + 1 AS quantity, color, CASE WHEN contains(colors, color) THEN 2 ELSE 0 END + CASE WHEN contains(shapes, 'redondo') THEN 1 ELSE 0 END AS score
          FROM (SELECT *, {_found(T.COLORS)} AS colors, {_found(T.SHAPES)} AS shapes FROM ({LOOKS})) CROSS JOIN (VALUES ('blanco'), ('azul')) AS v(color)),
        pl AS (SELECT event_id // 2 AS image_id, CASE WHEN event_type = 'view' THEN 'blanco' ELSE 'azul' END AS color, row_number() OVER (PARTITION BY event_id // 2 ORDER BY event_id) AS k FROM {{events}}),
        im AS (SELECT a.image_id, a.color AS one, b.color AS two FROM pl a LEFT JOIN pl b ON b.image_id = a.image_id AND b.k = 2 WHERE a.k = 1),
        best AS (SELECT x.bucket, x.color AS one, y.color AS two, max(x.score + y.score) AS total FROM sc x JOIN sc y ON x.bucket = y.bucket AND (x.p_partkey <> y.p_partkey OR x.quantity >= 2) GROUP BY ALL
                 UNION ALL SELECT bucket, color, NULL, max(score) FROM sc GROUP BY ALL)
        SELECT image_id, CAST(total AS BIGINT) AS total FROM im JOIN best ON best.bucket = im.image_id % 100 AND best.one = im.one AND best.two IS NOT DISTINCT FROM im.two""",
)
def assignment_total(t):
    """The greatest total score of images of two pills, which brute force over pairs of units can tell."""
    image = F.floor(F.col("event_id") / 2)
    pills = t("events").select(image.alias("image_id"), (image % 100).alias("list_id"), F.col("event_id").alias("pill_id"), F.when(F.col("event_type") == "view", "blanco").otherwise("azul").alias("color"), F.lit("redondo").alias("shape"))
    named = looks(t).withColumns({"list_id": F.col("p_partkey") % 100, "drug": F.concat_ws("-", "drug", "p_partkey")})
    expected = named.select("list_id", "drug", (F.col("rank") % 3 + 1).alias("quantity"))
    known = pills.join(named.select("list_id").distinct(), "list_id", "left_semi")
    found = identify.assign_listed(known, named.select("list_id", "drug", "presentation", "description", "rank"), expected)
    return found.groupBy("image_id").agg(F.sum(F.coalesce("score", F.lit(0))).alias("total"))


REGISTRY = "SELECT p_partkey AS nregistro, concat(p_type, ' ', p_name) AS name, CASE WHEN p_size % 2 = 0 THEN 'SMALL' WHEN p_size % 3 = 0 THEN 'ALFA' WHEN p_size % 5 = 0 THEN 'BETA' ELSE p_type END AS ingredient, p_size % 7 <> 0 AS marketed FROM {part}"


def registry_table(t):
    size = F.col("p_size")
    ingredient = F.when(size % 2 == 0, "SMALL").when(size % 3 == 0, "ALFA").when(size % 5 == 0, "BETA").otherwise(F.col("p_type"))
    return t("part").select(F.col("p_partkey").alias("nregistro"), F.concat_ws(" ", "p_type", "p_name").alias("name"), ingredient.alias("ingredient"), (size % 7 != 0).alias("marketed"))


@register(
    "union_dedup",
    f"""SELECT DISTINCT d.drug, r.nregistro, r.name FROM (VALUES ('small'), ('Economy'), ('promo red')) AS d(drug)
        JOIN ({REGISTRY}) r ON r.marketed AND (starts_with(upper(r.name), upper(d.drug)) OR upper(d.drug) = upper(r.ingredient))""",
)
def union_dedup(t):
    drugs = t("part").sparkSession.sql("SELECT * FROM VALUES ('small'), ('Economy'), ('promo red') AS d(drug)")
    return identify.presentations(drugs, registry_table(t)).select("drug", "nregistro", "name")


PARTS = "SELECT o_orderkey % 900 AS nregistro, CASE o_orderpriority WHEN '1-URGENT' THEN 'ALFA' WHEN '2-HIGH' THEN 'BETA' ELSE 'GAMMA' END AS ingredient FROM {orders}"


@register("combo_intersect", f"SELECT nregistro FROM ({PARTS}) WHERE ingredient = 'ALFA' INTERSECT SELECT nregistro FROM ({PARTS}) WHERE ingredient = 'BETA'")
def combo_intersect(t):
    p = F.col("o_orderpriority")
    rows = t("orders").select((F.col("o_orderkey") % 900).alias("nregistro"), F.lit("x").alias("name"), F.when(p == "1-URGENT", "ALFA").when(p == "2-HIGH", "BETA").otherwise("GAMMA").alias("ingredient"), F.lit(True).alias("marketed")).distinct()
    drugs = t("orders").sparkSession.sql("SELECT 'Alfa / beta' AS drug")
    return identify.presentations(drugs, rows).select("nregistro")


@register("soft_filter", "SELECT p_partkey, p_brand FROM (SELECT *, max(CASE WHEN p_size = 7 THEN 1 ELSE 0 END) OVER (PARTITION BY p_brand, p_type) AS any_fits FROM {part}) WHERE p_size = 7 OR any_fits = 0")
def soft_filter(t):
    return identify.soft_filter(t("part"), F.col("p_size") == 7, ("p_brand", "p_type")).select("p_partkey", "p_brand")


@register("cosine_similarity", """SELECT a.vec_id, b.vec_id AS other, round(greatest(0.0, least(1.0, list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) / (sqrt(list_dot_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[])) * sqrt(list_dot_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[]))))), 6) AS similarity
    FROM {embeddings} a JOIN {embeddings} b ON b.vec_id = a.vec_id + 1""")
def cosine_similarity(t):
    """Each vector with the one that follows it."""
    e = t("embeddings")
    following = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("vec_id").alias("other"), F.col("embedding").alias("next"))
    return e.join(following, "vec_id").select("vec_id", "other", F.round(S.cosine(F.col("embedding"), F.col("next")), 6).alias("similarity"))


@register("polygon_normalize", "SELECT l_orderkey, l_linenumber, l_extendedprice, round(l_quantity / 100, 6) AS x, round(l_linenumber / 50.0, 6) AS y FROM {lineitem}")
def polygon_normalize(t):
    flat = F.array(F.col("l_quantity"), F.col("l_linenumber").cast("double"))
    rows = t("lineitem").withColumn("n", S.normalized_polygon(flat, F.lit(100.0), F.lit(50.0)))
    return rows.select("l_orderkey", "l_linenumber", "l_extendedprice", F.round(F.get("n", F.lit(0)), 6).alias("x"), F.round(F.get("n", F.lit(1)), 6).alias("y"))


@register("box_overlap", "SELECT event_id, round(CASE WHEN least(h1 - l1, h2 - l2) > 0 THEN greatest(0.0, least(h1, h2) - greatest(l1, l2)) / least(h1 - l1, h2 - l2) ELSE 0 END, 6) AS overlap FROM (SELECT event_id, value AS l1, value + event_id % 9 AS h1, 40.0 AS l2, 40.0 + event_id % 7 AS h2 FROM {events})")
def box_overlap(t):
    i, v = F.col("event_id"), F.col("value")
    return t("events").select("event_id", F.round(S.overlap(v, v + i % 9, F.lit(40.0), F.lit(40.0) + i % 7), 6).alias("overlap"))


@register("band_assign", "SELECT event_id, CAST(value > 20 AS INT) + CAST(value > 55.5 AS INT) + CAST(value > 90 AS INT) AS band FROM {events}")
def band_assign(t):
    return t("events").select("event_id", S.band(F.col("value"), F.array(F.lit(20.0), F.lit(55.5), F.lit(90.0))).alias("band"))


@register("equal_cuts", "SELECT p_partkey, CAST(i * p_size * 40 // n AS INT) AS cut FROM (SELECT *, unnest(range(1, n)) AS i FROM (SELECT *, CAST(greatest(1, round_even(p_size * 40 / 360.0, 0)) AS BIGINT) AS n FROM {part}))")
def equal_cuts(t):
    height = F.col("p_size") * 40
    return t("part").select("p_partkey", F.explode(S.equal_cuts(height, F.lit(360))).alias("cut"))


@register("crop_intervals", """SELECT p_partkey, i AS crop, greatest(0, b[i] - CASE WHEN i > 1 THEN 10 ELSE 0 END) AS y0, least(h, b[i + 1] + CASE WHEN i < 3 THEN 10 ELSE 0 END) AS y1
    FROM (SELECT p_partkey, h, [0, CAST(floor(h / 3.0) AS INT), CAST(floor(h * 0.6) AS INT), h] AS b, unnest([1, 2, 3]) AS i FROM (SELECT p_partkey, p_size * 30 + 100 AS h FROM {part}))""")
def crop_intervals(t):
    height = F.col("p_size") * 30 + 100
    rows = t("part").select("p_partkey", F.posexplode(S.crops(F.array(F.lit(0.6), F.lit(1 / 3.0)), height, 10)).alias("crop", "x"))
    return rows.select("p_partkey", (F.col("crop") + 1).alias("crop"), "x.y0", "x.y1")


@register("yolo_labels", """SELECT o_orderkey AS image_id, coalesce(string_agg(line, chr(10) ORDER BY c), '') AS labels FROM {orders} LEFT JOIN (
    SELECT l_orderkey, l_quantity * 1000 + l_linenumber AS c, concat('0 ', printf('%.6f', l_quantity / 100), ' ', printf('%.6f', l_linenumber / 50.0)) AS line FROM {lineitem} GROUP BY ALL) ON l_orderkey = o_orderkey GROUP BY 1""")
def yolo_labels(t):
    images = t("orders").select(F.col("o_orderkey").alias("image_id"), F.lit("x\\bags\\a.jpg").alias("file_name"), F.lit(100.0).alias("width"), F.lit(50.0).alias("height"))
    lines = t("lineitem").select((F.col("l_quantity") * 1000 + F.col("l_linenumber")).alias("annotation_id"), F.col("l_orderkey").alias("image_id"), F.array(F.col("l_quantity"), F.col("l_linenumber").cast("double")).alias("polygon")).distinct()
    return sampling.yolo_labels(images, lines).select("image_id", "labels")


@register("status_labels", "SELECT track_pair_id, CASE WHEN status = 'paired' AND match_score >= 0.999 THEN 'verified by content' WHEN status = 'position_matched' THEN 'by position' ELSE 'to review' END AS shown FROM {pairs}")
def status_labels(t):
    return t("pairs").select("track_pair_id", T.status_label(F.col("status"), F.col("match_score")).alias("shown"))
