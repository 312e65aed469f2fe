"""Queries over read text: items, headers, sheets, pouches, rows of boxes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import sheets
from .registry import register

#: The fields of a line of an item list, in DuckDB: one dose a line, ASCII text.
FORMS = "COMPRIMIDO|CAPSULA"


@register(
    "item_line_parse",
    """SELECT ocr_result_id, line_index, CAST(regexp_extract(raw_line, '^([0-9]+) ', 1) AS DOUBLE) AS quantity, regexp_extract(raw_line, '^[0-9]+ (.*) [0-9]+ MG$', 1) AS drug_name,
              CAST(regexp_extract(raw_line, ' ([0-9]+) MG$', 1) AS DOUBLE) AS dose_value, 'MG' AS dose_unit FROM {items}""",
)
def item_line_parse(t):
    rows = t("items").select("ocr_result_id", F.col("line_index").alias("at"), F.inline(T.items(F.col("raw_line"))))
    return rows.select("ocr_result_id", F.col("at").alias("line_index"), "quantity", "drug_name", "dose_value", "dose_unit")


@register(
    "merged_line_items",
    """SELECT ocr_result_id, line_index, k AS item, CASE WHEN k = 0 THEN quantity END AS quantity, CASE WHEN k = 0 THEN drug_name ELSE 'SECOND' END AS drug_name,
              CASE WHEN k = 0 THEN dose_value ELSE 1.5 END AS dose_value, CASE WHEN k = 0 THEN 'MG' ELSE 'MCG' END AS dose_unit FROM {items}, (VALUES (0), (1)) AS v(k)""",
)
def merged_line_items(t):
    """Two drugs read as one line."""
    line = F.concat("raw_line", F.lit(" SECOND COMPRIMID 1,5 UG"))
    rows = t("items").select("ocr_result_id", F.col("line_index").alias("at"), F.inline(T.items(line)))
    return rows.select("ocr_result_id", F.col("at").alias("line_index"), F.col("line_index").alias("item"), "quantity", "drug_name", "dose_value", "dose_unit")


@register("single_item_parse", "SELECT ocr_result_id, line_index, nullif(array_to_string(list_filter(string_split(drug_name, ' '), lambda w: length(w) >= 4), ' '), '') AS drug_name, dose_value, dose_unit FROM {items}")
def single_item_parse(t):
    x = T.single_item(F.col("raw_line"))
    return t("items").select("ocr_result_id", "line_index", x.drug_name.alias("drug_name"), x.dose_value.alias("dose_value"), x.dose_unit.alias("dose_unit"))


@register(
    "header_parse",
    """SELECT reading_id, line_no, CASE WHEN contains(lower(line), 'lunes') THEN 'LUNES' WHEN contains(lower(line), 'jueves') THEN 'JUEVES' END AS weekday,
              nullif(regexp_extract(line, '([0-9]{1,2}/[0-9]{1,2}/[0-9]{2,4})', 1), '') AS day,
              CASE WHEN contains(upper(line), 'DESAY') THEN 'DESAYUNO' WHEN contains(upper(line), 'COMI') THEN 'COMIDA' WHEN contains(upper(line), 'CEN') THEN 'CENA' END AS slot FROM {lines}""",
)
def header_parse(t):
    line = F.col("line")
    return t("lines").select("reading_id", "line_no", T.weekday(line).alias("weekday"), T.date(line).alias("day"), T.slot(line).alias("slot"))


@register("unit_normalize", "SELECT reading_id, line_no, CASE WHEN contains(line, 'MICROGRAMOS') OR contains(line, 'MCG') THEN 'MCG' ELSE 'MG' END AS unit FROM {lines} WHERE contains(line, 'COMPRIMIDO')")
def unit_normalize(t):
    rows = t("lines").select("reading_id", "line_no", F.inline(T.items(F.col("line"))))
    return rows.select("reading_id", "line_no", F.col("dose_unit").alias("unit"))


@register("normalize_text", "SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\\n', ' | ', 'g'), '\\s+', ' ', 'g'), '\\s*\\|\\s*', ' | ', 'g'), '[^0-9A-Za-zÀ-ÿ%+./()\\- |]', '', 'g'), '^[ |]+|[ |]+$', '', 'g') AS said FROM {documents}")
def normalize_text(t):
    return t("documents").select("doc_id", T.normalized(F.col("text")).alias("said"))


@register("clean_html", "SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS said FROM {pages}")
def clean_html(t):
    return t("pages").select("page_id", T.clean_html(F.col("html")).alias("said"))


@register("section_extract", "SELECT page_id, left(trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')), 600) AS said FROM {pages}")
def section_extract(t):
    html = F.concat(F.lit("<h1>3. Forma farmacéutica</h1>"), F.col("html"), F.lit("4. DATOS CLÍNICOS x"))
    return t("pages").select("page_id", T.section(html).alias("said"))


@register("accent_strip", "SELECT doc_id, strip_accents(text) AS said FROM {documents}")
def accent_strip(t):
    return t("documents").select("doc_id", T.without_accents(F.col("text")).alias("said"))


@register("merged_line_flag", "SELECT ocr_result_id, max(n) > 1 AS merged FROM (SELECT ocr_result_id, raw_line, count(*) AS n FROM {items} GROUP BY 1, 2) GROUP BY 1")
def merged_line_flag(t):
    rows = t("items").groupBy("ocr_result_id").agg(F.collect_list(F.struct("line_index", "raw_line")).alias("items"))
    return rows.select("ocr_result_id", sheets.merged_line(F.col("items")).alias("merged"))


@register("names_preview", "SELECT ocr_result_id, string_agg(drug_name, '; ' ORDER BY line_index) AS preview FROM {items} GROUP BY 1")
def names_preview(t):
    rows = t("items").groupBy("ocr_result_id").agg(F.collect_list(F.struct("line_index", "drug_name")).alias("items"))
    return rows.select("ocr_result_id", sheets.names_preview(F.col("items")).alias("preview"))


@register("needs_review_flag", "SELECT o.ocr_result_id, o.mean_confidence < 80 OR count(i.line_index) = 0 AS needs_review FROM {ocr} o LEFT JOIN {items} i USING (ocr_result_id) GROUP BY 1, o.mean_confidence")
def needs_review_flag(t):
    from ..functions.scoring import reading_needs_review

    n = t("items").groupBy("ocr_result_id").agg(F.count("*").alias("n"))
    rows = t("ocr").join(n, "ocr_result_id", "left")
    return rows.select("ocr_result_id", reading_needs_review(F.col("mean_confidence"), F.coalesce("n", F.lit(0)), F.lit(False)).alias("needs_review"))


# A weekday starts a sheet when an item came since the sheet's start: here each third turn has a weekday, the next an item.
SHEETS = """
  SELECT reading_id, CAST(sheet AS INT) AS sheet_index, max(CASE WHEN contains(line, '/03/26') THEN CASE WHEN contains(line, 'lunes') THEN 'LUNES' ELSE 'JUEVES' END END) AS dose_weekday,
         max(nullif(regexp_extract(line, '([0-9]+/[0-9]+/[0-9]+)', 1), '')) AS dose_date, max(CASE WHEN starts_with(line, 'PERSONA') THEN line END) AS patient_name,
         count(*) FILTER (contains(line, 'COMPRIMIDO')) AS n_items
  FROM (SELECT *, greatest(0, (line_no // 2) // 3) AS sheet FROM {lines}) GROUP BY 1, 2"""


@register("sheet_segmentation", SHEETS)
def sheet_segmentation(t):
    h = F.col("header")
    return sheets.sheets(t("lines")).select("reading_id", "sheet_index", h.dose_weekday.alias("dose_weekday"), h.dose_date.alias("dose_date"), h.patient_name.alias("patient_name"), F.size("items").cast("long").alias("n_items"))


@register("first_sheets", f"SELECT reading_id, n_items FROM ({SHEETS}) WHERE sheet_index = 0")
def first_sheets(t):
    return sheets.first_sheet(t("lines")).select("reading_id", F.size("items").cast("long").alias("n_items"))


@register("seam_bins", "SELECT reading_id, line_no, CASE WHEN y >= 0.7 THEN 2 WHEN y >= 0.33 THEN 1 ELSE 0 END AS segment FROM {lines}")
def seam_bins(t):
    return t("lines").select("reading_id", "line_no", sheets.segment_of(F.col("y"), F.array(F.lit(0.33), F.lit(0.7))).alias("segment"))


@register(
    "sheets_by_seams",
    """WITH two AS (SELECT reading_id, count(*) FILTER (y >= 0.34) > 0 AS apart FROM {lines} GROUP BY 1)
       SELECT reading_id, seam_side, count(*) AS n, CAST(sum(n_items) AS BIGINT) AS n_items FROM (
         SELECT reading_id, CASE WHEN apart THEN CASE WHEN y >= 0.34 THEN 'below' ELSE 'above' END END AS seam_side, greatest(0, (line_no // 2) // 3) AS sheet, count(*) FILTER (contains(line, 'COMPRIMIDO')) AS n_items
         FROM {lines} JOIN two USING (reading_id) GROUP BY 1, 2, 3) GROUP BY 1, 2""",
)
def sheets_by_seams(t):
    """One seam between the first sheet and the second; readings of one sheet fall back to their order."""
    seams = t("lines").select("reading_id").distinct().withColumn("seams", F.array(F.lit(0.34)))
    found = sheets.sheets_by_seams(t("lines"), seams)
    return found.groupBy("reading_id", "seam_side").agg(F.count("*").alias("n"), F.sum(F.size("items")).alias("n_items"))


@register(
    "pouch_boundaries",
    """SELECT reading_id, round(greatest(0.0, y - 0.05), 6) AS start, round(y + 0.22, 6) AS end_y,
              concat(regexp_extract(line, '([0-9]+/[0-9]+/[0-9]+)', 1), '|', CASE WHEN contains(line, 'DESAY') THEN 'DESAYUNO' WHEN contains(line, 'CEN') THEN 'CENA' ELSE 'COMIDA' END) AS signature
       FROM {lines} l WHERE contains(line, '/03/26') AND EXISTS (SELECT 1 FROM {lines} f WHERE f.reading_id = l.reading_id AND f.line_no = l.line_no + 4)""",
)
def pouch_boundaries(t):
    return sheets.pouches(t("lines")).select("reading_id", F.round("start", 6).alias("start"), F.round("end", 6).alias("end_y"), "signature")


@register("footer_positions", "SELECT reading_id, round(y, 6) AS y FROM {lines} WHERE contains(line, 'FARMACIA')")
def footer_positions(t):
    return sheets.footers(t("lines")).select("reading_id", F.round("y", 6).alias("y"))


@register(
    "position_groups",
    """SELECT user_id, CAST(group_no AS INT) AS group_no, round(avg(y), 6) AS mean_y, CAST(floor(median(y)) AS BIGINT) AS median_y, count(*) AS n FROM (
         SELECT user_id, y, sum(CASE WHEN y - prev > 3 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY y, event_id ROWS UNBOUNDED PRECEDING) AS group_no
         FROM (SELECT user_id, event_id, value AS y, lag(value) OVER (PARTITION BY user_id ORDER BY value, event_id) AS prev FROM {events})) GROUP BY 1, 2""",
)
def position_groups(t):
    rows = sheets.position_groups(t("events").select("user_id", F.col("value").alias("y")), gap=3.0, key="user_id")
    return rows.select("user_id", "group_no", F.round("mean_y", 6).alias("mean_y"), "median_y", "n")


@register("signature_dedup", "SELECT event_id FROM (SELECT event_id, dense_rank() OVER (PARTITION BY user_id, event_type ORDER BY ts) AS seen FROM {events}) WHERE seen = 1")
def signature_dedup(t):
    found = t("events").select("event_id", F.concat_ws("|", "user_id", "event_type").alias("signature"), F.col("ts").alias("frame_index"))
    return sheets.new_signatures(found).select("event_id")


@register("row_clustering")
def row_clustering(t):
    """Boxes of each user's events joined into visual rows."""
    i, v = F.col("event_id"), F.col("value")
    poly = F.array(F.array((i % 50).cast("double"), v), F.array((i % 50 + 9).cast("double"), v + 8))
    boxes = t("events").select(F.col("user_id").alias("image_id"), i.alias("box_no"), F.col("event_type").alias("text"), ((i % 100) / 100).alias("score"), poly.alias("poly"))
    return sheets.rows_of_boxes(boxes, least_score=0.1)


@register("mean_confidence", "SELECT user_id, round(100 * avg(least(1.0, value / 200)), 2) AS confidence FROM {events} GROUP BY 1")
def mean_confidence(t):
    rows = t("events").groupBy("user_id").agg(F.collect_list(F.least(F.lit(1.0), F.col("value") / 200)).alias("scores"))
    return rows.select("user_id", sheets.mean_confidence(F.col("scores")).alias("confidence"))
