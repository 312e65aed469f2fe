"""The domain's tables as projections of the driver's, in SQL that Spark and DuckDB read alike.

A projection names tables and other projections in braces. For Spark they become subqueries
over data frames, for DuckDB common table expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

DAY = "concat(lpad(CAST(day({0}) AS STRING), 2, '0'), '/', lpad(CAST(month({0}) AS STRING), 2, '0'), '/', lpad(CAST(year({0}) % 100 AS STRING), 2, '0'))"
SLOT = "CASE WHEN hour({0}) < 6 THEN 'AYUNAS' WHEN hour({0}) < 11 THEN 'DESAYUNO' WHEN hour({0}) < 15 THEN 'COMIDA' WHEN hour({0}) < 19 THEN 'MERIENDA' ELSE 'CENA' END"
PRIORITY_SLOT = "CASE o_orderpriority WHEN '1-URGENT' THEN 'AYUNAS' WHEN '2-HIGH' THEN 'DESAYUNO' WHEN '3-MEDIUM' THEN 'COMIDA' WHEN '5-LOW' THEN 'CENA' ELSE NULL END"

PROJECTIONS = {
    # Observations: a user's events are a recording, a view is the pill side and a click the label side.
    "obs": f"""
        SELECT event_id AS bag_id, event_id AS ocr_result_id, user_id AS video, ts,
               CASE event_type WHEN 'view' THEN 'pill_side' WHEN 'click' THEN 'label_side' ELSE 'unknown' END AS side,
               CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INT) AS frame_index,
               value, least(1.0, value / 200.0) AS quality_score, value / 40.0 AS seam_prominence,
               least(1.0, value / 150.0) AS segment_confidence, value AS mean_confidence,
               {DAY.format("ts")} AS dose_date, {SLOT.format("ts")} AS dose_slot, props
        FROM {{events}}""",
    "videos": """
        SELECT c_custkey AS video_id, concat('VID_', CAST(c_custkey AS STRING), '.mp4') AS filename,
               CASE WHEN c_nationkey % 2 = 0 THEN 'pill_side' ELSE 'label_side' END AS side,
               CASE WHEN c_acctbal > 2000 THEN 'completed' ELSE 'in_progress' END AS status,
               CAST(c_nationkey + 5 AS DOUBLE) AS fps, CAST(c_custkey % 900 AS INT) AS frame_count
        FROM {customer}""",
    "frames": """
        SELECT event_id AS frame_id, user_id AS video_id,
               CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INT) AS frame_index,
               value * 8 AS sharpness, value / 2 AS contrast, value / 1000 AS overexposed_ratio,
               event_type <> 'error' AS strip_detected,
               CASE WHEN event_type = 'signup' THEN NULL ELSE value - 50 END AS cumulative_pan_px
        FROM {events}""",
    "pairs": f"""
        SELECT o_orderkey AS track_pair_id, concat('pair_', CAST(o_custkey AS STRING)) AS pair_key,
               CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INT) AS order_index,
               o_custkey AS pill_best_bag_id, o_orderkey % 700 AS label_best_bag_id, o_orderkey AS label_ocr_result_id,
               CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey + 1 ELSE NULL END AS pill_ocr_result_id,
               CASE o_orderstatus WHEN 'F' THEN 'paired' WHEN 'P' THEN 'position_matched' ELSE 'review' END AS status,
               CASE o_orderstatus WHEN 'F' THEN 1.0 WHEN 'P' THEN 0.75 ELSE 0.5 END AS match_score,
               o_orderstatus <> 'F' AS needs_review, o_totalprice / 5000 AS ocr_confidence
        FROM {{orders}}""",
    "headers": f"""
        SELECT o_orderkey AS ocr_result_id, concat('NAME ', CAST(o_custkey AS STRING)) AS patient_name, {DAY.format("o_orderdate")} AS dose_date,
               {PRIORITY_SLOT} AS dose_slot, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'LUNES' END AS dose_weekday
        FROM {{orders}}""",
    "ocr": """
        SELECT o_orderkey AS ocr_result_id, CASE WHEN o_orderkey % 4 = 0 THEN 'above' WHEN o_orderkey % 4 = 1 THEN 'below' ELSE NULL END AS seam_side,
               o_totalprice / 5000 AS mean_confidence
        FROM {orders}""",
    "bags": """
        SELECT c_custkey AS bag_id, c_custkey AS frame_id, concat('bags/pill_side/', c_name, '.jpg') AS crop_path, round(c_acctbal / 10000, 4) AS seam_position,
               CASE WHEN c_custkey % 3 = 0 THEN concat('[', CAST(round(c_acctbal / 20000, 4) AS STRING), ', 0.9]') WHEN c_custkey % 3 = 1 THEN 'no json' ELSE NULL END AS seam_positions_json
        FROM {customer}""",
    "items": """
        SELECT l_orderkey AS ocr_result_id,
               CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity, l_discount, l_tax) - 1 AS INT) AS line_index,
               l_quantity AS quantity, upper(p_name) AS drug_name, CAST(p_size AS DOUBLE) AS dose_value, 'MG' AS dose_unit,
               concat(CAST(CAST(l_quantity AS INT) AS STRING), ' ', upper(p_name), ' ', CAST(p_size AS STRING), ' MG') AS raw_line
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey""",
    "reviews": """
        SELECT doc_id AS track_pair_id,
               CASE WHEN quality = 1 AND toxic = 0 THEN 'accepted' WHEN quality = 1 THEN 'corrected' WHEN toxic = 1 THEN 'rejected' ELSE 'pending' END AS decision,
               concat('note ', CAST(doc_id AS STRING)) AS reviewer_notes, '2024-01-01' AS reviewed_at
        FROM {labels}""",
    "review_items": """
        SELECT ocr_result_id AS track_pair_id, line_index, quantity / 2 AS quantity, drug_name, dose_value, dose_unit
        FROM {items} WHERE ocr_result_id IN (SELECT track_pair_id FROM {reviews} WHERE decision = 'corrected') AND line_index < 2""",
    # Read lines: a conversation is a reading, its turns are lines of a sheet.
    "lines": """
        SELECT conv_id AS reading_id, CAST(turn * 2 AS INT) AS line_no,
               CASE WHEN turn % 3 = 0 THEN concat(CASE WHEN conv_id % 2 = 0 THEN 'lunes ' ELSE 'jueves' END, lpad(CAST(conv_id % 28 + 1 AS STRING), 2, '0'), '/03/26', CASE WHEN conv_id % 5 = 0 THEN 'DESAYL' WHEN conv_id % 5 = 1 THEN ' CENA' ELSE ' COMIDA' END)
                    WHEN turn % 3 = 1 THEN concat(CAST(turn + 1 AS STRING), ' ', upper(role), 'INA ', CAST(10 * (conv_id % 9 + 1) AS STRING), CASE WHEN conv_id % 4 = 0 THEN ' MG' WHEN conv_id % 4 = 1 THEN ' MICROGRAMOS' WHEN conv_id % 4 = 2 THEN ' MO' ELSE ',5 MCG' END, ' COMPRIMIDO')
                    ELSE concat('FARMACIA ', upper(role)) END AS line,
               CAST(0.02 + turn * 0.11 AS DOUBLE) AS y
        FROM {conversations}
        UNION ALL
        SELECT DISTINCT conv_id, -1, concat('PERSONA ', CAST(conv_id AS STRING)), CAST(0 AS DOUBLE) FROM {conversations}""",
}


def _names(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table or a projection."""
    if name in BASE:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = PROJECTIONS[name]
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in _names(sql)})


def query(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in _names(sql)})


def oracle(sql: str) -> str:
    """DuckDB's form of a query over tables and projections in braces."""
    needed: list[str] = []

    def need(text: str) -> None:
        for n in _names(text):
            if n in PROJECTIONS and n not in needed:
                need(PROJECTIONS[n])
                needed.append(n)

    need(sql)
    plain = lambda s: re.sub(r"\{(\w+)\}", lambda m: f"p_{m[1]}" if m[1] in PROJECTIONS else m[1], s)
    heads = ", ".join(f"p_{n} AS ({plain(PROJECTIONS[n])})" for n in needed)
    body = plain(sql).strip()
    if not needed:
        return body
    for start in ("WITH RECURSIVE ", "WITH "):
        if body.upper().startswith(start):
            return f"{start}{heads}, {body[len(start) :]}"
    return f"WITH {heads} {body}"
