"""From a stream of read lines to sheets: segmentation, positions, pouch boundaries.

Inputs are rows ``(reading_id, line_no, line, y)``; windows run within a reading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULTS, Settings
from ..functions import text as T

BEFORE = (Window.unboundedPreceding, -1)
SO_FAR = (Window.unboundedPreceding, 0)


def _ordered(*keys: str) -> Window:
    return Window.partitionBy(*keys).orderBy("line_no")


def parsed_lines(lines: DataFrame, keys: tuple[str, ...] = ("reading_id",)) -> DataFrame:
    """Each line with its sheet's number and what it says: the items, or a part of the header.

    A weekday begins a new sheet if the sheet so far has items. That is the case exactly if a line
    with items lies between the weekday before and this one, so two running sums suffice.
    """
    w = _ordered(*keys)
    rows = lines.withColumn("line", F.trim("line")).where(F.col("line") != "")
    rows = rows.withColumns({"weekday": T.weekday(F.col("line")), "items": T.items(F.col("line")), "dosed": T.has_dose(F.col("line"))})
    rows = rows.withColumn("run", F.count("weekday").over(w.rowsBetween(*SO_FAR)))
    in_run = Window.partitionBy(*keys, "run")
    rows = rows.withColumn("run_has_items", F.max(F.size("items") > 0).over(in_run)).withColumn("first_in_run", F.row_number().over(in_run.orderBy("line_no")) == 1)
    # A run of lines starts with its weekday, which begins a sheet if the run before it has items.
    starts = F.col("weekday").isNotNull() & F.coalesce(F.lag("run_has_items").over(w), F.lit(False)) & F.col("first_in_run")
    rows = rows.withColumn("sheet_index", F.sum(starts.cast("int")).over(w.rowsBetween(*SO_FAR)).cast("int"))
    # The header ends with the first line that has a dose, whether or not it gives an item.
    s = Window.partitionBy(*keys, "sheet_index").orderBy("line_no")
    return rows.withColumn("in_header", ~F.max("dosed").over(s.rowsBetween(*SO_FAR))).drop("run", "run_has_items", "first_in_run")


def headers(parsed: DataFrame, keys: tuple[str, ...] = ("reading_id",)) -> DataFrame:
    """One header for each sheet: the last weekday, date and slot, and the first two other lines as name and place.

    Once a slot is known no later line is a name, and a line needs two letters in a row to be one.
    """
    group = [*keys, "sheet_index"]
    s = Window.partitionBy(*group).orderBy("line_no")
    rows = parsed.where("in_header").withColumns({"day": T.date(F.col("line")), "slot": T.slot(F.col("line"))})
    known = F.count("slot").over(s.rowsBetween(*SO_FAR)) > 0
    plain = F.col("weekday").isNull() & F.col("day").isNull() & ~known & F.upper("line").rlike("[A-ZÁÉÍÓÚÜÑ]{2,}")
    rows = rows.withColumn("plain", plain).withColumn("nth", F.sum(F.col("plain").cast("int")).over(s.rowsBetween(*SO_FAR)))
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("line_no")))
    nth = lambda n: F.max(F.when(F.col("plain") & (F.col("nth") == n), F.col("line")))
    return rows.groupBy(*group).agg(
        nth(1).alias("patient_name"), nth(2).alias("patient_location"),
        last("weekday").alias("dose_weekday"), last("day").alias("dose_date"), last("slot").alias("dose_slot"),
    )


def sheet_items(parsed: DataFrame, keys: tuple[str, ...] = ("reading_id",)) -> DataFrame:
    """The items of each sheet, numbered through it."""
    group = [*keys, "sheet_index"]
    rows = parsed.where(~F.col("in_header")).select(*group, "line_no", F.inline("items"))
    number = F.row_number().over(Window.partitionBy(*group).orderBy("line_no", "line_index")) - 1
    return rows.withColumn("line_index", number.cast("int")).drop("line_no")


def sheets(lines: DataFrame, keys: tuple[str, ...] = ("reading_id",)) -> DataFrame:
    """``keys, sheet_index, header, items``: a row for each sheet that has a header or items."""
    parsed = parsed_lines(lines, keys)
    group = [*keys, "sheet_index"]
    item = F.struct("line_index", "quantity", "drug_name", "dose_value", "dose_unit", "raw_line")
    listed = sheet_items(parsed, keys).groupBy(*group).agg(F.array_sort(F.collect_list(item)).alias("items"))
    parts = ("patient_name", "patient_location", "dose_weekday", "dose_date", "dose_slot")
    found = headers(parsed, keys).join(listed, group, "full")
    some = F.col("items").isNotNull() | F.coalesce(*parts).isNotNull()
    none = F.expr("cast(array() as array<struct<line_index: int, quantity: double, drug_name: string, dose_value: double, dose_unit: string, raw_line: string>>)")
    return found.where(some).select(*group, F.struct(*parts).alias("header"), F.coalesce("items", none).alias("items"))


def first_sheet(lines: DataFrame) -> DataFrame:
    """The first sheet of each reading; readings without one are absent."""
    return sheets(lines).withColumn("rank", F.row_number().over(Window.partitionBy("reading_id").orderBy("sheet_index"))).where("rank = 1").drop("rank")


def segment_of(y: Column, seams: Column) -> Column:
    """In which of N+1 intervals a position lies; a seam belongs to the one below it; nothing lies above 0."""
    return F.when(y >= 0, F.size(F.filter(seams, lambda s: s <= y)))


def sheets_by_seams(lines: DataFrame, seams: DataFrame) -> DataFrame:
    """Sheets parsed apart on each side of the seams ``(reading_id, seams array<double>)``.

    A reading without seams, or with an interval without lines, is parsed in its order alone, and
    its ``seam_side`` is null. One seam gives ``above`` and ``below``, more give ``segment_N``.
    """
    rows = lines.join(seams, "reading_id", "left").withColumn("seams", F.array_sort(F.coalesce("seams", F.expr("cast(array() as array<double>)"))))
    rows = rows.withColumn("segment", segment_of(F.col("y"), F.col("seams")))
    whole = Window.partitionBy("reading_id")
    filled = F.size(F.collect_set("segment").over(whole)) == F.size("seams") + 1
    rows = rows.withColumn("apart", filled & (F.size("seams") > 0)).withColumn("segment", F.when(F.col("apart"), F.col("segment")).otherwise(0))
    rows = rows.where(F.col("segment").isNotNull())
    side = F.when(~F.col("apart"), None).when(F.size("seams") == 1, F.when(F.col("segment") == 0, "above").otherwise("below")).otherwise(F.concat(F.lit("segment_"), F.col("segment")))
    sides = rows.select("reading_id", "segment", side.alias("seam_side")).distinct()
    found = sheets(rows.select("reading_id", "segment", "line_no", "line"), ("reading_id", "segment")).join(sides, ["reading_id", "segment"])
    number = F.row_number().over(Window.partitionBy("reading_id").orderBy("segment", "sheet_index")) - 1
    return found.withColumn("number", number.cast("int")).select("reading_id", F.col("number").alias("sheet_index"), "seam_side", "header", "items")


def footers(lines: DataFrame) -> DataFrame:
    """Positions of the lines that hold a footer's word."""
    return lines.where(T.is_footer(F.col("line"))).select("reading_id", "y")


def position_groups(positions: DataFrame, *, gap: float = DEFAULTS.footer_gap, key: str = "reading_id") -> DataFrame:
    """Positions whose steps are at most ``gap`` are one group: its number, mean, median and size."""
    w = Window.partitionBy(key).orderBy("y")
    rows = positions.withColumn("new", (F.col("y") - F.lag("y").over(w) > gap).cast("int"))
    rows = rows.withColumn("group_no", F.coalesce(F.sum("new").over(w.rowsBetween(*SO_FAR)), F.lit(0)).cast("int"))
    return rows.groupBy(key, "group_no").agg(F.avg("y").alias("mean_y"), F.floor(F.median("y")).cast("long").alias("median_y"), F.count("*").alias("n"))


def pouches(lines: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """``(reading_id, start, end, signature)`` of each pouch that is seen whole.

    It starts a margin above its weekday and ends with its footer's block: the first footer below,
    extended over lines that follow closely, up to the next pouch. A pouch without a footer is cut off.
    """
    margin, gap = settings.name_margin, settings.footer_gap
    days = lines.where(T.weekday(F.col("line")).isNotNull()).select("reading_id", F.col("y").alias("day_y"), F.col("line").alias("day_line"), "line_no")
    feet = footers(lines).groupBy("reading_id").agg(F.array_sort(F.collect_list("y")).alias("feet"))
    every = lines.groupBy("reading_id").agg(F.array_sort(F.collect_list("y")).alias("ys"))
    tops = days.groupBy("reading_id").agg(F.array_sort(F.collect_list("day_y")).alias("tops"))
    rows = days.join(feet, "reading_id").join(every, "reading_id").join(tops, "reading_id")
    rows = rows.withColumn("foot", F.array_min(F.filter("feet", lambda f: f > F.col("day_y")))).where("foot is not null")
    following = F.coalesce(F.array_min(F.filter("tops", lambda y: y > F.col("foot"))), F.lit(1.0))
    rows = rows.withColumn("limit", F.greatest(F.col("foot"), following - margin))
    reach = F.filter("ys", lambda y: (y >= F.col("foot")) & (y < F.col("limit")))
    end = F.aggregate(reach, F.col("foot"), lambda acc, y: F.when(y - acc <= gap, y).otherwise(acc))
    sig = T.signature(T.date(F.col("day_line")), T.slot(F.col("day_line")))
    text = F.when(sig.isNotNull(), F.concat_ws("|", sig.sig_date, sig.sig_slot)).otherwise(F.regexp_replace(F.upper(F.trim("day_line")), r"\s+", " "))
    return rows.select("reading_id", F.greatest(F.lit(0.0), F.col("day_y") - margin).alias("start"), end.alias("end"), text.alias("signature"), "line_no")


def new_signatures(found: DataFrame) -> DataFrame:
    """Pouches whose signature wasn't seen in an earlier frame; one frame's repeats all stay."""
    w = Window.partitionBy("signature").orderBy("frame_index")
    return found.withColumn("seen", F.dense_rank().over(w)).where("seen = 1").drop("seen")


def rows_of_boxes(boxes: DataFrame, *, least_score: float = 0.0, settings: Settings = DEFAULTS) -> DataFrame:
    """Read boxes ``(image_id, box_no, text, score, poly)`` joined into visual rows.

    By top edge, each box goes to the first row whose first box it overlaps enough; the order decides,
    so an image is one group of a grouped function. Blank and low-scored boxes are left out before.
    """
    import pandas as pd

    xs = F.transform("poly", lambda p: F.get(p, F.lit(0)))
    ys = F.transform("poly", lambda p: F.get(p, F.lit(1)))
    edge = lambda value, other: F.coalesce(value, F.lit(other))
    rows = boxes.withColumn("text", F.trim("text")).where((F.col("text") != "") & (F.col("score") >= least_score))
    rows = rows.select("image_id", "box_no", "text", "score", edge(F.array_min(ys), 0.0).alias("top"), edge(F.array_max(ys), 20.0).alias("bottom"), edge(F.array_min(xs), 0.0).alias("left"))

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        opened: list[tuple[float, float, list]] = []
        for b in pdf.sort_values(["top", "box_no"]).itertuples():
            for top, bottom, members in opened:
                shorter = min(bottom - top, b.bottom - b.top)
                if shorter > 0 and (min(bottom, b.bottom) - max(top, b.top)) / shorter >= settings.row_overlap:
                    members.append(b)
                    break
            else:
                opened.append((b.top, b.bottom, [b]))
        out = []
        for number, (top, bottom, members) in enumerate(opened):
            members.sort(key=lambda b: b.left)
            out.append((pdf["image_id"].iloc[0], number, " ".join(b.text for b in members), sum(b.score for b in members) / len(members), (top + bottom) / 2))
        return pd.DataFrame(out, columns=["image_id", "row_no", "line", "score", "y"])

    return rows.groupBy("image_id").applyInPandas(cluster, "image_id long, row_no int, line string, score double, y double")


def mean_confidence(scores: Column) -> Column:
    """The mean of an array of 0..1 scores in percent; 0 without any."""
    mean = F.aggregate(scores, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(scores), F.lit(0))
    return F.coalesce(F.round(100 * mean, 2), F.lit(0.0))


def merged_line(items: Column) -> Column:
    """Whether two items come from the same raw line."""
    raw = F.transform(items, lambda x: x.raw_line)
    return F.size(F.array_distinct(raw)) < F.size(raw)


def names_preview(items: Column) -> Column:
    return F.array_join(F.filter(F.transform(F.array_sort(items), lambda x: x.drug_name), lambda n: n.isNotNull()), "; ")
