import datetime
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stripweave import cli
from stripweave.operators import grouping, identify, matching, review, sampling, sheets, tracking
from stripweave.sources import readers, sinks

SHEET = ["PERSONA UNO", "VILLA EJEMPLO", "51", "lunes 02/03/26 DESAYUNO", "1 ALFAPRUEBA 0,266 MG CAPSULA", "2 BETAPRUEBA 25 MICROGRAMOS COMPRIMIDO", "1 GAMMA/DELTA 20/12,5 MG COMPRIMIDO", "FARMACIA EJEMPLO", "900 00 00 00"]
SECOND = ["PERSONA DOS", "martes 03/03/26CENA", "1 OMEGA 5 MG", "FARMAOIA EJEMPLO"]


def lines(spark, *readings):
    rows = [(r, i, line, (i + 1) / 40) for r, reading in enumerate(readings) for i, line in enumerate(reading)]
    return spark.createDataFrame(rows, "reading_id long, line_no int, line string, y double")


def shown(rows):
    return {(r.reading_id, r.sheet_index): (r.header.patient_name, r.header.patient_location, r.header.dose_weekday, r.header.dose_date, r.header.dose_slot, [x.drug_name for x in r["items"]]) for r in rows.collect()}


FIRST = ("PERSONA UNO", "VILLA EJEMPLO", "LUNES", "02/03/26", "DESAYUNO", ["ALFAPRUEBA", "BETAPRUEBA", "GAMMA/DELTA"])


def test_sheets(spark):
    found = shown(sheets.sheets(lines(spark, SHEET, SHEET + SECOND, ["hola", "", "  "], [])))
    assert found[0, 0] == FIRST and found[1, 0] == FIRST
    # A second sheet has no name when only the order tells it apart.
    assert found[1, 1] == (None, None, "MARTES", "03/03/26", "CENA", ["OMEGA"])
    assert found[2, 0][0] == "hola" and len(found) == 4
    items = sheets.sheets(lines(spark, SHEET)).first()["items"]
    assert [x.line_index for x in items] == [0, 1, 2] and items[2].dose_value is None
    assert sheets.first_sheet(lines(spark, SHEET + SECOND)).count() == 1


def fold(reading):
    """Sheets by a plain left fold, as a reference for the windowed form."""
    out, weekday, items = [], None, 0
    for line in reading:
        if items and line.startswith("W"):
            out.append((weekday, items))
            weekday, items = None, 0
        if line.startswith("W") and not items:
            weekday = line
        items += line.startswith("I")
    return [*out, (weekday, items)]


def test_segmentation_agrees_with_a_fold(spark):
    import random

    r = random.Random(3)
    readings = [[r.choice("WIN") for _ in range(r.randint(1, 12))] for _ in range(200)]
    said = {"W": "lunes", "I": "1 ALFA 5 MG", "N": "FARMACIA"}
    parsed = sheets.parsed_lines(lines(spark, *[[said[x] for x in reading] for reading in readings]))
    n = parsed.groupBy("reading_id").agg(F.max("sheet_index").alias("last")).collect()
    assert {x.reading_id: x["last"] + 1 for x in n} == {i: len(fold(reading)) for i, reading in enumerate(readings)}


def test_sheets_by_seams(spark):
    both = lines(spark, SHEET + SECOND, SHEET + SECOND, SHEET, SHEET + SECOND)
    seams = spark.createDataFrame([(0, [9.5 / 40]), (2, [0.9]), (3, [9.5 / 40, 11.5 / 40])], "reading_id long, seams array<double>")
    rows = sheets.sheets_by_seams(both, seams)
    sides = {(r.reading_id, r.sheet_index): r.seam_side for r in rows.collect()}
    found = shown(rows)
    assert found[0, 0] == FIRST and found[0, 1][0] == "PERSONA DOS" and (sides[0, 0], sides[0, 1]) == ("above", "below")
    assert sides[1, 1] is None and sides[2, 0] is None and found[2, 0] == FIRST  # no seam; an empty side
    assert [sides[3, i] for i in range(3)] == ["segment_0", "segment_1", "segment_2"]


def test_lines_out_of_order_stay_on_their_side(spark):
    mixed = [(0, 0, "lunes 02/03/26 DESAYUNO", 0.1), (0, 1, "martes 03/03/26 CENA", 0.6), (0, 2, "1 ALFA 5 MG", 0.2), (0, 3, "1 BETA 5 MG", 0.7)]
    rows = spark.createDataFrame(mixed, "reading_id long, line_no int, line string, y double")
    found = shown(sheets.sheets_by_seams(rows, spark.createDataFrame([(0, [0.5])], "reading_id long, seams array<double>")))
    assert found[0, 0][5] == ["ALFA"] and found[0, 1][5] == ["BETA"]


def test_pouches(spark):
    rows = [(0, i, line, y) for i, (line, y) in enumerate([("FARMACIA A", 0.02), ("lunes 01/03/26 CENA", 0.10), ("1 X 5 MG", 0.15), ("FARMACIA A", 0.30), ("900", 0.34), ("www", 0.39), ("martes 02/03/26DESAYL", 0.50), ("FARMAGIA A", 0.60), ("x", 0.75), ("jueves 03/03/26", 0.9)])]
    found = sheets.pouches(spark.createDataFrame(rows, "reading_id long, line_no int, line string, y double")).orderBy("start").collect()
    assert [(round(r.start, 3), r.end, r.signature) for r in found] == [(0.05, 0.39, "01/03/26|CENA"), (0.45, 0.6, "02/03/26|DESAYUNO")]
    frames = spark.createDataFrame([("s", 1, "a"), ("s", 2, "b"), ("t", 2, "c"), ("s", 1, "d")], "signature string, frame_index int, k string")
    assert {r.k for r in sheets.new_signatures(frames).collect()} == {"a", "c", "d"}


def test_rows_of_boxes(spark):
    box = lambda x, y: [[x, y], [x + 20.0, y], [x + 20.0, y + 10.0], [x, y + 10.0]]
    rows = [(1, 0, "ALFA", 0.9, box(30.0, 2.0)), (1, 1, " 1 ", 0.7, box(0.0, 0.0)), (1, 2, "noise", 0.1, box(0.0, 1.0)), (1, 3, "BETA", 0.8, box(0.0, 20.0)), (1, 4, " ", 0.9, box(0.0, 40.0)), (2, 0, "a", 0.9, None)]
    rows += [(3, i, f"t{i}", 0.9, box(0.0, 6.0 * i)) for i in range(4)]  # each overlaps the next less than half
    found = sheets.rows_of_boxes(spark.createDataFrame(rows, "image_id long, box_no long, text string, score double, poly array<array<double>>"), least_score=0.5).orderBy("image_id", "row_no").collect()
    assert [(r.image_id, r.line) for r in found] == [(1, "1 ALFA"), (1, "BETA"), (2, "a"), (3, "t0"), (3, "t1"), (3, "t2"), (3, "t3")]
    assert abs(found[0].score - 0.8) < 1e-9 and found[0].y == 5.0


def observations(spark, rows):
    ddl = "video string, bag_id long, ocr_result_id long, center_norm double, quality_score double, mean_confidence double, dose_date string, dose_slot string, items array<struct<line_index: int, quantity: double, drug_name: string, dose_value: double, dose_unit: string, raw_line: string>>"
    return spark.createDataFrame(rows, ddl)


def it(*names, dose=5.0):
    return [(i, 1.0, n, dose, "MG", n) for i, n in enumerate(names)]


def test_by_header(spark):
    rows = observations(spark, [
        ("v", 1, 11, 0.1, 0.3, 50.0, "01/03/26", "CENA", it("ALFA")), ("v", 2, 12, 0.3, 0.9, 90.0, "01/03/26", "cena", it("ALFA", "BETA")), ("v", 3, 13, 0.2, 0.1, 99.0, "01/03/26", "CÉNA", it("gamma", dose=None)),
        ("v", 4, 14, 0.9, 0.5, 10.0, None, "CENA", it("ALFA")), ("v", 5, 15, 0.8, 0.5, 10.0, None, None, it("ALFA")), ("v", 6, 16, 0.7, 0.5, 10.0, "02/03/26", "CENA", []),
    ])
    found = grouping.by_header(rows).orderBy("group_no").collect()
    assert [r.bag_ids for r in found] == [[1, 2, 3], [6], [5], [4]]
    first = found[0]
    assert first.best_bag_id == 2 and first.ocr_result_id == 12 and abs(first.center_norm - 0.2) < 1e-9 and first.best_quality == 0.9
    assert [x.drug_name for x in first.merged_items] == ["ALFA", "gamma", "BETA"] and [x.line_index for x in first.merged_items] == [0, 1, 2]
    assert found[1].merged_items == [] and [x.drug_name for x in found[2].merged_items] == ["ALFA"] and found[2].sig_date is None


def test_by_seam(spark):
    golden = [14.44, 4.82, 1.88, 9.74, 8.41, 2.41, 2.49, 12.54]
    frames = [80, 90, 100, 110, 120, 130, 140, 190]
    rows = [("v", i + 1, f, p, 0.1 * i, 0.5) for i, (f, p) in enumerate(zip(frames, golden))] + [("w", 20 + i, 500 * i, p, 0.1, 0.5) for i, p in enumerate((10.0, 1.0, None))]
    found = grouping.by_seam(spark.createDataFrame(rows, "video string, bag_id long, frame_index int, seam_prominence double, quality_score double, center_norm double"))
    got = {(r.video, r.group_no): (r.bag_ids, r.in_transition, r.best_bag_id) for r in found.collect()}
    assert got["v", 0] == ([1, 2, 3, 4, 5], True, 5) and got["v", 1] == ([6, 7], False, 7) and got["v", 2] == ([8], True, 8)
    assert got["w", 0][1] and not got["w", 1][1] and got["w", 1][0] == [21, 22]


def test_sessions(spark, tmp_path):
    at = lambda s: datetime.datetime(2026, 3, 1, 10) + datetime.timedelta(seconds=s)
    rows = spark.createDataFrame([("b", at(32), "metadata"), ("a", at(0), "metadata"), ("d", at(700), "mtime"), ("c", at(200), "metadata"), ("e", at(900), "mtime")], "stem string, capture_time timestamp, time_source string")
    found = grouping.sessions(rows).orderBy("pair_key").collect()
    assert [(r.pill_video, r.label_video, r.gap_seconds, r.status, r.time_source) for r in found] == [("a", "b", 32.0, "ok", "metadata"), ("c", "d", 500.0, "needs_review", "mtime"), ("e", None, 0.0, "needs_review", "mtime")]
    assert found[2].pair_key == "session_0002_incompleta"
    config = grouping.session_config(grouping.sessions(rows)).orderBy("pair_key").collect()
    assert [r.video_sides for r in config] == [{"a": "pill_side", "b": "label_side"}, {"c": "pill_side", "d": "label_side"}, {"e": "pill_side"}]
    assert [[p.pair_key for p in r.video_pairs] for r in config] == [["session_0000"], ["session_0001"], []]
    sinks.write_json(grouping.session_config(grouping.sessions(rows)), str(tmp_path / "sessions"))
    settings = cli.settings_of(str(tmp_path / "sessions"))
    assert settings.video_sides == {"a": "pill_side", "b": "label_side", "c": "pill_side", "d": "label_side", "e": "pill_side"} and len(settings.video_pairs) == 2


def side(spark, *rows):
    return spark.createDataFrame([("p", *r) for r in rows], "pair_key string, track_key string, best_bag_id long, best_quality double, center_norm double")


def test_ordinal(spark):
    pills, labels = side(spark, ("a", 1, 1.0, 0.1), ("b", 2, 1.0, 0.9)), side(spark, ("x", 7, 1.0, 0.5))
    found = matching.ordinal(pills, labels, reverse=False).orderBy("order_index").collect()
    assert [(r.pill_bag, r.label_bag, r.match_score, r.status) for r in found] == [(1, 7, 0.875, "paired"), (2, None, 0.0, "unmatched_pill")]
    found = matching.ordinal(pills, side(spark, ("x", 7, 1.0, 0.2), ("y", 8, 1.0, 0.8)), reverse=True).orderBy("order_index").collect()
    assert [(r.pill_bag, r.label_bag, r.match_score) for r in found] == [(1, 8, 1.0), (2, 7, 1.0)]
    assert matching.ordinal(pills.limit(0), labels, reverse=False).first().status == "unmatched_label"


def test_position(spark):
    wanted = spark.createDataFrame([("p", 0, -100.0, 100.0), ("p", 1, -110.0, 100.0), ("p", 2, -120.0, 100.0), ("q", 0, 0.0, 0.0)], "pair_key string, label_group int, target double, tolerance double")
    photos = spark.createDataFrame([("p", 1, -100.0), ("p", 2, -150.0), ("p", 3, -201.0), ("p", 4, 500.0), ("q", 9, 0.0)], "pair_key string, bag_id long, position double")
    near = matching.position_candidates(wanted, photos)
    assert {(r.label_group, r.bag_id) for r in near.where("pair_key = 'p' and label_group = 0").collect()} == {(0, 1), (0, 2)}
    found = {(r.pair_key, r.label_group): r.bag_id for r in matching.position(near, spark.createDataFrame([], "pair_key string, bag_id long")).collect()}
    assert found == {("p", 0): 1, ("p", 1): 2, ("p", 2): 3, ("q", 0): 9}
    taken = spark.createDataFrame([("p", 1)], "pair_key string, bag_id long")
    assert {r.label_group: r.bag_id for r in matching.position(near, taken).where("pair_key = 'p'").collect()} == {0: 2, 1: 3}


def test_tracker(spark):
    def obs(bag, frame, center, vector, quality=0.5):
        return ("v", "pill_side", bag, frame, frame * 0.4, 0, center, quality, 0.5, vector)

    ddl = "video string, side string, bag_id long, frame_index int, timestamp_seconds double, bag_index_in_frame int, center_norm double, quality_score double, segment_confidence double, descriptor array<float>"
    rows = spark.createDataFrame([obs(1, 0, 0.5, [1.0, 0.0]), obs(2, 1, 0.52, [0.99, 0.1], 0.9), obs(3, 2, 0.5, [0.0, 1.0]), obs(4, 60, 0.5, [1.0, 0.0])], ddl)
    found = {r.bag_id: r for r in tracking.track(rows).collect()}
    assert found[1].track_key == found[2].track_key == "v:pill_side:track0001" and found[2].is_best and not found[1].is_best
    assert found[3].track_key.endswith("0002") and found[4].track_key.endswith("0003") and found[4].track_match_score == 1.0  # too unlike; too late
    table = {r.track_key[-4:]: r for r in tracking.rollup(tracking.track(rows), rows).collect()}
    assert (table["0001"].observation_count, table["0001"].first_bag_id, table["0001"].last_bag_id, table["0001"].best_bag_id) == (2, 1, 2, 2)


def slow_tracks(observations, s=tracking.DEFAULTS):
    """One side's tracks by the rule, pair by pair."""
    unit = lambda v: np.array(v) / max(np.linalg.norm(v), 1e-8)
    tracks, out = [], {}
    for f in sorted({o[1] for o in observations}):
        frame = sorted((o for o in observations if o[1] == f), key=lambda o: o[3])
        last, pairs = max(1, len(frame) - 1), []
        for i, o in enumerate(frame):
            for j, t in enumerate(tracks):
                away = abs(o[4] - t["at"])
                if frame[0][2] - t["seen"] <= s.max_gap_seconds and away <= s.max_position_delta:
                    cos = float(np.clip(unit(o[6]) @ unit(t["look"]), 0, 1))
                    pairs.append((s.appearance_weight * cos + s.position_weight * (1 - away / s.max_position_delta) + s.order_weight * max(0, 1 - abs(i - min(last, t["n"] - 1)) / last), i, j))
        taken = {}
        for score, i, j in sorted(pairs, reverse=True):
            if score >= s.min_track_score and i not in taken and j not in {x for x, _ in taken.values()}:
                taken[i] = (j, score)
        for i, o in enumerate(frame):
            q = 0.65 * o[5] + 0.35 * 0.5
            if i not in taken:
                tracks.append({"at": o[4], "seen": o[2], "n": 1, "q": q, "look": np.array(o[6])})
                out[o[0]] = (len(tracks), 1.0, False)
                continue
            j, score = taken[i]
            t = tracks[j]
            out[o[0]] = (j + 1, score, q > t["q"])
            t |= {"at": o[4], "seen": o[2], "n": t["n"] + 1, "q": max(q, t["q"]), "look": unit(s.descriptor_momentum * t["look"] + (1 - s.descriptor_momentum) * np.array(o[6]))}
    return out


def test_tracks_are_those_of_the_pairwise_rule():
    r = np.random.default_rng(3)
    for _ in range(25):
        kinds = r.normal(size=(4, 6)) + 1
        rows, time = [], 0.0
        for f in range(30):
            time += r.choice([0.4, 0.4, 3.0, 9.0])
            for k in range(r.integers(1, 6)):
                rows.append((len(rows), f, time, k, float(np.round(r.random(), 2)), float(r.random()), (kinds[r.integers(4)] + 0.2 * r.normal(size=6)).tolist()))
        table = pd.DataFrame([(b, f, t, k, c, q, 0.5, v) for b, f, t, k, c, q, v in rows], columns=["bag_id", "frame_index", "timestamp_seconds", "bag_index_in_frame", "center_norm", "quality_score", "segment_confidence", "descriptor"])
        live, found = tracking.assigned(("v", "s"), table.sample(frac=1, random_state=1), tracking.Live())
        slow = slow_tracks(rows)
        assert {x.bag_id: (int(x.track_key[-4:]), bool(x.is_best)) for x in found.itertuples()} == {b: (n, better) for b, (n, _, better) in slow.items()}
        assert all(abs(x.track_match_score - slow[x.bag_id][1]) < 1e-9 for x in found.itertuples())
        assert live.opened == max(n for n, _, _ in slow.values()) and len(live.number) < live.opened


def test_identification(spark):
    pills = spark.createDataFrame([(1, 0, "blanco", "redondo"), (1, 1, "rosa", "alargado"), (1, 2, "verde", "redondo")], "image_id long, pill_id long, color string, shape string")
    looks = spark.createDataFrame([(1, "A", "A 1", "blanco redondo", 1), (1, "A", "A 2", "rosa", 2), (1, "B", "B 1", "capsula rosa", 1), (1, "C", "C 1", "", 1)], "image_id long, drug string, presentation string, description string, rank int")
    scores = identify.best_scores(pills, looks)
    got = {(r.pill_id, r.drug): (r.score, r.presentation) for r in scores.collect()}
    assert got[0, "A"] == (3, "A 1") and got[1, "A"] == (2, "A 2") and got[1, "B"] == (3, "B 1") and got[2, "C"] == (0, None)
    expected = spark.createDataFrame([(1, "A", 1), (1, "B", 1)], "image_id long, drug string, quantity int")
    out = {(r.pill_id, r.drug): r.fit for r in identify.assign(scores, expected).collect()}
    assert out == {(0, "A"): "good", (1, "B"): "good", (2, None): None}
    short = [(r.pill_id, r.drug) for r in identify.assign(scores.where("pill_id = 0"), expected.withColumn("quantity", F.lit(2))).collect()]
    assert sorted(short, key=str) == [(0, "A"), (None, "A"), (None, "B"), (None, "B")]
    assert [r.drug for r in identify.ranking(scores).where("pill_id = 1").orderBy("rank").collect()] == ["B", "A", "C"]


def test_assignment_of_images_that_share_lists(spark):
    """Totals and units are those of each image by itself, whose list is its own."""
    draw = random.Random(5)
    colors, shapes = ("blanco", "rosa", "azul", None), ("redondo", "ovalado")
    pills = [(image, draw.randrange(6), 100 * image + p, draw.choice(colors), draw.choice(shapes)) for image in range(60) for p in range(draw.randint(1, 4))]
    of = {p[0]: p[1] for p in pills}
    pills = [(p[0], of[p[0]], *p[2:]) for p in pills]  # list 4 has looks but expects nothing, list 5 has fewer units than pills
    looks = [(n, f"D{d:02}", f"{d}-{k}", draw.choice(("blanco redondo", "rosa", "capsula azul", "ovalado", "")), k) for n in range(5) for d in range(9) for k in range(draw.randint(1, 2))] + [(5, "D00", "", "rosa", 0)]
    expected = [(n, f"D{d:02}", draw.choice((0, 1, 2, 3))) for n in range(4) for d in range(12)] + [(5, "D00", 2)]  # three drugs have no looks
    quantity = {(n, d): q for n, d, q in expected}
    p = spark.createDataFrame(pills, "image_id long, list_id int, pill_id long, color string, shape string")
    k = spark.createDataFrame(looks, "list_id int, drug string, presentation string, description string, rank int")
    e = spark.createDataFrame(expected, "list_id int, drug string, quantity int")
    lists = p.select("image_id", "list_id").distinct()
    own = identify.best_scores(p.drop("list_id"), lists.join(k, "list_id").drop("list_id"))
    score = {(r.pill_id, r.drug): r.score for r in own.collect()}
    alone = identify.assign(own, lists.join(e, "list_id").drop("list_id")).where("pill_id is not null").collect()
    found = identify.assign_listed(p, k, e).collect()
    assert sorted((r.image_id, r.pill_id) for r in found) == sorted((r.image_id, r.pill_id) for r in alone) == sorted((x[0], x[2]) for x in pills)
    total = lambda rows: Counter({i: sum(r.score or 0 for r in rows if r.image_id == i) for i in of})
    surplus = lambda rows: Counter(r.image_id for r in rows if r.drug is None)
    assert total(found) == total(alone) and surplus(found) == surplus(alone) and len(surplus(found)) > 9
    assert all(r.score == score.get((r.pill_id, r.drug), 0) for r in found if r.drug is not None)
    used = Counter((r.image_id, r.drug) for r in found if r.drug is not None)
    assert all(n <= quantity[of[i], d] for (i, d), n in used.items())


def test_presentations(spark):
    registry = spark.createDataFrame([("1", "ALFA 20 MG", "ALFA", True), ("2", "OTRO ALFA", "ALFA", True), ("3", "ALFA VIEJO", "ALFA", False), ("4", "DUO", "BETA", True), ("4", "DUO", "GAMMA", True), ("5", "SOLO", "BETA", True)], "nregistro string, name string, ingredient string, marketed boolean")
    drugs = spark.createDataFrame([("alfa",), ("beta/gamma",), ("beta/nada",)], "drug string")
    found = identify.presentations(drugs, registry)
    assert {(r.drug, r.nregistro) for r in found.collect()} == {("alfa", "1"), ("alfa", "2"), ("beta/gamma", "4")}
    kept = identify.soft_filter(found, identify.fits_dose(F.col("name"), F.lit("20mg")))
    assert {(r.drug, r.nregistro) for r in kept.collect()} == {("alfa", "1"), ("beta/gamma", "4")}
    details = spark.createDataFrame([("1", [("envase", "p0"), ("formafarmac", "p1")], [("2", "x"), ("1", "d1")], "3. FORMA FARMACEUTICA <p>rojo</p> 4. DATOS CLINICOS")], "nregistro string, photos array<struct<tipo: string, url: string>>, docs array<struct<tipo: string, url: string>>, html string")
    row = identify.appearances(kept, details).where("drug = 'alfa'").first()
    assert (row.photo_url, row.leaflet_url, row.description) == ("p1", "d1", "rojo")


def test_review_overlay_and_sampling(spark):
    table = spark.createDataFrame([("[0.4, null]", None), ("bad", 0.3), (None, None), ("[]", 0.2)], "j string, s double")
    assert [r[0] for r in table.select(review.seam_positions(F.col("j"), F.col("s"))).collect()] == [[0.4], [0.3], [], [0.2]]
    edited = spark.createDataFrame([(1, 0, " ", None, None, " mg "), (1, 1, "A", None, None, " mg "), (1, 2, None, 2.0, None, "")], "track_pair_id long, line_index int, drug_name string, quantity double, dose_value double, dose_unit string")
    assert [(r.line_index, r.drug_name, r.dose_unit) for r in review.editor_items(edited).orderBy("line_index").collect()] == [(1, "A", "MG"), (2, None, None)]
    rows = spark.range(100).withColumn("g", F.col("id") % 10)
    parts = sampling.split(rows, "id", group="g").groupBy("g").agg(F.countDistinct("split").alias("n")).collect()
    assert all(r.n == 1 for r in parts) and sampling.split(rows, "id").where("split = 'val'").count() == 15
    assert sampling.sample(rows, 7, "id").collect() == sampling.sample(rows.repartition(5), 7, "id").collect()
    assert sampling.split(rows.limit(0), "id").count() == 0 and sampling.split(rows.limit(3), "id").where("split = 'val'").count() == 1
    covered = spark.createDataFrame([("a.jpg", ["p::0"])], "crop_path string, pouches array<string>")
    assert sampling.batch_document(covered).first().document == '{"crop_path":"a.jpg","pouches":["p::0"]}'
    documents = sampling.task_documents(
        spark.createDataFrame([("bags/a.jpg", 100, 50)], "crop_path string, width int, height int"), spark.createDataFrame([("bags/a.jpg", 0, [10.0, 10.0, 50.0, 25.0])], "crop_path string, number int, polygon array<double>"),
        spark.createDataFrame([("bags/a.jpg", ["p::0"])], "crop_path string, pouches array<string>"),
        spark.createDataFrame([("p", 0, ("LUNES", None), [("ALFA",), ("BETA",)])], "pair_key string, order_index int, patient_context struct<weekday: string, date: string>, label_items array<struct<drug_name: string>>"),
    ).first().task
    assert '"bolsitas_texto":"p::0 | LUNES ? | ALFA, BETA"' in documents and '"points":[[10.0,20.0],[50.0,50.0]]' in documents


def test_sampled_frames(spark):
    info = spark.createDataFrame([("a", 25.0, 100), ("b", 0.0, 61), ("c", 1.0, 3), ("d", 25.0, 0)], "video string, fps double, frame_count int")
    found = {}
    for r in readers.sampled_frames(info).collect():
        found.setdefault(r.video, []).append(r.frame_index)
    assert found == {"a": list(range(0, 100, 10)), "b": [0, 30, 60], "c": [0, 1, 2]}
    ok = spark.createDataFrame([("a", i) for i in (0, 20, 30, 40)], "video string, frame_index int")
    assert [r.frame_index for r in readers.sampled_frames(info, ok).where("video = 'a'").orderBy("frame_index").collect()] == [0, 20, 30, 40]
    assert [r.frame_index for r in readers.sampled_frames(info, ok, stop_at_gap=True).where("video = 'a'").collect()] == [0]


def test_sources_and_sinks(spark, tmp_path):
    for name in ("b.MP4", "a.mkv", "c.txt"):
        (tmp_path / name).write_bytes(b"x")
    assert sorted(r.stem for r in readers.videos(spark, str(tmp_path)).collect()) == ["a", "b"]
    (tmp_path / "t.csv").write_bytes("﻿a,b\n1,é\n".encode())
    assert readers.csv_rows(spark, str(tmp_path / "t.csv")).collect()[0].asDict() == {"a": "1", "b": "é"}
    (tmp_path / "d.json").write_text('{"a": [1,\n 2]}')
    assert readers.json_documents(spark, str(tmp_path / "d.json")).first().a == [1, 2]
    catalog = sinks.Catalog(spark, str(tmp_path / "cat"))
    catalog.upsert("t", spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"), ["k"])
    catalog.upsert("t", spark.createDataFrame([(2, "c", 1), (3, "d", 2), (3, "e", 2)], "k long, v string, w int"), ["k"])
    assert sorted(map(tuple, catalog.read("t").collect())) == [(1, "a", None), (2, "c", 1), (3, "e", 2)]
    catalog.replace_sets("t", spark.createDataFrame([(1, "z", 9)], "k long, v string, w int"), ["k"])
    assert (1, "z", 9) in map(tuple, catalog.read("t").collect()) and not [p for p in (tmp_path / "cat").iterdir() if p.name.startswith(".t")]
    (tmp_path / "cat" / "t" / "version-9999999999-lost").mkdir()  # a writer that was lost before its end
    assert catalog.read("t").count() == 3
    before = catalog.read("t")
    catalog.write("t", catalog.read("t"))
    assert before.count() == 3 and len(list((tmp_path / "cat" / "t").iterdir())) == 2
    assert not catalog.exists("none")
    with pytest.raises(LookupError):
        catalog.read("none")
    catalog.register("t")
    assert readers.ad_hoc(spark, "SELECT count(*) AS n FROM t WHERE k > :k", k=1).first().n == 2
    old = spark.createDataFrame([(1, 2)], "k long, line_index int")
    assert sinks.replace_sets(old, old.limit(0), ["k"], emptied=spark.createDataFrame([(1,)], "k long")).count() == 0
    with pytest.raises(ValueError):
        sinks.evolved(old, "k long, sheet_index int", ["k", "sheet_index"])
    bags = spark.createDataFrame([(1, bytearray(np.array([12.5], "<f4").tobytes()), None), (2, None, 3.0)], "bag_id long, seam_prominence_blob binary, seam_prominence double")
    fixed, bad = sinks.repaired_prominence(bags)
    assert [r.seam_prominence for r in fixed.orderBy("bag_id").collect()] == [12.5, 3.0] and bags.where(bad).count() == 1
    sinks.write_csv(spark.createDataFrame([(1, [1, 2])], "a int, b array<int>"), str(tmp_path / "csv"))
    assert readers.csv_rows(spark, str(tmp_path / "csv")).first().b == "[1,2]"
    sinks.write_texts(spark.createDataFrame([("train", "x", "0 1")], "split string, name string, t string"), str(tmp_path / "yolo"), split="split", name="name", text="t")
    assert (tmp_path / "yolo" / "split=train" / "name=x").is_dir()


def test_boxes_of_payloads(spark):
    payloads = spark.createDataFrame([(1, '{"rec_texts": ["a", "b"], "rec_scores": [0.9, 0.8]}'), (2, '{"res": {"rec_texts": ["c"], "rec_scores": [0.7], "rec_polys": [[[0, 1], [2, 3]]]}}'), (3, "what")], "image_id long, payload string")
    found = readers.boxes_of(payloads).orderBy("image_id", "box_no").collect()
    assert [(r.image_id, r.text, r.score) for r in found] == [(1, "a", 0.9), (1, "b", 0.8), (2, "c", 0.7)] and found[2].poly == [[0.0, 1.0], [2.0, 3.0]]
