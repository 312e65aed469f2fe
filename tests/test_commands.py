"""A small dataset from end to end: build, match, review, rebuild, export, package, command line."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from stripweave import cli
from stripweave.config import DEFAULTS
from stripweave.plans import commands
from stripweave.sources.sinks import Catalog

SETTINGS = DEFAULTS.merged({"video_sides": {"P": "pill_side", "L": "label_side"}, "video_pairs": [{"pair_key": "s0", "pill_video": "P", "label_video": "L", "direction": "direct"}]})


def payload(*lines):
    box = lambda i: [[0, 20 * i], [90, 20 * i], [90, 20 * i + 10], [0, 20 * i + 10]]
    return json.dumps({"res": {"rec_texts": list(lines), "rec_scores": [0.95] * len(lines), "rec_polys": [box(i) for i in range(len(lines))]}})


def inputs(spark):
    """Six frames a side: pouch 1 is legible on both, pouch 2 on the label alone, frame 5 of the label is noise."""
    videos = spark.createDataFrame([(f"/v/{n}.mp4", f"{n}.mp4", 25.0, 100, 200, 60) for n in "PL"], "path string, filename string, fps double, width int, height int, frame_count int")
    metrics = [(f"{n}.mp4", i * 10, i * 0.4, 400.0, 90.0, 60.0, 0.01, True, -100.0) for n in "PL" for i in range(6)]
    flat = np.ones(50).tolist()
    crops = [(f"{n}.mp4", i * 10, 0, f"bags/{n}{i}.jpg", 0, 190, 200, 0.8, flat, [float(i < 3), float(i >= 3)]) for n in "PL" for i in range(6)]
    head = "PERSONA UNO", "lunes 02/03/26 CENA"
    read = [("P.mp4", 0, 0, payload(*head, "1 ALFA 5 MG")), ("L.mp4", 0, 0, payload(*head, "1 ALFA 5 MG", "2 BETA 10 MG")), ("L.mp4", 10, 0, payload(*head, "1 ALEA 5 MG")),
            ("L.mp4", 30, 0, payload("PERSONA UNO", "martes 03/03/26 CENA", "1 GAMMA 20 MG")), ("L.mp4", 50, 0, payload("FARMACIA"))]
    return (
        videos,
        spark.createDataFrame(metrics, "filename string, frame_index int, timestamp_seconds double, sharpness double, brightness double, contrast double, overexposed_ratio double, strip_detected boolean, dy double"),
        spark.createDataFrame(crops, "filename string, frame_index int, bag_index_in_frame int, crop_path string, y1 int, y2 int, frame_height int, segment_confidence double, profile array<double>, descriptor array<float>"),
        spark.createDataFrame([(*r, 200.0) for r in read], "filename string, frame_index int, bag_index_in_frame int, payload string, height double"),
    )


@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    out = Catalog(spark, str(tmp_path_factory.mktemp("data") / "catalog"))
    summary = commands.build_dataset(out, *inputs(spark), SETTINGS)
    assert {r.table_name: r.n for r in summary.collect()} == {"videos": 2, "frames": 12, "bags": 12, "ocr_results": 5, "pairs": out.read("track_pairs").count()}
    return out


def test_unknown_side_stops_the_run(spark, tmp_path):
    with pytest.raises(commands.UnknownSides, match="L, P"):
        commands.build_dataset(Catalog(spark, str(tmp_path)), *inputs(spark), DEFAULTS)


def test_only_the_sides_asked_for_are_read(spark, tmp_path):
    out = Catalog(spark, str(tmp_path / "one_side"))
    summary = {r.table_name: r.n for r in commands.build_dataset(out, *inputs(spark), SETTINGS, read_sides=("label_side",)).collect()}
    assert summary["bags"] == 12 and summary["ocr_results"] == 4
    sides = out.read("ocr_results").join(out.read("bags").select("bag_id", "side"), "bag_id").select("side").distinct().collect()
    assert [r.side for r in sides] == ["label_side"]


def test_tiers(catalog):
    rows = {r.order_index: r for r in catalog.read("track_pairs").collect()}
    assert sorted(rows) == list(range(len(rows)))
    assert rows[0].status == "paired" and rows[0].match_tier == "direct" and rows[0].match_score == 1.0 and not rows[0].needs_review
    assert rows[0].pill_track_key == "P:pill_side:direct:0000" and [x.drug_name for x in rows[0].merged_items] == ["ALFA", "BETA"]
    assert rows[1].status == "position_matched" and rows[1].match_score == 0.75 and rows[1].needs_review
    bags = {r.bag_id: (r.filename, r.frame_index) for r in catalog.read("bags").collect()}
    assert bags[rows[1].pill_best_bag_id] == ("P.mp4", 30) and bags[rows[1].label_best_bag_id] == ("L.mp4", 30)
    # The noise has no items, so it gets no photo by position; what is left is zipped by order.
    assert all(r.match_tier in ("ordinal", "unmatched") for i, r in rows.items() if i > 1)
    assert catalog.read("frames").where("filename = 'P.mp4'").agg(F.min("cumulative_pan_px")).first()[0] == -500.0
    assert catalog.read("bag_tracks").count() >= 2 and catalog.read("bags").where("selected").count() == 12


def test_rebuild_changes_nothing_and_finished_videos_are_skipped(spark, catalog):
    before = sorted(map(str, catalog.read("track_pairs").collect()))
    commands.rebuild_pairs(catalog, SETTINGS)
    assert sorted(map(str, catalog.read("track_pairs").collect())) == before
    commands.build_dataset(catalog, *inputs(spark), SETTINGS)
    assert sorted(map(str, catalog.read("track_pairs").collect())) == before


def test_review_export_and_package(spark, catalog, tmp_path):
    pairs = {r.order_index: r.track_pair_id for r in catalog.read("track_pairs").collect()}
    decisions = spark.createDataFrame([(pairs[0], "corrected", "n"), (pairs[1], "rejected", "")], "track_pair_id long, decision string, reviewer_notes string")
    items = spark.createDataFrame([(pairs[0], 0, 0.5, "ALFA X", 5.0, "mg"), (pairs[0], 1, None, " ", None, None)], "track_pair_id long, line_index int, quantity double, drug_name string, dose_value double, dose_unit string")
    commands.save_reviews(catalog, decisions, items)
    with pytest.raises(ValueError):
        commands.save_reviews(catalog, decisions.withColumn("decision", F.lit("maybe")))
    records = commands.export_dataset(catalog, str(tmp_path / "out")).collect()
    assert len(records) == 1 and records[0].label_source == "human_corrected" and records[0].label_items[0].quantity == 0.5 and records[0].label_items[0].dose_unit == "MG"
    assert records[0].patient_context.date == "02/03/26" and [p.crop_path for p in records[0].pill_photos] == ["bags/P0.jpg"]
    assert commands.export_dataset(catalog, exclude_rejected=False).count() == 2
    raw = catalog.read("label_items").where("drug_name = 'ALFA X'").count()
    assert raw == 0  # corrections never reach the readings
    assert {r.decision for r in commands.review_queue(catalog, decision="pending", hide_empty=False).collect()} <= {None, "pending"}

    commands.export_reviews(catalog, str(tmp_path / "reviews"))
    catalog.write("pair_reviews", catalog.read("pair_reviews").limit(0))
    catalog.write("pair_review_items", catalog.read("pair_review_items").limit(0))
    assert commands.import_reviews(catalog, str(tmp_path / "reviews")).count() == 0
    assert {(r.track_pair_id, r.decision) for r in catalog.read("pair_reviews").collect()} == {(pairs[0], "corrected"), (pairs[1], "rejected")}
    assert catalog.read("pair_review_items").first().quantity == 0.5

    (tmp_path / "files" / "bags").mkdir(parents=True)
    (tmp_path / "files" / "bags" / "P0.jpg").write_bytes(b"jpg")
    assert commands.package_dataset(catalog, str(tmp_path / "files"), str(tmp_path / "package")).count() == 0
    assert bytes(spark.read.parquet(str(tmp_path / "package")).first().content) == b"jpg"
    chosen, covered = commands.annotation_batch(commands.export_dataset(catalog))
    assert chosen.count() == covered.count() == 1


def test_pouch_images_and_identification(spark):
    lines = spark.createDataFrame([(r, 0, "lunes 02/03/26 CENA", 0.2) for r in (1, 2)] + [(r, 1, "FARMACIA", 0.5) for r in (1, 2)], "reading_id long, line_no int, line string, y double")
    frames = spark.createDataFrame([(1, 10, 1000), (2, 20, 1000)], "reading_id long, frame_index int, height int")
    row = commands.pouch_images(lines, frames).collect()
    assert [(r.reading_id, r.signature, r.y0, r.y1) for r in row] == [(1, "02/03/26|CENA", 50, 700)]
    pills = spark.createDataFrame([(1, 0, 5, 10, 200, 10.0, 10.0)], "image_id long, pill_id long, h int, s int, v int, width double, height double")
    expected = spark.createDataFrame([(1, "Alfa:20 mg:1"), (1, "Omega")], "image_id long, spec string")
    registry = spark.createDataFrame([("1", "ALFA 20 MG", "ALFA", True), ("2", "ALFA 40 MG", "ALFA", True)], "nregistro string, name string, ingredient string, marketed boolean")
    details = spark.createDataFrame([(n, [], [], f"3. FORMA FARMACÉUTICA comprimido {c} redondo 4. DATOS CLÍNICOS") for n, c in (("1", "blanco"), ("2", "rojo"))], "nregistro string, photos array<struct<tipo: string, url: string>>, docs array<struct<tipo: string, url: string>>, html string")
    assigned, ranked = commands.identify_pills(pills, expected, registry, details)
    assert {(r.pill_id, r.drug, r.fit) for r in assigned.collect()} == {(0, "Alfa", "good"), (None, "Omega", None)}
    assert [(r.drug, r.score) for r in ranked.orderBy("rank").collect()] == [("Alfa", 3), ("Omega", 0)]


def test_command_line(spark, catalog, tmp_path, capsys):
    (tmp_path / "c.yaml").write_text("video_pairs:\n- {pair_key: s0, pill_video: P, label_video: L}\nvideo_sides: {P: pill_side, L: label_side}\n")
    (tmp_path / "s.json").write_text('{"top_k": 3}')
    assert cli.settings_of(str(tmp_path / "c.yaml"), str(tmp_path / "s.json")).top_k == 3
    assert cli.main(["rebuild-pairs", catalog.root, "--config", str(tmp_path / "c.yaml")]) == 0
    assert cli.main(["review-queue", catalog.root, "--status", "all", "--show-empty"]) == 0
    (tmp_path / "A.mp4").write_bytes(b"x")
    (tmp_path / "B.mp4").write_bytes(b"x")
    assert cli.main(["plan-sessions", str(tmp_path), str(tmp_path / "plan")]) == 0
    assert spark.read.json(str(tmp_path / "plan")).count() == 1
    assert cli.main(["query", "/root/testdata/sf0.001", "review_summary"]) == 0
    assert "paired" in capsys.readouterr().out
