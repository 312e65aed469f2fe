import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stripweave.config import DEFAULTS
from stripweave.functions import kernels as K
from stripweave.functions import scoring as S
from stripweave.functions import text as T


def values(spark, rows, ddl, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, ddl).select(*columns).collect()]


LINES = {
    "1 ALFAPRUEBA 0,266 MG CAPSULA": [(0, 1.0, "ALFAPRUEBA", 0.266, "MG")],
    "2 BETAPRUEBA 25 MICROGRAMOS COMPRIMIDO": [(0, 2.0, "BETAPRUEBA", 25.0, "MCG")],
    "1 GAMMA/DELTA 20/12,5 MG COMPRIMIDO": [(0, 1.0, "GAMMA/DELTA", None, "MG")],
    "ALFA 40 MG COMPRIMID BETA 1 MG COMPRIMIDO": [(0, None, "ALFA", 40.0, "MG"), (1, None, "BETA", 1.0, "MG")],
    "0,5 GAMMA 2 MC": [(0, 0.5, "GAMMA", 2.0, "MCG")],
    "DELTA 20 MO": [(0, None, "DELTA", 20.0, "MG")],
    "1 EPSILON 50 µG": [(0, 1.0, "EPSILON", 50.0, "MCG")],
    "650 MG": [],
    "900 00 00 00": [],
    "FARMACIA EJEMPLO": [],
    "": [],
    "1 Ø ZETA · 5 MG": [(0, 1.0, "ZETA", 5.0, "MG")],
}


def test_items(spark):
    found = values(spark, [(k,) for k in LINES], "line string", "line", T.items(F.col("line")).alias("x"))
    for line, items in found:
        assert [(x.line_index, x.quantity, x.drug_name, x.dose_value, x.dose_unit) for x in items] == LINES[line], line


def test_header_parts(spark):
    rows = [("lunes 02/03/26 DESAYUNO",), ("sábado28/02/26CENA",), ("x 28/02/26DESAYL",), ("PERSONA UNO",), ("miércoles AYUNAS",)]
    found = values(spark, rows, "line string", T.weekday(F.col("line")), T.date(F.col("line")), T.slot(F.col("line")))
    assert found == [("LUNES", "02/03/26", "DESAYUNO"), ("SABADO", "28/02/26", "CENA"), (None, "28/02/26", "DESAYUNO"), (None, None, None), ("MIERCOLES", None, "AYUNAS")]


def test_signature(spark):
    rows = [(" 01/02/26", "comída "), ("01/02/26", None), ("", "CENA"), (None, None)]
    sig = T.signature(F.col("d"), F.col("s"))
    assert values(spark, rows, "d string, s string", sig.sig_date, sig.sig_slot) == [("01/02/26", "COMIDA"), (None, None), (None, None), (None, None)]


def test_text_helpers(spark):
    one = spark.range(1)
    row = one.select(
        T.normalized(F.lit("a\nb |c  «d» | ")), T.clean_html(F.lit("<p>x <b>y</b></p>\n z")), T.from_bags(F.lit("..\\x\\bags\\p\\q.jpg")), T.from_bags(F.lit("x/y.jpg")),
        T.section(F.lit("<b>3. Forma Farmacéutica</b> comprimido <i>rojo</i> 4. Datos clínicos")), T.single_item(F.lit("TOMAR ALFA BETA GAMMA DELTA 5,5 mg")),
        T.drug_spec(F.lit("Omega: 20 mg :2.4")), T.drug_spec(F.lit("Omega")), T.keywords(F.lit("Comprimidos blanquecinos, ovalados"), T.COLORS), T.keywords(F.lit(None).cast("string"), T.SHAPES),
        T.payload_field(F.lit('{"res": {"rec_texts": ["a"]}}'), "rec_texts"), T.segment_bounds(F.lit("segment_1"), F.array(F.lit(0.6), F.lit(0.2)), F.lit(100)), T.segment_bounds(F.lit("segment_9"), F.array(F.lit(0.6)), F.lit(100)),
    ).first()
    assert tuple(row[:5]) == ("a | b | c d", "x y z", "bags/p/q.jpg", "g", "comprimido rojo")
    assert tuple(row[5]) == ("BETA GAMMA DELTA", 5.5, "MG") and tuple(row[6]) == ("Omega", "20 mg", 2) and row[7].quantity == 1
    assert row[8] == ["blanco"] and row[9] == [] and row[10] == '["a"]' and tuple(row[11]) == (20, 60) and tuple(row[12]) == (0, 100)


def test_settings():
    assert DEFAULTS.merged({"top_k": 8, "unknown": 1}).top_k == 8 and DEFAULTS.top_k == 20


def test_scores(spark):
    one = spark.range(1)
    a = F.array(F.lit(1.0), F.lit(0.0))
    row = one.select(S.quality(F.lit(1600.0), F.lit(40.0), F.lit(0.0)), S.cosine(a, F.array(F.lit(0.0), F.lit(0.0))), S.cosine(a, F.array(F.lit(-1.0), F.lit(0.0))), S.overlap(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(9.0)),
                     S.interpolated(F.lit(5.0), F.lit(5.0), F.lit(5.0), F.lit(0.0), F.lit(1.0)), S.resize_factor(F.lit(100), F.lit(240)), S.resize_factor(F.lit(478), F.lit(900)), S.fit_label(F.lit(3)), S.color(F.lit(175), F.lit(99), F.lit(9))).first()
    assert tuple(row) == (0.825, 0.0, 0.0, 0.0, None, 4.8, 1.0, "good", "rojo")
    cuts = one.select(S.crops(F.array(F.lit(1 / 3), F.lit(2 / 3)), F.lit(90), 5), S.equal_cuts(F.lit(1000), F.lit(360)), S.segments(F.array(F.lit(400), F.lit(420)), F.lit(900)), S.percent_points(F.array(F.lit(5.0), F.lit(10.0)), F.lit(10), F.lit(20)),
                      S.complete_crops(F.expr("array(named_struct('start', 0.1, 'end', 0.3), named_struct('start', 0.35, 'end', 0.9))"), F.lit(1000), 50, 200)).first()
    assert [tuple(x) for x in cuts[0]] == [(0, 35), (25, 65), (55, 90)] and cuts[1] == [333, 666]
    assert [tuple(x) for x in cuts[2]] == [(0, 8, 392), (1, 428, 892)] and cuts[3] == [[50.0, 50.0]] and [tuple(x) for x in cuts[4]] == [(50, 350), (300, 1000)]


def test_assignment_is_optimal():
    r = np.random.default_rng(0)
    for _ in range(150):
        n, m = map(int, r.integers(1, 6, 2))
        score = r.integers(0, 5, (n, m)).astype(float)
        found = K.assignment(score)
        rows, cols = (score, False) if n <= m else (score.T, True)
        best = max(sum(rows[i, p[i]] for i in range(len(rows))) for p in itertools.permutations(range(rows.shape[1]), len(rows)))
        assert len(found) == min(n, m) and len({a for a, _ in found}) == len({b for _, b in found}) == len(found)
        assert sum(score[i, j] for i, j in found) == best
    assert K.assignment(np.zeros((0, 3))) == []


def test_motion():
    r = np.random.default_rng(42)
    base = r.integers(0, 255, (400, 200)).astype(float)
    assert abs(K.vertical_shift(base, np.roll(base, 40, axis=0)) - 40) < 1
    path = K.cumulative_shifts([np.roll(base, 25 * k, axis=0) for k in range(5)])
    assert path[0] == 0 and abs(path[-1] - 100) < 5 and K.cumulative_shifts([]) == []


def striped(*rows, height=1800, blue=255, other=20):
    picture = np.full((height, 60, 3), 90, np.uint8)
    picture[..., 0] = 94
    for row in rows:
        picture[row - 12 : row + 12] = (blue, other, other)
    return picture


def test_seams():
    found, at, ratio = K.strongest_peak(K.seam_profile(striped(360)))
    assert found and abs(at - 0.2) < 0.02 and ratio > 3 and isinstance(ratio, float)
    two = K.peaks(K.seam_profile(striped(500, 1200)))
    assert len(two) == 2 and abs(two[0][0] - 500 / 1800) < 0.02 and abs(two[1][0] - 1200 / 1800) < 0.02
    assert K.peaks(np.ones(50)) == [] and K.strongest_peak(np.zeros(9)) == (False, None, 0.0)
    assert not K.strongest_peak(K.seam_profile(striped(500, blue=240, other=240)))[0]  # bright, not blue
    assert len(K.inner_peaks(K.seam_profile(striped(60, 900)))) == 1  # the border is left out
    assert K.inner_peaks(np.r_[np.ones(40), 9, 9, np.ones(58)]) == [0.4]


def test_segments_and_masks():
    picture = np.full((900, 300, 3), 40, np.uint8)
    for row in (300, 600):
        picture[row : row + 6] = 250
    seams = K.horizontal_seams(picture, 180)
    assert len(seams) == 2 and abs(seams[0] - 303) < 12 and abs(seams[1] - 603) < 12
    assert K.merge_close([1, 2, 9, 10, 11], 3) == [1, 10] and K.merge_close([], 3) == []
    mask = np.zeros((50, 60), bool)
    mask[10:20, 5:35] = True
    f = K.mask_features(mask, np.full(mask.shape, 7.0))
    assert f["aspect"] == 3 and f["extent"] == 1 and f["area_frac"] == 0.1 and f["texture"] == 0 and (f["x0"], f["y1"]) == (5, 19)
    assert K.mask_features(np.zeros((3, 3)), np.zeros((3, 3))) is None
    assert K.strip_box(np.pad(np.full((10, 10), 200.0), 5))["x0"] == 5
    assert K.ordered_corners([[9, 9], [0, 0], [9, 0], [0, 9]]).tolist() == [[0, 0], [9, 0], [9, 9], [0, 9]]
    assert K.simplified([[0, 0], [1, 0.01], [2, 0], [2, 2]], 0.1).tolist() == [[0, 0], [2, 0], [2, 2]]


def test_pixels():
    r = np.random.default_rng(1)
    flat, rough = np.full((40, 40, 3), 128, np.uint8), r.integers(0, 255, (40, 40, 3)).astype(np.uint8)
    q = K.frame_quality(flat)
    assert q["sharpness"] == 0 and q["brightness"] == 128 and q["contrast"] == 0 and K.frame_quality(rough)["sharpness"] > 1000
    assert K.hsv(np.array([[[0, 0, 255], [0, 255, 0], [255, 0, 0]]]))[0].tolist() == [[0, 255, 255], [60, 255, 255], [120, 255, 255]]
    d = K.descriptor(rough)
    assert d.shape == (128,) and abs(np.linalg.norm(d) - 1) < 1e-5


def test_pandas_functions(spark):
    r = np.random.default_rng(2)
    picture = r.integers(0, 255, (20, 30, 3)).astype(np.uint8)
    rows = spark.createDataFrame([(bytearray(picture.tobytes()), 20, 30, K.seam_profile(striped(360)).tolist(), bytearray(np.array([14.5], "<f4").tobytes()))], "pixels binary, height int, width int, profile array<double>, blob binary")
    row = rows.select(K.quality_of("pixels", "height", "width").alias("q"), K.seam_bands("profile").alias("b"), K.seam_band("profile").alias("s"), K.inner_seams("profile").alias("i"), K.image_descriptor("pixels", "height", "width").alias("d"), K.repaired_float("blob").alias("f"), K.name_ratio(F.lit("BI ERIDENO"), F.lit("BIPERIDENO")).alias("n")).first()
    assert row.q.sharpness == K.frame_quality(picture)["sharpness"] and len(row.b) == 1 and row.s.found and len(row.i) == 1 and len(row.d) == 128 and row.f == 14.5 and 0.9 < row.n < 1


def item(name, dose=None, unit="MG"):
    return {"line_index": 0, "quantity": 1.0, "drug_name": name, "dose_value": dose, "dose_unit": unit, "raw_line": name}


@pytest.mark.parametrize(
    "names, expected",
    [
        (["ALFAPRUEBA", "alfaprueba", "BETA"], [("ALFAPRUEBA", 0), ("BETA", 1)]),
        (["BI ERIDENO", "BIPERIDENO", "EIPERIDENO", "BIPERIDENO"], [("BIPERIDENO", 0)]),
        (["", None, "GAMMA"], [("GAMMA", 0)]),
    ],
)
def test_merged_items(names, expected):
    assert [(x["drug_name"], x["line_index"]) for x in K.merged_items([item(n) for n in names])] == expected


def test_merged_item_with_a_dose_wins():
    found = K.merged_items([item("OMEPRAZOL"), item("OMEPRAZOL"), item("OMEPRAZ0L", 20.0)])
    assert len(found) == 1 and found[0]["dose_value"] == 20.0


def test_merge_is_idempotent():
    r = random.Random(0)
    names = ["".join(r.choice("ABCDEF") for _ in range(8)) for _ in range(12)]
    once = K.merged_items([item(n) for n in names])
    assert [x["drug_name"] for x in K.merged_items(once)] == [x["drug_name"] for x in once]
