"""Scores, buckets and rules over numbers, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULTS, Settings


def clamp(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def quality(sharpness: Column, contrast: Column, overexposed: Column) -> Column:
    total = 0.55 * F.least(sharpness / 800, F.lit(1.0)) + 0.35 * F.least(contrast / 80, F.lit(1.0)) + 0.10 * (1 - F.least(overexposed / 0.35, F.lit(1.0)))
    return F.round(clamp(total), 4)


def center(y1: Column, y2: Column, height: Column) -> Column:
    return (y1 + y2) / 2.0 / F.greatest(F.lit(1), height)


def combined_quality(q: Column, confidence: Column) -> Column:
    return 0.65 * q + 0.35 * confidence


def selection_score(q: Column, confidence: Column, match: Column) -> Column:
    return 0.55 * q + 0.30 * confidence + 0.15 * match


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine clipped to 0..1; 0 where a vector is next to nothing."""
    na, nb = F.sqrt(dot(a, a)), F.sqrt(dot(b, b))
    return F.when((na < 1e-8) | (nb < 1e-8), 0.0).otherwise(clamp(dot(a, b) / F.nullif(na * nb, F.lit(0.0))))


def track_score(appearance: Column, position: Column, order: Column, settings: Settings = DEFAULTS) -> Column:
    return settings.appearance_weight * appearance + settings.position_weight * position + settings.order_weight * order


def overlap(low1: Column, high1: Column, low2: Column, high2: Column) -> Column:
    """The shared part of two intervals over the shorter one."""
    shared = F.greatest(F.lit(0.0), F.least(high1, high2) - F.greatest(low1, low2))
    shorter = F.least(high1 - low1, high2 - low2)
    return F.when(shorter > 0, shared / shorter).otherwise(0.0)


def pair_score(left: Column, right: Column, balance: Column) -> Column:
    """Ordinal pairs have equal ranks by construction, so their ordinal similarity is 1."""
    return F.round(clamp(0.55 + 0.25 * balance + 0.20 * (left + right) / 2.0), 6)


def interpolated(position: Column, low: Column, high: Column, to_low: Column, to_high: Column) -> Column:
    """Where a position of one range lies in another; null where the range is empty."""
    return F.when(high > low, to_low + (position - low) / (high - low) * (to_high - to_low))


def color(h: Column, s: Column, v: Column) -> Column:
    grey = F.when(v < 60, "negro").when(v < 120, "gris").otherwise("blanco")
    return (
        F.when(s < 30, grey).when((h < 10) | (h > 170), "rojo").when(h < 20, "naranja").when(h < 35, "amarillo")
        .when((h >= 130) & (h < 170), "rosa").when((h >= 90) & (h < 130), "azul").when((h >= 35) & (h < 90), "verde").otherwise("otro")
    )


def aspect(width: Column, height: Column) -> Column:
    return F.greatest(width, height) / F.greatest(F.lit(1.0), F.least(width, height))


def shape(ratio: Column) -> Column:
    return F.when(ratio > 1.6, "alargado").when(ratio > 1.15, "ovalado").otherwise("redondo")


def appearance(color_seen: Column, shape_seen: Column, colors: Column, shapes: Column) -> Column:
    two = F.when(F.array_contains(colors, color_seen), 2).otherwise(0)
    one = F.when(F.array_contains(shapes, shape_seen), 1).otherwise(0)
    capsule = F.when(F.array_contains(shapes, "capsula") & shape_seen.isin("alargado", "ovalado"), 1).otherwise(0)
    return two + one + capsule


def fit_label(score: Column) -> Column:
    return F.when(score >= 3, "good").when(score > 0, "weak").otherwise("none")


def is_pill(area: Column, ratio: Column, extent: Column, texture: Column) -> Column:
    return area.between(0.0015, 0.05) & (ratio <= 3) & (extent <= 0.93) & (texture <= 15)


def is_foreground(area: Column) -> Column:
    return area.between(0.0005, 0.06)


def band(y: Column, seams: Column) -> Column:
    """How many seams lie strictly above a position."""
    return F.size(F.filter(seams, lambda s: y > s))


def reading_needs_review(confidence: Column, n_items: Column, merged_line: Column, settings: Settings = DEFAULTS) -> Column:
    return (F.coalesce(confidence, F.lit(0.0)) < settings.accept_reading) | (n_items == 0) | merged_line


def pair_needs_review(status: Column, ocr_id: Column, n_items: Column, confidence: Column, settings: Settings = DEFAULTS) -> Column:
    return (status != "paired") | ocr_id.isNull() | (F.coalesce(n_items, F.lit(0)) == 0) | (F.coalesce(confidence, F.lit(0.0)) < settings.accept_pair)


def equal_cuts(height: Column, target: Column) -> Column:
    """Cuts into equal parts of about the target height; none where one part is enough."""
    n = F.greatest(F.lit(1), F.bround(height / target).cast("int"))
    cuts = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.floor(i * height / n).cast("int"))
    return F.when(n > 1, cuts).otherwise(F.expr("cast(array() as array<int>)"))


def segments(cuts: Column, height: Column, *, margin: int = 8, least: int = 220, most: int = 12) -> Column:
    """Intervals between cuts, with margins, without short ones, numbered anew."""
    kept = F.slice(F.array_sort(cuts), 1, most - 1)
    bounds = F.concat(F.array(F.lit(0)), kept, F.array(height.cast("int")))
    found = F.transform(
        F.sequence(F.lit(0), F.size(bounds) - 2),
        lambda i: F.struct(F.greatest(F.lit(0), F.get(bounds, i) + margin).alias("y1"), F.least(height.cast("int"), F.get(bounds, i + 1) - margin).alias("y2")),
    )
    found = F.filter(found, lambda s: s.y2 - s.y1 >= int(least * 0.45))
    return F.transform(found, lambda s, i: F.struct(i.cast("int").alias("index"), s.y1.alias("y1"), s.y2.alias("y2")))


def crops(cuts: Column, height: Column, margin: int = 0) -> Column:
    """N cuts (0..1) as N+1 pixel intervals; the margin widens inner borders only."""
    rows = F.concat(F.array(F.lit(0)), F.transform(F.array_sort(cuts), lambda c: F.floor(c * height).cast("int")), F.array(height.cast("int")))
    last = F.size(rows) - 2
    found = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.struct(
            F.greatest(F.lit(0), F.get(rows, i) - F.when(i > 0, margin).otherwise(0)).alias("y0"),
            F.least(height.cast("int"), F.get(rows, i + 1) + F.when(i < last, margin).otherwise(0)).alias("y1"),
        ),
    )
    return F.filter(found, lambda s: s.y1 > s.y0)


def complete_crops(bounds: Column, height: Column, top: int = 100, bottom: int = 200) -> Column:
    """Pixel intervals of explicit ``(start, end)`` bounds with margins, never past the next one's start."""
    pixel = lambda x: F.floor(x * height).cast("int")
    found = F.transform(
        bounds,
        lambda b, i: F.struct(
            F.greatest(F.lit(0), pixel(b.start) - top).alias("y0"),
            F.least(height.cast("int"), pixel(b.end) + bottom, F.coalesce(pixel(F.get(bounds, i + 1).start), height.cast("int"))).alias("y1"),
        ),
    )
    return F.filter(found, lambda s: s.y1 > s.y0)


def resize_factor(width: Column, height: Column, least: int = 480) -> Column:
    """How far an image is enlarged so that its short side is long enough; 1 where it nearly is."""
    factor = F.greatest(F.lit(1.0), least / F.least(width, height).cast("double"))
    return F.when(factor > 1.01, factor).otherwise(1.0)


def normalized_polygon(flat: Column, width: Column, height: Column) -> Column:
    """Pixels ``[x1, y1, x2, y2, ...]`` as shares of width and height."""
    return F.transform(flat, lambda p, i: p / F.when(i % 2 == 0, width).otherwise(height))


def percent_points(flat: Column, width: Column, height: Column) -> Column:
    """The same as a list of ``[x, y]`` in percent."""
    shares = normalized_polygon(flat, width, height)
    pairs = F.sequence(F.lit(0), F.floor(F.size(flat) / 2).cast("int") - 1)
    empty = F.expr("cast(array() as array<array<double>>)")
    return F.when(F.size(flat) >= 2, F.transform(pairs, lambda i: F.array(F.get(shares, i * 2) * 100, F.get(shares, i * 2 + 1) * 100))).otherwise(empty)
