"""Substring dedup by line and passage hashing, with original offsets.

Units are lines, the sentences in them, and runs of words whose borders the words alone
decide, as a passage can be set into other text anywhere. Each unit is normalised to its
words and digested; the digests are grouped over the whole corpus, and all occurrences
but the earliest, by document and place, are removed.

A digest is a polynomial over the hashes of the unit's words, from prefix sums over a batch
of texts, so that a text costs a few passes over its characters whatever its units are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import holds, quoted, slices, split_join, task, written
from .neardup import keyed, mix

#: A run begins at a word whose hash is the least of so many before and after it: each 11 words or so.
RADIUS = 5
#: Bytes of text read at a time; a longer text comes alone.
READ_BYTES = 1 << 18
LINE, SENTENCE, RUN = range(3)


@dataclass(frozen=True)
class Least:
    """The fewest words of each kind of unit that are compared; shorter lines and sentences repeat by chance.

    Borders of runs that are nearer to each other than ``run`` are passed over, so runs leave no gaps.
    """

    line: int = 5
    sentence: int = 8
    run: int = RADIUS + 1


_M = [(m, np.uint64(pow(int(m), -1, 2**64))) for m in np.random.default_rng(20240611).integers(1, 2**63, 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]
_WORD, _SALT, _RUN, _NEXT = np.random.default_rng(20240612).integers(1, 2**63, 4, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@lru_cache(1)
def characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code point: is it part of a word, is it white space, and a hash of it in lower case."""
    n = 0x110000
    part = np.fromiter((c.isalnum() for c in map(chr, range(n))), bool, n)
    space = np.fromiter((c.isspace() for c in map(chr, range(n))), bool, n)
    lower = np.fromiter((ord(c.lower()[0]) for c in map(chr, range(n))), np.uint32, n)
    return part, space, mix((lower.astype(np.uint64) + np.uint64(1)) * _WORD)


holds("repeats", characters.cache_clear)


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def units(texts: list[str], least: Least = Least()) -> dict[str, np.ndarray]:
    """The units of some texts, an array for each of ``text, level, start, stop, h1, h2, again``.

    ``text`` is the number of the text; places are code points in it, ends exclusive. ``again`` units occurred
    before in the same text. Words are runs of letters and digits, case aside; other characters don't tell
    units apart.
    """
    part, space, hashed = characters()
    points = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
    inside = part[points]
    edge = np.flatnonzero(np.diff(inside, prepend=False))  # the last character is no part of a word
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return {c: np.zeros(0, np.int64) for c in ("text", "level", "start", "stop", "h1", "h2", "again")}
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    inner = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    words = mix(np.add.reduceat(hashed[points[inside]] * powers(_M[0][0], int(sizes.max()))[inner], first))
    sums = []
    for (m, inverse), w in zip(_M, (words, mix(words ^ _SALT))):
        sums.append((np.concatenate(([np.uint64(0)], np.cumsum(w * powers(m, len(w)), dtype=np.uint64))), powers(inverse, len(w) + 1)))

    def digests(a: np.ndarray, b: np.ndarray, salt: np.uint64) -> list[np.ndarray]:
        return [mix((s[b] - s[a]) * back[a] + (b - a).astype(np.uint64) * salt) for s, back in sums]

    # Lines, then the parts of lines between the ends of sentences: marks before white space.
    breaks = np.flatnonzero(points == 10)
    line_starts = np.concatenate(([0], breaks[:-1] + 1))
    line_words = np.searchsorted(starts, line_starts), np.searchsorted(starts, breaks)
    found = []
    a, b = line_words
    keep = b - a >= max(1, least.line)
    found.append((LINE, a[keep], b[keep], line_starts[keep], breaks[keep], digests(a[keep], b[keep], _SALT)))
    mark = (points == 33) | (points == 46) | (points == 63)
    cuts = np.flatnonzero(mark[:-1] & ~mark[1:] & space[points[1:]]) + 1
    bounds = np.union1d(line_starts, cuts[points[cuts] != 10])
    stops = np.append(bounds[1:], len(points))
    stops = stops - (np.append(points, 0)[stops - 1] == 10)
    solid = np.append(np.flatnonzero(~space[points]), len(points))
    bounds_line = np.searchsorted(line_starts, bounds, "right") - 1
    bounds = solid[np.searchsorted(solid, bounds)]
    a, b = np.searchsorted(starts, bounds), np.searchsorted(starts, stops)
    keep = (b - a >= max(1, least.sentence)) & ~((a == line_words[0][bounds_line]) & (b == line_words[1][bounds_line]))
    found.append((SENTENCE, a[keep], b[keep], bounds[keep], stops[keep], digests(a[keep], b[keep], _SALT)))

    owner = np.searchsorted(begins, starts, "right") - 1
    borders = run_borders(words, owner, least.run)
    same = owner[borders[:-1]] == owner[borders[1:]]
    a, b = borders[:-1][same], borders[1:][same]
    found.append((RUN, a, b, starts[a], starts[b], digests(a, b, _RUN)))

    level = np.concatenate([np.full(len(x[1]), x[0]) for x in found])
    word, start, stop = (np.concatenate([x[i] for x in found]) for i in (1, 3, 4))
    h1, h2 = (np.concatenate([x[5][i] for x in found]).view(np.int64) for i in (0, 1))
    text = owner[word]
    order = np.lexsort((word, h2, h1, text))
    again = np.zeros(len(order), bool)
    again[order[1:]] = np.logical_and.reduce([x[order[1:]] == x[order[:-1]] for x in (text, h1, h2)])
    return {"text": text, "level": level, "start": start - begins[text], "stop": stop - begins[text], "h1": h1, "h2": h2, "again": again}


def run_borders(words: np.ndarray, owner: np.ndarray, least: int) -> np.ndarray:
    """The words at which runs begin. Whether one does depends on the words within the radius alone.

    So a passage has the same inner borders in any text. Where words repeat with a short period many are
    the least of their surroundings; of those the next one at ``least`` words or more counts.
    """
    if len(words) < 2 * RADIUS + 1:
        return np.zeros(0, np.int64)
    # Pairs of words, as single ones repeat too often to tell places apart.
    h = words * _WORD
    inner = owner[1:] == owner[:-1]
    h[:-1][inner] += words[1:][inner] * _NEXT
    h = mix(h)
    least_near = np.lib.stride_tricks.sliding_window_view(h, 2 * RADIUS + 1).min(axis=1)
    borders = np.flatnonzero(h[RADIUS:-RADIUS] == least_near) + RADIUS
    borders = borders[(owner[borders - RADIUS] == owner[borders]) & (owner[borders + RADIUS] == owner[borders])]
    near = (np.diff(borders) < least) & (owner[borders[1:]] == owner[borders[:-1]])
    if near.any():
        kept, last = [], (-1, 0)
        for at, text in zip(borders.tolist(), owner[borders].tolist()):
            if text != last[0] or at - last[1] >= least:
                kept.append(at)
                last = (text, at)
        borders = np.array(kept)
    return borders


def unit_table(docs: DataFrame, least: Least = Least()) -> DataFrame:
    names = ["doc_id", "text_hash", "level", "start", "stop", "h1", "h2", "again"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task("repeats"):
            for piece in (p for batch in batches for p in slices(batch, 2, READ_BYTES)):
                found = units([t or "" for t in piece.column(2).to_pylist()], least)
                at = pa.array(found["text"])
                columns = [piece.column(0).take(at), piece.column(1).take(at), *(pa.array(found[c]).cast(k) for c, k in zip(names[2:], kinds[2:]))]
                yield pa.RecordBatch.from_arrays(columns, names)

    return keyed(docs).mapInArrow(run, "doc_id long, text_hash long, level int, start long, stop long, h1 long, h2 long, again boolean")


def repeated(docs: DataFrame, least: Least = Least()) -> DataFrame:
    """``(doc_id, text_hash, level, start, stop, first_doc)`` of each unit that occurred before.

    Positions are code points of the original text, and ``text_hash`` tells texts of one id apart (as in
    ``neardup.keyed``). Documents rank by ``doc_id`` (null first), then hash; rows that are equal in both are one
    document, and a repetition within a text has its own id as ``first_doc``. Null and empty texts have no units;
    other columns are ignored; an empty table gives no rows. Texts are read whole, in time proportional to their
    length; a unit that very many documents share is a split key.
    """
    found = written(unit_table(docs, least), name="units")
    once = found.where("not again").drop("again")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).groupBy("doc_id").agg(F.count("*").alias("n"))
    # Where each id is one row the least id is the first document; a pair takes a sort of all units.
    plain = ids.where("n > 1 or doc_id is null").isEmpty()
    rank = F.col("doc_id") if plain else F.struct("doc_id", "text_hash")
    firsts = once.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(rank).alias("first")).where("n > 1")
    firsts = written(firsts, name="firsts")
    held = split_join(once, firsts.drop("n"), ["h1", "h2"], sizes=firsts.select("h1", "h2", F.col("n").alias("_n")))
    held = held.where(~rank.eqNullSafe(F.col("first"))).withColumn("first_doc", F.col("first") if plain else F.col("first.doc_id"))
    columns = ["doc_id", "text_hash", "level", "start", "stop", "first_doc"]
    return held.select(*columns).unionByName(found.where("again").withColumn("first_doc", F.col("doc_id")).select(*columns))


KEY = ["doc_id", "text_hash"]


def removed(docs: DataFrame, least: Least = Least()) -> DataFrame:
    """``(doc_id, text_hash, spans array<struct<start, stop>>)`` of the documents that lose text, with overlapping and touching spans joined, in order."""
    grouped = repeated(docs, least).groupBy(*KEY).agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("found"))
    span = lambda start, stop: F.array(F.struct(start.alias("start"), stop.alias("stop")))
    empty = F.expr("named_struct('out', cast(array() as array<struct<start: bigint, stop: bigint>>), 'start', cast(-2 as bigint), 'stop', cast(-1 as bigint))")

    def step(acc, x):
        wider = F.struct(acc.out.alias("out"), acc.start.alias("start"), F.greatest(acc.stop, x.stop).alias("stop"))
        done = F.when(acc.stop >= 0, F.concat(acc.out, span(acc.start, acc.stop))).otherwise(acc.out)
        return F.when(x.start <= acc.stop, wider).otherwise(F.struct(done.alias("out"), x.start.alias("start"), x.stop.alias("stop")))

    joined = F.aggregate("found", empty, step, lambda acc: F.concat(acc.out, span(acc.start, acc.stop)))
    return grouped.select(*KEY, joined.alias("spans"))


def report(docs: DataFrame, least: Least = Least()) -> DataFrame:
    """``(doc_id, n_chars, n_removed, chars_removed, spans)`` of each row, spans as ``start:stop`` joined by commas.

    A row without text, or that loses none, has an empty ``spans``. See ``repeated`` for ranks, nulls and repeated rows.
    """
    slim = keyed(docs).select(*KEY, F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"))
    found = removed(docs, least)
    both = slim.alias("d").join(found.hint("merge").alias("r"), [F.col(f"d.{c}").eqNullSafe(F.col(f"r.{c}")) for c in KEY], "left").select("d.*", "r.spans")
    return both.select(
        "doc_id", "n_chars", F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s.stop - s.start), F.lit(0)).cast("long").alias("chars_removed"),
        F.coalesce(F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s.start.cast("string"), s.stop.cast("string"))), ","), F.lit("")).alias("spans"),
    )


def deduplicated(docs: DataFrame, least: Least = Least()) -> DataFrame:
    """``docs`` with repeated units cut out of ``text``. Other text, all rows, and columns of any name stay as they are."""
    found = removed(docs, least)
    rows = docs.select(F.struct(*map(quoted, docs.columns)).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    joined = rows.alias("d").join(found.alias("r"), [F.col(f"d.{c}").eqNullSafe(F.col(f"r.{c}")) for c in KEY], "left")
    stops = F.concat(F.array(F.lit(0).cast("long")), F.transform("spans", lambda s: s.stop))
    starts = F.concat(F.transform("spans", lambda s: s.start), F.array(F.length("text").cast("long")))
    kept = F.array_join(F.zip_with(stops, starts, lambda a, b: F.substring(F.col("text"), (a + 1).cast("int"), (b - a).cast("int"))), "")
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(kept)
    return joined.select(*(text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns))
