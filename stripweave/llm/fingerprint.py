"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last eight bytes decides, from content alone, where a chunk ends;
each chunk gives one character of a signature. The block size is the least power of two
whose triggers leave at most 64 chunks, and the signature of twice that size is kept as
well, so two texts can be compared when their sizes are equal or one step apart. Likeness
is one minus the edit distance of the signatures over the longer one's length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
CHUNKS = 64
LEAST_SIZE = 8
#: Documents in a range of ids, and the most ranges that are made.
RANGE_ROWS, MOST_RANGES = 256, 20_000

_BYTE = np.random.default_rng(20240407).integers(1, 2**63, 256, dtype=np.uint64)
_M = [np.uint64(pow(0x9E3779B97F4A7C15, k, 2**64)) for k in (1, 2, 4)]
_CODE = np.zeros(128, np.uint8)
_CODE[[ord(c) for c in ALPHABET]] = np.arange(64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def fingerprint(data: bytes) -> str:
    """``size:signature:signature of twice the size``; an empty text has empty signatures."""
    n = len(data)
    if not n:
        return f"{LEAST_SIZE}::"
    # Windows of 1, 2, 4 and 8 bytes, each from two of half its length; the first ones are shorter.
    rolled = _BYTE[np.frombuffer(data, np.uint8)]
    for step, factor in zip((1, 2, 4), _M):
        if n > step:
            longer = rolled.copy()
            longer[step:] += rolled[:-step] * factor
            rolled = longer
    rolled = _mix(rolled)
    total = np.cumsum(rolled, dtype=np.uint64)
    size, ends = LEAST_SIZE, np.flatnonzero((rolled & np.uint64(LEAST_SIZE - 1)) == 0)
    while len(ends) - (len(ends) > 0 and ends[-1] == n - 1) >= CHUNKS:
        size *= 2
        ends = ends[(rolled[ends] & np.uint64(size - 1)) == 0]
    twice = ends[(rolled[ends] & np.uint64(2 * size - 1)) == 0]
    return f"{size}:{_signature(total, ends, n)}:{_signature(total, twice, n)}"


def _signature(total: np.ndarray, ends: np.ndarray, n: int) -> str:
    """A character for each chunk, from the sum of its windows' hashes; the last chunk ends with the text."""
    if not len(ends) or ends[-1] != n - 1:
        ends = np.append(ends, n - 1)
    sums = total[ends]
    sums[1:] -= total[ends[:-1]]
    return "".join(map(ALPHABET.__getitem__, (_mix(sums) >> np.uint64(58)).tolist()))


def edit_distances(pairs: list[tuple[str, str]]) -> np.ndarray:
    """Levenshtein distances of strings of at most 64 characters of the alphabet, all pairs at a time.

    The bit-parallel form: a column of the table is two 64-bit words, and every pair has its own.
    """
    n = len(pairs)
    sizes = np.array([[len(a), len(b)] for a, b in pairs], np.int64).reshape(n, 2)
    left, right = (np.zeros((n, CHUNKS), np.uint8) for _ in range(2))
    for i, pair in enumerate(pairs):
        for table, text in zip((left, right), pair):
            table[i, : len(text)] = _CODE[np.frombuffer(text.encode(), np.uint8)]
    rows, one = np.arange(n), np.uint64(1)
    equal = np.zeros((n, 64), np.uint64)
    for j in range(int(sizes[:, 0].max(initial=0))):
        some = rows[sizes[:, 0] > j]
        equal[some, left[some, j]] |= one << np.uint64(j)
    plus, minus = np.full(n, np.iinfo(np.uint64).max, np.uint64), np.zeros(n, np.uint64)
    score, last = sizes[:, 0].copy(), np.maximum(sizes[:, 0] - 1, 0).astype(np.uint64)
    for t in range(int(sizes[:, 1].max(initial=0))):
        eq = equal[rows, right[:, t]]
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph, mh = minus | ~(xh | plus), plus & xh
        live = sizes[:, 1] > t
        score += np.where(live, ((ph >> last) & one).astype(np.int64) - ((mh >> last) & one).astype(np.int64), 0)
        ph, mh = (ph << one) | one, mh << one
        plus, minus = mh | ~(xv | ph), ph & xv
    return np.where(sizes[:, 0] == 0, sizes[:, 1], score)


def likeness(pairs: list[tuple[str, str]]) -> np.ndarray:
    """From 0 to 1 for each pair of fingerprints: 1 if they are equal, 0 where the block sizes aren't compatible."""
    at, strings = [], []
    out = np.zeros(len(pairs))
    for i, (x, y) in enumerate(pairs):
        if x == y:
            out[i] = 1.0
            continue
        (n, a, a2), (m, b, b2) = x.split(":"), y.split(":")
        n, m = int(n), int(m)
        found = [(a, b), (a2, b2)] if n == m else [(a, b2)] if n == 2 * m else [(a2, b)] if m == 2 * n else []
        at += [i] * len(found)
        strings += found
    if strings:
        longer = np.array([max(len(a), len(b), 1) for a, b in strings])
        np.maximum.at(out, at, 1 - edit_distances(strings) / longer)
    return out


def with_next(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, bucket, tail)`` in an order in which each row's next document follows it.

    Ranges of ids are dealt out and sorted, with the first row of the next range as a ``tail`` row
    at the end of each (after the last comes the first). So every text is shuffled once.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    count = slim.count()
    ranges = max(1, min(count // RANGE_ROWS, MOST_RANGES))
    place = F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf")))
    if ranges > 1:
        from pyspark.ml.feature import Bucketizer

        some = slim.select(place.alias("at")).sample(min(1.0, 20 * ranges / count), seed=7).collect()  # 20 * MOST_RANGES at most, or so
        ordered = sorted(r["at"] for r in some)
        cuts = sorted({ordered[k * len(ordered) // ranges] for k in range(1, ranges)} - {float("-inf")}) if ordered else []
        cut = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="at", outputCol="bucket") if cuts else None
    else:
        cut = None
    dealt = slim.withColumn("at", place)
    dealt = (cut.transform(dealt) if cut else dealt.withColumn("bucket", F.lit(0.0))).drop("at").withColumn("bucket", F.col("bucket").cast("int"))
    # One row for each range, MOST_RANGES at most.
    firsts = sorted((r["bucket"], r["first"]) for r in dealt.groupBy("bucket").agg(F.min(F.coalesce("doc_id", F.lit(-(2**63)))).alias("first")).collect())
    if not firsts:
        return dealt.withColumn("tail", F.lit(False))
    # Null ids sort first, and the least text of a repeated id comes first.
    target = [(first, firsts[i - 1][0]) for i, (_, first) in enumerate(firsts)]
    heads = spark.createDataFrame(target, "first long, to int")
    tails = (
        dealt.join(F.broadcast(heads), F.coalesce("doc_id", F.lit(-(2**63))) == F.col("first"))
        .groupBy("to").agg(F.min(F.struct("doc_id", "text")).alias("row"))
        .select("row.doc_id", "row.text", F.col("to").alias("bucket"), F.lit(True).alias("tail"))
    )
    both = dealt.withColumn("tail", F.lit(False)).unionByName(tails)
    return both.repartition("bucket").sortWithinPartitions("bucket", "tail", F.col("doc_id").asc_nulls_first(), "text")


OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and of its edited text, and how alike they are (columns ``OUT``).

    The edited text has its last half replaced by the first as many characters of the next document
    in ascending ``doc_id``. A null text is empty; a null ``doc_id`` sorts first; rows that repeat a
    ``doc_id`` follow each other by text; of a single document the next is itself. Other columns are
    ignored and an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, rows, held = None, [], 0
        for batch in batches:
            for piece in slices(batch, 1):
                for row in zip(*(piece.column(i).to_pylist() for i in range(4))):
                    doc_id, text, bucket, tail = row
                    own = fingerprint(text.encode("utf-8", "surrogatepass"))
                    if before and before[2] == bucket:
                        rows.append((before[0], before[1], before[3], text, own))
                        held += len(before[1])
                    before = (doc_id, text, bucket, own) if not tail else None
                if held > 4 << 20:
                    yield _compared(rows)
                    rows, held = [], 0
        if rows:
            yield _compared(rows)

    return with_next(docs).select("doc_id", "text", "bucket", "tail").mapInArrow(run, OUT)


def _compared(rows: list[tuple]) -> pa.RecordBatch:
    ids, sizes, shas, owns, edits, pairs = [], [], [], [], [], []
    for doc_id, text, own, follows, its in rows:
        half = len(text) // 2
        data = (text[: len(text) - half] + follows[:half]).encode("utf-8", "surrogatepass")
        edited = fingerprint(data)
        ids.append(doc_id)
        sizes.append(len(text))
        shas.append(hashlib.sha256(data).hexdigest())
        owns.append(own)
        edits.append(edited)
        pairs += [(own, edited), (own, its)]
    near = likeness(pairs).reshape(-1, 2)
    columns = [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(shas), pa.array(owns), pa.array(edits), pa.array(near[:, 0]), pa.array(near[:, 1])]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in OUT.split(", ")])
