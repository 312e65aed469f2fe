"""Near-duplicates by MinHash bands and odd sketches, confirmed on the full shingle sets.

1. Texts with equal shingle sets form a class, which is compared once.
2. Each class gets 130 MinHash samples. 26 bands of 5 samples give bucket keys: a pair at
   similarity 0.85 shares no bucket with probability below 3e-7. The samples are also folded
   into an odd sketch, a bitmap of parities: the XOR of two sketches has about as many bits
   as samples that differ, which tells high similarities apart in 32 bytes.
3. Star rounds: in each bucket every member is compared with one center by sketch, and the
   pairs that may be links are confirmed on their sets. The work is linear in a bucket. As
   long as much is left between components, further centers are taken from the bucket's main
   component and from the rest, for the members outside the main one.
4. Rest round: the members outside their bucket's main component are compared with all of
   its members, in blocks of bounded size, first by sketch and then on the sets, leaving out
   pairs of one component and, in large buckets, those that the triangle inequality rules
   out. A block gives a spanning forest of its links and not all pairs.
5. Components of all confirmed links, by star contraction.

So no link between different texts that share a bucket is lost, no task holds a whole
bucket, and a group of many similar texts costs rows in proportion to its size, and to what
lies outside its main component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, scratch, slices, split_join, task, written

SHINGLE = 5
BANDS, ROWS = 26, 5
SAMPLES = BANDS * ROWS
SKETCH_BITS = 256
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Sketches may differ in as many bits as at similarity 0.64 are expected, six deviations below 0.85.
MOST_BITS = 66
#: Members of a bucket compared at a time in the rest round.
BLOCK = 1024
#: Further star rounds as long as the buckets that still span components would need more comparisons a member than this.
STAR_ROUNDS, PAIRS = 6, 4 * BLOCK
#: The width of a ring around a center, in distance; a little more than a link's greatest one.
RING = 0.151
#: Bytes of text hashed at a time; a longer text comes alone.
HASHED_BYTES = 1 << 19

_random = np.random.default_rng(20240229)
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _random.integers(1, 2**63, SHINGLE + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_A = _random.integers(1, 2**63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _random.integers(1, 2**63, SAMPLES, dtype=np.uint64)
_SALT = _random.integers(1, 2**63, SAMPLES, dtype=np.uint64)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(n, _MULTIPLIER, np.uint64))


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its 5-word shingles.

    Words are runs without ASCII white space, A-Z lower-cased. A text with fewer words has one
    shingle, all of them; one without words has none.
    """
    parts = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    buffer = np.frombuffer(b"\n".join([*parts, b""]), np.uint8)
    limits = np.cumsum([len(p) + 1 for p in parts])
    inside = ~_SPACE[buffer]
    edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    empty = np.zeros(0, np.uint64)
    if not len(starts):
        return [empty for _ in texts]
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    inner = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    words = mix(np.add.reduceat(_BYTE[buffer[inside]] * _powers(int(sizes.max()))[inner], first))
    owner = np.searchsorted(limits, starts, "right")
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    n = max(0, len(words) - SHINGLE + 1)
    runs = mix(sum((words[j : j + n] * _PLACE[j] for j in range(SHINGLE)), np.zeros(n, np.uint64)))
    out = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= SHINGLE:
            out.append(np.unique(runs[a : b - SHINGLE + 1]))
        elif b > a:
            few = np.append(words[a:b] * _PLACE[: b - a], _PLACE[SHINGLE:] * np.uint64(b - a))
            out.append(mix(few.sum(dtype=np.uint64, keepdims=True)))
        else:
            out.append(empty)
    return out


def samples(shingles: np.ndarray) -> np.ndarray:
    """The MinHash samples of a set that isn't empty."""
    least = np.full(SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 2048):
        np.minimum(least, (shingles[i : i + 2048, None] * _A + _B).min(axis=0), out=least)
    return least


def odd_sketch(least: np.ndarray) -> np.ndarray:
    """Each sample, with its number, flips one of the sketch's bits: four 64-bit words."""
    bits = np.bincount((mix(least ^ _SALT) >> np.uint64(56)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def similarity(bits: float) -> float:
    """The similarity at which two sketches are expected to differ in so many bits."""
    return 1 + SKETCH_BITS / (4 * SAMPLES) * float(np.log(max(1e-9, 1 - 2 * bits / SKETCH_BITS)))


def band_keys(least: np.ndarray) -> np.ndarray:
    weights = _A[:ROWS]
    folded = (mix(least.reshape(BANDS, ROWS)) * weights).sum(axis=1, dtype=np.uint64)
    return mix(folded + np.arange(1, BANDS + 1, dtype=np.uint64) * _MULTIPLIER).view(np.int64)


FEATURES = "doc_id long, text_hash long, n_shingles long, h1 long, h2 long, s0 long, s1 long, s2 long, s3 long, bands array<long>"
SKETCH = ["s0", "s1", "s2", "s3"]


def keyed(docs: DataFrame) -> DataFrame:
    """A row's key is its id and its text's hash."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def features(docs: DataFrame) -> DataFrame:
    """Set size, two hashes of the set, sketch and band keys of each document; null where the set is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task():
            for batch in batches:
                for piece in slices(batch, 2, HASHED_BYTES):
                    yield of(piece)

    def of(piece: pa.RecordBatch) -> pa.RecordBatch:
        sizes, hashes, sketches, bands = [], [], [], []
        for s in shingle_sets(piece.column(2).to_pylist()):
            sizes.append(len(s))
            if not len(s):
                hashes.append((None, None))
                sketches.append((None,) * 4)
                bands.append(None)
                continue
            least = samples(s)
            h = [int(mix(s ^ _SALT[i]).sum(dtype=np.uint64).view(np.int64)) for i in (0, 1)]
            hashes.append(h)
            sketches.append(odd_sketch(least).tolist())
            bands.append(band_keys(least))
        return pa.RecordBatch.from_arrays(
            [piece.column(0), piece.column(1), pa.array(sizes, pa.int64()), *(pa.array(c, pa.int64()) for c in (*zip(*hashes), *zip(*sketches))), pa.array(bands, pa.list_(pa.int64()))],
            ["doc_id", "text_hash", "n_shingles", "h1", "h2", *SKETCH, "bands"],
        )

    return keyed(docs).mapInArrow(run, FEATURES)


def full_sets(texts: DataFrame) -> DataFrame:
    """The shingle set of each row of ``texts(doc, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task():
            for piece in (p for batch in batches for p in slices(batch, 1, HASHED_BYTES)):
                found = [s.view(np.int64) for s in shingle_sets(piece.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(found, pa.list_(pa.int64()))], ["doc", "items"])

    return texts.mapInArrow(run, "doc long, items array<long>")


def runs_of(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Consecutive rows that are equal in their first ``keys`` columns, across batch borders."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        new = np.zeros(batch.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def near_by_sketch(sketch: np.ndarray, rows: np.ndarray | list[int]) -> np.ndarray:
    """For some rows of ``sketch`` (n x 4 words), which others differ in few enough bits."""
    words = sketch.view(np.uint64)
    return sum(np.bitwise_count(words[rows, i][:, None] ^ words[None, :, i]).astype(np.int16) for i in range(4)) <= MOST_BITS


def _compared(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a run's classes, each once: the ids, their first rows, components, sketches, and whether each is on the left and on the right."""
    ids, first, place = np.unique(table["doc"].to_numpy(), return_index=True, return_inverse=True)
    side = table["left"].to_numpy(zero_copy_only=False)
    left, right = (np.bincount(place, side == x, len(ids)) > 0 for x in (True, False))
    get = lambda name: table[name].to_numpy()[first]
    return ids, first, get("component"), np.ascontiguousarray(np.stack([get(c) for c in SKETCH], axis=1)), left, right


def candidates_in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members that may link, by sketch, to one of another component on the other side of their run."""
    for table in runs_of(batches, 3):
        ids, _, comp, sketch, left, right = _compared(table)
        keep, some = np.zeros(len(ids), bool), np.flatnonzero(left)
        for a in range(0, len(some), 256):
            rows = some[a : a + 256]
            near = near_by_sketch(sketch, rows) & (comp[rows, None] != comp[None, :]) & right
            keep[rows] |= near.any(axis=1)
            keep |= near.any(axis=0)
        if keep.any():
            n = int(keep.sum())
            yield pa.RecordBatch.from_arrays([pa.array([table["key"][0].as_py()] * n, pa.int64()), pa.array(ids[keep])], ["key", "doc"])


def links_in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the confirmed links between components in each run."""
    for table in runs_of(batches, 3):
        ids, first, comp, sketch, left, right = _compared(table)
        sets = [table["items"][int(k)].values.to_numpy() for k in first]
        sizes = np.array([len(s) for s in sets])
        items, code = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(ids)), sizes)
        order = np.argsort(code, kind="stable")
        posting = owner[order]
        at = np.searchsorted(code[order], np.arange(len(items) + 1))
        of = np.split(code, np.cumsum(sizes)[:-1])
        _, label = np.unique(comp, return_inverse=True)
        out = []
        for i in np.flatnonzero(left):
            may = near_by_sketch(sketch, [i])[0] & (label != label[i]) & right
            if not may.any():
                continue
            shared = np.bincount(np.concatenate([posting[at[c] : at[c + 1]] for c in of[i]]), minlength=len(ids))
            linked = may & (100 * shared >= PERCENT * (sizes + sizes[i] - shared))
            for j in np.flatnonzero(linked):
                if label[j] != label[i]:
                    out.append((ids[i], ids[j]))
                    label[label == label[j]] = label[i]
        if out:
            a, b = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def open_buckets(members: DataFrame) -> DataFrame:
    """Of the buckets whose members are in several components ``(key, main, n, others)``: the component with most, all members, and those not in it."""
    each = members.groupBy("key", "component").agg(F.count("*").alias("n"))
    found = each.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("n").alias("n"), F.max("n").alias("most"))
    return found.select("key", "main", "n", (F.col("n") - F.col("most")).alias("others")).where("others > 0")


def sides(members: DataFrame) -> DataFrame:
    """``(key, doc, component, left)`` from ``members(key, doc, component, main, ring)``: who meets whom.

    Whoever is outside its bucket's main component is on the left, in its ring and the next ones, and all are on
    the right in theirs. Of a ring's left members those of the most frequent component meet only the right
    members outside it. Two members of different components in rings that touch meet somewhere.
    """
    outside = members.where("component <> main").select("key", F.explode(F.array(*(F.col("ring") + d for d in (-1, 0, 1)))).alias("ring"), "doc", "component")
    most = outside.groupBy("key", "ring", "component").agg(F.count("*").alias("n")).groupBy("key", "ring").agg(F.max_by("component", F.struct("n", "component")).alias("most"))
    most = written(most, name="most")
    on, same = ["key", "ring"], F.col("component") == F.col("most")
    left = split_join(written(outside, name="left"), most, on).select(F.xxhash64("key", "ring", same).alias("key"), "doc", "component", F.lit(True).alias("left"))
    right = split_join(members.select("key", "ring", "doc", "component"), most, on)
    right = right.select("key", "ring", "doc", "component", F.explode(F.when(same, F.array(F.lit(False))).otherwise(F.array(F.lit(True), F.lit(False)))).alias("meets"))
    return left.unionByName(right.select(F.xxhash64("key", "ring", "meets").alias("key"), "doc", "component", F.lit(False).alias("left")))


def in_blocks(members: DataFrame) -> DataFrame:
    """Deal each bucket out to pairs of blocks ``(i, j)`` of its left and right members, sorted for ``runs_of``."""
    blocks = lambda side: F.ceil(F.count_if(side) / BLOCK).cast("int")
    sizes = members.groupBy("key").agg(blocks(F.col("left")).alias("lefts"), blocks(~F.col("left")).alias("rights")).where("lefts > 0 and rights > 0")
    dealt = split_join(members, sizes, ["key"])
    place = lambda n: F.pmod(F.xxhash64("doc"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rest = [c for c in members.columns if c != "key"]
    left = dealt.where("left").select("key", place("lefts").alias("i"), every("rights").alias("j"), *rest)
    right = dealt.where("not left").select("key", every("lefts").alias("i"), place("rights").alias("j"), *rest)
    return left.unionByName(right).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


CLASS = ["h1", "h2", "n_shingles"]


def grouped(docs: DataFrame, *, tie_ids: bool) -> tuple[DataFrame, DataFrame]:
    """The documents' features, and the classes ``(doc, *CLASS, first, text_hash, rows, root)`` of equal sets.

    ``doc`` numbers the classes; ``first`` and ``text_hash`` are the key of the row that stands for a class, ``root``
    that ``(first, text_hash)`` of the class that stands for its component. With ``tie_ids`` the classes of one ``doc_id`` are linked.
    """
    with scratch(docs.sparkSession):
        found = written(features(docs), name="features")
        classes = _grouped(docs, found, tie_ids)
        return written(found.drop(*SKETCH, "bands"), name="rows", keep=True), written(classes, name="roots", keep=True)


def _grouped(docs: DataFrame, found: DataFrame, tie_ids: bool) -> DataFrame:
    usable = found.where("n_shingles > 0 and doc_id is not null")
    classes = usable.groupBy(*CLASS).agg(
        F.min(F.struct("doc_id", "text_hash")).alias("row"), F.count("*").alias("rows"), *(F.min(c).alias(c) for c in SKETCH), F.min("bands").alias("bands")
    )
    classes = classes.select(F.monotonically_increasing_id().alias("doc"), *CLASS, F.col("row.doc_id").alias("first"), F.col("row.text_hash").alias("text_hash"), "rows", *SKETCH, "bands")
    classes = written(classes, name="classes")  # which settles the numbers
    again = usable.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    again = written(again, name="again")
    repeated = not again.isEmpty()
    links = confirmed(docs, classes, repeated)
    if repeated and tie_ids:
        rows = split_join(written(usable.join(again, "doc_id", "left_semi").select("doc_id", *CLASS).distinct(), name="repeated"), classes.select(*CLASS, "doc"), CLASS)
        rows = written(rows.select("doc_id", "doc").distinct(), name="repeated")
        least = rows.groupBy("doc_id").agg(F.min("doc").alias("b"))
        links = links.unionByName(split_join(rows, least, ["doc_id"]).where("doc <> b").select(F.col("doc").alias("a"), "b"))
    comps = components(links)
    own = F.struct("first", "text_hash")
    joined = written(comps.withColumnRenamed("id", "doc").join(classes.select("doc", "first", "text_hash"), "doc"), name="joined")
    roots = joined.groupBy("component").agg(F.min(own).alias("root"))
    roots = split_join(joined.select("doc", "component"), roots, ["component"]).select("doc", "root")
    return classes.drop(*SKETCH, "bands").join(roots, "doc", "left").withColumn("root", F.coalesce("root", own))


def with_classes(found: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows that have a class, with its component's root; a set that many rows have is a split key."""
    usable = found.where("n_shingles > 0 and doc_id is not null").select("doc_id", "text_hash", *CLASS)
    return split_join(usable, classes.select(*CLASS, "root"), CLASS, sizes=classes.select(*CLASS, F.col("rows").alias("_n")))


def linked(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, a row for each row of ``docs``.

    Documents without words are linked with nothing, as are rows with a null ``doc_id`` (their
    ``component_id`` is null and they are kept). Rows that repeat a ``doc_id`` count as one document
    with the links of each of them. Other columns are ignored; an empty table gives no rows. Texts are read
    whole, whatever their length, and equal texts are always linked.
    """
    found, classes = grouped(docs, tie_ids=True)
    with_set = with_classes(found, classes).select("doc_id", "n_shingles", F.col("root.first").alias("component_id"))
    # The other rows stand by themselves.
    others = found.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    every = with_set.unionByName(others)
    return every.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_hash)`` (as in ``keyed``) of the rows that aren't the first of their component, once each.

    Here each row is a document by itself, also if another has its id: a text goes only if one like it stays. Rows
    with a null id or without words aren't in the table. Other columns are ignored; an empty table gives no rows.
    """
    found, classes = grouped(docs, tie_ids=False)
    rows = with_classes(found, classes)
    return rows.where((F.col("doc_id") != F.col("root.first")) | (F.col("text_hash") != F.col("root.text_hash"))).select("doc_id", "text_hash").distinct()


def confirmed(docs: DataFrame, classes: DataFrame, repeated: bool) -> DataFrame:
    """Links ``(a, b)`` between classes, enough of them to connect whatever is connected."""
    sketches = classes.select("doc", *SKETCH)
    keys = classes.select("doc", F.explode("bands").alias("key"))
    stars = keys.groupBy("key").agg(F.min("doc").alias("center"), F.count("*").alias("members")).where("members > 1")
    stars = written(stars, name="stars")
    shared = written(split_join(keys, stars, ["key"], sizes=stars.select("key", F.col("members").alias("_n"))), name="shared")

    def may_link(pairs: DataFrame) -> DataFrame:
        """Pairs ``(a, b)`` whose sketches are near; ``b`` may be in very many of them."""
        left, right = (sketches.select(F.col("doc").alias(x), *(F.col(c).alias(f"{x}{c}") for c in SKETCH)) for x in "ab")
        bits = sum((F.expr(f"bit_count(a{c} ^ b{c})") for c in SKETCH), F.lit(0))
        near = split_join(written(pairs, name="pairs"), right, ["b"]).join(left.hint("merge"), "a")
        return written(near.where(bits <= MOST_BITS).select("a", "b"), name="near")

    pairs = may_link(shared.where("doc <> center").select(F.col("doc").alias("a"), F.col("center").alias("b")).distinct())
    # Whoever may be compared again below needs its set too: members of buckets with others than the center.
    involved = pairs.select("a").union(pairs.select("b")).union(shared.where("members > 2").select("doc")).distinct().withColumnRenamed("a", "doc")
    rows = involved.join(classes.select("doc", F.col("first").alias("doc_id"), "text_hash"), "doc")
    texts = keyed(docs).join(rows, ["doc_id", "text_hash"]).select("doc", "text")
    sets = full_sets(texts.dropDuplicates(["doc"]) if repeated else texts)
    sets = written(sets, name="sets")

    def distances(pairs: DataFrame) -> DataFrame:
        a, b = (sets.select(F.col("doc").alias(x), F.col("items").alias(f"{x}_items")) for x in "ab")
        both = split_join(written(pairs, name="pairs"), b, ["b"]).join(a.hint("merge"), "a")
        both = both.withColumn("common", F.size(F.array_intersect("a_items", "b_items")))
        return both.select("a", "b", "common", (F.size("a_items") + F.size("b_items") - F.col("common")).alias("union"))

    def verified(pairs: DataFrame) -> DataFrame:
        return distances(pairs).where(100 * F.col("common") >= PERCENT * F.col("union")).select("a", "b")

    links = written(verified(pairs), name="links")
    for number in range(STAR_ROUNDS + 1):
        found = components(links)
        # Stars stand for the links so far: they connect the same classes.
        links = found.where("id <> component").select(F.col("id").alias("a"), F.col("component").alias("b"))
        comps = found.withColumnRenamed("id", "doc")
        members = shared.where("members > 2").select("key", "doc").join(comps.hint("merge"), "doc", "left").withColumn("component", F.coalesce("component", "doc"))
        members = written(members, name="members")
        buckets = written(open_buckets(members), name="open")
        work, rows = buckets.agg(F.sum(F.col("others").cast("double") * F.col("n")), F.sum("n")).first()
        if not rows:
            return links
        members = written(split_join(members, buckets.select("key", "main"), ["key"]), name="members")
        if work <= PAIRS * rows:
            break
        # Other centers for each of these buckets, one of its main component and one of the rest, for the members outside
        # the main component: in a few rounds most of them find one near, or others of their own kind.
        some = F.xxhash64("doc", F.lit(number))
        centers = members.groupBy("key").agg(*(F.min_by("doc", F.when(side, some)).alias(c) for c, side in (("b", F.col("component") == F.col("main")), ("c", F.col("component") != F.col("main")))))
        centers = written(centers, name="centers")
        if number == STAR_ROUNDS:
            break
        again = split_join(members.where("component <> main").select("key", F.col("doc").alias("a")), centers, ["key"])
        again = again.select("a", F.explode(F.array("b", "c")).alias("b")).where("a <> b").distinct()
        links = written(links.unionByName(verified(may_link(again))), name="links")
    if work > PAIRS * rows:
        # Distances are a metric: two members that are at distances from one center which differ by more than a
        # link's aren't linked. So a member meets those in its own ring around the center and in the next ones.
        rings = written(split_join(members.select("key", "doc"), centers.select("key", F.col("b").alias("center")), ["key"]), name="rings")
        far = distances(rings.select(F.col("doc").alias("a"), F.col("center").alias("b")).distinct()).withColumn("ring", F.floor((1 - F.col("common") / F.col("union")) / RING).cast("int"))
        far = written(far.select(F.col("a").alias("doc"), F.col("b").alias("center"), "ring"), name="rings")
        members = members.join(rings.join(far.hint("merge"), ["doc", "center"]).select("key", "doc", "ring").hint("merge"), ["key", "doc"])
    else:
        members = members.withColumn("ring", F.lit(0))
    members = written(sides(members), name="sides")
    members = written(members.join(sketches.hint("merge"), "doc"), name="members")
    may = in_blocks(members).mapInArrow(candidates_in_blocks, "key long, doc long").distinct()
    members = written(may.join(members.hint("merge"), ["key", "doc"]), name="may")
    if members.isEmpty():
        return links
    found = in_blocks(written(members.join(sets.hint("merge"), "doc"), name="may")).mapInArrow(links_in_blocks, "a long, b long")
    return links.unionByName(found)
