"""Approximate nearest neighbours by an inverted multi-index.

Each half of a vector is quantised by its own k-means, and a vector's entry is under its
pair of centroids, its cell. A query goes through the pairs by the sum of the two
distances, with a heap over the sorted distances of the halves, until the cells seen hold
enough entries; these are ranked by their distance on the original vectors in double
precision.

How many entries are enough is measured on the table itself: for a bounded number of its
vectors the true neighbours are found in one pass over all rows, and the budget is what
their searches would have to see for the wanted recall. Where the vectors have clusters it is
a few cells, whatever the number of rows; where they are spread evenly no index can do
without a large share of them.

Equal vectors are entered once for each of the few ids that can be among the nearest. Cells
are dealt out to blocks of bounded size (a large cell to several), and a block that very
many queries visit is compared with them in chunks; a row goes to no other task.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Vectors that the centroids are fitted on, those with the least hashes of their ids, and the rounds of the fit.
SAMPLE, FIT_ROUNDS = 20_000, 12
#: Entries in a cell on average, up to as many centroids for each half.
CELL, MOST_CENTROIDS = 16, 1024
#: Vectors that the budget is measured on, and the share of their true neighbours that it has to reach.
MEASURED, RECALL = 256, 0.95
#: Entries in a block and queries in a chunk, and the most blocks (larger ones hold the rest), about.
BLOCK, MOST_BLOCKS = 4096, 50_000
#: Tasks of the pass that finds true neighbours, at most: each returns some for every measured vector.
MEASURING_TASKS = 2000


@dataclass
class Quantiser:
    """Centroids of the two halves."""

    left: np.ndarray
    right: np.ndarray

    def distances(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.left.shape[1]
        return squared(vectors[:, :cut], self.left), squared(vectors[:, cut:], self.right)

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        a, b = self.distances(vectors)
        return a.argmin(axis=1) * len(self.right) + b.argmin(axis=1)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(axis=1)[:, None] + (y**2).sum(axis=1)[None, :] - 2 * x @ y.T, 0)


def nearest_center(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.concatenate([squared(points[i : i + 4096], centers).argmin(axis=1) for i in range(0, len(points), 4096)])


def k_means(points: np.ndarray, k: int, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """Lloyd's rounds from distinct points; a centroid that loses its points stays where it is."""
    distinct = np.unique(points, axis=0)
    centers = distinct[np.random.default_rng(5).permutation(len(distinct))[:k]].copy()
    for _ in range(rounds):
        nearest = nearest_center(points, centers)
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, points)
        counts = np.bincount(nearest, minlength=len(centers))
        centers[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centers


def visited(left: np.ndarray, right: np.ndarray, entries: list[int], least: int) -> Iterator[int]:
    """Cells with entries, in ascending order of the summed distances, until they hold ``least`` (or there are no more).

    ``entries[i * len(right) + j]`` is what cell ``(i, j)`` holds. The heap has one open pair for each rank on the
    left: after a pair comes its neighbour on the right, and the next rank opens when one is entered.
    """
    a, b = np.argsort(left, kind="stable").tolist(), np.argsort(right, kind="stable").tolist()
    x, y = np.sort(left).tolist(), np.sort(right).tolist()
    heap, seen, width = [(x[0] + y[0], 0, 0)], 0, len(b)
    while heap and seen < least:
        _, i, j = heapq.heappop(heap)
        cell = a[i] * width + b[j]
        if entries[cell]:
            seen += entries[cell]
            yield cell
        if j + 1 < width:
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (x[i + 1] + y[0], i + 1, 0))


def seen_before(quantiser: Quantiser, vector: np.ndarray, entries: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """How many entries a search from ``vector`` has seen when it has gone through each of ``cells``."""
    a, b = quantiser.distances(vector[None])
    order = np.argsort((a[0][:, None] + b[0][None, :]).ravel(), kind="stable")
    total = np.empty(len(order), np.int64)
    total[order] = np.cumsum(entries[order])
    return total[cells]


def usable(table: DataFrame) -> DataFrame:
    """Rows ``(vec_id, vector)`` that take part: an id, and finite components of which one isn't zero."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return table.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("vector")).where(fine)


def matrix(column: pa.Array) -> np.ndarray:
    """The vectors of an Arrow list column, all of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def fitted(rows: DataFrame, dims: int, centroids: int) -> Quantiser:
    h = F.xxhash64("vec_id")
    last = rows.select(h.alias("h")).orderBy("h").limit(SAMPLE).agg(F.max("h")).first()[0]
    some = rows.where(h <= last).select("vec_id", "vector", h.alias("h")).orderBy("h", "vec_id", "vector").limit(SAMPLE).collect()
    sample = np.array([r["vector"] for r in some])
    cut = dims - dims // 2  # a vector of one component has an empty right half
    return Quantiser(k_means(sample[:, :cut], centroids), k_means(sample[:, cut:], centroids))


def distinct_entries(rows: DataFrame, k: int) -> DataFrame:
    """``(vec_id, vector)``: of equal vectors the ``k + 1`` least ids; no others can be among the ``k`` nearest of a query."""
    order = Window.partitionBy("vector").orderBy("vec_id")
    return rows.distinct().withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1).drop("nth")


def measured_budget(entries: DataFrame, quantiser: Quantiser, held: np.ndarray, k: int, recall: float) -> int:
    """The entries to be seen for the wanted recall of the ``k`` nearest, by ``MEASURED`` of the vectors against all."""
    some = entries.select("vec_id", "vector").orderBy(F.xxhash64("vec_id", F.lit("measured")), "vec_id", "vector").limit(MEASURED).collect()
    own, vectors = np.array([r["vec_id"] for r in some]), np.array([r["vector"] for r in some])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, cell = np.full((len(own), k), np.inf), np.full((len(own), k), -1)
        for batch in batches:
            ids, at = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            found = matrix(batch.column(1)) if batch.num_rows else ()
            for i in range(0, batch.num_rows, 4096):
                near = squared(vectors, found[i : i + 4096])
                near[own[:, None] == ids[None, i : i + 4096]] = np.inf
                both, cells = np.concatenate([best, near], axis=1), np.concatenate([cell, np.broadcast_to(at[i : i + 4096], near.shape)], axis=1)
                least = np.argpartition(both, k - 1, axis=1)[:, :k]
                best, cell = np.take_along_axis(both, least, axis=1), np.take_along_axis(cells, least, axis=1)
        q, j = np.nonzero(np.isfinite(best))
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(best[q, j]), pa.array(cell[q, j], pa.int32())], ["q", "near", "cell"])

    order = Window.partitionBy("q").orderBy("near", "cell")
    near = entries.coalesce(MEASURING_TASKS).mapInArrow(run, "q int, near double, cell int").withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k)
    cells: dict[int, list[int]] = {}
    for r in near.select("q", "cell").collect():  # MEASURED * k rows
        cells.setdefault(r["q"], []).append(r["cell"])
    seen = [seen_before(quantiser, vectors[q], held, np.array(c)) for q, c in cells.items()]
    return int(np.quantile(np.concatenate(seen), recall, method="higher")) if seen else 0


def in_blocks(held: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first block of each cell and its number of blocks: neighbouring cells share one as long as there is room."""
    first, parts = np.zeros(len(held), np.int64), np.zeros(len(held), np.int64)
    opened, room = 0, size
    for cell in np.flatnonzero(held).tolist():
        n = int(held[cell])
        if n > room:
            opened, room = opened + 1, size
        first[cell], parts[cell] = opened, -(-n // size)
        if n > size:
            opened, room = opened + parts[cell], size
        else:
            room -= n
    return first, parts


def search(table: DataFrame, *, every: int = 100, k: int = 10, recall: float = RECALL, centroids: int | None = None) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest rows found for each row with ``vec_id % every = 0``.

    Rows without an id or with a null, zero or partly null or non-finite vector take no part, nor do
    those whose length isn't the most frequent one (the greatest of them, in a tie). Equal distances
    go by the smaller id. Rows that repeat an id are one candidate, or one query, at the nearest of its vectors, and
    an id is no candidate of its own. Other columns are ignored; an empty table, or one without queries, gives no
    rows. Of fewer than ``k`` candidates all are found.
    """
    spark = table.sparkSession
    rows = usable(table)
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims, count = sizes["n"], sizes["count"]
    rows = rows.where(F.size("vector") == dims)
    quantiser = fitted(rows, dims, centroids or max(1, min(MOST_CENTROIDS, round(math.sqrt(count / CELL)))))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = np.concatenate([quantiser.cells(v) for v in np.array_split(matrix(batch.column(1)), -(-batch.num_rows // 4096))])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int32())], ["vec_id", "vector", "cell"])

    entries = written(distinct_entries(rows, k).mapInArrow(assign, "vec_id long, vector array<double>, cell int"), name="entries")
    held = np.zeros(len(quantiser.left) * len(quantiser.right), np.int64)
    for r in entries.groupBy("cell").count().collect():  # MOST_CENTROIDS squared at most
        held[r["cell"]] = r["count"]
    budget = measured_budget(entries, quantiser, held, k, recall)
    first, parts = in_blocks(held, max(BLOCK, int(held.sum()) // MOST_BLOCKS))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entered, names = held.tolist(), ["query_id", "vector", "cells", "block"]
        kinds = [pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int32()), pa.int32()]
        for batch in batches:
            out: list[tuple] = []
            vectors = matrix(batch.column(1)) if batch.num_rows else ()
            for vec_id, vector, own in zip(batch.column(0).to_pylist(), vectors, batch.column(2).to_pylist()):
                a, b = quantiser.distances(vector[None])
                # The entries that have the query's id are no candidates, wherever they are.
                cells = np.fromiter(visited(a[0], b[0], entered, max(budget, k + own)), np.int64)
                cells = np.repeat(cells, parts[cells])
                to = first[cells] + np.concatenate([np.arange(n) for n in parts[cells[np.flatnonzero(np.diff(cells, prepend=-1))]]])
                order = np.argsort(to, kind="stable")
                to, cells = to[order], cells[order]
                cuts = np.flatnonzero(np.diff(to)) + 1
                out += [(vec_id, vector, some, block) for some, block in zip(np.split(cells, cuts), to[np.concatenate(([0], cuts))].tolist())]
                if len(out) > 2000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    queries = rows.where(F.col("vec_id") % every == 0).distinct()
    owned = entries.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.count("*").alias("own"))
    asked = queries.join(owned.hint("merge"), "vec_id", "left").select("vec_id", "vector", F.coalesce("own", F.lit(0)).alias("own"))
    asked = written(asked.mapInArrow(ask, "query_id long, vector array<double>, cells array<int>, block int"), name="asked")
    # A row for each cell and for each block, of which the numbers are bounded.
    cells = np.flatnonzero(held)
    place = F.broadcast(spark.createDataFrame(pd.DataFrame({"cell": cells.astype("int32"), "first": first[cells], "parts": parts[cells]})))
    chunks = asked.groupBy("block").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("chunks"))
    chunks = F.broadcast(written(chunks, name="chunks"))
    dealt = entries.join(place, "cell").withColumn("block", (F.col("first") + F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("parts"))).cast("int"))
    dealt = dealt.join(chunks, "block").select("vec_id", "vector", "cell", "block", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    asked = asked.join(chunks, "block").select("query_id", "vector", "cells", "block", F.pmod(F.xxhash64("query_id", "vector"), F.col("chunks")).cast("int").alias("chunk"))

    def rank(queries: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(queries) and len(found):
            vectors, ids = np.stack(found["vector"].to_numpy()), found["vec_id"].to_numpy()
            cells, place = np.unique(found["cell"].to_numpy(), return_inverse=True)
            alone = len(np.unique(ids)) == len(ids)
            for query, vector, asked in zip(queries["query_id"], queries["vector"], queries["cells"]):
                open_cells = np.isin(cells, asked)
                seen = open_cells[place] & (ids != query)
                near = np.sqrt(((vectors[seen] - vector) ** 2).sum(axis=1))
                some = ids[seen]
                best = _least(near, some, k if alone else len(some))
                if not alone:
                    best = best[np.sort(np.unique(some[best], return_index=True)[1])][:k]
                parts.append((np.full(len(best), query), some[best], near[best]))
        query, vec, near = map(np.concatenate, zip(*parts))
        return pd.DataFrame({"query_id": query, "vec_id": vec, "score": near})

    near = asked.groupBy("block", "chunk").cogroup(dealt.groupBy("block", "chunk")).applyInPandas(rank, "query_id long, vec_id long, score double")
    near = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _least(near: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` least distances, ties by id."""
    if len(near) <= 4 * k:
        return np.lexsort((ids, near))[:k]
    limit = np.partition(near, k - 1)[k - 1]
    some = np.flatnonzero(near <= limit)
    return some[np.lexsort((ids[some], near[some]))[:k]]
