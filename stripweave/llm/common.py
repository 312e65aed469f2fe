"""What the corpus operators share: Arrow batches, shared storage, connected components."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

#: Bytes of text that a Python worker handles at a time (a longer text comes alone).
SLICE_BYTES = 8 << 20
#: Rows that one task reads for one key without ado.
HOT_ROWS = 1_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where it is unset and all runs in one process, one made for this session."""
    context = spark.sparkContext
    given = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not given:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        given = tempfile.mkdtemp(prefix="stripweave-")
        context.setCheckpointDir(given)
    return given.rstrip("/")


_scratch: list[list[str]] = []


def written(df: DataFrame, *, name: str = "part", keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    It cuts the lineage, and any executor can read it again after another is lost. Within ``scratch`` the
    table goes with the scope, or with the one around it (``keep``).
    """
    path = f"{shared_dir(df.sparkSession)}/stripweave-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    scopes = _scratch[:-1] if keep else _scratch
    if scopes:
        scopes[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written within are deleted at the end; nothing that is used later may be planned on them."""
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


_held: dict[str, Callable[[], object]] = {}


def holds(name: str, forget: Callable[[], object]) -> None:
    """An operator's caches in a worker, and how they are emptied."""
    _held[name] = forget


@contextmanager
def task(name: str = "") -> Iterator[None]:
    """Around a task in a worker: other operators' caches are emptied before, and free memory is given back after."""
    for other, forget in _held.items():
        if other != name:
            forget()
    try:
        yield
    finally:
        pa.default_memory_pool().release_unused()
        with suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)


def quoted(name: str) -> Column:
    """The column of that name, whatever characters are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with underscores behind it until no column has it, in either case of letters."""
    known = {c.lower() for c in taken}
    while name.lower() in known:
        name += "_"
    return name


def split_join(left: DataFrame, right: DataFrame, on: list[str], *, sizes: DataFrame | None = None, least: int = HOT_ROWS) -> DataFrame:
    """Inner join of a written table ``left`` with ``right``, which has few rows for a key, where a key may hold much of ``left``.

    The rows of a key with more than a thousandth of ``left``, and with ``least``, go to as many tasks as it has
    such parts, each with its copy of the key's rows of ``right``: a thousand keys and two thousand copies
    at most. ``sizes(*on, _n)`` are the keys' rows, if they are known.
    """
    sizes = left.groupBy(*on).agg(F.count("*").alias("_n")) if sizes is None else sizes
    hot = sizes.where(F.col("_n") > least).orderBy(F.desc("_n"), *on).limit(1000).collect()
    if not hot:
        return left.join(right.hint("merge"), on)
    part = max(least, left.count() // 1000)
    kinds = StructType([left.schema[c] for c in on] + [StructField("_parts", LongType())])
    split = F.broadcast(left.sparkSession.createDataFrame([(*(r[c] for c in on), -(-r["_n"] // part)) for r in hot if r["_n"] > part], kinds))
    parts = F.coalesce("_parts", F.lit(1))
    dealt = left.join(split, on, "left").withColumn("_part", F.pmod(F.xxhash64(*map(quoted, left.columns)), parts)).drop("_parts")
    copied = right.join(split, on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("_parts")
    return dealt.join(copied.hint("merge"), [*on, "_part"]).drop("_part")


def slices(batch: pa.RecordBatch, column: int = 0, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with at most ``limit`` bytes of text, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield batch.slice(start)


def map_texts(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType, *, column: int, name: str = ""
) -> DataFrame:
    """Apply ``function`` to Arrow batches of ``df`` cut by the bytes of the text in ``column``; columns go by their places."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    plain = [f"c{i}" for i in range(len(schema))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task(name):
            for batch in batches:
                for piece in slices(batch, column):
                    yield pa.RecordBatch.from_arrays(function(piece).columns, plain)

    # Column names may hold characters that can't be resolved.
    given = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return given.mapInArrow(run, StructType([StructField(c, f.dataType) for c, f in zip(plain, schema)])).toDF(*schema.names)


def components(edges: DataFrame, *, rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)``: rows ``(id, component)``, component the smallest id.

    Alternating large-star and small-star steps, which need O(log^2 n) rounds and emit
    at most as many edges as they get, until all that is left is stars. Each step aggregates a minimum per node before
    it joins, and the join of a node with very many edges is split.
    Ids in no edge are not returned; loops and nulls are ignored.
    """
    with scratch(edges.sparkSession):
        edges = written(_contracted(edges, rounds), name="components", keep=True)
    roots = edges.select(F.col("b").alias("id")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        roots.select("id", F.col("id").alias("component"))
    )


def _contracted(edges: DataFrame, rounds: int) -> DataFrame:
    """Stars ``(a, b)`` in place of the edges: each id that isn't its component's smallest, and that one."""
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written(edges, name="cc")
    for _ in range(rounds):
        if are_stars(edges):
            return edges
        # Large star: every larger neighbour of a node goes to the smallest of its neighbourhood.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.min("a")).alias("m"))
        large = split_join(both.where("b > a"), least, ["a"]).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = written(large, name="cc")
        # Small star: a node's smaller neighbours, and itself, go to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = split_join(large, least, ["a"])
        edges = (
            small.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .unionByName(least.select("a", F.col("m").alias("b")))
            .distinct()
        )
        edges = written(edges, name="cc")
    if are_stars(edges):
        return edges
    raise RuntimeError("components did not converge")


def are_stars(edges: DataFrame) -> bool:
    """Whether the edges ``(a, b)``, distinct and ``a > b``, have each ``a`` once, and none of them as a ``b``."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionByName(edges.select(F.col("b").alias("id"), F.lit(0).alias("below"), F.lit(1).alias("above")))
    others = ends.groupBy("id").agg(F.sum("below").alias("below"), F.max("above").alias("above")).where("below > 1 or (below = 1 and above = 1)")
    return not others.agg(F.count("*")).first()[0]
