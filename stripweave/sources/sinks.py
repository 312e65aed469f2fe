"""Sinks: merges on keys, replaced sets, keyed updates, schema evolution, files."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` stand for those of ``old`` with the same key; columns that one side lacks are null there.

    Of several new rows with one key the last by all columns is taken, so the result doesn't depend on order.
    """
    rows = old.withColumn("_age", F.lit(0)).unionByName(new.withColumn("_age", F.lit(1)), allowMissingColumns=True)
    rest = [F.desc_nulls_last(c) for c in rows.columns if c != "_age" and c not in keys and not isinstance(rows.schema[c].dataType, _unordered())]
    w = Window.partitionBy(*keys).orderBy(F.desc("_age"), *rest)
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "_age")


def _unordered():
    from pyspark.sql.types import MapType, VariantType

    return (MapType, VariantType)


def replace_sets(old: DataFrame, new: DataFrame, parent: list[str], emptied: DataFrame | None = None) -> DataFrame:
    """All children of the parents in ``new`` (and in ``emptied``) are replaced by those in ``new``."""
    parents = new.select(*parent).distinct()
    if emptied is not None:
        parents = parents.unionByName(emptied.select(*parent).distinct())
    return old.join(parents, parent, "left_anti").unionByName(new, allowMissingColumns=True)


def update(rows: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Values of ``changes`` by key where there are any; each key at most once in ``changes``."""
    changed = [c for c in changes.columns if c not in keys]
    side = changes.select(*keys, *(F.col(c).alias(f"_new_{c}") for c in changed))
    joined = rows.join(side, keys, "left")
    return joined.select(*(F.coalesce(f"_new_{c}", c).alias(c) if c in changed else F.col(c) for c in rows.columns))


def shared_folder(spark: SparkSession) -> str | None:
    """The folder that driver and executors share for what is written on the way, if one is set."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def settled(rows: DataFrame) -> DataFrame:
    """A table that several branches of a plan read, made once: in the checkpoint folder where one is set, else kept."""
    spark = rows.sparkSession
    folder = shared_folder(spark)
    if not folder:
        return rows.persist()
    path = f"{folder.rstrip('/')}/stripweave-settled-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def evolved(rows: DataFrame, schema: str, keys: list[str]) -> DataFrame:
    """``rows`` with the columns that the schema has beyond it, as nulls. A missing key column can't be made up."""
    from pyspark.sql.types import StructType

    wanted = StructType.fromDDL(schema)
    if lost := [k for k in keys if k not in rows.columns]:
        raise ValueError(f"key columns {lost} are missing: the table has to be rebuilt")
    return rows.select(*rows.columns, *(F.lit(None).cast(f.dataType).alias(f.name) for f in wanted if f.name not in rows.columns))


def concatenated(*parts: DataFrame) -> DataFrame:
    """All rows with the union of the columns, in the order in which they first appear."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


class Catalog:
    """Tables as Parquet folders below one root, a folder for each version; one writer a table at a time.

    A version counts once its job's mark of success is there, the last thing that a job writes. So a writer that is lost
    at any point leaves the table as it was, and nothing is renamed. The version before stays for plans that still read it.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def _versions(self, name: str) -> tuple[list[str], list[str]]:
        """The folders of complete versions, in order, and of those that never were completed."""
        fs, path = self._fs()
        folder = path(f"{self.root}/{name}")
        found = sorted(x.getPath().getName() for x in fs.listStatus(folder)) if fs.exists(folder) else []
        done = [x for x in found if fs.exists(path(f"{self.root}/{name}/{x}/_SUCCESS"))]
        return done, [x for x in found if x not in done]

    def exists(self, name: str) -> bool:
        return bool(self._versions(name)[0])

    def read(self, name: str) -> DataFrame:
        done, _ = self._versions(name)
        if not done:
            raise LookupError(f"no table {name} in {self.root}")
        return self.spark.read.parquet(f"{self.root}/{name}/{done[-1]}")

    def write(self, name: str, rows: DataFrame) -> None:
        """Write the next version, then delete those before the last one and what lost writers left."""
        fs, path = self._fs()
        done, lost = self._versions(name)
        number = int(done[-1].split("-")[1]) + 1 if done else 0
        marked = rows.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
        marked.parquet(f"{self.root}/{name}/version-{number:010d}-{uuid.uuid4().hex}")
        for old in [*done[:-1], *lost]:
            fs.delete(path(f"{self.root}/{name}/{old}"), True)

    def upsert(self, name: str, rows: DataFrame, keys: list[str]) -> None:
        self.write(name, upsert(self.read(name), rows, keys) if self.exists(name) else upsert(rows.limit(0), rows, keys))

    def replace_sets(self, name: str, rows: DataFrame, parent: list[str]) -> None:
        self.write(name, replace_sets(self.read(name), rows, parent) if self.exists(name) else rows)

    def register(self, *names: str) -> None:
        """Make tables visible to SQL."""
        for name in names:
            self.read(name).createOrReplaceTempView(name)


def repaired_prominence(bags: DataFrame, column: str = "seam_prominence_blob") -> tuple[DataFrame, Column]:
    """Numbers stored as four bytes are decoded; the second value says which rows that concerns."""
    from ..functions.kernels import repaired_float

    bad = F.col(column).isNotNull() & (F.length(column) == 4)
    return bags.withColumn("seam_prominence", F.when(bad, repaired_float(F.col(column))).otherwise(F.col("seam_prominence"))), bad


def write_csv(rows: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """CSV with a header; nested values as JSON text."""
    flat = [F.to_json(c).alias(c) if t.startswith(("struct", "array", "map")) else F.col(c) for c, t in rows.dtypes]
    rows.select(*flat).write.mode(mode).option("header", "true").csv(path)


def write_json(rows: DataFrame, path: str, *, by: list[str] | None = None) -> None:
    """JSON lines, or one folder for each value of ``by``."""
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).json(path)


def write_texts(rows: DataFrame, path: str, *, split: str, name: str, text: str) -> None:
    """Text by split and name, as partitions."""
    rows.select(split, name, F.col(text).alias("value")).write.mode("overwrite").partitionBy(split, name).text(path)


def copy_files(spark: SparkSession, paths: DataFrame, source: str, target: str) -> DataFrame:
    """Copy the files ``(crop_path)`` below ``source`` to ``target`` by Spark's own readers and writers.

    Returns the paths that aren't there. Contents travel as rows to a Parquet package, so nothing is opened on the driver.
    """
    base = source.rstrip("/")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
    rel = found.select(F.substring_index("path", f"{base.removeprefix('file:')}/", -1).alias("crop_path"), "content")
    rel.join(paths.select("crop_path"), "crop_path", "left_semi").write.mode("overwrite").parquet(target)
    return paths.join(rel.select("crop_path"), "crop_path", "left_anti")
