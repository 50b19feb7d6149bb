"""Snapshots and published versions of a table kept as plain files.

A version is a directory that is written once and never changed. A tiny pointer directory names
the current one, so readers see either the old table or the new one, and a table is never
overwritten while it is being read.
"""

from __future__ import annotations

import tempfile
import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"


_own_roots: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; where none is set, a scratch folder in local mode only."""
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _own_roots:
        _own_roots[app] = tempfile.mkdtemp(prefix="firmalign-")
    return _own_roots[app]


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the checkpoint folder and read it back.

    Unlike cached blocks, the files survive a lost executor.
    """
    path = f"{checkpoint_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def snapshot(df: DataFrame, path: str) -> str:
    """Back a table up before it is changed; refuses to overwrite an earlier backup."""
    df.write.mode("errorifexists").parquet(path)
    return path


def restore(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


class VersionedTable:
    """A table published as immutable versions below one path.

    Pointers are numbered. The highest number names the current version, and a number that exists
    is refused, so of two writers that publish at the same time one fails.
    """

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def publish(self, df: DataFrame, label: str = "v") -> str:
        """Write a new version, then make it the current one."""
        version = self.write(df, label)
        self.point(df.sparkSession, version)
        return version

    def backup(self, df: DataFrame) -> str:
        """Publish the table as it is before a change."""
        return self.publish(df, "backup")

    def write(self, df: DataFrame, label: str = "v") -> str:
        """Write a version that isn't the current one yet."""
        stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        version = f"{stamp}-{label}-{uuid.uuid4().hex[:8]}"
        df.write.mode("errorifexists").parquet(f"{self.path}/versions/{version}")
        return version

    def _pointers(self, spark: SparkSession) -> list:
        try:
            rows = spark.read.schema("version string, n bigint").json(f"{self.path}/current")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return rows.orderBy(rows["n"].desc()).limit(1).collect()

    def point(self, spark: SparkSession, version: str) -> None:
        """Make a written version the current one."""
        last = self._pointers(spark)
        number = last[0]["n"] + 1 if last else 1
        spark.createDataFrame([(version,)], "version string").coalesce(1).write.mode(
            "errorifexists").json(f"{self.path}/current/n={number}")

    def current(self, spark: SparkSession) -> str:
        return self._pointers(spark)[0]["version"]

    def read(self, spark: SparkSession, version: str | None = None) -> DataFrame:
        return spark.read.parquet(f"{self.path}/versions/{version or self.current(spark)}")

    def rollback(self, spark: SparkSession, version: str) -> DataFrame:
        """Make an earlier version, such as a backup, the current one again."""
        self.point(spark, version)
        return self.read(spark)


class BucketedTable:
    """A table kept twice, dealt into buckets of its key; a pointer names the current copy.

    A change is written to the other copy by overwriting, as partitions, only the buckets that
    differ from it; readers go on with the current copy until the pointer moves, so they see the old
    table or the new one. The copy left behind is the backup of the last change. The pointer keeps
    the buckets in which the two copies differ, so what the other copy lacks is known.
    """

    def __init__(self, path: str, key: str = "firm_id", buckets: int = 64):
        self.path, self.key, self.buckets = path.rstrip("/"), key, buckets

    def _bucket(self) -> Column:
        return F.coalesce(F.pmod(F.xxhash64(self.key), F.lit(self.buckets)), F.lit(0)).cast("int")

    def _pointer(self, spark: SparkSession):
        try:
            rows = spark.read.schema("copy string, differ array<int>, n bigint").json(f"{self.path}/current")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return rows.orderBy(rows["n"].desc()).first()

    def _prints(self, df: DataFrame) -> DataFrame:
        """(bucket, print): rows and a sum of row hashes, which doesn't depend on their order."""
        row = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
        return df.groupBy(self._bucket().alias("bucket")).agg(F.struct(
            F.count(F.lit(1)), F.sum(row.cast("decimal(38,0)")), F.bit_xor(row)).cast(
                "string").alias("print"))

    def _copy(self, spark: SparkSession, copy: str) -> DataFrame:
        rows = spark.read.parquet(f"{self.path}/{copy}")
        # A bucket without rows is kept as one row that is marked as none.
        return rows.where("NOT _none").drop("bucket", "_none")

    def write(self, df: DataFrame, label: str = "v") -> str:
        """Bring the copy that isn't current to the state of ``df``; returns the version to point to.

        ``df`` is evaluated once and kept in the checkpoint folder while buckets are compared.
        """
        spark, pointer = df.sparkSession, self._pointer(df.sparkSession)
        differ, copy = list(range(self.buckets)), "a"
        if pointer is not None:
            copy = "b" if pointer["copy"] == "a" else "a"
            df = cut_lineage(df, label)
            before = self._prints(self.read(spark)).withColumnRenamed("print", "before")
            changed = self._prints(df).join(before, "bucket", "full").where(
                "NOT (print <=> before)").select("bucket")
            differ = sorted(r[0] for r in changed.collect())    # at most one number a bucket
        behind = set(differ) | set(pointer["differ"] if pointer is not None else ())
        if behind:
            rows = df.withColumns({"_none": F.lit(False), "bucket": self._bucket()}).where(
                F.col("bucket").isin(sorted(behind)))
            none = spark.createDataFrame([(b, True) for b in sorted(behind)], "bucket int, _none boolean")
            (rows.unionByName(none, allowMissingColumns=True).repartition("bucket")
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("bucket").parquet(f"{self.path}/{copy}"))
        return f"{copy}:{','.join(map(str, differ))}"

    def point(self, spark: SparkSession, version: str) -> None:
        """Make the copy a write has returned the current one."""
        copy, differ = version.split(":")
        pointer = self._pointer(spark)
        number = pointer["n"] + 1 if pointer is not None else 1
        row = [(copy, [int(b) for b in differ.split(",") if b])]
        spark.createDataFrame(row, "copy string, differ array<int>").coalesce(1).write.mode(
            "errorifexists").json(f"{self.path}/current/n={number}")

    def publish(self, df: DataFrame, label: str = "v") -> str:
        version = self.write(df, label)
        self.point(df.sparkSession, version)
        return version

    def backup(self, df: DataFrame) -> str:
        """The current copy stays as it is during a change; a table that is none yet is published."""
        pointer = self._pointer(df.sparkSession)
        if pointer is None:
            return self.publish(df, "backup")
        return f"{pointer['copy']}:{','.join(map(str, pointer['differ']))}"

    def read(self, spark: SparkSession, version: str | None = None) -> DataFrame:
        return self._copy(spark, version.split(":")[0] if version else self._pointer(spark)["copy"])

    def rollback(self, spark: SparkSession, version: str) -> DataFrame:
        """Make the copy from before the last change the current one again."""
        pointer = self._pointer(spark)
        copy = version.split(":")[0]
        if copy != pointer["copy"]:
            self.point(spark, f"{copy}:{','.join(map(str, pointer['differ']))}")
        return self.read(spark)
