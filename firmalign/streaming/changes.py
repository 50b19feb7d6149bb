"""Keep a firm table in step with a stream of master changes.

The state is a few plain tables, each dealt into buckets of its key by a hash, as partitions of its
files. A micro-batch finds the buckets its changed rows, their keys and the firms that share these
keys fall into, reads only those, and writes them anew under its own batch number; every other
bucket stays as an earlier batch left it. A batch reads what earlier batches wrote and overwrites
only its own files, so replaying it after a failure gives the same table, and readers go by the last
batch that was finished.

After every batch the table equals an update plus insert run on the master as changed so far,
apart from the ids of inserted rows, which are given out in order of arrival.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import vocabulary as v
from ..operators.matching import firm_keys, master_keys
from ..operators.mutations import add_tracking_columns, allocate_ids, new_firm_columns, update_matched
from ..sources.versions import cut_lineage

FIRM_COLS = ("firm_id", "payer_id", "name") + v.PAYLOAD_COLS + v.TRACKING_COLS
#: Number of a table's rows before any batch.
START = -1


def _ddl(cols) -> str:
    types = {"firm_id": "bigint", "last_synced_at": "timestamp"}
    return ", ".join(f"{c} {types.get(c, 'string')}" for c in cols)


#: Schema of each table of the state; its first column is the key it is dealt out by.
_STATE = {
    "base": _ddl(FIRM_COLS), "firm": _ddl(FIRM_COLS), "firm_key": "key string, firm_id bigint",
    "master": _ddl(v.MASTER_COLS), "master_key": "key string, oa_id bigint",
    "insert": f"oa_id bigint, removed boolean, {_ddl(FIRM_COLS)}",
}


class StreamedFirms:
    """A base firm table and the state a change stream keeps below ``path``."""

    def __init__(self, spark: SparkSession, base: DataFrame, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        if not self._batches("done", START + 1):
            base = add_tracking_columns(base).select(*FIRM_COLS)
            for name in ("base", "firm"):
                self._write(name, START, base)
            self._write("firm_key", START, firm_keys(base, "in").where(
                "NOT startswith(key, '-:')").select("key", "firm_id").distinct())
            self._finish(START, base.agg(F.coalesce(F.max("firm_id"), F.lit(0))).first()[0])

    # ------------------------------------------------------------ state
    def _bucket(self, key: Column | str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _touched(self, df: DataFrame, key: str) -> list[int]:
        """Buckets some rows fall into: at most ``buckets`` numbers."""
        return [r[0] for r in df.select(self._bucket(F.col(key)).alias("b")).distinct().collect()]

    def _files(self, name: str, schema: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _batches(self, name: str, before: int) -> dict[int, int]:
        """Bucket -> the last batch before a given one that wrote it."""
        files = self._files(name, "bucket int, batch_id bigint")
        if files is None:
            return {}
        rows = files.where(F.col("batch_id") < before).groupBy("bucket").agg(F.max("batch_id"))
        return dict(map(tuple, rows.collect()))

    def _read(self, name: str, before: int, buckets: list[int] | None = None) -> DataFrame:
        """A table as the batches before a given one left it, or some of its buckets."""
        newest = self._batches(name, before)
        paths = [f"{self.path}/{name}/batch_id={k}/bucket={b}" for b, k in sorted(newest.items())
                 if buckets is None or b in buckets]
        schema = f"{_STATE[name]}, bucket int, batch_id bigint"
        if not paths:
            return self.spark.createDataFrame([], _STATE[name])
        rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/{name}").parquet(*paths)
        # A bucket a batch left empty holds one row without a key.
        return rows.where(F.col(rows.columns[0]).isNotNull()).drop("bucket", "batch_id")

    def _write(self, name: str, batch_id: int, rows: DataFrame, buckets: list[int] = ()) -> None:
        """Replace buckets; those named are written even if nothing is left in them."""
        key = rows.columns[0]
        rows = rows.withColumn("bucket", self._bucket(F.col(key)))
        if buckets:
            marks = self.spark.createDataFrame([(b,) for b in buckets], "bucket int")
            rows = rows.unionByName(marks, allowMissingColumns=True)
        (rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket")
         .parquet(f"{self.path}/{name}/batch_id={batch_id}"))

    def _finish(self, batch_id: int, highest: int) -> None:
        """Readers and later batches see this batch from here on."""
        self.spark.createDataFrame([(highest, 0)], "highest bigint, bucket int").write.mode(
            "overwrite").partitionBy("bucket").parquet(f"{self.path}/done/batch_id={batch_id}")

    def _highest(self, before: int) -> int:
        done = self._files("done", "highest bigint, bucket int, batch_id bigint")
        return done.where(F.col("batch_id") < before).agg(F.max("highest")).first()[0]

    def _stamp(self, batch_id: int) -> Column:
        """The time a batch was first tried, also when it is tried again."""
        path = f"{self.path}/stamp/batch_id={batch_id}"
        try:
            known = self.spark.read.schema("at timestamp").parquet(path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            self.spark.range(1).select(F.current_timestamp().alias("at")).write.parquet(path)
            known = self.spark.read.schema("at timestamp").parquet(path)
        return F.lit(known.first()[0])

    # ------------------------------------------------------------ reading
    def _after_last(self) -> int:
        return max(self._batches("done", 1 << 62).values()) + 1

    def master(self) -> DataFrame:
        return self._read("master", self._after_last())

    def current(self) -> DataFrame:
        """The firm table as of the last finished batch."""
        end = self._after_last()
        inserted = self._read("insert", end).where("NOT removed")
        return self._read("firm", end).unionByName(inserted.select(*FIRM_COLS))

    # ------------------------------------------------------------ one batch
    def apply(self, batch: DataFrame, batch_id: int, run_ts: Column | None = None,
              seq: str = "seq") -> None:
        """Take in one micro-batch of master rows; the highest ``seq`` of a row wins."""
        run_ts = self._stamp(batch_id) if run_ts is None else run_ts
        changes = cut_lineage(batch.groupBy(F.col("firm_id").alias("_id")).agg(
            F.max_by(F.struct(*v.MASTER_COLS), seq).alias("r")).select("r.*"), "changes")
        changed_ids = changes.select("firm_id")
        rows = self._touched(changes, "firm_id")
        before = self._read("master", batch_id, rows)
        previous = cut_lineage(before.join(changed_ids, "firm_id", "left_semi"), "changes-before")
        self._write("master", batch_id, before.join(changed_ids, "firm_id", "left_anti")
                    .unionByName(changes), rows)

        # Keys of the changed rows, as they were and as they are.
        old, new = (master_keys(df, kinds="in").select("key", "oa_id").distinct()
                    for df in (previous, changes))
        touched = cut_lineage(old.unionByName(new).select("key").distinct(), "changed-keys")
        keys = self._touched(touched, "key")
        gone = changed_ids.withColumnRenamed("firm_id", "oa_id")
        self._write("master_key", batch_id, self._read("master_key", batch_id, keys)
                    .join(gone, "oa_id", "left_anti").select("key", "oa_id").unionByName(new), keys)

        # Firms that share one of these keys, and the master rows they may match now.
        sharing = self._read("firm_key", batch_id, keys).join(touched, "key", "left_semi")
        ids = cut_lineage(sharing.select("firm_id").distinct(), "touched-firms")
        firms = self._touched(ids, "firm_id")
        affected = self._read("base", batch_id, firms).join(ids, "firm_id", "left_semi")
        wanted = cut_lineage(firm_keys(affected, "in").select("key").distinct(), "wanted-keys")
        near = self._read("master_key", batch_id + 1, self._touched(wanted, "key")).join(
            wanted, "key", "left_semi").select(F.col("oa_id").alias("firm_id")).distinct()
        near = cut_lineage(near, "near-rows")
        master = self._read("master", batch_id + 1, self._touched(near, "firm_id")).join(
            near, "firm_id", "left_semi")
        self._write("firm", batch_id, self._read("firm", batch_id, firms)
                    .join(ids, "firm_id", "left_anti")
                    .unionByName(update_matched(affected, master, run_ts).select(*FIRM_COLS)), firms)

        # Changed rows no base firm matches are inserted, under the id they got before if any.
        links = self._read("insert", batch_id, rows)
        hit = new.join(sharing.select("key").distinct(), "key", "left_semi").select(
            F.col("oa_id").alias("firm_id"))
        known = links.select(F.col("oa_id").alias("firm_id"), F.col("firm_id").alias("old_id"))
        fresh = cut_lineage(changes.join(hit, "firm_id", "left_anti").join(known, "firm_id", "left"),
                            "fresh-rows")
        highest = self._highest(batch_id)
        unnumbered = fresh.where("old_id IS NULL")
        numbered = allocate_ids(unnumbered, "firm_id", F.lit(highest)).unionByName(
            fresh.where("old_id IS NOT NULL").withColumn("new_id", F.col("old_id")))
        inserted = numbered.select(F.col("firm_id").alias("oa_id"), F.lit(False).alias("removed"),
                                   *new_firm_columns(run_ts))
        removed = (links.join(gone, "oa_id", "left_semi")
                   .join(fresh.select(F.col("firm_id").alias("oa_id")), "oa_id", "left_anti")
                   .withColumn("removed", F.lit(True)))
        self._write("insert", batch_id, links.join(gone, "oa_id", "left_anti")
                    .unionByName(removed).unionByName(inserted), rows)
        self._finish(batch_id, highest + unnumbered.count())

    def start(self, changes: DataFrame, run_ts: Column | None = None, seq: str = "seq",
              trigger: dict | None = None):
        """Start the stream. ``availableNow`` (default) is the form to run on a schedule."""
        return (changes.writeStream
                .foreachBatch(lambda df, batch_id: self.apply(df, batch_id, run_ts, seq))
                .option("checkpointLocation", f"{self.path}/checkpoint")
                .trigger(**(trigger or {"availableNow": True})).start())
