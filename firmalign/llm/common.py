"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from firmalign.sources.versions import checkpoint_root, cut_lineage

__all__ = ["arrow_schema", "cut_lineage", "cut_rows", "map_arrow", "open_file",
           "shared_folder", "spread", "table", "task_file", "texts_of"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder, shared by all executors, for files an operator writes itself."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` for a function from record batches to lists of columns in schema order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in fn(batches):
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type)
                 for c, f in zip(columns, target, strict=True)], schema=target)

    target = arrow_schema(schema)
    return df.mapInArrow(run, schema)


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(),
             "double": pa.float64(), "boolean": pa.bool_(), "array<bigint>": pa.list_(pa.int64()),
             "array<string>": pa.list_(pa.string()), "array<int>": pa.list_(pa.int32()),
             "array<double>": pa.list_(pa.float64())}
    return pa.schema([(name, kinds[kind]) for name, kind in
                      (part.strip().split(" ", 1) for part in ddl.split(","))])


def texts_of(column: pa.Array) -> list[str]:
    """The texts of a column; a missing text is an empty one."""
    return [t or "" for t in column.to_pylist()]


def cut_rows(batches: Iterable[pa.RecordBatch], most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most_bytes`` at most, unless one row alone is larger."""
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        step = max(1, int(rows * most_bytes / max(batch.nbytes, 1)))
        for at in range(0, rows, step):
            yield batch.slice(at, step)


def open_file(path: str, mode: str):
    """A file in a folder that all executors share, by path or URI."""
    from pyarrow.fs import FileSystem
    fs, local = FileSystem.from_uri(path)
    if mode == "w":
        fs.create_dir(local.rsplit("/", 1)[0], recursive=True)
        return fs.open_output_stream(local)
    return fs.open_input_file(local)


def task_file(folder: str, suffix: str) -> str:
    """A file name of this attempt of this task: a repeated task never writes over another's."""
    task = TaskContext.get()
    return f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}{suffix}"


def spread(df: DataFrame, parts: int) -> DataFrame:
    """Deal the few rows of a list of files out, about one to a task."""
    return df.repartition(max(1, parts))
