"""What every corpus operator needs: tables, a folder all executors see, and batches of bounded size."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that a task holds as numpy arrays at once (each byte becomes about 30).
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset (tests, a single machine), a folder
    of this process, removed at its end; a cluster without the setting is an error."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    if not spark.sparkContext.master.startswith(("local[", "local")) or "cluster" in spark.sparkContext.master:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if "dir" not in _own:
        _own["dir"] = tempfile.mkdtemp(prefix="tidelake-")
        atexit.register(shutil.rmtree, _own["dir"], ignore_errors=True)
    return f"file://{_own['dir']}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tidelake/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read again: the lineage ends there, and the rows
    survive the loss of any executor."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def runs(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """First row and number of rows of runs of at most so many bytes of text (a longer text stands alone)."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    first = 0
    while first < len(column):
        before = ends[first] - sizes[first]
        last = max(first + 1, int(np.searchsorted(ends, before + most, "right")))
        yield first, last - first
        first = last


def slices(batch: pa.RecordBatch, column: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    for first, n in runs(batch.column(batch.schema.get_field_index(column)), most):
        yield batch.slice(first, n)


def free_name(columns: list[str], name: str) -> str:
    """A column name that is not among columns, in any case."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


class Steps:
    """Tables that the steps of one job write in the shared folder. Each is removed once all that
    reads it is itself written, so that a job holds no more than its open steps."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: dict[str, list[str]] = {}

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        path = new_path(self.spark, name)
        df.write.parquet(path)
        self._paths.setdefault(name, []).append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            for path in self._paths.pop(name, ()):
                fs, where = pafs.FileSystem.from_uri(path if "://" in path else os.path.abspath(path.removeprefix("file:")))
                fs.delete_dir(where)
