"""Helpers shared by the operators of this subpackage: inputs, shared storage, text slices."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy step works on at a time; a longer text is a step of its own.
STEP_BYTES = 1 << 18
#: Bytes of an Arrow batch between Spark and Python, so that a worker never holds much more than a step.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where it is unset in a local session (tests) a new temporary one."""
    where = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    where = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
    spark.conf.set("spark.checkpoint.dir", where)
    return where


def materialise(df: DataFrame, compression: str = "snappy", **options) -> DataFrame:
    """Write df to the shared folder and read it back: its lineage ends there, and lost executors lose nothing of it."""
    path = f"{shared_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.options(compression=compression, **options).parquet(path)
    df.sparkSession.sparkContext._jvm.System.gc()  # lets Spark delete the shuffle files behind the table
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def discard(*frames: DataFrame) -> None:
    """Delete materialised frames that nothing reads any more; what was made from them has been written too."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def map_batches(df: DataFrame, run, schema: str) -> DataFrame:
    """df.mapInArrow(run, schema), with Arrow batches of this session bounded in bytes."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(df.sparkSession.conf.get(key).rstrip("b")) > BATCH_BYTES:
        df.sparkSession.conf.set(key, BATCH_BYTES)
    return df.mapInArrow(run, schema)


def n_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def plain_text(column: str = "text"):
    """The text, or an empty one for null."""
    return F.coalesce(F.col(column), F.lit(""))


class Texts:
    """A slice of an Arrow string column as one byte array: buf holds the texts end to end, offs their n + 1 borders."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_string()).fill_null("")
        offs = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = column.buffers()[2]
        self.buf = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.empty(0, np.uint8)
        self.offs = offs - offs[0]
        self.n = len(column)


def text_steps(batches, column: str = "text", most: int = STEP_BYTES):
    """Cut Arrow batches into (batch slice, its Texts) of about `most` bytes each, whole rows always."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()).fill_null("")
        offs = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
        at = 0
        while at < len(values):
            end = max(at + 1, int(np.searchsorted(offs, offs[at] + most, "right")) - 1)
            yield batch.slice(at, end - at), Texts(values.slice(at, end - at))
            at = end


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)

