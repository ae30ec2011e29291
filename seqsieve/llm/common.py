"""What the operators of this subpackage share: shared folders, written tables, and raw access to Arrow text."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text bytes that one numpy step handles at once; bounds the temporary arrays of a task.
STEP_BYTES = 1 << 20
#: Bytes of an Arrow batch between Spark and Python, the setting's name and its default.
BATCH_BYTES, ARROW_BYTES, ARROW_DEFAULT = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
#: Bytes of a table that may be broadcast.
BROADCAST_BYTES = 64 << 20


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only where the session names none and runs on this machine alone
    (tests), one is made."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="seqsieve-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage with a table in the shared folder, which outlives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def rewritten(df: DataFrame, name: str, old: str | None) -> tuple[DataFrame, str]:
    """As materialise(), for a step that replaces the table below `old`, which is deleted when the new one is written.
    Also the new table's path."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, name)
    df.write.parquet(path)
    if old is not None:
        gone = spark._jvm.org.apache.hadoop.fs.Path(old)
        gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    return spark.read.schema(df.schema).parquet(path), path


def row_bytes(df: DataFrame) -> int:
    """Bytes of a row of numbers in a broadcast table, with the room that a hash table takes for it."""
    for field in df.schema.fields:
        if not isinstance(field.dataType, (T.NumericType, T.BooleanType)):
            raise TypeError(f"{field.name} has no fixed size")
    return 48 + 16 * len(df.columns)


def small(df: DataFrame, rows: int) -> DataFrame:
    """df, a table of numbers with this counted number of rows, marked to be broadcast if it takes BROADCAST_BYTES at
    most. Beyond that Spark joins it by a shuffle; the rows are the same."""
    return F.broadcast(df) if rows * row_bytes(df) <= BROADCAST_BYTES else df


def measured(df: DataFrame) -> DataFrame:
    """As small(), for a table of numbers and texts whose rows and bytes are counted here."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    held = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(0).cast("long"))
    rows, chars = df.agg(F.count("*"), F.coalesce(F.sum(held), F.lit(0))).first()
    size = rows * (row_bytes(df.drop(*texts)) + 24 * len(texts)) + chars  # a text has a place, a length and up to 7 bytes of filling
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before them until no column of df has them."""
    taken = {c.lower() for c in df.columns}

    def free(name: str) -> str:
        return name if name.lower() not in taken else free("_" + name)

    return [free(n) for n in names]


def map_batches(df: DataFrame, run, schema) -> DataFrame:
    """df.mapInArrow(), with the bytes of a batch bounded in the session: whole texts go to Python, and Spark's own
    bounds are 10,000 rows or 64 MB. A bound that the session was given stays."""
    conf = df.sparkSession.conf
    if conf.get(ARROW_BYTES) == ARROW_DEFAULT:
        conf.set(ARROW_BYTES, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Gives memory that a task no longer uses back to the system, as its worker outlives it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library, where it has it
    if trim is not None:
        trim(0)


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts or bytes and its row offsets (one more than rows); nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, pa.scalar("", column.type) if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else pa.scalar(b"", column.type))
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32, count=len(column) + 1 + column.offset)
    at = at[column.offset :].astype(np.int64)
    body = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[at[0] : at[-1]], at - at[0]


def steps(offsets: np.ndarray, most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `most` bytes each; a longer row stands alone."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
