"""Session helpers: the shared folder, durable intermediate tables, size-checked joins."""

from __future__ import annotations

import contextlib
import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only if its counted rows stay within this bound (a row is a key and a few numbers).
BROADCAST_ROWS = 20_000
SALTS = 64
#: Rows of a key and a few numbers for one file, about.
FILE_ROWS = 20_000
#: Bytes of an Arrow batch.
BATCH = 4 << 20


#: Tables of this session that are there still.
_paths: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share. A folder of one machine's own would lose rows, so there is no other."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return found.rstrip("/")


def modest(spark: SparkSession) -> None:
    """Arrow batches of texts of at most BATCH bytes in this session: a worker holds several copies of one."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))


def guarded(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with its columns that begin with an underscore renamed, as operators name columns of their own so, and the way back."""
    names = {c: f"sw{i}{c}" for i, c in enumerate(docs.columns) if c.startswith("_")}
    return docs.withColumnsRenamed(names), {v: k for k, v in names.items()}


def stored(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """df written as Parquet in the shared folder and read again: it cuts the lineage and outlives any executor.

    rows: about how many narrow rows it has, so that a small table does not become a file for each partition.
    """
    spark = df.sparkSession
    if rows is not None and rows // FILE_ROWS + 1 < int(spark.conf.get("spark.sql.shuffle.partitions")):
        df = df.coalesce(rows // FILE_ROWS + 1)
    path = f"{shared_dir(spark)}/strandwise/{name}-{uuid.uuid4().hex}"
    _paths.add(path)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._sw_path = path
    return out


def remove(df: DataFrame) -> None:
    """Delete the files of a table made by stored(), once nothing reads it any more."""
    _paths.discard(df._sw_path)
    remove_path(df.sparkSession, df._sw_path)


def sweep(spark: SparkSession) -> None:
    """Delete all tables of stored() that are left: to be called when no result of an operator is read any more."""
    while _paths:
        remove_path(spark, _paths.pop())


def remove_path(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def join_small(left: DataFrame, small: DataFrame, key: str, how: str = "left", rows: int = BROADCAST_ROWS) -> DataFrame:
    """left joined with small (one row a key) null-safely; broadcast if small has at most `rows` rows, else salted.

    small must be cheap to read twice (a stored table). The key's copy from small is dropped. The salt is a hash of the row, so a
    task that is run again deals its rows as before.
    """
    other = small.withColumnRenamed(key, "_sw_key")
    if small.limit(rows + 1).count() <= rows:
        return left.join(F.broadcast(other), left[key].eqNullSafe(other["_sw_key"]), how).drop("_sw_key")
    salted = left.withColumn("_sw_salt", F.pmod(F.xxhash64(*left.columns), F.lit(SALTS)).cast("int"))
    other = other.withColumn("_sw_salt2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    on = salted[key].eqNullSafe(other["_sw_key"]) & (salted["_sw_salt"] == other["_sw_salt2"])
    return salted.join(other, on, how).drop("_sw_key", "_sw_salt", "_sw_salt2")


def release() -> None:
    """Give freed memory of a Python worker back to the system: workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library than glibc
        ctypes.CDLL(None).malloc_trim(0)
