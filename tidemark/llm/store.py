"""Where operators cut lineage: the folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError):  # not every C library has it
    _trim = None


def give_back() -> None:
    """Returns freed memory to the system, so that neither the driver nor an executor's idle workers hold the peak of their last step."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


#: Bytes of an Arrow batch, unless the session names its own limit: a batch of long texts must fit beside others.
BATCH_BYTES = 8 << 20
_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; only on one machine (tests, local runs) a temporary one is set where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="tidemark-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


def small_batches(spark: SparkSession) -> None:
    if int(spark.conf.get(_LIMIT, "67108864b").rstrip("b")) == 64 << 20:
        spark.conf.set(_LIMIT, str(BATCH_BYTES))


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so that a lost executor costs no recomputation of what stands above."""
    shared_dir(df.sparkSession)
    small_batches(df.sparkSession)
    give_back()
    return df.checkpoint(eager=True)


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/tidemark-{name}-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
