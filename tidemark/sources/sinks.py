"""Writers: routed keyed tables, append-only logs, views, state and verified snapshots."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _files(spark: SparkSession, path: str):
    """The file system of ``path``, and what makes its paths."""
    made = spark._jvm.org.apache.hadoop.fs.Path
    return made(path).getFileSystem(spark._jsc.hadoopConfiguration()), made


def recover(spark: SparkSession, path: str) -> None:
    """Puts back what a ``replace`` that was cut short has set aside, and drops what it had not finished."""
    fs, made = _files(spark, path)
    old, new = made(f"{path}.old"), made(f"{path}.new")
    if fs.exists(old):
        if fs.exists(made(path)):
            fs.delete(old, True)
        else:
            fs.rename(old, made(path))
    fs.delete(new, True)


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Replaces the folder ``path`` by what ``write(folder)`` writes.

    The new rows are whole in a folder of their own before the old ones are set aside, and those go only when the new ones
    stand in their place; so at every moment one of the two is there, and ``recover`` (which each ``replace`` starts with)
    finds it. The rows may be read from ``path`` itself.
    """
    recover(spark, path)
    fs, made = _files(spark, path)
    write(f"{path}.new")
    if fs.exists(made(path)) and not fs.rename(made(path), made(f"{path}.old")):
        raise OSError(f"{path} can't be set aside")
    if not fs.rename(made(f"{path}.new"), made(path)):
        raise OSError(f"{path}.new can't take its place")
    fs.delete(made(f"{path}.old"), True)
    spark.catalog.refreshByPath(path)


def digest(df: DataFrame) -> str:
    """Order-free digest of a frame's rows."""
    row = F.xxhash64(*[F.col(c).cast("string") for c in sorted(df.columns)])
    got = df.agg(F.count("*").alias("n"), F.sum(row.cast("decimal(38,0)")).alias("s"), F.bit_xor(row).alias("x")).first()
    return f"{got.n}:{got.s}:{got.x}"


def write_if_changed(df: DataFrame, path: str) -> bool:
    """Overwrites parquet at ``path`` unless it already holds the same rows."""
    try:
        if digest(df.sparkSession.read.parquet(path)) == digest(df):
            return False
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    replace(df.sparkSession, path, lambda to: df.write.parquet(to))
    return True


def routed(listings: DataFrame) -> DataFrame:
    """Adds ``bucket``: ``live``, or the month a removed row was last seen in."""
    return listings.withColumn("bucket", F.when(F.col("status") == "removed", F.coalesce(F.date_format("last_seen_at", "yyyy-MM"), F.lit("unknown"))).otherwise("live"))


def write_listings(listings: DataFrame, path: str) -> None:
    """The keyed table by bucket, replaced as a whole: no row is ever absent, nor in two buckets."""
    rows = routed(listings).repartition("bucket", F.pmod(F.hash("internal_id"), F.lit(16))).sortWithinPartitions("bucket", "internal_id")
    replace(listings.sparkSession, path, lambda to: rows.write.partitionBy("bucket").parquet(to))


def append_log(rows: DataFrame, path: str, run_at: Column) -> None:
    """Append under the month of the run, not of the row."""
    rows.withColumn("month", F.date_format(run_at, "yyyy-MM")).write.mode("append").partitionBy("month").parquet(path)


def write_raw(rows: DataFrame, path: str, drop_keys: list[str] | None = None) -> None:
    """Gzip JSON lines by source and day, without bulky keys; an empty frame writes nothing."""
    if rows.limit(1).count():
        rows.drop(*(drop_keys or [])).write.mode("append").partitionBy("source", "day").json(path, compression="gzip")


def strip_bulk(column: Column, keys: list[str]) -> Column:
    """A struct without the named (dotted) fields."""
    return column.dropFields(*keys)


def write_state(state: DataFrame, path: str) -> None:
    replace(state.sparkSession, path, lambda to: state.write.parquet(to))


def append_run(spark: SparkSession, run: dict, path: str) -> None:
    """One JSON line to the run log."""
    spark.createDataFrame([(json.dumps(run, sort_keys=True, default=str),)], "value string").coalesce(1).write.mode("append").text(path)


def write_view(view: DataFrame, path: str, order: list[str]) -> None:
    """One CSV with a header; meant for views a person opens."""
    view.orderBy(*order).coalesce(1).write.mode("overwrite").csv(path, header=True, emptyValue="")


def write_index(points: DataFrame, path: str) -> dict:
    """Address index sorted for identical bytes on identical input, and its metadata."""
    points.repartition(1).sortWithinPartitions("street", "point_id").write.mode("overwrite").parquet(path)
    return {"points": points.count(), "digest": digest(points)}


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``bytes`` and ``sha256`` of every file below ``path``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.regexp_extract("path", r"([^/]+(?:/[^/]+)?)$", 1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def verify(spark: SparkSession, path: str, expected: DataFrame) -> DataFrame:
    """Files that are missing, new or different from the manifest; none on a good restore."""
    now = manifest(spark, path).withColumnsRenamed({"bytes": "bytes_now", "sha256": "sha256_now"})
    joined = expected.join(now, "file", "full")
    return joined.filter(~F.col("sha256").eqNullSafe(F.col("sha256_now"))).select("file", F.when(F.col("sha256_now").isNull(), "missing").when(F.col("sha256").isNull(), "new").otherwise("changed").alias("fault"))
