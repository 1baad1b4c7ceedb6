"""Scans of the tables in their file forms."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions.text import blank_to_null
from tidemark.operators.merge import newest_copy


def read_csv(spark: SparkSession, paths: str | list[str], schema: T.StructType, columns: dict[str, str] | None = None, **options: str) -> DataFrame:
    """CSV with headers into ``schema``: read as text, blanks to null, then typed; ``columns`` renames headers.

    Values that do not fit their type become null. Headers missing from a file are null, others are ignored.
    """
    raw = spark.read.options(header="true", multiLine="true", escape='"', **options).csv(paths)
    named = {(columns or {}).get(c, c): c for c in raw.columns}
    return raw.select(*[(blank_to_null(F.col(f"`{named[f.name]}`")).try_cast(f.dataType) if f.name in named else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])


def read_listings(spark: SparkSession, live: str, archives: list[str] | None = None, columns: dict[str, str] | None = None) -> DataFrame:
    """The live file and monthly archives as one keyed table; of two copies the later seen, then the removed one, stands."""
    rows = read_csv(spark, live, schemas.LISTINGS, columns).withColumn("__file", F.lit(0))
    for k, path in enumerate(archives or [], 1):
        rows = rows.unionByName(read_csv(spark, path, schemas.LISTINGS, columns).withColumn("__file", F.lit(k)))
    return newest_copy(rows, ["internal_id"], "last_seen_at", "status", ["__file"]).drop("__file")


def duplicate_ids(rows: DataFrame, key: str = "internal_id") -> DataFrame:
    """Ids that stand in more than one file."""
    return rows.groupBy(key).agg(F.count_distinct(F.col("_metadata.file_path")).alias("files")).filter("files > 1")


def read_observations(spark: SparkSession, paths: str | list[str], columns: dict[str, str] | None = None) -> DataFrame:
    return read_csv(spark, paths, schemas.OBSERVATIONS, columns)


def read_changes(spark: SparkSession, paths: str | list[str], columns: dict[str, str] | None = None) -> DataFrame:
    return read_csv(spark, paths, schemas.CHANGES, columns)


def read_runs(spark: SparkSession, paths: str | list[str], keep_bad: bool = False) -> DataFrame:
    """Run log of JSON lines in order of start; unreadable lines are dropped, or kept in ``bad_line``."""
    lines = spark.read.text(paths).filter(F.trim("value") != "")
    rows = lines.select(F.from_json("value", schemas.RUN_LOG).alias("run"), "value").select("run.*", F.when(F.col("run.started_at").isNull(), F.col("value")).alias("bad_line"))
    return rows if keep_bad else rows.filter("bad_line IS NULL").drop("bad_line").orderBy("started_at")


def read_register(spark: SparkSession, paths: str | list[str], columns: dict[str, str] | None = None) -> DataFrame:
    """Address points (gzip CSV read natively) that have a street and coordinates."""
    return read_csv(spark, paths, schemas.REGISTER, columns).filter("street IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL")


def read_register_export(spark: SparkSession, paths: str, schema: T.StructType, columns: dict[str, str], encoding: str = "cp1250", sep: str = ";") -> DataFrame:
    """The register's own export: semicolons and the windows-1250 code page, which Spark's readers don't take.

    Whole files are decoded on the executors; the register comes as one moderate file a municipality.
    """
    names = {v: k for k, v in columns.items()}
    wanted = [names.get(f.name, f.name) for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = list(csv.DictReader(io.StringIO(content.as_py().decode(encoding)), delimiter=sep))
                yield pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], pa.string()) for c in wanted], names=schema.names)

    raw = spark.read.format("binaryFile").load(paths).select("content").mapInArrow(run, T.StructType([T.StructField(f.name, T.StringType()) for f in schema]))
    return raw.select(*[blank_to_null(F.col(f.name)).try_cast(f.dataType).alias(f.name) for f in schema])


def read_raw(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Archived payloads, whole files (gzip natively): ``path`` and ``body``, oldest path first."""
    return spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body")).orderBy("path")


def advert_pages(raw: DataFrame, record_schema: T.DataType, field: str = "results") -> DataFrame:
    """One row a record of payloads of the form ``{field: [...]}``."""
    body = F.from_json("body", T.StructType([T.StructField(field, T.ArrayType(record_schema))]))
    return raw.select("path", F.explode(body[field]).alias("record"))


def sitemap_urls(pages: DataFrame, body: str = "body") -> DataFrame:
    """Addresses listed in sitemap texts."""
    return pages.select(F.explode(F.regexp_extract_all(body, F.lit(r"<loc>\s*([^<\s]+)\s*</loc>"), F.lit(1))).alias("url"))


def to_fetch(urls: DataFrame, known: DataFrame, due: DataFrame, excluded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(fetch, presence only) of listed urls: unknown ones first, then known ones that are due; excluded never."""
    wanted = urls.join(excluded, "url", "left_anti")
    fresh = wanted.join(known, "url", "left_anti").withColumn("fresh", F.lit(True))
    again = wanted.join(known, "url", "left_semi").join(due, "url", "left_semi").withColumn("fresh", F.lit(False))
    return fresh.unionByName(again).orderBy(F.desc("fresh"), "url"), wanted.join(known, "url", "left_semi").join(due, "url", "left_anti")
