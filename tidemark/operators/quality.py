"""Measured quality of the listing table: fill rates, flags, staleness, drops against history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MIN_AGREEMENT = 90.0
MAX_DROP = 10.0
STALE_DAYS = 4
STALE_ROWS = 25
HISTORY_DAYS = 90
MIN_HISTORY = 3


def stated(c: str) -> Column:
    return F.coalesce(F.trim(F.col(c).cast("string")) != "", F.lit(False))


def fill_rates(rows: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Percentage of rows that state each column, one row a group and column, in one pass."""
    wide = rows.groupBy(*by).agg(*[F.avg(F.when(stated(c), 100.0).otherwise(0.0)).alias(c) for c in columns])
    return wide.unpivot(by, columns, "column_name", "filled_pct")


def flagged(rows: DataFrame, id_col: str, rules: dict[str, Column], examples: int = 5) -> DataFrame:
    """Rows each rule hits: how many, and the smallest few ids."""
    tests = F.array(*[F.struct(F.lit(n).alias("rule"), F.coalesce(c, F.lit(False)).alias("hit")) for n, c in rules.items()])
    hits = rows.select(id_col, F.explode(tests).alias("t")).filter("t.hit").select(F.col("t.rule").alias("rule"), id_col)
    counts = hits.groupBy("rule").agg(F.count("*").alias("n"))
    few = hits.withColumn("nth", F.row_number().over(Window.partitionBy("rule").orderBy(id_col))).filter(F.col("nth") <= examples)
    return counts.join(few.groupBy("rule").agg(F.array_sort(F.collect_list(id_col)).alias("examples")), "rule")


def coverage(rows: DataFrame) -> DataFrame:
    """Today's percentages of rows with coordinates, a matched number and a postcode."""
    pct = lambda c: F.avg(F.when(F.coalesce(c, F.lit(False)), 100.0).otherwise(0.0))
    return rows.agg(F.count("*").alias("listings"), pct(F.col("lat").isNotNull() & F.col("lon").isNotNull()).alias("gps_pct"), pct(stated("house_number")).alias("number_pct"), pct(stated("postcode")).alias("psc_pct"))


def stale_groups(rows: DataFrame, by: list[str], seen: str, as_of: Column, days: int = STALE_DAYS) -> DataFrame:
    """Active rows not seen for ``days`` by group; the worst group first."""
    old = rows.filter((F.col("status") == "active") & F.coalesce(F.to_date(seen) <= F.date_sub(as_of, days), F.lit(True)))
    return old.groupBy(*by).agg(F.count("*").alias("stale"))


def worst(groups: DataFrame, by: list[str]) -> DataFrame:
    return groups.orderBy(F.desc("stale"), *by).limit(1)


def drops(history: DataFrame, points: float = MAX_DROP, least: int = MIN_HISTORY) -> DataFrame:
    """(``day``, ``metric``, ``value``) -> metrics whose newest value lies over ``points`` below the median of at least ``least`` earlier days."""
    ranked = history.filter("value IS NOT NULL").withColumn("last", F.max("day").over(Window.partitionBy("metric")))
    now = F.max(F.when(F.col("day") == F.col("last"), F.col("value")))
    before = F.when(F.col("day") < F.col("last"), F.col("value"))
    out = ranked.groupBy("metric").agg(now.alias("value"), F.median(before).alias("median"), F.count(before).alias("days"))
    return out.filter((F.col("days") >= least) & (F.col("median") - F.col("value") > points))


def faults(today: DataFrame, stale: DataFrame, history: DataFrame, by: list[str]) -> DataFrame:
    """One sentence a fault: too many stale rows, agreement below its floor, drops below history."""
    group = F.concat_ws("/", *by)
    old = worst(stale, by).filter(F.col("stale") >= STALE_ROWS).select(F.lit("stale").alias("check"), F.format_string("%d active %s rows not seen for days", "stale", group).alias("finding"))
    low = today.filter(F.col("agreement_pct") < MIN_AGREEMENT).select(F.lit("agreement").alias("check"), F.format_string("district agreement is %.2f", "agreement_pct").alias("finding"))
    fell = drops(history).select(F.lit("drop").alias("check"), F.format_string("%s is %.2f, median %.2f", "metric", "value", "median").alias("finding"))
    return old.unionByName(low).unionByName(fell)


def recorded(history: DataFrame, today: DataFrame, keep: int = HISTORY_DAYS) -> DataFrame:
    """History with today's metrics in place of earlier ones of the day, and the newest ``keep`` days kept."""
    both = history.join(today.select("day").distinct(), "day", "left_anti").unionByName(today)
    return both.withColumn("nth", F.dense_rank().over(Window.orderBy(F.desc("day")))).filter(F.col("nth") <= keep).drop("nth")  # one row a metric and day
