"""Findings over the run log and the derived series, each check a frame of (``check``, ``finding``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.times import overlap_hours
from tidemark.operators.market import missing_days

MAX_GAP_H = 5.0
MIN_SPACING_MIN = 30.0
FRESH_H = 30.0
RENT_DAYS = 8.0
MAX_FILE_BYTES = 50 << 20
#: Weekday (0 is Monday) and hours (UTC) in which sale sweeps are not supposed to run.
RESERVED = ((6,), 1.0, 6.0)


def sweeps(runs: DataFrame) -> DataFrame:
    """Runs that collect; bookkeeping entries carry a kind."""
    return runs.filter("kind IS NULL OR kind = ''")


def of_deal(runs: DataFrame, deal: str) -> DataFrame:
    return sweeps(runs).filter(F.array_contains("transactions", deal))


def gaps(runs: DataFrame) -> DataFrame:
    """Runs with the minutes since the one before, reserved hours taken off."""
    w = Window.orderBy("started_at")  # one row a run
    before = F.lag("started_at").over(w)
    weekdays, low, high = RESERVED
    rows = runs.withColumn("before", before).filter("before IS NOT NULL")
    return rows.withColumn("minutes", (F.unix_timestamp("started_at") - F.unix_timestamp("before")) / 60.0 - 60.0 * overlap_hours(F.col("before"), F.col("started_at"), low, high, weekdays))


def check_gap(runs: DataFrame, now: Column) -> DataFrame:
    last = of_deal(runs, "prodej").agg(F.max("started_at").alias("last")).filter("last IS NOT NULL")
    weekdays, low, high = RESERVED
    hours = (F.unix_timestamp(now) - F.unix_timestamp("last")) / 3600.0 - overlap_hours(F.col("last"), now, low, high, weekdays)
    return last.withColumn("hours", hours).filter(F.col("hours") > MAX_GAP_H).select(F.lit("gap").alias("check"), F.format_string("nothing collected for %.1f hours", "hours").alias("finding"))


def check_spacing(runs: DataFrame) -> DataFrame:
    last = gaps(of_deal(runs, "prodej")).orderBy(F.desc("started_at")).limit(1)
    raw = (F.unix_timestamp("started_at") - F.unix_timestamp("before")) / 60.0
    return last.withColumn("raw", raw).filter(F.col("raw") < MIN_SPACING_MIN).select(F.lit("spacing").alias("check"), F.format_string("two sweeps %.0f minutes apart", "raw").alias("finding"))


def check_rent(runs: DataFrame, now: Column) -> DataFrame:
    """The rent pass, or the log's beginning if it never ran, lies too far back."""
    rent = F.max(F.when(F.array_contains("transactions", "pronajem"), F.col("started_at")))
    last = sweeps(runs).agg(F.coalesce(rent, F.min("started_at")).alias("last")).withColumn("days", (F.unix_timestamp(now) - F.unix_timestamp("last")) / 86400.0)
    return last.filter(F.col("days") > RENT_DAYS).select(F.lit("rent").alias("check"), F.format_string("no rent pass for %.1f days", "days").alias("finding"))


def check_last_run(runs: DataFrame) -> DataFrame:
    """Errors and empty sources of the newest run; a log without runs is a finding too."""
    last = runs.orderBy(F.desc("started_at")).limit(1).select(F.explode("sources").alias("source", "x"))
    errors = last.filter(F.size("x.errors") > 0).select(F.lit("errors").alias("check"), F.format_string("%s reported %d error(s), first: %s", "source", F.size("x.errors"), F.element_at("x.errors", 1)).alias("finding"))
    empty = last.filter("x.fetched = 0").select(F.lit("empty").alias("check"), F.format_string("%s fetched nothing", "source").alias("finding"))
    never = runs.agg(F.count("*").alias("n")).filter("n = 0").select(F.lit("runs").alias("check"), F.lit("no run was ever logged").alias("finding"))
    return errors.unionByName(empty).unionByName(never)


def freshness(runs: DataFrame, now: Column) -> DataFrame:
    """Hours since each (``source``, ``scope``) was last swept completely."""
    each = sweeps(runs).select("started_at", F.explode("sources").alias("source", "x")).select("source", "started_at", F.explode("x.scopes_absence_marked").alias("scope"))
    return each.groupBy("source", "scope").agg(F.max("started_at").alias("last")).withColumn("hours", (F.unix_timestamp(now) - F.unix_timestamp("last")) / 3600.0)


def check_freshness(runs: DataFrame, now: Column) -> DataFrame:
    return freshness(runs, now).filter(F.col("hours") > FRESH_H).select(F.lit("freshness").alias("check"), F.format_string("%s %s not swept for %.1f hours", "source", "scope", "hours").alias("finding"))


def check_days(days: DataFrame) -> DataFrame:
    return missing_days(days).select(F.lit("days").alias("check"), F.format_string("no row for %s", F.col("day").cast("string")).alias("finding"))


def check_files(files: DataFrame) -> DataFrame:
    """Files (``path``, ``length``) over the ceiling."""
    return files.filter(F.col("length") > MAX_FILE_BYTES).select(F.lit("files").alias("check"), F.format_string("%s has %d bytes", "path", "length").alias("finding"))


def check_exports(files: DataFrame, newest_data: Column) -> DataFrame:
    """Exports (``path``, ``modified``) older than the data."""
    return files.filter(F.col("modified") < newest_data).select(F.lit("exports").alias("check"), F.format_string("%s is older than the data", "path").alias("finding"))


def report(runs: DataFrame, days: DataFrame, files: DataFrame, now: Column, exports: DataFrame | None = None, newest_data: Column | None = None) -> DataFrame:
    """All findings; those on ``exports`` (``path``, ``modified``) if they are given, with the moment of the newest data."""
    parts = [check_gap(runs, now), check_spacing(runs), check_rent(runs, now), check_last_run(runs), check_freshness(runs, now), check_days(days), check_files(files)]
    if exports is not None:
        parts.append(check_exports(exports, now if newest_data is None else newest_data))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def due(last: Column, now: Column, every_hours: float) -> Column:
    """A job never run, or last run longer ago than its interval, is due."""
    return last.isNull() | ((F.unix_timestamp(now) - F.unix_timestamp(last)) / 3600.0 >= every_hours)
