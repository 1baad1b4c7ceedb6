"""The daily market series over episodes.

Input rows: ``segment_type``, ``segment_deal``, ``start``, ``end``, ``gone`` (boolean), ``price``, ``days``,
``discount_pct``, ``cuts`` and ``edits`` (arrays of dates). Counts are deltas and window sums, so nothing grows with the
length of an episode; only order statistics range-join events to the windows that hold them.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.numbers import mean, median, share
from tidemark.functions.times import closed_week_end

WINDOWS = (1, 7, 30)
QUICK_DAYS = 14
CONFIRM_DAYS = 5


def with_segments(episodes: DataFrame) -> DataFrame:
    """Each row under its own segment and under all types of its deal; deals are never mixed."""
    names = F.array(F.concat_ws("/", "segment_type", "segment_deal"), F.concat_ws("/", F.lit("vse"), "segment_deal"))
    return episodes.withColumn("segment", F.explode(names))


def day_grid(rows: DataFrame, last_day: date | None = None) -> DataFrame:
    """Every (``segment``, ``day``) from the first start to the last day; two dates come to the driver, nothing else."""
    low, high = rows.agg(F.min("start"), F.max("end")).first()
    high = last_day or high
    days = F.sequence(F.lit(low), F.lit(high)) if low and low <= high else F.array().cast("array<date>")
    return rows.select("segment").distinct().select("segment", F.explode(days).alias("day"))


def daily_supply(rows: DataFrame, grid: DataFrame) -> DataFrame:
    """``segment``, ``day``, ``supply``, ``arrived``, ``departed``: an episode counts from start to end, both included."""
    up = rows.groupBy("segment", F.col("start").alias("day")).agg(F.count("*").alias("arrived"))
    down = rows.groupBy("segment", F.date_add("end", 1).alias("day")).agg(F.count("*").alias("after"))
    left = rows.filter("gone").groupBy("segment", F.col("end").alias("day")).agg(F.count("*").alias("departed"))
    joined = grid.join(up, ["segment", "day"], "left").join(down, ["segment", "day"], "left").join(left, ["segment", "day"], "left").na.fill(0, ["arrived", "after", "departed"])
    w = Window.partitionBy("segment").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return joined.withColumn("supply", F.sum(F.col("arrived") - F.col("after")).over(w)).drop("after")


def flows(daily: DataFrame, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    """Counts and rates over trailing windows, cut short at the series' start."""
    number = F.datediff("day", F.lit("1970-01-01").cast("date"))
    rows = daily.withColumn("dn", number).withColumn("first_dn", F.min("dn").over(Window.partitionBy("segment")))
    parts = []
    for n in windows:
        w = Window.partitionBy("segment").orderBy("dn").rangeBetween(-(n - 1), 0)
        covered = F.least(F.lit(n), F.col("dn") - F.col("first_dn") + 1)
        parts.append(rows.select("segment", "day", F.lit(n).alias("window_days"), covered.alias("covered"), "supply", F.sum("arrived").over(w).alias("arrived"), F.sum("departed").over(w).alias("departed"), (F.sum("supply").over(w) / covered).alias("supply_mean")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    per_30 = F.col("departed") * (30.0 / F.col("covered"))
    return out.filter("supply > 0").select(
        "*",
        (F.col("arrived") / F.col("covered")).alias("arrived_daily"),
        (F.col("departed") / F.col("covered")).alias("departed_daily"),
        share(per_30, F.col("supply_mean")).alias("absorption_pct"),
        F.when((per_30 > 0) & (F.col("supply_mean") >= 5), F.col("supply_mean") / per_30).alias("months_of_inventory"),
        F.when(F.lit(CONFIRM_DAYS) <= F.col("window_days") - 1, "ano").otherwise("ne").alias("departures_confirmed"),
    )


def _windowed(events: DataFrame, day: str, windows: tuple[int, ...]) -> DataFrame:
    """Each event under every (``window_days``, ``grid_day``) whose trailing window holds it."""

    def spread(n: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.struct(F.lit(n).alias("window_days"), F.date_add(F.col(day), k).alias("grid_day")))

    return events.withColumn("at", F.explode(F.concat(*[spread(n) for n in windows]))).select("*", "at.window_days", "at.grid_day").drop("at")


def departure_medians(rows: DataFrame, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    """Medians and means of departures in each trailing window; quick ones left within two weeks."""
    left = _windowed(rows.filter("gone"), "end", windows)
    quick = F.when(F.coalesce("days", F.lit(0)) <= QUICK_DAYS, F.col("price"))
    return left.groupBy("segment", F.col("grid_day").alias("day"), "window_days").agg(median(F.col("price")).alias("price_median"), median(quick).alias("quick_price_median"), median(F.col("days")).alias("days_median"), mean(F.col("days")).alias("days_mean"), F.count("*").alias("n"))


def changes_in_window(rows: DataFrame, column: str, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    """Episodes on the market with a change in the window: how many, changes each, and discounts."""
    dated = rows.select("segment", "row_id", "start", "end", "discount_pct", F.explode(column).alias("changed"))
    held = _windowed(dated, "changed", windows).filter("grid_day BETWEEN start AND end")
    each = held.groupBy("segment", "grid_day", "window_days", "row_id").agg(F.count("*").alias("times"), F.first("discount_pct").alias("discount_pct"))
    return each.groupBy("segment", F.col("grid_day").alias("day"), "window_days").agg(F.count("*").alias("changed"), F.avg("times").alias("times_each"), median(F.col("discount_pct")).alias("discount_median"), mean(F.col("discount_pct")).alias("discount_mean"))


def levels(rows: DataFrame, grid: DataFrame) -> DataFrame:
    """Medians of what is on the market each day."""
    live = rows.select("segment", "price", "days", F.explode(F.sequence("start", "end")).alias("day"))
    return live.groupBy("segment", "day").agg(F.count("*").alias("supply"), median(F.col("price")).alias("price_median"), mean(F.col("price")).alias("price_mean")).join(grid, ["segment", "day"], "left_semi")


def summary(series: DataFrame, measures: list[str], back: int) -> DataFrame:
    """Newest recorded day against the one ``back`` recorded days before (the first, if fewer), one row a measure."""
    w = Window.partitionBy("segment", "window_days").orderBy(F.desc("day"))
    ranked = series.withColumn("back", F.dense_rank().over(w) - 1)
    last = ranked.groupBy("segment", "window_days").agg(F.max("back").alias("deepest"))
    picked = ranked.join(last, ["segment", "window_days"]).filter((F.col("back") == 0) | (F.col("back") == F.least(F.lit(back), F.col("deepest"))))
    long = picked.unpivot(["segment", "window_days", "back", "deepest"], measures, "measure", "value")
    now = F.max(F.when(F.col("back") == 0, F.col("value")))
    then = F.max(F.when(F.col("back") == F.least(F.lit(back), F.col("deepest")), F.col("value")))
    return long.groupBy("segment", "window_days", "measure").agg(now.alias("now"), then.alias("then")).withColumn("change_pct", F.when(F.col("then") != 0, 100.0 * (F.col("now") - F.col("then")) / F.col("then")))


def missing_days(days: DataFrame) -> DataFrame:
    """Days without a row between the first and the last."""
    ends = days.agg(F.min("day").alias("low"), F.max("day").alias("high")).filter("low IS NOT NULL")
    return ends.select(F.explode(F.sequence("low", "high")).alias("day")).join(days.select("day").distinct(), "day", "left_anti")


def as_of_value(queries: DataFrame, series: DataFrame, days_back: int = 7) -> DataFrame:
    """``value`` of (day, value) on or up to ``days_back`` days before each query's ``day``."""
    offers = series.filter(F.col("value").isNotNull()).select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(days_back)), lambda k: F.date_add("day", k))).alias("day"), F.col("day").alias("stated_on"), "value")
    best = offers.groupBy("day").agg(F.max(F.struct("stated_on", "value")).alias("top"))
    return queries.join(best, "day", "left").select(*queries.columns, F.col("top.stated_on").alias("stated_on"), F.col("top.value").alias("value"))


def day_to_day(series: DataFrame, value: str) -> DataFrame:
    w = Window.partitionBy("segment").orderBy("day")
    return series.withColumn("before", F.lag(value).over(w)).withColumn("change", F.col(value) - F.col("before"))


def thinned(series: DataFrame, most: int = 60) -> DataFrame:
    """Every k-th point of a segment and its last one, so that about ``most`` remain; fewer than three points give none."""
    w = Window.partitionBy("segment")
    ranked = series.withColumn("nth", F.row_number().over(w.orderBy("day"))).withColumn("points", F.count("*").over(w))
    step = F.greatest(F.lit(1), F.ceil(F.col("points") / most))
    return ranked.filter((F.col("points") >= 3) & (((F.col("nth") - 1) % step == 0) | (F.col("nth") == F.col("points")))).drop("nth", "points")


def until_closed_week(series: DataFrame, today: Column, day: str = "day") -> DataFrame:
    """Rows of a series up to the Sunday before ``today``."""
    return series.filter(F.col(day) <= closed_week_end(today))
