"""Event-log derivations: newest values, change-only logs, transitions, price moves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def newest(events: DataFrame, key: str, at: str, values: list[str], where: Column | None = None) -> DataFrame:
    """The latest ``values`` of each key (partial aggregation, no sort); ties go to the greatest values."""
    rows = events if where is None else events.filter(where)
    packed = F.max(F.struct(at, *values)).alias("top")
    return rows.groupBy(key).agg(packed).select(key, F.col(f"top.{at}").alias(at), *(F.col(f"top.{v}").alias(v) for v in values))


def change_only(events: DataFrame, key: str, at: str, price: str, status: str, tie: str) -> DataFrame:
    """Events whose (price, status) differs from the one before; a missing price keeps the remembered one."""
    w = Window.partitionBy(key).orderBy(at, tie)
    known = events.withColumn("known_price", F.last(price, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    marked = known.withColumn("was_price", F.lag("known_price").over(w)).withColumn("was_status", F.lag(status).over(w)).withColumn("nth", F.row_number().over(w))
    same = F.col("known_price").eqNullSafe(F.col("was_price")) & F.col(status).eqNullSafe(F.col("was_status"))
    return marked.filter((F.col("nth") == 1) | ~same).drop("was_price", "was_status", "nth")


def transitions(events: DataFrame, key: str, at: str, status: str, tie: str) -> DataFrame:
    """Counts of status changes (``before``, ``after``) and the mean days between."""
    w = Window.partitionBy(key).orderBy(at, tie)
    steps = events.withColumn("before", F.lag(status).over(w)).withColumn("since", F.lag(at).over(w)).filter(F.col("before") != F.col(status))
    return steps.groupBy("before", F.col(status).alias("after")).agg(F.count("*").alias("n"), F.avg(F.datediff(F.to_date(at), F.to_date("since"))).alias("mean_days"))


def price_moves(events: DataFrame, key: str, at: str, price: str, tie: str) -> DataFrame:
    """Of each key's priced events: number, changes, cuts, days of change, first, last, least and greatest price."""
    w = Window.partitionBy(key).orderBy(at, tie)
    moved = events.filter(F.col(price).isNotNull()).withColumn("was", F.lag(price).over(w))
    changed = F.col("was").isNotNull() & (F.col("was") != F.col(price))
    return moved.groupBy(key).agg(
        F.count("*").alias("n_prices"),
        F.count_if(changed).alias("price_changes"),
        F.count_if(F.col(price) < F.col("was")).alias("price_cuts"),
        F.array_join(F.array_sort(F.collect_list(F.when(changed, F.date_format(at, "yyyy-MM-dd")))), "|").alias("change_days"),
        F.min_by(price, F.struct(at, tie)).alias("first_price"),
        F.max_by(price, F.struct(at, tie)).alias("last_price"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
    )


def distinct_prices(events: DataFrame, key: str, price: str) -> DataFrame:
    """All prices a key was ever seen at, ascending."""
    return events.filter(F.col(price).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_set(price)).alias("prices"))


def remembered_prices(sightings: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Rolling memory of (id, day, price): distinct prices of the last ``days`` days, newest first."""
    kept = sightings.filter((F.col("day") > F.date_sub(as_of, days)) & (F.col("day") <= as_of))
    ordered = F.sort_array(F.collect_list(F.struct("day", "price")), asc=False)
    return kept.groupBy("id").agg(F.array_distinct(F.transform(ordered, lambda x: x.price)).alias("prices"))


def repair_prices(state: DataFrame, events: DataFrame) -> DataFrame:
    """State rows (internal_id, price, status) with a missing price restored from the newest priced event."""
    last = newest(events, "internal_id", "observed_at", ["price"], F.col("price").isNotNull()).select("internal_id", F.col("price").alias("logged"))
    return state.join(last, "internal_id", "left").select("internal_id", F.coalesce("price", "logged").alias("price"), "status")
