"""Spans into islands and full episodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

GAP_DAYS = 14


def islands(spans: DataFrame, key: str, gap_days: int = GAP_DAYS, tie: list[str] | None = None) -> DataFrame:
    """Adds ``island`` (from 1): spans (``start``, ``end``) of a key join while they start at most ``gap_days`` after all before."""
    w = Window.partitionBy(key).orderBy("start", "end", *(tie or []))
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce((F.datediff("start", reach) > gap_days).cast("int"), F.lit(1))
    return spans.withColumn("fresh", fresh).withColumn("island", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("fresh")


def island_rollup(spans: DataFrame, key: str, gap_days: int = GAP_DAYS) -> DataFrame:
    """One row an island: ``start``, ``end``, ``n_spans``, ``days`` and the ``gap_before`` in days."""
    rows = islands(spans, key, gap_days).groupBy(key, "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_spans"))
    w = Window.partitionBy(key).orderBy("island")
    return rows.withColumn("days", F.datediff("end", "start")).withColumn("gap_before", F.datediff("start", F.lag("end").over(w)))


def first_stated(value: str) -> Column:
    """The value of the earliest member (start, end, id) that states one."""
    return F.min_by(value, F.when(F.col(value).isNotNull() & (F.col(value).cast("string") != ""), F.struct("start", "end", "internal_id"))).alias(value)


def episodes(listings: DataFrame, observations: DataFrame, changes: DataFrame, property_of: DataFrame, as_of: Column, gap_days: int = GAP_DAYS) -> DataFrame:
    """Market episodes of properties.

    ``property_of`` maps ``internal_id`` to ``property_key`` (connected components of duplicate and re-listing edges).
    An episode is active if a member is, removed if all are, else disappearing. Discounts compare the first and last
    price of the merged series; price changes are counted within each advert.
    """
    spans = listings.join(property_of, "internal_id").withColumn("start", F.to_date("first_seen_at")).withColumn("end", F.col("last_seen_at").cast("date")).filter("end >= start")
    members = islands(spans, "property_key", gap_days, ["internal_id"])
    priced = observations.filter("price > 0").join(members.select("internal_id", "property_key", "island"), "internal_id")
    own = Window.partitionBy("internal_id").orderBy("observed_at", "price")
    moves = priced.withColumn("was", F.lag("price").over(own))
    moved = F.col("was") != F.col("price")
    group = ["property_key", "island"]
    series = moves.groupBy(*group).agg(
        F.min_by("price", F.struct("observed_at", "price")).alias("first_price"),
        F.max_by("price", F.struct("observed_at", "price")).alias("last_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.count_if(moved).alias("price_changes"),
        F.count_if(F.col("price") < F.col("was")).alias("price_cuts"),
        F.array_sort(F.collect_list(F.when(moved, F.to_date("observed_at")))).alias("cut_days"),
    )
    edits = changes.join(members.select("internal_id", *group), "internal_id").groupBy(*group).agg(F.count("*").alias("attribute_changes"), F.array_sort(F.collect_list(F.to_date("changed_at"))).alias("edit_days"))
    stated = [first_stated(c) for c in ("disposition", "area_m2", "street", "house_number", "district", "municipality")]
    body = members.groupBy(*group).agg(
        F.min_by("property_type", F.struct("start", "end", "internal_id")).alias("property_type"),
        F.min_by("transaction_type", F.struct("start", "end", "internal_id")).alias("transaction_type"),
        *stated,
        F.coalesce(F.bool_or("priority_zone"), F.lit(False)).alias("priority_zone"),
        F.array_sort(F.collect_set("source")).alias("sources"),
        F.count("*").alias("listing_count"),
        F.array_sort(F.collect_list("internal_id")).alias("internal_ids"),
        F.min("start").alias("first_seen"),
        F.max("end").alias("last_seen"),
        F.bool_or(F.col("status") == "active").alias("live"),
        F.bool_and(F.col("status") == "removed").alias("gone"),
    )
    w = Window.partitionBy("property_key").orderBy("island")
    joined = body.join(series, group, "left").join(edits, group, "left")
    gap = F.datediff("first_seen", F.lag("last_seen").over(w))
    discount = F.col("first_price") - F.col("last_price")
    return joined.select(
        "property_key",
        F.col("island").alias("episode"),
        *[c for c in body.columns if c not in (*group, "live", "gone")],
        F.datediff("last_seen", "first_seen").alias("days_on_market"),
        gap.alias("gap_before_days"),
        F.when(F.col("live"), "active").when(F.col("gone"), "removed").otherwise("disappearing").alias("outcome"),
        F.when(F.col("live"), 0).otherwise(F.datediff(as_of, "last_seen")).alias("days_missing"),
        "first_price",
        "last_price",
        "min_price",
        "max_price",
        F.coalesce("price_changes", F.lit(0)).alias("price_changes"),
        F.coalesce("price_cuts", F.lit(0)).alias("price_cuts"),
        discount.alias("discount"),
        (100.0 * discount / F.col("first_price")).alias("discount_pct"),
        F.when(F.col("area_m2") > 0, F.rint(F.col("first_price") / F.col("area_m2")).cast("long")).alias("price_per_m2_first"),
        F.when(F.col("area_m2") > 0, F.rint(F.col("last_price") / F.col("area_m2")).cast("long")).alias("price_per_m2_last"),
        F.coalesce("attribute_changes", F.lit(0)).alias("attribute_changes"),
        F.coalesce("cut_days", F.array().cast("array<date>")).alias("cut_days"),
        F.coalesce("edit_days", F.array().cast("array<date>")).alias("edit_days"),
    )
