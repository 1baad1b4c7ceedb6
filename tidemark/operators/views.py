"""Views of what is on the market, and their filters and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.text import contains_folded
from tidemark.operators.events import newest
from tidemark.operators.merge import is_live


def with_latest(listings: DataFrame, observations: DataFrame) -> DataFrame:
    """Listings with the newest observation's ``price``, ``price_per_m2`` and ``observed_at``; rows never observed have nulls."""
    last = newest(observations, "internal_id", "observed_at", ["price", "price_per_m2"])
    return listings.join(last, "internal_id", "left")


def on_market(view: DataFrame) -> DataFrame:
    return view.filter(is_live(F.col("status")))


def exported(view: DataFrame) -> dict[str, DataFrame]:
    """The four exported views."""
    live = on_market(view).orderBy("transaction_type", "property_type", "municipality", "district", "street", "internal_id")
    counts = view.groupBy("source", "property_type", "transaction_type", "status").agg(F.count("*").alias("n"))
    return {"active": live, "priority": live.filter("priority_zone"), "all": view, "summary": counts.orderBy("source", "property_type", "transaction_type", "status")}


def on_street(view: DataFrame, wanted: str, removed: bool = False, property_type: str | None = None, transaction_type: str | None = None) -> DataFrame:
    """Rows whose street, address or description holds ``wanted`` without regard to accents."""
    text = F.concat_ws(" ", "street", "url", "description")
    out = view.filter(contains_folded(text, wanted))
    out = out if removed else on_market(out)
    for column, value in (("property_type", property_type), ("transaction_type", transaction_type)):
        if value:
            out = out.filter(F.col(column) == value)
    return out


def street_summary(view: DataFrame) -> DataFrame:
    """Least, upper-median and greatest price by type, deal and layout."""
    prices = F.array_sort(F.collect_list("price"))
    upper = F.when(F.size(prices) > 0, F.element_at(prices, (F.floor(F.size(prices) / 2) + 1).cast("int")))
    return view.groupBy("property_type", "transaction_type", "disposition").agg(F.count("*").alias("n"), F.min("price").alias("low"), upper.alias("middle"), F.max("price").alias("high"))


def top_positive(rows: DataFrame, value: str, tie: str, most: int = 5, at_most: float | None = None) -> DataFrame:
    """The ``most`` largest positive values; larger than ``at_most`` are taken for corrections and left out."""
    out = rows.filter(F.col(value) > 0)
    if at_most is not None:
        out = out.filter(F.col(value) <= at_most)
    return out.orderBy(F.desc(value), tie).limit(most)


def corrections(rows: DataFrame, value: str, at_most: float) -> DataFrame:
    return rows.agg(F.count_if(F.col(value) > at_most).alias("corrections"))


def comparable(series: DataFrame, floors: dict[str, str]) -> DataFrame:
    """Measures masked before the day they became comparable."""
    return series.select(*[F.when(F.col("day") >= F.lit(floors[c]).cast("date"), F.col(c)).alias(c) if c in floors else F.col(c) for c in series.columns])


def histories(observations: DataFrame, ids: DataFrame) -> DataFrame:
    """Observations of the given ``internal_id``s in order."""
    return observations.join(ids.select("internal_id").distinct(), "internal_id", "left_semi").orderBy("internal_id", "observed_at")


def coverage(runs: DataFrame) -> DataFrame:
    """The newest run of each scope and whether it was complete."""
    w = Window.partitionBy("scope").orderBy(F.desc("started_at"))
    return runs.withColumn("n", F.row_number().over(w)).filter("n = 1").select("scope", "started_at", "ok")
