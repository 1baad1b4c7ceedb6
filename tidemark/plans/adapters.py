"""Adapter views that let the driver's tables stand in for adverts, observations, spans and points.

``SQL`` states the same views for the oracle, as common table expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numbers import real_price

LEAST_VALUE = 10.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as an observation log; errors state no price, values below a floor are placeholders."""
    e = table(spark, sf_dir, "events")
    price = F.when(F.col("event_type") != "error", real_price(F.col("value"), LEAST_VALUE))
    return e.select(F.col("user_id").alias("internal_id"), F.col("ts").cast("timestamp").alias("observed_at"), "event_id", F.col("event_type").alias("status"), price.alias("price"))


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipments of a part as spans of so many days as items."""
    d = F.to_date("l_shipdate")
    return table(spark, sf_dir, "lineitem").select("l_partkey", d.alias("start"), F.date_add(d, F.col("l_quantity").cast("int")).alias("end"))


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as adverts: brand and type block them, every third lacks coordinates."""
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        k.alias("internal_id"), F.col("p_brand").alias("property_type"), F.lit("prodej").alias("transaction_type"), F.col("p_type").alias("disposition"), F.concat_ws("/", "p_brand", "p_type").alias("street"),
        (F.col("p_size") + 20.0).alias("area_m2"), F.array(F.col("p_retailprice")).alias("prices"), F.col("p_retailprice").alias("price"), F.when(k % 3 != 0, 50.0 + (k * 7 % 40) / 20000.0).alias("lat"), F.when(k % 3 != 0, 14.4 + (k * 11 % 40) / 20000.0).alias("lon"),
        F.array(F.element_at(F.split("p_name", " "), 1)).alias("places"), F.lit(None).cast("date").alias("seen_from"), F.lit(None).cast("date").alias("seen_to"), F.concat(F.lit("s"), (k % 3).cast("string")).alias("source"), F.lit("").alias("cluster_id"),
    )


def points(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``customer`` or ``supplier`` with coordinates by arithmetic on keys."""
    key = {"customer": "c_custkey", "supplier": "s_suppkey"}[name]
    nation = {"customer": "c_nationkey", "supplier": "s_nationkey"}[name]
    k = F.col(key)
    return table(spark, sf_dir, name).select(k.alias("id"), F.col(nation).alias("nation"), (50.0 + (k * 7919 % 2000) / 10000.0).alias("lat"), (14.4 + (k * 104729 % 2000) / 10000.0).alias("lon"))


def market_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as episodes."""
    k, start = F.col("o_orderkey"), F.to_date("o_orderdate")
    days = (F.col("o_custkey") % 60).cast("int")
    return table(spark, sf_dir, "orders").select(
        k.alias("row_id"), F.col("o_orderpriority").alias("segment_type"), F.col("o_orderstatus").alias("segment_deal"), start.alias("start"), F.date_add(start, days).alias("end"), (F.col("o_orderstatus") == "F").alias("gone"),
        F.col("o_totalprice").alias("price"), days.alias("days"), (k % 17).cast("double").alias("discount_pct"), F.when(k % 3 == 0, F.array(F.date_add(start, (k % 20).cast("int")), F.date_add(start, (k % 7).cast("int")))).otherwise(F.array().cast("array<date>")).alias("cuts"),
    )


SQL = {
    "obs": "obs AS (SELECT user_id AS internal_id, ts AS observed_at, event_id, event_type AS status, CASE WHEN event_type <> 'error' AND value >= 10 THEN value END AS price FROM events)",
    "span": 'span AS (SELECT l_partkey, l_shipdate::DATE AS "start", l_shipdate::DATE + l_quantity::INT AS "end" FROM lineitem)',
    "ent": "ent AS (SELECT p_partkey AS internal_id, p_brand AS property_type, p_type AS disposition, p_brand || '/' || p_type AS street, p_size + 20.0::DOUBLE AS area_m2, p_retailprice AS price, CASE WHEN p_partkey % 3 <> 0 THEN 50.0::DOUBLE + (p_partkey * 7 % 40) / 20000.0::DOUBLE END AS lat, CASE WHEN p_partkey % 3 <> 0 THEN 14.4::DOUBLE + (p_partkey * 11 % 40) / 20000.0::DOUBLE END AS lon, split_part(p_name, ' ', 1) AS place, 's' || (p_partkey % 3) AS source FROM part)",
    "cust": "cust AS (SELECT c_custkey AS id, c_nationkey AS nation, 50.0::DOUBLE + (c_custkey * 7919 % 2000) / 10000.0::DOUBLE AS lat, 14.4::DOUBLE + (c_custkey * 104729 % 2000) / 10000.0::DOUBLE AS lon FROM customer)",
    "supp": "supp AS (SELECT s_suppkey AS id, s_nationkey AS nation, 50.0::DOUBLE + (s_suppkey * 7919 % 2000) / 10000.0::DOUBLE AS lat, 14.4::DOUBLE + (s_suppkey * 104729 % 2000) / 10000.0::DOUBLE AS lon FROM supplier)",
    "epi": "epi0 AS (SELECT o_orderkey AS row_id, o_orderpriority AS t, o_orderstatus AS d, o_orderdate::DATE AS \"start\", o_orderdate::DATE + (o_custkey % 60)::INT AS \"end\", o_orderstatus = 'F' AS gone, o_totalprice AS price, o_custkey % 60 AS days, (o_orderkey % 17)::DOUBLE AS discount_pct FROM orders), epi AS (SELECT *, t || '/' || d AS segment FROM epi0 UNION ALL SELECT *, 'vse/' || d FROM epi0)",
    "hav": "2 * 6371000.0::DOUBLE * atan2(sqrt(h), sqrt(1 - h))",
}


def haversine_sql(a: str, b: str) -> str:
    """Metres between two aliases with ``lat`` and ``lon``."""
    h = f"(pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lon - {a}.lon) / 2), 2))"
    return f"(2 * 6371000.0::DOUBLE * atan2(sqrt({h}), sqrt(1 - {h})))"
