"""Components and clique clusters of match edges, with stable cluster ids."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MAX_MEMBERS = 8
_NAMES = {3: "exact", 2: "high", 1: "medium"}


def saved(df: DataFrame) -> DataFrame:
    """Checkpoint where the session names a folder for it (or one was set); else the frame as it is."""
    spark = df.sparkSession
    if spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return df.checkpoint(eager=True)
    return df


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(``id``) and (``a``, ``b``) -> (``id``, ``component``): the smallest id of the connected component.

    Minimum labels with pointer jumping, which takes about the logarithm of a component's diameter in rounds; lineage is
    cut each round, and rounds go on until one changes nothing. Nodes without edges are their own component.
    """
    both = saved(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = saved(nodes.select("id", F.col("id").alias("component")).distinct())
    while True:
        offers = both.join(labels.select(F.col("id").alias("b"), F.col("component").alias("offer")), "b").groupBy(F.col("a").alias("id")).agg(F.min("offer").alias("offer"))
        lower = labels.join(offers, "id", "left").select("id", "component", F.least("component", F.coalesce("offer", "component")).alias("next"))
        far = labels.select(F.col("id").alias("next"), F.col("component").alias("far"))
        now = saved(lower.join(far, "next", "left").select("id", F.least("next", F.coalesce("far", "next")).alias("new"), "component"))
        done = now.filter("new <> component").limit(1).count() == 0
        labels = now.select("id", F.col("new").alias("component"))
        if done:
            return labels


def joined(told: DataFrame) -> DataFrame:
    """(``id``, ``label``) -> (``id``, ``component``): the smallest label of the component of ids that share labels.

    Only ids of several labels join labels, so only these go in rounds.
    """
    told = saved(told)
    ids = saved(told.groupBy("id").agg(F.min("label").alias("low"), F.max("label").alias("high")))
    several = ids.filter("low < high")
    if several.isEmpty():
        return ids.select("id", F.col("low").alias("component"))
    edges = saved(told.join(several, "id").filter("low < label").select(F.col("low").alias("a"), F.col("label").alias("b")).distinct())
    found = components(edges.select(F.explode(F.array("a", "b")).alias("id")).distinct(), edges)
    return ids.join(found.withColumnRenamed("id", "low"), "low", "left").select("id", F.coalesce("component", "low").alias("component"))


def property_keys(listings: DataFrame) -> DataFrame:
    """``internal_id`` -> ``property_key`` over duplicate clusters and re-listing links whose target exists."""
    ids = listings.select(F.col("internal_id").alias("id"))
    in_cluster = listings.filter("cluster_id IS NOT NULL AND cluster_id <> ''").select(F.col("internal_id").alias("a"), F.concat(F.lit("cluster:"), "cluster_id").alias("b"))
    relisted = listings.filter("relisted_from IS NOT NULL AND relisted_from <> ''").select(F.col("internal_id").alias("a"), F.col("relisted_from").alias("b")).join(ids.withColumnRenamed("id", "b"), "b", "left_semi").select("a", "b")
    edges = in_cluster.unionByName(relisted)
    nodes = ids.unionByName(edges.select(F.col("b").alias("id"))).distinct()
    return components(nodes, edges).join(ids, "id", "left_semi").select(F.col("id").alias("internal_id"), F.col("component").alias("property_key"))


def _cliques(frame: pd.DataFrame) -> pd.DataFrame:
    """Greedy cliques of one component: seeds by degree, members by confidence with the seed; every member matches all."""
    near: dict[str, dict[str, int]] = {}
    for a, b, rank in zip(frame["a"], frame["b"], frame["rank"], strict=True):
        near.setdefault(a, {})[b] = rank
        near.setdefault(b, {})[a] = rank
    free, rows = set(near), []
    for seed in sorted(near, key=lambda k: (-len(near[k]), k)):
        if seed not in free:
            continue
        group = [seed]
        for other in sorted((k for k in near[seed] if k in free), key=lambda k: (-near[seed][k], k)):
            if len(group) < MAX_MEMBERS and all(other in near[m] for m in group):
                group.append(other)
        if len(group) > 1:
            free -= set(group)
            best = max(near[seed][m] for m in group[1:])
            rows += [(m, seed, len(near[seed]), best if m == seed else near[seed][m], len(group)) for m in group]
    return pd.DataFrame(rows, columns=["internal_id", "seed", "degree", "rank", "members"])


def cliques(edges: DataFrame) -> DataFrame:
    """(``a``, ``b``, ``rank``) -> members of clusters: ``internal_id``, ``seed``, ``degree`` of the seed, ``rank``, ``members``.

    Clusters never cross components, so each component is handled by itself; the blocking rules keep these small.
    """
    nodes = edges.select(F.col("a").alias("id")).unionByName(edges.select(F.col("b").alias("id"))).distinct()
    named = edges.join(components(nodes, edges).withColumnRenamed("id", "a"), "a")
    return named.groupBy("component").applyInPandas(_cliques, "internal_id string, seed string, degree long, rank int, members long")


def inherited(claims: DataFrame) -> DataFrame:
    """(``seed``, ``degree``, ``place``, ``old``) -> ``seed``, ``old``: each old id goes to one cluster.

    Clusters choose in order of degree, then seed; each takes the first of its old ids (by ``place``) that no earlier one
    took. In rounds, each cluster asks for its first id that has not refused it, and an id refuses all but the earliest
    that ask, until none is refused; this gives what choosing one after another gives.
    """
    left = saved(claims)
    while True:
        asked = left.withColumn("turn", F.row_number().over(Window.partitionBy("seed").orderBy("place"))).filter("turn = 1")
        told = saved(asked.withColumn("rank", F.row_number().over(Window.partitionBy("old").orderBy(F.desc("degree"), "seed"))).select("seed", "old", "rank"))
        if not told.filter("rank > 1").limit(1).count():
            return told.select("seed", "old")
        left = saved(left.join(told.filter("rank > 1"), ["seed", "old"], "left_anti"))


def named_clusters(members: DataFrame, listings: DataFrame) -> DataFrame:
    """Adds ``cluster_id``: the first of the members' old ids that no earlier cluster took, else a hash of the sorted members.

    A hash that is also an inherited id is salted with itself. ``confidence`` is the member's best rank by name.
    """
    old = listings.select("internal_id", F.col("cluster_id").alias("old")).filter("old IS NOT NULL AND old <> ''")
    claims = members.join(old, "internal_id").groupBy("seed", "old").agg(F.max("degree").alias("degree"), F.min("internal_id").alias("place"))
    taken = saved(inherited(claims))
    ids = members.groupBy("seed").agg(F.array_sort(F.collect_list("internal_id")).alias("ids"))
    clash = taken.select(F.col("old").alias("fresh"), F.lit(True).alias("clash"))
    given = ids.join(taken, "seed", "left").withColumn("fresh", _hash(F.col("ids"))).join(clash, "fresh", "left")
    fresh = F.when(F.col("clash"), _hash(F.array_sort(F.array_append("ids", F.col("fresh"))))).otherwise(F.col("fresh"))
    name = F.when(F.col("rank") == 3, "exact").when(F.col("rank") == 2, "high").otherwise("medium")
    return members.join(given.select("seed", F.coalesce("old", fresh).alias("cluster_id")), "seed").select("internal_id", "cluster_id", name.alias("dedup_confidence"))


def _hash(ids: Column) -> Column:
    return F.concat(F.lit("clu_"), F.substring(F.sha1(F.array_join(ids, ",").cast("binary")), 1, 10))


def cluster_hash(ids: list[str]) -> str:
    """The id of a new cluster, as ``named_clusters`` computes it."""
    return "clu_" + hashlib.sha1(",".join(sorted(ids)).encode()).hexdigest()[:10]


def apply_clusters(listings: DataFrame, named: DataFrame) -> DataFrame:
    """Listings with cluster columns set; rows that matched nothing are blanked."""
    base = listings.drop("cluster_id", "dedup_confidence")
    return base.join(named, "internal_id", "left").select(*[F.coalesce(c, F.lit("")).alias(c) if c in ("cluster_id", "dedup_confidence") else c for c in listings.columns])
