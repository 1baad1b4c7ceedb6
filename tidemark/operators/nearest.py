"""Nearest register points, donors of coordinates, and values that are the only one."""

from __future__ import annotations

from functools import reduce
from math import radians
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.geo import EARTH_M, haversine_m

MAX_M = 250.0
CROWD_FLOOR_M = 5.0
CROWD_FACTOR = 2.0
#: Spots that meet their places at once, about; and what a squared chord errs by at most.
BLOCK = 256
SLACK = 1e-14


def _unit(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    la, lo = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(la) * np.cos(lo), np.cos(la) * np.sin(lo), np.sin(la)])


def _arc(chord2: np.ndarray) -> np.ndarray:
    """Metres on the Earth of squared chords of the unit sphere."""
    return 2 * EARTH_M * np.arcsin(np.sqrt(np.clip(chord2, 0.0, 4.0)) / 2)


def reached(lat: np.ndarray, lon: np.ndarray, p_lat: np.ndarray, p_lon: np.ndarray, max_m: float) -> tuple[np.ndarray, np.ndarray]:
    """How many places each spot has within its reach, and which, spot after spot; none for a spot without a place within ``max_m``.

    Never a place too few, and hardly one too many: products of unit vectors tell, with ``SLACK`` allowed for their rounding.
    """
    with np.errstate(invalid="ignore"):
        spots, places = _unit(lat, lon).T, _unit(p_lat, p_lon)
        counts, which = [], []
        step = max(1, (1 << 16) // max(1, len(p_lat)))
        for k in range(0, len(lat), step):
            near = spots[k : k + step] @ places
            least = 2 - 2 * np.fmax.reduce(near, axis=1)
            reach = np.maximum(CROWD_FLOOR_M, CROWD_FACTOR * _arc(least + SLACK))
            # Far round the Earth chords hardly tell distances, so all places are taken there.
            limit = np.where(reach < 3 * EARTH_M, (2 * np.sin(np.minimum(reach / (2 * EARTH_M), 1.5))) ** 2 * 1.000001 + SLACK, np.inf)
            low = _arc(least * 0.999999 - SLACK)
            limit[~((low <= max_m) | (low > 2.9 * EARTH_M))] = -np.inf
            found = near >= (1 - limit / 2)[:, None]
            counts.append(found.sum(axis=1))
            which.append(np.nonzero(found)[1])
    return np.concatenate(counts), np.concatenate(which)


def _in_reach(max_m: float):
    """``reached`` for rows of arrays: a row's spots and its places give an array of places (from 0) a spot."""

    def run(lat: pa.Array, lon: pa.Array, p_lat: pa.Array, p_lon: pa.Array) -> pa.Array:
        counts, which = [np.zeros(0, "int64")], [np.zeros(0, "int64")]
        for row in zip(lat, lon, p_lat, p_lon):
            n, at = reached(*[c.values.to_numpy(zero_copy_only=False) for c in row], max_m)
            counts.append(n)
            which.append(at)
        ends = lambda n: pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
        each = pa.ListArray.from_arrays(ends(np.concatenate(counts)), pa.array(np.concatenate(which), pa.int32()))
        return pa.ListArray.from_arrays(ends([len(n) for n in counts[1:]]), each)

    # Stated as objects, as the annotations above are strings to a worker.
    run.__annotations__ = dict.fromkeys(("lat", "lon", "p_lat", "p_lon", "return"), pa.Array)
    return F.arrow_udf(run, "array<array<int>>")


def crowds(rows: DataFrame, points: DataFrame, key: str, number: Column, own: Column, around: Column, max_m: float) -> DataFrame:
    """Spots (``key``, ``lat``, ``lon``) of ``rows`` with ``__top``, the nearest point of the key within ``max_m``, and ``__crowd``.

    ``__top`` is a struct of ``metres``, ``id`` and ``point`` (the row of ``points``); equal distances go to the smaller point
    id. ``__crowd`` counts the distinct stated ``number`` within twice the distance found, at least five metres. All columns of
    a spot are stated on both sides; ``own`` is the cell of a spot, ``around`` the cells from which a point can be met.

    What is found depends on the spot only, so rows at one spot are answered once, and points at one spot stand as one. Spots
    of a key and cell meet the places round them block by block, as arrays: no pair becomes a row, and none is shuffled.
    ``reached`` finds the few places of a spot that can count; only for these the distance is computed as everywhere else.
    """
    spot, group = [key, "lat", "lon"], [key, "__cell"]
    places = points.groupBy(*spot).agg(F.min("point_id").alias("id"), F.collect_set(number).alias("numbers"))
    near = places.select(key, F.explode(around).alias("__cell"), F.struct("lat", "lon", "id", "numbers").alias("p")).groupBy(*group).agg(F.collect_list("p").alias("__near"))
    # A group's blocks are dealt to as many tasks as there are, each with the group's places once.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spots = rows.select(*spot).distinct().withColumn("__cell", own)
    sizes = spots.groupBy(*group).agg(F.ceil(F.count("*") / BLOCK).alias("__blocks"))
    deal = F.pmod("__block", F.least(F.lit(parts), "__blocks"))
    blocks = spots.join(sizes, group).withColumn("__block", F.pmod(F.xxhash64("lat", "lon"), "__blocks")).withColumn("__deal", deal)
    blocks = blocks.repartition(parts, *group, "__deal").groupBy(*group, "__deal", "__block").agg(F.collect_list(F.struct("lat", "lon")).alias("__spots"))
    near = near.join(sizes, group).withColumn("__deal", F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.lit(parts), "__blocks") - 1)))
    met = blocks.join(near, [*group, "__deal"]).withColumn("__in", _in_reach(max_m)(*[F.col(f"{side}.{c}").cast("array<double>") for side in ("__spots", "__near") for c in ("lat", "lon")]))

    away = lambda s: F.transform(s["__in"], lambda i: _away(s["__spots"], F.get("__near", i)))
    reach = lambda t: F.greatest(F.lit(CROWD_FLOOR_M), CROWD_FACTOR * t["metres"])
    crowd = lambda w, t: F.size(F.array_distinct(F.flatten(F.transform(F.filter(w, lambda a: a["metres"] <= reach(t)), lambda a: a["numbers"]))))
    # Distances and their least are bound by lambdas: as columns they would be put into the filter and done anew for every point.
    hits = lambda s, w: F.transform(F.filter(F.array(F.array_min(w)), lambda t: t["metres"] <= max_m), lambda t: F.struct(s["__spots"]["lat"].alias("lat"), s["__spots"]["lon"].alias("lon"), t.alias("top"), crowd(w, t).alias("crowd")))
    each = F.flatten(F.transform(F.arrays_zip("__spots", "__in"), lambda s: F.flatten(F.transform(F.array(away(s)), lambda w: hits(s, w)))))
    found = met.select(key, F.explode(each).alias("hit")).select(key, "hit.*")
    firsts = points.groupBy(*spot).agg(F.min(F.struct(F.col("point_id").alias("id"), F.struct(*points.columns).alias("point"))).alias("first"))
    firsts = firsts.select(key, F.col("lat").alias("__lat"), F.col("lon").alias("__lon"), "first")
    named = found.withColumns({"__lat": F.col("top.lat"), "__lon": F.col("top.lon")}).join(firsts, [key, "__lat", "__lon"])
    return named.select(*spot, F.struct("top.metres", "top.id", "first.point").alias("__top"), F.col("crowd").alias("__crowd"))


def _away(s: Column, p: Column) -> Column:
    return F.struct(haversine_m(s["lat"], s["lon"], p["lat"], p["lon"]).alias("metres"), p["id"].alias("id"), p["lat"].alias("lat"), p["lon"].alias("lon"), p["numbers"].alias("numbers"))


def nearest_point(rows: DataFrame, points: DataFrame, key: str, max_m: float = MAX_M) -> DataFrame:
    """For each row (``id``, ``key``, ``lat``, ``lon``) the nearest point of its key within ``max_m`` and how crowded it is there.

    ``points`` has ``point_id``, ``key``, ``number``, ``lat``, ``lon``. ``candidates`` counts the distinct numbers within
    twice the distance found, at least five metres. Ties in distance go to the smaller point id.
    """
    stated = F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col(key).isNotNull()
    known, placed, spot = points.filter(stated), rows.filter(stated).select("id", key, "lat", "lon"), [key, "lat", "lon"]
    # An id stands at one spot if its least and greatest agree: numbers are kept in hashed rows, where sets of spots are sorted.
    ids = placed.groupBy("id").agg(*[f(c).alias(f"{n}_{c}") for c in spot for n, f in (("low", F.min), ("high", F.max))])
    alone = reduce(and_, [F.col(f"low_{c}") == F.col(f"high_{c}") for c in spot])
    left = ids.filter(alone).select("id", *[F.col(f"low_{c}").alias(c) for c in spot])
    many = ids.filter(~alone).select(F.col("id").alias("__id"))
    several = placed.join(many, F.col("id").eqNullSafe(F.col("__id")), "left_semi").distinct().select("id", F.struct(*spot).alias("spot"))
    # No two places are nearer than their latitudes, so bands as high as the farthest crowd reaches hold it, at any longitude.
    band = F.floor(F.col("lat") / (1.001 * max(CROWD_FLOOR_M, CROWD_FACTOR * max_m) / (EARTH_M * radians(1))))
    found = crowds(left, known, key, F.col("number"), band, F.array(band - 1, band, band + 1), max_m)
    top = F.col("__top")
    out = left.join(found, spot).select("id", top["id"].alias("point_id"), top["point"]["number"].alias("number"), top["metres"].alias("metres"), F.col("__crowd").cast("long").alias("candidates"))
    return out.unionByName(_of_several(several, known, key, max_m))


def _of_several(rows: DataFrame, points: DataFrame, key: str, max_m: float) -> DataFrame:
    """``nearest_point`` of ids that stand at several spots (``id``, ``spot``), over the points of all of them."""
    left = rows.select("id", F.col("spot")[key].alias(key), F.col("spot.lat").alias("la"), F.col("spot.lon").alias("lo"))
    away = left.join(points, key).withColumn("metres", haversine_m(F.col("la"), F.col("lo"), F.col("lat"), F.col("lon")))
    low = away.withColumn("least", F.min("metres").over(Window.partitionBy("id"))).filter(F.col("least") <= max_m)
    reach = F.greatest(F.lit(CROWD_FLOOR_M), CROWD_FACTOR * F.col("least"))
    best = F.min(F.struct("metres", "point_id", "number")).alias("top")
    out = low.groupBy("id").agg(best, F.count_distinct(F.when(F.col("metres") <= reach, F.col("number"))).alias("candidates"))
    return out.select("id", F.col("top.point_id").alias("point_id"), F.col("top.number").alias("number"), F.col("top.metres").alias("metres"), "candidates")


def lend_in_clusters(rows: DataFrame) -> DataFrame:
    """Coordinates of the first sibling (smallest id) that has its own, for cluster members without."""
    donors = rows.filter("cluster_id IS NOT NULL AND cluster_id <> '' AND lat IS NOT NULL AND lon IS NOT NULL AND coalesce(coords_origin, '') = ''")
    best = donors.groupBy("cluster_id").agg(F.min(F.struct("internal_id", "lat", "lon")).alias("donor"))
    joined = rows.join(best, "cluster_id", "left")
    takes = F.col("lat").isNull() & F.col("donor").isNotNull()
    values = {"lat": F.when(takes, F.col("donor.lat")).otherwise(F.col("lat")), "lon": F.when(takes, F.col("donor.lon")).otherwise(F.col("lon")), "coords_origin": F.when(takes, "cluster").otherwise(F.col("coords_origin"))}
    return joined.select(*[values.get(c, F.col(c)).alias(c) for c in rows.columns])


def sole_value(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with exactly one stated value, and that value."""
    return rows.filter(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key).agg(F.min(value).alias("only"), F.max(value).alias("other")).filter("only = other").drop("other")


def fill_blanks(rows: DataFrame, history: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Blank ``columns`` filled from the history's row of the same keys; stated values stay."""
    old = history.select(*keys, *[F.col(c).alias(f"__{c}") for c in columns])
    joined = rows.join(old, keys, "left")
    filled = {c: F.coalesce(F.when(F.trim(F.col(c).cast("string")) != "", F.col(c)), F.col(f"__{c}")) for c in columns}
    return joined.select(*[filled.get(c, F.col(c)).alias(c) for c in rows.columns])


def near_misses(rows: DataFrame) -> DataFrame:
    """Pairs of different sources at one spot (four decimals), layout and deal, areas within one, in no common cluster."""
    spot = [F.round("lat", 4).alias("y"), F.round("lon", 4).alias("x")]
    side = lambda p: rows.filter("lat IS NOT NULL AND lon IS NOT NULL").select(*spot, "disposition", "transaction_type", *[F.col(c).alias(f"{p}_{c}") for c in ("internal_id", "source", "area_m2", "cluster_id")])
    pairs = side("a").join(side("b"), ["y", "x", "disposition", "transaction_type"])
    apart = ~F.coalesce((F.col("a_cluster_id") == F.col("b_cluster_id")) & (F.col("a_cluster_id") != ""), F.lit(False))
    return pairs.filter((F.col("a_internal_id") < F.col("b_internal_id")) & (F.col("a_source") != F.col("b_source")) & (F.abs(F.col("a_area_m2") - F.col("b_area_m2")) <= 1) & apart).select("a_internal_id", "b_internal_id")


def nearest_names(names: DataFrame, wanted: str, most: int = 8) -> DataFrame:
    """Distinct (``name``) most like ``wanted``: those that hold it, then by edit similarity of at least 0.6."""
    size = F.greatest(F.length("name"), F.lit(len(wanted)))
    ratio = 1 - F.levenshtein(F.col("name"), F.lit(wanted)) / size
    scored = names.filter("name <> ''").distinct().withColumn("holds", F.col("name").contains(wanted)).withColumn("ratio", ratio)
    return scored.filter("holds OR ratio >= 0.6").orderBy(F.desc("holds"), F.desc("ratio"), "name").limit(most)


def cross_check(rows: DataFrame) -> DataFrame:
    """Stated against registered district of matched rows: ``agree``, ``disagree`` and the share."""
    same = F.col("stated") == F.col("registered")
    out = rows.filter("stated IS NOT NULL AND registered IS NOT NULL").agg(F.count_if(same).alias("agree"), F.count_if(~same).alias("disagree"))
    return out.withColumn("agreement_pct", 100.0 * F.col("agree") / F.nullif(F.col("agree") + F.col("disagree"), F.lit(0)))
