"""Facts about the data set: distributions, clusters, life cycles, runs, growth, raw fields."""

from __future__ import annotations

import math
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

QUANTILES = (0.1, 0.25, 0.5, 0.75, 0.9)
#: Ranges that a group's values are cut into, and draws made at once.
RANGES = 4096
DRAWS = 1 << 18


def quantiles(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """Linear-interpolated quantiles p10 to p90, exact."""
    q = F.percentile(value, F.array(*map(F.lit, QUANTILES)))
    return rows.groupBy(*by).agg(F.count(value).alias("n"), q.alias("q")).select(*by, "n", *[F.element_at("q", k + 1).alias(f"p{int(100 * p)}") for k, p in enumerate(QUANTILES)])


def _middle_draws(rng: np.random.RandomState, n: int) -> list[int]:
    """The middle one or two, from zero, of n sorted draws of 0 to n - 1; memory grows with the root of n."""
    want = [(n - 1) // 2, n // 2]
    state, near = rng.get_state(), 8 * math.isqrt(n) + 8
    while True:
        low, high, below, kept = n // 2 - near, n // 2 + near, 0, []
        for at in range(0, n, DRAWS):
            x = np.floor(rng.random_sample(min(DRAWS, n - at)) * n).astype(np.int64)
            below += int((x < low).sum())
            kept.append(x[(x >= low) & (x <= high)])
        inside = np.sort(np.concatenate(kept))
        if below <= want[0] and want[1] < below + len(inside):
            return [int(inside[k - below]) for k in sorted({*want})]
        # The same draws again, with all of them kept.
        rng.set_state(state)
        near = n


def bootstrap_median(rows: DataFrame, by: str | list[str], value: str, rounds: int = 400, seed: int = 7, least: int = 5) -> DataFrame:
    """95 % bootstrap interval of each group's median; the stream of draws is Python's, so results repeat.

    What a round draws are places in the sorted group, which depend on its size only. So a group is its counts per value,
    cut into ranges of values whose sums place each drawn median; only ranges that hold one are sorted, each on its own.
    A group's draws (``rounds`` times its size, without its rows) are made in one task.
    """
    by = [by] if isinstance(by, str) else by
    v = F.col(value).cast("double")
    counts = rows.select(F.struct(*by).alias("g"), F.when(~F.isnan(v), v).alias("v")).groupBy("g", "v").agg(F.count("v").alias("c"))
    groups = counts.groupBy("g").agg(F.sum("c").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    width = F.col("hi") - F.col("lo")
    part = F.when((width > 0) & (width < float("inf")), F.floor((F.col("v") - F.col("lo")) / width * RANGES)).otherwise(0)
    values = counts.filter("c > 0").join(groups, "g").filter(F.col("n") >= least).select("g", "v", "c", part.alias("part"))
    ranges = values.groupBy("g", "part").agg(F.sum("c").alias("size"))
    ranges = ranges.withColumn("upto", F.sum("size").over(Window.partitionBy("g").orderBy("part"))).withColumn("before", F.col("upto") - F.col("size"))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in batch.column(0).to_pylist():
                rng = np.random.RandomState()
                # Python's generator and numpy's make the same doubles of the same state.
                _, (*key, at), _ = random.Random(seed).getstate()
                rng.set_state(("MT19937", np.array(key, np.uint32), at))
                drawn = [(n, k, place) for k in range(rounds) for place in _middle_draws(rng, n)]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*drawn, strict=True)], names=["n", "round", "place"])

    drawn = groups.filter(F.col("n") >= least).select("n").distinct().mapInArrow(draw, "n long, round long, place long")
    drawn = groups.select("g", "n").join(drawn, "n").select("g", "round", "place")
    wanted = drawn.join(ranges, "g").filter("place >= before AND place < upto").select("g", "part", "round", (F.col("place") - F.col("before")).alias("place"))
    hit = values.join(wanted.select("g", "part").distinct(), ["g", "part"]).withColumn("upto", F.sum("c").over(Window.partitionBy("g", "part").orderBy("v")))
    found = wanted.join(hit, ["g", "part"]).filter("place >= upto - c AND place < upto")
    medians = found.groupBy("g", "round").agg((F.sum("v") / F.count("v")).alias("m")).groupBy("g").agg(F.sort_array(F.collect_list("m")).alias("m"))
    bounds = medians.select("g", F.element_at("m", int(0.025 * rounds) + 1).alias("low"), F.element_at("m", int(0.975 * rounds)).alias("high"))
    return groups.select("g", "n").join(bounds, "g", "left").select("g.*", "n", "low", "high")


def cluster_profile(listings: DataFrame) -> DataFrame:
    """How many clusters have each size, and how many of these span sources."""
    each = listings.filter("cluster_id IS NOT NULL AND cluster_id <> ''").groupBy("cluster_id").agg(F.count("*").alias("members"), F.count_distinct("source").alias("sources"))
    return each.groupBy("members").agg(F.count("*").alias("clusters"), F.count_if(F.col("sources") > 1).alias("cross_source"))


def lifecycle(observations: DataFrame) -> DataFrame:
    """Totals of removals, returns and first absences, from consecutive statuses."""
    w = Window.partitionBy("internal_id").orderBy("observed_at", "status")
    steps = observations.withColumn("was", F.lag("status").over(w)).filter("was IS NOT NULL")
    gone = F.col("status") == "removed"
    return steps.agg(F.count_if(gone & (F.col("was") != "removed")).alias("removals"), F.count_if((F.col("status") == "active") & (F.col("was") != "active")).alias("returns"), F.count_if(F.col("status").startswith("missing_") & (F.col("was") == "active")).alias("went_missing"))


def runs_profile(runs: DataFrame) -> DataFrame:
    """Runs a day and kind with mean minutes and errors."""
    errors = F.aggregate(F.map_values("sources"), F.lit(0), lambda a, x: a + F.coalesce(F.size(x.errors), F.lit(0)))
    minutes = (F.unix_timestamp("finished_at") - F.unix_timestamp("started_at")) / 60.0
    return runs.groupBy(F.to_date("started_at").alias("day"), F.coalesce("kind", F.lit("sweep")).alias("kind")).agg(F.count("*").alias("runs"), F.avg(minutes).alias("minutes"), F.sum(errors).alias("errors"))


def silences(runs: DataFrame, most: int = 5) -> DataFrame:
    """The longest gaps between starts."""
    w = Window.orderBy("started_at")  # one row a run
    gap = (F.unix_timestamp("started_at") - F.unix_timestamp(F.lag("started_at").over(w))) / 3600.0
    return runs.select("started_at", gap.alias("hours")).filter("hours IS NOT NULL").orderBy(F.desc("hours"), "started_at").limit(most)


def price_spread(view: DataFrame) -> DataFrame:
    """Spread of prices within clusters that span sources, in percent of the lowest."""
    each = view.filter("cluster_id <> '' AND price > 0").groupBy("cluster_id").agg(F.count_distinct("source").alias("sources"), F.min("price").alias("low"), F.max("price").alias("high"))
    return each.filter("sources > 1").withColumn("spread_pct", 100.0 * (F.col("high") - F.col("low")) / F.col("low"))


def growth(days: DataFrame, whole_days: int = 7, ahead_days: int = 3 * 365) -> DataFrame:
    """Median rows a day (``day``, ``n``) over the last whole days and a straight projection."""
    last = days.withColumn("nth", F.row_number().over(Window.orderBy(F.desc("day")))).filter((F.col("nth") > 1) & (F.col("nth") <= whole_days + 1))  # one row a day; today isn't whole
    return last.agg(F.median("n").alias("per_day")).withColumn("projected", F.col("per_day") * ahead_days)


def json_paths(rows: DataFrame, json_col: str, depth: int = 6) -> DataFrame:
    """(``path``, ``n``): dotted field paths of JSON texts, and how many rows have them.

    JSON held in strings is parsed too; items of arrays are entered by a step ``[]``, which is no path of its own. The
    whole text is at depth 0, and each object or array that is entered counts as one.
    """
    whole = F.regexp_replace(json_col, r"^\s+", "")
    level, out = rows.select(F.monotonically_increasing_id().alias("row"), whole.alias("body"), F.lit("").alias("path")), None
    for _ in range(depth + 1):
        is_list = F.col("body").startswith("[") & F.json_array_length("body").isNotNull()
        items = F.transform(F.from_json("body", "array<string>"), lambda x: F.struct(F.concat("path", F.lit("[]")).alias("path"), x.alias("body"), F.lit(False).alias("field")))
        fields = F.transform(F.json_object_keys("body"), lambda k: F.struct(F.concat_ws(".", F.nullif("path", F.lit("")), k).alias("path"), F.col("values")[k].alias("body"), F.lit(True).alias("field")))
        level = level.withColumn("values", F.from_json("body", "map<string,string>")).select("row", F.explode(F.when(is_list, items).otherwise(fields)).alias("x")).select("row", "x.*")
        found = level.filter("field").select("row", "path")
        out = found if out is None else out.unionByName(found)
        level = level.filter(F.col("body").startswith("{") | F.col("body").startswith("["))
    return out.distinct().groupBy("path").agg(F.count("*").alias("n"))


def raw_coverage(paths: DataFrame, total: int) -> DataFrame:
    return paths.withColumn("pct", 100.0 * F.col("n") / F.lit(total))
