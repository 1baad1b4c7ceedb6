"""One collecting run: merging each source, absence, events, links, clusters, lent coordinates and house numbers.

What sources fetched comes in as frames; nothing is fetched here. Plans are cut with ``saved`` where the next step reads
them more than once.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.numbers import price_per_m2, real_price
from tidemark.functions.text import locality_tokens, street_key
from tidemark.operators import cluster, match, merge, nearest, register
from tidemark.operators.cluster import saved

SCOPE = ["property_type", "transaction_type"]
# Fields of an advert whose change is logged, and those that only take new values.
TRACKED = ["disposition", "area_m2", "floor", "ownership", "construction", "condition", "energy", "furnishing", "charges", "deposit", "description", "priority_zone"]
SILENT = ["source", "source_id", "url", "property_type", "transaction_type", "discounted", "original_price", "seller", "agency_id", "street", "district", "district_origin", "municipality", "lat", "lon"]
#: Messages of a source that say it stopped as planned.
PLANNED = "[planned]"


class Budget:
    """What a run may still spend: seconds by the clock and details to fetch; says why it stopped."""

    def __init__(self, max_seconds: float | None = None, max_details: int | None = None, clock: Callable[[], float] = time.monotonic) -> None:
        self.max_seconds, self.max_details, self.clock = max_seconds, max_details, clock
        self.started, self.used, self.skipped, self.reasons = clock(), 0, 0, []

    def out_of_time(self) -> bool:
        out = self.max_seconds is not None and self.clock() - self.started >= self.max_seconds
        return out and self._because("time budget exhausted")

    def take(self) -> bool:
        """Whether one more detail fits; if so, it counts as used."""
        if self.out_of_time() or (self.max_details is not None and self.used >= self.max_details and self._because("detail budget exhausted")):
            self.skipped += 1
            return False
        self.used += 1
        return True

    def _because(self, reason: str) -> bool:
        if reason not in self.reasons:
            self.reasons.append(reason)
        return True

    def summary(self) -> dict:
        return {"elapsed_s": round(self.clock() - self.started, 1), "max_seconds": self.max_seconds, "details_used": self.used, "details_skipped": self.skipped, "max_details": self.max_details, "stopped_reasons": list(self.reasons)}


def within_budget(queue: DataFrame, order: list[str], max_details: int) -> tuple[DataFrame, int]:
    """The first rows of a queue that a budget of details allows, and how many are left over."""
    return queue.orderBy(*order).limit(max_details), max(0, queue.count() - max_details)


def split_messages(messages: list[str]) -> tuple[list[str], list[str]]:
    """(errors, planned stops without their mark), each in order."""
    return [m for m in messages if not m.startswith(PLANNED)], [m.removeprefix(PLANNED).strip() for m in messages if m.startswith(PLANNED)]


# Cursors


def advanced(cursors: DataFrame, consumed: DataFrame) -> DataFrame:
    """Cursors (``source``, ``cursor``, ``cycle``) moved on by ``consumed`` and wrapped at ``queue_length``; each wrap is a cycle.

    A source without a cursor starts at zero; a negative count moves nothing; an empty queue only adds up.
    """
    c = cursors.select("source", F.col("cursor").alias("__at"), F.col("cycle").alias("__cycle")).join(consumed, "source", "full")
    at = F.coalesce("__at", F.lit(0)) + F.greatest(F.lit(0), F.coalesce("consumed", F.lit(0)))
    size = F.coalesce("queue_length", F.lit(0))
    return c.select("source", F.when(size > 0, F.pmod(at, size)).otherwise(at).cast("bigint").alias("cursor"), (F.coalesce("__cycle", F.lit(0)) + F.when(size > 0, F.floor(at / size)).otherwise(0)).cast("bigint").alias("cycle"))


def rotated(queue: DataFrame, position: str, cursor: int, length: int) -> DataFrame:
    """A queue numbered from zero by ``position`` with ``turn``, its order from the cursor on, round the end."""
    return queue.withColumn("turn", F.pmod(F.col(position) - F.lit(cursor), F.lit(max(1, length))).cast("bigint"))


def loggable(progress: dict, memories: tuple[str, ...]) -> dict:
    """Progress for the run log: maps of the named memories as their sizes."""
    return {s: {k: len(v) if k in memories and isinstance(v, dict) else v for k, v in e.items()} if isinstance(e, dict) else e for s, e in progress.items()}


# Sources


@dataclass
class Fetched:
    """What a source returned: ``rows`` with listing columns, ``price`` and perhaps ``presence_only``; ``scopes`` it walked whole."""

    source: str
    rows: DataFrame
    scopes: DataFrame
    messages: list[str] = field(default_factory=list)
    sweep_start: Column | None = None
    insert_new: bool = True
    #: Set instead of rows when the source crashed.
    crash: str | None = None


@dataclass
class Merged:
    """All listings after a source's merge, its log rows, the next state, and its figures."""

    listings: DataFrame
    state: DataFrame
    observations: DataFrame
    changes: DataFrame
    new_ids: DataFrame
    stats: dict


def merge_source(listings: DataFrame, state: DataFrame, fetched: Fetched, now: Column, today: Column) -> Merged:
    """Merges what a source shows into the listings.

    Of repeated ids the row with the largest ``url``, then price, stands. Rows with ``presence_only`` refresh dates and
    status and give no event. Rows of walked scopes that pass the guard and weren't seen are absent, and give an event
    without a price. A source that returns nothing and says nothing while rows are stored marks nothing absent.
    """
    errors, planned = split_messages(fetched.messages)
    other, mine = listings.filter(F.col("source") != fetched.source), saved(listings.filter(F.col("source") == fetched.source))
    rows = fetched.rows if "presence_only" in fetched.rows.columns else fetched.rows.withColumn("presence_only", F.lit(False))
    best = [F.max_by(F.struct(*rows.columns), F.struct(F.coalesce("url", F.lit("")), F.coalesce("price", F.lit(-1)))).alias("r")]
    snap = saved(rows.filter("internal_id IS NOT NULL").groupBy("internal_id").agg(*best).select("r.*"))
    tracked, silent = [c for c in TRACKED if c in snap.columns], [c for c in SILENT if c in snap.columns]
    figures = snap.join(mine.select("internal_id", F.col("status").alias("__was")), "internal_id", "left").agg(
        F.count("*").alias("fetched"), F.count_if(F.col("__was").isNull()).alias("new"), F.count_if(F.col("__was") == "active").alias("updated"), F.count_if(F.col("__was") != "active").alias("reactivated")
    ).first()
    stored = mine.count()
    fault = merge.empty_result_fault(figures.fetched, len(fetched.messages), stored)
    if fault:
        errors = [*errors, fault]
    merged, changes = merge.merge_snapshot(mine, snap, "internal_id", tracked, silent, now, today, fetched.insert_new)
    known = snap.join(mine.select("internal_id", *SCOPE), "internal_id", "left_semi").select("internal_id")
    seen_scopes = known.join(mine, "internal_id").select("internal_id", *SCOPE)
    guarded = merge.guarded_scopes(mine, seen_scopes, "internal_id", SCOPE, fetched.scopes.select(*SCOPE).distinct())
    verdicts = guarded.select(*SCOPE, "trusted").collect()  # one row a kind and deal
    trusted = guarded.filter("trusted") if not fault else guarded.limit(0)
    errors += [f"{r[0]}/{r[1]} shows under half of what is stored; nothing marked absent" for r in verdicts if not r.trusted]
    after = saved(merge.mark_absent(merged, snap, "internal_id", SCOPE, trusted, today, fetched.sweep_start))
    gone = after.join(snap, "internal_id", "left_anti").select("internal_id", F.col("status").alias("__now")).join(mine.select("internal_id", F.col("status").alias("__was")), "internal_id")
    gone = gone.filter("__now <> __was").select("internal_id", F.col("__now").alias("status"))
    price = real_price(F.col("price")).cast("bigint")
    shown = snap.filter("NOT coalesce(presence_only, false)").select("internal_id", price.alias("price")).join(after.select("internal_id", "area_m2"), "internal_id")
    sightings = shown.select("internal_id", "price", price_per_m2(F.col("price"), F.col("area_m2")).alias("price_per_m2"), F.lit("active").alias("status"))
    absent = gone.select("internal_id", F.lit(None).cast("bigint").alias("price"), F.lit(None).cast("bigint").alias("price_per_m2"), "status")
    events, next_state = merge.emit_events(sightings.unionByName(absent), state, now)
    lost = gone.agg(F.count("*").alias("n"), F.count_if(F.col("status") == "removed").alias("removed")).first()
    stats = figures.asDict() | {"missing_marked": lost.n, "removed_confirmed": lost.removed, "run_complete": bool(verdicts) and not errors, "scopes_absence_marked": [] if fault else sorted(f"{r[0]}/{r[1]}" for r in verdicts if r.trusted), "interruptions": planned, "errors": errors}
    fresh = after.join(mine, "internal_id", "left_anti").select("internal_id")
    return Merged(other.unionByName(after), saved(next_state), events, changes, fresh, stats)


def observe(listings: DataFrame, state: DataFrame, walk: Fetched, now: Column, today: Column, collect: bool = True) -> Merged:
    """A walk over the whole city that tells stored rows still up from gone, and collects new ones unless told not to.

    If rows of the source are stored outside the city, which the walk can't see, nothing is marked absent.
    """
    strays = [r[0] for r in listings.filter((F.col("source") == walk.source) & (F.trim("municipality") != "") & (F.trim("municipality") != register.CITY)).select(F.trim("municipality").alias("m")).distinct().orderBy("m").limit(5).collect()]
    messages = walk.messages + ([f"rows stored outside the city ({', '.join(strays)}); nothing marked absent"] if strays else [])
    scopes = walk.scopes.limit(0) if strays else walk.scopes
    return merge_source(listings, state, Fetched(walk.source, walk.rows, scopes, messages, walk.sweep_start, collect), now, today)


# One run


@dataclass
class Run:
    listings: DataFrame
    state: DataFrame
    observations: DataFrame
    changes: DataFrame
    stats: dict


def matchable(listings: DataFrame, state: DataFrame) -> DataFrame:
    """Listings in the columns of ``match``: folded street, locality words, the price last stated, dates."""
    place = F.concat_ws(" ", "district", "municipality")
    priced = listings.join(state.select("internal_id", F.col("price").alias("__price")), "internal_id", "left")
    return priced.select(
        "internal_id", "source", "status", "cluster_id", "property_type", "transaction_type", "disposition", "area_m2", "lat", "lon", street_key(F.col("street")).alias("street"), locality_tokens(place).alias("places"),
        F.array_compact(F.array(real_price(F.col("__price")).cast("double"))).alias("prices"), F.to_date("first_seen_at").alias("seen_from"), F.col("last_seen_at").alias("seen_to"),
    )


def relinked(listings: DataFrame, new_ids: DataFrame, state: DataFrame) -> DataFrame:
    """New listings with ``relisted_from``, the removed one that they may continue."""
    rows = matchable(listings, state)
    fresh = rows.join(new_ids, "internal_id", "left_semi").withColumn("first_seen", F.col("seen_from"))
    gone = rows.filter("status = 'removed'").withColumn("last_seen", F.col("seen_to"))
    link = match.relist_candidates(fresh, gone).select("internal_id", F.col("relisted_from").alias("__from"))
    return listings.join(link, "internal_id", "left").select(*[F.coalesce("__from", c).alias(c) if c == "relisted_from" else F.col(c) for c in listings.columns])


def run(listings: DataFrame, state: DataFrame, sources: list[Fetched], now: Column, today: Column, points: DataFrame | None = None, progress: dict | None = None, budget: Budget | None = None) -> Run:
    """One run over all sources, in the order that the steps rest on: merges, links, clusters, lent coordinates, numbers.

    Clusters take in what was merged, lending needs clusters, numbers need lent coordinates. A source that crashed is
    noted and leaves everything as it is.
    """
    spark, before = listings.sparkSession, listings
    budget = budget or Budget()
    per_source, logs, changes, fresh = {}, [], [], []
    for f in sources:
        if f.crash is not None:
            per_source[f.source] = {"crashed": True, "traceback": f.crash, "errors": [f.crash]}
            continue
        m = merge_source(listings, state, f, now, today)
        listings, state = m.listings, m.state
        per_source[f.source] = m.stats
        logs.append(m.observations)
        changes.append(m.changes)
        fresh.append(m.new_ids)
    if fresh:
        listings = saved(relinked(listings, _union(fresh, None), state))
    edges = saved(match.match_pairs(saved(matchable(listings, state)), today).select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), "rank"))
    listings = saved(cluster.apply_clusters(listings, cluster.named_clusters(saved(cluster.cliques(edges)), listings)))
    lent = saved(nearest.lend_in_clusters(listings))
    numbered = saved(register.fill_house_numbers(lent, points)) if points is not None else lent
    has = lambda df, c: df.filter(F.col(c).isNotNull()).count()
    observations = _union(logs, spark.createDataFrame([], schemas.OBSERVATIONS))
    changed = _union(changes, spark.createDataFrame([], schemas.CHANGES))
    stats = {
        "sources": per_source, "gps_lent_within_clusters": has(lent, "lat") - has(listings, "lat"), "numbers_matched": has(numbered, "match_distance_m") - has(lent, "match_distance_m"),
        "total_listings": numbered.count(), "total_observations_written": observations.count(), "total_changes_written": changed.count(), "budget": budget.summary(),
        "progress": loggable(progress or {}, ("vyrazene", "precteno")), "ok": not any(s.get("errors") for s in per_source.values()),
    }
    return Run(numbered.select(*before.columns), state, observations, changed, stats)


def _union(parts: list[DataFrame], none: DataFrame | None) -> DataFrame:
    out = parts[0] if parts else none
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
