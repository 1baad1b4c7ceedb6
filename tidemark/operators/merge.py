"""Merging snapshots into a keyed table, absence, and merges of concurrent copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.numbers import same_value

REMOVED_AFTER_DAYS = 5
DROP_FROM = 20
DROP_SHARE = 0.5
CUT = 300


def next_status(status: Column, days_absent: Column) -> Column:
    """Of a row that was looked for and not found: ``missing_N`` by days, removed from the fifth; unknown days never remove."""
    count = F.coalesce(F.regexp_extract(status, r"^missing_(\d+)$", 1).try_cast("int"), F.lit(0))
    by_days = F.when(days_absent >= REMOVED_AFTER_DAYS, "removed").otherwise(F.concat(F.lit("missing_"), F.greatest(F.lit(1), days_absent).cast("string")))
    unknown = F.concat(F.lit("missing_"), F.greatest(F.lit(1), count).cast("string"))
    return F.when(status == "removed", "removed").when(days_absent.isNull(), unknown).otherwise(by_days)


def is_live(status: Column) -> Column:
    return F.coalesce((status == "active") | status.like("missing\\_%"), F.lit(False))


def newest_copy(rows: DataFrame, key: list[str], seen: str, status: str, order: list[str]) -> DataFrame:
    """One row a key: latest ``seen``, then removed, then the first in ``order``."""
    w = Window.partitionBy(*key).orderBy(F.desc(seen), F.desc((F.col(status) == "removed").cast("int")), *order)
    return rows.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def merge_snapshot(table: DataFrame, snapshot: DataFrame, key: str, tracked: list[str], silent: list[str], now: Column, today: Column, insert_new: bool = True) -> tuple[DataFrame, DataFrame]:
    """One full outer join of a keyed table with a snapshot of the same columns.

    Blank new values never overwrite. Of ``tracked`` fields a true change (both stated, not equal across typings) is a
    change row; ``silent`` fields only take new values. Rows seen are active today; new ones start now. Returns the table
    and the change rows (key, changed_at, field, old_value, new_value).
    """
    blank = lambda c: F.trim(F.coalesce(c.cast("string"), F.lit(""))) == ""
    old = table.select(F.col(key).alias("__ok"), *[F.col(c).alias(f"o_{c}") for c in table.columns])
    new = snapshot.select(F.col(key).alias("__nk"), *[F.col(c).alias(f"n_{c}") for c in snapshot.columns if c in (*tracked, *silent, key)])
    joined = old.join(new, F.col("__ok") == F.col("__nk"), "full" if insert_new else "left")
    seen, known = F.col("__nk").isNotNull(), F.col("__ok").isNotNull()
    fields = {}
    for c in table.columns:
        if c == key:
            fields[c] = F.coalesce("__ok", "__nk")
        elif c in (*tracked, *silent):
            fields[c] = F.when(seen & ~blank(F.col(f"n_{c}")), F.col(f"n_{c}")).otherwise(F.col(f"o_{c}"))
        elif c == "status":
            fields[c] = F.when(seen, "active").otherwise(F.col("o_status"))
        elif c == "last_seen_at":
            fields[c] = F.when(seen, today).otherwise(F.col("o_last_seen_at"))
        elif c == "first_seen_at":
            fields[c] = F.when(known, F.col("o_first_seen_at")).otherwise(now)
        else:
            fields[c] = F.col(f"o_{c}")
    merged = joined.select(*[v.alias(c) for c, v in fields.items()])
    each = [F.struct(F.lit(c).alias("field"), F.substring(F.col(f"o_{c}").cast("string"), 1, CUT).alias("old_value"), F.substring(F.col(f"n_{c}").cast("string"), 1, CUT).alias("new_value"), (~blank(F.col(f"o_{c}")) & ~blank(F.col(f"n_{c}")) & ~same_value(F.col(f"o_{c}"), F.col(f"n_{c}"))).alias("real")) for c in tracked]
    changes = joined.filter(seen & known).select(F.col("__ok").alias(key), now.alias("changed_at"), F.explode(F.array(*each)).alias("x")).filter("x.real").select(key, "changed_at", "x.field", "x.old_value", "x.new_value")
    return merged, changes


def guarded_scopes(table: DataFrame, seen: DataFrame, key: str, scope: list[str], completed: DataFrame) -> DataFrame:
    """Completed scopes with ``active_before``, ``seen_now`` and ``trusted``: a scope of 20 or more that shows under half is not."""
    before = table.filter("status = 'active'").groupBy(*scope).agg(F.count("*").alias("active_before"))
    now = seen.groupBy(*scope).agg(F.count("*").alias("seen_now"))
    out = completed.join(before, scope, "left").join(now, scope, "left").na.fill(0, ["active_before", "seen_now"])
    return out.withColumn("trusted", ~((F.col("active_before") >= DROP_FROM) & (F.col("seen_now") < F.col("active_before") * DROP_SHARE)))


def mark_absent(table: DataFrame, seen: DataFrame, key: str, scope: list[str], trusted: DataFrame, today: Column, sweep_start: Column | None = None) -> DataFrame:
    """The table with the status of rows not seen in trusted scopes moved on; rows seen since the sweep began stay."""
    hit = seen.select(F.col(key), F.lit(True).alias("__seen")).distinct()
    flagged = table.join(hit, key, "left").join(trusted.select(*scope, F.lit(True).alias("__scope")), scope, "left")
    absent = F.col("__seen").isNull() & F.col("__scope").isNotNull() & (F.col("status") != "removed")
    if sweep_start is not None:
        absent = absent & F.coalesce(F.col("last_seen_at") < sweep_start, F.lit(True))
    moved = F.when(absent, next_status(F.col("status"), F.datediff(today, F.col("last_seen_at").cast("date")))).otherwise(F.col("status"))
    return flagged.withColumn("__new", moved).select(*[F.col("__new").alias(c) if c == "status" else F.col(c) for c in table.columns])


def emit_events(sightings: DataFrame, state: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """Events for (internal_id, price, price_per_m2, status) that differ from the remembered state, and the next state.

    A missing price keeps the remembered one in the state but is blank in the event.
    """
    old = state.select("internal_id", F.col("price").alias("p0"), F.col("status").alias("s0"), F.lit(True).alias("known"))
    joined = sightings.join(old, "internal_id", "left").withColumn("kp", F.coalesce("price", "p0"))
    moved = joined.filter(F.col("known").isNull() | ~(F.col("kp").eqNullSafe(F.col("p0")) & F.col("status").eqNullSafe(F.col("s0"))))
    events = moved.select("internal_id", now.alias("observed_at"), "price", "price_per_m2", "status")
    after = state.join(sightings.select("internal_id"), "internal_id", "left_anti").unionByName(joined.select("internal_id", F.col("kp").alias("price"), "status"))
    return events, after


def empty_result_fault(fetched: int, errors: int, stored: int) -> str | None:
    """A source that returns nothing and reports nothing while rows are stored has most likely changed its page."""
    return f"no rows returned and no error reported, while {stored} are stored" if not fetched and not errors and stored else None


def three_way(ours: DataFrame, theirs: DataFrame, base: DataFrame | None, key: str, values: list[str], first: str, last: str) -> DataFrame:
    """Our values win; earliest ``first`` and latest ``last``; a row that a side deleted since ``base`` stays deleted."""
    side = lambda df, p: df.select(key, *[F.col(c).alias(f"{p}_{c}") for c in (*values, first, last)], F.lit(True).alias(p))
    joined = side(ours, "o").join(side(theirs, "t"), key, "full")
    if base is not None:
        joined = joined.join(base.select(key, F.lit(True).alias("b")).distinct(), key, "left").filter("(o AND t) OR b IS NULL")
    pick = [F.when(F.col("o"), F.col(f"o_{c}")).otherwise(F.col(f"t_{c}")).alias(c) for c in values]
    return joined.select(key, *pick, F.least(f"o_{first}", f"t_{first}").alias(first), F.greatest(f"o_{last}", f"t_{last}").alias(last))


def union_logs(theirs: DataFrame, ours: DataFrame) -> DataFrame:
    """Distinct lines of both logs."""
    return theirs.unionByName(ours).dropDuplicates()


def merge_maps(ours: Column, theirs: Column) -> Column:
    """Shallow merge of two maps; our values win."""
    return F.map_from_entries(F.concat(F.map_entries(F.map_filter(theirs, lambda k, v: ~F.coalesce(F.map_contains_key(ours, k), F.lit(False)))), F.map_entries(ours)))


def restore_absence(table: DataFrame, walks: DataFrame, scope: list[str]) -> DataFrame:
    """Absent rows whose scope has had no complete walk (``walked_at``) since they were last seen become active again."""
    last = walks.groupBy(*scope).agg(F.max("walked_at").alias("walked_at"))
    joined = table.join(last, scope, "left")
    unjust = (F.col("status") != "active") & (F.col("walked_at").isNull() | (F.to_date("walked_at") <= F.col("last_seen_at").cast("date")))
    return joined.select(*[F.when(unjust, "active").otherwise(F.col("status")).alias(c) if c == "status" else F.col(c) for c in table.columns])


def purge(table: DataFrame, verdicts: DataFrame, key: str) -> DataFrame:
    """Rows without those whose newest verdict (``seen_at``, ``excluded``) excludes them."""
    last = verdicts.groupBy(key).agg(F.max_by("excluded", "seen_at").alias("excluded")).filter("excluded")
    return table.join(last, key, "left_anti")


def unlocated(table: DataFrame) -> DataFrame:
    """Rows that still lack a house number but can be matched."""
    return table.filter("(house_number IS NULL OR house_number = '') AND street <> '' AND lat IS NOT NULL AND lon IS NOT NULL")
