"""Structured Streaming forms of the log derivations; event times must be timestamps with zone (cast NTZ first)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.operators.merge import REMOVED_AFTER_DAYS


def zoned(events: DataFrame, at: str) -> DataFrame:
    """Event time as TIMESTAMP, which watermarks need."""
    return events.withColumn(at, F.col(at).cast("timestamp"))


def _changed(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    price, status, known = state.get if state.exists else (None, None, False)
    rows = pd.concat(list(frames)).sort_values(["observed_at", "event_id"])
    out = []
    for r in rows.itertuples(index=False):
        now = price if pd.isna(r.price) else float(r.price)
        if not known or now != price or r.status != status:
            out.append((key[0], r.observed_at, None if pd.isna(r.price) else float(r.price), r.status))
        price, status, known = now, r.status, True
    state.update((price, status, known))
    yield pd.DataFrame(out, columns=["internal_id", "observed_at", "price", "status"])


def change_only(events: DataFrame) -> DataFrame:
    """The change-only log of a stream of (``internal_id``, ``observed_at``, ``event_id``, ``price``, ``status``)."""
    kind = events.schema["internal_id"].dataType.simpleString()
    return events.groupBy("internal_id").applyInPandasWithState(_changed, f"internal_id {kind}, observed_at timestamp, price double, status string", "price double, status string, known boolean", "append", GroupStateTimeout.NoTimeout)


def _absent(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    if state.hasTimedOut:
        (last,) = state.get
        state.remove()
        yield pd.DataFrame({"internal_id": [key[0]], "last_seen": [pd.Timestamp(last, unit="ms")], "status": ["removed"]})
        return
    seen = max(int(f["observed_at"].max().timestamp() * 1000) for f in frames)
    last = max(seen, state.get[0]) if state.exists else seen
    state.update((last,))
    state.setTimeoutTimestamp(max(last + REMOVED_AFTER_DAYS * 86_400_000, state.getCurrentWatermarkMs() + 1))


def removals(sightings: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Ids not seen for the removal period of event time."""
    kind = sightings.schema["internal_id"].dataType.simpleString()
    return sightings.withWatermark("observed_at", lateness).groupBy("internal_id").applyInPandasWithState(_absent, f"internal_id {kind}, last_seen timestamp, status string", "last long", "append", GroupStateTimeout.EventTimeTimeout)


def counts(events: DataFrame, at: str, by: list[str], length: str = "1 day", slide: str | None = None, lateness: str = "1 hour") -> DataFrame:
    """Tumbling or sliding counts, closed once the watermark passes."""
    return events.withWatermark(at, lateness).groupBy(F.window(at, length, slide), *by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *by, "n")


def once_a_day(events: DataFrame, at: str, by: list[str], lateness: str = "1 day") -> DataFrame:
    """The first event of each key and day."""
    return events.withColumn("day", F.to_date(at)).withWatermark(at, lateness).dropDuplicatesWithinWatermark([*by, "day"])


def append_by_month(events: DataFrame, path: str, checkpoint: str):
    """Late rows go to the month in which they arrive; no file is rewritten."""

    def write(batch: DataFrame, _: int) -> None:
        batch.withColumn("month", F.date_format(F.current_timestamp(), "yyyy-MM")).write.mode("append").partitionBy("month").parquet(path)

    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def each_batch(events: DataFrame, merge: Callable[[DataFrame, int], None], checkpoint: str):
    """Snapshot merges as micro-batches."""
    return events.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
