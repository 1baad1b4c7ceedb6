"""Connected components by minimum labels; links never leave the executors.

Many links are joined in rounds over all executors, with pointer jumping. Up to ``LOCAL_LINKS`` of them (16 MB) are joined
by one task, since rounds over so few cost more in planning than in work. Both give the same labels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import cut

LOCAL_LINKS = 1 << 20


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the components of each a and b (in place); a label is the smallest member's number."""
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label[:] = label[label]


def _by_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    both = [np.concatenate(c) for c in zip(*((b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if len(b)), strict=True)]
    if both:
        ids, at = np.unique(np.concatenate(both), return_inverse=True)
        label = np.arange(len(ids))
        unite(label, *np.split(at, 2))
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[label])], names=["id", "label"])


def components(links: DataFrame) -> DataFrame:
    """(a, b) -> (id, label): the smallest id reachable from each linked id. Materialised in the shared folder.

    Each round takes the smallest label among neighbours and oneself, then that label's own label, so the number of rounds
    follows the logarithm of a component's diameter in practice. Labels only fall; the loop ends when a round changes none.
    """
    links = cut(links.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b").distinct())
    if links.count() <= LOCAL_LINKS:
        return cut(links.coalesce(1).mapInArrow(_by_one_task, "id long, label long"))
    pair = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")), F.struct("a", F.col("a").alias("b")), F.struct(F.col("b").alias("a"), "b")))
    edges = cut(links.select(pair.alias("e")).select("e.a", "e.b").distinct())
    labels = cut(edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("label")))
    while True:
        near = edges.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("next"), F.max(F.when(F.col("a") == F.col("b"), F.col("label"))).alias("was"))
        now = cut(near.join(labels.select(F.col("id").alias("next"), F.col("label").alias("far")), "next").select("id", F.col("far").alias("label"), (F.col("far") < F.col("was")).alias("fell")))
        labels = now.select("id", "label")
        if not now.filter("fell").limit(1).count():
            return labels
