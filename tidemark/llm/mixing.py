"""Mixing sources to target weights by hierarchical budgeting.

A tree (domain, language, source, say) splits a token budget by weights from the root down. No node gets more than its
subtree can give (tokens times ``max_epochs``); what a child cannot use goes to its siblings in proportion to their
weights, and only what all siblings together cannot use is left to the parent's siblings, because every node's limit is
known before its parent splits. Each leaf then takes whole passes over its documents, and of one more pass, in that
epoch's seeded order, the longest prefix of documents that fits.

Null labels are the label ``""``. Nodes without a stated weight weigh 1; weight 0 shuts a subtree. Documents without
tokens ride along where their place in the order falls inside the prefix. Rows with one id are ordered by the id alone
and kept or dropped together. Empty tables give empty results.

The tree has one row a leaf, never one a document; a leaf's order is cut into ``BUCKETS`` hash ranges whose token sums
place the boundary, so only documents of the boundary range are ever sorted, however large the leaf.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.store import cut
from tidemark.llm.textkit import Chunk, map_text

#: Hash ranges of a leaf: the first three hexadecimal digits.
BUCKETS = 4096


def with_tokens(df: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """The ``keep`` columns and ``n_tokens``, the number of words ``[^\\x20\\x09-\\x0D]+``."""

    def step(chunk: Chunk, rows: pa.RecordBatch) -> dict:
        return {"n_tokens": np.bincount(chunk.words()[2], minlength=chunk.n)}

    return map_text(df, text_col, step, [T.StructField("n_tokens", T.LongType())], keep)


def _weights(levels: list[str], weights: Mapping[tuple[str, ...], float]) -> F.Column:
    """The stated weight of the node that ``levels`` name, else 1."""
    out = F.lit(1.0)
    for path, weight in weights.items():
        if len(path) == len(levels):
            out = F.when(F.lit(True) if not path else _all([F.col(c) == v for c, v in zip(levels, path, strict=True)]), F.lit(float(weight))).otherwise(out)
    return out


def _all(conditions: list[F.Column]) -> F.Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def split_budget(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Adds ``share`` to rows of (``parent``, ``name``, weight, limit, budget): the parent's budget by weight, within limits.

    In order of limit/weight, a child is full exactly if the budget still covers all earlier limits and this ratio for
    everyone from here on.
    """
    family = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    before = family.orderBy("ratio", name).rowsBetween(Window.unboundedPreceding, -1)
    rated = children.withColumn("ratio", F.when(F.col("weight") > 0, F.col("limit") / F.col("weight")))
    rated = rated.filter("ratio IS NOT NULL")
    placed = rated.withColumn("given", F.coalesce(F.sum("limit").over(before), F.lit(0.0))).withColumn("open", F.sum("weight").over(family) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    full = placed.withColumn("full", F.col("given") + F.col("ratio") * F.col("open") <= F.col("budget"))
    left = F.col("budget") - F.sum(F.when(F.col("full"), F.col("limit")).otherwise(0.0)).over(family)
    share = F.when(F.col("full"), F.col("limit")).otherwise(left / F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(family) * F.col("weight"))
    return full.withColumn("share", share).drop("ratio", "given", "open", "full")


def plan(leaves: DataFrame, levels: list[str], weights: Mapping[tuple[str, ...], float], fraction: float, max_epochs: int) -> DataFrame:
    """(``levels``, n_tokens) of the leaves -> the same with ``budget`` (whole tokens) for each leaf."""
    nodes = {len(levels): leaves.withColumn("limit", F.col("n_tokens").cast("double") * max_epochs).withColumn("weight", _weights(levels, weights))}
    for d in range(len(levels) - 1, 0, -1):
        able = F.sum(F.when(F.col("weight") > 0, F.col("limit")).otherwise(0.0))
        nodes[d] = nodes[d + 1].groupBy(*levels[:d]).agg(able.alias("limit")).withColumn("weight", _weights(levels[:d], weights))
    total = leaves.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    level = nodes[1].withColumn("budget", F.lit(float(math.floor(total * fraction))))
    for d in range(1, len(levels) + 1):
        given = split_budget(level, levels[: d - 1], levels[d - 1])
        if d < len(levels):
            level = nodes[d + 1].join(given.select(*levels[:d], F.col("share").alias("budget")), levels[:d])
    return given.select(*levels, "n_tokens", F.floor(F.col("share") + 1e-6).cast("long").alias("budget"))


def mix_sources(df: DataFrame, levels: list[str], weights: Mapping[tuple[str, ...], float], fraction: float = 0.6, max_epochs: int = 2, seed: int = 17, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``levels``, ``n_tokens`` and ``copies`` (at least 1) of the documents chosen."""
    labels = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in levels]
    sized = cut(with_tokens(df.select(F.col(id_col), *labels, F.col(text_col).alias("__body")), "__body", [id_col, *levels]))
    leaves = cut(sized.groupBy(*levels).agg(F.sum("n_tokens").alias("n_tokens")))
    leaves = cut(plan(leaves, levels, weights, fraction, max_epochs))
    rule = leaves.filter("budget > 0 AND n_tokens > 0").select(*levels, F.floor(F.col("budget") / F.col("n_tokens")).cast("long").alias("passes"), (F.col("budget") % F.col("n_tokens")).alias("rest"))
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("passes").cast("string"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    keyed = sized.join(rule, levels).withColumn("place", order).withColumn("bucket", F.substring("place", 1, 3))
    ranges = keyed.groupBy(*levels, "bucket").agg(F.sum("n_tokens").alias("in_bucket"))
    w = Window.partitionBy(*levels).orderBy("bucket")
    ranges = ranges.withColumn("upto", F.sum("in_bucket").over(w)).select(*levels, "bucket", (F.col("upto") - F.col("in_bucket")).alias("before"), "upto")
    placed = keyed.join(ranges, [*levels, "bucket"])
    inner = Window.partitionBy(*levels).orderBy("place", id_col)
    clear = placed.filter("upto <= rest OR before > rest").withColumn("extra", (F.col("upto") <= F.col("rest")).cast("long"))
    edge = placed.filter("upto > rest AND before <= rest").withColumn("extra", (F.col("before") + F.sum("n_tokens").over(inner) <= F.col("rest")).cast("long"))
    out = clear.unionByName(edge).withColumn("copies", F.col("passes") + F.col("extra"))
    return out.filter("copies > 0").select(id_col, *levels, "n_tokens", "copies")


#: How ``documents`` are mixed: domains by the number that ends a source's name, and weights of nodes by path.
DOMAIN_SQL = "CASE WHEN try_cast(regexp_extract(source, '([0-9]+)$', 1) AS int) < 8 THEN 'web' WHEN try_cast(regexp_extract(source, '([0-9]+)$', 1) AS int) < 14 THEN 'books' WHEN try_cast(regexp_extract(source, '([0-9]+)$', 1) AS int) IS NOT NULL THEN 'forums' ELSE 'other' END"
LEVELS = ["domain", "lang", "source"]
DOMAINS = {"web": 5, "books": 3, "forums": 2}
LANGUAGES = {"en": 4, "de": 2, "fr": 2, "es": 2}
WEIGHTS = {(d,): w for d, w in DOMAINS.items()} | {(d, x): w for d in DOMAINS for x, w in LANGUAGES.items()}


def mix_documents(docs: DataFrame, fraction: float, max_epochs: int) -> DataFrame:
    """``mix_sources`` over ``documents`` with the mixture stated here."""
    source = docs.select("doc_id", "text", F.expr(DOMAIN_SQL).alias("domain"), "lang", "source")
    return mix_sources(source, LEVELS, WEIGHTS, fraction, max_epochs)
