"""Approximate nearest neighbours by learned partitions.

A bounded sample's neighbour graph is cut into balanced parts (seeded balanced assignment, then moves that bring a
vector to the part most of its neighbours are in, while sizes stay within a margin). A softmax classifier learns each
vector's spread of neighbours over parts; an offset a part, raised or lowered until all rows of the table fall evenly,
keeps the parts balanced outside the sample too. It puts every row into its most probable part and routes each query to as many
of its most probable parts as reach ``RECALL`` on the sample, and on, until these hold enough candidates. Candidates are
reranked by exact Euclidean distance in double precision; ties go to the smaller id. A query that still finds fewer than ``k``
ids is asked of every part.

The number of parts grows with the root of the number of rows, up to ``MAX_PARTS``; the sample grows with it, up to
``SAMPLE``. Parts are split into blocks of ``BLOCK_ROWS`` rows and their queries into blocks of ``BLOCK_QUERIES`` by hash,
so a part that draws a third of all rows (equal vectors always fall together) costs more tasks, not larger ones.

Vectors that are null, empty, zero, or hold null or non-finite components take no part. Vectors of different lengths have
no distance, so each length is searched by itself. Ids are taken to be unique; an id that is repeated counts once, at its nearest row,
and is asked with one of its rows, the first in order. Null ids take no part. Tables may be empty, and a query without candidates has no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.store import cut
from tidemark.llm.textkit import named

#: Most vectors that the partition is learned from, and parts.
SAMPLE = 16_000
MAX_PARTS = 256
GRAPH = 10
RECALL = 0.97
BLOCK_ROWS = 16_384
BLOCK_QUERIES = 4096


def valid(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id`` and ``vec`` (array of double) of the rows that take part."""
    vec = F.col("vec")
    rows = df.select(named(id_col).cast("long").alias("id"), named(vec_col).cast("array<double>").alias("vec")).filter("id IS NOT NULL AND vec IS NOT NULL")
    finite = ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(finite & F.exists(vec, lambda x: x != 0))


def _distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Squared distances, by the inner-product form."""
    return np.maximum((q * q).sum(axis=1)[:, None] + (x * x).sum(axis=1) - 2 * (q @ x.T), 0)


def neighbours(x: np.ndarray, k: int) -> np.ndarray:
    out = np.empty((len(x), min(k, max(len(x) - 1, 0))), np.int64)
    for a in range(0, len(x) if out.shape[1] else 0, 512):
        d = _distances(x[a : a + 512], x)
        d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
        near = np.argpartition(d, out.shape[1] - 1, axis=1)[:, : out.shape[1]]
        out[a : a + len(d)] = near
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rng: np.random.Generator, margin: float = 1.1, rounds: int = 6) -> np.ndarray:
    """Part of each vector; no part holds more than ``margin`` times the mean."""
    room = int(np.ceil(margin * len(x) / parts))
    centres = x[rng.choice(len(x), parts, replace=False)]
    for _ in range(5):
        own = np.argmin(_distances(x, centres), axis=1)
        centres = np.array([x[own == p].mean(axis=0) if (own == p).any() else centres[p] for p in range(parts)])
    part, size = np.full(len(x), -1), np.zeros(parts, int)
    d = _distances(x, centres)
    for i in np.argsort(d.min(axis=1)):
        for p in np.argsort(d[i]):
            if size[p] < room:
                part[i], size[p] = p, size[p] + 1
                break
    back: list[list[int]] = [[] for _ in range(len(x))]
    for i, row in enumerate(graph):
        for j in row:
            back[j].append(i)
    links = [np.concatenate((row, np.array(b, np.int64))) for row, b in zip(graph, back, strict=True)]
    for _ in range(rounds):
        moved = 0
        for i in rng.permutation(len(x)):
            pull = np.bincount(part[links[i]], minlength=parts)
            p = int(np.argmax(np.where(size < room, pull, -1)))
            if pull[p] > pull[part[i]]:
                size[part[i]] -= 1
                size[p] += 1
                part[i] = p
                moved += 1
        if not moved:
            break
    return part


class Router:
    """Softmax over parts on standardised vectors with one hidden layer."""

    def __init__(self, x: np.ndarray, parts: int, seed: int = 3, hidden: int = 128, epochs: int = 40):
        rng = np.random.default_rng(seed)
        graph = neighbours(x, GRAPH)
        self.parts = parts = max(1, min(parts, len(x) // 4))
        part = balanced_parts(x, graph, parts, rng) if graph.shape[1] else np.zeros(len(x), int)
        target = np.zeros((len(x), parts))
        for k in range(graph.shape[1]):
            np.add.at(target, (np.arange(len(x)), part[graph[:, k]]), 1.0)
        np.add.at(target, (np.arange(len(x)), part), 1.0)
        target /= target.sum(axis=1, keepdims=True)
        self.mean, scale = x.mean(axis=0), x.std(axis=0)
        self.scale = np.where(scale > 0, scale, 1)
        z = self._scaled(x)
        self.w = [rng.normal(0, (1 / z.shape[1]) ** 0.5, (z.shape[1], hidden)), np.zeros(hidden), rng.normal(0, (1 / hidden) ** 0.5, (hidden, parts)), np.zeros(parts)]
        m, v, t = [np.zeros_like(a) for a in self.w], [np.zeros_like(a) for a in self.w], 0
        for _ in range(epochs):
            order = rng.permutation(len(z))
            for a in range(0, len(z), 256):
                rows = order[a : a + 256]
                h = np.maximum(z[rows] @ self.w[0] + self.w[1], 0)
                g = (self._softmax(h @ self.w[2] + self.w[3]) - target[rows]) / len(rows)
                gh = (g @ self.w[2].T) * (h > 0)
                t += 1
                for k, grad in enumerate((z[rows].T @ gh + 1e-4 * self.w[0], gh.sum(axis=0), h.T @ g + 1e-4 * self.w[2], g.sum(axis=0))):
                    m[k] = 0.9 * m[k] + 0.1 * grad
                    v[k] = 0.999 * v[k] + 0.001 * grad * grad
                    self.w[k] = self.w[k] - 2e-3 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
        self.offset, self._x, self._graph = np.zeros(parts), x, graph
        plain, best = self._logits(x), (len(x) + 1, self.offset)
        for turn in range(200):
            sizes = np.bincount((plain + self.offset).argmax(axis=1), minlength=parts)
            if sizes.max() < best[0]:
                best = (int(sizes.max()), self.offset.copy())
            self.lean(sizes, 1 / (1 + turn / 5))
        self.offset = best[1]

    def lean(self, sizes: np.ndarray, rate: float) -> None:
        """Moves offsets towards equal sizes."""
        self.offset -= rate * np.log((sizes + 1) / (sizes.mean() + 1))

    def settle(self) -> None:
        """As many parts as find RECALL of the sample's neighbours where the router itself puts them; the sample is let go."""
        chance = self.chances(self._x)
        own, rank = chance.argmax(axis=1), np.argsort(np.argsort(-chance, axis=1, kind="stable"), axis=1)
        found = np.sort(rank[np.arange(len(own))[:, None], own[self._graph]].ravel()) if self._graph.size else np.zeros(1, int)
        self.probes = int(found[min(len(found) - 1, int(np.ceil(RECALL * len(found))) - 1)]) + 1
        self._x = self._graph = None

    def part(self, x: np.ndarray) -> np.ndarray:
        return self.chances(x).argmax(axis=1)

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -20, 20)

    @staticmethod
    def _softmax(a: np.ndarray) -> np.ndarray:
        e = np.exp(a - a.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def chances(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of the parts, with the offsets that balance them."""
        return self._softmax(self._logits(x) + self.offset)

    def _logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(self._scaled(x) @ self.w[0] + self.w[1], 0) @ self.w[2] + self.w[3]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def build_router(rows: DataFrame, sample: int, parts: int) -> Router:
    """Fitted on the ``sample`` vectors of smallest id hash."""
    got = rows.orderBy(F.xxhash64("id"), "id", "vec").limit(sample).toArrow()
    return Router(_matrix(got.column("vec").combine_chunks()), parts)


_ASSIGNED = T.StructType([T.StructField("id", T.LongType()), T.StructField("vec", T.ArrayType(T.DoubleType())), T.StructField("part", T.IntegerType())])
_FOUND = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])
_RESULT = T.StructType([_FOUND[0], T.StructField("rank", T.IntegerType()), *_FOUND[1:]])


def _assigned(rows: DataFrame, router: Router) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(router)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(shared.value.part(_matrix(b.column(1))).astype(np.int32))], names=_ASSIGNED.names)

    return rows.select("id", "vec").mapInArrow(run, _ASSIGNED)


def _sizes(assigned: DataFrame, parts: int) -> np.ndarray:
    out = np.zeros(parts, np.int64)
    for p, n in assigned.groupBy("part").count().collect():
        out[p] = n
    return out


def _rerank(k: int):
    """The ``k`` nearest ids of a block of rows for each of a block of queries."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(_FOUND)

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(rows) or not len(queries):
            return schema.empty_table()
        ids, x = rows.column("id").to_numpy(), _matrix(rows.column("vec").combine_chunks())
        by_id = np.argsort(ids, kind="stable")
        ids, x = ids[by_id], x[by_id]
        own, first = np.unique(ids, return_index=True)
        last = np.append(first[1:], len(ids))
        q_ids, q = queries.column("id").to_numpy(), _matrix(queries.column("vec").combine_chunks())
        got: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for a in range(0, len(q), 64):
            # An id is as near as its nearest row; the exact distance decides among those that the product form lets through.
            d = np.minimum.reduceat(_distances(q[a : a + 64], x), first, axis=1)
            d[q_ids[a : a + 64, None] == own] = np.inf
            for i, row in enumerate(d):
                if len(row) > k:
                    edge = np.partition(row, k - 1)[k - 1]
                    near = np.flatnonzero(row <= edge + 1e-9 * (1 + edge + (q[a + i] ** 2).sum()))
                else:
                    near = np.arange(len(row))
                near = near[row[near] < np.inf]
                if not len(near):
                    continue
                size = last[near] - first[near]
                at = np.repeat(first[near] - np.cumsum(size) + size, size) + np.arange(size.sum())
                exact = np.minimum.reduceat(np.sqrt(((x[at] - q[a + i]) ** 2).sum(axis=1)), np.cumsum(size) - size)
                best = np.lexsort((own[near], exact))[:k]
                got.append((np.full(len(best), q_ids[a + i]), own[near][best], exact[best]))
        return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*got, strict=True)], schema=schema) if got else schema.empty_table()

    return run


def _nearest(assigned: DataFrame, sizes: np.ndarray, routed: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest ids of each routed query (``id``, ``vec``, ``part``) in its parts."""
    asked = _sizes(routed, len(sizes))
    blocks = lambda n, size: F.element_at(F.array(*[F.lit(int(max(1, -(-v // size)))) for v in n]), F.col("part") + 1)
    n_rows, n_queries = blocks(sizes, BLOCK_ROWS), blocks(asked, BLOCK_QUERIES)
    hashed = F.xxhash64("id")
    wanted = F.element_at(F.array(*[F.lit(bool(v)) for v in asked > 0]), F.col("part") + 1)
    left = assigned.filter(wanted).select("id", "vec", "part", F.pmod(hashed, n_rows).cast("int").alias("rb"), F.explode(F.sequence(F.lit(0), n_queries - 1)).alias("qb"))
    right = routed.select("id", "vec", "part", F.explode(F.sequence(F.lit(0), n_rows - 1)).alias("rb"), F.pmod(hashed, n_queries).cast("int").alias("qb"))
    keys = ["part", "rb", "qb"]
    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_rerank(k), _FOUND).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")).cast("int")
    return near.withColumn("rank", rank).filter(F.col("rank") <= k).select(*_RESULT.names)


def _search(rows: DataFrame, n: int, every: int, k: int, sample: int, parts: int | None) -> DataFrame:
    """Search over ``n`` rows of one length."""
    parts = parts or max(1, min(MAX_PARTS, round(n**0.5 / 10)))
    router = build_router(rows, min(sample, max(6000, 64 * parts)), parts)
    best = None
    for turn in range(4):
        sizes = _sizes(_assigned(rows, router), router.parts)
        if best is None or sizes.max() < best[0].max():
            best = sizes, router.offset.copy()
        if sizes.max() <= 1.2 * sizes.mean():
            break
        router.lean(sizes, 0.4 / (turn + 1))
    sizes, router.offset = best
    router.settle()
    assigned = _assigned(rows, router)
    shared = rows.sparkSession.sparkContext.broadcast(router)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            order = np.argsort(-shared.value.chances(_matrix(b.column(1))), axis=1, kind="stable")
            enough = (np.cumsum(sizes[order], axis=1) > k).argmax(axis=1) + 1
            enough[sizes.sum() <= k] = len(sizes)
            take = np.maximum(enough, shared.value.probes)
            flat = np.concatenate([o[:t] for o, t in zip(order, take, strict=True)])
            back = pa.array(np.repeat(np.arange(len(b)), take))
            yield pa.RecordBatch.from_arrays([b.column(0).take(back), b.column(1).take(back), pa.array(flat.astype(np.int32))], names=_ASSIGNED.names)

    queries = rows.filter(F.col("id") % every == 0).groupBy("id").agg(F.min("vec").alias("vec"))
    routed = cut(queries.mapInArrow(route, _ASSIGNED))
    found = cut(_nearest(assigned, sizes, routed, k))
    # Repeated ids may leave a query short of others; such ones are asked of every part.
    full = found.filter(F.col("rank") == k).select(F.col("query_id").alias("id"))
    short = routed.groupBy("id").agg(F.first("vec").alias("vec"), F.count("*").alias("asked")).filter(F.col("asked") < router.parts).drop("asked").join(full, "id", "left_anti")
    again = cut(short.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(router.parts - 1)))))
    if not again.limit(1).count():
        return found
    return found.join(again.select(F.col("id").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(_nearest(assigned, sizes, again, k))


def search(df: DataFrame, every: int = 100, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", sample: int = SAMPLE, parts: int | None = None) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` nearest found of every row whose id ``every`` divides.

    ``parts`` is chosen by the number of rows if it isn't given; with one part the search is exact.
    """
    rows = valid(df, id_col, vec_col)
    out = df.sparkSession.createDataFrame([], _RESULT)
    for d, n in sorted(rows.groupBy(F.size("vec")).count().collect()):
        out = out.unionByName(_search(rows.filter(F.size("vec") == d), n, every, k, sample, parts))
    return out


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the exact neighbours that are found, by distance: an equally near id counts as well."""
    want = exact.groupBy("query_id").agg(F.count("*").alias("want"), F.max("score").alias("edge"))
    hits = found.join(want, "query_id").filter(F.col("score") <= F.col("edge") + 1e-12).count()
    return hits / max(1, exact.count())
