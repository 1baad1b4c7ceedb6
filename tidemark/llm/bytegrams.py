"""Byte n-gram counts gathered with Spark, and the back-off lookups that language models on them share.

A text is read as its words (lower-cased A-Z) joined by one space and closed by an end symbol, after ``order`` start
symbols. A *gram* packs ``order`` context bytes and the next byte into the low ``8 * (order + 1)`` bits of a 64-bit key;
what is left above them may hold a 16-bit tag (of a language, say). Lower-order grams are the suffixes of the top ones,
so only top grams are ever counted from texts.

A model of more than ``MAX_ENTRIES`` top grams is built and broadcast in shards by the last two context bytes, one after
another: each scores the positions that fall into it in a pass of its own over the texts, and a text's score is the sum
over passes. So neither driver nor tasks ever hold more than one shard, whatever the corpus; what grows is the number of
passes. Grams of up to two context bytes (at most 2^24 a tag) are shared by all shards.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.store import cut
from tidemark.llm.textkit import IS_SPACE, LOWER, Chunk, HashIndex, KeyCounter, free_name, map_text, named, sum_by_key

SYMBOLS = 257
#: Top grams of a shard.
MAX_ENTRIES = 6_000_000


def level_mask(j: int, order: int) -> np.uint64:
    """Keeps the tag, ``j`` context bytes and the symbol of a top gram's key."""
    return np.uint64((1 << 64) - (1 << 8 * (order + 1)) | (1 << (8 * (j + 1))) - 1)


class Stream:
    """The symbols of a chunk's texts: ``keys`` of their top grams and ``off``, each text's first position (none is empty)."""

    def __init__(self, chunk: Chunk, words: tuple[np.ndarray, np.ndarray, np.ndarray], order: int, tags: np.ndarray | None = None):
        starts, ends, doc = words
        size = ends - starts
        n_words = np.bincount(doc, minlength=chunk.n)
        letters = np.bincount(doc, weights=size, minlength=chunk.n).astype(np.int64)
        self.off = np.concatenate(([0], np.cumsum(letters + np.maximum(n_words, 1))))
        pads = order * np.arange(1, chunk.n + 1)
        out = np.full(self.off[-1] + order * chunk.n, 0x20, np.uint8)
        for k in range(1, order + 1):
            out[self.off[:-1] + pads - k] = 0
        end = np.cumsum(size + 1)
        first = np.concatenate(([0], np.cumsum(n_words)))[:-1]
        before = np.concatenate(([0], end))
        begin = before[:-1] - before[first[doc]] + (self.off[:-1] + pads)[doc]
        solid = np.flatnonzero(~IS_SPACE[chunk.buf])
        out[solid + np.repeat(begin - starts, size)] = LOWER[chunk.buf[solid]]
        out[self.off[1:] + pads - 1] = 0x0A
        keys = out[order:].astype(np.uint64)
        for k in range(1, order + 1):
            keys |= out[order - k : len(out) - k].astype(np.uint64) << np.uint64(8 * k)
        length = np.diff(self.off)
        keep = np.arange(self.off[-1]) + np.repeat(order * np.arange(chunk.n), length)
        self.keys = keys[keep]
        if tags is not None:
            self.keys |= np.repeat(tags.astype(np.uint64) << np.uint64(8 * (order + 1)), length)

    def select(self, docs: np.ndarray) -> np.ndarray:
        """Keys of the flagged texts."""
        return self.keys[np.repeat(docs, np.diff(self.off))]


def emit(counter: KeyCounter, kind: int = 0) -> list[pa.RecordBatch]:
    keys, counts = counter.drain()
    return [pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int32)), pa.array(k.view(np.int64)), pa.array(c)], names=["kind", "key", "n"]) for k, c in ((keys[i : i + 500_000], counts[i : i + 500_000]) for i in range(0, len(keys), 500_000))]


COUNT_SCHEMA = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("key", T.LongType()), T.StructField("n", T.LongType())])


class Levels:
    """Sorted grams and counts by number of context bytes; ``continuation`` counts distinct extensions below the top."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, order: int, shared: tuple[np.ndarray, np.ndarray] | None, continuation: bool):
        self.order = order
        self.keys, self.counts = [None] * (order + 1), [None] * (order + 1)
        for j in range(order, -1, -1):
            if j == order:
                got = sum_by_key(keys, counts)
            elif j == 2 and shared is not None:
                got = shared
            else:
                above = self.keys[j + 1]
                got = sum_by_key(above & level_mask(j, order), np.ones(len(above), np.int64) if continuation else self.counts[j + 1])
            self.keys[j], self.counts[j] = got


class Table:
    """Values of sorted grams; ``find`` gives each key's row or -1."""

    def __init__(self, keys: np.ndarray):
        self.keys, self._index = keys, None

    def __getstate__(self) -> dict:
        return {"keys": self.keys, "_index": None}

    def find(self, keys: np.ndarray) -> np.ndarray:
        if self._index is None:
            self._index = HashIndex(self.keys)
        return self._index.find(keys)


def rows_of(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Row of each key, all of which are present."""
    return np.searchsorted(sorted_keys, keys)


def shard_of(keys: np.ndarray, shards: int, order: int) -> np.ndarray:
    """By tag and the last two context bytes."""
    x = (keys >> np.uint64(8)) & np.uint64(0xFFFF) | (keys & level_mask(-1, order))
    return ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % shards


def _shard_column(shards: int, order: int) -> Callable:
    def f(batches):
        for b in batches:
            keys = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(shard_of(keys, shards, order).astype(np.int32))], names=["key", "n", "shard"])

    return f


def _collected(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    table = df.toArrow()
    keys, n = table.column(0).to_numpy().astype(np.int64).view(np.uint64), table.column(1).to_numpy().astype(np.int64)
    return keys, n


def tally(counts: np.ndarray) -> np.ndarray:
    """Numbers of grams counted once, twice, three and four times."""
    return np.array([(counts == k).sum() for k in (1, 2, 3, 4)], np.int64)


def _tallies(grams: DataFrame, order: int, continuation: bool) -> dict[int, np.ndarray]:
    """``tally`` of the levels that shards hold in part (more than two context bytes), counted on the executors."""
    out, level = {}, grams.select("key", "n")
    for j in range(order, 2, -1):
        if j < order:
            n = F.count("*") if continuation else F.sum("n")
            level = level.groupBy(F.col("key").bitwiseAND(F.lit(int(level_mask(j, order).view(np.int64)))).alias("key")).agg(n.alias("n"))
        got = dict(level.filter("n <= 4").groupBy("n").count().collect())
        out[j] = np.array([got.get(k, 0) for k in (1, 2, 3, 4)], np.int64)
    return out


def models(grams: DataFrame, build: Callable, order: int, continuation: bool, max_entries: int | None = None) -> Iterator[tuple[int, int, object]]:
    """(shard, number of shards, ``build(levels, tallies)``) of ``grams`` (key, n), one at a time through the driver.

    ``grams`` must be materialised. The number of shards follows its size, so each model is bounded. ``tallies`` has the
    counts of counts of levels that a shard holds in part only.
    """
    shards = max(1, -(-grams.count() // (max_entries or MAX_ENTRIES)))
    if shards == 1:
        yield 0, 1, build(Levels(*_collected(grams), order, None, continuation), {})
        return
    mask = int(level_mask(2, order).view(np.int64))
    if continuation:
        third = grams.select(F.col("key").bitwiseAND(F.lit(int(level_mask(3, order).view(np.int64)))).alias("key")).distinct()
        low = third.groupBy(F.col("key").bitwiseAND(F.lit(mask)).alias("key")).agg(F.count("*").alias("n"))
    else:
        low = grams.groupBy(F.col("key").bitwiseAND(F.lit(mask)).alias("key")).agg(F.sum("n").alias("n"))
    shared, tallies = sum_by_key(*_collected(low)), _tallies(grams, order, continuation)
    part = grams.select("key", "n").mapInArrow(_shard_column(shards, order), T.StructType([T.StructField("key", T.LongType()), T.StructField("n", T.LongType()), T.StructField("shard", T.IntegerType())]))
    for s in range(shards):
        yield s, shards, build(Levels(*_collected(part.filter(F.col("shard") == s).select("key", "n")), order, shared, continuation), tallies)


def score_texts(df: DataFrame, text_col: str, keep: list[str], shards: Iterator[tuple[int, int, object]], order: int, describe: Callable, fields: list[T.StructField], score: str, tags: Callable | None = None) -> DataFrame:
    """``keep``, ``fields`` as ``describe(chunk, rows, words, stream)`` gives them, and ``score``: log10 probability of each text's symbols.

    ``tags(rows)`` gives each row's tag. Passes after the first one are joined by digests of text and tag, so they need
    neither unique ids nor rows that come in the same order again.
    """
    spark, out, parts = df.sparkSession, None, []
    names = [free_name(x, [*keep, *(f.name for f in fields), score]) for x in ("__k1", "__k2", "__part")]
    keys = [T.StructField(c, T.LongType()) for c in names[:2]]

    def prepared(chunk: Chunk, rows: pa.RecordBatch) -> tuple:
        tag = tags(rows) if tags else None
        words = chunk.words()
        return words, Stream(chunk, words, order, tag), tag

    def partial(stream: Stream, s: int, n: int, model) -> np.ndarray:
        if n == 1:
            return np.add.reduceat(model.value.score(stream.keys), stream.off[:-1])
        own = np.flatnonzero(shard_of(stream.keys, n, order) == s)
        got = np.zeros(len(stream.keys))
        got[own] = model.value.score(stream.keys[own])
        return np.add.reduceat(got, stream.off[:-1])

    def digests(chunk: Chunk, tag: np.ndarray | None) -> dict:
        got = [hashlib.blake2b(chunk.bytes_of(i) + (b"" if tag is None else int(tag[i]).to_bytes(2, "big")), digest_size=16).digest() for i in range(chunk.n)]
        both = np.frombuffer(b"".join(got), "<i8").reshape(-1, 2)
        return dict(zip(names[:2], both.T.copy(), strict=True))

    for s, n, built in shards:
        model = spark.sparkContext.broadcast(built)
        if s == 0:

            def first(chunk: Chunk, rows: pa.RecordBatch, model=model, n=n) -> dict:
                words, stream, tag = prepared(chunk, rows)
                return describe(chunk, rows, words, stream) | {score: partial(stream, 0, n, model)} | (digests(chunk, tag) if n > 1 else {})

            out = map_text(df, text_col, first, [*fields, T.StructField(score, T.DoubleType()), *(keys if n > 1 else [])], keep)
            if n == 1:
                return out
            out = cut(out)
        else:

            def later(chunk: Chunk, rows: pa.RecordBatch, model=model, s=s, n=n) -> dict:
                _, stream, tag = prepared(chunk, rows)
                return digests(chunk, tag) | {names[2]: partial(stream, s, n, model)}

            got = map_text(df, text_col, later, [*keys, T.StructField(names[2], T.DoubleType())], keep).select(*names)
            parts.append(cut(got.dropDuplicates(names[:2])))
        model.destroy()
    rest = functools.reduce(DataFrame.unionByName, parts).groupBy(*names[:2]).agg(F.sum(names[2]).alias(names[2]))
    return out.join(rest, names[:2]).withColumn(score, named(score) + named(names[2])).drop(*names)
