"""Prediction by partial matching over byte contexts, pretrained on the corpus.

Counts of byte 6-grams form a context trie of depth 5. Escapes follow method D: a context seen ``n`` times with ``q``
distinct symbols gives a symbol seen ``c`` times (2c-1)/2n and the escape q/2n. On escape the symbols of the longer
context are excluded from the shorter one, whose counts and escape estimate shrink accordingly; below the empty context
the symbols not yet excluded are equally likely. The symbols of a context are all among those of its suffix, so what an
exclusion takes away is one number for each context, computed once when the model is built.

Each document's score is the log10 probability of its symbols: words (lower-cased A-Z) joined by single spaces, then an
end symbol. Words are ``[^\\x20\\x09-\\x0D]+``. Null and empty texts are the end symbol alone. Repeated rows each get a row,
with rows of one ``id_col`` held apart by position; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.bytegrams import COUNT_SCHEMA, SYMBOLS, Levels, Stream, Table, emit, level_mask, models, rows_of, score_texts
from tidemark.llm.store import cut
from tidemark.llm.textkit import LOWER, Chunk, KeyCounter, fold_text, hash_spans, named

#: Context bytes.
ORDER = 5
#: The commonest words whose counts go to every executor; counts of all others are joined.
HOT_WORDS = 1 << 18


class Ppm:
    def __init__(self, levels: Levels):
        order = self.order = levels.order
        self.grams, self.count, self.contexts, self.fresh, self.after = [], [], [], [], []
        totals = []
        with np.errstate(divide="ignore", invalid="ignore"):
            for j in range(order + 1):
                keys, c = levels.keys[j], levels.counts[j]
                ctx = keys >> np.uint64(8)
                first = np.flatnonzero(np.concatenate(([True], ctx[1:] != ctx[:-1]))) if len(ctx) else np.empty(0, np.int64)
                n = np.add.reduceat(c, first) if len(first) else np.empty(0, np.int64)
                q = np.diff(np.append(first, len(ctx)))
                totals.append((ctx[first], n, q))
                self.grams.append(Table(keys))
                self.count.append(np.log10(2 * c - 1))
                self.contexts.append(Table(ctx[first]))
                # Arrival without exclusions: log of the denominator and of the escape's share of it.
                self.fresh.append((np.log10(2 * n), np.log10(q)))
                # Arrival at the suffix by escape from this context: the same two, less what is excluded.
                if j:
                    taken = np.add.reduceat(levels.counts[j - 1][rows_of(levels.keys[j - 1], keys & level_mask(j - 1, order))], first) if len(first) else np.empty(0, np.int64)
                    up = rows_of(totals[j - 1][0], ctx[first] & (level_mask(j - 1, order) >> np.uint64(8)))
                    left, kinds = totals[j - 1][1][up] - taken, totals[j - 1][2][up] - q
                    self.after.append((np.log10(2 * left), np.log10(kinds), kinds == 0))
                else:
                    self.after.append(None)
        self.alphabet = np.log10(max(1, SYMBOLS - (int(totals[0][2][0]) if len(totals[0][2]) else 0)))
        self.empty = not len(totals[0][2])
        row_ctx = rows_of(totals[order][0], levels.keys[order] >> np.uint64(8))
        self.top = (self.count[order] - self.fresh[order][0][row_ctx]).astype(np.float32)

    def score(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of each top gram's symbol given its context."""
        if self.empty:
            return np.full(len(keys), -np.log10(SYMBOLS))
        row = self.grams[self.order].find(keys)
        out = np.where(row >= 0, self.top[row], 0).astype(np.float64)
        todo = np.flatnonzero(row < 0)
        child = np.full(len(todo), -1, np.int64)  # the longer context that was escaped from, -1 if none was known
        for j in range(self.order, -1, -1):
            if not len(todo):
                return out
            k = keys[todo] & level_mask(j, self.order)
            ctx = self.contexts[j].find(k >> np.uint64(8)).astype(np.int64)
            known, arrived = ctx >= 0, child >= 0
            total, escape = np.zeros(len(todo)), np.zeros(len(todo))
            f = known & ~arrived
            total[f], escape[f] = self.fresh[j][0][ctx[f]], self.fresh[j][1][ctx[f]]
            skip = np.zeros(len(todo), bool)
            if arrived.any():
                a = child[arrived]
                total[arrived], escape[arrived], skip[arrived] = self.after[j + 1][0][a], self.after[j + 1][1][a], self.after[j + 1][2][a]
            row = self.grams[j].find(k) if j < self.order else np.full(len(todo), -1)
            hit = row >= 0
            out[todo[hit]] += self.count[j][row[hit]] - total[hit]
            pay = ~hit & known & ~skip
            out[todo[pay]] += escape[pay] - total[pay]
            todo, child = todo[~hit], ctx[~hit]
        out[todo] -= self.alphabet
        return out


def build(levels: Levels, tallies: dict) -> Ppm:
    return Ppm(levels)


def _held_out(ids: pa.Array) -> np.ndarray:
    return np.array([zlib.crc32(b"" if x is None else str(x).encode()) % 7 == 2 for x in ids.to_pylist()], bool)


def _word_keys(chunk: Chunk, words: tuple) -> np.ndarray:
    return hash_spans(LOWER[chunk.buf], words[0], words[1])


def score_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, hot_words: int = HOT_WORDS) -> DataFrame:
    """Scores every text by a model of those whose CRC-32 of the id (as text, null: empty) mod 7 is not 2.

    ``id_col``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (add-one unigram model of words)
    and ``score`` (this model), both log10.
    """
    spark = df.sparkSession
    source = df.select(named(id_col).alias("id"), named(text_col).alias("text"))

    def gather(state: list, chunk: Chunk, rows: pa.RecordBatch):
        grams, words_seen, ends = state
        words, train = chunk.words(), ~_held_out(rows.column(0))
        grams.add(Stream(chunk, words, order).select(train))
        words_seen.add(_word_keys(chunk, words)[train[words[2]]])
        ends[0] += int(train.sum())
        for kind, counter in ((0, grams), (1, words_seen)):
            if counter.full():
                yield from emit(counter, kind)

    def flush(state: list):
        grams, words_seen, ends = state
        yield from emit(grams, 0)
        yield from emit(words_seen, 1)
        if ends[0]:
            yield pa.RecordBatch.from_arrays([pa.array([2], pa.int32()), pa.array([0]), pa.array(ends)], names=["kind", "key", "n"])

    gathered = fold_text(source, "text", lambda: [KeyCounter(), KeyCounter(), [0]], gather, flush, COUNT_SCHEMA, ["id"])
    counts = cut(gathered.groupBy("kind", "key").agg(F.sum("n").alias("n")))
    words = counts.filter("kind = 1").select("key", "n")
    total = {r.kind: (r.n, r.kinds) for r in counts.filter("kind > 0").groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect()}
    ends = total.get(2, (0, 0))[0]
    n_train, n_kinds = total.get(1, (0, 0))[0] + ends, total.get(1, (0, 0))[1] + (ends > 0)
    hot = words.orderBy(F.desc("n"), "key").limit(hot_words).toArrow()
    keys = hot.column(0).to_numpy().astype(np.int64).view(np.uint64)
    by_key = np.argsort(keys)
    hot_table = spark.sparkContext.broadcast((Table(keys[by_key]), hot.column(1).to_numpy().astype(np.int64)[by_key]))
    log_total = float(np.log10(n_train + n_kinds + 1))

    def describe(chunk: Chunk, rows: pa.RecordBatch, parts: tuple, stream: Stream) -> dict:
        doc = parts[2]
        index, count = hot_table.value
        key = _word_keys(chunk, parts)
        row = index.find(key)
        known, rare = row >= 0, row < 0
        n_words = np.bincount(doc, minlength=chunk.n)
        base = np.bincount(doc[known], weights=np.log10(count[row[known]] + 1.0), minlength=chunk.n)
        return {
            "held_out": _held_out(rows.column(0)),
            "n_tokens": n_words + 1,
            "hot_known": np.bincount(doc[known], minlength=chunk.n),
            "hot_base": base + np.log10(ends + 1.0) - log_total * (n_words + 1),
            "rare": pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.bincount(doc[rare], minlength=chunk.n)))), pa.int32()), pa.array(key[rare].view(np.int64))),
        }

    fields = [T.StructField("held_out", T.BooleanType()), *(T.StructField(c, T.LongType()) for c in ("n_tokens", "hot_known")), T.StructField("hot_base", T.DoubleType()), T.StructField("rare", T.ArrayType(T.LongType()))]
    grams = cut(counts.filter("kind = 0").select("key", "n"))
    scored = score_texts(source, "text", ["id"], models(grams, build, order, continuation=False), order, describe, fields, "score")
    scored = cut(scored.withColumn("__row", F.monotonically_increasing_id()))
    rare = scored.select("__row", F.explode("rare").alias("key")).groupBy("__row", "key").agg(F.count("*").alias("times"))
    found = rare.join(words, "key").groupBy("__row").agg(F.sum("times").alias("rare_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("rare_base"))
    out = scored.drop("rare").join(found, "__row", "left")
    return out.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("hot_known") + F.coalesce("rare_known", F.lit(0)) + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("hot_base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        "score",
    )
