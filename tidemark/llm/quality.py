"""Quality rules: word and line statistics, and language-specific perplexity bands.

A modified Kneser-Ney model of byte 5-grams is counted with Spark for each language, and held in sorted arrays with
hashed lookup. It learns from a reference: the texts that pass the plain rules and have at most ``MAX_SYMBOL_PERCENT``
symbols a hundred words, since a model that has read the noise finds it as likely as prose. Being outside the
reference rejects no text. Every text gets its log10 perplexity a symbol, and is rejected above the upper or below the lower edge of its language's
band. Edges come from the reference's quartiles: quartile -/+ ``spread`` times the quartile distance (at least ``floor``),
widened for short texts by ``1 + short / n_symbols``. Quartiles come from exact counts by 0.001 of log perplexity, so
they do not depend on how rows are dealt.

Null and empty texts have no words and fail the plain rules. A null language is a language of its own; one without
reference texts has no band, and its texts are judged by the plain rules alone. Repeated rows each get a row. Tables may
be empty; then the result is empty too. Columns of any name may stand beside: kept columns that are named like a result
give way to it in ``judge``, and ``keep_good`` returns all columns as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.bytegrams import COUNT_SCHEMA, Stream, emit, models, score_texts
from tidemark.llm.kneser_ney import build
from tidemark.llm.store import cut
from tidemark.llm.textkit import Chunk, KeyCounter, distinct_spans, fold_text, mix, named, sequence_hash

#: Context bytes of the perplexity model.
ORDER = 4
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: The reference's texts have at most so many symbols a hundred words.
MAX_SYMBOL_PERCENT = 10
#: Tags of languages are 16 bits; the last one is null.
MAX_LANGUAGES = 0xFFFF
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _repeated(keys: np.ndarray, places: np.ndarray, kinds: np.ndarray, doc: np.ndarray, window: int) -> np.ndarray:
    """Flags of the windows (their keys, and the places of their first words) that occur more than once in their document.

    Equal keys only propose; windows are equal if their documents and the kinds of their words are.
    """
    order = np.argsort(keys, kind="stable")
    alike = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
    a, b = places[order[alike]], places[order[alike + 1]]
    same = doc[a] == doc[b]
    for k in range(window):
        same &= kinds[a + k] == kinds[b + k]
    out = np.zeros(len(keys), bool)
    out[order[alike[same]]] = out[order[alike[same] + 1]] = True
    if not same.all():  # a collision may stand between equal windows: those with its key are told apart by words
        seen: dict[tuple, int] = {}
        for i in np.flatnonzero(np.isin(keys, keys[order[alike[~same]]])):
            words = (int(doc[places[i]]), *kinds[places[i] : places[i] + window].tolist())
            out[i] |= words in seen
            if words in seen:
                out[seen[words]] = True
            seen[words] = i
    return out


def statistics(chunk: Chunk, words: tuple[np.ndarray, np.ndarray, np.ndarray]) -> dict[str, np.ndarray]:
    """Plain per-document counts; see the contract of ``op6``."""
    starts, ends, doc = words
    buf, n = chunk.buf, chunk.n
    n_words = np.bincount(doc, minlength=n)
    letters = np.zeros(len(buf) + 1, np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=letters[1:])
    word_chars = np.bincount(doc, weights=letters[ends] - letters[starts], minlength=n).astype(np.int64)

    window = 5
    _, kinds = distinct_spans(buf, starts, ends)
    runs = sequence_hash(mix(kinds.astype(np.uint64) + np.uint64(1)), window)
    at = doc[: len(runs)]
    ok = at == doc[window - 1 :] if len(runs) else np.empty(0, bool)
    place = np.flatnonzero(ok)
    again = place[_repeated(runs[place] ^ mix(at[place].astype(np.uint64) + np.uint64(1)), place, kinds, doc, window)]
    mark = np.zeros(len(starts) + 1, np.int64)
    np.add.at(mark, again, 1)
    np.add.at(mark, again + window, -1)
    covered = np.cumsum(mark[:-1]) > 0
    n_repeat = np.bincount(doc[covered], minlength=n)

    stop = np.flatnonzero(buf == 0x0A)
    line_end = np.concatenate((stop, chunk.off[1:]))
    line_end.sort(kind="stable")
    line_start = np.empty_like(line_end)
    # A text's last line ends at the text's end; the line after a newline starts behind it.
    line_doc = np.searchsorted(stop, chunk.off, side="left")
    per = np.diff(line_doc) + 1
    of = np.repeat(np.arange(n), per)
    line_start[1:] = line_end[:-1] + 1
    first = np.concatenate(([0], np.cumsum(per)[:-1]))
    line_start[first] = chunk.off[:-1]
    solid = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    s, e, of = line_start[solid], line_end[solid], of[solid]
    lines, line_kind = distinct_spans(buf, s, e)
    _, once = np.unique(of * max(1, len(lines)) + line_kind, return_index=True)
    n_dup = np.bincount(of, minlength=n) - np.bincount(of[once], minlength=n)
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": chunk.count(_SYMBOL[buf]), "n_dup_lines": n_dup, "n_repeat_words": n_repeat, "base_failed": (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)}


def _is_reference(stats: dict[str, np.ndarray]) -> np.ndarray:
    """Texts that teach models and bands."""
    return ~stats["base_failed"] & (100 * stats["n_symbols"] <= MAX_SYMBOL_PERCENT * stats["n_words"])


def _tagger(df: DataFrame, lang_col: str) -> Callable[[pa.Array], np.ndarray]:
    """Tags of languages by their place in order, from the distinct values."""
    langs = df.select(named(lang_col).cast("string").alias("lang")).filter("lang IS NOT NULL").distinct().limit(MAX_LANGUAGES + 1).collect()
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"{lang_col} has more than {MAX_LANGUAGES} values")
    place = {x: k for k, x in enumerate(sorted(r[0] for r in langs))}
    return lambda values: np.array([MAX_LANGUAGES if x is None else place[x] for x in values.to_pylist()], np.uint64)


def perplexity_models(df: DataFrame, text_col: str, lang_col: str, tags: Callable) -> Iterator:
    """Kneser-Ney models (shards, usually one) of the reference texts."""

    def step(counter: KeyCounter, chunk: Chunk, rows: pa.RecordBatch):
        words = chunk.words()
        counter.add(Stream(chunk, words, ORDER, tags(rows.column(0))).select(_is_reference(statistics(chunk, words))))
        return emit(counter) if counter.full() else []

    counted = fold_text(df, text_col, KeyCounter, step, emit, COUNT_SCHEMA, [lang_col])
    return models(cut(counted.groupBy("key").agg(F.sum("n").alias("n"))), build, ORDER, continuation=True)


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_RESULTS = {f"q_{c}" for c in (*_COUNTS, "base_failed", "log_ppl", "length", "low", "high", "kept")}


def score_quality(df: DataFrame, text_col: str = "text", lang_col: str = "lang", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns and ``q_*`` statistics, ``q_log_ppl`` (log10 perplexity a symbol), ``q_length`` (symbols) and ``__lang``."""
    keep = [c for c in (keep if keep is not None else df.columns) if c.lower() not in {*_RESULTS, "__lang", "__body", "__band"}]
    source = df.select(*map(named, keep), named(lang_col).cast("string").alias("__lang"), named(text_col).alias("__body"))
    tags = _tagger(source, "__lang")

    def describe(chunk: Chunk, rows: pa.RecordBatch, words: tuple, stream: Stream) -> dict:
        return {f"q_{k}": v for k, v in statistics(chunk, words).items()} | {"q_length": np.diff(stream.off)}

    fields = [*(T.StructField(f"q_{c}", T.LongType()) for c in _COUNTS), T.StructField("q_base_failed", T.BooleanType()), T.StructField("q_length", T.LongType())]
    shards = perplexity_models(source, "__body", "__lang", tags)
    out = score_texts(source, "__body", [*keep, "__lang"], shards, ORDER, describe, fields, "q_log_ppl", lambda rows: tags(rows.column(len(keep))))
    return out.withColumn("q_log_ppl", -F.col("q_log_ppl") / F.col("q_length"))


def bands(scored: DataFrame, spread: float, floor: float) -> DataFrame:
    """``__band`` (language), ``q_low`` and ``q_high``, from all reference texts."""
    by_bin = scored.filter(~F.col("q_base_failed") & (100 * F.col("q_n_symbols") <= MAX_SYMBOL_PERCENT * F.col("q_n_words"))).groupBy("__lang", F.floor(F.col("q_log_ppl") * 1000).alias("bin")).agg(F.count("*").alias("n"))
    w = Window.partitionBy("__lang")
    ranked = by_bin.withColumn("upto", F.sum("n").over(w.orderBy("bin"))).withColumn("all", F.sum("n").over(w))
    quartile = lambda q: F.min(F.when(F.col("upto") >= F.col("all") * q, F.col("bin") + 0.5)) / 1000
    edges = ranked.groupBy("__lang").agg(quartile(0.25).alias("q1"), quartile(0.75).alias("q3"))
    margin = F.greatest(F.lit(floor), F.lit(spread) * (F.col("q3") - F.col("q1")))
    return edges.select(F.col("__lang").alias("__band"), (F.col("q1") - margin).alias("q_low"), (F.col("q3") + margin).alias("q_high"))


def judge(df: DataFrame, text_col: str = "text", lang_col: str = "lang", keep: list[str] | None = None, spread: float = 4.0, floor: float = 0.2, short: float = 60.0) -> DataFrame:
    """``score_quality`` with ``q_low``, ``q_high`` and the verdict ``q_kept``."""
    scored = cut(score_quality(df, text_col, lang_col, keep))
    # One short row a language, MAX_LANGUAGES at most; by language, a third of all texts would meet in one task.
    out = scored.join(F.broadcast(bands(scored, spread, floor)), F.col("__lang").eqNullSafe(F.col("__band")), "left").drop("__band", "__lang")
    slack = (F.col("q_high") - F.col("q_low")) / 2 * (F.lit(short) / F.col("q_length"))
    inside = F.col("q_log_ppl").between(F.col("q_low") - slack, F.col("q_high") + slack)
    return out.withColumn("q_kept", ~F.col("q_base_failed") & F.coalesce(inside, F.lit(True)))


def keep_good(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``df`` whose text is kept, with the columns of ``df``."""
    names = [f"c{k}" for k in range(len(df.columns))]
    text, lang = names[df.columns.index(text_col)], names[df.columns.index(lang_col)]
    return judge(df.toDF(*names), text, lang).filter("q_kept").select(*names).toDF(*df.columns)
