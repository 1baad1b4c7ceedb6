"""Language identification by hierarchical discrimination.

Byte 2- and 3-grams of the lower-cased text are hashed into a fixed number of counts. Languages whose mean profiles lie
close form a family (average-link clustering of the labelled sample). One-versus-one linear support vector machines
first choose the family, then the language within it; votes decide, then summed margins, then the name.

The sample is bounded: about ``SAMPLE`` labelled texts a language at most and ``SAMPLE_ALL`` in all, chosen by a hash of the
id, so it does not depend on how rows are dealt. Texts that are null or hold no letter are ``und`` with score 0, as is
everything where no labelled text exists. Repeated rows each get a row; a table of more than ``MAX_LANGUAGES`` labels is
refused. Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.textkit import IS_SPACE, LOWER, Chunk, map_text

SAMPLE = 1000
SAMPLE_ALL = 12_000
#: More languages than this are refused: too few sampled texts would be left for each.
MAX_LANGUAGES = SAMPLE_ALL // 8
DIMS = 2048
_ROWS = 512
_FOLD = LOWER.copy()
_FOLD[IS_SPACE] = 0x20
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def features(chunk: Chunk) -> np.ndarray:
    """Square roots of n-gram counts by hash, each text's row of unit length."""
    out = np.zeros((chunk.n, DIMS), np.float32)
    half = DIMS // 2
    for a in range(0, chunk.n, _ROWS):
        z = min(chunk.n, a + _ROWS)
        buf = _FOLD[chunk.buf[chunk.off[a] : chunk.off[z]]].astype(np.uint32)
        off = chunk.off[a : z + 1] - chunk.off[a]
        doc = np.repeat(np.arange(z - a), np.diff(off))
        count = np.zeros((z - a) * DIMS)
        for width in (2, 3):
            n = len(buf) - width + 1
            if n <= 0:
                continue
            key = buf[:n].copy()
            for k in range(1, width):
                key = key << np.uint32(8) | buf[k : k + n]
            slot = ((key * np.uint32(0x9E3779B1)) >> np.uint32(32 - half.bit_length() + 1)).astype(np.int64) + half * (width - 2)
            same = doc[:n] == doc[width - 1 :]
            count += np.bincount(doc[:n][same] * DIMS + slot[same], minlength=len(count))
        rows = np.sqrt(count.reshape(z - a, DIMS))
        norm = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
        out[a:z] = rows / np.where(norm > 0, norm, 1)
    return out


def has_letter(chunk: Chunk) -> np.ndarray:
    plain = chunk.count(_LETTER[chunk.buf]) > 0
    for i in np.flatnonzero(~plain & (chunk.off[1:] > chunk.off[:-1])):
        plain[i] = any(c.isalpha() for c in chunk.text_of(i))
    return plain


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 4.0, rounds: int = 25, seed: int = 5) -> np.ndarray:
    """L2-loss linear SVM by dual coordinate descent; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    rng, alpha, w = np.random.default_rng(seed), np.zeros(len(x)), np.zeros(x.shape[1])
    norm = (x * x).sum(axis=1) + 0.5 / c
    for _ in range(rounds):
        for i in rng.permutation(len(x)):
            step = max(alpha[i] - (y[i] * (w @ x[i]) - 1 + 0.5 / c * alpha[i]) / norm[i], 0.0) - alpha[i]
            if step:
                alpha[i] += step
                w += step * y[i] * x[i]
    return w


class OneVersusOne:
    """Linear SVMs for all pairs of classes."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.classes = sorted(set(y.tolist()))
        self.pairs = [(a, b) for a in range(len(self.classes)) for b in range(a + 1, len(self.classes))]
        self.weights = []
        for a, b in self.pairs:
            own = (y == self.classes[a]) | (y == self.classes[b])
            self.weights.append(fit_svm(x[own], np.where(y[own] == self.classes[a], 1.0, -1.0)))

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each row's class, and a confidence between 0 and 1: the least of the winner's pairwise ones."""
        votes, sums = np.zeros((len(x), len(self.classes))), np.zeros((len(x), len(self.classes)))
        least = np.full((len(x), len(self.classes)), np.inf)
        for (a, b), w in zip(self.pairs, self.weights, strict=True):
            margin = x @ w[:-1] + w[-1]
            votes[:, a] += margin >= 0
            votes[:, b] += margin < 0
            for k, m in ((a, margin), (b, -margin)):
                sums[:, k] += m
                least[:, k] = np.minimum(least[:, k], m)
        best = np.argmax(votes + 1e-3 / (1 + np.exp(-np.clip(sums, -50, 50))), axis=1) if self.pairs else np.zeros(len(x), int)
        margin = least[np.arange(len(x)), best] if self.pairs else np.full(len(x), 50.0)
        return best, 1 / (1 + np.exp(-4 * np.clip(margin, -10, 10)))


def families(x: np.ndarray, y: np.ndarray) -> dict[str, int]:
    """Average-link clustering of languages by the cosine of their mean profiles, into about the root of their number."""
    names = sorted(set(y.tolist()))
    means = np.array([x[y == k].mean(axis=0) for k in names], np.float64)
    means -= means.mean(axis=0)
    norm = np.sqrt((means * means).sum(axis=1, keepdims=True))
    means /= np.where(norm > 0, norm, 1)
    near = means @ means.T
    groups = [[k] for k in range(len(names))]
    while len(groups) > max(1, round(len(names) ** 0.5)):
        _, a, b = max((near[np.ix_(p, q)].mean(), -i, -j) for i, p in enumerate(groups) for j, q in enumerate(groups) if i < j)
        groups[-a] += groups.pop(-b)
    return {names[k]: f for f, g in enumerate(groups) for k in g}


class Hierarchy:
    def __init__(self, x: np.ndarray, y: np.ndarray):
        of = families(x, y)
        family = np.array([of[k] for k in y.tolist()])
        self.top = OneVersusOne(x, family)
        self.within = [OneVersusOne(x[family == f], y[family == f]) for f in self.top.classes]

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        family, sure = self.top.predict(x)
        names, score = np.empty(len(x), object), np.zeros(len(x))
        for f, inner in enumerate(self.within):
            own = np.flatnonzero(family == f)
            if len(own):
                k, s = inner.predict(x[own])
                names[own] = np.array(inner.classes, object)[k]
                score[own] = s * sure[own]
        return names, score


def _bucket(id_col: str) -> F.Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4


def fit(df: DataFrame, id_col: str, text_col: str, lang_col: str) -> Hierarchy | None:
    """From labelled rows of which the CRC-32 of the id mod 4 is not 2."""
    labelled = df.filter((_bucket(id_col) != 2) & F.col(lang_col).isNotNull() & (F.length(text_col) > 0))
    counts = dict(labelled.groupBy(lang_col).count().limit(MAX_LANGUAGES + 1).collect())
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"{lang_col} has more than {MAX_LANGUAGES} values")
    if not counts:
        return None
    each = min(SAMPLE, SAMPLE_ALL // len(counts))
    share = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, each / n))])
    chance = F.pmod(F.xxhash64(F.lit("sample"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(1 << 20)) / float(1 << 20)
    chosen = labelled.filter(chance < share[F.col(lang_col)])

    def step(chunk: Chunk, rows: pa.RecordBatch) -> dict:
        x = features(chunk)
        return {"letters": has_letter(chunk), "x": [v.astype(np.float32).tobytes() for v in x]}

    got = map_text(chosen, text_col, step, [T.StructField("letters", T.BooleanType()), T.StructField("x", T.BinaryType())], [id_col, lang_col]).filter("letters").orderBy(id_col, lang_col, "x").toArrow()
    if not len(got):
        return None
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), np.float32).reshape(-1, DIMS)
    return Hierarchy(x, np.array(got.column(lang_col).to_pylist(), object))


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``id_col``, ``held_out``, ``lang_pred`` and ``score`` (0 to 1) of every whole text."""
    model = df.sparkSession.sparkContext.broadcast(fit(df.select(id_col, text_col, lang_col), id_col, text_col, lang_col))

    def step(chunk: Chunk, rows: pa.RecordBatch) -> dict:
        names, score = np.full(chunk.n, "und", object), np.zeros(chunk.n)
        if model.value is not None:
            own = has_letter(chunk)
            for a in range(0, chunk.n, 4 * _ROWS):
                z = min(chunk.n, a + 4 * _ROWS)
                part = Chunk(chunk.buf[chunk.off[a] : chunk.off[z]], chunk.off[a : z + 1] - chunk.off[a])
                k, s = model.value.predict(features(part))
                names[a:z], score[a:z] = np.where(own[a:z], k, "und"), np.where(own[a:z], s, 0.0)
        return {"lang_pred": names.tolist(), "score": score}

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return map_text(df, text_col, step, fields, [id_col]).select(id_col, (_bucket(id_col) == 2).alias("held_out"), "lang_pred", "score")
