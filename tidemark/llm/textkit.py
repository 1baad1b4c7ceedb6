"""Arrow-batched numpy text primitives: whole texts as bytes, words, hashes, per-document reductions.

Texts arrive as Arrow string columns; a *chunk* is a run of whole documents of about ``CHUNK_BYTES`` bytes
(one longer document makes a chunk of its own). All separators of the word pattern ``[^\\x20\\x09-\\x0D]+`` are
ASCII, so words can be cut on UTF-8 bytes. Null texts count as empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.store import give_back

CHUNK_BYTES = 1 << 20

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
#: Keeps the low 0 to 8 bytes of a little-endian block.
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Spans longer than this are hashed one by one.
_LONG_SPAN = 256


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (in place)."""
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


class Chunk:
    """Whole documents, concatenated: ``buf`` bytes and ``off`` of length n + 1."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        self.buf, self.off, self.n = buf, off, len(off) - 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte starts and ends of the words, and each word's document."""
        solid = ~IS_SPACE[self.buf]
        before = np.empty_like(solid)
        before[:1] = False
        before[1:] = solid[:-1]
        cut = self.off[:-1][self.off[:-1] < self.off[1:]]
        before[cut] = False
        starts = np.flatnonzero(solid & ~before)
        after = np.empty_like(solid)
        after[-1:] = False
        after[:-1] = solid[1:]
        after[cut[1:] - 1] = False
        ends = np.flatnonzero(solid & ~after) + 1
        return starts, ends, np.searchsorted(self.off, starts, side="right") - 1

    def bytes_of(self, i: int) -> bytes:
        return self.buf[self.off[i] : self.off[i + 1]].tobytes()

    def text_of(self, i: int) -> str:
        return self.bytes_of(i).decode("utf-8", "replace")

    def count(self, flags: np.ndarray) -> np.ndarray:
        """Per document, how many of its bytes are flagged."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.off[1:]] - total[self.off[:-1]]


def _blocks(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as one little-endian number; zeros follow the end."""
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[: len(buf)] = buf
    return np.ndarray((len(buf) + 1,), "<u8", padded, strides=(1,))


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span: its length and blocks of eight bytes, chained through a bijective mixer.

    Different spans of one length up to eight bytes never collide; longer ones do so as random 64-bit numbers do.
    """
    blocks, size = _blocks(buf), ends - starts
    out = mix(size.astype(np.uint64) * np.uint64(_BASE) + np.uint64(1))
    live = np.flatnonzero((size > 0) & (size <= _LONG_SPAN))
    at, left = starts[live], size[live]
    while len(live):
        out[live] = mix(out[live] ^ (blocks[at] & _KEEP[np.minimum(left, 8)]))
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(size > _LONG_SPAN):
        out[i] ^= np.uint64(int.from_bytes(hashlib.blake2b(buf[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little"))
    return out


def same_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, others: np.ndarray, other_ends: np.ndarray) -> np.ndarray:
    """Whether each span has the bytes of the other one."""
    blocks, size = _blocks(buf), ends - starts
    same = size == other_ends - others
    live = np.flatnonzero(same & (size > 0) & (size <= _LONG_SPAN))
    a, b, left = starts[live], others[live], size[live]
    while len(live):
        keep = _KEEP[np.minimum(left, 8)]
        equal = blocks[a] & keep == blocks[b] & keep
        same[live[~equal]] = False
        more = equal & (left > 8)
        live, a, b, left = live[more], a[more] + 8, b[more] + 8, left[more] - 8
    for i in np.flatnonzero(same & (size > _LONG_SPAN)):
        same[i] = np.array_equal(buf[starts[i] : ends[i]], buf[others[i] : other_ends[i]])
    return same


def distinct_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a span of each kind, kind of each span); spans are of one kind if their bytes are equal, whatever their hashes."""
    _, first, back = np.unique(hash_spans(buf, starts, ends), return_index=True, return_inverse=True)
    rep = first[back]
    check = np.flatnonzero(rep != np.arange(len(rep)))
    odd = check[~same_spans(buf, starts[check], ends[check], starts[rep[check]], ends[rep[check]])]
    if len(odd):
        kinds, more = {}, []
        for i in odd:
            key = buf[starts[i] : ends[i]].tobytes()
            if key not in kinds:
                kinds[key] = len(first) + len(more)
                more.append(i)
            back[i] = kinds[key]
        first = np.concatenate((first, np.array(more, first.dtype)))
    return first, back


def sequence_hash(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive values."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = h[:n].copy()
    for k in range(1, width):
        out *= np.uint64(_BASE)
        out ^= h[k : k + n]
        out ^= out >> np.uint64(31)
    return mix(out)


def shingles(words: np.ndarray, doc: np.ndarray, n_docs: int, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every ``width``-word shingle; a shorter text is one shingle, one without words none."""
    per = np.bincount(doc, minlength=n_docs)
    h = sequence_hash(words, width)
    at = doc[: len(h)]
    ok = at == doc[width - 1 :] if len(h) else np.empty(0, bool)
    h, at = h[ok], at[ok]
    first = np.concatenate(([0], np.cumsum(per)))
    short = np.flatnonzero((per > 0) & (per < width))
    if len(short):
        extra = np.empty(len(short), np.uint64)
        for k, d in enumerate(short):
            run = words[first[d] : first[d + 1]]
            extra[k] = (int(sequence_hash(run, len(run))[0]) + len(run) * _BASE) % (1 << 64)
        h, at = np.concatenate((h, mix(extra))), np.concatenate((at, short))
        order = np.argsort(at, kind="stable")
        h, at = h[order], at[order]
    return h, at


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Chunk]]:
    """(first row, row after the last, chunk) over an Arrow string column."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield i, j, Chunk(buf[off[i] : off[j]], off[i : j + 1] - off[i])
        i = j


def free_name(name: str, taken: list[str]) -> str:
    """A column name that no column in ``taken`` has, in any case."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def named(column: str) -> F.Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def _with_text(df: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """The ``keep`` columns by place (Arrow functions take no names with dots) and, last, the text."""
    return df.select(*(named(c).alias(f"c{k}") for k, c in enumerate(keep)), named(text_col).cast("string").alias("text"))


def map_text(df: DataFrame, text_col: str, fn: Callable[[Chunk, pa.RecordBatch], dict], fields: list[T.StructField], keep: list[str], limit: int = CHUNK_BYTES) -> DataFrame:
    """One row per input row: the ``keep`` columns, then ``fields`` as computed by ``fn(chunk, rows)``; ``rows`` go by place.

    Row-wise, so repeated ids stay repeated. Output fields must not clash with ``keep``; columns of ``df`` may have any name.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    source = _with_text(df, text_col, keep)
    schema = T.StructType([*source.schema[:-1], *(T.StructField(f"f{k}", f.dataType) for k, f in enumerate(fields))])
    kinds = [to_arrow_schema(T.StructType([f])).field(0).type for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, chunk in chunks(batch.column(len(keep)), limit):
                rows = batch.slice(i, j - i)
                new = fn(chunk, rows)
                made = [new[f.name] if isinstance(new[f.name], pa.Array) else pa.array(new[f.name], kind) for f, kind in zip(fields, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*(rows.column(k) for k in range(len(keep))), *made], names=schema.names)
            give_back()

    return source.mapInArrow(run, schema).toDF(*keep, *(f.name for f in fields))


def fold_text(df: DataFrame, text_col: str, new_state: Callable, step: Callable, finish: Callable, schema: T.StructType, keep: list[str]) -> DataFrame:
    """Per input partition: ``state = new_state()``, ``step(state, chunk, rows)`` (may yield batches), ``finish(state)`` yields batches."""
    source = _with_text(df, text_col, keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = new_state()
        for batch in batches:
            for i, j, chunk in chunks(batch.column(len(keep))):
                yield from step(state, chunk, batch.slice(i, j - i)) or ()
            give_back()
        yield from finish(state)

    return source.mapInArrow(run, schema)


class HashIndex:
    """Open-addressing table of distinct 64-bit keys; ``find`` gives each key's row or -1."""

    EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(len(keys) * 2).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys, self.rows = np.full(1 << bits, self.EMPTY), np.full(1 << bits, -1, np.int32)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.keys[slot] == self.EMPTY
            at, first = np.unique(slot[free], return_index=True)
            put = todo[free][first]
            self.keys[at], self.rows[at] = keys[put], put
            left = np.ones(len(todo), bool)
            left[np.flatnonzero(free)[first]] = False
            todo, slot = todo[left], (slot[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(_BASE)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        got = self.keys[slot]
        out = np.where(got == keys, self.rows[slot], np.int32(-1))
        todo = np.flatnonzero((got != keys) & (got != self.EMPTY))
        slot = slot[todo]
        while len(todo):
            slot = (slot + 1) & self.mask
            got = self.keys[slot]
            hit = got == keys[todo]
            out[todo[hit]] = self.rows[slot[hit]]
            go = ~hit & (got != self.EMPTY)
            todo, slot = todo[go], slot[go]
        return out


def sum_by_key(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sum of their counts (1 each if none are given)."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    if not len(keys):
        return keys, np.empty(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    if counts is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(counts, first)


class KeyCounter:
    """Counts 64-bit keys, merging as it grows; memory follows the number of distinct keys of a task, up to ``limit``."""

    def __init__(self, limit: int = 1_500_000):
        self.parts, self.size, self.limit = [], 0, limit

    def add(self, keys: np.ndarray) -> None:
        k, c = sum_by_key(keys)
        self.parts.append((k, c))
        self.size += len(k)
        if self.size > self.limit:
            self._merge()

    def _merge(self) -> None:
        if len(self.parts) > 1:
            k, c = sum_by_key(np.concatenate([p[0] for p in self.parts]), np.concatenate([p[1] for p in self.parts]))
            self.parts, self.size = [(k, c)], len(k)

    def full(self) -> bool:
        return self.size > self.limit

    def drain(self) -> tuple[np.ndarray, np.ndarray]:
        self._merge()
        k, c = self.parts[0] if self.parts else (np.empty(0, np.uint64), np.empty(0, np.int64))
        self.parts, self.size = [], 0
        return k, c
