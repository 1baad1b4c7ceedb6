"""N-gram Jaccard self-join of documents as a blocked sparse matrix product.

The matrix has a row for each distinct shingle set and a column for each shingle. Two sets of sizes ``m <= n`` that reach
the similarity ``t`` share a column among the first ``m - ceil(2t/(1+t) m) + 1`` of the smaller and the first
``n - ceil(t n) + 1`` of the larger one in any common order, so only those entries are dealt out, rare columns first.
Rarity comes from a counter sketch of fixed size, which steers the work and never the result.

The product is taken twice. First by blocks of columns, over a folded matrix: a row is the parity of its shingles in
a bounded number of bits, of which the differing ones never outnumber the shingles that two sets differ in, so pairs
beyond the size-derived bound are discarded and no link is. What is left joins rows into groups that no link leaves.
Then each group is multiplied out over whole sets: overlap counts are accumulated over blocks of its columns, and pairs
below the size-derived bound are discarded. Pairs stay inside a block's task; what leaves it is one label a row (and a
number of links), so copies are never expanded into pairs.

Columns and groups of more than ``BLOCK`` rows (``ENTRIES`` entries) are cut into row blocks. Every block meets the
first one; then only rows outside a column's or group's largest component meet all others, so a hot group costs in proportion to
its rows. Numbers of links need every pair of blocks, so they cost the square of a group's *different* texts, in
computing but not in rows.

Shingles are compared by 64-bit hashes. Equal sets are one row from the start, named by a 64-bit digest and told apart by
128 bits. Texts without words have an empty set and no links; null is empty. Rows with a null id are left out. Rows that
repeat an id are documents of their own. Tables may be empty; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.components import components, unite
from tidemark.llm.store import cut, give_back
from tidemark.llm.textkit import LOWER, Chunk, chunks, fold_text, free_name, hash_spans, mix, named, shingles

PERCENT = 80
#: Counters of the rarity sketch: 2 MB of 16-bit counts whatever the input.
SKETCH_BITS = 20
#: Rows and entries of a row block; a task holds two blocks of each.
BLOCK = 256
ENTRIES = 1 << 20
#: Bits of a folded row: two a shingle, within these bounds.
FOLD = (64, 1 << 14)
#: Bits of the largest bitmap of names (16 MB) that spares work in a scan.
NAME_BITS = 1 << 27
_PARTS = 64


def _chunk_sets(chunk: Chunk, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(document, sorted distinct shingle hashes) of the chunk's documents."""
    starts, ends, doc = chunk.words()
    h, doc = shingles(hash_spans(LOWER[chunk.buf], starts, ends), doc, chunk.n, width)
    cuts = np.searchsorted(doc, np.arange(chunk.n + 1))
    for d in range(chunk.n):
        yield d, np.unique(h[cuts[d] : cuts[d + 1]])


def _least(n: np.ndarray | int, num: int, den: int):
    """ceil(num/den * n)."""
    return -(-(n * num) // den)


def _digest(u: np.ndarray) -> tuple[int, np.uint64, np.uint64]:
    """Size and 128-bit digest of a set of distinct hashes; zeros for the empty set."""
    if not len(u):
        return 0, np.uint64(0), np.uint64(0)
    return len(u), mix(u * np.uint64(0xD6E8FEB86659FD93)).sum(), mix(u ^ np.uint64(0xA0761D6478BD642F)).sum()


def _signed(x: list | np.ndarray) -> np.ndarray:
    return np.array(x, np.uint64).view(np.int64)


def _source(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.filter(named(id_col).isNotNull()).select(named(id_col).cast("long").alias("id"), named(text_col).cast("string").alias("text"))


# --- sketches of fixed size -------------------------------------------------------------------------------------------

_PART = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("data", T.BinaryType())])


def _parts(state: np.ndarray) -> list[tuple[int, bytes]]:
    size = len(state) // _PARTS
    return [(k, zlib.compress(v.tobytes(), 1)) for k in range(_PARTS) if (v := state[k * size : (k + 1) * size]).any()]


def _part_batch(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()), pa.array([d for _, d in rows], pa.binary())], names=_PART.names)


def _gathered(parts: DataFrame, dtype: type, merge: Callable, size: int) -> np.ndarray:
    """All tasks' parts merged on the executors; the driver gets ``size`` numbers at most, whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(zlib.decompress(data), dtype)
                total[k] = merge(total[k], part) if k in total else part
        yield _part_batch([(k, zlib.compress(v.tobytes(), 1)) for k, v in total.items()])

    out, width = np.zeros(size, dtype), size // _PARTS
    for k, data in parts.select(*_PART.names).repartition(_PARTS, "part").mapInArrow(run, _PART).collect():
        out[k * width : (k + 1) * width] = np.frombuffer(zlib.decompress(data), dtype)
    return out


def _add16(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum(a.astype(np.uint32) + b, 0xFFFF).astype(np.uint16)


class Names:
    """A bitmap of hashed names with sixteen places a name up to ``NAME_BITS``; it may say yes too often, never no."""

    def __init__(self, names: DataFrame):
        size = min(NAME_BITS, max(1 << 16, 1 << (16 * names.count()).bit_length()))

        def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            state = np.zeros(size >> 3, np.uint8)
            for b in batches:
                at = self.place(b.column(0).to_numpy(zero_copy_only=False), size)
                np.bitwise_or.at(state, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
            yield _part_batch(_parts(state))

        self.bits = _gathered(names.mapInArrow(mark, _PART), np.uint8, np.bitwise_or, size >> 3)

    @staticmethod
    def place(names: np.ndarray, size: int) -> np.ndarray:
        return (mix(names.astype(np.int64).view(np.uint64).copy()) & np.uint64(size - 1)).astype(np.int64)

    def may_have(self, names: np.ndarray) -> np.ndarray:
        at = self.place(names, 8 * len(self.bits))
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


# --- scans over the texts ---------------------------------------------------------------------------------------------

_LIGHT = T.StructType([T.StructField("id", T.LongType()), *(T.StructField(c, T.LongType()) for c in ("n", "f1", "f2")), *_PART])


def shingle_sets(df: DataFrame, id_col: str, text_col: str, width: int) -> tuple[DataFrame, np.ndarray]:
    """(``id``, set size ``n``, set digest ``f1``, ``f2``) of every document, and the sketch: one pass over the texts."""
    size = 1 << SKETCH_BITS

    def batch(ids, n, f1, f2, part, data) -> pa.RecordBatch:
        kinds = (*(pa.int64(),) * 4, pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((ids, n, f1, f2, part, data), kinds, strict=True)], names=_LIGHT.names)

    def step(state: np.ndarray, chunk: Chunk, rows: pa.RecordBatch) -> list:
        got = []
        for _, u in _chunk_sets(chunk, width):
            got.append(_digest(u))
            np.add.at(state, (u >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), np.uint32(1))
        n, f1, f2 = zip(*got, strict=True)
        none = [None] * chunk.n
        return [batch(rows.column(0), n, _signed(f1), _signed(f2), none, none)]

    def finish(state: np.ndarray) -> Iterator[pa.RecordBatch]:
        got = _parts(np.minimum(state, 0xFFFF).astype(np.uint16))
        none = [None] * len(got)
        yield batch(none, none, none, none, [k for k, _ in got], [d for _, d in got])

    both = cut(fold_text(_source(df, id_col, text_col), "text", lambda: np.zeros(size, np.uint32), step, finish, _LIGHT, ["id"]))
    return both.filter("part IS NULL").select("id", "n", "f1", "f2"), _gathered(both.filter("part IS NOT NULL"), np.uint16, _add16, size)


def _prefix(u: np.ndarray, sketch: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The entries of a set that must be dealt out, rare ones first, and how many of them it needs as the smaller set."""
    key = sketch[(u >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(40) | u >> np.uint64(24)
    p = len(u) - _least(len(u), percent, 100) + 1
    near = np.flatnonzero(key <= np.partition(key, p - 1)[p - 1])
    return u[near[np.argsort(key[near], kind="stable")][:p]], len(u) - _least(len(u), 2 * percent, 100 + percent) + 1


_ENTRY = T.StructType([T.StructField("column", T.LongType()), T.StructField("row", T.LongType()), T.StructField("short", T.BooleanType())])


def shared_columns(df: DataFrame, sketch: np.ndarray, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """The columns (``column``) dealt out for two sets or more, for one of them as the smaller set. Materialised."""
    table = df.sparkSession.sparkContext.broadcast(sketch)

    def step(_, chunk: Chunk, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        column, row, short = [], [], []
        for _, u in _chunk_sets(chunk, width):
            if len(u):
                own, few = _prefix(u, table.value, percent)
                column.append(own)
                row.append(np.full(len(own), _digest(u)[1]))
                short.append(np.arange(len(own)) < few)
        if column:
            yield pa.RecordBatch.from_arrays([pa.array(_signed(np.concatenate(column))), pa.array(_signed(np.concatenate(row))), pa.array(np.concatenate(short))], names=_ENTRY.names)

    entries = fold_text(_source(df, id_col, text_col), "text", lambda: None, step, lambda _: iter(()), _ENTRY, ["id"])
    # Counted by partial extremes, so a column of copies, however many, leaves a task as one row.
    some = entries.groupBy("column").agg(F.min("row").alias("least"), F.max("row").alias("most"), F.max("short").alias("short"))
    return cut(some.filter("least < most AND short").select("column"))


_NODE = T.StructType([T.StructField("row", T.LongType()), T.StructField("n", T.LongType()), T.StructField("bits", T.BinaryType()), T.StructField("columns", T.ArrayType(T.LongType())), T.StructField("few", T.IntegerType())])


def _folded(u: np.ndarray) -> bytes:
    """Parity of the set's hashes in a power of two of bits."""
    size = min(FOLD[1], max(FOLD[0], 1 << (2 * len(u) - 1).bit_length()))
    at = (mix(u.copy()) & np.uint64(size - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=size).astype(np.uint8) & 1, bitorder="little").tobytes()


def folded_rows(df: DataFrame, sketch: np.ndarray, columns: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """A row for each set with entries in ``columns`` (or seemingly so): its size, folded row, those entries, and how many of them it needs as the smaller set."""
    table = df.sparkSession.sparkContext.broadcast((sketch, Names(columns)))

    def step(_, chunk: Chunk, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counts, names = table.value
        out = []
        for _, u in _chunk_sets(chunk, width):
            if len(u):
                own, few = _prefix(u, counts, percent)
                there = names.may_have(own.view(np.int64))
                if there.any():
                    out.append((_signed([_digest(u)[1]])[0], len(u), _folded(u), own[there].view(np.int64), int(there[:few].sum())))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.int32()), strict=True)], names=_NODE.names)

    return fold_text(_source(df, id_col, text_col), "text", lambda: None, step, lambda _: iter(()), _NODE, ["id"]).dropDuplicates(["row"])


def whole_sets(df: DataFrame, ids: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``row`` and ``entries`` (sorted hashes, as bytes) of the documents in ``ids``, and of few others."""
    wanted = df.sparkSession.sparkContext.broadcast(Names(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(wanted.value.may_have(batch.column(0).to_numpy(zero_copy_only=False))))
            for _, _, chunk in chunks(batch.column(1)):
                got = [(_signed([_digest(u)[1]])[0], u.tobytes()) for _, u in _chunk_sets(chunk, width)]
                yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in got], pa.int64()), pa.array([e for _, e in got], pa.binary())], names=["row", "entries"])
            give_back()

    return _source(df, id_col, text_col).mapInArrow(run, T.StructType([T.StructField("row", T.LongType()), T.StructField("entries", T.BinaryType())]))


# --- blocks -----------------------------------------------------------------------------------------------------------
# Rows to be multiplied stand in groups (``grp``) of ``k`` row blocks; a tile is what one task multiplies at once.


def _block() -> F.Column:
    return F.pmod(F.xxhash64("row"), F.col("k"))


def _star(rows: DataFrame) -> DataFrame:
    """Tiles of each block with the group's first one: two blocks a tile, rows in proportion."""
    at = F.when(_block() == 0, F.sequence(F.lit(0).cast("long"), F.col("k") - 1)).otherwise(F.array(_block()))
    return rows.withColumn("tile", F.explode(at)).withColumn("side", F.lit(0))


def _every_two(rows: DataFrame) -> DataFrame:
    """Tiles of every two blocks and of each by itself; ``side`` tells the blocks of a tile apart."""
    other = rows.withColumn("own", _block()).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)))
    tile = F.least("own", "other") * F.col("k") + F.greatest("own", "other")
    return other.withColumn("tile", tile).withColumn("side", (F.col("own") > F.col("other")).cast("int")).drop("own", "other")


def _rest(rows: DataFrame, labels: DataFrame) -> DataFrame | None:
    """Tiles of the rows outside their group's largest component with all of its blocks; None if there are none.

    ``rows`` (``grp``, ``row``, ``k``) are those of groups of several blocks.
    """
    if not rows.limit(1).count():
        return None
    told = rows.join(labels.select(F.col("id").alias("row"), "label"), "row", "left").withColumn("label", F.coalesce("label", "row"))
    sizes = told.groupBy("grp", "label").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("grp").agg(F.max_by("label", F.struct("size", "label")).alias("main"), F.sum("size").alias("all"), F.max("size").alias("most")).filter("most < all")
    open_ = cut(largest.select("grp", "main", F.ceil((F.col("all") - F.col("most")) / BLOCK).cast("long").alias("strays")))
    if not open_.limit(1).count():
        return None
    told = told.join(open_, "grp").withColumn("stray", F.col("label") != F.col("main"))
    part = F.pmod(F.xxhash64("row", F.lit(1)), F.col("strays"))
    every = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    met = told.select("grp", "row", F.explode(F.transform(every("strays"), lambda m: _block() * F.col("strays") + m)).alias("tile"))
    strays = told.filter("stray").select("grp", "row", F.explode(F.transform(every("k"), lambda b: b * F.col("strays") + part)).alias("tile"))
    return met.unionByName(strays).distinct().withColumn("side", F.lit(0))


def _dealt(tiles: DataFrame) -> DataFrame:
    """Tiles dealt to tasks by range, so that their number a task is even, and in order."""
    return tiles.repartitionByRange("grp", "tile").sortWithinPartitions("grp", "tile", "side", "n", "row")


_LINK = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _link_batch(rows: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
    off = np.flatnonzero(label != np.arange(len(label)))
    return pa.RecordBatch.from_arrays([pa.array(rows[off]), pa.array(rows[label[off]])], names=_LINK.names)


def _whole_tiles(batches: Iterator[pa.RecordBatch], keys: tuple[str, str], weight: str, limit: int) -> Iterator[pa.Table]:
    """Tables of whole tiles, each of about ``limit`` bytes in column ``weight`` or one tile."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        size += batch.column(batch.schema.get_field_index(weight)).nbytes
        if size >= limit:
            table = pa.Table.from_batches(held)
            g, t = (table.column(c).to_numpy() for c in keys)
            last = np.flatnonzero((g != g[-1]) | (t != t[-1]))
            if len(last):
                yield table.slice(0, last[-1] + 1)
                held = table.slice(last[-1] + 1).combine_chunks().to_batches()
                size = sum(b.column(b.schema.get_field_index(weight)).nbytes for b in held)
    if held:
        yield pa.Table.from_batches(held)


def _folded_product(percent: int) -> Callable:
    """Kernel over folded rows: links (a, b) of rows to a leader they may be linked with, over any number of steps."""

    def links(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        g, t, n, short = (table.column(c).to_numpy() for c in ("grp", "tile", "n", "short"))
        rows, node = np.unique(table.column("row").to_numpy(), return_inverse=True)
        data = table.column("bits").combine_chunks().cast(pa.large_binary())
        off = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
        raw = np.frombuffer(data.buffers()[2], np.uint8)
        bytes_ = np.diff(off)
        first = np.ones(len(g), bool)
        first[1:] = (g[1:] != g[:-1]) | (t[1:] != t[:-1])
        group, label = np.cumsum(first), np.arange(len(rows))
        for size in np.unique(bytes_):
            # The smaller row of a pair is ``size`` bytes wide, the larger one as wide or twice that, and folded once more.
            at = np.flatnonzero((bytes_ == size) | (bytes_ == 2 * size))
            folded = np.empty((len(at), size // 8), np.uint64)
            for wide in (1, 2):
                mine = np.flatnonzero(bytes_[at] == wide * size)
                bits = raw[off[at[mine]][:, None] + np.arange(wide * size)].view(np.uint64)
                folded[mine] = bits if wide == 1 else bits[:, : size // 8] ^ bits[:, size // 8 :]
            gg, nn, ss, vv, lead = group[at], n[at], short[at], node[at], bytes_[at] == size
            i = np.arange(len(at))
            for shift in range(1, len(at)):
                i = i[: np.searchsorted(i, len(at) - shift)]
                i = i[(gg[i] == gg[i + shift]) & (nn[i + shift] * percent <= nn[i] * 100)]
                if not len(i):
                    break
                j = i + shift
                try_ = lead[i] & (label[vv[i]] != label[vv[j]]) & (ss[i] | (ss[j] & (nn[i] == nn[j])))
                a, b = i[try_], j[try_]
                for k in range(0, len(a), 4096):
                    x, y = a[k : k + 4096], b[k : k + 4096]
                    both = nn[x] + nn[y]
                    near = np.bitwise_count(folded[x] ^ folded[y]).sum(axis=1, dtype=np.int64) <= both - 2 * _least(both, percent, 100 + percent)
                    unite(label, vv[x[near]], vv[y[near]])
        return _link_batch(rows, label)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_tiles(batches, ("grp", "tile"), "bits", 2 << 20):
            yield links(table)
            give_back()

    return run


def _overlaps(sets: list[np.ndarray], split: int) -> np.ndarray:
    """Overlap counts of the sets before ``split`` with those from it on (or among themselves, if none are), accumulated over blocks of columns."""
    n = len(sets)
    left, right = (slice(0, split), slice(split, n)) if split < n else (slice(0, n), slice(0, n))
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # Columns of one row add nothing.
    often = times > 1
    use = often[column]
    owner, column = owner[use], (np.cumsum(often) - 1)[column[use]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(range(*left.indices(n))), len(range(*right.indices(n)))), np.float32)
    step, total = max(1, (1 << 21) // n), int(often.sum())
    for c in range(0, total, step):
        a, z = np.searchsorted(column, (c, c + step))
        block = np.zeros((n, min(step, total - c)), np.float32)
        block[owner[a:z], column[a:z] - c] = 1
        out += block[left] @ block[right].T
    return out


_TOLD = T.StructType([T.StructField("row", T.LongType()), T.StructField("label", T.LongType()), T.StructField("links", T.LongType())])


def _exact_product(percent: int, pairs: bool = False) -> Callable:
    """Kernel over whole sets: each row's leader and number of links (in documents) in each tile, or all pairs of linked rows."""

    def product(row: np.ndarray, n: np.ndarray, copies: np.ndarray, side: np.ndarray, sets: list[np.ndarray]) -> pa.RecordBatch:
        split = int(np.searchsorted(side, 1))
        cross = split < len(row)
        near = (100 + percent) * _overlaps(sets, split).astype(np.int64) >= percent * (n[: split if cross else None, None] + n[None, split if cross else 0 :])
        if cross:
            links = np.concatenate((near @ copies[split:], copies[:split] @ near))
        else:
            np.fill_diagonal(near, False)
            links = near @ copies
        a, b = np.nonzero(near if cross else np.triu(near))
        b = b + split if cross else b
        if pairs:
            return pa.RecordBatch.from_arrays([pa.array(row[a]), pa.array(row[b])], names=_LINK.names)
        label = np.arange(len(row))
        unite(label, a, b)
        return pa.RecordBatch.from_arrays([pa.array(row), pa.array(row[label]), pa.array(links)], names=_TOLD.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_tiles(batches, ("grp", "tile"), "entries", 4 << 20):
            g, t, row, n, copies, side = (table.column(c).to_numpy() for c in ("grp", "tile", "row", "n", "copies", "side"))
            first = np.ones(len(g), bool)
            first[1:] = (g[1:] != g[:-1]) | (t[1:] != t[:-1])
            # Rows of repeated ids may bring one set several times.
            again = np.zeros(len(g), bool)
            again[1:] = ~first[1:] & (row[1:] == row[:-1]) & (side[1:] == side[:-1])
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for c in table.column("entries").chunks for x in c]
            edge = np.flatnonzero(first)
            for a, z in zip(edge, np.append(edge[1:], len(g)), strict=True):
                at = a + np.flatnonzero(~again[a:z])
                if len(at) > 1:
                    yield product(row[at], n[at], copies[at], side[at], [sets[i] for i in at])

    return run


# --- the join ---------------------------------------------------------------------------------------------------------

_DIGEST = ["f1", "f2", "n"]


def _groups(df: DataFrame, sketch: np.ndarray, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """(``row``, ``grp``): groups of two rows or more that no link leaves."""
    columns = shared_columns(df, sketch, id_col, text_col, width, percent)
    nodes = cut(folded_rows(df, sketch, columns, id_col, text_col, width, percent))
    entries = nodes.select("row", F.posexplode("columns").alias("pos", "column"), "few").select("column", "row", (F.col("pos") < F.col("few")).alias("short"))
    # A bitmap says yes too often; and of columns with the same rows one is enough.
    seen = F.xxhash64("row", "short")
    alike = entries.groupBy("column").agg(F.count("*").alias("rows"), F.bit_xor(seen).alias("s1"), F.bit_xor(F.xxhash64(seen, F.lit(1))).alias("s2"), F.max("short").alias("short"))
    kept = alike.filter("rows > 1 AND short").groupBy("rows", "s1", "s2").agg(F.min("column").alias("column"))
    kept = kept.select("column", F.ceil(F.col("rows") / BLOCK).cast("long").alias("k"))
    rows = cut(entries.join(kept, "column").withColumnRenamed("column", "grp"))
    full = nodes.select("row", "n", "bits")
    links = cut(_dealt(_star(rows).join(full, "row")).mapInArrow(_folded_product(percent), _LINK))
    labels = components(links)
    rest = _rest(rows.filter("k > 1").select("grp", "row", "k"), labels)
    if rest is not None:
        more = rest.join(rows.select("grp", "row", "short"), ["grp", "row"]).join(full, "row")
        labels = components(links.unionByName(_dealt(more).mapInArrow(_folded_product(percent), _LINK)))
    return labels.select(F.col("id").alias("row"), F.col("label").alias("grp"))


class _Join:
    """Classes of equal sets, and the rows of groups that are to be multiplied out."""

    def __init__(self, df: DataFrame, id_col: str, text_col: str, width: int, percent: int):
        self.percent = percent
        self.sets, sketch = shingle_sets(df, id_col, text_col, width)
        self.classes = cut(self.sets.filter("n > 0").groupBy(*_DIGEST).agg(F.min("id").alias("class"), F.count("*").alias("copies")))
        members = self.classes.select(F.col("f1").alias("row"), "n", "copies", "class").join(_groups(df, sketch, id_col, text_col, width, percent), "row")
        sizes = members.groupBy("grp").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / ENTRIES)).cast("long").alias("k"))
        self.members = cut(members.join(sizes, "grp"))
        self.entries = whole_sets(df, self.members.select("class"), id_col, text_col, width)

    def multiply(self, tiles: DataFrame, pairs: bool = False) -> DataFrame:
        full = tiles.join(self.entries, "row").select("grp", "tile", "side", "row", "n", "copies", "entries")
        return _dealt(full).mapInArrow(_exact_product(self.percent, pairs), _LINK if pairs else _TOLD)

    def told(self, count_links: bool) -> tuple[DataFrame, DataFrame]:
        """Components (``row``, ``label``) and what each tile counted (``row``, ``links``)."""
        rows = self.members.drop("class")
        told = cut(self.multiply((_every_two if count_links else _star)(rows)))
        links = lambda t: t.filter("row <> label").select(F.col("row").alias("a"), F.col("label").alias("b"))
        labels = components(links(told))
        rest = None if count_links else _rest(rows.filter("k > 1").select("grp", "row", "k"), labels)
        if rest is not None:
            more = self.multiply(rest.join(rows.select("grp", "row", "n", "copies"), ["grp", "row"]))
            labels = components(links(told).unionByName(links(more)))
        return labels.withColumnRenamed("id", "row"), told.select("row", "links")


def near_pairs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """All pairs (``a`` < ``b``) of different sets that reach the similarity, by their smallest ids, and the copies (``id``, ``class``).

    The pairs grow with the square of a group's number of different sets; ``near_duplicates`` gives none.
    """
    join = _Join(df, id_col, text_col, width, percent)
    found = join.multiply(_every_two(join.members.drop("class")), pairs=True)
    name = lambda c: join.members.select(F.col("row").alias(c), F.col("class").alias(f"{c}_id"))
    pairs = found.join(name("a"), "a").join(name("b"), "b").select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b"))
    copies = join.sets.join(join.classes.filter("copies > 1"), _DIGEST).filter("id <> class").select("id", "class")
    return pairs, copies


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = PERCENT, count_links: bool = False) -> DataFrame:
    """``id_col``, ``n_shingles`` and ``component_id``: the smallest id that links reach, the document's own included.

    With ``count_links`` also ``n_links``: the number of other documents linked with it, copies included.
    """
    join = _Join(df, id_col, text_col, width, percent)
    labels, counted = join.told(count_links)
    own = join.classes.join(labels.withColumnRenamed("row", "f1"), "f1", "left").withColumn("label", F.coalesce("label", "f1"))
    # Materialised, so that the join's sides are both exchanges and a large component's side can be split.
    low = cut(own.groupBy("label").agg(F.min("class").alias("component")))
    own = own.join(low, "label")
    if count_links:
        own = own.join(counted.groupBy(F.col("row").alias("f1")).agg(F.sum("links").alias("links")), "f1", "left")
        own = own.withColumn("links", F.coalesce("links", F.lit(0)) + F.col("copies") - 1)
    extra = ["links"] if count_links else []
    own = own.select(*_DIGEST, "component", *extra)
    # Texts without words would all meet in one key; they are documents by themselves.
    full = join.sets.filter("n > 0").join(own, _DIGEST)
    out = full.unionByName(join.sets.filter("n = 0").withColumn("component", F.col("id")).withColumns({c: F.lit(0).cast("long") for c in extra}))
    name = free_name("n_shingles", [id_col])
    return out.select(F.col("id").alias(id_col), F.col("n").alias(name), F.col("component").alias("component_id"), *(F.col(c).alias("n_links") for c in extra))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = PERCENT) -> DataFrame:
    """The rows of ``df`` with the smallest id of their component; rows with a null id stay.

    Rows of one id are kept or dropped by that id: it goes if it stands behind another one in any component.
    """
    found = near_duplicates(df, id_col, text_col, width, percent)
    other = free_name("__other", df.columns)
    others = found.filter(named(id_col) != F.col("component_id")).select(named(id_col).alias(other)).distinct()
    return df.join(others, named(id_col).cast("long") == F.col(other), "left_anti")
