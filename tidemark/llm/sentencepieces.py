"""SentencePiece encoding and decoding by a batched numpy Viterbi search.

Text is escaped as SentencePiece does it (identity normaliser, dummy prefix, space as the word mark), then cut before
each run of spaces; no piece crosses such a cut, so the best path of a text is that of its segments. Distinct segments
of equal byte length advance together: at each end position the hashes of all substrings up to the longest piece probe
the sorted piece keys, and vectorised maxima store back-pointers. A character that is no piece costs the lowest piece
score less 10 and is written as its byte pieces. The segmentation is the one of highest total score; ties go to the
longer last piece.

Null and empty texts encode to nothing; repeated rows each get a row. Decoding is exact for every text, except that a
literal word mark (U+2581) decodes to a space, which ``exact`` reports.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.textkit import CHUNK_BYTES, Chunk, distinct_spans, map_text, mix

_LONG = 192
_CELLS = 1 << 21
MARK = "▁"

# Substrings of short segments are hashed by differences of running sums; what a hash finds is compared byte by byte.
_BASE = 0x9E3779B97F4A7C15
_POWERS = np.array([pow(_BASE, k, 1 << 64) for k in range(_LONG + 1)], np.uint64)
_BACK = np.array([pow(_BASE, -k, 1 << 64) for k in range(_LONG + 1)], np.uint64)
_LETTERS = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def _running(rows: np.ndarray) -> np.ndarray:
    """Running sums of each row's letters, each times the power of its place."""
    total = np.zeros((rows.shape[0], rows.shape[1] + 1), np.uint64)
    np.cumsum(_LETTERS[rows] * _POWERS[: rows.shape[1]], axis=1, out=total[:, 1:])
    return total


def _substring_keys(sums: np.ndarray, at: int, width: int) -> np.ndarray:
    """Keys of the substrings of ``width`` bytes that start at ``at``, from the differences of running sums."""
    return mix(sums * _BACK[at] + np.uint64(width))


class Pieces:
    """Sorted piece keys with ids and scores, and each id's bytes."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        text, self.byte_id = [b""] * n, np.full(256, -1, np.int32)
        ids, scores = [], []
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                text[i], self.byte_id[value] = bytes([value]), i
            elif not (sp.is_control(i) or sp.is_unknown(i)):
                if MARK in piece.lstrip(MARK):
                    raise ValueError(f"piece {i} has a word mark inside")
                text[i] = piece.replace(MARK, " ").encode()
                ids.append(i)
                scores.append(sp.get_score(i))
        if (self.byte_id < 0).any():
            raise ValueError("the model has no byte pieces")
        size = np.array([len(text[i]) for i in ids])
        self.longest = int(size.max())
        if self.longest > _LONG:
            raise ValueError(f"a piece has more than {_LONG} bytes")
        letters = np.zeros((len(ids), self.longest), np.uint8)
        for row, i in enumerate(ids):
            letters[row, : size[row]] = np.frombuffer(text[i], np.uint8)
        sums = _running(letters)[np.arange(len(ids)), size]
        keys = mix(sums + size.astype(np.uint64))
        order = np.argsort(keys)
        if (keys[order][1:] == keys[order][:-1]).any():
            raise ValueError("two pieces have one key")
        self.keys, self.ids, self.scores, self.letters = keys[order], np.array(ids, np.int32)[order], np.array(scores, np.float64)[order], letters[order]
        self.unknown = float(min(scores)) - 10.0
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(keys >> np.uint64(44)).astype(np.int64)] = True
        lens = np.array([len(x) for x in text])
        self.bytes, self.offset = np.frombuffer(b"".join(text), np.uint8), np.concatenate(([0], np.cumsum(lens)))
        self._dict = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_dict": None}

    def probe(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the keys that are pieces, and their places among the sorted keys."""
        maybe = np.flatnonzero(self.filter[(keys >> np.uint64(44)).astype(np.int64)])
        at = np.searchsorted(self.keys, keys[maybe])
        at[at == len(self.keys)] = 0
        hit = self.keys[at] == keys[maybe]
        return maybe[hit], at[hit]

    def best(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For an n x L matrix of equally long segments: (ids, segment) in order of segment and position."""
        n, size = rows.shape
        total = _running(rows)
        score = np.full((n, size + 1), -np.inf)
        score[:, 0] = 0
        step, piece = np.zeros((n, size + 1), np.int32), np.full((n, size + 1), -1, np.int32)
        starts = (rows & 0xC0) != 0x80
        for end in range(1, size + 1):
            best = score[:, end]
            # A character is one to four bytes; where it is no piece it may stand as unknown.
            boundary = starts[:, end] if end < size else np.ones(n, bool)
            covered = np.zeros(n, bool)
            for width in range(min(end, self.longest), 0, -1):
                at = end - width
                live = np.flatnonzero(score[:, at] > -np.inf)
                if not len(live):
                    continue
                pos, key = self.probe(_substring_keys(total[live, end] - total[live, at], at, width))
                r = live[pos]
                same = (rows[r, at:end] == self.letters[key, :width]).all(axis=1)
                if not same.all():
                    pos, key, r = pos[same], key[same], r[same]
                value = score[r, at] + self.scores[key]
                gain = value > best[r]
                r, key = r[gain], key[gain]
                best[r], step[r, end], piece[r, end] = value[gain], width, self.ids[key]
                if width <= 4:
                    one = live[pos][starts[live[pos], at] & ~starts[live[pos], at + 1 : end].any(axis=1)]
                    covered[one] = True
            open_ = np.flatnonzero(boundary & ~covered)
            for width in range(min(end, 4), 0, -1):
                at = end - width
                r = open_[starts[open_, at] & ~starts[open_, at + 1 : end].any(axis=1) & (score[open_, at] > -np.inf)]
                value = score[r, at] + self.unknown
                gain = value > best[r]
                r = r[gain]
                best[r], step[r, end], piece[r, end] = value[gain], width, -1
        out_id, out_row, out_pos = [], [], []
        at, live = np.full(n, size), np.arange(n)
        while len(live):
            width, got = step[live, at[live]], piece[live, at[live]]
            begin = at[live] - width
            known = got >= 0
            out_id.append(got[known])
            out_row.append(live[known])
            out_pos.append(begin[known])
            for k in range(int(width[~known].max()) if (~known).any() else 0):
                r, p = live[~known], begin[~known] + k
                r, p = r[width[~known] > k], p[width[~known] > k]
                out_id.append(self.byte_id[rows[r, p]])
                out_row.append(r)
                out_pos.append(p)
            at[live] = begin
            live = live[begin > 0]
        ids, row, pos = np.concatenate(out_id), np.concatenate(out_row), np.concatenate(out_pos)
        order = np.lexsort((pos, row))
        return ids[order], row[order]

    def best_long(self, segment: bytes) -> np.ndarray:
        """The same search for one long segment, in time linear in its length."""
        if self._dict is None:
            self._dict = {bytes(self.bytes[self.offset[i] : self.offset[i + 1]]): (s, i) for i, s in zip(self.ids.tolist(), self.scores.tolist(), strict=True)}
        n, pieces = len(segment), self._dict
        score, step, piece = [0.0] + [-np.inf] * n, [0] * (n + 1), [-1] * (n + 1)
        for at in range(n):
            if score[at] == -np.inf:
                continue
            one = 1
            while at + one < n and segment[at + one] & 0xC0 == 0x80:
                one += 1
            for width in range(1, min(self.longest, n - at) + 1):
                got = pieces.get(segment[at : at + width])
                if got and score[at] + got[0] > score[at + width]:
                    score[at + width], step[at + width], piece[at + width] = score[at] + got[0], width, got[1]
            if segment[at : at + one] not in pieces and score[at] + self.unknown > score[at + one]:
                score[at + one], step[at + one], piece[at + one] = score[at] + self.unknown, one, -1
        out, at = [], n
        while at > 0:
            begin = at - step[at]
            out.append([piece[at]] if piece[at] >= 0 else [int(self.byte_id[b]) for b in segment[begin:at]])
            at = begin
        return np.array([i for x in reversed(out) for i in x], np.int32)

    def encode(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the chunk's texts, and each text's offset among them."""
        if not len(chunk.buf):
            return np.empty(0, np.int32), np.zeros(chunk.n + 1, np.int64)
        full = chunk.off[1:] > chunk.off[:-1]
        shift = np.cumsum(full)
        off = chunk.off + np.concatenate(([0], shift))
        buf = np.empty(off[-1], np.uint8)
        first = off[:-1][full]
        rest = np.ones(len(buf), bool)
        rest[first] = False
        buf[first], buf[rest] = 0x20, chunk.buf
        # A word mark that stands in the text itself is the same symbol as an escaped space.
        buf, off = _fold_marks(buf, off)
        first = off[:-1][full]
        space = buf == 0x20
        begin = space.copy()
        begin[1:] &= ~space[:-1]
        begin[first] = True
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], len(buf))
        one, back = distinct_spans(buf, starts, ends)
        s, size = starts[one], (ends - starts)[one]
        ids_of, seg_of = [], []
        order = np.argsort(size, kind="stable")
        at = 0
        while at < len(order):
            width = int(size[order[at]])
            stop = int(np.searchsorted(size[order], width, side="right"))
            if width > _LONG:
                for w in order[at:stop]:
                    got = self.best_long(buf[s[w] : s[w] + width].tobytes())
                    ids_of.append(got)
                    seg_of.append(np.full(len(got), w))
            else:
                block = max(1, _CELLS // (width + 1))
                for k in range(at, stop, block):
                    w = order[k : min(stop, k + block)]
                    got, row = self.best(buf[s[w][:, None] + np.arange(width)])
                    ids_of.append(got)
                    seg_of.append(w[row])
            at = stop
        ids, seg = np.concatenate(ids_of), np.concatenate(seg_of)
        by = np.argsort(seg, kind="stable")
        ids, count = ids[by], np.bincount(seg, minlength=len(one))
        base = np.concatenate(([0], np.cumsum(count)))
        take = count[back]
        end = np.cumsum(take)
        out = ids[np.repeat(base[back] - (end - take), take) + np.arange(end[-1])]
        total = np.concatenate(([0], end))
        return out, total[np.searchsorted(starts, off)]

    def decode(self, ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of each id run, without the dummy prefix, and their offsets."""
        size = (self.offset[1:] - self.offset[:-1])[ids]
        end = np.cumsum(size)
        total = np.concatenate(([0], end))
        buf = self.bytes[np.repeat(self.offset[ids] - (end - size), size) + np.arange(total[-1])]
        cut = total[off]
        full = cut[1:] > cut[:-1]
        rest = np.ones(len(buf), bool)
        rest[cut[:-1][full]] = False
        return buf[rest], cut - np.concatenate(([0], np.cumsum(full)))


def _fold_marks(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, b, c = MARK.encode()
    hit = np.flatnonzero((buf[:-2] == a) & (buf[1:-1] == b) & (buf[2:] == c)) if len(buf) > 2 else np.empty(0, np.int64)
    if not len(hit):
        return buf, off
    buf, keep = buf.copy(), np.ones(len(buf), bool)
    buf[hit] = 0x20
    keep[hit + 1] = keep[hit + 2] = False
    return buf[keep], np.concatenate(([0], np.cumsum(keep)))[off]


def encode(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``ids`` (array of int), ``n_tokens`` long, ``ids_sha256`` (of little-endian int32 ids), and ``exact``: decoding gives the text back."""
    pieces = Pieces(model)

    def step(chunk: Chunk, rows: pa.RecordBatch) -> dict:
        ids, off = pieces.encode(chunk)
        buf, cut = pieces.decode(ids, off)
        raw = ids.astype("<i4").tobytes()
        exact = [True] * chunk.n
        if len(buf) != len(chunk.buf) or (buf != chunk.buf).any():
            exact = [buf[cut[i] : cut[i + 1]].tobytes() == chunk.bytes_of(i) for i in range(chunk.n)]
        return {
            "ids": pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids, pa.int32())),
            "n_tokens": np.diff(off),
            "ids_sha256": [hashlib.sha256(raw[4 * a : 4 * z]).hexdigest() for a, z in zip(off[:-1], off[1:], strict=True)],
            "exact": exact,
        }

    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("exact", T.BooleanType())]
    # Segments repeat, so the search gains from larger chunks.
    return map_text(df, text_col, step, fields, [id_col], 4 * CHUNK_BYTES)


def decode(df: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col`` and the decoded ``text`` of each array of ids; a null array gives a null text."""
    pieces = Pieces(model)
    schema = T.StructType([df.schema[id_col], T.StructField("text", T.StringType())])

    def run(batches):
        for batch in batches:
            runs = batch.column(1)
            filled = [x if x is not None else [] for x in runs.to_pylist()]
            off = np.concatenate(([0], np.cumsum([len(x) for x in filled]))).astype(np.int64)
            buf, cut = pieces.decode(np.array([i for x in filled for i in x], np.int64), off)
            text = [None if v is None else buf[a:z].tobytes().decode("utf-8", "replace") for v, a, z in zip(runs.to_pylist(), cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string())], names=[id_col, "text"])

    return df.select(id_col, ids_col).mapInArrow(run, schema)
