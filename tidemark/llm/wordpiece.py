"""Greedy word-piece token counts by a linear longest-match automaton.

The vocabulary is a byte trie. Every node carries a failure link and the number of pieces that are popped when the
link is taken, so a word's greedy longest-match length comes from one left-to-right walk: no piece is ever built and
no byte is read twice. Words are ``[^\\x20\\x09-\\x0D]+``; word-initial pieces start with the word mark. A word that
greedy matching cannot cover counts as one unknown token.

Null and empty texts have no words and no tokens; repeated rows each get a row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.textkit import Chunk, HashIndex, distinct_spans, map_text

MARK = "▁".encode()
_LONG = 64


def read_pieces(path: str) -> list[bytes]:
    """Ordinary pieces of a SentencePiece model file or of a plain list, one a line (``##`` marks continuation)."""
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return [sp.id_to_piece(i).encode() for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    with open(path, encoding="utf-8") as f:
        lines = [x.rstrip("\n") for x in f]
    return [x[2:].encode() if x.startswith("##") else MARK + x.encode() for x in lines if x and not (x[0] == "[" and x[-1] == "]")]


class Automaton:
    """``fail`` and ``pops`` per trie node; ``tail``: pieces popped when a word ends at the node, -1 if it can't."""

    def __init__(self, pieces: list[bytes]):
        children: list[dict[int, int]] = [{}]
        is_piece = [False]
        for piece in pieces:
            at = 0
            for b in piece:
                nxt = children[at].get(b)
                if nxt is None:
                    nxt = children[at][b] = len(children)
                    children.append({})
                    is_piece.append(False)
                at = nxt
            if at:
                is_piece[at] = True
        n = len(children)
        fail, pops, tail = [-1] * n, [0] * n, [-1] * n
        tail[0] = 0
        level = [0]
        while level:
            below = []
            for u in level:
                for b, v in children[u].items():
                    below.append(v)
                    if is_piece[v]:
                        fail[v], pops[v] = 0, 1
                    else:
                        z, count = fail[u], pops[u]
                        while z >= 0 and b not in children[z]:
                            count, z = count + pops[z], fail[z]
                        if z >= 0:
                            fail[v], pops[v] = children[z][b], count
                    if fail[v] >= 0 and tail[fail[v]] >= 0:
                        tail[v] = pops[v] + tail[fail[v]]
            level = below
        edges = [(u << 8 | b, v) for u, c in enumerate(children) for b, v in c.items()]
        self.edge = np.array([e for e, _ in edges], np.uint64)
        self.child = np.array([v for _, v in edges], np.int32)
        self.fail, self.pops, self.tail = np.array(fail, np.int32), np.array(pops, np.int32), np.array(tail, np.int32)
        at = 0
        for b in MARK:
            at = children[at].get(b, -1) if at >= 0 else -1
        self.start = at
        self._index = self._dict = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_index": None, "_dict": None}

    def _step(self, state: np.ndarray, byte: np.ndarray, count: np.ndarray) -> np.ndarray:
        """One byte for every word; dead words are at -1."""
        if self._index is None:
            self._index = HashIndex(self.edge)
        out = np.full(len(state), -1, np.int32)
        todo = np.flatnonzero(state >= 0)
        now = state[todo]
        while len(todo):
            edge = self._index.find(now.astype(np.uint64) << np.uint64(8) | byte[todo].astype(np.uint64))
            hit = edge >= 0
            out[todo[hit]] = self.child[edge[hit]]
            todo, now = todo[~hit], now[~hit]
            count[todo] += self.pops[now]
            now = self.fail[now]
            todo, now = todo[now >= 0], now[now >= 0]
        return out

    def lengths(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Pieces of each word, -1 for words that can't be covered; words advance together."""
        size = ends - starts
        out = np.full(len(starts), -1, np.int64)
        order = np.argsort(-size, kind="stable")
        long = int(np.searchsorted(-size[order], -_LONG))
        for w in order[:long]:
            out[w] = self.length(buf[starts[w] : ends[w]].tobytes())
        order = order[long:]
        size, at = size[order], starts[order]
        state, count = np.full(len(order), self.start, np.int32), np.zeros(len(order), np.int64)
        for i in range(int(size[0]) if len(size) else 0):
            n = int(np.searchsorted(-size, -i))
            state[:n] = self._step(state[:n], buf[at[:n] + i], count[:n])
        alive = state >= 0
        tail = np.where(alive, self.tail[state], -1)
        out[order] = np.where(tail >= 0, count + tail, -1)
        return out

    def length(self, word: bytes) -> int:
        """The same for one word."""
        if self._dict is None:
            self._dict = dict(zip(self.edge.tolist(), self.child.tolist(), strict=True)), self.fail.tolist(), self.pops.tolist()
        edge, fail, pops = self._dict
        state, count = self.start, 0
        for b in word:
            if state < 0:
                return -1
            while (nxt := edge.get(state << 8 | b)) is None:
                count, state = count + pops[state], fail[state]
                if state < 0:
                    return -1
            state = nxt
        return -1 if state < 0 or self.tail[state] < 0 else count + int(self.tail[state])


def token_counts(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_words``, ``n_tokens`` and ``n_unknown`` (long) of every whole text."""
    automaton = Automaton(read_pieces(vocabulary))

    def step(chunk: Chunk, rows: pa.RecordBatch) -> dict:
        starts, ends, doc = chunk.words()
        first, back = distinct_spans(chunk.buf, starts, ends)
        pieces = automaton.lengths(chunk.buf, starts[first], ends[first])[back]
        unknown = pieces < 0
        tokens = np.bincount(doc, weights=np.where(unknown, 1, pieces), minlength=chunk.n).astype(np.int64)
        return {"n_words": np.bincount(doc, minlength=chunk.n), "n_tokens": tokens, "n_unknown": np.bincount(doc[unknown], minlength=chunk.n)}

    return map_text(df, text_col, step, [T.StructField(c, T.LongType()) for c in ("n_words", "n_tokens", "n_unknown")], [id_col])
