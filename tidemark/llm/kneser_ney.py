"""Interpolated modified Kneser-Ney model over byte n-grams, in sorted arrays with hashed lookup."""

from __future__ import annotations

import numpy as np

from tidemark.llm.bytegrams import SYMBOLS, Levels, Table, level_mask, rows_of, tally


def discounts(n: np.ndarray) -> np.ndarray:
    """Discounts of counts 1, 2 and 3 or more; where the counts of counts don't allow the formula, 0.5, 0.75 and 0.9."""
    if (n == 0).any():
        return np.array([0.5, 0.75, 0.9])
    y = n[0] / (n[0] + 2 * n[1])
    return np.clip([1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]], 0.05, [0.95, 1.9, 2.85])


class KneserNey:
    def __init__(self, levels: Levels, cuts: list[np.ndarray]):
        order = self.order = levels.order
        self.grams, self.logp, self.contexts, self.back = [], [], [], []
        below_keys = below_p = None
        for j in range(order + 1):
            keys, c = levels.keys[j], levels.counts[j]
            d = np.concatenate(([0.0], cuts[j]))
            kind = np.minimum(c, 3)
            ctx = keys >> np.uint64(8)
            first = np.flatnonzero(np.concatenate(([True], ctx[1:] != ctx[:-1]))) if len(ctx) else np.empty(0, np.int64)
            total = np.add.reduceat(c, first) if len(first) else np.empty(0)
            gamma = (np.add.reduceat(d[kind], first) if len(first) else np.empty(0)) / total
            of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(ctx))))
            lower = 1.0 / SYMBOLS if j == 0 else below_p[rows_of(below_keys, keys & level_mask(j - 1, order))]
            p = (c - d[kind]) / total[of] + gamma[of] * lower
            self.grams.append(Table(keys))
            self.logp.append(np.log10(p).astype(np.float32))
            self.contexts.append(Table(ctx[first]))
            self.back.append(np.log10(gamma).astype(np.float32))
            below_keys, below_p = keys, p

    def score(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of each top gram's symbol given its context."""
        row = self.grams[self.order].find(keys)
        out = np.where(row >= 0, self.logp[self.order][row], 0).astype(np.float64)
        todo = np.flatnonzero(row < 0)
        for j in range(self.order, -1, -1):
            if not len(todo):
                break
            k = keys[todo] & level_mask(j, self.order)
            if j < self.order:
                row = self.grams[j].find(k)
                hit = row >= 0
                out[todo[hit]] += self.logp[j][row[hit]]
                todo, k = todo[~hit], k[~hit]
            ctx = self.contexts[j].find(k >> np.uint64(8))
            out[todo[ctx >= 0]] += self.back[j][ctx[ctx >= 0]]
        out[todo] -= np.log10(SYMBOLS)
        return out


def build(levels: Levels, tallies: dict[int, np.ndarray]) -> KneserNey:
    """A model, or a shard of one with the discounts of the whole table, whose ``tallies`` it is given where it holds a level in part."""
    return KneserNey(levels, [discounts(tallies[j] if j in tallies else tally(c)) for j, c in enumerate(levels.counts)])
