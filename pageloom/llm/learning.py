"""What the learned operators share: the sample of labelled rows, trees, isotonic calibration, factorisation machine."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bound on the labelled rows that a model is fitted on: the rows with the smallest hashes of their ids.
MAX_ROWS = 20_000


def labelled(docs: DataFrame, labels: DataFrame, label: str, max_rows: int = MAX_ROWS) -> DataFrame:
    """text, n_chars and y of at most max_rows labelled documents outside the held-out fifth.

    The ids of the sample, bounded by max_rows, are broadcast. Labels that are NULL or neither 0 nor 1 teach nothing. Of
    labels that share a doc_id the largest counts, of documents that do the one with the smallest text, so the bound holds.
    """
    rows = labels.where((F.crc32(F.col("doc_id").cast("string")) % 5 != 0) & F.col(label).isin(0, 1))
    rows = rows.groupBy("doc_id").agg(F.max(F.col(label).cast("double")).alias("y"))
    ids = rows.orderBy(F.xxhash64(F.col("doc_id"), F.lit(17)), "doc_id").limit(max_rows)
    cols = [c for c in ("text", "n_chars") if c in docs.columns]
    return docs.select("doc_id", *cols).join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min(F.struct(*cols)).alias("d"), F.max("y").alias("y")).select("doc_id", "d.*", "y")


class Trees:
    """Gradient-boosted trees for log loss, grown level by level on quantile bins; splits by gain."""

    def __init__(self, rounds: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 48, l2: float = 5.0, least: float = 3.0):
        self.rounds, self.depth, self.rate, self.bins, self.l2, self.least = rounds, depth, rate, bins, l2, least

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        n, d = x.shape
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) if n else np.zeros(0) for j in range(d)]
        # zeros stand apart from the rest however rare the rest is
        self.edges = [np.unique(np.concatenate([e, np.quantile(v, [0, 0.25, 0.5, 0.75])])) if len(v := x[x[:, j] > 0, j]) else e for j, e in enumerate(self.edges)]
        b = np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)], 1) if n else np.zeros((0, d), int)
        p = min(max(y.mean(), 1e-3), 1 - 1e-3) if n else 0.5
        self.base, self.trees = np.log(p / (1 - p)), []
        f = np.full(n, self.base)
        width = max((len(e) for e in self.edges), default=0) + 1
        for _ in range(self.rounds if n else 0):
            q = 1 / (1 + np.exp(-f))
            g, h = y - q, np.maximum(q * (1 - q), 1e-6)
            node, tree = np.zeros(n, np.int64), []
            for level in range(self.depth):
                k = 1 << level
                best = np.zeros(k), np.zeros(k, int), np.full(k, width)
                for j in range(d):
                    key = node * width + b[:, j]
                    gs, hs = (np.bincount(key, w, k * width).reshape(k, width).cumsum(1) for w in (g, h))
                    gt, ht = gs[:, -1:], hs[:, -1:]
                    gain = gs**2 / (hs + self.l2) + (gt - gs) ** 2 / (ht - hs + self.l2) - gt**2 / (ht + self.l2)
                    gain[(hs < self.least) | (ht - hs < self.least)] = 0
                    at = gain.argmax(1)
                    top = gain[np.arange(k), at]
                    better = top > best[0] + 1e-9
                    best[0][better], best[1][better], best[2][better] = top[better], j, at[better]
                tree.append((best[1], best[2]))
                node = 2 * node + (b[np.arange(n), best[1][node]] > best[2][node])
            leaves = 1 << self.depth
            value = self.rate * np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + self.l2)
            self.trees.append((tree, value))
            f += value[node]
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        b = np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)], 1)
        f, rows = np.full(len(x), self.base), np.arange(len(x))
        for tree, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for feature, cut in tree:
                node = 2 * node + (b[rows, feature[node]] > cut[node])
            f += value[node]
        return f


class Isotonic:
    """The rising step function nearest to the labels, joined by straight lines between the middles of its steps."""

    def fit(self, score: np.ndarray, y: np.ndarray) -> Isotonic:
        order = np.argsort(score, kind="stable")
        blocks: list[list[float]] = []  # sum of scores, sum of labels, rows
        for s, t in zip(score[order].tolist(), y[order].tolist(), strict=True):
            blocks.append([s, t, 1])
            while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
                s1, t1, n1 = blocks.pop()
                blocks[-1] = [blocks[-1][0] + s1, blocks[-1][1] + t1, blocks[-1][2] + n1]
        self.x = np.array([s / n for s, _, n in blocks] or [0.0])
        self.y = np.array([(t + 0.5) / (n + 1) if n < 2 else t / n for _, t, n in blocks] or [0.5])
        self.y = np.maximum.accumulate(self.y)
        return self

    def __call__(self, score: np.ndarray) -> np.ndarray:
        # a small share of the raw score keeps the order within a step
        return np.clip(0.99 * np.interp(score, self.x, self.y) + 0.01 / (1 + np.exp(-score)), 0, 1)


class FactorisationMachine:
    """w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j, with pairs summed in linear time as (square of sums - sum of squares) / 2."""

    def __init__(self, size: int, rank: int = 8, epochs: int = 6, rate: float = 0.15, l2: float = 1e-5, seed: int = 5):
        self.size, self.rank, self.epochs, self.rate, self.l2, self.seed = size, rank, epochs, rate, l2, seed

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> FactorisationMachine:
        """Adagrad over mini-batches of 128 rows of (indices, values); the rarer label weighs as much as the other, up to tenfold."""
        rng = np.random.default_rng(self.seed)
        self.w = np.zeros(self.size, np.float32)
        self.v = rng.normal(0, 0.02, (self.size, self.rank)).astype(np.float32)
        p = min(max(float(y.mean()), 1e-3), 1 - 1e-3) if len(y) else 0.5
        weight = np.where(y > 0.5, min(10, max(1, (1 - p) / p)), min(10, max(1, p / (1 - p)))).astype(np.float32)
        self.w0 = 0.0
        gw, gv = np.full(self.size, 1e-6, np.float32), np.full((self.size, self.rank), 1e-6, np.float32)
        for _ in range(self.epochs):
            for part in np.array_split(rng.permutation(len(y)), max(1, len(y) // 128)):
                if not len(part):
                    continue
                n = np.array([len(rows[i][0]) for i in part])
                idx, val = np.concatenate([rows[i][0] for i in part]), np.concatenate([rows[i][1] for i in part])
                at = np.concatenate([[0], np.cumsum(n)[:-1]])
                score, sums = self._score(idx, val, at)
                err = ((1 / (1 + np.exp(-score)) - y[part]) * weight[part]).astype(np.float32)
                e = np.repeat(err, n) * val
                dv = e[:, None] * (np.repeat(sums, n, 0) - self.v[idx] * val[:, None])
                order = np.argsort(idx, kind="stable")
                u, begin = np.unique(idx[order], return_index=True)
                dw, dv = np.add.reduceat(e[order], begin) / len(part), np.add.reduceat(dv[order], begin) / len(part)
                dw, dv = dw + self.l2 * self.w[u], dv + self.l2 * self.v[u]
                gw[u] += dw**2
                gv[u] += dv**2
                self.w[u] -= self.rate * dw / np.sqrt(gw[u])
                self.v[u] -= self.rate * 0.3 * dv / np.sqrt(gv[u])
                self.w0 -= self.rate * 0.1 * float(err.mean())
        return self

    def _score(self, idx, val, at):
        """Scores of the rows that begin at `at`, none of them empty, and the sums of v_i x_i."""
        xv = self.v[idx] * val[:, None]
        sums = np.add.reduceat(xv, at)
        pairs = 0.5 * (sums**2 - np.add.reduceat(xv * xv, at)).sum(1)
        return self.w0 + np.add.reduceat(self.w[idx] * val, at) + pairs, sums

    def raw(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        if not rows:
            return np.zeros(0)
        n = np.array([len(r[0]) for r in rows])
        return self._score(np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows]), np.concatenate([[0], np.cumsum(n)[:-1]]))[0]
