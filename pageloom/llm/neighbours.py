"""Approximate nearest neighbours: a balanced partition of a sample's neighbour graph, learnt by a small classifier that routes."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageloom.llm.work import Scratch, by_group, mark

#: Bound on the vectors that a partition and its classifier are fitted on; every vector is indexed.
SAMPLE = 8192
#: Rows that a part is meant to hold, parts of a level, rows of a block.
ROWS = 1000
MOST_PARTS = 256
BLOCK = 1024
#: Share of the neighbours of held-out vectors that must lie in the parts searched, by which the number of parts is chosen; how many
#: vectors are held out; parts that give the first bound on a query's scores.
TARGET, HELD_OUT, FIRST = 0.95, 1024, 4


def neighbour_graph(x: np.ndarray, k: int = 10) -> np.ndarray:
    """Row numbers of the k nearest others of each row by inner product, in blocks of rows."""
    n = len(x)
    k = min(k, n - 1)
    out = np.zeros((n, max(k, 0)), np.int64)
    for lo in range(0, n, 512):
        s = x[lo : lo + 512] @ x.T
        s[np.arange(len(s)), np.arange(lo, lo + len(s))] = -np.inf
        out[lo : lo + len(s)] = np.argpartition(-s, k - 1, 1)[:, :k] if k > 0 else 0
    return out


def balanced_partition(graph: np.ndarray, parts: int, seed: int = 3) -> np.ndarray:
    """Part of each vertex: the graph is halved again and again along its slowest mode, then ends of cut edges are swapped."""
    n, k = graph.shape
    rng, part = np.random.default_rng(seed), np.zeros(n, np.int64)

    def halve(at: np.ndarray, parts: int, first: int) -> None:
        part[at] = first
        if parts < 2 or len(at) < 2:
            return
        a = parts // 2
        inside = np.full(n, -1)
        inside[at] = np.arange(len(at))
        src, dst = np.repeat(np.arange(len(at)), k), inside[graph[at]].ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        src, dst = np.concatenate([src, dst]), np.concatenate([dst, src])
        degree = np.bincount(src, minlength=len(at)) + 1e-9
        v = rng.normal(size=len(at))
        for _ in range(40):
            v -= (v * degree).sum() / degree.sum()
            v = 0.5 * v + 0.5 * np.bincount(src, v[dst], len(at)) / degree
            v /= np.abs(v).max() + 1e-300
        left = np.zeros(len(at), bool)
        left[np.argsort(v, kind="stable")[: len(at) * a // parts]] = True
        for _ in range(8):
            pull = np.bincount(src, np.where(left[dst], 1.0, -1.0), len(at))
            gain = np.where(left, -pull, pull)
            l, r = (np.flatnonzero(m & (gain > 0)) for m in (left, ~left))
            m = min(len(l), len(r), max(1, len(at) // 20))
            if not m:
                break
            l, r = l[np.argsort(-gain[l], kind="stable")[:m]], r[np.argsort(-gain[r], kind="stable")[:m]]
            left[l], left[r] = False, True
        halve(at[left], a, first)
        halve(at[~left], parts - a, first + a)

    halve(np.arange(n), parts, 0)
    return part


class Router:
    """A classifier with one hidden layer: vector -> probabilities of the parts that hold its neighbours."""

    def fit(self, x: np.ndarray, target: np.ndarray, hidden: int = 64, steps: int = 600, seed: int = 7) -> Router:
        rng, (n, d), p = np.random.default_rng(seed), x.shape, target.shape[1]
        self.scale = float(np.sqrt((x * x).mean()) + 1e-12)
        w = [rng.normal(0, 1 / np.sqrt(d), (d, hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), (hidden, p)), np.zeros(p)]
        m, v = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
        for t in range(1, steps + 1):
            at = rng.integers(0, n, 512)
            b = x[at] / self.scale
            h = np.maximum(b @ w[0] + w[1], 0)
            z = h @ w[2] + w[3]
            q = np.exp(z - z.max(1, keepdims=True))
            dz = (q / q.sum(1, keepdims=True) - target[at]) / len(at)
            dh = (dz @ w[2].T) * (h > 0)
            for k, g in enumerate([b.T @ dh, dh.sum(0), h.T @ dz, dz.sum(0)]):
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.99 * v[k] + 0.01 * g * g
                w[k] -= 0.01 * min(1.0, 3 * (1 - t / steps) + 0.05) * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-8)
        self.w = w
        return self

    def __call__(self, x: np.ndarray) -> np.ndarray:
        w = self.w
        z = np.maximum(x / self.scale @ w[0] + w[1], 0) @ w[2] + w[3]
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


class Index:
    """Routers of one level, or of two: the parts of the first are parted again, each by a router of its own."""

    def __init__(self, first: Router | None, second: dict[int, Router]):
        self.first, self.second = first, second
        self.width = max([1, *(r.w[3].size for r in second.values())])

    def __len__(self) -> int:
        """Leaves, or rather their numbers."""
        return self.width * (1 if self.first is None else self.first.w[3].size)

    def likeliest(self, x: np.ndarray, probes: int) -> tuple[np.ndarray, np.ndarray]:
        """For each row the numbers of its likeliest leaves, best first, and their probabilities; -1 where there are fewer."""
        if self.first is None:
            return np.zeros((len(x), 1), np.int64), np.ones((len(x), 1))
        p = self.first(x)
        tops = min(p.shape[1], probes)
        top = np.argsort(-p, 1, kind="stable")[:, :tops]
        if not self.second:
            return top, np.take_along_axis(p, top, 1)
        leaf = np.full((len(x), tops * self.width), -1, np.int64)
        share = np.zeros(leaf.shape)
        for c in np.unique(top):
            row, nth = np.nonzero(top == c)
            q = self.second[c](x[row]) if c in self.second else np.ones((len(row), 1))
            for j in range(q.shape[1]):
                leaf[row, nth * self.width + j] = c * self.width + j
                share[row, nth * self.width + j] = p[row, c] * q[:, j]
        best = np.argsort(-share, 1, kind="stable")[:, :probes]
        return np.take_along_axis(leaf, best, 1), np.take_along_axis(share, best, 1)


def fit_router(x: np.ndarray, parts: int) -> Router:
    """A balanced partition of the rows' neighbour graph, learnt: a row's target is its part and the parts of its neighbours, half and half."""
    graph = neighbour_graph(x)
    part = balanced_partition(graph, parts)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 0.5 / graph.shape[1])
    target[np.arange(len(x)), part] += 0.5
    return Router().fit(x, target)


def parts_to_search(index: Index, held_out: np.ndarray, x: np.ndarray, k: int = 20) -> int:
    """The fewest likeliest parts of a held-out vector that together hold TARGET of its k nearest among x; all that index ranks if they don't.

    Nearest vectors of a sample are farther away than those of the whole table, so the share is rather too low than too high.
    """
    leaf = index.likeliest(x, 1)[0][:, 0]
    most, hits, k = min(MOST_PARTS, len(index)), np.zeros(MOST_PARTS, np.int64), min(k, len(x))
    for lo in range(0, len(held_out), 64):
        q = held_out[lo : lo + 64]
        ranked = index.likeliest(q, most)[0]
        near = leaf[np.argpartition(-(q @ x.T), k - 1, 1)[:, :k]]
        same = near[:, :, None] == ranked[:, None, :]
        found = same.any(2)
        hits += np.bincount(same.argmax(2)[found], minlength=MOST_PARTS)[:MOST_PARTS]
    share = np.cumsum(hits) / max(1, len(held_out) * k)
    return int(np.argmax(share >= TARGET)) + 1 if (share >= TARGET).any() else most


def _nearest(table: pa.Table, k: int) -> pa.Table:
    """The k nearest of each query of one block, by exact scores, that reach the query's bound. A query's number is the hash of its vector."""
    role = table["query"].to_numpy()
    ids, bound = table["vec_id"].to_numpy(), table["least"].to_numpy()
    flat = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(ids), -1)
    q, qi, bound = x[role], ids[role], bound[role]
    x, xi = x[~role], ids[~role]
    if not len(q) or not len(x):
        return None
    order = np.argsort(xi, kind="stable")
    x, xi = np.ascontiguousarray(x[order]), xi[order]
    out, n = [], min(k, len(x))
    for lo in range(0, len(q), 256):
        s = q[lo : lo + 256] @ x.T
        least = np.partition(s, len(x) - n, axis=1)[:, len(x) - n]
        row, c = np.nonzero(s >= (least - 1e-9 * np.maximum(1.0, np.abs(least)))[:, None])
        e = np.zeros(len(row))
        for j in range(x.shape[1]):  # from the first component to the last, so that equal vectors get equal scores everywhere
            e += q[lo + row, j] * x[c, j]
        best = np.lexsort((xi[c], -e, row))
        row, c, e = row[best], c[best], e[best]
        nth = np.arange(len(row)) - np.searchsorted(row, row, "left")
        few = (nth < n) & (e >= bound[lo + row])
        out.append((qi[lo + row[few]], xi[c[few]], e[few]))
    a, b, c = (np.concatenate(z) for z in zip(*out, strict=True))
    return pa.table({"same": a, "vec_id": b, "score": c})


def _vectors(df: DataFrame) -> DataFrame:
    """df's rows that take part, with `same`, a hash that stands for the vector."""
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = df.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where((F.size("v") > 0) & ~F.coalesce(bad, F.lit(True))).where(F.exists("v", lambda c: c != 0))
    return rows.withColumn("same", F.xxhash64("v"))


def _sample(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.xxhash64(F.col("vec_id"), F.lit(5)), "vec_id").limit(SAMPLE)


def _second_level(rows: DataFrame, first: Router, parts: int, n: int, work: Scratch) -> dict[int, Router]:
    """A router for each part of the first level, each fitted in a task of its own on at most SAMPLE of the part's rows."""
    spark, inner = rows.sparkSession, int(min(MOST_PARTS, -(-n // (parts * ROWS))))
    shared = spark.sparkContext.broadcast(first)

    def coarse(frames):
        for f in frames:
            yield f.assign(part=shared.value(np.stack(f.v.to_numpy())).argmax(1).astype("int64") if len(f) else np.zeros(0, "int64"))

    picked = rows.where(F.pmod(F.xxhash64("vec_id", F.lit(9)), F.lit(max(1, 4 * n // (parts * SAMPLE)))) == 0).select("v").mapInPandas(coarse, "v array<double>, part bigint")

    def fit(t: pa.Table) -> pa.Table | None:
        x = np.stack([np.asarray(v, float) for v in t["v"].to_pylist()[:SAMPLE]])
        if len(x) < 32:
            return None
        r = fit_router(x, int(max(2, min(inner, len(x) // 16))))
        flat = [np.float64(r.scale), *r.w]
        return pa.table({"part": t["part"][:1], "w": pa.array([np.concatenate([np.ravel(a) for a in flat]).tolist()], pa.list_(pa.float64()))})

    out, d = {}, first.w[0].shape[0]
    for row in work.save(by_group(picked, ["part"], fit, "part bigint, w array<double>"), "routers").collect():  # MOST_PARTS rows of a fixed size at most
        w, r = np.array(row["w"]), Router()
        h = first.w[0].shape[1]
        p = (len(w) - 1 - d * h - h) // (h + 1)
        cuts = np.cumsum([1, d * h, h, h * p])
        r.scale, r.w = float(w[0]), [a.reshape(s) for a, s in zip(np.split(w, cuts)[1:], [(d, h), (h,), (h, p), (p,)], strict=True)]
        out[int(row["part"])] = r
    return out


def nearest(vectors: DataFrame, is_query, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each query row, by inner product, ties to the smaller vec_id.

    Columns vec_id and embedding; NULL ids, and vectors that are NULL, empty, zero, of another length than most, or hold a
    NULL or non-finite component take no part. The rows are parted into parts of about ROWS rows, in two levels above
    MOST_PARTS of them. Each row lies in the part that the router finds likeliest. A query searches its likeliest parts, as many
    as hold TARGET of the neighbours of held-out vectors (few where vectors form clusters, most where they don't), and more
    until they hold k + 1 rows. The FIRST of them give a bound; of the others only what reaches it leaves its task. Parts are
    searched in blocks of about BLOCK rows. Equal vectors are searched for once and found by their k + 1 smallest ids, which
    changes no result, so a vector that fills a third of the table is as cheap as any. Repeated ids are candidates as often as
    they occur, but never of themselves; a query id that is there with several vectors gets the nearest to any of them. No
    rows give no rows. Other columns are not read.
    """
    spark, work = vectors.sparkSession, Scratch(vectors.sparkSession, "ann")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("query"))
    rows = _vectors(rows)
    size = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    dim, n = (int(size["d"]), int(size["n"])) if size else (1, 0)
    rows = rows.where(F.size("v") == dim)
    parts = int(max(1, min(MOST_PARTS, n // ROWS, SAMPLE // 16)))
    first, second, probes = None, {}, 1
    if parts > 1:
        x = np.array(_sample(rows.select("vec_id", "v")).toPandas().v.tolist(), float).reshape(-1, dim)
        held_out, x = x[-min(HELD_OUT, len(x) // 5) :], x[: -min(HELD_OUT, len(x) // 5)]
        first = fit_router(x, int(min(parts, max(2, len(x) // 16))))
        if n > 2 * MOST_PARTS * ROWS:
            second = _second_level(rows.select("vec_id", "v"), first, parts, n, work)
        probes = parts_to_search(Index(first, second), held_out, x, k)
    shared = spark.sparkContext.broadcast(Index(first, second))

    def index(frames):
        for f in frames:
            yield f.assign(part=shared.value.likeliest(np.stack(f.v.to_numpy()), 1)[0][:, 0] if len(f) else np.zeros(0, "int64"))

    # of equal vectors the k + 1 smallest ids are candidates
    often = work.save(rows.groupBy("same").agg(F.count("*").alias("n")).where(F.col("n") > k + 1).select("same"), "often")
    flagged = mark(work, rows.select("vec_id", "v", "same"), "same", often, "often-marks")
    few = flagged.where("_maybe").withColumn("nth", F.row_number().over(Window.partitionBy("same", "vec_id").orderBy("vec_id"))).where(F.col("nth") <= k)
    few = few.withColumn("nth", F.dense_rank().over(Window.partitionBy("same").orderBy("vec_id"))).where(F.col("nth") <= k + 1)
    kept = flagged.where("not _maybe").select("vec_id", "v").unionByName(few.select("vec_id", "v"))
    indexed = work.save(kept.mapInPandas(index, "vec_id bigint, v array<double>, part bigint"), "indexed")
    sizes = indexed.groupBy("part").agg(F.count("*").alias("n")).collect()  # at most MOST_PARTS * MOST_PARTS rows
    held = np.zeros(parts * shared.value.width, np.int64)
    for r in sizes:
        held[r["part"]] = r["n"]
    held_shared = spark.sparkContext.broadcast(held)

    def route(frames):
        held = held_shared.value
        for f in frames:
            if not len(f):
                continue
            ix = shared.value
            x, at, to = np.stack(f.v.to_numpy()), [], []
            most = probes
            open_ = np.arange(len(f))
            while len(open_):
                leaf = ix.likeliest(x[open_], most)[0]
                enough = np.where(leaf >= 0, held[leaf], 0).sum(1) > k
                done = np.ones(len(open_), bool) if leaf.shape[1] < most or most >= len(held) else enough
                for i, ls in zip(open_[done], leaf[done], strict=True):
                    ls = ls[ls >= 0]
                    at.append(np.full(len(ls), i))
                    to.append(ls)
                open_, most = open_[~done], 4 * most
            nth = np.concatenate([np.arange(len(x)) for x in at])
            at, to = np.concatenate(at), np.concatenate(to)
            live = held[to] > 0
            yield pd.DataFrame({"vec_id": f.vec_id.to_numpy()[at[live]], "v": f.v.to_numpy()[at[live]], "part": to[live], "nth": nth[live]})

    # one query for all that ask with an equal vector
    asked = rows.where("query").select(F.col("vec_id").alias("query_id"), "same").distinct()
    one = rows.where("query").select(F.col("same").alias("vec_id"), "v").dropDuplicates(["vec_id"])
    routed = work.save(one.mapInPandas(route, "vec_id bigint, v array<double>, part bigint, nth bigint"), "routed")
    asks = routed.groupBy("part").agg(F.count("*").alias("nq"))
    grid = indexed.groupBy("part").agg(F.count("*").alias("nd")).join(asks, "part").select("part", *[F.ceil(F.col(c) / BLOCK).cast("int").alias(c) for c in ("nd", "nq")])
    grid = work.save(grid, "grid")  # a row a part: at most MOST_PARTS * MOST_PARTS
    deal = lambda df, own, other: (  # noqa: E731  each row lies in one block of its own kind and meets all blocks of the other
        df.join(F.broadcast(grid), "part").withColumn(own, F.pmod(F.xxhash64("vec_id"), F.col("nd" if own == "db" else "nq"))).withColumn(other, F.explode(F.sequence(F.lit(0), F.col("nq" if own == "db" else "nd") - 1)))
    )
    cols = ["part", "db", "qb", "vec_id", "v"]
    data = deal(indexed, "db", "qb").select(*cols, F.lit(False).alias("query"), F.lit(0.0).alias("least"))
    # a query may find itself, as often as its id is repeated
    times = rows.groupBy("vec_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    top = k + min(k, int(times))

    def search(asks: DataFrame) -> DataFrame:
        """same, vec_id, score: the best of each query over the parts that it asks for."""
        wanted = asks.select("part").distinct()
        both = data.join(F.broadcast(wanted), "part", "left_semi").unionByName(deal(asks, "qb", "db").select(*cols, F.lit(True).alias("query"), "least"))
        return best(by_group(both, ["part", "db", "qb"], lambda t: _nearest(t, top), "same bigint, vec_id bigint, score double"))

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("nth", F.row_number().over(Window.partitionBy("same").orderBy(F.desc("score"), "vec_id"))).where(F.col("nth") <= top).drop("nth")

    early = work.save(search(routed.where(F.col("nth") < FIRST).withColumn("least", F.lit(float("-inf")))), "early")
    bound = early.groupBy(F.col("same").alias("vec_id")).agg(F.when(F.count("*") == top, F.min("score")).alias("least"))
    rest = routed.where(F.col("nth") >= FIRST).join(bound, "vec_id", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
    found = best(early.unionByName(search(rest)))
    pairs = asked.join(found, "same").where("query_id != vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
