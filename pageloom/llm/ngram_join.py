"""N-gram Jaccard join by a token-group matrix: groups of similar documents, unions of their shingles, bounds, verification."""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.work import Memo, Scratch, by_group, byte_words, components, mark

SHINGLE = 4
#: Links of the op1 query: PERCENT * union <= 100 * intersection.
PERCENT = 85
#: Bounds: documents from which frequent shingles are learnt, how many are remembered, bits of the filter that holds them.
SAMPLE, FREQUENT, FILTER_BITS = 16_000, 1 << 18, 22
CHUNK = 64
POSTING = 256
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def shingler(size: int = SHINGLE):
    """text -> its distinct shingles as rising 64-bit hashes; a text with fewer words is one shingle, one without words none."""
    word = Memo(xxhash.xxh3_64_intdigest, 300_000).__getitem__

    def shingles(text: str | None) -> np.ndarray:
        words = byte_words(text)
        if not words:
            return np.zeros(0, np.uint64)
        h = np.fromiter(map(word, words), np.uint64, len(words))
        n = min(size, len(h))
        s = np.full(len(h) - n + 1, np.uint64(n))
        for k in range(n):
            s = (s ^ (s >> np.uint64(29 + k % 4))) * _MIX[k % 4] + h[k : len(h) - n + 1 + k]
        s = (s ^ (s >> np.uint64(32))) * _MIX[0]
        return np.unique(s ^ (s >> np.uint64(29)))

    return shingles


def width(n: int) -> int:
    """Bits of the row that n shingles take in the matrix: a power of two, at least one bit a shingle."""
    return max(256, 1 << max(0, int(n) - 1).bit_length())


def matrix_row(s: np.ndarray, bits: int) -> np.ndarray:
    row = np.zeros(bits, bool)
    row[(s & np.uint64(bits - 1)).astype(np.int64)] = True
    return row


def need(n, m, percent: int = PERCENT):
    """Smallest intersection of sets of n and m shingles that links."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """Two linked sets share one of the first so many shingles of each, in any order that both follow."""
    return n - -(-percent * n // 100) + 1


def _learn_frequent(docs: DataFrame, size: int) -> np.ndarray:
    """Filter of shingles that several sampled documents hold. It only sets the order in which prefixes are taken: any filter is right."""
    key = F.xxhash64(F.col("doc_id"), F.lit(3))
    edge = docs.select(key.alias("k")).orderBy("k").limit(SAMPLE).agg(F.max("k")).first()[0]
    bits = np.zeros(1 << FILTER_BITS, bool)
    if edge is None:
        return np.packbits(bits)

    def run(frames):
        shingles = shingler(size)
        for f in frames:
            s = [shingles(t) for t in f.text]
            u, n = np.unique(np.concatenate(s), return_counts=True)
            yield pd.DataFrame({"t": u.view(np.int64), "n": n})

    rows = docs.where(key <= edge).select("text").mapInPandas(run, "t bigint, n bigint")
    top = rows.groupBy("t").agg(F.sum("n").alias("n")).where("n >= 4").orderBy(F.desc("n"), "t").limit(FREQUENT).toPandas()
    t = top.t.to_numpy(np.int64).view(np.uint64)
    bits[(t >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
    return np.packbits(bits)


def _signatures(docs: DataFrame, frequent, size: int, percent: int) -> DataFrame:
    """doc_id, n, h (hash of the set), lo, hi (its extreme shingles), prefix (rare ones first), bits (its row of the matrix)."""

    def run(frames):
        shingles, often = shingler(size), np.unpackbits(frequent.value).astype(bool)
        for f in frames:
            out = []
            for doc_id, text in zip(f.doc_id.tolist(), f.text, strict=True):
                s = shingles(text)
                n = len(s)
                if not n:
                    out.append((doc_id, 0, None, None, None, [], b""))
                    continue
                hot = often[(s >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]
                p = prefix_length(n, percent)
                first = np.concatenate([s[~hot][:p], s[hot][:p]])[:p] if hot.any() else s[:p]
                out.append((doc_id, n, set_hash(s), int(s[:1].view(np.int64)[0]), int(s[-1:].view(np.int64)[0]), first.view(np.int64), np.packbits(matrix_row(s, width(n)), bitorder="little").tobytes()))
            a = list(zip(*out, strict=True)) or [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[0], pa.int64()), pa.array(a[1], pa.int64()), pa.array(a[2], pa.int64()), pa.array(a[3], pa.int64()), pa.array(a[4], pa.int64()), pa.array(a[5], pa.list_(pa.int64())), pa.array(a[6], pa.binary())],
                names=["doc_id", "n", "h", "lo", "hi", "prefix", "bits"],
            )

    def arrow(batches):
        for b in batches:
            ids, texts = b.column(0), b.column(1)
            for lo in range(0, b.num_rows, 1000):
                yield from run([_Rows(ids.slice(lo, 1000).to_pylist(), texts.slice(lo, 1000).to_pylist())])

    return docs.select("doc_id", "text").mapInArrow(arrow, "doc_id bigint, n bigint, h bigint, lo bigint, hi bigint, prefix array<bigint>, bits binary")


class _Rows:
    def __init__(self, ids: list, texts: list):
        self.doc_id, self.text = np.array(ids, object), texts


class Sets:
    """Documents whose links are looked for in one task: bounds first, by the matrix, then exact intersections, none within a component."""

    def __init__(self, sets: list[np.ndarray], percent: int = PERCENT, room: int = 1):
        """room: bits of a row for each shingle of the middling set."""
        self.percent, self.s, self.room = percent, sets, room
        self.n = np.array([len(x) for x in self.s], np.int64)
        self.up = list(range(len(sets)))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join_equal(self, name: np.ndarray) -> None:
        """Those of one name are one component from the start."""
        for x in np.unique(name):
            at = np.flatnonzero(name == x)
            for k in at[1:].tolist():
                self.up[k] = int(at[0])

    def links(self, query: np.ndarray, member: np.ndarray) -> list[tuple[int, int]]:
        """A link for each pair of components that queries and members show to be joined."""
        out = []
        bits = int(min(1 << 13, max(256, self.room * width(int(np.median(self.n)))))) if len(self.n) else 256
        rows = np.stack([matrix_row(x, bits) for x in self.s]).astype(np.float32) if len(self.s) else np.zeros((0, bits), np.float32)
        size = rows.sum(1)
        for lo in range(0, len(query), 256):
            q = query[lo : lo + 256]
            both = rows[q] @ rows[member].T
            nq, nm = self.n[q][:, None], self.n[member][None, :]
            least = need(nq, nm, self.percent)
            bound = np.minimum(nq - (size[q][:, None] - both), nm - (size[member][None, :] - both))
            fits = (bound >= least - 0.5) & (nq * 100 >= self.percent * nm) & (nm * 100 >= self.percent * nq)
            for a, b in zip(*np.nonzero(fits), strict=True):
                i, j = int(q[a]), int(member[b])
                if i == j or self.root(i) == self.root(j):
                    continue
                if len(np.intersect1d(self.s[i], self.s[j], assume_unique=True)) >= least[a, b]:
                    self.up[self.root(i)] = self.root(j)
                    out.append((i, j))
        return out


def set_hash(s: np.ndarray) -> int:
    """The name of a set, as a signed number."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).view(np.int64))


def _sets(t: pa.Table, shingles, *keys: str) -> tuple[list[int], list[np.ndarray]]:
    """Rows whose text is that of their node, one for each node (and value of keys), and their sets.

    A text is found by its doc_id; other texts that share the id have another hash.
    """
    at, sets, seen = [], [], set()
    for i, (h, text, *key) in enumerate(zip(t["h"].to_pylist(), t["text"].to_pylist(), *[t[k].to_pylist() for k in keys], strict=True)):
        if (h, *key) not in seen and set_hash(s := shingles(text)) == h:
            seen.add((h, *key))
            at.append(i)
            sets.append(s)
    return at, sets


def _group(reps: DataFrame, docs: DataFrame, work: Scratch, size: int, percent: int) -> DataFrame:
    """Links among documents that share an extreme shingle, in chunks of about CHUNK that the salt deals out anew for either end."""
    keys = reps.select("h", "doc_id", F.explode(F.array(F.struct(F.lit(0).alias("end"), F.col("lo").alias("key")), F.struct(F.lit(1).alias("end"), F.col("hi").alias("key")))).alias("k")).select("h", "doc_id", "k.*")
    often = work.save(keys.groupBy("end", "key").agg(F.count("*").alias("c")).where("c > 1"), "keys")
    salt = F.pmod(F.xxhash64("h", "end"), F.ceil(F.col("c") / CHUNK))
    dealt = work.save(keys.join(often, ["end", "key"]).select("end", "key", salt.alias("salt"), "h", "doc_id"), "dealt")
    texts = mark(work, docs, "doc_id", dealt, "dealt-marks").where("_maybe").drop("_maybe").join(dealt, "doc_id").drop("doc_id")

    def link(t: pa.Table):
        if t.num_rows < 2:
            return None
        first, sets = _sets(t, _shingler(size))
        h, s = t["h"].to_numpy()[first], Sets(sets, percent)
        at = np.argsort(s.n, kind="stable")
        found = s.links(at, at)
        return pa.table({"a": h[[i for i, _ in found]], "b": h[[j for _, j in found]]}) if found else None

    return by_group(texts, ["end", "key", "salt"], link, "a bigint, b bigint")


@functools.cache
def _shingler(size: int):
    """One a size in each worker."""
    return shingler(size)


def _merge(t: pa.Table) -> pa.Table:
    """One row for a group: sizes of its members, the union of their rows, as wide as the widest, and what all rows share, as narrow as the narrowest."""
    bits, core = t["bits"].to_pylist(), t["core"].to_pylist()
    top = max(map(len, bits))
    union = np.zeros(top, np.uint8)
    for b in bits:  # a narrower row says nothing about the halves of a wider one: it fills both
        union |= np.tile(np.frombuffer(b, np.uint8), top // len(b))
    least = min(map(len, core))
    common = np.full(least, 255, np.uint8)
    for c in core:
        common &= np.bitwise_or.reduce(np.frombuffer(c, np.uint8).reshape(-1, least), 0)
    row = {"g": t["g"][:1], "lo": [min(t["lo"].to_pylist())], "hi": [max(t["hi"].to_pylist())], "members": [sum(t["members"].to_pylist())]}
    return pa.table(row | {"bits": pa.array([union.tobytes()], pa.binary()), "core": pa.array([common.tobytes()], pa.binary())})


class Groups:
    """Rows of the matrix for groups of one Arrow table: names, sizes, unions and cores, the bits still packed."""

    def __init__(self, t, percent: int):
        self.percent = percent
        get = lambda c: t.column(t.schema.get_field_index(c))
        self.g, self.lo, self.hi = (get(c).to_numpy() for c in ("g", "lo", "hi"))
        self.bits, self.core = self._bytes(get("bits")), self._bytes(get("core"))

    @staticmethod
    def _bytes(col):
        col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
        at = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
        return np.frombuffer(col.buffers()[2] or b"", np.uint8), at[:-1], np.diff(at)

    def fits(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Sizes that can link at all."""
        return (self.hi[i] * 100 >= self.percent * self.lo[j]) & (self.hi[j] * 100 >= self.percent * self.lo[i])

    def _rows(self, what, at: np.ndarray, size: int, to: int) -> np.ndarray:
        """Packed rows of `size` bytes each, folded (parts joined by OR) to `to` bytes."""
        data, offset, _ = what
        rows = data[offset[at][:, None] + np.arange(size)]
        return np.bitwise_or.reduce(rows.reshape(len(at), size // to, to), 1)

    def qualify(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs the bound leaves: a member shares no more than its size, less one for each bit that all members of its group have and the other group lacks.

        Rows are compared at the narrower core of the two, so a long document beside a short one keeps its detail against its like.
        """
        keep = np.zeros(len(i), bool)
        shape = np.stack([self.bits[2][i], self.core[2][i], self.bits[2][j], self.core[2][j]], 1)
        kinds, which = np.unique(shape, axis=0, return_inverse=True)
        for k, (bi, ci, bj, cj) in enumerate(kinds.tolist()):
            to, all_ = min(ci, cj), np.flatnonzero(which.ravel() == k)
            step = max(1, (8 << 20) // max(bi, bj, 1))
            for at in (all_[x : x + step] for x in range(0, len(all_), step)):
                x, y = i[at], j[at]
                lack_x = np.bitwise_count(self._rows(self.core, x, ci, to) & ~self._rows(self.bits, y, bj, to)).sum(1, dtype=np.int64)
                lack_y = np.bitwise_count(self._rows(self.core, y, cj, to) & ~self._rows(self.bits, x, bi, to)).sum(1, dtype=np.int64)
                keep[at] = np.minimum(self.hi[x] - lack_x, self.hi[y] - lack_y) >= need(self.lo[x], self.lo[y], self.percent)
        return keep


def _pairs(g: Groups, i: np.ndarray, j: np.ndarray):
    """The pairs among rows i and j that stay, each once, the smaller name first."""
    ok = (g.g[i] != g.g[j]) & g.fits(i, j)
    i, j = i[ok], j[ok]
    swap = g.g[i] > g.g[j]
    i, j = np.where(swap, j, i), np.where(swap, i, j)
    _, first = np.unique(np.stack([g.g[i], g.g[j]], 1), axis=0, return_index=True) if len(i) else (None, np.zeros(0, np.int64))
    i, j = i[first], j[first]
    ok = g.qualify(i, j)
    return g.g[i[ok]], g.g[j[ok]]


def _short_postings(batches, percent: int):
    """Pairs of groups in sorted postings of at most POSTING groups: each row meets those up to the end of its posting, all postings of a batch at a time."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
        token = t["token"].to_numpy()
        end = int(np.searchsorted(token, token[-1])) if len(token) else 0
        held, t = t.slice(end), t.slice(0, end)
        yield from _meet(t, percent)
    if held is not None:
        yield from _meet(held, percent)


def _meet(t: pa.Table, percent: int):
    if t.num_rows < 2:
        return
    t = t.combine_chunks()
    token, g = t["token"].to_numpy(), Groups(t, percent)
    for d in range(1, POSTING):
        i = np.flatnonzero(token[d:] == token[:-d]) if d < len(token) else []
        if not len(i):
            break
        a, b = _pairs(g, i, i + d)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _long_posting(t: pa.Table, percent: int) -> pa.Table | None:
    """Pairs of groups of two blocks of one long posting."""
    t = t.combine_chunks()
    g, own, i, j = Groups(t, percent), t["blk"].to_numpy(), t["bi"][0].as_py(), t["bj"][0].as_py()
    a, b = np.flatnonzero(own == i), np.flatnonzero(own == j)
    out = [_pairs(g, np.repeat(a[k : k + 64], len(b)), np.tile(b, len(a[k : k + 64]))) for k in range(0, len(a), 64)]
    x, y = (np.concatenate(z) for z in zip(*out, strict=True)) if out else (np.zeros(0), np.zeros(0))
    return pa.table({"a": x, "b": y}) if len(x) else None


def jaccard_join(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for every row: components of documents with 100 |A and B| >= percent |A or B|, over shingles of `size` words.

    1. Documents with equal sets are one node, named by the set's hash. Nodes that share their smallest or largest
       shingle are compared in chunks; linked ones form a group. A node alone is a group too.
    2. The matrix: each group's row is the union of its members' shingles, hashed to bits. Linked nodes share a shingle of
       their prefixes, so only groups that share one there are paired; a pair is kept if the bound on the intersection,
       from what the rows of all members have beyond the other group's row, allows a link. Postings over POSTING groups are compared
       in pairs of blocks. Pairs within a group are never made.
    3. Kept pairs are opened: the smaller group's members are compared with blocks of the larger one's, exactly.
    4. Components of all links. No link between two components is missed; links within one aren't needed.

    NULL texts and texts without words have no shingles and stand alone. A NULL doc_id gets a NULL component_id and links nothing.
    Rows that share a doc_id are one node each by their text; repeated rows appear as often as they occur. Very long texts
    are read whole. No other column is read. No rows give no rows.
    """
    spark, work = docs.sparkSession, Scratch(docs.sparkSession, "ngram")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    frequent = spark.sparkContext.broadcast(_learn_frequent(docs, size))
    sig = work.save(_signatures(docs, frequent, size, percent), "sig")
    live = sig.where("n > 0 and doc_id is not null")
    reps = work.save(live.groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.min("lo").alias("lo"), F.min("hi").alias("hi")), "reps")
    first = components(work, work.save(_group(reps, docs, work, size, percent), "near").distinct(), "one")
    named = work.save(reps.select("h", "doc_id").join(first.select(F.col("v").alias("h"), F.col("c").alias("g")), "h", "left").select("h", "doc_id", F.coalesce("g", "h").alias("g")), "named")
    nodes = work.save(live.join(named, ["h", "doc_id"]).dropDuplicates(["h"]).select("h", "doc_id", "g", "n", "prefix", "bits"), "nodes")
    seats = work.save(sig.select("doc_id", F.col("n").alias("n_shingles"), "h"), "seats")
    work.drop("sig", "near", "dealt", "keys", "reps")
    tokens = nodes.select(F.explode("prefix").alias("token"), "g")
    shared = work.save(tokens.groupBy("token").agg(F.min("g").alias("a"), F.max("g").alias("b")).where("a != b").select("token"), "shared")
    matrix = work.save(tokens.join(shared, "token").distinct(), "matrix")
    # groups' rows: those of single documents as they are, of others merged twice, so that no task merges a large group alone
    one = nodes.select("g", F.col("n").alias("lo"), F.col("n").alias("hi"), F.lit(1).cast("bigint").alias("members"), "bits", F.col("bits").alias("core"), F.pmod("h", F.lit(64)).alias("salt"))
    many = work.save(first.select(F.col("c").alias("g")).distinct(), "many")
    fields = "g bigint, lo bigint, hi bigint, members bigint, bits binary, core binary"
    merged = by_group(by_group(one.join(many, "g"), ["g", "salt"], _merge, fields), ["g"], _merge, fields)
    groups = work.save(one.drop("salt").join(many, "g", "left_anti").unionByName(merged), "groups")
    long = work.save(matrix.groupBy("token").agg(F.count("*").alias("m")).where(F.col("m") > POSTING), "long")
    rows = groups.drop("members")
    short = matrix.join(long, "token", "left_anti").join(rows, "g").repartition("token").sortWithinPartitions("token").mapInArrow(lambda batches: _short_postings(batches, percent), "a bigint, b bigint")
    posted = matrix.join(long, "token").withColumn("nb", F.ceil(F.col("m") / POSTING))
    posted = posted.withColumn("blk", F.pmod(F.xxhash64("g"), F.col("nb"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("nb") - 1)))
    posted = posted.select("token", "g", "blk", F.least("blk", "other").alias("bi"), F.greatest("blk", "other").alias("bj")).join(rows, "g")
    pairs = work.save(short.unionByName(by_group(posted, ["token", "bi", "bj"], lambda t: _long_posting(t, percent), "a bigint, b bigint")).distinct(), "pairs")
    work.drop("matrix", "shared", "long")
    second = components(work, _open(pairs, groups, nodes, docs, work, size, percent), "two")
    final = named.join(second.select(F.col("v").alias("g"), F.col("c").alias("c")), "g", "left").select("h", "doc_id", F.coalesce("c", "g").alias("c"))
    final = work.save(final, "final")
    least = work.save(final.groupBy("c").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("k")).where("k > 1").drop("k"), "least")
    rooms = work.save(final.join(least, "c", "left").select("h", F.coalesce("component_id", "doc_id").alias("component_id")), "rooms")
    work.drop("nodes", "groups", "opened")
    out = seats.join(rooms, "h", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def _open(pairs: DataFrame, groups: DataFrame, nodes: DataFrame, docs: DataFrame, work: Scratch, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) between the groups of the pairs, named by group."""
    size = groups.select("g", "members")
    sized = pairs.join(size.select(F.col("g").alias("a"), F.col("members").alias("ma")), "a").join(size.select(F.col("g").alias("b"), F.col("members").alias("mb")), "b")
    big = (F.col("ma") > F.col("mb")) | ((F.col("ma") == F.col("mb")) & (F.col("a") < F.col("b")))
    blocks = F.ceil(F.greatest("ma", "mb") / 256)
    sized = work.save(sized.select(F.when(big, F.col("a")).otherwise(F.col("b")).alias("big"), F.when(big, F.col("b")).otherwise(F.col("a")).alias("small"), blocks.alias("blocks")), "sized")
    asks = work.save(sized.join(size.withColumnRenamed("g", "small"), "small").groupBy("big").agg(F.ceil(F.sum("members") / 256).alias("turns")), "asks")
    sized = sized.join(asks, "big")
    who = nodes.select("g", "h", "doc_id")
    members = sized.select("big", "blocks", "turns").distinct().join(who, F.col("big") == F.col("g")).select("big", F.pmod(F.xxhash64("h"), F.col("blocks")).alias("blk"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("turns") - 1)).alias("turn"), "g", "h", "doc_id", F.lit(False).alias("query"))
    asking = sized.join(who, F.col("small") == F.col("g")).select("big", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("blk"), F.pmod(F.xxhash64("h"), F.col("turns")).alias("turn"), "g", "h", "doc_id", F.lit(True).alias("query"))
    opened = work.save(members.unionByName(asking), "opened")
    texts = mark(work, docs, "doc_id", opened, "opened-marks").where("_maybe").drop("_maybe").join(opened, "doc_id")

    def link(t: pa.Table):
        query, g = t["query"].to_numpy(), t["g"].to_numpy()
        if query.all() or not query.any():
            return None
        at, sets = _sets(t, _shingler(shingle), "query")
        query, g, s = query[at], g[at], Sets(sets, percent)
        s.join_equal(g)
        found = s.links(np.flatnonzero(query), np.flatnonzero(~query))
        return pa.table({"a": g[[i for i, _ in found]], "b": g[[j for _, j in found]]}) if found else None

    return by_group(texts, ["big", "blk", "turn"], link, "a bigint, b bigint")
