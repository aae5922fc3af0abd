"""Packing documents into fixed windows: minimum bin slack over a histogram of piece lengths."""

from __future__ import annotations

import functools
import json
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageloom.llm.work import SLICE, Scratch, byte_words, mark, tokenizer

END_ID = 1
PIECE = "doc_id bigint, key bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
_NAMES = [x.split()[0] for x in PIECE.split(", ")]


def _key() -> Column:
    """Stands for a text; cut pieces find their text by it, so neither NULL ids nor ids with several texts matter."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("key")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Merges:
    """The tokenizer's merges, applied to many words at a time: all words of a length are rows of a matrix of ids.

    In each round every row joins its first pair of lowest rank, until no row has a pair that the file lists; only the two
    pairs beside a new id are looked up again. For words of Latin letters, which the tokenizer lowers but does not split.
    """

    SLOTS, NONE = 18, np.int32(1 << 30)
    PLAIN = re.compile("[a-zA-Z\xc0-\xd6\xd8-\xf6\xf8-\xff]+")

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:  # a file that every machine has
            model = json.load(f)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = np.array([vocab.get(c, -1) for c in letters], np.int32)
        self.last = np.array([vocab.get(c + end, -1) for c in letters], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.uint64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        _, first = np.unique(keys, return_index=True)
        keys, rank, self.tables = keys[first], np.arange(len(pairs), dtype=np.int32)[first], []
        while len(keys):  # of pairs that share a slot the first stays, the others go to the next table
            slot = self._slot(keys, len(self.tables))
            _, at = np.unique(slot, return_index=True)
            held, ranks = np.zeros(1 << self.SLOTS, np.uint64), np.full(1 << self.SLOTS, self.NONE, np.int32)
            held[slot[at]], ranks[slot[at]] = keys[at], rank[at]
            self.tables.append((held, ranks))
            left = np.setdiff1d(np.arange(len(keys)), at)
            keys, rank = keys[left], rank[left]

    def _slot(self, keys: np.ndarray, k: int) -> np.ndarray:
        h = (keys ^ (keys >> np.uint64(23 + k))) * np.uint64(0x9E3779B97F4A7C15 + 2 * k)
        return (h >> np.uint64(64 - self.SLOTS)).astype(np.int64)

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of the pairs, NONE where the file lists none."""
        keys = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)
        rank = np.full(keys.shape, self.NONE, np.int32)
        for k, (held, ranks) in enumerate(self.tables):
            slot = self._slot(keys, k)
            np.copyto(rank, ranks[slot], where=held[slot] == keys)
        return rank

    def _same_length(self, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words that are the rows of b, and how many each has."""
        n, size = b.shape
        ids = self.inner[b]
        ids[:, -1] = self.last[b[:, -1]]
        out, count = ids.copy(), np.full(n, size)
        if size < 2:
            return out, count
        place, rank, left = np.arange(n), self._ranks(ids[:, :-1], ids[:, 1:]), size
        while len(place):
            row = np.arange(len(place))
            at = rank.argmin(1)
            best = rank[row, at]
            done = best >= self.NONE
            if done.any():
                out[place[done], : ids.shape[1]], count[place[done]] = ids[done], left
                place, ids, rank, at, best = (x[~done] for x in (place, ids, rank, at, best))
                row = row[: len(place)]
            # each row has as many ids as rounds have left: what is behind its pair moves up by one
            left -= 1
            behind = np.arange(left)[None, :] > at[:, None]
            ids = np.where(behind, ids[:, 1:], ids[:, :-1])
            ids[row, at] = self.made[best]
            if left < 2:
                out[place, :1], count[place] = ids, 1
                break
            rank = np.where(behind[:, : left - 1], rank[:, 1:], rank[:, :-1])
            for p, ok in ((at - 1, at > 0), (at, at + 1 < left)):  # the pairs on either side
                r, c = row[ok], p[ok]
                rank[r, c] = self._ranks(ids[r, c], ids[r, c + 1])
        return out, count

    def encode(self, words: list[tuple[bytes, object]]):
        """(key, ids as bytes) for each (word in small letters, key)."""
        by: dict[int, tuple[list[bytes], list]] = {}
        for w, key in words:
            some = by.setdefault(len(w), ([], []))
            some[0].append(w)
            some[1].append(key)
        for size, (all_, keys) in by.items():
            for lo in range(0, len(all_), 4096):
                ids, count = self._same_length(np.frombuffer(b"".join(all_[lo : lo + 4096]), np.uint8).reshape(-1, size))
                flat, at = np.ascontiguousarray(ids, "<u4").tobytes(), np.arange(len(ids)) * (4 * size)
                yield from zip(keys[lo : lo + 4096], [flat[a:b] for a, b in zip(at.tolist(), (at + 4 * count).tolist(), strict=True)], strict=True)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary: itself where printable, else from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b if b in shown else next(rest)) for b in range(256)]


class Encoder:
    """Texts -> their ids and the end id as little-endian unsigned 32-bit bytes.

    The tokenizer drops white space and never joins across it, so ids are found word by word, and words that no memo has
    yet are encoded together. A-Z in lower case and marks that end a word change no id: the tokenizer lowers all letters, and
    a run of such marks after a letter is a part of its own. Words of Latin letters are merged here, all others by the
    tokenizer. The memo is emptied when it holds MOST words.
    """

    MOST, CHUNK, LONG = 300_000, 256, 64
    MARKS = b"".join(bytes([b]) for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'")

    def __init__(self, path: str):
        self.tok, self.merges, self.memo, self.end = tokenizer(path), Merges(path), {}, array("I", [END_ID]).tobytes()

    def _learn(self, words) -> None:
        if len(self.memo) + len(words) > self.MOST:
            self.memo.clear()
        stems, whole = {}, []
        for w in words:
            stem = w.rstrip(self.MARKS)
            if stem and stem is not w and len(stem) < len(w) and (stem[-1] >= 97 and stem[-1] <= 122):
                stems[w] = stem
            else:
                whole.append(w)
        need = {x for w, s in stems.items() for x in (s, w[len(s) :]) if x not in self.memo} | {w for w in whole if w not in self.memo}
        plain = self.merges.PLAIN.fullmatch
        mine, rest = [], []
        for w in need:
            text = w.decode("utf-8", "replace")
            if len(w) <= self.LONG and plain(text):
                mine.append((text.lower().encode(), w))
            else:
                rest.append((w, text))
        self.memo.update(self.merges.encode(mine))
        for lo in range(0, len(rest), 10_000):
            part = rest[lo : lo + 10_000]
            for (w, _), e in zip(part, self.tok.encode_batch_fast([t for _, t in part], add_special_tokens=False), strict=True):
                self.memo[w] = array("I", e.ids).tobytes()
        for w, s in stems.items():
            self.memo[w] = self.memo[s] + self.memo[w[len(s) :]]

    def __call__(self, texts):
        for lo in range(0, len(texts), self.CHUNK):
            words = [byte_words(t) for t in texts[lo : lo + self.CHUNK]]
            new = set().union(*words)
            if not new <= self.memo.keys():
                self._learn(new if len(self.memo) + len(new) > self.MOST else new - self.memo.keys())
            get = self.memo.__getitem__
            for w in words:
                yield b"".join([*map(get, w), self.end])


@functools.cache
def encoder(path: str) -> Encoder:
    """One a worker, so that the tasks of a worker share its memo."""
    return Encoder(path)


def _pieces(docs: DataFrame, path: str, window: int) -> DataFrame:
    """Each document cut at multiples of the window. Ids of documents stay Arrow columns: no NULL turns them into doubles."""

    def run(batches):
        ids = encoder(path)
        for b in batches:
            for lo in range(0, b.num_rows, SLICE):
                part = b.slice(lo, SLICE)
                row, start, length, crc, total = [], [], [], [], []
                for k, x in enumerate(map(memoryview, ids(part.column(2).to_pylist()))):
                    n = len(x) // 4
                    for at in range(0, n, window):
                        cut = x[4 * at : 4 * (at + window)]
                        row.append(k)
                        start.append(at)
                        length.append(len(cut) // 4)
                        crc.append(zlib.crc32(cut))
                        total.append(n)
                row = pa.array(row, pa.int64())
                cols = [part.column(0).take(row), part.column(1).take(row)] + [pa.array(c, pa.int64()) for c in (start, length, crc, total)]
                yield pa.RecordBatch.from_arrays(cols, names=_NAMES)

    return docs.select(F.col("doc_id").cast("bigint"), _key(), "text").mapInArrow(run, PIECE)


def best_fill(counts: dict[int, int], capacity: int) -> tuple[int, dict[int, int]]:
    """The largest sum up to capacity that a multiset of the lengths can make, and how often it takes each length.

    Subset sums are the bits of one whole number. Lengths come largest first, each as often as it is there, in binary
    parts; the number before each length is kept, and the sum is traced back through them with the fewest of a length.
    """
    mask, reach, before = (1 << (capacity + 1)) - 1, 1, []
    for n in sorted((n for n in counts if n <= capacity and counts[n]), reverse=True):
        before.append((n, reach))
        left, part = min(counts[n], capacity // n), 1
        while left:
            k = min(part, left)
            reach |= (reach << (n * k)) & mask
            left, part = left - k, part * 2
        if reach >> capacity:
            break
    total = at = reach.bit_length() - 1
    taken = {}
    for n, had in reversed(before):
        k = 0
        while not (had >> (at - k * n)) & 1:
            k += 1
        if k:
            taken[n] = k
            at -= k * n
    return total, taken


def plan(histogram: dict[int, int], window: int) -> tuple[list[tuple[dict[int, int], int]], dict[int, int]]:
    """Fills ({length: times}, windows made that way), and how many pieces of each length are left over.

    The longest length left is always taken; the rest of the window comes from best_fill. A fill is used as often as
    its pieces last, so each step uses up a length: no more steps than lengths, however many pieces there are. A
    length for which no fill closes the window is left over.
    """
    counts, fills, over = dict(histogram), [], {}
    while counts:
        n = max(counts)
        rest = counts | {n: counts[n] - 1}
        total, taken = best_fill(rest, window - n)
        if total < window - n:
            over[n] = counts.pop(n)
            continue
        taken[n] = taken.get(n, 0) + 1
        times = min(counts[k] // v for k, v in taken.items())
        fills.append((taken, times))
        for k, v in taken.items():
            counts[k] -= v * times
            if not counts[k]:
                del counts[k]
    return fills, over


def _tables(fills, over, window: int):
    """For each length: the ranks at which fills begin, with first sequence, pieces a sequence and offset; and where its leftovers lie."""
    by: dict[int, list] = {}
    used: dict[int, int] = {}
    seq = 0
    for taken, times in fills:
        at = 0
        for n in sorted(taken, reverse=True):
            by.setdefault(n, []).append((used.get(n, 0), seq, taken[n], at))
            used[n] = used.get(n, 0) + taken[n] * times
            at += n * taken[n]
        seq += times
    place, at = {}, 0
    for n in sorted(over, reverse=True):
        place[n] = (used.get(n, 0), at)
        at += n * over[n]
    return {n: np.array(v, np.int64) for n, v in by.items()}, place, seq, at


def _assign(ranked: DataFrame, tables, window: int) -> DataFrame:
    by, place, first, total = tables
    # the last window of the leftovers is cut at powers of two, which need no padding
    whole, tail = divmod(total, window)
    cuts, at = [], whole * window
    for bit in range(tail.bit_length() - 1, -1, -1):
        if tail >> bit & 1:
            cuts.append(at)
            at += 1 << bit
    cuts = np.array(cuts, np.int64)

    def bound(p: int) -> tuple[int, int, int]:
        """Sequence, its begin and its end at position p of the leftovers."""
        if p < whole * window:
            return first + p // window, p // window * window, p // window * window + window
        i = int(np.searchsorted(cuts, p, "right")) - 1
        return first + whole + i, int(cuts[i]), int(cuts[i + 1]) if i + 1 < len(cuts) else total

    def run(batches):
        for f in batches:
            n, r = f.column("length").to_numpy(), f.column("rank").to_numpy()
            seq, off, cut = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64), []
            for k in np.unique(n):
                rows = np.flatnonzero(n == k)
                from_, pos = place.get(int(k), (1 << 62, 0))
                fit = rows[r[rows] < from_]
                if len(fit):
                    t = by[int(k)]
                    i = np.searchsorted(t[:, 0], r[fit], "right") - 1
                    d = r[fit] - t[i, 0]
                    seq[fit], off[fit] = t[i, 1] + d // t[i, 2], t[i, 3] + d % t[i, 2] * k
                for row in rows[r[rows] >= from_].tolist():
                    p = pos + (int(r[row]) - from_) * int(k)
                    s, lo, hi = bound(p)
                    seq[row], off[row] = s, p - lo
                    if p + k > hi:
                        cut.append((row, p, int(k)))
            whole = np.ones(len(n), bool)
            whole[[c[0] for c in cut]] = False
            more = []
            for row, p, k in cut:
                q = p
                while q < p + k:
                    s, lo, hi = bound(q)
                    e = min(hi, p + k)
                    more.append((row, q - p, e - q, s, q - lo))
                    q = e
            at = np.flatnonzero(whole)
            m = np.array(more, np.int64).reshape(-1, 5)
            idx = np.concatenate([at, m[:, 0]])
            join = lambda x, y: pa.array(np.concatenate([x, y]))
            given = lambda c: f.column(c).to_numpy()
            cols = [
                f.column("doc_id").take(pa.array(idx)), f.column("key").take(pa.array(idx)), join(given("start")[at], given("start")[m[:, 0]] + m[:, 1]), join(n[at], m[:, 2]),
                join(given("ids_crc32")[at], np.zeros(len(m), np.int64)), pa.array(given("doc_tokens")[idx]), join(seq[at], m[:, 3]), join(off[at], m[:, 4]), join(np.ones(len(at), bool), np.zeros(len(m), bool)),
            ]
            yield pa.RecordBatch.from_arrays(cols, names=[*_NAMES, "sequence_id", "offset", "whole"])

    return ranked.mapInArrow(run, f"{PIECE}, sequence_id bigint, offset bigint, whole boolean")


def _read_cut(docs: DataFrame, cut: DataFrame, path: str, work: Scratch) -> DataFrame:
    """The cut pieces with the checksum of their ids: their texts are read and encoded once more, equal ones as one."""
    mine = mark(work, docs.select(_key(), "text"), "key", cut, "cut-marks").where("_maybe").drop("_maybe")
    few = mine.join(cut.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"])
    cols = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset"]

    def run(batches):
        ids = encoder(path)
        for b in batches:
            crc, memo = [], (None, b"")
            for text, start, length in zip(*[b.column(c).to_pylist() for c in ("text", "start", "length")], strict=True):
                if memo[0] != (text or ""):
                    memo = (text or "", next(ids([text])))
                crc.append(zlib.crc32(memo[1][4 * start : 4 * (start + length)]))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in cols], pa.array(crc, pa.int64())], names=[*cols, "ids_crc32"])

    fields = ", ".join(f"{c} bigint" for c in [*cols, "ids_crc32"])
    return few.join(cut.select("key", *cols), "key").select("text", *cols).mapInArrow(run, fields)


def pack(docs: DataFrame, path: str | None = None, window: int = 2048) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row a piece of a document.

    Each document's ids end with the end id, so an empty or NULL text is one piece of length 1. Documents are cut at
    multiples of the window; what is left of each is a piece. The histogram of piece lengths (as many numbers as a
    window has ids, at any size of the corpus) goes to the driver, which plans the fills; pieces find their place
    by their rank among those of their length. Pieces whose length closes no window are laid end to end and cut at the
    window's borders, and the very last ones at powers of two, so no window needs padding. Ranks are counted in
    buckets of about 100 pieces, so a length that a third of all documents share is counted by many tasks. Repeated rows
    are packed as often as they occur, and so are rows that share a doc_id or have none. Very long texts are so many more
    pieces. Columns beside doc_id and text are not read. No rows give no rows.
    """
    path = path or tokenizer_path()
    work = Scratch(docs.sparkSession, "pack")
    parts = work.save(_pieces(docs, path, window), "pieces")
    counts = parts.groupBy("length").agg(F.count("*").alias("n")).collect()  # at most `window` rows
    hist = {int(r["length"]): int(r["n"]) for r in counts}
    tables = _tables(*plan(hist, window), window)
    sizes = docs.sparkSession.createDataFrame([(k, max(1, n // 100)) for k, n in hist.items()], "length bigint, buckets bigint")
    keyed = parts.join(F.broadcast(sizes), "length").withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.col("buckets"))).drop("buckets")
    keyed = work.save(keyed.withColumn("nth", F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32"))), "keyed")
    sums = keyed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    running = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = work.save(sums.select("length", "bucket", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("base")), "base")
    ranked = keyed.join(base, ["length", "bucket"]).select("doc_id", "key", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("nth") - 1).alias("rank"))
    placed = work.save(_assign(ranked, tables, window), "placed")
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    cut = work.save(placed.where("not whole").drop("whole"), "cut")
    return placed.where("whole").select(*cols).unionByName(_read_cut(docs, cut, path, work).select(*cols))


def sequences(docs: DataFrame, pieces: DataFrame, path: str | None = None) -> DataFrame:
    """sequence_id, ids: the packed windows themselves, from unique doc_ids. A window's pieces meet in one task; no window is larger than its size."""
    path = path or tokenizer_path()

    def run(batches):
        ids = encoder(path)
        for b in batches:
            text, start, length = (b.column(c).to_pylist() for c in ("text", "start", "length"))
            out = [np.frombuffer(x, "<u4")[s : s + n].astype("int64") for x, s, n in zip(ids(text), start, length, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("sequence_id"), b.column("offset"), pa.array(out, pa.list_(pa.int64()))], names=["sequence_id", "offset", "ids"])

    parts = docs.select("doc_id", "text").join(pieces, "doc_id").select("text", "start", "length", "sequence_id", "offset").mapInArrow(run, "sequence_id bigint, offset bigint, ids array<bigint>")
    return parts.groupBy("sequence_id").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
