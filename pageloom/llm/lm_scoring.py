"""LM scoring: the probability of a text over all ways to cut its words into pieces of an existing subword vocabulary."""

from __future__ import annotations

import functools
import json
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.packing import byte_letters, tokenizer_path
from pageloom.llm.work import SLICE, Scratch, byte_words, crc_mod, map_texts

#: Bounds on the words whose values go to all executors, in number and in bytes each; all other words are joined by shuffle.
FREQUENT, SHORT = 1 << 17, 64
#: Letters, single digits and runs of other marks: the parts of a word that pieces do not reach across.
PART = re.compile(r"[^\W\d_]+|\d|[\W_]+")
END = "</w>"


class Vocabulary:
    """Pieces of the tokenizer's file as bytes, each for the inside or for the end of a part of a word.

    Ids are those of the file; one more stands for the glue between the parts of a word. A piece's place in a hash table
    is found for whole arrays at once: two pieces that share a place go to the next of four tables.
    """

    SLOTS, STEP = 18, np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:  # a file that every machine has
            vocab = json.load(f)["model"]["vocab"]
        byte = {c: b for b, c in enumerate(byte_letters())}
        spelt = {i: bytes(map(byte.__getitem__, p.removesuffix(END))) for p, i in vocab.items() if all(c in byte for c in p.removesuffix(END))}
        self.final = {spelt[i]: i for p, i in vocab.items() if p.endswith(END) and i in spelt}
        self.inner = {spelt[i]: i for p, i in vocab.items() if not p.endswith(END) and i in spelt}
        self.glue, self.size = max(vocab.values()) + 1, max(vocab.values()) + 2
        self.longest = max(map(len, spelt.values()))
        self.tables = {last: self._tables(self.final if last else self.inner) for last in (False, True)}

    def start(self) -> np.ndarray:
        """Scores that the vocabulary itself gives: by Zipf's law, a piece's share falls with its place in the order of merges."""
        p = 1 / (np.arange(self.size) + 10.0)
        return np.log(p / p.sum())

    def hashes(self, b: np.ndarray) -> np.ndarray:
        """Hashes of the beginnings of each row of bytes; substring() finds the rest from them."""
        h = np.zeros((len(b), b.shape[1] + 1), np.uint64)
        for j in range(b.shape[1]):
            h[:, j + 1] = h[:, j] * self.STEP + (b[:, j].astype(np.uint64) + np.uint64(0x51ED270B))
        return h

    def _slot(self, h: np.ndarray, k: int) -> np.ndarray:
        h = (h ^ (h >> np.uint64(29 + k))) * np.uint64(0xBF58476D1CE4E5B9 + 2 * k)
        return (h >> np.uint64(64 - self.SLOTS)).astype(np.int64)

    def _tables(self, pieces: dict[bytes, int]):
        by_len: dict[int, list[bytes]] = {}
        for p in pieces:
            by_len.setdefault(len(p), []).append(p)
        hs, ids = [], []
        for n, ps in by_len.items():
            hs.append(self.hashes(np.frombuffer(b"".join(ps), np.uint8).reshape(-1, n))[:, n])
            ids.append(np.array([pieces[p] for p in ps]))
        h, i, out = np.concatenate(hs), np.concatenate(ids), []
        for k in range(4):
            keys, vals = np.zeros(1 << self.SLOTS, np.uint64), np.full(1 << self.SLOTS, -1, np.int64)
            slot = self._slot(h, k)
            _, first = np.unique(slot, return_index=True)
            keys[slot[first]], vals[slot[first]] = h[first], i[first]
            out.append((keys, vals))
            left = np.setdiff1d(np.arange(len(h)), first)
            h, i = h[left], i[left]
            if not len(h):
                break
        assert not len(h)
        return out

    def find(self, h: np.ndarray, last: bool) -> np.ndarray:
        """Piece ids of substrings by hash, -1 where there is none."""
        out = np.full(len(h), -1, np.int64)
        for k, (keys, vals) in enumerate(self.tables[last]):
            slot = self._slot(h, k)
            out = np.where((out < 0) & (keys[slot] == h), vals[slot], out)
        return out


def parts_of(word: bytes) -> list[bytes]:
    return [p.encode("utf-8", "replace") for p in PART.findall(word.decode("utf-8", "replace"))]


class Lattice:
    """All segmentations of parts of words. Parts of equal length are treated together, a column of positions at a time."""

    MOST = 48

    def __init__(self, vocab: Vocabulary, logp: np.ndarray):
        self.v, self.logp = vocab, logp
        self.power = np.ones(self.MOST + 1, np.uint64)
        for j in range(1, self.MOST + 1):
            self.power[j] = self.power[j - 1] * Vocabulary.STEP

    def _arcs(self, b: np.ndarray):
        """For each end j, the starts i with the pieces found between them and their scores."""
        h, n = self.v.hashes(b), b.shape[1]
        for j in range(1, n + 1):
            starts = range(max(0, j - self.v.longest), j)
            ids = [self.v.find(h[:, j] - h[:, i] * self.power[j - i], j == n) for i in starts]
            yield j, starts, [np.where(x < 0, -np.inf, self.logp[x]) for x in ids], ids

    @staticmethod
    def _sum(terms: np.ndarray) -> np.ndarray:
        top = np.maximum(terms.max(0), -1e30)
        return top + np.log(np.maximum(np.exp(terms - top).sum(0), 1e-300))

    def forward(self, b: np.ndarray):
        """Log sums of the ways to each position, and the arcs."""
        a, arcs = np.full((b.shape[1] + 1, len(b)), -np.inf), []
        a[0] = 0
        for j, starts, scores, ids in self._arcs(b):
            a[j] = self._sum(np.stack([a[i] + s for i, s in zip(starts, scores, strict=True)]))
            arcs.append((j, starts, scores, ids))
        return a, arcs

    def _long_forward(self, part: bytes):
        """Log sums of the ways to each position of one part of any length, and for each end the starts and pieces."""
        a, n, arcs = [0.0] + [-1e30] * len(part), len(part), []
        for j in range(1, n + 1):
            table = self.v.final if j == n else self.v.inner
            found = [(i, k) for i in range(max(0, j - self.v.longest), j) if (k := table.get(part[i:j])) is not None]
            if found:
                a[j] = self._add([a[i] + float(self.logp[k]) for i, k in found])
            arcs.append((j, found))
        return a, arcs

    @staticmethod
    def _add(terms: list[float]) -> float:
        top = max(terms)
        return top + math.log(sum(math.exp(x - top) for x in terms))

    def _long(self, part: bytes) -> float:
        return self._long_forward(part)[0][-1]

    def _long_expected(self, part: bytes, times: float, sums: np.ndarray) -> None:
        a, arcs = self._long_forward(part)
        if a[-1] < -1e29:  # no way through
            return
        back = [-1e30] * len(part) + [0.0]
        for j, found in reversed(arcs):
            for i, k in found:
                x = float(self.logp[k]) + back[j]
                back[i] = self._add([back[i], x])
                sums[k] += times * math.exp(min(a[i] + x - a[-1], 0.0))

    def _by_length(self, parts: list[bytes]):
        by: dict[int, list[int]] = {}
        for k, p in enumerate(parts):
            by.setdefault(len(p), []).append(k)
        for n, at in by.items():
            if n <= self.MOST:
                yield n, at, np.frombuffer(b"".join([parts[k] for k in at]), np.uint8).reshape(-1, n)
            else:
                yield n, at, None

    def score(self, words: list[bytes]) -> np.ndarray:
        """Natural logs of the words' summed probabilities."""
        cut = [parts_of(w) for w in words]
        place = {p: k for k, p in enumerate(dict.fromkeys(p for c in cut for p in c))}
        value = np.zeros(len(place))
        for n, at, b in self._by_length(list(place)):
            value[at] = self.forward(b)[0][n] if b is not None else [self._long(p) for p in (list(place)[k] for k in at)]
        glue = float(self.logp[self.v.glue])
        return np.array([sum(value[place[p]] for p in c) + glue * (len(c) - 1) for c in cut], float)

    def expected(self, words: list[bytes], sums: np.ndarray, times: list[int] | None = None) -> None:
        """Adds to sums how often each piece is expected in the words, each there so many times (once, if none are given)."""
        parts: Counter = Counter()
        for w, k in zip(words, times or [1] * len(words), strict=True):
            c = parts_of(w)
            sums[self.v.glue] += k * (len(c) - 1)
            for x in c:
                parts[x] += k
        held, weight = list(parts), np.array(list(parts.values()), float)
        for n, at, b in self._by_length(held):
            if b is None:
                for k in at:
                    self._long_expected(held[k], weight[k], sums)
                continue
            a, arcs = self.forward(b)
            back = np.full((n + 1, len(b)), -np.inf)
            back[n] = 0
            for j, starts, scores, ids in reversed(arcs):
                for i, s, k in zip(starts, scores, ids, strict=True):
                    hit = np.flatnonzero(k >= 0)
                    if not len(hit):
                        continue
                    x = s[hit] + back[j, hit]
                    back[i, hit] = np.logaddexp(back[i, hit], x)
                    sums += np.bincount(k[hit], weight[at][hit] * np.exp(np.minimum(a[i, hit] + x - a[n, hit], 0.0)), len(sums))


def _count(docs: DataFrame) -> DataFrame:
    """word, c: occurrences in training texts, 0 for words of held-out texts alone. Counts are summed per task before the shuffle."""

    def run(batches):
        held: Counter = Counter()
        out = lambda: pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "c"])
        for b in batches:
            for lo in range(0, b.num_rows, SLICE):
                part = b.slice(lo, SLICE)
                for text, known in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    words = byte_words(text)
                    if known:
                        for w in words:
                            held[w] += 0
                    else:
                        held.update(words)
                if len(held) > 100_000:
                    yield out()
                    held.clear()
        yield out()

    return docs.select("text", "held_out").mapInArrow(run, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def _maximise(counts: DataFrame, path: str, logp: np.ndarray) -> np.ndarray:
    """One round of expectation maximisation over all training words by their counts; what returns is bounded by the vocabulary."""
    shared = counts.sparkSession.sparkContext.broadcast(logp)

    def expect(batches):
        lattice, sums = Lattice(vocabulary(path), shared.value), np.zeros(len(shared.value))
        for b in batches:
            lattice.expected(b.column(0).to_pylist(), sums, b.column(1).to_pylist())
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["piece", "n"])

    found = counts.where("c > 0").select("word", "c").mapInArrow(expect, "piece bigint, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
    sums = np.full(len(logp), 0.01)
    for r in found:
        sums[r["piece"]] += r["n"]
    return np.log(sums / sums.sum())


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    """One a worker."""
    return Vocabulary(path)


def score_texts(docs: DataFrame, held_out, path: str | None = None, rounds: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, word_score for every row.

    Words have A-Z in lower case; each text ends with one end token. base_score: add-one word unigrams. score: log10 of the
    text's marginal probability: the sum over all segmentations of its words into pieces of an existing vocabulary, each
    token being a word or, by its share of training tokens, the end. The vocabulary's own order gives the pieces' first
    scores; rounds of expectation maximisation over all training words by their counts fit them to the corpus. word_score
    gives a word of the training texts one more way, the word as a whole: the share of training tokens seen once
    (Good-Turing) goes to the pieces, the rest to whole words.

    NULL and empty texts hold the end token alone; a NULL doc_id counts as training text; very long texts and words are
    scored whole. Repeated rows each get their row. Other columns are not read. No rows give no rows. Each distinct word is
    scored once. The FREQUENT most frequent words of SHORT bytes at most (a fixed bound) go to the executors and are looked
    up in place; the others are shuffled, one row a document and word, so no key is hot.
    """
    path = path or tokenizer_path()
    spark, work = docs.sparkSession, Scratch(docs.sparkSession, "lm")
    docs = docs.select(F.col("doc_id").cast("bigint"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    counts = work.save(_count(docs), "counts")
    head = counts.agg(F.sum("c"), F.count(F.when(F.col("c") > 0, 1)), F.count(F.when(F.col("c") == 1, 1))).first()
    texts = docs.where("not held_out").count()
    total, distinct = int(head[0] or 0) + texts, int(head[1] or 0) + (1 if texts else 0)
    novel = min(1.0, (int(head[2] or 0) + 1) / (total + 1))
    logp = Vocabulary(path).start()
    for _ in range(rounds if distinct else 0):
        logp = _maximise(counts, path, logp)
    p_end = (texts + 1) / (total + 2)
    end = math.log10((texts + 1) / (total + distinct + 1)), math.log10(p_end), math.log10(((1 - novel) * texts + novel) / (total + 1)), int(bool(texts))
    shared = spark.sparkContext.broadcast(logp)

    def rate(batches):
        lattice = Lattice(vocabulary(path), shared.value)
        for b in batches:
            c = b.column(1).to_numpy()
            ways = lattice.score(b.column(0).to_pylist())
            s = math.log10(1 - p_end) + ways / math.log(10)
            whole = (1 - novel) * c / max(1, total)
            m = np.log10(np.maximum(whole + novel * np.exp(np.maximum(ways, -600)), 1e-300))
            # far below what a double holds, the logarithm of the lattice alone is left
            m = np.where((c == 0) & (ways < -600), math.log10(novel) + ways / math.log(10), m)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.log10((c + 1) / (total + distinct + 1))), pa.array(s), pa.array(m)], names=["word", "c", "b", "s", "m"])

    rated = work.save(counts.select("word", "c").mapInArrow(rate, "word binary, c bigint, b double, s double, m double"), "rated")
    work.drop("counts")
    top = rated.where(F.octet_length("word") <= SHORT).orderBy(F.desc("c"), "word").limit(FREQUENT).toPandas()
    frequent = spark.sparkContext.broadcast((dict(zip(map(bytes, top.word), range(len(top)), strict=True)), (top.c > 0).to_numpy(), top[["b", "s", "m"]].to_numpy(float)))

    def texts_of():
        place, known, values = frequent.value
        get = place.get

        def read(texts):
            n, k, sums, rest = [], [], [], []
            for text in texts:
                words = byte_words(text)
                ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
                hit = ids[ids >= 0]
                n.append(len(words) + 1)
                k.append(int(known[hit].sum()) + end[3])
                sums.append(values[hit].sum(0) + end[:3])
                rest.append(Counter(words[i] for i in np.flatnonzero(ids < 0).tolist()))
            sums = np.array(sums, float).reshape(-1, 3)
            return n, k, sums[:, 0], sums[:, 1], sums[:, 2], [list(r) for r in rest], [list(r.values()) for r in rest]

        return read

    added = [("n_tokens", "bigint"), ("n_known", "bigint"), ("base_score", "double"), ("score", "double"), ("word_score", "double"), ("words", "array<binary>"), ("times", "array<bigint>")]
    parts = work.save(map_texts(docs, ["doc_id", "held_out"], ["text"], texts_of, added).withColumn("row", F.monotonically_increasing_id()), "parts")
    rare = parts.select("row", F.explode(F.arrays_zip("words", "times")).alias("x")).select("row", F.col("x.words").alias("word"), F.col("x.times").alias("k"))
    times = lambda c: F.sum(F.col("k") * F.col(c)).alias(c)
    more = rare.join(rated, "word").groupBy("row").agg(F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("k"), times("b"), times("s"), times("m"))
    out = parts.drop("words", "times").join(more, "row", "left")
    plus = lambda c, d: (F.col(c) + F.coalesce(F.col(d), F.lit(0))).alias(c)
    return out.select("doc_id", "held_out", "n_tokens", plus("n_known", "k"), F.lit(total).cast("bigint").alias("train_tokens"), plus("base_score", "b"), plus("score", "s"), plus("word_score", "m"))


def lm_scores(docs: DataFrame) -> DataFrame:
    """Scores of all documents, learnt from those whose crc32(doc_id) mod 7 is not 2."""
    return score_texts(docs, crc_mod("doc_id", 7) == 2)
