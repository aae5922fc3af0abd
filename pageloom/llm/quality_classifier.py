"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

import functools
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.learning import MAX_ROWS, FactorisationMachine, labelled
from pageloom.llm.work import Memo, byte_words, map_texts

WORDS = 1 << 15
BINS = 16
STATS = 12
SIZE = WORDS + BINS * STATS


def _stats(text: str, words: list[bytes], ids: np.ndarray, n_chars) -> list[float]:
    n, chars = max(1, len(words)), max(1, len(text))
    lines = [x for x in text.split("\n") if x.strip()]
    distinct = len(np.unique(ids))
    runs = int((ids[1:] == ids[:-1]).sum()) if len(ids) > 1 else 0
    upper = int(_capitals()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)].sum())
    given = float(n_chars) if n_chars is not None and n_chars == n_chars else -1.0
    return [
        np.log1p(len(words)), chars / n, upper / chars, text.count("!") / chars, sum(map(text.count, "#*$%&|<>")) / chars, sum(map(text.count, ".,;:")) / chars,
        distinct / n, runs / n, len(set(lines)) / max(1, len(lines)), n / max(1, len(lines)), len(text) - len(text.translate(_NO_DIGIT)), np.log1p(max(given, 0.0)),
    ]


_NO_DIGIT = dict.fromkeys(map(ord, "0123456789"))


@functools.cache
def _capitals() -> np.ndarray:
    """For each code point whether it is a capital letter."""
    return np.fromiter(map(str.isupper, map(chr, range(0x110000))), bool, 0x110000)


def reader(edges: list[np.ndarray] | None):
    """(text, n_chars) -> statistics, or with bin edges the machine's indices and values, words scaled to length 1 in all."""
    memo = Memo(lambda w: zlib.crc32(w) & (WORDS - 1), 150_000)

    def read(text: str | None, n_chars):
        text = text or ""
        words = byte_words(text)
        ids = np.fromiter(map(memo.__getitem__, words), np.int64, len(words))
        stats = _stats(text, words, ids, n_chars)
        u, k = np.unique(ids, return_counts=True)
        if edges is None:
            return stats, u, k
        v = np.log1p(k)
        v = v / np.sqrt((v * v).sum()) if len(v) else v
        bins = [WORDS + BINS * j + int(np.searchsorted(e, s, "right")) for j, (e, s) in enumerate(zip(edges, stats, strict=True))]
        return np.concatenate([u, bins]), np.concatenate([v, np.full(STATS, 0.3)]).astype(np.float32)

    return read


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> tuple[list[np.ndarray], FactorisationMachine]:
    sample = labelled(docs, labels, "quality", max_rows)
    sample = sample.select("text", "y", F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double").alias("n_chars"))

    def learn():
        read = reader(None)
        return lambda texts, n_chars: tuple(zip(*[read(t, c) for t, c in zip(texts, n_chars, strict=True)], strict=True)) or ((), (), ())

    # at most max_rows rows, each of at most WORDS numbers however long its text
    got = map_texts(sample, ["y"], ["text", "n_chars"], learn, [("s", "array<double>"), ("u", "array<bigint>"), ("k", "array<bigint>")]).toPandas()
    s = np.array(got.s.tolist(), float).reshape(len(got), STATS)
    edges = [np.unique(np.quantile(s[:, j], np.linspace(0, 1, BINS + 1)[1:-1]))[: BINS - 1] if len(s) else np.zeros(0) for j in range(STATS)]
    rows = []
    for x, u, k in zip(s, got.u, got.k, strict=True):
        v = np.log1p(np.asarray(k, float))
        v = v / np.sqrt((v * v).sum()) if len(v) else v
        bins = [WORDS + BINS * j + int(np.searchsorted(e, t, "right")) for j, (e, t) in enumerate(zip(edges, x, strict=True))]
        rows.append((np.concatenate([np.asarray(u, np.int64), bins]), np.concatenate([v, np.full(STATS, 0.3)]).astype(np.float32)))
    return edges, FactorisationMachine(SIZE).fit(rows, got.y.to_numpy(float))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every document.

    Learns from labelled rows outside the held-out fifth, at most MAX_ROWS of them. Inputs are the words (hashed), twelve
    statistics of structure in bins, one of them n_chars as given (missing counts as 0). NULL and empty texts have no words
    and are scored by their statistics; very long ones are read whole. Other columns are not read. Without labels every score is that of an even chance. Repeated rows each get their row.
    """
    edges, machine = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast((edges, machine))

    def rate():
        e, m = shared.value
        read = reader(e)
        return lambda texts, n_chars: (1 / (1 + np.exp(-np.clip(np.asarray(m.raw([read(t, c) for t, c in zip(texts, n_chars, strict=True)]), float), -30, 30))),)

    cols = docs.select(F.col("doc_id").cast("bigint"), "text", F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double").alias("n_chars"))
    out = map_texts(cols, ["doc_id"], ["text", "n_chars"], rate, [("score", "double")])
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
