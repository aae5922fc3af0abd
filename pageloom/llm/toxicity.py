"""Toxicity: gradient-boosted trees over dense features of the text, calibrated by isotonic regression."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.learning import MAX_ROWS, Isotonic, Trees, labelled
from pageloom.llm.work import SLICE, Memo, map_texts

#: Pronouns of the second person in the languages of the corpus.
SECOND = frozenset("you your yours yourself ya u du dich dir dein deine deinen deiner ihr euch sie tu te toi ton ta tes vous votre vos tú ti tuyo usted ustedes os vosotros su".split())
_LEET = str.maketrans("013457@$!|", "oieastasil")
_EDGE = re.compile(r"^\W+|\W+$")
_MARKS = ".,;:!?\"'()[]"
_INNER = re.compile(r"[\W\d_]")
_SAME = re.compile(r"(.)\1{2,}")
LEXICON = 2000
NEAR = 4
FEATURES = 22
#: Parts of the sample, by checksums of texts: each is scored by trees that have not seen it.
FOLDS = 4


def _bare(word: str) -> str:
    return _EDGE.sub("", word).lower()


def _plain(word: str) -> str:
    """The word as it reads without leetspeak, inner marks and stretched letters."""
    return _SAME.sub(r"\1", re.sub(r"[\W\d_]+", "", word.lower().translate(_LEET)))


def learn_lexicon(sample: DataFrame, n_rows: int, n_toxic: int) -> dict[str, float]:
    """At most LEXICON words with the largest log odds of standing in a toxic document, by counts over the sample."""

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, SLICE):
                part = b.slice(lo, SLICE)
                out = [(w, y) for t, y in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True) for w in {_bare(x) for x in (t or "").split()} if w]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in out], pa.string()), pa.array([y for _, y in out], pa.float64())], names=["word", "y"])

    counts = sample.select("text", "y").mapInArrow(run, "word string, y double").groupBy("word").agg(F.count("*").alias("n"), F.sum("y").alias("t"))
    least = max(3, n_toxic // 500)
    odds = F.log((F.col("t") + 0.5) / (n_toxic + 1)) - F.log((F.col("n") - F.col("t") + 0.5) / (n_rows - n_toxic + 1))
    rows = counts.where(F.col("t") >= least).withColumn("odds", odds).where("odds > 1.5").orderBy(F.desc("odds"), "word").limit(LEXICON).collect()
    return {r["word"]: float(r["odds"]) for r in rows}


def featurizer(lexicon: dict[str, float]):
    """text -> FEATURES numbers. Each distinct word is looked at once for a bounded memo; a text costs one lookup a word."""

    def flags(raw: str) -> int:
        bare = raw.strip(_MARKS)
        if not bare.isalpha():
            bare = _EDGE.sub("", raw)
        word = bare.lower()
        # by the raw word, so that a disguised first or last letter counts; "!" may be one
        stretched, mixed = bool(_SAME.search(raw)), not raw.strip(_MARKS.replace("!", "")).isalpha()
        weight, code = lexicon.get(word), 0
        if weight is not None:
            code |= 1 | min(255, int(weight * 16)) << 8
        elif (stretched or mixed) and len(p := _plain(raw)) > 3 and (w := lexicon.get(p)) is not None:
            code |= 2 | min(255, int(w * 16)) << 8
        elif len(word) > 6 and any(word[i : i + n] in strong for n in lengths for i in range(len(word) - n + 1)):
            code |= 128
        code |= 4 * (word in SECOND) | 8 * (len(bare) > 1 and raw.isupper()) | 16 * bool(mixed and _INNER.search(word) and any(c.isalpha() for c in word))
        return code | 32 * stretched | 64 * raw[:1].isupper()

    strong = frozenset(k for k, v in lexicon.items() if v > 3 and len(k) > 4)
    lengths = sorted({len(k) for k in strong})
    memo = Memo(flags, 150_000)

    def features(text: str | None) -> np.ndarray:
        text = text or ""
        words = text.split()
        n, chars = max(1, len(words)), max(1, len(text))
        c = np.fromiter(map(memo.__getitem__, words), np.int64, len(words))
        hit, odd = np.flatnonzero(c & 1), np.flatnonzero(c & 2)
        weights = (c[c & 3 > 0] >> 8) / 16
        second = np.flatnonzero(c & 4)
        both = np.concatenate([hit, odd])
        if len(second) and len(both):
            at = np.searchsorted(second, both)
            gap = np.minimum(np.abs(second[np.minimum(at, len(second) - 1)] - both), np.abs(second[np.maximum(at - 1, 0)] - both))
        else:
            gap = np.full(len(both), 1000)
        distinct = len({words[i].lower() for i in hit.tolist()})
        share = lambda bit: float(np.count_nonzero(c & bit)) / n
        rate = lambda s: text.count(s) / chars
        out = [
            len(hit) / n, np.log1p(len(hit)), distinct, weights.max(initial=0), weights.sum() / n, weights.sum(), len(odd) / n, np.log1p(len(odd)),
            float((gap <= NEAR).sum()) / n, float((gap <= NEAR).sum()), share(4), share(8), share(16), share(32), share(64), share(128),
            rate("!"), rate("?"), rate("."), sum(map(text.count, "#*$%&@")) / chars, np.log1p(len(words)), chars / n,
        ]
        return np.array(out)

    return features


class Model:
    def __init__(self, lexicon: dict[str, float], trees: Trees, scale: Isotonic):
        self.lexicon, self.trees, self.scale = lexicon, trees, scale


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """The lexicon and the trees are learned from all of the sample, calibration from scores of each fold by trees of the other folds."""
    sample = labelled(docs, labels, "toxic", max_rows).select("text", "y")
    n = sample.agg(F.count("*"), F.sum("y")).first()
    lexicon = learn_lexicon(sample, int(n[0] or 0), int(n[1] or 0))

    def read():
        features = featurizer(lexicon)
        return lambda texts: ([zlib.crc32((t or "").encode("utf-8", "replace")) % FOLDS for t in texts], [features(t) for t in texts])

    got = map_texts(sample, ["y"], ["text"], read, [("fold", "bigint"), ("x", "array<double>")]).toPandas()  # at most max_rows rows of FEATURES numbers
    x, y, fold = np.array(got.x.tolist(), float).reshape(len(got), FEATURES), got.y.to_numpy(float), got.fold.to_numpy()
    out = np.zeros(len(y))
    for k in range(FOLDS if len(y) else 0):
        out[fold == k] = Trees().fit(x[fold != k], y[fold != k]).raw(x[fold == k])
    return Model(lexicon, Trees().fit(x, y), Isotonic().fit(out, y))


def score(docs: DataFrame, model: Model, keep: list[str], to: str = "toxicity") -> DataFrame:
    """keep and `to` (0 to 1) for every row; the model, bounded by its lexicon and trees, goes to the executors."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rate():
        m = shared.value
        features = featurizer(m.lexicon)
        return lambda texts: (m.scale(m.trees.raw(np.array([features(t) for t in texts]).reshape(len(texts), FEATURES))),)

    return map_texts(docs, keep, ["text"], rate, [(to, "double")])


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document.

    Learns from labelled rows outside the held-out fifth, at most MAX_ROWS of them. Features: densities of learned
    words, plain and disguised, their nearness to the second person, capitals, punctuation, stretched and mixed words.
    Very long texts are read whole. NULL and empty texts get the score of a text without words. Without labels every score is the same. Repeated rows each
    get their row; no other column is read.
    """
    out = score(docs.select("doc_id", "text"), train(docs, labels), ["doc_id"])
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))
