"""A small corpus with what operators must bear: NULLs, empty and long texts, copies, repeated rows, clashing columns."""

import random

from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

SCHEMA = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()), StructField("source", StringType()), StructField("n_chars", LongType()),
    StructField("length", StringType()), StructField("rank", IntegerType()), StructField("score", DoubleType()), StructField("bucket", StringType()), StructField("c", StringType()), StructField("h", StringType()), StructField("g", StringType()),
    *[StructField(c, StringType()) for c in ("tokens", "domain", "epoch", "toxicity", "_part", "_maybe", "_of", "_removed", "_domain", "key", "fold", "word")],
])
#: Beyond what a double holds; beside a NULL id it must stay as it is.
LARGE = (1 << 53) + 1


def rows(n: int = 60, seed: int = 1):
    rng = random.Random(seed)
    syllables = ["an", "ber", "cho", "del", "en", "fro", "gi", "hul", "is", "jo", "ka", "lum"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))
    line = lambda k: " ".join(word() for _ in range(k)).capitalize() + "."
    text = lambda: "\n".join(line(rng.randint(3, 14)) for _ in range(rng.randint(1, 6)))
    out = []
    for i in range(n):
        t = text()
        if i % 6 == 5:
            t = out[i - 3][1]
        elif i % 6 == 4 and out[i - 4][1]:
            w = out[i - 4][1].split(" ")
            w[len(w) // 2] = "changed"
            t = " ".join(w)
        elif i % 10 == 3:
            t += " you idiot scum"
        elif i % 10 == 7:
            t = "spam### " * 30
        out.append([i, t, rng.choice(["en", "de", None]), rng.choice(["s1", "s1", "s2", None]), len(t)])
    out += [[n, None, None, None, None], [n + 1, "", "en", "s1", 0], [n + 2, " \t\n ", "en", "s1", 4], [n + 3, " ".join(word() for _ in range(6000)), "en", "s1", None]]
    out += [[None, text(), "en", "s2", 5], [None, None, None, None, None], list(out[0]), list(out[0]), [n + 4, "Äé 𝔘 ' ż x", "de", "s2", 9]]
    out.append([LARGE, text(), "en", "s1", 7])
    return [tuple(r) + ("x", 1, 0.5, "y", "z", "q", "w", *"abcdefghijkl") for r in out]


def corpus(spark, n: int = 60):
    return spark.createDataFrame(rows(n), SCHEMA).repartition(3)


def labels(spark, n: int = 60):
    data = [(i, int(i % 10 != 7), int(i % 10 == 3)) for i in range(n)] + [(None, 1, None), (1, None, None)]
    return spark.createDataFrame(data, "doc_id bigint, quality int, toxic int")


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
