"""Line dedup against plain character shingles, where one cut or another once lost lines."""

import random

from pyspark.sql import functions as F

from pageloom.llm import line_dedup
from pageloom.llm.work import Scratch
from tests.llm.brute import WORD, Union


def plain(line):
    t = " ".join(WORD.findall(line.lower()))
    return {t[i : i + 5] for i in range(max(1, len(t) - 4))}


def kept(lines):
    """Places of the lines that no earlier line is joined to."""
    sets, u = [plain(x) for x in lines], Union(len(lines))
    for i in range(len(lines)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                u.join(i, j)
    return {i for i in range(len(lines)) if u.root(i) == i}


def run(spark, lines):
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string")
    return {r.doc_id for r in line_dedup.dedup_lines(docs).collect()}


def words(rng, n):
    return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9))) for _ in range(n)]


def test_all_lines_of_a_band_are_compared(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BLOCK", 16, raising=False)
    rng = random.Random(3)
    passage, lines = " ".join(words(rng, 24)), []
    for _ in range(60):  # far below the threshold among each other, but each with a near copy
        tail = words(rng, 14)
        lines.append(f"{passage} {' '.join(tail)}")
        tail[7] = tail[7][:-1] + "#"
        lines.append(f"{passage} {' '.join(tail)}")
    want = kept(lines)
    assert len(want) == 60
    assert run(spark, lines) == want


def test_one_letter_in_a_short_line(spark):
    rng, lines = random.Random(4), []
    for _ in range(100):
        w = words(rng, rng.randint(10, 26))
        lines.append(" ".join(w))
        k = rng.randrange(len(w))
        w[k] = "#" + w[k][1:]
        lines.append(" ".join(w))
    want, got = kept(lines), run(spark, lines)
    assert len(want) <= 105 and want <= got
    assert len(got - want) <= 3  # links that no band shows


def test_the_end_of_a_long_word_counts(spark):
    lines = [f"source: https://example.org/articles/{k}" for k in ("1234567890", "abcdefghij")] + ["Ab", "AB", "𝔘𝔘 x", "你好", "你们"]
    assert run(spark, lines) == kept(lines) == {0, 1, 2, 4, 5, 6}


def test_families_of_near_copies(spark):
    """Of families of 3, 10 and 100 lines with some words changed, nearly all that plain comparison joins are joined, and no other."""
    rng, lines = random.Random(9), []
    for size, families in ((3, 60), (10, 15), (100, 4)):
        for _ in range(families):
            base = words(rng, 40)
            for _ in range(size):
                w = list(base)
                for k in rng.sample(range(40), rng.randint(1, 3)):
                    w[k] = words(rng, 1)[0]
                lines.append(" ".join(w))
    want, got = kept(lines), run(spark, lines)
    removed = len(lines) - len(want)
    assert removed > 400 and want <= got
    assert (len(lines) - len(got)) / removed >= 0.9


def test_shingles_are_plain_ones():
    rng = random.Random(2)
    lines = [" ".join(words(rng, rng.randint(1, 30))) for _ in range(200)] + ["a", "abcd", "abcde", "ä𝔘ö", "日本語"]
    data = [x.encode() for x in lines]
    sets = line_dedup._sets(data)
    assert [len(s) for s in sets] == [len(plain(x)) for x in lines]
    others = [x[:7] + "#" + x[8:] if i % 2 else lines[i - 1] for i, x in enumerate(lines)]
    want = [100 * len(plain(a) & plain(b)) >= 80 * len(plain(a) | plain(b)) for a, b in zip(lines, others, strict=True)]
    assert line_dedup.alike(data, [x.encode() for x in others]).tolist() == want


def test_no_python_on_the_executors(spark, monkeypatch):
    """DataFrame functions only: no plan of a step or of the result runs Python, and the columns agree with plain shingles."""
    plans, save = [], Scratch.save

    def kept_plan(self, df, name):
        plans.append(df._jdf.queryExecution().toString())
        return save(self, df, name)

    monkeypatch.setattr(Scratch, "save", kept_plan)
    rng = random.Random(6)
    lines = [" ".join(words(rng, rng.randint(1, 30))) for _ in range(60)] + ["a", "abcd", "abcde", "ä𝔘ö", "日本語", "a  b\tC "]
    lines += [x[:7] + "#" + x[8:] for x in lines]
    out = line_dedup.dedup_lines(spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string").coalesce(1))
    plans.append(out._jdf.queryExecution().toString())
    assert len(plans) > 10 and not [p for p in plans if any(x in p for x in ("MapInArrow", "MapInPandas", "PythonUDF", "EvalPython"))]
    n = F.size(F.array_distinct(line_dedup.shingles(line_dedup.spaced(F.lower("a"))))).alias("n")
    got = [r.n for r in spark.createDataFrame([(x,) for x in lines], "a string").select(n).collect()]
    assert got == [len(plain(x)) for x in lines]


def family(rng, near=150, far=60):
    """Lines of one base: near ones are mostly joined; far ones are close to all and alike to few."""
    base, lines = words(rng, 60), []
    for k in range(near + far):
        w = list(base)
        for i in rng.sample(range(60), rng.randint(1, 2) if k < near else rng.randint(5, 6)):
            w[i] = words(rng, 1)[0]
        lines.append(" ".join(w))
    rng.shuffle(lines)
    return lines


def test_a_crowded_band_is_not_verified_pair_by_pair(spark, monkeypatch):
    pairs, save = [], Scratch.save

    def counted(self, df, name):
        out = save(self, df, name)
        if name == "rest":
            pairs.append(out.select("a", "b").count())
            assert out.select("a", "b").distinct().count() == pairs[-1]
        return out

    monkeypatch.setattr(Scratch, "save", counted)
    lines = family(random.Random(12))
    want, got = kept(lines), run(spark, lines)
    assert len(want) > 20 and want <= got
    assert (len(lines) - len(got)) / (len(lines) - len(want)) >= 0.9
    assert pairs and pairs[0] <= 8 * len(lines), pairs


def test_sketches_refuse_no_like_lines(spark):
    """Two sketches differ in no more bits than the lines in shingles, and in nearly as many where these are few."""
    lines = [*family(random.Random(13), 30, 30), "a", "abcde", "日本語 𝔘", " ".join(words(random.Random(14), 1500))]
    rows = line_dedup._sketched(spark.createDataFrame(list(enumerate(lines)), "h bigint, line string")).collect()
    sketch = {r.h: [r[w] & (1 << 64) - 1 for w in line_dedup.SKETCH] for r in rows}
    sets = [plain(x) for x in lines]
    few = 0
    for i in range(len(lines)):
        for j in range(i):
            bits = sum((x ^ y).bit_count() for x, y in zip(sketch[i], sketch[j], strict=True))
            apart = len(sets[i] ^ sets[j])
            assert bits <= apart and (apart - bits) % 2 == 0
            if apart < 100:
                few += 1
                assert bits >= 0.75 * apart
    assert few > 400
