"""Grounding of proposed values: against plain pairs, and one large book whose words all begin alike."""

import random
from threading import Timer

from pyspark.sql import functions as F

from pageloom.functions.text import covered
from pageloom.operators import reconcile

O = "book_id string, scan_index int, ord int, scan_id string, field string, value string"
P = "book_id string, pos int, field string, value string, notes string"
WORDS = ["a", "b", "ab", "ac", "abc", "abd", "abcd", "abcde", "abcdef", "abcdefg", "abcdx", "bcd", "bcde", "b" * 70, "b" * 71, "b" * 69 + "c", "b" * 130, "b" * 64 + "d" * 6, "Ábc"]


def within(spark, seconds, of):
    """What the call returns; its jobs are cancelled, and the call fails, after so many seconds."""
    timer = Timer(seconds, spark.sparkContext.cancelAllJobs)
    timer.start()
    try:
        return of()
    finally:
        timer.cancel()


def test_covering_sets_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(reconcile, "BLOCK", 3)
    rng = random.Random(3)
    some = lambda: sorted(set(rng.choices([w.lower() for w in WORDS], k=rng.randint(1, 4))))
    sets = lambda name: spark.createDataFrame([(rng.choice("xy"), rng.choice("ta"), some()) for _ in range(150)], f"book_id string, field string, {name} array<string>").distinct().localCheckpoint()
    wanted, seen = sets("words"), sets("o_words")
    every = wanted.join(seen, ["book_id", "field"]).where(covered(F.col("words"), F.col("o_words"))).collect()
    got = reconcile.covering(wanted, seen).select("book_id", "field", "words", "o_words").collect()
    assert len(got) == len(every) > 100 and sorted(got) == sorted(every)


def test_sources_are_those_of_all_ways_in_order(spark):
    o = [("x", 0, 0, "s0", "title", "Das Buch"), ("x", 1, 0, "s1", "title", "das  Buch."), ("x", 2, 0, "s2", "author", "DAS BUCH"), ("x", 3, 0, "s3", "title", "D. Buche und mehr"), ("x", 4, 0, "s4", "title", "das  Buch."), ("y", 0, 0, "t0", "title", "Das Buch"), ("x", 5, 0, "s5", "title", None), (None, 0, 0, "u", "title", "Das Buch")]
    p = [("x", 0, "title", "das Buch.", None), ("x", 1, "title", "Das Buch", None), ("x", 2, None, "Das Buch", None), ("x", 3, "title", None, None), ("x", 4, "title", "...", None), (None, 0, "title", "Das Buch", None)]
    got = {(r.book_id, r.pos): (r.fate, r.sources, r.n_sources) for r in reconcile.ground_values(spark.createDataFrame(o, O), spark.createDataFrame(p, P)).collect()}
    assert got == {
        ("x", 0): ("kept", ["s1", "s4", "s0", "s2", "s3"], 5), ("x", 1): ("competing_values", ["s0", "s1", "s2", "s4", "s3"], 5), ("x", 2): ("kept", ["s0", "s1", "s2", "s4"], 4),
        ("x", 3): ("ungrounded_value", None, None), ("x", 4): ("ungrounded_value", None, None), (None, 0): ("ungrounded_value", None, None),
    }


def test_a_large_book_whose_words_begin_alike(spark):
    """30,000 titles with one first letter would make 900 million pairs of them."""
    d = spark.range(30_000)
    title = F.concat(F.lit("Q"), F.md5(F.col("id").cast("string")))
    o = d.select(F.lit("x").alias("book_id"), F.col("id").alias("scan_index"), F.lit(0).alias("ord"), F.col("id").cast("string").alias("scan_id"), F.lit("author").alias("field"), title.alias("value"))
    p = d.select(F.lit("x").alias("book_id"), F.col("id").alias("pos"), F.lit("author").alias("field"), F.upper(title).alias("value"), F.lit(None).cast("string").alias("notes"))
    got = within(spark, 90, lambda: reconcile.ground_values(o, p).groupBy("fate", "origin", "n_sources").count().collect())
    assert [tuple(r) for r in got] == [("kept", "inferred", 1, 30_000)]
