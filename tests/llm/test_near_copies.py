"""The near-copy stage of the pipeline against five-word shingles at 0.8."""

import random

from tests.llm.brute import WORD

import corpus_pipeline


def test_stage_takes_five_words_and_eighty_hundredths(spark):
    rng, data = random.Random(5), []
    for i in range(0, 60, 2):
        w = [f"w{rng.randrange(10**6)}" for _ in range(95)]
        data.append((i, " ".join(w)))
        for k in (20, 60)[: 1 + i // 2 % 2]:
            w[k] = "edited"
        data.append((i + 1, " ".join(w)))

    def alike(a, b, size):
        a, b = ({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} for w in map(WORD.findall, (a, b)))
        return len(a & b) / len(a | b)

    want = {d for d, t in data if d % 2 == 0 or alike(t, data[d - 1][1], 5) < 0.8}
    assert any(0.8 <= alike(data[d - 1][1], t, 5) and alike(data[d - 1][1], t, 4) < 0.85 for d, t in data if d % 2)
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    assert {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()} == want
