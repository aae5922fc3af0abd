"""The whole pipeline against plain versions of its stages."""

from collections import Counter

from pageloom.llm import packing, toxicity
from tests.llm import brute
from tests.llm.fixture import LARGE, corpus, empty, labels

import corpus_pipeline


def test_pipeline(spark, tmp_path):
    """With NULL ids and texts, repeated rows, an id beyond doubles and columns that share names with inner ones."""
    from tokenizers import Tokenizer

    corpus(spark).write.parquet(f"{tmp_path}/documents.parquet")
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    scored = toxicity.score(docs, toxicity.train(docs, spark.read.parquet(f"{tmp_path}/labels.parquet")), docs.columns, "tox")
    clean = scored.where(f"tox < {corpus_pipeline.TOXIC}").collect()
    texts = brute.dedup_lines({r.doc_id: r.text for r in clean if r.doc_id is not None})
    first = brute.first_of_components(texts, corpus_pipeline.COPY_SHINGLE, corpus_pipeline.COPY_PERCENT)
    kept = [(r.doc_id, r.text if r.doc_id is None else texts[r.doc_id], r.lang, r.source) for r in clean if r.doc_id is None or r.doc_id in first]
    times = brute.mix(kept)
    tok = Tokenizer.from_file(packing.tokenizer_path())
    tok.encode_special_tokens = True
    size = {d: len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for d, t, _, _ in kept if brute.WORD.search(t or "")}
    want = Counter({d: n * size[d] for d, n in times.items() if n})
    have = Counter()
    for r in got:
        have[r.doc_id] += r.length
    assert have == want
    assert {LARGE, None} <= {r.doc_id for r in scored.collect()}  # whether or not they stay, their ids are whole
    sizes = Counter()
    for r in got:
        sizes[r.sequence_id] += r.length
    assert all(n == 2048 or n & (n - 1) == 0 for n in sizes.values())
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)


def test_stages_on_an_empty_table(spark, tmp_path):
    empty(spark).write.parquet(f"{tmp_path}/documents.parquet")
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_join", "mixing", "packing"]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.isEmpty()
    assert corpus_pipeline.run(spark, str(tmp_path)).isEmpty()
