"""q_alto_text over whole texts."""

from pageloom.plans import catalog


def test_all_words_are_wrapped(spark, tmp_path):
    texts = [" ".join(f"w{i}" for i in range(n)) for n in (1, 39, 41, 300)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.scan_id: (r.status, r.chars, r.ocr_text) for r in catalog.QUERIES["q_alto_text"](spark, str(tmp_path)).collect()}
    assert got == {f"d{i}": ("ok", len(t), t) for i, t in enumerate(texts)}
