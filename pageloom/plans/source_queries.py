"""Queries over sources and proposals, on documents and files made from the driver's tables, each with its SQL."""

from pyspark.sql import functions as F

from pageloom.operators import reconcile
from pageloom.plans.catalog import query, table
from pageloom.sources import documents, inventory


def _id():
    return F.col("doc_id").cast("string")


def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


@query("""SELECT 'd' || doc_id AS name, list_extract(['gold', 'annotated', 'elements', 'pages', NULL], doc_id % 5 + 1) AS kind FROM documents""")
def q_sniff_documents(spark, sf_dir):
    i = F.col("doc_id") % 5
    body = F.when(i == 0, '{"gold_version": 1}').when(i == 1, '{"schema_version": 2, "scans": []}').when(i == 2, '{"elements": []}').when(i == 3, '{"pages": []}').otherwise('{"other": 1}')
    return docs(spark, sf_dir).select(text("d", _id()).alias("name"), documents.sniff(F.try_parse_json(body)).alias("kind"))


@query("""SELECT 'b' || doc_id AS book_id, 's' || doc_id AS scan_id, 'page_type' AS field, CASE WHEN doc_id % 3 = 0 THEN 'blank' WHEN doc_id % 3 = 1 THEN 'poster' END AS value, doc_id % 3 = 1 AS incomparable FROM documents
UNION ALL SELECT 'b' || doc_id, 's' || doc_id, 'page_number', '[' || doc_id || '],x', false FROM documents""")
def q_catalogue_pages(spark, sf_dir):
    kind = F.when(F.col("doc_id") % 3 == 0, '"Blank"').when(F.col("doc_id") % 3 == 1, '"poster"').otherwise("null")
    body = text('{"document": {"pid": "b', _id(), '"}, "pages": [{"scan_index": 0, "scan_id": "s', _id(), '", "page_number": "(', _id(), '), x", "page_type": ', kind, "}]}")
    d = documents.from_pages(docs(spark, sf_dir).select(F.try_parse_json(body).alias("body")), "catalogue", ["blank", "titlePage"])
    return d.select("book_id", "scan_id", "field", "value", "incomparable")


@query("""WITH RECURSIVE c AS (SELECT 'c' || doc_id AS id, CASE WHEN doc_id > 0 THEN 'c' || (doc_id // 4) END AS parent FROM documents), t AS (SELECT id, 1 AS level FROM c WHERE parent IS NULL UNION ALL SELECT c.id, t.level + 1 FROM t JOIN c ON c.parent = t.id)
SELECT id, CAST(level AS BIGINT) AS level FROM t""")
def q_chapter_levels(spark, sf_dir):
    chapters = docs(spark, sf_dir).select(F.lit("b").alias("book_id"), text("c", _id()).alias("id"), F.when(F.col("doc_id") > 0, text("c", F.floor(F.col("doc_id") / 4).cast("string"))).alias("parent_id"))
    return documents.chapter_levels(chapters).select("id", F.col("level").cast("bigint").alias("level"))


@query("""SELECT 'd' || doc_id AS scan_id, CASE WHEN doc_id % 5 = 0 THEN 'missing' WHEN doc_id % 7 = 0 THEN 'error' ELSE 'ok' END AS status,
 CASE WHEN doc_id % 5 <> 0 AND doc_id % 7 <> 0 THEN 'Line ' || doc_id || chr(10) || chr(10) || 'end' END AS ocr_text,
 CASE WHEN doc_id % 5 <> 0 AND doc_id % 7 = 0 THEN 'several OCR files match the scan: d' || doc_id || '.TXT, d' || doc_id || '.txt' END AS error FROM documents""")
def q_ocr_txt(spark, sf_dir):
    """Text sidecars with a byte-order mark, blank lines and spaces at line ends; some scans have none, some two."""
    d, name = docs(spark, sf_dir), text("d", _id())
    content = F.encode(text("\ufeff\r\n\r\nLine ", _id(), "  \r\n\n\n\nend\t\n"), "UTF-8")
    files = d.where("doc_id % 5 != 0").select(F.explode(F.when(F.col("doc_id") % 7 == 0, F.array(text(name, ".txt"), text(name, ".TXT"))).otherwise(F.array(text(name, ".txt")))).alias("filename"), content.alias("content"))
    return inventory.attach_ocr(d.select(name.alias("scan_id")), files).select("scan_id", "ocr.status", "ocr_text", "ocr.error")


@query("""SELECT 'listed twice: d' || (doc_id // 2) AS problem FROM documents WHERE doc_id % 20 = 0 UNION ALL SELECT 'a path, not a name: x/d' || doc_id FROM documents WHERE doc_id % 50 = 1""")
def q_order_problems(spark, sf_dir):
    d = docs(spark, sf_dir)
    names = d.where("doc_id % 20 in (0, 1)").select(text("d", F.floor((F.col("doc_id") - F.col("doc_id") % 20) / 2).cast("string")).alias("name")).unionByName(d.where("doc_id % 50 = 1").select(text("x/d", _id()).alias("name")))
    return inventory.order_problems(names)


@query("SELECT 'd' || doc_id AS scan_id, f AS field, 'not_reviewed' AS status FROM documents, (VALUES ('side'), ('page_type')) t(f)")
def q_gold_template(spark, sf_dir):
    scans = docs(spark, sf_dir).select(F.col("source").alias("book_id"), text("d", _id()).alias("scan_id"), F.col("doc_id").alias("scan_index"), F.sha2("text", 256).alias("image_sha256"))
    return inventory.gold_template(scans, ["side", "page_type"]).select("scan_id", "field", "status")


@query("SELECT 'd' || doc_id AS scan_id FROM documents WHERE doc_id < 30 AND doc_id IN (7, 8, 40)")
def q_select_scans(spark, sf_dir):
    scans = docs(spark, sf_dir).select(F.col("doc_id").alias("scan_index"), text("d", _id()).alias("scan_id"))
    return inventory.select_scans(scans, 30, ["d7", "d8", "d40"]).select("scan_id")


@query("SELECT source, doc_id, last_value(CASE WHEN n_chars % 3 = 0 THEN n_chars END IGNORE NULLS) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_v FROM documents")
def q_nearest_earlier(spark, sf_dir):
    d = docs(spark, sf_dir).select("source", "doc_id", F.when(F.col("n_chars") % 3 == 0, F.col("n_chars")).alias("v"))
    return inventory.nearest_earlier(d, ["source"], "doc_id", "v").select("source", "doc_id", "last_v")


@query("SELECT source AS book_id, 'title' AS field, CAST(count(DISTINCT n_chars % 4) AS BIGINT) AS forms FROM documents WHERE doc_id % 2 = 0 GROUP BY source HAVING count(DISTINCT n_chars % 4) > 1")
def q_competing_observed(spark, sf_dir):
    """Values that differ only in marks, case and spaces are one form."""
    n = (F.col("n_chars") % 4).cast("string")
    value = F.when(F.col("doc_id") % 4 == 0, text("Das  Buch ", n, ".")).otherwise(text("das BUCH ", n))
    observed = docs(spark, sf_dir).select(F.col("source").alias("book_id"), F.when(F.col("doc_id") % 2 == 0, "title").otherwise("author").alias("field"), value.alias("value"), F.col("doc_id").alias("scan_index"))
    return reconcile.competing_observed(observed).select("book_id", "field", "forms")


@query("""WITH c AS (SELECT doc_id, doc_id % 2 = 0 AS toc, doc_id % 3 = 0 AS head, doc_id % 2 = 0 AND doc_id % 5 <> 0 AS in_toc, doc_id % 3 = 0 AND doc_id % 4 <> 0 AS in_head FROM documents)
SELECT doc_id, in_toc OR in_head AS kept, CASE WHEN in_head THEN 'observed' WHEN in_toc THEN 'inferred' END AS origin, CASE WHEN in_toc AND doc_id % 7 <> 0 THEN CAST(doc_id AS VARCHAR) END AS ref,
 concat_ws(',', CASE WHEN toc AND NOT in_toc THEN 'unmatched_toc_entry' END, CASE WHEN head AND NOT in_head THEN 'unmatched_heading' END, CASE WHEN NOT (in_toc AND doc_id % 7 <> 0) THEN 'ungrounded_reference' END, CASE WHEN NOT in_toc AND NOT in_head THEN 'ungrounded_chapter' END) AS codes FROM c""")
def q_ground_chapters(spark, sf_dir):
    d, i, none = docs(spark, sf_dir), F.col("doc_id"), F.array().cast("array<string>")
    book, title = F.col("source").alias("book_id"), text("Kapitel n", _id())
    chapters = d.select(
        book, i.alias("pos"), title.alias("title"), F.lit(1).alias("level"), F.when(i % 2 == 0, F.array(text("t", _id()))).otherwise(none).alias("toc_ids"), F.when(i % 3 == 0, F.array(text("h", _id()))).otherwise(none).alias("heading_ids"),
        F.when(i % 7 == 0, text("x", _id())).otherwise(_id()).alias("ref"),
    )
    toc = d.select(book, text("t", _id()).alias("scan_id"), F.when(i % 5 == 0, "anderes").otherwise(text("KAPITEL N", _id(), ".")).alias("title"), _id().alias("ref"))
    headings = d.select(book, text("h", _id()).alias("scan_id"), F.when(i % 4 == 0, "nichts").otherwise(title).alias("text"))
    return reconcile.ground_chapters(chapters, toc, headings).select(F.col("pos").alias("doc_id"), "kept", "origin", "ref", F.array_join("codes", ",").alias("codes"))


@query("""SELECT source AS book_id, doc_id AS pos, 'title' AS field, CASE WHEN doc_id % 3 = 2 THEN 'ungrounded_value' WHEN row_number() OVER (PARTITION BY source, doc_id % 3 = 2 ORDER BY doc_id) > 1 THEN 'competing_values' ELSE 'kept' END AS fate,
 CASE WHEN doc_id % 3 <> 2 AND row_number() OVER (PARTITION BY source, doc_id % 3 = 2 ORDER BY doc_id) = 1 THEN CASE WHEN doc_id % 3 = 0 THEN 'observed' ELSE 'inferred' END END AS origin FROM documents""")
def q_ground_values(spark, sf_dir):
    """Whole titles proposed as they were seen, in another case, or not seen at all."""
    d, i = docs(spark, sf_dir), F.col("doc_id")
    seen = d.select(F.col("source").alias("book_id"), i.alias("scan_index"), F.lit(0).alias("ord"), text("d", _id()).alias("scan_id"), F.lit("title").alias("field"), text("Q", F.md5(_id())).alias("value"))
    value = F.when(i % 3 == 0, text("Q", F.md5(_id()))).when(i % 3 == 1, F.upper(text("q", F.md5(_id())))).otherwise(text("Z", F.md5(_id())))
    proposed = d.select(F.col("source").alias("book_id"), i.alias("pos"), F.lit("title").alias("field"), value.alias("value"), F.lit(None).cast("string").alias("notes"))
    return reconcile.ground_values(seen, proposed).select("book_id", "pos", "field", "fate", "origin")
