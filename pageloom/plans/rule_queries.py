"""Queries over integrity rules, scoring details and text forms, each with its SQL."""

from pyspark.sql import functions as F

from pageloom.functions import text as T
from pageloom.operators import bibliography, context, pagination, reconcile, scoring, usage, validate
from pageloom.plans.book_queries import _EVAL, evaluation, turns
from pageloom.plans.catalog import query, table
from pageloom.sources import documents, inventory


def _id():
    return F.col("doc_id").cast("string")


def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


# --- text forms ---

_FOLD = "replace(lower(nfc_normalize({})), 'ß', 'ss')"
_SPACES = r"regexp_replace({}, '[\s\x{{a0}}]+', ' ', 'g')"
_KEY = f"replace(lower(trim({_SPACES.format(r"regexp_replace(text, '[.,;:]+(\s|$)', '\1', 'g')")})), 'ß', 'ss')"


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN CAST(doc_id AS VARCHAR) ELSE list_extract(['I','II','III','IV','V','VI','VII','VIII','IX','X'], doc_id % 10 + 1) END AS shown FROM documents")
def q_format_number(spark, sf_dir):
    value = F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")).otherwise(F.col("doc_id") % 10 + 1)
    return docs(spark, sf_dir).select("doc_id", T.format_number(value, F.when(F.col("doc_id") % 2 == 0, "arabic").otherwise("roman")).alias("shown"))


@query("SELECT doc_id, '[' || doc_id || '],' || (doc_id + 1) AS label FROM documents")
def q_normalize_label(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", T.normalize_label(F.concat(F.lit(" ["), _id(), F.lit("],\t "), (F.col("doc_id") + 1).cast("string"), F.lit("\n"))).alias("label"))


@query(f"SELECT doc_id, md5(trim({_SPACES.format(_FOLD.format('text'))}, ' .,:;/-–—')) AS form FROM documents")
def q_normalize_text(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.md5(T.normalize_text("text")).alias("form"))


@query(f"SELECT doc_id, md5({_KEY}) AS form FROM documents")
def q_comparison_key(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.md5(T.comparison_key(F.col("text"))).alias("form"))


@query("SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE doc_id % 3 <> 0 END AS same FROM documents")
def q_same_text(spark, sf_dir):
    other = F.concat(F.lit(" "), F.replace("text", F.lit(" "), F.lit("  ")), F.when(F.col("doc_id") % 3 == 0, " x").otherwise("\t"))
    return docs(spark, sf_dir).select("doc_id", T.same_text(F.col("text"), other).alias("same"))


@query("SELECT doc_id, 'data:image/png;base64,' || to_base64(encode(text)) AS url FROM documents")
def q_data_url(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", T.data_url(F.lit("image/png"), F.encode("text", "UTF-8")).alias("url"))


_WORDS = "SELECT doc_id, left(md5(CAST(doc_id AS VARCHAR)), CAST(1 + doc_id % 9 AS INTEGER)) AS a, left(md5(CAST(doc_id AS VARCHAR)), CAST(1 + doc_id % 7 AS INTEGER)) || repeat('x', CAST(doc_id % 4 AS INTEGER)) AS b FROM documents"


def _words(spark, sf_dir):
    m, i = F.md5(_id()), F.col("doc_id")
    return docs(spark, sf_dir).select("doc_id", F.left(m, (1 + i % 9).cast("int")).alias("a"), F.concat(F.left(m, (1 + i % 7).cast("int")), F.repeat(F.lit("x"), (i % 4).cast("int"))).alias("b"))


_MATCH = """(a = b OR (least(length(a), length(b)) = 1 AND left(a, 1) = left(b, 1)) OR (least(length(a), length(b)) > 1 AND least(length(a), length(b)) >= greatest(3, least(length(a), length(b)) - 2)
 AND left(a, greatest(3, least(length(a), length(b)) - 2)) = left(b, greatest(3, least(length(a), length(b)) - 2))))"""


@query(f"SELECT doc_id, {_MATCH} AS match FROM ({_WORDS}) w")
def q_word_match(spark, sf_dir):
    return _words(spark, sf_dir).select("doc_id", T.word_match(F.col("a"), F.col("b")).alias("match"))


@query(f"SELECT doc_id, {_MATCH} OR {_MATCH.replace('b)', 'a)').replace('= b', '= a')} AS covered FROM ({_WORDS}) w")
def q_covered(spark, sf_dir):
    """A word against itself and another: always covered, whichever stands first."""
    return _words(spark, sf_dir).select("doc_id", T.covered(F.array("a"), F.array("b", "a")).alias("covered"))


# --- scoring ---


@query(_EVAL + """, e AS (SELECT DISTINCT doc_id, n_chars FROM g)
SELECT 'rule' AS system, 'observed' AS layer, CAST(count(*) FILTER (doc_id % 7 <> 0) AS BIGINT) AS compared, CAST(count(*) FILTER (doc_id % 7 = 0) AS BIGINT) AS missing,
 CAST(count(*) FILTER (doc_id % 7 <> 0 AND doc_id % 17 = 0) AS BIGINT) AS hash_mismatch, CAST(count(*) FILTER (doc_id % 7 <> 0) AS BIGINT) AS hash_checked, CAST(0 AS BIGINT) AS index_differs FROM e""")
def q_scan_summary(spark, sf_dir):
    gold, pred, _ = evaluation(spark, sf_dir)
    return scoring.scan_summary(scoring.score_scans(gold, pred))


@query("SELECT 'rule' AS system, 'observed' AS layer, f AS field FROM (VALUES ('quality'), ('toxic')) t(f)")
def q_provided_fields(spark, sf_dir):
    return bibliography.provided_fields(evaluation(spark, sf_dir)[1])


@query(_EVAL + " SELECT 'd' || doc_id AS scan_id, field, outcome FROM o WHERE outcome IS NOT NULL AND outcome NOT IN ('correct', 'no_prediction', 'scan_missing')")
def q_score_errors(spark, sf_dir):
    gold, pred, _ = evaluation(spark, sf_dir)
    return scoring.errors(scoring.score_scans(gold, pred)).select("scan_id", "field", "outcome")


@query("""SELECT 'rule' AS system, 'observed' AS layer, 'side' AS field, lang AS raw, CAST(count(*) AS BIGINT) AS n FROM documents WHERE n_chars % 4 = 0 GROUP BY lang""")
def q_incomparable_values(spark, sf_dir):
    p = docs(spark, sf_dir).select(F.lit("rule").alias("system"), F.lit("observed").alias("layer"), F.lit("side").alias("field"), F.col("lang").alias("value"), (F.col("n_chars") % 4 == 0).alias("incomparable"))
    return scoring.incomparable_values(p)


#: Books are documents; titles of two words in another spacing and case, or of another document; every rule of the outcome occurs.
@query("""SELECT 'catalogue' AS system, 'd' || doc_id AS book_id, 'title' AS field, CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN 'ambiguous_unscorable' WHEN doc_id % 7 = 0 THEN 'scan_missing' WHEN doc_id % 5 = 0 THEN 'no_prediction'
 WHEN doc_id % 17 = 0 THEN 'document_incompatible' WHEN doc_id % 3 = 0 THEN CASE WHEN doc_id % 4 = 0 THEN 'correct' WHEN doc_id % 2 = 0 THEN 'spurious_value' ELSE 'spurious_value' END
 WHEN doc_id % 4 = 0 THEN 'missing_value' WHEN doc_id % 2 = 0 THEN 'wrong_value' ELSE 'correct' END AS outcome FROM documents""")
def q_score_bibliography(spark, sf_dir):
    i = F.col("doc_id")
    d = docs(spark, sf_dir).select("doc_id", F.concat(F.lit("d"), _id()).alias("book_id"))
    title = F.array(F.concat(F.lit("Große Reise "), _id(), F.lit(".")), F.lit("Band 2"))
    none = F.array(F.lit(None).cast("array<string>"))
    gold = d.select("book_id", F.lit("title").alias("field"), F.when(i % 11 == 0, "not_reviewed").when(i % 13 == 0, "ambiguous").when(i % 3 == 0, "absent").otherwise("verified").alias("status"),
                    F.when((i % 11 != 0) & (i % 13 != 0), F.when(i % 3 == 0, none).otherwise(F.array(title))).alias("accept"))
    books = d.where("doc_id % 7 != 0").select(F.lit("catalogue").alias("system"), "book_id", "doc_id")
    value = F.when(i % 4 == 0, F.array().cast("array<string>")).when(i % 2 == 0, F.array(F.lit("Another title"))).otherwise(F.array(F.lit("BAND 2"), F.concat(F.lit("  GROSSE  reise "), _id())))
    pred = books.where("doc_id % 5 != 0").select("system", "book_id", F.lit("title").alias("field"), value.alias("value"))
    checks = books.select("system", "book_id", (i % 17 != 0).alias("compatible"))
    return bibliography.score_bibliography(gold, pred, books.drop("doc_id"), checks).select("system", "book_id", "field", "outcome")


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE 'VII,' || doc_id END AS form, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE '0' || doc_id || ',vii' END AS exact FROM documents")
def q_canonical_numbers(spark, sf_dir):
    values = F.when(F.col("doc_id") % 4 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("vii"), F.concat(F.lit("0"), _id())))
    joined = lambda f: F.array_join(F.reverse(bibliography.canonical(f, values)) if f.endswith("normalized") else bibliography.canonical(f, values), ",")
    return docs(spark, sf_dir).select("doc_id", joined("printed_numbers_normalized").alias("form"), joined("printed_numbers_exact").alias("exact"))


# --- context, pagination, references ---


@query("""WITH c AS (SELECT conv_id AS book_id, turn, CASE WHEN turn % 2 = 0 THEN 'title' ELSE 'author' END AS field, 'v' || length(text) % 3 AS value FROM conversations WHERE length(text) % 11 <> 0)
SELECT book_id, field, value, string_agg(DISTINCT CAST(turn AS VARCHAR), ',' ORDER BY CAST(turn AS VARCHAR)) AS seen, CAST(row_number() OVER (PARTITION BY book_id, field ORDER BY min(turn)) AS BIGINT) AS rank FROM c GROUP BY book_id, field, value""")
def q_context_first_seen(spark, sf_dir):
    seen = F.array_join(F.array_sort(F.transform("seen", lambda x: x.cast("string"))), ",")
    return context.first_seen(turns(spark, sf_dir)).select("book_id", "field", "value", seen.alias("seen"), F.col("rank").cast("bigint").alias("rank"))


_REGULAR = """SELECT source AS book_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i, n_chars % 3 = 0 AS free, n_chars % 5 = 0 AS plate FROM documents"""
#: Books whose printed numbers count their pages without plates; some pages print none. The number of each page is known.
_NUMBERED = f"""
WITH r AS (SELECT *, plate OR free AS bare, sum(CASE WHEN plate THEN 0 ELSE 1 END) OVER (PARTITION BY book_id ORDER BY i) AS n FROM ({_REGULAR}) x),
e AS (SELECT *, max(CASE WHEN bare THEN 0 ELSE i END) OVER (PARTITION BY book_id) AS last_i, max(CASE WHEN bare THEN 0 ELSE n END) OVER (PARTITION BY book_id) AS last_n FROM r),
v AS (SELECT *, CASE WHEN last_i = 0 OR i <= last_i THEN CASE WHEN NOT plate THEN n END ELSE last_n + i - last_i END AS value FROM e),
p AS (SELECT *, sum(CASE WHEN value IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY book_id ORDER BY i) AS part, coalesce(max(value) OVER (PARTITION BY book_id ORDER BY i), 1) AS base FROM v),
l AS (SELECT *, sum(CASE WHEN value IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY book_id, part ORDER BY i) AS nth FROM p)"""


def regular(spark, sf_dir):
    docs(spark, sf_dir).createOrReplaceTempView("documents")
    d = spark.sql(_NUMBERED + " SELECT book_id, i, plate, bare, n FROM l")
    n, none = F.col("n").cast("int"), F.lit(None).cast("string")
    number = F.struct(none.alias("side"), n.cast("string").alias("raw"), n.cast("string").alias("normalized"), n.alias("numeric_value"), F.lit("arabic").alias("numeral_system"))
    numbers = F.when(~F.col("bare"), F.array(number)).otherwise(F.array().cast(f"array<{pagination.NUMBER}>"))
    return d.select("book_id", (F.col("i") - 1).cast("int").alias("scan_index"), F.lit("normalPage").alias("page_type"), none.alias("side"), F.when(F.col("plate"), "plate").alias("leaf"), numbers.alias("numbers"), F.array().cast(f"array<{pagination.SUBPAGE}>").alias("subpages"))


@query(_NUMBERED + """ SELECT book_id, CAST(i - 1 AS BIGINT) AS scan_index, CASE WHEN NOT bare THEN CAST(value AS VARCHAR) WHEN value IS NOT NULL THEN '[' || value || ']'
 ELSE '[' || base || CASE WHEN nth <= 26 THEN chr(CAST(96 + nth AS INTEGER)) ELSE chr(CAST(96 + (nth - 1) // 26 AS INTEGER)) || chr(CAST(97 + (nth - 1) % 26 AS INTEGER)) END || ']' END AS page_number FROM l""")
def q_regular_page_numbers(spark, sf_dir):
    return pagination.scan_page_numbers(pagination.page_labels(regular(spark, sf_dir))).select("book_id", F.col("scan_index").cast("bigint").alias("scan_index"), "page_number")


@query(_NUMBERED + """, a AS (SELECT book_id, min(i) AS a, max(i) AS b, min(n) AS u, max(n) AS v FROM l WHERE NOT bare GROUP BY book_id)
SELECT book_id, CASE WHEN a = b THEN '- scan ' || a || ': arabic ' || u ELSE '- scans ' || a || '-' || b || ': arabic ' || u || '-' || v END AS line FROM a""")
def q_regular_runs(spark, sf_dir):
    paged = pagination.pages(regular(spark, sf_dir))
    return pagination.number_runs(paged, pagination.anchors(paged)).select("book_id", "line")


@query("""WITH n AS (SELECT source AS book_id, count(*) AS n FROM documents GROUP BY 1), s AS (SELECT source AS book_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS p, 'd' || doc_id AS scan_id FROM documents),
r AS (SELECT source AS book_id, doc_id AS pos, unnest([n_chars % 60, doc_id % 7, n_chars % 60]) AS p FROM documents)
SELECT r.pos, coalesce(string_agg(DISTINCT s.scan_id, ',' ORDER BY s.scan_id), '') AS scan_ids, CAST(count(*) FILTER (r.p < 1 OR r.p > n.n) AS BIGINT) AS n_outside FROM r JOIN n USING (book_id) LEFT JOIN s ON s.book_id = r.book_id AND s.p = r.p GROUP BY r.pos""")
def q_reference_positions(spark, sf_dir):
    from pyspark.sql import Window

    d = docs(spark, sf_dir)
    scans = d.select(F.col("source").alias("book_id"), (F.row_number().over(Window.partitionBy("source").orderBy("doc_id")) - 1).cast("bigint").alias("scan_index"), F.concat(F.lit("d"), _id()).alias("scan_id"))
    refs = d.select(F.col("source").alias("book_id"), F.col("doc_id").alias("pos"), F.array(F.col("n_chars") % 60, F.col("doc_id") % 7, F.col("n_chars") % 60).alias("positions"))
    out = reconcile.reference_positions(refs, scans, d.groupBy(F.col("source").alias("book_id")).agg(F.count("*").alias("n")))
    return out.select("pos", F.array_join(F.array_sort("scan_ids"), ",").alias("scan_ids"), F.size("outside").cast("bigint").alias("n_outside"))


# --- usage, inventory ---


@query("SELECT conv_id, CAST(turn AS BIGINT) AS turn, CAST(row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS BIGINT) AS attempt FROM conversations")
def q_number_attempts(spark, sf_dir):
    d = usage.number_attempts(table(spark, sf_dir, "conversations"), ["conv_id", "role"], "turn")
    return d.select("conv_id", F.col("turn").cast("bigint").alias("turn"), F.col("attempt").cast("bigint").alias("attempt"))


_OCR = "SELECT *, CASE WHEN n_chars % 7 = 0 THEN 'missing' WHEN n_chars % 7 = 1 THEN 'error' ELSE 'ok' END AS status, CASE WHEN doc_id % 2 = 0 THEN 'txt' ELSE 'alto' END AS format, n_chars > 2000 AS long FROM documents"


def ocr(spark, sf_dir):
    n, i = F.col("n_chars"), F.col("doc_id")
    status = F.when(n % 7 == 0, "missing").when(n % 7 == 1, "error").otherwise("ok")
    d = docs(spark, sf_dir).select(F.col("source").alias("book_id"), "doc_id", F.concat(F.lit("d"), _id()).alias("scan_id"), "n_chars", status.alias("status"))
    here, ok = F.col("status") != "missing", F.col("status") == "ok"
    file = F.when(here | (i % 11 == 0), F.concat("scan_id", F.lit(".txt")))
    o = F.struct(
        "status", file.alias("filename"), F.when(here, F.when(i % 2 == 0, "txt").otherwise("alto")).alias("format"), F.when(ok & (i % 13 != 0), "hash").alias("sha256"), F.when(ok, n).alias("chars"), F.when(ok, F.least(n, F.lit(2000))).alias("sent_chars"),
        ((n > 2000) & (ok | (i % 17 == 0))).alias("truncated"), F.when((F.col("status") == "error") & (i % 5 != 0), "bad bytes").alias("error"),
    )
    return d.select("book_id", F.col("doc_id").alias("scan_index"), "scan_id", o.alias("ocr"))


@query(f"""SELECT source AS book_id, CAST(count(*) FILTER (status = 'ok' AND format = 'txt') AS BIGINT) AS txt, CAST(count(*) FILTER (status = 'ok' AND format = 'alto') AS BIGINT) AS alto, CAST(count(*) FILTER (status = 'missing') AS BIGINT) AS missing,
 CAST(count(*) FILTER (status = 'error') AS BIGINT) AS error, CAST(count(*) FILTER (long AND (status = 'ok' OR doc_id % 17 = 0)) AS BIGINT) AS truncated FROM ({_OCR}) o GROUP BY source""")
def q_ocr_summary(spark, sf_dir):
    return inventory.ocr_summary(ocr(spark, sf_dir), "book_id")


@query(f"SELECT 'd' || doc_id AS scan_id, 'OCR of scan d' || doc_id || ' (d' || doc_id || '.txt) not used, image only: bad bytes' AS problem FROM ({_OCR}) o WHERE status = 'error' AND doc_id % 5 <> 0")
def q_ocr_problems(spark, sf_dir):
    return inventory.ocr_problems(ocr(spark, sf_dir)).where("problem is not null")


@query(f"""SELECT 'ocr_presence' AS rule, source AS book_id, CAST(doc_id AS VARCHAR) AS detail FROM documents WHERE source IN ('src1', 'src2')
UNION ALL SELECT 'ocr_status', source, CAST(doc_id AS VARCHAR) FROM ({_OCR}) o WHERE (status = 'ok' AND doc_id % 13 = 0) OR (status = 'error' AND doc_id % 5 = 0) OR (status = 'missing' AND doc_id % 11 = 0) OR (status <> 'ok' AND long AND doc_id % 17 = 0)""")
def q_ocr_rules(spark, sf_dir):
    books = docs(spark, sf_dir).select(F.col("source").alias("book_id")).distinct().withColumn("ocr_directory", F.when(~F.col("book_id").isin("src1", "src2"), "ocr"))
    return validate.ocr_rules(ocr(spark, sf_dir), books)


@query("""SELECT source AS book_id, CAST(doc_id AS BIGINT) AS scan_index, CASE WHEN doc_id % 6 = 0 THEN 'not selected' ELSE concat_ws(',', CASE WHEN doc_id % 4 = 0 THEN 'sha' END, CASE WHEN doc_id % 5 = 0 THEN 'name' END) END AS changed
 FROM documents WHERE doc_id % 6 = 0 OR doc_id % 4 = 0 OR doc_id % 5 = 0""")
def q_changed_scans(spark, sf_dir):
    d = docs(spark, sf_dir).select(F.col("source").alias("book_id"), F.col("doc_id").alias("scan_index"), F.md5("text").alias("sha"), F.col("lang").alias("name"), "doc_id")
    now = d.where("doc_id % 6 != 0").withColumns({"sha": F.when(F.col("doc_id") % 4 == 0, "x").otherwise(F.col("sha")), "name": F.when(F.col("doc_id") % 5 == 0, "y").otherwise(F.col("name"))})
    return inventory.changed_scans(d, now, ["sha", "name"]).select("book_id", F.col("scan_index").cast("bigint").alias("scan_index"), F.array_join("changed", ",").alias("changed"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'titlePage' WHEN doc_id % 3 = 1 THEN 'blank' END AS page_type FROM documents")
def q_page_type_vocabulary(spark, sf_dir):
    raw = F.when(F.col("doc_id") % 3 == 0, " TITLEPAGE ").when(F.col("doc_id") % 3 == 1, "blank").otherwise("poster")
    return docs(spark, sf_dir).select("doc_id", documents.vocabulary(raw, ["titlePage", "blank"]).alias("page_type"))


# --- integrity rules ---


@query("SELECT 'scan_ref' AS rule, source AS book_id, 'd' || (doc_id + 1) AS detail FROM documents d WHERE NOT EXISTS (SELECT 1 FROM documents e WHERE e.source = d.source AND e.doc_id = d.doc_id + 1)")
def q_known_references(spark, sf_dir):
    d = docs(spark, sf_dir)
    ids = d.select(F.col("source").alias("book_id"), F.concat(F.lit("d"), _id()).alias("id"))
    return validate.known(d.select(F.col("source").alias("book_id"), F.concat(F.lit("d"), (F.col("doc_id") + 1).cast("string")).alias("id")), ids, "scan_ref")


@query("""SELECT 'observation_call' AS rule, source AS book_id, 'd' || doc_id AS detail FROM documents WHERE (doc_id % 5 = 0) <> (doc_id % 7 = 0) OR (doc_id % 5 <> 0 AND doc_id % 7 <> 0 AND (n_chars % 4 = 0 OR n_chars % 9 = 0 OR n_chars % 10 = 3))
 OR (doc_id % 5 = 0 AND doc_id % 7 <> 0)""")
def q_observation_calls(spark, sf_dir):
    d, i, n = docs(spark, sf_dir), F.col("doc_id"), F.col("n_chars")
    scan, call = F.concat(F.lit("d"), _id()), F.concat(F.lit("c"), _id())
    scans = d.select(F.col("source").alias("book_id"), scan.alias("scan_id"), F.when(i % 5 != 0, "seen").alias("observation"), F.when(i % 7 != 0, call).alias("observation_call_id"))
    calls = d.where("n_chars % 10 != 3").select(F.col("source").alias("book_id"), call.alias("call_id"), F.when(n % 4 == 0, "reconcile").otherwise("observe").alias("stage"), F.when(n % 9 == 0, "timeout").otherwise("ok").alias("status"), scan.alias("scan_id"))
    return validate.observation_calls(scans, calls)


@query("SELECT 'resolved_scans' AS rule, source AS book_id, CAST(doc_id AS VARCHAR) AS detail FROM documents WHERE doc_id % 9 = 0 OR doc_id % 8 = 0")
def q_same_scans(spark, sf_dir):
    d, i = docs(spark, sf_dir), F.col("doc_id")
    scans = d.select(F.col("source").alias("book_id"), i.alias("scan_index"), F.concat(F.lit("d"), _id()).alias("scan_id"))
    return validate.same_scans(scans, scans.where("scan_index % 9 != 0").withColumn("scan_id", F.when(F.col("scan_index") % 8 == 0, "other").otherwise(F.col("scan_id"))))


@query("""WITH n AS (SELECT source AS book_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS pos, doc_id, doc_id % 4 + 1 AS level, n_chars % 50 AS s, n_chars % 60 AS e FROM documents),
p AS (SELECT a.*, b.pos AS p_pos, b.level AS p_level FROM n a LEFT JOIN n b ON b.book_id = a.book_id AND b.pos = a.pos - 1 + CASE WHEN a.doc_id % 10 = 0 THEN 2 ELSE 0 END)
SELECT 'parent' AS rule, book_id, 'p' || pos AS detail FROM p WHERE doc_id % 3 = 0 AND NOT coalesce(p_pos < pos AND p_level < level, false)
UNION ALL SELECT 'bounds', book_id, 'p' || pos FROM n WHERE e < s""")
def q_structure_forest(spark, sf_dir):
    from pyspark.sql import Window

    i = F.col("doc_id")
    pos = F.row_number().over(Window.partitionBy("source").orderBy("doc_id"))
    d = docs(spark, sf_dir).withColumn("pos", pos)
    parent = F.when(i % 3 == 0, F.concat(F.lit("p"), (F.col("pos") - 1 + F.when(i % 10 == 0, 2).otherwise(0)).cast("string")))
    return validate.structure_forest(d.select(F.col("source").alias("book_id"), "pos", F.concat(F.lit("p"), F.col("pos").cast("string")).alias("id"), parent.alias("parent_id"), (i % 4 + 1).alias("level"), (F.col("n_chars") % 50).alias("start_index"), (F.col("n_chars") % 60).alias("end_index")))


@query("SELECT 'subpages' AS rule, source AS book_id, CAST(doc_id AS VARCHAR) AS detail FROM documents WHERE doc_id % 4 <> 0 AND (doc_id % 3 <> 0 OR doc_id % 4 = 1)")
def q_subpage_rules(spark, sf_dir):
    i = F.col("doc_id")
    side = lambda s: F.struct(F.lit(s).alias("side"), F.lit("blank").alias("page_type"))
    subs = F.when(i % 4 == 0, F.array().cast("array<struct<side:string,page_type:string>>")).when(i % 4 == 1, F.array(side("left"), side("left"))).otherwise(F.array(side("left"), side("right")))
    return validate.subpage_rules(docs(spark, sf_dir).select(F.col("source").alias("book_id"), i.alias("scan_index"), F.when(i % 3 == 0, "both").when(i % 3 == 1, "left").alias("side"), subs.alias("subpages")))


@query("SELECT 'page_number' AS rule, source AS book_id, CAST(doc_id AS VARCHAR) AS detail FROM documents WHERE doc_id % 5 <> 0 AND (doc_id % 6 = 0 OR doc_id % 7 = 0)")
def q_page_number_rules(spark, sf_dir):
    i = F.col("doc_id")
    d = docs(spark, sf_dir).select(F.col("source").alias("book_id"), i.alias("scan_index"), _id().alias("n"))
    stored = d.select("book_id", "scan_index", F.when(F.col("scan_index") % 5 != 0, F.when(F.col("scan_index") % 6 == 0, "x").otherwise(F.col("n"))).alias("page_number"))
    return validate.page_number_rules(stored, d.select("book_id", "scan_index", F.when(F.col("scan_index") % 7 != 0, F.col("n")).alias("page_number")))


@query("SELECT 'totals' AS rule, 'b' || doc_id AS book_id, '3' AS detail FROM documents WHERE doc_id % 5 = 0 OR doc_id % 6 = 0 OR doc_id % 7 = 0")
def q_totals_rules(spark, sf_dir):
    i = F.col("doc_id")
    base = lambda calls, cost, complete: docs(spark, sf_dir).select(F.concat(F.lit("b"), _id()).alias("book_id"), calls.cast("bigint").alias("calls"), F.lit(1).cast("bigint").alias("failed_calls"), i.alias("prompt_tokens"), i.alias("completion_tokens"), cost.alias("cost_usd"), complete.alias("cost_complete"))
    stored = base(F.lit(3), F.when(i % 4 != 0, 0.1 + 0.2 * F.lit(1.0)), F.lit(True))
    computed = base(F.when(i % 5 == 0, 4).otherwise(3), F.when((i % 4 != 0) & (i % 6 != 0), F.lit(0.3)).when((i % 4 == 0) & (i % 6 == 0), F.lit(0.5)).when(i % 6 == 0, F.lit(0.4)), i % 7 != 0)
    return validate.totals_rules(stored, computed)


@query("""WITH s AS (SELECT source AS book_id, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, n_chars FROM documents), n AS (SELECT book_id, count(*) AS n FROM s GROUP BY 1),
m AS (SELECT book_id, i, CASE WHEN n_chars % 10 = 0 THEN 'dup' ELSE 'd' || doc_id END AS scan_id, doc_id FROM s)
SELECT 'gold_index' AS rule, book_id, CAST(i AS VARCHAR) AS detail FROM m WHERE i >= 40
UNION ALL SELECT 'gold_scan_id', book_id, scan_id FROM m GROUP BY book_id, scan_id HAVING count(*) > 1
UNION ALL SELECT 'gold_structure', book_id, CAST(n AS VARCHAR) FROM n WHERE n < 40
UNION ALL SELECT 'gold_start', book_id, 'd' || doc_id FROM s WHERE doc_id % 3 = 0 AND n_chars % 10 = 0""")
def q_gold_manifest(spark, sf_dir):
    from pyspark.sql import Window

    d = docs(spark, sf_dir).select(F.col("source").alias("book_id"), "doc_id", (F.row_number().over(Window.partitionBy("source").orderBy("doc_id")) - 1).alias("scan_index"), F.when(F.col("n_chars") % 10 == 0, "dup").otherwise(F.concat(F.lit("d"), _id())).alias("scan_id"))
    books = d.select("book_id").distinct().withColumns({"scan_count": F.lit(40), "has_structure": F.lit(True)})
    starts = d.select("book_id", F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("d"), _id())).alias("start_scan_id"))
    return validate.gold_manifest(d.drop("doc_id"), books, starts)


@query("SELECT 'unknown_key' AS rule, source AS book_id, 'extra' AS detail FROM documents WHERE doc_id % 3 = 0")
def q_extra_keys(spark, sf_dir):
    raw = F.when(F.col("doc_id") % 3 == 0, '{"a": 1, "extra": 2}').otherwise('{"a": 1, "b": 2}')
    return validate.extra_keys(docs(spark, sf_dir).select(F.col("source").alias("book_id"), raw.alias("j")), "j", ["a", "b"])
