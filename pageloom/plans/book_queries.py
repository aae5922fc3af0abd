"""Context, reconciliation, evaluation, validation and resume queries over books made from the driver's tables."""

from pyspark.sql import functions as F

from pageloom.operators import context, reconcile, scoring, validate
from pageloom.sources import inventory
from pageloom.plans.catalog import query, table

_TURN = "CASE WHEN turn % 5 = 3 THEN 'side unknown' WHEN turn % 2 = 0 THEN 'right' ELSE 'left' END"
_TURN_LINE = f"""'- scan ' || (turn + 1) || ': ' || CASE WHEN length(text) % 11 = 0 THEN 'not observed' ELSE role || '; ' || {_TURN} || '; ' ||
  CASE WHEN length(text) % 3 = 0 THEN 'no page number' ELSE 'page ' || length(text) END || CASE WHEN turn % 3 = 0 THEN '; heading "h' || turn || '"' ELSE '' END END"""


def turns(spark, sf_dir):
    """Conversations as books, turns as scans: the role is the page type, the text's length the printed number."""
    c = table(spark, sf_dir, "conversations")
    n = F.length("text")
    t = F.col("turn").cast("int")
    number = F.struct(F.lit(None).cast("string").alias("side"), n.cast("string").alias("raw"), n.cast("string").alias("normalized"), n.alias("numeric_value"), F.lit("arabic").alias("numeral_system"))
    heading = F.struct(F.concat(F.lit("h"), t.cast("string")).alias("text"), (F.pmod(t, F.lit(2)) + F.pmod(n, F.lit(2)) + 1).alias("level"))
    none = lambda kind: F.array().cast(f"array<{kind}>")
    observation = F.struct(
        F.col("role").alias("page_type"), F.when(t % 5 == 3, F.lit(None).cast("string")).when(t % 2 == 0, "right").otherwise("left").alias("side"), none("struct<side:string,page_type:string>").alias("subpages"),
        F.when(n % 3 != 0, F.array(number)).otherwise(none("struct<side:string,raw:string,normalized:string,numeric_value:int,numeral_system:string>")).alias("printed_numbers"),
        F.when(t % 3 == 0, F.array(heading)).otherwise(none("struct<text:string,level:int>")).alias("headings"), none("struct<title:string>").alias("toc_entries"),
        F.array(F.struct(F.when(t % 2 == 0, "title").otherwise("author").alias("field"), F.concat(F.lit("v"), F.pmod(n, F.lit(3)).cast("string")).alias("value"))).alias("bibliographic_candidates"),
    )
    return c.select(F.col("conv_id").alias("book_id"), t.alias("scan_index"), F.when(n % 11 != 0, observation).alias("observation"))


@query(f"""SELECT conv_id AS book_id, CAST(turn AS BIGINT) AS scan_index, coalesce(string_agg(line, chr(10) ORDER BY t2), '') AS recent FROM
 (SELECT a.conv_id, a.turn, b.turn AS t2, b.line FROM conversations a LEFT JOIN (SELECT *, {_TURN_LINE} AS line FROM conversations) b ON b.conv_id = a.conv_id AND b.turn < a.turn AND b.turn >= a.turn - 5) x GROUP BY conv_id, turn""")
def q_context_recent(spark, sf_dir):
    return context.recent_lines(turns(spark, sf_dir), 5).select("book_id", F.col("scan_index").cast("bigint").alias("scan_index"), F.array_join("recent", "\n").alias("recent"))


@query("""WITH n AS (SELECT conv_id AS book_id, turn, length(text) AS v FROM conversations WHERE length(text) % 11 <> 0 AND length(text) % 3 <> 0)
SELECT book_id, CAST(turn AS BIGINT) AS scan_index, CAST(v AS BIGINT) AS value, 'page number ' || v || ' on scan ' || (turn + 1) || ' after ' || p || ' on scan ' || (pt + 1) AS message FROM
 (SELECT *, lag(v) OVER w AS p, lag(turn) OVER w AS pt FROM n WINDOW w AS (PARTITION BY book_id ORDER BY turn)) x WHERE v <= p""")
def q_context_irregularities(spark, sf_dir):
    d = context.irregularities(turns(spark, sf_dir))
    return d.select("book_id", F.col("scan_index").cast("bigint").alias("scan_index"), F.col("value").cast("bigint").alias("value"), "message")


@query("""WITH h AS (SELECT conv_id AS book_id, turn AS t, turn % 2 + length(text) % 2 + 1 AS level FROM conversations WHERE length(text) % 11 <> 0 AND turn % 3 = 0),
s AS (SELECT conv_id AS book_id, turn AS t FROM conversations)
SELECT s.book_id, CAST(s.t AS BIGINT) AS scan_index, coalesce((SELECT string_agg('level ' || level || ' "h' || t || '" (scan ' || (t + 1) || ')', '; ' ORDER BY level) FROM h
  WHERE h.book_id = s.book_id AND h.t < s.t AND NOT EXISTS (SELECT 1 FROM h g WHERE g.book_id = h.book_id AND g.t > h.t AND g.t < s.t AND g.level <= h.level)), '') AS stack FROM s""")
def q_context_heading_stack(spark, sf_dir):
    d = context.heading_stack(turns(spark, sf_dir))
    return d.select("book_id", F.col("scan_index").cast("bigint").alias("scan_index"), F.coalesce(F.array_join("stack", "; "), F.lit("")).alias("stack"))


@query(None)
def q_build_context(spark, sf_dir):
    return context.build_context(turns(spark, sf_dir), 5, 600)


@query("""SELECT book_id, field, CAST(count(DISTINCT v) AS BIGINT) AS forms FROM (SELECT conv_id AS book_id, CASE WHEN turn % 2 = 0 THEN 'title' ELSE 'author' END AS field, length(text) % 3 AS v FROM conversations WHERE length(text) % 11 <> 0) x
 WHERE field = 'title' GROUP BY book_id, field HAVING count(DISTINCT v) > 1""")
def q_biblio_competing(spark, sf_dir):
    return context.competing_values(turns(spark, sf_dir)).select("book_id", "field", "forms")


_NODES = """SELECT source AS book_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos, 'ch' || doc_id AS id, doc_id // 20 * 7 % 5 % 4 + 1 AS level,
 n_chars % 97 AS start_index, n_chars % 9 = 0 AS start_spread, lang AS key FROM documents"""


def nodes(spark, sf_dir):
    from pyspark.sql import Window

    i = F.floor(F.col("doc_id") / 20)
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("book_id"), (F.row_number().over(Window.partitionBy("source").orderBy("doc_id")) - 1).alias("pos"), F.concat(F.lit("ch"), F.col("doc_id").cast("string")).alias("id"), (i * 7 % 5 % 4 + 1).alias("level"),
        (F.col("n_chars") % 97).alias("start_index"), (F.col("n_chars") % 9 == 0).alias("start_spread"), F.col("lang").alias("key"),
    )


@query(f"WITH c AS ({_NODES}) SELECT a.id, (SELECT arg_max(b.id, b.pos) FROM c b WHERE b.book_id = a.book_id AND b.pos < a.pos AND b.level < a.level) AS parent_id FROM c a")
def q_chapter_parent(spark, sf_dir):
    return reconcile.chapter_parents(nodes(spark, sf_dir)).select("id", "parent_id")


@query(f"""WITH c AS ({_NODES}), x AS (SELECT a.*, (SELECT arg_min(b.start_index, b.pos) FROM c b WHERE b.book_id = a.book_id AND b.pos > a.pos AND b.level <= a.level) AS e,
  (SELECT arg_min(b.start_spread, b.pos) FROM c b WHERE b.book_id = a.book_id AND b.pos > a.pos AND b.level <= a.level) AS s FROM c a)
SELECT id, CAST(CASE WHEN e >= start_index THEN CASE WHEN e > start_index AND NOT s THEN e - 1 ELSE e END END AS BIGINT) AS end_index FROM x""")
def q_chapter_end(spark, sf_dir):
    return reconcile.chapter_bounds(nodes(spark, sf_dir)).select("id", F.col("end_index").cast("bigint").alias("end_index"))


@query(f"""WITH c AS ({_NODES}) SELECT id, lag(id) OVER (PARTITION BY book_id, key, start_index ORDER BY pos) AS duplicate_of, coalesce(start_index < lag(start_index) OVER (PARTITION BY book_id ORDER BY pos), false) AS out_of_order FROM c""")
def q_chapter_duplicates(spark, sf_dir):
    return reconcile.chapter_bounds(nodes(spark, sf_dir)).select("id", "duplicate_of", "out_of_order")


@query("""WITH i AS (SELECT source AS book_id, n_chars % 400 AS v, count(DISTINCT doc_id) AS n, min(doc_id) AS target FROM documents GROUP BY 1, 2),
r AS (SELECT source AS book_id, doc_id, doc_id % 400 AS v FROM documents)
SELECT r.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n, CASE WHEN n = 1 THEN 'd' || target END AS target, CASE WHEN n > 1 THEN 'ambiguous_toc_reference' WHEN n IS NULL THEN 'unresolved_toc_reference' END AS warning
FROM r LEFT JOIN i ON i.book_id = r.book_id AND i.v = r.v""")
def q_toc_resolution(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    scan = F.concat(F.lit("d"), F.col("doc_id").cast("string"))
    index = d.select(F.col("source").alias("book_id"), F.col("doc_id").alias("scan_index"), scan.alias("scan_id"), F.lit("arabic").alias("numeral_system"), (F.col("n_chars") % 400).alias("numeric_value"))
    refs = d.select(F.col("source").alias("book_id"), "doc_id", F.concat(F.lit("["), (F.col("doc_id") % 400).cast("string"), F.lit("]")).alias("ref"), F.array().cast("array<string>").alias("heading_ids"))
    return reconcile.resolve_references(refs, index).select("doc_id", F.coalesce(F.size("candidates"), F.lit(0)).cast("bigint").alias("n"), "target", F.col("reference_warning").alias("warning"))


_CORR = "SELECT source AS book_id, doc_id AS pos, row_number() OVER (PARTITION BY source ORDER BY doc_id) % 17 AS scan, CASE WHEN n_chars % 3 = 0 THEN NULL ELSE lang END AS page_type FROM documents"


def corrected(spark, sf_dir):
    from pyspark.sql import Window

    d = table(spark, sf_dir, "documents")
    i = F.row_number().over(Window.partitionBy("source").orderBy("doc_id"))
    none = F.lit(None).cast("string")
    scans = d.select(F.col("source").alias("book_id"), (i - 1).alias("scan_index"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("scan_id"), (F.col("n_chars") % 10 != 0).alias("observed"), F.col("lang").alias("page_type"), F.when(F.col("n_chars") % 2 == 0, "left").otherwise("right").alias("side"), none.alias("leaf"), F.array().cast("array<struct<side:string,page_type:string,leaf:string>>").alias("subpages"))
    corr = d.select(F.col("source").alias("book_id"), F.col("doc_id").alias("pos"), (i % 17).alias("scan"), F.when(F.col("n_chars") % 3 != 0, F.col("lang")).alias("page_type"), F.lit("keep").alias("side"), F.when(F.col("n_chars") % 5 == 0, "plate").otherwise("keep").alias("leaf"), F.lit("r").alias("reason"))
    return scans, corr, reconcile.first_corrections(scans, corr)


@query(f"""WITH c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY book_id, scan ORDER BY pos) AS r FROM ({_CORR}) y) z WHERE r = 1),
s AS (SELECT source AS book_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS scan, doc_id, lang, n_chars FROM documents)
SELECT 'd' || s.doc_id AS scan_id, s.lang AS old_type, CASE WHEN c.pos IS NOT NULL AND s.n_chars % 10 <> 0 AND c.page_type IS NOT NULL THEN c.page_type ELSE s.lang END AS page_type
FROM s LEFT JOIN c ON c.book_id = s.book_id AND c.scan = s.scan""")
def q_first_correction_wins(spark, sf_dir):
    return corrected(spark, sf_dir)[2].select("scan_id", "old_type", "page_type")


@query("""SELECT 'd' || doc_id AS scan_id, CASE WHEN n_chars % 7 = 0 THEN 'plate' ELSE 'binding' END AS old_value FROM documents WHERE n_chars % 7 < 2 AND lang IN ('en', 'de')""")
def q_leaf_conflicts(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    leaf = F.when(F.col("n_chars") % 7 == 0, "plate").when(F.col("n_chars") % 7 == 1, "binding")
    scans = d.select(F.col("source").alias("book_id"), F.col("doc_id").alias("scan_index"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("scan_id"), F.when(F.col("lang").isin("en", "de"), "preface").otherwise("blank").alias("page_type"), F.lit("left").alias("side"), leaf.alias("leaf"), F.array().cast("array<struct<side:string,page_type:string,leaf:string>>").alias("subpages"))
    return reconcile.settle_leaves(scans)[1].select(F.element_at("scan_ids", 1).alias("scan_id"), "old_value")


@query(None)
def q_grounding_fuzzy(spark, sf_dir):
    """First words of documents proposed as values, grounded in those of their own source; word rules have no SQL form."""
    d = table(spark, sf_dir, "documents").where("text is not null")
    words = F.split("text", " ", 4)
    obs = d.select(F.col("source").alias("book_id"), F.col("doc_id").alias("scan_index"), F.lit(0).alias("ord"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("scan_id"), F.when(F.col("doc_id") % 3 == 0, "title").otherwise("author").alias("field"), F.array_join(F.slice(words, 1, 3), " ").alias("value"))
    prop = obs.select("book_id", F.col("scan_index").alias("pos"), "field", F.upper("value").alias("value"), F.lit(None).cast("string").alias("notes"))
    return reconcile.ground_values(obs, prop).select("book_id", "pos", "field", "fate", "origin", F.col("n_sources").alias("n"))


# --- evaluation: labels are the gold, rules on documents the systems ---


def evaluation(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scan = F.concat(F.lit("d"), F.col("doc_id").cast("string"))
    none, no = F.lit(None).cast("string"), F.lit(False)
    j = docs.join(labels, "doc_id", "left")
    fields = F.array(F.struct(F.lit("quality").alias("field"), F.col("quality").cast("string").alias("v")), F.struct(F.lit("toxic").alias("field"), F.col("toxic").cast("string").alias("v")))
    g = j.select(F.col("source").alias("book_id"), scan.alias("scan_id"), F.col("doc_id").alias("scan_index"), F.sha2("text", 256).alias("sha"), F.explode(fields).alias("f"))
    status = F.when(F.col("f.v").isNull(), "not_reviewed").when(F.col("scan_index") % 13 == 0, "absent").otherwise("verified")
    gold = g.select("book_id", "scan_id", "scan_index", "sha", F.col("f.field").alias("field"), status.alias("status"), scoring.acceptable(status, F.col("f.v"), F.array().cast("array<string>")).alias("accept"))
    p = docs.where(F.col("doc_id") % 7 != 0).select(F.col("source").alias("book_id"), scan.alias("scan_id"), F.col("doc_id").alias("scan_index"), F.when(F.col("doc_id") % 17 == 0, "other").otherwise(F.sha2("text", 256)).alias("sha"), "n_chars", "doc_id")
    one = p.select(F.lit("rule").alias("system"), F.lit("observed").alias("layer"), "book_id", "scan_id", "scan_index", "sha", F.lit("quality").alias("field"), F.when(F.col("doc_id") % 5 != 0, F.when(F.col("n_chars") >= 200, "1").otherwise("0")).alias("value"), (F.col("doc_id") % 19 == 0).alias("incomparable"))
    two = p.where(F.col("doc_id") % 3 != 0).select(F.lit("rule").alias("system"), F.lit("observed").alias("layer"), "book_id", "scan_id", "scan_index", "sha", F.lit("toxic").alias("field"), F.lit("0").alias("value"), no.alias("incomparable"))
    return gold, one.unionByName(two), none


_EVAL = """
WITH g AS (SELECT d.source AS book_id, d.doc_id, f.field, CASE f.field WHEN 'quality' THEN l.quality ELSE l.toxic END AS v, d.n_chars FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id CROSS JOIN (VALUES ('quality'), ('toxic')) f(field)),
s AS (SELECT *, CASE WHEN v IS NULL THEN 'not_reviewed' WHEN doc_id % 13 = 0 THEN 'absent' ELSE 'verified' END AS status,
  CASE WHEN field = 'quality' THEN CASE WHEN doc_id % 5 <> 0 THEN CASE WHEN n_chars >= 200 THEN 1 ELSE 0 END END ELSE 0 END AS p FROM g),
o AS (SELECT *, CASE WHEN status = 'not_reviewed' THEN NULL WHEN doc_id % 7 = 0 THEN 'scan_missing' WHEN doc_id % 17 = 0 THEN 'hash_mismatch'
  WHEN field = 'toxic' AND doc_id % 3 = 0 THEN 'no_prediction' WHEN field = 'quality' AND doc_id % 19 = 0 THEN 'incomparable'
  WHEN (status = 'verified' AND p = v) OR (status = 'absent' AND p IS NULL) THEN 'correct' WHEN p IS NULL THEN 'missing_value' WHEN status = 'absent' THEN 'spurious_value' ELSE 'wrong_value' END AS outcome FROM s)"""
_EVAL_COUNTS = ", ".join(f"CAST(count(*) FILTER (outcome = '{x}') AS BIGINT) AS {x}" for x in scoring.SCORED + scoring.UNSCORED)


#: A scan without any field of the toy system is missing: those that doc_id % 7 leaves out; every other scan has its quality row.
@query(_EVAL + f" SELECT field, {_EVAL_COUNTS}, CAST(count(*) FILTER (outcome IN ('correct', 'wrong_value', 'missing_value', 'spurious_value')) AS BIGINT) AS scored FROM o GROUP BY field")
def q_score_scans(spark, sf_dir):
    gold, pred, _ = evaluation(spark, sf_dir)
    d = scoring.field_stats(scoring.score_scans(gold, pred), "field")
    return d.select("field", *[F.col(c).cast("bigint").alias(c) for c in [*scoring.SCORED, *scoring.UNSCORED, "scored"]])


@query(_EVAL + " SELECT field, status, coalesce(outcome, 'not_scored') AS outcome, CAST(count(*) AS BIGINT) AS n FROM o GROUP BY ALL")
def q_score_by_status(spark, sf_dir):
    gold, pred, _ = evaluation(spark, sf_dir)
    return scoring.score_scans(gold, pred).groupBy("field", "status", F.coalesce("outcome", F.lit("not_scored")).alias("outcome")).agg(F.count("*").alias("n"))


@query(_EVAL + " SELECT field, status, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY ALL")
def q_label_status_counts(spark, sf_dir):
    return scoring.status_counts(evaluation(spark, sf_dir)[0])


@query("SELECT source AS book_id, source AS predicted_book FROM documents WHERE doc_id % 7 <> 0 GROUP BY source")
def q_match_books(spark, sf_dir):
    gold, pred, _ = evaluation(spark, sf_dir)
    return scoring.match_books(gold, pred)


@query("""SELECT source AS book_id, CAST(count(*) FILTER (doc_id % 7 = 0) AS BIGINT) AS missing, CAST(count(*) FILTER (doc_id % 7 <> 0 AND doc_id % 17 = 0) AS BIGINT) AS mismatched,
 CASE WHEN count(*) FILTER (doc_id % 7 <> 0 AND doc_id % 17 = 0) > 0 THEN 'hash_mismatch' WHEN count(*) FILTER (doc_id % 7 = 0) > 0 THEN 'partial' END AS reason FROM documents GROUP BY source""")
def q_document_check(spark, sf_dir):
    gold, pred, _ = evaluation(spark, sf_dir)
    size = lambda d: d.select("book_id", "scan_id", "sha").distinct()
    g, p = size(gold), size(pred)
    g = g.join(g.groupBy("book_id").agg(F.count("*").alias("scan_count")), "book_id")
    p = p.join(p.groupBy("book_id").agg(F.count("*").alias("p_scan_count")), "book_id").withColumnRenamed("sha", "p_sha")
    return scoring.document_check(g, p)


_KTH = "SELECT source AS book_id, row_number() OVER (PARTITION BY source, lang, doc_id % 3 ORDER BY doc_id) AS nth, lang, doc_id % 3 AS half, doc_id, n_chars % 50 AS start FROM documents"


@query(f"""WITH c AS (SELECT *, row_number() OVER (PARTITION BY book_id, lang ORDER BY doc_id) AS k FROM ({_KTH}) x WHERE half = 0), p AS (SELECT *, row_number() OVER (PARTITION BY book_id, lang ORDER BY doc_id) AS k FROM ({_KTH}) x WHERE half = 1)
SELECT c.book_id, CAST(count(*) AS BIGINT) AS gold, CAST(count(p.doc_id) AS BIGINT) AS matched, CAST(count(*) FILTER (c.start = p.start) AS BIGINT) AS starts_correct FROM c LEFT JOIN p ON p.book_id = c.book_id AND p.lang = c.lang AND p.k = c.k GROUP BY c.book_id""")
def q_structure_kth_match(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("book_id"), F.col("doc_id").alias("pos"), F.col("lang").alias("title"), (F.col("n_chars") % 50).alias("start"), F.lit(None).cast("string").alias("ref"))
    return scoring.structure_scores(d.where("pos % 3 = 0"), d.where("pos % 3 = 1")).select("book_id", "gold", "matched", "starts_correct")


@query("""SELECT 'quality' AS field, CAST(count(*) AS BIGINT) AS eligible, CAST(count(*) FILTER (d.doc_id % 7 <> 0) AS BIGINT) AS compared,
 CAST(count(*) FILTER (d.doc_id % 7 <> 0 AND d.doc_id % 5 <> 0 AND CASE WHEN d.n_chars >= 200 THEN 1 ELSE 0 END = l.quality) AS BIGINT) AS agreed FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE l.quality IS NOT NULL""")
def q_agreement(spark, sf_dir):
    gold, pred, _ = evaluation(spark, sf_dir)
    labels = table(spark, sf_dir, "labels")
    other = labels.join(table(spark, sf_dir, "documents").select("doc_id"), "doc_id").select(F.lit("labels").alias("system"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("scan_id"), F.lit("quality").alias("field"), F.col("quality").cast("string").alias("value"))
    return scoring.agreement(pred, other).where("field = 'quality'").select("field", "eligible", "compared", "agreed")


# --- validation, resume, sources ---


@query("""SELECT 'scan_index' AS rule, book_id, CAST(doc_id AS VARCHAR) AS detail FROM (SELECT source AS book_id, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS w FROM documents) x WHERE w <> doc_id // 20
UNION ALL SELECT 'scan_count', source, '50' FROM documents GROUP BY source HAVING count(*) <> 50
UNION ALL SELECT 'gold_status', d.source, 'f' FROM documents d WHERE n_chars % 5 = 0
UNION ALL SELECT 'ids', source, lang FROM documents GROUP BY source, lang HAVING count(*) > 1""")
def q_validation_violations(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    scans = d.select(F.col("source").alias("book_id"), F.floor(F.col("doc_id") / 20).alias("scan_index"), F.col("doc_id"))
    books = d.select(F.col("source").alias("book_id"), F.lit(50).alias("scan_count")).distinct()
    order = validate.scan_order(scans, books)
    gold = d.select(F.col("source").alias("book_id"), F.lit("f").alias("field"), F.when(F.col("n_chars") % 5 == 0, "absent").otherwise("verified").alias("status"), F.lit("v").alias("value"), F.array().cast("array<string>").alias("alternatives"))
    ids = validate.unique(d.select(F.col("source").alias("book_id"), "lang"), "ids", "lang")
    return order.unionByName(validate.gold_rules(gold)).unionByName(ids)


@query("SELECT source AS book_id, 'd' || doc_id AS scan_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def q_resume_worklist(spark, sf_dir):
    d, l = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scan = F.concat(F.lit("d"), F.col("doc_id").cast("string"))
    scans = d.select(F.col("source").alias("book_id"), scan.alias("scan_id"))
    return inventory.worklist(scans, d.join(l, "doc_id", "left_semi").select(F.col("source").alias("book_id"), scan.alias("scan_id")))


@query("""SELECT coalesce(a.key, b.key) AS key, stored, current FROM (SELECT 'k' || doc_id AS key, lang AS stored FROM documents WHERE doc_id % 3 <> 0) a
 FULL JOIN (SELECT 'k' || doc_id AS key, CASE WHEN doc_id % 5 = 0 THEN 'new' ELSE lang END AS current FROM documents WHERE doc_id % 4 <> 0) b ON a.key = b.key WHERE stored IS DISTINCT FROM current""")
def q_identity_diff(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    key = F.concat(F.lit("k"), F.col("doc_id").cast("string")).alias("key")
    return inventory.identity_diff(d.where("doc_id % 3 != 0").select(key, F.col("lang").alias("value")), d.where("doc_id % 4 != 0").select(key, F.when(F.col("doc_id") % 5 == 0, "new").otherwise(F.col("lang")).alias("value")))


@query("SELECT 'd' || doc_id || '.JPG' AS filename FROM documents WHERE doc_id % 10 = 3")
def q_unlisted_files(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    name = F.concat(F.lit("d"), F.col("doc_id").cast("string"))
    return inventory.match_files(d.where("doc_id % 10 != 3").select(F.col("doc_id").alias("scan_index"), name.alias("name")), d.select(F.concat(name, F.lit(".JPG")).alias("filename")), [".jpg"])[2]


@query(None)
def q_alto_text(spark, sf_dir):
    """Documents wrapped as ALTO sidecars and read back through the OCR source."""
    d = table(spark, sf_dir, "documents")
    name = F.concat(F.lit("d"), F.col("doc_id").cast("string"))
    words = F.array_join(F.transform(F.split(F.regexp_replace("text", '[<>&"]', ""), r"\s+"), lambda w: F.concat(F.lit('<String CONTENT="'), w, F.lit('"/>'))), "")
    xml = F.concat(F.lit('<alto xmlns="http://www.loc.gov/standards/alto/ns-v4#"><Layout><TextBlock><TextLine>'), words, F.lit("</TextLine></TextBlock></Layout></alto>"))
    out = inventory.attach_ocr(d.select(name.alias("scan_id")), d.select(F.concat(name, F.lit(".xml")).alias("filename"), F.encode(xml, "UTF-8").alias("content")))
    return out.select("scan_id", "ocr.status", "ocr.format", F.col("ocr.chars").cast("bigint").alias("chars"), "ocr_text")
