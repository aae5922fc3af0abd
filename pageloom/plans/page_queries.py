"""Pagination queries over books that are made from the documents by whole-number arithmetic."""

from pyspark.sql import functions as F

from pageloom.operators import pagination as P
from pageloom.plans.catalog import query, table

#: A book is a source; its scans are its documents. The same SQL runs in Spark and in DuckDB.
OBS = """
SELECT *, CASE WHEN page_type <> 'normalPage' OR (27 * i + doc_id) % 5 = 0 OR (i < 5 AND i < 2) THEN NULL
               WHEN i < 5 THEN i - 1
               WHEN doc_id % 37 = 0 THEN seq + 7
               ELSE seq + CASE WHEN i >= n / 2 AND book_id IN ('src3', 'src7') THEN 9 ELSE 0 END END AS value,
          CASE WHEN i < 5 THEN 'roman' ELSE 'arabic' END AS sys
FROM (SELECT *, sum(CASE WHEN page_type = 'normalPage' AND i >= 5 THEN 1 ELSE 0 END) OVER (PARTITION BY book_id ORDER BY i) AS seq
      FROM (SELECT *, CASE WHEN i < 2 THEN 'frontCover' WHEN i = n - 1 THEN 'backCover' WHEN doc_id % 11 = 0 THEN 'frontispiece' ELSE 'normalPage' END AS page_type,
                   CASE WHEN i % 2 = 0 THEN 'right' ELSE 'left' END AS side
            FROM (SELECT source AS book_id, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM documents) a) b) c"""

_ANCHORS = f"""
WITH obs AS ({OBS}),
anc AS (SELECT book_id, i AS k, CAST(value AS BIGINT) AS value, sys, value - i AS off FROM obs WHERE value IS NOT NULL),
nb AS (SELECT *, lag(sys) OVER w AS ps, lead(sys) OVER w AS ns, lag(off) OVER w AS po, lead(off) OVER w AS no_ FROM anc WINDOW w AS (PARTITION BY book_id ORDER BY k)),
wr AS (SELECT *, coalesce(ps = sys AND ns = sys AND po = no_ AND po <> off AND k + po >= 1, false) AS wrong FROM nb),
isl AS (SELECT *, sum(CASE WHEN wrong THEN 0 ELSE 1 END) OVER (PARTITION BY book_id ORDER BY k) AS island FROM wr),
fx AS (SELECT *, wrong AND row_number() OVER (PARTITION BY book_id, island, wrong ORDER BY k) % 2 = 1 AS fixed FROM isl),
av AS (SELECT book_id, k, sys, value AS printed, fixed, CAST(CASE WHEN fixed THEN k + po ELSE value END AS BIGINT) AS value FROM fx),
fr AS (SELECT book_id, i AS k, page_type <> 'normalPage' AS uncounted, side FROM obs WHERE value IS NULL),
gp AS (SELECT * FROM (SELECT book_id, k AS a_k, value AS a_value, sys AS a_system, lead(k) OVER w AS b_k, lead(value) OVER w AS b_value, lead(sys) OVER w AS b_system FROM av WINDOW w AS (PARTITION BY book_id ORDER BY k)) WHERE b_k IS NOT NULL),
gf AS (SELECT g.*, (SELECT count(*) FROM fr WHERE fr.book_id = g.book_id AND fr.k > g.a_k AND fr.k < g.b_k) AS free FROM gp g),
gr AS (SELECT *, b_value - a_value - 1 AS missing, CASE WHEN a_system = b_system AND b_value - a_value - 1 BETWEEN 0 AND free THEN 'fill'
         WHEN a_system = b_system AND b_value - a_value - 1 > free THEN 'gap' WHEN a_system = b_system THEN 'break' ELSE 'restart' END AS rule FROM gf)"""


def scans(spark, sf_dir):
    """The made books as scans for the pagination operators."""
    table(spark, sf_dir, "documents").createOrReplaceTempView("documents")
    d = spark.sql(OBS)
    number = F.struct(F.lit(None).cast("string").alias("side"), F.col("value").cast("string").alias("raw"), F.col("value").cast("string").alias("normalized"), F.col("value").cast("int").alias("numeric_value"), F.col("sys").alias("numeral_system"))
    none = F.lit(None).cast("string")
    return d.select("book_id", F.col("i").cast("int").alias("scan_index"), "page_type", "side", none.alias("leaf"), F.when(F.col("value").isNotNull(), F.array(number)).otherwise(F.array().cast(f"array<{P.NUMBER}>")).alias("numbers"), F.array().cast(f"array<{P.SUBPAGE}>").alias("subpages"))


@query(f"WITH obs AS ({OBS}) SELECT book_id, CAST(i AS BIGINT) AS k, page_type, side, CASE WHEN value IS NULL THEN 'free' ELSE 'printed' END AS kind, page_type <> 'normalPage' AS uncounted FROM obs")
def q_pages_explode(spark, sf_dir):
    return P.pages(scans(spark, sf_dir)).select("book_id", F.col("k").cast("bigint").alias("k"), "page_type", "side", "kind", "uncounted")


@query(f"""WITH obs AS ({OBS}) SELECT book_id, CASE WHEN sum(CASE WHEN value IS NULL THEN 0 WHEN (value % 2 = 1) = (side = 'right') THEN 1 ELSE -1 END) < 0 THEN 'left' ELSE 'right' END AS odd_side FROM obs GROUP BY book_id""")
def q_odd_side_vote(spark, sf_dir):
    return P.odd_side(scans(spark, sf_dir))


@query(_ANCHORS + " SELECT book_id, CAST(k AS BIGINT) AS k, printed, value, fixed FROM av")
def q_anchor_conflicts(spark, sf_dir):
    a = P.anchors(P.pages(scans(spark, sf_dir)))
    return a.select("book_id", *[F.col(c).cast("bigint").alias(c) for c in ("k", "printed", "value")], "fixed")


@query(_ANCHORS + " SELECT book_id, CAST(a_k AS BIGINT) AS a_k, CAST(b_k AS BIGINT) AS b_k, CAST(free AS BIGINT) AS free, CAST(missing AS BIGINT) AS missing, rule FROM gr")
def q_number_gaps(spark, sf_dir):
    paged = P.pages(scans(spark, sf_dir))
    return P.gaps(paged, P.anchors(paged)).select("book_id", *[F.col(c).cast("bigint").alias(c) for c in ("a_k", "b_k", "free", "missing")], "rule")


#: Counted pages of stretches that need no choice: before the first anchor, after a break, after the last anchor, and full or empty fills.
@query(_ANCHORS + """,
edge AS (SELECT book_id, min(k) AS first_k, max(k) AS last_k FROM av GROUP BY book_id),
st AS (SELECT f.*, (SELECT max(k) FROM av WHERE av.book_id = f.book_id AND av.k < f.k) AS pk, (SELECT min(k) FROM av WHERE av.book_id = f.book_id AND av.k > f.k) AS nk FROM fr f),
sv AS (SELECT st.*, p.value AS pv, q.value AS nv, g.rule, g.missing, g.free,
        sum(CASE WHEN uncounted THEN 0 ELSE 1 END) OVER (PARTITION BY st.book_id, pk ORDER BY st.k DESC) AS back, row_number() OVER (PARTITION BY st.book_id, pk ORDER BY st.k) AS onn
       FROM st LEFT JOIN av p ON p.book_id = st.book_id AND p.k = pk LEFT JOIN av q ON q.book_id = st.book_id AND q.k = nk LEFT JOIN gr g ON g.book_id = st.book_id AND g.a_k = pk)
SELECT book_id, CAST(k AS BIGINT) AS k, CAST(CASE WHEN nv IS NULL THEN pv + onn
  WHEN pk IS NULL OR rule IN ('break', 'restart') THEN CASE WHEN NOT uncounted AND back <= nv - 1 THEN nv - back END
  WHEN rule = 'fill' AND missing > 0 THEN pv + onn END AS BIGINT) AS value
FROM sv WHERE NOT coalesce(rule = 'fill' AND missing BETWEEN 1 AND free - 1, false)""")
def q_counted_pages(spark, sf_dir):
    d = P.number_pages(scans(spark, sf_dir)).where(F.col("kind").isin("counted", "lettered", "free") & ~F.col("chosen"))
    return d.select("book_id", F.col("k").cast("bigint").alias("k"), F.col("value").cast("bigint").alias("value"))


@query(None)
def q_page_labels(spark, sf_dir):
    """All labels, with those that the least-cost assignment chooses; held against golden sequences in the tests."""
    return P.page_labels(scans(spark, sf_dir)).select("book_id", "k", "scan_index", "side", "ord", "label", "numeric_value", "numeral_system", "origin", "kind")


@query(None)
def q_scan_page_number(spark, sf_dir):
    return P.scan_page_numbers(P.page_labels(scans(spark, sf_dir)))


@query(None)
def q_number_runs(spark, sf_dir):
    paged = P.pages(scans(spark, sf_dir))
    return P.number_runs(paged, P.anchors(paged))
