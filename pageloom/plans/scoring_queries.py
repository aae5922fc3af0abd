"""Scoring queries: rules on documents as predictions, labels as the reviewed truth."""

from pyspark.sql import functions as F

from pageloom.operators import scoring
from pageloom.plans.catalog import query, table

OUTCOMES_SQL = """
SELECT outcome, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT CASE WHEN l.doc_id IS NULL THEN 'not_scored'
              WHEN CAST(CASE WHEN d.n_chars >= 200 THEN 1 ELSE 0 END AS VARCHAR) = CAST(l.quality AS VARCHAR) THEN 'correct'
              ELSE 'wrong_value' END AS outcome
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id) GROUP BY outcome"""


@query(OUTCOMES_SQL)
def q_score_outcomes(spark, sf_dir):
    """Histogram of outcomes of the rule "200 characters or more are good quality" against the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("n_chars") >= 200, "1").otherwise("0").alias("predicted"))
    gold = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("value"))
    status = F.when(F.col("value").isNotNull(), "verified").otherwise("not_reviewed")
    no = F.lit(None).cast("string")
    true, false = F.lit(True), F.lit(False)
    accept = scoring.acceptable(status, F.col("value"), F.array().cast("array<string>"))
    coded = scoring.outcome(accept, status, true, no, no, true, false, F.col("predicted"))
    return docs.join(gold, "doc_id", "left").groupBy(F.coalesce(coded, F.lit("not_scored")).alias("outcome")).agg(F.count("*").alias("n"))
