"""Usage queries: events stand for calls, users for runs."""

from pyspark.sql import functions as F

from pageloom.operators import usage
from pageloom.plans.catalog import query, table

_CALLS = """SELECT user_id AS run_id, event_id AS call_id, event_type AS stage, CASE WHEN event_type = 'error' THEN 'http_error' ELSE 'ok' END AS status,
 CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 1000 END AS prompt_tokens, event_id % 77 AS completion_tokens, CASE WHEN event_type = 'view' THEN NULL ELSE CAST(value AS DECIMAL(18,6)) END AS cost,
 row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS attempt, event_id % 5 AS model FROM events"""
_SUMS = """CAST(count(*) AS BIGINT) AS calls, CAST(count(*) FILTER (status <> 'ok') AS BIGINT) AS failed_calls, CAST(sum(coalesce(prompt_tokens, 0)) AS BIGINT) AS prompt_tokens,
 CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens, CAST(sum(cost) AS DOUBLE) AS cost_usd, count(cost) = count(*) AS cost_complete"""


def calls(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    id_ = F.col("event_id")
    d = e.select(
        F.col("user_id").alias("run_id"), id_.alias("call_id"), F.col("event_type").alias("stage"), "ts", F.when(F.col("event_type") == "error", "http_error").otherwise("ok").alias("status"),
        F.when(id_ % 3 != 0, id_ % 1000).alias("prompt_tokens"), (id_ % 77).alias("completion_tokens"), F.when(F.col("event_type") != "view", F.col("value")).alias("cost_usd"),
        F.concat(F.lit("model"), (id_ % 5).cast("string")).alias("served_model"), F.lit(None).cast("double").alias("latency_s"),
    )
    return usage.number_attempts(d.withColumn("_at", F.struct("ts", "call_id")), ["run_id", "stage"], "_at").drop("_at")


@query(f"WITH c AS ({_CALLS}) SELECT run_id, {_SUMS} FROM c GROUP BY run_id")
def q_usage_totals(spark, sf_dir):
    return usage.usage_totals(calls(spark, sf_dir))


@query(f"WITH c AS ({_CALLS}) SELECT stage, status, {_SUMS} FROM c GROUP BY ROLLUP (stage, status)")
def q_usage_rollup_by_stage(spark, sf_dir):
    return usage.usage_rollup(calls(spark, sf_dir))


@query(f"""WITH c AS ({_CALLS}), t AS (SELECT run_id, {_SUMS} FROM c GROUP BY run_id)
SELECT run_id % 7 AS grp, CAST(count(*) AS BIGINT) AS books, CAST(sum(calls) AS BIGINT) AS calls, CAST(sum(failed_calls) AS BIGINT) AS failed_calls, CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens,
 CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens, CAST(sum(CAST(cost_usd AS DECIMAL(18,6))) AS DOUBLE) AS cost_usd, bool_and(cost_complete) AS cost_complete FROM t GROUP BY 1""")
def q_usage_over_books(spark, sf_dir):
    return usage.usage_over_books(usage.usage_totals(calls(spark, sf_dir)).withColumn("grp", F.col("run_id") % 7), "grp")


@query(f"""WITH c AS ({_CALLS}) SELECT run_id, string_agg(DISTINCT 'model' || model, ',' ORDER BY 'model' || model) AS models, CAST(count(*) FILTER (attempt > 1) AS BIGINT) AS retries,
 round(CAST(count(*) FILTER (status <> 'ok') AS DOUBLE) / count(*), 4) AS error_rate FROM c GROUP BY run_id""")
def q_retry_error_rate(spark, sf_dir):
    return usage.provenance(calls(spark, sf_dir)).select("run_id", F.concat_ws(",", "served_models").alias("models"), "retries", "error_rate")
