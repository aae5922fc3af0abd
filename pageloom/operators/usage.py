"""Usage of remote requests: totals, retries and provenance from a table of calls.

calls: run_id, call_id, stage, scan_id, attempt, status, prompt_tokens, completion_tokens, cost_usd, served_model, latency_s.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,6)"


def _totals() -> list:
    cost = F.col("cost_usd").cast(MONEY)
    return [
        F.count("*").alias("calls"),
        F.count_if(F.col("status") != "ok").alias("failed_calls"),
        F.sum(F.coalesce("prompt_tokens", F.lit(0))).cast("bigint").alias("prompt_tokens"),
        F.sum(F.coalesce("completion_tokens", F.lit(0))).cast("bigint").alias("completion_tokens"),
        F.sum(cost).cast("double").alias("cost_usd"),
        (F.count("cost_usd") == F.count("*")).alias("cost_complete"),
    ]


def usage_totals(calls: DataFrame, *keys: str) -> DataFrame:
    """One row a run (or other keys): NULL tokens count 0; the cost is NULL if no call has one, and complete if all have."""
    return calls.groupBy(*(keys or ("run_id",))).agg(*_totals())


def usage_rollup(calls: DataFrame) -> DataFrame:
    """Totals by stage and status, by stage, and of all calls; NULL keys stand for all."""
    return calls.rollup("stage", "status").agg(*_totals())


def usage_over_books(totals: DataFrame, *keys: str) -> DataFrame:
    """Totals of totals: complete only where every part is."""
    sums = [F.sum(c).cast("bigint").alias(c) for c in ("calls", "failed_calls", "prompt_tokens", "completion_tokens")]
    return totals.groupBy(*keys).agg(F.count("*").alias("books"), *sums, F.sum(F.col("cost_usd").cast(MONEY)).cast("double").alias("cost_usd"), F.bool_and("cost_complete").alias("cost_complete"))


def provenance(calls: DataFrame) -> DataFrame:
    """Served models, retries (calls beyond a request's first), share of failures and summed latency of each run."""
    return calls.groupBy("run_id").agg(
        F.array_sort(F.collect_set("served_model")).alias("served_models"),
        F.count_if(F.col("attempt") > 1).alias("retries"),
        F.round(F.try_divide(F.count_if(F.col("status") != "ok"), F.count("*")), 4).alias("error_rate"),
        F.sum(F.col("latency_s").cast(MONEY)).cast("double").alias("latency_s"),
    )


def number_attempts(calls: DataFrame, request: list[str], order: str) -> DataFrame:
    """attempt 1..k of each request, by time."""
    from pyspark.sql import Window

    return calls.withColumn("attempt", F.row_number().over(Window.partitionBy(*request).orderBy(order)))
