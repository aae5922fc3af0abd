"""Named queries over the driver's tables and the SQL they must agree with."""

from pyspark.sql import DataFrame, SparkSession

QUERIES = {}
ORACLE = {}


def query(sql: str | None):
    """Registers a query under its function's name, with its SQL if there is one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


from pageloom.plans import book_queries, function_queries, page_queries, rule_queries, scoring_queries, source_queries, usage_queries  # noqa: E402,F401
