"""The corpus queries, one opN_<name> for each operator, with the SQL of those that SQL can express."""

from pyspark.sql import DataFrame, SparkSession

QUERIES = {}
ORACLE = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


from pageloom.llm import queries  # noqa: E402,F401
