"""A corpus from raw documents to packed windows: toxicity, line dedup, n-gram join, mixing, packing.

Part of the corpus operators; each stage's result is written as Parquet and read as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm import line_dedup, mixing, ngram_join, packing, toxicity
from pageloom.llm.work import Scratch, fresh

#: Documents that the classifier takes for toxic with this probability go.
TOXIC = 0.5
#: Near copies: words of a shingle, and the similarity in hundredths.
COPY_SHINGLE, COPY_PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents under the threshold; the model learns from the labels outside their held-out fifth."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    to = fresh(docs, "toxicity")
    return toxicity.score(docs, toxicity.train(docs, labels), docs.columns, to).where(F.col(to) < TOXIC).drop(to)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines like earlier ones; documents that had only such lines are copies and go."""
    return line_dedup.dedup_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each component of the join. Rows with a NULL doc_id stay; rows that share one stay together."""
    work = Scratch(spark, "copies")
    rooms = work.save(ngram_join.jaccard_join(docs, COPY_SHINGLE, COPY_PERCENT).where("doc_id != component_id").select("doc_id").distinct(), "gone")
    return docs.join(rooms, "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as there are, dealt to domains, languages and sources by the roots of their sizes; a document comes twice at most."""
    return mixing.mix(docs).select(*docs.columns)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of 2048-token windows."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("ngram_join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir: the pieces that packing() gives of what the others keep.

    NULL texts are kept by the first three stages and never taken by mixing, as are texts without words. Rows with a NULL
    doc_id keep their lines and stand alone in the join. Rows that repeat a doc_id stay or go together there; equal ones keep
    the lines of both. Columns beyond doc_id, text, lang, source and n_chars pass through up to packing, whatever their names.
    An empty table gives an empty table.
    """
    work = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = work.save(stage(spark, docs, sf_dir), name)
    return docs


#: Toxicity, fuzzy lines and packing are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None
