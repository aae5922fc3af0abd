"""The queries: each applies its operator, with production parameters, to its whole table."""

import zlib

from pyspark.sql import functions as F

from pageloom.llm import line_dedup, lm_scoring, mixing, neighbours, ngram_join, packing, quality_classifier, quality_rules, sharding, toxicity
from pageloom.llm.catalog import query, table

SHARD_LIMIT = 1 << 20

SHARDS_SQL = f"""
WITH r AS (SELECT doc_id, CAST(coalesce(octet_length(encode(text)), 0) AS BIGINT) AS bytes,
                  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS hash FROM documents),
d AS (SELECT CAST(range AS BIGINT) AS depth FROM range(0, 61)),
n AS (SELECT depth, hash >> (60 - depth) AS prefix, sum(bytes) AS shard_bytes, min(hash) AS lo, max(hash) AS hi FROM r, d GROUP BY 1, 2),
f AS (SELECT * FROM n WHERE shard_bytes <= {SHARD_LIMIT} OR lo = hi),
m AS (SELECT r.doc_id, r.bytes, r.hash, min(f.depth) AS depth FROM r, f WHERE r.hash >> (60 - f.depth) = f.prefix GROUP BY ALL)
SELECT m.doc_id, m.bytes, CAST(m.depth AS BIGINT) AS depth, CAST(f.prefix AS BIGINT) AS prefix, CAST(f.shard_bytes AS BIGINT) AS shard_bytes,
       f.shard_bytes > {SHARD_LIMIT} AS oversized
FROM m JOIN f ON f.depth = m.depth AND f.prefix = m.hash >> (60 - m.depth)"""


@query(SHARDS_SQL)
def op4_sharding(spark, sf_dir):
    """Every document's shard under 1 MiB of text a shard."""
    docs = table(spark, sf_dir, "documents")
    out = sharding.extendible_shards(docs, "doc_id", F.octet_length("text"), SHARD_LIMIT)
    return out.select(F.col("key").alias("doc_id"), "bytes", F.col("depth").cast("bigint").alias("depth"), "prefix", "shard_bytes", "oversized")


@query()
def op2_quality_rules(spark, sf_dir):
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


@query()
def op9_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query()
def op8_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op10_quality_classifier(spark, sf_dir):
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op5_lm_scoring(spark, sf_dir):
    return lm_scoring.lm_scores(table(spark, sf_dir, "documents"))


@query()
def op3_nearest_neighbours(spark, sf_dir):
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


#: Which domain the checksum gives each of the driver's sources, for SQL without that checksum.
DOMAINS = {f"src{i}": f"domain{zlib.crc32(f'src{i}'.encode()) % 4}" for i in range(20)}


def _fill_sql(name: str, nodes: str, parent: str) -> str:
    """DuckDB form of a level of the tree: {name}(own columns, budget) from {nodes}(own columns, parent's, cap, weight, key, budget)."""
    by = f"PARTITION BY {parent}" if parent else ""
    order = f"{by} ORDER BY cap / weight, key"
    return f"""
{name} AS (SELECT * REPLACE (least(cap, max(lvl) OVER ({by}) * weight) AS budget) FROM (
  SELECT *, (budget - coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM ({nodes})))"""


def mixing_sql(documents: str = "documents", columns: str = "doc_id, CAST(epoch AS INTEGER) AS epoch, domain, lang, source, tokens") -> str:
    """The mix with its default parameters, as DuckDB SQL."""
    domains = "coalesce(map {" + ", ".join(f"'{k}': '{v}'" for k, v in DOMAINS.items()) + "}[coalesce(source, '')], 'domain0')"
    node = lambda own, extra: f"SELECT {own}, sum(tokens)::DOUBLE * 2 AS cap, sqrt(sum(tokens)::DOUBLE) AS weight, {own.split(', ')[-1]} AS key, {extra}"
    return f"""
WITH rws AS (SELECT *, {domains} AS dm, coalesce(lang, '') AS lg, coalesce(source, '') AS sc,
                    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tk FROM {documents}),
lv AS (SELECT dm, lg, sc, sum(tk) AS tokens, count(*) AS n FROM rws WHERE tk > 0 GROUP BY ALL),
{_fill_sql("l1", node("dm", "(SELECT sum(tokens)::DOUBLE FROM lv) AS budget FROM lv GROUP BY dm"), "")},
{_fill_sql("l2", "SELECT a.*, l1.budget FROM (" + node("dm, lg", "0 AS z FROM lv GROUP BY dm, lg") + ") a JOIN l1 USING (dm)", "dm")},
{_fill_sql("l3", "SELECT a.*, l2.budget FROM (" + node("dm, lg, sc", "0 AS z FROM lv GROUP BY dm, lg, sc") + ") a JOIN l2 USING (dm, lg)", "dm, lg")},
pl AS (SELECT dm, lg, sc, CAST(floor(budget / tokens + 1e-9) AS INTEGER) AS ep, greatest(0.0, budget - floor(budget / tokens + 1e-9) * tokens) AS rest
       FROM l3 JOIN lv USING (dm, lg, sc)),
od AS (SELECT *, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '/11/' || ep), 1, 15) AS BIGINT) AS place FROM rws JOIN pl USING (dm, lg, sc) WHERE tk > 0),
cm AS (SELECT *, sum(tk) OVER (PARTITION BY dm, lg, sc ORDER BY place RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM od),
tm AS (SELECT *, ep + CASE WHEN cum <= rest THEN 1 ELSE 0 END AS times FROM cm),
mixed AS (SELECT * EXCLUDE (tokens), CAST(tk AS BIGINT) AS tokens FROM (SELECT *, 0 AS tokens, dm AS domain, unnest(range(0, times)) AS epoch FROM tm WHERE times > 0))
SELECT {columns} FROM mixed"""


@query(mixing_sql())
def op6_mixing(spark, sf_dir):
    """Every document as often as a mix of all tokens takes it, at most twice."""
    return mixing.schedule(table(spark, sf_dir, "documents"))


@query()
def op1_ngram_join(spark, sf_dir):
    return ngram_join.jaccard_join(table(spark, sf_dir, "documents"))


@query()
def op7_line_dedup(spark, sf_dir):
    """All documents that keep a line, without fuzzy copies of earlier lines."""
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
