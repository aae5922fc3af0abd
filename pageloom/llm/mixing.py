"""Mixing sources to target weights: a budget of tokens flows down a tree of domains, languages and sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageloom.llm.work import Scratch, fresh, has_words, words_of

LEVELS = ["domain", "lang", "source"]
#: Rows of a leaf that share a bucket of the order when the prefix is looked for.
BUCKET = 500
SPAN = 1 << 60


def order_key(key: Column, seed: int, epoch: Column) -> Column:
    """The place of a row in a seeded epoch: 60 bits of an MD5."""
    text = F.concat_ws("/", F.coalesce(key.cast("string"), F.lit("")), F.lit(str(seed)), epoch.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def default_domain(source: Column) -> Column:
    """A domain for tables that have none: one of four, by the source's checksum."""
    return F.concat(F.lit("domain"), F.pmod(F.crc32(F.coalesce(source, F.lit(""))), F.lit(4)).cast("string"))


def _fill(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """Budget of each node: its weight's share of its parent's, never over its capacity; what a full node can't take goes to its siblings by weight.

    Siblings stand by capacity a unit of weight. The level at which the budget runs out is the largest of
    (budget - capacities before) / (weights from here on); a node gets that level times its weight, or its capacity.
    """
    by = Window.partitionBy(*parent)
    order = by.orderBy(F.col("cap") / F.col("weight"), "key")
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    level = (F.col("budget") - before) / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    return nodes.withColumn("_level", level).withColumn("budget", F.least(F.col("cap"), F.max("_level").over(by) * F.col("weight"))).drop("_level")


def leaf_budgets(leaves: DataFrame, budget: float, max_epochs: int, weights: dict[str, dict[str, float]], levels: list[str] = LEVELS) -> DataFrame:
    """levels, tokens, n, budget for each leaf (levels, tokens, n).

    A node's weight among its siblings is the one given for its value, else the square root of its tokens. Its
    capacity is max_epochs times its tokens. Capacities are those of whole subtrees, so a shortage is made good by
    siblings first, and only what a subtree can't hold reaches its parent's siblings. Leaves without tokens get nothing.
    """
    live = leaves.where("tokens > 0")
    above = None
    for k, name in enumerate(levels):
        parent, own = levels[:k], levels[: k + 1]
        t = live.groupBy(*own).agg(F.sum("tokens").cast("double").alias("t"))
        given = F.create_map(*[F.lit(x) for kv in weights[name].items() for x in kv])[F.col(name)] if weights.get(name) else F.lit(None).cast("double")
        nodes = t.select(*own, (F.col("t") * max_epochs).alias("cap"), F.coalesce(given, F.sqrt("t")).alias("weight"), F.col(name).alias("key")).where("weight > 0")
        if above is None:
            nodes = nodes.withColumn("budget", F.lit(float(budget)))
        else:
            nodes = nodes.join(above, parent)
        above = _fill(nodes, parent).select(*own, "budget")
    return live.join(above, levels)


def cutoffs(rows: DataFrame, budgets: DataFrame, seed: int, work: Scratch, levels: list[str] = LEVELS) -> DataFrame:
    """levels, epochs, cut: how often all of a leaf is taken, and the last place of the next epoch's prefix.

    The prefix is the longest whose tokens stay within what the whole epochs leave. It's found in two steps: sums by
    buckets of the order say in which bucket it ends, and only that bucket's rows are put in order.
    """
    plan = budgets.withColumn("epochs", F.floor(F.col("budget") / F.col("tokens") + 1e-9).cast("int")).withColumn("rest", F.greatest(F.lit(0.0), F.col("budget") - F.col("epochs") * F.col("tokens")))
    plan = work.save(plan.select(*levels, "epochs", "rest", F.ceil(F.col("n") / BUCKET).cast("double").alias("buckets")), "plan")
    keyed = rows.join(plan, levels).withColumn("place", order_key(F.col("doc_id"), seed, F.col("epochs")))
    keyed = work.save(keyed.select(*levels, "tokens", "place", F.floor(F.col("place") / float(SPAN) * F.col("buckets")).alias("bucket")), "keyed")
    sums = keyed.groupBy(*levels, "bucket").agg(F.sum("tokens").alias("t"), F.max("place").alias("top"))
    run = Window.partitionBy(*levels).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = sums.withColumns({"before": F.coalesce(F.sum("t").over(run), F.lit(0)), "passed": F.max("top").over(run)}).join(plan.select(*levels, "rest"), levels)
    ends = work.save(ends.where((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("t") > F.col("rest"))).select(*levels, "bucket", "before", "passed", "rest"), "ends")
    last = keyed.join(ends, [*levels, "bucket"])
    by_place = Window.partitionBy(*levels).orderBy("place").rangeBetween(Window.unboundedPreceding, 0)
    inside = last.withColumn("sum", F.col("before") + F.sum("tokens").over(by_place)).groupBy(*levels).agg(F.max(F.when(F.col("sum") <= F.col("rest"), F.col("place"))).alias("place"), F.first("passed").alias("passed"))
    return plan.select(*levels, "epochs").join(inside, levels, "left").select(*levels, "epochs", F.coalesce("place", "passed", F.lit(-1)).alias("cut"))


def _own(docs: DataFrame, domain: Column | None) -> dict[str, Column]:
    """A row's place in the tree, under names that docs does not have."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    of = {"domain": F.coalesce(domain, F.lit("")) if domain is not None else default_domain(F.col("source")), "lang": blank("lang"), "source": blank("source")}
    return {fresh(docs, f"_{c}"): of[c] for c in LEVELS}


def _cut(rows: DataFrame, work: Scratch, budget_share: float, max_epochs: int, seed: int, weights) -> DataFrame:
    """levels, epochs, cut for each leaf of the rows (doc_id, levels, tokens)."""
    leaves = work.save(rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n")), "leaves")
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    budgets = work.save(leaf_budgets(leaves, total * budget_share, max_epochs, weights or {}), "budgets")
    return work.save(cutoffs(rows, budgets, seed, work).select(*LEVELS, "epochs", "cut"), "cut")


def _times(seed: int, epochs: Column, cut: Column) -> Column:
    return epochs + (order_key(F.col("doc_id"), seed, epochs) <= cut).cast("int")


def schedule(docs: DataFrame, budget_share: float = 1.0, max_epochs: int = 2, seed: int = 11, weights: dict[str, dict[str, float]] | None = None, domain: Column | None = None) -> DataFrame:
    """doc_id, epoch, domain, lang, source, tokens: which rows mix() takes and how often, without their texts, which are read once."""
    work = Scratch(docs.sparkSession, "mix")
    own = _own(docs, domain)
    rows = docs.select("doc_id", *[v.alias(k) for k, v in zip(LEVELS, own.values(), strict=True)], F.size(words_of(F.col("text"))).cast("bigint").alias("tokens"), F.struct("lang", "source").alias("given"))
    rows = work.save(rows.where("tokens > 0"), "rows")
    cut = _cut(rows.drop("given"), work, budget_share, max_epochs, seed, weights)
    taken = rows.join(cut, LEVELS).withColumn("times", _times(seed, F.col("epochs"), F.col("cut"))).where("times > 0")
    return taken.select("doc_id", F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("epoch"), "domain", "given.lang", "given.source", "tokens")


def mix(docs: DataFrame, budget_share: float = 1.0, max_epochs: int = 2, seed: int = 11, weights: dict[str, dict[str, float]] | None = None, domain: Column | None = None) -> DataFrame:
    """docs with epoch, domain and tokens: each row as often as its leaf's budget takes it.

    The budget is budget_share of all tokens (words). A leaf of (domain, language, source) takes whole epochs, then the
    prefix of one more in that epoch's own seeded order; a document that would pass the budget ends it. NULL languages
    and sources count as the text "" (the rows keep their NULLs). Rows without words have no tokens: they are never taken. Repeated
    rows stand together in the order and are taken together, as do rows that share a doc_id; NULL ids count as the text "".
    Where docs has a column epoch, domain or tokens, it stays as it is and the new one's name gets a mark before it. If the
    tree can't hold the budget, every leaf gives max_epochs. Very long texts count as any. No rows give no rows. Only sums by
    leaf and bucket are shuffled; texts stay where they are read.
    """
    work = Scratch(docs.sparkSession, "mix")
    own = _own(docs, domain)
    rows = docs.select("doc_id", *[v.alias(k) for k, v in zip(LEVELS, own.values(), strict=True)], F.size(words_of(F.col("text"))).cast("bigint").alias("tokens"))
    rows = work.save(rows.where("tokens > 0"), "rows")
    epochs, end = fresh(docs, "_epochs"), fresh(docs, "_cut")
    cut = _cut(rows, work, budget_share, max_epochs, seed, weights).toDF(*own, epochs, end)
    times = fresh(docs, "_times")
    taken = docs.withColumns(own).where(has_words(F.col("text"))).join(cut, list(own)).withColumn(times, _times(seed, F.col(epochs), F.col(end))).where(F.col(times) > 0)
    added = [F.explode(F.sequence(F.lit(0), F.col(times) - 1)).alias(fresh(docs, "epoch")), F.col(next(iter(own))).alias(fresh(docs, "domain")), F.size(words_of(F.col("text"))).cast("bigint").alias(fresh(docs, "tokens"))]
    return taken.select(*[F.col(f"`{c}`") for c in docs.columns], *added)
