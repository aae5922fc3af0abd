"""Outcome-coded scoring of predictions against reviewed labels."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Outcomes that count as scored, then those that stay outside the denominator.
SCORED = ["correct", "wrong_value", "missing_value", "spurious_value"]
UNSCORED = ["no_prediction", "scan_missing", "hash_mismatch", "incomparable", "ambiguous_unscorable", "document_incompatible"]


def acceptable(status: Column, value: Column, alternatives: Column) -> Column:
    """The values that count as right for a label of this status; NULL where nothing can be scored."""
    none = F.array(F.lit(None).cast("string"))
    return (
        F.when(status == "verified", F.array(value))
        .when(status.isin("absent", "not_applicable"), none)
        .when((status == "ambiguous") & (F.size(alternatives) > 0), alternatives)
    )


def outcome(accept: Column, status: Column, scan_present: Column, sha_gold: Column, sha_pred: Column, provided: Column, incomparable: Column, predicted: Column) -> Column:
    """One label's outcome; earlier rules win, and NULL means that the label is not up for scoring."""
    return (
        F.when(accept.isNull() & (status == "ambiguous"), "ambiguous_unscorable")
        .when(accept.isNull(), F.lit(None).cast("string"))
        .when(~scan_present, "scan_missing")
        .when(sha_gold != sha_pred, "hash_mismatch")
        .when(~provided, "no_prediction")
        .when(incomparable, "incomparable")
        .when(F.exists(accept, lambda a: a.eqNullSafe(predicted)), "correct")
        .when(predicted.isNull(), "missing_value")
        .when(F.forall(accept, lambda a: a.isNull()), "spurious_value")
        .otherwise("wrong_value")
    )


# Long tables: gold (book_id, scan_id, scan_index, sha, field, status, accept) and predictions (system, layer, book_id,
# scan_id, scan_index, sha, field, value, incomparable). A field that a system doesn't give for a scan has no row.


def field_stats(coded: DataFrame, *keys: str) -> DataFrame:
    """keys, one count an outcome, scored, eligible, accuracy and coverage; rows whose outcome is NULL aren't eligible."""
    counts = [F.count_if(F.col("outcome") == o).alias(o) for o in SCORED + UNSCORED]
    d = coded.groupBy(*keys).agg(*counts, F.count_if(F.col("outcome").isNull()).alias("not_scored"))
    d = d.withColumn("scored", sum((F.col(o) for o in SCORED), F.lit(0))).withColumn("eligible", F.col("scored") + sum((F.col(o) for o in UNSCORED), F.lit(0)))
    return d.withColumns({"accuracy": F.round(F.try_divide("correct", "scored"), 4), "coverage": F.round(F.try_divide("scored", "eligible"), 4)})


def status_counts(gold: DataFrame) -> DataFrame:
    return gold.groupBy("field", "status").agg(F.count("*").alias("n"))


def match_books(gold: DataFrame, predictions: DataFrame) -> DataFrame:
    """book_id, predicted_book for books that share a scan id, by an equi-join. The query fails where a book or a prediction has several."""
    pairs = gold.select("book_id", "scan_id").distinct().join(predictions.select(F.col("book_id").alias("predicted_book"), "scan_id").distinct(), "scan_id").select("book_id", "predicted_book").distinct()
    others = lambda side: F.count("*").over(Window.partitionBy(side)) > 1
    pairs = pairs.withColumns({f"_{side}": others(side) for side in ("book_id", "predicted_book")})
    wrong = F.raise_error(F.concat(F.lit("several matches of books: "), "book_id", F.lit(" and "), "predicted_book"))
    return pairs.select("book_id", F.when(F.col("_book_id") | F.col("_predicted_book"), wrong).otherwise(F.col("predicted_book")).alias("predicted_book"))


def score_scans(gold: DataFrame, predictions: DataFrame) -> DataFrame:
    """Each gold label of each (system, layer) with its outcome: left joins by scan and by field tell absent scans from absent fields."""
    groups = predictions.select("system", "layer").distinct()
    scans = predictions.select("system", "layer", "scan_id", F.col("sha").alias("p_sha"), F.col("scan_index").alias("p_index")).distinct()
    values = predictions.select("system", "layer", "scan_id", "field", F.col("value").alias("predicted"), "incomparable", F.lit(True).alias("provided"))
    d = gold.crossJoin(F.broadcast(groups)).join(scans.withColumn("present", F.lit(True)), ["system", "layer", "scan_id"], "left").join(values, ["system", "layer", "scan_id", "field"], "left")
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    return d.withColumn("outcome", outcome(F.col("accept"), F.col("status"), yes("present"), F.col("sha"), F.col("p_sha"), yes("provided"), yes("incomparable"), F.col("predicted")))


def scan_summary(coded: DataFrame) -> DataFrame:
    """Per (system, layer): scans compared, missing, with another hash, with both hashes, at another place."""
    scans = coded.select("system", "layer", "book_id", "scan_id", "scan_index", "sha", "p_sha", "p_index", "present").distinct()
    on = F.coalesce("present", F.lit(False))
    return scans.groupBy("system", "layer").agg(
        F.count_if(on).alias("compared"), F.count_if(~on).alias("missing"), F.count_if(F.col("sha") != F.col("p_sha")).alias("hash_mismatch"),
        F.count_if(on & F.col("sha").isNotNull() & F.col("p_sha").isNotNull()).alias("hash_checked"), F.count_if(F.col("scan_index") != F.col("p_index")).alias("index_differs"),
    )


def document_check(gold_scans: DataFrame, predicted_scans: DataFrame) -> DataFrame:
    """book_id, reason (NULL where the documents agree): hash_mismatch, then partial, then scan_count.

    gold_scans: book_id, scan_id, sha, scan_count. predicted_scans: book_id, scan_id, p_sha, p_scan_count.
    """
    d = gold_scans.join(predicted_scans.drop("book_id").withColumn("present", F.lit(True)), "scan_id", "left")
    g = d.groupBy("book_id").agg(F.count_if(F.col("present").isNull()).alias("missing"), F.count_if(F.col("sha") != F.col("p_sha")).alias("mismatched"), F.max("scan_count").alias("n"), F.max("p_scan_count").alias("p"))
    reason = F.when(F.col("mismatched") > 0, "hash_mismatch").when((F.col("missing") > 0) | (F.col("p") < F.col("n")), "partial").when(F.col("p") != F.col("n"), "scan_count")
    return g.select("book_id", "missing", "mismatched", reason.alias("reason"))


def match_titles(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """Chapters paired by equal titles, the k-th of a title with the k-th: what taking the first unused one gives.

    Both: book_id, pos, title (in comparison form), start, ref.
    """
    nth = lambda d: d.withColumn("nth", F.row_number().over(Window.partitionBy("book_id", "title").orderBy("pos")))
    p = nth(predicted).select("book_id", "title", "nth", *[F.col(c).alias(f"p_{c}") for c in ("pos", "start", "ref")])
    return nth(gold).join(p, ["book_id", "title", "nth"], "left")


def structure_scores(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """Per book: matched titles, title recall and precision, starts and references right among those that gold has, sets of starts in common."""
    n = predicted.groupBy("book_id").agg(F.count("*").alias("predicted"), F.collect_set("start").alias("p_starts"))
    m = match_titles(gold, predicted)
    hit = F.col("p_pos").isNotNull()
    d = m.groupBy("book_id").agg(
        F.count("*").alias("gold"), F.count_if(hit).alias("matched"), F.collect_set("start").alias("starts"),
        F.count_if(hit & F.col("start").isNotNull()).alias("starts_scored"), F.count_if(hit & (F.col("start") == F.col("p_start"))).alias("starts_correct"),
        F.count_if(hit & F.col("ref").isNotNull()).alias("refs_scored"), F.count_if(hit & (F.col("ref") == F.col("p_ref"))).alias("refs_correct"),
    ).join(n, "book_id", "left")
    common = F.coalesce(F.size(F.array_intersect("starts", "p_starts")), F.lit(0))
    return d.select(
        "book_id", "gold", F.coalesce("predicted", F.lit(0)).alias("predicted"), "matched", F.round(F.try_divide("matched", "gold"), 4).alias("title_recall"), F.round(F.try_divide("matched", "predicted"), 4).alias("title_precision"),
        "starts_scored", "starts_correct", "refs_scored", "refs_correct", common.alias("common_starts"),
    )


def agreement(left: DataFrame, right: DataFrame) -> DataFrame:
    """Agreement of each system with each comparator by field: the comparator's values that aren't NULL are the reference."""
    a = left.select(F.col("system"), "layer", "scan_id", "field", "value")
    b = right.where("value is not null").select(F.col("system").alias("comparator"), "scan_id", "field", F.col("value").alias("reference"))
    groups = a.select("system", "layer").distinct()
    d = b.crossJoin(F.broadcast(groups)).join(a.withColumn("given", F.lit(True)), ["system", "layer", "scan_id", "field"], "left")
    return d.groupBy("system", "layer", "comparator", "field").agg(F.count("*").alias("eligible"), F.count_if("given").alias("compared"), F.count_if(F.col("value") == F.col("reference")).alias("agreed")).withColumn("agreement", F.round(F.try_divide("agreed", "compared"), 4))


def incomparable_values(predictions: DataFrame) -> DataFrame:
    return predictions.where("incomparable").groupBy("system", "layer", "field", F.col("value").alias("raw")).agg(F.count("*").alias("n"))


def errors(coded: DataFrame, first: int | None = None) -> DataFrame:
    """Labels that are scored and not correct, by book, scan and field; `first` keeps so many, for a report."""
    rows = coded.where(F.col("outcome").isNotNull() & ~F.col("outcome").isin("correct", "no_prediction", "scan_missing")).orderBy("book_id", "scan_index", "field")
    return rows.limit(first) if first else rows
