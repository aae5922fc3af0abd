"""Scoring of bibliographic fields, whose values are sets of texts, and canonical forms of values by field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions.text import normalize_label, normalize_number, normalize_text


def canonical(field: str, values: Column) -> Column:
    """The form in which two lists of values of a field are compared; NULL for no list and for an empty one.

    Printed numbers are compared in order of their text, exactly or in their normal form; bibliographic values as sets without
    case, spacing and outer marks; page numbers without spaces; all others as they are.
    """
    if field == "printed_numbers_exact":
        form = F.sort_array(values)
    elif field == "printed_numbers_normalized":
        form = F.sort_array(F.transform(values, normalize_number))
    elif field == "page_number":
        form = F.transform(values, normalize_label)
    else:
        form = values
    return F.when(F.size(values) > 0, form)


def _sets(d: DataFrame, keys: list[str], values: str, to: str) -> DataFrame:
    """keys and `to`: the set of the normal forms of the texts in `values`, sorted; NULL for no list and for an empty one.

    Normal forms need full case folding, so the texts are exploded and folded in batches, a row each.
    """
    one = d.select(*keys, F.posexplode_outer(values).alias("_at", "_v")).withColumn("_v", normalize_text("_v"))
    return one.groupBy(*keys).agg(F.array_sort(F.collect_set("_v")).alias("_s")).select(*keys, F.when(F.size("_s") > 0, F.col("_s")).alias(to))


def score_bibliography(gold: DataFrame, predictions: DataFrame, books: DataFrame, checks: DataFrame) -> DataFrame:
    """Each gold field of each system with its outcome.

    gold: book_id, field, status, accept (lists of values that count as right, a NULL list where nothing does; NULL where
    nothing can be scored). predictions: system, book_id, field, value (a list). books: system, book_id, the books that a
    system has. checks: system, book_id, compatible. Only predictions of the whole, unchanged book are scored.
    """
    options = gold.select("book_id", "field", F.posexplode_outer("accept").alias("nth", "option"))
    right = _sets(options.where("option is not null"), ["book_id", "field", "nth"], "option", "right")
    right = options.select("book_id", "field", "nth").where("nth is not null").join(right, ["book_id", "field", "nth"], "left").groupBy("book_id", "field")
    right = right.agg(F.collect_list("right").alias("right"), F.bool_or(F.col("right").isNull()).alias("none_right"))
    given = predictions.join(_sets(predictions, ["system", "book_id", "field"], "value", "shown"), ["system", "book_id", "field"]).withColumn("provided", F.lit(True))
    d = gold.join(right, ["book_id", "field"], "left").crossJoin(books.select("system").distinct()).join(books.withColumn("present", F.lit(True)), ["system", "book_id"], "left")
    d = d.join(given, ["system", "book_id", "field"], "left").join(checks.select("system", "book_id", "compatible"), ["system", "book_id"], "left")
    hit = F.when(F.col("shown").isNull(), F.col("none_right")).otherwise(F.exists("right", lambda x: x == F.col("shown")))
    outcome = (
        F.when(F.col("accept").isNull(), F.when(F.col("status") == "ambiguous", "ambiguous_unscorable"))
        .when(F.col("present").isNull(), "scan_missing")
        .when(F.col("provided").isNull(), "no_prediction")
        .when(~F.coalesce("compatible", F.lit(False)), "document_incompatible")
        .when(hit, "correct")
        .when(F.col("shown").isNull(), "missing_value")
        .when(F.size("right") == 0, "spurious_value")
        .otherwise("wrong_value")
    )
    return d.select("system", "book_id", "field", "status", "accept", F.col("value").alias("predicted"), outcome.alias("outcome"))


def provided_fields(predictions: DataFrame) -> DataFrame:
    """system, layer, field: what a system gives at a layer at all; all other fields are reported as not provided."""
    return predictions.select("system", "layer", "field").distinct()
