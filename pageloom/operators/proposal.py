"""The text that a model reconciles a book from: a summary of the numbering, then every scan with its evidence in full."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions.text import collapse


def _json(text: Column) -> Column:
    """The collapsed text as a JSON string."""
    return F.regexp_extract(F.to_json(F.struct(collapse(text).alias("x"))), r'(?s)^\{"x":(.*)\}$', 1)


def evidence(value: Column, confidence: Column, reason: Column) -> Column:
    """The value with its confidence and reason in brackets, as far as they are known."""
    shown = F.regexp_replace(F.regexp_replace(F.format_number(confidence, 4), r"0+$", ""), r"\.$", "")
    extra = F.concat_ws(", ", shown, F.when(reason != "", _json(reason)))
    return F.when(extra != "", F.concat(value, F.lit(" ("), extra, F.lit(")"))).otherwise(value)


def scan_lines(scans: DataFrame) -> DataFrame:
    """book_id, ord, line for scans (book_id, scan_index, observation, page_number): one line a scan, its texts below it."""
    o = F.col("observation")
    some = lambda c: F.coalesce(F.size(o[c]), F.lit(0)) > 0
    level = lambda x: F.coalesce(x["level"].cast("string"), F.lit("?"))
    maybe = lambda before, x, after="": F.coalesce(F.concat(F.lit(before), x, F.lit(after)), F.lit(""))
    subs = F.when(some("subpages"), F.concat(F.lit(" ("), F.array_join(F.transform(o["subpages"], lambda s: F.concat(s["side"], F.lit(" "), F.coalesce(s["page_type"], F.lit("?")), maybe(" leaf ", s["leaf"]))), ", "), F.lit(")"))).otherwise("")
    side = F.concat(evidence(F.coalesce(o["side"], F.lit("side unknown")), F.when(o["side"].isNotNull(), o["side_confidence"]), o["side_reason"]), subs)
    leaf = F.when(o["leaf"].isNotNull() | (o["leaf_reason"] != ""), evidence(F.concat(F.lit("leaf "), F.coalesce(o["leaf"], F.lit("unknown"))), F.lit(None).cast("double"), o["leaf_reason"]))
    numbers = F.when(some("printed_numbers"), F.concat(F.lit("printed "), F.array_join(F.transform(o["printed_numbers"], lambda n: F.concat(n["raw"], maybe(" (", n["side"], ")"), maybe(" at ", n["position"]))), ", "))).otherwise("no printed number")
    label = F.concat(F.lit("label "), F.coalesce("page_number", F.lit("unresolved")))
    head = F.concat_ws("; ", evidence(F.coalesce(o["page_type"], F.lit("page type unknown")), o["page_type_confidence"], o["page_type_reason"]), side, leaf, numbers, label)
    at = (F.col("scan_index") + 1).cast("string")
    first = F.concat(F.lit("scan "), at, F.lit(": "), F.when(o.isNull(), F.concat(F.lit("not observed (request failed); "), label)).otherwise(head))
    none = F.array().cast("array<string>")
    below = F.concat(
        F.coalesce(F.transform(o["headings"], lambda h: F.concat(F.lit("  heading level "), level(h), F.lit(": "), _json(h["text"]))), none),
        F.coalesce(F.transform(o["toc_entries"], lambda e: F.concat(F.lit("  TOC entry level "), level(e), F.lit(": "), _json(e["title"]), F.lit(" -> "), F.coalesce(F.when(e["printed_page_reference"] != "", _json(e["printed_page_reference"])), F.lit("no page reference")))), none),
        F.coalesce(F.transform(o["bibliographic_candidates"], lambda c: F.concat(F.lit("  "), c["field"], F.lit(": "), _json(c["value"]))), none),
        F.when(o["notes"] != "", F.array(F.concat(F.lit("  note: "), _json(o["notes"])))).otherwise(none),
    )
    return scans.select("book_id", F.col("scan_index").alias("ord"), F.array_join(F.concat(F.array(first), below), "\n").alias("line"))


def header_lines(scans: DataFrame, runs: DataFrame, warnings: DataFrame) -> DataFrame:
    """book_id, ord, line: what stands above the scans. runs: book_id, run, line. warnings: book_id, stage, ord, code, message."""
    n = scans.groupBy("book_id").agg(F.count("*").alias("n"))
    top = n.select("book_id", F.lit(0).alias("ord"), F.concat(F.lit("Book with "), F.col("n").cast("string"), F.lit(' scans; "scan N" is the position in scanning order, not a page number.\n\nPrinted page numbering:')).alias("line"))
    run = n.join(runs.groupBy("book_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("run", "line"))), lambda x: x["line"]), "\n").alias("r")), "book_id", "left").select("book_id", F.lit(1).alias("ord"), F.coalesce("r", F.lit("- no page numbers observed")).alias("line"))
    warn = warnings.groupBy("book_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("stage", "ord", "code", "message"))), lambda x: F.concat(F.lit("- "), x["code"], F.lit(": "), x["message"])), "\n").alias("line")).select("book_id", F.lit(2).alias("ord"), "line")
    last = n.select("book_id", F.lit(3).alias("ord"), F.lit("\nScans:").alias("line"))
    return top.unionByName(run).unionByName(warn).unionByName(last)
