"""Integrity rules as queries: each gives its violations as rows (rule, book_id, detail)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _found(d: DataFrame, rule: str, detail: Column | str) -> DataFrame:
    text = F.col(detail) if isinstance(detail, str) else detail
    return d.select(F.lit(rule).alias("rule"), F.col("book_id").cast("string").alias("book_id"), text.cast("string").alias("detail"))


def unique(d: DataFrame, rule: str, *keys: str) -> DataFrame:
    return _found(d.groupBy("book_id", *keys).count().where("count > 1"), rule, F.concat_ws("/", *keys))


def known(refs: DataFrame, ids: DataFrame, rule: str) -> DataFrame:
    """References (book_id, id) to nothing."""
    return _found(refs.join(ids, ["book_id", "id"], "left_anti"), rule, "id")


def scan_order(scans: DataFrame, books: DataFrame) -> DataFrame:
    """Counts that differ from the book's, and places that don't run from 0 without holes."""
    n = scans.groupBy("book_id").agg(F.count("*").alias("n"))
    count = books.join(n, "book_id", "left").where(F.coalesce("n", F.lit(0)) != F.col("scan_count"))
    place = scans.withColumn("want", F.row_number().over(Window.partitionBy("book_id").orderBy("scan_index")) - 1).where("want != scan_index")
    return _found(count, "scan_count", "scan_count").unionByName(_found(place, "scan_index", "scan_index"))


def ocr_rules(scans: DataFrame, books: DataFrame) -> DataFrame:
    """OCR data where and only where the book has an OCR folder; each status with the fields that go with it."""
    d = scans.join(books.select("book_id", "ocr_directory"), "book_id")
    both = _found(d.where(F.col("ocr").isNotNull() != F.col("ocr_directory").isNotNull()), "ocr_presence", "scan_index")
    o = F.col("ocr")
    bad = (
        ((o["status"] == "ok") & (o["sha256"].isNull() | o["chars"].isNull() | o["sent_chars"].isNull() | o["error"].isNotNull()))
        | ((o["status"] == "error") & o["error"].isNull())
        | ((o["status"] == "missing") & (o["filename"].isNotNull() | o["error"].isNotNull()))
        | ((o["status"] != "ok") & F.coalesce(o["truncated"], F.lit(False)))
    )
    return both.unionByName(_found(d.where(bad), "ocr_status", "scan_index"))


def observation_calls(scans: DataFrame, calls: DataFrame) -> DataFrame:
    """Observations whose call isn't there, is of another scan or stage, or failed; and calls without their observation."""
    c = calls.select("book_id", F.col("call_id").alias("observation_call_id"), "stage", "status", F.col("scan_id").alias("call_scan"))
    d = scans.join(c, ["book_id", "observation_call_id"], "left")
    good = (F.col("call_scan") == F.col("scan_id")) & F.col("stage").isin("observe", "escalate") & (F.col("status") == "ok")
    bad = (F.col("observation").isNotNull() != F.col("observation_call_id").isNotNull()) | (F.col("observation_call_id").isNotNull() & ~F.coalesce(good, F.lit(False)))
    return _found(d.where(bad), "observation_call", "scan_id")


def same_scans(scans: DataFrame, resolved: DataFrame) -> DataFrame:
    """Resolved scans that are not the book's scans in the book's order."""
    r = resolved.select("book_id", "scan_index", F.col("scan_id").alias("other"))
    return _found(scans.select("book_id", "scan_index", "scan_id").join(r, ["book_id", "scan_index"], "full_outer").where(~F.col("scan_id").eqNullSafe(F.col("other"))), "resolved_scans", "scan_index")


def structure_forest(nodes: DataFrame) -> DataFrame:
    """Parents that aren't earlier or not of an outer level, and ends before starts. nodes: book_id, pos, id, parent_id, level, start_index, end_index."""
    p = nodes.select("book_id", F.col("id").alias("parent_id"), F.col("pos").alias("p_pos"), F.col("level").alias("p_level"))
    d = nodes.join(p, ["book_id", "parent_id"], "left")
    bad = F.col("parent_id").isNotNull() & ~F.coalesce((F.col("p_pos") < F.col("pos")) & (F.col("p_level") < F.col("level")), F.lit(False))
    return _found(d.where(bad), "parent", "id").unionByName(_found(nodes.where("end_index < start_index"), "bounds", "id")).unionByName(unique(nodes, "structure_id", "id"))


def subpage_rules(scans: DataFrame) -> DataFrame:
    """Subpages on scans that aren't spreads, and sides that come twice."""
    sides = F.transform("subpages", lambda s: s["side"])
    bad = (F.size("subpages") > 0) & (~F.coalesce(F.col("side") == "both", F.lit(False)) | (F.size(F.array_distinct(sides)) != F.size(sides)))
    return _found(scans.where(bad), "subpages", "scan_index")


def page_number_rules(scans: DataFrame, computed: DataFrame) -> DataFrame:
    """Page numbers that are neither NULL nor the joined labels."""
    d = scans.select("book_id", "scan_index", "page_number").join(computed.select("book_id", "scan_index", F.col("page_number").alias("want")), ["book_id", "scan_index"], "left")
    return _found(d.where(F.col("page_number").isNotNull() & ~F.col("page_number").eqNullSafe(F.col("want"))), "page_number", "scan_index")


def totals_rules(stored: DataFrame, computed: DataFrame) -> DataFrame:
    """Stored totals that the calls don't add up to; costs may differ by 1e-9 of their size."""
    whole = ["calls", "failed_calls", "prompt_tokens", "completion_tokens", "cost_complete"]
    c = computed.select("book_id", *[F.col(x).alias(f"c_{x}") for x in [*whole, "cost_usd"]])
    d = stored.join(c, "book_id", "left")
    near = F.abs(F.col("cost_usd") - F.col("c_cost_usd")) <= 1e-9 * F.greatest(F.abs("cost_usd"), F.abs("c_cost_usd"))
    same = F.coalesce(near, F.col("cost_usd").isNull() & F.col("c_cost_usd").isNull())
    ok = reduce(lambda a, x: a & F.col(x).eqNullSafe(F.col(f"c_{x}")), whole, same)
    return _found(d.where(~ok), "totals", "calls")


def gold_rules(gold: DataFrame) -> DataFrame:
    """Labels whose value and alternatives don't go with their status. gold: book_id, field, status, value, alternatives."""
    n = F.coalesce(F.size("alternatives"), F.lit(0))
    bad = (
        ((F.col("status") == "verified") & F.col("value").isNull())
        | ((F.col("status") != "verified") & F.col("value").isNotNull())
        | ((F.col("status") != "ambiguous") & (n > 0))
        | ((F.col("status") == "ambiguous") & (n == 1))
        | ~F.col("status").isin("verified", "absent", "not_applicable", "ambiguous", "not_reviewed")
    )
    return _found(gold.where(bad), "gold_status", "field")


def gold_manifest(scans: DataFrame, books: DataFrame, starts: DataFrame) -> DataFrame:
    """Scan ids that come twice, places beyond the book, structure of an incomplete manifest, chapter starts on unknown scans."""
    d = scans.join(books, "book_id")
    beyond = _found(d.where("scan_index >= scan_count or scan_index < 0"), "gold_index", "scan_index")
    n = scans.groupBy("book_id").agg(F.count("*").alias("n"))
    part = books.join(n, "book_id").where("has_structure and n < scan_count")
    refs = known(starts.select("book_id", F.col("start_scan_id").alias("id")).where("id is not null"), scans.select("book_id", F.col("scan_id").alias("id")), "gold_start")
    return beyond.unionByName(unique(scans, "gold_scan_id", "scan_id")).unionByName(unique(scans, "gold_scan_index", "scan_index")).unionByName(_found(part, "gold_structure", "n")).unionByName(refs)


def extra_keys(raw: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """JSON objects with keys outside their schema, which a reader with a schema would drop without a word."""
    keys = F.array_except(F.json_object_keys(column), F.array(*[F.lit(k) for k in allowed]))
    return _found(raw.withColumn("_extra", keys).where(F.size("_extra") > 0), "unknown_key", F.array_join("_extra", ","))


def require_none(violations: DataFrame) -> None:
    """Raises with the first violations; the check reads five rows."""
    bad = violations.limit(5).collect()
    if bad:
        raise ValueError("; ".join(f"{r['rule']} in {r['book_id']}: {r['detail']}" for r in bad))
