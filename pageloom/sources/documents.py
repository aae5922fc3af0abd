"""Predictions and gold labels from JSON files, in long form, and results as nested JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions.text import library_label, normalize_label
from pageloom.operators.scoring import acceptable

FIELDS = ["page_type", "side", "leaf", "printed_numbers", "page_number"]


class PredictionError(ValueError):
    """A file that is no prediction, or a broken one."""


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """path, sha, body (VARIANT) of whole JSON files; sha is that of the exact bytes."""
    d = spark.read.format("binaryFile").load(path)
    return d.select("path", F.sha2("content", 256).alias("sha"), F.try_parse_json(F.col("content").cast("string")).alias("body"))


def sniff(body: Column) -> Column:
    """The kind of a document by its keys: annotated, gold, elements, pages; NULL for others."""
    has = lambda key: F.try_variant_get(body, f"$.{key}", "variant").isNotNull()
    return F.when(has("gold_version"), "gold").when(has("schema_version") & has("scans"), "annotated").when(has("elements"), "elements").when(has("pages"), "pages")


_LABEL = "struct<status:string,value:{0},alternatives:array<{0}>>"
GOLD = "book_id string, scan_count int, scans array<struct<scan_id:string,scan_index:int,image_sha256:string," + ",".join(f"{f}:{_LABEL.format('array<string>' if f == 'printed_numbers' else 'string')}" for f in FIELDS) + ">>"


def gold_labels(d: DataFrame) -> DataFrame:
    """Labels of gold manifests in long form: book_id, scan_id, scan_index, sha, field, status, accept.

    A field that a scan doesn't name is not reviewed. Lists of printed numbers are one text with commas, page numbers have no spaces.
    accept holds the texts that count as right, with NULL for none; it is NULL where nothing can be scored.
    """
    s = d.select(F.from_json(F.to_json("body"), GOLD).alias("b")).select("b.book_id", F.explode("b.scans").alias("s"))

    def label(f: str) -> Column:
        form = (lambda v: F.when(F.size(v) > 0, F.array_join(v, ","))) if f == "printed_numbers" else normalize_label if f == "page_number" else (lambda v: v)
        x = F.col(f"s.{f}")
        status = F.coalesce(x["status"], F.lit("not_reviewed"))
        return F.struct(F.lit(f).alias("field"), status.alias("status"), acceptable(status, form(x["value"]), F.transform(x["alternatives"], form)).alias("accept"))

    long = s.select("book_id", F.col("s.scan_id").alias("scan_id"), F.col("s.scan_index").alias("scan_index"), F.col("s.image_sha256").alias("sha"), F.explode(F.array(*[label(f) for f in FIELDS])).alias("f"))
    return long.select("book_id", "scan_id", "scan_index", "sha", "f.*")


def from_annotated(d: DataFrame, schema: str, system: str) -> DataFrame:
    """Long predictions of the observed layer of annotated books, parsed by `schema`; printed numbers are ordered left, none, right."""
    b = d.select(F.from_json(F.to_json("body"), schema).alias("b")).select("b.book_id", F.explode("b.scans").alias("s"))
    o = F.col("s.observation")
    side = lambda n: F.when(n["side"] == "left", 0).when(n["side"].isNull(), 1).otherwise(2)
    numbers = F.transform(F.array_sort(F.transform(o["printed_numbers"], lambda n, i: F.struct(side(n).alias("k"), i.alias("i"), F.coalesce(n["normalized"], n["raw"]).alias("v")))), lambda x: x["v"])
    values = {"page_type": o["page_type"], "side": o["side"], "leaf": o["leaf"], "printed_numbers": F.when(F.size(numbers) > 0, F.array_join(numbers, ","))}
    long = F.array(*[F.struct(F.lit(k).alias("field"), v.cast("string").alias("value")) for k, v in values.items()])
    return b.select(F.lit(system).alias("system"), F.lit("observed").alias("layer"), "book_id", F.col("s.scan_id").alias("scan_id"), F.col("s.scan_index").alias("scan_index"), F.col("s.image_sha256").alias("sha"), F.explode(long).alias("x"), F.lit(False).alias("incomparable")).select("*", "x.*").drop("x")


_CLAIM = "struct<value:string>"
RESOLVED = (
    "book_id string, scans array<struct<scan_id:string,scan_index:int,image_sha256:string>>, "
    f"resolved struct<scans:array<struct<page_type:{_CLAIM},side:{_CLAIM},leaf:{_CLAIM},page_number:string>>,bibliography:map<string,string>,"
    f"structure:array<struct<title:{_CLAIM},level:int,start_scan_id:string,printed_page_reference:string>>>"
)


def from_resolved(d: DataFrame, system: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The resolved layer of annotated books: long predictions, bibliography (system, book_id, field, value: a list) and chapters in order.

    Resolved scans stand in the order of the book's scans. Books that are not resolved give no rows; a field of one value is a list
    of it, or an empty list.
    """
    b = d.select(F.from_json(F.to_json("body"), RESOLVED).alias("b")).select("b.book_id", "b.scans", "b.resolved").where("resolved is not null")
    pairs = b.select("book_id", F.explode(F.arrays_zip("scans", F.col("resolved.scans").alias("r"))).alias("x")).select("book_id", F.col("x.scans").alias("s"), F.col("x.r").alias("r"))
    values = {f: F.col(f"r.{f}.value") for f in ("page_type", "side", "leaf")} | {"page_number": normalize_label(F.col("r.page_number"))}
    long = F.array(*[F.struct(F.lit(k).alias("field"), v.alias("value")) for k, v in values.items()])
    out = pairs.select(F.lit(system).alias("system"), F.lit("resolved").alias("layer"), "book_id", "s.scan_id", "s.scan_index", F.col("s.image_sha256").alias("sha"), F.explode(long).alias("f"))
    out = out.select(*[c for c in out.columns if c != "f"], "f.field", "f.value", F.lit(False).alias("incomparable"))
    fields = b.select("book_id", F.explode("resolved.bibliography").alias("field", "raw"))
    several = F.transform(F.from_json("raw", f"array<{_CLAIM}>"), lambda x: x["value"])
    one = F.array_compact(F.array(F.from_json("raw", _CLAIM)["value"]))
    biblio = fields.select(F.lit(system).alias("system"), "book_id", "field", F.when(F.col("raw").startswith("["), several).otherwise(F.coalesce(one, F.array().cast("array<string>"))).alias("value"))
    nodes = b.select("book_id", F.posexplode("resolved.structure").alias("pos", "n"))
    chapters = nodes.select("book_id", "pos", F.col("n.title.value").alias("title"), "n.level", F.col("n.start_scan_id").alias("start"), F.col("n.printed_page_reference").alias("ref"))
    return out, biblio, chapters


def from_pages(d: DataFrame, system: str, page_types: list[str]) -> DataFrame:
    """Long predictions of catalogue page lists; page types outside the vocabulary are incomparable."""
    schema = "document struct<pid:string>, pages array<struct<scan_index:int,scan_id:string,page_number:string,page_type:string>>"
    p = d.select(F.from_json(F.to_json("body"), schema).alias("b")).select(F.col("b.document.pid").alias("book_id"), F.explode("b.pages").alias("p"))
    kind = vocabulary(F.col("p.page_type"), page_types)
    long = F.array(
        F.struct(F.lit("page_type").alias("field"), F.coalesce(kind, F.col("p.page_type")).alias("value"), (kind.isNull() & F.col("p.page_type").isNotNull()).alias("incomparable")),
        F.struct(F.lit("page_number").alias("field"), normalize_label(library_label(F.col("p.page_number"))).alias("value"), F.lit(False).alias("incomparable")),
    )
    return p.select(F.lit(system).alias("system"), F.lit("catalogue").alias("layer"), "book_id", F.col("p.scan_id").alias("scan_id"), F.col("p.scan_index").alias("scan_index"), F.lit(None).cast("string").alias("sha"), F.explode(long).alias("x")).select("*", "x.*").drop("x")


def from_elements(d: DataFrame, system: str, page_types: list[str]) -> tuple[DataFrame, DataFrame]:
    """Pages in long form and chapters (book_id, id, parent_id, title, start) of element lists; each value is a (value, confidence) pair."""
    e = d.select(F.try_variant_get("body", "$.batch_id", "string").alias("book_id"), F.try_variant_get("body", "$.page_to_image_mapping", "map<string,string>").alias("images"), F.explode(F.try_variant_get("body", "$.elements", "array<variant>")).alias("e"))
    get = lambda path, kind="string": F.try_variant_get("e", f"$.{path}", kind)
    pages = e.where(get("type") == "page").select("book_id", get("id").alias("id"), "images", get("pageIndex", "int").alias("page_index"), get("batch_index", "int").alias("batch_index"), get("pageType[0]").alias("page_type"), get("side[0]").alias("side"), get("pageNumber[0]").alias("page_number"))
    all_indexed = pages.groupBy("book_id").agg(F.bool_and(F.col("page_index").isNotNull()).alias("indexed"))
    pages = pages.join(all_indexed, "book_id")
    scan = F.coalesce(F.regexp_replace(F.regexp_extract(F.element_at("images", F.col("id")), r"([^/]*)$", 1), r"\.[^.]*$", ""), F.col("id"))
    kind = vocabulary(F.col("page_type"), page_types)
    side = F.when(F.lower("side").isin("left", "right"), F.lower("side")).when(F.lower("side").isin("both", "double"), "both")
    long = F.array(
        F.struct(F.lit("page_type").alias("field"), F.coalesce(kind, F.col("page_type")).alias("value"), (kind.isNull() & F.col("page_type").isNotNull()).alias("incomparable")),
        F.struct(F.lit("side").alias("field"), F.coalesce(side, F.col("side")).alias("value"), (side.isNull() & F.col("side").isNotNull()).alias("incomparable")),
        F.struct(F.lit("page_number").alias("field"), normalize_label(F.col("page_number")).alias("value"), F.lit(False).alias("incomparable")),
    )
    out = pages.select(F.lit(system).alias("system"), F.lit("observed").alias("layer"), "book_id", scan.alias("scan_id"), F.when(F.col("indexed"), F.col("page_index")).otherwise(F.col("batch_index")).alias("scan_index"), F.lit(None).cast("string").alias("sha"), F.explode(long).alias("x")).select("*", "x.*").drop("x")
    chapters = e.where(get("type") == "chapter").select("book_id", get("id").alias("id"), get("parent_id").alias("parent_id"), get("title[0]").alias("title"), get("pageIndexStart", "int").alias("start"))
    return out, chapters


def chapter_levels(chapters: DataFrame, most: int = 100) -> DataFrame:
    """chapters with level: the depth under parent_id, by a recursive query; raises on cycles and on depths beyond `most`."""
    spark = chapters.sparkSession
    chapters.createOrReplaceTempView("_chapters")
    out = spark.sql(f"""
        WITH RECURSIVE tree(book_id, id, level) MAX RECURSION LEVEL {most} AS (
          SELECT book_id, id, 1 FROM _chapters c WHERE parent_id IS NULL OR NOT EXISTS (SELECT 1 FROM _chapters p WHERE p.book_id = c.book_id AND p.id = c.parent_id)
          UNION ALL SELECT c.book_id, c.id, t.level + 1 FROM tree t JOIN _chapters c ON c.book_id = t.book_id AND c.parent_id = t.id)
        SELECT * FROM tree""")
    lost = chapters.join(out, ["book_id", "id"], "left_anti").limit(5).collect()
    if lost:
        raise PredictionError(f"chapters in a cycle: {[r['id'] for r in lost]}")
    return chapters.join(out, ["book_id", "id"])


def vocabulary(value: Column, allowed: list[str]) -> Column:
    """The allowed value that equals the text in any case, else NULL."""
    table = F.create_map(*[F.lit(x) for a in allowed for x in (a.lower(), a)])
    return F.element_at(table, F.lower(F.trim(value)))


def nest_book(books: DataFrame, scans: DataFrame, **lists: DataFrame) -> DataFrame:
    """book_id, json: books with their scans and other lists in order, one JSON document a book. Lists carry book_id and pos."""
    d = books.join(scans.groupBy("book_id").agg(F.sort_array(F.collect_list(F.struct("scan_index", *[c for c in scans.columns if c not in ("book_id", "scan_index")]))).alias("scans")), "book_id", "left")
    for name, rows in lists.items():
        inner = F.struct("pos", *[c for c in rows.columns if c not in ("book_id", "pos")])
        d = d.join(rows.groupBy("book_id").agg(F.sort_array(F.collect_list(inner)).alias(name)), "book_id", "left")
    return d.select("book_id", F.to_json(F.struct(*[c for c in d.columns])).alias("json"))


def write_json_lines(d: DataFrame, path: str) -> None:
    """Refuses to write over what is there; a failed job leaves no part of the result."""
    d.write.mode("errorifexists").json(path)
