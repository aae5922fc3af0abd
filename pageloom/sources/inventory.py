"""Sources of a book: the order of its scans, the files that match it, image sizes, OCR sidecars, resume state."""

from __future__ import annotations

import struct
import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pageloom.functions.text import bound_text, normalize_lines


class InputError(ValueError):
    """Bad input; the message names all problems found, up to a bound."""


def read_order(spark: SparkSession, path: str) -> DataFrame:
    """scan_index, name from a text file: one name a line, blank lines and a byte-order mark dropped; the order of lines is kept."""
    whole = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", "^﻿", "").alias("t"))
    names = whole.select(F.posexplode(F.filter(F.transform(F.split("t", r"\r\n|\r|\n"), lambda x: F.trim(x)), lambda x: x != "")).alias("scan_index", "name"))
    bad = order_problems(names).limit(20).collect()
    if bad or names.isEmpty():
        raise InputError("; ".join(r["problem"] for r in bad) or "no names in the order file")
    return names


def order_problems(names: DataFrame) -> DataFrame:
    twice = names.groupBy("name").count().where("count > 1").select(F.concat(F.lit("listed twice: "), "name").alias("problem"))
    paths = names.where(F.col("name").rlike(r"[/\\]")).select(F.concat(F.lit("a path, not a name: "), "name").alias("problem"))
    return twice.unionByName(paths)


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]*$", "")


def extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1))


def match_files(order: DataFrame, files: DataFrame, extensions: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(scan_index, name, filename), problems (name, n), unlisted files: each name has exactly one file with one of the extensions.

    files: filename. Extensions match in any case; files whose names begin with a dot don't count.
    """
    f = files.where(~F.col("filename").startswith(".")).where(extension(F.col("filename")).isin(extensions)).withColumn("name", stem(F.col("filename")))
    found = order.join(f.groupBy("name").agg(F.count("*").alias("n"), F.min("filename").alias("filename")), "name", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return found.where("n = 1").select("scan_index", "name", "filename"), found.where("n != 1").select("name", "n"), f.join(order, "name", "left_anti").select("filename")


def select_scans(scans: DataFrame, first: int | None = None, scan_ids: list[str] | None = None) -> DataFrame:
    """The first scans or named ones, as a predicate that reaches the listing before any file is decoded."""
    if first is not None:
        scans = scans.where(F.col("scan_index") < first)
    return scans.where(F.col("scan_id").isin(scan_ids)) if scan_ids is not None else scans


def image_info(data: bytes) -> tuple[int | None, int | None, str | None]:
    """Width and height as displayed, from the headers of PNG and JPEG files; an error for other or broken files.

    Decoding pixels needs an image library, which is optional; headers are enough for the inventory.
    """
    if data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 24:
        return (*struct.unpack(">II", data[16:24]), None)
    if data[:2] != b"\xff\xd8":
        return None, None, "not a PNG or JPEG image"
    at, turned = 2, False
    while at + 9 < len(data):
        if data[at] != 0xFF:
            return None, None, "broken JPEG"
        kind, size = data[at + 1], struct.unpack(">H", data[at + 2 : at + 4])[0]
        if kind == 0xE1 and data[at + 4 : at + 10] == b"Exif\0\0":
            turned = _orientation(data[at + 10 : at + 2 + size]) in (5, 6, 7, 8)
        if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            h, w = struct.unpack(">HH", data[at + 5 : at + 9])
            return (h, w, None) if turned else (w, h, None)
        at += 2 + size
    return None, None, "broken JPEG"


def _orientation(tiff: bytes) -> int:
    try:
        e = "<" if tiff[:2] == b"II" else ">"
        at = struct.unpack(e + "I", tiff[4:8])[0]
        for k in range(struct.unpack(e + "H", tiff[at : at + 2])[0]):
            tag, _, _, value = struct.unpack(e + "HHIH", tiff[at + 2 + 12 * k : at + 12 + 12 * k])
            if tag == 0x0112:
                return value
    except struct.error:
        pass
    return 1


def build_inventory(images: DataFrame) -> DataFrame:
    """images (scan_index, scan_id, filename, content) with sha256, width, height and error; the bytes go no further."""

    def run(frames):
        for f in frames:
            info = [image_info(bytes(c)) for c in f.content]
            yield f.drop(columns="content").assign(width=pd.array([i[0] for i in info], "Int32"), height=pd.array([i[1] for i in info], "Int32"), error=[i[2] for i in info])

    hashed = images.select("scan_index", "scan_id", "filename", F.sha2("content", 256).alias("image_sha256"), "content")
    return hashed.mapInPandas(run, "scan_index int, scan_id string, filename string, image_sha256 string, width int, height int, error string")


def alto_text(data: bytes) -> tuple[str | None, str | None]:
    """Text of an ALTO document of any namespace, or the error: lines of words, hyphens glued on, blank lines between blocks."""
    try:
        root = ET.fromstring(data)
    except ET.ParseError as exc:
        return None, f"malformed XML ({exc})"
    name = lambda e: e.tag.rpartition("}")[2] if isinstance(e.tag, str) else ""
    if name(root) != "alto":
        return None, f"not an ALTO document (root element <{name(root)}>)"

    def line(e) -> str:
        out = ""
        for x in e:
            content = x.get("CONTENT", "")
            if name(x) == "String" and content:
                out += (" " if out else "") + content
            elif name(x) == "HYP" and out:
                out += content
        return out

    of = lambda e, kind: [x for x in e.iter() if name(x) == kind]
    return "\n\n".join("\n".join(map(line, of(b, "TextLine"))) for b in of(root, "TextBlock")), None


@F.pandas_udf(StringType())
def _alto_json(content: pd.Series) -> pd.Series:
    import json

    return content.map(lambda c: json.dumps(dict(zip(("text", "error"), alto_text(bytes(c)), strict=True)), ensure_ascii=False), na_action="ignore")


def attach_ocr(scans: DataFrame, sidecars: DataFrame, most: int = 6000) -> DataFrame:
    """scans with ocr (status, filename, format, sha256, size_bytes, chars, sent_chars, truncated, error) and ocr_text.

    sidecars: filename, content. A scan takes the one .txt or .xml file of its name: none is missing, several are an
    error, as are bad bytes and XML that isn't ALTO. Texts are normalised and bounded.
    """
    f = sidecars.withColumns({"scan_id": stem(F.col("filename")), "ext": extension(F.col("filename"))}).where(F.col("ext").isin(".txt", ".xml", ".alto"))
    one = f.groupBy("scan_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("filename")).alias("names"), F.first("content").alias("content"), F.first("ext").alias("ext"))
    d = scans.join(one, "scan_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    alto = F.from_json(F.when((F.col("n") == 1) & (F.col("ext") != ".txt"), _alto_json("content")), "text string, error string")
    utf8 = F.expr("is_valid_utf8(cast(content as string))")
    plain = F.regexp_replace(F.col("content").cast("string"), "^﻿", "")
    raw = F.when(F.col("n") != 1, F.lit(None).cast("string")).when(F.col("ext") != ".txt", alto["text"]).when(utf8, plain)
    error = F.when(F.col("n") > 1, F.concat(F.lit("several OCR files match the scan: "), F.array_join("names", ", "))).when((F.col("n") == 1) & (F.col("ext") != ".txt"), alto["error"]).when((F.col("n") == 1) & ~utf8, "not valid UTF-8 text")
    d = d.withColumns({"_text": normalize_lines(raw), "_error": error}).withColumn("ocr_text", bound_text(F.col("_text"), most))
    single = F.col("n") == 1
    ok = single & F.col("_error").isNull()
    ocr = F.struct(
        F.when(F.col("n") == 0, "missing").when(F.col("_error").isNotNull(), "error").otherwise("ok").alias("status"), F.when(single, F.get("names", F.lit(0))).alias("filename"),
        F.when(single, F.when(F.col("ext") == ".txt", "txt").otherwise("alto")).alias("format"), F.when(single, F.sha2("content", 256)).alias("sha256"), F.when(single, F.octet_length("content").cast("bigint")).alias("size_bytes"),
        F.when(ok, F.length("_text")).alias("chars"), F.when(ok, F.length("ocr_text")).alias("sent_chars"), (ok & (F.col("_text") != F.col("ocr_text"))).alias("truncated"), F.col("_error").alias("error"),
    )
    return d.select(*scans.columns, ocr.alias("ocr"), "ocr_text")


def ocr_summary(scans: DataFrame, *keys: str) -> DataFrame:
    o, is_ = F.col("ocr"), lambda c, v: F.col(f"ocr.{c}") == v
    return scans.where(o.isNotNull()).groupBy(*keys).agg(
        F.count_if(is_("status", "ok") & is_("format", "txt")).alias("txt"), F.count_if(is_("status", "ok") & is_("format", "alto")).alias("alto"),
        F.count_if(is_("status", "missing")).alias("missing"), F.count_if(is_("status", "error")).alias("error"), F.count_if(F.coalesce("ocr.truncated", F.lit(False))).alias("truncated"),
    )


def ocr_problems(scans: DataFrame) -> DataFrame:
    file = F.when(F.col("ocr.filename").isNotNull(), F.concat(F.lit(" ("), F.col("ocr.filename"), F.lit(")"))).otherwise("")
    return scans.where("ocr.status = 'error'").select("scan_id", F.concat(F.lit("OCR of scan "), "scan_id", file, F.lit(" not used, image only: "), F.col("ocr.error")).alias("problem"))


def worklist(scans: DataFrame, done: DataFrame) -> DataFrame:
    """Scans without an observation yet."""
    return scans.join(done.select("book_id", "scan_id"), ["book_id", "scan_id"], "left_anti")


def identity_diff(stored: DataFrame, current: DataFrame) -> DataFrame:
    """key, stored, current for keys of a run's identity that differ, over the keys of both."""
    d = stored.select("key", F.col("value").alias("stored")).join(current.select("key", F.col("value").alias("current")), "key", "full_outer")
    return d.where(~F.col("stored").eqNullSafe(F.col("current")))


def changed_scans(done: DataFrame, selected: DataFrame, keys: list[str]) -> DataFrame:
    """Observed scans that the selection no longer holds or holds with other values of the keys: reasons to refuse a resume."""
    s = selected.select("book_id", "scan_index", *[F.col(k).alias(f"now_{k}") for k in keys], F.lit(True).alias("there"))
    d = done.join(s, ["book_id", "scan_index"], "left")
    parts = F.array_compact(F.array(*[F.when(~F.col(k).eqNullSafe(F.col(f"now_{k}")), k) for k in keys]))
    return d.select("book_id", "scan_index", F.when(F.col("there").isNull(), F.array(F.lit("not selected"))).otherwise(parts).alias("changed")).where(F.size("changed") > 0)


def gold_template(scans: DataFrame, fields: list[str]) -> DataFrame:
    """One label of status not_reviewed for each scan and field."""
    return scans.select("book_id", "scan_id", "scan_index", "image_sha256", F.explode(F.array(*[F.lit(f) for f in fields])).alias("field"), F.lit("not_reviewed").alias("status"))


def nearest_earlier(d: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """The last value before each row that isn't NULL."""
    return d.withColumn(f"last_{value}", F.last(value, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)))
