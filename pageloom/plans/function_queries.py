"""Queries over the scalar functions."""

from pyspark.sql import functions as F

from pageloom.functions import text as T
from pageloom.plans.catalog import query, table

_ROMAN = "repeat('M', CAST(n // 1000 AS INTEGER)) || list_extract(['','C','CC','CCC','CD','D','DC','DCC','DCCC','CM'], (n // 100) % 10 + 1) || list_extract(['','X','XX','XXX','XL','L','LX','LXX','LXXX','XC'], (n // 10) % 10 + 1) || list_extract(['','I','II','III','IV','V','VI','VII','VIII','IX'], n % 10 + 1)"
_LETTER = """CASE WHEN i < 26 THEN chr(CAST(97 + i AS INTEGER))
  WHEN i < 702 THEN chr(CAST(97 + i // 26 - 1 AS INTEGER)) || chr(CAST(97 + i % 26 AS INTEGER))
  ELSE chr(CAST(97 + ((i // 26 - 1) // 26 - 1) AS INTEGER)) || chr(CAST(97 + (i // 26 - 1) % 26 AS INTEGER)) || chr(CAST(97 + i % 26 AS INTEGER)) END"""


@query(f"SELECT doc_id, n, {_ROMAN} AS roman FROM (SELECT doc_id, doc_id % 3999 + 1 AS n FROM documents)")
def q_to_roman(spark, sf_dir):
    n = F.col("doc_id") % 3999 + 1
    return table(spark, sf_dir, "documents").select("doc_id", n.alias("n"), T.to_roman(n).alias("roman"))


@query(f"SELECT doc_id, lower({_ROMAN}) AS roman, CASE WHEN doc_id % 7 = 3 THEN NULL ELSE n END AS value FROM (SELECT doc_id, doc_id % 3999 + 1 AS n FROM documents)")
def q_roman_value(spark, sf_dir):
    """Values of numerals; every seventh one is spoilt by a repeated letter and has none."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.lower(T.to_roman(F.col("doc_id") % 3999 + 1)).alias("roman"))
    spoilt = F.when(F.col("doc_id") % 7 == 3, F.concat(F.lit("iiii"), "roman")).otherwise(F.col("roman"))
    return d.select("doc_id", "roman", T.roman_value(spoilt).alias("value"))


@query(f"SELECT doc_id, {_LETTER} AS letters FROM (SELECT doc_id, doc_id % 18278 AS i FROM documents)")
def q_letters(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.letter(F.col("doc_id") % 18278 + 1).alias("letters"))


@query("""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN CAST(doc_id AS VARCHAR) WHEN 1 THEN CAST(doc_id AS VARCHAR) WHEN 2 THEN 'XIV' ELSE 'p. ' || doc_id || 'a' END AS number FROM documents""")
def q_normalize_number(spark, sf_dir):
    i = F.col("doc_id").cast("string")
    raw = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("[00"), i, F.lit("]"))).when(F.col("doc_id") % 4 == 1, F.concat(F.lit("— "), i, F.lit(" —"))).when(F.col("doc_id") % 4 == 2, F.lit("(xiv.)")).otherwise(F.concat(F.lit("P. "), i, F.lit("A")))
    return table(spark, sf_dir, "documents").select("doc_id", T.normalize_number(raw).alias("number"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '[' || doc_id || '],' || (doc_id + 1) ELSE doc_id || ',[' || (doc_id + 1) || ']' END AS label FROM documents")
def q_library_label(spark, sf_dir):
    i, j = F.col("doc_id").cast("string"), (F.col("doc_id") + 1).cast("string")
    raw = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("("), i, F.lit("), "), j)).otherwise(F.concat(i, F.lit(", ("), j, F.lit(")")))
    return table(spark, sf_dir, "documents").select("doc_id", T.library_label(raw).alias("label"))


@query("""SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'arabic' WHEN 1 THEN 'roman' END AS system,
 CASE doc_id % 3 WHEN 0 THEN doc_id WHEN 1 THEN 12 END AS value FROM documents""")
def q_parse_reference(spark, sf_dir):
    i = F.col("doc_id").cast("string")
    ref = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("["), i, F.lit("]-17"))).when(F.col("doc_id") % 3 == 1, F.lit("(xii)")).otherwise(F.lit("see Šumavě 5"))
    return table(spark, sf_dir, "documents").select("doc_id", T.parse_reference(ref).alias("p")).select("doc_id", "p.system", "p.value")


_NORM_SQL = r"""regexp_replace(regexp_replace(array_to_string(list_transform(string_split(regexp_replace(text, '\r\n|\r|\f', chr(10), 'g'), chr(10)), lambda x: rtrim(x, ' ' || chr(9) || chr(11) || chr(160))), chr(10)), '\n{3,}', chr(10) || chr(10), 'g'), '^\n+|\n+$', '', 'g')"""


@query(f"SELECT doc_id, sha256({_NORM_SQL}) AS sha FROM documents")
def q_ocr_normalize_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(T.normalize_lines(F.col("text")), 256).alias("sha"))


_BOUND = r"""
WITH t AS (SELECT doc_id, text, length(text) AS n, 600 - (43 + length(CAST(length(text) AS VARCHAR))) AS b FROM documents),
p AS (SELECT *, substr(text, 1, CAST(b * 2 // 3 AS INTEGER)) AS h0, right(text, CAST(b // 3 AS INTEGER)) AS t0 FROM t),
c AS (SELECT *, CASE WHEN contains(h0, chr(10)) THEN regexp_replace(h0, '\n[^\n]*$', '') ELSE h0 END AS h,
             CASE WHEN contains(t0, chr(10)) THEN substr(t0, strpos(t0, chr(10)) + 1) ELSE t0 END AS e FROM p)
SELECT doc_id, sha256(CASE WHEN n <= 600 THEN text ELSE h || chr(10) || '[... ' || (n - length(h) - length(e)) || ' characters of OCR text omitted ...]' || chr(10) || e END) AS sha FROM c"""


@query(_BOUND)
def q_ocr_bound_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(T.bound_text(F.col("text"), 600), 256).alias("sha"))


@query("SELECT doc_id, '\"' || CASE WHEN length(t) <= 80 THEN t ELSE left(t, 77) || '...' END || '\"' AS q FROM (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM documents)")
def q_quoted(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.quoted(F.col("text")).alias("q"))


@query("SELECT doc_id, '3-' || left(sha256(text), 8) AS version FROM documents")
def q_prompt_version(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.version(3, F.col("text")).alias("version"))


@query("""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'key <redacted-key> task-management image data:<redacted> tail ' || doc_id || ' <redacted-key>' ELSE repeat('long ', 40) || '...' END AS safe FROM documents""")
def q_safe_text(spark, sf_dir):
    i = F.col("doc_id").cast("string")
    secret = F.concat(F.lit("s3cret"), i)
    raw = F.concat(F.lit("key sk-abcdefgh"), i, F.lit(" task-management image data:image/png;base64,"), F.base64(F.encode(i, "UTF-8")), F.lit(" tail "), i, F.lit(" "), secret)
    text = F.when(F.col("doc_id") % 2 == 0, raw).otherwise(F.repeat(F.lit("long "), 50))
    return table(spark, sf_dir, "documents").select("doc_id", T.safe_text(text, 200, secret).alias("safe"))
