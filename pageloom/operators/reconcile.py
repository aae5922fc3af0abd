"""Checks that ground a model's proposal about a book in what was observed on its scans.

Tables carry the place of a row in its list (`pos`, from 0), and warnings and changes a sort key (stage, ord, sub), since the
order in which they are reported is part of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageloom.functions.text import collapse, comparison_key, covered, parse_reference, plain_words, word_match
from pageloom.operators.nesting import nested

#: Types of pages that belong to the text block, and leaves that contradict them.
BLOCK_TYPES = ["titlePage", "tableOfContents", "preface", "introduction", "normalPage", "impressum", "colophon", "imprimatur", "dedication", "errata", "appendix", "bibliography", "afterword", "conclusion", "index", "listOfIllustrations", "listOfMaps", "listOfTables"]
CONFLICTING = ["plate", "binding"]
SINGLE_VALUED = ["title", "subtitle", "part_name", "part_number", "edition", "publication_date"]
#: Lengths of the beginnings by which words meet, and how many sets of words that share a word one key holds.
KEY_LENGTHS, BLOCK = [*range(1, 65), *[2**k for k in range(7, 31)]], 4096


def _by(*keys: str):
    return Window.partitionBy(*keys)


def first_corrections(scans: DataFrame, corrections: DataFrame) -> DataFrame:
    """scans with type, side and leaf as the first correction of each observed scan sets them, and old values.

    scans: book_id, scan_index, scan_id, observed, page_type, side, leaf, subpages. corrections: book_id, pos, scan (from
    1), page_type, side and leaf ("keep" and "none" have their meaning), reason.
    """
    rank = F.row_number().over(_by("book_id", "scan").orderBy("pos"))
    c = corrections.withColumn("_rank", rank).where("_rank = 1").select("book_id", (F.col("scan") - 1).alias("scan_index"), F.col("pos").alias("c_pos"), F.col("page_type").alias("c_type"), F.col("side").alias("c_side"), F.col("leaf").alias("c_leaf"), "reason")
    d = scans.join(c, ["book_id", "scan_index"], "left")
    on = F.col("observed") & F.col("c_pos").isNotNull()
    word = lambda c: F.when(F.col(c) != "none", F.col(c))
    new_type = F.when(on & F.col("c_type").isNotNull(), F.col("c_type")).otherwise(F.col("page_type"))
    new_side = F.when(on & (F.col("c_side") != "keep"), word("c_side")).otherwise(F.col("side"))
    leaf_set = on & (F.col("c_leaf") != "keep") & ~word("c_leaf").eqNullSafe(F.col("leaf"))
    new_leaf = F.when(leaf_set, word("c_leaf")).otherwise(F.col("leaf"))
    side_set = on & (F.col("c_side") != "keep") & ~new_side.eqNullSafe(F.col("side"))
    subs = F.when(side_set & ~F.coalesce(new_side == "both", F.lit(False)), F.array().cast(scans.schema["subpages"].dataType)).otherwise(F.col("subpages"))
    subs = F.when(leaf_set, F.transform(subs, lambda s: s.withField("leaf", new_leaf))).otherwise(subs)
    return d.select("book_id", "scan_index", "scan_id", "observed", F.col("page_type").alias("old_type"), F.col("side").alias("old_side"), F.col("leaf").alias("old_leaf"), "c_pos", "reason", new_type.alias("page_type"), new_side.alias("side"), new_leaf.alias("leaf"), subs.alias("subpages"))


def correction_changes(corrected: DataFrame) -> DataFrame:
    """One row for each field that a correction changed: field_path, old_value, new_value, reason."""
    three = F.array(*[F.struct(F.lit(k).alias("sub"), F.lit(n).alias("name"), F.col(o).alias("old"), F.col(f).alias("new")) for k, (n, o, f) in enumerate([("page_type", "old_type", "page_type"), ("side", "old_side", "side"), ("leaf", "old_leaf", "leaf")])])
    d = corrected.where("c_pos is not null and observed").select("book_id", "scan_index", "scan_id", "c_pos", "reason", F.explode(three).alias("x")).where(~F.col("x.old").eqNullSafe(F.col("x.new")))
    path = F.concat(F.lit("resolved.scans["), F.col("scan_index").cast("string"), F.lit("]."), F.col("x.name"))
    return d.select("book_id", F.lit(0).alias("stage"), F.col("c_pos").alias("ord"), F.col("x.sub").alias("sub"), path.alias("field_path"), F.col("x.old").alias("old_value"), F.col("x.new").alias("new_value"), "reason", F.array("scan_id").alias("scan_ids"))


def correction_warnings(scans: DataFrame, corrections: DataFrame, sizes: DataFrame) -> DataFrame:
    """Corrections of scans outside the book, and first ones of scans without an observation. sizes: book_id, n."""
    c = corrections.join(sizes, "book_id")
    beyond = c.where("scan < 1 or scan > n").select("book_id", F.lit(0).alias("stage"), F.col("pos").alias("ord"), F.lit("invalid_scan_reference").alias("code"), F.concat(F.lit("scan position "), F.col("scan").cast("string"), F.lit(" outside 1-"), F.col("n").cast("string")).alias("message"), F.array().cast("array<string>").alias("scan_ids"))
    first = c.withColumn("_r", F.row_number().over(_by("book_id", "scan").orderBy("pos"))).where("_r = 1").withColumn("scan_index", F.col("scan") - 1)
    blind = first.join(scans.where("not observed").select("book_id", "scan_index", "scan_id"), ["book_id", "scan_index"])
    return beyond.unionByName(blind.select("book_id", F.lit(0).alias("stage"), F.col("pos").alias("ord"), F.lit("correction_of_unobserved_scan").alias("code"), F.concat(F.lit("scan "), F.col("scan").cast("string"), F.lit(" was not observed")).alias("message"), F.array("scan_id").alias("scan_ids")))


def settle_leaves(scans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Scans whose pages each have their own leaf, without leaves that contradict the page type; and the conflicts found.

    On spreads a page without its own leaf takes the scan's, and pages are made where there are none.
    """
    both = F.coalesce(F.col("side") == "both", F.lit(False))
    kind = scans.schema["subpages"].dataType.elementType

    def page(side: str) -> Column:
        own = F.get(F.filter("subpages", lambda s: s["side"] == side), F.lit(0))
        made = F.struct(*[F.lit(side).cast(f.dataType).alias(f.name) if f.name == "side" else F.lit(None).cast(f.dataType).alias(f.name) for f in kind.fields])
        return F.when(own.isNotNull(), own.withField("leaf", F.coalesce(own["leaf"], F.col("leaf")))).when(F.col("leaf").isNotNull(), made.withField("leaf", F.col("leaf")))

    d = scans.withColumn("subpages", F.when(both, F.array_compact(F.array(page("left"), page("right")))).otherwise(F.col("subpages")))
    wrong = lambda leaf, kind: F.coalesce(leaf.isin(CONFLICTING) & kind.isin(BLOCK_TYPES), F.lit(False))
    sub_wrong = lambda s: wrong(s["leaf"], F.coalesce(s["page_type"], F.col("page_type")))
    pages = F.when(both, F.transform("subpages", lambda s, j: F.struct(j.alias("j"), s["leaf"].alias("leaf"), F.coalesce(s["page_type"], F.col("page_type")).alias("kind"), sub_wrong(s).alias("bad")))).otherwise(
        F.array(F.struct(F.lit(-1).alias("j"), F.col("leaf").alias("leaf"), F.col("page_type").alias("kind"), wrong(F.col("leaf"), F.col("page_type")).alias("bad")))
    )
    bad = d.select("book_id", "scan_index", "scan_id", F.explode(pages).alias("p")).where("p.bad")
    path = F.concat(F.lit("resolved.scans["), F.col("scan_index").cast("string"), F.lit("]"), F.when(F.col("p.j") >= 0, F.concat(F.lit(".subpages["), F.col("p.j").cast("string"), F.lit("]"))).otherwise(""), F.lit(".leaf"))
    conflicts = bad.select("book_id", F.lit(1).alias("stage"), F.col("scan_index").alias("ord"), F.col("p.j").alias("sub"), F.lit("leaf_type_conflict").alias("code"), path.alias("field_path"), F.col("p.leaf").alias("old_value"), F.col("p.kind").alias("page_type"), F.array("scan_id").alias("scan_ids"))
    none = F.lit(None).cast("string")
    clean = d.withColumns({
        "subpages": F.when(both, F.transform("subpages", lambda s: s.withField("leaf", F.when(~sub_wrong(s), s["leaf"]).otherwise(none)))).otherwise(F.col("subpages")),
        "leaf": F.when(~both & wrong(F.col("leaf"), F.col("page_type")), none).otherwise(F.col("leaf")),
    })
    return clean, conflicts


def _stem_length(word: Column) -> Column:
    """So many letters must another word share that is at least as long as this one, if they are to match."""
    n = F.length(word)
    return F.when(n <= 2, n).otherwise(F.greatest(F.lit(3), n - 2))


def _stem(word: Column) -> Column:
    """The longest key of a word within its stem: keys have any length up to 64 letters, then powers of two."""
    n = _stem_length(word)
    return F.left(word, F.when(n <= KEY_LENGTHS[63], n).otherwise(F.array_max(F.filter(_key_lengths(), lambda x: x <= n))))


def _key_lengths() -> Column:
    return F.array(*[F.lit(x) for x in KEY_LENGTHS])


def _word_pairs(short: DataFrame, s: str, long: DataFrame, w: str) -> DataFrame:
    """Words of both tables (book_id, field, word) in which the first, not longer than the second, may begin it."""
    a = short.withColumn("stem", _stem(F.col(s)))
    # the second is met by those of its beginnings that have the length of a stem: a few numbers, whatever the rows
    lengths = a.agg(F.collect_set(F.length("stem")).alias("lengths"))
    b = long.crossJoin(F.broadcast(lengths)).withColumn("stem", F.explode(F.transform(F.filter("lengths", lambda n: n <= F.length(_stem(F.col(w)))), lambda n: F.left(F.col(w), n)))).drop("lengths")
    return a.join(b, ["book_id", "field", "stem"]).drop("stem")


def covering(wanted: DataFrame, seen: DataFrame) -> DataFrame:
    """book_id, field, words, o_words: the sets of words of a field, and those seen in it that cover them.

    wanted: book_id, field, words; seen: book_id, field, o_words, both distinct. Words that match are found by equal
    stems, once for all sets that have them. A set then meets only those that match its rarest word, of which blocks go
    to different tasks; whether they cover all its words is decided on them.
    """
    w = wanted.select("book_id", "field", F.explode("words").alias("w")).distinct()
    postings = seen.select("book_id", "field", "o_words", F.explode("o_words").alias("v"))
    v = postings.groupBy("book_id", "field", "v").agg(F.count("*").alias("n"))
    nearer = _word_pairs(w, "w", v, "v").where(F.length("w") <= F.length("v")).select("book_id", "field", "w", "v", "n")
    farther = _word_pairs(v, "v", w, "w").where(F.length("v") < F.length("w")).select("book_id", "field", "w", "v", "n")
    match = nearer.unionByName(farther).where(word_match(F.col("w"), F.col("v")))
    met = match.groupBy("book_id", "field", "w").agg(F.sum("n").alias("met"))
    each = wanted.select("book_id", "field", "words", F.explode("words").alias("w")).join(met, ["book_id", "field", "w"])
    rarest = each.groupBy("book_id", "field", "words").agg(F.count("*").alias("matched"), F.min(F.struct("met", "w"))["w"].alias("w")).where(F.col("matched") == F.size("words"))
    blocks = F.ceil(F.col("n") / BLOCK)
    ask = rarest.join(match, ["book_id", "field", "w"]).select("book_id", "field", "words", "v", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)).alias("block"))
    held = postings.join(v, ["book_id", "field", "v"]).select("book_id", "field", "v", "o_words", F.pmod(F.xxhash64("o_words"), blocks).alias("block"))
    return ask.join(held, ["book_id", "field", "v", "block"]).where(covered(F.col("words"), F.col("o_words"))).select("book_id", "field", "words", "o_words").distinct()


def ground_values(observed: DataFrame, proposed: DataFrame) -> DataFrame:
    """Each proposed bibliographic value with the scans that show it (and their number), how (exact, similar, covered), and its fate.

    observed: book_id, scan_index, ord, scan_id, field, value. proposed: book_id, pos, field, value, notes. Exact: the same
    text in the same field. Similar: the same comparison form in any field. Covered: all its words, up to initials and
    endings, in one candidate of the field. Each different text, form and set of words is looked up once, however many
    rows have it, and its scans are listed once; rows without use for the list take their number alone.
    """
    word_set = lambda c: F.array_sort(F.array_distinct(plain_words(F.col(c))))
    scan = F.struct("scan_index", "ord", "scan_id")
    # nothing equals an unknown book or value; with the same filter everywhere the branches share their exchanges
    known = F.col("book_id").isNotNull() & F.col("value").isNotNull()
    o = observed.where(known).groupBy("book_id", "field", "value").agg(F.collect_list(scan).alias("at"))
    p = proposed.where(known).select("book_id", "field", "value").distinct()
    listed = F.flatten(F.collect_list("at"))
    exact = o.groupBy("book_id", "field", collapse(F.col("value")).alias("text")).agg(F.count("*").alias("n_1"), listed.alias("at_1"))
    similar = o.groupBy("book_id", comparison_key(F.col("value")).alias("key")).agg(F.count("*").alias("n_2"), listed.alias("at_2"))
    by_words = o.withColumn("o_words", word_set("value")).groupBy("book_id", "field", "o_words").agg(listed.alias("at"))
    forms = p.withColumns({"text": collapse(F.col("value")), "key": comparison_key(F.col("value")), "words": word_set("value")})
    some = lambda c: F.size(c) > 0
    pairs = covering(forms.where(some("words")).select("book_id", "field", "words").distinct(), by_words.where(some("o_words")).select("book_id", "field", "o_words"))
    near = pairs.join(by_words, ["book_id", "field", "o_words"]).groupBy("book_id", "field", "words").agg(F.count("*").alias("n_3"), listed.alias("at_3"))
    forms = forms.join(exact, ["book_id", "field", "text"], "left").join(similar, ["book_id", "key"], "left").join(near, ["book_id", "field", "words"], "left")
    way = F.when(F.col("n_1") > 0, 1).when(F.col("n_2") > 0, 2).when(F.col("n_3") > 0, 3)
    scans = lambda c: F.coalesce(F.transform(F.array_sort(c), lambda x: x["scan_id"]), F.array().cast("array<string>"))
    sources = F.when(way.isNotNull(), F.array_distinct(F.concat(scans("at_1"), scans("at_2"), scans("at_3"))))
    forms = forms.select(F.col("book_id").alias("f_book"), F.col("field").alias("f_field"), F.col("value").alias("f_value"), "key", way.alias("way"), sources.alias("sources"), F.size(sources).alias("n_sources"))
    d = proposed.join(forms, proposed["book_id"].eqNullSafe(forms["f_book"]) & proposed["field"].eqNullSafe(forms["f_field"]) & proposed["value"].eqNullSafe(forms["f_value"]), "left")
    grounded = F.col("way").isNotNull()
    nth_field = F.row_number().over(_by("book_id", "field", "_g").orderBy("pos"))
    nth_key = F.row_number().over(_by("book_id", "field", "_g", "key").orderBy("pos"))
    d = d.withColumn("_g", grounded).withColumns({"_f": nth_field, "_k": nth_key})
    single = F.col("field").isin(SINGLE_VALUED)
    fate = F.when(~grounded, "ungrounded_value").when(single & (F.col("_f") > 1), "competing_values").when(~single & (F.col("_k") > 1), "repeated").otherwise("kept")
    place = F.sum(F.when(F.col("fate") == "kept", 1).otherwise(0)).over(_by("book_id", "field").orderBy("pos")) - 1
    d = d.withColumn("fate", fate).withColumn("place", F.when((F.col("fate") == "kept") & ~single, place))
    origin = F.when(F.col("fate") == "kept", F.when(F.col("way") == 1, "observed").otherwise("inferred"))
    return d.select("book_id", "pos", "field", "value", "notes", "fate", origin.alias("origin"), "place", "sources", "n_sources")


def bibliography_changes(grounded: DataFrame, observed: DataFrame) -> DataFrame:
    """Kept values that weren't observed in this form: old_value holds the distinct observed ones of the field, as they were seen."""
    seen = observed.groupBy("book_id", "field", "value").agg(F.min(F.struct("scan_index", "ord")).alias("at"))
    old = seen.groupBy("book_id", "field").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]).alias("old_value"))
    path = F.concat(F.lit("resolved.bibliography."), F.col("field"), F.when(F.col("place").isNotNull(), F.concat(F.lit("["), F.col("place").cast("string"), F.lit("]"))).otherwise(""))
    d = grounded.where("origin = 'inferred'").join(old, ["book_id", "field"], "left")
    return d.select("book_id", F.lit(3).alias("stage"), F.col("pos").alias("ord"), path.alias("field_path"), "old_value", F.col("value").alias("new_value"), F.coalesce("notes", F.concat(F.lit("not observed in this form as "), F.col("field"))).alias("reason"), F.col("sources").alias("scan_ids"))


def reference_positions(refs: DataFrame, scans: DataFrame, sizes: DataFrame) -> DataFrame:
    """refs (book_id, pos, positions from 1) with scan_ids, distinct in their order, and the positions outside the book."""
    e = refs.select("book_id", "pos", F.posexplode("positions").alias("ord", "p")).join(sizes, "book_id").join(scans.select("book_id", (F.col("scan_index") + 1).alias("p"), "scan_id"), ["book_id", "p"], "left")
    inside = F.array_distinct(F.transform(F.filter(F.sort_array(F.collect_list(F.struct("ord", "scan_id"))), lambda x: x["scan_id"].isNotNull()), lambda x: x["scan_id"]))
    outside = F.transform(F.sort_array(F.collect_list(F.when((F.col("p") < 1) | (F.col("p") > F.col("n")), F.struct("ord", "p")))), lambda x: x["p"])
    return refs.join(e.groupBy("book_id", "pos").agg(inside.alias("scan_ids"), outside.alias("outside")), ["book_id", "pos"], "left")


def ground_chapters(chapters: DataFrame, toc: DataFrame, headings: DataFrame) -> DataFrame:
    """Chapters with the scans that support them, their page reference if it is printed, and the warnings on them.

    chapters: book_id, pos, title, level, toc_ids, heading_ids, ref. toc: book_id, scan_id, title, ref. headings: book_id,
    scan_id, text. Cited scans are exploded and joined by id; only then do words decide whether a text belongs to the title.
    """
    c = chapters.withColumn("words", plain_words(F.col("title")))
    fits = lambda: covered(F.col("words"), F.col("t_words")) | covered(F.col("t_words"), F.col("words"))
    t = toc.select("book_id", "scan_id", F.col("title").alias("t_text"), F.col("ref").alias("t_ref"), plain_words(F.col("title")).alias("t_words"))
    h = headings.select("book_id", "scan_id", F.col("text").alias("t_text"), F.lit(None).cast("string").alias("t_ref"), plain_words(F.col("text")).alias("t_words"))
    cited = lambda ids: c.select("book_id", "pos", "words", F.col("title").alias("c_title"), F.col("ref").alias("c_ref"), F.explode(ids).alias("scan_id"))
    met = cited("toc_ids").join(t, ["book_id", "scan_id"]).where(fits()).withColumn("toc", F.lit(True)).unionByName(cited("heading_ids").join(h, ["book_id", "scan_id"]).where(fits()).withColumn("toc", F.lit(False)))
    same = collapse(F.col("t_text")) == collapse(F.col("c_title"))
    g = met.groupBy("book_id", "pos").agg(
        F.bool_or("toc").alias("in_toc"), F.bool_or(~F.col("toc")).alias("in_heading"), F.coalesce(F.bool_or(F.col("toc") & (collapse(F.col("t_ref")) == collapse(F.col("c_ref")))), F.lit(False)).alias("ref_printed"),
        F.bool_or(same).alias("title_observed"), F.flatten(F.collect_list("t_words")).alias("seen"),
    )
    d = c.join(g, ["book_id", "pos"], "left")
    yes = lambda x: F.coalesce(F.col(x), F.lit(False))
    none = F.array().cast("array<string>")
    toc_ok, head_ok = F.when(yes("in_toc"), F.col("toc_ids")).otherwise(none), F.when(yes("in_heading"), F.col("heading_ids")).otherwise(none)
    alone, bare = (F.size(toc_ok) == 0) & (F.size(head_ok) == 0), ~F.coalesce(covered(F.col("words"), F.col("seen")), F.lit(False))
    codes = F.array_compact(F.array(
        F.when((F.size("toc_ids") > 0) & ~yes("in_toc"), "unmatched_toc_entry"), F.when((F.size("heading_ids") > 0) & ~yes("in_heading"), "unmatched_heading"),
        F.when(F.col("ref").isNotNull() & ~yes("ref_printed"), "ungrounded_reference"), F.when(alone, "ungrounded_chapter").when(bare, "ungrounded_title"),
    ))
    kept = ~alone & ~bare
    d = d.select("book_id", "pos", "title", "level", toc_ok.alias("toc_ids"), head_ok.alias("heading_ids"), F.when(yes("ref_printed"), F.col("ref")).alias("ref"), kept.alias("kept"), F.when(kept & yes("title_observed"), "observed").when(kept, "inferred").alias("origin"), codes.alias("codes"))
    # dropped chapters don't move the place of those that follow
    place = F.coalesce(F.sum(F.col("kept").cast("int")).over(_by("book_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return d.withColumns({"node": place.cast("int"), "id": F.concat(F.lit("ch"), (F.col("pos") + 1).cast("string"))})


def resolve_references(chapters: DataFrame, page_index: DataFrame) -> DataFrame:
    """chapters (book_id, pos, ref, heading_ids) with candidates, start and the warning of the resolution.

    page_index: book_id, scan_index, scan_id, numeral_system, numeric_value, one row a label. A reference is looked up by
    system and value: one scan is the target, several are ambiguous, none is unresolved unless a heading tells the start.
    """
    i = page_index.where("numeral_system is not null and numeric_value is not null").groupBy("book_id", F.col("numeral_system").alias("r_system"), F.col("numeric_value").cast("bigint").alias("r_value"))
    i = i.agg(F.array_distinct(F.transform(F.sort_array(F.collect_list(F.struct("scan_index", "scan_id"))), lambda x: x["scan_id"])).alias("candidates"))
    parsed = parse_reference(F.col("ref"))
    d = chapters.withColumns({"r_system": parsed["system"], "r_value": parsed["value"]}).join(i, ["book_id", "r_system", "r_value"], "left").drop("r_system", "r_value")
    n = F.when(F.col("ref").isNotNull(), F.coalesce(F.size("candidates"), F.lit(0)))
    target = F.when(n == 1, F.get("candidates", F.lit(0)))
    heading = F.get("heading_ids", F.lit(0))
    code = F.when(n > 1, "ambiguous_toc_reference").when((n == 0) & heading.isNull(), "unresolved_toc_reference").when(heading.isNotNull() & target.isNotNull() & (heading != target), "toc_heading_mismatch")
    return d.withColumns({"target": target, "start": F.coalesce(heading, target), "reference_warning": code})


def chapter_parents(nodes: DataFrame) -> DataFrame:
    """nodes (book_id, pos, id, level) with parent_id: the nearest chapter before of an outer level."""
    return nested(nodes, "book_id", ["pos"], "level").select("me.*", F.col("parent.id").alias("parent_id"))


def chapter_bounds(nodes: DataFrame) -> DataFrame:
    """nodes (book_id, pos, id, level, key, start_index) with end_index and the warnings duplicate_of and out_of_order.

    A chapter ends before the next one of the same or an outer level starts, on that scan if it is a spread (`spread_starts`
    tells for the node's own start) or its own start; unknown if that start is unknown or earlier.
    """
    by = _by("book_id").orderBy("pos")
    d = nested(nodes, "book_id", ["pos"], "level").select("me.*", F.col("closer.start_index").alias("_end"), F.col("closer.start_spread").alias("_spread"))
    end, start = F.col("_end"), F.col("start_index")
    bound = F.when(start.isNotNull() & end.isNotNull() & (end >= start), F.when((end > start) & ~F.coalesce("_spread", F.lit(False)), end - 1).otherwise(end))
    started = start.isNotNull()
    twin = F.lag("id").over(_by("book_id", "key", "start_index").orderBy("pos"))
    last = F.last(F.when(started, start), ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1))
    return d.withColumns({"end_index": bound, "duplicate_of": F.when(started, twin), "out_of_order": started & F.coalesce(start < last, F.lit(False))}).drop("_end", "_spread")


def competing_observed(observed: DataFrame, fold: bool = True) -> DataFrame:
    """Single-valued fields observed in several comparison forms: book_id, field, forms, scans."""
    d = observed.where(F.col("field").isin(SINGLE_VALUED)).groupBy("book_id", "field").agg(F.count_distinct(comparison_key(F.col("value"), fold)).alias("forms"), F.array_sort(F.collect_set("scan_index")).alias("scans"))
    return d.where("forms > 1")


def emitted(*parts: DataFrame) -> DataFrame:
    """Warnings or changes of all stages in the order in which they are reported."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.orderBy("book_id", "stage", "ord", *[c for c in ["sub"] if c in out.columns])


def proposal_input(header: DataFrame, lines: DataFrame, most: int = 100_000) -> DataFrame:
    """book_id, text: the text that a model is asked about, from header lines and the lines of each scan.

    Both: book_id, ord, line. Nothing is shortened: the query fails where a text is longer than `most` characters.
    """
    d = header.withColumn("part", F.lit(0)).unionByName(lines.withColumn("part", F.lit(1)))
    text = d.groupBy("book_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "ord", "line"))), lambda x: x["line"]), "\n").alias("text"))
    over = F.raise_error(F.concat(F.lit(f"input over {most} characters: "), F.col("book_id").cast("string")))
    return text.withColumn("text", F.when(F.length("text") > most, over).otherwise(F.col("text")))
