"""Grounding, bounds, scoring, validation, sources and observation on small books."""

import json
import struct

import pytest
from pyspark.sql import functions as F

from pageloom.functions import text as T
from pageloom.operators import context, reconcile, scoring, usage, validate
from pageloom.sources import documents, inventory
from pageloom.streaming import observe


def test_text_functions(spark):
    d = spark.createDataFrame([("  Straße, Å ",), ("V Praze,",), (None,)], "x string")
    got = d.select(T.normalize_text("x").alias("n"), T.plain_words("x").alias("w"), T.comparison_key(F.col("x")).alias("k")).collect()
    assert got[0].n == "strasse, å" and got[1].w == ["v", "praze"] and got[1].k == "v praze" and got[2].n is None
    pairs = spark.createDataFrame([("praha", "praze", True), ("k", "karel", True), ("dum", "dam", False), ("na", "ne", False)], "a string, b string, want boolean")
    assert pairs.where(T.word_match(F.col("a"), F.col("b")) != F.col("want")).count() == 0
    n = spark.createDataFrame([("IIII", None), ("xiv", 14), ("MCMXCIX", 1999), ("", None), ("abc", None)], "x string, want int")
    assert n.where(~T.roman_value(F.col("x")).eqNullSafe(F.col("want"))).count() == 0


OBSERVED = [("b", 0, 0, "s0", "title", "CESTY PO ŠUMAVĚ"), ("b", 2, 0, "s2", "title", "Cesty po Šumavě"), ("b", 2, 1, "s2", "author", "Karel Klostermann"), ("b", 2, 2, "s2", "publication_place", "V Praze")]
PROPOSED = [("b", 0, "title", "Cesty po Šumavě", None), ("b", 1, "title", "CESTY PO ŠUMAVĚ", None), ("b", 2, "author", "K. Klostermann", None), ("b", 3, "publication_place", "Praha", "nominative"), ("b", 4, "publisher", "Otto", None), ("b", 5, "author", "k. klostermann", None), ("b", 6, "editor", "Karel Klostermann", None)]


def test_bibliography_is_grounded(spark):
    o = spark.createDataFrame(OBSERVED, "book_id string, scan_index int, ord int, scan_id string, field string, value string")
    p = spark.createDataFrame(PROPOSED, "book_id string, pos int, field string, value string, notes string")
    g = reconcile.ground_values(o, p).cache()
    got = {r.pos: (r.fate, r.origin, r.place, r.sources) for r in g.collect()}
    assert got[0] == ("kept", "observed", None, ["s2", "s0"])
    assert got[1][0] == "competing_values" and got[4][0] == "ungrounded_value" and got[5][0] == "repeated"
    assert got[2] == ("kept", "inferred", 0, ["s2"]) and got[3] == ("kept", "inferred", 0, ["s2"]) and got[6] == ("kept", "inferred", 0, ["s2"])
    c = {r.field_path: (r.old_value, r.reason) for r in reconcile.bibliography_changes(g, o).collect()}
    assert c == {"resolved.bibliography.author[0]": (["Karel Klostermann"], "not observed in this form as author"), "resolved.bibliography.publication_place[0]": (["V Praze"], "nominative"), "resolved.bibliography.editor[0]": (None, "not observed in this form as editor")}
    assert reconcile.competing_observed(o).count() == 0


def test_chapters_are_grounded(spark):
    ch = spark.createDataFrame([("b", 0, "Úvod", 1, ["s4"], ["s7"], "1"), ("b", 1, "Neznámá", 1, ["s4"], [], None), ("b", 2, "Na horách", 2, ["s4"], [], "9"), ("b", 3, "Domů", 1, [], ["s7"], None)], "book_id string, pos int, title string, level int, toc_ids array<string>, heading_ids array<string>, ref string")
    toc = spark.createDataFrame([("b", "s4", "Úvod", "1"), ("b", "s4", "Kapitola II. Na horách", "6")], "book_id string, scan_id string, title string, ref string")
    head = spark.createDataFrame([("b", "s7", "KAPITOLA I. Úvod")], "book_id string, scan_id string, text string")
    got = {r.pos: r for r in reconcile.ground_chapters(ch, toc, head).collect()}
    assert got[0].kept and got[0].origin == "observed" and got[0].ref == "1" and got[0].codes == []
    assert not got[1].kept and got[1].codes == ["unmatched_toc_entry", "ungrounded_chapter"]
    assert got[2].kept and got[2].codes == ["ungrounded_reference"] and got[2].ref is None and got[2].node == 1 and got[2].origin == "inferred"
    assert got[3].codes == ["unmatched_heading", "ungrounded_chapter"]


def test_leaves_and_corrections(spark):
    sub = "array<struct<side:string,page_type:string,leaf:string>>"
    scans = spark.createDataFrame([("b", 0, "s0", True, "frontEndSheet", None, "binding", []), ("b", 1, "s1", True, "normalPage", "both", "plate", [("left", "normalPage", None), ("right", "illustration", None)]), ("b", 2, "s2", False, None, None, None, [])], f"book_id string, scan_index int, scan_id string, observed boolean, page_type string, side string, leaf string, subpages {sub}")
    corr = spark.createDataFrame([("b", 0, 1, "titlePage", "keep", "keep", "r"), ("b", 1, 1, "blank", "left", "none", "late"), ("b", 2, 3, "blank", "keep", "keep", "r"), ("b", 3, 9, None, "keep", "keep", "r")], "book_id string, pos int, scan int, page_type string, side string, leaf string, reason string")
    fixed = reconcile.first_corrections(scans, corr)
    assert [(r.field_path, r.old_value, r.new_value) for r in reconcile.correction_changes(fixed).collect()] == [("resolved.scans[0].page_type", "frontEndSheet", "titlePage")]
    sizes = spark.createDataFrame([("b", 3)], "book_id string, n int")
    assert sorted((r.ord, r.code) for r in reconcile.correction_warnings(scans, corr, sizes).collect()) == [(2, "correction_of_unobserved_scan"), (3, "invalid_scan_reference")]
    clean, bad = reconcile.settle_leaves(fixed)
    assert sorted(r.field_path for r in bad.collect()) == ["resolved.scans[0].leaf", "resolved.scans[1].subpages[0].leaf"]
    rows = {r.scan_index: r for r in clean.collect()}
    assert rows[0].leaf is None and [s.leaf for s in rows[1].subpages] == [None, "plate"]


def test_positions(spark):
    scans = spark.createDataFrame([("b", i, f"s{i}") for i in range(3)], "book_id string, scan_index int, scan_id string")
    refs = spark.createDataFrame([("b", 0, [3, 1, 3, 7]), ("b", 1, [])], "book_id string, pos int, positions array<int>")
    got = {r.pos: r for r in reconcile.reference_positions(refs, scans, spark.createDataFrame([("b", 3)], "book_id string, n int")).collect()}
    assert got[0].scan_ids == ["s2", "s0"] and got[0].outside == [7] and got[1].scan_ids is None


def test_outcomes(spark):
    cases = [("verified", "1", [], True, None, None, True, False, "1", "correct"), ("verified", "1", [], True, None, None, True, False, None, "missing_value"), ("absent", None, [], True, None, None, True, False, "2", "spurious_value"), ("absent", None, [], True, None, None, True, False, None, "correct"),
             ("ambiguous", None, ["1", None], True, None, None, True, False, None, "correct"), ("ambiguous", None, [], True, None, None, True, False, "1", "ambiguous_unscorable"), ("not_reviewed", None, [], True, None, None, True, False, "1", None), ("verified", "1", [], False, None, None, False, False, None, "scan_missing"),
             ("verified", "1", [], True, "a", "b", True, False, "1", "hash_mismatch"), ("verified", "1", [], True, "a", None, False, False, None, "no_prediction"), ("verified", "1", [], True, None, None, True, True, "x", "incomparable"), ("verified", "1", [], True, None, None, True, False, "2", "wrong_value")]
    d = spark.createDataFrame(cases, "status string, value string, alt array<string>, present boolean, a string, b string, provided boolean, inc boolean, pred string, want string")
    got = scoring.outcome(scoring.acceptable(F.col("status"), F.col("value"), F.col("alt")), F.col("status"), F.col("present"), F.col("a"), F.col("b"), F.col("provided"), F.col("inc"), F.col("pred"))
    assert d.where(~got.eqNullSafe(F.col("want"))).count() == 0
    g = spark.createDataFrame([("b1", "s1"), ("b1", "s2")], "book_id string, scan_id string")
    with pytest.raises(Exception, match="several matches"):
        scoring.match_books(g, spark.createDataFrame([("p1", "s1"), ("p2", "s2")], "book_id string, scan_id string")).collect()


def test_validation(spark):
    nodes = spark.createDataFrame([("b", 0, "c1", None, 1, 0, 3), ("b", 1, "c2", "c1", 2, 5, 4), ("b", 2, "c3", "c9", 1, 0, 1), ("b", 3, "c4", "c2", 2, 0, 1)], "book_id string, pos int, id string, parent_id string, level int, start_index int, end_index int")
    assert sorted((r.rule, r.detail) for r in validate.structure_forest(nodes).collect()) == [("bounds", "c2"), ("parent", "c3"), ("parent", "c4")]
    raw = spark.createDataFrame([("b", '{"a":1,"z":2}')], "book_id string, j string")
    bad = validate.extra_keys(raw, "j", ["a"])
    assert bad.first().detail == "z"
    with pytest.raises(ValueError, match="unknown_key"):
        validate.require_none(bad)


def test_sources(spark, tmp_path):
    (tmp_path / "order.txt").write_bytes("﻿a\n\n b \r\nc\n".encode())
    order = inventory.read_order(spark, str(tmp_path / "order.txt"))
    assert [r.name for r in order.orderBy("scan_index").collect()] == ["a", "b", "c"]
    (tmp_path / "bad.txt").write_text("a\na\nx/y\n")
    with pytest.raises(inventory.InputError, match="twice.*path|path.*twice"):
        inventory.read_order(spark, str(tmp_path / "bad.txt"))
    files = spark.createDataFrame([("a.JPG",), ("b.jpg",), ("b.png",), ("d.png",), (".e.png",)], "filename string")
    ok, bad, other = inventory.match_files(order, files, [".jpg", ".png"])
    assert [r.filename for r in ok.collect()] == ["a.JPG"] and {(r.name, r.n) for r in bad.collect()} == {("b", 2), ("c", 0)} and [r.filename for r in other.collect()] == ["d.png"]
    png = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + struct.pack(">II", 40, 30) + b"\x08\x02\0\0\0"
    exif = b"Exif\0\0MM\0*\0\0\0\x08" + struct.pack(">HHHIHH", 1, 0x0112, 3, 1, 6, 0)
    jpeg = b"\xff\xd8\xff\xe1" + struct.pack(">H", len(exif) + 2) + exif + b"\xff\xc0" + struct.pack(">HBHHB", 11, 8, 30, 40, 1) + b"\1\x11\0"
    images = spark.createDataFrame([(0, "a", "a.png", bytearray(png)), (1, "b", "b.jpg", bytearray(jpeg)), (2, "c", "c.jpg", bytearray(b"no"))], "scan_index int, scan_id string, filename string, content binary")
    got = {r.scan_id: (r.width, r.height, r.error) for r in inventory.build_inventory(images).collect()}
    assert got["a"] == (40, 30, None) and got["b"] == (30, 40, None) and got["c"][2]


def test_ocr(spark):
    alto = '<a:alto xmlns:a="http://www.loc.gov/standards/alto/ns-v2#"><a:Layout><a:TextBlock><a:TextLine><a:String CONTENT="KAPITOLA"/><a:SP/><a:String CONTENT="I."/></a:TextLine><a:TextLine><a:String CONTENT="žluťoučký"/><a:String CONTENT="kůň"/><a:HYP CONTENT="-"/></a:TextLine></a:TextBlock><a:TextBlock><a:TextLine><a:String CONTENT="12"/></a:TextLine></a:TextBlock></a:Layout></a:alto>'
    side = [("a.xml", alto.encode()), ("b.txt", "﻿x \r\n\r\n\r\n\r\ny\f".encode()), ("c.txt", b"\xe8\xff"), ("d.xml", b"<alto><"), ("e.txt", b"1"), ("e.xml", b"2"), ("f.xml", b"<other/>")]
    scans = spark.createDataFrame([(x,) for x in "abcdefg"], "scan_id string")
    out = {r.scan_id: r for r in inventory.attach_ocr(scans, spark.createDataFrame([(n, bytearray(c)) for n, c in side], "filename string, content binary")).collect()}
    assert out["a"].ocr_text == "KAPITOLA I.\nžluťoučký kůň-\n\n12" and out["b"].ocr_text == "x\n\ny"
    assert [out[x].ocr.status for x in "abcdefg"] == ["ok", "ok", "error", "error", "error", "error", "missing"]
    assert out["a"].ocr.chars == len(out["a"].ocr_text) and not out["a"].ocr.truncated


def test_documents(spark, tmp_path):
    pages = {"source": "x", "document": {"pid": "p"}, "pages": [{"scan_index": 0, "scan_id": "a", "page_number": "(1), 2", "page_type": "titlepage"}, {"scan_index": 1, "scan_id": "b", "page_type": "Odd"}]}
    (tmp_path / "p.json").write_text(json.dumps(pages))
    d = documents.read_documents(spark, str(tmp_path / "p.json"))
    assert d.select(documents.sniff(F.col("body")).alias("k")).first().k == "pages"
    got = {(r.scan_id, r.field): (r.value, r.incomparable) for r in documents.from_pages(d, "cat", ["titlePage", "blank"]).collect()}
    assert got["a", "page_type"] == ("titlePage", False) and got["b", "page_type"] == ("Odd", True) and got["a", "page_number"] == ("[1],2", False) and got["b", "page_number"] == (None, False)
    elements = {"batch_id": "b", "page_to_image_mapping": {"p1": "dir/img1.jpg"}, "elements": [{"type": "page", "id": "p1", "batch_index": 3, "pageIndex": 0, "pageType": ["blank", 0.9], "side": ["left", 0.8]}, {"type": "chapter", "id": "c1", "title": ["A", 1]}, {"type": "chapter", "id": "c2", "parent_id": "c1", "title": ["B", 1]}]}
    (tmp_path / "e.json").write_text(json.dumps(elements))
    long, chapters = documents.from_elements(documents.read_documents(spark, str(tmp_path / "e.json")), "m", ["blank"])
    assert {(r.scan_id, r.scan_index, r.field, r.value) for r in long.collect()} >= {("img1", 0, "page_type", "blank"), ("img1", 0, "side", "left")}
    assert {(r.id, r.level) for r in documents.chapter_levels(chapters).collect()} == {("c1", 1), ("c2", 2)}
    with pytest.raises(documents.PredictionError):
        documents.chapter_levels(spark.createDataFrame([("b", "x", "y"), ("b", "y", "x")], "book_id string, id string, parent_id string"))


def test_observation_is_a_fold_that_goes_on_after_failures_and_resumes(spark):
    def payload(row, earlier):
        return {"scan": row["scan_id"], "seen": [e["scan_index"] for e in earlier if e["observation"]]}

    class Client:
        def complete(self, p):
            if p["scan"] == "s1":
                raise observe.HttpFailure(400)
            return {"model": "m", "choices": [{"content": json.dumps({"seen": p["seen"]}), "finish_reason": "stop"}], "usage": {"prompt_tokens": 5, "completion_tokens": 1}}

    scans = spark.createDataFrame([("b", f"s{i}", i) for i in range(4)], "book_id string, scan_id string, scan_index int")
    done = observe.observe_books(scans, Client, payload, sleep=lambda s: None).cache()
    got = {r.scan_id: r.observation and json.loads(r.observation)["seen"] for r in done.collect()}
    assert got == {"s0": [], "s1": None, "s2": [0], "s3": [0, 2]}
    totals = usage.usage_totals(observe.call_table(done), "book_id").first()
    assert (totals.calls, totals.failed_calls, totals.prompt_tokens, totals.cost_usd, totals.cost_complete) == (4, 1, 15, None, False)

    class Better(Client):
        def complete(self, p):
            return super().complete(p | {"scan": "other"})

    again = observe.observe_books(observe.resume(scans, done), Better, payload, sleep=lambda s: None)
    assert {r.scan_id: json.loads(r.observation)["seen"] for r in again.collect()} == {"s0": [], "s1": [0], "s2": [0], "s3": [0, 2]}
    assert observe.wait(3, rng=lambda: 1.0) == 8.0 and observe.wait(9, rng=lambda: 1.0) == 60.0


def test_retries():
    replies = [observe.HttpFailure(500), {"choices": [{"content": "{", "finish_reason": "stop"}]}, {"choices": [{"content": "{}", "finish_reason": "stop"}]}]

    class Client:
        def complete(self, p):
            r = replies.pop(0)
            if isinstance(r, Exception):
                raise r
            return r

    r = observe.Requests(Client(), 3, sleep=lambda s: None).send({}, lambda x: x, "c", "observe")
    assert [c["status"] for c in r.calls] == ["http_error", "invalid_response", "ok"]


def test_context_fits(spark):
    from pyspark.sql import functions as F

    cases = [(["s" * 50], ["b1", "b2"], ["r1", "r2"])]
    d = spark.createDataFrame(cases, "s array<string>, b array<string>, r array<string>")

    def fit(most):
        return d.select(context.fitted(F.col("s"), F.col("b"), F.col("r"), most).alias("t")).first().t

    head = "s" * 50
    assert fit(10_000) == f"{head}\nb1\nb2\nPrevious scans:\nr1\nr2"
    whole = len(fit(10_000))
    assert fit(whole) == fit(10_000)
    assert fit(whole - 1) == f"{head}\nb1\nb2\nPrevious scans:\nr2"
    assert fit(whole - 4) == f"{head}\nb1\nb2"
    assert fit(55) == head  # the note on left-out fields does not fit either; the text ends with a line
    assert fit(20) == "s" * 20


def test_context_fits(spark):
    from pyspark.sql import functions as F

    head = "s" * 50
    d = spark.createDataFrame([([head], ["b1", "b2"], ["r1", "r2"])], "s array<string>, b array<string>, r array<string>")
    want = {
        10_000: f"{head}\nb1\nb2\nPrevious scans:\nr1\nr2", 78: f"{head}\nb1\nb2\nPrevious scans:\nr1\nr2",
        77: f"{head}\nb1\nb2\nPrevious scans:\nr2", 74: f"{head}\nb1\nb2",
        55: head,  # the note on left-out fields does not fit either; the text ends with a line
        20: "s" * 20,
    }
    got = d.select(*[context.fitted(F.col("s"), F.col("b"), F.col("r"), most).alias(str(most)) for most in want]).first()
    assert {most: got[str(most)] for most in want} == want


def test_rounds_store_each_scan(spark, tmp_path):
    class Client:
        def complete(self, body):
            n = int(body["messages"][1]["content"][0]["text"])
            if n == 2 and not (tmp_path / "mended").exists():
                raise observe.HttpFailure(400)
            return {"model": "m", "choices": [{"content": f'{{"n": {n}}}', "finish_reason": "stop"}], "usage": {}}

    def payload(scan, earlier):
        return observe.build_payload("m", "s", str(sum(e["observation"] is not None for e in earlier)))

    scans = spark.createDataFrame([(b, f"{b}{i}", i) for b in "xy" for i in range(4)], "book_id string, scan_id string, scan_index int")
    store = f"{tmp_path}/store"
    run = lambda: {r.scan_id: r.observation for r in observe.observe_in_rounds(scans, store, Client, payload, per_round=2, sleep=lambda s: None).collect()}
    # the third scan fails, and the fourth after it has seen as many before it
    assert run() == {f"{b}{i}": f'{{"n": {i}}}' if i < 2 else None for b in "xy" for i in range(4)}
    assert spark.read.parquet(store).groupBy("round").count().count() == 2
    (tmp_path / "mended").touch()
    assert run() == {f"{b}{i}": f'{{"n": {i}}}' for b in "xy" for i in range(4)}
    assert spark.read.parquet(store).count() == 12


def test_evaluate_reads_gold_and_writes_reports(spark, tmp_path):
    from pageloom.__main__ import evaluate

    scan = lambda i, **labels: {"scan_id": f"s{i}", "scan_index": i, "image_sha256": f"{i}"} | labels
    gold = {"gold_version": "1", "book_id": "b", "scan_count": 3, "scans": [
        scan(0, page_type={"status": "verified", "value": "blank"}, side={"status": "not_applicable"}),
        scan(1, page_type={"status": "ambiguous", "alternatives": ["preface", None]}, printed_numbers={"status": "verified", "value": ["4", "5"]}, page_number={"status": "verified", "value": "4, 5"}),
        scan(2, side={"status": "verified", "value": "left"}),
    ]}
    number = lambda v, side: {"side": side, "raw": v, "normalized": v}
    seen = lambda i, **o: {"scan_id": f"s{i}", "scan_index": i, "image_sha256": f"{i}", "observation": o}
    book = {"schema_version": "2", "book_id": "b", "scans": [seen(0, page_type="blank", side="left"), seen(1, page_type=None, printed_numbers=[number("5", "right"), number("4", "left")]), seen(2, side="right")]}
    claim = lambda v: v and {"value": v, "origin": "observed"}
    flat = lambda **c: {k: claim(c.get(k)) for k in ("page_type", "side", "leaf")} | {"page_number": c.get("page_number")}
    chapter = {"title": claim("One"), "level": 1, "start_scan_id": "s1", "printed_page_reference": "4"}
    book["resolved"] = {"scans": [flat(page_type="blank"), flat(page_number="4,5"), flat(side="left")], "bibliography": {"title": claim("T"), "subtitle": None, "author": [claim("A"), claim("B")], "editor": []}, "structure": [chapter]}
    (tmp_path / "gold.json").write_text(json.dumps(gold))
    (tmp_path / "book.json").write_text(json.dumps(book))
    labels = {(r.scan_id, r.field): (r.status, r.accept) for r in documents.gold_labels(documents.read_documents(spark, f"{tmp_path}/gold.json")).collect()}
    assert len(labels) == 15 and labels["s1", "printed_numbers"] == ("verified", ["4,5"]) and labels["s1", "page_number"] == ("verified", ["4,5"])
    assert labels["s0", "side"] == ("not_applicable", [None]) and labels["s2", "leaf"] == ("not_reviewed", None) and labels["s1", "page_type"] == ("ambiguous", ["preface", None])
    evaluate(spark, f"{tmp_path}/gold.json", f"{tmp_path}/book.json", "mine", f"{tmp_path}/report.json")
    found = json.loads((tmp_path / "report.json").read_text())
    by = {r["field"]: r for r in found["accuracy"] if r["layer"] == "observed"}
    resolved = {r["field"]: r for r in found["accuracy"] if r["layer"] == "resolved"}
    assert (resolved["page_type"]["correct"], resolved["side"]["correct"], resolved["page_number"]["correct"], resolved["printed_numbers"]["no_prediction"]) == (2, 2, 1, 1)
    _, biblio, chapters = documents.from_resolved(documents.read_documents(spark, f"{tmp_path}/book.json"), "mine")
    assert {r.field: r.value for r in biblio.collect()} == {"title": ["T"], "subtitle": [], "author": ["A", "B"], "editor": []}
    assert [tuple(r) for r in chapters.collect()] == [("b", 0, "One", 1, "s1", "4")]
    assert (by["page_type"]["correct"], by["printed_numbers"]["correct"], by["side"]["spurious_value"], by["side"]["wrong_value"]) == (2, 1, 1, 1)
    assert "# Evaluation" in (tmp_path / "report.md").read_text()
    with pytest.raises(documents.PredictionError):
        evaluate(spark, f"{tmp_path}/book.json", f"{tmp_path}/book.json", "mine", f"{tmp_path}/no.json")


def test_settings_files(tmp_path):
    from pageloom import config

    for text in (None, "{", "[]"):
        path = tmp_path / f"{text and ord(text[0])}.json"
        if text:
            path.write_text(text)
        with pytest.raises(config.ConfigError):
            config.read_settings(str(path))
    (tmp_path / "good.json").write_text('{"provider": "openai", "model": "m"}')
    assert config.build_config(config.read_settings(f"{tmp_path}/good.json")).model == "m"
    with pytest.raises(config.ConfigError, match="environment"):
        config.build_config({"provider": "openai", "model": "m", "api_key": "x"})
