import pytest

from pageloom import config, schemas
from pageloom.operators import proposal, reconcile, report


def test_config():
    c = config.build_config({"provider": "openai", "model": "m", "base_url": "https://x"}, {"provider": "openrouter", "max_retries": 2})
    assert c.url.startswith("https://openrouter") and c.max_retries == 2 and "context_max_chars" in c.identity()
    for bad in ({"provider": "openai", "model": "m", "max_retries": 11}, {"provider": "openai", "model": "m", "api_key": "x"}, {"provider": "openai"}, {"provider": "openai", "model": "m", "request_params": {"model": "y"}}, {"provider": "openai", "model": "m", "base_url": "ftp://x"}):
        with pytest.raises(config.ConfigError):
            config.build_config(bad)
    with pytest.raises(config.ConfigError):
        config.check_paths("/a/b/out.json", "/a/b")


def test_vocabularies():
    assert len(schemas.PAGE_TYPES) == 37 == len(set(schemas.PAGE_TYPES)) and len(schemas.BIBLIO_FIELDS) == 17


def test_proposal_text(spark):
    o = ("titlePage", 0.9, 'full "title"', None, None, None, None, None, [], [("left", "V", "V", 5, "roman", "top_left", None, None)], [("Úvod  x", None, None, None)], [("A", None, 1, None)], [("title", "T", None, None)], None)
    scans = spark.createDataFrame([("b", 0, o, "V"), ("b", 1, None, None)], f"book_id string, scan_index int, observation {schemas.OBSERVATION}, page_number string")
    runs = spark.createDataFrame([("b", 0, "- scan 1: roman V")], "book_id string, run bigint, line string")
    warn = spark.createDataFrame([("b", 0, 3, "code", "message")], "book_id string, stage int, ord int, code string, message string")
    text = reconcile.proposal_input(proposal.header_lines(scans, runs, warn), proposal.scan_lines(scans)).first().text
    assert text.split("\n")[2:] == [
        "Printed page numbering:", "- scan 1: roman V", "- code: message", "", "Scans:", 'scan 1: titlePage (0.9, "full \\"title\\""); side unknown; printed V (left) at top_left; label V', '  heading level ?: "Úvod x"', '  TOC entry level 1: "A" -> no page reference', '  title: "T"', "scan 2: not observed (request failed); label unresolved",
    ]
    with pytest.raises(Exception, match="input over 50 characters: b"):
        reconcile.proposal_input(proposal.header_lines(scans, runs, warn), proposal.scan_lines(scans), most=50).collect()


def test_report(spark):
    from pageloom.operators import scoring

    coded = spark.createDataFrame([("s", "l", "b", "x", 1, "f", "correct", "1"), ("s", "l", "b", "y", 2, "f", "wrong_value", "2"), ("s", "l", "b", "z", 3, "f", None, None)], "system string, layer string, book_id string, scan_id string, scan_index int, field string, outcome string, predicted string")
    status = spark.createDataFrame([("f", "verified", 2)], "field string, status string, n int")
    r = report.collect_report(scoring.field_stats(coded, "system", "layer", "field"), scoring.errors(coded), status)
    assert r["accuracy"][0]["accuracy"] == 0.5 and r["errors"]["total"] == 1
    md = report.to_markdown(r)
    assert "50.0 %" in md and "| b | y | f | wrong_value | 2 |" in md and report.to_json(r) == report.to_json(r)


def test_command_line(spark, tmp_path):
    import json
    import struct

    from pageloom.__main__ import main

    images = tmp_path / "images"
    images.mkdir()
    for name in ("a", "b"):
        (images / f"{name}.png").write_bytes(b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + struct.pack(">II", 40, 30) + b"\x08\x02\0\0\0")
    (tmp_path / "order").write_text("b\na\n")
    assert main(["inventory", str(images), "--order", str(tmp_path / "order"), "--book", "x", "--out", str(tmp_path / "inv")]) == 0
    rows = [json.loads(x) for f in (tmp_path / "inv").glob("part*") for x in f.read_text().splitlines()]
    assert sorted((r["scan_index"], r["scan_id"], r["width"]) for r in rows) == [(0, "b", 40), (1, "a", 40)]
    assert main(["gold-template", str(images), "--order", str(tmp_path / "order"), "--book", "x", "--out", str(images / "gold")]) == 2
    book = {"schema_version": "0.3", "book_id": "b", "scans": [{"scan_id": "s0", "scan_index": 0, "observation": {"page_type": "normalPage", "printed_numbers": [{"raw": "7", "numeric_value": 7, "numeral_system": "arabic"}], "subpages": []}}, {"scan_id": "s1", "scan_index": 1}]}
    (tmp_path / "book.json").write_text(json.dumps(book))
    assert main(["labels", str(tmp_path / "book.json"), "--out", str(tmp_path / "labels")]) == 0
    rows = [json.loads(x) for f in (tmp_path / "labels").glob("part*") for x in f.read_text().splitlines()]
    assert sorted((r["scan_index"], r["page_number"]) for r in rows) == [(0, "7"), (1, "[8]")]
