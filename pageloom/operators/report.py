"""Evaluation reports: small tables go to the driver and become JSON or Markdown; equal inputs give equal bytes."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame

from pageloom.operators.scoring import SCORED, UNSCORED

SHOWN = 100


def ratio(a: int, b: int) -> float | None:
    return round(a / b, 4) if b else None


def percent(x: float | None) -> str:
    return "–" if x is None else f"{100 * x:.1f} %"


def collect_report(stats: DataFrame, errors: DataFrame, statuses: DataFrame, agreement: DataFrame | None = None) -> dict:
    """The report of field statistics by (system, layer, field). Only sums and the first SHOWN errors leave the executors."""
    rows = lambda d, *keys: [r.asDict() for r in d.orderBy(*keys).collect()]
    accuracy = [r | {"accuracy": ratio(r["correct"], r["scored"]), "coverage": ratio(r["scored"], r["eligible"])} for r in rows(stats, "system", "layer", "field")]
    shown = [{k: str(v) if v is not None else None for k, v in r.asDict().items()} for r in errors.orderBy("book_id", "scan_index", "field").limit(SHOWN).collect()]
    return {"accuracy": accuracy, "errors": {"total": errors.count(), "first": shown}, "gold_status_counts": rows(statuses, "field", "status"), "agreement": rows(agreement, "system", "layer", "comparator", "field") if agreement is not None else []}


def to_json(report: dict) -> str:
    return json.dumps(report, ensure_ascii=False, indent=2, sort_keys=True) + "\n"


def _table(head: list[str], rows: list[list]) -> list[str]:
    line = lambda cells: "| " + " | ".join("" if c is None else str(c) for c in cells) + " |"
    return [line(head), line(["---"] * len(head)), *map(line, rows)]


def to_markdown(report: dict) -> str:
    out = ["# Evaluation", "", "## Accuracy", ""]
    out += _table(["system", "layer", "field", "eligible", "scored", "accuracy", "coverage", *SCORED[1:], *UNSCORED], [[r["system"], r["layer"], r["field"], r["eligible"], r["scored"], percent(r["accuracy"]), percent(r["coverage"]), *[r[o] for o in SCORED[1:] + UNSCORED]] for r in report["accuracy"]])
    out += ["", "## Labels by status", "", *_table(["field", "status", "labels"], [[r["field"], r["status"], r["n"]] for r in report["gold_status_counts"]])]
    if report["agreement"]:
        out += ["", "## Agreement with comparators", "", *_table(["system", "comparator", "field", "compared", "agreement"], [[r["system"], r["comparator"], r["field"], r["compared"], percent(r["agreement"])] for r in report["agreement"]])]
    e = report["errors"]
    if e["total"]:
        out += ["", f"## Errors ({e['total']})", "", *_table(["book", "scan", "field", "outcome", "predicted"], [[r["book_id"], r["scan_id"], r["field"], r["outcome"], r.get("predicted")] for r in e["first"]])]
        if e["total"] > SHOWN:
            out += ["", f"{e['total'] - SHOWN} more."]
    return "\n".join(out) + "\n"
