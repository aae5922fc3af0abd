"""python -m pageloom: inventory, gold-template, labels, evaluate. Exit codes: 0 done, 1 failed items, 2 bad input, 130 interrupted."""

from __future__ import annotations

import argparse
import sys

from pageloom.config import ConfigError


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="pageloom")
    sub = p.add_subparsers(dest="command", required=True)
    for name, what in (("inventory", "scans of a folder of images with sizes and hashes, as JSON lines"), ("gold-template", "a manifest with one unreviewed label a scan and field")):
        c = sub.add_parser(name, help=what)
        c.add_argument("images")
        c.add_argument("--order", required=True, help="file with one scan name a line")
        c.add_argument("--book", required=True)
        c.add_argument("--max-pages", type=int)
        c.add_argument("--out", required=True)
    c = sub.add_parser("evaluate", help="annotated books scored against gold manifests, as a JSON report and a Markdown one beside it")
    c.add_argument("gold")
    c.add_argument("predictions")
    c.add_argument("--system", default="annotated")
    c.add_argument("--out", required=True)
    c = sub.add_parser("labels", help="page labels of annotated books (JSON documents), as JSON lines")
    c.add_argument("books")
    c.add_argument("--out", required=True)
    return p


def evaluate(spark, gold: str, predictions: str, system: str, out: str) -> None:
    """Field statistics by system and layer, the first errors and label counts. Both reports are small; the driver writes them."""
    from pyspark.sql import functions as F

    from pageloom.operators import report, scoring
    from pageloom.schemas import BOOK
    from pageloom.sources import documents

    kinds = {name: documents.read_documents(spark, path).withColumn("kind", documents.sniff(F.col("body"))) for name, path in (("gold", gold), ("annotated", predictions))}
    for name, d in kinds.items():
        other = d.where(f"kind is null or kind != '{name}'").select("path").limit(5).collect()
        if other:
            raise documents.PredictionError(f"not of kind {name}: {', '.join(r['path'] for r in other)}")
    labels = documents.gold_labels(kinds["gold"])
    predicted = documents.from_annotated(kinds["annotated"], BOOK, system).unionByName(documents.from_resolved(kinds["annotated"], system)[0])
    coded = scoring.score_scans(labels, predicted)
    found = report.collect_report(scoring.field_stats(coded, "system", "layer", "field"), scoring.errors(coded), scoring.status_counts(labels))
    with open(out, "w", encoding="utf-8") as f:
        f.write(report.to_json(found))
    with open(f"{out.removesuffix('.json')}.md", "w", encoding="utf-8") as f:
        f.write(report.to_markdown(found))


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from pageloom.config import check_paths
    from pageloom.sources import documents, inventory

    spark = SparkSession.builder.appName("pageloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        if args.command == "labels":
            from pageloom.operators import pagination
            from pageloom.schemas import BOOK

            d = documents.read_documents(spark, args.books).select(F.from_json(F.to_json("body"), BOOK).alias("b")).select("b.book_id", F.explode("b.scans").alias("s"))
            o = F.col("s.observation")
            none = lambda c, kind: F.coalesce(o[c].cast(f"array<{kind}>"), F.array().cast(f"array<{kind}>"))
            number = F.transform(o["printed_numbers"], lambda n: F.struct(*[n[c].alias(c) for c in ("side", "raw", "normalized", "numeric_value", "numeral_system")]))
            sub = F.transform(o["subpages"], lambda s: F.struct(*[s[c].alias(c) for c in ("side", "page_type", "leaf")]))
            scans = d.select("book_id", F.col("s.scan_index").alias("scan_index"), o["page_type"].alias("page_type"), o["side"].alias("side"), o["leaf"].alias("leaf"), F.coalesce(number, F.array().cast(f"array<{pagination.NUMBER}>")).alias("numbers"), F.coalesce(sub, F.array().cast(f"array<{pagination.SUBPAGE}>")).alias("subpages"))
            documents.write_json_lines(pagination.scan_page_numbers(pagination.page_labels(scans)), args.out)
            return 0
        if args.command == "evaluate":
            evaluate(spark, args.gold, args.predictions, args.system, args.out)
            return 0
        check_paths(args.out, args.images)
        order = inventory.read_order(spark, args.order)
        if args.max_pages is not None:
            order = order.where(F.col("scan_index") < args.max_pages)
        files = spark.read.format("binaryFile").load(args.images).withColumn("filename", F.regexp_extract("path", r"([^/]*)$", 1))
        found, problems, _ = inventory.match_files(order, files.select("filename"), [".jpg", ".jpeg", ".png"])
        bad = problems.limit(20).collect()
        if bad:
            raise inventory.InputError("; ".join(f"{r['name']}: {r['n']} files" for r in bad))
        images = found.withColumnRenamed("name", "scan_id").join(files.select("filename", "content"), "filename")
        scans = inventory.build_inventory(images).withColumn("book_id", F.lit(args.book))
        out = scans if args.command == "inventory" else inventory.gold_template(scans, documents.FIELDS)
        documents.write_json_lines(out.orderBy("scan_index"), args.out)
        return int(scans.where("error is not null").count() > 0)
    except (ConfigError, inventory.InputError, documents.PredictionError) as exc:
        print(exc, file=sys.stderr)
        return 2
    except KeyboardInterrupt:
        return 130


if __name__ == "__main__":
    sys.exit(main())
