"""Command line: ``python -m stripweave.cli COMMAND ...``."""

from __future__ import annotations

import argparse
import glob
import json
import os
import sys


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="stripweave", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def add(name: str, *args: str, **flags) -> argparse.ArgumentParser:
        p = commands.add_parser(name)
        for a in args:
            p.add_argument(a)
        p.add_argument("--config", help="YAML or JSON settings")
        p.add_argument("--sessions", help="YAML or JSON that overrides the settings' top-level names")
        return p

    add("build-dataset", "inputs", "catalog").add_argument("--allow-unknown", action="store_true")
    add("rebuild-pairs", "catalog")
    add("plan-sessions", "folder", "output")
    add("export-reviews", "catalog", "output")
    add("import-reviews", "catalog", "input")
    p = add("export-dataset", "catalog", "output")
    p.add_argument("--include-rejected", action="store_true")
    p.add_argument("--include-empty", action="store_true")
    add("package-dataset", "catalog", "source", "output")
    p = add("review-queue", "catalog")
    p.add_argument("--decision")
    p.add_argument("--status")
    p.add_argument("--sample", type=int)
    p.add_argument("--show-empty", action="store_true")
    p = add("query", "tables", "name")
    p.add_argument("--rows", type=int, default=20)
    return top


def settings_of(*paths: str | None):
    from .config import DEFAULTS

    out = DEFAULTS
    for path in paths:
        if path:
            names = sorted(glob.glob(os.path.join(path, "part-*"))) if os.path.isdir(path) else [path]
            text = "\n".join(open(name, encoding="utf-8").read() for name in names)
            try:
                given = json.loads(text)
            except ValueError:
                given = joined_lines(text)
            out = out.merged(given or {})
    return out


def joined_lines(text: str) -> dict:
    """JSON lines as one configuration, maps and lists put together; any other text is YAML."""
    lines = [x for x in text.splitlines() if x.strip()]
    if not lines or not all(x.startswith("{") for x in lines):
        import yaml

        return yaml.safe_load(text)
    out: dict = {}
    for given in map(json.loads, lines):
        for name, value in given.items():
            if isinstance(value, dict):
                out.setdefault(name, {}).update(value)
            elif isinstance(value, list):
                out.setdefault(name, []).extend(value)
            else:
                out[name] = value
    return out


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    from pyspark.sql import SparkSession

    from .plans import commands, registry
    from .sources.sinks import Catalog, write_json

    spark = SparkSession.builder.appName("stripweave").getOrCreate()
    settings = settings_of(args.config, args.sessions)
    catalog = Catalog(spark, args.catalog) if "catalog" in args else None
    if args.command == "build-dataset":
        read = lambda name: spark.read.parquet(f"{args.inputs}/{name}")
        commands.build_dataset(catalog, *map(read, ("video_info", "frame_metrics", "bag_crops", "ocr_payloads")), settings, allow_unknown=args.allow_unknown).show()
    elif args.command == "rebuild-pairs":
        commands.rebuild_pairs(catalog, settings).groupBy("status").count().show()
    elif args.command == "plan-sessions":
        from .operators.grouping import session_config

        write_json(session_config(commands.plan_sessions(spark, args.folder, settings=settings)), args.output)
    elif args.command == "export-reviews":
        commands.export_reviews(catalog, args.output)
    elif args.command == "import-reviews":
        commands.import_reviews(catalog, args.input).show(truncate=False)
    elif args.command == "export-dataset":
        from .operators.review import breakdown

        out = commands.export_dataset(catalog, args.output, exclude_rejected=not args.include_rejected, exclude_empty=not args.include_empty)
        breakdown(out.select("pipeline_status", "label_source", "review.decision")).orderBy("kind", "value").show()
    elif args.command == "package-dataset":
        commands.package_dataset(catalog, args.source, args.output).show(truncate=False)
    elif args.command == "review-queue":
        commands.review_queue(catalog, decision=args.decision, status=args.status, sample=args.sample, hide_empty=not args.show_empty).show(truncate=False)
    else:
        registry.QUERIES[args.name](spark, args.tables).show(args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
