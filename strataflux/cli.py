"""Command line: one command per stage, `run` for all of them. Exit 1: losses don't reconcile; 2: bad configuration."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pydantic import ValidationError

from strataflux import __version__
from strataflux.config import parse_settings


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="strataflux")
    commands = p.add_subparsers(dest="command", required=True)
    commands.add_parser("version")
    for name in ("ingest", "qc", "harmonize", "model", "account", "report", "run", "provenance"):
        c = commands.add_parser(name)
        c.add_argument("--config", required=True)
        c.add_argument("--outdir", required=True)
        c.add_argument("--regions", help="parquet table of the region vocabulary", required=name in ("ingest", "account", "run"))
        if name == "ingest":
            c.add_argument("--subject", help="only this subject")
    c = commands.add_parser("collect")
    c.add_argument("--outdir", required=True)
    c.add_argument("sources", nargs="+")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    if args.command == "version":
        print(__version__)
        return 0
    config = None
    if args.command != "collect":
        try:
            config = parse_settings(Path(args.config).read_text())
        except ValidationError as e:
            for x in e.errors():
                print(f"{'.'.join(map(str, x['loc']))}: {x['msg']}", file=sys.stderr)
            return 2
    from pyspark.sql import SparkSession

    from strataflux.plans import pipeline, report

    spark = SparkSession.builder.appName("strataflux").getOrCreate()
    regions = spark.read.parquet(args.regions) if getattr(args, "regions", None) else None
    out = args.outdir
    if args.command == "ingest":
        pipeline.ingest(spark, config, regions, out, args.subject)
    elif args.command == "qc":
        pipeline.run_qc(spark, config, out)
    elif args.command == "harmonize":
        pipeline.run_harmonize(spark, config, out)
    elif args.command == "model":
        pipeline.run_model(spark, config, out)
    elif args.command == "collect":
        pipeline.collect(spark, args.sources, out)
    elif args.command == "provenance":
        Path(out, "provenance.json").write_text(json.dumps(pipeline.provenance(spark, config), indent=2))
    elif args.command == "report":
        Path(out, "report.html").write_text(report.render(report.collect_summaries(spark, config, out), pipeline.provenance(spark, config), []))
    else:
        errors = pipeline.run(spark, config, regions, out) if args.command == "run" else pipeline.run_accounting(spark, config, regions, out)
        for e in errors:
            print(e, file=sys.stderr)
        return int(bool(errors))
    return 0


if __name__ == "__main__":
    sys.exit(main())
