"""python -m tidemark run [--sources a,b] [--dry-run] [--output DIR] | sources"""

from __future__ import annotations

import argparse
import logging

from tidemark.sources.content import REGISTRY


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tidemark", description="Financial documents: entities, sentiment, checks, briefings.")
    parser.add_argument("-v", "--verbose", action="store_true")
    commands = parser.add_subparsers(dest="command", required=True)
    run_ = commands.add_parser("run", help="fetch, annotate, check and write")
    run_.add_argument("--sources", help="keys, comma-separated; all without it")
    run_.add_argument("--dry-run", action="store_true", help="only fetch and de-duplicate; writes nothing")
    run_.add_argument("--output", default="output")
    commands.add_parser("sources", help="the sources' keys")
    given = parser.parse_args(arguments)
    logging.basicConfig(level=logging.DEBUG if given.verbose else logging.INFO)
    if given.command == "sources":
        print("\n".join(REGISTRY))
        return
    from pyspark.sql import SparkSession

    from tidemark.run import run

    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    sources = [s.strip() for s in given.sources.split(",")] if given.sources else None
    out = run(spark, given.output, sources, given.dry_run)
    if given.dry_run:
        out["content_items"].select("source_name", "title", "content_hash").orderBy("ord").show(1000, False)
    else:
        print(out)


if __name__ == "__main__":
    main()
