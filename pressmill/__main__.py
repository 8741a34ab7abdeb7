"""``python -m pressmill format|extract|links IN OUT``, also for spark-submit."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from pressmill.config import JobConfig
from pressmill.plans.crawling import pages_to_links, run_extraction
from pressmill.plans.formatting import run_formatter, run_published
from pressmill.session import prepare_workers
from pressmill.sources.pages import read_pages

def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="pressmill")
    parser.add_argument("job", choices=("format", "extract", "links"))
    parser.add_argument("path")
    parser.add_argument("out_dir")
    parser.add_argument("--keywords", nargs="*", default=[])
    parser.add_argument("--start", default=JobConfig.start)
    parser.add_argument("--end", default=JobConfig.end)
    parser.add_argument("--lines", action="store_true", help="articles are JSON lines")
    parser.add_argument("--date-format", default=JobConfig.date_format)
    parser.add_argument("--batch", nargs="+", default=JobConfig.batch, help="numbers restart here")
    parser.add_argument("--run", help="format: publish the outputs together as this run, numbers go on")
    parser.add_argument("--seen", help="links: table of source and url already fetched")
    args = parser.parse_args(argv)
    cfg = JobConfig(tuple(args.keywords), args.start, args.end, args.date_format, tuple(args.batch))
    spark = SparkSession.builder.appName(f"pressmill-{args.job}").getOrCreate()
    if args.job == "format" and args.run:
        print(run_published(spark, args.path, args.out_dir, args.run, cfg, args.lines))
    elif args.job == "format":
        run_formatter(spark, args.path, args.out_dir, cfg, args.lines)
    elif args.job == "extract":
        run_extraction(spark, args.path, args.out_dir, cfg)
    else:
        prepare_workers(spark)
        seen = spark.read.parquet(args.seen) if args.seen else None
        links = pages_to_links(read_pages(spark, args.path), cfg, seen)
        links.write.mode("overwrite").partitionBy("source").parquet(args.out_dir)


if __name__ == "__main__":
    main()
