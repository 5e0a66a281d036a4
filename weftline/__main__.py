"""python -m weftline run | collect | review | probe"""

from __future__ import annotations

import argparse
import sys
from datetime import date

from pyspark.sql import functions as F

from weftline.config import Config
from weftline.operators import textproc
from weftline.plans.analysis import analyse
from weftline.plans.collection import collect, known_ids
from weftline.runtime import build_session
from weftline.sources import articles, dictionaries, feeds


def arguments(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="weftline")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("run", "review"):
        sub = commands.add_parser(name)
        sub.add_argument("--articles", default="articles")
        sub.add_argument("--dict", default="dict")
        sub.add_argument("--stopwords", default="dict/stopwords.txt")
        sub.add_argument("--config", default="config.yaml")
    commands.choices["run"].add_argument("--out", default="out")
    commands.choices["review"].add_argument("--min-count", type=int, default=3)
    commands.choices["review"].add_argument("--top", type=int, default=50)
    sub = commands.add_parser("collect")
    sub.add_argument("--sources", default="sources")
    sub.add_argument("--out", default="articles")
    sub.add_argument("--only")
    sub.add_argument("--dry-run", action="store_true")
    commands.add_parser("probe").add_argument("url")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = arguments(sys.argv[1:] if argv is None else argv)
    if args.command == "probe":
        print(feeds.probe(feeds.fetch(args.url), args.url))
        return 0
    spark = build_session()
    if args.command == "collect":
        sources = dictionaries.load_sources(spark, args.sources)
        sources = sources.where(F.col("id") == args.only) if args.only else sources
        stored, report = collect(spark, sources, known_ids(spark, args.out), date.today(), out=None if args.dry_run else args.out)
        report.show(1000, truncate=60)
        failed, listed = report.where("error is not null").count(), report.count()
        return int(listed > 0 and failed == listed)
    cfg = Config.load(args.config)
    docs = articles.load_articles(spark, args.articles)
    entities, stop = dictionaries.load_entities(spark, args.dict), dictionaries.load_stopwords(args.stopwords)
    if args.command == "run":
        print(analyse(spark, docs, entities, stop, cfg, args.out))
        return 0
    baskets = textproc.build_baskets(docs, textproc.make_analyser(entities, stop, cfg), cfg)
    known = entities.select(F.explode("aliases").alias("alias"))
    textproc.dictionary_candidates(baskets, known, args.min_count, args.top).orderBy("list", "rank").show(2 * args.top, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
