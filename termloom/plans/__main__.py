"""``spark-submit`` entry: ``python -m termloom.plans <job> ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ..functions.analysis import LANGUAGES
from .mine_stopwords import mine_stopwords
from .parse_archives import parse_archives
from .top_terms import top_terms


def main() -> None:
    parser = argparse.ArgumentParser(prog="termloom")
    jobs = parser.add_subparsers(dest="job", required=True)

    archives = jobs.add_parser("parse-archives")
    archives.add_argument("--filelist", required=True)
    archives.add_argument("--outputdir", required=True)
    archives.add_argument("--oversize", choices=["global", "running", "none"], default="none")
    archives.add_argument("--rejectsdir", help="where to write what is not in the output, and why")
    archives.add_argument("--maxlinelen", type=int, help="messages with a longer line are rejected")
    archives.add_argument("--strictdividers", action="store_true", help="a message begins behind a blank line only")

    terms = jobs.add_parser("top-terms")
    terms.add_argument("--input", required=True)
    terms.add_argument("--workingdir", required=True)
    terms.add_argument("--stopwords")
    terms.add_argument("--maxterms", type=int, default=20)
    terms.add_argument("--shinglesize", type=int, default=1)

    words = jobs.add_parser("mine-stopwords")
    words.add_argument("--input", required=True)
    words.add_argument("--workingdir", required=True)
    words.add_argument("--maxdf", type=float, help="share of users; without it the commonest 2000 terms are listed")

    for job in (archives, terms, words):
        job.add_argument("--partitions", type=int, help="deal the input over that many tasks first")
    for job in (terms, words):
        job.add_argument("--lang", default="en", choices=LANGUAGES)

    args = parser.parse_args()
    spark = SparkSession.builder.appName(f"termloom {args.job}").getOrCreate()
    if args.job == "parse-archives":
        oversize = None if args.oversize == "none" else args.oversize
        print(
            parse_archives(
                spark,
                args.outputdir,
                args.filelist,
                oversize=oversize,
                strict_dividers=args.strictdividers,
                rejects_dir=args.rejectsdir,
                max_line_len=args.maxlinelen,
                partitions=args.partitions,
            )
        )
    elif args.job == "top-terms":
        options = {"lang": args.lang, "partitions": args.partitions}
        print(
            top_terms(
                spark, args.input, args.workingdir, args.stopwords, args.maxterms, args.shinglesize, **options
            )
        )
    else:
        options = {"lang": args.lang, "partitions": args.partitions}
        print(mine_stopwords(spark, args.input, args.workingdir, args.maxdf, **options))
    spark.stop()


if __name__ == "__main__":
    main()
