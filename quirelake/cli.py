"""Command line: diagnose, run, validate, crosscheck, parsers. Exit codes: 0 good, 1 findings, 2 no input."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quirelake.functions import patterns as P
from quirelake.operators import diagnose, validate
from quirelake.plans import corpus
from quirelake.sources import parsers, sinks
from quirelake.sources import text as S


def _texts(spark: SparkSession, path: str):
    return spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select(F.col("_metadata.file_name").alias("doc_id"), F.col("value").alias("text"))


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="quirelake")
    sub = ap.add_subparsers(dest="verb", required=True)
    for verb in ("diagnose", "run", "validate"):
        p = sub.add_parser(verb)
        p.add_argument("path")
        p.add_argument("--profile", default="textbook", choices=sorted(P.PROFILES))
        p.add_argument("--out", default="out")
        p.add_argument("--from", dest="start", default="extract", choices=corpus.STAGES)
        p.add_argument("--pages", help="2-4, 5 or 7-")
        p.add_argument("--parser", help="the first available one that the diagnosis names, if not given")
        p.add_argument("--force", action="store_true", help="run without a diagnosis")
    p = sub.add_parser("crosscheck")
    p.add_argument("a")
    p.add_argument("b")
    sub.add_parser("parsers")
    args = ap.parse_args(argv)
    if args.verb == "parsers":
        for name, (good, why) in parsers.availability().items():
            print(f"{name:12} {'available' if good else why}")
        return 0
    spark = SparkSession.builder.appName("quirelake").getOrCreate()
    if args.verb == "crosscheck":
        tally = lambda root: validate.mnemonic_inventory(S.markdown_corpus(spark, root).select("name", "text")).select(F.col("body").alias("term"), "n")
        a, b = tally(args.a).cache(), tally(args.b).cache()
        pairs = validate.near_misses(a, b)
        text = sinks.crosscheck_report(validate.crosscheck_terms(a, b), pairs)
        sinks.write_text(spark, f"{args.a.rstrip('/')}/_reports/crosscheck.md", text)
        print(text)
        return int(pairs.limit(1).count() > 0)
    rules = P.profile(args.profile)
    if args.verb == "validate":
        files = S.markdown_corpus(spark, args.path).select("name", "text")
        found = validate.validate(files, rules)
        verdict = validate.verdict(found)
        print(sinks.report(found, verdict))
        return int(verdict.first().verdict == "FAIL")
    docs = _texts(spark, args.path)
    if docs.limit(1).count() == 0:
        print(f"nothing in {args.path}", file=sys.stderr)
        return 2
    if args.verb == "diagnose":
        diagnose.diagnose(S.text_pages(docs), rules=rules).write.mode("overwrite").parquet(f"{args.out}/_reports/diagnosis")
        text = sinks.diagnosis_report(spark.read.parquet(f"{args.out}/_reports/diagnosis"))
        sinks.write_text(spark, f"{args.out}/_reports/diagnosis.md", text)
        print(text)
        return 0
    found = diagnose.stored(spark, f"{args.out}/_reports/diagnosis", docs)
    if found is None and not args.force and args.start == "extract":
        print(f"no diagnosis of all documents; run: quirelake diagnose {args.path} --out {args.out}, or use --force", file=sys.stderr)
        return 2
    parser = args.parser or parsers.pick_parser(["textfile"]).name  # files of text need no other
    verdict = corpus.run(spark, docs, args.out, rules, args.start, pages=args.pages, parser=parser)
    print(verdict)
    return int(verdict == "FAIL")


if __name__ == "__main__":
    sys.exit(main())
