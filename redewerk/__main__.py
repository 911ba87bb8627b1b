"""Command line: ``python -m redewerk build | clean | query``. Ends with 0, 1 if there is no input or the output exists, 2 if no record came out."""

from __future__ import annotations

import argparse
import sys

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import catalog
from .operators import cleaning, dataset
from .plans.build import Options, build
from .session import session
from .sources import files, sinks


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("redewerk")
    sub = p.add_subparsers(dest="command", required=True)
    b = sub.add_parser("build", help="transcripts and minutes to chat records, rejects and summary")
    b.add_argument("--transcripts", required=True)
    b.add_argument("--minutes", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--granularity", choices=("per-top", "document"), default="per-top")
    b.add_argument("--include-untagged-as-document", action="store_true")
    b.add_argument("--val-frac", type=float, default=0.1)
    b.add_argument("--min-tgt-tokens", type=int, default=32)
    b.add_argument("--match-threshold", type=float, default=90.0)
    b.add_argument("--max-seq-len", type=int, default=65536)
    b.add_argument("--val-max-seq-len", type=int, default=8192)
    b.add_argument("--seed", type=int, default=42)
    b.add_argument("--holdout-manifest")
    b.add_argument("--holdout-stems", nargs="*", default=[])
    b.add_argument("--exclusions")
    b.add_argument("--institutions", nargs="*", default=[])
    b.add_argument("--overwrite", action="store_true")
    c = sub.add_parser("clean", help="minutes to cleaned bodies")
    c.add_argument("--minutes", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--institutions", nargs="*", default=[])
    c.add_argument("--overwrite", action="store_true")
    q = sub.add_parser("query", help="a registered query over a folder of tables")
    q.add_argument("name", choices=sorted(catalog.queries()))
    q.add_argument("--tables", required=True)
    q.add_argument("--out", required=True)
    q.add_argument("--overwrite", action="store_true")
    return p


def named_texts(spark: SparkSession, path: str) -> DataFrame:
    """(stem, text) of the Markdown files of a folder; the stem is the file's name without its ending."""
    d = files.whole_texts(spark, path).where(F.lower("path").endswith(".md"))
    return d.select(F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"(?i)\.md$", "").alias("stem"), "text")


def run_build(spark: SparkSession, a: argparse.Namespace) -> int:
    t, m = named_texts(spark, a.transcripts), named_texts(spark, a.minutes)
    if t.isEmpty() or m.isEmpty():
        return 1
    stems = spark.createDataFrame([(x,) for x in a.holdout_stems], "stem string")
    held = files.manifest(spark, a.holdout_manifest, a.holdout_stems) if a.holdout_manifest else stems
    ex = dataset.exclusion_rows(files.exclusions(spark, a.exclusions)) if a.exclusions else spark.createDataFrame([], "stem string, top int")
    o = Options(
        granularity=a.granularity, include_untagged=a.include_untagged_as_document, share=a.val_frac, min_words=a.min_tgt_tokens, cap=a.max_seq_len, val_cap=a.val_max_seq_len, seed=a.seed, threshold=a.match_threshold,
        institutions=tuple(a.institutions),
    )
    b = build(t, m, held, ex, o)
    if b.records.isEmpty():
        return 2
    sinks.write_jsonl(b.records, f"{a.out}/records", a.overwrite)
    sinks.write_tsv(b.rejects.unionByName(b.recovered), f"{a.out}/rejects", ["reason", "stem", "top"], a.overwrite)
    sinks.write_tsv(b.summary, f"{a.out}/summary", ["split"], a.overwrite)
    return 0


def run(spark: SparkSession, argv: list[str]) -> int:
    """Runs a command; input that can't be read and output that exists are 1."""
    try:
        a = parser().parse_args(argv)
    except SystemExit as e:
        return 0 if e.code == 0 else 1
    try:
        if a.command == "build":
            return run_build(spark, a)
        if a.command == "clean":
            m = cleaning.clean_minutes(named_texts(spark, a.minutes), institutions=a.institutions)
            if m.isEmpty():
                return 1
            m.select("stem", "cover", "body", "matched").write.mode("overwrite" if a.overwrite else "errorifexists").parquet(a.out)
            # minutes without the heading of the decisions have no body
            return 2 if not m.where("not matched").isEmpty() else 0
        catalog.queries()[a.name](spark, a.tables).write.mode("overwrite" if a.overwrite else "errorifexists").parquet(a.out)
        return 0
    except AnalysisException as e:
        print(e.getMessage(), file=sys.stderr)
        return 1


def main() -> int:
    return run(session(), sys.argv[1:])


if __name__ == "__main__":
    raise SystemExit(main())
