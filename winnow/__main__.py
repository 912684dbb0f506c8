"""Command line for the two phases (meant for ``spark-submit``):

    python -m winnow identify --pubmed P.csv --scopus S.csv --ieee I.csv --out DIR
    python -m winnow report --annotated A.csv --out DIR
    python -m winnow screen --out DIR [--scorer module:factory]

``identify`` writes the flagged table (Parquet, reused on later runs of the
same inputs), its summary tables and the annotation template (CSV).
``report`` reads the annotated template back and writes every report table
into a new run folder under ``DIR``. Paths may be any file system Spark can
read; the session comes from the submitting environment.
"""

from __future__ import annotations

import argparse
import importlib
import sys

from pyspark.sql import SparkSession

from .functions.constants import APPLICATION_LABELS, CANCER_TYPE, METHOD_LABELS, NOT_RELEVANT
from .operators import score
from .plans import workflow
from .sources import tables


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="winnow")
    sub = p.add_subparsers(dest="cmd", required=True)
    i = sub.add_parser("identify", help="exports -> flagged table, summary, annotation template")
    i.add_argument("--pubmed", nargs="+", required=True)
    i.add_argument("--scopus", nargs="+", required=True)
    i.add_argument("--ieee", nargs="+", required=True)
    i.add_argument("--out", required=True)
    r = sub.add_parser("report", help="annotated template -> report tables")
    r.add_argument("--annotated", nargs="+", required=True, help="files or folders (all are read); of a glob, the first match")
    r.add_argument("--out", required=True)
    r.add_argument("--flagged", help="flagged table of the identification run (default: the one under --out)")
    c = sub.add_parser("screen", help="flagged table -> scores, tags, screen, sheets for a reader")
    c.add_argument("--flagged", help="flagged table (default: the one under --out)")
    c.add_argument("--scorer", default="lexical", help="lexical, or module:function giving a model factory")
    c.add_argument("--out", required=True)
    for s in (i, r, c):
        s.add_argument("--methods", nargs="+", default=list(METHOD_LABELS))
        s.add_argument("--applications", nargs="+", default=list(APPLICATION_LABELS))
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"winnow-{args.cmd}").getOrCreate()
    out = args.out.rstrip("/")
    if args.cmd == "identify":
        flagged = workflow.identification(spark, args.pubmed, args.scopus, args.ieee, out_dir=out)
        written = workflow.identification_tables(flagged)
        for name, df in written.items():
            tables.write_table(df, f"{out}/{name}")
        workflow.build_template(flagged, f"{out}/template", args.methods, args.applications)
        return written
    if args.cmd == "screen":
        return _screen(spark, args, out)
    # a glob stands for its first match; listed paths are all read
    path = [tables.resolve_first(spark, p, p) if any(ch in p for ch in "*?[") else p for p in args.annotated]
    labels = [*args.methods, *args.applications, NOT_RELEVANT]
    annotated = tables.read_annotated(spark, path, labels)
    flagged = _flagged(spark, args.flagged, f"{out}/flagged")
    run_dir = tables.run_folder(out)
    return workflow.report(annotated, flagged, out_dir=run_dir, method_labels=args.methods,
                           application_labels=args.applications, category=CANCER_TYPE)


def _screen(spark: SparkSession, args: argparse.Namespace, out: str) -> dict:
    def scorer(candidates, labels):
        if args.scorer == "lexical":
            return score.with_lexical_scores(candidates, "title", labels).select("row_id", "scores")
        module, _, name = args.scorer.partition(":")
        return score.model_scores(candidates, "title", labels, getattr(importlib.import_module(module), name))

    flagged = _flagged(spark, args.flagged, f"{out}/flagged")
    if flagged is None:
        raise SystemExit(f"no flagged table under {out}; pass --flagged")
    written = workflow.score_screen(flagged, scorer, out, args.methods, args.applications)
    return written | workflow.validation(written["merged_tags"], out, args.methods)


def _flagged(spark: SparkSession, explicit: str | None, default: str):
    """The identification table for the PRISMA counts: the given path, or the
    only run stored under ``default`` (runs are kept per input fingerprint, so
    several runs there are ambiguous)."""
    if explicit:
        return spark.read.parquet(explicit)
    if not tables.table_exists(spark, default):
        return None
    root = spark.read.parquet(default)
    if "fp" in root.columns:
        runs = root.select("fp").distinct().limit(2).collect()
        if len(runs) > 1:
            raise SystemExit(f"several identification runs under {default}; pass --flagged")
        root = root.drop("fp")
    return root


if __name__ == "__main__":
    main(sys.argv[1:])
