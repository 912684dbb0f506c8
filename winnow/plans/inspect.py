"""Plan inspection: what a query's executed plan shuffles, broadcasts and scans.

    python -m winnow.plans.inspect [sf_dir] > PLANS.md
"""

from __future__ import annotations

import re
import sys

from pyspark.sql import DataFrame


def executed_plan(df: DataFrame, final: bool = True) -> str:
    """The physical plan text; with AQE, the final adaptive plan (run ``df``
    first to get it)."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0] if final else text


def summary(df: DataFrame) -> dict:
    """Counts of the plan nodes that matter at scale."""
    p = executed_plan(df)
    scans = re.findall(r"FileScan (\w+) \[([^\]]*)\][^\n]*?Location: \w+\(\d+ paths\)\[([^\]]*)\]", p)
    return {
        "hash_exchanges": len(re.findall(r"^(?!.*ReusedExchange).*Exchange hashpartitioning", p, re.M)),
        "range_exchanges": len(re.findall(r"^(?!.*ReusedExchange).*Exchange rangepartitioning", p, re.M)),
        "single_partition_exchanges": len(re.findall(r"^(?!.*ReusedExchange).*Exchange SinglePartition", p, re.M)),
        "broadcasts": len(re.findall(r"^(?!.*ReusedExchange).*BroadcastExchange", p, re.M)),
        "reused_exchanges": p.count("ReusedExchange"),
        "scans": [(fmt, path.rsplit("/", 1)[-1], cols) for fmt, cols, path in scans],
        "sort_aggregates": p.count("SortAggregate"),
        "hash_aggregates": p.count("HashAggregate"),
        "windows": len(re.findall(r"\bWindow \[", p)),
        "take_ordered": p.count("TakeOrderedAndProject"),
        "python": p.count("BatchEvalPython") + p.count("ArrowEvalPython") + p.count("MapInPandas"),
        "joins": re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", p),
    }


def main(argv: list[str]) -> None:
    import os

    sys.path.insert(0, os.getcwd())
    from winnow.plans.catalog import QUERIES
    from winnow.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    spark = local_session(8, shuffle_partitions=16)
    print(f"# Executed plans of the registered queries ({sf_dir}, local[8], AQE on)\n")
    print("Final adaptive plans after one run. `hash`/`range`/`single` = shuffle exchanges, "
          "`bcast` = broadcast exchanges, `reused` = exchanges shared inside the query.\n")
    print("| query | hash | range | single | bcast | reused | joins | aggregates | windows | scans (columns read) |")
    print("|---|---|---|---|---|---|---|---|---|---|")
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        df.collect()  # run this DataFrame's own execution so the final adaptive plan exists
        s = summary(df)
        joins = ", ".join(sorted(set(s["joins"]))) or "-"
        aggs = f"hash {s['hash_aggregates']}, sort {s['sort_aggregates']}"
        scans = "; ".join(f"{t}: {c}" for _, t, c in s["scans"])
        print(f"| {name} | {s['hash_exchanges']} | {s['range_exchanges']} | {s['single_partition_exchanges']} | "
              f"{s['broadcasts']} | {s['reused_exchanges']} | {joins} | {aggs} | {s['windows']} | {scans} |")
    print(SCALE_NOTES)
    spark.stop()


SCALE_NOTES = """
## What changes at 100 TB

* `labels` is then far above the broadcast limit: where tags are used, the
  fixture join becomes a sort-merge join on `row_id` (unique on both sides, no
  hot key). Text-derived columns are computed before it, so no document text
  crosses it. Queries without tags read `documents` alone.
* `flag_duplicates`: one `groupBy` on the key's 256-bit digest with partial
  aggregation, joined back on the digest. The count side has one row a key, so
  a hot key is a skewed left side that adaptive execution splits. In this
  query both reads share one exchange of the narrow keyed rows (`reused`).
* Survivors (`keep_first`, template, scoring inputs): the least `row_id` per
  digest is a hash aggregate (a hot key costs one row a map task), then a
  semi-join on the unique `row_id`. No sort aggregate, no long text key in a
  shuffle or sort. The records are scanned twice.
* Report tables: one partial aggregate per map task and a single final row;
  `venn_regions` groups by the region (at most 2^k groups) and joins the list of
  all regions, one row each, with an ordinal computed from its own bits;
  `inclusive_overlaps` folds eight labels a step, one exchange each;
  `category_counts_by_source` has one group for each listed source and ranks
  labels by their place in one sorted array.
* `cooccurrence` reads the table once for all dimensions and counts the pairs that
  rows hold. `cooccurrence_bitmaps` shuffles bitmaps (4 KB a label and 32,768
  rows at most), intersects them where a bucket's row is, and shuffles counts;
  `temporal_trends` groups by a handful of years. `multi_value_counts` ends
  in a range sort, for its values are free text.
* `prisma_flow`: two one-row aggregates meet in one row, from which all boxes
  and the check are read.
* `harmonise_sources`: one scan; rows are numbered in cells of consecutive old
  ids, cells are counted from two narrow columns. Nothing runs while the query
  is built. CSV exports use file order: one checkpoint and a table of one row
  a file and split, with offsets in two levels.
* Scoring family (`two_dimension_tags`, `score_screen`, `max_score_bands`, sheets):
  scores leave a generator (`computed_once`), through which no filter is pushed, so
  each holds seven intersections and the normalisation of `keep_first`. The range sort of
  `borderline_sheet` reads an exchange of its rows for both passes.
* `stored_scores`: the store is bucketed by candidate digest; candidates are shuffled
  once to its buckets, the store is not. `identification_in_batches`: the key table is
  bucketed; a batch's keys are shuffled to it, and known keys are written where they are.
  Records join it by digest with skew splitting.
* `top_labels_indexed`: title words meet label words by hash join (a frequent word is a
  skewed left side); the best k of a title are cut before and after the exchange by id.
* `excluded_sample`, `sample_sheet`: a per-task top-30 merged on the driver.
  `score_labels_cosine` takes its label table as a scalar subquery.
"""


if __name__ == "__main__":
    main(sys.argv[1:])
