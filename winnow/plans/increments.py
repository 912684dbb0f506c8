"""Identification of export files that arrive over time (SRC-8, DED-2, DED-3).

A folder holds the state: a manifest of the files read, the keyed records of every
batch, and a key table with one row a key (its digest, how many rows have it, how
many of them are flagged papers, its first row and its first clean row). A batch
reads only files that the manifest lacks and merges only their keys: the key table
is bucketed by digest and doesn't move, nothing is normalised again.

Rows are ordered by source, file path and place in the file, as one run over all
files orders them, so ``flagged`` gives the same table, row ids included, whatever the
batches were. A batch counts once its manifest is written, last; what a failed batch
left is overwritten by the next. A file that has changed since it was read is an
error. No batch, row or key is held on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.constants import SOURCES
from ..functions.text import dedup_key
from ..operators import identify as ident
from ..operators.skew import key_digest
from ..session import checkpoint
from ..sources import buckets, exports
from ..sources.tables import committed

MANIFEST = "batch int, source_ordinal int, file string, path string, length long, changed timestamp, rows long"
STATE_BUCKETS = 64
PLACE = ["source_ordinal", "file", "pos"]


def _place() -> Column:
    return F.struct(*PLACE)


class Increments:
    """The state under ``path``."""

    def __init__(self, spark: SparkSession, path: str, state_buckets: int = STATE_BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), state_buckets

    # --- what there is ------------------------------------------------------

    def batches(self) -> int:
        """Committed batches; they are numbered 1..n."""
        n = 0
        while committed(self.spark, f"{self.path}/manifest/batch={n + 1}"):
            n += 1
        return n

    def manifest(self) -> DataFrame:
        paths = [f"{self.path}/manifest/batch={i}" for i in range(1, self.batches() + 1)]
        return self.spark.read.schema(MANIFEST).parquet(*paths) if paths else self.spark.createDataFrame([], MANIFEST)

    def records(self) -> DataFrame:
        """The keyed records of all batches."""
        return self.spark.read.parquet(*[f"{self.path}/records/batch={i}" for i in range(1, self.batches() + 1)])

    def keys(self) -> DataFrame:
        """(key_digest, n, flagged, least, least_clean): one row a key."""
        return buckets.read(self.spark, f"{self.path}/keys/version={self.batches()}")

    # --- a batch ------------------------------------------------------------

    def _listing(self, paths: str | Sequence[str] | None, ordinal: int) -> DataFrame | None:
        if not paths:
            return None
        files = self.spark.read.format("binaryFile").load([paths] if isinstance(paths, str) else list(paths))
        return files.select(F.lit(ordinal).alias("source_ordinal"), "path", "length", F.col("modificationTime").alias("changed"))

    def ingest(self, pubmed: str | Sequence[str] | None = None, scopus: str | Sequence[str] | None = None,
               ieee: str | Sequence[str] | None = None) -> int:
        """Read the files that are new below the given paths as one batch; how many
        files that were."""
        given = dict(zip(SOURCES, (pubmed, scopus, ieee)))
        found = [x for i, p in enumerate(given.values()) if (x := self._listing(p, i)) is not None]
        if not found:
            return 0
        listed = found[0]
        for x in found[1:]:
            listed = listed.unionByName(x)
        old = self.manifest().select("source_ordinal", "path", F.col("length").alias("_l"), F.col("changed").alias("_c"))
        files = checkpoint(listed.join(old, ["source_ordinal", "path"], "left"))
        changed = (F.col("length") != F.col("_l")) | (F.col("changed") != F.col("_c"))
        # names of this batch's files alone pass the driver; the reader takes a list of paths
        open_files = files.filter(F.col("_l").isNull() | changed).select("source_ordinal", "path", F.col("_l").isNotNull().alias("known")).collect()
        if bad := [r["path"] for r in open_files if r["known"]]:
            raise RuntimeError(f"files changed since they were read: {bad[:3]}")
        new = files.filter(F.col("_l").isNull()).drop("_l", "_c")
        todo = {s: sorted(r["path"] for r in open_files if r["source_ordinal"] == i) for i, s in enumerate(SOURCES)}
        count = sum(map(len, todo.values()))
        if count:
            self._commit(self.batches() + 1, todo, new)
        return count

    def _commit(self, batch: int, todo: dict[str, list[str]], files: DataFrame) -> None:
        spark = self.spark
        rows = None
        for source, adapt in zip(SOURCES, (exports.adapt_pubmed, exports.adapt_scopus, exports.adapt_ieee)):
            if todo[source]:
                part = adapt(exports.read_export(spark, todo[source]))
                rows = part if rows is None else rows.unionByName(part)
        numbered = exports.assign_row_ids(rows, segment_by=["_source_ordinal", "_file"])
        numbered = numbered.withColumnsRenamed({"_source_ordinal": "source_ordinal", "_file": "file"})
        first = numbered.groupBy("source_ordinal", "file").agg(F.min("row_id").alias("_first"), F.count(F.lit(1)).alias("rows"))
        placed = numbered.join(first.drop("rows"), ["source_ordinal", "file"]).withColumn("pos", F.col("row_id") - F.col("_first"))
        keyed = ident.normalise(placed)
        # rows without title and DOI have a key of their own, by place
        own = F.concat_ws(":", "source_ordinal", "file", "pos")
        keyed = ident.flag_secondary(keyed.withColumn("_key", dedup_key("doi_norm", "title_norm", "year", own)))
        at = f"{self.path}/records/batch={batch}"
        (keyed.withColumn(buckets.KEY, key_digest("_key")).drop("_key", "row_id", "_first").write.mode("overwrite").parquet(at))
        stored = spark.read.parquet(at)
        clean = F.when(~F.col("flag_review_conf"), _place())
        mine = stored.groupBy(buckets.KEY).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("flag_review_conf").cast("long")).alias("flagged"),
                                               F.min(_place()).alias("least"), F.min(clean).alias("least_clean"))
        self._merge(batch, mine)
        sizes = stored.groupBy("source_ordinal", "file").agg(F.count(F.lit(1)).alias("rows"))
        # a listed path and the path that a scan reports differ in how the scheme is written
        short = "^[a-z]+:/+"
        files = files.withColumn("_p", F.regexp_replace("path", short, "/"))
        sizes = sizes.withColumn("_p", F.regexp_replace("file", short, "/"))
        done = files.join(sizes, ["source_ordinal", "_p"], "left").select(
            F.lit(batch).alias("batch"), "source_ordinal", F.coalesce("file", "path").alias("file"), "path", "length", "changed",
            F.coalesce("rows", F.lit(0)).cast("long").alias("rows"))
        done.write.mode("overwrite").parquet(f"{self.path}/manifest/batch={batch}")

    def _merge(self, batch: int, mine: DataFrame) -> None:
        """The next version of the key table: known keys changed where they are, new ones added."""
        at = f"{self.path}/keys/version={batch}"
        if batch == 1:
            buckets.write(mine, at, buckets=self.buckets)
            return
        mine = checkpoint(mine)
        old = buckets.read(self.spark, f"{self.path}/keys/version={batch - 1}")
        here = mine.select(F.col(buckets.KEY), *[F.col(c).alias(f"_{c}") for c in ("n", "flagged", "least", "least_clean")])
        both = old.join(here, buckets.KEY, "left").select(
            buckets.KEY, (F.col("n") + F.coalesce("_n", F.lit(0))).alias("n"), (F.col("flagged") + F.coalesce("_flagged", F.lit(0))).alias("flagged"),
            F.least("least", "_least").alias("least"), F.least("least_clean", "_least_clean").alias("least_clean"))
        n = buckets.buckets_of(self.spark, f"{self.path}/keys/version={batch - 1}")
        buckets.write(both, at, buckets=n, placed=True)
        buckets.write(mine.join(old.select(buckets.KEY), buckets.KEY, "left_anti"), at, buckets=n, mode="append")

    # --- what follows from the state ----------------------------------------

    def _numbered(self) -> DataFrame:
        """Files with the row id of their first row, in the order of one run."""
        files = self.manifest()
        sizes = files.groupBy("source_ordinal").agg(F.sum("rows").alias("n")).agg(
            F.map_from_entries(F.collect_list(F.struct("source_ordinal", "n"))).alias("m")).scalar()  # an entry a source
        start = F.aggregate(F.map_entries("_sizes"), F.lit(0).cast("long"),
                            lambda a, e: a + F.when(e["key"] < F.col("source_ordinal"), e["value"]).otherwise(F.lit(0)))
        before = F.sum("rows").over(Window.partitionBy("source_ordinal").orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
        return (files.withColumns({"_before": F.coalesce(before, F.lit(0)), "_sizes": sizes})
                .select("source_ordinal", "file", (start + F.col("_before")).alias("_first")))

    def flagged(self) -> DataFrame:
        """The flagged table of all batches, as ``identify`` gives it for one run."""
        rows = self.records().join(self._numbered(), ["source_ordinal", "file"])
        rows = ident.add_dedup_key(rows.withColumn("row_id", F.col("_first") + F.col("pos")))
        rows = rows.join(self.keys().select(buckets.KEY, F.col("n").alias("dup_group_size")), buckets.KEY)
        return rows.withColumn("flag_duplicate", F.col("dup_group_size") > 1).select(*ident.FLAGGED_COLUMNS)

    def survivors(self) -> DataFrame:
        """The first clean row of every key, (row_id and the record columns)."""
        least = self.keys().filter(F.col("least_clean").isNotNull()).select("least_clean.*")
        rows = self.records().join(least, PLACE, "left_semi").join(self._numbered(), ["source_ordinal", "file"])
        rows = ident.add_dedup_key(rows.withColumn("row_id", F.col("_first") + F.col("pos")))
        return rows.select("row_id", "dedup_key", "title", "authors", "year", "doi", "source")

    def summary(self) -> DataFrame:
        """AGG-5 from the manifest and the key table alone: (ordinal, metric, value)."""
        files = self.manifest().agg(*[F.coalesce(F.sum(F.when(F.col("source_ordinal") == i, F.col("rows"))), F.lit(0)).alias(s)
                                      for i, s in enumerate(("pubmed", "scopus", "ieee"))])
        keys = self.keys().agg(F.count(F.lit(1)).alias("papers"), F.count_if(F.col("flagged") > 0).alias("excluded"))
        row = files.unionByName(keys, allowMissingColumns=True)
        row = row.agg(*[F.max(c).alias(c) for c in row.columns])
        total = F.col("pubmed") + F.col("scopus") + F.col("ieee")
        boxes = [("pubmed", F.col("pubmed")), ("scopus", F.col("scopus")), ("ieee", F.col("ieee")), ("total_raw", total),
                 ("duplicates_removed", total - F.col("papers")), ("dedup_papers", F.col("papers")), ("excluded_rev_conf", F.col("excluded")),
                 ("kept", F.col("papers") - F.col("excluded"))]
        return row.select(F.inline(F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(m).alias("metric"), v.cast("long").alias("value"))
                                             for i, (m, v) in enumerate(boxes)])))
