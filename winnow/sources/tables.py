"""Stored tables: annotation files, checkpoints and written outputs
(SRC-6..9, SNK-1, SNK-3..7).

Parquet is the primary format (typed, column-pruned, predicate-pushdown).
CSV exports are written as a folder of part files by all tasks in parallel;
nothing is funnelled through one task or the driver. Every part file begins with
a byte-order mark (the first header name carries it), as spreadsheets expect; the
readers here take it off.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import FLAGGED_HEADERS, RECORD_HEADERS
from ..functions.nulls import lenient_double
from .exports import BYTE_ORDER_MARK, read_export

# FIXED VALUE: run-folder stamp format.
RUN_STAMP = "run_%b-%d-%Y_%Hh%M"


def resolve_first(spark: SparkSession, pattern: str, default: str) -> str:
    """SRC-6: the first path, in sorted order, matching a glob; ``default``
    when nothing matches. A match is a path as it stands: a folder of part
    files is one match and is read whole."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    names = sorted(s.getPath().toString() for s in found or [])
    return names[0] if names else default


def read_annotated(spark: SparkSession, path: str | Sequence[str], tag_columns: Sequence[str]) -> DataFrame:
    """SRC-7: the annotated table. Export headers (Title, Year, Source, ...)
    map back to the operators' column names; tag cells are parsed leniently
    to doubles (``1``, ``1.0`` -> 1.0; ``1.7`` stays 1.7 and is no 1; blank or
    text -> null) and are truncated only by the tables that do so (N11); other
    columns stay text."""
    df = from_export_headers(read_export(spark, path))
    return df.withColumns({c: lenient_double(F.col(f"`{c}`")) for c in tag_columns if c in df.columns})


def read_flagged_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """A flagged table exported as CSV, typed again: headers mapped back,
    ``row_id`` and ``dup_group_size`` to long, the two flags to boolean, the year kept as
    text (a CSV round trip would otherwise leave everything text, and the
    keys must not change)."""
    df = from_export_headers(read_export(spark, path))
    typed = {c: F.col(c).try_cast("long") for c in ("row_id", "dup_group_size")}
    # normalised fields are never null ('' when missing); the CSV reader turns '' into null
    typed |= {c: F.coalesce(F.col(c), F.lit("")) for c in ("doi_norm", "title_norm", "year")}
    for flag in ("flag_duplicate", "flag_review_conf"):
        typed[flag] = F.lower(F.col(flag)) == F.lit("true")
    return df.withColumns({k: v for k, v in typed.items() if k in df.columns})


def committed(spark: SparkSession, path: str) -> bool:
    """Whether a write of a table to ``path`` has succeeded (its mark is there): a
    folder that a failed write left is no table."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a table at ``path``; any trouble but a missing path is raised."""
    try:
        spark.read.parquet(path).schema  # noqa: B018 - resolves the path only
        return True
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


RULES_VERSION = 2  # of the identification rules: stored tables of other versions are not reused


def fingerprint(*parts: object) -> str:
    """A short stable id of the inputs a checkpoint was built from."""
    return hashlib.sha1("\x1f".join(map(str, parts)).encode()).hexdigest()[:16]


def input_fingerprint(spark: SparkSession, *inputs: str | Sequence[str]) -> str:
    """Fingerprint of input files: path, length and time of change of each, as
    Spark lists them (no content is read), and the version of the rules."""
    parts = [RULES_VERSION]
    for paths in inputs:
        files = spark.read.format("binaryFile").load([paths] if isinstance(paths, str) else list(paths))
        parts.append(files.select("path", "length", "modificationTime")
                     .agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first())
    return fingerprint(*map(tuple, parts[1:]), parts[0])


def read_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame],
                  key: str | None = None) -> DataFrame:
    """SRC-8: compute once, reload later. With ``key`` (see ``fingerprint``)
    the table lives under ``path/fp=<key>``, so changed inputs rebuild."""
    target = f"{path.rstrip('/')}/fp={key}" if key else path
    if not committed(spark, target):
        build().write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def read_scores(spark: SparkSession, path: str, labels: Sequence[str]) -> DataFrame:
    """SRC-9: a stored score table; raises when a requested label column is
    missing (stale checkpoint)."""
    df = spark.read.parquet(path)
    missing = [l for l in labels if l not in df.columns]
    if missing:
        raise RuntimeError(f"Stale scores in {path}: no column for {missing}")
    return df


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """SNK-1 / SNK-5: Parquet table."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_scores(df: DataFrame, path: str) -> None:
    """SNK-7: a score table is never overwritten silently."""
    df.write.mode("errorifexists").parquet(path)


def with_export_headers(df: DataFrame) -> DataFrame:
    """Record / flag columns renamed to the export headers (Title, DOI_norm, ...)."""
    names = {**RECORD_HEADERS, **FLAGGED_HEADERS}
    return df.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in df.columns])


def from_export_headers(df: DataFrame) -> DataFrame:
    """Inverse of ``with_export_headers``: Title, DOI_norm, ... back to the
    column names the operators use (a CSV round trip keeps the headers)."""
    back = {v: k for k, v in {**RECORD_HEADERS, **FLAGGED_HEADERS}.items()}
    return df.select(*[F.col(f"`{c}`").alias(back.get(c, c)) for c in df.columns])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", headers: bool = True, mark: bool = True) -> None:
    """SNK-1 / SNK-3 / SNK-6: CSV folder with a header row, UTF-8, by default with
    a byte-order mark at the start of each file."""
    out = with_export_headers(df) if headers else df
    if mark and out.columns:
        out = out.toDF(BYTE_ORDER_MARK + out.columns[0], *out.columns[1:])
    (out.write.mode(mode).option("header", True).option("escape", '"').option("encoding", "UTF-8")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def run_folder(base: str, now: datetime | None = None) -> str:
    """SNK-4: ``<base>/run_<Mon-DD-YYYY_HHhMM>``; created by the first write."""
    return f"{base.rstrip('/')}/{(now or datetime.now()).strftime(RUN_STAMP)}"
