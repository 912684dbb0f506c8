"""Row-local identification on a streaming DataFrame.

There is no stream in the screening rules themselves; what carries over is
that normalisation, the tiered key and the flag of secondary papers are plain Column
expressions, so newly arriving records can be keyed as they land. Group sizes
and keep-first need all rows of a key and stay batch jobs over the keyed
output table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.identify import keyed

KEYED_STREAM_COLUMNS = ("row_id", "title", "authors", "year", "doi", "source", "doi_norm", "title_norm",
                        "dedup_key", "flag_review_conf")


def key_records(records: DataFrame) -> DataFrame:
    """Works on batch and streaming frames alike; ``records`` must carry a
    unique ``row_id`` (an incremental source cannot number rows densely)."""
    if "row_id" not in records.columns:
        raise ValueError("streamed records need a unique row_id column")
    return keyed(records).select(*KEYED_STREAM_COLUMNS)


def start_keying(spark: SparkSession, source_dir: str, schema: StructType | str, sink_dir: str,
                 checkpoint_location: str, source_format: str = "parquet",
                 trigger_once: bool = True) -> StreamingQuery:
    """Key every new record file under ``source_dir`` into a Parquet table at
    ``sink_dir`` (append). ``checkpoint_location`` must be a shared folder so
    the query resumes exactly once after a driver or executor loss."""
    stream = spark.readStream.schema(schema).format(source_format)
    if source_format == "csv":
        stream = stream.option("header", True).option("multiLine", True).option("escape", '"')
    out = key_records(stream.load(source_dir))
    w = (out.writeStream.format("parquet").option("path", sink_dir)
         .option("checkpointLocation", checkpoint_location).outputMode("append"))
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
