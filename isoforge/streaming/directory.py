"""Directory mode as a stream: files are taken up once each, and a run ends when all that is there is done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from isoforge.operators.sinks import WriterOptions
from isoforge.plans.etl import build_table
from isoforge.sources.entries import ROW_TAG, entry_texts, parse_xml
from isoforge.sources.tables import COLUMNS


def stream_entries(spark: SparkSession, directory: str, files_per_batch: int = 64) -> DataFrame:
    reader = spark.readStream.option("lineSep", f"<{ROW_TAG}").option("pathGlobFilter", "*.{xml,xml.gz}")
    return parse_xml(entry_texts(reader.option("maxFilesPerTrigger", files_per_batch).text(directory)), "value")


def stream_table(spark: SparkSession, directory: str, target: str, checkpoint: str, sidecar: DataFrame | None = None, strict: bool = False, options: WriterOptions = WriterOptions(), files_per_batch: int = 64) -> StreamingQuery:
    """Appends the table of new files to target. A batch that is run again after a failure replaces its own partition, so no row is doubled."""

    def write(batch: DataFrame, number: int) -> None:
        out = build_table(batch, sidecar, strict).select(*COLUMNS)
        options.apply(out.write.mode("overwrite")).parquet(f"{target.rstrip('/')}/batch={number}")

    query = stream_entries(spark, directory, files_per_batch).writeStream.foreachBatch(write)
    return query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
