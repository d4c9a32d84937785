"""Continuous landing of arriving delimited files with Structured Streaming.

The batch ingestion (``periodica.sources.ingest``) claims files and keeps a
manifest of landed ones, and so does the stream: its checkpoint offers every file
to one micro-batch, and the manifest tells which files of a replayed micro-batch
have landed. Each micro-batch goes through the same typed conversion and
the same append of accepted rows (and rejects) as a batch ingestion.

``Trigger.AvailableNow`` processes everything present and stops, which is how a
scheduled job drains the drop folder; a long-running query can use a
processing-time trigger instead.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodica.session import shared_path
from periodica.sources.claims import end_run
from periodica.sources.files import CORRUPT_COL
from periodica.sources.ingest import claim, convert, land_files, load_timestamp, publish
from periodica.sources.tables import Lake
from periodica.spec import SOURCE_FILE_COL, IngestSpec


def file_stream(spark: SparkSession, folder: str, spec: IngestSpec,
                max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming scan of the drop folder: text cells in the spec's header
    order. ``enforceSchema=false`` makes Spark check every file's header
    against those names, so a file with another layout fails loudly instead
    of being read by position."""
    names = [src for src, _ in spec.column_map]
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names]
                          + [T.StructField(CORRUPT_COL, T.StringType(), True)])
    glob = "*.csv" if spec.file_type == "csv" else "*"
    return (spark.readStream.schema(schema)
            .option("sep", spec.delimiter).option("header", True)
            .option("encoding", spec.encoding).option("enforceSchema", False)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COL)
            .option("quote", "\u0000")
            .option("pathGlobFilter", glob).option("maxFilesPerTrigger", max_files_per_trigger)
            .csv(folder)
            .withColumn(SOURCE_FILE_COL, F.input_file_name()))


def _batch_writer(spark: SparkSession, lake: Lake, spec: IngestSpec, landing: str):
    def write(batch: DataFrame, epoch_id: int) -> None:
        # the same conversion, claims and append as a batch ingestion: a replayed
        # micro-batch, or one with files that a batch has landed, writes nothing twice
        at = load_timestamp(dt.datetime.now())
        typed = convert(batch, spec, at, at.date())
        mine = claim(spark, lake, spec, typed.select(F.col(SOURCE_FILE_COL).alias("path")))
        if mine is None:
            return
        try:
            for run in mine.takes:
                publish(spark, lake, spec, landing, mine, run)
            rows = typed.join(mine.paths, typed[SOURCE_FILE_COL] == mine.paths["path"], "left_semi")
            land_files(spark, lake, spec, rows, landing, mine, mine.paths, at)
        finally:
            end_run(mine.run)
    return write


def land_stream(spark: SparkSession, lake: Lake, spec: IngestSpec, folder: str,
                checkpoint: str | None = None, available_now: bool = True):
    """Start (and, with ``available_now``, run to completion) the landing
    stream of one source. Returns the finished or running query."""
    landing = lake.ensure_landing_table(spec)
    checkpoint = checkpoint or shared_path(spark, "periodica", "streams", spec.landing_table)
    w = (file_stream(spark, folder, spec).writeStream
         .foreachBatch(_batch_writer(spark, lake, spec, landing))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    q = w.start()
    if available_now:
        q.awaitTermination()
        # micro-batches run in the query's own session; drop this session's
        # cached file listing of the landing so readers see the new files
        spark.catalog.refreshTable(landing)
    return q
