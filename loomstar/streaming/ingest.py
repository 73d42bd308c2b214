"""Incremental ingestion of arriving source files with the same cleaners.

The reference has no streaming operators (every flow is a finite read and one
write).  Its sources, however, arrive as folders of documents; this module lets
the batch cleaners run incrementally over such a folder with Structured
Streaming: each trigger picks up only new files, applies a row-local cleaner
(``DataFrame -> DataFrame``) and appends Parquet.  Progress lives in a
checkpoint under the shared checkpoint folder, so a restarted or failed job
resumes without reprocessing or losing files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from loomstar.session import scratch_path


def clean_arrivals(spark: SparkSession, source_dir: str, schema: T.StructType | str,
                   cleaner: Callable[[DataFrame], DataFrame], sink_dir: str, *,
                   fmt: str = "json", checkpoint_dir: str | None = None,
                   available_now: bool = True, max_files_per_trigger: int | None = None,
                   options: dict[str, str] | None = None) -> StreamingQuery:
    """Start a stream: new files in ``source_dir`` -> ``cleaner`` -> Parquet in ``sink_dir``.

    ``cleaner`` must be row-local (all loomstar cleaners except de-duplication
    are).  With ``available_now`` the query processes what is there and stops.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    cleaned = cleaner(reader.load(source_dir))
    writer = (cleaned.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint_dir or scratch_path(spark, "stream-checkpoint")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(sink_dir)
