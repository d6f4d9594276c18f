"""A stream of JSON rows into a table: each micro-batch becomes files and catalog rows, as ingest.append writes them."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import valuetypes as V
from tidemark.sources import ingest
from tidemark.sources.ingest import Transform
from tidemark.sources.tables import Table


def stream_rows(spark: SparkSession, folder: str, row: V.Struct, transform: Transform | None = None) -> DataFrame:
    """JSON lines that appear in a folder, as rows. Appending keeps no state, so rows of any age are taken."""
    lines = spark.readStream.text(folder).where(F.trim("value") != "")
    return ingest.decoded(lines, F.col("value"), row, transform or Transform())


def append_stream(rows: DataFrame, table: Table, data_path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Start appending. Files are written before the catalog names them, so a batch that failed half way is not seen.

    A batch is known by the stream's checkpoint and its number, so one that is run again replaces what it wrote.
    """
    stream = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]

    def write(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            ingest.append(batch.sparkSession, table, batch, data_path, name=f"{stream}-{number}")

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
