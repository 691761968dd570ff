"""Collecting response files as they arrive. Runs are consolidated by the batch landing alone."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from jobtide.schemas import RESPONSES


def start_collecting(
    spark: SparkSession, incoming: str, responses_path: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Append newly arrived response files to the responses table, each exactly once.

    A run may be spread over any number of batches: ``plans.build.land`` reads the table, takes the runs
    it has not landed yet, and gives the same payloads as if they had come at once. Its ``settled``
    argument leaves out runs that are still being collected.
    """
    stream = spark.readStream.schema(RESPONSES).parquet(incoming)
    writer = stream.writeStream.format("parquet").option("path", responses_path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
