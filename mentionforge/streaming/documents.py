"""Documents as they arrive: the batch operators behind Structured Streaming. An extension, not parity: a checkpoint
takes the place of skipping what has an output already."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def read_stream(spark: SparkSession, folder: str, schema: str = "doc_id string, text string", files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder)


def process_stream(docs: DataFrame, process: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Applies a batch operator to each micro-batch. A batch writes to its own folder and replaces it if it is run
    again, so every document's records are there once."""

    def batch(df: DataFrame, number: int) -> None:
        process(df).write.mode("overwrite").json(f"{out}/batch={number}")

    return docs.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
