"""Running a streaming table to a file sink."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from loomset.operators.scoring import Factory, GenerationOptions, generate
from loomset.session import scratch_path


def start_file_sink(stream: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append a stream to parquet files, exactly once per input row by the checkpoint."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def start_batches(
    stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Call ``work(rows, number)`` for every micro-batch; the same number comes again after a failure."""
    writer = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def drain(stream: DataFrame, label: str) -> DataFrame:
    """Process everything available now, stop, and return what was written."""
    spark = stream.sparkSession
    path = scratch_path(spark, label)
    start_file_sink(stream, path, f"{path}-checkpoint", once=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def score_stream(
    prompts: DataFrame, factory: Factory, options: GenerationOptions = GenerationOptions(), batch_size: int = 4
) -> DataFrame:
    """Generation over a stream of prompts; start it with :func:`start_file_sink`."""
    return generate(prompts, factory, options, batch_size)
