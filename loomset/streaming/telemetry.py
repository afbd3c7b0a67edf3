"""Training telemetry as Structured Streaming queries.

Both queries work on whole micro-batches, so the batch operators split hot runs and no task holds a run. A
micro-batch that is repeated after a failure writes the same folders again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from loomset.operators.telemetry import CHUNK_STEPS, MIN_DELTA, PATIENCE, early_stopping_states, progress_projection
from loomset.session import drop_path, join_lookup
from loomset.sources.readers import numbered_folders
from loomset.streaming.jobs import start_batches

STATES = "run_id {kind}, best_loss double, wait_count bigint, stop_step bigint"


def _state_paths(spark: SparkSession, states: str, before: int) -> list[str]:
    """Folders of the states left by micro-batches before this one, oldest first."""
    return [path for n, path in numbered_folders(spark, states, "batch=") if n < before]


def run_states(spark: SparkSession, states: str, kind: str = "string", before: int = 1 << 62) -> DataFrame:
    """Best loss, wait and first step that asked to stop, per run, after the micro-batches so far."""
    schema = STATES.format(kind=kind)
    paths = _state_paths(spark, states, before)
    return spark.read.schema(schema).parquet(paths[-1]) if paths else spark.createDataFrame([], schema)


def start_early_stopping(
    events: DataFrame,
    out: str,
    states: str,
    checkpoint: str,
    patience: int = PATIENCE,
    min_delta: float = MIN_DELTA,
    chunk_steps: int = CHUNK_STEPS,
    once: bool = False,
) -> StreamingQuery:
    """Write the state after every evaluation to ``out``, as :func:`early_stopping_states` gives it.

    Inside a micro-batch evaluations go by step, across micro-batches in order of arrival. ``states`` holds
    one row per run, rewritten by every micro-batch from the one before it; the last two are kept.
    """
    kind = events.schema["run_id"].dataType.simpleString()

    def advance(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = run_states(spark, states, kind, number)
        rows = f"{out}/batch={number}"
        early_stopping_states(batch, patience, min_delta, chunk_steps, start=before).write.mode("overwrite").parquet(rows)
        last = spark.read.parquet(rows).groupBy("run_id").agg(
            F.max_by("best_loss", "step").alias("_best"),
            F.max_by("wait_count", "step").alias("_wait"),
            F.min(F.when(F.col("should_stop"), F.col("step"))).alias("_stop"),
        )
        here = F.col("_wait").isNotNull()
        after = before.join(last, "run_id", "full").select(
            "run_id",
            F.when(here, F.col("_best")).otherwise(F.col("best_loss")).alias("best_loss"),
            F.coalesce("_wait", "wait_count").alias("wait_count"),
            F.coalesce("stop_step", "_stop").alias("stop_step"),
        )
        after.write.mode("overwrite").parquet(f"{states}/batch={number}")
        for path in _state_paths(spark, states, number)[:-1]:
            drop_path(spark, path)

    return start_batches(events, advance, checkpoint, once)


def start_progress(
    events: DataFrame, runs: Callable[[], DataFrame], every: int, out: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Write progress rows to ``out``. ``runs()`` gives the table ``(run_id, start_ts, total_steps)`` and is called
    for every micro-batch, so runs that were added since have elapsed time and time to go.

    Events of runs that the table lacks stay, without elapsed time, total and time to go.
    """

    def advance(batch: DataFrame, number: int) -> None:
        rows = progress_projection(join_lookup(batch, runs(), ["run_id"]), every)
        rows.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return start_batches(events, advance, checkpoint, once)


def batches_written(spark: SparkSession, out: str, schema: T.StructType | str) -> DataFrame:
    """The rows that all micro-batches so far wrote to ``out``."""
    paths = [path for _, path in numbered_folders(spark, out, "batch=")]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
