"""Batch generation with a user-supplied model, and what is computed from its output."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomset.operators.evaluate import batch_ids, task_accuracy, text_metrics
from loomset.operators.split import seeded_sample

# prompts and options -> one (text, number of generated tokens) per prompt.
Generate = Callable[[list[str], dict], list[tuple[str, int]]]
# Called once per Python worker; loads the model and returns the generate function.
Factory = Callable[[], Generate]

# Options that only matter when sampling, and the values at which others do nothing.
SAMPLING_ONLY = ["temperature", "top_p", "top_k"]
NEUTRAL = {"repetition_penalty": 1.0, "num_beams": 1}

RESULT_FIELDS = [("generated_text", T.StringType()), ("num_tokens", T.LongType()), ("generation_time", T.DoubleType())]


@dataclass(frozen=True)
class GenerationOptions:
    """The defaults of batch generation."""

    max_new_tokens: int = 256
    temperature: float = 0.7
    top_p: float = 0.9
    top_k: int = 50
    do_sample: bool = True
    repetition_penalty: float = 1.1
    num_beams: int = 1

    def call_options(self, pad_token_id: int | None = None) -> dict:
        """The options a model is called with; those without effect stay out."""
        options = asdict(self)
        idle = [name for name, neutral in NEUTRAL.items() if options[name] == neutral]
        if not self.do_sample:
            idle += SAMPLING_ONLY
        for name in idle:
            del options[name]
        options["pad_token_id"] = pad_token_id
        return options


GREEDY = GenerationOptions(do_sample=False, repetition_penalty=1.0)


def generate(
    prompts: DataFrame,
    factory: Factory,
    options: GenerationOptions = GenerationOptions(),
    batch_size: int = 4,
    prompt: str = "prompt",
    pad_token_id: int | None = None,
) -> DataFrame:
    """Adds the generated text, its token count and its share of the batch time to every row.

    Rows stay where they are and pass through as Arrow columns; each task loads the model once and
    feeds it ``batch_size`` prompts at a time. Works on a batch or streaming table.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    call = options.call_options(pad_token_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for batch in batches:
            texts, counts, times = [], [], []
            prompts_here = batch.column(prompt).to_pylist()
            for start in range(0, len(prompts_here), batch_size):
                if model is None:
                    model = factory()
                part = prompts_here[start : start + batch_size]
                began = time.perf_counter()
                answers = model(part, call)
                share = (time.perf_counter() - began) / len(part)
                if len(answers) != len(part):
                    raise ValueError(f"model returned {len(answers)} results for {len(part)} prompts")
                texts += [text for text, _ in answers]
                counts += [count for _, count in answers]
                times += [share] * len(part)
            added = {
                "generated_text": pa.array(texts, pa.string()),
                "num_tokens": pa.array(counts, pa.int64()),
                "generation_time": pa.array(times, pa.float64()),
            }
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *added.values()], names=[*batch.schema.names, *added.keys()]
            )

    schema = T.StructType(prompts.schema.fields + [T.StructField(n, t) for n, t in RESULT_FIELDS])
    return prompts.mapInArrow(run, schema)


def score_batches(
    dataset: DataFrame,
    factory: Callable[[], Callable],
    text: str = "text",
    batch_size: int = 4,
    max_length: int = 2048,
    order: str = "row_id",
) -> DataFrame:
    """``(loss, num_tokens)`` of every batch of texts, for :func:`evaluate.perplexity`.

    ``factory()`` returns ``score(texts, max_length) -> (mean loss, tokens)``. A batch is
    ``batch_size`` consecutive rows by ``order`` (scan order where that column is missing), whatever
    the partitions; its texts meet in one row.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    position = F.col(order) if order in dataset.columns else F.monotonically_increasing_id()
    numbered = batch_ids(dataset.select(position.alias("_row"), F.col(text).alias("text")), batch_size, "_row")
    members = F.sort_array(F.collect_list(F.struct("_row", "text")))
    whole = numbered.groupBy("batch_id").agg(members.alias("rows")).select(F.col("rows.text").alias("texts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = None
        for batch in batches:
            rows = []
            for texts in batch.column(0).to_pylist():
                if score is None:
                    score = factory()
                rows.append(score(texts, max_length))
            losses, counts = ([row[k] for row in rows] for k in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(losses, pa.float64()), pa.array(counts, pa.int64())], names=["loss", "num_tokens"]
            )

    return whole.mapInArrow(run, "loss double, num_tokens bigint")


def tokens_per_second(num_tokens="num_tokens", seconds="generation_time"):
    n, t = F.col(num_tokens), F.col(seconds)
    return F.when(t <= 0, F.lit(0.0)).otherwise(n / t)


def throughput(results: DataFrame) -> DataFrame:
    """Totals over all rows."""
    sums = results.agg(
        F.count("*").alias("num_prompts"),
        F.coalesce(F.sum("num_tokens"), F.lit(0)).alias("num_tokens"),
        F.coalesce(F.sum("generation_time"), F.lit(0.0)).alias("generation_time"),
    )
    return sums.withColumn("tokens_per_second", tokens_per_second())


def generate_and_score(
    dataset: DataFrame, factory: Factory, text: str = "text", reference: str = "output", max_new_tokens: int = 256
) -> DataFrame:
    """Greedy generation over every row, then the text metrics against the reference column.

    Prompt and reference travel in one row, so nothing has to be joined back.
    """
    options = GenerationOptions(max_new_tokens=max_new_tokens, do_sample=False, repetition_penalty=1.0)
    rows = dataset.select(F.col(text).alias("prompt"), F.col(reference).alias("reference"))
    return text_metrics(generate(rows, factory, options).withColumnRenamed("generated_text", "prediction"))


def generate_and_check(
    dataset: DataFrame, factory: Factory, text: str = "text", label: str = "output", max_new_tokens: int = 64
) -> DataFrame:
    """Greedy generation over every row, then containment accuracy against the label column."""
    options = GenerationOptions(max_new_tokens=max_new_tokens, do_sample=False, repetition_penalty=1.0)
    rows = dataset.select(F.col(text).alias("prompt"), F.col(label).alias("expected"))
    return task_accuracy(generate(rows, factory, options))


def review_samples(
    dataset: DataFrame,
    factory: Factory,
    num_samples: int = 20,
    text: str = "text",
    reference: str | None = "output",
    max_new_tokens: int = 256,
    temperature: float = 0.7,
    seed: int = 42,
    row_id: str = "row_id",
) -> DataFrame:
    """``(sample_id, prompt, reference, generated, metadata)`` for a seeded sample of the rows."""
    is_text = reference in dataset.columns and dataset.schema[reference].dataType.simpleString() == "string"
    ref = F.coalesce(F.col(reference), F.lit("")) if is_text else F.lit("")
    picked = seeded_sample(dataset, num_samples, seed, row_id).select(
        "sample_id",
        F.col(row_id).alias("_index"),
        F.col(text).alias("prompt"),
        ref.alias("reference"),
    )
    options = GenerationOptions(
        max_new_tokens=max_new_tokens, do_sample=temperature > 0, temperature=temperature, repetition_penalty=1.0
    )
    return generate(picked, factory, options).select(
        "sample_id",
        "prompt",
        "reference",
        F.col("generated_text").alias("generated"),
        F.struct(F.col("_index").alias("index"), F.lit(float(temperature)).alias("temperature")).alias("metadata"),
    )
