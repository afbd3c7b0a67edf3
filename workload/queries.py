"""One query per operator; each reads the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.functions.templates import register_template, render, template_names
from loomset.functions.text import py_strip
from loomset.operators import compare, cost, evaluate, registry, scoring, split, stats, telemetry, unify, validate
from loomset.plans.evaluate import compare_models, evaluate_model
from loomset.plans.prepare import prepare_dataset, prepare_training_set, split_sizes_of
from loomset.session import materialize, scratch_path
from loomset.sources import readers, sinks
from loomset.streaming import telemetry as stream_telemetry
from loomset.streaming.jobs import drain, score_stream
from workload import views
from workload.stub_model import echo_factory, length_loss_factory

Query = Callable[[SparkSession, str], DataFrame]
UNIFIED = ["row_id", "instruction", "input", "output"]


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# ------------------------------------------------------------------ sources and sinks


def json_array_source(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written as JSON list files of 1,000 records each, then read back."""
    rows = views.unified(spark, sf)
    record = F.to_json(F.struct(F.col("row_id").alias("doc"), "instruction", "input", "output"))
    lists = rows.groupBy(F.floor(F.col("row_id") / 1000).alias("file")).agg(F.collect_list(record).alias("records"))
    path = scratch_path(spark, "json-array")
    value = F.concat(F.lit("[\n"), F.array_join("records", ",\n"), F.lit("\n]")).alias("value")
    lists.select(value).write.option("maxRecordsPerFile", 1).text(path)
    table = readers.load(spark, path)
    return unify.to_unified(table, keep=("doc",)).withColumnRenamed("doc", "row_id")


def csv_source(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "csv") + ".csv"
    sinks.write_csv(views.unified(spark, sf).withColumnRenamed("row_id", "doc"), path)
    table = readers.load(spark, path).withColumn("doc", F.col("doc").cast("bigint"))
    return unify.to_unified(table, keep=("doc",)).withColumnRenamed("doc", "row_id")


def json_lines_source(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "lines") + ".jsonl"
    views.dolly(spark, sf).write.json(path)
    schema = "row_id bigint, instruction string, context string, response string"
    return unify.to_unified(readers.read_json_lines(spark, path, schema))


def _read_and_left(rows: DataFrame, left: DataFrame) -> DataFrame:
    """Rows that were read, and the texts that were left out."""
    return rows.select(*UNIFIED, F.lit(None).cast("string").alias("value")).unionByName(left.select("value"), allowMissingColumns=True)


def json_array_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as JSON list files of 100 records each; every seventh file holds ids and is not closed."""
    record = F.to_json(F.struct(*UNIFIED))
    broken = F.col("file") % 7 == 3
    files = views.unified(spark, sf).withColumn("file", F.floor(F.col("row_id") / 100)).groupBy("file").agg(
        F.collect_list(F.when(~broken, record)).alias("records"), F.sort_array(F.collect_list("row_id")).alias("ids")
    )
    value = F.when(broken, F.concat(F.lit("["), F.array_join("ids", ","))).otherwise(F.concat(F.lit("["), F.array_join("records", ","), F.lit("]")))
    path = scratch_path(spark, "broken-arrays")
    files.select(value.alias("value")).write.option("maxRecordsPerFile", 1).option("lineSep", " ").text(path)
    schema = "row_id bigint, instruction string, input string, output string"
    left = readers.malformed_json(spark, path, schema, lists=True).select(F.trim("value").alias("value"))
    return _read_and_left(readers.read_json_array(spark, path, schema, quarantine=True), left)


def json_lines_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as JSON lines; every seventh line ends after its first field."""
    line = F.when(F.col("row_id") % 7 == 3, F.format_string('{"row_id":%d,', "row_id")).otherwise(F.to_json(F.struct(*UNIFIED)))
    path = scratch_path(spark, "broken-lines")
    views.unified(spark, sf).select(line.alias("value")).write.text(path)
    schema = "row_id bigint, instruction string, input string, output string"
    return _read_and_left(readers.read_json_lines(spark, path, schema, quarantine=True), readers.malformed_json(spark, path, schema))


def parquet_source(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "table") + ".parquet"
    views.oasst(spark, sf).write.parquet(path)
    return unify.to_unified(readers.load(spark, path))


def named_split_scan(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "named")
    rows = views.unified(spark, sf, F.col("lang").alias("split"))
    rows.write.partitionBy("split").parquet(f"{root}/docs")
    return readers.read_split(spark, root, "docs", "en")


def split_sink_readback(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "splits")
    rows = split.random_split(render(views.unified(spark, sf), "mistral"))
    sinks.write_splits(rows, path)
    return spark.read.schema("text string, split string").json(path)


def _samples(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.review_samples(views.instruction_rows(spark, sf), echo_factory, num_samples=50)


def review_csv_readback(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "review-csv")
    sinks.write_review_csv(_samples(spark, sf), path)
    table = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"')
    blank = {c: F.coalesce(c, F.lit("")) for c in ("rating", "notes", "reference")}
    return table.withColumn("sample_id", F.col("sample_id").cast("bigint")).withColumns(blank)


def review_json_readback(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "review-json")
    sinks.write_review_json(_samples(spark, sf), path)
    schema = (
        "sample_id bigint, prompt string, reference string, generated string, "
        "metadata struct<index:bigint,temperature:double>, rating int, notes string"
    )
    table = spark.read.schema(schema).json(path)
    return table.select(
        "sample_id", "prompt", "reference", "generated", F.col("rating").isNull().alias("unrated"), "notes",
        F.col("metadata.index").alias("source_row"), F.col("metadata.temperature").alias("temperature"),
    )


def review_markdown_readback(spark: SparkSession, sf: str) -> DataFrame:
    """Non-blank lines of the sheet with their counts."""
    path = scratch_path(spark, "review-md")
    sinks.write_review_markdown(_samples(spark, sf), path)
    lines = spark.read.text(path).where("value <> ''")
    return lines.groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


def metrics_sink_readback(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "metrics")
    sinks.write_metrics(views.results(spark, sf), path)
    return spark.read.schema(compare.RESULT_SCHEMA).json(path)


def registry_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The registry written with an unknown key and without a status, then read back."""
    path = scratch_path(spark, "registry")
    sinks.append_registry(views.registry(spark, sf).drop("status").withColumn("note", F.lit("x")), path)
    return _flat_registry(readers.healthy(readers.read_registry(spark, path)))


def _flat_registry(df: DataFrame) -> DataFrame:
    return df.select(
        "seq", "name", "version", "path", "status", F.col("timestamp").cast("timestamp_ntz").alias("registered_at"),
        F.col("metrics")["eval_loss"].alias("eval_loss"), F.col("metrics")["accuracy"].alias("accuracy"),
    )


# ------------------------------------------------------------------ unification and templates


def _template(name: str, mode: str) -> Query:
    return lambda spark, sf: render(views.unified(spark, sf), name, mode)


def template_custom(spark: SparkSession, sf: str) -> DataFrame:
    if "question" not in template_names():
        register_template(
            "question",
            lambda i, x, o: F.concat(F.lit("Q: "), py_strip(i), F.lit("\nA: "), py_strip(F.lit("") if o is None else o)),
        )
    return render(views.unified(spark, sf), "Question")


# ------------------------------------------------------------------ validation and statistics


def special_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(validate.with_special_ratio(views.unified(spark, sf)).select("row_id", "special_ratio"), "special_ratio")


def validation_kept(spark: SparkSession, sf: str) -> DataFrame:
    return validate.validate_all(views.unified(spark, sf))


def validation_report(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(validate.validation_report(validate.reason_counts(views.unified(spark, sf))), "removal_rate")


def dataset_stats(spark: SparkSession, sf: str) -> DataFrame:
    row = stats.dataset_stats(views.unified(spark, sf)).drop("token_length_distribution")
    return _rounded(row, "avg_instruction_len", "avg_input_len", "avg_output_len")


# ------------------------------------------------------------------ splits


def random_split(spark: SparkSession, sf: str) -> DataFrame:
    return split.random_split(views.unified(spark, sf)).select("row_id", "split")


def random_split_two_way(spark: SparkSession, sf: str) -> DataFrame:
    return split.random_split(views.unified(spark, sf), 0.9, 0.1, 0.0, seed=7).select("row_id", "split")


def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.unified(spark, sf, "source")
    return split.random_split(rows, stratify="source").select("row_id", "source", "split")


def seeded_sample(spark: SparkSession, sf: str) -> DataFrame:
    return split.seeded_sample(views.unified(spark, sf), 200).select("sample_id", *UNIFIED)


# ------------------------------------------------------------------ metrics


def _pair_metric(make) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        scores = make(views.pairs(spark, sf))
        return _rounded(scores, *[c for c in scores.columns if c != "pair_id"])

    return query


def rouge_means(spark: SparkSession, sf: str) -> DataFrame:
    names = ("rouge_1", "rouge_2", "rouge_l")
    return _rounded(evaluate.mean_of(evaluate.pair_metrics(views.pairs(spark, sf)), *names), *names)


def text_metrics(spark: SparkSession, sf: str) -> DataFrame:
    row = evaluate.text_metrics(views.pairs(spark, sf))
    return _rounded(row, *row.columns)


def bleu_mean(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(evaluate.mean_of(evaluate.pair_bleu(views.pairs(spark, sf)), "bleu"), "bleu")


def pair_alignment(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.pairs(spark, sf)
    return evaluate.align_pairs(rows.select("pair_id", "prediction"), rows.select("pair_id", "reference"))


def unaligned_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations with a first assistant turn against those with a second user turn."""
    first_answer = views.nth_turn(spark, sf, "assistant", 1, "prediction")
    return evaluate.unaligned(first_answer, views.nth_turn(spark, sf, "user", 2, "reference"))


def task_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(evaluate.task_accuracy(views.answers(spark, sf)), "accuracy")


def task_accuracy_strict(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(evaluate.task_accuracy(views.answers(spark, sf), strict=True), "accuracy")


def perplexity(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(evaluate.perplexity(views.scored(spark, sf)), "perplexity")


def batch_ids(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.batch_ids(views.unified(spark, sf).select("row_id"), 4)


# ------------------------------------------------------------------ comparison


def result_union(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.results(spark, sf)
    parts = [rows.where(F.col("model_name") == m) for m in reversed(views.MODELS)]
    return compare.add_models(*parts)


def improvement(spark: SparkSession, sf: str) -> DataFrame:
    rows = compare.improvements(views.results(spark, sf))
    return _rounded(rows, "base_value", "finetuned_value", "absolute_change", "relative_change")


def comparison_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = compare.comparison_summary(views.results(spark, sf), "events")
    return lines.where("line <> ''").select("part", "pos", "line")


# ------------------------------------------------------------------ registry


def registry_register(spark: SparkSession, sf: str) -> DataFrame:
    old = views.registry(spark, sf)
    new = old.select("seq", "name", F.lit("v-next").alias("version"), "path", "metrics")
    return _flat_registry(registry.register(old, new, F.lit("2025-01-01 00:00:00").cast("timestamp")))


def latest_versions(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_registry(registry.latest_versions(views.registry(spark, sf)))


def best_versions(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_registry(registry.best_versions(views.registry(spark, sf)))


def best_versions_by_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_registry(registry.best_versions(views.registry(spark, sf), "accuracy"))


def list_versions(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_registry(registry.list_models(views.registry(spark, sf), "purchase"))


def _status_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Each (name, version) is deployed, then archived."""
    keys = views.registry(spark, sf).select("name", "version").distinct()
    steps = F.array(
        F.struct(F.lit(1).alias("change_no"), F.lit("deployed").alias("status")),
        F.struct(F.lit(2).alias("change_no"), F.lit("archived").alias("status")),
    )
    return keys.select("name", "version", F.inline(steps))


def update_status(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_registry(registry.update_status(views.registry(spark, sf), _status_changes(spark, sf)))


def delete_versions(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.registry(spark, sf)
    keys = rows.where(F.col("metrics")["eval_loss"] > 200).select("name", "version").distinct()
    return _flat_registry(registry.delete_versions(rows, keys))


# ------------------------------------------------------------------ telemetry


def _states(df: DataFrame) -> DataFrame:
    return _rounded(df, "eval_loss", "best_loss")


def early_stopping(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(telemetry.early_stopping(views.runs(spark, sf)), "best_loss")


def early_stopping_states(spark: SparkSession, sf: str) -> DataFrame:
    return _states(telemetry.early_stopping_states(views.runs(spark, sf)))


def _event_stream(spark: SparkSession, sf: str, view) -> DataFrame:
    """A derived event table as a file stream."""
    batch = view(spark, sf)
    path = scratch_path(spark, "stream-input")
    batch.write.parquet(path)
    return spark.readStream.schema(batch.schema).parquet(path)


def _arrivals(spark: SparkSession, batch: DataFrame, parts: list, arrive) -> None:
    """Call ``arrive(stream)`` after each part of ``batch`` was added to the folder that the stream reads."""
    path = scratch_path(spark, "stream-input")
    for part in parts:
        batch.where(part).write.mode("append").parquet(path)
        arrive(spark.readStream.schema(batch.schema).parquet(path))


def early_stopping_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The evaluations arrive in five micro-batches, earlier steps first."""
    batch = views.runs(spark, sf)
    out = scratch_path(spark, "stopping")
    cuts = batch.approxQuantile("step", [0.2, 0.4, 0.6, 0.8], 0.01)
    bounds = [float("-inf"), *cuts, float("inf")]
    parts = [(F.col("step") > low) & (F.col("step") <= high) for low, high in zip(bounds[:-1], bounds[1:])]

    def arrive(stream: DataFrame) -> None:
        stream_telemetry.start_early_stopping(stream, out, f"{out}-states", f"{out}-checkpoint", once=True).awaitTermination()

    _arrivals(spark, batch, parts, arrive)
    kind = batch.schema["run_id"].dataType.simpleString()
    schema = f"run_id {kind}, step bigint, eval_loss double, best_loss double, wait_count bigint, should_stop boolean"
    return _states(stream_telemetry.batches_written(spark, out, schema))


def progress(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.progress_rows(views.train_events(spark, sf), 5)


def progress_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Four micro-batches of a quarter of the runs each; a run enters the run table just before its events."""
    batch = views.train_events(spark, sf)
    out, known = scratch_path(spark, "progress"), scratch_path(spark, "runs")
    quarter = F.pmod(F.xxhash64("run_id"), F.lit(4))
    bounds = telemetry.run_bounds(batch)
    numbers = iter(range(4))

    def arrive(stream: DataFrame) -> None:
        bounds.where(quarter == next(numbers)).write.mode("append").parquet(known)
        runs = lambda: spark.read.schema(bounds.schema).parquet(known)
        stream_telemetry.start_progress(stream, runs, 5, out, f"{out}-checkpoint", once=True).awaitTermination()

    _arrivals(spark, batch, [quarter == k for k in range(4)], arrive)
    schema = telemetry.progress_projection(batch.join(bounds, "run_id", "left"), 5).schema
    return stream_telemetry.batches_written(spark, out, schema)


def metric_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(telemetry.metric_rows(views.train_events(spark, sf)), "value")


def metric_rows_stream(spark: SparkSession, sf: str) -> DataFrame:
    stream = telemetry.metric_rows(_event_stream(spark, sf, views.train_events))
    return _rounded(drain(stream, "metric-rows"), "value")


def eval_rows(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.eval_rows(views.train_events(spark, sf))


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(telemetry.run_summary(views.train_events(spark, sf)), "samples_per_second")


def run_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Report lines except the rounded figures, which the summary query checks."""
    reports = telemetry.run_reports(telemetry.run_summary(views.train_events(spark, sf)))
    lines = F.split("summary", "\n")
    return reports.select("run_id", F.get(lines, F.lit(0)).alias("title"), F.get(lines, F.lit(2)).alias("checkpoint"))


def run_report_texts(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.run_reports(telemetry.run_summary(views.train_events(spark, sf)))


# ------------------------------------------------------------------ scoring and cost


def _prompts(spark: SparkSession, sf: str) -> DataFrame:
    return render(views.unified(spark, sf), "chatml", "inference").withColumnRenamed("text", "prompt")


def batch_generation(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.generate(_prompts(spark, sf), echo_factory).drop("generation_time")


def throughput(spark: SparkSession, sf: str) -> DataFrame:
    """Throughput of usage rows taken as (tokens, seconds)."""
    rows = views.usage(spark, sf).select(
        F.col("usage_id").alias("num_tokens"),
        F.when(F.col("usage_id") % 7 == 0, 0.0).otherwise(F.col("hours")).alias("generation_time"),
    )
    return _rounded(scoring.throughput(rows), "generation_time", "tokens_per_second")


def row_throughput(spark: SparkSession, sf: str) -> DataFrame:
    seconds = F.when(F.col("usage_id") % 7 == 0, F.lit(0.0)).otherwise(F.col("hours"))
    rows = views.usage(spark, sf).select("usage_id", F.col("usage_id").alias("num_tokens"), seconds.alias("generation_time"))
    return _rounded(rows.select("usage_id", scoring.tokens_per_second().alias("tokens_per_second")), "tokens_per_second")


def generate_and_score(spark: SparkSession, sf: str) -> DataFrame:
    row = scoring.generate_and_score(views.instruction_rows(spark, sf), echo_factory)
    return _rounded(row, *row.columns)


def generate_and_check(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.instruction_rows(spark, sf)
    label = F.when(F.col("row_id") % 2 == 0, F.substring("text", 2, 12)).otherwise(F.col("output"))
    return _rounded(scoring.generate_and_check(rows.withColumn("output", label), echo_factory), "accuracy")


def stream_scoring(spark: SparkSession, sf: str) -> DataFrame:
    stream = score_stream(_event_stream(spark, sf, _prompts), echo_factory)
    return drain(stream, "scored").drop("generation_time")


def review_samples(spark: SparkSession, sf: str) -> DataFrame:
    return _samples(spark, sf).select(
        "sample_id", "prompt", "reference", "generated",
        F.col("metadata.index").alias("source_row"), F.col("metadata.temperature").alias("temperature"),
    )


def loss_scoring(spark: SparkSession, sf: str) -> DataFrame:
    rows = scoring.score_batches(render(views.unified(spark, sf), "llama3"), length_loss_factory)
    return _rounded(evaluate.perplexity(rows, ()), "perplexity")


def cost_estimate(spark: SparkSession, sf: str) -> DataFrame:
    return cost.estimate_cost(views.usage(spark, sf))


# ------------------------------------------------------------------ composed jobs


def chat_training_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns to validated, rendered training rows: the smallest whole job."""
    kept = validate.validate_all(unify.turns_to_unified(views.turns(spark, sf)))
    return render(kept, "chatml").withColumnRenamed("row_id", "conv_id")


def prepare_dataset_rows(spark: SparkSession, sf: str) -> DataFrame:
    return prepare_dataset(spark, views.unified(spark, sf), out=scratch_path(spark, "prepared")).rows


def prepare_training_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return split_sizes_of(prepare_training_set(spark, views.dolly(spark, sf), config_template="llama3").rows)


def prepare_training_rows(spark: SparkSession, sf: str) -> DataFrame:
    return prepare_training_set(spark, views.dolly(spark, sf), config_template="llama3").rows


def prepare_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return prepare_dataset(spark, views.unified(spark, sf)).reasons


def evaluate_model_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = evaluate_model(
        views.instruction_rows(spark, sf),
        views.scored(spark, sf),
        model_name="stub",
        dataset_name="conversations",
        pairs=views.pairs(spark, sf),
        answers=views.answers(spark, sf),
        out=scratch_path(spark, "evaluation"),
    )
    return _rounded(rows, "value")


def compare_model_reports(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.results(spark, sf)
    parts = [rows.where(F.col("model_name") == m) for m in views.MODELS]
    return compare_models(*parts, dataset_name="events").best


def comparison_report(spark: SparkSession, sf: str) -> DataFrame:
    """Every numbered line, blank ones included."""
    return compare.comparison_summary(views.results(spark, sf), "events")


def compare_model_tables(spark: SparkSession, sf: str) -> DataFrame:
    """All tables of a comparison, one below the other."""
    rows = views.results(spark, sf)
    job = compare_models(*[rows.where(F.col("model_name") == m) for m in views.MODELS], dataset_name="events")

    def part(df: DataFrame, label: str, **columns) -> DataFrame:
        kinds = {"name": "string", "metric": "string", "v1": "double", "v2": "double", "v3": "double", "v4": "double", "text": "string"}
        return df.select(F.lit(label).alias("part"), *[(F.col(columns[c]) if c in columns else F.lit(None)).cast(t).alias(c) for c, t in kinds.items()])

    changes = ("base_value", "finetuned_value", "absolute_change", "relative_change")
    parts = [
        part(job.best, "best", name="model_name", metric="metric", v1="value"),
        part(_rounded(job.improvement, *changes), "improvement", metric="metric", **dict(zip(("v1", "v2", "v3", "v4"), changes))),
        part(job.reports, "report", name="model_name", v1="pos", text="summary"),
        part(job.summary, "summary", v1="part", v2="pos", v3="no", text="line"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


QUERIES: dict[str, Query] = {
    "json_array_source": json_array_source,
    "csv_source": csv_source,
    "json_lines_source": json_lines_source,
    "json_array_quarantine": json_array_quarantine,
    "json_lines_quarantine": json_lines_quarantine,
    "parquet_source": parquet_source,
    "named_split_scan": named_split_scan,
    "split_sink_readback": split_sink_readback,
    "review_csv_readback": review_csv_readback,
    "review_json_readback": review_json_readback,
    "review_markdown_readback": review_markdown_readback,
    "metrics_sink_readback": metrics_sink_readback,
    "registry_scan": registry_scan,
    "unify_alpaca": lambda spark, sf: unify.to_unified(views.unified(spark, sf)),
    "unify_alpaca_no_input": lambda spark, sf: unify.to_unified(views.alpaca_no_input(spark, sf)),
    "unify_dolly": lambda spark, sf: unify.to_unified(views.dolly(spark, sf)),
    "unify_oasst": lambda spark, sf: unify.to_unified(views.oasst(spark, sf)),
    "unify_explicit_format": lambda spark, sf: unify.to_unified(views.unified(spark, sf), "oasst"),
    "unify_nested_messages": lambda spark, sf: unify.to_unified(views.nested_messages(spark, sf)),
    "unify_turns": lambda spark, sf: unify.turns_to_unified(views.turns(spark, sf)),
    **{
        f"template_{name}_{mode}": _template(name, mode)
        for name in ("alpaca", "chatml", "llama3", "mistral")
        for mode in ("train", "inference")
    },
    "template_custom": template_custom,
    "length_filter": lambda spark, sf: validate.filter_lengths(views.unified(spark, sf)),
    "quality_filter": lambda spark, sf: validate.filter_quality(views.unified(spark, sf)),
    "quality_counts": lambda spark, sf: validate.quality_counts(views.unified(spark, sf)),
    "special_ratio": special_ratio,
    "exact_dedup": lambda spark, sf: validate.drop_duplicates(views.unified(spark, sf)),
    "validation_kept": validation_kept,
    "validation_flags": lambda spark, sf: validate.flags(views.unified(spark, sf)),
    "validation_reasons": lambda spark, sf: validate.sorted_reasons(validate.reason_counts(views.unified(spark, sf))),
    "validation_report": validation_report,
    "validation_summary": lambda spark, sf: validate.report_summary(validate.reason_counts(views.unified(spark, sf))),
    "dataset_stats": dataset_stats,
    "token_histogram": lambda spark, sf: stats.histogram_rows(stats.dataset_stats(views.unified(spark, sf))),
    "random_split": random_split,
    "random_split_two_way": random_split_two_way,
    "stratified_split": stratified_split,
    "seeded_sample": seeded_sample,
    "bleu_pairs": _pair_metric(evaluate.pair_bleu),
    "bleu_mean": bleu_mean,
    "rouge_1_pairs": _pair_metric(lambda p: evaluate.pair_rouge_n(p, 1)),
    "rouge_2_pairs": _pair_metric(lambda p: evaluate.pair_rouge_n(p, 2)),
    "rouge_3_pairs": _pair_metric(lambda p: evaluate.pair_rouge_n(p, 3)),
    "rouge_l_pairs": _pair_metric(evaluate.pair_rouge_l),
    "rouge_means": rouge_means,
    "text_metrics": text_metrics,
    "pair_alignment": pair_alignment,
    "unaligned_pairs": unaligned_pairs,
    "task_accuracy": task_accuracy,
    "task_accuracy_strict": task_accuracy_strict,
    "perplexity": perplexity,
    "batch_ids": batch_ids,
    "wide_results": lambda spark, sf: compare.wide_results(views.results(spark, sf)),
    "result_union": result_union,
    "best_models": lambda spark, sf: compare.best_models(views.results(spark, sf)),
    "improvement": improvement,
    "evaluation_summaries": lambda spark, sf: compare.evaluation_summaries(views.results(spark, sf)),
    "comparison_lines": comparison_lines,
    "registry_register": registry_register,
    "latest_versions": latest_versions,
    "best_versions": best_versions,
    "best_versions_by_accuracy": best_versions_by_accuracy,
    "list_versions": list_versions,
    "update_status": update_status,
    "delete_versions": delete_versions,
    "early_stopping": early_stopping,
    "early_stopping_states": early_stopping_states,
    "early_stopping_stream": early_stopping_stream,
    "top_checkpoints": lambda spark, sf: telemetry.top_checkpoints(views.runs(spark, sf)),
    "checkpoint_history": lambda spark, sf: telemetry.checkpoint_history(views.runs(spark, sf)),
    "best_checkpoint": lambda spark, sf: telemetry.best_checkpoint(views.runs(spark, sf)),
    "progress_rows": progress,
    "progress_stream": progress_stream,
    "metric_rows": metric_rows,
    "metric_rows_stream": metric_rows_stream,
    "eval_rows": eval_rows,
    "run_summary": run_summary,
    "run_reports": run_reports,
    "run_report_texts": run_report_texts,
    "comparison_report": comparison_report,
    "compare_models_tables": compare_model_tables,
    "prepare_training_rows": prepare_training_rows,
    "batch_generation": batch_generation,
    "throughput": throughput,
    "row_throughput": row_throughput,
    "generate_and_score": generate_and_score,
    "generate_and_check": generate_and_check,
    "stream_scoring": stream_scoring,
    "review_samples": review_samples,
    "loss_scoring": loss_scoring,
    "cost_estimate": cost_estimate,
    "chat_training_rows": chat_training_rows,
    "prepare_dataset": prepare_dataset_rows,
    "prepare_training_sizes": prepare_training_sizes,
    "prepare_reasons": prepare_reasons,
    "evaluate_model": evaluate_model_rows,
    "compare_models": compare_model_reports,
}
