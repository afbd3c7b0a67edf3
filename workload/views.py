"""Input tables of the queries, derived by Spark from the given parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomset.operators.cost import HOURLY_PRICES

INSTANCE_TYPES = [*HOURLY_PRICES, "ml.unlisted"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def unified(spark: SparkSession, sf: str, *extra: str) -> DataFrame:
    """Documents cut at the first full stop into instruction and output."""
    docs = table(spark, sf, "documents")
    head = F.substring_index("text", ".", 1)
    kind = F.col("doc_id") % 3
    inp = F.when(kind == 0, F.col("source")).when(kind == 1, F.lit("")).otherwise(F.lit("  "))
    return docs.select(
        F.col("doc_id").alias("row_id"),
        head.alias("instruction"),
        inp.alias("input"),
        F.expr("substring(text, length(substring_index(text, '.', 1)) + 2)").alias("output"),
        *extra,
    )


def dolly(spark: SparkSession, sf: str) -> DataFrame:
    return unified(spark, sf).withColumnsRenamed({"input": "context", "output": "response"})


def oasst(spark: SparkSession, sf: str) -> DataFrame:
    return unified(spark, sf).drop("input").withColumnRenamed("output", "response")


def alpaca_no_input(spark: SparkSession, sf: str) -> DataFrame:
    return unified(spark, sf).drop("input")


def nested_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as message arrays in five shapes, both spellings of the fields."""
    null = F.lit(None).cast("string")

    def old(role: str, text) -> Column:
        return F.struct(F.lit(role).alias("from"), null.alias("role"), text.alias("value"), null.alias("content"))

    def new(role: str, text) -> Column:
        return F.struct(null.alias("from"), F.lit(role).alias("role"), null.alias("value"), text.alias("content"))

    i, o, shape = F.col("instruction"), F.col("output"), F.col("row_id") % 5
    conversations = (
        F.when(shape == 0, F.array(old("human", i), old("gpt", o)))
        .when(shape == 1, F.array(old("gpt", o), old("human", i)))
        .when(shape == 2, F.array(new("system", F.lit("Be brief.")), new("user", i), new("assistant", o)))
        .when(shape == 3, F.array(old("human", i)))
        .otherwise(F.array(old("human", F.lit("")), old("human", i), old("gpt", o), old("gpt", i)))
    )
    return unified(spark, sf).select("row_id", conversations.alias("conversations"))


def turns(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations")


def nth_turn(spark: SparkSession, sf: str, role: str, n: int, name: str) -> DataFrame:
    """Text of the n-th turn of a role, for the conversations that have one."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    ranked = turns(spark, sf).where(F.col("role") == role).withColumn("_at", F.row_number().over(w))
    return ranked.where(F.col("_at") == n).select(F.col("conv_id").alias("pair_id"), F.col("text").alias(name))


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    """First and second assistant turn of a conversation, where both exist."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    first_two = (
        turns(spark, sf)
        .where("role = 'assistant'")
        .withColumn("_at", F.row_number().over(w))
        .where("_at <= 2")
    )
    return (
        first_two.groupBy(F.col("conv_id").alias("pair_id"))
        .agg(
            F.max(F.when(F.col("_at") == 1, F.col("text"))).alias("prediction"),
            F.max(F.when(F.col("_at") == 2, F.col("text"))).alias("reference"),
        )
        .where("prediction IS NOT NULL AND reference IS NOT NULL")
    )


def answers(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs with a label that sometimes lies inside the generation."""
    kind = F.col("pair_id") % 3
    inside = F.concat(F.lit(" "), F.substring("prediction", 3, 10), F.lit("\n"))
    expected = F.when(kind == 0, inside).when(kind == 1, F.col("reference")).otherwise(F.substring("reference", 1, 5))
    return pairs(spark, sf).select("pair_id", F.col("prediction").alias("generated_text"), expected.alias("expected"))


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """Evaluations: one run per user, the event number as step."""
    return table(spark, sf, "events").select(
        F.col("user_id").alias("run_id"),
        F.col("event_id").alias("step"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("eval_loss"),
    )


def train_events(spark: SparkSession, sf: str) -> DataFrame:
    """Training events whose reported fields depend on the event type."""

    def only(types: list[str], value) -> Column:
        return F.when(F.col("event_type").isin(types), value)

    value = F.col("value")
    return table(spark, sf, "events").select(
        F.col("user_id").alias("run_id"),
        F.col("event_id").alias("step"),
        F.col("ts").cast("timestamp").alias("ts"),
        (F.col("event_id") % 8 + 1).alias("num_samples"),
        only(["click", "view"], value).alias("loss"),
        only(["click"], value / 1000).alias("learning_rate"),
        only(["view"], value / 2).alias("grad_norm"),
        only(["purchase", "signup"], value).alias("eval_loss"),
        only(["purchase"], value * 2).alias("eval_runtime"),
        only(["signup"], value / 4).alias("eval_samples_per_second"),
    )


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_type").alias("run"),
        (F.col("value") / 100).alias("loss"),
        (F.col("event_id") % 512 + 1).alias("num_tokens"),
    )


def registry(spark: SparkSession, sf: str) -> DataFrame:
    accuracy = F.regexp_extract("props", r"(\d+)", 1).cast("double") / 100
    plain = F.create_map(F.lit("eval_loss"), F.col("value"))
    both = F.create_map(F.lit("eval_loss"), F.col("value"), F.lit("accuracy"), accuracy)
    return table(spark, sf, "events").select(
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("name"),
        F.concat(F.lit("v"), (F.col("event_id") % 50).cast("string")).alias("version"),
        F.concat(F.lit("models/"), F.col("event_id").cast("string")).alias("path"),
        F.when(F.col("event_id") % 3 == 0, both).otherwise(plain).alias("metrics"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit("registered").alias("status"),
    )


def usage(spark: SparkSession, sf: str) -> DataFrame:
    types = F.array(*[F.lit(t) for t in INSTANCE_TYPES])
    return table(spark, sf, "events").select(
        F.col("event_id").alias("usage_id"),
        F.get(types, (F.col("event_id") % len(INSTANCE_TYPES)).cast("int")).alias("instance_type"),
        F.col("value").alias("hours"),
    )


MODELS = ["click", "error", "purchase", "signup", "view"]


def results(spark: SparkSession, sf: str) -> DataFrame:
    """One model per event type with two or three metrics each."""
    position = F.array_position(F.array(*[F.lit(m) for m in MODELS]), F.col("event_type")) - 1
    weight = F.col("event_id") % 512 + 1
    per_model = table(spark, sf, "events").groupBy("event_type").agg(
        F.count("*").alias("num_samples"),
        F.exp(F.sum(F.col("value") / 100 * weight) / F.sum(weight)).alias("perplexity"),
        F.avg("value").alias("loss"),
        F.when(F.col("event_type") != "signup", F.avg((F.col("value") > 10).cast("double"))).alias("accuracy"),
    )
    metrics = F.array(
        *[
            F.struct(F.lit(i).alias("metric_no"), F.lit(m).alias("metric"), F.round(F.col(m), 6).alias("value"))
            for i, m in enumerate(("perplexity", "loss", "accuracy"))
        ]
    )
    return per_model.select(
        position.cast("int").alias("pos"),
        F.col("event_type").alias("model_name"),
        F.lit("events").alias("dataset_name"),
        "num_samples",
        F.inline(metrics),
    ).where("value IS NOT NULL")


def instruction_rows(spark: SparkSession, sf: str) -> DataFrame:
    """First user and assistant turn per conversation, as a prompt and its expected output."""
    from loomset.operators.unify import turns_to_unified

    return turns_to_unified(turns(spark, sf)).select("row_id", F.col("instruction").alias("text"), "output")
