"""A table of model versions: append, look up, update and delete as joins and aggregates.

Rows are ``(seq, name, version, path, metrics, timestamp, status)``; ``seq`` is the order of
registration. (name, version) need not be unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomset.functions.ordering import row_positions
from loomset.session import join_lookup, materialize

REGISTRY_SCHEMA = (
    "seq bigint, name string, version string, path string, "
    "metrics map<string,double>, timestamp timestamp, status string"
)
REGISTRY_COLUMNS = ["seq", "name", "version", "path", "metrics", "timestamp", "status"]

# The status of a new row, and metrics where less is better.
REGISTERED = "registered"
LOWER_IS_BETTER = ("eval_loss", "train_loss", "perplexity", "loss")


def register(registry: DataFrame, new: DataFrame, now: Column | None = None) -> DataFrame:
    """The registry plus ``new`` rows ``(name, version, path, metrics)``; duplicates allowed.

    New rows are numbered on from the registry's largest ``seq``, in the order of their own ``seq`` if they
    have that column, else in scan order.
    """
    last = registry.agg(F.max("seq")).first()[0]
    if "seq" not in new.columns:
        new = materialize(new.withColumn("seq", F.monotonically_increasing_id()), "registered")
    new = row_positions(new, "seq", "_at")
    empty = F.create_map().cast("map<string,double>")
    added = new.select(
        (F.col("_at") + F.lit(0 if last is None else last + 1)).alias("seq"),
        "name",
        "version",
        "path",
        F.coalesce("metrics", empty).alias("metrics"),
        (F.current_timestamp() if now is None else now).alias("timestamp"),
        F.lit(REGISTERED).alias("status"),
    )
    return registry.select(*REGISTRY_COLUMNS).unionByName(added)


def _first_by(registry: DataFrame, *order: Column) -> DataFrame:
    """First row per name; the rank filter runs before the shuffle as well (WindowGroupLimit)."""
    w = Window.partitionBy("name").orderBy(*order)
    return registry.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def latest_versions(registry: DataFrame, name: str | None = None) -> DataFrame:
    """Most recent version per model; of equal times the one registered first."""
    return _first_by(list_models(registry, name), F.desc("timestamp"), F.asc("seq"))


def best_versions(registry: DataFrame, metric: str = "eval_loss", name: str | None = None) -> DataFrame:
    """Best version per model among those whose metric is a number; the earlier wins a tie."""
    value = F.col("metrics")[metric]
    rows = list_models(registry, name).where(value.isNotNull() & ~F.isnan(value))
    return _first_by(rows, F.asc(value) if metric in LOWER_IS_BETTER else F.desc(value), F.asc("seq"))


def list_models(registry: DataFrame, name: str | None = None) -> DataFrame:
    """All versions, or those of one model. An empty name means no filter."""
    return registry.where(F.col("name") == name) if name else registry


def update_status(registry: DataFrame, changes: DataFrame) -> DataFrame:
    """Apply ``changes`` ``(change_no, name, version, status)``.

    A change hits the first matching row only, and the last change of a key wins. The row is found
    by a combined minimum per key, then set by a join on the unique ``seq``, so a key with many
    rows is never gathered.
    """
    keys = ["name", "version"]
    final = changes.groupBy(*keys).agg(F.max_by("status", "change_no").alias("_new"))
    first = registry.groupBy(*keys).agg(F.min("seq").alias("seq"))
    target = first.join(final, keys).select("seq", "_new")
    updated = registry.join(target, "seq", "left")
    return updated.withColumn("status", F.coalesce("_new", "status")).select(*registry.columns)


def delete_versions(registry: DataFrame, keys: DataFrame) -> DataFrame:
    """The registry without any row that matches ``(name, version)`` in ``keys``."""
    wanted = keys.select("name", "version").distinct()
    return join_lookup(registry, wanted, ["name", "version"], "left_anti").select(*registry.columns)


def matched_keys(registry: DataFrame, keys: DataFrame) -> DataFrame:
    """Which of ``keys`` exist, i.e. whether an update or delete would change anything."""
    present = registry.select("name", "version").distinct().withColumn("found", F.lit(True))
    return keys.join(present, ["name", "version"], "left").withColumn("found", F.coalesce("found", F.lit(False)))
