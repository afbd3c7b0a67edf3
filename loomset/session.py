"""Session settings, shared scratch space and size-checked joins."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only after its rows and bytes were measured and found at or below these.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20

CHECKPOINT_CONF = "spark.checkpoint.dir"
_LOCAL_SCRATCH_CONF = "spark.loomset.local.scratch"


def build_session(app: str = "loomset", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this library expects; anything in ``conf`` wins."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local-mode session without that
    setting gets a temporary folder of its own.
    """
    shared = spark.conf.get(CHECKPOINT_CONF, None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
    local = spark.conf.get(_LOCAL_SCRATCH_CONF, None)
    if not local:
        local = tempfile.mkdtemp(prefix="loomset-")
        spark.conf.set(_LOCAL_SCRATCH_CONF, local)
    return local


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def write_scratch(df: DataFrame, label: str, fmt: str = "parquet") -> str:
    """Write ``df`` to shared scratch; returns the path."""
    path = scratch_path(df.sparkSession, label)
    df.write.format(fmt).save(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to shared scratch and read it back.

    The lineage is cut by a table that outlives any executor, and later passes read only the
    columns they need.
    """
    return df.sparkSession.read.schema(df.schema).parquet(write_scratch(df, label))


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a path this library wrote."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def join_lookup(
    big: DataFrame, lookup: DataFrame, on: list[str], how: str = "left", max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Join a table with a lookup that is unique on ``on``.

    The lookup is written out, its rows counted and its bytes summed. A small one is broadcast, so a key that owns a large
    share of ``big`` costs no shuffle. A large one is joined by shuffle, where adaptive execution
    splits the partitions of hot keys (the lookup holds one row per key, so splitting ``big`` is
    enough).
    """
    table = materialize(lookup, "lookup")
    size = table.agg(F.count("*").alias("n"), F.sum(F.octet_length(F.to_json(F.struct(*table.columns)))).alias("bytes")).first()
    if size["n"] <= max_rows and (size["bytes"] or 0) <= BROADCAST_BYTES:
        table = F.broadcast(table)
    return big.join(table, on, how)
