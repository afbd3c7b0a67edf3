"""Price lookup over a usage table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.functions.rounding import py_round

# US dollars per hour by instance type.
HOURLY_PRICES = {
    "ml.g4dn.xlarge": 0.736,
    "ml.g4dn.2xlarge": 1.12,
    "ml.g5.xlarge": 1.408,
    "ml.g5.2xlarge": 1.515,
    "ml.g5.4xlarge": 2.03,
    "ml.g5.12xlarge": 7.09,
    "ml.p3.2xlarge": 3.825,
    "ml.p4d.24xlarge": 37.688,
    "ml.inf2.xlarge": 0.758,
}


def price_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(HOURLY_PRICES.items()), "instance_type string, _price double")


def estimate_cost(usage: DataFrame) -> DataFrame:
    """Adds hourly and total cost; an unknown type costs 0 and is marked.

    The price list has nine rows, so it is always broadcast.
    """
    hourly = F.coalesce("_price", F.lit(0.0))
    joined = usage.join(F.broadcast(price_table(usage.sparkSession)), "instance_type", "left")
    return joined.select(
        *usage.columns,
        hourly.alias("hourly_cost_usd"),
        py_round(hourly * F.col("hours"), 2).alias("total_cost_usd"),
        F.col("_price").isNotNull().alias("known_pricing"),
    )
