"""Seeded orders, exact ranks and cut points that need no global sort."""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate
from operator import add, or_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DatetimeType, NumericType

# A 4-digit hexadecimal prefix gives at most 65,536 groups.
PREFIX = 4
# A bucket this small is read as rows.
SMALL_BUCKET = 10_000
# Bytes of texts in a range of rows that one task numbers.
BUCKET_BYTES = 64 << 20


def seeded_hash(row_id: str | Column, seed: int) -> Column:
    """Pseudo-random order key of a row: the md5 of ``row_id:seed``."""
    c = F.col(row_id) if isinstance(row_id, str) else row_id
    return F.md5(F.concat(c.cast("string"), F.lit(f":{seed}")))


class Histogram:
    """Row counts per hash prefix: at most 65,536 numbers, so the driver may hold them."""

    def __init__(self, keys: DataFrame, parent: str = ""):
        start = len(parent) + 1
        rows = (
            keys.where(F.col("_h").startswith(parent))
            .groupBy(F.substring("_h", start, PREFIX).alias("p"))
            .agg(F.count("*").alias("n"))
            .collect()
        )
        counts = sorted((r["p"], r["n"]) for r in rows)
        self.parent = parent
        self.prefixes = [p for p, _ in counts]
        self.ends = list(accumulate(n for _, n in counts))
        self.total = self.ends[-1] if self.ends else 0

    def locate(self, rank: int) -> tuple[str, int, int]:
        """Prefix that holds the row of this 1-based rank, its rank there, and that bucket's size."""
        at = bisect_left(self.ends, rank)
        before = self.ends[at - 1] if at else 0
        return self.parent + self.prefixes[at], rank - before, self.ends[at] - before


@dataclass(frozen=True)
class Cut:
    """The last row of a stretch in hash order. Rows of equal hash are told apart by ``content``, then by
    ``position``, where the stretch ends among them."""

    h: str
    content: int | None = None
    position: int | None = None


def content_hash(df: DataFrame) -> Column:
    """A 64-bit number of a row's values; columns that cannot be hashed do not count."""
    names = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    return F.xxhash64(*[F.col(f"`{c}`") for c in names])


def hash_keys(df: DataFrame, row_id: str, seed: int) -> DataFrame:
    """(_h, _c, _n): order key, content and position of every row."""
    return df.select(seeded_hash(row_id, seed).alias("_h"), content_hash(df).alias("_c"), F.monotonically_increasing_id().alias("_n"))


def _select_number(rows: DataFrame, name: str, rank: int) -> tuple[int, int]:
    """The value of this 1-based rank in a column of longs, and the rank among the rows of that value.

    Four passes count the next 16 bits, at most 65,536 numbers each.
    """
    value = F.col(name).bitwiseXOR(F.lit(-(1 << 63)))  # in the order of unsigned numbers
    found = 0
    for shift in (48, 32, 16, 0):
        above = shift + 16
        inside = rows if above == 64 else rows.where(F.shiftrightunsigned(value, above) == F.lit(found))
        part = F.shiftrightunsigned(value, shift).bitwiseAND(F.lit(0xFFFF))
        counts = sorted((r["p"], r["n"]) for r in inside.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
        for digit, n in counts:
            if rank <= n:
                break
            rank -= n
        found = (found << 16) | digit
    return found - (1 << 63), rank


def cut_points(keys: DataFrame, top: Histogram, ranks: list[int]) -> list[Cut]:
    """The rows of these exact ranks in the order of hash, content and position.

    Counts per prefix narrow the search 65,536-fold per pass over the id column; only small buckets are read
    as rows, in one pass. Where many rows share a hash, counts over their contents and positions go on, so
    a cut inside an id that repeats costs passes, not rows.
    """
    found, small = [], []
    for rank in ranks:
        prefix, inner, size = top.locate(rank)
        while size > SMALL_BUCKET and len(prefix) < 32:
            prefix, inner, size = Histogram(keys, prefix).locate(inner)
        if size <= SMALL_BUCKET:
            small.append(prefix)
            found.append((prefix, inner, None))
        else:
            same = keys.where(F.col("_h") == prefix)
            content, inner = _select_number(same, "_c", inner)
            position, _ = _select_number(same.where(F.col("_c") == content), "_n", inner)
            found.append((prefix, inner, Cut(prefix, content, position)))
    rows = []
    if small:
        wanted = reduce(or_, [F.col("_h").startswith(prefix) for prefix in small])
        rows = sorted((r["_h"], r["_c"], r["_n"]) for r in keys.where(wanted).collect())  # SMALL_BUCKET rows a rank
    cuts = []
    for prefix, inner, cut in found:
        if cut is None:
            bucket = [row for row in rows if row[0].startswith(prefix)]
            h, content, position = bucket[inner - 1]
            ends_there = inner == len(bucket) or bucket[inner][0] != h
            cut = Cut(h) if ends_there else Cut(h, content, position)
        cuts.append(cut)
    return cuts


def at_or_before(h: Column, content: Column, position: Column, cut: Cut) -> Column:
    if cut.content is None:
        return h <= cut.h
    same = (content < cut.content) | ((content == cut.content) & (position <= cut.position))
    return (h < cut.h) | ((h == cut.h) & same)


def rank_by_hash(df: DataFrame, row_id: str, seed: int, name: str) -> DataFrame:
    """Exact 1-based rank in hash order for a table of any size.

    Rows are ranked inside a hash prefix and shifted by the number of rows before it; the shift
    table has at most 65,536 rows and is broadcast.
    """
    spark = df.sparkSession
    histogram = Histogram(hash_keys(df, row_id, seed).select("_h"))
    before = [0] + histogram.ends[:-1] if histogram.ends else []
    shifts = spark.createDataFrame(list(zip(histogram.prefixes, before)), "_p string, _before bigint")
    hashed = df.withColumn("_h", seeded_hash(row_id, seed)).withColumn("_p", F.substring("_h", 1, PREFIX))
    w = Window.partitionBy("_p").orderBy("_h", row_id)
    return (
        hashed.join(F.broadcast(shifts), "_p")
        .withColumn(name, F.col("_before") + F.row_number().over(w))
        .drop("_p", "_h", "_before")
    )


def row_positions(df: DataFrame, order: str, name: str, rows_per_bucket: int = 1_000_000) -> DataFrame:
    """Exact 0-based position in ``order`` (unique numbers), without one task seeing every row.

    Quantiles of the order column cut the table into ranges of similar size, however clumped the
    numbers are. Positions are counted inside a range and shifted by the ranges before it. Rows travel
    whole, so tables of long rows are cut into more ranges, of ``BUCKET_BYTES`` on average.
    """
    spark = df.sparkSession
    wide = [f"`{f.name}`" for f in df.schema.fields if not isinstance(f.dataType, (NumericType, BooleanType, DatetimeType))]
    width = reduce(add, [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)).cast("long") for c in wide], F.lit(0).cast("long"))
    total, size = df.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    parts = max(total // rows_per_bucket, size // BUCKET_BYTES) + 1
    cuts: list[float] = []
    if parts > 1:
        probabilities = [i / parts for i in range(1, parts)]
        cuts = sorted(set(df.stat.approxQuantile(order, probabilities, 1 / (4 * parts))))
    ordered = df.withColumn("_order", F.col(order).cast("double"))
    if cuts:
        splits = [float("-inf"), *cuts, float("inf")]
        bucketed = Bucketizer(splits=splits, inputCol="_order", outputCol="_bucket").transform(ordered)
    else:
        bucketed = ordered.withColumn("_bucket", F.lit(0.0))
    sizes = {r["_bucket"]: r["n"] for r in bucketed.groupBy("_bucket").agg(F.count("*").alias("n")).collect()}
    shifts, before = [], 0
    for bucket in sorted(sizes):
        shifts.append((bucket, before))
        before += sizes[bucket]
    offsets = spark.createDataFrame(shifts, "_bucket double, _before bigint")
    w = Window.partitionBy("_bucket").orderBy(order)
    return (
        bucketed.join(F.broadcast(offsets), "_bucket")
        .withColumn(name, F.col("_before") + F.row_number().over(w) - 1)
        .drop("_bucket", "_order", "_before")
    )
