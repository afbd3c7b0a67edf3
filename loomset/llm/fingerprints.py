"""Document fingerprints: SimHash, and all fingerprints within a Hamming radius by permuted block tables.

Terms are pairs of neighbouring lower-cased words (a text of one word has that word), weighted by their
occurrences times their length, at most ``MAX_WEIGHT``. Each occurrence votes with its weight on 64 signed
bits; a bit is set if more than half of the weight votes for it. Two bits share a 64-bit sum, so votes of a
document may add up to 2^32. A text without words has the fingerprint 0.

Search: fingerprints are cut into ``blocks`` blocks; two within ``radius`` bits agree on at least
``blocks - radius`` of them. There is one table for every choice of that many blocks, keyed by their bits,
and only fingerprints that share a key are compared: exact for every radius below ``blocks``. Equal
fingerprints are one entry with a count, so groups of copies make no pairs, and a pair is counted in the
first table that has it.

Null text counts as empty. Documents are ordered by doc_id, null ids first, rows that repeat an id by their
text. An empty table gives an empty table. Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomset.llm.common import hint_small
from loomset.session import materialize

MAX_WEIGHT = 64
RADIUS = 3
BLOCKS = 6
_LANES = (1 << 32) + 1
_LOW = (1 << 32) - 1
_FIRST = -(1 << 63)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def terms(text: Column) -> Column:
    """Words of a text; ``votes`` pairs them up."""
    return F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")


def votes(words: Column) -> Column:
    """(hash, weight) of every term."""
    n = F.size(words)
    at = F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - 2, F.lit(0)))).otherwise(F.array().cast("array<int>"))

    def vote(i: Column) -> Column:
        a, b = F.get(words, i), F.coalesce(F.get(words, i + 1), F.lit(""))
        return F.struct(F.xxhash64(a, b).alias("hash"), F.least(F.length(a) + F.length(b), F.lit(MAX_WEIGHT)).cast("long").alias("weight"))

    return F.transform(at, vote)


def tally(rows: DataFrame, keys: list[str], words: str) -> DataFrame:
    """``keys`` with ``print``, the fingerprint of the words in ``words``; ``keys`` tell rows apart."""
    # The outer form keeps rows without terms and keeps the optimizer from computing the votes twice.
    each = rows.select(*keys, votes(F.col(words)).alias("vote")).select(*keys, F.explode_outer("vote").alias("vote"))
    cast = each.select(*keys, F.coalesce("vote.hash", F.lit(0)).alias("hash"), F.coalesce("vote.weight", F.lit(0)).cast("long").alias("weight"))
    lanes = [F.sum(F.shiftrightunsigned("hash", b).bitwiseAND(F.lit(_LANES)) * F.col("weight")).alias(f"lane{b}") for b in range(32)]
    summed = cast.groupBy(*keys).agg(F.sum("weight").alias("weight"), *lanes)
    bits = []
    for b in range(32):
        low, high = F.col(f"lane{b}").bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(f"lane{b}", 32)
        bits.append(F.when(low * 2 > F.col("weight"), F.lit(1 << b)).otherwise(F.lit(0)).cast("long"))
        bits.append(F.when(high * 2 > F.col("weight"), F.lit(_signed(1 << (b + 32)))).otherwise(F.lit(0)).cast("long"))
    return summed.select(*keys, reduce(lambda x, y: x.bitwiseOR(y), bits).alias("print"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def hexadecimal(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def block_masks(radius: int = RADIUS, blocks: int = BLOCKS) -> list[int]:
    """The bits of each table's key, as signed 64-bit masks."""
    if not 0 <= radius < blocks <= 64:
        raise ValueError("the radius is below the number of blocks")
    edges = [64 * i // blocks for i in range(blocks + 1)]
    whole = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    return [_signed(sum(c)) for c in combinations(whole, blocks - radius)]


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(query, print, n, distance): for each distinct query the fingerprints within ``radius`` and their rows.

    Both sides have a long column ``print``.
    """
    masks = block_masks(radius, blocks)

    def tables(df: DataFrame, name: str) -> DataFrame:
        keys = F.array(*[F.struct(F.lit(t).alias("t"), F.col(name).bitwiseAND(F.lit(m)).alias("bits")) for t, m in enumerate(masks)])
        return df.withColumn("k", F.explode(keys)).select(*df.columns, F.col("k.t").alias("t"), F.col("k.bits").alias("bits"))

    asked = tables(queries.where("print IS NOT NULL").select(F.col("print").alias("query")).distinct(), "query")
    kept = tables(prints.where("print IS NOT NULL").groupBy("print").agg(F.count("*").alias("n")), "print")
    differ = F.col("query").bitwiseXOR(F.col("print"))
    first = F.lit(len(masks))
    for t in range(len(masks) - 1, -1, -1):
        first = F.when(differ.bitwiseAND(F.lit(masks[t])) == 0, t).otherwise(first)
    found = asked.join(kept, ["t", "bits"]).where((F.bit_count(differ) <= radius) & (F.col("t") == first))
    return found.select("query", "print", "n", F.bit_count(differ).alias("distance"))


def _bucket(key: Column, firsts: list[int]) -> Column:
    """Index of the last of the sorted ``firsts`` not above ``key``, by counting in two steps."""
    step = max(1, isqrt(len(firsts)))
    all_ = F.array(*[F.lit(x).cast("long") for x in firsts])
    coarse = F.array(*[F.lit(x).cast("long") for x in firsts[::step]])
    jump = (F.size(F.filter(coarse, lambda x: x <= key)) - 1) * step
    return jump + F.size(F.filter(F.slice(all_, jump + 1, F.lit(step)), lambda x: x <= key)) - 1


def neighbours(docs: DataFrame, text: str = "text") -> DataFrame:
    """(bucket, place, extra, doc_id, text, next): every document with the text of the next by doc_id.

    Ids are cut at quantiles into a few buckets per shuffle partition. The first document of a bucket is
    also sent to the bucket before it (the very first to the last), so every document meets its successor
    in its own bucket. ``extra`` marks those copies.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    key = F.coalesce(F.col("doc_id"), F.lit(_FIRST))
    n = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = rows.agg(F.min(key).alias("low"), F.percentile_approx(key, [i / n for i in range(1, n)], 100 * n).alias("cuts")).first()
    firsts = sorted({found["low"], *(found["cuts"] or [])} - {None}) or [_FIRST]
    last = len(firsts) - 1
    own = rows.withColumn("bucket", _bucket(key, firsts))
    leads = F.element_at(F.array(*[F.lit(x).cast("long") for x in firsts]), F.col("bucket") + 1) == key
    before = F.when(F.col("bucket") == 0, F.lit(last)).otherwise(F.col("bucket") - 1)
    here = F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("extra"))
    there = F.struct(before.alias("bucket"), F.lit(1).alias("extra"))
    sent = own.select("doc_id", "text", F.explode(F.when(leads, F.array(here, there)).otherwise(F.array(here))).alias("to"))
    placed = sent.select("to.bucket", "to.extra", "doc_id", "text")
    order = Window.partitionBy("bucket").orderBy("extra", F.col("doc_id").asc_nulls_first(), "text")
    return placed.select("bucket", F.row_number().over(order).alias("place"), "extra", "doc_id", "text", F.lead("text").over(order).alias("next"))


def edited(text: Column, following: Column) -> Column:
    """The last half of the code points replaced by as many of the first of ``following``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(F.coalesce(following, F.lit("")), F.lit(1), half))


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, print): the fingerprint of every row."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", terms(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("words"))
    return tally(rows, ["row", "doc_id"], "words").select("doc_id", "print")


def fingerprint_digest(docs: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """One row per document: fingerprints of its text and edited text, likenesses, and for every twentieth
    id ``n_near``, the number of other rows within ``radius`` bits (null for the rest)."""
    near = neighbours(docs)
    change = edited(F.col("text"), F.col("next"))
    # The successor copies need no edited text.
    made = near.select("bucket", "place", "extra", "doc_id", "text", F.when(F.col("extra") == 0, change).otherwise(F.lit("")).alias("edited"))
    sized = made.select(
        "bucket", "place", "extra", "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("text")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text"))).alias("both"),
    )
    keys = ["bucket", "place", "extra", "doc_id", "n_chars", "edited_sha256"]
    rows = sized.select(*keys, F.explode_outer("both").alias("b")).select(*keys, F.col("b.kind").alias("kind"), terms(F.col("b.text")).alias("words"))
    each = tally(rows, [*keys, "kind"], "words")
    of = lambda k: F.max(F.when(F.col("kind") == k, F.col("print")))
    wide = each.groupBy(*keys).agg(of(0).alias("own"), of(1).alias("changed"))
    following = F.lead("own").over(Window.partitionBy("bucket").orderBy("place"))
    prints = materialize(wide.withColumn("next", following).where("extra = 0").drop("extra", "bucket", "place"), "prints")

    asked = (F.col("doc_id") % 20 == 0)
    counted = within_radius(prints.where(asked).select(F.col("own").alias("print")), prints.select(F.col("own").alias("print")), radius, blocks)
    counts = materialize(counted.groupBy(F.col("query").alias("own")).agg((F.sum("n") - 1).alias("n_near")), "near_counts")
    out = prints.join(hint_small(counts, counts.count(), 16), "own", "left")
    return out.select(
        "doc_id", "n_chars", "edited_sha256",
        hexadecimal(F.col("own")).alias("fingerprint"), hexadecimal(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"), likeness(F.col("own"), F.coalesce("next", "own")).alias("near_next"),
        F.when(asked, F.col("n_near")).alias("n_near"),
    )
