"""Mixing sources to target weights by hierarchical budgets.

The tree is domain, then language, then source; its leaves hold the documents. A node of supply S tokens
can give at most ``max_epochs`` x S. The budget goes down the tree: the children of a node share its
budget by their weights, and a child that can give less than its share gives all it can and leaves the
shortage to its siblings, again by weight. As a node never gets more than its leaves can give, a shortage
moves between siblings first and between their ancestors only when a whole subtree is exhausted. Budgets
are whole tokens, rounded down.

A leaf of budget B and supply S takes B // S whole epochs and, from one more epoch in an order seeded by
(seed, epoch, doc_id), the longest prefix of documents that fits the remaining tokens. The prefix is found
without sorting a leaf: tokens are added up by the first four hexadecimal digits of the order key, the
digits where the budget ends are located on those sums (at most 65,536 a leaf), and only documents with
those digits are ranked. Every document is then decided by comparing its key with the leaf's last key.

Null text has no tokens; documents without tokens are never selected. Null keys are nodes of their own,
and a null doc_id is ordered as the empty string. Rows that repeat a doc_id share a key and stand or fall
together. An empty table gives an empty table. Extra columns pass through, also when named like ours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomset.llm.common import fresh, hint_small, packed, unpacked
from loomset.session import materialize

LEVELS = ("domain", "lang", "source")
WORD = r"[^\x20\x09-\x0D]++"
DIGITS = 4
SEED = 11


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(doc_id: Column, seed: int, epoch: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def weight_of(name: str, weights: dict[str, int], default: int = 1) -> Column:
    """Weight of a node by its value at a level; whole numbers keep sums exact."""
    out = F.lit(default)
    for value, weight in weights.items():
        out = F.when(F.col(name) == value, weight).otherwise(out)
    return out.cast("long")


def share_budget(nodes: DataFrame, parent: list[str], budget: Column, tie: str) -> DataFrame:
    """``nodes`` with ``given``: each parent's ``budget`` shared among its children by ``weight`` up to ``able``.

    The children are ordered by able / weight; the exhausted ones are a prefix of that order, and the others
    share what the prefix leaves by weight. One row per node of the tree, never per document.
    """
    ratio = F.col("able") / F.col("weight")
    order = Window.partitionBy(*[F.coalesce(F.col(p), F.lit("\0")) for p in parent] or [F.lit(0)]).orderBy(ratio, F.coalesce(F.col(tie), F.lit("\0")))
    before = F.coalesce(F.sum("able").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    behind = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    level = (budget - before) / behind
    exhausted = level >= ratio
    # Past the first child that is not exhausted all share its level.
    first = F.min(F.when(~exhausted, F.struct(ratio.alias("r"), level.alias("level")))).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    given = F.when(first.isNull() | (ratio < first["r"]), F.col("able")).otherwise(F.least(F.col("able"), F.floor(first["level"] * F.col("weight"))))
    return nodes.withColumn("given", F.greatest(given, F.lit(0)).cast("long"))


def leaf_budgets(leaves: DataFrame, budget: Column | int, weights: dict[str, dict[str, int]], max_epochs: int) -> DataFrame:
    """``leaves`` (domain, lang, source, supply) with ``given`` tokens each."""
    able = leaves.withColumn("able", F.col("supply") * max_epochs)
    given: DataFrame | None = None
    for depth in range(1, len(LEVELS) + 1):
        level, above = list(LEVELS[:depth]), list(LEVELS[: depth - 1])
        nodes = able.groupBy(*level).agg(F.sum("able").alias("able")).withColumn("weight", weight_of(level[-1], weights.get(level[-1], {})))
        if given is None:
            nodes = nodes.withColumn("budget", budget if isinstance(budget, Column) else F.lit(budget))
        else:
            up = given.select(*[F.col(c).alias(f"up_{c}") for c in above], F.col("given").alias("budget"))
            same = None
            for c in above:
                equal = F.col(c).eqNullSafe(F.col(f"up_{c}"))
                same = equal if same is None else same & equal
            nodes = nodes.join(up, same).drop(*[f"up_{c}" for c in above])
        given = share_budget(nodes, above, F.col("budget"), level[-1]).select(*level, "given", "able")
    return given.select(*LEVELS, (F.col("able") / max_epochs).cast("long").alias("supply"), "given")


def mix(
    docs: DataFrame,
    domain: Column,
    weights: dict[str, dict[str, int]],
    share: float = 0.6,
    max_epochs: int = 2,
    seed: int = SEED,
    text: str = "text",
) -> DataFrame:
    """The selected documents with ``domain``, ``n_tokens`` and ``epochs``, the number of times each is taken.

    The budget is ``share`` of all tokens, rounded down.
    """
    if any(w <= 0 for level in weights.values() for w in level.values()):
        raise ValueError("weights are positive whole numbers")
    (row,) = fresh(docs, "_row")
    keep, names = packed(docs)
    domain_name, tokens_name, epochs_name = fresh(docs, "domain", "n_tokens", "epochs")
    rows = docs.select(
        keep.alias(row), F.col("doc_id").alias("doc_id"), domain.cast("string").alias("domain"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
        token_count(F.col(f"`{text}`")).alias("n"),
    )
    narrow = materialize(rows.where("n > 0").groupBy(*LEVELS, "doc_id").agg(F.sum("n").alias("n")), "tokens")
    supply = narrow.groupBy(*LEVELS).agg(F.sum("n").alias("supply"))
    budget = F.floor(F.lit(share) * F.lit(narrow.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long")).first()[0]))
    leaves = materialize(
        leaf_budgets(supply, budget, weights, max_epochs)
        .withColumn("whole", F.expr("given div supply"))
        .withColumn("left", F.expr("given % supply"))
        .withColumn("leaf", F.md5(F.concat_ws("\1", *[F.coalesce(F.col(c), F.lit("\2")) for c in LEVELS]))),
        "leaves",
    )
    small = hint_small(leaves, leaves.count(), 128)
    named = small.select(*[F.col(c).alias(f"leaf_{c}") for c in LEVELS], "leaf", "whole", "left")
    # Null-safe equality as an equi-join: null is one value of each key.
    key = lambda c: F.coalesce(c, F.lit("\2"))
    same = None
    for c in LEVELS:
        equal = key(F.col(c)) == key(F.col(f"leaf_{c}"))
        same = equal if same is None else same & equal
    placed = narrow.join(named, same).select("leaf", "left", "n", order_key(F.col("doc_id"), seed, F.col("whole")).alias("key"))
    placed = placed.where("left > 0").withColumn("digits", F.substring("key", 1, DIGITS))
    sums = placed.groupBy("leaf", "left", "digits").agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("leaf").orderBy("digits"))
    ends = sums.withColumn("upto", upto).where("upto > left").groupBy("leaf").agg(F.min(F.struct("digits", (F.col("left") - F.col("upto") + F.col("n")).alias("room"))).alias("e"))
    ends = materialize(ends.select("leaf", "e.digits", "e.room"), "ends")
    ranked = placed.select("leaf", "digits", "key", "n").join(hint_small(ends, ends.count(), 64), ["leaf", "digits"])
    ranked = ranked.groupBy("leaf", "digits", "room", "key").agg(F.sum("n").alias("n"))
    inside = ranked.withColumn("upto", F.sum("n").over(Window.partitionBy("leaf", "digits").orderBy("key"))).where("upto <= room")
    last = inside.groupBy("leaf").agg(F.max("key").alias("last"))
    # Keys up to ``last`` are in; without one, keys below the digits where the budget ends; without those, all.
    cuts = leaves.join(ends.select("leaf", "digits"), "leaf", "left").join(last, "leaf", "left")
    cuts = materialize(cuts.select(*[F.col(c).alias(f"leaf_{c}") for c in LEVELS], "whole", "left", F.coalesce("last", "digits").alias("last")), "cuts")
    chosen = rows.join(hint_small(cuts, cuts.count(), 160), same)
    taken = F.when(F.col("left") == 0, 0).when(F.col("last").isNull(), 1).otherwise((order_key(F.col("doc_id"), seed, F.col("whole")) <= F.col("last")).cast("int"))
    out = chosen.withColumn("epochs", (F.col("whole") + taken).cast("long")).where("n > 0 AND epochs > 0")
    return out.select(*unpacked(row, names), F.col("domain").alias(domain_name), F.col("n").alias(tokens_name), F.col("epochs").alias(epochs_name))
