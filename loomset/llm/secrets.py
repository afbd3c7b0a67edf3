"""Secret scans: fixed patterns, and two character Markov models for strings that only look random.

``labelled_samples`` takes both classes from the documents themselves: values that a fixed pattern
already marks as keys are samples of random strings, every other distinct identifier is a sample of
ordinary ones. ``train_models`` counts character transitions per class over all samples and keeps the
log-likelihood ratio of each transition, at most ``len(ALPHABET) ** 2`` numbers with add-one smoothing.
Half of the random model's weight is what the marked keys show, the other half is even draws from the
alphabets keys are written in, so neither few keys nor keys of one alphabet shut out the others.
Transitions with punctuation are left out: identifiers hold none, so they would tell nothing.

``find_secrets`` adds to the fixed kinds every long run of key characters, with a letter and a digit,
whose mean ratio per transition reaches ``min_ratio``. By default the cut comes from the models: a run
must reach what strings drawn from its alphabet reach at its length, ``SPREADS`` standard deviations
below their mean, and lie no nearer to the ordinary samples' mean than to theirs, in standard deviations.
Without ordinary samples there is nothing to set apart, and no run is found.

Null text counts as empty and gives no spans. An empty table gives an empty table; repeated rows and
null ids are scanned row by row; extra columns pass through, also when named like ours.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.llm.common import fresh, packed, unpacked
from loomset.llm.spans import listed, located, matches, replaced

KINDS = ("assign", "access", "hex", "random")
BASE = KINDS[:3]
_DIGITS, _UPPER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABET = _UPPER + _UPPER.lower() + _DIGITS
SPREADS = 3.0
# The alphabets of keys, smallest first, with what no string of one contains.
KEY_ALPHABETS = (
    (_DIGITS + "abcdef", "[g-zA-Z]"),
    (_DIGITS + "ABCDEF", "[a-zG-Z]"),
    (_DIGITS + _UPPER.lower(), "[A-Z]"),
    (_DIGITS + _UPPER, "[a-z]"),
    (ALPHABET, None),
)

_ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)"""
_ASSIGN_VALUE = r"""(?i)^(?:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?"""
_PATTERN = {
    "assign": _ASSIGN,
    "access": r"AKIA[A-Z0-9]{16,}+",
    "hex": r"(?<![0-9a-f])[0-9a-f]{24,}+",
    "random": r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+",
}
_IDENTIFIER = r"(?<![A-Za-z0-9_])[A-Za-z_][A-Za-z0-9_]{5,}+"


class Models(NamedTuple):
    """``ratios`` by transition, row-major over ``ALPHABET``; per key alphabet the ratio that is equally far
    from both classes, and mean and standard deviation of the ratios of its even draws."""

    ratios: list[float]
    limits: list[tuple[float, float, float]]


def _guard(text: Column, kind: str) -> Column | None:
    return {"assign": text.contains(":") | text.contains("="), "access": text.contains("AKIA")}.get(kind)


def _value(kind: str, match: Column) -> Column:
    return F.regexp_replace(match, _ASSIGN_VALUE, "") if kind == "assign" else match


def labelled_samples(df: DataFrame, text: str = "text") -> DataFrame:
    """(value, label): 1 for distinct key strings marked by a fixed pattern, 0 for other distinct identifiers."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))

    def keys(kind: str) -> Column:
        found = matches(body, _PATTERN[kind], _guard(body, kind))
        return F.transform(found, lambda m: F.struct(_value(kind, m).alias("value"), F.lit(1).alias("label")))

    plain = F.transform(matches(body, _IDENTIFIER), lambda m: F.struct(m.alias("value"), F.lit(0).alias("label")))
    # The outer form keeps the optimizer from inferring a filter that would run the patterns twice.
    rows = df.select(F.explode_outer(F.concat(*[keys(k) for k in BASE], plain)).alias("s")).select("s.value", "s.label")
    marked = F.col("value").rlike("[0-9a-f]{24,}") | F.col("value").contains("AKIA")
    keyed = (F.length("value") >= 16) & F.col("value").rlike("[0-9]")
    return rows.where(F.when(F.col("label") == 1, keyed).otherwise(~marked)).distinct()


def _moments(weighted: list[tuple[float, int]]) -> tuple[float, float]:
    total = sum(w for _, w in weighted)
    mean = sum(x * w for x, w in weighted) / total
    return mean, math.sqrt(sum((x - mean) ** 2 * w for x, w in weighted) / total)


def _limits(ratios: dict[str, float], ordinary: dict[str, int]) -> list[tuple[float, float, float]]:
    plain, plain_spread = _moments([(ratios[p], n) for p, n in ordinary.items()]) if ordinary else (math.inf, 0.0)
    out = []
    for chars, _ in KEY_ALPHABETS:
        mean, spread = _moments([(ratios[a + b], 1) for a in chars for b in chars])
        apart = plain < mean and plain_spread + spread > 0
        out.append(((mean * plain_spread + plain * spread) / (plain_spread + spread) if apart else math.inf, mean, spread))
    return out


def train_models(samples: DataFrame) -> Models:
    """Log-likelihood ratio random : ordinary of each transition, and the cuts that follow from it.

    ``samples`` has ``value`` and ``label`` (1 random, 0 ordinary). The counts cover all samples; what
    reaches the driver is one number per class and transition, whatever the corpus holds.
    """
    steps = F.filter(
        F.transform(F.sequence(F.lit(1), F.greatest(F.length("value") - 1, F.lit(1))), lambda i: F.substring(F.col("value"), i, F.lit(2))),
        lambda pair: F.length(pair) == 2,
    )
    known = (F.instr(F.lit(ALPHABET), F.substring("pair", 1, 1)) > 0) & (F.instr(F.lit(ALPHABET), F.substring("pair", 2, 1)) > 0)
    counted = (
        samples.where("value IS NOT NULL AND label IN (0, 1)")
        .select("label", F.explode_outer(steps).alias("pair"))
        .where(known)
        .groupBy("label", "pair")
        .count()
        .collect()
    )
    counts = {(r["label"], r["pair"]): r["count"] for r in counted}
    ratios = {}
    for a in ALPHABET:
        row = {k: [counts.get((k, a + b), 0) + 1 for b in ALPHABET] for k in (0, 1)}
        total = {k: sum(v) for k, v in row.items()}
        drawn = [chars for chars, _ in KEY_ALPHABETS if a in chars]
        for j, b in enumerate(ALPHABET):
            even = sum((b in chars) / len(chars) for chars in drawn) / len(drawn)
            ratios[a + b] = math.log((row[1][j] / total[1] + even) / 2) - math.log(row[0][j] / total[0])
    return Models(list(ratios.values()), _limits(ratios, {pair: n for (label, pair), n in counts.items() if label == 0}))


def _reaches(value: Column, ratio: Column, model: Models) -> Column:
    """Whether ``ratio``, the mean of ``value``, reaches the cut of the smallest alphabet that ``value`` is written in."""
    steps = F.size(F.regexp_extract_all(value, F.lit("[A-Za-z0-9](?=[A-Za-z0-9])"), F.lit(0)))
    cut = F.lit(math.inf)
    for (_, outside), (even, mean, spread) in reversed(list(zip(KEY_ALPHABETS, model.limits, strict=True))):
        own = F.greatest(F.lit(even), F.lit(mean) - F.lit(SPREADS * spread) / F.sqrt(F.greatest(steps, F.lit(1))))
        cut = own if outside is None else F.when(value.rlike(outside), cut).otherwise(own)
    return (steps > 0) & (ratio >= cut)


def mean_ratio(value: Column, model: Models) -> Column:
    """Mean log-likelihood ratio per transition; characters outside the alphabet end a transition."""
    table = F.split(F.lit(",".join(f"{x:.4f}" for x in model.ratios)), ",").cast("array<double>")
    codes = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"), F.lit(0).alias("n"))

    def step(acc: Column, code: Column) -> Column:
        counted = (acc["last"] >= 0) & (code >= 0)
        ratio = F.when(counted, F.get(table, acc["last"] * len(ALPHABET) + code)).otherwise(0.0)
        return F.struct(code.alias("last"), (acc["sum"] + ratio).alias("sum"), (acc["n"] + counted.cast("int")).alias("n"))

    return F.aggregate(codes, start, step, lambda acc: F.when(acc["n"] > 0, acc["sum"] / acc["n"]).otherwise(0.0))


def find_secrets(
    df: DataFrame, model: Models, text: str = "text", spans: str = "secrets", min_ratio: float | None = None
) -> DataFrame:
    """``df`` with ``spans``: an array of (start, end, value, kind, rank, ratio), by start and rank."""
    row, body, *founds = fresh(df, "_row", "_text", *[f"_{k}" for k in KINDS])
    keep, names = packed(df)
    work = df.select(keep.alias(row), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(body))
    for kind, column in zip(KINDS, founds, strict=True):
        work = work.withColumn(column, matches(F.col(body), _PATTERN[kind], _guard(F.col(body), kind)))

    def of(kind: str, column: str) -> Column:
        def described(s: Column) -> Column:
            return F.struct(
                s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), F.lit(kind).alias("kind"),
                F.lit(KINDS.index(kind)).alias("rank"), F.round(mean_ratio(_value(kind, s["value"]), model), 3).alias("ratio"),
            )

        found = located(F.col(body), _PATTERN[kind], F.col(column))
        if kind == "assign":
            found = F.filter(found, lambda s: F.length(_value(kind, s["value"])) >= 6)
        if kind == "random":
            found = F.filter(found, lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]"))
            reaches = lambda s: _reaches(s["value"], s["ratio"], model) if min_ratio is None else s["ratio"] >= min_ratio
            return F.filter(F.transform(found, described), reaches)
        return F.transform(found, described)

    (name,) = fresh(df, spans)
    both = F.concat(*[of(k, c) for k, c in zip(KINDS, founds, strict=True)])
    order = F.array_sort(both, lambda a, b: F.when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1)).otherwise(a["rank"] - b["rank"]))
    return work.select(F.col(row), order.alias(name)).select(*unpacked(row, names), name)


def redact_secrets(df: DataFrame, model: Models, text: str = "text", min_ratio: float | None = None) -> DataFrame:
    """``df`` with every found span of ``text`` replaced by ``[KIND]``; other columns and null texts stay."""
    (spans,) = fresh(df, "_secrets")
    found = find_secrets(df, model, text, spans, min_ratio)
    return found.withColumn(text, replaced(F.col(f"`{text}`"), F.col(spans))).select(*[f"`{c}`" for c in df.columns])


def secrets_digest(df: DataFrame, text: str = "text", min_ratio: float | None = None) -> DataFrame:
    """One row per document: counts of the fixed kinds, a digest of their spans, and all spans."""
    docs = df.select("doc_id", F.col(f"`{text}`").alias("text"))
    model = train_models(labelled_samples(docs))
    found = find_secrets(docs, model, min_ratio=min_ratio)
    base = F.filter("secrets", lambda s: s["rank"] < len(BASE))
    of = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[of(k).alias(f"n_{k}") for k in BASE],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"),
        of("random").alias("n_random"),
        F.array_max(F.transform("secrets", lambda s: s["ratio"])).alias("top_ratio"),
    )
