"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Every kind has a pattern, a check and a prior score. A confirmed checksum raises the score, a word of
the kind within ``CONTEXT_CHARS`` raises it further. The base kinds (email, ip, card, phone) are kept
whenever their check holds; the further kinds (iban, ssn) only from ``min_score`` upward, which a
number without a checksum reaches only beside a context word.

Patterns are written for the JVM so that they cost one linear pass: possessive repetition where the
next character cannot belong to the repeated class, and look-behinds that skip starts inside a run a
match would have begun earlier. They find the same spans as the plain forms.

An account code may be written in groups, so words and numbers after it look like more of it. Its
pattern therefore proposes only heads, with the run behind each, and the checksum is tested at every
end of a group. The end at the length of the code's country wins, else the longest that passes; a code
inside the one before it is dropped.

Null text counts as empty and gives no spans. An empty table gives an empty table; repeated rows and
null ids are scanned row by row; extra columns pass through, also when named like ours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.llm.common import fresh, packed, unpacked
from loomset.llm.spans import chunked, cut, digits, listed, located, luhn, matches, mod97, reached, replaced

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = KINDS[:4]
CONTEXT_CHARS = 40
MIN_SCORE = 0.6

_PATTERN = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # Matches the head; group 1 is the run of a longest code, and one more character if it goes on.
    "iban": r"(?<![A-Z0-9])(?=([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+[A-Z0-9]?))[A-Z]{2}[0-9]{2}",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
IBAN_CHARS = (15, 34)
# Characters of an account code by country.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
# Score before checks, gain of a passed checksum, gain of a context word.
_SCORES = {
    "email": (0.9, 0.0, 0.1),
    "ip": (0.6, 0.0, 0.3),
    "card": (0.3, 0.4, 0.3),
    "phone": (0.6, 0.0, 0.3),
    "iban": (0.2, 0.6, 0.2),
    "ssn": (0.4, 0.0, 0.4),
}
_CONTEXT = {
    "email": r"\b(e-?mail|mail|contact|write)\b",
    "ip": r"\b(ip|host|server|address|login)\b",
    "card": r"\b(card|visa|mastercard|amex|credit|debit|payment)\b",
    "phone": r"\b(phone|tel|call|mobile|fax|contact)\b",
    "iban": r"\b(iban|account|bank|konto)\b",
    "ssn": r"\b(ssn|social|security|tax)\b",
}


def _guard(text: Column, kind: str) -> Column:
    """A cheap test that every match implies."""
    return {
        "email": text.contains("@"),
        "phone": text.contains("+"),
        "ip": text.contains("."),
        "ssn": text.contains("-"),
    }.get(kind, text.rlike("[0-9]"))


def _small_part(part: Column) -> Column:
    """A number of any length that is at most 255."""
    bare = F.ltrim(part, F.lit("0"))
    return F.when(F.length(bare) > 3, False).when(bare == "", True).otherwise(bare.try_cast("int") <= 255)


def _holds(kind: str, value: Column) -> Column:
    number = digits(value)
    count = F.length(number)
    return {
        "email": F.lit(True),
        "ip": F.forall(F.split(value, r"\."), _small_part),
        "card": F.when(count.between(12, 19), luhn(number)).otherwise(False),
        "phone": count.between(9, 15),
        "ssn": ~F.substring(value, 1, 3).isin("000", "666") & ~value.startswith("9"),
    }[kind]


def _account(window: Column) -> Column:
    """The account code that ``window`` begins with, or null."""
    country = F.substring(window, 1, 2)
    usual = F.lit(None).cast("int")
    for length, countries in _IBAN_LENGTHS.items():
        usual = F.when(country.isin(*countries.split()), length).otherwise(usual)
    ends = F.filter(
        F.sequence(F.lit(IBAN_CHARS[0]), F.length(window)), lambda end: F.substring(window, end, F.lit(2)).rlike("^[A-Z0-9](?![A-Z0-9])")
    )
    bare = lambda value: F.regexp_replace(value, " ", "")
    codes = F.filter(
        F.transform(ends, lambda end: F.substring(window, F.lit(1), end)),
        lambda v: F.when(F.length(bare(v)).between(*IBAN_CHARS), mod97(bare(v))).otherwise(False),
    )
    whole = F.filter(codes, lambda v: F.length(bare(v)) == usual)
    return F.coalesce(F.get(whole, F.lit(0)), F.try_element_at(codes, F.lit(-1)))


def _accounts(text: Column, windows: Column) -> Column:
    """``windows``, the runs behind every head, as an array of ``SPAN`` of the confirmed codes."""
    heads = located(text, _PATTERN["iban"], F.transform(windows, lambda w: F.substring(w, 1, 4)))
    codes = F.zip_with(heads, F.transform(windows, _account), lambda s, value: F.struct(
        s["start"].alias("start"), (s["start"] + F.length(value)).alias("end"), value.alias("value"),
    ))
    passed = F.filter(codes, lambda s: s["value"].isNotNull())
    ended = F.zip_with(passed, reached(passed), lambda s, at: F.struct(s.alias("span"), (s["end"] > at).alias("beyond")))
    return F.transform(F.filter(ended, lambda s: s["beyond"]), lambda s: s["span"])


def find_pii(
    df: DataFrame, text: str = "text", spans: str = "pii", kinds: tuple[str, ...] = KINDS, min_score: float = MIN_SCORE
) -> DataFrame:
    """``df`` with ``spans``: an array of (start, end, value, kind, rank, score), by start and rank."""
    row, body, chunks, *founds = fresh(df, "_row", "_text", "_chunks", *[f"_{k}" for k in kinds])
    keep, names = packed(df)
    work = df.select(keep.alias(row), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(body))
    for kind, column in zip(kinds, founds, strict=True):
        work = work.withColumn(column, matches(F.col(body), _PATTERN[kind], _guard(F.col(body), kind), int(kind == "iban")))
    proposed = F.greatest(*[F.size(c) for c in founds], F.lit(0)) > 0
    work = work.withColumn(chunks, F.when(proposed, chunked(F.col(body))))

    def scored(kind: str, found: str) -> Column:
        prior, checked, nearby = _SCORES[kind]

        def score(s: Column) -> Column:
            before = cut(F.col(chunks), F.greatest(s["start"] - CONTEXT_CHARS, F.lit(0)), s["start"])
            after = cut(F.col(chunks), s["end"], s["end"] + CONTEXT_CHARS)
            near = F.lower(F.concat(before, F.lit(" "), after)).rlike(_CONTEXT[kind])
            value = F.lit(prior + checked) + F.when(near, nearby).otherwise(0.0)
            return F.struct(
                s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), F.lit(kind).alias("kind"),
                F.lit(KINDS.index(kind)).alias("rank"), F.round(F.least(value, F.lit(1.0)), 2).alias("score"),
            )

        if kind == "iban":
            held = _accounts(F.col(body), F.col(found))
        else:
            held = F.filter(located(F.col(body), _PATTERN[kind], F.col(found)), lambda s: _holds(kind, s["value"]))
        out = F.transform(held, score)
        return out if kind in BASE else F.filter(out, lambda s: s["score"] >= min_score)

    each = [scored(k, c) for k, c in zip(kinds, founds, strict=True)]
    (name,) = fresh(df, spans)
    sorted_spans = F.array_sort(F.concat(*each), lambda a, b: F.when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1)).otherwise(a["rank"] - b["rank"]))
    return work.select(F.col(row), sorted_spans.alias(name)).select(*unpacked(row, names), name)


def redact_pii(df: DataFrame, text: str = "text", kinds: tuple[str, ...] = KINDS, min_score: float = MIN_SCORE) -> DataFrame:
    """``df`` with every found span of ``text`` replaced by ``[KIND]``; other columns and null texts stay."""
    (spans,) = fresh(df, "_pii")
    found = find_pii(df, text, spans, kinds, min_score)
    return found.withColumn(text, replaced(F.col(f"`{text}`"), F.col(spans))).select(*[f"`{c}`" for c in df.columns])


def pii_digest(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: counts of the base kinds, a digest of the base spans, and all spans."""
    found = find_pii(df.select("doc_id", F.col(f"`{text}`").alias("text")))
    base = F.filter("pii", lambda s: s["rank"] < len(BASE))
    of = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[of(k).alias(f"n_{k}") for k in BASE],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("pii")).alias("spans"),
        *[of(k).alias(f"n_{k}") for k in KINDS[len(BASE):]],
        F.array_max(F.transform("pii", lambda s: s["score"])).alias("top_score"),
    )
