"""Spans of regular-expression matches as columns, without leaving the JVM.

Positions are code points, the end exclusive. ``split`` and ``regexp_extract_all`` walk the same
matches, so the lengths of gaps and matches add up to positions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:int,end:int,value:string>"
# Values that one running combination gathers, and code points of a piece of text.
BLOCK = 64
CHUNK = 512


def matches(text: Column, pattern: str, guard: Column | None = None, group: int = 0) -> Column:
    """``group`` of all leftmost, non-overlapping matches. ``guard`` is a cheap test that every match implies."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    return found if guard is None else F.when(guard, found).otherwise(F.array().cast("array<string>"))


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often it occurs."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _steps(values: Column, combine) -> Column:
    """0, then every value combined with all before it."""
    return F.aggregate(values, F.array(F.lit(0)), lambda acc, x: F.array_append(acc, combine(F.element_at(acc, -1), x)))


def running(values: Column, combine, levels: int = 2) -> Column:
    """For each of ``values`` (whole numbers) all before it combined, 0 for the first; ``combine`` is associative.

    ``aggregate`` copies what it has gathered at every step, so it only ever sees ``BLOCK`` values, or the
    results of the blocks of the last level: the cost is linear in the values.
    """

    def shifted(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.element_at(b, -1))
        bases = running(totals, combine, levels - 1) if levels > 1 else _steps(totals, combine)
        inner = F.zip_with(
            blocks, F.slice(bases, F.lit(1), F.size(blocks)),
            lambda b, base: F.transform(F.slice(b, F.lit(1), F.size(b) - 1), lambda x: combine(base, x)),
        )
        return F.flatten(inner)

    def in_blocks(v: Column) -> Column:
        last = F.floor((F.size(v) - 1) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda k: _steps(F.slice(v, k * BLOCK + 1, F.lit(BLOCK)), combine))
        return _let(blocks, shifted)

    return _let(values, lambda v: F.when(F.size(v) > 0, in_blocks(v)).otherwise(F.array().cast("array<int>")))


def reached(spans: Column) -> Column:
    """For each span the furthest end of those before it, 0 for the first."""
    return running(F.transform(spans, lambda s: s["end"]), F.greatest)


def located(text: Column, pattern: str, found: Column) -> Column:
    """``found``, the matches of ``pattern`` in ``text``, as an array of ``SPAN``."""
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    pairs = F.zip_with(found, gaps, lambda value, gap: F.struct(value.alias("value"), F.length(gap).alias("gap")))

    def placed(p: Column) -> Column:
        before = running(F.transform(p, lambda x: x["gap"] + F.length(x["value"])), lambda a, b: a + b)

        def span(x: Column, at: Column) -> Column:
            start = at + x["gap"]
            return F.struct(start.alias("start"), (start + F.length(x["value"])).alias("end"), x["value"].alias("value"))

        return F.zip_with(p, before, span)

    return F.when(F.size(found) > 0, _let(pairs, placed)).otherwise(F.array().cast(f"array<{SPAN}>"))


def chunked(text: Column) -> Column:
    """``text`` as consecutive pieces of ``CHUNK`` code points, so that ``cut`` need not count from its start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def cut(chunks: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` (exclusive, clipped at the text's end) of a ``chunked`` text."""
    first = F.floor(start / CHUNK).cast("int")
    held = F.slice(chunks, first + 1, F.floor((end - 1) / CHUNK).cast("int") - first + 1)
    return F.when(end > start, F.substring(F.array_join(held, ""), start - first * CHUNK + 1, end - start)).otherwise("")


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    doubled = F.transform(
        F.split(F.reverse(number), ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            F.when(c.cast("int") < 5, c.cast("int") * 2).otherwise(c.cast("int") * 2 - 9)
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account code of A-Z and 0-9 passes the mod-97 check: the first four characters move to
    the end, letters count 10 to 35, and the number leaves 1."""
    turned = F.concat(F.substring(code, 5, 1_000), F.substring(code, 1, 4))

    def step(acc: Column, c: Column) -> Column:
        value = F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1
        return (acc * F.when(value < 10, 10).otherwise(100) + value) % 97

    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def listed(spans: Column) -> Column:
    """``kind:start:end`` by start, then rank of the kind, comma-joined."""
    keys = F.transform(spans, lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"]))
    return F.array_join(
        F.transform(F.array_sort(keys), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def replaced(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by ``[KIND]``; overlapping spans become one, under the first kind."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"])))

    def pieces(chunks: Column) -> Column:
        def joined(found: Column) -> Column:
            head = lambda start, kind, at: F.struct(start.alias("start"), kind.alias("kind"), at.alias("at"))
            heads = F.filter(F.zip_with(found, reached(found), lambda s, at: head(s["start"], s["kind"], at)), lambda h: h["start"] >= h["at"])
            behind = F.array_max(F.transform(found, lambda s: s["end"]))
            parts = F.transform(heads, lambda h: F.concat(cut(chunks, h["at"], h["start"]), F.lit("["), F.upper(h["kind"]), F.lit("]")))
            return F.array_join(F.array_append(parts, cut(chunks, behind, F.length(text))), "")

        return _let(ordered, joined)

    return F.when(F.size(spans) > 0, _let(chunked(text), pieces)).otherwise(text)
