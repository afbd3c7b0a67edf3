"""Fill-in-middle examples: texts cut at line ends and put in prefix-suffix-middle order.

A text is a run of lines, each with its line break; the last may lack one. One ``fullmatch`` of the repeated
line group keeps the end of every repetition, so ``ends(1)`` gives the number of lines and both cut offsets.
The cuts come from the sha256 of ``seed:doc_id``: its first four 8-digit groups h1 to h4. The prefix ends
after the smaller of h1 and h2 modulo (n + 1) lines, the middle after the larger, the suffix is the rest.

* plain: the text as it is, if it is empty, holds a mark, or h3 % 100 >= ``rate``;
* spm, if h4 % 100 < ``spm``: mark S, suffix, mark P, prefix, mark M, middle;
* psm otherwise: mark P, prefix, mark S, suffix, mark M, middle.

A null text is empty: plain, 0 lines, empty output. A null doc_id hashes as the empty string. Prefix, middle
and suffix may be empty. Offsets are code points. Whole texts are cut, whatever their length; one text is
held at a time. Repeated rows are cut row by row and alike, an empty table gives an empty table, extra
columns pass through, and an added column whose name is taken gets a trailing underscore.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Sequence

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomset.llm.common import fresh

MARKS = ("<P>", "<S>", "<M>")
RATE, SPM, SEED = 100, 50, 7
# A repetition never gives back what it took, so matching needs no memory but the captured ends.
LINES = r"([^\n]*+\n|[^\n]++)*+"
# Characters of output a task gathers before it hands them on.
_CHARS = 1 << 22

ADDED = ["n", "form", "prefix_chars", "middle_chars", "output"]
_TYPES = [T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType()]


def check_marks(marks: Sequence[str]) -> None:
    """Marks must differ, and no end of one may begin another, so that text beside a mark cannot look like one."""
    if len(marks) != 3 or len(set(marks)) != 3 or not all(marks):
        raise ValueError("three different marks are wanted")
    for a in marks:
        for b in marks:
            if a != b and a in b or any(a.endswith(b[:i]) for i in range(1, len(b))):
                raise ValueError(f"the marks {a!r} and {b!r} overlap")


def transformed(text: str, key: str, rate: int, spm: int, seed: int, marks: Sequence[str], lines: regex.Pattern) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    ends = [0, *lines.fullmatch(text).ends(1)]
    n = len(ends) - 1
    h1, h2, h3, h4 = struct.unpack(">4I", hashlib.sha256(f"{seed}:{key}".encode()).digest()[:16])
    if n == 0 or h3 % 100 >= rate or any(mark in text for mark in marks):
        return n, "plain", None, None, text
    first, second = sorted((ends[h1 % (n + 1)], ends[h2 % (n + 1)]))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    p, s, m = marks
    if h4 % 100 < spm:
        return n, "spm", first, second - first, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return n, "psm", first, second - first, f"{p}{prefix}{s}{suffix}{m}{middle}"


def fill_middle(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rate: int = RATE, spm: int = SPM, seed: int = SEED,
    marks: Sequence[str] = MARKS,
) -> DataFrame:
    """``docs`` with ``n``, ``form``, ``prefix_chars``, ``middle_chars`` (null if plain) and ``output``."""
    check_marks(marks)
    *added, key, copy = fresh(docs, *ADDED, "_key", "_whole")
    names = docs.columns
    shown = docs.select("*", F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias(key), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias(copy))

    def run(batches):
        lines = regex.compile(LINES)
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

        def out(batch, start, rows):
            some = batch.slice(start, len(rows))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
            return pa.RecordBatch.from_arrays([*[some.column(i) for i in range(len(names))], *columns], [*names, *added])

        for batch in batches:
            keys, texts = batch.column(len(names)), batch.column(len(names) + 1)
            start, size, rows = 0, 0, []
            for i in range(batch.num_rows):
                rows.append(transformed(texts[i].as_py(), keys[i].as_py(), rate, spm, seed, marks, lines))
                size += len(rows[-1][-1])
                if size >= _CHARS:
                    yield out(batch, start, rows)
                    start, size, rows = i + 1, 0, []
            if rows:
                yield out(batch, start, rows)

    schema = T.StructType([*docs.schema.fields, *[T.StructField(c, t) for c, t in zip(added, _TYPES)]])
    return shown.mapInArrow(run, schema)


def restored(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The text that ``output`` was made from. Stays in the JVM: the marks split it into three parts."""
    check_marks(marks)
    parts = F.split(output, "|".join(rf"\Q{mark}\E" for mark in marks), 4)
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_middle_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, and digests of the output and of the restored text."""
    made = fill_middle(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )
