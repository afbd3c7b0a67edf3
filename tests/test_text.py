import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomset.functions.rounding import fixed, percent, py_round
from loomset.functions.text import PY_WHITESPACE, as_text, has_text, py_strip, special_ratio, tokens
from tests.formulas import special_share

ALPHABET = list("abcXYZ019 .,!?-_\t\n\r") + list(PY_WHITESPACE) + list("éßñçŽДжλΣςאبहि日本語한글①½²٣😀👍🏽́​­|$€")


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(ALPHABET, k=rng.randrange(0, 40))) for _ in range(n)]


def test_whitespace_set_is_pythons():
    assert sorted(PY_WHITESPACE) == [chr(c) for c in range(0x110000) if chr(c).isspace()]


@pytest.mark.parametrize("seed", [1, 2])
def test_text_functions_match_python(spark, seed):
    texts = [*random_texts(1500, seed), "", " ", " \u001f", "abc", "İSTANBUL ΣΑΣ", "a b\u0085c"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(
        "t",
        py_strip(F.col("t")).alias("strip"),
        has_text(F.col("t")).alias("has"),
        tokens(F.col("t")).alias("tokens"),
        special_ratio(F.col("t")).alias("ratio"),
        F.length("t").alias("n"),
    ).collect()
    for r in rows:
        assert r["strip"] == r["t"].strip()
        assert r["has"] == bool(r["t"].strip())
        assert r["tokens"] == r["t"].lower().split()
        assert r["ratio"] == pytest.approx(special_share(r["t"]))
        assert r["n"] == len(r["t"])


def test_strip_over_every_code_point(spark):
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(c,) for c in points], "c int").repartition(8)
    text = F.decode(F.unhex(F.concat(F.lit("0000FEFF"), F.lpad(F.hex("c"), 8, "0"))), "utf-32")
    rows = df.select("c", has_text(text).alias("has"), py_strip(text).alias("strip")).where(~F.col("has")).collect()
    assert {r["c"] for r in rows} == {c for c in points if chr(c).isspace()}
    assert {r["strip"] for r in rows} == {""}


def test_falsy_values_become_empty(spark):
    schema = "s string, b boolean, i int, d double, a array<string>, m map<string,int>, x struct<k:int>"
    df = spark.createDataFrame(
        [
            (None, None, None, None, None, None, None),
            ("", False, 0, 0.0, [], {}, None),
            ("0", True, 7, 1.5, ["q"], {"k": 1}, (3,)),
            ("a", True, -1, float("nan"), ["q"], {"k": 1}, (3,)),
            ("a", True, -1, float("inf"), ["q"], {"k": 1}, (3,)),
        ],
        schema,
    )
    types = {f.name: f.dataType for f in df.schema.fields}
    rows = [tuple(r) for r in df.select(*[as_text(F.col(c), t).alias(c) for c, t in types.items()]).collect()]
    assert rows[0] == rows[1] == ("",) * 7
    assert rows[2] == ("0", "True", "7", "1.5", '["q"]', '{"k":1}', '{"k":3}')
    assert rows[3][3] == "nan" and rows[4][3] == "inf"
    assert isinstance(types["s"], T.StringType)


def test_rounding_is_pythons(spark):
    rng = random.Random(3)
    ties = [k / 8 for k in range(-40, 40)] + [2.675, 1.005, 0.285, 1.515 * 49, 3.825 * 18.2, 2.03 * 10.5]
    near = [round(rng.uniform(0, 400), 1) * p for p in (0.736, 1.408, 1.515, 7.09, 37.688) for _ in range(400)]
    wide = [rng.uniform(-1, 1) * 10 ** rng.randrange(-8, 18) for _ in range(2000)]
    values = [*ties, *near, *wide, 0.0, -0.0, 2.0**52 + 1]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.select(
        "v",
        *[py_round(F.col("v"), d).alias(f"r{d}") for d in (1, 2, 4)],
        fixed(F.col("v"), 2).alias("text"),
        fixed(F.col("v"), 1, signed=True).alias("signed"),
        percent(F.col("v"), 1).alias("percent"),
    ).collect()
    for r in rows:
        v = r["v"]
        assert [r["r1"], r["r2"], r["r4"]] == [round(v, 1), round(v, 2), round(v, 4)], v
        if abs(v) < 1e12 and round(v, 2) and round(v, 1) and round(v * 100, 1):
            assert (r["text"], r["signed"], r["percent"]) == (f"{v:.2f}", f"{v:+.1f}", f"{v:.1%}"), v
