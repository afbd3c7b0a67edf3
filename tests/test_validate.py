import random

import pytest

from loomset.operators import validate
from tests.formulas import special_share

GOOD = ("Say hello please", "", "Hello there!")


def reasons_of(df):
    return {r["row_id"]: r["reason"] for r in df.collect()}


def brute(rows, low=10, high=8192):
    """Reason per row, in row order."""
    seen, out = set(), []
    for i, x, o in rows:
        si, so = i.strip(), o.strip()
        key = si + "|||" + so
        if not si:
            why = "empty_instruction"
        elif not so:
            why = "empty_output"
        elif len(si) < 5:
            why = "instruction_too_short"
        elif len(so) < 3:
            why = "output_too_short"
        elif special_share(si + so) > 0.5:
            why = "corrupted_text"
        elif not low <= len(i) + len(x) + len(o) <= high:
            why = "length_out_of_range"
        else:
            why = "duplicate" if key in seen else None
            seen.add(key)
        out.append(why)
    return out


def test_schema(spark):
    df = spark.createDataFrame([(0, "a")], "row_id int, input string")
    assert validate.missing_columns(df) == ["instruction", "output"]
    with pytest.raises(ValueError, match="needs the columns"):
        validate.validate_all(df)


def test_lengths(unified):
    df = unified(("X", "", "Y"), ("a" * 10_000, "", "b"), ("abcde", "", "fghij"))
    assert [r["row_id"] for r in validate.filter_lengths(df).collect()] == [2]
    assert validate.filter_lengths(df, 1, 20_000).count() == 3
    assert validate.filter_lengths(df, 10, 10).count() == 1


def test_quality_reasons(unified):
    df = unified(
        ("", "", "fine output"),
        (" \u001f", "", "fine output"),
        ("fine instruction", "", " \n"),
        ("Hi", "", "fine output"),
        ("fine instruction", "", "ab"),
        ("@#$%^&*!", "", "(){}[]<>"),
        ("abcd", "", "!!!!"),
        ("abcde", "", "!!!!!"),
        ("abcde", "", "!!!!!!"),
        GOOD,
    )
    assert reasons_of(validate.with_quality_reason(df)) == {
        0: "empty_instruction", 1: "empty_instruction", 2: "empty_output", 3: "instruction_too_short",
        4: "output_too_short", 5: "corrupted_text", 6: "instruction_too_short", 7: None, 8: "corrupted_text", 9: None,
    }
    assert validate.filter_quality(df).count() == 2
    assert {r["reason"]: r["n"] for r in validate.quality_counts(df).collect()}["corrupted_text"] == 2


def test_duplicates(unified):
    df = unified(("Say hi", "", "Hello!"), (" Say hi", "other", "Hello!\n"), ("Say bye", "", "Goodbye!"), ("Say hi", "", "Hey"))
    assert sorted(r["row_id"] for r in validate.drop_duplicates(df).collect()) == [0, 2, 3]
    tricky = unified(("a|||b", "", "c"), ("a", "", "b|||c"))
    assert [r["row_id"] for r in validate.drop_duplicates(tricky).collect()] == [0]


def test_all_checks(unified):
    df = unified(GOOD, ("", "", "x"), GOOD, ("X", "", "Y"))
    counts = {r["reason"]: r["n"] for r in validate.reason_counts(df).collect()}
    assert counts == {None: 1, "empty_instruction": 1, "duplicate": 1, "instruction_too_short": 1}
    report = validate.validation_report(validate.reason_counts(df)).first()
    assert tuple(report) == (4, 1, 3, 0.75)
    text = validate.report_summary(validate.reason_counts(df)).first()["summary"]
    assert text.splitlines()[:5] == [
        "Validation Report:", "  Original samples: 4", "  Filtered samples: 1", "  Removed: 3 (75.0%)", "  Removal reasons:",
    ]
    assert set(text.splitlines()[5:]) == {"    - duplicate: 1", "    - empty_instruction: 1", "    - instruction_too_short: 1"}


def test_empty_table(unified, spark):
    df = unified(GOOD).where("false")
    counts = validate.reason_counts(df)
    assert tuple(validate.validation_report(counts).first()) == (0, 0, 0, 0.0)
    assert validate.report_summary(counts).first()["summary"].endswith("Removed: 0 (0.0%)")
    assert validate.validate_all(df).count() == 0


def random_rows(n, seed):
    rng = random.Random(seed)
    words = ["alpha", "béta", "γάμμα", "!!", "  ", "||", "日本", "x", "?!?!?!?!", "\n", "a" * 30]
    return [
        tuple("".join(rng.choices(words, k=rng.randrange(0, k))) for k in (4, 3, 5)) for _ in range(n)
    ]


@pytest.mark.parametrize("partitions", [1, 8])
def test_flags_match_brute_force(unified, partitions):
    rows = random_rows(1200, 5)
    want = brute(rows, 10, 80)
    df = unified(*rows, partitions=partitions)
    flags = reasons_of(validate.flag_all(df, 10, 80))
    assert [flags[i] for i in range(len(rows))] == want
    kept = sorted(r["row_id"] for r in validate.validate_all(df, 10, 80).collect())
    assert kept == [i for i, why in enumerate(want) if why is None]
    counts = {r["reason"]: r["n"] for r in validate.reason_counts(df, 10, 80).collect()}
    assert counts == {why: want.count(why) for why in set(want)}


def test_one_text_in_a_third_of_the_table(unified):
    rows = [GOOD if i % 3 == 0 else (f"instruction {i}", "", f"output {i}") for i in range(3000)]
    df = unified(*rows, partitions=8)
    kept = {r["row_id"] for r in validate.validate_all(df).collect()}
    assert kept == {0} | {i for i in range(3000) if i % 3}
    assert {r["reason"]: r["n"] for r in validate.reason_counts(df).collect()} == {None: 2001, "duplicate": 999}
