import pytest
from pyspark.sql import functions as F

from loomset.operators.unify import detect_format, to_unified, turns_to_unified


@pytest.mark.parametrize(
    "columns, name",
    [
        (["instruction", "input", "output"], "alpaca"),
        (["instruction", "context", "response", "category"], "dolly"),
        (["instruction", "response"], "oasst"),
        (["conversations", "id"], "sharegpt"),
        (["instruction", "output"], "alpaca_no_input"),
        (["instruction", "input", "output", "conversations"], "alpaca"),
    ],
)
def test_detection(columns, name):
    assert detect_format(columns) == name


def test_unknown_layouts_raise(spark):
    with pytest.raises(ValueError, match="no known layout"):
        detect_format(["foo", "baz"])
    with pytest.raises(ValueError, match="no layout named"):
        to_unified(spark.createDataFrame([(0, "a")], "row_id int, instruction string"), "nonexistent")


def one(df):
    return [tuple(r)[1:] for r in df.orderBy("row_id").collect()]


def test_mapped_layouts(spark):
    dolly = spark.createDataFrame([(0, "Do X", "Y", "Z")], "row_id int, instruction string, context string, response string")
    assert one(to_unified(dolly)) == [("Do X", "Y", "Z")]
    oasst = spark.createDataFrame([(0, "Do X", "Z")], "row_id int, instruction string, response string")
    assert one(to_unified(oasst)) == [("Do X", "", "Z")]
    short = spark.createDataFrame([(0, "Do X", "Z")], "row_id int, instruction string, output string")
    assert one(to_unified(short)) == [("Do X", "", "Z")]
    # A named layout wins over detection; what it misses becomes empty.
    assert one(to_unified(dolly, "alpaca")) == [("Do X", "", "")]


def test_values_are_turned_into_text(spark):
    df = spark.createDataFrame([(0, None, 0, 5), (1, "a", 2, 0)], "row_id int, instruction string, input int, output int")
    assert one(to_unified(df)) == [("", "", "5"), ("a", "2", "")]


def messages(spark, *conversations):
    schema = "row_id int, conversations array<struct<from:string,value:string,role:string,content:string>>"
    return spark.createDataFrame(list(enumerate(conversations)), schema)


def m(role, text):
    return (role, text, None, None)


def test_nested_messages(spark):
    df = messages(
        spark,
        [m("human", "Hello"), m("gpt", "Hi there!")],
        [m("human", "only")],
        [m("gpt", "first"), m("human", "second")],
        [m("human", ""), m("gpt", None), m("user", "u"), m("assistant", "a"), m("gpt", "later")],
        [m("system", "s"), m("human", "no answer")],
        [(None, None, "user", "u"), (None, None, "assistant", "a")],
        [m("human", "  "), m("gpt", "a")],
        None,
        [],
    )
    got = {r["row_id"]: (r["instruction"], r["output"]) for r in to_unified(df).collect()}
    assert got == {0: ("Hello", "Hi there!"), 2: ("second", "first"), 3: ("u", "a"), 5: ("u", "a"), 6: ("  ", "a")}


def test_nested_messages_with_one_spelling(spark):
    df = spark.createDataFrame(
        [(0, [("user", "q"), ("assistant", "r")])], "row_id int, conversations array<struct<role:string,content:string>>"
    )
    assert one(to_unified(df)) == [("q", "", "r")]


def test_turn_table_agrees_with_nested_messages(spark):
    rows = []
    shapes = ["user:a assistant:b", "assistant:b user:a", "user: user:x gpt:y human:z", "system:s user:q", "user:q", "human:1 gpt: gpt:2"]
    for conv, shape in enumerate(shapes):
        for turn, part in enumerate(shape.split()):
            role, _, text = part.partition(":")
            rows.append((conv, turn, role, text))
    turns = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").repartition(8)
    nested = turns.groupBy(F.col("conv_id").alias("row_id")).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("turn", "role", "text"))),
            lambda t: F.struct(t["role"].alias("from"), t["text"].alias("value")),
        ).alias("conversations")
    )
    assert sorted(map(tuple, turns_to_unified(turns).collect())) == sorted(map(tuple, to_unified(nested).collect()))
