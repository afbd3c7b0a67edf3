import csv
import json
import random

import numpy as np
import pyarrow as pa
import pytest

from loomset.operators.unify import to_unified
from loomset.sources import blocks, readers, sinks


def test_json_array(spark, tmp_path):
    good = tmp_path / "good.json"
    good.write_text("\n " + json.dumps([{"instruction": "a", "output": "é"}, {"instruction": "b", "output": None}]), encoding="utf-8")
    rows = to_unified(readers.load(spark, str(good))).orderBy("row_id").collect()
    assert [(r["instruction"], r["output"]) for r in rows] == [("a", "é"), ("b", "")]
    bad = tmp_path / "bad.json"
    bad.write_text('{"not": "a list"}')
    with pytest.raises(Exception, match="a JSON list is wanted in .*bad.json"):
        readers.load(spark, str(bad)).collect()
    with pytest.raises(FileNotFoundError):
        readers.load(spark, str(tmp_path / "absent.json"))
    with pytest.raises(ValueError, match="no source format"):
        readers.load(spark, str(good), "avro")


BROKEN_LISTS = ['[{"a": 1}', '[{"a": 1}] tail', '{"a": 1}', '[{"a": }]', " \n"]


@pytest.mark.parametrize("text", BROKEN_LISTS)
def test_broken_json_list_fails_or_is_quarantined(spark, tmp_path, text):
    (tmp_path / "good.json").write_text('\ufeff[{"a": 1}, {"a": 2}]\n', encoding="utf-8")
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception, match="JSON list is wanted|MALFORMED|Malformed"):
        readers.read_json_array(spark, str(tmp_path), "a bigint").collect()
    got = readers.read_json_array(spark, str(tmp_path), "a bigint", quarantine=True)
    assert sorted(r["a"] for r in got.collect()) == [1, 2]
    left = readers.malformed_json(spark, str(tmp_path), "a bigint", lists=True).collect()
    assert [(r["file"].endswith("bad.json"), r["value"]) for r in left] == [(True, text)]


def test_broken_json_line_fails_or_is_quarantined(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"a": 1}\n{"a": \n\n{"a": 2}\n{"a": "no number"}\n')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        readers.read_json_lines(spark, str(path), "a bigint").collect()
    got = readers.load(spark, str(path), schema="a bigint", quarantine=True)
    assert sorted(r["a"] for r in got.collect()) == [1, 2] and got.columns == ["a", "row_id"] and got.count() == 2
    left = readers.malformed_json(spark, str(path), "a bigint").collect()
    assert sorted(r["value"] for r in left) == ['{"a": ', '{"a": "no number"}']


def test_csv(spark, tmp_path):
    path = tmp_path / "data.csv"
    path.write_text('instruction,input,output\nSay hello,,Hello!\nSay bye,N/A,"Bye, ""you""\nall!"\n  padded  ,x,y\n')
    rows = to_unified(readers.load(spark, str(path))).orderBy("row_id").collect()
    assert [tuple(r)[1:] for r in rows] == [
        ("Say hello", "", "Hello!"), ("Say bye", "", 'Bye, "you"\nall!'), ("  padded  ", "x", "y"),
    ]
    with pytest.raises(FileNotFoundError):
        readers.load(spark, str(tmp_path / "absent.csv"))


def test_lines_parquet_and_named_splits(spark, tmp_path):
    df = spark.createDataFrame([("a", "b", "train"), ("c", "d", "test")], "instruction string, output string, split string")
    df.drop("split").write.json(str(tmp_path / "x.jsonl"))
    assert to_unified(readers.load(spark, str(tmp_path / "x.jsonl"))).count() == 2
    df.write.partitionBy("split").parquet(str(tmp_path / "named"))
    one = readers.read_split(spark, str(tmp_path), "named", "test")
    assert [r["instruction"] for r in one.collect()] == ["c"] and "split" not in one.columns


def test_split_sink(spark, tmp_path):
    df = spark.createDataFrame([(0, "é\n", "train"), (1, "b", "test")], "row_id int, text string, split string")
    sinks.write_splits(df, str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir()) == ["split=test", "split=train"]
    text = next((tmp_path / "out" / "split=train").glob("*.json")).read_text(encoding="utf-8")
    assert text == '{"text":"é\\n"}\n'


def samples(spark):
    rows = [(1, 'say "hi",\nplease', "ref", " generated ", (5, 0.7)), (2, "p2", "", "g2", (9, 0.7))]
    schema = "sample_id bigint, prompt string, reference string, generated string, metadata struct<index:bigint,temperature:double>"
    return spark.createDataFrame(rows, schema)


def test_review_csv(spark, tmp_path):
    sinks.write_review_csv(samples(spark), str(tmp_path / "csv"))
    rows = []
    for part in sorted((tmp_path / "csv").glob("part-*.csv")):
        with open(part, newline="", encoding="utf-8") as f:
            rows += list(csv.DictReader(f))
    assert rows == [
        {"sample_id": "1", "prompt": 'say "hi",\nplease', "reference": "ref", "generated": " generated ", "rating": "", "notes": ""},
        {"sample_id": "2", "prompt": "p2", "reference": "", "generated": "g2", "rating": "", "notes": ""},
    ]


def test_review_json(spark, tmp_path):
    sinks.write_review_json(samples(spark), str(tmp_path / "json"))
    rows = [json.loads(line) for part in sorted((tmp_path / "json").glob("part-*")) for line in part.read_text().splitlines()]
    assert rows[0] == {
        "sample_id": 1, "prompt": 'say "hi",\nplease', "reference": "ref", "generated": " generated ",
        "metadata": {"index": 5, "temperature": 0.7}, "rating": None, "notes": "",
    }


def test_review_markdown(spark, tmp_path):
    sinks.write_review_markdown(samples(spark), str(tmp_path / "md"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "md").glob("part-*")))
    assert text == (
        "# Human Evaluation Samples\n\n## Sample 1\n\n"
        '**Prompt:**\n```\nsay "hi",\nplease\n```\n\n**Reference:**\n```\nref\n```\n\n**Generated:**\n```\n generated \n```\n\n'
        "**Rating:** [ ] 1  [ ] 2  [ ] 3  [ ] 4  [ ] 5\n\n**Notes:**\n\n---\n\n"
        "## Sample 2\n\n**Prompt:**\n```\np2\n```\n\n**Generated:**\n```\ng2\n```\n\n"
        "**Rating:** [ ] 1  [ ] 2  [ ] 3  [ ] 4  [ ] 5\n\n**Notes:**\n\n---\n\n"
    )


# ------------------------------------------------------------------ files cut anywhere

LISTS = [
    '[{"a": 1}] [{"a": 2}]', '[{"a": 1}] junk ]', '[{"a": 1}, null]', '[{"a": 1}, 7]', '[null, {"a": 1}]', '[{"a": 1}, [{"a": 2}]]',
    '[{"a": 1} {"a": 2}]', '[{"a": 1},, {"a": 2}]', '[{"a": 1},]', '[{"a": "no number"}]', '[{"a": 1}', '[{"a": 1}]}', '[', ']', '"[]"',
    '[{"a": [1}]]', '[{"a": 1}}]', '{"a": [{"a": 1}]}', '[{"a": 1}]\n[]',
]


@pytest.mark.parametrize("text", LISTS[:6])
def test_whatever_is_no_list_of_objects_fails(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception, match="JSON list is wanted|Malformed"):
        readers.read_json_array(spark, str(tmp_path), "a bigint").collect()


def test_whatever_is_no_list_of_objects_is_quarantined(spark, tmp_path):
    (tmp_path / "good.json").write_text('[ {"a": 1} , {"a": 2}\n]\n')
    (tmp_path / "empty.json").write_text("\n[ ]\n")
    for i, text in enumerate(LISTS):
        (tmp_path / f"bad{i}.json").write_text(text)
    got = readers.read_json_array(spark, str(tmp_path), "a bigint", quarantine=True)
    assert sorted(r["a"] for r in got.collect()) == [1, 2]
    left = readers.malformed_json(spark, str(tmp_path), "a bigint", lists=True).collect()
    assert sorted(r["value"] for r in left) == sorted(LISTS)


def test_a_line_is_one_object(spark, tmp_path):
    bad = ['{"a": 1} {"a": 2}', '{"a": 3} junk', '[{"a": 1}]', "null", "7", '{"a": 1}] x [{"a": 2}', '{"a": 1},{"a": 2}']
    (tmp_path / "x.jsonl").write_text("\n".join(['{"a": 1}', " ", *bad, '  {"a": 2, "b": "} {"}  ']) + "\n")
    got = readers.read_json_lines(spark, str(tmp_path), "a bigint", quarantine=True)
    assert sorted(r["a"] for r in got.collect()) == [1, 2]
    assert sorted(r["value"] for r in readers.malformed_json(spark, str(tmp_path), "a bigint").collect()) == sorted(bad)
    for line in bad[:3]:
        (tmp_path / "x.jsonl").write_text(line)
        with pytest.raises(Exception, match="Malformed"):
            readers.read_json_lines(spark, str(tmp_path), "a bigint").collect()


@pytest.fixture
def cut_into(spark):
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield cut
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def odd_records(n):
    """Objects with braces, quotes and backslashes in strings, nested values and long strings."""
    rng = random.Random(n)
    words = ['"', "\\", "}", "{", "[", "]", ",", "é", "日本", "\n", "x", "]}", '\\"', " ", " "]
    text = lambda k: "".join(rng.choice(words) for _ in range(rng.randint(0, k)))
    return [{"id": i, "s": text(12), "n": {"t": text(5), "l": [{"u": text(3)}] * (i % 3)}, "long": text(400 if i % 17 == 0 else 2)} for i in range(n)]


@pytest.mark.parametrize("size, layout", [(64, "one line"), (333, "spread"), (1 << 20, "spaced")])
def test_lists_are_read_in_blocks(spark, tmp_path, cut_into, size, layout):
    cut_into(size)
    rows = odd_records(150)
    options = {"one line": {"separators": (",", ":")}, "spread": {"indent": 2}, "spaced": {}}[layout]
    for k in range(3):
        part = rows[k * 50 : (k + 1) * 50]
        (tmp_path / f"{k}.json").write_text(json.dumps(part, ensure_ascii=k == 1, **options), encoding="utf-8")
    schema = "id bigint, s string, n struct<t:string,l:array<struct<u:string>>>, long string"
    for given in (schema, None):
        df = readers.read_json_array(spark, str(tmp_path), given)
        got = [r.asDict(recursive=True) for r in df.orderBy("row_id").collect()]
        assert [{k: r[k] for k in rows[0]} for r in got] == rows
        assert len({r["row_id"] for r in got}) == 150
    if size == 64:
        assert blocks.block_effects(blocks.pieces(spark, str(tmp_path), "}", readers._list_effect)).count() > 50


@pytest.mark.parametrize("size, line_end, broadcast", [(64, "\n", True), (64, "\r\n", False), (333, "\r\n", True), (1 << 20, "\n", False)])
def test_csv_is_read_in_blocks(spark, tmp_path, cut_into, size, line_end, broadcast, monkeypatch):
    cut_into(size)
    if not broadcast:
        monkeypatch.setattr(blocks, "BROADCAST_BYTES", 0)
    rng = random.Random(7)
    cells = ["", "x", 'a "b" c', "line" + line_end + "break", line_end * 3, ",", '"', '""', "é,日", '","', "N/A", "x" * 300, line_end + '"']
    rows = [[str(i), rng.choice(cells), rng.choice(cells)] for i in range(240)]
    for k in range(2):
        with open(tmp_path / f"{k}.csv", "w", newline="", encoding="utf-8") as f:
            writer = csv.writer(f, lineterminator=line_end, quoting=csv.QUOTE_ALL if k else csv.QUOTE_MINIMAL)
            writer.writerow(["doc", "a", "b"])
            writer.writerows(rows[k * 120 : (k + 1) * 120])
            if k:
                f.write(line_end + '240,5" pipe,last')  # a blank line, a quote inside a cell, no line end
    want = [[i, *(None if c in readers.CSV_MISSING else c for c in cells)] for i, *cells in [*rows, ["240", '5" pipe', "last"]]]
    got = readers.read_csv(spark, str(tmp_path)).orderBy("row_id").collect()
    assert [list(r)[:3] for r in got] == want


def test_states_under_both_starts():
    rng = random.Random(4)
    for _ in range(200):
        n = rng.randint(0, 12)
        end0, end1 = (np.array([rng.randint(0, 1) for _ in range(n)], np.int64) for _ in range(2))
        for start in (0, 1):
            states = [start]
            for a, b in zip(end0, end1):
                states.append(int(b if states[-1] else a))
            assert blocks.states_of(end0, end1, start).tolist() == states


def test_piece_effects_and_block_starts(spark, tmp_path):
    """Effects from bytes equal a walk over characters; thousands of files need no Python call each."""
    rng = random.Random(11)
    texts = ["".join(rng.choice('"\\\\[{]aé') for _ in range(rng.randrange(12))) for _ in range(400)]

    def walk(text: str, quoted: int) -> tuple[int, int]:
        depth, at = 0, 0
        while at < len(text):
            if text[at] == "\\" and at + 1 < len(text):
                at += 2
                continue
            if text[at] == '"':
                quoted = 1 - quoted
            elif not quoted:
                depth += {"[": 1, "{": 1, "]": -1}.get(text[at], 0)
            at += 1
        return quoted, depth - (not quoted)

    got = np.array(readers._piece_effects(pa.array(texts))).T.tolist()
    assert got == [[*(walk(t, q)[0] for q in (0, 1)), *(walk(t, q)[1] for q in (0, 1))] for t in texts]
    effects = [(f"f{i % 9}", i // 9, 100, 10, *e) for i, e in enumerate(got)]
    df = spark.createDataFrame(effects, "file string, block long, size long, bytes long, end0 long, end1 long, add0 long, add1 long")
    starts = blocks.block_starts(df)
    assert "InPandas" not in starts._jdf.queryExecution().executedPlan().toString()
    at = {}
    for r in starts.orderBy("file", "block").collect():
        assert (r["state"], r["depth"]) == at.get(r["file"], (0, 0))
        e = got[r["block"] * 9 + int(r["file"][1:])]
        at[r["file"]] = (e[r["state"]], r["depth"] + e[2 + r["state"]])


def test_texts_of_lists_are_cut_once(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1}]')
    read = readers.read_json_array(spark, str(tmp_path), "a bigint", quarantine=True)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "FileScan text" not in plan
    assert [r["a"] for r in read.collect()] == [1]
