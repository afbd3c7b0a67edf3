import json

import pytest

from loomset.__main__ import main

ROWS = [{"instruction": f"question {i}", "response": f"reply number {i}"} for i in range(100)]


def test_prepare_and_training_set(spark, tmp_path, capsys):
    path = tmp_path / "raw.jsonl"
    path.write_text("\n".join(map(json.dumps, ROWS + ROWS[:5])))
    main(["prepare", "--source", str(path), "--template", "mistral", "--output-dir", str(tmp_path / "out")], spark)
    shown = capsys.readouterr().out
    assert "num_samples: 105" in shown and "    - duplicate: 5" in shown and "train: 90 samples" in shown
    assert spark.read.json(str(tmp_path / "out")).count() == 100
    main(["training-set", "--source", str(path), "--output-dir", str(tmp_path / "out2")], spark)
    assert "validation: 10 samples" in capsys.readouterr().out


def test_prepare_one_stored_split(spark, tmp_path, capsys):
    df = spark.createDataFrame([(r["instruction"], r["response"], "train" if i % 2 else "test") for i, r in enumerate(ROWS)], "instruction string, response string, split string")
    df.write.partitionBy("split").parquet(str(tmp_path / "store" / "named"))
    main(["prepare", "--source", str(tmp_path / "store" / "named"), "--split", "test", "--output-dir", str(tmp_path / "o")], spark)
    assert "num_samples: 50" in capsys.readouterr().out


def test_evaluate_and_compare(spark, tmp_path, capsys):
    path = tmp_path / "data.json"
    path.write_text(json.dumps(ROWS))
    folders = []
    for name, loss in (("base", 2.0), ("tuned", 1.0)):
        spark.createDataFrame([(loss, 10)], "loss double, num_tokens bigint").write.parquet(str(tmp_path / f"{name}.parquet"))
        out = tmp_path / name
        main(["evaluate", "--model", name, "--dataset", str(path), "--scored", str(tmp_path / f"{name}.parquet"), "--output-dir", str(out)], spark)
        folders.append(str(out / "eval_results"))
    assert "  Perplexity: 7.39" in capsys.readouterr().out
    main(["compare", *folders, "--dataset-name", "demo"], spark)
    shown = capsys.readouterr().out
    assert "  Best perplexity: tuned" in shown and "  Perplexity change: -4.67 (-63.2%)" in shown
    with pytest.raises(SystemExit):
        main(["unknown"], spark)


def test_reader_options(spark, tmp_path, capsys):
    path = tmp_path / "raw.jsonl"
    path.write_text("\n".join([*map(json.dumps, ROWS), '{"instruction": ', '{"instruction": "a"} {"response": "b"}']))
    command = ["prepare", "--source", str(path), "--schema", "instruction string, response string", "--output-dir", str(tmp_path / "out")]
    main([*command, "--quarantine"], spark)
    assert "num_samples: 100" in capsys.readouterr().out
    with pytest.raises(Exception, match="Malformed"):
        main(command, spark)
    with pytest.raises(SystemExit):
        main([*command, "--split", "train"], spark)
    flat = tmp_path / "raw.csv"
    flat.write_text("instruction,response\n" + "\n".join(f"question {i},reply number {i}" for i in range(30)))
    main(["training-set", "--source", str(flat), "--plain-csv", "--output-dir", str(tmp_path / "out2")], spark)
    assert "validation: 3 samples" in capsys.readouterr().out
