from loomset.operators.stats import dataset_stats, histogram_rows


def test_lengths_and_empty_inputs(unified):
    row = dataset_stats(unified(("Hello", "", "Hi there!"), ("Goodbye world", "friend", "Bye!"))).first()
    assert (row.num_samples, row.max_instruction_len, row.min_instruction_len) == (2, 13, 5)
    assert (row.avg_instruction_len, row.avg_input_len, row.avg_output_len) == (9.0, 3.0, 6.5)
    assert dataset_stats(unified(("a", "", "b"), ("a", "1+1", "b"), ("a", "  ", "b"))).first().empty_input_count == 2


def test_empty_table(unified):
    row = dataset_stats(unified(("a", "b", "c")).where("false")).first()
    assert row.num_samples == 0 and row.token_length_distribution == {}
    assert row.avg_output_len == 0.0 and row.max_output_len == 0 and row.empty_input_count == 0


def test_bucket_edges(unified):
    sizes = [127, 128, 255, 256, 511, 512, 1023, 1024]
    df = unified(*[("é" * (4 * n), "", "") for n in sizes])
    got = dataset_stats(df).first().token_length_distribution
    assert got == {"0-128": 1, "128-256": 2, "256-512": 2, "512-1024": 2, "1024+": 1}
    one = dataset_stats(unified(("a" * 100, "", "b" * 103)))
    assert {r["bucket"]: r["n"] for r in histogram_rows(one).collect()} == {
        "0-128": 1, "128-256": 0, "256-512": 0, "512-1024": 0, "1024+": 0,
    }
