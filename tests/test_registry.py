import datetime

from pyspark.sql import functions as F

from loomset.operators import registry
from loomset.sources import readers, sinks


def rows(spark, *entries):
    data = [
        (i, name, version, f"p{i}", metrics, datetime.datetime(2024, 1, 1 + day), "registered")
        for i, (name, version, day, metrics) in enumerate(entries)
    ]
    return spark.createDataFrame(data, registry.REGISTRY_SCHEMA)


def versions(df):
    return {r["name"]: r["version"] for r in df.collect()}


def test_latest_and_best(spark):
    table = rows(
        spark,
        ("m", "v1", 0, {"eval_loss": 0.5, "accuracy": 0.7}),
        ("m", "v2", 2, {"eval_loss": 0.3, "accuracy": 0.9}),
        ("m", "v3", 2, {"eval_loss": 0.7}),
        ("n", "v9", 1, {"train_loss": 0.1}),
        ("n", "v8", 0, {"train_loss": 0.1}),
    )
    assert versions(registry.latest_versions(table)) == {"m": "v2", "n": "v9"}
    assert versions(registry.latest_versions(table, "absent")) == {}
    assert versions(registry.best_versions(table)) == {"m": "v2"}
    assert versions(registry.best_versions(table, "accuracy")) == {"m": "v2"}
    assert versions(registry.best_versions(table, "train_loss")) == {"n": "v9"}
    assert versions(registry.best_versions(table, "absent")) == {}
    assert registry.list_models(table, "m").count() == 3
    assert registry.list_models(table, "").count() == registry.list_models(table).count() == 5


def test_register(spark):
    table = rows(spark, ("m", "v1", 0, {}))
    new = spark.createDataFrame([(7, "m", "v1", "x", None)], "seq bigint, name string, version string, path string, metrics map<string,double>")
    got = registry.register(table, new).orderBy("seq").collect()
    assert [(r["version"], r["status"]) for r in got] == [("v1", "registered")] * 2
    assert got[1]["metrics"] == {} and got[1]["timestamp"] is not None
    assert [r["seq"] for r in got] == [0, 1]
    again = registry.register(registry.register(table, new), new.drop("seq").union(new.drop("seq")))
    assert sorted(r["seq"] for r in again.collect()) == [0, 1, 2, 3]
    change = spark.createDataFrame([(1, "m", "v1", "deployed")], "change_no int, name string, version string, status string")
    assert [r["seq"] for r in registry.update_status(again, change).where("status = 'deployed'").collect()] == [0]
    assert [r["seq"] for r in registry.register(table.limit(0), new).collect()] == [0]


def test_update_hits_the_first_and_delete_hits_all(spark):
    table = rows(spark, ("m", "v1", 0, {}), ("m", "v1", 1, {}), ("m", "v2", 0, {}), ("n", "v1", 0, {}))
    changes = spark.createDataFrame(
        [(1, "m", "v1", "deployed"), (2, "m", "v1", "archived"), (3, "x", "v1", "deployed")],
        "change_no int, name string, version string, status string",
    )
    status = {r["seq"]: r["status"] for r in registry.update_status(table, changes).collect()}
    assert status == {0: "archived", 1: "registered", 2: "registered", 3: "registered"}
    keys = changes.select("name", "version").distinct()
    assert {r["seq"] for r in registry.delete_versions(table, keys).collect()} == {2, 3}
    found = {(r["name"], r["version"]): r["found"] for r in registry.matched_keys(table, keys).collect()}
    assert found == {("m", "v1"): True, ("x", "v1"): False}


def test_storage(spark, tmp_path):
    path = str(tmp_path / "registry")
    sinks.append_registry(rows(spark, ("m", "v1", 0, {"eval_loss": 0.5})), path)
    sinks.append_registry(rows(spark, ("m", "v2", 1, {})).withColumn("seq", F.lit(1)), path)
    (tmp_path / "registry" / "broken.json").write_text('{"name": "half\n{"name": "x", "unknown": 1}\n')
    table = readers.read_registry(spark, path)
    good = {r["name"]: r for r in readers.healthy(table).collect()}
    assert readers.healthy(table).count() == 3
    assert good["x"]["status"] == "registered" and good["x"]["metrics"] == {} and good["x"]["version"] == ""
    assert [r[0] for r in readers.quarantined(table).collect()] == ['{"name": "half']


def test_list_file(spark, tmp_path):
    path = tmp_path / "registry.json"
    path.write_text(
        '[{"name": "m", "version": "v1", "metrics": {"a": 1}, "timestamp": "2024-01-02T03:04:05.123456+00:00"},\n'
        ' {"name": "m", "version": "v2", "timestamp": "2024-01-02T03:04:05+00:00", "status": "deployed"}]'
    )
    got = readers.healthy(readers.read_registry(spark, str(path), multi_line=True)).orderBy("seq").collect()
    assert [r["status"] for r in got] == ["registered", "deployed"]
    assert got[0]["timestamp"].microsecond == 123456 and got[0]["metrics"] == {"a": 1.0}
    path.write_text("not json")
    broken = readers.read_registry(spark, str(path), multi_line=True)
    assert readers.healthy(broken).count() == 0 and readers.quarantined(broken).count() == 1


def test_a_version_without_a_number_is_never_best(spark):
    from loomset.operators.registry import best_versions

    schema = "seq long, name string, version string, metrics map<string,double>"
    rows = [(1, "m", "1", {"eval_loss": None}), (2, "m", "2", {"eval_loss": float("nan")}), (3, "m", "3", {"eval_loss": 0.5})]
    assert [r["version"] for r in best_versions(spark.createDataFrame(rows, schema)).collect()] == ["3"]
