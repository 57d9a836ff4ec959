import pytest
from pyspark.sql import functions as F

from coursemill.operators import dims
from coursemill.schemas import DIM_CONFIG_CHANGE
from coursemill.sources import records
from coursemill.streaming import sinks
from tests.conftest import rows

CHANGES = "`table` string, type string, data map<string,string>, arrival bigint"
CONFIG = [("course", "dim_course", "info", "id,name,price", "id")]
CONFIG_SCHEMA = ("source_table string, sink_table string, sink_family string, "
                 "sink_columns string, sink_row_key string")


@pytest.fixture
def config(spark):
    return spark.createDataFrame(CONFIG, CONFIG_SCHEMA)


def changes(spark, *data):
    return spark.createDataFrame(
        [(t, k, d, i) for i, (t, k, d) in enumerate(data)], CHANGES)


def applied(spark, config, *data):
    return rows(dims.apply_changes(dims.route(changes(spark, *data), config)))


def test_null_keeps_the_old_value(spark, config):
    assert applied(
        spark, config,
        ("course", "bootstrap-insert", {"id": "1", "name": "a", "price": "5", "note": "x"}),
        ("course", "update", {"id": "1", "name": None, "price": "6"}),
        ("other", "insert", {"id": "9"}),
    ) == [("dim_course", "1", {"id": "1", "name": "a", "price": "6"})]


def test_delete_forgets_old_columns(spark, config):
    assert applied(
        spark, config,
        ("course", "insert", {"id": "1", "name": "a", "price": "5"}),
        ("course", "delete", {"id": "1", "name": "a"}),
        ("course", "insert", {"id": "1", "name": "b"}),
        ("course", "insert", {"id": "2", "name": "c"}),
        ("course", "delete", {"id": "2"}),
    ) == [("dim_course", "1", {"id": "1", "name": "b"})]


def test_null_type_is_a_put_and_a_missing_key_is_set_aside(spark, config):
    routed = dims.route(changes(
        spark, ("course", None, {"id": "1", "name": "a"}),
        ("course", "insert", {"name": "b"})), config)
    assert rows(dims.apply_changes(routed), "row_key") == [("1",)]
    assert rows(dims.without_key(routed), "cols") == [({"name": "b"},)]


def test_key_must_be_among_the_kept_columns(spark):
    config = spark.createDataFrame([("course", "d", "info", "name, id", "id")], CONFIG_SCHEMA)
    routed = dims.route(changes(spark, ("course", "insert", {"id": "1", "name": "a"})), config)
    assert rows(routed, "row_key", "cols") == [(None, {"name": "a"})]


def config_stream(spark, *texts):
    topic = spark.createDataFrame(list(enumerate(texts)), "arrival bigint, value string")
    return dims.config_changes(records.records(topic, DIM_CONFIG_CHANGE))


def record(op, name, columns="id", before=True):
    row = (f'{{"source_table":"{name}","sink_table":"dim_{name}","sink_family":"info",'
           f'"sink_columns":"{columns}","sink_row_key":"id"}}')
    return (f'{{"op":"{op}","before":{row if op in "ud" else "null"},'
            f'"after":{"null" if op == "d" else row}}}')


def test_config_changes(spark):
    changed = config_stream(
        spark, record("r", "a"), record("r", "b"), record("u", "a", "id,x"), record("d", "b"),
        record("c", "c"))
    assert rows(dims.current_config(changed), "source_table", "sink_columns") == [
        ("a", "id,x"), ("c", "id")]
    assert rows(dims.resets(changed)) == [("dim_a", 2), ("dim_b", 3)]


def test_update_of_the_config_empties_the_dimension(spark, config):
    resets = spark.createDataFrame([("dim_course", 0)], "sink_table string, reset_at bigint")
    routed = dims.route(changes(
        spark, ("course", "insert", {"id": "1", "name": "a"}),
        ("course", "insert", {"id": "2", "name": "b"})), config)
    assert rows(dims.apply_changes(dims.after_reset(routed, resets)), "row_key") == [("2",)]


def test_preload_comes_before_changes(spark, config):
    from pyspark.sql import functions as F
    loaded = dims.preloaded(config, F.lit(-1).cast("bigint"))
    dropped = config_stream(spark, record("d", "course"))
    assert dims.current_config(loaded).count() == 1
    assert dims.current_config(loaded.unionByName(dropped)).count() == 0


def test_dimension_log_replay(spark, config, folder):
    write = sinks.dimension_writer(f"{folder}/log", lambda: config, f"{folder}/quarantine")
    first = changes(spark, ("course", "insert", {"id": "1", "name": "a"}),
                    ("course", "insert", {"name": "no key"}))
    second = changes(spark, ("x", "insert", {}), ("x", "insert", {}),
                     ("course", "update", {"id": "1", "price": "7"}))
    for batch, batch_id in ((first, 0), (second, 1), (first, 0), (second, 1)):
        write(batch, batch_id)
    assert rows(sinks.read_dimensions(spark, f"{folder}/log")) == [
        ("dim_course", "1", {"id": "1", "name": "a", "price": "7"})]
    assert spark.read.parquet(f"{folder}/log").count() == 2
    assert spark.read.parquet(f"{folder}/quarantine").count() == 1


def test_dimension_as_table(spark, config):
    table = dims.as_table(dims.apply_changes(dims.route(changes(
        spark, ("course", "insert", {"id": "1", "name": "a"})), config)),
        "dim_course", "id", "name", "price")
    assert rows(table) == [("1", "a", None)]


def test_snapshot_and_newer_batches_say_what_the_log_says(spark, folder):
    import random

    rng = random.Random(1)
    schema = "sink_table string, row_key string, op string, cols map<string,string>, arrival long"

    def batch(number):
        return spark.createDataFrame([(
            f"d{rng.randrange(2)}", str(rng.randrange(6)), rng.choice(["insert", "update", "delete"]),
            {c: rng.choice([None, str(rng.randrange(99))]) for c in "xy"}, 100 * number + k)
            for k in range(40)], schema)

    path, snapshots = f"{folder}/log", f"{folder}/snapshots"

    def check():
        want = dims.apply_changes(spark.read.parquet(path))
        got = sinks.read_dimensions(spark, path, snapshots=snapshots)
        key = lambda r: (r.sink_table, r.row_key, sorted(r.cols.items()))
        assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))

    for number in range(5):
        sinks.write_batch(batch(number), path, number, ["sink_table"], "a")
        check()
        if number in (1, 3):
            assert sinks.compact_dimensions(spark, path, snapshots) == (1 if number == 1 else 2)
            check()
    log = sinks.dimension_log(spark, path, snapshots)
    files = {r[0] for r in log.select(F.input_file_name()).collect()}
    assert files and all("number=2" in f or "batch_id=4" in f for f in files)
