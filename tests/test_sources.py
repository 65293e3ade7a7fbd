"""Sources, sinks, topics and session helpers."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from signalguard.schemas import COMPLETED_ACTIONS, TELEMETRY, TELEMETRY_AVRO_NAME, schema_of
from signalguard.session import settings, shared_dir
from signalguard.sources import kafka
from signalguard.sources.tables import (
    append_to_table,
    conform,
    create_table_as,
    drop_tables,
    explode_json_list,
    scan,
    split_not_null,
)


def test_read_options():
    options = kafka.read_options(
        "SASL_SSL://host:9092", "readings", security=kafka.sasl_security('u"1', "p\\2")
    )
    assert options["kafka.bootstrap.servers"] == "host:9092"
    assert options["subscribe"] == "readings"
    assert options["startingOffsets"] == "earliest"
    assert options["kafka.security.protocol"] == "SASL_SSL"
    assert 'username="u\\"1" password="p\\\\2";' in options["kafka.sasl.jaas.config"]


def test_write_options():
    options = kafka.write_options("h:1", "out")
    assert options["kafka.compression.type"] == "lz4"
    assert options["kafka.linger.ms"] == "50"
    assert options["topic"] == "out"


def test_frame_is_added_and_stripped(spark):
    df = spark.createDataFrame([(bytearray(b"body"),), (bytearray(b""),)], "value binary")
    framed = df.select(kafka.add_frame(F.col("value"), 100_001).alias("f"))
    rows = framed.select("f", kafka.strip_frame(F.col("f")).alias("b")).collect()
    assert bytes(rows[0].f) == b"\x00" + (100_001).to_bytes(4, "big") + b"body"
    assert [bytes(r.b) for r in rows] == [b"body", b""]


def test_avro_schema():
    schema = json.loads(kafka.avro_schema(TELEMETRY, TELEMETRY_AVRO_NAME))
    kinds = {f["name"]: f["type"] for f in schema["fields"]}
    assert list(kinds) == TELEMETRY.fieldNames()
    assert kinds["rpm"] == "int" and kinds["vibration_g"] == "double"
    assert kinds["reading_ts"] == {"type": "long", "logicalType": "timestamp-millis"}
    nullable = json.loads(kafka.avro_schema(schema_of("a string"), "r"))
    assert nullable["fields"][0]["type"] == ["null", "string"]


def test_keyed_records(spark):
    df = spark.createDataFrame([(7, "x")], "k int, v string")
    row = kafka.keyed_records(df, "k", F.col("v").cast("binary")).first()
    assert (row.key, bytes(row.value)) == ("7", b"x")


def test_split_not_null_loses_no_row(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "b")], "x int, y string")
    kept, rejected = split_not_null(df, ["x", "y"])
    assert kept.count() == 1 and rejected.count() == 2


def test_explode_json_list(spark):
    df = spark.createDataFrame([(1, '["a","b"]'), (2, "[]"), (3, "broken")], "id int, l string")
    out = explode_json_list(df, "l", "m").select("id", "m").collect()
    assert sorted(map(tuple, out)) == [(1, "a"), (1, "b")]


def test_typed_table_and_appends(spark):
    schema = schema_of("b string, a double")
    df = spark.createDataFrame([(1, 2, "dropped")], "a int, b int, c string")
    table = create_table_as(df, shared_dir(spark, "typed"), schema)
    assert table.dtypes == [("b", "string"), ("a", "double")]
    path = shared_dir(spark, "append")
    rows = spark.createDataFrame([(None, 1), ("k", 1)], "key string, v int")
    for _ in range(2):
        append_to_table(rows, path, "key")
    assert sorted(r.key for r in scan(spark, path, rows.schema).collect()) == [
        "UNKNOWN",
        "UNKNOWN",
        "k",
        "k",
    ]


def test_an_existing_table_is_not_overwritten(spark):
    df = spark.range(3)
    path = shared_dir(spark, "once")
    create_table_as(df, path)
    with pytest.raises(Exception, match="already exists"):
        create_table_as(df, path)


def test_partitioned_table_prunes(spark):
    df = spark.range(10).select("id", (F.col("id") % 2).alias("part"))
    table = create_table_as(df, shared_dir(spark, "parts"), partition_by=["part"])
    plan = table.where("part = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan
    assert table.where("part = 1").count() == 5


def test_drop_named_tables_only(spark):
    for name in ("drop_me", "keep_me"):
        spark.range(1).write.mode("overwrite").saveAsTable(name)
    drop_tables(spark, ["drop_me", "never_was"])
    assert not spark.catalog.tableExists("drop_me")
    assert spark.catalog.tableExists("keep_me")
    drop_tables(spark, ["keep_me"])


def test_conform_to_a_declared_table(spark):
    names = COMPLETED_ACTIONS.fieldNames()
    row = {n: "x" for n in names} | {"window_start": dt.datetime(2024, 1, 1)}
    df = spark.createDataFrame([row]).select(*reversed(names))
    assert conform(df, COMPLETED_ACTIONS).schema == COMPLETED_ACTIONS


def test_shared_dir_is_fresh_and_below_the_configured_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first != second and first.startswith(root)


def test_settings_are_restored(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with settings(spark, spark__sql__shuffle__partitions="3"):
        assert spark.conf.get(key) == "3"
    assert spark.conf.get(key) == before
