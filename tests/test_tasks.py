"""What a task holds does not grow with the input: larger inputs make more tasks."""

import re

from signalguard.operators.windows import average_signals
from signalguard.session import dealt
from signalguard.streaming.run import COUNTED, stream_session


def parts(df, **options) -> int:
    plan = dealt(df, "id", **options)._jdf.queryExecution().executedPlan().toString()
    return int(re.search(r"hashpartitioning\(id#\d+L?, (\d+)\)", plan)[1])


def test_larger_inputs_are_dealt_to_more_tasks(spark):
    least = 8 * spark.sparkContext.defaultParallelism
    assert parts(spark.range(1000)) == least
    assert parts(spark.range(1 << 26)) == 256  # 512 MB of numbers
    assert parts(spark.range(1 << 28)) == 1024
    assert parts(spark.range(1 << 28), most=200) == 200
    unknown = spark.createDataFrame([(1,), (2,)], "id bigint")
    assert parts(unknown) == least


def test_streams_have_several_state_partitions_to_a_core(spark):
    with stream_session(spark):
        found = int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert found == 4 * spark.sparkContext.defaultParallelism
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "16m"
    with stream_session(spark, 3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"


def test_windows_of_sparse_tables_are_combined_in_dealt_tasks(spark):
    """Not in as many as the session has shuffle partitions, however many windows there are."""
    least = 8 * spark.sparkContext.defaultParallelism
    rows = spark.range(1000).selectExpr(
        "nullif(id % 7, 3) k", "timestamp_ntz'2024-01-01' + make_dt_interval(0, id % 50) t", "id v"
    )
    rows = rows.union(rows.selectExpr("k", "cast(null as timestamp_ntz)", "v"))
    sparse = average_signals(rows, "t", "2 hours", "k", ["v"], sparse=True)
    plan = sparse._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"hashpartitioning\([^()]*, (\d+)\)", plan) == [str(least)]
    found = sorted(map(str, sparse.collect()))
    assert found == sorted(map(str, average_signals(rows, "t", "2 hours", "k", ["v"]).collect()))


def test_larger_replays_have_more_state_partitions(spark):
    def found(**options) -> int:
        with stream_session(spark, **options):
            return int(spark.conf.get("spark.sql.shuffle.partitions"))

    least = 4 * spark.sparkContext.defaultParallelism
    assert found(replay=spark.range(1000)) == least
    assert found(replay=spark.range(1 << 26)) == 64  # 512 MB of numbers
    assert found(replay=spark.range(1 << 28)) == 256
    assert found(state_partitions=3, replay=spark.range(1 << 28)) == 3
    assert found(replay=spark.createDataFrame([(1,)], "id bigint")) == least


def test_the_state_of_a_replay_is_not_counted(spark):
    with stream_session(spark, replay=spark.range(1000)):
        assert spark.conf.get(COUNTED) == "false"
    with stream_session(spark):
        assert spark.conf.get(COUNTED, None) != "false"
