from __future__ import annotations

import random

from conftest import hour

from tidewatch.operators.windows import keep_last
from tidewatch.streaming.upsert import landing_stream
from tidewatch.streaming.winners import log_changes, newest_rows, use_state_store

SCHEMA = "series_id string, observed_at timestamp_ntz, n long, v double"
KEYS = ["series_id", "observed_at"]


def run(spark, folder, parts, **options):
    use_state_store(spark)
    for part in parts:
        df = spark.createDataFrame(part, SCHEMA)
        df.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    source = landing_stream(spark, f"{folder}/in", df.schema, files_per_batch=1)
    changes = newest_rows(source, KEYS, sequence="n", **options)
    log_changes(changes, f"{folder}/changes", f"{folder}/checkpoint").awaitTermination()
    return [tuple(r)[:4] for r in spark.read.parquet(f"{folder}/changes").orderBy("batch").collect()]


def test_shuffled_and_replayed_files_give_the_batch_result(spark, tmp_path):
    order = random.Random(4)
    rows = [(s, hour(order.randrange(30)), n, float(n)) for n, s in enumerate("ab" * 60)]
    order.shuffle(rows)
    parts = [rows[:50], rows[50:], rows[20:70]]  # the last one repeats
    log = run(spark, tmp_path, parts)
    last = {row[:2]: row for row in sorted(log, key=lambda r: r[2])}
    expected = keep_last(spark.createDataFrame(rows, SCHEMA), KEYS, "n").collect()
    assert sorted(last.values()) == sorted(tuple(r) for r in expected)
    assert len(log) == len(set(log))  # what was in force is not emitted again


def test_null_keys_are_left_out_and_old_hours_are_forgotten(spark, tmp_path):
    first = [("a", hour(0), 5, 1.0), ("a", None, 6, 1.0), (None, hour(1), 7, 1.0), ("a", hour(1), None, 1.0)]
    later = [("a", hour(500), 8, 2.0)]
    again = [("a", hour(500), 8, 2.0), ("a", hour(499), 9, 3.0)]
    log = run(spark, tmp_path, [first, later, again], lateness="2 days")
    assert sorted(log) == [first[0], again[1], later[0]]


def test_keys_of_one_hour_share_states(spark, tmp_path):
    """A call for each key is what takes the time, so a full hour needs few of them."""
    use_state_store(spark)
    first = [(f"s{i}", hour(0), i, float(i)) for i in range(300)]
    second = [(f"s{i}", hour(0), 1000 + i, -1.0) for i in range(0, 300, 3)]
    for part in (first, second + first):
        df = spark.createDataFrame(part, SCHEMA)
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    source = landing_stream(spark, f"{tmp_path}/in", df.schema, files_per_batch=1)
    query = log_changes(
        newest_rows(source, KEYS, sequence="n", slots=4), f"{tmp_path}/changes", f"{tmp_path}/checkpoint"
    )
    query.awaitTermination()
    assert all(p["stateOperators"][0]["numRowsTotal"] <= 8 for p in query.recentProgress)  # with the timers
    log = spark.read.parquet(f"{tmp_path}/changes").drop("batch").collect()
    assert sorted(tuple(r) for r in log) == sorted(first + second)


def test_states_without_the_time_among_the_keys(spark, tmp_path):
    use_state_store(spark)
    rows = [("a", hour(0), 1, 1.0), ("a", hour(5), 3, 2.0), ("b", hour(1), 2, 3.0), ("a", hour(9), 2, 4.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    source = landing_stream(spark, f"{tmp_path}/in", df.schema)
    changes = newest_rows(source, ["series_id"], sequence="n")
    log_changes(changes, f"{tmp_path}/changes", f"{tmp_path}/checkpoint").awaitTermination()
    log = spark.read.parquet(f"{tmp_path}/changes").drop("batch").collect()
    assert sorted(tuple(r) for r in log) == [rows[1], rows[2]]
