from __future__ import annotations

import pytest
from conftest import hour

from tidewatch.operators.contracts import ContractError
from tidewatch.plans.jobs import load_job
from tidewatch.schemas import ENRICHMENT_SCHEMA
from tidewatch.sinks.upsert import (
    PARTITION,
    add_missing_columns,
    merge_keep_id,
    merge_replace,
    read_table,
    upsert_table,
)

SCHEMA = "id long, observed_at timestamp_ntz, temp double, rain double, inserted_at string"
STORED = [(1, hour(0), 1.0, 0.1, "old"), (2, hour(1), 2.0, 0.2, "old")]


def test_keep_id_update_blanks_columns_that_were_not_sent(spark):
    target = spark.createDataFrame(STORED, SCHEMA)
    sent = spark.createDataFrame(
        [(9, hour(1), 20.0, "new"), (10, hour(2), 30.0, "new")],
        "id long, observed_at timestamp_ntz, temp double, inserted_at string",
    )
    rows = merge_keep_id(target, sent, ["observed_at"]).orderBy("observed_at").collect()
    assert [tuple(r) for r in rows] == [
        (1, hour(0), 1.0, 0.1, "old"),
        (2, hour(1), 20.0, None, "old"),
        (10, hour(2), 30.0, None, "new"),
    ]


def test_replace_update_keeps_columns_that_were_not_sent(spark):
    target = spark.createDataFrame(STORED, SCHEMA)
    sent = spark.createDataFrame(
        [(9, hour(1), None), (10, hour(2), 30.0)], "id long, observed_at timestamp_ntz, temp double"
    )
    rows = merge_replace(target, sent, ["observed_at"]).orderBy("observed_at").collect()
    assert [tuple(r) for r in rows] == [
        (1, hour(0), 1.0, 0.1, "old"),
        (9, hour(1), None, 0.2, "old"),
        (10, hour(2), 30.0, None, None),
    ]


def test_unknown_columns_are_refused(spark):
    target = spark.createDataFrame(STORED, SCHEMA)
    sent = spark.createDataFrame([(hour(0), 1)], "observed_at timestamp_ntz, other int")
    with pytest.raises(ContractError, match="other"):
        merge_replace(target, sent, ["observed_at"])


def test_table_upsert_counts_rows_and_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "table")
    first = spark.createDataFrame([(i, hour(i), float(i), 0.0, "a") for i in range(72)], SCHEMA)
    second = spark.createDataFrame([(i, hour(i), -1.0, 0.0, "b") for i in range(30, 40)], SCHEMA)
    assert upsert_table(spark, path, first, ["observed_at"]) == 72
    for _ in range(2):
        assert upsert_table(spark, path, second, ["observed_at"]) == 10
        rows = read_table(spark, path).collect()
        assert len(rows) == 72
        assert sum(r.temp == -1.0 for r in rows) == 10
    assert upsert_table(spark, path, second.limit(0), ["observed_at"]) == 0


def test_untouched_dates_are_not_rewritten(spark, tmp_path):
    path = tmp_path / "table"
    rows = spark.createDataFrame([(i, hour(i), 0.0, 0.0, "a") for i in range(72)], SCHEMA)
    upsert_table(spark, str(path), rows, ["observed_at"])

    def files():
        return {p.parent.name: p.name for p in path.glob(f"{PARTITION}=*/*.parquet")}

    before = files()
    change = spark.createDataFrame([(0, hour(30), 5.0, 0.0, "b")], SCHEMA)
    upsert_table(spark, str(path), change, ["observed_at"])
    after = files()
    changed = {name for name in before if before[name] != after[name]}
    assert changed == {f"{PARTITION}=2026-05-02"}


def test_sink_mode_is_checked(spark, tmp_path):
    rows = spark.createDataFrame(STORED, SCHEMA)
    with pytest.raises(ValueError, match="mode"):
        load_job(spark, str(tmp_path / "t"), rows, [], mode="auto")
    assert load_job(spark, str(tmp_path / "t"), rows, [], mode="keep_id") == 2


def test_missing_columns_are_added_once(spark):
    df = spark.createDataFrame([(hour(0), 1.0)], "observed_at timestamp_ntz, cape double")
    wide = add_missing_columns(df, ENRICHMENT_SCHEMA)
    assert wide.columns[:2] == ["observed_at", "cape"]
    assert set(wide.columns) == set(ENRICHMENT_SCHEMA.names)
    assert add_missing_columns(wide, ENRICHMENT_SCHEMA).columns == wide.columns
    assert wide.first().uv_index is None and wide.first().cape == 1.0


def test_only_touched_dates_are_read(spark, tmp_path, monkeypatch):
    from tidewatch.sinks import upsert

    path = str(tmp_path / "table")
    rows = spark.createDataFrame([(i, hour(i), 0.0, 0.0, "a") for i in range(72)], SCHEMA)
    upsert_table(spark, path, rows, ["observed_at"])
    seen = []
    real = upsert.merge_replace
    monkeypatch.setitem(upsert.MODES, "replace", lambda t, s, k: seen.append(t) or real(t, s, k))
    change = spark.createDataFrame([(0, hour(30), 5.0, 0.0, "b")], SCHEMA)
    upsert_table(spark, path, change, ["observed_at"])
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(observed_date" in plan or "PartitionFilters: [(observed_date" in plan
    assert "PartitionFilters: []" not in plan

    # Sent again, the rows stay.
    upsert_table(spark, path, change.union(change.limit(0)), ["observed_at"])
    assert sorted(r.temp for r in read_table(spark, path).collect()) == [0.0] * 71 + [5.0]


def test_columns_that_were_not_sent_stay_in_the_table(spark, tmp_path):
    for mode, rain in (("replace", [1.5, 2.5]), ("keep_id", [None, 2.5])):
        path = str(tmp_path / mode)
        kind = "observed_at timestamp_ntz, temp double, rain double"
        upsert_table(spark, path, spark.createDataFrame([(hour(0), 1.0, 1.5), (hour(1), 2.0, 2.5)], kind), ["observed_at"])
        part = spark.createDataFrame([(hour(0), 9.0)], "observed_at timestamp_ntz, temp double")
        upsert_table(spark, path, part, ["observed_at"], mode=mode)
        rows = spark.read.parquet(path).orderBy("observed_at").collect()
        assert [r.temp for r in rows] == [9.0, 2.0] and [r.rain for r in rows] == rain


def test_missing_and_repeated_keys_are_refused(spark, tmp_path):
    path, kind = str(tmp_path / "t"), "observed_at timestamp_ntz, temp double"
    for rows in ([(None, 1.0)], [(hour(0), 1.0), (hour(0), 2.0)]):
        with pytest.raises(ContractError):
            upsert_table(spark, path, spark.createDataFrame(rows, kind), ["observed_at"])


def test_a_late_hour_does_not_read_the_days_between(spark, tmp_path):
    path, kind = str(tmp_path / "t"), "observed_at timestamp_ntz, temp double"
    rows = spark.createDataFrame([(hour(24 * d), float(d)) for d in range(30)], kind)
    upsert_table(spark, path, rows, ["observed_at"])
    # The days between can not be read any more.
    for day in (tmp_path / "t").glob(f"{PARTITION}=*"):
        if day.name[-2:] not in ("01", "30"):
            for file in day.glob("*.parquet"):
                file.write_bytes(b"no table")
    ends = spark.createDataFrame([(hour(0), -1.0), (hour(24 * 29), -2.0)], kind)
    assert upsert_table(spark, path, ends, ["observed_at"]) == 2


def test_the_columns_are_read_from_one_file(spark, tmp_path):
    from tidewatch.sinks import upsert

    path, kind = str(tmp_path / "t"), "observed_at timestamp_ntz, temp double"
    first = spark.createDataFrame([(hour(0), 1.0)], kind)
    upsert_table(spark, path, first, ["observed_at"])
    assert (tmp_path / "t" / upsert.SCHEMA_FILE).exists()
    wide = spark.createDataFrame([(hour(1), 2.0, 0.5)], kind + ", rain double")
    upsert_table(spark, path, wide, ["observed_at"])
    (tmp_path / "t" / upsert.SCHEMA_FILE).unlink()  # a table of an earlier version
    upsert_table(spark, path, first, ["observed_at"])
    assert (tmp_path / "t" / upsert.SCHEMA_FILE).exists()
    rows = {r.observed_at: (r.temp, r.rain) for r in read_table(spark, path, None).collect()}
    assert rows == {hour(0): (1.0, None), hour(1): (2.0, 0.5)}
