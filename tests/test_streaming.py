from __future__ import annotations

from conftest import hour

from tidewatch.operators.windows import keep_last
from tidewatch.sinks.upsert import PARTITION, read_table, upsert_table
from tidewatch.streaming.upsert import landing_stream, stream_upsert

SCHEMA = "series_id string, observed_at timestamp_ntz, n long, v double"


def test_stream_gives_the_batch_result(spark, tmp_path):
    first = [("a", hour(h), h, float(h)) for h in range(48)] + [("a", hour(3), 100, 33.0)]
    late = [("a", hour(5), 200, 55.0), ("a", hour(5), 201, 56.0), ("b", hour(50), 202, 1.0)]
    keys = ["series_id", "observed_at"]
    for part in (first, late):
        df = spark.createDataFrame(part, SCHEMA)
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        batch = keep_last(df, keys, "n").drop("n")
        upsert_table(spark, str(tmp_path / "batch"), batch, keys)
        for _ in range(2):  # the second start finds nothing new
            stream_upsert(
                landing_stream(spark, str(tmp_path / "in"), df.schema, files_per_batch=1),
                str(tmp_path / "stream"),
                keys,
                sequence="n",
                checkpoint=str(tmp_path / "checkpoint"),
            ).awaitTermination()

    def rows(name):
        return sorted(map(tuple, read_table(spark, str(tmp_path / name)).drop(PARTITION).collect()))

    assert rows("stream") == rows("batch")
    values = {(s, t): v for s, t, v in rows("stream")}
    assert values["a", hour(3)] == 33.0 and values["a", hour(5)] == 56.0
    assert len(values) == 49
