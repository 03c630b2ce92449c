"""Newest row of each hour as keyed state of a stream.

Unlike the upsert of whole micro-batches, nothing of the table is read again: the state
holds, for each key, the sequence number of the row in force; keys of one hour share
some states. A row that arrives late or a second time is compared with it, and only a
change is emitted. A timer frees the state of hours that the watermark has left behind
for longer than the lateness allowed.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: Key types whose values are equal in Python when they are in Spark.
PLAIN = (T.StringType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.DateType())
#: States that the keys of one hour share: a call for each key costs far more than the work on it.
SLOTS = 64

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class NewestRow(StatefulProcessor):
    """Keeps the largest sequence number of each key, emits its row when it grows.

    One state holds the numbers of all keys of a group, told apart by the columns
    ``inner``; a group without such columns is one key. Among rows of one number in one
    batch the first in column order wins; a later batch with the same number changes
    nothing, so a replayed file emits nothing.
    """

    def __init__(
        self, names: list[str], inner: list[T.StructField], sequence: str, time: str, keep_ms: int
    ):
        self.names, self.sequence, self.time, self.keep_ms = names, sequence, time, keep_ms
        self.inner = [field.name for field in inner]
        entry = [T.StructField(f"k{i}", field.dataType) for i, field in enumerate(inner)]
        entries = T.ArrayType(T.StructType([*entry, T.StructField("n", T.LongType())]))
        self.state = T.StructType([T.StructField("newest", entries)])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", self.state)

    def _rank(self, row: Row) -> tuple:
        others = [(row[c] is not None, row[c]) for c in self.names]
        return -row[self.sequence], others

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best: dict[tuple, Row] = {}
        for row in rows:
            own = tuple([row[c] for c in self.inner])
            held = best.get(own)
            if held is None or row[self.sequence] > held[self.sequence]:
                best[own] = row
            elif row[self.sequence] == held[self.sequence]:
                best[own] = min(held, row, key=self._rank)
        stored = self.newest.get()
        known = {tuple(entry[:-1]): entry[-1] for entry in stored[0]} if stored is not None else {}
        grown = {
            own: row for own, row in best.items()
            if own not in known or known[own] < row[self.sequence]
        }
        if not grown:
            return
        if stored is None:
            at = next(iter(grown.values()))[self.time]
            hour = int(at.replace(tzinfo=UTC).timestamp() * 1000)
            self.handle.registerTimer(hour + self.keep_ms)
        known.update((own, row[self.sequence]) for own, row in grown.items())
        self.newest.update(([(*own, n) for own, n in known.items()],))
        for row in grown.values():
            yield Row(**{c: row[c] for c in self.names})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.newest.clear()
        return iter(())

    def close(self) -> None:
        pass


def newest_rows(
    source: DataFrame, keys: list[str], *, sequence: str, time: str = "observed_at", lateness: str = "30 days",
    slots: int = SLOTS,
) -> DataFrame:
    """Stream of rows that have become the newest of their key.

    ``sequence`` is a whole number that grows with every delivery. Rows without it, the
    time or a key are left out. Hours older than the watermark by ``lateness`` are
    forgotten; a row that comes later still counts as new. The last emitted row of a
    key is the batch's ``keep_last``, whatever the order and number of deliveries.
    Keys of one time are dealt to ``slots`` states by a hash, if ``time`` is a key and
    the others are of the types PLAIN; else each key is a state of its own. A stream
    keeps its number of slots.
    """
    needed = [*keys, sequence, time]
    rows = source.where(F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in dict.fromkeys(needed))))
    instant = rows.withColumn("__at", F.col(time).cast("timestamp"))
    span = pd.Timedelta(lateness)
    inner = [source.schema[c] for c in dict.fromkeys(keys) if c != time]
    groups = keys
    if time in keys and inner and all(field.dataType in PLAIN for field in inner):
        hashed = F.xxhash64(*[F.col(f"`{field.name}`") for field in inner])
        instant = instant.withColumn("__slot", F.pmod(hashed, F.lit(slots)).cast("int"))
        groups = [time, "__slot"]
    else:
        inner = []
    processor = NewestRow(source.columns, inner, sequence, time, int(span.total_seconds() * 1000))
    return (
        instant.withWatermark("__at", lateness)
        .drop("__at")
        .groupBy(*groups)
        .transformWithState(
            statefulProcessor=processor, outputStructType=source.schema,
            outputMode="Update", timeMode="EventTime",
        )
    )


def use_state_store(spark) -> None:
    """State of this kind needs the RocksDB store, which comes with Spark."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


def log_changes(changes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Store the changes of all available input, each micro-batch once.

    A batch has its own folder, so a batch that is replayed after a failure replaces
    what its first attempt wrote.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        changes.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
