"""The dated upsert as a stream with keyed state: one row for each key, held in a state store on disk."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..shipping import ship

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def on_disk(spark: SparkSession):
    """State stores of queries and reads that start inside are RocksDB's."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


class NewestRow(StatefulProcessor):
    """Keeps the row of the latest date; of equal dates the one that came in a later batch, in a batch the greatest in
    order. Rows are looked at one at a time, so a hot key needs no more memory than another."""

    def __init__(self, schema, date: str, order: list[str]):
        self.schema, self.date, self.order = schema, date, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.row = handle.getValueState("row", self.schema)

    def _rank(self, row) -> tuple:
        """Nulls before all values."""
        return tuple((row[c] is not None, row[c]) if row[c] is not None else (False,) for c in [self.date, *self.order])

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best = None
        for row in rows:
            if best is None or self._rank(row) >= self._rank(best):
                best = row
        held = self.row.get() if self.row.exists() else None
        if held is not None:
            held = dict(zip(self.schema.fieldNames(), held))
        if best is not None and (held is None or self._rank(best)[:1] >= self._rank(held)[:1]):
            self.row.update(tuple(best[c] for c in self.schema.fieldNames()))
            yield Row(**{c: best[c] for c in self.schema.fieldNames()})

    def close(self) -> None:
        pass


def newest_rows(stream: DataFrame, keys: list[str], date: str, order: list[str]) -> DataFrame:
    """A streaming table of the rows that win, as operators.merge.dated_upsert has them: a later batch's row replaces
    the one held unless that is strictly newer. A late row changes nothing."""
    ship(stream.sparkSession)
    # The driver starts a worker of its own to ask the processor for its state, and that has no shipped files.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    return stream.groupBy(*keys).transformWithState(NewestRow(stream.schema, date, order), stream.schema, "Update", "None")


def keep_newest(stream: DataFrame, checkpoint: str, keys: list[str], date: str, order: list[str]):
    """Starts a query that takes in all there is and stops. Run again with the same checkpoint it takes in what is new;
    what a failed run had taken in is not counted twice."""
    with on_disk(stream.sparkSession):
        return newest_rows(stream, keys, date, order).writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def held_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The rows that the state holds, one for each key."""
    with on_disk(spark):
        return spark.read.format("statestore").option("stateVarName", "row").load(checkpoint).select(F.col("value.*"))
