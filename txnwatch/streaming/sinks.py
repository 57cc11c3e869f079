"""Running streams and keeping what they produce, in stores (see ``store``) or, for other streams to read on, in one folder per
batch. A batch that is run again after a failure leaves one result either way."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import LongType, StructField, StructType

from ..sources.tables import write_table
from .store import BatchStore


def run_batches(
    stream: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
    continuous: str | None = None,
) -> StreamingQuery:
    """Start the stream: over what is available now, or every ``continuous`` interval."""
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return (
        stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
        .outputMode(mode).trigger(**trigger).start()
    )


def write_batch(batch: DataFrame, batch_id: int, path: str, partition_by: str | None = None) -> None:
    write_table(batch, f"{path}/batch_id={batch_id}", partition_by=partition_by)


def run_to_table(stream: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Run over what is available now into a store; every emitted row with its ``batch_id``."""
    schema = stream.schema

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        keep(batch, batch_id, path, schema)

    run_batches(stream, on_batch, f"{path}-checkpoint", mode).awaitTermination()
    return BatchStore(stream.sparkSession, path, schema).read()


def keep(batch: DataFrame, batch_id: int, path: str, schema=None, merged=None, by_date: bool = False) -> BatchStore:
    """Add a batch to the store at ``path`` and keep the store tidy."""
    store = BatchStore(batch.sparkSession, path, schema, by_date)
    store.append(batch, batch_id)
    store.tidy(merged)
    return store


def newest_of(*keys: str) -> Callable[[DataFrame], DataFrame]:
    """For ``keep``: of rows that replace one another only the newest of each key."""
    def merged(rows: DataFrame) -> DataFrame:
        last = Window.partitionBy(*keys).orderBy(F.desc("batch_id"))
        return rows.withColumn("_n", F.row_number().over(last)).filter("_n = 1").drop("_n")

    return merged


def read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    """Everything the batches of a folder wrote, with ``batch_id``."""
    return spark.read.schema(StructType([*schema.fields, StructField("batch_id", LongType())])).parquet(path)


def latest(updates: DataFrame, *keys: str) -> DataFrame:
    """The newest emission of each key of a stream run in update mode."""
    newest = Window.partitionBy(*keys).orderBy(F.desc("batch_id"))
    return updates.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n", "batch_id")


def current(answers: DataFrame, key: str, marker: str) -> DataFrame:
    """The newest answer per key, without the keys whose newest answer is that nothing was found."""
    return latest(answers, key).filter(F.col(marker).isNotNull())


def stream_fan_out(stream: DataFrame, sinks: dict[str, Callable[[DataFrame, int], None]], checkpoint: str) -> StreamingQuery:
    """One stream to several sinks. The batch is kept while they take their turns, so the source is read once."""

    def deliver(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for sink in sinks.values():
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    return run_batches(stream, deliver, checkpoint)


class LateRows(StreamingQueryListener):
    """Adds up, per query id, the rows the watermark turned away; a nightly batch run with ``as_of`` picks them up. A query
    itself remembers its last hundred reports only. Register with ``spark.streams.addListener``."""

    def __init__(self):
        self.total: dict[str, int] = {}

    def onQueryStarted(self, event):
        self.total.setdefault(str(event.id), 0)

    def onQueryProgress(self, event):
        late = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        key = str(event.progress.id)
        self.total[key] = self.total.get(key, 0) + late

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
