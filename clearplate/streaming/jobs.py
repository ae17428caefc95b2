"""Streaming forms of the usage, dedupe and fact-state jobs.

Each job takes a streaming DataFrame and returns the running query. State lives in Spark's
state store below the checkpoint; results are plain Parquet tables, a partition for each batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from clearplate.functions.latest import top_per_key
from clearplate.operators.facts import live
from clearplate.sources.tables import overwrite_partitions

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
# The store that keeps named state variables.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FACT_KEY = ["user_id", "fact_key"]


def hourly_usage(usage: DataFrame, late: str = "1 hour") -> DataFrame:
    """Requests, tokens and credits per tumbling hour and agent; rows later than ``late`` are dropped."""
    return (
        usage.withWatermark("start_time", late)
        .groupBy(F.window("start_time", "1 hour").alias("w"), "agent_name")
        .agg(F.count(F.lit(1)).alias("total_requests"), F.sum("tokens").alias("total_tokens"), F.sum("token_credits").alias("total_credits"))
        .select(F.col("w.start").alias("hour"), "agent_name", "total_requests", "total_tokens", "total_credits")
    )


def write_updates(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Write the rows that each batch changed, a partition for each batch; a repeated batch writes the same partition again."""
    empty = df.sparkSession.createDataFrame([], df.schema)
    empty.write.mode("overwrite").parquet(f"{path}/_at=-1")  # so that the table has columns before the first row

    def save(batch: DataFrame, number: int) -> None:
        overwrite_partitions(batch.withColumn("_at", F.lit(number).cast("long")), path, ["_at"])

    return df.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def latest_values(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Current row per key: of what the batches wrote, the last. A task keeps one row per key before the shuffle."""
    return top_per_key(spark.read.parquet(path), keys, [F.desc("_at")]).drop("_at")


def dedupe_stream(records: DataFrame, keys: Sequence[str], time: str, late: str = "1 hour") -> DataFrame:
    """First delivery of each record; copies that come within the watermark are dropped."""
    return records.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))


class Newest(StatefulProcessor):
    """Keeps the newest record of a key, and gives it out when it changes. Deletes are records like any other."""

    def __init__(self, schema: T.StructType, order: Sequence[str]):
        self.schema, self.order = schema, list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", self.schema)

    def _age(self, record: dict) -> tuple:
        return tuple((record[c] is not None, record[c]) for c in self.order)  # an unknown time is the oldest

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self.newest.get()
        best = None if held is None else dict(zip(self.schema.names, held))
        changed = False
        for row in rows:
            record = row.asDict()
            if best is None or self._age(record) > self._age(best):
                best, changed = record, True
        if changed:
            values = tuple(best[c] for c in self.schema.names)
            self.newest.update(values)
            yield Row(**dict(zip(self.schema.names, values)))

    def close(self) -> None:
        pass


def latest_wins_stream(records: DataFrame, path: str, checkpoint: str, keys: Sequence[str], order: Sequence[str]) -> StreamingQuery:
    """Keep the newest record of each key in the state store; every change of it is a row of the table at ``path``.

    Records may come late, out of order and more than once: an older one changes nothing.
    After a failure the query goes on from its checkpoint.
    """
    spark = records.sparkSession
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        kept = records.groupBy(*keys).transformWithState(Newest(records.schema, order), records.schema, "Update", "None")
        return write_updates(kept, path, checkpoint)
    finally:
        spark.conf.set(STATE_STORE, before)


def kept_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The newest record of each key as the state store at the checkpoint holds it."""
    return spark.read.format("statestore").option("stateVarName", "newest").load(checkpoint).select("value.*")


def fact_state_stream(events: DataFrame, path: str, checkpoint: str, order: Sequence[str] = ("ts",)) -> StreamingQuery:
    """Maintain the fact state from a stream of stores and deletes. Deletes stay as markers, so a late store cannot revive a fact."""
    return latest_wins_stream(events, path, checkpoint, FACT_KEY, order)


def fact_state(spark: SparkSession, checkpoint: str, order: Sequence[str] = ("ts",)) -> DataFrame:
    """The facts that stand, read from the state itself."""
    return live(kept_state(spark, checkpoint)).select(*FACT_KEY, "fact_value", *order)
