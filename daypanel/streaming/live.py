"""Structured Streaming forms of the incremental merge and of the daily sample summary."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from daypanel.core import DAY, ENTITY, KEYS, keep_last
from daypanel.operators import sync
from daypanel.operators.sessions import sample_daily
from daypanel.plans.jobs import materialise, months_of, upsert_table
from daypanel.sources import sinks

def upsert_stream(
    stream: DataFrame, table: str, merge: Callable, checkpoint: str, key=None, available_now: bool = True
) -> StreamingQuery:
    """Merge each arriving batch of rows into a stored table; only touched months are rewritten.

    The number of the merged batch is published together with the data, under a name taken
    from the checkpoint, so a batch handed over again after a failure is applied exactly once.
    """
    name = hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def apply(batch: DataFrame, batch_id: int) -> None:
        if sinks.applied_batch(batch.sparkSession, table, name) >= batch_id:
            return
        upsert_table(batch, table, merge, key, f"v=batch-{name}-{batch_id}", {f"{sinks.MARK}{name}": str(batch_id)})

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def newest_days(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """Upsert by (entity, day), the newer row wins."""
    both = sync.stack(old, new)
    return keep_last(both, KEYS, sync.newest_first([c for c in both.columns if c not in (*KEYS, "_source")], both)).drop("_source")


def write_daily_samples(stream: DataFrame, root: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Samples (entity, ts, bpm) merged by key, however late they come, and the summary of each day they touch.

    ``root/samples`` and ``root/daily`` are stored tables.  Every batch is merged into the samples, then the touched
    days are summed up anew from all their samples.  Both publish the batch number with the data, so a batch handed over again changes
    nothing, and readers see whole batches.  One writer per root.
    """
    name = hashlib.md5(checkpoint.encode()).hexdigest()[:12]
    samples, daily = f"{root}/samples", f"{root}/daily"

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        version, mark = f"v=batch-{name}-{batch_id}", {f"{sinks.MARK}{name}": str(batch_id)}
        rows = batch.where(F.col("ts").isNotNull() & F.col(ENTITY).isNotNull()).select(
            ENTITY, F.col("ts").cast("date").alias(DAY), F.col("ts").cast("string").alias("sample_ts"), F.col("bpm").cast("double").alias("bpm")
        )
        landed = materialise(rows, "samples")
        if sinks.applied_batch(spark, samples, name) < batch_id:
            upsert_table(landed, samples, sync.merge_samples, version=version, mark=mark)
        if sinks.applied_batch(spark, daily, name) < batch_id and (months := months_of(landed)):
            touched = landed.select(*KEYS).distinct()
            held = sinks.read_version(spark, samples, months).join(touched, KEYS, "left_semi")
            upsert_table(sample_daily(held), daily, newest_days, version=version, mark=mark)

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_daily_samples(spark: SparkSession, root: str) -> DataFrame | None:
    return sinks.read_version(spark, f"{root}/daily")
