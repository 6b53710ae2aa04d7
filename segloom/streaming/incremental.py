"""Incremental forms: resumable batches, latest state, sessions and gates over a file stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def pending(inventory: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What of the inventory has no finished row yet."""
    return inventory.join(done.select(*keys).distinct(), keys, "left_anti")


def latest(journal: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key of an append-only journal, in one aggregation."""
    rest = [c for c in journal.columns if c not in keys]
    return journal.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*")


def committed_prefix(results: DataFrame, index: str, ok: str) -> DataFrame:
    """Results before the first one that failed."""
    stop = results.where(~F.col(ok)).agg(F.min(index).alias("_stop"))
    return results.join(F.broadcast(stop)).where(F.col("_stop").isNull() | (F.col(index) < F.col("_stop"))).drop("_stop")


def read_events(spark: SparkSession, path: str, schema: str, per_trigger: int = 16) -> DataFrame:
    """A folder of Parquet files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def sessions(events: DataFrame, at: str, key: str, gap: str, late: str) -> DataFrame:
    """(key, start, stop, n) of runs of events less than `gap` apart; works on streams, for which rows over `late` late are left out."""
    marked = events.withWatermark(at, late) if events.isStreaming else events
    found = marked.groupBy(key, F.session_window(at, gap).alias("w")).agg(F.count("*").alias("n"))
    return found.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("stop"), "n")


def stage(stream: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Run `work` on each micro-batch and append it to `out`. A batch that is done again replaces its own folder, so restarts are safe."""

    def batch(df: DataFrame, number: int) -> None:
        work(df).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch).trigger(availableNow=True).start()


def run_identity(df: DataFrame) -> DataFrame:
    """(rows, digest) of a configuration or inventory: two runs may share results only if they agree. Order does not matter."""
    row = F.sha2(F.to_json(F.struct(*sorted(df.columns))), 256)
    return df.select(row.alias("h")).agg(F.count("*").alias("rows"), F.sha2(F.concat(F.sum(F.conv(F.substring("h", 1, 15), 16, 10).cast("decimal(38,0)")).cast("string"), F.max("h")), 256).alias("digest"))


def first_of_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row for each key, the first in the order given: an idempotency cache."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")
