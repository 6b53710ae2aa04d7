"""Tables of a data set, and the roles they play for sequence operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A Parquet table by name; filters and column choices reach the scan."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def dealt(df: DataFrame, key: str) -> DataFrame:
    """df dealt by key to all cores if it comes of fewer files than there are cores: a small file is one row group, so one task. A table
    of many files stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if len(df._jdf.inputFiles()) >= cores else df.repartition(cores, key)


def events(spark: SparkSession, root: str) -> DataFrame:
    """Event stream: episode, frame (0..n-1 in time order), t (microseconds), c (hundredths of value), label, event_id."""
    raw = table(spark, root, "events")
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return raw.select(
        F.col("user_id").alias("episode"),
        (F.row_number().over(order) - 1).cast("long").alias("frame"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("t"),
        F.round(F.col("value") * 100).cast("long").alias("c"),
        F.col("event_type").alias("label"),
        "event_id",
    )


EVENTS = """ev AS (SELECT user_id AS episode, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame,
  epoch_us(ts) AS t, CAST(round(value * 100) AS BIGINT) AS c, event_type AS label, event_id FROM events)"""


def timeline(spark: SparkSession, root: str) -> DataFrame:
    """Segment list: episode, segment, left, right, n (frames), start_frame and end_frame by prefix sums."""
    raw = table(spark, root, "lineitem")
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    n = F.col("l_quantity").cast("long")
    total = F.sum(n).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return raw.select(
        F.col("l_orderkey").alias("episode"),
        (F.row_number().over(order) - 1).cast("long").alias("segment"),
        F.col("l_returnflag").alias("left"),
        F.col("l_linestatus").alias("right"),
        n.alias("n"),
        (total - n).alias("start_frame"),
        (total - 1).alias("end_frame"),
    )


TIMELINE = """tl AS (SELECT *, CAST(stop - n AS BIGINT) AS start_frame, CAST(stop - 1 AS BIGINT) AS end_frame FROM (
  SELECT l_orderkey AS episode, row_number() OVER w - 1 AS segment, l_returnflag AS "left", l_linestatus AS "right", CAST(l_quantity AS BIGINT) AS n,
    sum(CAST(l_quantity AS BIGINT)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stop
  FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate)))"""


def vectors(spark: SparkSession, root: str) -> DataFrame:
    """State vectors: episode, frame, x (array of doubles, rounded to six decimals)."""
    raw = table(spark, root, "embeddings")
    order = Window.partitionBy("label").orderBy("vec_id")
    return raw.select(
        F.col("label").cast("long").alias("episode"),
        (F.row_number().over(order) - 1).cast("long").alias("frame"),
        F.transform(F.slice("embedding", 1, 16), lambda v: F.round(v.cast("double") * 1000000).cast("long")).alias("x"),
    )


VECTORS = """vx AS (SELECT CAST(label AS BIGINT) AS episode, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame,
  list_transform(embedding[1:16], lambda v: CAST(round(CAST(v AS DOUBLE) * 1000000) AS BIGINT)) AS x FROM embeddings)"""
