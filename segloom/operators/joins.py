"""Alignment joins: as-of, interval and nearest, each with an equality key so that they stay hash or merge joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof(target: DataFrame, source: DataFrame, key: str = "episode", at: str = "t", tie: str = "id") -> DataFrame:
    """target with `before` and `after`: structs (t, id) of the source rows next to its time.

    before: the latest source at or before, of equal times the largest id. after: the earliest at or after, of equal times the
    smallest id. One exchange: both sides are stacked and filled along the time line, in linear time.
    """
    extra = [c for c in target.columns if c not in (key, at)]
    mark = F.struct(F.col(at).alias("t"), F.col(tie).alias("id"))
    left = target.select(key, at, F.lit(1).alias("_side"), F.lit(None).cast("long").alias("_tie"), F.struct(*extra).alias("_row"), F.lit(None).cast(source.select(mark.alias("m")).schema["m"].dataType).alias("_mark"))
    right = source.select(key, at, F.lit(0).alias("_side"), F.col(tie).alias("_tie"), F.lit(None).cast(left.schema["_row"].dataType).alias("_row"), mark.alias("_mark"))
    both = left.unionByName(right)
    back = Window.partitionBy(key).orderBy(at, "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    on = Window.partitionBy(key).orderBy(F.desc(at), "_side", F.desc("_tie")).rowsBetween(Window.unboundedPreceding, 0)
    filled = both.withColumn("before", F.last("_mark", ignorenulls=True).over(back)).withColumn("after", F.last("_mark", ignorenulls=True).over(on))
    return filled.where("_side = 1").select(key, at, "_row.*", "before", "after")


def nearest(aligned: DataFrame, at: str = "t") -> DataFrame:
    """asof() output with `near`: the closer of before and after; at equal distance the earlier."""
    gap_before, gap_after = F.col(at) - F.col("before.t"), F.col("after.t") - F.col(at)
    near = F.when(F.col("before").isNull(), F.col("after")).when(F.col("after").isNull() | (gap_before <= gap_after), F.col("before")).otherwise(F.col("after"))
    return aligned.withColumn("near", near)


def interval_overlap(a: DataFrame, b: DataFrame, key: str = "episode", bucket: int = 64) -> DataFrame:
    """Pairs of intervals [start, stop) of a and [b_start, b_stop) of b with a common point, within the key.

    Both sides are put in time buckets, so that a long episode is many small equality joins; a pair is kept where its common part
    begins, so it comes once.
    """
    def spread(df: DataFrame, lo: str, hi: str) -> DataFrame:
        return df.where(F.col(hi) > F.col(lo)).withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(lo) / bucket), F.floor((F.col(hi) - 1) / bucket))))

    joined = spread(a, "start", "stop").join(spread(b, "b_start", "b_stop"), [key, "_bucket"])
    first = F.greatest("start", "b_start")
    return joined.where((F.col("start") < F.col("b_stop")) & (F.col("b_start") < F.col("stop")) & (F.floor(first / bucket) == F.col("_bucket"))).drop("_bucket")


def aligned_audit(left: DataFrame, right: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """(issue, n): rows on one side only, and for each field the joined rows whose values differ; null equals null."""
    a = left.select(*keys, F.struct(*fields).alias("a"))
    b = right.select(*keys, F.struct(*fields).alias("b"))
    both = a.join(b, keys, "full")
    checks = [F.when(F.col("a").isNull(), "missing_left"), F.when(F.col("b").isNull(), "missing_right")]
    checks += [F.when(F.col("a").isNotNull() & F.col("b").isNotNull() & ~F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}")), f"differs_{f}") for f in fields]
    return both.select(F.explode(F.filter(F.array(*checks), lambda c: c.isNotNull())).alias("issue")).groupBy("issue").agg(F.count("*").alias("n"))
