"""Sequence operators over (episode, frame): islands, runs, clusters, smoothing, histories.

Every operator partitions by the episode, so one exchange serves a chain of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def along(key: str | list[str] = "episode", *order: str) -> WindowSpec:
    """The rows of an episode in order."""
    return Window.partitionBy(*([key] if isinstance(key, str) else key)).orderBy(*(order or ("frame",)))


def upto(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, 0)


def label_runs(df: DataFrame, label: str | Column, key: str = "episode", frame: str = "frame", *extra: Column) -> DataFrame:
    """Run-length encoding: one row (key, run, label, start_frame, end_frame, n, and extra aggregates) for each maximal run of equal labels;
    null is a label."""
    w = along(key, frame)
    value = F.col(label) if isinstance(label, str) else label
    turn = F.when(F.row_number().over(w) == 1, 0).when(value.eqNullSafe(F.lag(value).over(w)), 0).otherwise(1)
    rows = df.withColumns({"_f": F.col(frame), "_label": value, "_turn": turn}).withColumn("run", F.sum("_turn").over(upto(along(key, "_f"))))
    return rows.groupBy(key, "run").agg(F.first("_label").alias("label"), F.min("_f").alias("start_frame"), F.max("_f").alias("end_frame"), *extra, F.count("*").alias("n"))


def islands(df: DataFrame, mask: Column, key: str | list[str] = "episode", frame: str = "frame", *extra: Column) -> DataFrame:
    """Gaps and islands: (key, start_frame, end_frame) of each maximal run of consecutive frames where mask holds, with extra aggregates."""
    keys = [key] if isinstance(key, str) else key
    held = df.where(mask).withColumn("_island", F.col(frame) - F.row_number().over(along(keys, frame)))
    return held.groupBy(*keys, "_island").agg(F.min(frame).alias("start_frame"), F.max(frame).alias("end_frame"), *extra).drop("_island")


def bridged(df: DataFrame, mask: Column, most: int, blocked: Column | None = None, key: str = "episode", frame: str = "frame") -> DataFrame:
    """df with boolean `bridged`: mask, and also true over interior gaps of at most `most` frames of which none is blocked."""
    w = along(key, frame)
    rows = df.withColumn("_m", mask).withColumn("_b", F.lit(False) if blocked is None else blocked)
    rows = rows.withColumn("_turn", F.when(F.lag("_m").over(w).eqNullSafe(F.col("_m")), 0).otherwise(1)).withColumn("_run", F.sum("_turn").over(upto(w)))
    of_run, whole = Window.partitionBy(key, "_run"), Window.partitionBy(key)
    inner = (F.min(frame).over(of_run) > F.min(frame).over(whole)) & (F.max(frame).over(of_run) < F.max(frame).over(whole))
    fill = ~F.col("_m") & (F.count("*").over(of_run) <= most) & inner & ~F.max("_b").over(of_run)
    return rows.withColumn("bridged", F.col("_m") | fill).drop("_m", "_b", "_turn", "_run")


def gap_clusters(df: DataFrame, position: str, radius: int, key: str = "episode", *order: str) -> DataFrame:
    """df with `cluster`: a new one begins where the gap to the row before is above radius (single linkage to the last member)."""
    w = along(key, position, *order)
    far = F.when(F.col(position) - F.lag(position).over(w) > radius, 1).otherwise(0)
    return df.withColumn("_far", far).withColumn("cluster", F.sum("_far").over(upto(w))).drop("_far")


def moving_sum(value: Column, width: int, w: WindowSpec) -> Column:
    """Sum over a centred window of `width` rows, zero beyond the ends; of an even width the longer half lies before."""
    return F.sum(value).over(w.rowsBetween(-(width // 2), width - width // 2 - 1))


def edge_moving_sum(value: Column, width: int, w: WindowSpec) -> Column:
    """Sum over a centred window of an odd width, with the first and last value repeated beyond the ends."""
    half = width // 2
    inside = F.sum(value).over(w.rowsBetween(-half, half))
    before = F.greatest(F.lit(0), F.lit(half + 1) - F.row_number().over(w))
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = F.greatest(F.lit(0), F.row_number().over(w) + half - F.count("*").over(whole))
    return inside + before * F.first(value).over(whole) + after * F.last(value).over(whole)


def segments_from_boundaries(cuts: DataFrame, lengths: DataFrame, key: str = "episode") -> DataFrame:
    """(key, segment, start_frame, end_frame): disjoint segments that cover 0..n-1, cut at the distinct boundaries strictly inside.

    cuts: key, frame. lengths: key, n. An episode without boundaries is one segment; one of no frames has none.
    """
    inner = cuts.join(lengths, key).where("frame > 0 and frame < n").select(key, "frame", "n").distinct()
    starts = inner.unionByName(lengths.where("n > 0").select(key, F.lit(0).cast("long").alias("frame"), "n"))
    w = along(key, "frame")
    return starts.select(key, (F.row_number().over(w) - 1).cast("long").alias("segment"), F.col("frame").alias("start_frame"), (F.coalesce(F.lead("frame").over(w), F.col("n")) - 1).alias("end_frame"))


def sign_continuity(dot: Column, key: str = "episode", frame: str = "frame") -> tuple[Column, Column]:
    """Group marker and flip marker of sign-continuous sequences: a zero dot restarts the sign, a negative one flips it."""
    return F.when(dot == 0, 1).otherwise(0), F.when(dot < 0, 1).otherwise(0)


def block_numbers(df: DataFrame, key: str, order: list[str], buckets: int = 256) -> DataFrame:
    """df with `block`: contiguous numbers over all episodes in the order of the numeric key, then `order`.

    Rows are counted for each episode, and the counts are summed over `buckets` ranges of about as many episodes each, so no task sees
    all rows, whatever the keys look like. Their bounds come from a quantile sketch of the keys, which runs while the plan is made: a
    plan that found them anew in each use could number rows twice.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("_n"))
    bounds = sorted(set(df.select(key).approxQuantile(key, [i / buckets for i in range(1, buckets)], 0.25 / buckets)))
    edges = F.array(*[F.lit(b) for b in bounds]) if bounds else F.array().cast("array<double>")
    counts = counts.withColumn("_range", F.size(F.filter(edges, lambda e: e <= F.col(key).cast("double"))))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = counts.groupBy("_range").agg(F.sum("_n").alias("_sum")).withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    inside = Window.partitionBy("_range").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.join(F.broadcast(ranges), "_range").select(key, (F.col("_base") + F.coalesce(F.sum("_n").over(inside), F.lit(0))).alias("_start"))
    return df.join(starts, key).withColumn("block", F.col("_start") + F.row_number().over(along(key, *order)) - 1).drop("_start")


def first_of(found: DataFrame, key: str, order: str, n: int = 5) -> DataFrame:
    """(key, docs, examples): how many rows each key has, and its first n by `order`. The rank is filtered at once, so each task keeps n
    rows of a key, and a key of all rows is counted before the exchange."""
    few = found.withColumn("_k", F.row_number().over(Window.partitionBy(key).orderBy(order))).where(F.col("_k") <= n)
    return found.groupBy(key).agg(F.count("*").alias("docs")).join(few.groupBy(key).agg(F.sort_array(F.collect_list(order)).alias("examples")), key)


def absorb_still(df: DataFrame, still: Column, least: int, key: str = "episode", order: str = "segment", n: str = "n") -> DataFrame:
    """df with `group`, `is_still` and `role`: still segments joined to the motion they belong to.

    Leading still segments go to the next motion (pre_context), others to the one before (post_settle); those after the last motion
    are a group of their own if they have `least` frames together, or if there is no motion at all (terminal).
    """
    w = along(key, order)
    whole = Window.partitionBy(key)
    rows = df.withColumn("is_still", still).withColumn("_seen", F.sum(F.when(F.col("is_still"), 0).otherwise(1)).over(upto(w)))
    rows = rows.withColumn("_all", F.max("_seen").over(whole))
    tail = F.col("is_still") & (F.col("_seen") == F.col("_all"))
    rows = rows.withColumn("_tail", F.sum(F.when(tail, F.col(n)).otherwise(0)).over(whole))
    own = tail & ((F.col("_tail") >= least) | (F.col("_all") == 0))
    rows = rows.withColumn("group", F.when(own, F.col("_all") + F.when(F.col("_all") == 0, 0).otherwise(1)).otherwise(F.greatest(F.col("_seen"), F.lit(1))) - F.when(F.col("_all") == 0, 0).otherwise(1))
    role = F.when(~F.col("is_still"), "owner").when(own, "terminal").when(F.col("_seen") == 0, "pre_context").otherwise("post_settle")
    return rows.withColumn("role", role).drop("_seen", "_all", "_tail")
