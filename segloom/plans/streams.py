"""Queries over the event stream: segments, quality gates, alignment, smoothing, islands, clusters, transitions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from segloom.functions.arrays import round_even
from segloom.operators.joins import asof, interval_overlap, nearest
from segloom.operators.windows import along, bridged, edge_moving_sum, gap_clusters, islands, label_runs, moving_sum
from segloom.plans.registry import query
from segloom.sources.tables import EVENTS, events

HIGH = 2000  # hundredths: a value from here on is active
BAND = (1000, 3000)

RUNS = """ru AS (SELECT episode, run, any_value(label) AS label, min(frame) AS start_frame, max(frame) AS end_frame, count(*) AS n FROM (
  SELECT *, sum(turn) OVER (PARTITION BY episode ORDER BY frame) AS run FROM (
    SELECT *, CASE WHEN frame > 0 AND label IS DISTINCT FROM lag(label) OVER (PARTITION BY episode ORDER BY frame) THEN 1 ELSE 0 END AS turn FROM ev)) GROUP BY episode, run)"""


@query("activity_segments", f"WITH {EVENTS}, {RUNS} SELECT episode, CAST(run AS BIGINT) AS segment, label, start_frame, end_frame, n, CAST(ceil(n / 8.0) AS BIGINT) AS num_chunks FROM ru")
def activity_segments(spark, root):
    """WIN-07, SEG-01, PRJ-12."""
    return label_runs(events(spark, root), "label").select("episode", F.col("run").cast("long").alias("segment"), "label", "start_frame", "end_frame", "n", F.ceil(F.col("n") / 8).cast("long").alias("num_chunks"))


@query("activity_segment_stats", f"""WITH {EVENTS}, {RUNS} SELECT episode, count(*) AS segments, CAST(sum(n) AS BIGINT) AS frames, min(n) AS shortest, max(n) AS longest, median(n) AS median_n,
  count(*) FILTER (WHERE n < 2) AS n_1, count(*) FILTER (WHERE n = 2) AS n_2, count(*) FILTER (WHERE n > 2) AS n_more FROM ru GROUP BY episode""")
def activity_segment_stats(spark, root):
    """AGG-02."""
    n = F.col("n")
    return label_runs(events(spark, root), "label").groupBy("episode").agg(F.count("*").alias("segments"), F.sum(n).alias("frames"), F.min(n).alias("shortest"), F.max(n).alias("longest"), F.percentile(n, F.lit(0.5)).alias("median_n"), F.count_if(n < 2).alias("n_1"), F.count_if(n == 2).alias("n_2"), F.count_if(n > 2).alias("n_more"))


STEPS = "st AS (SELECT *, t - lag(t) OVER (PARTITION BY episode ORDER BY frame) AS dt FROM ev), me AS (SELECT episode, median(dt) AS period FROM st GROUP BY episode)"


def steps(spark, root):
    return events(spark, root).withColumn("dt", F.col("t") - F.lag("t").over(along()))


def with_period(spark, root):
    return steps(spark, root).withColumn("period", F.percentile("dt", F.lit(0.5)).over(Window.partitionBy("episode")))


@query("stream_quality_violations", f"""WITH {EVENTS}, {STEPS}, v AS (SELECT episode, frame, dt, CASE WHEN dt <= 0 THEN 'disorder' WHEN dt > 1.5 * period THEN 'gap' END AS code FROM st JOIN me USING (episode))
  SELECT episode, code, count(*) AS n, max(dt) AS max_dt, list(frame ORDER BY frame)[1:20] AS frames FROM v WHERE code IS NOT NULL GROUP BY episode, code""")
def stream_quality_violations(spark, root):
    """FLT-01, AGG-11: at most the first 20 places of each code; a window minimum keeps the rest out of the list."""
    bad = with_period(spark, root).withColumn("code", F.when(F.col("dt") <= 0, "disorder").when(F.col("dt") > 1.5 * F.col("period"), "gap")).where("code is not null")
    placed = bad.withColumn("_k", F.row_number().over(Window.partitionBy("episode", "code").orderBy("frame")))
    return placed.groupBy("episode", "code").agg(F.count("*").alias("n"), F.max("dt").alias("max_dt"), F.sort_array(F.collect_list(F.when(F.col("_k") <= 20, F.col("frame")))).alias("frames"))


@query("stream_coverage", f"""WITH {EVENTS}, s AS (SELECT episode, label, min(t) AS first_t, max(t) AS last_t, count(*) AS n FROM ev GROUP BY episode, label)
  SELECT *, first_t - min(first_t) OVER (PARTITION BY episode) AS prefix, max(last_t) OVER (PARTITION BY episode) - last_t AS suffix FROM s""")
def stream_coverage(spark, root):
    """FLT-04, AGG-21."""
    whole = Window.partitionBy("episode")
    topics = events(spark, root).groupBy("episode", "label").agg(F.min("t").alias("first_t"), F.max("t").alias("last_t"), F.count("*").alias("n"))
    return topics.withColumn("prefix", F.col("first_t") - F.min("first_t").over(whole)).withColumn("suffix", F.max("last_t").over(whole) - F.col("last_t"))


@query("edge_trim", f"""WITH {EVENTS}, s AS (SELECT episode, label, min(t) AS a, max(t) AS z FROM ev GROUP BY episode, label), w AS (SELECT episode, max(a) AS lo, min(z) AS hi FROM s GROUP BY episode)
  SELECT episode, lo, hi, count(*) FILTER (WHERE t BETWEEN lo AND hi) AS kept, count(*) FILTER (WHERE t < lo) AS head, count(*) FILTER (WHERE t > hi) AS tail FROM ev JOIN w USING (episode) GROUP BY ALL""")
def edge_trim(spark, root):
    """FLT-06: the interval that all topics of an episode cover."""
    ev = events(spark, root)
    span = ev.groupBy("episode", "label").agg(F.min("t").alias("a"), F.max("t").alias("z")).groupBy("episode").agg(F.max("a").alias("lo"), F.min("z").alias("hi"))
    t = F.col("t")
    return ev.join(span, "episode").groupBy("episode", "lo", "hi").agg(F.count_if(t.between(F.col("lo"), F.col("hi"))).alias("kept"), F.count_if(t < F.col("lo")).alias("head"), F.count_if(t > F.col("hi")).alias("tail"))


def clicks_and_purchases(spark, root):
    ev = events(spark, root)
    return ev.where("label = 'click'").select("episode", "t", "event_id"), ev.where("label = 'purchase'").select("episode", "t", F.col("event_id").alias("id"))


PAIRED = """p AS (SELECT episode, t, event_id AS id FROM ev WHERE label = 'purchase'), k AS (SELECT episode, t, event_id FROM ev WHERE label = 'click'),
 b AS (SELECT k.episode, k.t, k.event_id, p.t AS before_t, p.id AS before_id FROM k ASOF LEFT JOIN p ON k.episode = p.episode AND k.t >= p.t),
 a AS (SELECT k.event_id, p.t AS after_t, p.id AS after_id FROM k ASOF LEFT JOIN p ON k.episode = p.episode AND k.t <= p.t),
 n AS (SELECT b.*, after_t, after_id, CASE WHEN before_t IS NULL OR after_t - t < t - before_t THEN after_id ELSE before_id END AS near_id,
   CASE WHEN before_t IS NULL OR after_t - t < t - before_t THEN after_t ELSE before_t END AS near_t FROM b JOIN a USING (event_id))"""


@query("asof_backward", f"WITH {EVENTS}, {PAIRED} SELECT episode, t, event_id, before_t, before_id FROM b")
def asof_backward(spark, root):
    """JOIN-01."""
    return asof(*clicks_and_purchases(spark, root)).select("episode", "t", "event_id", F.col("before.t").alias("before_t"), F.col("before.id").alias("before_id"))


@query("asof_forward", f"WITH {EVENTS}, {PAIRED} SELECT episode, t, event_id, after_t, after_id FROM b JOIN a USING (event_id)")
def asof_forward(spark, root):
    """JOIN-04."""
    return asof(*clicks_and_purchases(spark, root)).select("episode", "t", "event_id", F.col("after.t").alias("after_t"), F.col("after.id").alias("after_id"))


@query("asof_nearest", f"WITH {EVENTS}, {PAIRED} SELECT episode, t, event_id, near_t, near_id FROM n")
def asof_nearest(spark, root):
    """JOIN-02."""
    return nearest(asof(*clicks_and_purchases(spark, root))).select("episode", "t", "event_id", F.col("near.t").alias("near_t"), F.col("near.id").alias("near_id"))


@query("asof_tolerance", f"WITH {EVENTS}, {PAIRED} SELECT episode, count(*) AS n, count(*) FILTER (WHERE before_t IS NULL) AS missing, count(*) FILTER (WHERE t - before_t > 3600000000) AS stale, max(t - before_t) AS max_skew FROM b GROUP BY episode")
def asof_tolerance(spark, root):
    """JOIN-03, FLT-05, AGG-24: targets without an observation, or with one that is over an hour old."""
    age = F.col("t") - F.col("before.t")
    return asof(*clicks_and_purchases(spark, root)).groupBy("episode").agg(F.count("*").alias("n"), F.count_if(F.col("before").isNull()).alias("missing"), F.count_if(age > 3_600_000_000).alias("stale"), F.max(age).alias("max_skew"))


@query("moving_average_same", f"""WITH {EVENTS}, m AS (SELECT *, least(5, count(*) OVER (PARTITION BY episode)) AS n FROM ev)
  SELECT episode, frame, CAST(sum(c) OVER (PARTITION BY episode ORDER BY frame ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS BIGINT) / 5.0::DOUBLE AS smooth,
    CAST(sum(c) OVER (PARTITION BY episode ORDER BY frame ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS BIGINT) / 4.0::DOUBLE AS smooth_even FROM m WHERE n = 5""")
def moving_average_same(spark, root):
    """WIN-02, over episodes of at least five frames; zero beyond the ends, always divided by the width."""
    w = along()
    long = events(spark, root).withColumn("n", F.count("*").over(Window.partitionBy("episode"))).where("n >= 5")
    return long.select("episode", "frame", (moving_sum(F.col("c"), 5, w) / 5).alias("smooth"), (moving_sum(F.col("c"), 4, w) / 4).alias("smooth_even"))


@query("moving_average_edge", f"""WITH {EVENTS}, f AS (SELECT *, first_value(c) OVER w AS head, last_value(c) OVER w AS tail, count(*) OVER (PARTITION BY episode) AS n FROM ev
    WINDOW w AS (PARTITION BY episode ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
  SELECT episode, frame, CAST(sum(c) OVER (PARTITION BY episode ORDER BY frame ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) + greatest(0, 2 - frame) * head + greatest(0, frame + 3 - n) * tail AS BIGINT) / 5.0::DOUBLE AS smooth FROM f""")
def moving_average_edge(spark, root):
    """WIN-03."""
    return events(spark, root).select("episode", "frame", (edge_moving_sum(F.col("c"), 5, along()) / 5).alias("smooth"))


@query("value_rate_energy", f"""WITH {EVENTS}, {STEPS}, q AS (SELECT episode, quantile_cont(c, 0.05) AS lo, quantile_cont(c, 0.95) AS hi FROM ev GROUP BY episode),
  u AS (SELECT episode, frame, dt, CASE WHEN hi - lo <= 1e-9 THEN 0 ELSE greatest(0, least(1, (c - lo) / (hi - lo))) END AS unit FROM st JOIN q USING (episode))
  SELECT episode, frame, round_even(unit, 6) AS unit, CASE WHEN frame = 0 THEN 0.0 ELSE round_even(abs(unit - lag(unit) OVER (PARTITION BY episode ORDER BY frame)) / (dt / 1e9), 6) END AS energy FROM u""")
def value_rate_energy(spark, root):
    """WIN-01, PRJ-07, PRJ-09: value scaled by its 5th and 95th percentile, and its rate; the first frame has rate 0."""
    whole = Window.partitionBy("episode")
    ev = steps(spark, root).withColumn("lo", F.percentile("c", F.lit(0.05)).over(whole)).withColumn("span", F.percentile("c", F.lit(0.95)).over(whole) - F.col("lo"))
    unit = F.when(F.col("span") <= 1e-9, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("c") - F.col("lo")) / F.col("span"))))
    ev = ev.withColumn("unit", unit)
    rate = F.abs(F.col("unit") - F.lag("unit").over(along())) / (F.col("dt") / 1e9)
    return ev.select("episode", "frame", round_even(F.col("unit"), 6).alias("unit"), F.when(F.col("frame") == 0, 0.0).otherwise(round_even(rate, 6)).alias("energy"))


@query("mask_islands", f"""WITH {EVENTS} SELECT episode, min(frame) AS start_frame, max(frame) AS end_frame, count(*) AS n, CAST(sum(c) AS BIGINT) AS total FROM (
  SELECT *, frame - row_number() OVER (PARTITION BY episode ORDER BY frame) AS g FROM ev WHERE c >= {HIGH}) GROUP BY episode, g""")
def mask_islands(spark, root):
    """WIN-06."""
    return islands(events(spark, root), F.col("c") >= HIGH, "episode", "frame", F.count("*").alias("n"), F.sum("c").alias("total"))


@query("bridged_islands", f"""WITH {EVENTS}, m AS (SELECT *, c >= {HIGH} AS m, label = 'error' AS b FROM ev),
  r AS (SELECT *, sum(turn) OVER (PARTITION BY episode ORDER BY frame) AS run FROM (SELECT *, CASE WHEN frame > 0 AND m = lag(m) OVER (PARTITION BY episode ORDER BY frame) THEN 0 ELSE 1 END AS turn FROM m)),
  f AS (SELECT *, m OR (count(*) OVER g <= 2 AND NOT bool_or(b) OVER g AND min(frame) OVER g > 0 AND max(frame) OVER g < max(frame) OVER (PARTITION BY episode)) AS held FROM r WINDOW g AS (PARTITION BY episode, run))
  SELECT episode, min(frame) AS start_frame, max(frame) AS end_frame FROM (SELECT *, frame - row_number() OVER (PARTITION BY episode ORDER BY frame) AS i FROM f WHERE held) GROUP BY episode, i""")
def bridged_islands(spark, root):
    """WIN-08: islands over gaps of two frames at most, but not over errors."""
    return islands(bridged(events(spark, root), F.col("c") >= HIGH, 2, F.col("label") == "error"), F.col("bridged"))


@query("value_change_events", f"""WITH {EVENTS}, d AS (SELECT *, c - lag(c) OVER (PARTITION BY episode ORDER BY frame) AS dc FROM ev),
  i AS (SELECT *, frame - row_number() OVER (PARTITION BY episode ORDER BY frame) AS g FROM d WHERE abs(dc) >= 1500)
  SELECT episode, min(frame) - 1 AS start_frame, max(frame) AS end_frame, CAST(sum(dc) AS BIGINT) AS delta, CASE WHEN sum(dc) < 0 THEN 'decrease' ELSE 'increase' END AS direction FROM i GROUP BY episode, g""")
def value_change_events(spark, root):
    """WIN-09: runs of large changes, from the frame before the first to the last."""
    ev = events(spark, root).withColumn("dc", F.col("c") - F.lag("c").over(along()))
    runs = islands(ev, F.abs("dc") >= 1500, "episode", "frame", F.sum("dc").alias("delta"))
    return runs.select("episode", (F.col("start_frame") - 1).alias("start_frame"), "end_frame", "delta", F.when(F.col("delta") < 0, "decrease").otherwise("increase").alias("direction"))


@query("value_trend_events", f"""WITH {EVENTS}, d AS (SELECT *, c - lag(c) OVER (PARTITION BY episode ORDER BY frame) AS dc FROM ev), s AS (SELECT d.*, sign, sign * dc >= 800 AS m, sign * dc <= -800 AS b FROM d, (VALUES (1), (-1)) v(sign)),
  r AS (SELECT *, sum(turn) OVER (PARTITION BY episode, sign ORDER BY frame) AS run FROM (SELECT *, CASE WHEN frame > 0 AND coalesce(m, false) = coalesce(lag(m) OVER (PARTITION BY episode, sign ORDER BY frame), false) THEN 0 ELSE 1 END AS turn FROM s)),
  f AS (SELECT *, coalesce(m, false) OR (count(*) OVER g <= 1 AND NOT bool_or(coalesce(b, false)) OVER g AND min(frame) OVER g > 0 AND max(frame) OVER g < max(frame) OVER (PARTITION BY episode)) AS held FROM r WINDOW g AS (PARTITION BY episode, sign, run)),
  i AS (SELECT episode, sign, min(frame) AS onset, max(frame) AS done FROM (SELECT *, frame - row_number() OVER (PARTITION BY episode, sign ORDER BY frame) AS k FROM f WHERE held) GROUP BY episode, sign, k)
  SELECT i.episode, onset, done, CASE WHEN sign > 0 THEN 'increase' ELSE 'decrease' END AS direction, z.c - a.c AS delta FROM i JOIN ev a ON a.episode = i.episode AND a.frame = greatest(0, onset - 1) JOIN ev z ON z.episode = i.episode AND z.frame = done WHERE abs(z.c - a.c) >= 1000""")
def value_trend_events(spark, root):
    """WIN-10: rises and falls, bridged over single frames that do not go the other way, with a least change against the frame before."""
    w = along()
    ev = events(spark, root).withColumn("dc", F.coalesce(F.col("c") - F.lag("c").over(w), F.lit(0))).withColumn("prev", F.coalesce(F.lag("c").over(w), F.col("c")))
    both = ev.withColumn("sign", F.explode(F.array(F.lit(1), F.lit(-1)))).withColumn("track", F.struct("episode", "sign"))
    held = bridged(both, F.col("sign") * F.col("dc") >= 800, 1, F.col("sign") * F.col("dc") <= -800, key="track")
    runs = islands(held, F.col("bridged"), "track", "frame", F.min_by("prev", "frame").alias("a"), F.max_by("c", "frame").alias("z"))
    out = runs.select("track.episode", F.col("start_frame").alias("onset"), F.col("end_frame").alias("done"), F.when(F.col("track.sign") > 0, "increase").otherwise("decrease").alias("direction"), (F.col("z") - F.col("a")).alias("delta"))
    return out.where(F.abs("delta") >= 1000)


@query("pause_valleys", f"""WITH {EVENTS}, i AS (SELECT *, frame - row_number() OVER (PARTITION BY episode ORDER BY frame) AS g FROM ev WHERE c < {BAND[0]}), n AS (SELECT episode, count(*) AS n FROM ev GROUP BY episode),
  v AS (SELECT episode, min(frame) AS start_frame, max(frame) AS end_frame, min(c) AS low, arg_min(frame, (c, frame)) AS valley FROM i GROUP BY episode, g)
  SELECT v.*, 2 + ({BAND[0]} - low) / {BAND[0]}::DOUBLE AS strength FROM v JOIN n USING (episode) WHERE start_frame > 1 AND end_frame < n - 2 AND end_frame - start_frame >= 1""")
def pause_valleys(spark, root):
    """WIN-11: quiet runs of two frames or more away from the ends, and their first least frame."""
    ev = events(spark, root).withColumn("frames", F.count("*").over(Window.partitionBy("episode")))
    runs = islands(ev, F.col("c") < BAND[0], "episode", "frame", F.min("c").alias("low"), F.min_by("frame", F.struct("c", "frame")).alias("valley"), F.max("frames").alias("frames"))
    kept = runs.where("start_frame > 1 and end_frame < frames - 2 and end_frame - start_frame >= 1")
    return kept.select("episode", "start_frame", "end_frame", "low", "valley", (2 + (BAND[0] - F.col("low")) / BAND[0]).alias("strength"))


CLUSTERS = """cl AS (SELECT *, sum(far) OVER (PARTITION BY episode ORDER BY t, event_id) AS cluster FROM (
  SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY episode ORDER BY t, event_id) > 1800000000 THEN 1 ELSE 0 END AS far FROM ev))"""


@query("gap_clusters", f"WITH {EVENTS}, {CLUSTERS} SELECT episode, CAST(cluster AS BIGINT) AS cluster, min(t) AS first_t, max(t) AS last_t, count(*) AS n FROM cl GROUP BY episode, cluster")
def gap_clusters_(spark, root):
    """WIN-16 (a session is cut by a gap of over half an hour)."""
    return gap_clusters(events(spark, root), "t", 1_800_000_000, "episode", "event_id").groupBy("episode", F.col("cluster").cast("long").alias("cluster")).agg(F.min("t").alias("first_t"), F.max("t").alias("last_t"), F.count("*").alias("n"))


@query("cluster_combine", f"""WITH {EVENTS}, {CLUSTERS} SELECT episode, CAST(cluster AS BIGINT) AS cluster, CAST(sum(frame * (c + 1)) AS BIGINT) / CAST(sum(c + 1) AS BIGINT)::DOUBLE AS centroid, max(c) AS strength,
  arg_max(frame, (c, -frame)) AS representative, list_sort(list(DISTINCT label)) AS labels, count(*) AS support FROM cl GROUP BY episode, cluster""")
def cluster_combine(spark, root):
    """AGG-25: weighted centroid, strongest member (of equals the first), union of labels."""
    rows = gap_clusters(events(spark, root), "t", 1_800_000_000, "episode", "event_id")
    weight = F.col("c") + 1
    return rows.groupBy("episode", F.col("cluster").cast("long").alias("cluster")).agg((F.sum(F.col("frame") * weight) / F.sum(weight)).alias("centroid"), F.max("c").alias("strength"), F.max_by("frame", F.struct(F.col("c"), -F.col("frame"))).alias("representative"), F.sort_array(F.collect_set("label")).alias("labels"), F.count("*").alias("support"))


@query("trend_onset", f"""WITH {EVENTS}, s AS (SELECT episode, frame, c, avg_after.* FROM ev, LATERAL (SELECT 1 AS one) avg_after),
  f AS (SELECT *, sum(c) OVER a AS sa, count(*) OVER a AS na, count(*) FILTER (WHERE c >= 1000) OVER a AS ha, sum(c) OVER b AS sb, count(*) OVER b AS nb FROM s
    WINDOW a AS (PARTITION BY episode ORDER BY frame ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING), b AS (PARTITION BY episode ORDER BY frame ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)),
  g AS (SELECT * FROM f WHERE na >= 2 AND c >= 1000 AND sa >= 2200 * na AND 100 * ha >= 67 * na AND (nb = 0 OR sb < 2200 * nb OR sa * nb >= sb * na + 600 * na * nb)),
  p AS (SELECT episode, frame AS nominal FROM ev WHERE label = 'signup')
  SELECT p.episode, nominal, coalesce(min(g.frame), nominal) AS onset, count(g.frame) > 0 AS found FROM p LEFT JOIN g ON g.episode = p.episode AND g.frame BETWEEN greatest(1, nominal - 5) AND nominal + 5 GROUP BY p.episode, nominal""")
def trend_onset(spark, root):
    """WIN-15: near each proposal, the earliest frame from which the signal is high and stays so, or has risen; all in whole numbers."""
    ev = events(spark, root)
    w = along()
    after, before = w.rowsBetween(0, 2), w.rowsBetween(-3, -1)
    c = F.col("c")
    f = ev.select("episode", "frame", "label", "c", F.sum(c).over(after).alias("sa"), F.count("*").over(after).alias("na"), F.count_if(c >= 1000).over(after).alias("ha"), F.sum(c).over(before).alias("sb"), F.count("*").over(before).alias("nb"))
    rises = F.expr("na >= 2 and c >= 1000 and sa >= 2200 * na and 100 * ha >= 67 * na and (nb = 0 or sb < 2200 * nb or sa * nb >= sb * na + 600 * na * nb)")
    first = F.min(F.when(rises & (F.col("frame") >= 1), F.col("frame"))).over(w.rowsBetween(-5, 5))  # frames follow each other, so rows are frames
    return f.withColumn("first", first).where("label = 'signup'").select("episode", F.col("frame").alias("nominal"), F.coalesce("first", "frame").alias("onset"), F.col("first").isNotNull().alias("found"))


@query("activity_transitions", f"""WITH {EVENTS}, a AS (SELECT *, c > {HIGH} AS active, lag(c) OVER (PARTITION BY episode ORDER BY frame) AS p FROM ev)
  SELECT episode, frame, active, 1 + abs(c - p) / 100.0::DOUBLE AS score FROM a WHERE p IS NOT NULL AND active <> (p > {HIGH})""")
def activity_transitions(spark, root):
    """WIN-23."""
    ev = events(spark, root).withColumn("p", F.lag("c").over(along())).withColumn("active", F.col("c") > HIGH)
    return ev.where(F.col("p").isNotNull() & (F.col("active") != (F.col("p") > HIGH))).select("episode", "frame", "active", (1 + F.abs(F.col("c") - F.col("p")) / 100).alias("score"))


@query("change_points", f"""WITH {EVENTS}, d AS (SELECT *, abs(c - lag(c) OVER (PARTITION BY episode ORDER BY frame)) AS m FROM ev), q AS (SELECT episode, greatest(quantile_cont(m, 0.65), 0.01) AS th FROM d WHERE m > 0 GROUP BY episode),
  e AS (SELECT d.episode, frame, m >= th AS on_, lag(m >= th) OVER (PARTITION BY d.episode ORDER BY frame) AS was, lead(m >= th) OVER (PARTITION BY d.episode ORDER BY frame) AS next FROM d JOIN q USING (episode) WHERE m IS NOT NULL)
  SELECT episode, frame - 1 AS frame, 'on' AS edge FROM e WHERE on_ AND coalesce(NOT was, true) UNION ALL SELECT episode, frame, 'off' FROM e WHERE on_ AND coalesce(NOT next, true)""")
def change_points(spark, root):
    """WIN-25: both edges of each run of changes above the 65th percentile of the positive ones."""
    w, whole = along(), Window.partitionBy("episode")
    d = events(spark, root).withColumn("m", F.abs(F.col("c") - F.lag("c").over(w))).where("m is not null")
    d = d.withColumn("th", F.greatest(F.percentile(F.when(F.col("m") > 0, F.col("m")), F.lit(0.65)).over(whole), F.lit(0.01))).where("th is not null")
    runs = islands(d, F.col("m") >= F.col("th"))
    edge = F.explode(F.array(F.struct((F.col("start_frame") - 1).alias("frame"), F.lit("on").alias("edge")), F.struct(F.col("end_frame").alias("frame"), F.lit("off").alias("edge"))))
    return runs.select("episode", edge.alias("e")).select("episode", "e.frame", "e.edge")


@query("interval_overlap_join", f"""WITH {EVENTS}, {RUNS}, hi AS (SELECT episode, min(frame) AS b_start, max(frame) + 1 AS b_stop FROM (SELECT *, frame - row_number() OVER (PARTITION BY episode ORDER BY frame) AS g FROM ev WHERE c >= {HIGH}) GROUP BY episode, g)
  SELECT ru.episode, CAST(run AS BIGINT) AS segment, b_start, b_stop, least(end_frame + 1, b_stop) - greatest(start_frame, b_start) AS shared FROM ru JOIN hi ON ru.episode = hi.episode AND start_frame < b_stop AND b_start <= end_frame""")
def interval_overlap_join(spark, root):
    """JOIN-09: segments and high islands that overlap."""
    ev = events(spark, root)
    runs = label_runs(ev, "label").select("episode", F.col("run").cast("long").alias("segment"), F.col("start_frame").alias("start"), (F.col("end_frame") + 1).alias("stop"))
    high = islands(ev, F.col("c") >= HIGH).select("episode", F.col("start_frame").alias("b_start"), (F.col("end_frame") + 1).alias("b_stop"))
    return interval_overlap(runs, high).select("episode", "segment", "b_start", "b_stop", (F.least("stop", "b_stop") - F.greatest("start", "b_start")).alias("shared"))


@query("interval_point_join", f"""WITH {EVENTS}, {RUNS}, {CLUSTERS}, m AS (SELECT episode, CAST(cluster AS BIGINT) AS cluster, (min(frame) + max(frame)) // 2 AS centre FROM cl GROUP BY episode, cluster)
  SELECT m.episode, cluster, centre, CAST(run AS BIGINT) AS segment, label FROM m JOIN ru ON m.episode = ru.episode AND centre BETWEEN start_frame AND end_frame""")
def interval_point_join(spark, root):
    """JOIN-07, JOIN-17: the segment that holds the centre frame; segments are disjoint, so it is an as-of join on their starts."""
    ev = events(spark, root)
    runs = label_runs(ev, "label")
    centre = gap_clusters(ev, "t", 1_800_000_000, "episode", "event_id").groupBy("episode", F.col("cluster").cast("long").alias("cluster")).agg(F.floor((F.min("frame") + F.max("frame")) / 2).alias("t"))
    found = asof(centre, runs.select("episode", F.col("start_frame").alias("t"), F.col("run").cast("long").alias("id")))
    return found.select("episode", "cluster", F.col("t").alias("centre"), F.col("before.id").alias("segment")).join(runs.select("episode", F.col("run").cast("long").alias("segment"), "label"), ["episode", "segment"])


@query("nearest_snap", f"""WITH {EVENTS}, {RUNS}, a AS (SELECT episode, frame, event_id FROM ev WHERE label = 'signup'), b AS (SELECT episode, start_frame AS cut FROM ru)
  SELECT a.episode, event_id, frame, arg_min(cut, (abs(cut - frame), cut)) AS snapped, min(abs(cut - frame)) AS offset_frames FROM a JOIN b ON a.episode = b.episode GROUP BY ALL""")
def nearest_snap(spark, root):
    """JOIN-14: each annotation at the nearest boundary, of equals the first."""
    ev = events(spark, root)
    marks = ev.where("label = 'signup'").select("episode", F.col("frame").alias("t"), "event_id")
    cuts = label_runs(ev, "label").select("episode", F.col("start_frame").alias("t"), F.col("run").cast("long").alias("id"))
    return nearest(asof(marks, cuts)).select("episode", "event_id", F.col("t").alias("frame"), F.col("near.t").alias("snapped"), F.abs(F.col("near.t") - F.col("t")).alias("offset_frames"))


@query("successor_actions", f"WITH {EVENTS}, n AS (SELECT *, lead(c) OVER (PARTITION BY episode ORDER BY frame) AS action FROM ev) SELECT episode, frame, c AS state, action FROM n WHERE action IS NOT NULL")
def successor_actions(spark, root):
    """WIN-20, PRJ-13: the next measurement as action; the last one has none and goes."""
    return events(spark, root).select("episode", "frame", F.col("c").alias("state"), F.lead("c").over(along()).alias("action")).where("action is not null")


@query("sequence_continuity", f"""WITH {EVENTS}, s AS (SELECT *, (event_id * 40000000) % 4294967296 AS seq FROM ev), d AS (SELECT *, lag(seq) OVER (PARTITION BY episode ORDER BY frame) AS p FROM s)
  SELECT episode, count(*) AS breaks, count(*) FILTER (WHERE seq < p) AS wraps FROM d WHERE p IS NOT NULL AND ((seq - p) % 4294967296 + 4294967296) % 4294967296 <> 40000000 GROUP BY episode""")
def sequence_continuity(spark, root):
    """FLT-02: steps of a 32-bit counter that are not the expected one, across its wrap."""
    seq = (F.col("event_id") * 40000000) % 4294967296
    d = events(spark, root).withColumn("seq", seq).withColumn("p", F.lag("seq").over(along()))
    return d.where(F.pmod(F.col("seq") - F.col("p"), F.lit(4294967296)) != 40000000).groupBy("episode").agg(F.count("*").alias("breaks"), F.count_if(F.col("seq") < F.col("p")).alias("wraps"))


@query("json_props_extract", "SELECT user_id AS episode, count(*) AS n, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS total, max(CAST(json_extract(props, '$.k') AS BIGINT)) AS largest FROM events GROUP BY user_id")
def json_props_extract(spark, root):
    """STR-09 on well-formed text."""
    from segloom.sources.tables import table

    k = F.get_json_object("props", "$.k").cast("long")
    return table(spark, root, "events").groupBy(F.col("user_id").alias("episode")).agg(F.count("*").alias("n"), F.sum(k).alias("total"), F.max(k).alias("largest"))


@query("row_digest", "SELECT event_id, sha256('{\"event_id\":' || event_id || ',\"event_type\":\"' || event_type || '\",\"user_id\":' || user_id || '}') AS digest FROM events")
def row_digest(spark, root):
    """STR-10: SHA-256 of JSON with sorted keys and no blanks."""
    from segloom.sources.tables import table

    return table(spark, root, "events").select("event_id", F.sha2(F.to_json(F.struct("event_id", "event_type", "user_id")), 256).alias("digest"))


@query("latest_status", f"WITH {EVENTS} SELECT episode, arg_max(label, (t, event_id)) AS status, max(t) AS updated, count(*) AS changes FROM ev GROUP BY episode")
def latest_status(spark, root):
    """STM-03, ROW-21: the last write for each key wins."""
    return events(spark, root).groupBy("episode").agg(F.max_by("label", F.struct("t", "event_id")).alias("status"), F.max("t").alias("updated"), F.count("*").alias("changes"))


@query("ordered_prefix_commit", f"WITH {EVENTS}, f AS (SELECT episode, min(frame) FILTER (WHERE label = 'error') AS stop FROM ev GROUP BY episode) SELECT ev.episode, count(*) AS committed, max(frame) AS last_frame FROM ev JOIN f USING (episode) WHERE stop IS NULL OR frame < stop GROUP BY ev.episode")
def ordered_prefix_commit(spark, root):
    """STM-04: frames before the first failure."""
    failed = F.min(F.when(F.col("label") == "error", F.col("frame"))).over(Window.partitionBy("episode"))
    return events(spark, root).withColumn("stop", failed).where("stop is null or frame < stop").groupBy("episode").agg(F.count("*").alias("committed"), F.max("frame").alias("last_frame"))


REASONS = "SELECT episode, frame // 10 AS part, label FROM ev WHERE c >= 1000"


@query("rejection_reason_counts_all", f"WITH {EVENTS}, r AS ({REASONS}) SELECT label AS reason, count(*) AS n FROM r GROUP BY label")
def rejection_reason_counts_all(spark, root):
    """AGG-05, every occurrence."""
    return events(spark, root).where("c >= 1000").groupBy(F.col("label").alias("reason")).agg(F.count("*").alias("n"))


@query("rejection_reason_counts_once", f"WITH {EVENTS}, r AS ({REASONS}) SELECT label AS reason, count(*) AS n FROM (SELECT DISTINCT episode, part, label FROM r) GROUP BY label")
def rejection_reason_counts_once(spark, root):
    """AGG-05, once for each unit."""
    rows = events(spark, root).where("c >= 1000").select("episode", F.floor(F.col("frame") / 10).alias("part"), "label").distinct()
    return rows.groupBy(F.col("label").alias("reason")).agg(F.count("*").alias("n"))


@query("history_list", f"""WITH {EVENTS}, {RUNS} SELECT episode, CAST(run AS BIGINT) AS segment, label, coalesce(list(label) OVER (PARTITION BY episode ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), []) AS history FROM ru""")
def history_list(spark, root):
    """WIN-19: all labels before, in order. Rows grow with their episode, as the lists are what is asked for."""
    w = Window.partitionBy("episode").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    return label_runs(events(spark, root), "label").select("episode", F.col("run").cast("long").alias("segment"), "label", F.collect_list("label").over(w).alias("history"))


