"""Queries over state vectors: kinematics, quaternions, targets, local statistics."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from segloom.functions.arrays import dot, log_delta, minus, norm, parts, quaternion_angle, round_even
from segloom.operators import kernels
from segloom.operators.segmentation import propose, segment_episode
from segloom.operators.windows import along, moving_sum, sign_continuity
from segloom.plans.registry import query
from segloom.plans.sequential import segment_sql
from segloom.sources.tables import VECTORS, vectors

VX = f"WITH {VECTORS}"
LAGGED = "lg AS (SELECT *, lag(x) OVER (PARTITION BY episode ORDER BY frame) AS p FROM vx)"
XYZ, QUAT, GRIP = (0, 1, 2), (3, 4, 5, 6), 7


def _dot(a, at, b=None, shift=1):
    b = b or a
    return " + ".join(f"{a}[{i + shift}] * {b}[{i + shift}]" for i in at)


def _norm(a, at):
    return f"sqrt(CAST({_dot(a, at)} AS DOUBLE))"


def lagged(spark, root):
    return vectors(spark, root).withColumn("p", F.lag("x").over(along()))


@query("arm_components", f"{VX} SELECT episode, frame, x[1:3] AS xyz, [x[7], x[4], x[5], x[6]] AS wxyz, x[8] AS grip, x[9:11] AS right_xyz FROM vx")
def arm_components(spark, root):
    """PRJ-01, PRJ-19: position, quaternion with the last component first, gripper, and the other arm's position."""
    q = parts("x", QUAT)
    return vectors(spark, root).select("episode", "frame", F.slice("x", 1, 3).alias("xyz"), F.array(q[3], q[0], q[1], q[2]).alias("wxyz"), F.get("x", F.lit(GRIP)).alias("grip"), F.slice("x", 9, 3).alias("right_xyz"))


@query("velocity", f"{VX}, {LAGGED} SELECT episode, frame, coalesce(x[1] - p[1], 0) AS vx, coalesce(x[2] - p[2], 0) AS vy, coalesce(x[3] - p[3], 0) AS vz, coalesce(round_even(sqrt(CAST((x[1]-p[1])*(x[1]-p[1]) + (x[2]-p[2])*(x[2]-p[2]) + (x[3]-p[3])*(x[3]-p[3]) AS DOUBLE)), 3), 0.0) AS speed FROM lg")
def velocity(spark, root):
    """PRJ-09: differences to the frame before; zero in frame 0."""
    d = minus(parts("x", XYZ), parts("p", XYZ))
    zero = [F.coalesce(c, F.lit(0)).alias(n) for c, n in zip(d, ("vx", "vy", "vz"), strict=True)]
    return lagged(spark, root).select("episode", "frame", *zero, F.coalesce(round_even(norm(d), 3), F.lit(0.0)).alias("speed"))


@query("quat_angle", f"{VX}, {LAGGED} SELECT episode, frame, round_even(2 * acos(least(abs({_dot('x', QUAT, 'p')}) / ({_norm('x', QUAT)} * {_norm('p', QUAT)}), 1.0)), 6) AS angle FROM lg WHERE p IS NOT NULL")
def quat_angle(spark, root):
    """PRJ-03, PRJ-04."""
    return lagged(spark, root).where("p is not null").select("episode", "frame", round_even(quaternion_angle(parts("x", QUAT), parts("p", QUAT)), 6).alias("angle"))


@query("quat_log_delta", f"""{VX}, {LAGGED}, m AS (SELECT episode, frame, {_dot('x', QUAT, 'p')} AS w,
   -x[4]*p[5] + x[5]*p[4] - x[6]*p[7] + x[7]*p[6] AS a, -x[4]*p[6] + x[5]*p[7] + x[6]*p[4] - x[7]*p[5] AS b, -x[4]*p[7] - x[5]*p[6] + x[6]*p[5] + x[7]*p[4] AS c FROM lg WHERE p IS NOT NULL),
  s AS (SELECT *, CASE WHEN w < 0 THEN -1 ELSE 1 END AS f, sqrt(CAST(a AS DOUBLE) * a + CAST(b AS DOUBLE) * b + CAST(c AS DOUBLE) * c) AS len FROM m)
  SELECT episode, frame, round_even(f * a * 2 * atan2(len, CAST(f * w AS DOUBLE)) / len, 6) AS rx, round_even(f * b * 2 * atan2(len, CAST(f * w AS DOUBLE)) / len, 6) AS ry, round_even(f * c * 2 * atan2(len, CAST(f * w AS DOUBLE)) / len, 6) AS rz FROM s""")
def quat_log_delta(spark, root):
    """PRJ-05."""
    as_double = lambda c: [v.cast("double") for v in parts(c, QUAT)]
    r = log_delta(as_double("p"), as_double("x"))
    return lagged(spark, root).where("p is not null").select("episode", "frame", *[round_even(c, 6).alias(n) for c, n in zip(r, ("rx", "ry", "rz"), strict=True)])


@query("quat_sign_continuity", f"""{VX}, {LAGGED}, d AS (SELECT episode, frame, x[4] AS w, coalesce({_dot('x', QUAT, 'p')}, 1) AS dp FROM lg), g AS (SELECT *, sum(CASE WHEN dp = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY episode ORDER BY frame) AS part FROM d)
  SELECT episode, frame, CAST(CASE WHEN sum(CASE WHEN dp < 0 THEN 1 ELSE 0 END) OVER (PARTITION BY episode, part ORDER BY frame) % 2 = 1 THEN -w ELSE w END AS BIGINT) AS w FROM g""")
def quat_sign_continuity(spark, root):
    """PRJ-06: flips compose, so the sign of a frame is the parity of the flips before it, from the last zero product on."""
    product = F.coalesce(dot(parts("x", QUAT), parts("p", QUAT)), F.lit(1))
    part, flip = sign_continuity(product)
    rows = lagged(spark, root).select("episode", "frame", F.get("x", F.lit(3)).alias("w"), part.alias("_z"), flip.alias("_flip"))
    rows = rows.withColumn("_part", F.sum("_z").over(along().rowsBetween(Window.unboundedPreceding, 0)))
    odd = F.sum("_flip").over(along(["episode", "_part"]).rowsBetween(Window.unboundedPreceding, 0)) % 2 == 1
    return rows.select("episode", "frame", F.when(odd, -F.col("w")).otherwise(F.col("w")).alias("w"))


LOCAL = "lo AS (SELECT episode, frame, first_value(x) OVER w AS a, last_value(x) OVER w AS z FROM vx WINDOW w AS (PARTITION BY episode ORDER BY frame ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING))"


def local(spark, root):
    w = along().rowsBetween(-2, 2)
    return vectors(spark, root).select("episode", "frame", F.first("x").over(w).alias("a"), F.last("x").over(w).alias("z"))


@query("local_motion_stats", f"""{VX}, {LOCAL}, d AS (SELECT episode, frame, z[1]-a[1] AS dx, z[2]-a[2] AS dy, z[3]-a[3] AS dz, z[8]-a[8] AS grip FROM lo)
  SELECT episode, frame, dz AS vertical, grip AS grip_trend, sqrt(CAST(dx*dx + dy*dy AS DOUBLE)) AS horizontal, sqrt(CAST(dx*dx + dy*dy + dz*dz AS DOUBLE)) AS translation FROM d""")
def local_motion_stats(spark, root):
    """WIN-04: displacement over two frames before to two after, cut off at the ends."""
    d = minus(parts("z", (*XYZ, GRIP)), parts("a", (*XYZ, GRIP)))
    return local(spark, root).select("episode", "frame", d[2].alias("vertical"), d[3].alias("grip_trend"), norm(d[:2]).alias("horizontal"), norm(d[:3]).alias("translation"))


@query("phase_labels", f"""{VX}, {LOCAL}, d AS (SELECT episode, frame, abs(z[3]-a[3]) AS v, z[3]-a[3] AS dz, (z[1]-a[1])*(z[1]-a[1]) + (z[2]-a[2])*(z[2]-a[2]) + (z[3]-a[3])*(z[3]-a[3]) AS t2, abs(z[8]-a[8]) AS r FROM lo)
  SELECT episode, CASE WHEN t2 < 10000000000 THEN 'still' WHEN v >= 50000 AND 10000 * v * v >= 3844 * t2 THEN CASE WHEN dz > 0 THEN 'lift' ELSE 'lower' END WHEN r * r > 4 * t2 THEN 'turn' ELSE 'move' END AS phase, count(*) AS frames FROM d GROUP BY 1, 2""")
def phase_labels(spark, root):
    """WIN-05: still, vertical, turn, move, in that order; thresholds in whole units, so that ties are exact."""
    d = minus(parts("z", XYZ), parts("a", XYZ))
    t2, r = dot(d, d), F.abs(F.get("z", F.lit(GRIP)) - F.get("a", F.lit(GRIP)))
    phase = F.when(t2 < 10_000_000_000, "still").when((F.abs(d[2]) >= 50_000) & (10_000 * d[2] * d[2] >= 3844 * t2), F.when(d[2] > 0, "lift").otherwise("lower")).when(r * r > 4 * t2, "turn").otherwise("move")
    return local(spark, root).groupBy("episode", phase.alias("phase")).agg(F.count("*").alias("frames"))


@query("direction_changes", f"""{VX}, v AS (SELECT episode, frame, x, lag(x, 3) OVER w AS a, lead(x, 3) OVER w AS z FROM vx WINDOW w AS (PARTITION BY episode ORDER BY frame)),
  d AS (SELECT episode, frame, (x[1]-a[1])*(z[1]-x[1]) + (x[2]-a[2])*(z[2]-x[2]) + (x[3]-a[3])*(z[3]-x[3]) AS d, (x[1]-a[1])*(x[1]-a[1]) + (x[2]-a[2])*(x[2]-a[2]) + (x[3]-a[3])*(x[3]-a[3]) AS n1, (z[1]-x[1])*(z[1]-x[1]) + (z[2]-x[2])*(z[2]-x[2]) + (z[3]-x[3])*(z[3]-x[3]) AS n2 FROM v WHERE a IS NOT NULL AND z IS NOT NULL)
  SELECT episode, frame, round_even(d / (sqrt(CAST(n1 AS DOUBLE)) * sqrt(CAST(n2 AS DOUBLE))), 6) AS cosine FROM d WHERE n1 >= 10000000000 AND n2 >= 10000000000 AND d / (sqrt(CAST(n1 AS DOUBLE)) * sqrt(CAST(n2 AS DOUBLE))) < 0.35""")
def direction_changes(spark, root):
    """WIN-24: mean velocity before and after, by the sums over three frames."""
    w = along()
    rows = vectors(spark, root).withColumn("a", F.lag("x", 3).over(w)).withColumn("z", F.lead("x", 3).over(w)).where("a is not null and z is not null")
    before, after = minus(parts("x", XYZ), parts("a", XYZ)), minus(parts("z", XYZ), parts("x", XYZ))
    rows = rows.select("episode", "frame", dot(before, after).alias("d"), dot(before, before).alias("n1"), dot(after, after).alias("n2")).where("n1 >= 10000000000 and n2 >= 10000000000")
    cosine = F.col("d") / (F.sqrt(F.col("n1").cast("double")) * F.sqrt(F.col("n2").cast("double")))
    return rows.withColumn("c", cosine).where("c < 0.35").select("episode", "frame", round_even(F.col("c"), 6).alias("cosine"))


@query("robust_velocity_scale", f"""{VX}, {LAGGED}, e AS (SELECT episode, unnest(range(16)) AS dim, unnest(list_transform(range(1, 17), lambda i: abs(x[i] - p[i]))) AS v FROM lg WHERE p IS NOT NULL), q AS (SELECT episode, dim, quantile_cont(v, 0.9) AS s FROM e GROUP BY ALL)
  SELECT episode, CAST(dim AS INTEGER) AS dim, round_even(s, 3) AS scale FROM q""")
def robust_velocity_scale(spark, root):
    """AGG-22."""
    step = F.transform(F.arrays_zip("x", "p"), lambda r: F.abs(r["x"] - r["p"]))
    rows = lagged(spark, root).where("p is not null").select("episode", F.posexplode(step).alias("dim", "v"))
    return rows.groupBy("episode", "dim").agg(round_even(F.percentile("v", F.lit(0.9)), 3).alias("scale"))


BLOCKS = "bl AS (SELECT *, frame // 10 AS segment FROM vx), sg AS (SELECT episode, segment, min(frame) AS start_frame, max(frame) AS end_frame, count(*) AS n FROM bl GROUP BY ALL)"


def blocks(spark, root):
    return vectors(spark, root).withColumn("segment", F.floor(F.col("frame") / 10))


@query("guide_action", f"""{VX}, {BLOCKS} SELECT sg.episode, sg.segment, n, list_transform(range(1, 17), lambda i: round_even((z.x[i] - a.x[i]) / 1000000.0::DOUBLE, 4)) AS guide FROM sg JOIN vx a ON a.episode = sg.episode AND a.frame = start_frame JOIN vx z ON z.episode = sg.episode AND z.frame = end_frame""")
def guide_action(spark, root):
    """PRJ-11: last state minus first, four decimals, half to even, in one aggregation."""
    ends = blocks(spark, root).groupBy("episode", "segment").agg(F.count("*").alias("n"), F.min_by("x", "frame").alias("a"), F.max_by("x", "frame").alias("z"))
    return ends.select("episode", "segment", "n", F.transform(F.arrays_zip("a", "z"), lambda r: round_even((r["z"] - r["a"]) / 1000000, 4)).alias("guide"))


@query("segment_motion_summary", f"""{VX}, {BLOCKS}, st AS (SELECT *, lag(x) OVER (PARTITION BY episode, segment ORDER BY frame) AS p FROM bl)
  SELECT episode, segment, round_even(sum(sqrt(CAST((x[1]-p[1])*(x[1]-p[1]) + (x[2]-p[2])*(x[2]-p[2]) + (x[3]-p[3])*(x[3]-p[3]) AS DOUBLE))), 2) AS path_length, arg_max(x[3], frame) - arg_min(x[3], frame) AS vertical, max(x[3]) - min(x[3]) AS vertical_range, arg_max(x[8], frame) - arg_min(x[8], frame) AS grip_delta, CAST(sum(x[8]) AS BIGINT) / count(*)::DOUBLE AS mean_grip FROM st GROUP BY episode, segment""")
def segment_motion_summary(spark, root):
    """AGG-01, PRJ-15: the step into a segment's first frame is not its own."""
    z, grip = F.get("x", F.lit(2)), F.get("x", F.lit(GRIP))
    rows = blocks(spark, root).withColumn("p", F.lag("x").over(along(["episode", "segment"])))
    ends = lambda c: F.max_by(c, "frame") - F.min_by(c, "frame")
    return rows.groupBy("episode", "segment").agg(round_even(F.sum(norm(minus(parts("x", XYZ), parts("p", XYZ)))), 2).alias("path_length"), ends(z).alias("vertical"), (F.max(z) - F.min(z)).alias("vertical_range"), ends(grip).alias("grip_delta"), (F.sum(grip) / F.count("*")).alias("mean_grip"))


@query("contradiction_candidates", f"""{VX}, {BLOCKS}, e AS (SELECT sg.episode, sg.segment, z.x[3] - a.x[3] AS v, z.x[8] - a.x[8] AS g, (z.x[1]-a.x[1])*(z.x[1]-a.x[1]) + (z.x[2]-a.x[2])*(z.x[2]-a.x[2]) AS h2, CASE WHEN sg.segment % 3 = 0 THEN 'still' WHEN sg.segment % 3 = 1 THEN 'lift' ELSE 'close' END AS label
    FROM sg JOIN vx a ON a.episode = sg.episode AND a.frame = start_frame JOIN vx z ON z.episode = sg.episode AND z.frame = end_frame),
  c AS (SELECT unnest([CASE WHEN label = 'still' AND h2 + v * v > 40000000000 THEN 'large_motion_under_still' END, CASE WHEN label = 'lift' AND v < -50000 THEN 'opposite_vertical' END, CASE WHEN label = 'close' AND g > 50000 THEN 'opposite_gripper' END]) AS code FROM e)
  SELECT code, count(*) AS n FROM c WHERE code IS NOT NULL GROUP BY code""")
def contradiction_candidates(spark, root):
    """FLT-27, SEG-15, PRJ-14: labels that the measured end points contradict."""
    ends = blocks(spark, root).groupBy("episode", "segment").agg(F.min_by("x", "frame").alias("a"), F.max_by("x", "frame").alias("z"))
    d = minus(parts("z", (*XYZ, GRIP)), parts("a", (*XYZ, GRIP)))
    label = F.element_at(F.array(F.lit("still"), F.lit("lift"), F.lit("close")), (F.col("segment") % 3 + 1).cast("int"))
    codes = F.array(F.when((label == "still") & (dot(d[:3], d[:3]) > 40_000_000_000), "large_motion_under_still"), F.when((label == "lift") & (d[2] < -50_000), "opposite_vertical"), F.when((label == "close") & (d[3] > 50_000), "opposite_gripper"))
    return ends.select(F.explode(F.filter(codes, lambda c: c.isNotNull())).alias("code")).groupBy("code").agg(F.count("*").alias("n"))


@query("smoothed_speed", f"""{VX}, {LAGGED}, s AS (SELECT episode, frame, coalesce(abs(x[1]-p[1]) + abs(x[2]-p[2]) + abs(x[3]-p[3]), 0) AS e FROM lg)
  SELECT episode, frame, CAST(sum(e) OVER (PARTITION BY episode ORDER BY frame ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS BIGINT) / 3.0::DOUBLE AS energy FROM s""")
def smoothed_speed(spark, root):
    """PRJ-09, WIN-02."""
    d = minus(parts("x", XYZ), parts("p", XYZ))
    rows = lagged(spark, root).select("episode", "frame", F.coalesce(F.abs(d[0]) + F.abs(d[1]) + F.abs(d[2]), F.lit(0)).alias("e"))
    return rows.select("episode", "frame", (moving_sum(F.col("e"), 3, along()) / 3).alias("energy"))


@query("matrix_validity", f"""{VX} SELECT episode, count(*) AS n, count(*) FILTER (WHERE abs(x[1]*x[4] + x[2]*x[5] + x[3]*x[6]) < 10000000000) AS orthogonal, count(*) FILTER (WHERE x[1]*x[1] + x[2]*x[2] + x[3]*x[3] > 0) AS nonzero FROM vx GROUP BY episode""")
def matrix_validity(spark, root):
    """PRJ-18: rows of a rotation matrix are orthogonal within a tolerance."""
    a, b = parts("x", (0, 1, 2)), parts("x", (3, 4, 5))
    return vectors(spark, root).groupBy("episode").agg(F.count("*").alias("n"), F.count_if(F.abs(dot(a, b)) < 10_000_000_000).alias("orthogonal"), F.count_if(dot(a, a) > 0).alias("nonzero"))


@query("named_state", f"""{VX} SELECT episode, frame, '{{' || '"x":' || CAST(x[1] AS VARCHAR) || ',"y":' || CAST(x[2] AS VARCHAR) || ',"z":' || CAST(x[3] AS VARCHAR) || ',"grip":' || CAST(x[8] AS VARCHAR) || '}}' AS state FROM vx""")
def named_state(spark, root):
    """PRJ-13: components by name, as compact JSON, in whole micro-units."""
    names = F.struct(*[F.get("x", F.lit(i)).alias(n) for i, n in ((0, "x"), (1, "y"), (2, "z"), (7, "grip"))])
    return vectors(spark, root).select("episode", "frame", F.to_json(names).alias("state"))


@query("numeric_gate", f"""{VX}, v AS (SELECT episode, unnest([CASE WHEN len(x) <> 16 THEN 'shape' END, CASE WHEN {_dot('x', QUAT)} = 0 THEN 'zero_quaternion' END, CASE WHEN abs({_dot('x', QUAT)} - 1000000000000) > 980000000000 THEN 'quaternion_norm' END, CASE WHEN x[8] NOT BETWEEN -200000 AND 200000 THEN 'gripper_range' END]) AS code FROM vx)
  SELECT episode, code, count(*) AS n FROM v WHERE code IS NOT NULL GROUP BY ALL""")
def numeric_gate(spark, root):
    """FLT-03, FLT-07, FLT-09: each rule a code, each code counted."""
    q = parts("x", QUAT)
    grip = F.get("x", F.lit(GRIP))
    codes = F.array(F.when(F.size("x") != 16, "shape"), F.when(dot(q, q) == 0, "zero_quaternion"), F.when(F.abs(dot(q, q) - 1_000_000_000_000) > 980_000_000_000, "quaternion_norm"), F.when(~grip.between(-200_000, 200_000), "gripper_range"))
    return vectors(spark, root).select("episode", F.explode(F.filter(codes, lambda c: c.isNotNull())).alias("code")).groupBy("episode", "code").agg(F.count("*").alias("n"))


def _episode(x):
    return np.array(x, float) / 1e6


@query("segment_episode_16d", segment_sql(VECTORS))
def segment_episode_16d(spark, root):
    """SEG-04, with SEG-02, SEG-03, SEG-05, WIN-13, WIN-15, WIN-17, JOIN-15 and ROW-17 inside: one kernel call an episode."""

    def kernel(_, x):
        found = segment_episode(_episode(x))
        return [(i, s["start"], s["end"], s["left"], s["right"], s["label"], s["relation"], len(s["members"])) for i, s in enumerate(found)]

    schema = "episode long, segment long, start_frame long, end_frame long, left_action string, right_action string, label string, relation string, pieces long"
    return kernels.per_episode(vectors(spark, root), kernel, schema, ["episode"], "frame", ["frame", "x"])


@query("recovery_proposals")
def recovery_proposals(spark, root):
    """SEG-09, SEG-10, WIN-23, WIN-24, WIN-25."""

    def kernel(frame, x):
        cuts = propose(_episode(x), 0.1 * np.array(frame, float), (7, 15))
        return [(i, a, b - 1) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]

    return kernels.per_episode(vectors(spark, root), kernel, "episode long, segment long, start_frame long, end_frame long", ["episode"], "frame", ["frame", "x"])
