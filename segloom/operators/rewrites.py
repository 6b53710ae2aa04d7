"""Rewriting of segment tables: merged segments, renumbering, history and targets. One exchange by episode serves a chain of these."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segloom.functions.arrays import minus, norm, parts, quaternion_angle
from segloom.functions.language import pair_verb, sub_task
from segloom.operators.windows import along

# Rows of a chunk, and the share of a segment's rows that a planning origin may lie behind its start.
CHUNK, ORIGIN = 8, 0.3


def chunks_of(n: Column) -> Column:
    return F.ceil(n / CHUNK).cast("long")


def regrouped(rows: DataFrame, group: Column, still: Column) -> DataFrame:
    """One row for each (episode, group) of segments: the ends of the group, its first state and last target, and the actions of its owner.

    rows: episode, segment, start_frame, end_frame, left, right, state, target. The owner is the first segment that is not still, else
    the first; `sources` lists the segments.
    """
    owner = lambda c: F.coalesce(F.min_by(c, F.when(~still, F.col("segment"))), F.min_by(c, "segment"))
    out = rows.groupBy("episode", group.alias("group")).agg(
        F.min("start_frame").alias("start_frame"), F.max("end_frame").alias("end_frame"), owner("segment").alias("owner"), owner("left").alias("left"), owner("right").alias("right"),
        F.min_by("state", "segment").alias("state"), F.max_by("target", "segment").alias("target"), F.sort_array(F.collect_list("segment")).alias("sources"),
    )
    return out.withColumn("segment", (F.row_number().over(along("episode", "start_frame")) - 1).cast("long")).drop("group")


def targeted(rows: DataFrame) -> DataFrame:
    """rows of regrouped() with verb, sub_task, valid, chunks, slots, padded, origin (the farthest one allowed) and guide (target less state)."""
    valid = F.col("end_frame") - F.col("start_frame") + 1
    return rows.withColumns({
        "verb": pair_verb(F.col("left"), F.col("right")), "sub_task": sub_task(F.col("left"), F.col("right")), "valid": valid, "chunks": chunks_of(valid), "slots": chunks_of(valid) * CHUNK, "padded": chunks_of(valid) * CHUNK - valid,
        "origin": F.least(F.greatest(F.lit(0), valid - 1), F.floor(valid * 3 / 10)).cast("long"), "guide": F.zip_with("target", "state", lambda z, a: z - a),
    })


def with_history(rows: DataFrame) -> DataFrame:
    """rows with what was planned and executed before each: previous_verb, previous_frame, previous_state, delta, executed (rows), executed_chunks,
    executed_slots, executed_padding, images (three, or six with the boundary before) and sample_type."""
    w = along("episode", "segment")
    before = {f"previous_{c}": F.lag(v).over(w) for c, v in (("verb", "verb"), ("frame", "start_frame"), ("state", "state"))}
    rows = rows.withColumns(before)
    executed = F.coalesce(F.col("start_frame") - F.col("previous_frame"), F.lit(0))
    first = F.col("previous_frame").isNull()
    return rows.withColumns({
        "delta": F.zip_with("state", "previous_state", lambda z, a: z - a), "executed": executed, "executed_chunks": chunks_of(executed), "executed_slots": chunks_of(executed) * CHUNK, "executed_padding": chunks_of(executed) * CHUNK - executed,
        "images": F.when(first, 3).otherwise(6), "sample_type": F.when(first, "initial_boundary").otherwise("subtask_transition"),
    })


def arm_metrics(state: str, target: str, at: int) -> dict[str, Column]:
    """Translation, vertical, horizontal, rotation and gripper change of the arm whose components begin at `at`; in units of the state."""
    d = minus(parts(target, range(at, at + 3)), parts(state, range(at, at + 3)))
    return {"translation": norm(d), "horizontal": norm(d[:2]), "vertical": d[2], "rotation": quaternion_angle(parts(state, range(at + 3, at + 7)), parts(target, range(at + 3, at + 7))), "grip": F.get(target, F.lit(at + 7)) - F.get(state, F.lit(at + 7))}


# Motion that a still label contradicts, and drifts that contradict the label of a direction; metres, radians, apertures.
LARGE, AGAINST = {"translation": 0.02, "rotation": 0.15, "grip": 0.20}, {"vertical": 0.02, "grip": 0.05}


def pose_action(m: dict[str, Column], unit: float = 1.0) -> Column:
    """Action by the change of a pose; lengths and grippers are multiples of 1 / unit."""
    up = F.abs(m["vertical"])
    tall = (up > F.greatest(F.lit(0.015 * unit), 0.60 * m["translation"])) & (up > m["horizontal"])
    turning = m["rotation"] / 0.10 > 4.5 * F.greatest(m["translation"] / unit / 0.08, F.lit(1e-6))
    return F.when(m["grip"] <= -LARGE["grip"] * unit, "close_gripper").when(m["grip"] >= LARGE["grip"] * unit, "open_gripper").when(tall, F.when(m["vertical"] > 0, "lift").otherwise("lower")).when(turning, "turn").otherwise("move")


def corrected(action: Column, m: dict[str, Column], confirmed: Column, unit: float = 1.0) -> Column:
    """An action after corrections: a confirmed one as it is, else what the change of pose plainly contradicts."""
    large = (m["translation"] >= LARGE["translation"] * unit) | (m["rotation"] >= LARGE["rotation"]) | (F.abs(m["grip"]) >= LARGE["grip"] * unit)
    wrong = ((action == "still") & large) | ((action == "lift") & (m["vertical"] < -AGAINST["vertical"] * unit)) | ((action == "lower") & (m["vertical"] > AGAINST["vertical"] * unit))
    return (
        F.when(confirmed.isNotNull(), confirmed)
        .when(wrong, pose_action(m, unit))
        .when((action == "open_gripper") & (m["grip"] < -AGAINST["grip"] * unit), "close_gripper")
        .when((action == "close_gripper") & (m["grip"] > AGAINST["grip"] * unit), "open_gripper")
        .otherwise(action)
    )


def named_candidates(action: Column, m: dict[str, Column], unit: float = 1.0) -> Column:
    """Names of the thresholds that a segment's end points cross against its action, for review."""
    t, v, g, r = m["translation"] / unit, m["vertical"] / unit, m["grip"] / unit, m["rotation"]
    # Names and thresholds of candidates at end points.
    rules = {
        "still_translation_ge_10mm": (action == "still") & (t >= 0.01),
        "still_translation_ge_20mm": (action == "still") & (t >= 0.02),
        "still_rotation_ge_0_05rad": (action == "still") & (r >= 0.05),
        "still_gripper_change_ge_0_20": (action == "still") & (F.abs(g) >= 0.20),
        "lift_endpoint_down_ge_5mm": (action == "lift") & (v <= -0.005),
        "lower_endpoint_up_ge_5mm": (action == "lower") & (v >= 0.005),
        "open_gripper_wrong_or_tiny_delta": (action == "open_gripper") & (g <= 0.05),
        "close_gripper_wrong_or_tiny_delta": (action == "close_gripper") & (g >= -0.05),
        "turn_endpoint_rotation_lt_0_02rad": (action == "turn") & (r < 0.02),
        "move_endpoint_pose_change_tiny": (action == "move") & (t < 0.003) & (r < 0.02),
    }
    return F.filter(F.array(*[F.when(c, n) for n, c in rules.items()]), lambda x: x.isNotNull())


def prompt(task: Column, state: Column, previous_state: Column, previous: Column, delta: Column, execution: Column, images: Column, mode: Column) -> Column:
    """The user's side of a planning row: image marks and lines; history lines stand only where there is a boundary before."""
    first = previous_state.isNull()
    lines = [
        F.concat(F.lit("Task: "), F.trim(task)),
        F.when(mode == "multi", "Task arm mode: multi-arm; both arms may participate or hand off as required by the task."),
        F.when(first, "Images: current head, current left wrist, current right wrist.").otherwise("Images: previous-boundary head, previous-boundary left wrist, previous-boundary right wrist, current head, current left wrist, current right wrist."),
        F.when(first, "History boundary: none; this is the initial planning boundary."),
        F.when(~first, F.concat(F.lit("Previous command: "), previous)),
        F.when(~first, F.concat(F.lit("Previous execution: "), execution)),
        F.when(~first, F.concat(F.lit("Previous boundary state: "), previous_state)),
        F.concat(F.lit("Current state: "), state),
        F.when(~first, F.concat(F.lit("Observed state delta since previous boundary: "), delta)),
    ]
    return F.concat(F.repeat(F.lit("<image>"), images), F.concat_ws("\n", *lines))


def facts(user: DataFrame) -> DataFrame:
    """(keys, line, key, arm, aperture, label) of the states that lines of a prompt show.

    user: any keys and `user`, the prompt. line counts from 1; key is current.state or previous.state; label says whether an aperture is
    closed (0.05 or less), open (0.95 or more) or between.
    """
    keys = [c for c in user.columns if c != "user"]
    lines = user.select(*keys, F.posexplode(F.split("user", "\n")).alias("line", "text"))
    heads = {"current.state": "Current state: ", "previous.state": "Previous boundary state: "}
    key = F.when(F.col("text").startswith(heads["current.state"]), "current.state").when(F.col("text").startswith(heads["previous.state"]), "previous.state")
    shown = lines.withColumn("key", key).where("key is not null")
    body = F.regexp_replace("text", "^[A-Z][a-z ]+: ", "")
    arms = F.array(*[F.struct(F.lit(a).alias("arm"), F.get_json_object(body, f"$.{a}.gripper").cast("double").alias("aperture")) for a in ("left", "right")])
    rows = shown.select(*keys, (F.col("line") + 1).alias("line"), "key", F.explode(arms).alias("s")).select(*keys, "line", "key", "s.*")
    return rows.withColumn("label", F.when(F.col("aperture") <= 0.05, "closed").when(F.col("aperture") >= 0.95, "open").otherwise("partially_open"))


def round_trip(source: DataFrame, exported: DataFrame) -> DataFrame:
    """(code, n): frames and targets of exported segments against the source, as multisets.

    source: episode, frame, state, action. exported: episode, segment, start_frame, end_frame, guide, chunks, actions (arrays in frame order).
    """
    back = exported.select("episode", F.posexplode("actions").alias("i", "action"), "start_frame").select("episode", (F.col("start_frame") + F.col("i")).alias("frame"), "action")
    have = source.select("episode", "frame", "action")
    lost, extra = (a.exceptAll(b).agg(F.count("*").alias("n")).select(F.lit(c).alias("code"), "n") for a, b, c in ((have, back, "missing_frames"), (back, have, "unexpected_frames")))
    ends = exported.join(source.select("episode", F.col("frame").alias("start_frame"), F.col("state").alias("_a")), ["episode", "start_frame"], "left").join(source.select("episode", F.col("frame").alias("end_frame"), F.col("action").alias("_z")), ["episode", "end_frame"], "left")
    guide = ~F.col("guide").eqNullSafe(F.zip_with("_z", "_a", lambda z, a: z - a))
    before = F.lag("end_frame").over(Window.partitionBy("episode").orderBy("segment"))
    checked = ends.withColumn("_gap", F.col("start_frame") != F.coalesce(before + 1, F.lit(0)))
    sums = checked.agg(F.count_if(guide).alias("a"), F.count_if(F.col("chunks") != chunks_of(F.size("actions"))).alias("b"), F.count_if("_gap").alias("c"))
    rows = sums.select(F.explode(F.create_map(F.lit("guide_differs"), "a", F.lit("chunks_differ"), "b", F.lit("gaps"), "c")).alias("code", "n"))
    return lost.unionByName(extra).unionByName(rows)
