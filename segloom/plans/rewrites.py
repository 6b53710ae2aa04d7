"""Queries that rewrite segment tables into training rows, and audits of what they wrote."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from segloom.functions import language
from segloom.functions.arrays import round_even
from segloom.operators import ingest as adapters
from segloom.operators import rewrites
from segloom.operators.windows import absorb_still, along, block_numbers, label_runs
from segloom.plans import sequential
from segloom.plans.ingest import FULL, MANIFEST_SQL, ROLE_SQL, VERB_SQL, audits, full_episodes, recovery_manifest_rows
from segloom.plans.registry import query
from segloom.plans.states import QUAT, _dot, _norm
from segloom.plans.timelines import _grouped
from segloom.sources.tables import EVENTS, TIMELINE, VECTORS, table, timeline, vectors

TL, EV, VX = f"WITH {TIMELINE}", f"WITH {EVENTS}", f"WITH {VECTORS}"
UNIT = 1_000_000  # states are in millionths


def _case(column, mapping):
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def clause_sql(left, right):
    a, b = (_case(c, {k: v.format(arm=arm) for k, v in language.CLAUSES.items()}) for c, arm in ((left, "left"), (right, "right")))
    return f"CASE WHEN {left} = 'still' AND {right} = 'still' THEN '{language.BOTH_STILL}' WHEN {left} = 'still' THEN {b} || ' while keeping the left arm stationary' WHEN {right} = 'still' THEN {a} || ' while keeping the right arm stationary' ELSE {a} || ' and ' || {b} END"


def task_sql(left, right):
    c = clause_sql(left, right)
    return f"(upper(left({c}, 1)) || substr({c}, 2) || '.')"


def closing_sql(left, right, chunks):
    return f"('Therefore, the next action should be: ' || {clause_sql(left, right)} || ', executed for ' || {chunks} || CASE WHEN {chunks} = 1 THEN ' action chunk (' ELSE ' action chunks (' END || 'left:' || {left} || ', right:' || {right} || ').')"


def number_sql(x):
    n = f"CAST(round_even({x} / 100.0::DOUBLE, 0) AS BIGINT)"
    tail = f"regexp_replace(lpad(CAST(abs({n}) % 10000 AS VARCHAR), 4, '0'), '0+$', '')"
    return f"(CASE WHEN {n} < 0 THEN '-' ELSE '' END || abs({n}) // 10000 || '.' || CASE WHEN {tail} = '' THEN '0' ELSE {tail} END)"


def state_sql(x, prefix=""):
    arm = lambda name, at: f"""'"{name}": {{"{prefix}xyz": [' || array_to_string(list_transform({x}[{at + 1}:{at + 3}], lambda v: {number_sql('v')}), ', ') || '], "{prefix}quat_wxyz": [' || array_to_string(list_transform({x}[{at + 4}:{at + 7}], lambda v: {number_sql('v')}), ', ') || '], "{prefix}gripper": ' || {number_sql(f'{x}[{at + 8}]')} || '}}'"""
    return f"('{{' || {arm('left', 0)} || ', ' || {arm('right', 8)} || '}}')"


#: Four frames to a segment, labelled by what two components do; the target is the state in which the next segment begins.
STEPS = f"""{VECTORS}, se AS (SELECT episode, frame // 4 AS segment, min(frame) AS start_frame, max(frame) AS end_frame, arg_min(x, frame) AS a, arg_max(x, frame) AS z FROM vx GROUP BY ALL),
 st AS (SELECT episode, segment, start_frame, end_frame, a AS state, coalesce(lead(a) OVER (PARTITION BY episode ORDER BY segment), z) AS target, CASE WHEN abs(z[3] - a[3]) < 60000 THEN 'still' WHEN z[3] > a[3] THEN 'lift' ELSE 'lower' END AS l,
   CASE WHEN abs(z[11] - a[11]) < 60000 THEN 'still' WHEN z[16] > a[16] THEN 'open_gripper' ELSE 'close_gripper' END AS r FROM se)"""


def steps(spark, root):
    ends = vectors(spark, root).groupBy("episode", F.floor(F.col("frame") / 4).alias("segment")).agg(F.min("frame").alias("start_frame"), F.max("frame").alias("end_frame"), F.min_by("x", "frame").alias("state"), F.max_by("x", "frame").alias("z"))
    change = lambda i: F.get("z", F.lit(i)) - F.get("state", F.lit(i))
    left = F.when(F.abs(change(2)) < 60_000, "still").when(change(2) > 0, "lift").otherwise("lower")
    right = F.when(F.abs(change(10)) < 60_000, "still").when(change(15) > 0, "open_gripper").otherwise("close_gripper")
    target = F.coalesce(F.lead("state").over(along("episode", "segment")), F.col("z"))
    return ends.select("episode", "segment", "start_frame", "end_frame", "state", target.alias("target"), left.alias("left"), right.alias("right"))


#: Still segments in their neighbours, as absorb_still() does it.
GROUPED = """sq AS (SELECT *, l = 'still' AND r = 'still' AS still, sum(CASE WHEN l = 'still' AND r = 'still' THEN 0 ELSE 1 END) OVER (PARTITION BY episode ORDER BY segment) AS seen FROM st), sr AS (SELECT *, max(seen) OVER (PARTITION BY episode) AS all_ FROM sq),
 sx AS (SELECT *, sum(CASE WHEN still AND seen = all_ THEN end_frame - start_frame + 1 ELSE 0 END) OVER (PARTITION BY episode) AS tail FROM sr), sy AS (SELECT *, CASE WHEN still AND seen = all_ AND (tail >= 8 OR all_ = 0) THEN CASE WHEN all_ = 0 THEN 0 ELSE all_ + 1 END ELSE greatest(seen, 1) END AS grp FROM sx),
 sg AS (SELECT episode, grp, min(start_frame) AS start_frame, max(end_frame) AS end_frame, coalesce(min(segment) FILTER (WHERE NOT still), min(segment)) AS owner, coalesce(arg_min(l, segment) FILTER (WHERE NOT still), arg_min(l, segment)) AS l, coalesce(arg_min(r, segment) FILTER (WHERE NOT still), arg_min(r, segment)) AS r,
   arg_min(state, segment) AS state, arg_max(target, segment) AS target, list(segment ORDER BY segment) AS sources FROM sy GROUP BY episode, grp), sn AS (SELECT *, row_number() OVER (PARTITION BY episode ORDER BY start_frame) - 1 AS segment, end_frame - start_frame + 1 AS valid, (end_frame - start_frame + 8) // 8 AS chunks FROM sg)"""


def regrouped_steps(spark, root):
    still = (F.col("left") == "still") & (F.col("right") == "still")
    rows = absorb_still(steps(spark, root).withColumn("n", F.col("end_frame") - F.col("start_frame") + 1), still, 8)
    return rewrites.with_history(rewrites.targeted(rewrites.regrouped(rows, F.col("group"), still)))


@query("still_rewrite", f"""WITH {STEPS}, {GROUPED} SELECT episode, segment, owner, sources, start_frame, end_frame, 'left:' || l || ', right:' || r AS verb, {task_sql('l', 'r')} AS sub_task, valid, chunks, chunks * 8 AS slots, chunks * 8 - valid AS padded, least(greatest(0, valid - 1), valid * 3 // 10) AS origin,
  list_transform(range(1, 17), lambda i: target[i] - state[i]) AS guide, lag(start_frame) OVER w AS previous_frame, lag('left:' || l || ', right:' || r) OVER w AS previous_verb, coalesce(start_frame - lag(start_frame) OVER w, 0) AS executed, CAST(ceil(coalesce(start_frame - lag(start_frame) OVER w, 0) / 8.0) AS BIGINT) AS executed_chunks,
  CASE WHEN segment = 0 THEN 3 ELSE 6 END AS images, CASE WHEN segment = 0 THEN 'initial_boundary' ELSE 'subtask_transition' END AS sample_type, row_number() OVER (ORDER BY episode, segment) - 1 AS block FROM sn WINDOW w AS (PARTITION BY episode ORDER BY segment)""")
def still_rewrite(spark, root):
    """ROW-03, SEG-05, WIN-18: segments without still ones, renumbered, with new targets, chunks and history."""
    rows = block_numbers(regrouped_steps(spark, root), "episode", ["segment"])
    return rows.select("episode", "segment", "owner", "sources", "start_frame", "end_frame", "verb", "sub_task", "valid", "chunks", "slots", "padded", "origin", "guide", "previous_frame", "previous_verb", "executed", "executed_chunks", "images", "sample_type", "block")


@query("still_rewrite_mapping", f"""WITH {STEPS}, {GROUPED}, m AS (SELECT episode, segment AS new_segment, owner, start_frame AS new_start, end_frame AS new_end, unnest(sources) AS old_segment FROM sn)
  SELECT m.*, CASE WHEN old_segment = owner THEN 'owner' WHEN old_segment < owner THEN 'pre_context' WHEN l = 'still' AND r = 'still' THEN 'post_settle' ELSE 'merged' END AS role FROM m JOIN st ON st.episode = m.episode AND st.segment = old_segment""")
def still_rewrite_mapping(spark, root):
    """ROW-03: where each source segment went, and in what role."""
    new = regrouped_steps(spark, root).select("episode", F.col("segment").alias("new_segment"), "owner", F.col("start_frame").alias("new_start"), F.col("end_frame").alias("new_end"), F.explode("sources").alias("old_segment"))
    old = steps(spark, root).select("episode", F.col("segment").alias("old_segment"), ((F.col("left") == "still") & (F.col("right") == "still")).alias("still"))
    role = F.when(F.col("old_segment") == F.col("owner"), "owner").when(F.col("old_segment") < F.col("owner"), "pre_context").when(F.col("still"), "post_settle").otherwise("merged")
    return new.join(old, ["episode", "old_segment"]).select("episode", "new_segment", "owner", "new_start", "new_end", "old_segment", role.alias("role"))


METRICS = f"""me AS (SELECT *, {', '.join(f'''sqrt(CAST((target[{a + 1}] - state[{a + 1}]) * (target[{a + 1}] - state[{a + 1}]) + (target[{a + 2}] - state[{a + 2}]) * (target[{a + 2}] - state[{a + 2}]) + (target[{a + 3}] - state[{a + 3}]) * (target[{a + 3}] - state[{a + 3}]) AS DOUBLE)) AS t{n},
   sqrt(CAST((target[{a + 1}] - state[{a + 1}]) * (target[{a + 1}] - state[{a + 1}]) + (target[{a + 2}] - state[{a + 2}]) * (target[{a + 2}] - state[{a + 2}]) AS DOUBLE)) AS h{n}, target[{a + 3}] - state[{a + 3}] AS v{n}, target[{a + 8}] - state[{a + 8}] AS g{n},
   2 * acos(least(abs({_dot('state', [i + a for i in QUAT], 'target')}) / ({_norm('state', [i + a for i in QUAT])} * {_norm('target', [i + a for i in QUAT])}), 1.0)) AS q{n}''' for n, a in (('l', 0), ('r', 8)))} FROM st)"""


def _corrected_sql(action, n, confirmed):
    pose = f"CASE WHEN g{n} <= -200000 THEN 'close_gripper' WHEN g{n} >= 200000 THEN 'open_gripper' WHEN abs(v{n}) > greatest(15000.0::DOUBLE, 0.60::DOUBLE * t{n}) AND abs(v{n}) > h{n} THEN CASE WHEN v{n} > 0 THEN 'lift' ELSE 'lower' END WHEN q{n} / 0.10::DOUBLE > 4.5::DOUBLE * greatest(t{n} / 1000000.0::DOUBLE / 0.08::DOUBLE, 1e-6::DOUBLE) THEN 'turn' ELSE 'move' END"
    wrong = f"({action} = 'still' AND (t{n} >= 20000 OR q{n} >= 0.15 OR abs(g{n}) >= 200000)) OR ({action} = 'lift' AND v{n} < -20000) OR ({action} = 'lower' AND v{n} > 20000)"
    return f"CASE WHEN {confirmed} THEN 'oscillate' WHEN {wrong} THEN {pose} WHEN {action} = 'open_gripper' AND g{n} < -50000 THEN 'close_gripper' WHEN {action} = 'close_gripper' AND g{n} > 50000 THEN 'open_gripper' ELSE {action} END"


def _measured(spark, root):
    return steps(spark, root), {arm: rewrites.arm_metrics("state", "target", at) for arm, at in (("left", 0), ("right", 8))}


@query("semantic_rewrite", f"""WITH {STEPS}, {METRICS}, co AS (SELECT episode, segment, l, r, {_corrected_sql('l', 'l', 'segment % 17 = 5')} AS l2, {_corrected_sql('r', 'r', 'false')} AS r2 FROM me)
  SELECT episode, segment, l2 AS "left", r2 AS "right", {task_sql('l2', 'r2')} AS sub_task, list_filter([CASE WHEN l2 <> l THEN 'left:' || l || '>' || l2 END, CASE WHEN r2 <> r THEN 'right:' || r || '>' || r2 END], lambda c: c IS NOT NULL) AS corrections FROM co""")
def semantic_rewrite(spark, root):
    """ROW-03, SEG-15, JOIN-13: labels that end points plainly contradict are corrected, confirmed corrections come first, and the
    subtask follows."""
    rows, m = _measured(spark, root)
    # Corrections that a reviewer confirmed, by (episode, segment, arm).
    confirmed = rows.where("segment % 17 = 5").select("episode", "segment", F.lit("oscillate").alias("confirmed"))
    rows = rows.join(confirmed, ["episode", "segment"], "left")
    new = {arm: rewrites.corrected(F.col(arm), m[arm], F.col("confirmed") if arm == "left" else F.lit(None).cast("string"), UNIT) for arm in m}
    rows = rows.select("episode", "segment", "left", "right", *[c.alias(f"new_{a}") for a, c in new.items()])
    changes = F.array(*[F.when(F.col(f"new_{a}") != F.col(a), F.concat(F.lit(f"{a}:"), a, F.lit(">"), f"new_{a}")) for a in new])
    return rows.select("episode", "segment", F.col("new_left").alias("left"), F.col("new_right").alias("right"), language.sub_task(F.col("new_left"), F.col("new_right")).alias("sub_task"), F.filter(changes, lambda c: c.isNotNull()).alias("corrections"))


def _candidates_sql(n, action):
    t, v, g, q = f"t{n} / 1000000.0::DOUBLE", f"v{n} / 1000000.0::DOUBLE", f"g{n} / 1000000.0::DOUBLE", f"q{n}"
    rules = {"still_translation_ge_10mm": f"{action} = 'still' AND {t} >= 0.01", "still_translation_ge_20mm": f"{action} = 'still' AND {t} >= 0.02", "still_rotation_ge_0_05rad": f"{action} = 'still' AND {q} >= 0.05", "still_gripper_change_ge_0_20": f"{action} = 'still' AND abs({g}) >= 0.20", "lift_endpoint_down_ge_5mm": f"{action} = 'lift' AND {v} <= -0.005", "lower_endpoint_up_ge_5mm": f"{action} = 'lower' AND {v} >= 0.005",
             "open_gripper_wrong_or_tiny_delta": f"{action} = 'open_gripper' AND {g} <= 0.05", "close_gripper_wrong_or_tiny_delta": f"{action} = 'close_gripper' AND {g} >= -0.05", "turn_endpoint_rotation_lt_0_02rad": f"{action} = 'turn' AND {q} < 0.02", "move_endpoint_pose_change_tiny": f"{action} = 'move' AND {t} < 0.003 AND {q} < 0.02"}
    return "[" + ", ".join(f"CASE WHEN {c} THEN '{k}' END" for k, c in rules.items()) + "]"


@query("endpoint_candidates", f"""WITH {STEPS}, {METRICS}, c AS (SELECT episode, segment, 'left' AS arm, unnest({_candidates_sql('l', 'l')}) AS name FROM me UNION ALL SELECT episode, segment, 'right', unnest({_candidates_sql('r', 'r')}) FROM me)
  SELECT name, count(*) AS n, list(episode * 1000000 + segment ORDER BY episode, segment, arm)[1:20] AS examples FROM c WHERE name IS NOT NULL GROUP BY name""")
def endpoint_candidates(spark, root):
    """FLT-27, PRJ-14, AGG-11: the ten thresholds at end points, with the first twenty segments of each."""
    rows, m = _measured(spark, root)
    each = F.array(*[F.struct(F.lit(arm).alias("arm"), rewrites.named_candidates(F.col(arm), m[arm], UNIT).alias("names")) for arm in m])
    found = rows.select("episode", "segment", F.explode(each).alias("e")).select("episode", "segment", "e.arm", F.explode("e.names").alias("name"))
    counts = found.groupBy("name").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("name").orderBy("episode", "segment", "arm"))
    few = found.withColumn("k", place).where("k <= 20").groupBy("name").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", (F.col("episode") * 1_000_000 + F.col("segment")).alias("id")))), lambda r: r["id"]).alias("examples"))
    return counts.join(few, "name")


TRAJECTORY = "ty AS (SELECT episode, frame // 4 AS segment, frame, x, lag(x) OVER (PARTITION BY episode, frame // 4 ORDER BY frame) AS p, first_value(x) OVER (PARTITION BY episode, frame // 4 ORDER BY frame) AS o FROM vx)"


def _xyz(a, b):
    return f"sqrt(CAST(({a}[1] - {b}[1]) * ({a}[1] - {b}[1]) + ({a}[2] - {b}[2]) * ({a}[2] - {b}[2]) + ({a}[3] - {b}[3]) * ({a}[3] - {b}[3]) AS DOUBLE))"


@query("trajectory_metrics", f"""{VX}, {TRAJECTORY} SELECT episode, segment, round_even(max({_xyz('x', 'o')}), 2) AS farthest, round_even(arg_max({_xyz('x', 'o')}, frame), 2) AS net, round_even(sum({_xyz('x', 'p')}), 2) AS path, round_even(sum(2 * acos(least(abs({_dot('x', QUAT, 'p')}) / ({_norm('x', QUAT)} * {_norm('p', QUAT)}), 1.0))), 6) AS rotation, max(x[3]) - min(x[3]) AS vertical_range, max(x[8]) - min(x[8]) AS grip_range FROM ty GROUP BY episode, segment""")
def trajectory_metrics(spark, root):
    """PRJ-15, JOIN-09: motion inside each segment: farthest and net way, path, rotation, and the ranges of height and gripper."""
    w = Window.partitionBy("episode", "segment").orderBy("frame")
    rows = vectors(spark, root).withColumn("segment", F.floor(F.col("frame") / 4)).withColumn("p", F.lag("x").over(w)).withColumn("o", F.first("x").over(w))
    step, way = rewrites.arm_metrics("p", "x", 0), rewrites.arm_metrics("o", "x", 0)
    z, grip = F.get("x", F.lit(2)), F.get("x", F.lit(7))
    return rows.groupBy("episode", "segment").agg(round_even(F.max(way["translation"]), 2).alias("farthest"), round_even(F.max_by(way["translation"], "frame"), 2).alias("net"), round_even(F.sum(step["translation"]), 2).alias("path"), round_even(F.sum(step["rotation"]), 6).alias("rotation"), (F.max(z) - F.min(z)).alias("vertical_range"), (F.max(grip) - F.min(grip)).alias("grip_range"))


@query("short_rewrite", f"""{sequential.SHORT_MERGE.replace("SELECT episode, CAST(i - 1 AS BIGINT) AS grp, g[i].pair AS pair, g[i].a AS start_frame, g[i].z AS end_frame, g[i].k AS pieces FROM u", "SELECT 1")[:-len("SELECT 1")].rstrip()}, v AS (SELECT episode, CAST(i - 1 AS BIGINT) AS segment, g[i].pair AS verb, g[i].a AS start_frame, g[i].z AS end_frame, g[i].k AS pieces, g[i].z - g[i].a + 1 AS valid FROM u)
  SELECT episode, segment, verb, start_frame, end_frame, pieces, valid, (valid + 7) // 8 AS chunks, (valid + 7) // 8 * 8 - valid AS padded, lag(verb) OVER w AS previous_verb, coalesce(start_frame - lag(start_frame) OVER w, 0) AS executed, row_number() OVER (ORDER BY episode, segment) - 1 AS block FROM v WINDOW w AS (PARTITION BY episode ORDER BY segment)""")
def short_rewrite(spark, root):
    """ROW-03, SEG-06: short equal neighbours merged, renumbered over all episodes, with new chunks and history."""
    from segloom.operators import kernels

    rows = _grouped(spark, root, kernels.merge_short).withColumnsRenamed({"grp": "segment", "pair": "verb"})
    valid, w = F.col("end_frame") - F.col("start_frame") + 1, along("episode", "segment")
    rows = rows.withColumns({"valid": valid, "chunks": rewrites.chunks_of(valid), "padded": rewrites.chunks_of(valid) * 8 - valid, "previous_verb": F.lag("verb").over(w), "executed": F.coalesce(F.col("start_frame") - F.lag("start_frame").over(w), F.lit(0))})
    return block_numbers(rows, "episode", ["segment"])


ACTIONS = "ac AS (SELECT episode, frame, x, lead(x) OVER (PARTITION BY episode ORDER BY frame) AS action FROM vx)"
PROMPT = f"""pr AS (SELECT episode, segment, start_frame, end_frame, l, r, valid, chunks, state, 'left:' || l || ', right:' || r AS verb, {task_sql('l', 'r')} AS sub_task, list_transform(range(1, 17), lambda i: target[i] - state[i]) AS guide, lag(state) OVER w AS before, coalesce(start_frame - lag(start_frame) OVER w, 0) AS executed FROM sn WINDOW w AS (PARTITION BY episode ORDER BY segment)),
 gj AS (SELECT *, '{{"guide_action": [' || array_to_string(list_transform(guide, lambda v: {number_sql('v')}), ', ') || '], "primary_action_verb": "' || verb || '", "sub_task": "' || sub_task || '", "num_chunks": ' || chunks || '}}' AS goal FROM pr),
 us AS (SELECT *, lag(goal) OVER (PARTITION BY episode ORDER BY segment) AS previous_goal FROM gj),
 ut AS (SELECT *, repeat('<image>', CASE WHEN before IS NULL THEN 3 ELSE 6 END) || concat_ws(chr(10), 'Task: label ' || episode, CASE WHEN episode % 2 = 0 THEN 'Task arm mode: multi-arm; both arms may participate or hand off as required by the task.' END,
   CASE WHEN before IS NULL THEN 'Images: current head, current left wrist, current right wrist.' ELSE 'Images: previous-boundary head, previous-boundary left wrist, previous-boundary right wrist, current head, current left wrist, current right wrist.' END, CASE WHEN before IS NULL THEN 'History boundary: none; this is the initial planning boundary.' END,
   'Previous command: ' || previous_goal, CASE WHEN before IS NOT NULL THEN 'Previous execution: {{"executed_chunks": ' || (executed + 7) // 8 || ', "valid_action_rows": ' || executed || ', "aligned_action_slots": ' || (executed + 7) // 8 * 8 || ', "padded_action_slots": ' || ((executed + 7) // 8 * 8 - executed) || '}}' END,
   CASE WHEN before IS NOT NULL THEN 'Previous boundary state: ' || {state_sql('before')} END, 'Current state: ' || {state_sql('state')}, CASE WHEN before IS NOT NULL THEN 'Observed state delta since previous boundary: ' || {state_sql('list_transform(range(1, 17), lambda i: state[i] - before[i])', 'delta_')} END) AS user_ FROM us)"""


def prompted(spark, root):
    """Rows of regrouped_steps() with the goal as JSON and the user's prompt."""
    rows = regrouped_steps(spark, root)
    goal = F.concat(F.lit('{"guide_action": '), language.numbers(F.col("guide")), F.lit(', "primary_action_verb": "'), "verb", F.lit('", "sub_task": "'), "sub_task", F.lit('", "num_chunks": '), F.col("chunks").cast("string"), F.lit("}"))
    rows = rows.withColumn("goal", goal).withColumn("previous_goal", F.lag("goal").over(along("episode", "segment")))
    whole = lambda c: F.col(c).cast("string")
    execution = F.concat(F.lit('{"executed_chunks": '), whole("executed_chunks"), F.lit(', "valid_action_rows": '), whole("executed"), F.lit(', "aligned_action_slots": '), whole("executed_slots"), F.lit(', "padded_action_slots": '), whole("executed_padding"), F.lit("}"))
    named = lambda c, prefix="": F.when(F.col(c).isNotNull(), language.named_state(F.col(c), prefix))
    task = F.concat(F.lit("label "), F.col("episode").cast("string"))
    user = rewrites.prompt(task, named("state"), named("previous_state"), F.col("previous_goal"), named("delta", "delta_"), execution, F.col("images"), F.when(F.col("episode") % 2 == 0, "multi").otherwise("single"))
    return rows.withColumn("user", user)


@query("planner_rows", f"WITH {STEPS}, {GROUPED}, {PROMPT} SELECT episode, segment, user_ AS \"user\", goal AS assistant, valid, chunks * 8 - valid AS padded FROM ut")
def planner_rows(spark, root):
    """ROW-02, ROW-04, STR-17, PRJ-13: one training row for each segment: the prompt with states as JSON to four places, and the goal."""
    return prompted(spark, root).select("episode", "segment", "user", F.col("goal").alias("assistant"), "valid", "padded")


@query("visible_payload", f"""WITH {STEPS}, {GROUPED}, {PROMPT}, ln AS (SELECT episode, segment, unnest(string_split(user_, chr(10))) AS t, generate_subscripts(string_split(user_, chr(10)), 1) AS line FROM ut), lk AS (SELECT *, CASE WHEN starts_with(t, 'Current state: ') THEN 'current.state' ELSE 'previous.state' END AS key, regexp_replace(t, '^[A-Z][a-z ]+: ', '') AS body FROM ln WHERE starts_with(t, 'Current state: ') OR starts_with(t, 'Previous boundary state: ')),
  la AS (SELECT *, unnest(['left', 'right']) AS arm FROM lk), lv AS (SELECT episode, segment, CAST(line AS INTEGER) AS line, key, arm, CAST(json_extract_string(body, '$.' || arm || '.gripper') AS DOUBLE) AS aperture FROM la) SELECT *, CASE WHEN aperture <= 0.05 THEN 'closed' WHEN aperture >= 0.95 THEN 'open' ELSE 'partially_open' END AS label FROM lv""")
def visible_payload(spark, root):
    """ROW-14, FLT-17: the states that a prompt shows, read back from its lines, with apertures named."""
    return rewrites.facts(prompted(spark, root).select("episode", "segment", "user"))


def _exported(spark, root):
    """Segments with guide, chunks and the actions of their frames; the last frame of an episode has no action."""
    frames = vectors(spark, root).withColumn("action", F.lead("x").over(along())).where("action is not null").withColumnRenamed("x", "state")
    ends = frames.groupBy("episode", F.floor(F.col("frame") / 4).alias("segment")).agg(F.min("frame").alias("start_frame"), F.max("frame").alias("end_frame"), F.min_by("state", "frame").alias("a"), F.max_by("action", "frame").alias("z"), F.sort_array(F.collect_list(F.struct("frame", "action"))).alias("rows"))
    rows = ends.select("episode", "segment", "start_frame", "end_frame", F.zip_with("z", "a", lambda z, a: z - a).alias("guide"), F.transform("rows", lambda r: r["action"]).alias("actions"))
    return frames, rows.withColumn("chunks", rewrites.chunks_of(F.size("actions")))


@query("pretrain_export", f"""{VX}, {ACTIONS}, ex AS (SELECT episode, frame // 4 AS segment, min(frame) AS start_frame, max(frame) AS end_frame, arg_min(x, frame) AS a, arg_max(action, frame) AS z, list(action ORDER BY frame) AS actions FROM ac WHERE action IS NOT NULL GROUP BY ALL)
  SELECT episode, segment, start_frame, end_frame, list_transform(range(1, 17), lambda i: z[i] - a[i]) AS guide, (len(actions) + 7) // 8 AS chunks, len(actions) AS valid, (len(actions) + 7) // 8 * 8 - len(actions) AS padding, actions FROM ex""")
def pretrain_export(spark, root):
    """ROW-04, ROW-01: segments with their action rows, and what chunks of eight would pad."""
    n = F.size("actions").cast("long")
    return _exported(spark, root)[1].select("episode", "segment", "start_frame", "end_frame", "guide", "chunks", n.alias("valid"), (rewrites.chunks_of(n) * 8 - n).alias("padding"), "actions")


@query("round_trip_rows", f"""{VX}, {ACTIONS}, ex AS (SELECT episode, frame // 4 AS segment, min(frame) AS start_frame, max(frame) AS end_frame, arg_min(x, frame) AS a, arg_max(action, frame) AS z, list(action ORDER BY frame) AS actions FROM ac WHERE action IS NOT NULL GROUP BY ALL),
  da AS (SELECT *, CASE WHEN segment % 5 = 3 THEN actions[1:len(actions) - 1] ELSE actions END AS kept, CASE WHEN segment % 7 = 2 THEN a ELSE list_transform(range(1, 17), lambda i: z[i] - a[i]) END AS guide, (len(actions) + 7) // 8 + CASE WHEN segment = 4 THEN 1 ELSE 0 END AS chunks, start_frame + CASE WHEN segment = 6 THEN 1 ELSE 0 END AS first FROM ex),
  ba AS (SELECT episode, first + i AS frame, kept[i + 1] AS action FROM (SELECT *, unnest(range(len(kept))) AS i FROM da)), ha AS (SELECT episode, frame, action FROM ac WHERE action IS NOT NULL),
  gu AS (SELECT da.*, list_transform(range(1, 17), lambda i: ez.action[i] - ea.x[i]) AS want, lag(da.end_frame) OVER (PARTITION BY da.episode ORDER BY da.segment) AS before FROM da LEFT JOIN ac ea ON ea.episode = da.episode AND ea.frame = da.first LEFT JOIN ac ez ON ez.episode = da.episode AND ez.frame = da.end_frame)
  SELECT 'missing_frames' AS code, count(*) AS n FROM (SELECT * FROM ha EXCEPT ALL SELECT * FROM ba) UNION ALL SELECT 'unexpected_frames', count(*) FROM (SELECT * FROM ba EXCEPT ALL SELECT * FROM ha) UNION ALL SELECT 'guide_differs', count(*) FILTER (WHERE guide IS DISTINCT FROM want) FROM gu
  UNION ALL SELECT 'chunks_differ', count(*) FILTER (WHERE chunks <> (len(kept) + 7) // 8) FROM gu UNION ALL SELECT 'gaps', count(*) FILTER (WHERE first <> coalesce(before + 1, 0)) FROM gu""")
def round_trip_rows(spark, root):
    """ROW-05: rows rebuilt from an export against the source; here the export is damaged in five ways, all of which must be counted."""
    frames, rows = _exported(spark, root)
    segment = F.col("segment")
    bad = rows.join(frames.select("episode", F.col("frame").alias("start_frame"), F.col("state").alias("a")), ["episode", "start_frame"]).withColumns({
        "actions": F.when(segment % 5 == 3, F.slice("actions", 1, F.size("actions") - 1)).otherwise(F.col("actions")), "guide": F.when(segment % 7 == 2, F.col("a")).otherwise(F.col("guide")),
        "chunks": F.col("chunks") + F.when(segment == 4, 1).otherwise(0), "start_frame": F.col("start_frame") + F.when(segment == 6, 1).otherwise(0),
    }).drop("a")
    return rewrites.round_trip(frames, bad)


COT_LABELS = """ct AS (SELECT episode, segment, start_frame, n, CASE "left" WHEN 'A' THEN 'open_gripper' WHEN 'N' THEN 'still' ELSE 'lift' END AS l, CASE "right" WHEN 'F' THEN 'move' ELSE 'still' END AS r, CAST(ceil(n / 8.0) AS BIGINT) AS chunks FROM tl),
 ch AS (SELECT *, coalesce(list('left:' || l || ', right:' || r) OVER (PARTITION BY episode ORDER BY segment ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), []) AS history, lag(start_frame) OVER (PARTITION BY episode ORDER BY segment) AS previous FROM ct)"""


def cot(spark, root):
    """Segments with actions, chunks, all actions done before, and the start of the segment before."""
    left = F.when(F.col("left") == "A", "open_gripper").when(F.col("left") == "N", "still").otherwise("lift")
    rows = timeline(spark, root).select("episode", "segment", "start_frame", "n", left.alias("l"), F.when(F.col("right") == "F", "move").otherwise("still").alias("r"), rewrites.chunks_of(F.col("n")).alias("chunks"))
    w = along("episode", "segment")
    return rows.withColumn("history", F.collect_list(language.pair_verb(F.col("l"), F.col("r"))).over(w.rowsBetween(Window.unboundedPreceding, -1))).withColumn("previous", F.lag("start_frame").over(w))


def _reasoning(task, history, command):
    done = F.when(F.size(history) == 0, "No atomic action has been completed yet.").otherwise(F.concat(F.size(history).cast("string"), F.lit(" atomic actions have already been completed, so the episode is at a later decision point.")))
    # The text of the offline reasoner.
    return F.concat(F.lit("The overall objective is "), F.regexp_replace(task, r"\.+$", ""), F.lit(". "), done, F.lit(" The current observation and robot state define the next pre-action decision. "), command, F.lit(" This statement describes the commanded motion only and does not claim contact, grasp, placement, or task success."))


REASON_SQL = f"""('The overall objective is order ' || episode || '. ' || CASE WHEN len(history) = 0 THEN 'No atomic action has been completed yet.' ELSE len(history) || ' atomic actions have already been completed, so the episode is at a later decision point.' END || ' The current observation and robot state define the next pre-action decision. ' || {task_sql('l', 'r')} || ' This statement describes the commanded motion only and does not claim contact, grasp, placement, or task success.')"""


@query("template_reasoning", f"{TL}, {COT_LABELS} SELECT episode, segment, {REASON_SQL} AS reasoning FROM ch")
def template_reasoning(spark, root):
    """UDF-01: the deterministic reasoner, as a column of a row's task, history and command."""
    task = F.concat(F.lit("order "), F.col("episode").cast("string"), F.lit("."))
    return cot(spark, root).select("episode", "segment", _reasoning(task, F.col("history"), language.sub_task(F.col("l"), F.col("r"))).alias("reasoning"))


@query("cot_rows", f"""{TL}, {COT_LABELS}, cr AS (SELECT *, CASE WHEN previous IS NULL THEN [] ELSE ['history_head', 'history_left', 'history_right'] END || ['current_head', 'current_left', 'current_right'] AS roles FROM ch)
  SELECT 'episode_' || lpad(CAST(episode AS VARCHAR), 6, '0') || '__segment_' || lpad(CAST(segment AS VARCHAR), 3, '0') AS sample_id, roles, history, concat_ws(chr(10), repeat('<image>', len(roles)), 'Task: order ' || episode, 'Current decision frame: ' || start_frame, 'Image roles: ' || array_to_string(roles, ', '), 'Completed action history: ' || CASE WHEN len(history) = 0 THEN 'none' ELSE '["' || array_to_string(history, '","') || '"]' END, 'Previous decision frame: ' || previous) AS human,
    '<think>' || chr(10) || {REASON_SQL} || ' ' || {closing_sql('l', 'r', 'chunks')} || chr(10) || '</think>' || chr(10) || chr(10) || '{{"num_chunks":' || chunks || ',"primary_action_verb":"left:' || l || ', right:' || r || '","sub_task":"' || {task_sql('l', 'r')} || '"}}' AS assistant FROM cr""")
def cot_rows(spark, root):
    """ROW-02, WIN-19, STR-07, STR-08: rows with all earlier actions, a prompt without the target, and a reply that ends in the closing
    sentence and the target as JSON."""
    rows = cot(spark, root)
    left, right, text = F.col("l"), F.col("r"), lambda c: F.col(c).cast("string")
    names = lambda when: F.array(*[F.lit(f"{when}_{c}") for c in ("head", "left", "right")])
    roles = F.when(F.col("previous").isNull(), names("current")).otherwise(F.concat(names("history"), names("current")))
    done = F.when(F.size("history") == 0, "none").otherwise(F.concat(F.lit('["'), F.array_join("history", '","'), F.lit('"]')))
    task = F.concat(F.lit("order "), text("episode"))
    human = F.concat_ws("\n", F.repeat(F.lit("<image>"), F.size(roles)), F.concat(F.lit("Task: "), task), F.concat(F.lit("Current decision frame: "), text("start_frame")), F.concat(F.lit("Image roles: "), F.array_join(roles, ", ")), F.concat(F.lit("Completed action history: "), done), F.concat(F.lit("Previous decision frame: "), text("previous")))
    goal = F.concat(F.lit('{"num_chunks":'), text("chunks"), F.lit(',"primary_action_verb":"'), language.pair_verb(left, right), F.lit('","sub_task":"'), language.sub_task(left, right), F.lit('"}'))
    reply = F.concat(F.lit("<think>\n"), _reasoning(task, F.col("history"), language.sub_task(left, right)), F.lit(" "), language.closing(left, right, F.col("chunks")), F.lit("\n</think>\n\n"), goal)
    sample = F.concat(F.lit("episode_"), F.lpad(text("episode"), 6, "0"), F.lit("__segment_"), F.lpad(text("segment"), 3, "0"))
    return rows.select(sample.alias("sample_id"), roles.alias("roles"), "history", human.alias("human"), reply.alias("assistant"))


# Recoveries

RUNS_SQL = f"""{EV}, {FULL}, ru AS (SELECT *, sum(turn) OVER (PARTITION BY episode ORDER BY frame) - 1 AS run FROM (SELECT *, CASE WHEN raw_phase = lag(raw_phase) OVER (PARTITION BY episode ORDER BY frame) THEN 0 ELSE 1 END AS turn FROM fu)),
 rs AS (SELECT episode, run, any_value(raw_phase) AS raw_phase, any_value(phase) AS phase, min(frame) AS start_frame, max(frame) AS end_frame, arg_min(state, frame) AS a, arg_max_null(action, frame) AS z, bool_and(action_is_supervised) AS supervised, bool_or(observation_only) AS watched FROM ru GROUP BY episode, run)"""


def phase_runs(spark, root):
    """Runs of one raw phase with their end frames, first state, last action and supervision."""
    w = along()
    rows = full_episodes(spark, root).withColumn("turn", F.when(F.col("raw_phase") == F.lag("raw_phase").over(w), 0).otherwise(1))
    rows = rows.withColumn("run", F.sum("turn").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    return rows.groupBy("episode", "run").agg(F.first("raw_phase").alias("raw_phase"), F.first("phase").alias("phase"), F.min("frame").alias("start_frame"), F.max("frame").alias("end_frame"), F.min_by("state", "frame").alias("a"), F.max_by("action", "frame").alias("z"), F.bool_and("action_is_supervised").alias("supervised"), F.bool_or("observation_only").alias("watched"))


@query("recovery_action_rows", f"""{RUNS_SQL} SELECT episode, row_number() OVER w - 1 AS segment, start_frame, end_frame, z - a AS guide, (end_frame - start_frame + 8) // 8 AS chunks, {ROLE_SQL.format("raw_phase", "(row_number() OVER w - 1)")} AS role, {VERB_SQL.format("raw_phase")} AS verb, CASE WHEN row_number() OVER w = 1 THEN 'failed_no_effect' ELSE 'success' END AS previous_status, lag(start_frame) OVER w AS history_frame FROM rs WHERE supervised AND NOT watched WINDOW w AS (PARTITION BY episode ORDER BY run)""")
def recovery_action_rows(spark, root):
    """ROW-06, FLT-22: targets of supervised recovery segments, each with the outcome before it."""
    rows = phase_runs(spark, root).where("supervised and not watched")
    w = along("episode", "run")
    index = F.row_number().over(w) - 1
    n = F.col("end_frame") - F.col("start_frame") + 1
    rows = rows.withColumn("segment", index.cast("long"))
    return rows.select("episode", "segment", "start_frame", "end_frame", (F.col("z") - F.col("a")).alias("guide"), rewrites.chunks_of(n).alias("chunks"), adapters.role_of(F.col("raw_phase"), F.col("segment")).alias("role"), adapters.verb_of(F.col("raw_phase")).alias("verb"), F.when(F.col("segment") == 0, "failed_no_effect").otherwise("success").alias("previous_status"), F.lag("start_frame").over(w).alias("history_frame"))


FULL_ROWS = f"""{RUNS_SQL}, ne AS (SELECT *, lead(phase) OVER w AS next_phase, lead(z - a) OVER w AS next_guide, lead(start_frame) OVER w AS next_start, max(run) OVER (PARTITION BY episode) AS last_ FROM rs WINDOW w AS (PARTITION BY episode ORDER BY run)),
 fr AS (SELECT episode, run, CASE WHEN run = last_ AND phase = 'recovery' THEN 'terminal_recovery_assessment' WHEN phase = 'rollout' THEN 'rollout_assessment' WHEN next_phase = 'recovery' THEN CASE WHEN phase = 'failure' OR phase = 'recovery' THEN 'recovery_action' ELSE 'recovery_diagnosis' END WHEN phase = 'failure' THEN 'failure_diagnosis' ELSE 'recovery_diagnosis' END AS sample_type,
   phase, raw_phase, start_frame AS before_frame, coalesce(next_start, end_frame) AS current_frame, next_guide, CASE phase WHEN 'rollout' THEN 'success' WHEN 'failure' THEN CASE WHEN end_frame > start_frame THEN 'failed_different' ELSE 'failed_no_effect' END ELSE 'partial' END AS outcome FROM ne)"""


def full_rows(spark, root):
    """One row for each run of a phase: its kind, the frames before and now, and the action that follows a failure or recovery."""
    w = along("episode", "run")
    rows = phase_runs(spark, root).withColumns({"next_phase": F.lead("phase").over(w), "next_guide": F.lead(F.col("z") - F.col("a")).over(w), "next_start": F.lead("start_frame").over(w), "last": F.max("run").over(Window.partitionBy("episode"))})
    phase = F.col("phase")
    kind = (
        F.when((F.col("run") == F.col("last")) & (phase == "recovery"), "terminal_recovery_assessment").when(phase == "rollout", "rollout_assessment")
        .when(F.col("next_phase") == "recovery", F.when(phase.isin("failure", "recovery"), "recovery_action").otherwise("recovery_diagnosis")).when(phase == "failure", "failure_diagnosis").otherwise("recovery_diagnosis")
    )
    outcome = F.when(phase == "rollout", "success").when(phase == "failure", F.when(F.col("end_frame") > F.col("start_frame"), "failed_different").otherwise("failed_no_effect")).otherwise("partial")
    return rows.select("episode", "run", kind.alias("sample_type"), "phase", "raw_phase", F.col("start_frame").alias("before_frame"), F.coalesce("next_start", "end_frame").alias("current_frame"), "next_guide", outcome.alias("outcome"))


@query("full_episode_rows", f"""{FULL_ROWS} SELECT episode, run, sample_type, phase, before_frame, current_frame, CASE WHEN sample_type = 'recovery_action' THEN next_guide END AS next_action, sample_type = 'recovery_action' AS action_supervision, {_case('outcome', language.OPENINGS)} AS opening FROM fr""")
def full_episode_rows(spark, root):
    """ROW-07, SEG-16: assessments of source, failure, recovery and end, with actions only where a failure or recovery is their origin."""
    action = F.col("sample_type") == "recovery_action"
    return full_rows(spark, root).select("episode", "run", "sample_type", "phase", "before_frame", "current_frame", F.when(action, F.col("next_guide")).alias("next_action"), action.alias("action_supervision"), language.lookup(language.OPENINGS, F.col("outcome")).alias("opening"))


@query("full_episode_report", f"{FULL_ROWS} SELECT phase, raw_phase, outcome, count(*) AS rows_, count(*) FILTER (WHERE sample_type = 'recovery_action') AS actions, count(DISTINCT episode) AS episodes FROM fr GROUP BY GROUPING SETS ((phase), (raw_phase), (outcome), ())")
def full_episode_report(spark, root):
    """ROW-07, AGG-15: rows and actions by phase, by raw phase, by outcome and in all."""
    rows = full_rows(spark, root)
    keys = [F.col(c) for c in ("phase", "raw_phase", "outcome")]
    return rows.groupingSets([[keys[0]], [keys[1]], [keys[2]], []], *keys).agg(F.count("*").alias("rows_"), F.count_if(F.col("sample_type") == "recovery_action").alias("actions"), F.countDistinct("episode").alias("episodes"))


NUMBERED = f"""{MANIFEST_SQL}, nm AS (SELECT episode, segment, start_frame, end_frame, row_number() OVER (ORDER BY episode, segment) - 1 AS block, dense_rank() OVER (ORDER BY episode) - 1 AS episode_index, min(segment) OVER (PARTITION BY episode) AS first_segment FROM ms)"""


def numbered(spark, root):
    """Segments of the recovery manifest with their block and episode numbers over the whole manifest."""
    rows = recovery_manifest_rows(spark, root).select("episode", "segment", "start_frame", "end_frame")
    rows = block_numbers(rows, "episode", ["segment"])
    order = block_numbers(rows.select("episode").distinct(), "episode", ["episode"]).withColumnRenamed("block", "episode_index")
    return rows.join(order, "episode")


@query("native_manifest", f"{NUMBERED} SELECT episode_index, episode, min(block) AS global_block_start, count(*) AS segment_count, max(end_frame) + 1 AS all_frames FROM nm GROUP BY ALL")
def native_manifest(spark, root):
    """ROW-08, WIN-21: eligible episodes numbered in order, each with its first block, segments and frames."""
    return numbered(spark, root).groupBy("episode_index", "episode").agg(F.min("block").alias("global_block_start"), F.count("*").alias("segment_count"), (F.max("end_frame") + 1).alias("all_frames"))


@query("manifest_reload", f"""{NUMBERED}, dm AS (SELECT * FROM nm WHERE block % 101 <> 50), ck AS (SELECT *, lag(block) OVER (ORDER BY block) AS pb, lag(end_frame) OVER (PARTITION BY episode ORDER BY segment) AS pe FROM dm) SELECT count(*) AS segments, count(*) FILTER (WHERE block <> coalesce(pb + 1, 0)) AS block_gaps, count(*) FILTER (WHERE start_frame <> coalesce(pe + 1, 0)) AS frame_gaps, count(DISTINCT episode_index) AS episodes FROM ck""")
def manifest_reload(spark, root):
    """ROW-08, FLT-10: a stored manifest read back, with the breaks in its numbers; here some segments are lost. Blocks are compared by
    a join with the next number, not by a window over all rows."""
    rows = numbered(spark, root).where("block % 101 <> 50")
    marked = rows.withColumn("gap", F.col("start_frame") != F.coalesce(F.lag("end_frame").over(along("episode", "segment")) + 1, F.lit(0)))
    follows = rows.select((F.col("block") + 1).alias("block"), F.lit(True).alias("follows"))
    checked = marked.join(follows, "block", "left")
    return checked.agg(F.count("*").alias("segments"), F.count_if(F.col("follows").isNull() & (F.col("block") != 0)).alias("block_gaps"), F.count_if("gap").alias("frame_gaps"), F.countDistinct("episode_index").alias("episodes"))


FINAL = f"""{NUMBERED}, rk AS (SELECT *, CAST(episode_index % 4 AS INTEGER) AS rank FROM nm), ot AS (SELECT rank, episode, segment, end_frame - start_frame + 1 AS n FROM rk WHERE NOT (rank = 3 AND episode % 31 = 0) UNION ALL SELECT 1, episode, segment, end_frame - start_frame + 1 FROM rk WHERE rank = 2 AND episode % 37 = 0)"""


def ranks(spark, root):
    """The manifest by rank, and what the ranks have written: one rank has lost episodes, and another wrote some of a third."""
    rows = numbered(spark, root).withColumn("rank", (F.col("episode_index") % 4).cast("int")).withColumn("n", F.col("end_frame") - F.col("start_frame") + 1)
    written = rows.where("not (rank = 3 and episode % 31 = 0)").select("rank", "episode", "segment", "n")
    return rows, written.unionByName(rows.where("rank = 2 and episode % 37 = 0").select(F.lit(1).alias("rank"), "episode", "segment", "n"))


@query("rank_pipeline", f"{FINAL}, dn AS (SELECT rank, episode, count(*) AS have FROM ot GROUP BY ALL), wn AS (SELECT rank, episode, count(*) AS want FROM rk GROUP BY ALL) SELECT rank, count(*) AS episodes, count(*) FILTER (WHERE have = want) AS complete, count(*) FILTER (WHERE have IS NULL) AS pending, CAST(sum(want) AS BIGINT) AS blocks FROM wn LEFT JOIN dn USING (rank, episode) GROUP BY rank")
def rank_pipeline(spark, root):
    """ROW-09, WIN-26, JOIN-20: what each rank has to do, has done, and has yet to do."""
    rows, written = ranks(spark, root)
    want = rows.groupBy("rank", "episode").agg(F.count("*").alias("want"))
    have = written.groupBy("rank", "episode").agg(F.count("*").alias("have"))
    return want.join(have, ["rank", "episode"], "left").groupBy("rank").agg(F.count("*").alias("episodes"), F.count_if(F.col("have") == F.col("want")).alias("complete"), F.count_if(F.col("have").isNull()).alias("pending"), F.sum("want").alias("blocks"))


@query("finalize_ranks", f"""{FINAL}, ou AS (SELECT episode, segment, count(*) AS copies, min(n) AS n FROM ot GROUP BY ALL), fj AS (SELECT rk.episode AS a, ou.episode AS b, copies, rk.end_frame - rk.start_frame + 1 AS want, ou.n AS have FROM rk FULL JOIN ou ON rk.episode = ou.episode AND rk.segment = ou.segment)
  SELECT count(*) FILTER (WHERE a IS NOT NULL) AS expected, count(*) FILTER (WHERE b IS NOT NULL) AS written, count(*) FILTER (WHERE b IS NULL) AS missing, count(*) FILTER (WHERE a IS NULL) AS unexpected, count(*) FILTER (WHERE copies > 1) AS duplicated, count(*) FILTER (WHERE want <> have) AS differ, CAST(sum(have) AS BIGINT) AS action_rows FROM fj""")
def finalize_ranks(spark, root):
    """ROW-10, SET-02, SET-05: the union of all ranks against the manifest: coverage, uniqueness and recomputed rows."""
    rows, written = ranks(spark, root)
    once = written.groupBy("episode", "segment").agg(F.count("*").alias("copies"), F.min("n").alias("have"))
    both = rows.select("episode", "segment", F.col("n").alias("want")).join(once, ["episode", "segment"], "full")
    return both.agg(F.count("want").alias("expected"), F.count("have").alias("written"), F.count_if(F.col("have").isNull()).alias("missing"), F.count_if(F.col("want").isNull()).alias("unexpected"), F.count_if(F.col("copies") > 1).alias("duplicated"), F.count_if(F.col("want") != F.col("have")).alias("differ"), F.sum("have").alias("action_rows"))


@query("resume_check", f"""{NUMBERED}, sv AS (SELECT block, CASE WHEN block % 1009 = 700 THEN 'changed' ELSE md5(episode || '|' || segment || '|' || start_frame) END AS digest FROM nm WHERE block < 5000), wt AS (SELECT block, md5(episode || '|' || segment || '|' || start_frame) AS digest FROM nm), bd AS (SELECT min(wt.block) AS stop FROM wt LEFT JOIN sv USING (block) WHERE sv.digest IS DISTINCT FROM wt.digest)
  SELECT (SELECT count(*) FROM sv) AS stored, stop AS first_bad, coalesce(stop, (SELECT count(*) FROM wt)) AS verified, (SELECT count(*) FROM sv WHERE block >= stop) AS discarded FROM bd""")
def resume_check(spark, root):
    """ROW-22, STM-04: stored rows against what they must be, over the whole prefix; from the first that differs on, all is done anew."""
    digest = F.md5(F.concat_ws("|", F.col("episode").cast("string"), F.col("segment").cast("string"), F.col("start_frame").cast("string")))
    want = numbered(spark, root).select("block", digest.alias("want"))
    have = want.where("block < 5000").select("block", F.when(F.col("block") % 1009 == 700, "changed").otherwise(F.col("want")).alias("have"))
    both = want.join(have, "block", "left").withColumn("ok", F.col("have").eqNullSafe(F.col("want")))
    stop = both.agg(F.min(F.when(~F.col("ok"), F.col("block"))).alias("first_bad"), F.count("*").alias("rows"))
    joined = both.join(F.broadcast(stop))  # one row
    return joined.agg(F.count("have").alias("stored"), F.first("first_bad").alias("first_bad"), F.coalesce(F.first("first_bad"), F.first("rows")).alias("verified"), F.count_if(F.col("have").isNotNull() & (F.col("block") >= F.col("first_bad"))).alias("discarded"))
