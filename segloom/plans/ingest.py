"""Queries over adapters and inventories: what becomes of records on their way in."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from segloom.functions.arrays import norm, parts, round_even
from segloom.functions.text import json_keys
from segloom.operators import ingest
from segloom.operators.windows import along, block_numbers
from segloom.plans.registry import query
from segloom.sources.tables import EVENTS, TIMELINE, VECTORS, events, table, timeline, vectors

TL, EV, VX = f"WITH {TIMELINE}", f"WITH {EVENTS}", f"WITH {VECTORS}"
HOURS = 3_600_000_000


@query("json_members", "SELECT k AS key, count(*) AS n, CAST(sum(CAST(json_extract(props, '$.' || k) AS BIGINT)) AS BIGINT) AS total FROM (SELECT props, unnest(json_keys(props)) AS k FROM events) GROUP BY k")
def json_members(spark, root):
    """SRC-08: members of JSON objects as (key, value) rows."""
    rows = table(spark, root, "events").select(F.explode(F.from_json("props", "map<string,bigint>")).alias("key", "value"))
    return rows.groupBy("key").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def _bridge(spark, root):
    x = F.col("x")
    n = F.count("*").over(Window.partitionBy("episode"))
    flags = [(F.col("frame") == 0).cast("int").alias("is_first"), (F.col("frame") == n - F.when(F.col("episode") == 3, 2).otherwise(1)).cast("int").alias("is_last"), F.when((F.col("episode") == 5) & (F.col("frame") % 7 == 3), 2).when((F.col("episode") == 7) & (F.col("frame") == 4), 1).otherwise(0).alias("is_terminal")]
    return vectors(spark, root).select("episode", "frame", F.slice(x, 1, 7).alias("state"), F.slice(x, 8, 3).alias("translation"), F.slice(x, 11, 3).alias("rotation"), F.get(x, F.lit(15)).alias("aperture"), *flags)


@query("bridge_steps", f"{VX} SELECT episode, frame, frame / 5.0::DOUBLE AS time, x[8:13] || [x[16]] AS action, [x[1] + x[8], x[2] + x[9], x[3] + x[10], x[4] + x[11], x[5] + x[12], x[6] + x[13], x[16]] AS endpoint FROM vx")
def bridge_steps(spark, root):
    """SRC-11: seven-dimensional steps with the action and the endpoint that it commands."""
    return ingest.bridge_steps(_bridge(spark, root)).select("episode", "frame", "time", "action", "endpoint")


@query("step_flag_problems", f"""{VX}, s AS (SELECT episode, frame, max(frame) OVER (PARTITION BY episode) AS m FROM vx), f AS (SELECT *, CASE WHEN frame = m - (CASE WHEN episode = 3 THEN 1 ELSE 0 END) THEN 1 ELSE 0 END AS last_, CASE WHEN episode = 5 AND frame % 7 = 3 THEN 2 WHEN episode = 7 AND frame = 4 THEN 1 ELSE 0 END AS term FROM s),
  e AS (SELECT episode, bool_or(last_ <> CASE WHEN frame = m THEN 1 ELSE 0 END) AS a, bool_or(term NOT IN (0, 1)) AS b, bool_or(term <> 0 AND frame < m) AS c FROM f GROUP BY episode), u AS (SELECT episode, unnest([CASE WHEN a THEN 'noncanonical_is_last' END, CASE WHEN b THEN 'nonboolean_is_terminal' END, CASE WHEN c THEN 'terminal_before_final_step' END]) AS code FROM e)
  SELECT * FROM u WHERE code IS NOT NULL""")
def step_flag_problems(spark, root):
    """SRC-10, SRC-11, FLT-24: first, last and terminal marks that are not canonical."""
    return ingest.flag_problems(_bridge(spark, root))


@query("single_instruction", "SELECT conv_id, count(DISTINCT nullif(trim(text), '')) AS instructions, CASE WHEN count(DISTINCT nullif(trim(text), '')) = 1 THEN max(nullif(trim(text), '')) END AS instruction FROM conversations WHERE role = 'system' GROUP BY conv_id")
def single_instruction(spark, root):
    """SRC-11: the one instruction of an episode, null if it has none or several."""
    said = F.nullif(F.trim("text"), F.lit(""))
    many = F.countDistinct(said)
    return table(spark, root, "conversations").where("role = 'system'").groupBy("conv_id").agg(many.alias("instructions"), F.when(many == 1, F.max(said)).alias("instruction"))


STREAMS = f"""{EV}, k AS (SELECT episode, t, event_id AS id FROM ev WHERE label = 'view'), a AS (SELECT episode, t, c FROM ev WHERE label = 'click'), e AS (SELECT episode, t, c FROM ev WHERE label = 'error'), s AS (SELECT episode, t, c FROM ev WHERE label = 'signup'),
  j AS (SELECT k.episode, k.t, k.id, a.t AS at_, a.c AS av, e.t AS et, e.c AS ev_, b.t AS bt, b.c AS bv, f.t AS ft, f.c AS fv FROM k ASOF LEFT JOIN a ON k.episode = a.episode AND k.t >= a.t ASOF LEFT JOIN e ON k.episode = e.episode AND k.t >= e.t ASOF LEFT JOIN s b ON k.episode = b.episode AND k.t >= b.t ASOF LEFT JOIN s f ON k.episode = f.episode AND k.t <= f.t),
  n AS (SELECT *, CASE WHEN bt IS NULL THEN ft WHEN ft IS NULL OR t - bt <= ft - t THEN bt ELSE ft END AS st, CASE WHEN bt IS NULL THEN fv WHEN ft IS NULL OR t - bt <= ft - t THEN bv ELSE fv END AS sv FROM j)"""


def _streams(spark, root):
    messages = events(spark, root).select("episode", F.col("label").alias("topic"), "t", F.col("event_id").alias("id"), F.col("c").alias("value"))
    return ingest.aligned_streams(messages, "view", ["click", "error"], ["signup"], 24 * HOURS)


def _code(t):
    return f"CASE WHEN {t} IS NULL THEN 'missing' WHEN abs(t - {t}) > {24 * HOURS} THEN 'late' END"


@query("stream_alignment", f"{STREAMS} SELECT episode, id, av AS click, t - at_ AS click_skew, {_code('at_')} AS click_code, ev_ AS error, {_code('et')} AS error_code, sv AS signup, t - st AS signup_skew, {_code('st')} AS signup_code FROM n")
def stream_alignment(spark, root):
    """SRC-12, JOIN-01 to JOIN-03: observations at or before each tick of one topic's clock, the nearest command, and a tolerance."""
    rows = _streams(spark, root)
    return rows.select("episode", "id", F.col("click.value").alias("click"), F.col("click.skew").alias("click_skew"), F.col("click.code").alias("click_code"), F.col("error.value").alias("error"), F.col("error.code").alias("error_code"), F.col("signup.value").alias("signup"), F.col("signup.skew").alias("signup_skew"), F.col("signup.code").alias("signup_code"))


@query("stream_alignment_report", f"{STREAMS} SELECT episode, count(*) AS ticks, max(t - at_) AS click_skew, max(t - et) AS error_skew, max(abs(t - st)) AS signup_skew, count(*) FILTER (WHERE {_code('at_')} IS NOT NULL OR {_code('et')} IS NOT NULL OR {_code('st')} IS NOT NULL) AS unaligned, count(*) FILTER (WHERE at_ > t OR et > t) AS leaks FROM n GROUP BY episode")
def stream_alignment_report(spark, root):
    """SRC-12, AGG-24, FLT-25: the largest skews of an episode, ticks that a stream misses, and observations from the future."""
    code = F.coalesce("click.code", "error.code", "signup.code")
    skews = [F.max(F.abs(F.col(f"{c}.skew"))).alias(f"{c}_skew") for c in ("click", "error", "signup")]
    return _streams(spark, root).groupBy("episode").agg(F.count("*").alias("ticks"), *skews, F.count_if(code.isNotNull()).alias("unaligned"), F.count_if((F.col("click.t") > F.col("t")) | (F.col("error.t") > F.col("t"))).alias("leaks"))


ENDPOSE = "en AS (SELECT episode, frame, x[1:7] || [x[16]] || x[8:14] || [x[15]] AS state FROM vx)"


def _endpose(spark, root):
    x = F.col("x")
    extra = F.when(F.col("frame") % 3 != 1, F.to_json(F.struct((F.col("frame") % 6 == 0).alias("new_decision_boundary"), F.lit("step").alias("stage"))))
    return ingest.endpose(vectors(spark, root).select("episode", "frame", F.slice(x, 1, 7).alias("left_pose"), F.get(x, F.lit(15)).alias("left_grip"), F.slice(x, 8, 7).alias("right_pose"), F.get(x, F.lit(14)).alias("right_grip"), extra.alias("extra")))


@query("endpose_states", f"{VX}, {ENDPOSE} SELECT * FROM (SELECT episode, frame, state, lead(state) OVER (PARTITION BY episode ORDER BY frame) AS action, frame > 0 AND frame % 6 = 0 AS decision FROM en) WHERE action IS NOT NULL")
def endpose_states(spark, root):
    """SRC-13, WIN-20: four arrays as one state, the next state as action, and decisions from JSON."""
    return _endpose(spark, root).select("episode", "frame", "state", "action", "decision")


@query("adapter_dispatch", f"""{VX}, {ENDPOSE}, b AS (SELECT episode, frame / 5.0::DOUBLE AS time, len(x[1:7]) AS d, x[1] AS s FROM vx), e AS (SELECT episode, frame / 5.0::DOUBLE AS time, len(state) AS d, state[1] AS s FROM en WHERE frame < (SELECT max(v.frame) FROM vx v WHERE v.episode = en.episode))
  SELECT 'bridge' AS profile, CAST(max(d) AS BIGINT) AS dimension, count(*) AS rows_, count(DISTINCT episode) AS episodes, max(time) AS last_time, CAST(sum(s) AS BIGINT) AS total FROM b UNION ALL SELECT 'endpose', CAST(max(d) AS BIGINT), count(*), count(DISTINCT episode), max(time), CAST(sum(s) AS BIGINT) FROM e""")
def adapter_dispatch(spark, root):
    """UDF-03: sources of two profiles, each by its adapter, as one table."""
    x = F.col("x")
    native = vectors(spark, root).select("episode", "frame", F.slice(x, 1, 7).alias("left_pose"), F.get(x, F.lit(15)).alias("left_grip"), F.slice(x, 8, 7).alias("right_pose"), F.get(x, F.lit(14)).alias("right_grip"), F.lit(None).cast("string").alias("extra"))
    rows = ingest.adapt({"bridge": _bridge(spark, root), "endpose": native})
    return rows.groupBy("profile").agg(F.max(F.size("state")).cast("long").alias("dimension"), F.count("*").alias("rows_"), F.countDistinct("episode").alias("episodes"), F.max("time").alias("last_time"), F.sum(F.get("state", F.lit(0))).alias("total"))


# The raw phases that events stand for here, and the phase of each raw one.
RAW = {"view": "rollout", "click": "attempt", "error": "failure_observation", "signup": "recovery", "purchase": "recovery_outcome"}
PHASE = {"rollout": "rollout", "pre_failure": "rollout", "attempt": "failure", "failure_observation": "failure", "failure_outcome": "failure", "failure": "failure", "post_failure": "failure", "recovery": "recovery", "recovery_outcome": "recovery"}
_CASE = lambda column, mapping: f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"
FULL = f"""fe AS (SELECT episode, frame, t, c AS state, lead(c) OVER (PARTITION BY episode ORDER BY frame) AS action, {_CASE('label', RAW)} AS raw_phase FROM ev), fu AS (SELECT *, {_CASE('raw_phase', PHASE)} AS phase, raw_phase = 'failure_observation' AS observation_only, raw_phase IN ('recovery', 'recovery_outcome') AND action IS NOT NULL AS action_is_supervised,
  bool_or(raw_phase = 'recovery_outcome') OVER (PARTITION BY episode) AS task_success FROM fe)"""


def full_episodes(spark, root):
    """Frames with state, action, raw and mapped phase, and the flags of supervision."""
    named = lambda mapping, c: F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[c]
    rows = events(spark, root).select("episode", "frame", "t", F.col("c").alias("state"), F.lead("c").over(along()).alias("action"), named(RAW, F.col("label")).alias("raw_phase"))
    flags = {"phase": named(PHASE, F.col("raw_phase")), "observation_only": F.col("raw_phase") == "failure_observation", "action_is_supervised": F.col("raw_phase").isin("recovery", "recovery_outcome") & F.col("action").isNotNull(), "task_success": F.bool_or(F.col("raw_phase") == "recovery_outcome").over(Window.partitionBy("episode"))}
    return rows.withColumns(flags)


@query("full_episode_table", f"{EV}, {FULL} SELECT episode, frame, state, action, raw_phase, phase, observation_only, action_is_supervised, task_success FROM fu")
def full_episode_table(spark, root):
    """SRC-14: the wide frame table of failures and recoveries."""
    return full_episodes(spark, root).drop("t")


@query("dataset_shards", """WITH s AS (SELECT p_brand AS dataset, CASE WHEN p_size % 2 = 0 THEN 'train' ELSE 'val' END AS split, p_size, count(*) AS n FROM part GROUP BY ALL), l AS (SELECT dataset, split, list(n ORDER BY p_size) AS lengths FROM s GROUP BY ALL), u AS (SELECT dataset, split, len(lengths) AS of_, unnest(range(len(lengths))) AS shard, lengths FROM l)
  SELECT dataset, '0.1.0' AS version, split, CAST(shard AS INTEGER) AS shard, lengths[shard + 1] AS expected, printf('%s-%s.tfrecord-%05d-of-%05d', lower(replace(dataset, '#', '_')), split, shard, of_) AS path FROM u""")
def dataset_shards(spark, root):
    """SRC-15: shards of data sets by their JSON descriptions."""
    sizes = table(spark, root, "part").groupBy(F.col("p_brand").alias("dataset"), F.when(F.col("p_size") % 2 == 0, "train").otherwise("val").alias("name"), "p_size").agg(F.count("*").alias("n"))
    lengths = F.transform(F.sort_array(F.collect_list(F.struct("p_size", "n"))), lambda r: r["n"].cast("string"))
    splits = sizes.groupBy("dataset", "name").agg(lengths.alias("shardLengths"), F.sum("n").cast("string").alias("numBytes"))
    infos = splits.groupBy("dataset").agg(F.to_json(F.struct(F.lower(F.replace("dataset", F.lit("#"), F.lit("_"))).alias("name"), F.lit("0.1.0").alias("version"), F.collect_list(F.struct("name", "shardLengths", "numBytes")).alias("splits"))).alias("info"))
    return ingest.shard_inventory(infos)


@query("action_leaf", """WITH l AS (SELECT p_brand AS dataset, 'steps/action/' || p_partkey AS key, p_size % 9 AS width, ['float32', 'int64', 'string', 'float64', 'bool'][1 + p_partkey % 5] AS dtype FROM part)
  SELECT dataset, m.key AS key, CAST(m.width AS INTEGER) AS width, m.dtype AS dtype FROM (SELECT dataset, arg_min({'key': key, 'width': width, 'dtype': dtype}, {'a': NOT starts_with(dtype, 'float'), 'b': width, 'c': key}) AS m FROM l WHERE width > 0 AND dtype <> 'string' GROUP BY dataset)""")
def action_leaf(spark, root):
    """SRC-15: the narrowest floating feature of an action."""
    dtype = F.element_at(F.array(*[F.lit(d) for d in ("float32", "int64", "string", "float64", "bool")]), (1 + F.col("p_partkey") % 5).cast("int"))
    leaves = table(spark, root, "part").select(F.col("p_brand").alias("dataset"), F.concat(F.lit("steps/action/"), F.col("p_partkey").cast("string")).alias("key"), (F.col("p_size") % 9).alias("width"), dtype.alias("dtype"))
    return ingest.action_leaf(leaves)


@query("episode_catalogue", """WITH g AS (SELECT l_orderkey // 4000 AS file, l_orderkey // 250 AS row_group, min(l_orderkey) AS lo, max(l_orderkey) AS hi FROM lineitem GROUP BY ALL), m AS (SELECT o_orderkey AS k, list(DISTINCT file) AS files, count(*) AS groups_ FROM orders JOIN g ON o_orderkey BETWEEN lo AND hi GROUP BY 1)
  SELECT o_orderkey AS episode, coalesce(len(files), 0) AS files, coalesce(groups_, 0) AS row_groups, list_filter(['train', 'val', 'test'], lambda s: CASE s WHEN 'train' THEN o_orderkey < 9000 WHEN 'val' THEN o_orderkey >= 9000 AND o_orderkey < 12000 ELSE o_orderkey >= 11900 AND o_orderkey < 14000 END) AS splits,
    o_orderkey / 30.0::DOUBLE AS from_s, (o_orderkey + o_custkey) / 30.0::DOUBLE AS to_s FROM orders LEFT JOIN m ON k = o_orderkey""")
def episode_catalogue(spark, root):
    """SRC-17, JOIN-08: episodes with the row groups that may hold them, the splits that claim them, and their span of a video."""
    key = F.col("l_orderkey")
    groups = table(spark, root, "lineitem").groupBy(F.floor(key / 4000).alias("file"), F.floor(key / 250).alias("row_group")).agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
    orders = table(spark, root, "orders").select(F.col("o_orderkey").alias("key"), "o_custkey")
    found = ingest.range_catalogue(orders.select("key"), groups).groupBy("key").agg(F.countDistinct("file").alias("files"), F.count("*").alias("row_groups"))
    splits = ingest.split_of(F.col("key"), {"train": (0, 9000), "val": (9000, 12000), "test": (11900, 14000)})
    return orders.join(found, "key", "left").select(F.col("key").alias("episode"), F.coalesce("files", F.lit(0)).alias("files"), F.coalesce("row_groups", F.lit(0)).alias("row_groups"), splits.alias("splits"), (F.col("key") / 30).alias("from_s"), ((F.col("key") + F.col("o_custkey")) / 30).alias("to_s"))


@query("catalogue_problems", """WITH s AS (SELECT o_orderkey AS k, CAST(o_orderkey < 9000 AS INTEGER) + CAST(o_orderkey >= 9000 AND o_orderkey < 12000 AS INTEGER) + CAST(o_orderkey >= 11900 AND o_orderkey < 14000 AS INTEGER) AS n FROM orders), d AS (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)
  SELECT 'overlapping_splits' AS code, count(*) AS n FROM s WHERE n > 1 UNION ALL SELECT 'no_split', count(*) FROM s WHERE n = 0 UNION ALL SELECT 'duplicate_identity', count(*) FROM d""")
def catalogue_problems(spark, root):
    """SRC-17: episodes in two splits or in none, and identities that come twice."""
    splits = F.size(ingest.split_of(F.col("o_orderkey"), {"train": (0, 9000), "val": (9000, 12000), "test": (11900, 14000)}))
    one = table(spark, root, "orders").agg(F.count_if(splits > 1).alias("a"), F.count_if(splits == 0).alias("b"))
    twice = table(spark, root, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("n"))
    rows = one.select(F.explode(F.create_map(F.lit("overlapping_splits"), "a", F.lit("no_split"), "b")).alias("code", "n"))
    return rows.unionByName(twice.select(F.lit("duplicate_identity").alias("code"), "n"))


# Words that labels are made of here.
LABELS = ("withdraw_arm", "retry-grasp", "confirm_contact", "press__button", "restore pose", "move_on", "Recenter_tool")
_LABEL = "['" + "', '".join(LABELS) + "'][1 + {0} % 7]"


def label_of(number):
    return F.element_at(F.array(*[F.lit(x) for x in LABELS]), (1 + number % 7).cast("int"))


ROLE_SQL = """CASE WHEN regexp_matches(lower({0}), 'confirm|verify|observe') THEN 'verify_recovery' WHEN regexp_matches(lower({0}), 'retry|reattempt') THEN 'retry_failed_subtask' WHEN regexp_matches(lower({0}), 'withdraw|recenter|relocalize|clear|restore|regrasp') THEN 'repair_precondition' WHEN {1} = 0 THEN 'start_recovery' ELSE 'resume_original_task' END"""
VERB_SQL = """CASE WHEN regexp_matches(lower({0}), 'confirm|observe|verify|wait') THEN 'recover:verify' WHEN regexp_matches(lower({0}), 'retry|reattempt|press') THEN 'recover:retry' WHEN regexp_matches(lower({0}), 'restore|regrasp|recover') THEN 'recover:restore' ELSE 'recover:reposition' END"""
WORDS_SQL = "trim(regexp_replace(regexp_replace({0}, '[-_]+', ' ', 'g'), ' +', ' ', 'g'))"


@query("label_roles", f"""{TL}, l AS (SELECT segment, {_LABEL.format('(episode + segment)')} AS label FROM tl) SELECT label, {ROLE_SQL.format('label', 'segment')} AS role, {VERB_SQL.format('label')} AS verb, upper(left({WORDS_SQL.format('label')}, 1)) || substr({WORDS_SQL.format('label')}, 2) || '.' AS sentence, count(*) AS n FROM l GROUP BY ALL""")
def label_roles(spark, root):
    """STR-11: role, verb and sentence of a label by its words."""
    rows = timeline(spark, root).select("segment", label_of(F.col("episode") + F.col("segment")).alias("label"))
    label = F.col("label")
    return rows.groupBy("label", ingest.role_of(label, F.col("segment")).alias("role"), ingest.verb_of(label).alias("verb"), ingest.sentence_of(label).alias("sentence")).agg(F.count("*").alias("n"))


AUDIT_SQL = """ad AS (SELECT o_orderkey, o_custkey % 5 AS level, {'eligible_for_training': CASE WHEN o_totalprice > 50000 THEN 'true' ELSE 'false' END, 'pair_audit_status': CASE o_orderstatus WHEN 'P' THEN 'pending' ELSE 'passed' END, 'source_failure_verified': CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE 'true' END,
  'source_failure_mode': CASE WHEN o_orderpriority LIKE '5%' THEN 'planning_failure' ELSE 'execution_failure' END, 'recovery_success': 'true', 'new_decision_boundary': 'true', 'direct_continuation': CASE WHEN o_orderkey % 13 = 0 THEN 'true' ELSE 'false' END} AS a FROM orders)"""
FAILED_SQL = """list_filter(['eligible_for_training', 'pair_audit_status', 'source_failure_verified', 'source_failure_mode', 'recovery_success', 'new_decision_boundary', 'direct_continuation'], lambda r: CASE r WHEN 'eligible_for_training' THEN a.eligible_for_training <> 'true' WHEN 'pair_audit_status' THEN a.pair_audit_status <> 'passed' WHEN 'source_failure_verified' THEN a.source_failure_verified IS NULL
  WHEN 'source_failure_mode' THEN a.source_failure_mode <> 'execution_failure' WHEN 'direct_continuation' THEN a.direct_continuation <> 'false' ELSE false END)"""


def audits(spark, root):
    """Orders as pairs of failure and recovery, with a map of audit values and a level."""
    flag = lambda c: F.when(c, "true").otherwise("false")
    values = {"eligible_for_training": flag(F.col("o_totalprice") > 50000), "pair_audit_status": F.when(F.col("o_orderstatus") == "P", "pending").otherwise("passed"), "source_failure_verified": F.when(F.col("o_custkey") % 11 != 0, "true"), "source_failure_mode": F.when(F.col("o_orderpriority").startswith("5"), "planning_failure").otherwise("execution_failure"), "recovery_success": F.lit("true"), "new_decision_boundary": F.lit("true"), "direct_continuation": flag(F.col("o_orderkey") % 13 == 0)}
    return table(spark, root, "orders").select(F.col("o_orderkey").alias("episode"), (F.col("o_custkey") % 5).alias("level"), F.create_map(*[y for k, v in values.items() for y in (F.lit(k), v)]).alias("audit"))


@query("recovery_eligibility", f"WITH {AUDIT_SQL}, r AS (SELECT o_orderkey AS episode, {FAILED_SQL} AS failed, level BETWEEN 1 AND 4 AS known_level FROM ad) SELECT episode, failed, known_level, len(failed) = 0 AND known_level AS eligible FROM r")
def recovery_eligibility(spark, root):
    """FLT-21: the seven audit requirements of a pair, and its level."""
    rows = audits(spark, root).select("episode", ingest.audit_failures(F.col("audit")).alias("failed"), F.col("level").isin(*ingest.LEVELS).alias("known_level"))
    return rows.withColumn("eligible", (F.size("failed") == 0) & F.col("known_level"))


@query("outcome_problems", """WITH o AS (SELECT o_orderkey AS episode, ['success', 'failed_no_effect', 'failed_different', 'partial', 'unknown', 'maybe'][1 + o_custkey % 6] AS status, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE o_orderpriority END AS expected, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS observed, CASE WHEN o_orderkey % 4 = 0 THEN ' ' ELSE 'differs' END AS mismatch FROM orders)
  SELECT episode, list_filter(['status', 'expected', 'observed', 'mismatch'], lambda r: CASE r WHEN 'status' THEN status = 'maybe' WHEN 'expected' THEN trim(expected) = '' WHEN 'observed' THEN status IN ('failed_no_effect', 'failed_different', 'partial') AND trim(coalesce(observed, '')) = '' ELSE status IN ('failed_no_effect', 'failed_different', 'partial') AND trim(mismatch) = '' END) AS problems FROM o""")
def outcome_problems(spark, root):
    """SRC-19, FLT-21: outcomes that lack what their status asks for."""
    status = F.element_at(F.array(*[F.lit(s) for s in ("success", "failed_no_effect", "failed_different", "partial", "unknown", "maybe")]), (1 + F.col("o_custkey") % 6).cast("int"))
    expected = F.when(F.col("o_orderkey") % 7 == 0, "").otherwise(F.col("o_orderpriority"))
    observed, mismatch = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")), F.when(F.col("o_orderkey") % 4 == 0, " ").otherwise("differs")
    return table(spark, root, "orders").select(F.col("o_orderkey").alias("episode"), ingest.outcome_problems(status, expected, observed, mismatch).alias("problems"))


MANIFEST_SQL = f"""{TL}, {AUDIT_SQL}, ok AS (SELECT o_orderkey AS episode, level FROM ad WHERE len({FAILED_SQL}) = 0 AND level BETWEEN 1 AND 4),
  ms AS (SELECT tl.episode, level, CASE WHEN tl.episode % 2 = 0 THEN 'direct' ELSE 'native_recovery_pair' END AS adapter, segment, start_frame, end_frame, {_LABEL.format('(tl.episode + segment)')} AS label FROM tl JOIN ok USING (episode))"""


def recovery_manifest_rows(spark, root):
    """(episode, level, adapter, segment, start_frame, end_frame, label) of eligible pairs, through a manifest of JSON objects."""
    label = label_of(F.col("episode") + F.col("segment"))
    segments = timeline(spark, root).groupBy("episode").agg(F.sort_array(F.collect_list(F.struct("segment", "start_frame", "end_frame", label.alias("label")))).alias("segments"))
    fit = audits(spark, root).where((F.size(ingest.audit_failures(F.col("audit"))) == 0) & F.col("level").isin(*ingest.LEVELS)).select("episode", "level")
    entries = segments.join(fit, "episode").select(F.to_json(F.struct("episode", "level", F.when(F.col("episode") % 2 == 0, "direct").otherwise("native_recovery_pair").alias("adapter"), "segments")).alias("entry"))
    schema = "episode long, level long, adapter string, segments array<struct<segment: long, start_frame: long, end_frame: long, label: string>>"
    return entries.select(F.from_json("entry", schema, {"mode": "FAILFAST"}).alias("e")).select("e.episode", "e.level", "e.adapter", F.explode("e.segments").alias("s")).select("episode", "level", "adapter", "s.*")


@query("recovery_manifest", f"""{MANIFEST_SQL} SELECT episode, level, adapter, segment, start_frame, end_frame, label, {ROLE_SQL.format('label', 'segment')} AS role, {VERB_SQL.format('label')} AS verb, CASE WHEN segment = 0 THEN 'failed_no_effect' ELSE 'success' END AS previous_status, lag({VERB_SQL.format('label')}) OVER (PARTITION BY episode ORDER BY segment) AS previous_verb FROM ms""")
def recovery_manifest(spark, root):
    """SRC-19: a manifest of two kinds of entries as segment rows, each with the outcome before it."""
    rows = recovery_manifest_rows(spark, root)
    verb = ingest.verb_of(F.col("label"))
    return rows.select("episode", "level", "adapter", "segment", "start_frame", "end_frame", "label", ingest.role_of(F.col("label"), F.col("segment")).alias("role"), verb.alias("verb"), F.when(F.col("segment") == 0, "failed_no_effect").otherwise("success").alias("previous_status"), F.lag(verb).over(along("episode", "segment")).alias("previous_verb"))


@query("unit_directions", f"{VX}, n AS (SELECT *, sqrt(CAST(x[1] * x[1] + x[2] * x[2] + x[3] * x[3] AS DOUBLE)) AS len FROM vx) SELECT episode, frame, round_even(x[1] / len, 6) AS ux, round_even(x[2] / len, 6) AS uy, round_even(x[3] / len, 6) AS uz FROM n WHERE len > 1e-12")
def unit_directions(spark, root):
    """PRJ-02: directions of length one; those without a length are left out."""
    v = parts("x", (0, 1, 2))
    rows = vectors(spark, root).withColumn("len", norm(v)).where("len > 1e-12")
    return rows.select("episode", "frame", *[round_even(c / F.col("len"), 6).alias(n) for c, n in zip(v, ("ux", "uy", "uz"), strict=True)])


@query("gripper_anchor", f"{VX} SELECT episode, frame, (120000 - x[8]) / 240000.0::DOUBLE AS opening, x[8] / 1000000.0::DOUBLE / 0.103::DOUBLE AS aperture FROM vx")
def gripper_anchor(spark, root):
    """PRJ-08: raw gripper values between two fixed anchors, and as a share of the open span."""
    grip, closed, open_ = F.get("x", F.lit(7)), 120_000, -120_000
    return vectors(spark, root).select("episode", "frame", ((closed - grip) / (closed - open_)).alias("opening"), (grip / 1_000_000 / ingest.APERTURE).alias("aperture"))


@query("container_counts", f"""{EV}, s AS (SELECT episode, label AS topic, count(*) AS expected FROM ev GROUP BY ALL), f AS (SELECT episode, label AS topic, count(*) AS found FROM ev WHERE event_id % 40 <> 7 AND NOT (episode % 9 = 0 AND label = 'signup') GROUP BY ALL)
  SELECT CASE WHEN found IS NULL THEN 'missing_topic' WHEN expected IS NULL THEN 'unlisted_topic' ELSE 'count_differs' END AS code, topic, count(*) AS n, CAST(sum(expected - coalesce(found, 0)) AS BIGINT) AS lost FROM s FULL JOIN f USING (episode, topic) WHERE expected IS DISTINCT FROM found GROUP BY ALL""")
def container_counts(spark, root):
    """FLT-08: messages of each topic against the counts of a container's summary."""
    ev = events(spark, root)
    said = ev.groupBy("episode", F.col("label").alias("topic")).agg(F.count("*").alias("expected"))
    kept = ev.where("event_id % 40 <> 7 and not (episode % 9 = 0 and label = 'signup')").groupBy("episode", F.col("label").alias("topic")).agg(F.count("*").alias("found"))
    code = F.when(F.col("found").isNull(), "missing_topic").when(F.col("expected").isNull(), "unlisted_topic").otherwise("count_differs")
    both = said.join(kept, ["episode", "topic"], "full").where(~F.col("expected").eqNullSafe(F.col("found")))
    return both.groupBy(code.alias("code"), "topic").agg(F.count("*").alias("n"), F.sum(F.col("expected") - F.coalesce("found", F.lit(0))).alias("lost"))


@query("sorted_blocks", f"{TL} SELECT episode, segment, start_frame FROM tl ORDER BY episode, segment")
def sorted_blocks(spark, root):
    """TOP-02: all rows in the order of (episode, segment), by ranges and not in one task."""
    return timeline(spark, root).select("episode", "segment", "start_frame").orderBy("episode", "segment")


@query("first_rows", f"{TL} SELECT episode, segment, start_frame FROM tl ORDER BY episode, segment LIMIT 100")
def first_rows(spark, root):
    """TOP-03: the first hundred rows; each task keeps its own first hundred only."""
    return timeline(spark, root).select("episode", "segment", "start_frame").orderBy("episode", "segment").limit(100)


@query("row_slice", f"{TL}, b AS (SELECT episode, segment, row_number() OVER (ORDER BY episode, segment) - 1 AS block FROM tl) SELECT * FROM b WHERE block >= 250 AND block < 400")
def row_slice(spark, root):
    """TOP-03: rows 250 to 399 by their number over all episodes."""
    return block_numbers(timeline(spark, root).select("episode", "segment"), "episode", ["segment"]).where("block >= 250 and block < 400")


@query("utc_stamps", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS stamp FROM events")
def utc_stamps(spark, root):
    """STR-16: time stamps as ISO 8601 text of UTC."""
    return table(spark, root, "events").select("event_id", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")).alias("stamp"))


NESTED = f"""{TL}, d AS (SELECT episode, '{{"schema":"atomic","segments":[' || string_agg('{{"segment_index":' || segment || CASE WHEN n = 50 THEN ',"notes":{{"reasoning":"x \\"cot\\": y"}}' WHEN n = 49 THEN ',"cot":[1,2]' ELSE '' END || '}}', ',' ORDER BY segment) || ']}}' AS doc FROM tl GROUP BY episode)"""


def _nested(spark, root):
    note = F.when(F.col("n") == 50, ',"notes":{"reasoning":"x \\"cot\\": y"}').when(F.col("n") == 49, ',"cot":[1,2]').otherwise("")
    piece = F.concat(F.lit('{"segment_index":'), F.col("segment").cast("string"), note, F.lit("}"))
    pieces = timeline(spark, root).groupBy("episode").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("segment", piece.alias("p")))), lambda r: r["p"]), ",").alias("s"))
    return pieces.select("episode", F.concat(F.lit('{"schema":"atomic","segments":['), "s", F.lit("]}")).alias("doc"))


@query("walk_keys", f"{NESTED}, k AS (SELECT episode, t.key AS key FROM d, json_tree(doc) t WHERE try_cast(t.key AS BIGINT) IS NULL AND t.key IS NOT NULL) SELECT key, count(*) AS n, count(DISTINCT episode) AS episodes, key IN ('cot', 'chain_of_thought', 'reasoning', 'reasoning_steps', 'assistant_response') AS forbidden FROM k GROUP BY key")
def walk_keys(spark, root):
    """FLT-13, UDF-06: keys at every depth of JSON objects, as rows, and those that must not be there."""
    rows = _nested(spark, root).select("episode", F.explode(json_keys(F.col("doc"))).alias("key"))
    return rows.groupBy("key").agg(F.count("*").alias("n"), F.countDistinct("episode").alias("episodes"), F.first(F.col("key").isin("cot", "chain_of_thought", "reasoning", "reasoning_steps", "assistant_response")).alias("forbidden"))
