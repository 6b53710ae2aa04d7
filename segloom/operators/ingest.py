"""Adapters: how records of several sources become episodes of states, actions and segments. All column expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segloom.operators.windows import along

# Frames a second where a source has no clock, and the span of an open gripper in metres.
NOMINAL_FPS, APERTURE = 5, 0.103


def bridge_steps(steps: DataFrame) -> DataFrame:
    """Steps of a single arm with time, action and endpoint.

    steps: episode, frame, state (7), translation (3), rotation (3), aperture. action is translation, rotation and aperture; endpoint
    the first six components of state plus action, and the aperture; time that of NOMINAL_FPS.
    """
    action = F.concat("translation", "rotation", F.array("aperture"))
    moved = F.zip_with(F.slice("state", 1, 6), F.slice("action", 1, 6), lambda s, a: s + a)
    return steps.withColumn("action", action).withColumn("endpoint", F.concat(moved, F.array("aperture"))).withColumn("time", F.col("frame") / NOMINAL_FPS)


def flag_problems(steps: DataFrame) -> DataFrame:
    """(episode, code): first, last and terminal marks of steps that are not as they must be; frame counts from 0 to the last."""
    last = F.max("frame").over(Window.partitionBy("episode"))
    rows = steps.withColumn("_last", last)
    bad = rows.groupBy("episode").agg(
        F.bool_or(F.col("is_first") != (F.col("frame") == 0).cast("int")).alias("noncanonical_is_first"),
        F.bool_or(F.col("is_last") != (F.col("frame") == F.col("_last")).cast("int")).alias("noncanonical_is_last"),
        F.bool_or(~F.col("is_terminal").isin(0, 1)).alias("nonboolean_is_terminal"),
        F.bool_or((F.col("is_terminal") != 0) & (F.col("frame") < F.col("_last"))).alias("terminal_before_final_step"),
    )
    names = [c for c in bad.columns if c != "episode"]
    return bad.select("episode", F.explode(F.filter(F.array(*[F.when(F.col(n), n) for n in names]), lambda c: c.isNotNull())).alias("code"))


def aligned_streams(messages: DataFrame, clock: str, causal: Sequence[str], commands: Sequence[str] = (), tolerance: int = 250_000_000) -> DataFrame:
    """(episode, t, and a struct for each topic): messages of several topics on the clock of one.

    messages: episode, topic, t, id, value. A causal topic gives its latest message at or before a clock tick, of equal times that of
    the largest id; a command topic the nearest, of equal distance the earlier. A topic's struct has t, value, skew (tick less t) and
    code: missing if there is no message, late if the skew is above the tolerance. All topics share one exchange and sort.
    """
    tick = F.col("topic") == clock
    back = Window.partitionBy("episode").orderBy("t", F.when(tick, 1).otherwise(0), "id").rowsBetween(Window.unboundedPreceding, 0)
    on = Window.partitionBy("episode").orderBy("t", F.when(tick, 0).otherwise(1), "id").rowsBetween(0, Window.unboundedFollowing)
    seen = messages.where(F.col("topic").isin(clock, *causal, *commands))
    for topic in (*causal, *commands):
        message = F.when(F.col("topic") == topic, F.struct("t", "value"))
        before, after = F.last(message, ignorenulls=True).over(back), F.first(message, ignorenulls=True).over(on)
        seen = seen.withColumn(f"_{topic}", F.struct(before.alias("b"), after.alias("a")) if topic in commands else F.struct(before.alias("b"), F.lit(None).cast(messages.select(F.struct("t", "value").alias("s")).schema["s"].dataType).alias("a")))
    out = []
    for topic in (*causal, *commands):
        b, a = F.col(f"_{topic}.b"), F.col(f"_{topic}.a")
        near = F.when(b.isNull(), a).when(a.isNull() | (F.col("t") - b["t"] <= a["t"] - F.col("t")), b).otherwise(a)
        skew = F.col("t") - near["t"]
        code = F.when(near.isNull(), "missing").when(F.abs(skew) > tolerance, "late")
        out.append(F.struct(near["t"].alias("t"), near["value"].alias("value"), skew.alias("skew"), code.alias("code")).alias(topic))
    return seen.where(tick).select("episode", "t", "id", *out)


def endpose(frames: DataFrame) -> DataFrame:
    """(episode, frame, state, action, decision): 16-dimensional states of two arms, each action the next state.

    frames: episode, frame, left_pose (7), left_grip, right_pose (7), right_grip and extra (JSON text, may be null). The last row of
    an episode is its final observation: the last action, and no row of its own. decision: whether extra says so after frame 0.
    """
    state = F.concat("left_pose", F.array("left_grip"), "right_pose", F.array("right_grip"))
    decision = F.coalesce(F.get_json_object("extra", "$.new_decision_boundary") == "true", F.lit(False)) & (F.col("frame") > 0)
    rows = frames.select("episode", "frame", state.alias("state"), decision.alias("decision")).withColumn("action", F.lead("state").over(along()))
    return rows.where("action is not null")


def shard_inventory(infos: DataFrame) -> DataFrame:
    """(dataset, version, split, shard, expected, path) of each shard that a dataset's description lists.

    infos: dataset, info (JSON text with name, version and splits of name and shardLengths).
    """
    schema = "name string, version string, splits array<struct<name: string, shardLengths: array<string>, numBytes: string>>"
    splits = infos.select("dataset", F.from_json("info", schema).alias("i")).select("dataset", "i.name", "i.version", F.explode("i.splits").alias("s"))
    shards = splits.select("dataset", "name", "version", F.col("s.name").alias("split"), F.size("s.shardLengths").alias("of"), F.posexplode("s.shardLengths").alias("shard", "n"))
    path = F.format_string("%s-%s.tfrecord-%05d-of-%05d", "name", "split", "shard", "of")
    return shards.select("dataset", "version", "split", "shard", F.col("n").cast("long").alias("expected"), path.alias("path"))


def action_leaf(leaves: DataFrame) -> DataFrame:
    """(dataset, key, width, dtype): of each dataset's features the one that stands for its actions.

    leaves: dataset, key, width, dtype. Floating ones come first, then narrow ones, then by key; widths under one do not count.
    """
    usable = leaves.where("width > 0 and dtype in ('float32', 'float64', 'int32', 'int64', 'bool')")
    rank = F.struct((~F.col("dtype").startswith("float")).alias("a"), F.col("width").alias("b"), F.col("key").alias("c"))
    return usable.groupBy("dataset").agg(F.min_by(F.struct("key", "width", "dtype"), rank).alias("m")).select("dataset", "m.*")


def range_catalogue(keys: DataFrame, groups: DataFrame, block: int = 512) -> DataFrame:
    """(key, file, row_group) of each row group of a file whose [lo, hi] holds a key.

    keys: key; groups: file, row_group, lo, hi. Ranges are listed under the blocks of keys they meet, so the join has an equality.
    """
    spread = groups.withColumn("_block", F.explode(F.sequence(F.floor(F.col("lo") / block), F.floor(F.col("hi") / block))))
    return keys.withColumn("_block", F.floor(F.col("key") / block)).join(spread, "_block").where("key between lo and hi").select("key", "file", "row_group")


def split_of(key: Column, ranges: dict[str, tuple[int, int]]) -> Column:
    """Names of the half-open ranges that hold a key, as an array: none, one, or several if they overlap."""
    return F.filter(F.array(*[F.when((key >= lo) & (key < hi), n) for n, (lo, hi) in ranges.items()]), lambda c: c.isNotNull())


# Words of a label that tell the role of a recovery segment and the verb of its target.
ROLE_WORDS = {"verify_recovery": ("confirm", "verify", "observe"), "retry_failed_subtask": ("retry", "reattempt"), "repair_precondition": ("withdraw", "recenter", "relocalize", "clear", "restore", "regrasp")}
VERB_WORDS = {"recover:verify": ("confirm", "observe", "verify", "wait"), "recover:retry": ("retry", "reattempt", "press"), "recover:restore": ("restore", "regrasp", "recover")}


def _by_words(label: Column, words: dict[str, Sequence[str]], other: Column) -> Column:
    out = None
    for name, parts in words.items():
        hit = F.lower(label).rlike("|".join(parts))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(other)


def role_of(label: Column, index: Column) -> Column:
    """Role of a recovery segment by the words of its label, and by whether it is the first."""
    return _by_words(label, ROLE_WORDS, F.when(index == 0, "start_recovery").otherwise("resume_original_task"))


def verb_of(label: Column) -> Column:
    return _by_words(label, VERB_WORDS, F.lit("recover:reposition"))


def sentence_of(label: Column) -> Column:
    """A label's words as a sentence."""
    words = F.trim(F.regexp_replace(F.regexp_replace(label, "[-_]+", " "), " +", " "))
    return F.concat(F.upper(F.substring(words, 1, 1)), F.substring(words, F.lit(2), F.length(words)), F.lit("."))


# What a pair of a source failure and its recovery must have been audited for.
AUDITED = {"eligible_for_training": "true", "pair_audit_status": "passed", "source_failure_verified": "true", "source_failure_mode": "execution_failure", "recovery_success": "true", "new_decision_boundary": "true", "direct_continuation": "false"}
LEVELS, UNCLEAR = (1, 2, 3, 4), ("failed_no_effect", "failed_different", "partial")


def audit_failures(audit: Column) -> Column:
    """Names of the requirements that a map of audit values does not meet."""
    return F.filter(F.array(*[F.when(~F.coalesce(audit[k] == v, F.lit(False)), k) for k, v in AUDITED.items()]), lambda c: c.isNotNull())


def outcome_problems(status: Column, expected: Column, observed: Column, mismatch: Column) -> Column:
    """What an outcome lacks: a known status, the subtask expected, and for a failure what was seen and how it differs."""
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    failed = status.isin(*UNCLEAR)
    found = [F.when(~F.coalesce(status, F.lit("")).isin("success", "unknown", *UNCLEAR), "status"), F.when(blank(expected), "expected"), F.when(failed & blank(observed), "observed"), F.when(failed & blank(mismatch), "mismatch")]
    return F.filter(F.array(*found), lambda c: c.isNotNull())


#: Adapters by name: each takes a table of its source's rows and returns (episode, frame, time, state, action, profile).
ADAPTERS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def adapter(name: str):
    """Register an adapter."""

    def add(f: Callable[[DataFrame], DataFrame]):
        ADAPTERS[name] = f
        return f

    return add


def adapt(sources: dict[str, DataFrame]) -> DataFrame:
    """Rows of several sources, each by the adapter of its name; a name without one is an error."""
    unknown = sorted(set(sources) - set(ADAPTERS))
    if unknown or not sources:
        raise ValueError(f"no adapter for {unknown}" if unknown else "no sources")
    out = None
    for name, rows in sorted(sources.items()):
        part = ADAPTERS[name](rows).select("episode", "frame", "time", "state", "action", F.lit(name).alias("profile"))
        out = part if out is None else out.unionByName(part)
    return out


@adapter("bridge")
def _bridge(rows: DataFrame) -> DataFrame:
    return bridge_steps(rows)


@adapter("endpose")
def _endpose(rows: DataFrame) -> DataFrame:
    return endpose(rows).withColumn("time", F.col("frame") / NOMINAL_FPS)
