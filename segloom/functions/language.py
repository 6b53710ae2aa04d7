"""Text about actions: clauses, subtasks, closing sentences, numbers and states as JSON. Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The clause of each action of one arm, and of two still arms.
CLAUSES = {
    "still": "keep the {arm} arm stationary",
    "move": "move the {arm} arm to the demonstrated target pose",
    "turn": "rotate the {arm} end effector to the demonstrated target orientation",
    "lift": "lift the {arm} arm toward the demonstrated target pose",
    "lower": "lower the {arm} arm toward the demonstrated target pose",
    "open_gripper": "open the {arm} gripper",
    "close_gripper": "close the {arm} gripper",
    "oscillate": "oscillate the {arm} arm along the demonstrated motion",
}
BOTH_STILL = "keep both arms stationary at the demonstrated terminal pose"

# How the clause of a single arm, and of an arm of two, must begin, and the limits of words for a label.
STARTS = {"move": "Move", "turn": "Rotate", "lift": "Lift", "lower": "Lower", "open_gripper": "Open the gripper", "close_gripper": "Close the gripper", "still": "Hold"}
LABEL_WORDS, GROUP_WORDS = 45, 70

# Openings that tell how the previous subtask went.
OPENINGS = {
    "success": "The previous atomic subtask was completed successfully.",
    "partial": "The previous atomic subtask was only partially completed.",
    "failed_no_effect": "The previous atomic subtask was not completed successfully. The intended effect did not occur.",
    "failed_different": "The previous atomic subtask was not completed successfully. The execution produced a different result from the intended effect.",
}

# Substitutions that make openings comparable, in this order, and the words that are left.
OPENING_RULES = (
    (r"\b(left|right)\b", "arm"),
    (r"\b(open|closed|close|opening|closing)\b", "gripper_state"),
    (r"\b(move|moves|moving|moved|reposition|repositions|repositioning|shift|shifts|shifting|translate|translates|translating)\b", "motion"),
    (r"\b(turn|turns|turning|rotate|rotates|rotating|rotation)\b", "rotation"),
    (r"\b(lift|lifts|lifting|raise|raises|raising|upward)\b", "vertical"),
    (r"\b(lower|lowers|lowering|descend|descends|descending|downward)\b", "vertical"),
    (r"\b\d+(?:\.\d+)?\b", "number"),
)


def lookup(mapping: dict[str, str], key: Column) -> Column:
    """Value of a key, null for others."""
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[key]


def arm_clause(arm: str, action: Column) -> Column:
    return lookup({k: v.format(arm=arm) for k, v in CLAUSES.items()}, action)


def pair_clause(left: Column, right: Column) -> Column:
    """What both arms do, in one clause; null for an unknown action."""
    a, b, still = arm_clause("left", left), arm_clause("right", right), F.lit("still")
    return (
        F.when((left == still) & (right == still), BOTH_STILL)
        .when(left == still, F.concat(b, F.lit(" while keeping the left arm stationary")))
        .when(right == still, F.concat(a, F.lit(" while keeping the right arm stationary")))
        .otherwise(F.concat(a, F.lit(" and "), b))
    )


def sentence(clause: Column) -> Column:
    return F.concat(F.upper(F.substring(clause, 1, 1)), F.substring(clause, F.lit(2), F.length(clause)), F.lit("."))


def pair_verb(left: Column, right: Column) -> Column:
    return F.concat(F.lit("left:"), left, F.lit(", right:"), right)


def sub_task(left: Column, right: Column) -> Column:
    return sentence(pair_clause(left, right))


def closing(left: Column, right: Column, chunks: Column) -> Column:
    """The sentence that a reasoning text must end with."""
    unit = F.when(chunks == 1, "action chunk").otherwise("action chunks")
    return F.concat(F.lit("Therefore, the next action should be: "), pair_clause(left, right), F.lit(", executed for "), chunks.cast("string"), F.lit(" "), unit, F.lit(" ("), pair_verb(left, right), F.lit(")."))


def number(micro: Column) -> Column:
    """A whole number of millionths as a decimal number of four places at most, half to even, without a negative zero."""
    n = F.bround(micro / 100, 0).cast("long")
    digits = F.lpad(F.abs(n).cast("string"), 5, "0")
    short = F.when(F.length(digits) > 5, digits).otherwise(F.abs(n).cast("string"))
    text = F.when(F.abs(n) >= 10_000, short).otherwise(digits)
    whole, part = F.substring(text, F.lit(1), F.length(text) - 4), F.regexp_replace(F.right(text, F.lit(4)), "0+$", "")
    return F.concat(F.when(n < 0, "-").otherwise(""), whole, F.lit("."), F.when(part == "", "0").otherwise(part))


def numbers(x: Column) -> Column:
    """An array of millionths as a JSON list."""
    return F.concat(F.lit("["), F.array_join(F.transform(x, number), ", "), F.lit("]"))


def named_state(x: Column, prefix: str = "") -> Column:
    """A state of two arms (millionths, 16) as JSON by name; `prefix` is put before the names, as delta_."""
    arm = lambda name, at: F.concat(F.lit(f'"{name}": {{"{prefix}xyz": '), numbers(F.slice(x, at + 1, 3)), F.lit(f', "{prefix}quat_wxyz": '), numbers(F.slice(x, at + 4, 4)), F.lit(f', "{prefix}gripper": '), number(F.get(x, F.lit(at + 7))), F.lit("}"))
    return F.concat(F.lit("{"), arm("left", 0), F.lit(", "), arm("right", 8), F.lit("}"))


def normal_opening(text: Column) -> Column:
    """The first sentence with actions, arms and numbers replaced by their kinds."""
    first = F.lower(F.trim(F.element_at(F.split(text, r"(?<=[.!?])\s+"), 1)))
    for pattern, to in OPENING_RULES:
        first = F.regexp_replace(first, pattern, to)
    return F.array_join(F.regexp_extract_all(first, F.lit("([a-z0-9_']+)"), F.lit(1)), " ")


def json_object(text: Column) -> Column:
    """The JSON object of a reply: without code fences, or the first balanced one that ends the text; null if there is none."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(text), r"(?i)^```(?:json)?\s*", ""), r"\s*```$", "")
    starts = F.filter(F.sequence(F.lit(1), F.greatest(F.length(bare), F.lit(1))), lambda i: F.substring(bare, i, F.lit(1)) == "{")
    tails = F.transform(starts, lambda i: F.substring(bare, i, F.length(bare)))
    listed = lambda t: F.try_parse_json(F.concat(F.lit("["), t, F.lit("]")))  # noqa: E731  # the parser ignores what follows a value, but not in a list
    return F.get(F.filter(tails, lambda t: listed(t).isNotNull() & F.variant_get(listed(t), "$[1]", "string").isNull()), F.lit(0))
