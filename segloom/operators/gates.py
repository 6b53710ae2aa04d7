"""Text gates: forbidden claims, intentions that labels contradict, citations."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Claims that a reasoning text must not make, the headings it must not begin with, its words, and the tokenizer for these.
FORBIDDEN = (
    r"\bguide_action\b",
    r"\bground truth\b",
    r"\bfuture (?:frame|image|state|endpoint)\b",
    r"\bsegment endpoint\b",
    r"\bfrozen target\b",
    r"\bsource reasoning\b",
    r"\bstyle brief\b",
    r"<think>|</think>",
    r"therefore, the next action should be",
    r"\b(?:authoritative|supervision|supervisory)\b",
    r"\bfixed (?:command|action|target)\b",
    r"\b(?:task arm constraint|single-arm mode|multi-arm mode|single-arm constraint|multi-arm constraint)\b",
    r"\b(?:task|arm) constraints?\b",
    r"\b(?:left|right) arm (?:is )?(?:designated|constrained)\b",
    r"\bsole active manipulator\b",
    r"\bcontrol system dictates\b",
    r"\btherefore[:,.]?\s*(?:left:[a-z_]+,\s*right:[a-z_]+)?[.!]?\s*$",
    r"\bleft:[a-z_]+,\s*right:[a-z_]+\b",
    r"\b(?:state vector|state channels|rotation components)\b",
    r"\b(?:control logic|control sequence|command specifies|plan requires)\b",
    r"\bTEACHER_ONLY\b",
    r"\b(?:annotation|annotations|dataset provenance|evidence_ids|claim_evidence)\b",
    r"\b(?:observer card|critic verdict|style label)\b",
)
HEADINGS = ("Evidence:", "Analysis:", "Reasoning:", "Style:")
WORDS = {"normal": (55, 150), "recovery": (55, 230), "style": (70, 190)}
WORD = r"[\p{L}\p{N}_'-]*[\p{L}\p{N}_][\p{L}\p{N}_'-]*"

# Phrases that name an action, words of intention before them, and words that take an intention back.
TERMS = {
    "move": r"(?:move|reposition|translate|shift|travel|advance)",
    "turn": r"(?:turn|rotate|reorient)",
    "lift": r"(?:lift|raise|ascend|move upward|travel upward)",
    "lower": r"(?:lower|descend|move downward|travel downward)",
    "open_gripper": r"(?:open (?:its |the )?gripper|actuate (?:its |the )?gripper (?:to|into) (?:an? )?open(?: configuration| state)?)",
    "close_gripper": r"(?:close (?:its |the )?gripper|actuate (?:its |the )?gripper (?:to|into) (?:a )?closed(?: configuration| state)?)",
    "oscillate": r"(?:oscillate|shake|perform (?:an )?alternating motion)",
    "still": r"(?:(?:remain|stay|be) (?:completely )?(?:still|stationary|idle|inactive|fixed)|keep (?:its |the )?(?:pose|position)(?: unchanged)?)",
}
MODAL = r"(?:must|should|will|needs? to|has to|is required to|is expected to|is scheduled to|is planned to|is going to)(?: now)?"
LEAD = r"(?:now )?(?:(?:execute|perform|make|initiate|begin|continue|undergo|carry out) )?(?:(?:a|an|the) )?"
SUBJECT = r"(?:arm|gripper|end[- ]effector)"
BETWEEN = r"(?:\s+(?:now|currently|therefore|consequently))?\s+"
HYPOTHETICAL = r"\b(?:whether|if|might|could|would|may)\b[^,.!?;:]*$"
NEGATED = r"\b(?:not|no)\b[^,.!?;:]{0,16}$"
ALTERNATIVE = r"\b(?:alternative|option|hypothesis|might|could|would)\b"
REJECTED = r"\b(?:reject(?:ed)?|ruled out|unnecessary|invalid|no evidence|does not need|do not need|not needed)\b"
OPPOSITE = {"lift": "lower", "lower": "lift", "open_gripper": "close_gripper", "close_gripper": "open_gripper"}
CLASH_WITH_STILL = ("move", "lift", "lower", "oscillate")

_INTENT = {
    (arm, action): re.compile(rf"\b(?:the )?{arm} {SUBJECT}(?!['’]s)\b{BETWEEN}{MODAL}\s+{LEAD}{terms}\b|\b{MODAL}\s+{LEAD}{terms}\s+(?:the )?{arm} {SUBJECT}\b", re.IGNORECASE)
    for arm in ("left", "right")
    for action, terms in TERMS.items()
}


def body_problems(text: Column, kind: str = "normal") -> Column:
    """Names of the rules that a reasoning text breaks: words, heading, and forbidden_<place of the pattern>; null text breaks words."""
    low, high = WORDS[kind]
    body = F.trim(F.coalesce(text, F.lit("")))
    words = F.regexp_count(body, F.lit(WORD))
    heading = F.exists(F.array(*[F.lit(h) for h in HEADINGS]), lambda h: F.startswith(body, h))
    found = [F.when(~words.between(low, high), "words"), F.when(heading, "heading"), *[F.when(body.rlike(f"(?i){p}"), f"forbidden_{i}") for i, p in enumerate(FORBIDDEN)]]
    return F.filter(F.array(*found), lambda c: c.isNotNull())


def sentences(text: str) -> list[str]:
    return re.split(r"(?<=[.!?])\s+", text)


def takes_back(sentence: str, a: int, b: int) -> bool:
    """Whether an intention at a:b of a sentence is hypothetical, negated, or an alternative that the sentence goes on to reject."""
    before, after = sentence[:a], sentence[b:]
    return bool(re.search(HYPOTHETICAL, before) or re.search(NEGATED, before) or (re.search(ALTERNATIVE, before) and re.search(REJECTED, after)))


def intended(text: str, arm: str) -> set[str]:
    """Actions that sentences of the text plainly assign to an arm."""
    found = set()
    for sentence in sentences(text):
        low = sentence.lower()
        found |= {action for action in TERMS if any(not takes_back(low, *m.span()) for m in _INTENT[arm, action].finditer(sentence))}
    return found


def contradictions(text: str, left: str, right: str) -> list[str]:
    """arm:action of each plain intention that the arm's label contradicts.

    A still arm has any intention to move against it; others that of the opposite action, and, if they change the pose along a line,
    that of staying still.
    """
    out = []
    for arm, label in (("left", left), ("right", right)):
        wants = intended(text or "", arm)
        against = wants - {"still"} if label == "still" else wants & ({OPPOSITE.get(label)} | ({"still"} if label in CLASH_WITH_STILL else set()))
        out += [f"{arm}:{a}" for a in sorted(against)]
    return out


def action_contradictions(text: Column, left: Column, right: Column) -> Column:
    """contradictions() of each row; texts without a word of intention skip the patterns."""

    @F.pandas_udf("array<string>")
    def run(t: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([contradictions(*r) for r in zip(t, a, b, strict=True)])

    return F.when(text.rlike(f"(?i){MODAL}") & text.rlike(r"(?i)\b(left|right) (arm|gripper|end)"), run(text, left, right)).otherwise(F.array().cast("array<string>"))


def citations_ok(cited: Column, allowed: Column, quote: Column, body: Column) -> Column:
    """Whether all cited ids are allowed and the quote stands in the body."""
    return (F.size(F.array_except(cited, allowed)) == 0) & F.contains(body, quote)
