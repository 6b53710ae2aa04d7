"""Segmentation by kind of trajectory: native recoveries, single-arm, dual-arm poses, joints only, and measured references.

Pure functions of one episode's arrays, on top of segmentation.py. A step is a dict with start, end (inclusive), left and right.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

import numpy as np

from segloom.operators.kernels import coarsen
from segloom.operators.segmentation import ARMS, Arm, Limits, Proposals, propose, segment_episode, spans, still_groups

STILL = ("still", "still")
# Fewest rows of an action, limits of trajectories whose poses are measured, and of proposals from joints.
ROWS = 8
MEASURED = Limits(segment=0.3, merge=0.25, phase=0.3, joint_segment=0.2, still_translation=0.006, still_path=0.015, still_rotation=0.05, grip_change=0.12, grip_delta=0.12)
JOINTS = Proposals(shortest=0.65, longest=4.0, smooth=0.15, direction=0.3)
GRIP, COMMAND, NEVER = 0.12, 0.05, 10.0


def unit_direction(v: Sequence[float]) -> np.ndarray:
    """v scaled to length one; an error if it has none."""
    v = np.asarray(v, float)
    length = np.linalg.norm(v)
    if not length > 1e-12:
        raise ValueError("a direction needs a length")
    return v / length


def euler_quaternions(angles: np.ndarray) -> np.ndarray:
    """(w, x, y, z) of rotations about the fixed x, y and z axes in turn."""
    (a, b, c), (p, q, r) = np.cos(np.asarray(angles, float).T / 2), np.sin(np.asarray(angles, float).T / 2)
    return np.stack([a * b * c + p * q * r, p * b * c - a * q * r, a * q * c + p * b * r, a * b * r - p * q * c], 1)


def matrix_quaternions(m: np.ndarray) -> np.ndarray:
    """(w, x, y, z) of rotation matrices, each from the largest of its four squared components."""
    m = np.asarray(m, float)
    x, y, z = m[:, 0, 0], m[:, 1, 1], m[:, 2, 2]
    squares = np.stack([1 + x + y + z, 1 + x - y - z, 1 - x + y - z, 1 - x - y + z], 1)
    s, t = m - m.transpose(0, 2, 1), m + m.transpose(0, 2, 1)
    w = [s[:, 2, 1], s[:, 0, 2], s[:, 1, 0]]
    table = np.empty((len(m), 4, 4))  # row k: the components times four times the k-th one
    for k in range(4):
        table[:, k, k] = squares[:, k]
    for k in range(3):
        table[:, 0, k + 1] = table[:, k + 1, 0] = w[k]
    for i, j in ((0, 1), (0, 2), (1, 2)):
        table[:, i + 1, j + 1] = table[:, j + 1, i + 1] = t[:, i, j]
    q = table[np.arange(len(m)), squares.argmax(1)]
    return q / np.linalg.norm(q, axis=1, keepdims=True)


def poses_valid(m: np.ndarray) -> bool:
    """Whether all 4 x 4 matrices are homogeneous and rotate without stretching."""
    r = m[:, :3, :3]
    return bool(np.allclose(m[:, 3], [0, 0, 0, 1], atol=1e-5) and np.allclose(r @ r.transpose(0, 2, 1), np.eye(3), atol=1e-3))


def continuous(q: np.ndarray) -> np.ndarray:
    """Quaternions with the signs that make neighbours agree; a zero product starts anew with the sign given."""
    product = (q[1:] * q[:-1]).sum(1)
    flips = np.concatenate([[0], np.cumsum(product < 0)])
    restart = np.maximum.accumulate(np.concatenate([[0], np.where(product == 0, np.arange(1, len(q)), 0)])) if len(q) else flips
    odd = (flips - flips[restart]) % 2 if len(q) else flips
    return np.where(odd[:, None] == 1, -q, q)


def arms_of(poses: dict[str, np.ndarray], grips: dict[str, np.ndarray]) -> np.ndarray:
    """16-dimensional states of two arms from their pose matrices and grippers."""
    sides = []
    for name in ARMS:
        m = np.asarray(poses[name], float).reshape(-1, 4, 4)
        if not poses_valid(m):
            raise ValueError(f"{name}: not a rigid pose")
        sides += [m[:, :3, 3], continuous(matrix_quaternions(m[:, :3, :3])), np.asarray(grips[name], float)[:, None]]
    return np.concatenate(sides, 1)


# Native recoveries


def motion_label(states: np.ndarray, last: np.ndarray, a: int, b: int, arm: str, limits: Limits = Limits()) -> str:
    """Action of rows a to b by the way from the first state to the state after the last row."""
    path = np.vstack([states[a : b + 1], last[None]])
    side = Arm(arm, path, np.arange(len(path), dtype=float), limits, lambda seconds, least=1: least)
    change = side.grip[-1] - side.grip[0]
    # The limits for labels of native recoveries.
    if abs(change) >= max(0.08, 4 * limits.grip_change):
        return "close_gripper" if change < 0 else "open_gripper"
    step = side.position[-1] - side.position[0]
    length, flat = np.linalg.norm(step), np.linalg.norm(step[:2])
    if side.path[-1] < 0.005 and side.rotation[-1] < 0.03 and np.ptp(side.grip) < 0.08:
        return "still"
    if abs(step[2]) > max(0.015, 0.60 * length) and abs(step[2]) > flat:
        return "lift" if step[2] > 0 else "lower"
    return "turn" if side.rotation[-1] / 0.10 > 4.5 * max(length / 0.08, 1e-6) else "move"


def rows_of(step: dict) -> int:
    return step["end"] - step["start"] + 1


def pair_of(step: dict) -> tuple[str, str]:
    return step["left"], step["right"]


def joined(steps: Sequence[dict], least: int = ROWS) -> list[dict]:
    """Steps after neighbours of one pair joined, if either is under `least` rows or both come of one decision (`group`)."""
    out: list[dict] = []
    for step in steps:
        step = {**step, "spans": list(step["spans"])}
        while out and pair_of(out[-1]) == pair_of(step) and (min(rows_of(out[-1]), rows_of(step)) < least or out[-1].get("group") == step.get("group")):
            before = out.pop()
            step = {**before, "end": step["end"], "spans": before["spans"] + step["spans"]}
        out.append(step)
    return out


def normalized(steps: Sequence[dict], least: int = ROWS) -> list[dict]:
    """Steps without still ones but a terminal hold, and without short ones beside their like; `spans` keeps what each was made of."""
    steps = [{**s, "spans": s.get("spans", [(i, s["start"], s["end"], s["left"], s["right"])])} for i, s in enumerate(steps)]
    held = []
    for members in still_groups([pair_of(s) == STILL for s in steps], [rows_of(s) for s in steps], least):
        owner = next((steps[i] for i in members if pair_of(steps[i]) != STILL), steps[members[0]])
        held.append({**owner, "start": steps[members[0]]["start"], "end": steps[members[-1]]["end"], "spans": [x for i in members for x in steps[i]["spans"]]})
    return joined(held, least)


def step_problems(steps: Sequence[dict], least: int = ROWS) -> list[str]:
    """Codes of what the action policy forbids: a gap, an empty step, a still step before the end, a short terminal hold, and short
    neighbours of one pair."""
    found = set()
    for i, s in enumerate(steps):
        before = steps[i - 1] if i else None
        if s["start"] != (before["end"] + 1 if before else 0):
            found.add("gap")
        if rows_of(s) < 1:
            found.add("empty")
        if pair_of(s) == STILL:
            found.add("still_before_end" if i < len(steps) - 1 else "ok" if rows_of(s) >= least else "short_hold")
        if before and pair_of(before) == pair_of(s) and min(rows_of(before), rows_of(s)) < least:
            found.add("short_repeat")
    return sorted(found - {"ok"}) if steps else ["none"]


def recovery_steps(states: np.ndarray, actions: np.ndarray, times: np.ndarray, decisions: Sequence[bool], limits: Limits = Limits()) -> tuple[list[dict], list[str]]:
    """Steps of a native recovery and their problems.

    Boundaries are those of the state-only segmentation and the decisions. Steps are labelled by their motion, normalized, and
    labelled anew for the rows they then hold, until nothing changes.
    """
    states, actions = np.asarray(states, float), np.asarray(actions, float)
    starts = [0, *(i for i, d in enumerate(decisions) if d and i > 0)]
    cuts = {s["start"] for s in segment_episode(states, times, limits)} | set(starts)

    def labelled(steps: Sequence[dict]) -> list[dict]:
        return [{**s, **{arm: motion_label(states, actions[s["end"]], s["start"], s["end"], arm, limits) for arm in ARMS}} for s in steps]

    raw = [{"start": a, "end": b, "group": int(np.searchsorted(starts, a, "right")) - 1} for a, b in spans(cuts, len(states))]
    steps = normalized(labelled(raw))
    for _ in range(len(raw) + 1):
        if step_problems(steps):
            break
        now = normalized(labelled(steps))
        if [(s["start"], s["end"], *pair_of(s)) for s in now] == [(s["start"], s["end"], *pair_of(s)) for s in steps]:
            return now, step_problems(now)
        steps = now
    return steps, step_problems(steps) or ["no_fixpoint"]


# Profiles

# What a gripper change means where closing makes the value smaller.
MEANING = {"gripper_decrease": "close_gripper", "gripper_increase": "open_gripper"}


def meant(action: str, decrease_closes: bool = True) -> str:
    """Action with a gripper change named by its purpose."""
    action = MEANING.get(action, action)
    swap = {"close_gripper": "open_gripper", "open_gripper": "close_gripper"}
    return action if decrease_closes else swap.get(action, action)


def pose_steps(states: np.ndarray, times: np.ndarray | None, limits: Limits) -> list[dict]:
    return [{"start": s["start"], "end": s["end"], **{arm: meant(s[arm]) for arm in ARMS}} for s in segment_episode(states, times, limits)]


def joint_steps(states: np.ndarray, times: np.ndarray, limits: Proposals = JOINTS) -> list[dict]:
    """Steps of two arms of six joints and a gripper each, labelled by what joints and grippers do."""
    half = states.shape[1] // 2
    cuts = propose(states, times, (half - 1, 2 * half - 1), limits)
    out = []
    for a, b in zip(cuts, cuts[1:], strict=False):
        step = {"start": int(a), "end": int(b) - 1}
        for arm, at in (("left", 0), ("right", half)):
            part = states[a:b, at : at + half]
            change, path, reach = part[-1, -1] - part[0, -1], abs(np.diff(part[:, :-1], axis=0)).sum(0).max(initial=0), np.ptp(part[:, -1])
            # Joint paths and gripper ranges that count as motion.
            step[arm] = "close_gripper" if change < -GRIP else "open_gripper" if change > GRIP else "move" if path > 0.04 or reach > 0.08 else "still"
        out.append(step)
    return out


def regripped(steps: Sequence[dict], states: np.ndarray, targets: np.ndarray, grips: dict[str, int], poses: np.ndarray | None) -> list[dict]:
    """Steps with gripper labels corrected that both the measured change and the commanded one contradict."""
    out = []
    for s in steps:
        s = dict(s)
        for arm, g in grips.items():
            measured = states[s["end"], g] - states[s["start"], g]
            commanded = targets[s["end"], g] - states[s["start"], g]
            sign = {"open_gripper": 1, "close_gripper": -1}.get(s[arm])
            if sign is None or not (sign * measured < GRIP and sign * commanded < COMMAND):
                continue
            if abs(measured) >= GRIP:
                s[arm] = "open_gripper" if measured > 0 else "close_gripper"
            elif poses is not None:
                s[arm] = Arm(arm, poses, np.arange(len(poses), dtype=float), replace(Limits(), grip_change=NEVER), lambda seconds, least=1: least).action(s["start"], s["end"])
            else:
                s[arm] = "move"
        out.append(s)
    return out


def absorbed(steps: Sequence[dict], least: int = ROWS) -> list[dict]:
    """Steps with still ones in their neighbours; `hold` marks a terminal still step and `parts` what a step is made of."""
    out = []
    groups = still_groups([pair_of(s) == STILL for s in steps], [rows_of(s) for s in steps], least)
    for k, members in enumerate(groups):
        owner = next((steps[i] for i in members if pair_of(steps[i]) != STILL), steps[members[0]])
        item = {**owner, "start": steps[members[0]]["start"], "end": steps[members[-1]]["end"], "parts": [steps[i] for i in members]}
        out.append(item | {"hold": pair_of(item) == STILL and k == len(groups) - 1})
    return out


def coarse(steps: Sequence[dict], notes: Sequence[int] = ()) -> list[dict]:
    """Steps grouped for the least total loss of coarsen(); a change of either action, a terminal hold and the boundary nearest to a
    note (the first of equals) are kept."""
    cuts = [s["start"] for s in steps] + [steps[-1]["end"] + 1]
    kept = {min(range(len(cuts)), key=lambda k: (abs(cuts[k] - n), k)) for n in notes}
    kept |= {i for i in range(1, len(steps)) if pair_of(steps[i]) != pair_of(steps[i - 1]) or steps[i].get("hold")}
    edge = sorted({0, len(steps), *kept})
    out = []
    for a, b in zip(edge, edge[1:], strict=False):
        group = np.array(coarsen([rows_of(s) for s in steps[a:b]])[0])
        for g in np.unique(group):
            part = [steps[a + i] for i in np.flatnonzero(group == g)]
            out.append({**part[0], "end": part[-1]["end"], "parts": [p for s in part for p in s.get("parts", [s])]})
    return out


def native_steps(profile: str, states: np.ndarray, times: np.ndarray, targets: np.ndarray, poses: dict[str, np.ndarray] | None = None, notes: Sequence[int] = (), lengths: bool = False) -> list[dict]:
    """Steps of a native trajectory by its profile.

    `bridge`: one arm of position, Euler angles and gripper; the other arm is taken as inactive. `yam`: two arms of six joints and a
    gripper; with pose matrices these are segmented, else the joints. Gripper labels that measurement and command contradict are
    corrected, short equal neighbours joined in one pass from the left, and still steps of `yam` absorbed. `lengths` groups steps by
    length (yam only).
    """
    states, times, targets = np.asarray(states, float), np.asarray(times, float), np.asarray(targets, float)
    if len(states) < 2 or not np.isfinite(states).all() or (np.diff(times) <= 0).any():
        raise ValueError("a trajectory has two finite states or more, at rising times")
    if profile == "bridge":
        idle = np.tile([0, 0, 0, 1.0, 0, 0, 0, 0], (len(states), 1))
        dual = np.concatenate([states[:, :3], euler_quaternions(states[:, 3:6]), states[:, 6:7], idle], 1)
        steps, grips = pose_steps(dual, times, Limits()), {"left": 6}
    elif profile == "yam":
        dual = arms_of(poses, {"left": states[:, 6], "right": states[:, 13]}) if poses else None
        steps, grips = pose_steps(dual, times, MEASURED) if poses else joint_steps(states, times), {"left": 6, "right": 13}
    else:
        raise ValueError(f"unknown profile {profile!r}")
    out: list[dict] = []
    for s in regripped(steps, states, targets, grips, dual):
        if out and pair_of(out[-1]) == pair_of(s) and min(rows_of(out[-1]), rows_of(s)) < ROWS:
            out[-1]["end"] = s["end"]
        else:
            out.append(dict(s))
    if profile == "yam":
        out = absorbed(out)
    if lengths:
        if profile != "yam":
            raise ValueError("lengths apply to two arms")
        out = coarse(out, notes)
    return out


def reference_steps(measured: np.ndarray, stamps: np.ndarray, lengths: bool = True, origin: tuple[int, int] | None = None) -> list[dict]:
    """Steps of a trajectory whose actions are its own next states, with guide, chunks and frames of the source.

    All observations are segmented, and the steps then share the transitions, one fewer: the last observation has none. `guide` is
    the state after a step's last row less its first. With origin (first frame kept and start stamp of an uncropped source, stamps in
    nanoseconds), source_start, source_target, start_time and target_time refer to that source.
    """
    measured, stamps = np.array(measured, float), np.asarray(stamps, np.int64)
    if measured.ndim != 2 or measured.shape[1] != 16 or len(measured) < 3 or not np.isfinite(measured).all() or len(stamps) != len(measured) or (np.diff(stamps) <= 0).any():
        raise ValueError("a reference has three finite 16-dimensional observations or more, at rising stamps")
    for at in (3, 11):
        q = measured[:, at : at + 4]
        size = np.linalg.norm(q, axis=1, keepdims=True)
        if (abs(size - 1) > 1e-3).any():
            raise ValueError("a quaternion is not of unit length")
        measured[:, at : at + 4] = continuous(q / size)
    n = len(measured) - 1
    steps = [{**s, "end": min(s["end"], n - 1)} for s in pose_steps(measured, (stamps - stamps[0]) / 1e9, MEASURED) if s["start"] < n]
    steps = absorbed(steps)
    steps = coarse(steps) if lengths else steps
    for s in steps:
        a, b = s["start"], s["end"]
        s |= {"guide": np.round(measured[b + 1] - measured[a], 8), "chunks": -(-rows_of(s) // 8)}
        if origin:
            first, zero = origin
            s |= {"source_start": first + a, "source_target": first + b + 1, "start_time": (stamps[a] - zero) / 1e9, "target_time": (stamps[b + 1] - zero) / 1e9}
    return steps
