"""Segmentation of dual-arm state sequences into actions, from states and times alone.

Pure functions of one episode's arrays; plans run them over grouped rows. A state is two arms of position (3), quaternion (w, x, y,
z) and gripper.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np

from segloom.operators.kernels import filter_evidence, pair_arms, persistent_runs, split_long

ARMS = {"left": 0, "right": 8}


@dataclass(frozen=True)
class Limits:
    """Times in seconds, speeds in units a second, lengths in units, angles in radians."""

    # The durations, scales and thresholds of the state-only rules.
    period: float = 0.02
    segment: float = 0.10
    pause: float = 0.06
    merge: float = 0.10
    window: float = 0.18
    phase: float = 0.10
    bridge: float = 0.04
    search: float = 0.18
    confirm: float = 0.06
    sync: float = 0.08
    joint_segment: float = 0.04
    before_grip: float = 0.60
    after_grip: float = 0.40
    smooth: float = 0.10
    hold: float = 0.16
    translation_scale: float = 0.15
    rotation_scale: float = 1.00
    grip_scale: float = 1.00
    pause_energy: float = 0.50
    grip_rate: float = 0.50
    grip_delta: float = 0.08
    move_speed: float = 0.08
    vertical_speed: float = 0.05
    turn_speed: float = 0.40
    still_translation: float = 0.003
    still_path: float = 0.008
    still_rotation: float = 0.02
    vertical_ratio: float = 0.62
    vertical_length: float = 0.005
    turn_dominance: float = 1.6
    turn_window: float = 0.05
    move_window: float = 0.03
    grip_change: float = 0.01


def runs_of(mask: np.ndarray) -> list[tuple[int, int]]:
    """First and last index of each run of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], np.asarray(mask, np.int8), [0]])))
    return [(int(a), int(b) - 1) for a, b in zip(edge[::2], edge[1::2], strict=True)]


def unit_quaternions(q: np.ndarray) -> np.ndarray:
    return q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-12)


def turns(q: np.ndarray) -> np.ndarray:
    """Angle from each quaternion to the next."""
    return 2 * np.arccos(np.clip(abs((q[1:] * q[:-1]).sum(1)), 0, 1))


def rotation_vectors(q: np.ndarray) -> np.ndarray:
    """Logarithm of each next quaternion times the conjugate of the one before, the short way round."""
    w1, v1, w0, v0 = q[1:, :1], q[1:, 1:], q[:-1, :1], -q[:-1, 1:]
    w = w1 * w0 - (v1 * v0).sum(1, keepdims=True)
    v = w1 * v0 + w0 * v1 + np.cross(v1, v0)
    v, w = np.where(w < 0, -v, v), abs(w)
    length = np.linalg.norm(v, axis=1, keepdims=True)
    return np.where(length > 1e-12, v / np.maximum(length, 1e-12) * 2 * np.arctan2(length, w), 2 * v)


def smooth_same(x: np.ndarray, width: int) -> np.ndarray:
    """Moving mean with zeros beyond the ends."""
    width = min(width, len(x))
    return np.convolve(x, np.full(width, 1 / width), "same") if width > 1 else x.copy()


class Arm:
    """What the rules look at: motion, energy, phase scores and windowed statistics of one arm."""

    def __init__(self, name: str, states: np.ndarray, t: np.ndarray, limits: Limits, frames: Callable[..., int]):
        at = ARMS[name]
        self.name, self.t, self.limits, self.frames = name, t, limits, frames
        self.position, self.grip = states[:, at : at + 3], states[:, at + 7]
        q = unit_quaternions(states[:, at + 3 : at + 7])
        n, dt = len(states), np.diff(t)
        low, high = np.percentile(self.grip, [5, 95])
        self.unit = np.clip((self.grip - low) / (high - low), 0, 1) if high - low > 1e-9 else np.zeros(n)
        still = np.zeros((1, 3))
        velocity = np.concatenate([still, np.diff(self.position, axis=0) / dt[:, None]])
        spin = np.linalg.norm(np.concatenate([still, rotation_vectors(q) / dt[:, None]]), axis=1)
        self.rate = np.concatenate([[0], np.diff(self.unit) / dt])
        speed = np.linalg.norm(velocity, axis=1)
        energy = speed / limits.translation_scale + spin / limits.rotation_scale + abs(self.rate) / limits.grip_scale
        self.energy = smooth_same(energy, frames(limits.smooth))
        up = velocity[:, 2]
        self.scores = {
            "still": 1 / (1 + energy / limits.pause_energy),
            "move": np.linalg.norm(velocity[:, :2], axis=1) / limits.move_speed,
            "turn": np.maximum(spin / limits.turn_speed - 0.35 * speed / limits.move_speed, 0),
            "lift": np.maximum(up, 0) / limits.vertical_speed,
            "lower": np.maximum(-up, 0) / limits.vertical_speed,
        }
        self.path = np.concatenate([[0], np.cumsum(np.linalg.norm(np.diff(self.position, axis=0), axis=1))])
        self.rotation = np.concatenate([[0], np.cumsum(turns(q))])

    def evidence(self, frame: int, kind: tuple[str, str], type_: str, strength: float, strong: bool) -> dict:
        return {"frame": int(frame), "kind": kind, "types": (type_,), "strength": float(strength), "strong": strong, "arms": (self.name,)}

    def pauses(self) -> list[dict]:
        """The quietest frame of each long enough run of low energy that does not touch an end."""
        calm, out = self.limits.pause_energy, []
        for a, b in runs_of(self.energy < calm):
            if b - a + 1 >= self.frames(self.limits.pause) and a > 1 and b < len(self.energy) - 2:
                f = a + int(self.energy[a : b + 1].argmin())
                out.append(self.evidence(f, ("pause", "still"), "state_motion_energy_valley", 2 + max(0, (calm - self.energy[f]) / calm), True))
        return out

    def grips(self) -> list[dict]:
        """The quietest frames before and after each opening or closing."""
        events = []
        for direction, sign in (("increase", 1), ("decrease", -1)):
            on, against = sign * self.rate >= self.limits.grip_rate, sign * self.rate <= -self.limits.grip_rate
            for a, b in runs_of(~on):
                if a > 0 and b < len(on) - 1 and b - a < self.frames(self.limits.bridge) and not against[a : b + 1].any():
                    on[a : b + 1] = True
            events += [(a, b, direction) for a, b in runs_of(on) if abs(self.unit[b] - self.unit[max(0, a - 1)]) >= self.limits.grip_delta]
        out = []
        for a, b, direction in sorted(events, key=lambda e: e[0]):
            first = max(1, a - self.frames(self.limits.before_grip))
            spans = (("pre", first, max(first + 1, a + 1)), ("post", b, min(len(self.energy), b + self.frames(self.limits.after_grip) + 1)))
            for when, lo, hi in spans:
                f = lo + int(self.energy[lo:hi].argmin())
                out.append(self.evidence(f, ("gripper", direction), f"{when}_gripper_{direction}_stabilization", 2.5 + max(0, self.limits.pause_energy - self.energy[f]), True))
        return out

    def phases(self) -> list[dict]:
        """Changes between lasting phases, each moved to where the new one sets in."""
        limits, n = self.limits, len(self.t)
        half = max(1, self.frames(limits.window, 3) // 2)
        lo, hi = np.maximum(np.arange(n) - half, 0), np.minimum(np.arange(n) + half, n - 1)
        step = self.position[hi] - self.position[lo]
        length, path, turned = np.linalg.norm(step, axis=1), self.path[hi] - self.path[lo], self.rotation[hi] - self.rotation[lo]
        upright = abs(step[:, 2]) / np.maximum(length, 1e-12)
        still = (length < limits.still_translation) & (path < limits.still_path) & (turned < limits.still_rotation)
        vertical = (abs(step[:, 2]) >= limits.vertical_length) & (upright >= limits.vertical_ratio)
        turning = turned / limits.turn_window > limits.turn_dominance * np.maximum(length / limits.move_window, 1e-6)
        label = np.select([still, vertical & (step[:, 2] > 0), vertical, turning], ["still", "lift", "lower", "turn"], "move")
        cuts = [0, *(np.flatnonzero(label[1:] != label[:-1]) + 1).tolist(), n]
        runs = persistent_runs([(str(label[a]), a, b - 1) for a, b in zip(cuts, cuts[1:], strict=False)], self.frames(limits.phase))
        out = []
        for (before, _, end), (now, start, _) in zip(runs, runs[1:], strict=False):
            contrast = abs(upright[start] - upright[end]) + abs(turned[start] - turned[end]) / limits.turn_window
            found = self.onset(self.scores[now], start, 0.45 if now == "still" else 0.25)
            item = self.evidence(found, ("phase", now), "persistent_state_phase_transition", 1 + min(contrast, 2), False)
            out.append(item | {"types": ("persistent_state_phase_transition", "successor_trend_onset"), "before": before})
        return out

    def onset(self, score: np.ndarray, nominal: int, low: float, sustained: float = 0.55) -> int:
        """The earliest frame near `nominal` from which the score is high and stays so, after lower ones; else `nominal`."""
        reach, confirm = self.frames(self.limits.search), self.frames(self.limits.confirm, 2)
        for f in range(max(1, nominal - reach), min(len(score) - 1, nominal + reach) + 1):
            after, before = score[f : f + confirm], score[max(0, f - confirm) : f]
            if len(after) > 1 and score[f] >= low and after.mean() >= sustained and (after >= low).mean() >= 0.67 and (before.mean() < sustained or after.mean() >= before.mean() + 0.15):
                return f
        return nominal

    def action(self, a: int, b: int) -> str:
        """Label of frames a to b: the first gripper change that overlaps, else the kind of motion."""
        change = np.diff(self.grip)
        for s, e in runs_of(abs(change) >= self.limits.grip_change):
            if s <= b and e + 1 >= a:
                return "gripper_decrease" if self.grip[e + 1] < self.grip[s] else "gripper_increase"
        step = self.position[b] - self.position[a]
        length, turned, flat = np.linalg.norm(step), self.rotation[b] - self.rotation[a], np.linalg.norm(step[:2])
        # The limits for the label of a whole segment.
        if length < 0.005 and turned < 0.03:
            return "still"
        if abs(step[2]) > max(0.015, 0.60 * length) and abs(step[2]) > flat:
            return "lift" if step[2] > 0 else "lower"
        return "turn" if turned / 0.10 > 4.5 * max(length / 0.08, 1e-6) else "move"


def spans(cuts: Sequence[int], n: int) -> list[tuple[int, int]]:
    """Segments [a, b] that cover 0..n-1, cut at the boundaries strictly inside."""
    edge = [0, *sorted({c for c in cuts if 0 < c < n}), n]
    return [(a, b - 1) for a, b in zip(edge, edge[1:], strict=False)]


def still_groups(still: Sequence[bool], n: Sequence[int], least: int) -> list[list[int]]:
    """Segments by the motion they belong to: leading still ones with the next motion, others with the one before; those after the
    last motion alone if they have `least` frames together, or if there is no motion."""
    moves = [i for i, s in enumerate(still) if not s]
    if not moves:
        return [list(range(len(still)))] if still else []
    starts = [0, *moves[1:]]
    tail = list(range(moves[-1] + 1, len(still)))
    alone = bool(tail) and sum(n[i] for i in tail) >= least
    edge = [*starts, tail[0] if alone else len(still), *([len(still)] if alone else [])]
    return [list(range(a, b)) for a, b in zip(edge, edge[1:], strict=False)]


def segment_episode(states: np.ndarray, times: np.ndarray | None = None, limits: Limits = Limits()) -> list[dict]:
    """Segments of an episode: start, end, left, right, label, relation and the raw segments each one holds.

    Evidence of each arm (pauses, gripper changes, lasting phases) is clustered, matched between the arms, and cut at; segments are
    labelled by their motion, and those where both arms are still join their neighbours.
    """
    states = np.asarray(states, float)
    if states.ndim != 2 or states.shape[1] != 16 or not len(states) or not np.isfinite(states).all():
        raise ValueError("states must be a finite array of at least one 16-dimensional row")
    t = np.arange(len(states)) * limits.period if times is None else np.asarray(times, float)
    if len(t) != len(states) or (np.diff(t) <= 0).any():
        raise ValueError("times must rise, one for each state")
    period = float(np.median(np.diff(t))) if len(t) > 1 else limits.period
    frames = lambda seconds, least=1: max(least, int(round(seconds / period)))
    arms = {name: Arm(name, states, t, limits, frames) for name in ARMS}
    found = {name: filter_evidence([*arm.pauses(), *arm.grips(), *arm.phases()], len(t), frames(limits.segment), frames(limits.merge)) for name, arm in arms.items()}
    joint = filter_evidence(pair_arms(found["left"], found["right"], frames(limits.sync), frames(limits.joint_segment)), len(t), frames(limits.joint_segment), 0)
    raw = spans([e["frame"] for e in joint], len(t))
    labels = [tuple(arm.action(a, b) for arm in arms.values()) for a, b in raw]
    out = []
    for members in still_groups([pair == ("still", "still") for pair in labels], [b - a + 1 for a, b in raw], frames(limits.hold)):
        left, right = labels[next((i for i in members if labels[i] != ("still", "still")), members[0])]
        moving = [x for x in (left, right) if x != "still"]
        label = "+".join(dict.fromkeys(moving)) or "still"
        relation = ("both_still", "left_only" if left != "still" else "right_only", "dual_same_phase" if left == right else "dual_different_phase")[len(moving)]
        out.append({"start": raw[members[0]][0], "end": raw[members[-1]][1], "left": left, "right": right, "label": label, "relation": relation, "members": members})
    return out


@dataclass(frozen=True)
class Proposals:
    """Limits of propose(): seconds, a quantile and a cosine."""

    # Defaults of the review proposals.
    shortest: float = 0.25
    longest: float = 3.0
    smooth: float = 0.10
    direction: float = 0.18
    pause_quantile: float = 0.25
    cosine: float = 0.35


def smooth_edge(x: np.ndarray, width: int) -> np.ndarray:
    """Moving mean of an odd width, with the end values repeated beyond the ends."""
    width = min(width, len(x) if len(x) % 2 else len(x) - 1)
    if len(x) <= 2 or width <= 1:
        return x.copy()
    return np.convolve(np.pad(x, width // 2, mode="edge"), np.full(width, 1 / width), "valid")


def propose(states: np.ndarray, times: np.ndarray, grippers: Sequence[int] = (), limits: Proposals = Proposals()) -> list[int]:
    """Boundaries of an episode of any layout, ends included: changes of activity, of direction and of the grippers, merged within
    half a shortest segment, and split where a segment would be too long."""
    states, times = np.asarray(states, float), np.asarray(times, float)
    n, dt = len(states), float(np.median(np.diff(times)))
    shortest = max(2, round(limits.shortest / dt))
    longest = max(shortest + 1, round(limits.longest / dt))
    width = max(3, round(limits.smooth / dt)) | 1
    side = max(2, round(limits.direction / dt))
    step = np.diff(states, axis=0)
    velocity = step / np.diff(times)[:, None]
    scale = np.quantile(abs(velocity), 0.90, axis=0)
    used = scale[scale > 1e-8]
    velocity = velocity / np.where(scale > 1e-8, scale, np.median(used) if len(used) else 1.0)
    energy = np.linalg.norm(velocity, axis=1) / np.sqrt(states.shape[1])
    energy = smooth_edge(np.concatenate([energy[:1], energy]), width)
    active = energy > max(1.5 * np.quantile(energy, limits.pause_quantile), 0.35 * np.quantile(energy, 0.65), 1e-6)
    turn = np.flatnonzero(active[1:] != active[:-1]) + 1
    found = [(int(f), 1 + abs(energy[f] - energy[f - 1])) for f in turn]
    sums = np.concatenate([np.zeros((1, states.shape[1])), np.cumsum(velocity, axis=0)])
    at = np.arange(side, len(velocity) - side + 1)
    before, after = (sums[at] - sums[at - side]) / side, (sums[at + side] - sums[at]) / side
    a, b = np.linalg.norm(before, axis=1), np.linalg.norm(after, axis=1)
    able = (a >= 0.10) & (b >= 0.10)
    cosine = np.where(able, (before * after).sum(1) / np.where(able, a * b, 1), 1)
    found += [(int(f), 1 - c) for f, c in zip(at[cosine < limits.cosine], cosine[cosine < limits.cosine], strict=True)]
    for g in grippers:
        size = abs(step[:, g])
        if (size > 1e-8).any():
            on = size >= max(np.quantile(size[size > 1e-8], 0.65), 1e-4)
            found += [(min(f, n - 1), 2.0) for a_, b_ in runs_of(on) for f in (a_, b_ + 1)]
    cuts, last, best = [], None, None
    for f, s in sorted(found, key=lambda e: e[0]):
        if last is not None and f - last <= max(1, shortest // 2):
            best = max(best, (f, s), key=lambda e: e[1])
        else:
            cuts += [best[0]] if best else []
            best = (f, s)
        last = f
    cuts += [best[0]] if best else []
    return split_long(sorted({0, n, *[f for f in cuts if shortest <= f <= n - shortest]}), energy, longest, shortest)
