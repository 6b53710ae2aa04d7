"""Segmentation against its SQL on random trajectories, recoveries and profiles against rules written anew, and gates of text."""

import itertools
import random
import re

import duckdb
import numpy as np
import pytest

from segloom.operators import gates, profiles
from segloom.operators.kernels import coarsen
from segloom.operators.segmentation import ARMS, Limits, Proposals, propose, segment_episode
from segloom.plans.sequential import segment_sql


def trajectory(rng, n=160):
    """Two arms that rest, move, turn, rise and grip in turn, in whole millionths."""
    out = np.zeros((n, 16))
    for at in (0, 8):
        position, turn, grip = rng.normal(size=3) * 0.1, 0.0, float(rng.integers(0, 2))
        i = 0
        while i < n:
            k, kind = int(rng.integers(4, 30)), rng.choice(["rest", "move", "turn", "up", "grip"])
            speed = rng.normal(size=3) * 0.004
            goal = 1 - grip
            for j in range(min(k, n - i)):
                if kind == "move":
                    position = position + speed * (1, 1, 0.1)
                elif kind == "up":
                    position = position + (0, 0, abs(speed[0]) * 2 * (1 if goal else -1))
                elif kind == "turn":
                    turn += 0.02
                elif kind == "grip":
                    grip += (goal - grip) * 0.3
                noise = rng.normal(size=3) * 1e-5
                out[i, at : at + 8] = [*(position + noise), np.cos(turn / 2), 0, np.sin(turn / 2), 0, grip]
                i += 1
    return np.rint(out * 1e6).astype(np.int64)


def test_segments_are_those_of_the_sql():
    rng = np.random.default_rng(1)
    episodes = {k: trajectory(rng, int(rng.integers(30, 220))) for k in range(40)}
    db = duckdb.connect()
    db.execute("create table v (episode bigint, frame bigint, x bigint[])")
    db.executemany("insert into v values (?, ?, ?)", [(k, i, row.tolist()) for k, x in episodes.items() for i, row in enumerate(x)])
    found = db.execute(segment_sql("vx AS (SELECT * FROM v)")).fetchall()
    want = sorted((r[0], r[1], *r[2:]) for r in found)
    got = [(k, i, s["start"], s["end"], s["left"], s["right"], s["label"], s["relation"], len(s["members"])) for k, x in episodes.items() for i, s in enumerate(segment_episode(x / 1e6))]
    assert sorted(got) == want and len(got) > 200


def test_segments_of_odd_episodes():
    for n in (1, 2, 9):
        still = np.zeros((n, 16))
        still[:, [3, 11]] = 1
        assert [(s["start"], s["end"], s["label"]) for s in segment_episode(still)] == [(0, n - 1, "still")]
    with pytest.raises(ValueError):
        segment_episode(np.zeros((0, 16)))
    with pytest.raises(ValueError):
        segment_episode(np.full((4, 16), np.nan))


def naive_normalized(steps, least=8):
    """Still steps into their neighbours and equal neighbours together, one change at a time."""
    steps = [dict(s) for s in steps]
    still = lambda s: (s["left"], s["right"]) == ("still", "still")
    size = lambda s: s["end"] - s["start"] + 1
    moves = [i for i, s in enumerate(steps) if not still(s)]
    if not moves:
        return [{**steps[0], "end": steps[-1]["end"]}]
    tail = steps[moves[-1] + 1 :]
    keep = tail and sum(map(size, tail)) >= least
    out = []
    for i in moves:
        out.append({**steps[i], "start": 0 if i == moves[0] else steps[i]["start"]})
    for a, b in zip(out, out[1:], strict=False):
        a["end"] = b["start"] - 1
    out[-1]["end"] = tail[0]["start"] - 1 if keep else steps[-1]["end"]
    if keep:
        out.append({**tail[0], "end": tail[-1]["end"]})
    merged = True
    while merged:
        merged = False
        for i in range(len(out) - 1):
            a, b = out[i : i + 2]
            if (a["left"], a["right"]) == (b["left"], b["right"]) and (min(size(a), size(b)) < least or a["group"] == b["group"]):
                out[i : i + 2] = [{**a, "end": b["end"]}]
                merged = True
                break
    return out


def test_normalized_against_single_changes():
    rng = random.Random(2)
    for _ in range(500):
        steps, at, group = [], 0, 0
        for _ in range(rng.randint(1, 12)):
            n = rng.choice([1, 3, 7, 8, 9, 20])
            group += rng.random() < 0.5
            left, right = rng.choice([("still", "still"), ("move", "still"), ("move", "lift")])
            steps.append({"start": at, "end": at + n - 1, "left": left, "right": right, "group": group})
            at += n
        keys = ("start", "end", "left", "right")
        got = profiles.normalized(steps)
        assert [[s[k] for k in keys] for s in got] == [[s[k] for k in keys] for s in naive_normalized(steps)]
        assert [x[0] for s in got for x in s["spans"]] == list(range(len(steps)))


def test_recovery_steps_hold_the_policy():
    rng = np.random.default_rng(3)
    settled = 0
    for _ in range(25):
        x = trajectory(rng, 150) / 1e6
        decisions = rng.random(149) < 0.05
        steps, problems = profiles.recovery_steps(x[:-1], x[1:], 0.02 * np.arange(149), decisions)
        assert steps[0]["start"] == 0 and steps[-1]["end"] == 148 and all(a["end"] + 1 == b["start"] for a, b in itertools.pairwise(steps))
        if not problems:
            settled += 1
            assert all(s[arm] == profiles.motion_label(x[:-1], x[s["end"] + 1], s["start"], s["end"], arm) for s in steps for arm in ARMS)
            assert profiles.step_problems(steps) == []
    assert settled > 10


def test_step_problems():
    step = lambda a, b, left="move", right="still": {"start": a, "end": b, "left": left, "right": right}
    assert profiles.step_problems([]) == ["none"]
    assert profiles.step_problems([step(0, 9), step(11, 20, "lift")]) == ["gap"]
    assert profiles.step_problems([step(0, 9, "still"), step(10, 19)]) == ["still_before_end"]
    assert profiles.step_problems([step(0, 9), step(10, 12, "still")]) == ["short_hold"]
    assert profiles.step_problems([step(0, 9), step(10, 12)]) == ["short_repeat"]


def test_coarse_keeps_changes_holds_and_notes():
    rng = random.Random(5)
    for _ in range(200):
        steps, at = [], 0
        for _ in range(rng.randint(1, 10)):
            n = rng.choice([4, 16, 31, 40, 70])
            steps.append({"start": at, "end": at + n - 1, "left": rng.choice(["move", "lift"]), "right": "still"})
            at += n
        notes = [rng.randrange(at) for _ in range(rng.randint(0, 2))]
        got = profiles.coarse(steps, notes)
        cuts = [s["start"] for s in steps] + [at]
        kept = {cuts[min(range(len(cuts)), key=lambda k: (abs(cuts[k] - n), k))] for n in notes} | {b["start"] for a, b in itertools.pairwise(steps) if a["left"] != b["left"]}
        assert kept - {at} <= {s["start"] for s in got} and [p for s in got for p in s["parts"]] == steps
        best = min(cost(c, cuts) for r in range(len(steps)) for c in itertools.combinations(range(1, len(steps)), r) if {cuts.index(k) for k in kept} <= {0, len(steps), *c})
        mine = cost([cuts.index(s["start"]) for s in got[1:]], cuts)
        assert mine == pytest.approx(best)


def cost(inner, cuts):
    edge, total = [0, *inner, len(cuts) - 1], 0
    for a, b in itertools.pairwise(edge):
        n = cuts[b] - cuts[a]
        if n > 128 and b - a > 1:
            return float("inf")
        total += 0.8 + 4 * (max(0, 32 - n) / 16) ** 2 + (max(0, n - 64) / 32) ** 2
    return total


def test_coarsen_of_a_single_long_piece():
    assert coarsen([300])[0] == [0] and coarsen([])[0] == []


def test_rotations():
    rng = np.random.default_rng(6)
    angles = rng.normal(size=(40, 3))

    def about(axis, t):
        c, s, m = np.cos(t), np.sin(t), np.eye(3)
        i, j = [k for k in range(3) if k != axis]
        m[i, i] = m[j, j] = c
        m[i, j], m[j, i] = (s, -s) if axis == 1 else (-s, c * 0 + s)
        return m

    m = np.stack([about(2, c) @ about(1, b) @ about(0, a) for a, b, c in angles])
    assert np.allclose(abs((profiles.matrix_quaternions(m) * profiles.euler_quaternions(angles)).sum(1)), 1)
    half_turns = np.stack([np.diag([1.0, -1, -1]), np.diag([-1.0, 1, -1]), np.diag([-1.0, -1, 1]), np.eye(3)])
    assert np.allclose(abs(profiles.matrix_quaternions(half_turns)), np.array([[0, 1, 0, 0], [0, 0, 1, 0], [0, 0, 0, 1], [1, 0, 0, 0]]))


def test_continuous_signs_are_those_of_a_loop():
    rng = np.random.default_rng(7)
    for _ in range(200):
        q = rng.integers(-1, 2, size=(12, 4)).astype(float)
        want = q.copy()
        for i in range(1, len(q)):
            if want[i - 1] @ want[i] < 0:
                want[i] = -want[i]
        assert (profiles.continuous(q) == want).all()
    assert profiles.continuous(np.zeros((0, 4))).shape == (0, 4)


def test_profiles():
    rng = np.random.default_rng(8)
    x = trajectory(rng, 140) / 1e6
    t = 0.1 * np.arange(140)
    bridge = profiles.native_steps("bridge", np.concatenate([x[:, :3], rng.normal(size=(140, 3)) * 0.01, x[:, 7:8]], 1), t, x[:, :7])
    assert bridge[0]["start"] == 0 and bridge[-1]["end"] == 139 and all(s["right"] == "still" for s in bridge)
    joints = np.concatenate([np.cumsum(rng.normal(size=(140, 6)) * 0.01, 0), x[:, 7:8], np.cumsum(rng.normal(size=(140, 6)) * 0.01, 0), x[:, 15:16]], 1)
    m = np.tile(np.eye(4), (140, 1, 1))
    m[:, :3, 3] = x[:, :3]
    poses = {"left": m, "right": m}
    for steps in (profiles.native_steps("yam", joints, t, joints), profiles.native_steps("yam", joints, t, joints, poses, [40], True)):
        assert steps[0]["start"] == 0 and steps[-1]["end"] == 139 and all((s["left"], s["right"]) != profiles.STILL for s in steps[:-1])
    bad = m.copy()
    bad[3, 0, 0] = 2
    for call in (lambda: profiles.native_steps("none", joints, t, joints), lambda: profiles.native_steps("yam", joints, t, joints, {"left": bad, "right": m}), lambda: profiles.native_steps("bridge", x[:1, :7], t[:1], x[:1, :7])):
        with pytest.raises(ValueError):
            call()
    stamps = (t * 1e9).astype(np.int64)
    steps = profiles.reference_steps(x, stamps, origin=(7, -100))
    assert [s["end"] + 1 for s in steps[:-1]] == [s["start"] for s in steps[1:]] and steps[-1]["end"] == 138
    for s in steps:
        assert np.allclose(s["guide"][:3], x[s["end"] + 1, :3] - x[s["start"], :3]) and s["chunks"] == -(-(s["end"] - s["start"] + 1) // 8)
        assert s["source_target"] == 7 + s["end"] + 1 and s["target_time"] == pytest.approx((stamps[s["end"] + 1] + 100) / 1e9)
    with pytest.raises(ValueError):
        profiles.reference_steps(x * 2, stamps)


def test_regripped():
    states = np.array([[0.5], [0.5], [0.9], [0.9]])
    targets = np.array([[0.5], [0.5], [0.9], [0.5]])
    step = lambda label, a, b: [{"start": a, "end": b, "left": label, "right": "still"}]
    change = lambda label, a, b: profiles.regripped(step(label, a, b), states, targets, {"left": 0}, None)[0]["left"]
    assert change("open_gripper", 0, 1) == "move" and change("close_gripper", 0, 2) == "open_gripper" and change("open_gripper", 0, 2) == "open_gripper" and change("lift", 0, 2) == "lift"
    assert profiles.meant("gripper_decrease") == "close_gripper" and profiles.meant("gripper_decrease", False) == "open_gripper" and profiles.meant("move", False) == "move"


def naive_proposals(states, times, limits):
    """Boundaries of propose() without grippers, frame by frame."""
    n, dims = states.shape
    dt = float(np.median(np.diff(times)))
    least = max(2, round(limits.shortest / dt))
    width = max(3, round(limits.smooth / dt)) | 1
    side = max(2, round(limits.direction / dt))
    velocity = [[(states[i + 1][k] - states[i][k]) / (times[i + 1] - times[i]) for k in range(dims)] for i in range(n - 1)]
    scale = [np.quantile([abs(v[k]) for v in velocity], 0.9) for k in range(dims)]
    scale = [s if s > 1e-8 else np.median([u for u in scale if u > 1e-8] or [1.0]) for s in scale]
    velocity = [[v / s for v, s in zip(row, scale, strict=True)] for row in velocity]
    raw = [np.sqrt(sum(v * v for v in row)) / np.sqrt(dims) for row in velocity]
    raw = [raw[0], *raw]
    energy = [sum(raw[min(max(i + d, 0), n - 1)] for d in range(-(width // 2), width // 2 + 1)) / width for i in range(n)]
    level = max(1.5 * np.quantile(energy, limits.pause_quantile), 0.35 * np.quantile(energy, 0.65), 1e-6)
    found = [(i, 1 + abs(energy[i] - energy[i - 1])) for i in range(1, n) if (energy[i] > level) != (energy[i - 1] > level)]
    for f in range(side, n - 1 - side + 1):
        a = [sum(velocity[j][k] for j in range(f - side, f)) / side for k in range(dims)]
        b = [sum(velocity[j][k] for j in range(f, f + side)) / side for k in range(dims)]
        x, y = np.linalg.norm(a), np.linalg.norm(b)
        if x >= 0.1 and y >= 0.1 and (c := np.dot(a, b) / (x * y)) < limits.cosine:
            found.append((f, 1 - c))
    return sorted(found), energy, least


def test_proposals_are_cut_at_what_a_plain_scan_finds():
    rng = np.random.default_rng(9)
    for _ in range(20):
        x = np.cumsum(rng.normal(size=(80, 5)) * np.repeat(rng.choice([0.0, 0.1, 1.0], 8), 10)[:, None], 0)
        t = 0.05 * np.arange(80)
        found, energy, least = naive_proposals(x, t, Proposals())
        clusters = []
        for f, s in found:
            if clusters and f - clusters[-1][-1][0] <= max(1, least // 2):
                clusters[-1].append((f, s))
            else:
                clusters.append([(f, s)])
        inner = [max(c, key=lambda e: e[1])[0] for c in clusters]
        want = {0, 80, *[f for f in inner if least <= f <= 80 - least]}
        got = propose(x, t)
        assert want <= set(got) and all(b - a <= max(least + 1, round(3.0 / 0.05)) for a, b in itertools.pairwise(got))


def plain_contradictions(text, left, right):
    """The rule of gates.contradictions by a scan over sentences, arms and actions."""
    out = []
    for arm, label in (("left", left), ("right", right)):
        wants = set()
        for sentence in gates.sentences(text):
            for action, words in gates.TERMS.items():
                for pattern in (rf"\b(?:the )?{arm} {gates.SUBJECT}(?!['’]s)\b{gates.BETWEEN}{gates.MODAL}\s+{gates.LEAD}{words}\b", rf"\b{gates.MODAL}\s+{gates.LEAD}{words}\s+(?:the )?{arm} {gates.SUBJECT}\b"):
                    for m in re.finditer(pattern, sentence, re.I):
                        before, after = sentence[: m.start()].lower(), sentence[m.end() :].lower()
                        if not (re.search(gates.HYPOTHETICAL, before) or re.search(gates.NEGATED, before) or (re.search(gates.ALTERNATIVE, before) and re.search(gates.REJECTED, after))):
                            wants.add(action)
        for w in sorted(wants):
            opposite = {("lift", "lower"), ("lower", "lift"), ("open_gripper", "close_gripper"), ("close_gripper", "open_gripper")}
            if (label == "still" and w != "still") or (label, w) in opposite or (w == "still" and label in ("move", "lift", "lower", "oscillate")):
                out.append(f"{arm}:{w}")
    return out


def test_contradictions():
    cases = {
        "The left arm should now lift.": ["left:lift"],
        "The left arm should not lift.": [],
        "If it slips, the left arm will lift.": ["left:lift"],
        "See whether the left arm will lift.": [],
        "The option is that the left arm will lift, which is not needed.": [],
        "We must now rotate the right arm.": ["right:turn"],
        "The left arm's wrist will lift.": [],
        "The left arm will remain still.": [],
        "The right gripper needs to close its gripper! The left arm is going to open the gripper.": ["left:open_gripper", "right:close_gripper"],
        "": [],
    }
    for text, want in cases.items():
        assert gates.contradictions(text, "still", "still") == want == plain_contradictions(text, "still", "still")
    assert gates.contradictions("The left arm will lower.", "lift", "still") == ["left:lower"] and gates.contradictions("The left arm will remain still.", "turn", "still") == []
    rng = random.Random(10)
    parts = ["the left arm", "the right gripper", "left end-effector", "should", "must now", "is going to", "lift", "lower", "remain still", "open its gripper", "not", "if", "another option", "is unnecessary", ".", "!", ",", "may", "perform a", "turn"]
    for _ in range(3000):
        text = " ".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))
        labels = [rng.choice(list(gates.TERMS)) for _ in range(2)]
        assert gates.contradictions(text, *labels) == plain_contradictions(text, *labels)


def test_body_problems(spark):
    body = "word " * 60
    texts = [body, "short", None, "Analysis: " + body, body + "by ground truth", body + "Therefore: left:move, right:still.", "w " * 151]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.p for r in rows.select("i", gates.body_problems(rows.t).alias("p")).collect()}
    assert got == {0: [], 1: ["words"], 2: ["words"], 3: ["heading"], 4: ["forbidden_1"], 5: ["forbidden_16", "forbidden_17"], 6: ["words"]}


def test_limits_are_a_configuration():
    from segloom.operators.reasoning import configured, load_driver

    assert configured(Limits(), {"segment": 1}).segment == 1
    for values, error in (({"none": 1}, KeyError), ({"segment": "x"}, TypeError), ({"segment": True}, TypeError)):
        with pytest.raises(error):
            configured(Limits(), values)
    assert load_driver("json", ["dumps"])["dumps"]([1]) == "[1]"
    with pytest.raises(TypeError):
        load_driver("json", ["dumps", "absent"])
