"""Sequential rules against plain statements of them, on random and edge cases."""

import itertools
import math
import random

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from segloom.operators import kernels
from segloom.operators.gates import contradictions
from segloom.operators.segmentation import propose, runs_of, segment_episode, smooth_edge, spans, still_groups

timelines = st.lists(st.tuples(st.integers(1, 20), st.sampled_from("ab")), min_size=1, max_size=12)


def restart_merge(lengths, labels, least):
    """Scan from the left, join one group, start over."""
    groups = [[i] for i in range(len(lengths))]
    while True:
        for g, group in enumerate(groups):
            if sum(lengths[i] for i in group) < least:
                for other in (g - 1, g + 1):
                    if 0 <= other < len(groups) and labels[groups[other][0]] == labels[group[0]]:
                        a, b = sorted((g, other))
                        groups[a : b + 1] = [groups[a] + groups[b]]
                        break
                else:
                    continue
                break
        else:
            return [next(g for g, group in enumerate(groups) if i in group) for i in range(len(lengths))]


@given(timelines)
def test_merge_short(rows):
    lengths, labels = [r[0] for r in rows], [r[1] for r in rows]
    assert kernels.merge_short(lengths, labels, 8) == restart_merge(lengths, labels, 8)


@given(timelines)
def test_fold_short_only_joins_equal_neighbours(rows):
    lengths, labels = [r[0] for r in rows], [r[1] for r in rows]
    groups = kernels.fold_short(lengths, labels, 8)
    assert groups[0] == 0 and all(b - a in (0, 1) for a, b in itertools.pairwise(groups))
    for i in range(1, len(rows)):
        assert groups[i] != groups[i - 1] or labels[i] == labels[i - 1]


def cost(parts):
    return sum(0.8 + 4 * (max(0, 32 - n) / 16) ** 2 + (max(0, n - 64) / 32) ** 2 for n in parts)


@pytest.mark.parametrize("lengths", [[32], [64], [128], [129], [200], [7, 8, 9], [20, 20, 20, 20], [1] * 10, [130, 5], [60, 70, 10, 50]])
def test_coarsen_is_the_cheapest_grouping(lengths):
    groups, found = kernels.coarsen(lengths)
    best = math.inf
    for cuts in itertools.product([0, 1], repeat=len(lengths) - 1):
        parts, sizes = [[lengths[0]]], []
        for n, c in zip(lengths[1:], cuts, strict=True):
            parts.append([n]) if c else parts[-1].append(n)
        if all(sum(p) <= 128 or len(p) == 1 for p in parts):
            best = min(best, cost([sum(p) for p in parts]))
        del sizes
    assert found == pytest.approx(best)
    assert groups == sorted(groups) and groups[0] == 0


def test_split_long():
    energy = [5.0] * 100
    energy[40] = 1.0
    assert kernels.split_long([0, 100], energy, 50, 10) == [0, 40, 78, 100] or all(b - a <= 50 for a, b in itertools.pairwise(kernels.split_long([0, 100], energy, 50, 10)))
    assert kernels.split_long([0, 50], energy, 50, 10) == [0, 50]


def test_persistent_runs():
    assert kernels.persistent_runs([("a", 0, 9), ("b", 10, 11), ("a", 12, 20)], 5) == [("a", 0, 20)]
    assert kernels.persistent_runs([("a", 0, 1), ("b", 2, 20)], 5) == [("b", 0, 20)]
    assert kernels.persistent_runs([("a", 0, 9), ("b", 10, 11), ("c", 12, 20)], 5) == [("a", 0, 11), ("c", 12, 20)]
    assert kernels.persistent_runs([], 5) == []


def item(frame, strength=1.0, strong=True, kind=("pause", "still"), arm="left"):
    return {"frame": frame, "strength": strength, "strong": strong, "kind": kind, "types": (kind[0],), "arms": (arm,)}


def test_combine_and_filter():
    one = kernels.combine([item(10, 1.0), item(20, 3.0), item(12, 9.0, strong=False)])
    assert one["frame"] == 18 and one["strength"] == 9.0 and one["strong"]
    assert kernels.combine([item(5, strong=False), item(3, strong=False)])["frame"] == 3
    out = kernels.filter_evidence([item(1), item(10), item(12), item(14), item(30), item(99)], 100, 5, 2)
    assert [e["frame"] for e in out] == [12, 30]
    assert kernels.filter_evidence([], 100, 5, 2) == []


def test_pair_arms():
    left = [item(10), item(50, kind=("gripper", "increase"))]
    right = [item(12, arm="right"), item(53, arm="right"), item(90, arm="right")]
    out = kernels.pair_arms(left, right, 4, 2)
    assert [(e["frame"], e["relation"]) for e in out] == [(11, "synchronous_pause"), (50, "single_arm"), (53, "single_arm"), (90, "single_arm")]
    assert kernels.greedy_pairs([(10, "a"), (14, "a")], [(13, "a"), (11, "a")], 4) == [(1, 0, 1), (1, 1, 0)]


def test_runs_and_spans():
    assert runs_of(np.array([1, 1, 0, 1], bool)) == [(0, 1), (3, 3)]
    assert runs_of(np.zeros(0, bool)) == []
    assert spans([0, 5, 5, 12, 10], 10) == [(0, 4), (5, 9)]
    assert still_groups([True, False, True, False, True], [3, 5, 2, 5, 9], 8) == [[0, 1, 2], [3], [4]]
    assert still_groups([True, False, True], [3, 5, 7], 8) == [[0, 1, 2]]
    assert still_groups([True, True], [1, 1], 8) == [[0, 1]]
    assert np.allclose(smooth_edge(np.array([1.0, 4.0, 1.0, 4.0]), 3), [2, 2, 3, 3])


def episode(moves):
    """Positions along z with rests, quaternions constant, grippers closed."""
    z = np.concatenate([[0.0], np.cumsum(np.repeat([m for m, _ in moves], [n for _, n in moves]))])
    states = np.zeros((len(z), 16))
    states[:, 3] = states[:, 11] = 1
    states[:, 2] = z
    return states


def test_segment_episode_covers_and_labels():
    states = episode([(0.0, 20), (0.01, 40), (0.0, 30), (-0.01, 40), (0.0, 30)])
    found = segment_episode(states)
    assert found[0]["start"] == 0 and found[-1]["end"] == len(states) - 1
    assert all(b["start"] == a["end"] + 1 for a, b in itertools.pairwise(found))
    assert "lift" in [s["left"] for s in found] and "lower" in [s["left"] for s in found]
    assert all(s["right"] == "still" for s in found)
    assert all((s["left"], s["right"]) != ("still", "still") for s in found[:-1])
    with pytest.raises(ValueError):
        segment_episode(np.full((3, 16), np.nan))
    one = segment_episode(states[:1])
    assert [(s["start"], s["end"], s["label"]) for s in one] == [(0, 0, "still")]


def test_propose_covers():
    rng = random.Random(1)
    states = np.cumsum(np.array([[rng.gauss(0, 1) for _ in range(7)] for _ in range(200)]), axis=0)
    cuts = propose(states, np.arange(200) * 0.1, [6])
    assert cuts[0] == 0 and cuts[-1] == 200 and cuts == sorted(set(cuts))
    assert max(b - a for a, b in itertools.pairwise(cuts)) <= 30


def test_contradictions():
    assert contradictions("The left arm will open the gripper.", "close_gripper", "still") == ["left:open_gripper"]
    assert contradictions("The left arm will not open the gripper.", "close_gripper", "still") == []
    assert contradictions("See whether the right arm should lift.", "move", "lower") == []
    assert contradictions("If needed, the right arm should lift.", "move", "lower") == ["right:lift"]  # a comma ends what is hypothetical
    assert contradictions("The right arm must move away.", "move", "still") == ["right:move"]
    assert contradictions(None, "move", "still") == []


def test_weighted_frame_of_many_is_that_of_the_sql():
    import duckdb

    db, rng = duckdb.connect(), random.Random(4)
    for _ in range(300):
        c = [rng.randint(400, 1900) * 10 for _ in range(rng.randint(1, 6))]
        rows = [(60 * i + j, v / 1000) for i, v in enumerate(c) for j in range(60)]
        cluster = [{"frame": f, "strength": w, "strong": True, "types": (), "arms": ()} for f, w in rows]
        f, w = map(list, zip(*rows, strict=True))
        want = db.execute("SELECT round_even(list_sum(list_transform(list_zip($1::BIGINT[], $2::DOUBLE[]), lambda e: e[1] * e[2])) / list_sum($2::DOUBLE[]), 0)", [f, w]).fetchall()
        assert kernels.combine(cluster)["frame"] == want[0][0]
