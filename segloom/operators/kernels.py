"""Rules that are sequential by nature, as plain functions over one episode's short lists, and how they run on grouped data.

Relational steps come first and cut the input to segments or evidence, so that an episode is a few hundred rows at most.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce
from operator import add

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string


def per_episode(df: DataFrame, kernel: Callable[..., list[tuple]], schema: str, keys: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """Rows (keys, *kernel output) of each group: kernel takes one list for each column, in the order of `order`.

    Groups become array columns on the JVM side, and one Python call serves an Arrow batch of them, so the cost is that of the
    kernel and not of a frame for each group. A group must fit in a row.
    """
    names = [c.strip().rsplit(" ", 1)[0] for c in schema.split(",")]
    packed = df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(order, *[c for c in columns if c != order]))).alias("_rows"))
    arrays = packed.select(*keys, *[F.col(f"_rows.{c}").alias(f"_{c}") for c in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            keyed = [b.column(k).to_pylist() for k in keys]
            lists = [b.column(f"_{c}").to_pylist() for c in columns]
            for row in zip(*keyed, *lists, strict=True):
                head = row[: len(keys)]
                out += [head + r for r in kernel(*row[len(keys) :])]
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=target)

    target = to_arrow_schema(_parse_datatype_string(schema))
    return arrays.mapInArrow(run, schema)


def merge_short(lengths: Sequence[int], labels: Sequence, least: int) -> list[int]:
    """Group of each segment after short ones joined an equal neighbour, the previous one if it can, until nothing changes.

    A group under `least` frames joins the group before it of the same label, else the one after. Joining only ever lengthens
    groups, so one pass with a step back after each join reaches the same end as starting over each time.
    """
    groups = [[i] for i in range(len(lengths))]
    size = list(lengths)
    label = list(labels)
    i = 0
    while i < len(groups):
        if size[i] < least:
            into = i - 1 if i and label[i - 1] == label[i] else i + 1 if i + 1 < len(groups) and label[i + 1] == label[i] else None
            if into is not None:
                a, b = sorted((i, into))
                groups[a:b + 1] = [groups[a] + groups[b]]
                size[a:b + 1] = [size[a] + size[b]]
                del label[b]
                i = 0 if a == 0 else a - 1
                continue
        i += 1
    out = [0] * len(lengths)
    for g, members in enumerate(groups):
        for m in members:
            out[m] = g
    return out


def fold_short(lengths: Sequence[int], labels: Sequence, least: int) -> list[int]:
    """Group of each segment after one pass from the left: equal neighbours join if either is under `least` frames."""
    out, size = [], 0
    for i, (n, label) in enumerate(zip(lengths, labels, strict=True)):
        if i and label == labels[i - 1] and (n < least or size < least):
            out.append(out[-1])
            size += n
        else:
            out.append(out[-1] + 1 if out else 0)
            size = n
    return out


def coarsen(lengths: Sequence[int], preferred: tuple[int, int] = (32, 64), most: int = 128) -> tuple[list[int], float]:
    """Group of each segment of one protected run, and the cost: the grouping of least total loss.

    A group of L frames loses 0.8 + 4 * short^2 + excess^2, with short = max(0, low - L) / (low / 2) and
    excess = max(0, L - high) / low. A group of several segments has `most` frames at most. Of equal costs the shorter last group wins.
    """
    low, high = preferred
    edge = [0]
    for n in lengths:
        edge.append(edge[-1] + n)
    best: list[tuple[float, int]] = [(0.0, -1)]
    for end in range(1, len(edge)):
        found = (math.inf, -1)
        for start in reversed(range(end)):
            frames = edge[end] - edge[start]
            if start < end - 1 and frames > most:
                break
            cost = best[start][0] + 0.8 + 4 * (max(0, low - frames) / (low / 2)) ** 2 + (max(0, frames - high) / low) ** 2
            if cost < found[0]:
                found = (cost, start)
        best.append(found)
    cuts, end = [], len(lengths)
    while end > 0:
        end = best[end][1]
        cuts.append(end)
    group, out = -1, []
    starts = set(cuts)
    for i in range(len(lengths)):
        group += i in starts
        out.append(group)
    return out, best[-1][0]


def split_long(cuts: Sequence[int], energy: Sequence[float], most: int, least: int) -> list[int]:
    """Boundaries with more in between where they are over `most` frames apart: at the least energy near the farthest point allowed."""
    out = [cuts[0]]
    reach = max(least, most // 4)
    for right in cuts[1:]:
        while right - out[-1] > most:
            goal = out[-1] + most
            low, high = max(out[-1] + least, goal - reach), min(right - least, goal + reach)
            out.append(min(range(low, high + 1), key=lambda f: (energy[f], f)) if high > low else goal)
        out.append(right)
    return sorted(set(out))


def persistent_runs(runs: Sequence[tuple], least: int) -> list[tuple]:
    """(label, start, end) runs without short ones.

    First, a run under `least` frames between two of one label vanishes into them, from the left until none is left. Then a short run
    joins the one before it, a short first run the next; equal neighbours become one.
    """
    now = [list(r) for r in runs]
    i = 1
    while i < len(now) - 1:
        if now[i][2] - now[i][1] + 1 < least and now[i - 1][0] == now[i + 1][0]:
            now[i - 1][2] = now[i + 1][2]
            del now[i : i + 2]
            i = 1
        else:
            i += 1
    kept: list[list] = []
    for r in now:
        if kept and r[2] - r[1] + 1 < least:
            kept[-1][2] = r[2]
        else:
            kept.append(r)
    if len(kept) > 1 and kept[0][2] - kept[0][1] + 1 < least:
        kept[1][1] = kept[0][1]
        del kept[0]
    out: list[list] = []
    for r in kept:
        if out and out[-1][0] == r[0]:
            out[-1][2] = r[2]
        else:
            out.append(r)
    return [tuple(r) for r in out]


def plain_sum(values: Iterable[float]) -> float:
    """Sum from left to right, each step rounded, as SQL engines add doubles; sum() of Python 3.12 and later compensates."""
    return reduce(add, values, 0.0)


def combine(cluster: Sequence[dict]) -> dict:
    """One piece of evidence for several: dicts with frame, strength, strong, arms, types and optional fields.

    Strong members decide: the frame is their mean weighted by strength, rounded half to even, and the strongest, of equals the
    earliest, gives the other fields. Without strong ones the first frame does.
    """
    strong = [e for e in cluster if e["strong"]]
    if strong:
        lead = max(strong, key=lambda e: (e["strength"], -e["frame"]))
        weights = [max(e["strength"], 1e-6) for e in strong]
        frame = round(plain_sum(e["frame"] * w for e, w in zip(strong, weights, strict=True)) / plain_sum(weights))
    else:
        lead = min(cluster, key=lambda e: e["frame"])
        frame = lead["frame"]
    return {
        **lead,
        "frame": frame,
        "arms": tuple(sorted({a for e in cluster for a in e["arms"]})),
        "types": tuple(sorted({t for e in cluster for t in e["types"]})),
        "strong": bool(strong),
        "strength": max(e["strength"] for e in cluster),
        "support": list(cluster),
    }


def filter_evidence(evidence: Sequence[dict], frames: int, least: int, radius: int) -> list[dict]:
    """Evidence away from the ends, single-linked within `radius` frames, and folded where what is left stands under `least` apart."""
    rows = sorted((e for e in evidence if least <= e["frame"] <= frames - least), key=lambda e: e["frame"])
    clusters: list[list[dict]] = []
    for e in rows:
        if clusters and e["frame"] - clusters[-1][-1]["frame"] <= radius:
            clusters[-1].append(e)
        else:
            clusters.append([e])
    out: list[dict] = []
    for e in map(combine, clusters):
        if out and e["frame"] - out[-1]["frame"] < least:
            out[-1] = combine([*out[-1]["support"], *e["support"]])
        else:
            out.append(e)
    return out


def pair_arms(left: Sequence[dict], right: Sequence[dict], sync: int, near: int) -> list[dict]:
    """Joint evidence of two arms: each left item takes the nearest unused right item within `sync` frames if both are of one kind or
    within `near` frames; the rest stay single. `kind` names what an item is evidence of."""
    free = list(range(len(right)))
    out = []
    for item in left:
        close = [j for j in free if abs(right[j]["frame"] - item["frame"]) <= sync]
        j = min(close, key=lambda k: (abs(right[k]["frame"] - item["frame"]), k)) if close else None
        if j is not None and (right[j]["kind"] == item["kind"] or abs(right[j]["frame"] - item["frame"]) <= near):
            free.remove(j)
            same = right[j]["kind"] == item["kind"]
            out.append({**combine([item, right[j]]), "relation": f"synchronous_{item['kind'][0]}" if same else "near_simultaneous_mixed_evidence"})
        else:
            out.append({**item, "relation": "single_arm"})
    out += [{**right[j], "relation": "single_arm"} for j in free]
    return sorted(out, key=lambda e: e["frame"])


def greedy_pairs(left: Sequence[tuple], right: Sequence[tuple], sync: int) -> list[tuple[int, int, int]]:
    """(distance, i, j): one-to-one matches of (frame, direction) items of one direction, the closest first, at most `sync` apart.

    Items are in the order of their frames; only those near each other are listed.
    """
    frames = [b[0] for b in right]
    near = [
        (abs(right[j][0] - a[0]), i, j)
        for i, a in enumerate(left)
        for j in range(bisect_left(frames, a[0] - sync), bisect_right(frames, a[0] + sync))
        if a[1] == right[j][1]
    ]
    found, used_left, used_right = [], set(), set()
    for gap, i, j in sorted(near):
        if i not in used_left and j not in used_right:
            used_left.add(i)
            used_right.add(j)
            found.append((gap, i, j))
    return found
