"""Sharding by histogram sort.

Keys are counted below candidate boundaries across all partitions, in bytes; the probes close in on each splitter until it
meets the tolerance, and only then do rows move, once.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segloom.llm.common import cut

#: Keys are 63-bit numbers from 0; the first probes stand 2^FIRST to the key range, later ones 2^NEXT to the interval left.
BITS, FIRST, NEXT = 63, 13, 7
#: Low bits of a key that only tell rows of one group apart.
TIE = 23
#: Rows of a cell, which one task numbers, and cells of a shard at most; a table of more rows has larger cells.
CELL_ROWS, MOST_CELLS = 50_000, 1024


def splitters(keys: DataFrame, goals: Sequence[int], tolerance: int, low: int = 0) -> list[tuple[int, int, int, int]]:
    """(a, bytes below a, b, bytes below b) for each goal: neighbouring candidates with the goal between their exact byte counts.

    keys: k long, from 0, and size long. Candidates are multiples of 2^low. Each round counts, in one aggregation on the JVM,
    the bytes between neighbouring probes of all intervals that are still open, and reads only rows in these; at most 2^13 numbers, then
    len(goals) * 2^7, come to the driver. A goal is settled when a candidate is within `tolerance` of it, or a and b are neighbours.
    """
    spark = keys.sparkSession
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    span = [(0, 0, 1 << BITS, total)] * len(goals)
    shift = BITS
    while shift > low:
        open_ = sorted({s[0] >> shift for s, g in zip(span, goals, strict=True) if s[2] - s[0] == 1 << shift and min(g - s[1], s[3] - g) > tolerance})
        if not open_:
            break
        step = min(FIRST if shift == BITS else NEXT, shift - low)
        rows = keys
        if shift < BITS:
            inside = F.broadcast(spark.createDataFrame([(p,) for p in open_], "_p long"))  # at most len(goals) rows
            rows = keys.join(inside, F.shiftright("k", shift) == F.col("_p"))
        counted = {r.at: r.bytes for r in rows.groupBy(F.shiftright("k", shift - step).alias("at")).agg(F.sum("size").alias("bytes")).collect()}
        for i, (a, below, b, _) in enumerate(span):
            if b - a != 1 << shift or a >> shift not in open_:
                continue
            for probe in range(a >> shift - step, b >> shift - step):
                here = counted.get(probe, 0)
                if below + here > goals[i] or probe + 1 == b >> shift - step:
                    span[i] = (probe << shift - step, below, probe + 1 << shift - step, below + here)
                    break
                below += here
        shift -= step
    return span


def nearest(span: Sequence[tuple[int, int, int, int]], goals: Sequence[int]) -> list[int]:
    """Of the two candidates of each goal, the one whose bytes are nearer to it."""
    return [a if g - x <= y - g else b for (a, x, b, y), g in zip(span, goals, strict=True)]


def shard_edges(keys: DataFrame, shards: int, tolerance: float) -> tuple[list[int], dict[int, int]]:
    """Boundaries of ranges of groups, and the shard of each range by its first key.

    Groups (keys alike but for TIE bits) stay whole. One of more bytes than a shard's share takes a shard by itself, and the others
    share the rest; a boundary that falls on it would leave shards empty. There are fewer than `shards` of these.
    """
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    heavy: dict[int, int] = {}
    while True:
        rest, parts = total - sum(heavy.values()), shards - len(heavy)
        if parts < 1 or not total:
            break
        light = keys.where(~F.shiftright("k", TIE).isin([h >> TIE for h in heavy])) if heavy else keys
        goals = [rest * i // parts for i in range(1, parts)]
        span = splitters(light, goals, int(rest * tolerance / parts), TIE)
        more = {a: y - x for a, x, b, y in span if b - a == 1 << TIE and (y - x) * parts > rest}
        if not more:
            break
        heavy |= dict(sorted(more.items(), key=lambda e: -e[1])[: parts - 1])
        if parts == 1:
            break
    edges = sorted({0, *(nearest(span, goals) if total and parts > 1 else [])})
    owner = {}
    for e in sorted({*edges, *heavy, *(h + (1 << TIE) for h in heavy)}):
        owner[e] = parts + sorted(heavy).index(e) if e in heavy else bisect_right(edges, e) - 1
    return sorted(owner), owner


def range_of(key: str, edges: Sequence[int], spark) -> tuple[DataFrame, Column]:
    """A table to broadcast, (_top, _edges, _base), and the index of a row's range once it is joined on the key's upper bits.

    edges: sorted, the first 0. A row looks through the few edges that share its upper FIRST bits only.
    """
    tops: dict[int, list[int]] = {}
    for e in edges:
        tops.setdefault(e >> BITS - FIRST, []).append(e)
    rows, at = [], 0
    for top in range(1 << FIRST):
        own = tops.get(top, [])
        rows.append((top, own, at - 1))
        at += len(own)
    table = spark.createDataFrame(rows, "_top long, _edges array<long>, _base int")
    return table, (F.col("_base") + F.size(F.filter("_edges", lambda e: e <= F.col(key)))).cast("int")


def text_key(doc_id: str, text: str) -> Column:
    """Sort key: 40 bits of the text's hash, so that equal texts are one group, and 23 of the id's, which tell its rows apart."""
    high = F.shiftright(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), 24).bitwiseAND(F.lit((1 << 40) - 1))
    return F.shiftleft(high, TIE).bitwiseOR(F.shiftrightunsigned(F.xxhash64(doc_id), 64 - TIE))


def shard(rows: DataFrame, shards: int = 8, cells: int | None = None, tolerance: float = 0.0005) -> DataFrame:
    """rows (k long, size long and any others) with shard int and slot long, gapless from 0 in each shard.

    Shards are ranges of k of near equal bytes, k from 0 to 2^63 - 1, and its upper 40 bits name a group that no boundary divides: each
    is off by at most `tolerance` of a shard or half a group. A group larger than a shard's share has a shard of its own. Every shard
    is numbered in smaller ranges, `cells` to a shard (by default one for CELL_ROWS rows), which may divide a group, so that no task
    holds a whole shard or a hot group. Rows move once, to their cell. `rows` is read several times and should be a table. A null
    size counts as 0, a null k as 0. Ties in k are ordered by doc_id and size where there are such columns. Columns named shard or
    slot are replaced. An empty table gives an empty one.
    """
    spark = rows.sparkSession
    rows = rows.drop("shard", "slot", "_cell", "_start", "_shard", "_top", "_edges", "_base", "_p").withColumn("k", F.coalesce("k", F.lit(0)))
    keys = rows.select("k", F.coalesce("size", F.lit(0)).alias("size"))
    seen = keys.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    edges, owner = shard_edges(keys, shards, tolerance)
    cells = cells or max(1, min(MOST_CELLS, -(-seen.n // (shards * CELL_ROWS))))
    goals = [seen.n * i // (shards * cells) for i in range(1, shards * cells)]
    ones = keys.select("k", F.lit(1).alias("size"))
    bounds = sorted({*edges, *nearest(splitters(ones, goals, seen.n // (4 * shards * cells)), goals)}) if cells > 1 else edges
    table, index = range_of("k", bounds, spark)
    celled = rows.join(F.broadcast(table), F.shiftright("k", BITS - FIRST) == F.col("_top")).withColumn("_cell", index).drop("_top", "_edges", "_base")
    counts = dict(celled.groupBy("_cell").count().collect())
    starts, next_ = [], [0] * (shards + 1)
    for c, edge in enumerate(bounds):
        s = owner[edges[bisect_right(edges, edge) - 1]]
        starts.append((c, s, next_[s]))
        next_[s] += counts.get(c, 0)
    places = F.broadcast(spark.createDataFrame(starts, "_cell int, _shard int, _start long"))  # shards * (cells + 3) rows at most
    order = Window.partitionBy("_cell").orderBy("k", *[c for c in ("doc_id", "size") if c in rows.columns])
    numbered = celled.join(places, "_cell").withColumn("slot", F.col("_start") + F.row_number().over(order) - 1)
    return numbered.withColumn("shard", F.col("_shard")).drop("_cell", "_start", "_shard", "k")


def op7(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = docs.select("doc_id", text_key("doc_id", "text").alias("k"), (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    out = shard(cut(rows, "keys"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
