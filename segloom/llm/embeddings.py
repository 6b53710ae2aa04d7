"""Near-duplicate vectors by int8 tile products with error bounds.

Unit vectors are rounded to int8 and tiles of them multiplied; each vector's rounding error is known exactly, which bounds the
error of every product. Pairs that the bound leaves open are computed anew, with a second int8 plane and then in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.llm.common import components, cut, forest, shuffle_width

#: Vectors that are packed in one row. Rows and columns that are multiplied at once. Open pairs computed at once.
BLOCK, STRIPE, WIDE, OPEN = 1024, 512, 4096, 50_000
#: Bytes of quantised vectors on one side of a tile, at most.
SIDE = 8 << 20
#: One step of the second int8 plane is this part of a step of the first.
FINE = 254.0


def vectors_of(rows: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, key binary, vec binary, dim): vec holds the doubles, key their digest; both null for vectors that link with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            size = lists.value_lengths().fill_null(0).to_numpy().astype(np.int64)
            at = np.concatenate([[0], np.cumsum(size)])
            flat = lists.flatten()
            x = flat.fill_null(np.nan).to_numpy(zero_copy_only=False).astype(float) + 0.0
            bad, some = (np.concatenate([[0], np.cumsum(f)]) for f in (~np.isfinite(x), x != 0))
            good = (size > 0) & (bad[at[1:]] == bad[at[:-1]]) & (some[at[1:]] > some[at[:-1]])
            raw, edge = x.tobytes(), (8 * at).tolist()
            vecs = [raw[i:j] if g else None for i, j, g in zip(edge[:-1], edge[1:], good.tolist(), strict=True)]
            keys = [None if v is None else xxhash.xxh3_128_digest(v) for v in vecs]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.binary()), pa.array(vecs, pa.binary()), pa.array(size.astype(np.int32), mask=~good)], names=["vec_id", "key", "vec", "dim"])

    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v")).mapInArrow(run, "vec_id long, key binary, vec binary, dim int")


class Quantised(NamedTuple):
    """Unit vectors x in two int8 planes: |x - s q| <= e, and |x - s (q + r / FINE)| <= f."""

    q: np.ndarray
    r: np.ndarray
    s: np.ndarray
    e: np.ndarray
    f: np.ndarray

    def doubles(self, at: np.ndarray) -> np.ndarray:
        return (self.q[at] + self.r[at] / FINE) * self.s[at, None]


def unit(raw: bytes, dim: int) -> np.ndarray:
    """Vectors of `dim` doubles, scaled to length one."""
    x = np.frombuffer(raw, float).reshape(-1, dim)
    x = x / abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def quantise(x: np.ndarray) -> Quantised:
    """Both planes of unit vectors x, and the exact errors that each leaves, rounded up."""
    s = np.maximum(abs(x).max(1), 1e-300) / 127
    q = np.rint(x / s[:, None]).astype(np.int8)
    rest = x - s[:, None] * q
    r = np.rint(rest * (FINE / s[:, None])).astype(np.int8)
    fine = x - (q + r / FINE) * s[:, None]
    return Quantised(q, r, s, np.sqrt((rest * rest).sum(1)) + 1e-12, np.sqrt((fine * fine).sum(1)) + 1e-12)


def tile(a: Quantised, b: Quantised, same: bool, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Linked index pairs (i, j) of two sides, and pairs still open, part by part; i < j only if both are the same side.

    |x.y - sx sy qx.qy| <= ex + ey + ex ey by the triangle inequality; pairs that this leaves open get a product of both planes, with
    the errors f in place of e. The products of int8 rows are exact in float32 up to 1,040 components, and in float64 beyond.
    """
    kind = np.float32 if a.q.shape[1] <= 1040 else np.float64
    for j in range(0, len(b.q), WIDE):
        cols = slice(j, min(j + WIDE, len(b.q)))
        right, scale = b.q[cols].T.astype(kind), b.s[None, cols].astype(kind)
        for i in range(0, cols.stop if same else len(a.q), STRIPE):
            rows = slice(i, min(i + STRIPE, len(a.q)))
            about = (a.q[rows].astype(kind) @ right) * a.s[rows, None].astype(kind) * scale
            error = a.e[rows].max() + b.e[cols].max() + a.e[rows].max() * b.e[cols].max() + 4e-6
            p, q = np.nonzero(about >= threshold - error)
            near = about[p, q]
            p, q = p + i, q + j
            if same:
                keep = p < q
                p, q, near = p[keep], q[keep], near[keep]
            own = a.e[p] + b.e[q] + a.e[p] * b.e[q] + 4e-6
            sure, open_ = near >= threshold + own, np.nonzero(abs(near - threshold) < own)[0]
            left = np.zeros(len(p), bool)
            for k in range(0, len(open_), OPEN):
                at = open_[k : k + OPEN]
                u, v = p[at], q[at]
                product = np.einsum("ij,ij->i", a.doubles(u), b.doubles(v))
                own = a.f[u] + b.f[v] + a.f[u] * b.f[v] + 1e-9
                sure[at] = product >= threshold + own
                left[at] = abs(product - threshold) < own
            yield p[sure], q[sure], p[left], q[left]


def near_duplicates(rows: DataFrame, threshold: float = 0.9, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of rows.

    Equal vectors are one node with a count, so copies are never paired. Distinct vectors go to sides by hash, and each pair of
    sides is one task's tile: all pairs are compared, but a tile returns only counts of links for its rows and a forest of its
    links, never the pairs. Tiles get two int8 planes of each vector, an eighth of its doubles each; the few pairs that these leave
    open, within some 1e-4 of the threshold, meet their doubles in a join. Vectors of different lengths are not compared. Null, zero
    and non-finite vectors, and empty ones, have no links and are their own component. Rows with a null vec_id count as links of
    their copies and neighbours, and belong to the component of a copy that has an id; without one they link with nothing.

    A side holds SIDE bytes at most, so a tile's memory does not depend on the number of rows, and each vector travels once for each
    side; the number of tiles grows with the square of the number of distinct vectors, which is the cost of an exact threshold.
    """
    spark = rows.sparkSession
    table = cut(vectors_of(rows, vec_id, embedding), "vectors")
    nodes = cut(table.where("key is not null").groupBy("key").agg(F.min("vec_id").alias("node"), F.count("*").alias("n"), F.min("vec").alias("vec"), F.min("dim").alias("dim")).where("node is not null"), "nodes")
    dims = nodes.groupBy("dim").count().collect()  # one row for each length of vector
    blocks = max([1, *[-(-r["count"] * 21 // (20 * BLOCK)) for r in dims]])
    most = max([1, *[-(-2 * r["dim"] * r["count"] // SIDE) for r in dims]])
    sides = max(1, min(blocks, max(most, isqrt(2 * shuffle_width(spark)))))

    def pack(group: pa.Table) -> pa.Table:
        x = quantise(unit(b"".join(group["vec"].to_pylist()), group["dim"][0].as_py()))
        node, n = group["node"].to_numpy(), group["n"].to_numpy()
        return pa.table({"dim": group["dim"][:1], "side": group["side"][:1], "node": [node.tobytes()], "n": [n.tobytes()], **{k: [v.tobytes()] for k, v in x._asdict().items()}})

    dealt = nodes.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")).withColumn("side", F.col("block") % sides)
    packed = dealt.groupBy("dim", "side", "block").applyInArrow(pack, "dim int, side int, node binary, n binary, q binary, r binary, s binary, e binary, f binary")
    tiles = packed.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(sides - 1)))).withColumns({"lo": F.least("side", "other"), "hi": F.greatest("side", "other")})
    schema = "node long, n long, parent long, open long"

    def whole(parts: list[dict]) -> tuple[np.ndarray, np.ndarray, Quantised]:
        kinds = {"node": np.int64, "n": np.int64, "q": np.int8, "r": np.int8, "s": float, "e": float, "f": float}
        got = {k: np.frombuffer(b"".join([r[k] for r in parts]), t) for k, t in kinds.items()}
        dim = parts[0]["dim"]
        return got["node"], got["n"], Quantised(got["q"].reshape(-1, dim), got["r"].reshape(-1, dim), got["s"], got["e"], got["f"])

    def work(group: pa.Table) -> pa.Table:
        parts = group.to_pylist()
        lo, hi = parts[0]["lo"], parts[0]["hi"]
        found = [sorted([r for r in parts if r["side"] == side], key=lambda r: r["node"]) for side in dict.fromkeys((lo, hi))]
        if lo != hi and not all(found):
            return pa.table({c: pa.array([], pa.int64()) for c in ("node", "n", "parent", "open")})
        (na, ca, a), (nb, cb, b) = (whole(found[0]), whole(found[-1])) if lo != hi else [whole(found[0])] * 2
        ga, gb, u, v = np.zeros(len(na)), np.zeros(len(nb)), [na[:0]], [na[:0]]
        left = [(na[:0], na[:0])]
        for p, q, x, y in tile(a, b, lo == hi, threshold):
            ga += np.bincount(p, cb[q], len(na))
            gb += np.bincount(q, ca[p], len(nb))
            left.append((na[x], nb[y]))
            if len(p):
                x, y = forest(na[p], nb[q])
                u.append(x)
                v.append(y)
        u, v = forest(np.concatenate(u), np.concatenate(v))
        x, y = (np.concatenate(c) for c in zip(*left, strict=True))
        node = np.concatenate([na[ga > 0], nb[gb > 0], u, x])
        n = np.concatenate([ga[ga > 0], gb[gb > 0], np.zeros(len(u) + len(x))]).astype(np.int64)
        kind = np.repeat([0, 1, 2], [len(n) - len(u) - len(x), len(u), len(x)])
        parent, open_ = (pa.array(np.concatenate([np.zeros(len(n) - len(c) - pad, np.int64), c, np.zeros(pad, np.int64)]), mask=kind != k) for c, pad, k in ((v, len(x), 1), (y, 0, 2)))
        return pa.table({"node": pa.array(node, pa.int64()), "n": n, "parent": parent, "open": open_})

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = []
            for dim, x, y in zip(b.column("dim").to_pylist(), b.column("x").to_pylist(), b.column("y").to_pylist(), strict=True):
                good.append(float((unit(x, dim) * unit(y, dim)).sum()) >= threshold)
            yield pa.RecordBatch.from_arrays([b.column(c).filter(pa.array(good, pa.bool_())) for c in ("src", "dst", "m", "n")], names=["src", "dst", "m", "n"])

    found = cut(tiles.groupBy("dim", "lo", "hi").applyInArrow(work, schema), "links")
    pairs = found.where("open is not null").select(F.col("node").alias("src"), F.col("open").alias("dst"))
    left = nodes.select(F.col("node").alias("src"), "dim", F.col("vec").alias("x"), F.col("n").alias("m"))
    right = nodes.select(F.col("node").alias("dst"), F.col("vec").alias("y"), "n")
    more = cut(pairs.join(left, "src").join(right, "dst").select("src", "dst", "dim", "x", "y", "m", "n").mapInArrow(settle, "src long, dst long, m long, n long"), "settled")
    joined = components(found.where("parent is not null").select(F.col("node").alias("src"), F.col("parent").alias("dst")).unionByName(more.select("src", "dst")))
    each = found.select("node", "n").unionByName(more.select(F.col("src").alias("node"), "n")).unionByName(more.select(F.col("dst").alias("node"), F.col("m").alias("n")))
    counts = each.groupBy("node").agg(F.sum("n").alias("far"))
    named = nodes.join(counts, "node", "left").join(joined, "node", "left").select("key", (F.col("n") - 1 + F.coalesce("far", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    out = table.join(named, "key", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op4(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
