"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints are looked up under 2^(r+1) - 1 structured bit masks. Each bit position has a vector of r+1 bits, and mask v keeps
the positions whose vector has an odd overlap with v. Any r positions leave a v that overlaps all of them evenly, so two
fingerprints at distance r or less agree under that mask: no pair is missed (Pagh, 2016).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.llm.common import by_group, components, cut, discard, forest, groups_of, in_sides, lean, merged, shuffle_width, text_bytes, whole_groups

#: Rows of one mask and key that are compared in one task; larger groups are split in blocks of about so many.
BLOCK = 1024
#: For each byte its eight bits, lowest first, as the eight bytes of an integer.
SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").reshape(-1).view(np.uint64)


def fingerprint_of(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Majority bits of each run at[i]:at[i+1] of 64-bit hashes; an empty run gives 0."""
    n = np.diff(at)
    out = np.zeros(len(n), np.uint64)
    full = np.nonzero(n)[0]
    if not len(full):
        return out
    blocks = -(-n[full] // 255)  # a byte counts up to 255
    first = np.cumsum(blocks) - blocks
    start = np.repeat(at[:-1][full], blocks) + 255 * (np.arange(blocks.sum()) - np.repeat(first, blocks))
    ones = np.empty((len(full), 64), np.int64)
    part = hashes.view(np.uint8).reshape(-1, 8)
    for byte in range(8):
        sums = np.add.reduceat(SPREAD[part[:, byte]], start).view(np.uint8).reshape(-1, 8).astype(np.int64)
        ones[:, 8 * byte : 8 * byte + 8] = np.add.reduceat(sums, first)
    bits = (2 * ones > n[full][:, None]).astype(np.uint8)
    out[full] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(column: pa.Array, width: int = 4, seed: int = 42) -> np.ndarray:
    """SimHash of each whole text: XXH64 of its word shingles, A-Z in lower case, repeats included; without words 0."""
    data, at = text_bytes(column)
    raw, digest = data.tobytes(), xxhash.xxh64_intdigest
    hashes: list[int] = []
    ends = [0]
    for i in range(len(at) - 1):
        words = raw[at[i] : at[i + 1]].lower().split()
        if words:
            flat = b" ".join(words)
            if len(words) <= width:
                hashes.append(digest(flat, seed))
            else:
                stop = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
                start = [0, *(stop[: len(words) - width] + 1).tolist()]
                hashes += [digest(flat[a:b], seed) for a, b in zip(start, stop[width - 1 :].tolist(), strict=True)]
        ends.append(len(hashes))
    return fingerprint_of(np.array(hashes, np.uint64), np.array(ends))


def fingerprint_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 4) -> DataFrame:
    """(doc_id, fp long) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in lean(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fingerprints(b.column(1), width).view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, fp long")


def masks(radius: int) -> list[int]:
    """The covering masks for 64 bits, as signed integers. Positions take the nonzero vectors in turn, so masks are of near equal weight."""
    k = radius + 1
    vectors = [1 + i % (2**k - 1) for i in range(64)]
    found = [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, 2**k)]
    return [m - 2**64 if m >> 63 else m for m in found]


def _pairs(group: np.ndarray, fp: np.ndarray, node: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside runs of equal `group`, as the edges of a forest."""
    cuts = np.nonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))[0]
    stop = np.repeat(cuts[1:], np.diff(cuts))  # end of each row's group
    rows, a, b = np.arange(len(fp)), [], []
    step, held = 1, 0
    while True:
        rows = rows[rows + step < stop[rows]]
        if not len(rows):
            break
        near = np.bitwise_count(fp[rows] ^ fp[rows + step]) <= radius
        a.append(node[rows[near]])
        b.append(node[rows[near] + step])
        held += len(a[-1])
        step += 1
        if held > 2_000_000:
            x, y = forest(np.concatenate(a), np.concatenate(b))
            a, b, held = [x], [y], len(x)
    return forest(np.concatenate(a), np.concatenate(b)) if held else (node[:0], node[:0])


def links(prints: DataFrame, radius: int = 4) -> DataFrame:
    """Edges (src, dst) that connect the nodes of `prints` (fp long, distinct; node long) just as all links within `radius` do.

    Groups under one mask and key are compared in full; a group of more than BLOCK rows is split in blocks, and each pair of
    blocks is a task's work of its own, so no task holds a whole hot group and none is capped.
    """
    spark = prints.sparkSession
    keyed = prints.select("fp", "node", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks(radius)])).alias("mask", "key"))
    many = keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    split = merged(keyed, many, ["mask", "key"]).withColumn("blocks", blocks).withColumn("own", own)
    split = split.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # One integer names a mask, key and pair of blocks; two that fall together only make more pairs to compare.
    group = F.xxhash64("mask", "key", F.least("own", "other"), F.greatest("own", "other")).alias("group")
    ready = split.select(group, "fp", "node").repartition(shuffle_width(spark), "group").sortWithinPartitions("group")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, np.int64)] * 3
        for b in batches:
            if not b.num_rows:
                continue
            now = [np.concatenate([r, c.to_numpy(zero_copy_only=False)]) for r, c in zip(rest, b.columns, strict=True)]
            whole = int(np.searchsorted(now[0], now[0][-1], "left"))  # the last group may go on
            rest = [x[whole:] for x in now]
            if whole:
                yield edges([x[:whole] for x in now])
        if len(rest[0]):
            yield edges(rest)

    def edges(part: list[np.ndarray]) -> pa.RecordBatch:
        a, b = _pairs(part[0], part[1].view(np.uint64), part[2], radius)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["src", "dst"])

    return ready.mapInArrow(run, "src long, dst long")


def near_duplicates(docs: DataFrame, radius: int = 4, width: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) of each row; component_id is the smallest doc_id reachable over links, the row's own included.

    Equal fingerprints are one node, so copies are never paired. Rows with a null doc_id have null components unless their
    fingerprint is shared; empty texts have fingerprint 0 and link like any other.
    """
    table = cut(fingerprint_table(docs, doc_id, text, width), "simhash")
    prints = cut(table.groupBy("fp").agg(F.min("doc_id").alias("node")), "prints")
    joined = components(links(prints.where("node is not null"), radius))
    named = merged(prints, joined, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return merged(table, named, "fp").select("doc_id", "fp", "component_id")


def op5(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


_ODD = np.random.default_rng(5).integers(0, 2**63, 12, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Rows of a class on one side of a task; fewest shingles of a set whose fingerprints may exclude it, and how many standard deviations
#: above what sets just similar enough differ by on average fingerprints may be.
SIDE, SMALL, DEVIATIONS = 4096, 12, 6.0
#: Documents that hot shingles are looked for in, how many of them have a hot one, and hot ones at most; they only order the shingles.
HOT_DOCS, HOT_LEAST, HOT_MOST = 50_000, 3, 100_000


def shingles_of(words: list[bytes], width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; a shorter text is one shingle."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(words) - width + 1)
    out = np.zeros(n, np.uint64)
    for i in range(min(width, len(words))):
        out += h[i : i + n] * _ODD[i]
    return np.unique(out)


def shingle_set(text: bytes, width: int) -> bytes:
    """Sorted distinct 32-bit hashes of the word shingles."""
    return np.unique((shingles_of(text.lower().split(), width) >> np.uint64(32)).astype(np.uint32)).tobytes()


def prefix_of(shingles: np.ndarray, hot: np.ndarray, least: float) -> np.ndarray:
    """The first shingles by (hot, hash), so many that two sets with a Jaccard similarity of `least` have one in common.

    Such sets of n and m share least * max(n, m) or more. The first that they share has all the others behind it, so in each set
    it is one of the first n - least * n + 1, whatever the order, if it is the same order for all.
    """
    n = len(shingles)
    if len(hot):
        late = hot[np.minimum(np.searchsorted(hot, shingles), len(hot) - 1)] == shingles
        shingles = np.concatenate([shingles[~late], shingles[late]])
    return shingles[: n - int(np.ceil(least * n - 1e-9)) + 1]


def hot_shingles(docs: DataFrame, width: int) -> np.ndarray:
    """Sorted hashes, of the lower half, of shingles that many of a sample of docs (doc_id, text) have."""
    of = max(1, docs.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in lean(batches, 500):
            sets = [shingles_of(t.as_buffer().to_pybytes().lower().split(), width) for t in b.column(0)]
            h = np.concatenate(sets)
            yield pa.RecordBatch.from_arrays([pa.array(h[h < np.uint64(2**63)].view(np.int64))], names=["h"])

    part = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < min(1_000_000, 1_000_000 * HOT_DOCS // of)).select("text")
    counts = part.mapInArrow(run, "h long").groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= HOT_LEAST)
    top = counts.orderBy(F.desc("n"), "h").limit(HOT_MOST).select("h").toArrow().column("h").to_numpy()
    return np.sort(top.view(np.uint64))


def differing(least: float, bits: int = 128) -> int:
    """Bits that fingerprints of two sets with a Jaccard similarity of `least` or more differ in at most, but for a chance below 1e-7.

    The cosine of such sets is 2 least / (1 + least) or more, and a bit differs with the share of their angle in a half turn.
    """
    p = float(np.arccos(2 * least / (1 + least)) / np.pi)
    return int(bits * p + DEVIATIONS * np.sqrt(bits * p * (1 - p)))


class _Rows:
    """Columns of classed rows as arrays, and which pairs of them may be similar and are not connected yet."""

    def __init__(self, t: pa.Table, least: float):
        self.node, self.part, self.own, self.lo, self.hi, size, a, b = (t.column(c).to_numpy() for c in ("node", "part", "own", "lo", "hi", "size", "fp", "fp2"))
        self.size, self.fp, self.fp2 = size.astype(np.int64), a.view(np.uint64), b.view(np.uint64)
        self.least, self.most = least, differing(least)

    def open(self, i, j, part: np.ndarray) -> np.ndarray:
        """Whether rows i and j, of one group, are of different components, stand on the sides that the group compares, and are alike
        enough in size and fingerprints."""
        small, large = np.minimum(self.size[i], self.size[j]), np.maximum(self.size[i], self.size[j])
        good = (part[i] != part[j]) & ((self.lo[i] == self.hi[i]) | (self.own[i] != self.own[j])) & (small >= self.least * large - 1e-9)
        far = np.bitwise_count(self.fp[i] ^ self.fp[j]).astype(np.int64) + np.bitwise_count(self.fp2[i] ^ self.fp2[j])
        return good & ((small < SMALL) | (far <= self.most))


def active(rows: DataFrame, least: float) -> DataFrame:
    """rows of classed() that could be similar to some row of their group which no link connects them to; pairs are not returned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches):
            x = _Rows(t, least)
            stop = np.concatenate([np.full(z - a, z) for a, z in groups_of(t)])
            keep, at, step = np.zeros(t.num_rows, bool), np.arange(t.num_rows), 1
            while True:
                at = at[at + step < stop[at]]
                if not len(at):
                    break
                found = at[x.open(at, at + step, x.part)]
                keep[found] = keep[found + step] = True
                step += 1
            yield from t.filter(pa.array(keep)).combine_chunks().to_batches()

    return rows.mapInArrow(run, rows.schema)


def similar_pairs(rows: DataFrame, least: float) -> DataFrame:
    """(src, dst): a forest of the links between rows of a group: sets with a Jaccard similarity of `least` or more.

    rows: those of classed(), sorted by group, with shingles (binary, sorted 32-bit hashes). A row is compared with all later ones of
    its group that may be similar and that links found so far don't connect it to.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches):
            x, out = _Rows(t, least), []
            sets = [np.frombuffer(s.as_buffer(), np.uint32) for s in t.column("shingles")]
            part = x.part.copy()
            for a, z in groups_of(t):
                every, back = np.unique(np.concatenate(sets[a:z]), return_inverse=True)
                edge = np.concatenate([[0], np.cumsum([len(s) for s in sets[a:z]])])
                mark = np.zeros(len(every), np.int32)
                for i in range(a, z - 1):
                    rest = np.arange(i + 1, z)
                    rest = rest[x.open(i, rest, part)]
                    if not len(rest):
                        continue
                    own = back[edge[i - a] : edge[i - a + 1]]
                    mark[own] = 1
                    size = edge[rest - a + 1] - edge[rest - a]
                    at = np.repeat(edge[rest - a] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                    both = np.add.reduceat(mark[back[at]], np.cumsum(size) - size)
                    mark[own] = 0
                    for j in rest[both >= least * (len(own) + size - both) - 1e-9].tolist():
                        if part[j] != part[i]:
                            out.append((x.node[i], x.node[j]))
                            part[a:z][part[a:z] == part[j]] = part[i]
            if out:
                src, dst = np.array(out, np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(src), pa.array(dst)], names=["src", "dst"])

    return rows.mapInArrow(run, "src long, dst long")


def classed(members: DataFrame) -> DataFrame:
    """members (class, node, part and others) of the classes that hold several components, in groups of in_sides()."""
    many = members.groupBy("class").agg(F.count("*").alias("n"), F.min("part").alias("a"), F.max("part").alias("z")).where("a <> z")
    return in_sides(members, many, SIDE)


def similar_documents(docs: DataFrame, width: int = 5, least: float = 0.8) -> DataFrame:
    """(doc_id, component_id): near duplicates by the Jaccard similarity of their sets of `width`-word shingles, `least` or more.

    Candidates come from covering SimHash: links() of the fingerprints of the shingle sets, and are verified on all shingles. As
    fingerprints of sets at 0.8 differ in ten bits of 64 on average, and masks for that radius would be too many, a prefix filter
    completes them: similar sets have one of the first shingles of both in common, in an order that puts rare ones first (prefix_of).
    Nodes that share such a key are a class, named by the smallest node of the key. In each class nodes that no link connects yet are
    compared if sizes and 128 bits of fingerprints allow a similarity of `least`, which a similar pair fails with a chance below 1e-7.
    Classes are compared inside tasks, in pairs of sides; a task returns a forest of links and never the pairs.

    Texts of the same words in the same order are one node and never paired. component_id is the smallest doc_id reachable. Null
    texts are empty; rows with a null doc_id are not compared; rows of one doc_id are compared each by its own text.
    """
    from segloom.llm.shared_keys import BITS, SPREAD, shared_keys, unplanes

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).where("doc_id is not null")
    buckets = SPREAD * shuffle_width(docs.sparkSession)
    hot = hot_shingles(docs, width)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in lean(batches):
            digest, size, prefix, prints = [], [], [], []
            for t in b.column(1):
                words = t.as_buffer().to_pybytes().lower().split()
                own = shingles_of(words, width)
                digest.append(xxhash.xxh3_128_digest(b" ".join(words)))
                size.append(len(own))
                prefix.append(prefix_of(own, hot, least).tobytes())
                other = (own ^ (own >> np.uint64(32))) * _ODD[-1]
                prints.append(fingerprint_of(np.concatenate([own, other ^ (other >> np.uint64(29))]), np.array([0, len(own), 2 * len(own)])))
            fp = np.stack(prints).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(digest, pa.binary()), pa.array(size, pa.int32()), pa.array(prefix, pa.binary()), pa.array(fp[:, 0]), pa.array(fp[:, 1])], names=["doc_id", "digest", "size", "prefix", "fp", "fp2"])

    def keys_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, at = text_bytes(column)
        return np.repeat(np.arange(len(column)), np.diff(at) // 8), data.view(np.int64)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = np.int64(2**BITS - 1)
        for b in lean(batches):
            out = []
            for node, prefix, keys in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                key = np.frombuffer(prefix, np.int64)
                key = key[np.isin(key & low, np.concatenate([unplanes(k, BITS // 8) for k in keys]))]
                out.append((key, np.full(len(key), node)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["key", "node"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in lean(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingle_set(t.as_buffer().to_pybytes(), width) for t in b.column(1)], pa.binary())], names=["node", "shingles"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in lean(batches):
            good = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(both >= least * (len(x) + len(y) - both) - 1e-9)
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], names=["src", "dst"])

    def sets_of(nodes: DataFrame) -> DataFrame:
        return merged(docs, nodes.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi").mapInArrow(sets, "node long, shingles binary").dropDuplicates(["node"])

    table = cut(docs.mapInArrow(prefixes, "doc_id long, digest binary, size int, prefix binary, fp long, fp2 long"), "prefixes")
    nodes = cut(table.groupBy("digest").agg(F.min("doc_id").alias("node"), *[F.min(c).alias(c) for c in ("size", "prefix", "fp", "fp2")]).drop("digest"), "nodes")
    # Covering SimHash: fingerprints within the radius, one of each; and texts of one fingerprint with the first of them.
    prints = cut(nodes.groupBy("fp").agg(F.min("node").alias("node")), "prints")
    twins = merged(nodes, prints.withColumnRenamed("node", "first"), "fp").where("node > first").select(F.col("node").alias("src"), F.col("first").alias("dst"))
    pairs = cut(links(prints).unionByName(twins), "pairs")
    ends = pairs.select(F.col("src").alias("node")).unionByName(pairs.select(F.col("dst").alias("node")))
    shingles = cut(sets_of(ends), "shingles")
    left, right = (shingles.select(F.col("node").alias(c), F.col("shingles").alias(f"s_{c}")) for c in ("src", "dst"))
    found = cut(merged(merged(pairs, left, "src"), right, "dst").select("src", "dst", "s_src", "s_dst").mapInArrow(verify, "src long, dst long"), "links")
    discard(prints, pairs, shingles)
    first = cut(components(found), "components")
    # The prefix filter: classes of nodes that share a key.
    flags = shared_keys(nodes.select(F.col("node").alias("doc_id"), F.col("prefix").alias("text")), keys_of, buckets).groupBy("doc_id").agg(F.collect_list("keys").alias("keys"))
    keyed = merged(nodes, flags.withColumnRenamed("doc_id", "node"), "node").select("node", "prefix", "keys")
    keyed = cut(keyed.mapInArrow(rows, "key long, node long"), "keyed")
    members = merged(keyed, keyed.groupBy("key").agg(F.min("node").alias("class")), "key").select("class", "node").distinct()
    members = merged(merged(members, nodes.drop("prefix"), "node"), first, "node", "left").withColumn("part", F.coalesce("component", "node")).drop("component")
    members = cut(members, "members")
    some = cut(active(classed(members), least), "active")
    discard(keyed, members)
    more = cut(similar_pairs(by_group(merged(some, sets_of(some), "node")), least), "links")
    joined = components(first.select(F.col("node").alias("src"), F.col("component").alias("dst")).unionByName(more))
    named = table.groupBy("digest").agg(F.min("doc_id").alias("node"))
    named = merged(named, joined, "node", "left").select("digest", F.coalesce("component", "node").alias("component_id"))
    out = cut(merged(table.select("doc_id", "digest"), named, "digest").select("doc_id", "component_id"), "similar")
    discard(table, nodes, found, first, some, more)
    return out
