"""Helpers that the operators share: intermediate tables, byte views of Arrow columns, components."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: spark.checkpoint.dir, or (local master only) one of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="segloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: lineage ends there, and a lost executor costs a reread.

    discard() deletes the table; what is not discarded stays until the folder is emptied.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/segloom/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.segloom_path = path
    return out


def merged(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """left joined with right by an exchange, whatever Spark takes their sizes for: tables that grow with the input are never broadcast, as
    the driver would hold them. A Parquet file of ids under the broadcast threshold is many times that in its memory."""
    return left.join(right.hint("merge"), on, how)


def discard(*tables: DataFrame) -> None:
    """Delete tables that cut() made, once all that was derived from them has been written."""
    for t in tables:
        jvm, conf = t.sparkSession._jvm, t.sparkSession._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(t.segloom_path)
        path.getFileSystem(conf).delete(path, True)


def shuffle_width(spark: SparkSession) -> int:
    """Number of partitions that the session wants after an exchange; the operator of the cluster sets it by input size."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated UTF-8 bytes of a string or binary column and n+1 offsets; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or len(at) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def lean(batches: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most `rows` rows, so that what is made of them stays small; at the end the worker gives back
    memory that it no longer uses, as it lives on for later stages."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
    give_back()


def give_back() -> None:
    """Return to the system what memory a worker no longer uses."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library has its own ways
        pass


def spans_of(at: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) of about `most` bytes each; a longer row is alone."""
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for the graph of edges a-b, each node but the smallest once; in memory, for bounded blocks."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while len(x):
        low = np.minimum(label[x], label[y])
        before = label.copy()
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        label = label[label]
        label = label[label]
        if np.array_equal(before, label) and np.array_equal(label[x], label[y]):
            break
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (src, dst), long: one row (node, component) for each node that has an edge.

    component is the smallest node reachable. Alternating large-star and small-star steps (Kiveris et al., 2014) until nothing changes:
    edges stay in a distributed table, each round is cut and the one before deleted, and only a row count and a checksum reach the
    driver. Nulls and loops are ignored.
    """
    now = edges.select(F.col("src").cast("long").alias("u"), F.col("dst").cast("long").alias("v")).where("u is not null and v is not null and u <> v")
    now = now.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, last, seen = cut(now, "edges"), None, ()
    while seen != last:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # A table of its own, so that the join with it may split the edges of a hot node.
        least = cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = cut(merged(both.where("v > u"), least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        low = cut(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = merged(large, low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        before, now = now, cut(small, "edges")
        discard(before, least, large, low)
        last, seen = seen, tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def in_sides(members: DataFrame, sizes: DataFrame, side: int) -> DataFrame:
    """Members (class, node, and others) of classes dealt to groups and sorted by (group, node), with own, lo and hi.

    sizes: class and n, of the classes wanted. A class of more than `side` members is split in sides by hash, and each pair of sides (lo,
    hi) is a group of its own, so no task holds a whole hot class; own is the side of a member.
    """
    split = merged(members, sizes.select("class", F.ceil(F.col("n") / side).cast("int").alias("sides")), "class")
    split = split.withColumn("own", F.pmod(F.xxhash64("node"), F.col("sides")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
    split = split.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}).withColumn("group", F.xxhash64("class", "lo", "hi"))
    return by_group(split.drop("class", "sides", "other"))


def by_group(rows: DataFrame) -> DataFrame:
    return rows.repartition(shuffle_width(rows.sparkSession), "group").sortWithinPartitions("group", "node")


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches that are sorted by `group`."""
    rest = None
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([b])]).combine_chunks()
        group = t.column("group").to_numpy()
        whole = int(np.searchsorted(group, group[-1], "left"))  # the last group may go on
        rest = t.slice(whole)
        if whole:
            yield t.slice(0, whole)
    if rest is not None and rest.num_rows:
        yield rest


def groups_of(t: pa.Table) -> list[tuple[int, int]]:
    """Rows [a, z) of each group of a table of whole groups."""
    group = t.column("group").to_numpy()
    cuts = np.nonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))[0]
    return list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
