"""Readers and writers of record files: line JSON, keyed episode files, TFRecord frames, split exports, verified commits."""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator
from functools import partial
from typing import BinaryIO, TextIO

import numpy as np
import pyarrow as pa
from pyarrow import fs, parquet
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_jsonl(spark: SparkSession, path: str, schema: str | StructType, tolerate_last: bool = False) -> DataFrame:
    """Objects of line JSON files; blank lines are skipped and any other line that is no such object is an error.

    With tolerate_last, a line that does not parse is dropped where it ends its file without a line break, as after a torn write. Files
    with such a line are found first, by one pass that returns a row for each of them.
    """
    if not tolerate_last:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file")).where("trim(line) <> ''")
    torn = lines.where("try_parse_json(line) is null").groupBy("file").agg(F.count("*").alias("n"), F.max("line").alias("line"))
    for r in torn.toLocalIterator():
        with open_shard(r.file) as f:
            tail = r.line.encode()
            f.seek(max(0, f.size() - len(tail)))
            if r.n > 1 or f.read() != tail:
                raise ValueError(f"{r.file}: a line that does not end the file is no object")
    return lines.where("try_parse_json(line) is not null").select(F.from_json("line", schema, {"mode": "FAILFAST"}).alias("o")).select("o.*")


def read_keyed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(key, value) of a file that holds one JSON object with a `"key":{...}` member on each line."""
    lines = spark.read.text(path).select(F.trim("value").alias("line")).where("line not in ('{', '}', '')")
    body = F.regexp_replace("line", r",$", "")
    return lines.select(F.regexp_extract(body, r'^"([^"]*)"\s*:', 1).alias("key"), F.from_json(F.regexp_replace(body, r'^"[^"]*"\s*:\s*', ""), schema, {"mode": "FAILFAST"}).alias("value"))


def episode_path(index: Column) -> Column:
    """Where the episode of a number lies: a thousand to a chunk."""
    return F.format_string("data/chunk-%03d/episode_%06d.parquet", F.floor(index / 1000), index)


def episode_of(path: Column) -> Column:
    """Episode number in a path such as data/chunk-000/episode_000012.parquet."""
    return F.regexp_extract(path, r"episode_(\d+)\.\w+$", 1).cast("long")


def read_episodes(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Episode files with those of the columns that they have; episode_index comes from the path. Filters reach the row groups."""
    found = spark.read.option("mergeSchema", "true").parquet(path)
    return found.select(episode_of(F.col("_metadata.file_path")).alias("episode_index"), *[c for c in columns if c in found.columns])


_MASK = 0xA282EAD8


def _crc_tables(count: int = 8) -> np.ndarray:
    """table[k][b]: the checksum's state after byte b and k zero bytes, from the reflected polynomial of CRC-32C."""
    table = np.zeros((count, 256), np.uint32)
    state = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        state = (state >> 1) ^ np.where(state & 1, np.uint32(0x82F63B78), np.uint32(0))
    table[0] = state
    for k in range(1, count):
        table[k] = (table[k - 1] >> np.uint32(8)) ^ table[0][table[k - 1] & 255]
    return table


_CRC = [t.tolist() for t in _crc_tables()]


def masked_crc32c(data: bytes) -> int:
    """CRC-32C as TFRecord files keep it: rotated by 15 bits and offset. Eight bytes a step."""
    crc, whole = 0xFFFFFFFF, len(data) // 8 * 8
    t0, t1, t2, t3, t4, t5, t6, t7 = _CRC
    for word in np.frombuffer(data, "<u8", whole // 8).tolist():
        word ^= crc
        crc = t7[word & 255] ^ t6[word >> 8 & 255] ^ t5[word >> 16 & 255] ^ t4[word >> 24 & 255] ^ t3[word >> 32 & 255] ^ t2[word >> 40 & 255] ^ t1[word >> 48 & 255] ^ t0[word >> 56]
    for b in data[whole:]:
        crc = t0[(crc ^ b) & 255] ^ crc >> 8
    crc ^= 0xFFFFFFFF
    return ((crc >> 15 | crc << 17) + _MASK) & 0xFFFFFFFF


def frames(stream: BinaryIO, check: bool = True) -> Iterator[bytes]:
    """Records of a TFRecord file, one at a time: length, its checksum, payload, its checksum."""
    at = 0
    while header := stream.read(12):
        if len(header) < 12:
            raise ValueError(f"truncated header at byte {at}")
        size, head = struct.unpack("<QI", header)
        if check and masked_crc32c(header[:8]) != head:
            raise ValueError(f"bad length checksum at byte {at}")
        payload, tail = stream.read(size), stream.read(4)
        if len(payload) < size or len(tail) < 4:
            raise ValueError(f"truncated record at byte {at}")
        if check and masked_crc32c(payload) != struct.unpack("<I", tail)[0]:
            raise ValueError(f"bad record checksum at byte {at}")
        yield payload
        at += size + 16


def record_sizes(stream: BinaryIO) -> Iterator[tuple[int, int]]:
    """(first byte, payload bytes) of the records of a file, by their headers alone: payloads are skipped, not read."""
    at = 0
    while header := stream.read(12):
        if len(header) < 12 or masked_crc32c(header[:8]) != struct.unpack_from("<I", header, 8)[0]:
            raise ValueError(f"bad header at byte {at}")
        (size,) = struct.unpack_from("<Q", header)
        yield at, size
        stream.seek(size + 4, 1)
        at += size + 16


def fields(data: bytes) -> Iterator[tuple[int, int, int | bytes]]:
    """(number, wire type, value) of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        number, wire = tag >> 3, tag & 7
        if wire == 0:
            yield number, wire, varint()
            continue
        size = varint() if wire == 2 else {1: 8, 5: 4}.get(wire)
        if size is None or at + size > len(data):
            raise ValueError(f"bad field {number} of wire type {wire}")
        yield number, wire, data[at : at + size]
        at += size


def example_features(payload: bytes) -> dict[str, int]:
    """How many values each feature of an Example has."""
    out = {}
    for _, _, features in (f for f in fields(payload) if f[0] == 1):
        for _, _, entry in fields(features):
            parts = {n: v for n, _, v in fields(entry)}
            count = 0
            for kind, _, values in fields(parts.get(2, b"")):
                for _, wire, v in fields(values):
                    if kind == 2:
                        count += len(v) // 4
                    elif kind == 3 and wire == 2:
                        count += sum(b < 128 for b in v)
                    else:
                        count += 1
            out[parts[1].decode()] = count
    return out


def example_values(payload: bytes) -> dict[str, list]:
    """Values of each feature of an Example: bytes, floats, or integers."""
    out = {}
    for _, _, features in (f for f in fields(payload) if f[0] == 1):
        for _, _, entry in fields(features):
            parts = {n: v for n, _, v in fields(entry)}
            values: list = []
            for kind, _, packed in fields(parts.get(2, b"")):
                for _, wire, v in fields(packed):
                    if kind == 1:
                        values.append(v)
                    elif kind == 2:
                        values += np.frombuffer(v, "<f4").tolist()
                    else:
                        numbers = [n for _, _, n in fields(b"".join(b"\x08" + x for x in _varints(v)))] if wire == 2 else [v]
                        values += [n - 2**64 if n >> 63 else n for n in numbers]
            out[parts[1].decode()] = values
    return out


def _varints(data: bytes) -> Iterator[bytes]:
    start = 0
    for i, b in enumerate(data):
        if b < 128:
            yield data[start : i + 1]
            start = i + 1


def _shards(spark: SparkSession, path: str) -> DataFrame:
    """(path) of files, a partition each, without reading them."""
    names = [r.path for r in spark.read.format("binaryFile").load(path).select("path").toLocalIterator()]
    return spark.createDataFrame([(n,) for n in names], "path string").repartition(max(1, len(names)))


def open_shard(path: str) -> BinaryIO:
    """A file of any file system that Arrow knows, to be read in pieces."""
    system, name = fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
    return system.open_input_file(name)


def read_tfrecord_census(spark: SparkSession, path: str) -> DataFrame:
    """(path, record, bytes, feature, n): value counts of the features of each record, one task for each shard file, one record in
    memory at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name in b.column(0).to_pylist():
                with open_shard(name) as stream:
                    for i, payload in enumerate(frames(stream)):
                        found = sorted(example_features(payload).items())
                        columns = list(zip(*[(name, i, len(payload), k, n) for k, n in found], strict=True)) or [()] * 5
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()), strict=True)], names=["path", "record", "bytes", "feature", "n"])

    return _shards(spark, path).mapInArrow(run, "path string, record long, bytes long, feature string, n long")


def read_tfrecords(spark: SparkSession, path: str) -> DataFrame:
    """(path, record, sha256, ints, floats, texts): the features of each record as maps by kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.map_(pa.string(), pa.list_(pa.int64())), pa.map_(pa.string(), pa.list_(pa.float64())), pa.map_(pa.string(), pa.list_(pa.binary())))
        for b in batches:
            for name in b.column(0).to_pylist():
                with open_shard(name) as stream:
                    for i, payload in enumerate(frames(stream)):
                        values = sorted(example_values(payload).items())
                        maps = [[(k, v) for k, v in values if v and isinstance(v[0], kind)] for kind in (int, float, bytes)]
                        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([i], pa.int64()), pa.array([hashlib.sha256(payload).hexdigest()]), *[pa.array([m], t) for m, t in zip(maps, kinds, strict=True)]], names=["path", "record", "sha256", "ints", "floats", "texts"])

    return _shards(spark, path).mapInArrow(run, "path string, record long, sha256 string, ints map<string,array<long>>, floats map<string,array<double>>, texts map<string,array<binary>>")


def row_groups(spark: SparkSession, path: str, column: str) -> DataFrame:
    """(file, row_group, rows, lo, hi) of the row groups of Parquet files, from their footers; where a footer has no statistics of the
    integer column, it is read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for name in b.column(0).to_pylist():
                with open_shard(name) as stream:
                    found = parquet.ParquetFile(stream)
                    at = found.schema_arrow.get_field_index(column)
                    for g in range(found.num_row_groups):
                        said = found.metadata.row_group(g).column(at).statistics if at >= 0 else None
                        if said is not None and said.has_min_max:
                            lo, hi = said.min, said.max
                        else:
                            values = found.read_row_group(g, columns=[column]).column(0)
                            lo, hi = (values.drop_null().to_numpy().min(), values.drop_null().to_numpy().max()) if len(values.drop_null()) else (None, None)
                        out.append((name, g, found.metadata.row_group(g).num_rows, None if lo is None else int(lo), None if hi is None else int(hi)))
            columns = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["file", "row_group", "rows", "lo", "hi"])

    return _shards(spark, path).mapInArrow(run, "file string, row_group long, rows long, lo long, hi long")


def read_batches(spark: SparkSession, path: str, columns: list[str], rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Columns of Parquet files on the driver, batch by batch and never more than one row group, for small indexes."""
    for r in spark.read.format("binaryFile").load(path).select("path").toLocalIterator():
        with open_shard(r.path) as stream:
            yield from parquet.ParquetFile(stream).iter_batches(rows, columns=columns)


MCAP = b"\x89MCAP0\r\n"


def container_problems(path: str) -> list[str]:
    """What is wrong with the ends of a message container: no magic bytes at the start or at the end, or no room for records."""
    with open_shard(path) as f:
        size = f.size()
        head = f.read(len(MCAP))
        f.seek(max(0, size - len(MCAP)))
        tail = f.read(len(MCAP))
    return [p for p, bad in (("start", head != MCAP), ("end", tail != MCAP), ("short", size < 2 * len(MCAP) + 1)) if bad]


def members(stream: TextIO, size: int = 1 << 16) -> Iterator[tuple[str, object]]:
    """Members of one large JSON object, each parsed by itself as the text comes in; at most one member is in memory."""
    read, text, at, decoder = partial(stream.read, size), "", 0, json.JSONDecoder()

    def token() -> str:
        nonlocal text, at
        while True:
            while at < len(text) and text[at] in " \t\r\n":
                at += 1
            if at < len(text):
                return text[at]
            text, at = read(), 0
            if not text:
                raise ValueError("the object does not end")

    def value():
        nonlocal text, at
        token()
        while True:
            try:
                found, end = decoder.raw_decode(text, at)
                if end < len(text):  # a number at the end of what is there may go on
                    at = end
                    return found
            except json.JSONDecodeError:
                pass
            more = read()
            if not more:
                raise ValueError("a member does not end")
            text, at = text[at:] + more, 0

    if token() != "{":
        raise ValueError("not an object")
    at += 1
    while token() != "}":
        key = value()
        if not isinstance(key, str) or token() != ":":
            raise ValueError("a member has no name")
        at += 1
        yield key, value()
        if token() == ",":
            at += 1
        elif text[at] != "}":
            raise ValueError("members are not separated")


def inventory(spark: SparkSession, path: str, shards: int = 256) -> DataFrame:
    """(path, length, modified, key, shard) of files, without reading them; key is the SHA-256 of the path, shard its first 64 bits
    modulo `shards`."""
    listed = spark.read.format("binaryFile").load(path).select("path", "length", F.col("modificationTime").alias("modified"))
    key = F.sha2("path", 256)
    number = F.conv(F.substring(key, 1, 16), 16, 10).cast("decimal(20,0)")
    return listed.withColumn("key", key).withColumn("shard", (number % shards).cast("int"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of the files of a finished export."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def verify(committed: DataFrame, found: DataFrame) -> DataFrame:
    """(path, issue): files that are missing, unexpected or changed against a manifest."""
    a, b = committed.select("path", F.col("sha256").alias("want")), found.select("path", F.col("sha256").alias("have"))
    issue = F.when(F.col("have").isNull(), "missing").when(F.col("want").isNull(), "unexpected").when(F.col("want") != F.col("have"), "changed")
    return a.join(b, "path", "full").select("path", issue.alias("issue")).where("issue is not null")


def export_split(df: DataFrame, path: str, split: str = "source_split", form: str = "json") -> None:
    """Write df in one folder for each split."""
    df.write.mode("errorifexists").partitionBy(split).format(form).save(path)
