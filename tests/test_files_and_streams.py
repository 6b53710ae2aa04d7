"""Record files, commits and incremental forms."""

import io
import struct

import pytest
from pyspark.sql import functions as F

from segloom.sources import files
from segloom.streaming import incremental


def test_jsonl(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a":1}\n\n{"a":2}\n{"a":')
    rows = files.read_jsonl(spark, str(tmp_path / "a.jsonl"), "a long", tolerate_last=True).collect()
    assert sorted(r.a for r in rows) == [1, 2]
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(tmp_path / "a.jsonl"), "a long").collect()
    (tmp_path / "b.jsonl").write_text('{"a":\n{"a":2}\n')
    with pytest.raises(ValueError):
        files.read_jsonl(spark, str(tmp_path / "b.jsonl"), "a long", tolerate_last=True)


def test_keyed(spark, tmp_path):
    (tmp_path / "v.json").write_text('{\n"0":{"n":1},\n"7":{"n":2}\n}\n')
    assert sorted((r.key, r.value.n) for r in files.read_keyed(spark, str(tmp_path / "v.json"), "n long").collect()) == [("0", 1), ("7", 2)]


def test_episode_paths(spark, tmp_path):
    spark.createDataFrame([(1.0,)], "x double").coalesce(1).write.parquet(str(tmp_path / "raw"))
    part = next((tmp_path / "raw").glob("*.parquet"))
    target = tmp_path / "data" / "chunk-000"
    target.mkdir(parents=True)
    part.rename(target / "episode_000012.parquet")
    got = files.read_episodes(spark, str(target), ["x", "absent"]).collect()
    assert [(r.episode_index, r.x) for r in got] == [(12, 1.0)] and "absent" not in got[0]


def record(payload):
    size = struct.pack("<Q", len(payload))
    return size + struct.pack("<I", files.masked_crc32c(size)) + payload + struct.pack("<I", files.masked_crc32c(payload))


def message(number, payload):
    return bytes([number << 3 | 2, len(payload)]) + payload


def test_tfrecord(spark, tmp_path):
    floats = message(2, message(1, struct.pack("<3f", 1, 2, 3)))
    ints = message(3, message(1, bytes([1, 0x80, 1])))
    example = message(1, message(1, message(1, b"f") + message(2, floats)) + message(1, message(1, b"i") + message(2, ints)))
    (tmp_path / "s.tfrecord").write_bytes(record(example) * 2)
    rows = files.read_tfrecord_census(spark, str(tmp_path)).collect()
    assert sorted((r.record, r.feature, r.n) for r in rows) == [(0, "f", 3), (0, "i", 2), (1, "f", 3), (1, "i", 2)]
    whole = {r.record: r for r in files.read_tfrecords(spark, str(tmp_path)).collect()}
    assert (whole[1].floats, whole[1].ints, whole[1].texts) == ({"f": [1.0, 2.0, 3.0]}, {"i": [1, 128]}, {})
    with (tmp_path / "s.tfrecord").open("rb") as f:
        assert list(files.record_sizes(f)) == [(0, len(example)), (len(example) + 16, len(example))]
    bad = bytearray(record(example))
    bad[20] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        list(files.frames(io.BytesIO(bytes(bad))))
    with pytest.raises(ValueError, match="truncated"):
        list(files.frames(io.BytesIO(record(example)[:-1])))
    assert files.masked_crc32c(b"123456789") == ((0xE3069283 >> 15 | 0xE3069283 << 17) + 0xA282EAD8) & 0xFFFFFFFF


def test_manifest_and_inventory(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).write_text(name)
    before = spark.createDataFrame(files.manifest(spark, str(tmp_path)).collect())
    assert files.verify(before, files.manifest(spark, str(tmp_path))).count() == 0
    (tmp_path / "a").write_text("x")
    (tmp_path / "b").unlink()
    (tmp_path / "c").write_text("c")
    assert sorted(r.issue for r in files.verify(before, files.manifest(spark, str(tmp_path))).collect()) == ["changed", "missing", "unexpected"]
    rows = files.inventory(spark, str(tmp_path)).collect()
    assert all(r.shard == int(r.key[:16], 16) % 256 for r in rows) and len(rows) == 2


def test_export_split(spark, tmp_path):
    df = spark.createDataFrame([(1, "train"), (2, "val")], "x long, source_split string")
    files.export_split(df, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out" / "source_split=val")).collect()[0].x == 2


def test_journal(spark):
    journal = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 1, "z")], "k long, at long, s string")
    assert sorted((r.k, r.s) for r in incremental.latest(journal, ["k"], ["at"]).collect()) == [(1, "c"), (2, "z")]
    assert [r.at for r in incremental.first_of_key(journal, ["k"], ["at"]).where("k = 1").collect()] == [1]
    assert incremental.pending(journal, journal.where("k = 1"), ["k"]).count() == 1
    results = spark.createDataFrame([(0, True), (1, True), (2, False), (3, True)], "i long, ok boolean")
    assert sorted(r.i for r in incremental.committed_prefix(results, "i", "ok").collect()) == [0, 1]
    assert incremental.run_identity(journal).collect() == incremental.run_identity(journal.orderBy(F.desc("at"))).collect()


def test_stream_sessions_and_stages(spark, tmp_path):
    rows = [(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:05:00"), (1, "2024-01-01 02:00:00"), (2, "2024-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "k long, s string").select("k", F.to_timestamp("s").alias("ts"))
    df.write.parquet(str(tmp_path / "in"))
    assert sorted((r.k, r.n) for r in incremental.sessions(df, "ts", "k", "30 minutes", "1 hour").collect()) == [(1, 1), (1, 2), (2, 1)]
    stream = incremental.read_events(spark, str(tmp_path / "in"), "k long, ts timestamp")
    q = incremental.stage(stream, lambda d: d.groupBy("k").count(), str(tmp_path / "out"), str(tmp_path / "check"))
    q.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() >= 2
    again = incremental.stage(incremental.read_events(spark, str(tmp_path / "in"), "k long, ts timestamp"), lambda d: d, str(tmp_path / "out"), str(tmp_path / "check"))
    again.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).groupBy().sum("count").first()[0] == 4
