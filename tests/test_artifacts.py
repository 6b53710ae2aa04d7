"""Commits, journals, installs, locks, and readers of record files."""

import io
import json
import threading

import numpy as np
import pyarrow as pa
import pytest
from pyarrow import parquet

from segloom.operators import ingest, reasoning
from segloom.sources import artifacts, files


def test_writes_are_whole(tmp_path):
    artifacts.write_json(tmp_path / "d" / "a.json", {"b": 1, "a": "ä"})
    assert json.loads((tmp_path / "d" / "a.json").read_text()) == {"a": "ä", "b": 1}
    artifacts.write_jsonl(tmp_path / "a.jsonl", [{"x": 1}, {"x": 2}])
    with pytest.raises(ValueError):
        artifacts.write_jsonl(tmp_path / "a.jsonl", [{"x": float("nan")}])
    assert (tmp_path / "a.jsonl").read_text() == '{"x":1}\n{"x":2}\n'
    artifacts.write_csv(tmp_path / "a.csv", [{"n": 1, "t": "x,y"}])
    assert (tmp_path / "a.csv").read_text().splitlines() == ["n,t", '1,"x,y"']
    artifacts.save_arrays(tmp_path / "a.npz", {"x": np.arange(6).reshape(2, 3)})
    assert (artifacts.load_arrays(tmp_path / "a.npz")["x"] == np.arange(6).reshape(2, 3)).all()
    assert not [p for p in tmp_path.rglob(".*")] and artifacts.utc_now().endswith("+00:00")


def test_commit_is_verified_and_not_repeated(tmp_path):
    def filled(text):
        folder = artifacts.staging(tmp_path, "s")
        (folder / "sub").mkdir()
        (folder / "sub" / "f").write_text(text)
        return folder

    artifacts.commit(filled("x"), tmp_path / "final", "one")
    artifacts.commit(filled("x"), tmp_path / "final", "one")
    assert artifacts.verify_commit(tmp_path / "final", "one") == [] and artifacts.verify_commit(tmp_path / "final", "two") == ["identity"]
    with pytest.raises(RuntimeError):
        artifacts.commit(filled("x"), tmp_path / "final", "two")
    (tmp_path / "final" / "sub" / "f").write_text("y")
    (tmp_path / "final" / "g").write_text("z")
    assert artifacts.verify_commit(tmp_path / "final", "one") == ["unexpected: g", "changed: sub/f"]


def test_install_rolls_back(tmp_path, monkeypatch):
    release, target = tmp_path / "r", tmp_path / "t"
    for folder, values in ((release, {"a": "new", "b": "new"}), (target, {"a": "old", "c": "kept"})):
        folder.mkdir()
        for name, text in values.items():
            (folder / name).write_text(text)
    manifest = {n: artifacts.digest_of(release / n) for n in ("a", "b")}
    with pytest.raises(ValueError):
        artifacts.install(release, target, manifest | {"a": "0"})
    copy = artifacts.shutil.copyfile
    monkeypatch.setattr(artifacts.shutil, "copyfile", lambda a, b: (_ for _ in ()).throw(OSError("full")) if a.name == "b" else copy(a, b))
    with pytest.raises(OSError):
        artifacts.install(release, target, manifest)
    assert {p.name: p.read_text() for p in target.iterdir()} == {"a": "old", "c": "kept"}
    monkeypatch.undo()
    assert artifacts.install(release, target, manifest) == ["a"] and artifacts.install(release, target, manifest) == []
    assert {p.name: p.read_text() for p in target.iterdir()} == {"a": "new", "b": "new", "c": "kept"}


def test_journal_repairs_a_torn_tail(tmp_path):
    journal = artifacts.Journal(tmp_path / "j")
    places = [journal.append({"n": i}) for i in range(3)]
    assert [journal.read(at)["n"] for at in places] == [0, 1, 2]
    with (tmp_path / "j").open("ab") as f:
        f.write(b'{"n": 3')
    again = artifacts.Journal(tmp_path / "j")
    assert again.torn.read_bytes() == b'{"n": 3' and again.append({"n": 4}) == places[2] + len('{"n":2}\n')
    (tmp_path / "k").write_text("[1]\n")
    with pytest.raises(ValueError):
        artifacts.Journal(tmp_path / "k")


def test_locks_retries_and_bounded_work(tmp_path):
    with artifacts.lock(tmp_path / "l"):
        with pytest.raises(BlockingIOError), artifacts.lock(tmp_path / "l"):
            pass
    with artifacts.lock(tmp_path / "l", True):
        pass
    taken, gate = [], threading.Event()

    def source():
        for i in range(50):
            taken.append(i)
            yield i

    def work(i):
        if i == 0:
            gate.wait(5)
        if i == 3:
            raise ValueError(i)
        return i * i

    found = {}
    for item, result, error in artifacts.bounded_map(source(), work, 2):
        assert len(taken) <= len(found) + 5
        found[item] = result
        gate.set()
        assert (error is not None) == (item == 3)
    assert found == {i: None if i == 3 else i * i for i in range(50)}
    pauses = []
    assert artifacts.retried(lambda k: k if k == 2 else 1 / 0, sleep=pauses.append) == 2 and pauses == [0.5, 1.0]
    with pytest.raises(ZeroDivisionError):
        artifacts.retried(lambda k: 1 / 0, 2, sleep=pauses.append)
    turn = artifacts.round_robin(["a", "b"])
    assert [turn() for _ in range(3)] == ["a", "b", "a"]


def test_members_of_a_large_object():
    value = {f"k{i}": [i, {"x": "}" * i, "y": None}, -1.5e3] for i in range(50)} | {"n": 12345}
    for size in (1, 7, 1000):
        assert dict(files.members(io.StringIO(json.dumps(value)), size)) == value
    assert dict(files.members(io.StringIO(" { } "))) == {}
    for bad in ("[1]", '{"a": 1', '{"a" 1}', '{"a": 1 "b": 2}', "{1: 2}"):
        with pytest.raises(ValueError):
            list(files.members(io.StringIO(bad), 3))


def test_row_groups_and_batches(spark, tmp_path):
    table = pa.table({"episode_index": list(range(100)), "x": [0.5] * 100})
    parquet.write_table(table, tmp_path / "a.parquet", row_group_size=30)
    parquet.write_table(table.slice(0, 10), tmp_path / "b.parquet", write_statistics=False)
    got = sorted((r.file[-9:], r.row_group, r.rows, r.lo, r.hi) for r in files.row_groups(spark, str(tmp_path), "episode_index").collect())
    assert got == [("a.parquet", 0, 30, 0, 29), ("a.parquet", 1, 30, 30, 59), ("a.parquet", 2, 30, 60, 89), ("a.parquet", 3, 10, 90, 99), ("b.parquet", 0, 10, 0, 9)]
    assert sum(b.num_rows for b in files.read_batches(spark, str(tmp_path), ["episode_index"], 16)) == 110


def test_container_ends(tmp_path):
    (tmp_path / "good").write_bytes(files.MCAP + b"records" + files.MCAP)
    (tmp_path / "cut").write_bytes(files.MCAP + b"rec")
    (tmp_path / "other").write_bytes(b"")
    assert [files.container_problems(str(tmp_path / n)) for n in ("good", "cut", "other")] == [[], ["end", "short"], ["start", "end", "short"]]


def test_sorted_write_and_markdown(spark, tmp_path):
    rows = spark.createDataFrame([(i % 7, i) for i in range(200)], "k int, v int").repartition(5)
    artifacts.write_sorted(rows, str(tmp_path / "out"), ["k", "v"])
    parts = [parquet.read_table(p).to_pylist() for p in sorted((tmp_path / "out").glob("*.parquet"))]
    flat = [(r["k"], r["v"]) for part in parts for r in part]
    assert flat == sorted(flat) and len(flat) == 200
    lines = artifacts.markdown(spark.createDataFrame([("b", None), ("a", 1)], "n string, x int"), ["n"]).orderBy("line").collect()
    assert [r.text for r in lines] == ["| n | x |", "|-|-|", "| a | 1 |", "| b |  |"]


def test_rounds_and_adapters(spark):
    rows = spark.createDataFrame([(1, "aaa"), (2, "b")], "i long, t string")
    seen = reasoning.annotate(rows, ["i"], lambda row, n, said: row["t"] * n + "".join(said), {"long": lambda d, row: None if len(d) >= 6 else "too short"}, 2, "string").collect()
    assert {r.i: (r.accepted, r.draft, r.problems) for r in seen} == {1: (2, "aaaaaalong", {}), 2: (2, "bblong", {})}
    with pytest.raises(ValueError):
        ingest.adapt({"none": rows})
    with pytest.raises(ValueError):
        ingest.adapt({})


def test_aligned_streams_take_the_past_and_the_nearest(spark):
    rows = [(1, "clock", 10, 1, 0), (1, "clock", 20, 2, 0), (1, "a", 10, 3, 5), (1, "a", 10, 4, 6), (1, "a", 21, 5, 7), (1, "b", 8, 6, 1), (1, "b", 12, 7, 2), (2, "clock", 5, 8, 0)]
    df = spark.createDataFrame(rows, "episode long, topic string, t long, id long, value long")
    got = {(r.episode, r.t): r for r in ingest.aligned_streams(df, "clock", ["a"], ["b"], 5).collect()}
    assert (got[1, 10].a.value, got[1, 10].b.value, got[1, 10].b.skew) == (6, 1, 2)
    assert (got[1, 20].a.value, got[1, 20].a.code, got[1, 20].b.value, got[1, 20].b.code) == (6, "late", 2, "late")
    assert got[2, 5].a.code == got[2, 5].b.code == "missing"
