"""Removal of repeated substrings by sorting suffixes.

Windows are the 50-byte beginnings of suffixes. Each is filed under its minimizer, the 24-byte piece in it of least hash, so equal
windows meet without sending all of them: neighbours with one minimizer travel as one string, and only those whose minimizer
another document has. Their windows are then sorted, deep-shallow: multikey quicksort over 8-byte characters down to a shallow
depth, and blind tries for the groups that still agree there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.llm.common import cut, lean, shuffle_width, text_bytes
from segloom.llm.shared_keys import BITS, SPREAD, bucket_of, by_bucket, expanded, expanded_text, hot_code, planes, shared_keys, squeezed, squeezed_text, unplanes

WINDOW, PIECE = 50, 24
#: Window starts that are worked on at once; a document may go over several steps.
STEP = 1 << 19
SHALLOW = 16

_rng = np.random.default_rng(20)
BYTE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: From BYTES[i] on, an integer has more than i + 1 bytes.
BYTES = np.array([1 << 8 * i for i in range(1, 8)], np.uint64)
ODD = _rng.integers(0, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def piece_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the PIECE bytes at each position."""
    one = BYTE[data]
    two = one[:-1] * ODD[0] + one[1:]
    four = two[:-2] * ODD[1] + two[2:]
    eight = four[:-4] * ODD[2] + four[4:]
    sixteen = eight[:-8] * ODD[3] + eight[8:]
    h = sixteen[:-8] * ODD[4] + eight[16:]
    h ^= h >> np.uint64(32)
    h *= ODD[5]
    h ^= h >> np.uint64(29)
    return h


def runs(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of windows of one minimizer: (row, key, first window, last window), positions in data.

    Windows lie within a row. The minimizer depends on the window's bytes alone: the leftmost piece of least 40-bit hash.
    """
    span = WINDOW - PIECE + 1
    low = np.uint64(2**24 - 1)
    for start in range(0, len(data) - WINDOW + 1, STEP):
        part = data[start : start + STEP + WINDOW - 1]
        h = piece_hashes(part)
        k = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        for d in (1, 2, 4, 8):
            k = np.minimum(k[:-d], k[d:])
        k = np.minimum(k[: len(k) - (span - 16)], k[span - 16 :])  # least of `span` pieces, for each window
        n = len(part) - WINDOW + 1
        pos = (k[:n] & low).astype(np.int64)
        a = int(np.searchsorted(at, start, "right")) - 1
        b = int(np.searchsorted(at, start + n, "left"))
        row = np.repeat(np.arange(a, b), np.diff(np.clip(at[a : b + 1], start, start + n)))
        pos[np.repeat(at[a + 1 : b + 1], np.diff(np.clip(at[a : b + 1], start, start + n))) < np.arange(start, start + n) + WINDOW] = -1  # it would go on in the next row
        turn = np.nonzero(np.concatenate([[True], (pos[1:] != pos[:-1]) | (row[1:] != row[:-1])]))[0]
        end = np.concatenate([turn[1:], [n]]) - 1
        good = pos[turn] >= 0
        turn, end = turn[good], end[good]
        yield row[turn], h[pos[turn]].view(np.int64), start + turn, start + end


def keys_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    parts = [(r, k) for r, k, _, _ in runs(*text_bytes(column))]
    return (np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])) if parts else (np.zeros(0, int), np.zeros(0, np.int64))


def characters(data: np.ndarray) -> np.ndarray:
    """The 8 bytes at each position, as an integer that compares like them."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.lib.stride_tricks.sliding_window_view(padded, 8)[: len(data)].copy().view(">u8").ravel().astype(np.uint64)


def suffix_classes(data: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Class of each suffix data[pos:], such that two have the same one just if their first WINDOW bytes are equal.

    Deep-shallow sorting of all suffixes at once. Shallow: multikey quicksort, whose characters are 8 bytes; each pass sorts by the
    next one within groups equal so far. Deep: a blind trie for each group left, grown breadth first; a node skips to the first
    byte in which its members differ, found by comparing all with one of them, and branches by that byte alone.
    """
    word = characters(data)
    out = np.arange(len(pos))
    live, group = np.arange(len(pos)), np.zeros(len(pos), np.int64)
    for depth in range(0, SHALLOW, 8):
        ch = word[pos[live] + depth]
        order = np.lexsort((ch, group)) if depth else np.argsort(ch)
        live, group, ch = live[order], group[order], ch[order]
        live, group = _regroup(live, group, ch)
    deep = (*range(SHALLOW, WINDOW - 7, 8), WINDOW - 8)
    while len(live):
        starts = np.nonzero(np.concatenate([[True], group[1:] != group[:-1]]))[0]
        size = np.diff(np.concatenate([starts, [len(live)]]))
        lead = np.repeat(live[starts], size)
        skip = np.full(len(live), WINDOW)
        for d in deep[::-1]:
            diff = word[pos[live] + d] ^ word[pos[lead] + d]
            some = diff != 0
            skip[some] = d + 7 - np.searchsorted(BYTES, diff[some], "right")
        node = np.minimum.reduceat(skip, starts)  # depth of the group's branching byte
        leaf = np.repeat(node >= WINDOW, size)
        out[live[leaf]] = lead[leaf]
        live, group, at = live[~leaf], group[~leaf], np.repeat(node, size)[~leaf]
        ch = data[pos[live] + at]
        order = np.argsort(group * 256 + ch)
        live, group = _regroup(live[order], group[order], ch[order])
    return out


def _regroup(live: np.ndarray, group: np.ndarray, ch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups split by character, without those of one member."""
    new = np.concatenate([[True], (group[1:] != group[:-1]) | (ch[1:] != ch[:-1])]) if len(live) else np.zeros(0, bool)
    group = np.cumsum(new)
    last = np.concatenate([new[1:], [True]]) if len(live) else new
    keep = ~(new & last)
    return live[keep], group[keep]


def later_windows(data: np.ndarray, start: np.ndarray, windows: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs (string, first window, last window) of windows that a string of a smaller doc has too.

    String i is data[start[i] : start[i] + windows[i] + WINDOW - 1] and has windows[i] windows.
    """
    string = np.repeat(np.arange(len(start)), windows)
    offset = np.arange(len(string)) - np.repeat(np.cumsum(windows) - windows, windows)
    kind = suffix_classes(data, start[string] + offset)
    least = np.full(len(string), np.iinfo(np.int64).max)
    np.minimum.at(least, kind, doc[string])
    late = np.nonzero(least[kind] < doc[string])[0]
    if not len(late):
        return late, late, late
    new = np.concatenate([[True], (late[1:] != late[:-1] + 1) | (string[late[1:]] != string[late[:-1]])])
    end = np.concatenate([np.nonzero(new)[0][1:], [len(late)]]) - 1
    return string[late[new]], offset[late[new]], offset[late[end]]


#: A minimizer is hot if HOT documents have it, or one in HOT_SHARE if that is more: of such there are no more than HOT_SHARE times the
#: minimizers of a document, so a list of them can go to all tasks.
HOT, HOT_SHARE = 1000, 10_000
PARTS = "bucket int, known boolean, doc binary, first binary, windows binary, times binary, data binary"
SPANS = "doc_id long, tag long, lo long, hi long"


def tag_of(raw: bytes) -> int:
    """31 bits of a text's hash; a position in the text and its tag are one integer."""
    return xxhash.xxh3_64_intdigest(raw) >> 33


def candidates(joined: DataFrame, buckets: int, hot: np.ndarray) -> DataFrame:
    """PARTS rows: the strings of each document's windows whose minimizer another document has.

    joined: doc_id, text (squeezed), keys (array of binary). Strings of one content that are worked on together are sent once, for the
    smallest doc_id, with all their places in it; the windows of the others are known to be late, and go along as such without their
    bytes. Strings of a hot minimizer are taken apart in their windows, and each is filed under a hash of all of it, so a hot
    minimizer, as of a template with varying ends, is dealt to all buckets.
    """
    hot = np.sort(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in lean(batches, 5000):
            data, at = text_bytes(expanded_text(b.column(1)))
            doc = b.column(0).to_numpy()
            whole = data.tobytes()
            tags = np.array([tag_of(whole[a:z]) for a, z in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], np.int64)
            want = [np.concatenate([unplanes(x, BITS // 8) for x in k]) for k in b.column(2).to_pylist()]
            wanted = np.unique(np.concatenate([w ^ (np.int64(i) << BITS) for i, w in enumerate(want)]))
            parts: dict[tuple[int, bool], list] = {}
            for row, key, first, last in runs(data, at):
                tag = (key & np.int64(2**BITS - 1)) ^ (row << BITS)
                hit = np.searchsorted(wanted, tag)
                hit = wanted[np.minimum(hit, len(wanted) - 1)] == tag
                row, key, first, last = row[hit], key[hit], first[hit], last[hit]
                if not len(row):
                    continue
                place = bucket_of(key, buckets)
                apart = np.zeros(len(key), bool)
                if len(hot):
                    code = hot_code(key, buckets)
                    apart = hot[np.minimum(np.searchsorted(hot, code), len(hot) - 1)] == code
                if apart.any():
                    n = np.where(apart, last - first + 1, 1)
                    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    row, first, last, place, apart = (np.repeat(x, n) for x in (row, first, last, place, apart))
                    first = first + step
                    last = np.where(apart, first, last)
                order = np.argsort(doc[row], kind="stable")
                row, first, last, place, apart = (x[order] for x in (row, first, last, place, apart))
                seen: dict[bytes, int] = {}
                base = int(first.min())
                raw = data[base : last.max() + WINDOW].tobytes()
                texts = [raw[a:z] for a, z in zip((first - base).tolist(), (last - base + WINDOW).tolist(), strict=True)]
                mine = np.array([seen.setdefault(t, i) for i, t in enumerate(texts)])
                late = doc[row[mine]] < doc[row]
                known, own = np.nonzero(late)[0], np.nonzero(~late)[0]
                own = own[np.argsort(mine[own], kind="stable")]  # the places of a string stand together
                lead = mine[own] == own
                times = np.diff(np.concatenate([np.nonzero(lead)[0], [len(own)]]))
                own, at_ = own[lead], own
                for i in np.nonzero(apart[own])[0].tolist():
                    place[own[i]] = xxhash.xxh3_64_intdigest(texts[own[i]]) % buckets
                spot = (tags[row] << 32) | (first - at[row])
                ends = np.cumsum(times)
                for i, which in by_bucket(place[own]):
                    spread_ = np.repeat(ends[which] - times[which], times[which]) + np.arange(times[which].sum()) - np.repeat(np.cumsum(times[which]) - times[which], times[which])
                    kept = parts.setdefault((i, False), [[], [], [], [], []])
                    j = own[which]
                    for column, x in zip(kept, (doc[row[j]], spot[at_[spread_]], last[j] - first[j] + 1, times[which], [texts[t] for t in j.tolist()]), strict=True):
                        column.append(x)
                for i, which in by_bucket((doc[row[known]].view(np.uint64) % np.uint64(buckets)).astype(np.int64)):
                    j = known[which]
                    kept = parts.setdefault((i, True), [[], [], [], [], []])
                    for column, x in zip(kept, (doc[row[j]], spot[j], last[j] - first[j] + 1, j[:0], []), strict=True):
                        column.append(x)
            if parts:
                out = []
                for (i, known), (d, f, n, k, t) in parts.items():
                    out.append((i, known, squeezed(planes(np.concatenate(d), 8)), squeezed(planes(np.concatenate(f), 8)), planes(np.concatenate(n), 1), squeezed(planes(np.concatenate(k), 4)), squeezed(b"".join([x for part in t for x in part]))))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.bool_(), *[pa.binary()] * 5), strict=True)], names=["bucket", "known", "doc", "first", "windows", "times", "data"])

    return joined.select("doc_id", "text", "keys").mapInArrow(run, PARTS)


def late_spans(parts: DataFrame) -> DataFrame:
    """(doc_id, tag, lo, hi): bytes lo to hi of a text that windows of smaller documents cover; spans of several tasks may overlap."""

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        known = [r for r in rows if r["known"]]
        doc = [unplanes(expanded(r["doc"]), 8) for r in known]
        lo = [unplanes(expanded(r["first"]), 8) for r in known]
        hi = [x + unplanes(r["windows"], 1) for x, r in zip(lo, known, strict=True)]
        sent = [r for r in rows if not r["known"]]
        if sent:
            d, f = (np.concatenate([unplanes(expanded(r[c]), 8) for r in sent]) for c in ("doc", "first"))
            n = np.concatenate([unplanes(r["windows"], 1) for r in sent])
            times = np.concatenate([unplanes(expanded(r["times"]), 4) for r in sent])
            data = np.frombuffer(b"".join([expanded(r["data"]) for r in sent]), np.uint8)
            length = n + WINDOW - 1
            string, a, z = later_windows(data, np.cumsum(length) - length, n, d)
            many = times[string]
            place = np.repeat((np.cumsum(times) - times)[string], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            doc.append(np.repeat(d[string], many))
            lo.append(f[place] + np.repeat(a, many))
            hi.append(f[place] + np.repeat(z, many) + 1)
        doc, lo, hi = joined(np.concatenate(doc), np.concatenate(lo), np.concatenate(hi) + (WINDOW - 1))
        low = np.int64(2**32 - 1)
        return pa.table({"doc_id": doc, "tag": lo >> 32, "lo": lo & low, "hi": hi & low})

    return parts.groupBy("bucket").applyInArrow(run, SPANS)


def joined(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each document with those that touch made one; they are of like length, so ends rise with beginnings but for a window."""
    order = np.lexsort((lo, doc))
    doc, lo, hi = doc[order], lo[order], hi[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (lo[1:] > hi[:-1])
    at = np.nonzero(new)[0]
    return doc[at], lo[at], np.maximum.reduceat(hi, at) if len(at) else hi


def merge(lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, int]]:
    """Union of spans as maximal runs; spans that touch are one run."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.concatenate([[True], lo[1:] > hi[:-1]])
    return list(zip(lo[new].tolist(), hi[np.concatenate([np.nonzero(new)[0][1:], [len(lo)]]) - 1].tolist(), strict=True))


def repeated(docs: DataFrame) -> DataFrame:
    """(doc_id, spans array<struct<lo,hi,tag>>): of each document with any, bytes to remove; spans may overlap.

    docs: doc_id long and text. A byte is removed if a 50-byte string that covers it also starts in a document with a smaller
    doc_id; all is judged on the input. Null texts are empty; rows with a null doc_id neither remove nor are removed. Rows with one
    doc_id do not count as each other's repeats; if their texts differ, each is judged by itself, and `tag` tells whose a span is.
    """
    spark = docs.sparkSession
    buckets = SPREAD * shuffle_width(spark)
    hot = max(HOT, docs.count() // HOT_SHARE)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).where(f"doc_id is not null and octet_length(text) >= {WINDOW}")
    shared = cut(shared_keys(docs, keys_of, buckets, hot), "keys")
    popular = [np.frombuffer(r["keys"], np.int64) for r in shared.where("doc_id is null").select("keys").toLocalIterator()]
    flags = shared.where("doc_id is not null").groupBy("doc_id").agg(F.collect_list("keys").alias("keys"))
    found = late_spans(candidates(squeezed_text(docs).join(flags, "doc_id"), buckets, np.concatenate([np.zeros(0, np.int64), *popular])))
    return found.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "tag"))).alias("spans"))


def remove(docs: DataFrame, spans: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """docs with their spans removed: columns of docs, `text` as what is left (binary; null if not keep_text), n_bytes, n_removed,
    n_spans and kept_sha256."""
    docs = docs.drop("_id", "_spans", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    rest = [c for c in docs.columns if c != text]
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest] + [f"`{text}` binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in lean(batches):
            texts, sizes, gone, counts, sums = [], [], [], [], []
            for t, s in zip(b.column(text), b.column("_spans"), strict=True):
                raw = expanded(t.as_buffer()) if t.is_valid else b""
                runs_ = []
                if s.is_valid and len(s):
                    lo, hi, tag = (s.values.field(k).to_numpy() for k in ("lo", "hi", "tag"))
                    own = tag == tag_of(raw)
                    runs_ = merge(lo[own], hi[own]) if own.any() else []
                edge = [0, *[x for r in runs_ for x in r], len(raw)]
                left = b"".join([raw[a:z] for a, z in zip(edge[::2], edge[1::2], strict=True)])
                texts.append(left if keep_text else None)
                sizes.append(len(raw))
                gone.append(len(raw) - len(left))
                counts.append(len(runs_))
                sums.append(hashlib.sha256(left).hexdigest())
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in rest], pa.array(texts, pa.binary()), *[pa.array(x, pa.int64()) for x in (sizes, gone, counts)], pa.array(sums, pa.string())], names=[*rest, text, "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    joined = squeezed_text(docs, text).join(spans.select(F.col("doc_id").alias("_id"), F.col("spans").alias("_spans")), F.col("doc_id") == F.col("_id"), "left").drop("_id")
    return joined.select(*rest, text, "_spans").mapInArrow(run, schema)


def op2(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove(docs, cut(repeated(docs), "spans"), keep_text=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
