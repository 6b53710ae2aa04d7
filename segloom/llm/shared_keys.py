"""Which sampled keys occur in more than one document.

Substring operators sample keys from texts such that documents with a common passage have a common key. Only keys of two
documents or more need a closer look. Keys travel packed, a few bytes each, and what a batch can tell by itself isn't sent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from segloom.llm.common import lean

#: Bits of a key that are compared within a bucket. Keys that are equal in these by chance only cost a closer look.
BITS = 32
#: Parts that one task's exchange is packed in, for each partition after it.
SPREAD = 4


def planes(values: np.ndarray, width: int) -> bytes:
    """The lowest `width` bytes of 64-bit integers, byte by byte, which compresses well."""
    return np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def squeezed(raw: bytes) -> bytes:
    """Compressed bytes; an exchange compresses too, but by far less."""
    return zstandard.compress(raw, 1)


def expanded(raw: bytes) -> bytes:
    return zstandard.decompress(raw)


def squeezed_text(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with `text` as compressed UTF-8 bytes, for an exchange; null stays null."""
    names = docs.columns
    schema = ", ".join(f"`{c}` {'binary' if c == text else docs.schema[c].dataType.simpleString()}" for c in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in lean(batches):
            small = pa.array([squeezed(t.as_buffer()) if t.is_valid else None for t in b.column(text)], pa.binary())
            yield pa.RecordBatch.from_arrays([small if c == text else b.column(c) for c in names], names=names)

    return docs.mapInArrow(run, schema)


def expanded_text(column: pa.Array) -> pa.Array:
    """The bytes of a column of squeezed_text()."""
    return pa.array([expanded(t.as_buffer()) if t.is_valid else None for t in column], pa.binary())


def unplanes(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, -1).T
    return out.reshape(-1).view("<i8")


def by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, indices), each bucket once; indices keep their order."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    cuts = np.nonzero(np.diff(bucket[order], prepend=-1))[0]
    for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
        yield int(bucket[order[a]]), order[a:b]


def bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((key.view(np.uint64) >> np.uint64(BITS)) % np.uint64(buckets)).astype(np.int64)


def hot_code(key: np.ndarray, buckets: int) -> np.ndarray:
    """What stands for a key among the hot ones: its bucket and low bits."""
    return (bucket_of(key, buckets) << BITS) | (key & np.int64(2**BITS - 1))


SCHEMA = "bucket int, known boolean, keys binary, docs binary, many binary"


def shared_keys(docs: DataFrame, keys_of: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], buckets: int, hot: int | None = None) -> DataFrame:
    """(doc_id, keys binary): packed low bits of those of each document's keys that another document has too; several rows a document.

    With `hot`, rows without doc_id hold the hot_code() of keys that so many documents or more have.

    docs: doc_id long, not null, and text. keys_of gives (row, 64-bit key) of a batch of texts. A key that several documents of a
    batch have is settled there, and one of them speaks for it to other batches, so a key of a third of all documents sends one
    entry a batch.
    """
    low = np.int64(2**BITS - 1)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in lean(batches, 5000):
            row, key = keys_of(b.column(1))
            if not len(row):
                continue
            doc = b.column(0).to_numpy()[row]
            order = np.lexsort((doc, key))
            key, doc = key[order], doc[order]
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])])
            key, doc = key[new], doc[new]  # each key once a document
            first = np.concatenate([[True], key[1:] != key[:-1]])
            size = np.diff(np.concatenate([np.nonzero(first)[0], [len(key)]]))
            many = np.repeat(size, size)
            out = []
            for known, part in ((False, first), (True, many > 1)):
                k, d, m = key[part], doc[part], many[part]
                if known:  # any bucket will do; a document's rows stay together
                    where = (d.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
                else:
                    where = bucket_of(k, buckets)
                order = np.argsort(d, kind="stable")  # ids in order take few bytes
                k, d, m = k[order], d[order], m[order]
                out += [(i, known, planes(k[at], BITS // 8), squeezed(planes(d[at], 8)), b"" if known else squeezed(planes(m[at], 2))) for i, at in by_bucket(where[order])]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "known", "keys", "docs", "many"])

    def settle(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        said = [r for r in rows if r["known"]]
        popular = np.zeros(0, np.int64)
        key = [unplanes(r["keys"], BITS // 8) for r in said]
        doc = [unplanes(expanded(r["docs"]), 8) for r in said]
        asked = [r for r in rows if not r["known"]]
        if asked:
            k = np.concatenate([unplanes(r["keys"], BITS // 8) for r in asked])
            d = np.concatenate([unplanes(expanded(r["docs"]), 8) for r in asked])
            m = np.concatenate([unplanes(expanded(r["many"]), 2) for r in asked])
            order = np.argsort(k, kind="stable")
            k, d, m = k[order], d[order], m[order]
            starts = np.nonzero(np.concatenate([[True], k[1:] != k[:-1]]))[0]
            size = np.diff(np.concatenate([starts, [len(k)]]))
            found = np.repeat(size > 1, size) & (m == 1)
            if hot:
                popular = k[starts][np.add.reduceat(m, starts) >= hot] & low
            key.append(k[found])
            doc.append(d[found])
        key, doc = np.concatenate(key) & low, np.concatenate(doc)
        order = np.argsort(doc, kind="stable")
        key, doc = key[order], doc[order]
        at = np.concatenate([np.nonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))[0], [len(doc)]]) if len(doc) else np.zeros(1, int)
        ids, packed = doc[at[:-1]].tolist(), [planes(key[a:b], BITS // 8) for a, b in zip(at[:-1], at[1:], strict=True)]
        if len(popular):
            ids.append(None)
            packed.append(((np.int64(rows[0]["bucket"]) << BITS) | popular).tobytes())
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "keys": pa.array(packed, pa.binary())})

    return docs.select("doc_id", "text").mapInArrow(send, SCHEMA).groupBy("bucket").applyInArrow(settle, "doc_id long, keys binary")
