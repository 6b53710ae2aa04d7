"""Packing of tokenised documents by cutting-stock column generation.

A linear program over patterns of piece lengths is solved by column generation: a knapsack dynamic program prices new patterns.
The rounded pattern counts are then dealt to pieces by their rank within each length class.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segloom.llm.common import cut, lean, spans_of, text_bytes
from segloom.llm.mixing import buckets_for

LIMIT = 4096
#: Lengths are grouped in classes of so many tokens for the linear program, which so has LIMIT / WIDTH rows at most.
WIDTH = 16
#: Words whose ids a worker remembers in each of two generations; longer words are not kept. Bytes of text encoded at once.
WORDS, LONGEST, TOGETHER = 200_000, 40, 4 << 20
#: Marks that may end a word of letters and are then a token run of their own.
MARKS = ".,!?;:%&*$#|"


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers, for vocabularies with word ends.

    Such a vocabulary drops white space and case and never joins what white space separates, so a text is put in lower case (A-Z),
    split at ASCII white space, and each distinct word is encoded once. Words of letters are looked up without the marks after
    them, and those not yet known are encoded in one string: each gives exactly one id that ends a word, which tells them apart. A
    vocabulary that is not so is refused.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        suffix = self.tokenizer.model.end_of_word_suffix
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            ends[i] = bool(suffix) and token.endswith(suffix)
        self.ends = ends
        probe = "It's  a Probe,\tof\n\n9 WORDS: don't... \r\nx"
        if b"".join(self._plain([probe])) != b"".join(self._plain(probe.lower().split())):
            raise ValueError(f"{path}: case or white space matters to this vocabulary, so texts can't be encoded word by word")
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _plain(self, words: list[str]) -> list[bytes]:
        """Ids of each word."""
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters, encoded together."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        stops = np.nonzero(self.ends[ids])[0] + 1
        if len(stops) != len(words):
            return self._plain(words)
        raw, at = ids.tobytes(), [0, *(4 * stops).tolist()]
        return [raw[a:b] for a, b in zip(at, at[1:], strict=False)]

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of each of the distinct words. What is looked up and remembered is a word without the marks after its letters."""
        young, old, got, new = self.young, self.old, [], []
        for i, w in enumerate(words):
            ids = young.get(w)
            if ids is None:
                ids = old.get(w)
                if ids is None:
                    new.append(i)
                else:
                    young[w] = ids
            got.append(ids)
        parts, asked = [], {}
        for i in new:
            w = words[i]
            core = w.rstrip(MARKS)
            core, marks = (core, w[len(core) :]) if core.isalpha() else (w, "")
            parts.append((i, core, marks))
            for x in (core, marks):
                if x and x not in asked:
                    asked[x] = young.get(x) or old.get(x)
        unknown = [w for w, ids in asked.items() if ids is None]
        letters = [w for w in unknown if w.isalpha()]
        others = [w for w in unknown if not w.isalpha()]
        fresh = dict(zip(letters, self._letters(letters), strict=True)) if letters else {}
        fresh |= dict(zip(others, self._plain(others), strict=True)) if others else {}
        asked |= fresh
        young.update((w, i) for w, i in fresh.items() if len(w) <= LONGEST)
        for i, core, marks in parts:
            got[i] = asked[core] + (asked[marks] if marks else b"") if core else b""
        if len(young) > WORDS:
            self.old, self.young = young, {}
        return got

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's begin and end; a null has none."""
        lists = pc.ascii_split_whitespace(pc.ascii_lower(column.fill_null("")))
        coded = lists.flatten().dictionary_encode()
        ids = self.words(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat, first = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(size) - size
        word = coded.indices.to_numpy(zero_copy_only=False)
        n = size[word]
        stop = np.cumsum(n)
        out = flat[np.repeat(first[word] - (stop - n), n) + np.arange(stop[-1] if len(stop) else 0)]
        edge = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
        return out, np.concatenate([[0], stop])[edge]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT, end: int = 2) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens.

    A document is its ids and `end`; it is cut after every `limit` ids, so all pieces but the last are full sequences. A null or
    empty text has the one id `end`.
    """
    stop = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = encoder(path)
        for b in lean(batches):
            keys, (_, at) = b.column(0).to_pylist(), text_bytes(b.column(1))
            out: list[list] = [[], [], [], [], []]
            for i, j in spans_of(at, TOGETHER):
                all_ids, edge = of.texts(b.column(1).slice(i, j - i))
                for key, a, z in zip(keys[i:j], edge[:-1], edge[1:], strict=True):
                    ids = all_ids[a:z].tobytes() + stop
                    for k in range(0, len(ids), 4 * limit):
                        part = ids[k : k + 4 * limit]
                        for column, value in zip(out, (key, k // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4), strict=True):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def knapsack(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """How many of each item make the most valuable unbounded knapsack, and its value."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        fits = np.nonzero(sizes <= c)[0]
        if len(fits):
            with_ = best[c - sizes[fits]] + values[fits]
            j = int(with_.argmax())
            if with_[j] > best[c] + 1e-12:
                best[c], last[c] = with_[j], fits[j]
    pattern, c = np.zeros(len(sizes), np.int64), capacity
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            pattern[last[c]] += 1
            c -= sizes[last[c]]
    return pattern, float(best[capacity])


def column_generation(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 3000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and their fractional counts that fill the demand with least sequences, by the revised simplex method.

    It starts from one pattern for each size and prices by knapsack() under the current duals; every basis on the way fills the
    demand, so stopping after `rounds` costs some padding only.
    """
    columns = np.diag(capacity // sizes).astype(float)
    inverse, x = np.linalg.inv(columns), demand / (capacity // sizes)
    for _ in range(rounds):
        pattern, value = knapsack(sizes, inverse.sum(0), capacity)
        if value <= 1 + 1e-7:
            break
        d = inverse @ pattern
        able = np.nonzero(d > 1e-9)[0]
        r = able[np.argmin(x[able] / d[able])]
        theta = x[r] / d[r]
        x = np.maximum(x - theta * d, 0)
        x[r] = theta
        columns[:, r] = pattern
        row = inverse[r] / d[r]
        inverse = inverse - np.outer(d, row)
        inverse[r] = row
    return np.rint(columns).astype(np.int64), x


def plan(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """(sizes in a sequence, how many such sequences) that hold exactly counts[size] pieces of each size.

    Fractional counts are rounded down; the few pieces left, less than one pattern for each size, go to the fullest sequence with
    room, longest first.
    """
    sizes = np.array(sorted(counts), np.int64)
    left = np.array([counts[s] for s in sizes], np.int64)
    out = []
    if len(sizes):
        patterns, x = column_generation(sizes, left.astype(float), capacity)
        for j in np.argsort(-x, kind="stable"):
            have = patterns[:, j] > 0
            k = min(int(x[j] + 1e-6), int((left[have] // patterns[have, j]).min()))
            if k:
                left -= k * patterns[:, j]
                out.append((np.repeat(sizes, patterns[:, j])[::-1].tolist(), k))
    bins: list[list[int]] = []
    room: list[int] = []
    for i in range(len(sizes))[::-1]:
        for _ in range(left[i]):
            fit = [(r, b) for b, r in enumerate(room) if r >= sizes[i]]
            if fit:
                b = min(fit)[1]
            else:
                b = len(bins)
                bins.append([])
                room.append(capacity)
            bins[b].append(int(sizes[i]))
            room[b] -= int(sizes[i])
    return out + [(b, 1) for b in bins]


def pack(rows: DataFrame, limit: int = LIMIT, width: int = WIDTH) -> DataFrame:
    """rows of pieces() with sequence_id and offset.

    The driver sees the histogram of at most limit / width length classes. Sequences hold `limit` tokens at most, as a class
    counts as its longest length. Pieces are ranked within their class by hash buckets, so that a class with most of the rows is
    many tasks' work; a rank falls into one range of a pattern's copies, which are at most some thousands and broadcast. `rows`
    is read several times and should be a table.
    """
    spark = rows.sparkSession
    classed = rows.withColumn("class", F.ceil(F.col("length") / width).cast("int"))
    counts = dict(classed.groupBy("class").count().collect())
    ranges, at, first = [], dict.fromkeys(counts, 0), 0
    for sizes, k in plan(counts, limit // width):
        for slot, c in enumerate(sizes):
            ranges.append((c, at[c], at[c] + k, first, slot))
            at[c] += k
        first += k
    buckets = F.broadcast(spark.createDataFrame([(c, buckets_for(n)) for c, n in counts.items()], "class int, buckets int"))
    dealt = classed.join(buckets, "class").withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.col("buckets")).cast("int"))
    before = Window.partitionBy("class").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("class", "bucket").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy("class", "bucket").orderBy(F.desc("length"), "doc_id", "start", "ids_crc32")
    ranked = dealt.join(starts, ["class", "bucket"]).withColumn("rank", F.col("before") + F.row_number().over(inside) - 1)
    table = F.broadcast(spark.createDataFrame(ranges, "class int, lo long, hi long, first long, slot int"))
    placed = ranked.join(table, "class").where("rank >= lo and rank < hi").withColumn("sequence_id", F.col("first") + F.col("rank") - F.col("lo"))
    ahead = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(ahead), F.lit(0))).select(*rows.columns, "sequence_id", "offset")


def vocabulary() -> str:
    """Path of the vocabulary that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10(spark, sf_dir: str) -> DataFrame:
    return pack(cut(pieces(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary()), "pieces"))
