"""Quality classifier by Bradley-Terry ranking.

Scores are learned from preference pairs, a good text over a bad one, by logistic loss on differences of their features. The cut
is a quantile of the scores: the one that the bad share of the labelled texts lies below.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.llm.common import lean, text_bytes
from segloom.llm.textstats import CLASSES, LOWER, UPPER, class_counts, line_counts, pair_counts, repeat_words

#: Labelled rows of each class that are fitted on; those with the smallest hash of their id.
SAMPLE = 3_000
PAIRS = 12_000
EXTRA = 9
FEATURES = CLASSES * CLASSES + EXTRA


def features(column: pa.Array) -> np.ndarray:
    """Feature rows of whole texts: roots of the shares of byte-class pairs, and nine measures of length, repetition and marks."""
    data, at = text_bytes(column)
    pairs = pair_counts(data, at)
    out = np.zeros((len(at) - 1, FEATURES))
    out[:, : CLASSES * CLASSES] = np.sqrt(pairs / np.maximum(pairs.sum(1, keepdims=True), 1))
    marks = class_counts(data, at)
    raw = data.tobytes()
    for i in range(len(at) - 1):
        text = raw[at[i] : at[i + 1]]
        words = text.split()
        n = len(words)
        if n:
            lines, again = line_counts(text)
            distinct = len(set(words))
            repeated = repeat_words(words) if distinct < n else 0
            out[i, -EXTRA:] = np.log1p(n), repeated / n, sum(map(bytes.__eq__, words[1:], words)) / n, again / max(lines, 1), len(text) / n / 10, min(1.0, distinct / n * np.sqrt(n) / 10), min(1.0, 2 * marks[i, 3] / n), min(1.0, 2 * marks[i, UPPER] / max(1, marks[i, UPPER] + marks[i, LOWER])), min(1.0, 2 * marks[i, 4] / n)
    return out


def fit(x: np.ndarray, good: np.ndarray, bad_share: float, cutoff: float, penalty: float = 1.0, rounds: int = 25) -> dict:
    """Bradley-Terry weights from features x and labels good.

    Pairs are drawn with a fixed seed, PAIRS of them; Newton steps minimise the logistic loss of the score difference with a
    squared penalty. The returned model maps scores to (0, 1), rising, such that the bad_share quantile of the labelled scores,
    weighted to that share, comes out at `cutoff`. With one class only, all scores are the same.
    """
    mean, scale = (x.mean(0), x.std(0) + 1e-3) if len(x) else (np.zeros(FEATURES), np.ones(FEATURES))
    up, down = np.nonzero(good)[0], np.nonzero(~good)[0]
    w = np.zeros(x.shape[1] if len(x) else FEATURES)
    if not len(up) or not len(down):
        return {"mean": mean, "scale": scale, "w": w, "at": 0.0, "slope": 1.0, "shift": 2.0 if len(up) or not len(down) else -4.0}
    z = (x - mean) / scale
    rng = np.random.default_rng(7)
    d = z[rng.choice(up, PAIRS)] - z[rng.choice(down, PAIRS)]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(np.clip(d @ w, -50, 50)))
        step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d + penalty * np.eye(len(w)), d.T @ p - penalty * w)
        w += step
        if abs(step).max() < 1e-6:
            break
    s = z @ w
    weight = np.where(good, (1 - bad_share) / len(up), bad_share / len(down))
    order = np.argsort(s, kind="stable")
    below = np.cumsum(weight[order])
    k = int(np.searchsorted(below, bad_share))
    at = float((s[order[max(k - 1, 0)]] + s[order[min(k, len(s) - 1)]]) / 2)
    spread = max(float(np.median(s[up]) - np.median(s[down])), 1e-6)
    return {"mean": mean, "scale": scale, "w": w, "at": at, "slope": 8 / spread, "shift": float(np.log(cutoff / (1 - cutoff)))}


def apply(model: dict, x: np.ndarray) -> np.ndarray:
    """Scores in (0, 1) of feature rows."""
    s = ((x - model["mean"]) / model["scale"]) @ model["w"]
    return 1 / (1 + np.exp(-np.clip(model["slope"] * (s - model["at"]) + model["shift"], -30, 30)))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, cutoff: float = 0.3) -> dict:
    """Model from labelled documents: labels has doc_id and quality (1 good, 0 bad, anything else is left out).

    Of each class, `sample` rows at most, by hash of doc_id; their ids are broadcast (2 * sample rows) and their features
    collected. The share of bad text is counted over all labels given. A document labelled both ways counts as bad.
    """
    one = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    counts = {r.quality: r["count"] for r in one.groupBy("quality").count().collect()}
    few = [one.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for q in (0, 1)]
    rows = docs.select("doc_id", "text").join(F.broadcast(few[0].unionByName(few[1])), "doc_id").dropDuplicates(["doc_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in lean(batches):
            x = features(b.column("text")).astype(np.float32)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("quality"), pa.array([r.tobytes() for r in x], pa.binary())], names=["doc_id", "quality", "x"])

    got = sorted(rows.select("doc_id", "text", F.col("quality").cast("int").alias("quality")).mapInArrow(run, "doc_id long, quality int, x binary").collect())
    x = np.frombuffer(b"".join(r.x for r in got), np.float32).reshape(-1, FEATURES).astype(float)
    return fit(x, np.array([r.quality == 1 for r in got], bool), counts.get(0, 0) / max(1, sum(counts.values())), cutoff)


def score(docs: DataFrame, model: dict, text: str = "text", output: str = "score", keep_text: bool = True) -> DataFrame:
    """docs with a double column `output`: the model's score of each whole text; a null text counts as empty."""
    names = [c for c in docs.columns if c != output and (keep_text or c != text)]
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names] + [f"{output} double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in lean(batches):
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(apply(model, features(b.column(text))))], names=[*names, output])

    return docs.select(*dict.fromkeys([*names, text])).mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id"):
    """Whether crc32 of the id, as text, is a multiple of 5."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def op1(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality").where(~held_out())
    scored = score(docs, train(docs, labels), keep_text=False)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
