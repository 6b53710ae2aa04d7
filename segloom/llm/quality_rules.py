"""Quality rules as weak supervision.

Rules vote to keep or to reject, or abstain. Expectation-maximisation over the votes of all documents estimates how often each
rule votes so on good and on bad text, and the posterior probability of good text decides, in place of all-must-pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segloom.llm.common import cut, lean
from segloom.llm.textstats import COLUMNS, stats

REJECT, ABSTAIN, KEEP = 0, 1, 2


def text_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """All other columns of docs with the long columns COLUMNS, counted over whole texts; a null text is empty."""
    rest = [c for c in docs.columns if c != text and c not in COLUMNS]
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest] + [f"{c} long" for c in COLUMNS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in lean(batches):
            yield pa.RecordBatch.from_arrays([b.column(c) for c in rest] + [pa.array(x) for x in stats(b.column(text))], names=[*rest, *COLUMNS])

    return docs.select(*rest, text).mapInArrow(run, schema)


def _vote(value: Column, good: Column, bad: Column) -> Column:
    return F.when(value.isNull(), ABSTAIN).when(bad, REJECT).when(good, KEEP).otherwise(ABSTAIN)


def votes() -> dict[str, Column]:
    """The rules, over the columns of text_stats(): REJECT, ABSTAIN or KEEP. A text without words makes most of them abstain."""
    words, chars = F.col("n_words"), F.col("word_chars")

    def share(a: Column, b: Column, least: Column, keep: float, reject: float) -> Column:
        x = F.when(least, a / F.nullif(b, F.lit(0)))
        return _vote(x, x < keep, x > reject)

    length = F.when(words > 0, chars / words)
    return {
        "symbols": share(F.col("n_symbols"), chars, words > 0, 0.01, 0.05),
        "capitals": share(F.col("n_upper"), F.col("n_upper") + F.col("n_lower"), words >= 5, 0.25, 0.5),
        "repeats": share(F.col("n_repeat_words"), words, words >= 10, 0.1, 0.2),
        "lines": share(F.col("n_dup_lines"), F.col("n_lines"), F.col("n_lines") >= 4, 0.1, 0.3),
        "bangs": share(F.col("n_bang"), words, words >= 5, 0.05, 0.25),
        "stays": share(F.col("n_stay"), words, words >= 10, 0.05, 0.2),
        "word_length": _vote(length, length.between(2.5, 12.0), ~length.between(1.5, 20.0)),
        "size": _vote(words, words >= 30, words < 10),
        "variety": share(words - F.col("n_distinct"), words, words.between(20, 400), 0.6, 0.8),
    }


#: Pseudo-documents of the prior, a fixed number whatever the corpus: what good text and each kind of bad text start from.
TRUST, GOOD, OWN, OTHER = 100.0, 0.02, 0.8, 0.05


def fit_votes(patterns: np.ndarray, counts: np.ndarray, rounds: int = 1000) -> tuple[np.ndarray, np.ndarray]:
    """Class shares, and P(reject | class, the rule votes) as [class, rule], by EM.

    patterns: distinct vote vectors; counts: documents of each. Class 0 is good text and class j a kind of bad text, that which rule
    j - 1 is for, as bad text of one kind may well please the rules for others. An abstention says nothing of a class, so only votes
    cast count. The start, and a prior of TRUST documents for good text and for each kind under its own rule (two elsewhere), say
    that rules reject GOOD of good text, OWN of their kind and OTHER of the rest; the corpus outweighs that prior as it grows.
    """
    m = patterns.shape[1]
    kinds = np.arange(1, m + 1)
    first, weight = np.full((m + 1, m), OTHER), np.full((m + 1, m), 2.0)
    first[0], weight[0] = GOOD, TRUST
    first[kinds, kinds - 1], weight[kinds, kinds - 1] = OWN, TRUST
    share, p = np.array([0.85] + [0.15 / m] * m), first
    reject, cast = (patterns == REJECT).astype(float), (patterns != ABSTAIN).astype(float)
    for _ in range(rounds):
        part = responsibilities(patterns, share, p) * counts
        new = np.clip((part @ reject + weight * first) / (part @ cast + weight), 1e-9, 1 - 1e-9)
        share = (part.sum(1) + 1) / (counts.sum() + m + 1)
        done = abs(new - p).max() < 1e-7
        p = new
        if done:
            break
    return share, p


def responsibilities(patterns: np.ndarray, share: np.ndarray, p: np.ndarray) -> np.ndarray:
    """P(class | votes) of each vote vector, as [class, vector]; class 0 is good text."""
    reject, keep = (patterns == REJECT).astype(float), (patterns == KEEP).astype(float)
    logs = np.log(p) @ reject.T + np.log1p(-p) @ keep.T + np.log(share)[:, None]
    weight = np.exp(logs - logs.max(0)) if logs.size else logs
    return weight / weight.sum(0)


def accuracies(share: np.ndarray, p: np.ndarray) -> np.ndarray:
    """(P(reject | good), P(reject | bad)) of each rule that votes, as [rule, 2]."""
    return np.stack([p[0], share[1:] @ p[1:] / share[1:].sum()], 1)


def judge(rows: DataFrame, threshold: float = 0.5) -> DataFrame:
    """rows of text_stats() with base_failed, posterior (of good text, double) and kept.

    EM needs how many documents cast each vote vector, counted over all rows: at most 3 to the number of rules, 19,683, whatever
    the number of documents. Those counts go to the driver, and the posteriors come back as a broadcast table of that size.
    base_failed: fewer than 10 words, or more than a fifth of them in repeated five-word windows. `rows` is read twice and should
    be a table.
    """
    rules = votes()
    code = sum((v * 3**i for i, v in enumerate(rules.values())), F.lit(0))
    coded = rows.withColumn("_code", code.cast("int"))
    seen = coded.groupBy("_code").count().collect()
    codes = np.array([r[0] for r in seen], np.int64)
    patterns = np.stack([codes // 3**i % 3 for i in range(len(rules))], 1) if len(codes) else np.zeros((0, len(rules)), np.int64)
    share, p = fit_votes(patterns, np.array([r[1] for r in seen], float))
    table = rows.sparkSession.createDataFrame([(int(c), float(q)) for c, q in zip(codes, responsibilities(patterns, share, p)[0], strict=True)], "_code int, posterior double")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    out = coded.join(F.broadcast(table), "_code").drop("_code").withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))


def op9(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return judge(cut(text_stats(docs), "rules")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")
