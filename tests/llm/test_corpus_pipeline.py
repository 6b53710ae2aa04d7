"""The pipeline's stages on a small corpus: schema, effect, clean documents kept."""

import random

import pytest

import corpus_pipeline
from segloom.llm import packing, simhash

pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    folder = tmp_path_factory.mktemp("corpus")
    text = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n)) + "."
    good = [text(rng.randint(60, 200)) for _ in range(150)]
    bad = [" ".join(w.upper() + "!!" for w in text(80).split()) for _ in range(50)]
    passage = text(70)
    texts = good + bad + [good[0], good[1] + " end", passage + "\n" + text(80), text(60) + "\n" + passage, None, ""]
    rows = [(i, t, "en", f"src{i % 4}" if i % 7 else None, len(t or ""), "extra") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, mix_taken string").repartition(3).write.parquet(str(folder / "documents.parquet"))
    labels = [(i, int(i < 150), 0) for i in range(0, 200, 2)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    return str(folder), texts, passage


def test_stages(spark, corpus):
    folder, texts, passage = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        seen[name] = docs
        if name != "packing":
            assert docs.columns == columns
    kept = {r.doc_id for r in seen["quality classifier"].collect()}
    assert len(kept & set(range(150))) >= 145 and len(kept & set(range(150, 200))) <= 5
    once = {r.doc_id for r in seen["SimHash near-dedup"].collect()}
    assert 200 not in once and 201 not in once and kept & set(range(150)) <= once
    cut = {r.doc_id: r for r in seen["substring dedup"].collect()}
    assert passage in cut[202].text and passage not in cut[203].text and cut[203].n_chars == len(cut[203].text)
    assert all(cut[i].text == texts[i] for i in cut if i < 150)
    assert {r.doc_id for r in seen["mixing to target weights"].collect()} <= set(cut)
    assert seen["packing"].groupBy("sequence_id").sum("length").agg({"sum(length)": "max"}).first()[0] <= packing.LIMIT


def test_run_and_empty_tables(spark, corpus, tmp_path):
    folder = corpus[0]
    assert corpus_pipeline.run(spark, folder).count() > 0
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{folder}/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert simhash.similar_documents(spark.read.parquet(str(tmp_path / "documents.parquet"))).count() == 0
