"""The pipeline's stages against plain versions of them, and the registered queries."""

import public_tokenizers
import pytest
from llm_cases import ROWS, documents, empty
from pyspark.sql import functions as F
from test_llm_simhash import groups, plain

import __spark_entry__ as entry
import corpus_pipeline
from newstide.llm import languages, packing, quality, surrogates
from newstide.llm.queries import QUERIES, surrogate_key

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_stages_in_order(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    given = {r.doc_id: r for r in docs.collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_duplicates", "personal_data", "packing"]

    def stored(stage, frame):
        return spark.createDataFrame(stage(spark, frame, sf_dir).collect(), docs.schema)

    filters = languages.learn(docs)
    kept = stored(corpus_pipeline.language, docs)
    plainly = [r for r in given.values() if (p := filters.predict(r.text or "", filters.chance))[0] != "und" and p[2] >= 0.3]
    assert rows(kept) == sorted(map(tuple, plainly), key=repr) and len(plainly) > 0.98 * len(given)

    machine = quality.learn(kept, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    good = stored(corpus_pipeline.good_quality, kept)
    plainly = [r for r in plainly if machine.scores([quality.features(r.text or "")])[0] >= 0.5]
    assert rows(good) == sorted(map(tuple, plainly), key=repr)

    once = stored(corpus_pipeline.near_duplicates, good)
    ids = [r.doc_id for r in plainly]
    first = set(groups(ids, [plain(r.text or "") for r in plainly]))
    plainly = [r for r in plainly if r.doc_id in first]
    assert rows(once) == sorted(map(tuple, plainly), key=repr)

    safe = stored(corpus_pipeline.personal_data, once)
    replaced = {r.doc_id: r.text for r in surrogates.surrogates(once, surrogate_key(spark)).collect()}
    assert {r.doc_id: (r.text, r.n_chars) for r in safe.collect()} == {
        r.doc_id: (replaced[r.doc_id], len(replaced[r.doc_id]) if replaced[r.doc_id] != r.text else r.n_chars) for r in plainly
    }

    encode = packing.encoder(public_tokenizers.path("word_bpe_49k.json")).encode
    packed = corpus_pipeline.packing(spark, safe, sf_dir).collect()
    tokens = {r.doc_id: len(encode(r.text or "")) // 4 + 1 for r in safe.collect()}
    sums = {}
    for r in packed:
        sums[r.doc_id] = sums.get(r.doc_id, 0) + r.length
    assert sums == tokens


def test_personal_data_on_a_cluster_and_with_full_formats(spark, sf_dir):
    """Without a key of the session, and with an address that is the only one of its format and masks of many lengths."""
    masks = [(i, 'password: "' + "*" * i + '" from 0000::') for i in range(6, 26)]
    docs = documents(spark, [*ROWS, *masks])
    master = spark.conf.get("spark.master")
    spark.conf.set("spark.master", "spark://elsewhere:7077")
    try:
        result = corpus_pipeline.personal_data(spark, docs, sf_dir).collect()
    finally:
        spark.conf.set("spark.master", master)
    made = {r.doc_id: r for r in result if r.text and "password" in r.text}
    assert len(result) == docs.count() and len(made) == len(masks) == len({r.text for r in made.values()})
    assert all(r.n_chars == len(r.text) and "***" not in r.text for r in made.values())


def test_run_gives_the_last_stage(spark, sf_dir):
    result = corpus_pipeline.run(spark, sf_dir)
    assert result.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert result.count() > 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_and_empty_tables(spark, sf_dir, name, stage):
    """Nulls, repeats, long texts, other columns; the labels are those of other documents."""
    docs = documents(spark).withColumn("lang", F.col("source"))
    result = stage(spark, docs, sf_dir)
    if name != "packing":
        assert result.columns == docs.columns
    assert result.count() >= (0 if name in ("language", "quality") else 5)
    assert stage(spark, empty(spark), sf_dir).collect() == []


def test_queries_are_registered(spark):
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    assert "op5_vectors" in entry.oracle_sql()
