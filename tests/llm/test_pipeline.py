"""The pipeline's stages against plain Python on the small table."""

from __future__ import annotations

import public_tokenizers as P
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from tests.llm.cases import documents
from tests.llm.test_minhash import brute
from tests.llm.test_pii import brute as brute_spans
from tests.llm.test_quality_rules import plain
from tests.llm.test_tokens import check_packed
from weftline.llm import minhash_tensor
from weftline.sources.tables import load


def test_stages_on_the_documents(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    kept = pipeline.quality(spark, docs, sf_dir)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids = {r["doc_id"] for r in kept.collect()}
    assert kept.columns == docs.columns and not any(plain(texts[i])["base_failed"] for i in ids)
    labels = {r["doc_id"]: r["quality"] for r in load(spark, sf_dir, "labels").collect()}
    good = [i for i, q in labels.items() if q == 1 and not plain(texts[i])["base_failed"]]
    assert all(i in ids for i in good)

    one = pipeline.near_duplicates(spark, kept, sf_dir)
    want = {d for d, _, _, k in brute([(i, texts[i]) for i in ids], minhash_tensor.Scheme()) if k}
    assert {r["doc_id"] for r in one.collect()} == want and one.columns == docs.columns

    clean = pipeline.private_data(spark, one, sf_dir)
    assert clean.columns == docs.columns and clean.dtypes == docs.dtypes
    after = {r["doc_id"]: r for r in clean.collect()}
    for i in want:
        assert not brute_spans(after[i]["text"]) and after[i]["n_chars"] == len(after[i]["text"])
        assert brute_spans(texts[i]) or after[i]["text"] == texts[i]

    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    words_of = lambda t: tokenizer.encode(t, add_special_tokens=False).ids + [2]
    whole, padded = check_packed(pipeline.packed(spark, clean, sf_dir).collect(), {i: r["text"] for i, r in after.items()}, words_of)
    assert whole == padded


def test_quality_keeps_scripts_with_vowel_signs(spark, sf_dir):
    signs = ["\u0d3e", "\u0d3f", "\u0d41", "\u0d46"]
    malayalam = " ".join("".join(chr(0x0D15 + (i * k) % 30) + signs[(i + k) % 4] for k in range(1, 5)) for i in range(1, 70))
    digits = " ".join(f"word{i:08d}" for i in range(70))
    docs = spark.createDataFrame([(1, malayalam), (2, digits)], "doc_id long, text string")
    assert [r["doc_id"] for r in pipeline.quality(spark, docs, sf_dir).collect()] == [1]


def test_stages_take_odd_rows(spark, sf_dir):
    docs = documents(spark)
    for _, stage in pipeline.STAGES:
        for frame in (docs, docs.limit(0), docs.withColumn("text", F.lit(None).cast("string"))):
            stage(spark, frame, sf_dir).collect()


def test_repeated_rows_leave_one(spark, sf_dir):
    docs = documents(spark).where("doc_id IS NOT NULL")
    left = pipeline.near_duplicates(spark, docs, sf_dir)
    assert left.count() == left.select("doc_id").distinct().count()


def test_maps_and_dotted_names_pass_the_near_duplicates(spark, sf_dir):
    docs = spark.createDataFrame(
        [(1, "b", {"k": 1}, 5), (1, "a", {"k": 2}, 5), (1, "a", None, 5), (2, None, {}, None), (None, "a", {"k": 3}, 6)],
        "doc_id long, text string, meta map<string,int>, `a.b` int",
    )
    left = pipeline.near_duplicates(spark, docs, sf_dir)
    assert left.columns == docs.columns
    assert sorted(map(repr, left.drop("meta").collect())) == sorted(
        map(repr, spark.createDataFrame([(1, "a", 5), (2, None, None), (None, "a", 6)], "doc_id long, text string, `a.b` int").collect())
    )


def test_run_equals_the_stages(spark, sf_dir):
    got = pipeline.run(spark, sf_dir)
    assert {"doc_id", "start", "length", "sequence_id"} <= set(got.columns) and got.count() > 0
    assert len(pipeline.STAGES) == 4 and pipeline.ORACLE_SQL is None
