"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; the driver of the pipeline writes its
result and reads it again. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from weftline.llm import minhash_tensor, packing, pii, quality_cascade
from weftline.llm.columns import let, words
from weftline.session import materialise, ship_package
from weftline.sources.tables import load


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    rules = quality_cascade.order_rules(docs, [*quality_cascade.BASE_RULES, *quality_cascade.SCRIPT_RULES])
    text = F.col("text")
    return docs.where(let(words(text), lambda w: quality_cascade.verdict(rules, text, w)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, the one with the smallest id; rows without an id stay.

    Of rows that repeat an id, which are one document, the first by text and the other columns stays.
    """
    ship_package(spark)
    found = minhash_tensor.near_duplicates(docs, minhash_tensor.Scheme(words=5, percent=80))
    kept = materialise(found.where("kept AND doc IS NOT NULL").select(F.col("doc").alias("doc_id")).distinct(), "kept-ids")
    text, rest = F.col("text"), [f for f in docs.schema if f.name not in ("doc_id", "text")]
    first = Window.partitionBy("doc_id").orderBy(text, *(_sortable(f) for f in rest))
    named = docs.join(kept, "doc_id").withColumn("__nth", F.row_number().over(first)).where("__nth = 1").drop("__nth")
    return named.select(*(_quoted(c) for c in docs.columns)).unionByName(docs.where("doc_id IS NULL"))


def _quoted(name: str) -> Column:
    """The column of just that name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def _sortable(field: T.StructField) -> Column:
    """The column, or its JSON where it holds a type that has no order."""
    unordered = any(kind in field.dataType.simpleString() for kind in ("map<", "variant"))
    return F.to_json(F.struct(_quoted(field.name))) if unordered else _quoted(field.name)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by the name of its kind; the stated length follows the new text."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a sequence, with its token ids."""
    ship_package(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), added_tokens=True)


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("private data", private_data),
    ("packing", packed),
]
#: Packing follows a tokenizer, which SQL cannot state; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES):
            docs = materialise(docs, name.replace(" ", "-"))
    return docs
