"""The registered queries of the subpackage. Each applies one operator to a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

import public_tokenizers

from weftline.llm import (
    ann_bits, byte_bpe, chat_format, line_dedup, minhash_tensor, oracles, packing, pii, quality_cascade, spelling,
    token_align, token_counts, url_rules, web_archive,
)
from weftline.session import scratch, ship_package
from weftline.sources import tables

#: The texts of conversation -7, which shows that control strings survive.
TRICKY = r"\### Assistant: </turn> ok"
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def load(spark, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return tables.load(spark, sf_dir, name)


def _hex(text: Column) -> Column:
    return F.sha2(text, 256)


def op1_chat_format(spark, sf_dir) -> DataFrame:
    turns = load(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], "conv_id long, turn long, role string, text string")
    examples = chat_format.expand_replies(turns.unionByName(extra))
    turns_read = chat_format.parse_turns(F.col("formatted"))
    said = F.transform(turns_read, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    each = examples.select(
        "conv_id",
        "example",
        F.when(F.col("has_reply"), chat_format.masked_text(F.col("formatted"), F.col("loss_start"), F.col("loss_end"))).alias("reply"),
        F.when(F.col("complete"), F.size(turns_read).cast("long")).alias("n_turns"),
        F.when(F.col("complete"), _hex(F.array_join(said, ""))).alias("turns_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    replies = F.sort_array(F.collect_list(F.when(F.col("reply").isNotNull(), F.struct("example", "reply"))))
    return (
        each.groupBy("conv_id")
        .agg(
            F.max("n_turns").alias("n_turns"),
            F.max("turns_sha256").alias("turns_sha256"),
            F.array_join(F.transform(replies, lambda r: r["reply"]), "").alias("trained"),
            F.sum("formatted_chars").alias("formatted_chars"),
        )
        .select(
            "conv_id",
            "n_turns",
            "turns_sha256",
            F.length("trained").cast("long").alias("loss_chars"),
            _hex(F.col("trained")).alias("loss_sha256"),
            "formatted_chars",
        )
    )


def op4_quality_cascade(spark, sf_dir) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    ordered = quality_cascade.order_rules(docs, quality_cascade.RULES)
    q = F.col("quality")
    kept = quality_cascade.verdict(ordered, F.col("text"), q["words"], failed=q["base_failed"])
    return quality_cascade.base_metrics(docs).select(
        "doc_id",
        *(q[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")),
        kept.alias("kept"),
    )


def _count_kind(kind: str) -> Column:
    return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long")


def op6_pii(spark, sf_dir) -> DataFrame:
    found = pii.find_pii(load(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "pii")
    place = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("pii", lambda s: s["kind"].isin(*pii.BASE))
    return found.select(
        "doc_id",
        *(_count_kind(k).alias(f"n_{k}") for k in pii.BASE),
        _hex(F.array_join(F.transform(base, place), ",")).alias("base_sha256"),
        F.array_join(F.transform("pii", place), ",").alias("spans"),
    )


def op7_url_rules(spark, sf_dir) -> DataFrame:
    """Labels name documents; a page takes the label of the document with its number. Low quality or toxic is bad."""
    pages = load(spark, sf_dir, "pages").select("page_id", "url")
    labels = load(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")
    )
    labelled = pages.join(labels, "page_id").select("url", "bad")
    return url_rules.filter_urls(pages, labelled, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op2_ann_bits(spark, sf_dir) -> DataFrame:
    return ann_bits.nearest(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op3_minhash(spark, sf_dir) -> DataFrame:
    scheme = minhash_tensor.Scheme(words=3, percent=85)
    found = minhash_tensor.near_duplicates(load(spark, sf_dir, "documents"), scheme)
    return found.select(F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept")


def op5_warc(spark, sf_dir) -> DataFrame:
    path = scratch(spark, "warc")
    web_archive.write_archive(load(spark, sf_dir, "pages"), path)
    return web_archive.pages_of(web_archive.read_archive(spark, path))


def op8_token_counts(spark, sf_dir) -> DataFrame:
    starting, continuing = token_counts.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_pieces(docs, starting, continuing).select("doc_id", "pieces.*")


def op9_byte_bpe(spark, sf_dir) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    coded = docs.withColumn("ids", byte_bpe.encoded(spark, F.col("text"), path, public_tokenizers.PATTERN))
    read = coded.withColumn("bytes", byte_bpe.decoded(spark, F.col("ids"), path))
    return read.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        _hex(F.col("ids")).alias("ids_sha256"),
        _hex(F.col("bytes")).alias("decoded_sha256"),
    )


def op10_packing(spark, sf_dir) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), added_tokens=True)
    digest = {"length": F.expr("octet_length(ids) div 4").cast("long"), "ids_crc32": F.crc32("ids")}
    return pieces.withColumns(digest).drop("ids")


def op11_token_align(spark, sf_dir) -> DataFrame:
    path = public_tokenizers.path
    files = token_align.Tokenizers.read(path("byte_bpe_50k.json"), public_tokenizers.PATTERN, path("piece_bpe_32k.model"))
    found = token_align.align(load(spark, sf_dir, "documents"), files)
    digest = F.when(F.col("n_a") > 0, _hex(F.col("groups"))).otherwise("")
    return found.select(*(c for c in found.columns if c != "groups"), digest.alias("groups_sha256"))


def op12_line_dedup(spark, sf_dir) -> DataFrame:
    found = line_dedup.drop_repeated_lines(load(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", _hex(F.col("text")).alias("kept_sha256"))


def op13_spelling(spark, sf_dir) -> DataFrame:
    words = spelling.count_words(load(spark, sf_dir, "documents"), 7, change=spelling.lost_letter, least=2)
    return spelling.group_variants(words, ratio=10)


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_ann_bits": op2_ann_bits,
    "op3_minhash": op3_minhash,
    "op4_quality_cascade": op4_quality_cascade,
    "op5_warc": op5_warc,
    "op6_pii": op6_pii,
    "op7_url_rules": op7_url_rules,
    "op8_token_counts": op8_token_counts,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_packing": op10_packing,
    "op11_token_align": op11_token_align,
    "op12_line_dedup": op12_line_dedup,
    "op13_spelling": op13_spelling,
}
SQL = {
    "op1_chat_format": oracles.CHAT,
    "op2_ann_bits": oracles.NEAREST,
    "op3_minhash": oracles.NEAR_DUPLICATES,
    "op4_quality_cascade": oracles.QUALITY,
    "op5_warc": oracles.ARCHIVE,
    "op6_pii": oracles.PRIVATE,
    "op12_line_dedup": oracles.LINES,
    "op13_spelling": oracles.SPELLING,
}
