"""Pages as WARC records, equal payloads written once.

Of the pages with equal payloads of at least ``least`` bytes, the one with the largest id is written as a response; the
others are revisits that refer to it. Smaller payloads are always responses.

Cases: null html is an empty payload, a null url leaves the target out. A page with a null id is a response if no page with
an id has the same payload, else a revisit; rows that repeat the largest id are all responses. An empty table gives
an empty archive. Columns other than page_id, url and html are not looked at. A payload of any length is one record; it is
held in memory by the task that writes it and by the one that reads it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weftline.llm import warc
from weftline.session import materialise

DATE = "2024-01-01T00:00:00Z"
PAGE, REFERS = "X-Page-Id", "X-Refers-To-Page-Id"


def _urn(page_id: Column, digest: Column) -> Column:
    code = F.sha1(F.concat_ws("/", page_id, digest))
    cuts = [F.substring(code, at, size) for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def records(pages: DataFrame, least: int = 1000) -> DataFrame:
    """``pages`` (page_id, url, html) as rows of the data source's fields."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"), F.sha1(payload).alias("digest")
    )
    # Only digests that occur again; written first, so that its measured size decides whether the join broadcasts it.
    again = (
        rows.where(F.octet_length("payload") >= least)
        .groupBy("digest")
        .agg(F.max("page_id").alias("original"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "original")
    )
    named = rows.join(materialise(again, "warc-originals"), "digest", "left")
    revisit = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    headers = F.map_filter(
        F.create_map(
            F.lit(PAGE), F.col("page_id").cast("string"), F.lit(REFERS), F.when(revisit, F.col("original").cast("string"))
        ),
        lambda _, v: v.isNotNull(),
    )
    return named.select(
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        _urn(F.col("page_id"), F.col("digest")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(DATE).alias("date"),
        F.when(revisit, _urn(F.col("original"), F.col("digest"))).alias("refers_to"),
        F.col("digest").alias("payload_digest"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        headers.alias("headers"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write_archive(pages: DataFrame, path: str, least: int = 1000, **options: str) -> None:
    warc.register(pages.sparkSession)
    records(pages, least).write.format("warc").mode("append").options(**options).save(path)


def read_archive(spark, path: str, **options: str) -> DataFrame:
    warc.register(spark)
    return spark.read.format("warc").options(**options).load(path)


def pages_of(archive: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to; responses are digested again from what was read."""
    response = F.col("record_type") == "response"
    return archive.select(
        F.col("headers")[PAGE].cast("bigint").alias("page_id"),
        F.when(response, F.octet_length("payload")).otherwise(F.col("payload_bytes")).cast("bigint").alias("payload_bytes"),
        F.when(response, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        F.col("headers")[REFERS].cast("bigint").alias("refers_to"),
    )
