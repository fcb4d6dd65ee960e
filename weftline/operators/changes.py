"""Incremental loads, change capture, merge and history tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from weftline.operators.joins import null_safe
from weftline.operators.windows import lead_in
from weftline.sources.layout import overwrite


def incremental(source: DataFrame, ts: str, since: Column) -> DataFrame:
    return source.where(F.col(ts) > since)


def load_increment(source: DataFrame, path: str, parts: Sequence[str], arrival: str) -> None:
    """Bring the partitioned table at ``path`` up to date with ``source``.

    The high-water mark is the largest ``arrival`` (a number or time that rises as rows come in) already
    loaded. Every partition that rows above the mark, or without an arrival, belong to is replaced as a whole. So rows
    that come late for an old partition are loaded too, and a repeated or broken-off run does no harm.
    """
    loaded = source.sparkSession.read.parquet(path)
    mark = loaded.agg(F.max(arrival)).first()[0] if arrival in loaded.columns else None
    fresh = source if mark is None else source.where((F.col(arrival) > F.lit(mark)) | F.col(arrival).isNull())
    touched = fresh.select(*[F.col(p).alias(f"_{p}") for p in parts]).distinct()
    rows = source.join(touched, null_safe([(F.col(p), F.col(f"_{p}")) for p in parts]), "left_semi")
    overwrite(rows, path, parts, "dynamic")


def latest(changes: DataFrame, key: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """The newest change per key; combined before the shuffle, so a busy key costs no more than others."""
    rest = [c for c in changes.columns if c not in key]
    newest = F.max_by(F.struct(*rest), F.struct(*seq)).alias("_newest")
    return changes.groupBy(*key).agg(newest).select(*key, "_newest.*").select(*changes.columns)


def apply_cdc(base: DataFrame, changes: DataFrame, key: Sequence[str], seq: Sequence[str], op: str = "op") -> DataFrame:
    """State after all changes: the newest change per key replaces the base row, ``delete`` removes it."""
    rest = [c for c in base.columns if c not in key]
    return merge(base, latest(changes, key, seq), key, rest, delete_when=F.col(op) == "delete")


def merge(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    update: Sequence[str],
    delete_when: Column | None = None,
) -> DataFrame:
    """Upsert ``source`` (unique per key) into ``target``.

    Matched rows take the ``update`` columns of the source; matched rows for which
    ``delete_when`` (over source columns) holds are removed; unmatched source rows are
    inserted unless it holds for them too. One full join; null keys match nothing.
    """
    gone = F.coalesce(delete_when, F.lit(False)) if delete_when is not None else F.lit(False)
    fields = [F.col(c).alias(c) for c in target.columns]
    incoming = source.select(*[F.col(c).alias(f"_{c}") for c in on], gone.alias("_gone"), F.struct(*fields).alias("_new"))
    held = target.select(*on, F.struct(*fields).alias("_old"))
    same = reduce(lambda x, y: x & y, [F.col(c) == F.col(f"_{c}") for c in on])
    joined = held.join(incoming, same, "full").where(~F.coalesce("_gone", F.lit(False)))
    fresh, matched = F.col("_old").isNull(), F.col("_new").isNotNull()

    def value(c: str) -> Column:
        take = fresh | matched if c in update else fresh
        return F.when(take, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c)

    return joined.select(*[value(c) for c in target.columns])


def scd2(changes: DataFrame, key: Sequence[str], ts: str, tie: Sequence[str] = ()) -> DataFrame:
    """History with ``[valid_from, valid_to)`` per version; the current version has no end."""
    dated = lead_in(changes, key, [ts, *tie], ts, "valid_to")
    return dated.withColumnRenamed(ts, "valid_from")


def as_of(history: DataFrame, at: Column) -> DataFrame:
    """The versions in force at a point in time."""
    open_end = F.col("valid_to").isNull() | (F.col("valid_to") > at)
    return history.where((F.col("valid_from") <= at) & open_end)
