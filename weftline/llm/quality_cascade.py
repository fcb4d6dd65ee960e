"""Quality rules as a short-circuit cascade.

Each rule is a boolean column that rejects a document. Cost (seconds) and selectivity of the rules are measured on a
bounded sample; rules are then ordered by rejections per cost, counted among documents that the rules before let through.
The verdict is a CASE of the ordered rules, so a rejected document pays only for the rules up to the one that rejects it.
The order changes the cost and never the verdict, which is the conjunction of all rules.

Cases: a null or empty text has no words. A rule that is null does not reject. Every row gets a verdict, repeated ones
each their own. On an empty table the sample is empty and the given order stays. Very long texts are measured whole, in
the task of their row. Other columns are carried along untouched, but for one named like ``into`` of ``base_metrics``, which
the measurements replace.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from weftline.llm.columns import BLANKS, let, words

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 3


@dataclass(frozen=True)
class Rule:
    """``rejects`` builds the rejecting condition from the text column and the array of its words."""

    name: str
    rejects: Callable[[Column, Column], Column]


def count_symbols(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SYMBOLS)).cast("long")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.regexp_replace(x, BLANKS, "") != "")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(lines_with_words(text), lambda v: F.size(v) - F.size(F.array_distinct(v))).cast("long")


def repeated_words(text_words: Column, window: int = WINDOW) -> Column:
    """Words inside word windows that occur twice or more in the text, the first occurrence included."""

    def of(w: Column) -> Column:
        spans = F.transform(
            F.sequence(F.lit(0), F.size(w) - window), lambda i: F.array_join(F.slice(w, i + 1, F.lit(window)), " ")
        )
        return F.when(F.size(w) < window, F.lit(0)).otherwise(let(spans, in_spans))

    def in_spans(spans: Column) -> Column:
        placed = F.sort_array(F.transform(spans, lambda s, i: F.struct(s.alias("span"), i.alias("at"))))
        return F.when(F.size(spans) == F.size(F.array_distinct(spans)), F.lit(0)).otherwise(let(placed, covered))

    def covered(placed: Column) -> Column:
        same = lambda x, j: F.get(placed, j)["span"].eqNullSafe(x["span"])
        again = F.transform(placed, lambda x, j: F.when(same(x, j - 1) | same(x, j + 1), x["at"]))
        each = F.transform(F.array_compact(again), lambda p: F.sequence(p, p + (window - 1)))
        return F.size(F.array_distinct(F.flatten(each)))

    return let(text_words, of).cast("long")


def base_metrics(docs: DataFrame, text: str = "text", into: str = "quality") -> DataFrame:
    """``docs`` with a struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    measured = docs.withColumn(into, words(F.col(text)))
    measured = measured.withColumn(
        into,
        F.struct(
            F.col(into).alias("words"),
            F.size(into).cast("long").alias("n_words"),
            F.length(F.array_join(into, "")).cast("long").alias("word_chars"),
            count_symbols(F.col(text)).alias("n_symbols"),
            duplicate_lines(F.col(text)).alias("n_dup_lines"),
            repeated_words(F.col(into)).alias("n_repeat_words"),
        ),
    )
    failed = (F.col(f"{into}.n_words") < 50) | (
        100 * F.col(f"{into}.n_repeat_words") > 50 * F.col(f"{into}.n_words")
    )
    return measured.withColumn(into, F.col(into).withField("base_failed", failed))


def _times(share: float, count: Column, whole: Column) -> Column:
    return count * 100 > whole * round(share * 100)


def letters(kept: str) -> Rule:
    """Texts with over 40 % of characters that are neither white space nor in the classes ``kept``."""
    return Rule("letters", lambda t, w: _times(0.4, F.regexp_count(t, F.lit(rf"[^{kept}\s]")), F.length(t)))


#: The rules that stand for the method's own verdict.
RULES: Sequence[Rule] = (
    Rule("symbols", lambda t, w: _times(0.3, count_symbols(t), F.size(w))),
    Rule("shouting", lambda t, w: _times(0.3, F.regexp_count(t, F.lit("!!+")), F.size(w))),
    letters(r"\p{L}"),
    Rule("duplicate_lines", lambda t, w: _times(0.5, duplicate_lines(t), F.size(lines_with_words(t)))),
    Rule("word_length", lambda t, w: ~F.length(F.array_join(w, "")).between(F.size(w) * 2, F.size(w) * 15)),
    Rule("few_distinct_words", lambda t, w: _times(0.8, F.size(w) - F.size(F.array_distinct(w)), F.size(w)) & (F.size(w) < 400)),
    Rule("ellipsis_lines", lambda t, w: _times(0.5, F.regexp_count(t, F.lit(r"(?m)(\.\.\.|…)$")), F.size(lines_with_words(t)))),
    Rule("bullet_lines", lambda t, w: _times(0.9, F.regexp_count(t, F.lit(r"(?m)^[\x20\t]*[-•*]\x20")), F.size(lines_with_words(t)))),
)
#: The same for all scripts: vowels written as combining marks count as letters. The SQL of op4 states the rule without marks.
SCRIPT_RULES: Sequence[Rule] = tuple(letters(r"\p{L}\p{M}") if r.name == "letters" else r for r in RULES)
#: The base rules as members of a cascade, for callers that need the verdict and no counts.
BASE_RULES: Sequence[Rule] = (
    Rule("few_words", lambda t, w: F.size(w) < 50),
    Rule("repeated_words", lambda t, w: _times(0.5, repeated_words(w), F.size(w))),
)


def _seconds(frame: DataFrame, condition: Column, repeat: int = 2) -> float:
    best = float("inf")
    for _ in range(repeat):
        began = time.perf_counter()
        frame.agg(F.count_if(condition)).collect()
        best = min(best, time.perf_counter() - began)
    return best


def order_rules(
    docs: DataFrame,
    rules: Sequence[Rule],
    text: str = "text",
    sample_rows: int = 1000,
    sample_chars: int = 20_000,
    fraction: float = 0.1,
    seed: int = 7,
) -> list[Rule]:
    """The rules by rejections per second, measured on at most ``sample_rows`` texts of at most ``sample_chars`` characters.

    The sample is gathered partition by partition until it is full, so a large table is not read for it; it and one row
    per distinct combination of verdicts are all that reaches the driver.
    """
    spark, t = docs.sparkSession, F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(t.alias("t")).where(F.length("t") <= sample_chars).sample(fraction, seed).take(sample_rows)
    sample = spark.createDataFrame(texts, "t string").select("t", words(F.col("t")).alias("w"))
    sample.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        verdicts = [F.coalesce(r.rejects(F.col("t"), F.col("w")), F.lit(False)).alias(f"r{i}") for i, r in enumerate(rules)]
        seen = sample.select(*verdicts).groupBy(*(f"r{i}" for i in range(len(rules)))).count().collect()
        if not seen:
            return list(rules)
        idle = _seconds(sample, F.col("t").isNull())
        cost = [max(_seconds(sample, v) - idle, 1e-4) for v in verdicts]
    finally:
        sample.unpersist()
    left, order, waiting = list(seen), [], list(range(len(rules)))
    while waiting:
        best = max(waiting, key=lambda i: (sum(s["count"] for s in left if s[i]) / cost[i], -cost[i]))
        order.append(rules[best])
        waiting.remove(best)
        left = [s for s in left if not s[best]]
    return order


def verdict(ordered: Sequence[Rule], text: Column, text_words: Column, failed: Column | None = None) -> Column:
    """True for documents that no rule rejects; later rules are not evaluated once one rejects."""
    t = F.coalesce(text, F.lit(""))
    case = F.when(failed, F.lit(False)) if failed is not None else F.when(F.lit(False), F.lit(False))
    for rule in ordered:
        case = case.when(rule.rejects(t, text_words), F.lit(False))
    return case.otherwise(F.lit(True))
