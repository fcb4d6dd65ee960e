from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import functions as F

from tests.llm.cases import TEXTS, documents
from weftline.llm import quality_cascade as Q
from weftline.llm.columns import running_max, running_sum, words

BLANK = re.compile(r"[\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    found = [w for w in BLANK.split(text) if w]
    windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    often = Counter(windows)
    repeated = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if BLANK.sub("", x)]
    return {
        "n_words": len(found),
        "word_chars": sum(map(len, found)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated),
        "base_failed": len(found) < 50 or 100 * len(repeated) > 50 * len(found),
    }


def test_base_metrics_match_plain_python(spark):
    texts = [*TEXTS, "a b c a b c a b c", "a a a a a", "x y z q x y z", "# | <>\n# | <>\n \n#\x0b"]
    got = Q.base_metrics(documents(spark, texts), into="m").select("text", "m.*").drop("words").collect()
    for r in got:
        want = plain(r["text"])
        assert {k: r[k] for k in want} == want, r["text"]


def test_order_does_not_change_the_verdict(spark):
    docs = documents(spark)
    rules = [*Q.BASE_RULES, *Q.RULES]
    verdicts = [
        docs.select(Q.verdict(order, F.col("text"), words(F.col("text"))).alias("k")).collect() for order in (rules, rules[::-1])
    ]
    assert verdicts[0] == verdicts[1]
    assert sorted(r.name for r in Q.order_rules(docs, rules, fraction=1.0)) == sorted(r.name for r in rules)


def test_cheap_and_selective_rules_come_first(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.array_repeat(F.lit("some words"), 300)).alias("text"))
    slow = Q.Rule("slow", lambda t, w: Q.repeated_words(w) < 0)
    fast = Q.Rule("fast", lambda t, w: F.size(w) > 1)
    assert [r.name for r in Q.order_rules(docs, [slow, fast], fraction=1.0)] == ["fast", "slow"]


def test_a_rule_is_not_evaluated_after_a_rejection(spark):
    boom = Q.Rule("boom", lambda t, w: F.raise_error(F.lit("evaluated")).isNotNull())
    stop = Q.Rule("stop", lambda t, w: F.lit(True))
    got = documents(spark).select(Q.verdict([stop, boom], F.col("text"), words(F.col("text"))).alias("k"))
    assert {r["k"] for r in got.collect()} == {False}


def test_empty_table(spark):
    docs = documents(spark).limit(0)
    assert Q.order_rules(docs, Q.RULES) == list(Q.RULES)
    assert Q.base_metrics(docs, into="m").count() == 0


def test_junk_goes_and_prose_stays(spark):
    prose = " ".join(f"wort{i} lore{i * 7}em." for i in range(60))
    junk = [" ".join(f"W{i}!!" for i in range(80)), " | ".join(f"a{i}b" for i in range(80)), " ".join(f"w{i}###" for i in range(80))]
    got = spark.createDataFrame([(t,) for t in [prose, *junk]], "text string")
    kept = [r["k"] for r in got.select(Q.verdict(Q.RULES, F.col("text"), words(F.col("text"))).alias("k")).collect()]
    assert kept == [True, False, False, False]


def test_running_values(spark):
    values = [(i * 7919) % 1000 for i in range(700)]
    frame = spark.createDataFrame([(values,), ([],), ([5],)], "v array<bigint>")
    got = frame.select(running_sum(F.col("v")).alias("s"), running_max(F.col("v")).alias("m")).collect()
    assert got[0]["s"] == [sum(values[: i + 1]) for i in range(700)]
    assert got[0]["m"] == [max(values[: i + 1]) for i in range(700)]
    assert [(r["s"], r["m"]) for r in got[1:]] == [([], []), ([5], [5])]
