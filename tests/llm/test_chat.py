from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from weftline.llm import chat_format as C

SHAPE = "conv_id long, turn long, role string, text string, formatted string"


def examples(spark, rows):
    return [r.asDict() for r in C.expand_replies(spark.createDataFrame(rows, SHAPE)).orderBy("conv_id", "example").collect()]


def test_every_reply_is_an_example_with_its_context(spark):
    rows = [(1, 2, "user", "b", "x"), (1, 0, "user", "a", "x"), (1, 1, "assistant", "r1", "x"), (1, 3, "assistant", "r2", "x"), (1, 4, "user", "c", "x")]
    got = examples(spark, rows)
    assert [e["has_reply"] for e in got] == [True, True, False]
    assert [e["complete"] for e in got] == [False, False, True]
    assert got[0]["formatted"] == "### user: a</turn>\n### assistant: r1</turn>\n"
    assert got[1]["formatted"].startswith(got[0]["formatted"])
    assert [e["formatted"][e["loss_start"] : e["loss_end"]] for e in got] == ["r1", "r2", ""]


TRICKY = ["", "\\", "\\h", "\\\\h###", "####", "</turn>", "</turn>\n### assistant: x", "a\\t</turn", ">", ": ", "🦆###🦆", "\\b\\c\\t"]


@pytest.mark.parametrize("role", ["user", "assistant", "a: b", "</turn>", "###", ""])
def test_control_strings_survive(spark, role):
    rows = [(1, i, role, t, None) for i, t in enumerate(TRICKY)]
    got = C.expand_replies(spark.createDataFrame(rows, SHAPE)).where("complete")
    turns = got.select(C.parse_turns(F.col("formatted")).alias("t")).first()["t"]
    assert [(t["role"], t["text"]) for t in turns] == [(role, t) for t in TRICKY]


def test_masked_text_is_the_reply(spark):
    rows = [(i, 0, "assistant", t, None) for i, t in enumerate(TRICKY)]
    got = C.expand_replies(spark.createDataFrame(rows, SHAPE))
    got = got.select("conv_id", C.masked_text(F.col("formatted"), F.col("loss_start"), F.col("loss_end")).alias("t"))
    assert [r["t"] for r in got.orderBy("conv_id").collect()] == TRICKY


def test_nulls_ties_and_repeats(spark):
    rows = [(None, None, None, None, None), (None, None, "user", "x", None), (2, 0, "user", "b", None), (2, 0, "user", "a", None), (2, 0, "user", "a", None)]
    got = examples(spark, rows)
    assert [(e["conv_id"], e["n_turns"]) for e in got] == [(None, 2), (2, 3)]
    assert got[0]["formatted"] == "### : </turn>\n### user: x</turn>\n"
    assert got[1]["formatted"] == "### user: a</turn>\n" * 2 + "### user: b</turn>\n"


def test_empty_table(spark):
    assert examples(spark, []) == []
