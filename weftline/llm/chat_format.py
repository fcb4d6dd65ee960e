"""Chat formatting by prefix-target expansion.

Every reply of a conversation becomes an example of its own: all turns before it are context, and the mask covers the
text of that reply only. Turns after the last reply (or of a conversation without one) end in one more example with an
empty mask, so that the examples of a conversation hold all its turns.

A turn is written ``### role: text</turn>`` and a line feed. Control strings inside roles and texts are escaped, and the
escaping can be undone.

Cases: a null role or text is empty. Rows with a null conversation id form one conversation. Turns are ordered by turn
number (null first), then role and text, so that ties and repeated rows have one order; repeated rows stay. An empty table
gives no example. Other columns, whatever their names, are not looked at. One conversation is one row while it is
expanded, since its last example holds all of it; the output grows with turns times replies, as the method asks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, CLOSE, AFTER_ROLE = "### ", "</turn>\n", ": "
#: What is escaped, in this order, and undone in the opposite order. No code contains another control string.
TEXT_CODES = [("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\t")]
ROLE_CODES = [*TEXT_CODES, (":", "\\c")]


def escape(text: Column, codes=TEXT_CODES) -> Column:
    for plain, code in codes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, codes=TEXT_CODES) -> Column:
    for plain, code in reversed(codes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def expand_replies(
    turns: DataFrame, conversation="conv_id", turn="turn", role="role", text="text", reply_role="assistant"
) -> DataFrame:
    """One row per example: conversation, example (from 0), n_turns, formatted, loss_start, loss_end, has_reply, complete.

    The mask runs from ``loss_start`` to ``loss_end`` (code points, end exclusive). ``complete`` marks the example that
    holds all turns of its conversation.
    """
    empty = F.lit("")
    rows = turns.select(
        F.col(conversation).alias("conversation"),
        F.struct(
            F.col(turn).alias("at"), F.coalesce(F.col(role), empty).alias("role"), F.coalesce(F.col(text), empty).alias("text")
        ).alias("t"),
    )
    whole = rows.groupBy("conversation").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    written = F.transform(
        "turns",
        lambda t: F.concat(
            F.lit(OPEN), escape(t["role"], ROLE_CODES), F.lit(AFTER_ROLE), escape(t["text"]), F.lit(CLOSE)
        ),
    )
    ends = F.filter(
        F.sequence(F.lit(1), F.size("turns")),
        lambda i: (F.get("turns", i - 1)["role"] == reply_role) | (i == F.size("turns")),
    )
    at_end = F.get("turns", F.col("n_turns") - 1)
    mask_end = F.length("formatted") - len(CLOSE)
    return (
        whole.select("conversation", "turns", written.alias("written"), ends.alias("ends"))
        .select("conversation", "turns", "written", F.posexplode("ends").alias("example", "n_turns"))
        .select(
            F.col("conversation").alias(conversation),
            "example",
            "n_turns",
            F.array_join(F.slice("written", F.lit(1), F.col("n_turns")), "").alias("formatted"),
            (at_end["role"] == reply_role).alias("has_reply"),
            F.length(escape(at_end["text"])).alias("reply_length"),
            (F.col("n_turns") == F.size("turns")).alias("complete"),
        )
        .select(
            conversation,
            "example",
            "n_turns",
            "formatted",
            F.when(F.col("has_reply"), mask_end - F.col("reply_length")).otherwise(mask_end).alias("loss_start"),
            mask_end.alias("loss_end"),
            "has_reply",
            "complete",
        )
    )


def parse_turns(formatted: Column) -> Column:
    """The turns of a formatted text as an array of (role, text)."""
    pieces = F.split(formatted, CLOSE)

    def turn(piece: Column) -> Column:
        body = F.substr(piece, F.lit(len(OPEN) + 1))
        role = F.substring_index(body, AFTER_ROLE, 1)
        return F.struct(
            unescape(role, ROLE_CODES).alias("role"),
            unescape(F.substr(body, F.length(role) + len(AFTER_ROLE) + 1)).alias("text"),
        )

    return F.transform(F.filter(pieces, lambda p: p != ""), turn)


def masked_text(formatted: Column, start: Column, end: Column) -> Column:
    """What the mask covers, unescaped."""
    return unescape(F.substr(formatted, start + 1, end - start))
