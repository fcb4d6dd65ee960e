"""Small tables that every operator must survive: nulls, empty and long texts, ties, repeats, clashing columns."""

from __future__ import annotations

LONG = " ".join(f"word{i % 977} tail{i % 13}" for i in range(60_000))
TEXTS = [
    None,
    "",
    " \t\n",
    "one",
    "same text here\nsame text here\n\nother line",
    "same text here\nsame text here\n\nother line",
    "Ünïcödé 🦆🦆 naïve — café́ ΑΣ İstanbul ﬁ",
    "a\tb c\x1cd\x85e f  g \n\n h\r\n\t i",
    "don't I'LL we've 'tis 12345 ... !!! ",
    "x" * 5000,
    "ab" * 3000 + " " + "9" * 3000,
    LONG,
]


def documents(spark, texts=TEXTS):
    """Ids repeat once and one is null; other columns clash with names that operators use inside."""
    rows = [(i if t != "one" else None, t, "en", "s", 0, "n", "w") for i, t in enumerate(texts)]
    rows.append(rows[4])
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, quality string, pieces string"
    )
