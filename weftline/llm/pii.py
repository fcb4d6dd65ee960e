"""Personal data: patterns propose spans, checksums confirm them, context words adjust a score.

All of it is column expressions on the row: no shuffle, no Python. A pattern's matches and the pieces between them give the
positions by running sums. Positions are code points, end exclusive.

Patterns are written so that each run of characters is tried once (a match starts at the beginning of a run, or where the
match before ended) and repeated groups never backtrack. They match what their plain forms match, in linear time.

Cases: a null or empty text has no spans. Long texts are handled whole. Repeated rows are handled one by one. Spans of
different kinds may overlap; redaction merges them. Columns other than the text are carried along untouched, but for
one named like ``into`` of ``find_pii``, which the spans replace.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from weftline.llm.columns import let, running_max, running_sum

AROUND = 48


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(m: Column) -> Column:
    """The digits of ``m`` satisfy the Luhn checksum."""
    marks = F.split(F.reverse(_digits(m)), "")

    def weigh(d: Column, i: Column) -> Column:
        n = d.cast("int")
        return F.when(i % 2 == 0, n).otherwise(F.when(n > 4, 2 * n - 9).otherwise(2 * n))

    return F.aggregate(F.transform(marks, weigh), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(m: Column) -> Column:
    """The account number satisfies the mod-97 checksum."""
    plain = F.replace(m, F.lit(" "), F.lit(""))
    turned = F.split(F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4))), "")

    def step(acc: Column, c: Column) -> Column:
        digit = c.between("0", "9")
        return (acc * F.when(digit, 10).otherwise(100) + F.when(digit, c.cast("int")).otherwise(F.ascii(c) - 55)) % 97

    return F.aggregate(turned, F.lit(0), step) == 1


def _sized(m: Column, least: int, most: int) -> Column:
    return F.length(_digits(m)).between(least, most)


PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


@dataclass(frozen=True)
class Kind:
    """``present`` is a cheap test that a text may hold the pattern at all.

    ``always`` keeps confirmed spans whatever their score; otherwise the score decides.
    """

    name: str
    pattern: str
    present: Callable[[Column], Column]
    confirm: Callable[[Column], Column]
    score: float
    context: str
    against: str = "(?!)"
    always: bool = True


#: In the order in which spans are listed.
KINDS: Sequence[Kind] = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda t: F.contains(t, F.lit("@")),
        lambda m: F.lit(True),
        0.9,
        r"(?i)\b(?:e-?mail|contact|write|correo|courriel)\b",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
        lambda t: t.rlike(r"[0-9]\.[0-9]"),
        lambda m: m.rlike(rf"^{PART}(?:\.{PART}){{3}}$"),
        0.6,
        r"(?i)\b(?:ip|address|host|server|from)\b",
        r"(?i)\b(?:version|release|section|v)\W*$",
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        lambda t: t.rlike(r"[0-9][\x20-]?[0-9]"),
        lambda m: F.when(_sized(m, 13, 19), luhn(m)).otherwise(F.lit(False)),
        0.8,
        r"(?i)\b(?:card|credit|visa|mastercard|tarjeta|carte|karte)\b",
        r"(?i)\b(?:isbn|order|invoice)\b",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda t: F.contains(t, F.lit("+")),
        lambda m: _sized(m, 9, 15),
        0.7,
        r"(?i)\b(?:phone|tel|call|mobile|fax|telefon|tel[eé]fono)\b",
    ),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        lambda t: t.rlike("[A-Z]{2}[0-9]{2}"),
        mod97,
        0.8,
        r"(?i)\b(?:iban|account|bank|konto|cuenta|compte)\b",
        always=False,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        lambda t: F.contains(t, F.lit("-")),
        lambda m: ~m.rlike("^(?:000|666|9)|-00-|-0000$"),
        0.4,
        r"(?i)\b(?:ssn|social\s+security)\b",
        always=False,
    ),
)
BASE = ("email", "ip", "card", "phone")
KEEP_FROM = 0.6
CONTEXT_GAIN = 0.3


def spans_of(text: Column, kind: Kind) -> Column:
    """Array of (kind, start, end, score) of one kind, in order."""

    def placed(pieces: Column, found: Column) -> Column:
        shifts = F.transform(
            found,
            lambda m, i: (F.length(F.get(pieces, i)) + F.coalesce(F.length(F.get(found, i - 1)), F.lit(0))).cast("long"),
        )
        return let(running_sum(shifts), lambda starts: F.transform(found, lambda m, i: span(pieces, m, i, F.get(starts, i))))

    def span(pieces: Column, m: Column, i: Column, start: Column) -> Column:
        before = F.right(F.get(pieces, i), F.lit(AROUND))
        after = F.left(F.get(pieces, i + 1), F.lit(AROUND))
        helped = before.rlike(kind.context) | after.rlike(kind.context)
        score = (
            F.lit(kind.score)
            + F.when(helped, F.lit(CONTEXT_GAIN)).otherwise(F.lit(0.0))
            - F.when(before.rlike(kind.against), F.lit(CONTEXT_GAIN)).otherwise(F.lit(0.0))
        )
        sure = kind.confirm(m) if kind.always else kind.confirm(m) & (score >= KEEP_FROM)
        return F.struct(
            F.lit(kind.name).alias("kind"),
            start.alias("start"),
            (start + F.length(m)).alias("end"),
            F.round(F.least(score, F.lit(1.0)), 2).alias("score"),
            sure.alias("sure"),
        )

    shape = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"
    all_found = let(
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)),
        lambda found: F.when(
            F.size(found) > 0, let(F.split(text, kind.pattern), lambda pieces: placed(pieces, found))
        ),
    )
    kept = F.transform(
        F.filter(all_found, lambda s: s["sure"]), lambda s: F.struct(s["kind"], s["start"], s["end"], s["score"])
    )
    none = F.array().cast(shape)
    return F.when(kind.present(text), F.coalesce(kept, none).cast(shape)).otherwise(none)


def find_pii(docs: DataFrame, text: str = "text", into: str = "pii", kinds: Sequence[Kind] = KINDS) -> DataFrame:
    """``docs`` with an array of spans (kind, start, end, score), by kind in the given order, then start."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumn(into, F.concat(*(spans_of(t, kind) for kind in kinds)))


def redacted(text: Column, spans: Column) -> Column:
    """The text with every merged run of spans replaced by the kind that starts it, in angle brackets."""

    def rebuilt(s: Column) -> Column:
        ends = running_max(F.transform(s, lambda x: x["end"]))
        return let(ends, lambda upto: let(F.split(text, ""), lambda marks: joined(s, upto, marks)))

    def joined(s: Column, upto: Column, marks: Column) -> Column:
        def piece(x: Column, i: Column) -> Column:
            done = F.coalesce(F.get(upto, i - 1), F.lit(0).cast("long"))
            fresh = (i == 0) | (x["start"] >= done)
            gap = F.array_join(F.slice(marks, (done + 1).cast("int"), (x["start"] - done).cast("int")), "")
            return F.when(fresh, F.concat(gap, F.lit("<"), F.upper(x["kind"]), F.lit(">"))).otherwise(F.lit(""))

        last = F.element_at(upto, -1)
        tail = F.array_join(
            F.slice(marks, (last + 1).cast("int"), F.greatest(F.size(marks) - last, F.lit(0)).cast("int")), ""
        )
        return F.concat(F.array_join(F.transform(s, piece), ""), tail)

    ordered = F.array_sort(
        F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))
    )
    return F.when(F.size(spans) > 0, let(ordered, rebuilt)).otherwise(text)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with personal data replaced in ``text``; texts without any stay as they are."""
    found = find_pii(docs, text, "__pii")
    return found.withColumn(text, redacted(F.col(text), F.col("__pii"))).drop("__pii")
