"""Column expressions that several operators share. All run inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

#: The bytes that separate words: space and the controls from tab to carriage return.
BLANKS = r"[\x20\x09-\x0D]+"
#: Length of the blocks in which running values are computed.
BLOCK = 128


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` mentions it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda acc, x: acc + x)


def running(values: Column, fold: Callable[[Column], Column], join: Callable[[Column, Column], Column]) -> Column:
    """Element i: ``fold`` over elements 0 to i. Blocks keep the work well below the square of the length.

    ``fold`` reduces an array and must give the neutral value of ``join`` for an empty one.
    """

    def in_blocks(v: Column) -> Column:
        count = F.ceil(F.size(v) / F.lit(BLOCK)).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), count - 1), lambda b: F.slice(v, b * BLOCK + 1, F.lit(BLOCK)))
        return let(blocks, lambda bs: let(F.transform(bs, fold), lambda folds: _inside(bs, folds)))

    def _inside(blocks: Column, folds: Column) -> Column:
        before = F.transform(folds, lambda _, b: fold(F.slice(folds, F.lit(1), b)))
        return let(
            before,
            lambda bf: F.flatten(
                F.transform(
                    blocks,
                    lambda block, b: F.transform(
                        block, lambda _, i: join(F.get(bf, b), fold(F.slice(block, F.lit(1), i + 1)))
                    ),
                )
            ),
        )

    return let(values, lambda v: F.when(F.size(v) > 0, in_blocks(v)).otherwise(v))


def running_sum(values: Column) -> Column:
    return running(values, total, lambda a, b: a + b)


def running_max(values: Column) -> Column:
    """Running maximum of values that are not negative."""
    top = lambda v: F.coalesce(F.array_max(v), F.lit(0).cast("long"))
    return running(values, top, lambda a, b: F.greatest(a, b))
