"""Spans of pattern matches, and texts with spans replaced, in JVM expressions.

A span is struct(name, start, end, value) in code points, end exclusive.  Positions come from
the gaps between matches and the matches themselves, added up in blocks, so many matches
cost no more than their number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPANS = "array<struct<name:string,start:int,end:int,value:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def sums_before(steps: Column) -> Column:
    """For each element of an integer array the sum of those before it, block by block."""
    zero = F.array(F.lit(0))

    def running(a: Column) -> Column:
        return F.aggregate(a, zero, lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0), lambda acc, x: acc + x)

    def in_blocks(a: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(a))).cast("int")
        blocks = let(width, lambda w: F.transform(F.sequence(F.lit(1), F.size(a), w), lambda first: F.slice(a, first, w)))
        shifted = lambda parts: F.zip_with(
            parts, running(F.transform(parts, total)), lambda p, base: F.when(p.isNotNull(), F.transform(F.slice(running(p), 1, F.size(p)), lambda v: v + base))
        )
        return F.flatten(F.array_compact(let(blocks, shifted)))

    return F.when(F.size(steps) == 0, F.array().cast("array<int>")).otherwise(let(steps, in_blocks))


def found(text: Column, name: str, pattern: str, check: Callable[[Column], Column] | None = None) -> Column:
    """Spans of the matches of ``pattern`` (none may be empty) that pass ``check``."""
    regex = F.lit(pattern)

    def placed(matches: Column) -> Column:
        def spans(gaps: Column) -> Column:
            before = sums_before(F.zip_with(gaps, matches, lambda g, m: g + F.length(m)))
            starts = F.zip_with(before, gaps, lambda b, g: b + g)
            made = F.zip_with(
                starts,
                matches,
                lambda s, m: F.struct(F.lit(name).alias("name"), s.alias("start"), (s + F.length(m)).alias("end"), m.alias("value")),
            )
            return F.filter(made, lambda s: check(s["value"])) if check else made

        gaps = F.transform(F.slice(F.split(text, regex, -1), 1, F.size(matches)), F.length)
        return F.when(F.size(matches) == 0, F.array().cast(SPANS)).otherwise(let(gaps, spans).cast(SPANS))

    return let(F.regexp_extract_all(text, regex, F.lit(0)), placed)


def replaced(text: Column, spans: Column, label: Callable[[Column], Column]) -> Column:
    """``text`` with spans, in order and without overlaps, replaced by their labels."""
    ends = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    parts = F.zip_with(
        spans,
        F.slice(ends, 1, F.size(spans)),
        lambda s, at: F.concat(F.substring(text, at + 1, s["start"] - at), label(s)),
    )
    tail = F.substring(text, F.element_at(ends, -1) + 1, F.length(text))
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(F.array_join(parts, ""), tail))
