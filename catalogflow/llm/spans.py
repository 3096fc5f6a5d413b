"""Pattern matches in texts with their code-point offsets, by built-in functions only.

``split`` gives what lies between the matches and ``regexp_extract_all`` the matches; laid end to end their lengths
are the offsets. The patterns are written so that the engine reads a text once: look-behinds admit a match only where
a run of its signs begins, and possessive loops never step back, so very long runs cost neither time nor stack.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:bigint,end:bigint,kind:string,value:string>>"


@dataclass(frozen=True)
class Kind:
    """``accept`` takes the match; ``hint`` is a cheap condition on the text without which nothing can match."""

    name: str
    pattern: str
    accept: object = None
    hint: Callable[[Column], Column] | None = None


def matches(text: Column, kind: Kind) -> Column:
    """All accepted matches as spans in order, without overlaps. Rejected matches still use up their signs."""
    gaps = F.split(text, kind.pattern, -1)
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    pairs = F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda m, g: F.struct(
        m.alias("value"), F.length(g).cast("bigint").alias("gap"), F.length(m).cast("bigint").alias("size")))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(SPAN).alias("spans"))

    def step(state: Column, m: Column) -> Column:
        begin = state["at"] + m["gap"]
        span = F.struct(begin.alias("start"), (begin + m["size"]).alias("end"), F.lit(kind.name).alias("kind"),
                        m["value"].alias("value"))
        kept = F.concat(state["spans"], F.array(span))
        spans = F.when(kind.accept(m["value"]), kept).otherwise(state["spans"]) if kind.accept else kept
        return F.struct((begin + m["size"]).alias("at"), spans.alias("spans"))

    spans = F.aggregate(pairs, start, step, lambda s: s["spans"])
    # Most texts have no match: they are told by one cheap look and never cut.
    able = kind.hint(text) if kind.hint else text.rlike(kind.pattern)
    return F.when(able, spans).otherwise(F.array().cast(SPAN))


def by_start(spans: Column, kinds: list[str]) -> Column:
    """Spans in order of start, then of their kind's place in ``kinds``."""
    rank = F.array(*[F.lit(k) for k in kinds])
    keyed = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(rank, s["kind"]).alias("rank"), s["end"].alias("end"),
        s["kind"].alias("kind"), s["value"].alias("value")))
    return F.array_sort(keyed)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of ordered spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def number_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def overlaps(spans: Column, start: Column, end: Column) -> Column:
    return F.exists(spans, lambda s: (s["start"] < end) & (start < s["end"]))
