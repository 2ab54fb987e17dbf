"""Spans in texts by built-in functions alone. A span is struct<start, end, kind, value>; offsets are code points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPANS = "array<struct<start:int,end:int,kind:string,value:string>>"


def let(value: Column, f) -> Column:
    """f(value), with ``value`` computed once however often f uses it."""
    return F.transform(F.array(value), f)[0]


def none() -> Column:
    return F.array().cast(SPANS)


def located(text: Column, pattern: str, kind: str) -> Column:
    """All matches of ``pattern``, leftmost first, without overlap.

    The texts between matches tell where each match lies: it starts after all gaps and matches before it.
    """
    parts = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, value: F.struct(F.length(gap).alias("gap"), value.alias("value")),
    )

    def add(state: Column, part: Column) -> Column:
        start = state["at"] + part["gap"]
        end = start + F.length(part["value"])
        span = F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), part["value"].alias("value"))
        return F.when(part["value"].isNull(), state).otherwise(
            F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))
        )

    start = F.struct(F.lit(0).alias("at"), none().alias("out"))
    return F.when(text.rlike(pattern), F.aggregate(parts, start, add)["out"]).otherwise(none())


def in_order(spans: Column, kinds: list[str]) -> Column:
    """Spans by start, then by kind in the order of ``kinds``, then by end."""
    rank = F.create_map(*(x for i, k in enumerate(kinds) for x in (F.lit(k), F.lit(i))))
    keyed = F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"),
            s["value"].alias("value"),
        ),
    )
    return F.transform(
        F.array_sort(keyed),
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value")
        ),
    )


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def apart(spans: Column, others: Column) -> Column:
    """Those of ``spans`` that overlap none of ``others``."""
    return let(
        others,
        lambda all_others: F.filter(
            spans, lambda s: ~F.exists(all_others, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"]))
        ),
    )


def replaced(text: Column, spans: Column, by: dict[str, str], own: dict | None = None) -> Column:
    """The text with each span, in order, replaced by what ``by`` has for its kind, or ``own``, from the span itself.

    A span that starts within one replaced before it goes with that one.
    """
    marks = F.create_map(*(x for k, v in by.items() for x in (F.lit(k), F.lit(v))))

    def mark(s: Column) -> Column:
        plain = F.try_element_at(marks, s["kind"])
        return F.coalesce(*(F.when(s["kind"] == k, f(s)) for k, f in (own or {}).items()), plain)

    def add(state: Column, s: Column) -> Column:
        whole = F.concat(state["out"], F.substring(text, state["at"] + 1, s["start"] - state["at"]), mark(s))
        return (
            F.when(s["start"] >= state["at"], F.struct(s["end"].alias("at"), whole.alias("out")))
            .when(s["end"] > state["at"], F.struct(s["end"].alias("at"), state["out"].alias("out")))
            .otherwise(state)
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(spans, start, add)
    rest = F.aggregate(spans, F.lit(0), lambda at, s: F.greatest(at, s["end"]))
    return F.when(F.size(spans) > 0, F.concat(done["out"], F.substring(text, rest + 1, F.length(text)))).otherwise(text)
