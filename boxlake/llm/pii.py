"""Personal data: patterns propose spans, checksums confirm them, context words adjust scores.

Kinds in order: ``email``, ``ip``, ``card`` (Luhn), ``phone``, ``iban`` (mod 97) and ``ssn``.
Each pattern's leftmost matches that do not overlap are proposed; matches that fail their
kind's check are dropped and not tried again. A span's score is its kind's own, more if a
context word stands in the ``BEFORE`` code points before it. The first four kinds stay at
any score; the other two need ``ACCEPT``, which an ``ssn`` reaches with a context word only.

A cheap necessary condition is tried first, so that texts without a kind are read once for
it. Quantifiers are possessive where giving back could never match, so no pattern is
quadratic in a long token. Offsets count code points, ends are exclusive.

Null and empty texts have no spans. Everything is per row: repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxlake.llm.common import let, text_of

BEFORE = 40
ACCEPT = 0.5
BOOST = 0.4
_BLOCK = 256
_NEAR = 8  # matches that hold BEFORE code points, of five each
_LOCAL = "[A-Za-z0-9._%+-]"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    def total(digits: Column) -> Column:
        def one(i: Column) -> Column:
            digit = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
            return F.when(i % 2 == 0, digit).when(digit > 4, digit * 2 - 9).otherwise(digit * 2)

        size = F.length(digits)
        summed = F.aggregate(F.transform(F.sequence(F.lit(0), size - 1), one), F.lit(0), lambda a, x: a + x)
        return size.between(13, 19) & (summed % 10 == 0)

    return let(_digits(value), total)


def _mod_97(value: Column) -> Column:
    plain = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(step(a, c))) == 1


def _bytes_of_ip(value: Column) -> Column:
    def small(part: Column) -> Column:
        plain = F.regexp_replace(part, "^0+", "")
        return (F.length(plain) < 3) | ((F.length(plain) == 3) & (plain <= "255"))

    return F.forall(F.split(value, r"\."), small)


@dataclass(frozen=True)
class Kind:
    """``pattern`` proposes, ``needs`` is a cheap condition on the text, ``check`` confirms."""

    name: str
    pattern: str
    needs: Callable[[Column], Column]
    check: Callable[[Column], Column]
    score: float
    context: str
    base: bool = True
    alone: bool = False  # no letter or digit may touch it


KINDS = (
    Kind(
        "email", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda t: F.instr(t, "@") > 0, lambda v: F.lit(True), 0.9, "mail|contact|write to",
    ),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", lambda t: t.rlike(r"[0-9]\.[0-9]"), _bytes_of_ip, 0.6, "ip|host|server|address"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"), _luhn, 0.7, "card|visa|credit|payment"),
    Kind(
        "phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: F.instr(t, "+") > 0,
        lambda v: F.length(_digits(v)).between(9, 15), 0.6, "phone|tel|call|mobile|fax",
    ),
    Kind(
        "iban", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}+(?: ?[A-Z0-9]{1,3})?+",
        lambda t: t.rlike(r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}"), _mod_97, 0.7, "iban|account|bank", base=False, alone=True,
    ),
    Kind(
        "ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", lambda t: t.rlike("[0-9]{3}-[0-9]{2}-[0-9]{4}"),
        lambda v: ~v.rlike("^(?:000|666|9)"), 0.3, "ssn|social security|tax id|national id", base=False, alone=True,
    ),
)


def _placed(rows: Column) -> Column:
    """Start, end and surroundings from gaps and values: sums within blocks, then over blocks.

    ``lead`` is what stands before a match, ``BEFORE`` code points at most. It is carried from
    match to match, and a block starts with what its last few predecessors end with, since
    ``_NEAR`` of them hold as many code points: no place is looked up in the text.
    """
    kind = "array<struct<start:int,end:int,value:string,lead:string,next:string>>"

    def joined(part: Column) -> Column:
        return F.right(F.array_join(F.transform(part, lambda r: F.concat(r["tail"], r["value"])), ""), F.lit(BEFORE))

    def moved(state: Column, row: Column) -> Column:
        start = state["at"] + row["gap"]
        end = start + F.length(row["value"])
        lead = F.right(F.concat(state["tail"], row["tail"]), F.lit(BEFORE))
        one = F.struct(start.alias("start"), end.alias("end"), row["value"].alias("value"), lead.alias("lead"), row["next"].alias("next"))
        return F.struct(
            end.alias("at"), F.right(F.concat(lead, row["value"]), F.lit(BEFORE)).alias("tail"), F.concat(state["out"], F.array(one)).alias("out")
        )

    def block(b: Column) -> Column:
        first = F.greatest(b - _NEAR, F.lit(1))
        tail = F.when(b > 1, joined(F.slice(rows, first, b - first))).otherwise("")
        start = F.struct(F.lit(0).alias("at"), tail.alias("tail"), F.array().cast(kind).alias("out"))
        return F.aggregate(F.slice(rows, b, _BLOCK), start, moved)

    def shifted(state: Column, part: Column) -> Column:
        at = state["at"]
        out = F.transform(part["out"], lambda s: F.struct(
            (s["start"] + at).alias("start"), (s["end"] + at).alias("end"), s["value"].alias("value"), s["lead"].alias("lead"), s["next"].alias("next")
        ))
        return F.struct((at + part["at"]).alias("at"), F.concat(state["out"], F.array(out)).alias("out"))

    blocks = F.transform(F.sequence(F.lit(1), F.size(rows), F.lit(_BLOCK)), block)
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
    return F.when(F.size(rows) > 0, F.flatten(F.aggregate(blocks, start, shifted)["out"])).otherwise(F.array().cast(kind))


def located(text: Column, pattern: str) -> Column:
    """Start, end, value, ``lead`` and ``next`` (the code point behind) of each match.

    The pattern never matches an empty text, nor fewer than five code points.
    """
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.struct(
        F.length(g).alias("gap"), F.right(g, F.lit(BEFORE)).alias("tail"), F.left(g, F.lit(1)).alias("head")
    ))
    rows = F.zip_with(F.regexp_extract_all(text, F.lit(pattern), 0), gaps, lambda m, g: F.struct(
        g["gap"].alias("gap"), g["tail"].alias("tail"), F.concat(g["head"], F.left(F.coalesce(m, F.lit("")), F.lit(1))).alias("head"), m.alias("value")
    ))

    def with_next(rows: Column) -> Column:
        return F.zip_with(rows, F.slice(rows, 2, F.greatest(F.size(rows), F.lit(1))), lambda r, n: F.struct(
            r["gap"].alias("gap"), r["tail"].alias("tail"), r["value"].alias("value"), F.coalesce(F.left(n["head"], F.lit(1)), F.lit("")).alias("next")
        ))

    return let(F.filter(let(rows, with_next), lambda r: r["value"].isNotNull()), _placed)


def spans_of(text: Column) -> Column:
    """Array of ``kind, start, end, value, score`` by kind, then start."""

    def of_kind(text: Column, kind: Kind) -> Column:
        def judged(s: Column) -> Column:
            score = F.when(F.lower(s["lead"]).rlike(kind.context), kind.score + BOOST).otherwise(kind.score)
            return F.struct(F.lit(kind.name).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), F.least(score, F.lit(1.0)).alias("score"))

        def kept(s: Column) -> Column:
            good = kind.check(s["value"])
            if kind.alone:
                good &= ~s["lead"].rlike("[A-Za-z0-9]$") & ~s["next"].rlike("[A-Za-z0-9]")
            return good

        spans = F.transform(F.filter(located(text, kind.pattern), kept), judged)
        spans = spans if kind.base else F.filter(spans, lambda s: s["score"] >= ACCEPT)
        empty = F.array().cast("array<struct<kind:string,start:int,end:int,value:string,score:double>>")
        return F.when(kind.needs(text), spans).otherwise(empty)

    return let(text, lambda t: F.concat(*[of_kind(t, kind) for kind in KINDS]))


def found(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans`` of every document."""
    # The generator keeps the spans from being computed anew for each column read from them.
    return docs.select("doc_id", F.inline(F.array(F.struct(spans_of(text_of()).alias("spans")))))
