"""Personal data in texts: patterns propose spans, checksums confirm them, words nearby adjust the score.

All of it is column expressions. Positions count code points.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwise.llm.arrays import cut_blocks, indexes, let, part, running


def luhn(match: Column) -> Column:
    """12 to 19 digits whose Luhn sum is right."""
    digits = F.regexp_replace(match, "[ -]", "")
    return F.when(F.length(digits).between(12, 19), F.call_function("luhn_check", digits)).otherwise(False)


def octets(match: Column) -> Column:
    """Four parts of at most 255."""
    return match.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$")


def phone_digits(match: Column) -> Column:
    """9 to 15 digits."""
    return F.length(F.regexp_replace(match, "[^0-9]", "")).between(9, 15)


def mod_97(match: Column) -> Column:
    """An account number of 15 to 34 characters that leaves 1 when divided by 97."""
    bare = F.regexp_replace(match, " ", "")
    turned = F.concat(F.substring(bare, 5, 34), F.substring(bare, 1, 4))

    def digit(rest: Column, c: Column) -> Column:
        value = F.when(c <= "9", F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return (rest * F.when(c <= "9", 10).otherwise(100) + value) % 97

    rest = F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), digit)
    return F.when(F.length(bare).between(15, 34), rest == 1).otherwise(False)


def always(match: Column) -> Column:
    return F.lit(True)


@dataclass(frozen=True)
class Kind:
    """A kind of personal data.

    Matches of `pattern` that `confirm` rejects are dropped without another try.
    `score` is that of a confirmed match; a word of `context` nearby adds `bonus`.
    Kinds that are not `base` need a score of `least`.
    """

    name: str
    pattern: str
    confirm: Callable[[Column], Column] = always
    context: str = ""
    score: float = 0.8
    bonus: float = 0.2
    base: bool = True


# Repetitions are possessive, and a match begins at the first character of a run or
# where the last match ended: the same matches, without trying every tail of a run.
KINDS = (
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        context="e-?mail|mail|contact|write|reach",
    ),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", octets, "ip|host|server|address|login", 0.6),
    Kind("card", r"[0-9](?:[ -]?+[0-9])++", luhn, "card|visa|credit|debit|payment|mastercard", 0.7),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", phone_digits, "phone|tel|call|mobile|fax|whatsapp", 0.7),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        mod_97,
        "iban|account|bank|konto|compte|cuenta",
        0.8,
        base=False,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        context="ssn|social|security",
        score=0.3,
        bonus=0.5,
        base=False,
    ),
)

SPAN = "struct<start:long,rank:int,end:long,kind:string,score:double,base:boolean>"


def _spans(kind: Kind, rank: int, text: Column, near: int, least: float) -> Column:
    """The confirmed matches of one kind in a text."""

    def located(found: Column) -> Column:
        def placed(between: Column) -> Column:
            both = lambda i: (F.char_length(F.get(between, i)) + F.char_length(F.get(found, i))).cast("long")
            before = running(F.transform(indexes(F.size(found)), both), F.lit(0).cast("long"), lambda a, b: a + b)

            def span(start: Column, i: Column) -> Column:
                match = F.get(found, i)
                begin = start + F.char_length(F.get(between, i))
                nearby = F.lower(F.concat_ws(" ", F.right(F.get(between, i), F.lit(near)), F.left(F.get(between, i + 1), F.lit(near))))
                helped = nearby.rlike(rf"\b(?:{kind.context})\b") if kind.context else F.lit(False)
                score = F.when(helped, kind.score + kind.bonus).otherwise(kind.score)
                confirmed = F.coalesce(kind.confirm(match), F.lit(False))
                return F.when(
                    confirmed if kind.base else confirmed & (score >= least),
                    F.struct(
                        begin.alias("start"),
                        F.lit(rank).alias("rank"),
                        (begin + F.char_length(match)).cast("long").alias("end"),
                        F.lit(kind.name).alias("kind"),
                        score.cast("double").alias("score"),
                        F.lit(kind.base).alias("base"),
                    ).cast(SPAN),
                )

            return let(before, lambda starts: F.filter(F.transform(starts, span), lambda s: s.isNotNull()))

        none = F.array().cast(f"array<{SPAN}>")
        return F.when(F.size(found) == 0, none).otherwise(let(F.split(text, kind.pattern, -1), placed))

    return let(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), located)


def with_personal_data(
    docs: DataFrame, text: str = "text", into: str = "personal_data", kinds: tuple[Kind, ...] = KINDS, near: int = 40, least: float = 0.7
) -> DataFrame:
    """`docs` with an array of spans (start, rank, end, kind, score, base), by start and then kind.

    A null text is empty and has none. All rows and other columns stay; a column
    that has the name `into` is replaced. Spans of different kinds may overlap.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    each = [_spans(kind, rank, whole, near, least) for rank, kind in enumerate(kinds)]
    return docs.withColumn(into, F.array_sort(F.concat(*each)))


def masked(text: Column, spans: Column) -> Column:
    """The text with [KIND] in place of each span; overlapping spans become one, named by its first."""

    def cut(blocks: Column) -> Column:
        def pieces(reach: Column) -> Column:
            def piece(s: Column, i: Column) -> Column:
                done = F.get(reach, i)
                named = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
                return F.when((s["start"] >= done), F.concat(part(blocks, done, s["start"]), named)).otherwise("")

            done = F.greatest(F.element_at(reach, -1), F.element_at(spans, -1)["end"])
            total = F.char_length(text).cast("long")
            return F.concat(F.array_join(F.transform(spans, piece), ""), part(blocks, done, total))

        ends = F.transform(spans, lambda s: s["end"])
        return let(running(ends, F.lit(0).cast("long"), lambda a, b: F.greatest(a, b)), pieces)

    return F.when(F.size(spans) == 0, text).otherwise(let(cut_blocks(text), cut))
