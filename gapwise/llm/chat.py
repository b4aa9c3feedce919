"""Formats conversations for training: role order, control strings, loss flags.

All of it is column expressions and joins of columns.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapwise.llm.arrays import cut_blocks, let, part, running


@dataclass(frozen=True)
class Template:
    """Which strings stand around a turn, by role, and whose texts are learned.

    A turn is `begin` with the role's name for {role}, the text, `end`. Roles with an
    entry in `around` have strings of their own instead. `machine` has the allowed
    steps: from a state (a role, or "start") to the roles that may follow; a
    conversation may stop in the states of `final`.
    """

    around: dict[str, tuple[str, str]] = field(
        default_factory=lambda: {
            "system": ("<<SYS>>\n", "\n<</SYS>>\n\n"),
            "user": ("[INST] ", " [/INST]"),
            "assistant": (" ", "</s>"),
        }
    )
    begin: str = "[ROLE {role}] "
    end: str = " [/ROLE]"
    learned: frozenset[str] = frozenset({"assistant"})
    machine: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "start": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    final: frozenset[str] = frozenset({"assistant"})
    #: What follows the first bracket of a control string (a regular expression).
    control: str = r"/?(?:INST\]|ROLE[ \]]|<?/?SYS>>|s>|t\|)"

    def strings(self, role: Column, which: int) -> Column:
        """What stands before (0) or behind (1) the text of a turn."""
        before, behind = self.begin.split("{role}")
        other = F.lit(self.end) if which else F.concat(F.lit(before), self.escaped(role), F.lit(behind))
        return reduce(lambda rest, r: F.when(role == r, self.around[r][which]).otherwise(rest), self.around, other)

    def escaped(self, text: Column) -> Column:
        """`text` without control strings: one backslash more behind the first bracket of each."""
        return F.regexp_replace(text, rf"([\[<])(\\*)({self.control})", r"$1\\$2$3")

    def unescaped(self, text: Column) -> Column:
        return F.regexp_replace(text, rf"([\[<])\\(\\*)({self.control})", "$1$2$3")


#: Marks the begin of each turn in the output, whatever the template; escaped in texts like the others.
TURN = "<t|{role}>"


def segments(conversations: DataFrame, template: Template = Template(), block: int = 512) -> DataFrame:
    """conv_id, turn, place, role, text, prefix, body, suffix, loss, valid_turn for each row.

    The formatted turn is prefix, body (the escaped text), suffix; `loss` says whether
    the body is learned. Rows of a conversation are ordered by turn, role and text
    (nulls first); `place` orders them together with turn. `valid_turn` says whether
    the role may follow the one before. A null text or role counts as empty; rows
    with a null conv_id are one conversation, rows with a null turn come first.
    Repeated rows are turns of their own. Other columns are not read.

    The order is found within blocks of turns, so that a conversation of any length
    spreads over many tasks; only the last roles of its blocks meet in one.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("block", F.floor(F.col("turn") / block))
    order = ["turn", "role", "text"]
    within = Window.partitionBy("conv_id", "block").orderBy(*order)
    ranked = rows.withColumn("place", F.row_number().over(within)).withColumn("before", F.lag("role").over(within))
    last = rows.groupBy("conv_id", "block").agg(F.max_by("role", F.struct(*order)).alias("last_role"))
    along = Window.partitionBy("conv_id").orderBy("block")
    last = last.select(
        F.col("conv_id").alias("c"), F.col("block").alias("b"), F.coalesce(F.lag("last_role").over(along), F.lit("start")).alias("start_role")
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("block").eqNullSafe(F.col("b"))
    known = ranked.join(last, same, "left").withColumn("before", F.coalesce("before", "start_role"))
    allowed = [(F.col("before") == state) & F.col("role").isin(*roles) for state, roles in template.machine.items()]
    role = F.col("role")
    name = F.base64(F.encode(role, "UTF-8"))  # a role's name may hold anything
    mark, close = TURN.split("{role}")
    return known.select(
        "conv_id",
        "turn",
        "place",
        "role",
        "text",
        F.concat(F.lit(mark), name, F.lit(close), template.strings(role, 0)).alias("prefix"),
        template.escaped(F.col("text")).alias("body"),
        template.strings(role, 1).alias("suffix"),
        role.isin(*template.learned).alias("loss"),
        reduce(lambda a, b: a | b, allowed).alias("valid_turn"),
    )


def formatted(parts: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, formatted, loss_spans, valid: one row per conversation of `segments`.

    `loss_spans` has start and end (code points) of what is learned. `valid` says
    whether all turns follow the machine to a final state. A conversation's text is
    one value, so it has to fit a row; longer ones are used as segments.
    """
    item = F.struct("turn", "place", "prefix", "body", "suffix", "loss", "role", "valid_turn")
    turns = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(item)).alias("turns"))
    whole = lambda t: F.concat(t["prefix"], t["body"], t["suffix"])
    lengths = F.transform("turns", lambda t: F.char_length(whole(t)).cast("long"))
    def spans(starts: Column) -> Column:
        def span(t: Column, i: Column) -> Column:
            start = F.get(starts, i) + F.char_length(t["prefix"])
            return F.when(t["loss"], F.struct(start.alias("start"), (start + F.char_length(t["body"])).alias("end")))

        return F.filter(F.transform("turns", span), lambda s: s.isNotNull())

    return turns.select(
        "conv_id",
        F.array_join(F.transform("turns", whole), "").alias("formatted"),
        let(running(lengths, F.lit(0).cast("long"), lambda a, b: a + b), spans).alias("loss_spans"),
        (F.forall("turns", lambda t: t["valid_turn"]) & F.element_at("turns", -1)["role"].isin(*template.final)).alias("valid"),
    )


def read_back(texts: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, turns (array of role, text), loss_texts (array), formatted_chars, from `formatted` and its loss spans."""
    mark, close = (re.escape(x) for x in TURN.split("{role}"))
    pieces = let(F.split("formatted", mark, -1), lambda x: F.slice(x, 2, F.size(x)))

    def turn(piece: Column) -> Column:
        parts = F.split(piece, close, 2)
        role, rest = F.decode(F.unbase64(parts[0]), "UTF-8"), parts[1]
        begin, end = (F.char_length(template.strings(role, i)) for i in (0, 1))
        text = template.unescaped(F.substring(rest, begin + 1, F.char_length(rest) - begin - end))
        return F.struct(role.alias("role"), text.alias("text"))

    def learned(blocks: Column) -> Column:
        return F.transform("loss_spans", lambda s: template.unescaped(part(blocks, s["start"], s["end"])))

    return texts.select(
        "conv_id",
        F.transform(pieces, turn).alias("turns"),
        let(cut_blocks(F.col("formatted")), learned).alias("loss_texts"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
