"""Chat formatting: a machine over roles, a declarative template, segments with loss flags.

The template says which role may follow which, what stands before and behind each turn, which
roles are learned from, and which strings are its own.  Only DataFrame functions are used.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``after``: roles that may follow a role, ``""`` being the start.  ``last``: roles a
    conversation may end with.  ``control``: strings that mark turns; inside a text each gets
    ``escape`` before it, as does ``escape`` itself, so that reading back is exact."""

    after: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",),
        "user": ("assistant",), "assistant": ("user",)})
    last: tuple[str, ...] = ("assistant",)
    before: str = "### {role}: "
    behind: str = " </turn>\n"
    learned: tuple[str, ...] = ("assistant",)
    control: tuple[str, ...] = ("###", "</turn>")
    escape: str = "\\"

    def _any(self) -> str:
        return "|".join(re.escape(s) for s in (self.escape, *self.control))

    def escaped(self, text: Column) -> Column:
        sign = self.escape.replace("\\", "\\\\").replace("$", "\\$")
        return F.regexp_replace(text, f"({self._any()})", sign + "$1")

    def plain(self, text: Column) -> Column:
        return F.regexp_replace(text, f"{re.escape(self.escape)}({self._any()})", "$1")


CHAT = Template()


def segments(rows: DataFrame, template: Template = CHAT, *, conversation: str = "conv_id",
             turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per turn: ``conv_id, turn, place, role_allowed, closes, segments``.

    ``place`` counts the turns of a conversation from 0, ``role_allowed`` is the machine's
    step, ``closes`` says for the last turn whether the machine may stop there (else null),
    ``segments`` is an array of (text, loss, content): head, text and tail of the turn.
    A null text is empty, a null role is the empty role and never allowed, null turns come
    first, rows of one turn go by role and text, a null conversation is one of its own, an
    empty table gives no rows, other columns are ignored.
    """
    known = rows.select(F.col(conversation).alias("conv_id"), F.col(turn).alias("turn"),
                        F.coalesce(role, F.lit("")).alias("role"),
                        F.coalesce(text, F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    step = F.lit(False)
    for state, roles in template.after.items():
        step = step | ((F.col("state") == state) & F.col("role").isin(*roles))
    head = template.before.split("{role}")
    learned = F.col("role").isin(*template.learned)
    piece = lambda t, loss, content: F.struct(
        t.alias("text"), loss.alias("loss"), F.lit(content).alias("content"))
    return (known
            .withColumn("place", F.row_number().over(order) - 1)
            .withColumn("state", F.lag("role", 1, "").over(order))
            .withColumn("is_last", F.lead("role").over(order).isNull())
            .select("conv_id", "turn", "place", step.alias("role_allowed"),
                    F.when(F.col("is_last"), F.col("role").isin(*template.last)).alias("closes"),
                    F.array(
                        piece(F.concat(F.lit(head[0]), template.escaped(F.col("role")),
                                       F.lit(head[1])), F.lit(False), False),
                        piece(template.escaped(F.col("text")), learned, True),
                        piece(F.lit(template.behind), F.lit(False), False)).alias("segments")))


def documents(turns: DataFrame) -> DataFrame:
    """One training document per conversation: ``conv_id, valid, segments`` in order.

    A document is one record by definition, so a conversation's turns meet in one row here.
    """
    return (turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "segments"))).alias("turns"),
        (F.min("role_allowed") & F.coalesce(F.max("closes"), F.lit(False))).alias("valid"))
        .select("conv_id", "valid", F.flatten("turns.segments").alias("segments")))


def read_back(formatted: DataFrame, template: Template = CHAT) -> DataFrame:
    """``conv_id, valid, formatted, turns, learned`` from the segments alone: turns are
    (role, text) without escapes, learned is the list of texts under the loss mask."""
    head = template.before.split("{role}")
    first, last = len(head[0]), len(head[1])
    pieces = F.col("segments")
    turns = F.transform(F.sequence(F.lit(0), F.size(pieces) - 1, F.lit(3)), lambda i: F.struct(
        template.plain(F.substring(F.element_at(pieces, i + 1)["text"], F.lit(first + 1),
                                   F.length(F.element_at(pieces, i + 1)["text"]) - first - last)
                       ).alias("role"),
        template.plain(F.element_at(pieces, i + 2)["text"]).alias("text")))
    learned = F.transform(F.filter(pieces, lambda s: s["loss"]),
                          lambda s: template.plain(s["text"]))
    return formatted.select(
        "conv_id", "valid", F.array_join(pieces["text"], "").alias("formatted"),
        turns.alias("turns"), learned.alias("learned"))


def digest(rows: DataFrame) -> DataFrame:
    """The counts and digests of what ``read_back`` gives."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("learned", "")
    return rows.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid")
