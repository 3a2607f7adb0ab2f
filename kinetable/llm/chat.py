"""Chat formatting: a machine over roles and a declarative template turn conversations into segments with loss flags."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START = ""  # state before the first turn; any other state is the role that led to it


@dataclass(frozen=True)
class Turn:
    """What is written around a turn's text, and whether the text is learned."""

    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Allowed steps ``(state, role)`` and their marks; marks of every other step, with the role between the first two.

    ``control`` are the strings that must not stand in a text; ``escape`` is put behind the first character of each, and
    doubled where it stands itself. The closing mark tells the role, so that a reader needs no state.
    """

    turns: Mapping[tuple[str, str], Turn]
    control: tuple[str, ...]
    foreign: tuple[str, str, str]
    escape: str = "\\"
    final: frozenset[str] = field(default=frozenset())

    def __post_init__(self) -> None:
        marks = [m for t in self.turns.values() for m in (t.before, t.after) if m] + list(self.foreign)
        if len(self.escape) != 1 or any(self.escape in c or len(c) < 2 for c in self.control):
            raise ValueError("the escape is one character that no control string holds; these have two at least")
        # else a text's end and the next mark could be read as a control string
        for c in self.control:
            for m in marks:
                if any(m.startswith(c[i:]) for i in range(1, len(c))) and m not in self.control:
                    raise ValueError(f"the end of {c!r} begins {m!r}")
            if any(c != d and (c in d or any(d.startswith(c[i:]) for i in range(1, len(c)))) for d in self.control):
                raise ValueError(f"{c!r} overlaps another control string")
            if any(c != m[i:] and c.startswith(m[i:]) for m in marks for i in range(1, len(m))):
                raise ValueError(f"the start of {c!r} ends a mark")
        if any(not any(c in m for c in self.control) for m in [*self.closing, *self.foreign]):
            raise ValueError("closing marks hold a control string")
        for role in {r for _, r in self.turns}:
            if len([m for m in self.opening(role) if not any(c in m for c in self.control)]) > 1:
                raise ValueError(f"two opening marks of {role!r} hold no control string")
        roles = {a: {r for (_, r), t in self.turns.items() if t.after == a} for a in self.closing}
        if any(len(r) > 1 for r in roles.values()):
            raise ValueError("a closing mark belongs to one role")

    def opening(self, role: str) -> list[str]:
        """Marks before a role's text, longest first."""
        return sorted({t.before for (_, r), t in self.turns.items() if r == role}, key=len, reverse=True)

    @cached_property
    def closing(self) -> tuple[str, ...]:
        return tuple(sorted({t.after for t in self.turns.values()}))


#: Instruction format with a system part inside the first instruction.
INSTRUCT = Template(
    turns={
        (START, "system"): Turn("<s>[INST] <<SYS>>\n", "\n<</SYS>>\n\n"),
        ("system", "user"): Turn("", " [/INST]"),
        (START, "user"): Turn("<s>[INST] ", " [/INST]"),
        ("assistant", "user"): Turn("<s>[INST] ", " [/INST]"),
        ("user", "assistant"): Turn(" ", " </s>", loss=True),
    },
    control=("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<turn>", "<text>", "</turn>"),
    foreign=("<turn>", "<text>", "</turn>"),
    final=frozenset({"user", "assistant"}),
)


def escaped(text: Column, template: Template) -> Column:
    """``text`` without control strings; ``unescaped`` brings it back."""
    e = template.escape
    text = F.replace(text, F.lit(e), F.lit(e + e))
    for c in template.control:
        text = F.replace(text, F.lit(c), F.lit(c[0] + e + c[1:]))
    return text


def unescaped(text: Column, template: Template) -> Column:
    """A single escape behind a control string's first character was put there; of two, one was."""
    e = template.escape
    for c in reversed(template.control):
        text = F.replace(text, F.lit(c[0] + e + c[1:]), F.lit(c))
    return F.replace(text, F.lit(e + e), F.lit(e))


def segments(turns: DataFrame, template: Template = INSTRUCT, conv: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text", learn: str = "assistant") -> DataFrame:
    """``(conv, turn, role, allowed, segments)``, one row per turn, ``segments`` an array of ``(text, loss)``.

    A conversation's rows stand by turn (null last), equal turns by role and text. The machine's state is the role before; a step
    that the template does not allow is marked as foreign and ``allowed`` is false, so no turn is lost. Texts of ``learn`` carry
    the loss, allowed or not; marks never do. Null text and null role are empty; rows of null ``conv`` are one
    conversation; repeated rows are turns of their own; other columns play no part. Built-in expressions only.
    """
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    line = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    rows = rows.withColumns({"state": F.lag("role", 1, START).over(line), "place": F.row_number().over(line)})
    # the first turn has no role before it, a turn after an empty role has one that no step starts from
    state = F.when((F.col("place") > 1) & (F.col("state") == ""), F.lit(None)).otherwise(F.col("state"))
    plain = escaped(F.col("text"), template)
    opens, between, closes = template.foreign
    learned = F.col("role") == learn
    parts = F.array(
        F.struct(F.concat(F.lit(opens), escaped(F.col("role"), template), F.lit(between)).alias("text"), F.lit(False).alias("loss")),
        F.struct(plain.alias("text"), learned.alias("loss")), F.struct(F.lit(closes).alias("text"), F.lit(False).alias("loss")))
    allowed = F.lit(False)
    for (before, now), t in template.turns.items():
        here = F.coalesce((state == before) & (F.col("role") == now), F.lit(False))
        marked = F.array(F.struct(F.lit(t.before).alias("text"), F.lit(False).alias("loss")), F.struct(plain.alias("text"), F.lit(t.loss).alias("loss")),
                         F.struct(F.lit(t.after).alias("text"), F.lit(False).alias("loss")))
        parts, allowed = F.when(here, marked).otherwise(parts), allowed | here
    return rows.select("conv", "turn", "place", "role", allowed.alias("allowed"), parts.alias("segments"))


def conversations(turns: DataFrame, template: Template = INSTRUCT, **columns: str) -> DataFrame:
    """``(conv, valid, segments, formatted)``, one row per conversation, from the rows that ``segments`` takes.

    ``segments`` are those of all turns in order, ``formatted`` is their text. ``valid`` says that every step is allowed
    and the last role may end a conversation. A conversation is one value, as a text is; all of its turns meet in one
    row, and rows of other conversations never do. No rows give no row.
    """
    each = segments(turns, template, **columns)
    ordered = F.array_sort(F.collect_list(F.struct("place", "role", "allowed", "segments")))
    whole = each.groupBy("conv").agg(ordered.alias("t"))
    parts = F.flatten(F.col("t.segments"))
    valid = F.forall("t", lambda x: x["allowed"]) & F.element_at("t", -1)["role"].isin(*sorted(template.final))
    return whole.select("conv", valid.alias("valid"), parts.alias("segments"), F.array_join(F.transform(parts, lambda x: x["text"]), "").alias("formatted"))


def read_turns(formatted: Column, template: Template = INSTRUCT) -> Column:
    """The turns of a formatted conversation as an array of ``(role, text)``, parsed from its marks alone."""
    opens, between, closes = template.foreign
    ends = "|".join(f"\\Q{m}\\E" for m in (*template.closing, closes))
    piece = lambda i: F.regexp_extract_all(formatted, F.lit(f"(?s)(.*?)({ends})"), F.lit(i))

    def turn(body: Column, mark: Column) -> Column:
        rest = F.substr(body, F.lit(len(opens) + 1))
        name = F.substring_index(rest, between, 1)
        got = F.struct(unescaped(name, template).alias("role"), F.substr(rest, F.char_length(name) + (len(between) + 1)).alias("text"))
        for after in template.closing:
            role = next(r for (_, r), t in template.turns.items() if t.after == after)
            text = body
            plain = [m for m in template.opening(role) if not any(c in m for c in template.control)]
            if plain:
                text = F.substr(body, F.lit(len(plain[0]) + 1))
            for m in template.opening(role):
                if m not in plain:
                    text = F.when(F.startswith(body, F.lit(m)), F.substr(body, F.lit(len(m) + 1))).otherwise(text)
            got = F.when(mark == after, F.struct(F.lit(role).alias("role"), text.alias("text"))).otherwise(got)
        return F.struct(got["role"].alias("role"), unescaped(got["text"], template).alias("text"))

    return F.zip_with(piece(1), piece(2), turn)


def read_loss(segments: Column, template: Template = INSTRUCT) -> Column:
    """All text under the loss mask, unescaped, in order."""
    learned = F.filter(segments, lambda x: x["loss"])
    return F.array_join(F.transform(learned, lambda x: unescaped(x["text"], template)), "")
