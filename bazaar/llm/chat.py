"""Chat formatting: a state machine over roles and a declarative template, in SQL functions."""

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"
# The state behind a turn that may not follow: no transition leads on from it.
REFUSED = "\x00"


@dataclass(frozen=True)
class ChatTemplate:
    """What stands around a turn, which turns may follow each other, and whose text is learnt.

    A turn is ``start + role + after_role + text + end``. ``transitions`` maps a state to the
    roles that may come next; the state is the last role, at first ``start_state``. ``final``
    lists the states in which a conversation may end. ``reserved`` strings are control strings
    of other templates, which a text may not bring in either.
    """

    start: str = "<|im_start|>"
    after_role: str = "\n"
    end: str = "<|im_end|>\n"
    reserved: tuple[str, ...] = ("<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]")
    learnt: tuple[str, ...] = ("assistant",)
    start_state: str = ""
    final: tuple[str, ...] = ("assistant",)
    transitions: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )

    def __post_init__(self):
        firsts = {control[:1] for control in self.controls()}
        for control in self.controls():
            if len(control) < 2 or ESCAPE in control or firsts & set(control[1:]):
                raise ValueError(
                    f"{control!r}: a control string has two characters or more, no backslash, and"
                    " none inside it starts another one, else texts could not be escaped"
                )

    def controls(self) -> list[str]:
        """The strings that texts must not contain; line ends around them are not control."""
        return sorted({self.start.strip("\n"), self.end.strip("\n"), *self.reserved})

    def _pattern(self, escapes: str) -> str:
        parts = (f"{re.escape(c[0])}(?={escapes}{re.escape(c[1:])})" for c in self.controls())
        return "(" + "|".join(parts) + ")"

    def escaped(self, text: Column) -> Column:
        """Text in which each control string has a backslash behind its first character, one
        more than it may have had there: the same step undone gives the text back."""
        return F.regexp_replace(text, self._pattern(r"\\*"), r"$1\\")

    def unescaped(self, text: Column) -> Column:
        parts = (
            f"(?<={re.escape(c[0])})\\\\(?=\\\\*{re.escape(c[1:])})" for c in self.controls()
        )
        return F.regexp_replace(text, "|".join(parts), "")

    def escaped_role(self, role: Column) -> Column:
        """A role as one line: backslashes and the template's line feed have a name."""
        role = F.replace(role, F.lit("\\"), F.lit("\\\\"))
        return self.escaped(F.replace(role, F.lit("\n"), F.lit("\\n")))

    def unescaped_role(self, role: Column) -> Column:
        role = F.replace(self.unescaped(role), F.lit("\\\\"), F.lit("\\\x00"))
        role = F.replace(role, F.lit("\\n"), F.lit("\n"))
        return F.replace(role, F.lit("\\\x00"), F.lit("\\"))


DEFAULT_TEMPLATE = ChatTemplate()


def _next_state(template: ChatTemplate, state: Column, role: Column) -> Column:
    """The machine's step: the state is the last role, REFUSED once a turn was out of order."""
    allowed = F.lit(False)
    for source, roles in template.transitions.items():
        allowed = allowed | ((state == source) & role.isin(*roles))
    return F.when(allowed, role).otherwise(REFUSED)


def format_conversations(
    turns: DataFrame,
    template: ChatTemplate = DEFAULT_TEMPLATE,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row for each conversation: its id, ``segments``, ``formatted``, ``valid`` and
    ``first_bad_turn``.

    ``segments`` is an array of (text, loss): the pieces of ``formatted`` in their order, with
    the flag whether a model learns them; ``formatted`` is their concatenation. ``valid`` tells
    whether the machine accepted every turn and ended in a final state; ``first_bad_turn`` is
    the index of the first turn it refused (null if none). Invalid conversations are formatted
    too; the flag is for the caller to filter by.

    Turns go by turn, role and text, null turns first; repeated rows are turns of their own. A
    null text or role is empty. Rows without a conversation id form one conversation without an
    id. An empty table gives an empty one. A conversation is one row of the result, so its text
    meets in one task, as any row does; nothing else does.
    """
    ordered = F.sort_array(
        F.collect_list(
            F.struct(
                F.col(turn).alias("turn"),
                F.coalesce(F.col(role), F.lit("")).alias("role"),
                F.coalesce(F.col(text), F.lit("")).alias("text"),
            )
        )
    )
    grouped = turns.groupBy(F.col(conversation).alias(conversation)).agg(ordered.alias("turns"))
    segments = F.flatten(
        F.transform(
            "turns",
            lambda t: F.array(
                _segment(
                    F.concat(
                        F.lit(template.start), template.escaped_role(t["role"]),
                        F.lit(template.after_role),
                    ),
                    F.lit(False),
                ),
                _segment(template.escaped(t["text"]), t["role"].isin(*template.learnt)),
                _segment(F.lit(template.end), F.lit(False)),
            ),
        )
    )
    start = F.struct(
        F.lit(template.start_state).cast("string").alias("state"),
        F.lit(0).alias("index"),
        F.lit(None).cast("int").alias("bad"),
    )

    def step(machine: Column, t: Column) -> Column:
        state = _next_state(template, machine["state"], t["role"])
        bad = F.when(machine["bad"].isNull() & (state == REFUSED), machine["index"])
        return F.struct(
            state.alias("state"),
            (machine["index"] + 1).alias("index"),
            F.coalesce(machine["bad"], bad).alias("bad"),
        )

    return (
        grouped.withColumn("machine", F.aggregate("turns", start, step))
        .withColumn("segments", segments)
        .select(
            conversation,
            "segments",
            F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
            F.coalesce(F.col("machine.state").isin(*template.final), F.lit(False)).alias("valid"),
            F.col("machine.bad").alias("first_bad_turn"),
        )
    )


def _segment(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def read_turns(formatted: Column | str, template: ChatTemplate = DEFAULT_TEMPLATE) -> Column:
    """The turns of a formatted conversation as an array of (role, text), read from its string."""
    formatted = F.col(formatted) if isinstance(formatted, str) else formatted
    parts = F.split(formatted, re.escape(template.start))
    after = re.escape(template.after_role)

    def turn(part: Column) -> Column:
        body = F.substring(part, F.lit(1), F.length(part) - len(template.end))
        pair = F.split(body, after, 2)
        return F.struct(
            template.unescaped_role(pair[0]).alias("role"),
            template.unescaped(pair[1]).alias("text"),
        )

    return F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), turn)


def learnt_text(segments: Column | str, template: ChatTemplate = DEFAULT_TEMPLATE) -> Column:
    """All text under the loss mask, unescaped and joined in its order."""
    learnt = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(learnt, lambda s: template.unescaped(s["text"])), "")
