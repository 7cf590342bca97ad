"""Chat formatting: a finite-state machine over roles and a declarative template, in DataFrame operations only.

A template names the states that each role may follow, what stands before and after a turn, and the roles whose
text a model is trained on. ``format_chats`` orders the turns of a conversation, runs the machine over their
roles and emits segments: head, text and tail of each turn, each with its loss flag. The formatted text is the
segments in a row. ``read_chats`` takes the segments back to turns and to the text under the loss mask.

Control strings begin with ``<|``. Inside texts and roles one backslash is put between ``<`` and ``|`` (and one
more where backslashes stand there already), so no text can hold a control string; reading takes it out again.
In roles a line break and a backslash are escaped too, since a line break ends a head.

The machine: a turn whose role may not follow the state before it is counted and the machine goes on in the state
of that role; a conversation is valid if no turn is wrong and it ends in an accepting state. Wrong
conversations are formatted like the others; ``valid``, ``n_wrong`` and ``first_wrong`` let a caller drop them.

A formatted conversation is one training example and one row, so its turns meet in one task by nature; it
cannot be longer than a string (2 GB). Texts are shuffled once, by conversation.

Nulls, ties and odd rows: null role or text is empty; a null turn comes first; turns with the same number are
ordered by role, then text; repeated rows are turns of their own; rows without a conv_id are one conversation
with a null conv_id; an unknown role has no state and is a wrong turn; extra columns are not read; an empty
table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START = "start"


@dataclass(frozen=True)
class Template:
    """Turn marks, the loss roles and the machine: ``follows[role]`` are the states that ``role`` may follow."""

    opening: str = "<|im_start|>"
    between: str = "\n"
    closing: str = "<|im_end|>"
    after: str = "\n"
    loss: tuple[str, ...] = ("assistant",)
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "system": (START,),
            "user": (START, "system", "assistant"),
            "assistant": ("user", "tool"),
            "tool": ("assistant",),
        }
    )
    accepting: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        if not (self.opening.startswith("<|") and self.closing.startswith("<|") and self.between == "\n"):
            raise ValueError("control strings begin with <| and a line break ends a head")
        if self.opening.startswith(self.closing) or self.closing.startswith(self.opening):
            raise ValueError("one control string begins with the other")


CHATML = Template()


def escaped(text: Column) -> Column:
    """``<|`` gets a backslash between, ``<\\|`` a second one, and so on."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escaped_role(role: Column) -> Column:
    return F.replace(F.replace(escaped(role), F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(F.replace(role, F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\")))


def _checked(roles: Column, template: Template) -> Column:
    """The machine's run over an array of roles: state, n_wrong, first_wrong (0-based, -1 for none), at."""
    allowed = F.array(*[F.lit(f"{state}\x00{role}") for role, states in template.follows.items() for state in states])
    start = F.struct(
        F.lit(START).alias("state"), F.lit(0).cast("long").alias("n_wrong"), F.lit(-1).cast("long").alias("first_wrong"),
        F.lit(0).cast("long").alias("at"),
    )

    def step(run: Column, role: Column) -> Column:
        wrong = ~F.array_contains(allowed, F.concat(run["state"], F.lit("\x00"), role))
        return F.struct(
            role.alias("state"),
            (run["n_wrong"] + wrong.cast("long")).alias("n_wrong"),
            F.when(wrong & (run["first_wrong"] < 0), run["at"]).otherwise(run["first_wrong"]).alias("first_wrong"),
            (run["at"] + 1).alias("at"),
        )

    return F.aggregate(roles, start, step)


def _segment(text: Column, loss: Column | bool) -> Column:
    flag = F.lit(loss) if isinstance(loss, bool) else loss
    return F.struct(text.alias("text"), flag.alias("loss"))


def _emitted(template: Template):
    """A turn's segments: head, text, tail."""
    trained = F.array(*[F.lit(r) for r in template.loss]) if template.loss else F.array().cast("array<string>")

    def of(turn: Column) -> Column:
        head = F.concat(F.lit(template.opening), escaped_role(turn["role"]), F.lit(template.between))
        tail = F.lit(template.closing + template.after)
        return F.array(
            _segment(head, False), _segment(escaped(turn["text"]), F.array_contains(trained, turn["role"])), _segment(tail, False)
        )

    return of


def format_chats(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """conv_id, n_turns, valid, n_wrong, first_wrong (null for none), segments array<struct<text, loss>> per conversation."""
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("_turns"))
    chats = chats.withColumn("_run", _checked(F.transform("_turns", lambda t: t["role"]), template))
    run = F.col("_run")
    return chats.select(
        "conv_id",
        run["at"].alias("n_turns"),
        ((run["n_wrong"] == 0) & run["state"].isin(list(template.accepting))).alias("valid"),
        run["n_wrong"].alias("n_wrong"),
        F.nullif(run["first_wrong"], F.lit(-1).cast("long")).alias("first_wrong"),
        F.flatten(F.transform("_turns", _emitted(template))).alias("segments"),
    )


def formatted(segments: Column) -> Column:
    """The formatted conversation."""
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def read_turns(text: Column, template: Template = CHATML) -> Column:
    """array<struct<role, text>> of a formatted conversation."""
    quoted = "".join("\\" + c if not c.isalnum() and c != "\n" else c for c in template.closing + template.after)
    parts = F.filter(F.split(text, quoted, -1), lambda p: p != "")

    def turn(part: Column) -> Column:
        head = F.substring_index(part, template.between, 1)
        role = F.substring(head, F.lit(len(template.opening) + 1), F.length(head))
        said = F.substring(part, F.length(head) + len(template.between) + 1, F.length(part))
        return F.struct(unescaped_role(role).alias("role"), unescaped(said).alias("text"))

    return F.transform(parts, turn)


def loss_text(segments: Column) -> Column:
    """What stands under the loss mask, without escapes."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")


def read_chats(chats: DataFrame, template: Template = CHATML) -> DataFrame:
    """conv_id, valid, formatted, loss_text, turns array<struct<role, text>>, read from the segments of ``chats``."""
    out = chats.select("conv_id", "valid", formatted(F.col("segments")).alias("formatted"), loss_text(F.col("segments")).alias("loss_text"))
    return out.withColumn("turns", read_turns(F.col("formatted"), template))
