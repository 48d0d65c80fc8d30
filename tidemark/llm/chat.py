"""Chat formatting from a declarative template, checked by a finite-state machine over roles.

A template says for each role what stands before and after its text and whether the text counts for the loss, and which role may
follow which. The machine's state is the role of the last turn, so a turn is in order exactly if the template lets it follow the turn
before; that is one look back in a window, whatever the length of a conversation.

Every turn becomes segments (text, loss) whose texts joined are the formatted conversation. Control strings begin with one of a few
signs; inside texts each of these signs gets an escape sign behind it, which no control string has there. So texts cannot forge
control strings, and taking the escape sign away again restores every text exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

#: Signs that control strings begin with, and the sign put behind each of them inside texts.
SIGNS, ESCAPE = "<[|", "\\"


@dataclass(frozen=True)
class Role:
    before: str
    after: str
    loss: bool = False
    follows: frozenset[str | None] = frozenset()  # None: the beginning


@dataclass(frozen=True)
class Template:
    """Roles by name. A turn of any other role stands between `other` with its escaped name and `other_end`, is never in order, and has
    no loss. `ends` lists the roles a conversation may end with."""

    roles: dict[str, Role]
    ends: frozenset[str]
    other: tuple[str, str] = ("<|", "|>")
    other_end: str = "<|end|>"
    pattern: re.Pattern = field(init=False, repr=False)

    def __post_init__(self):
        text = rf"(?:[^{re.escape(SIGNS)}]|[{re.escape(SIGNS)}]{re.escape(ESCAPE)})*"
        parts = [f"{re.escape(r.before)}(?P<t{i}>{text}){re.escape(r.after)}" for i, r in enumerate(self.roles.values())]
        parts.append(f"{re.escape(self.other[0])}(?P<name>{text}){re.escape(self.other[1])}(?P<rest>{text}){re.escape(self.other_end)}")
        object.__setattr__(self, "pattern", re.compile("|".join(parts), re.DOTALL))


LLAMA = Template(
    {
        "system": Role("<<SYS>>\n", "\n<</SYS>>\n", follows=frozenset({None})),
        "user": Role("[INST] ", " [/INST]", follows=frozenset({None, "system", "assistant"})),
        "assistant": Role("<s> ", " </s>", loss=True, follows=frozenset({"user"})),
    },
    ends=frozenset({"assistant"}),
)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, f"([{re.escape(SIGNS)}])", f"$1{ESCAPE * 2}")


def unescape(text: str) -> str:
    return re.sub(f"([{re.escape(SIGNS)}]){re.escape(ESCAPE)}", r"\1", text)


def parse(template: Template, formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation, or of a part that holds whole turns."""
    out, at, names = [], 0, list(template.roles)
    while at < len(formatted):
        found = template.pattern.match(formatted, at)
        if not found:
            raise ValueError(f"no turn begins at {at}")
        groups = found.groupdict()
        if groups["name"] is not None:
            out.append((unescape(groups["name"]), unescape(groups["rest"])))
        else:
            i = next(i for i in range(len(names)) if groups[f"t{i}"] is not None)
            out.append((names[i], unescape(groups[f"t{i}"])))
        at = found.end()
    return out


def _order() -> list[Column]:
    return [F.col("turn"), F.col("role"), F.col("text")]


def format_turns(conversations: DataFrame, template: Template = LLAMA, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per turn: conv_id, turn, role, text, segments (array of text and loss), in_order.

    Null texts and roles count as empty; rows with the same turn go by role and text, and repeated rows are turns of their own. Rows without
    a conversation id form one conversation, and a null turn comes first. Other columns are not read.
    """
    rows = conversations.select(
        F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("last", F.lag("role").over(Window.partitionBy("conv_id").orderBy(*_order())))
    before = F.concat(F.lit(template.other[0]), escape(F.col("role")), F.lit(template.other[1]))
    after, loss, allowed = F.lit(template.other_end), F.lit(False), F.lit(False)
    for name, r in template.roles.items():
        own = F.col("role") == name
        follows = F.col("last").isin(*(x for x in r.follows if x is not None))
        if None in r.follows:
            follows = follows | F.col("last").isNull()
        before, after = F.when(own, r.before).otherwise(before), F.when(own, r.after).otherwise(after)
        loss, allowed = F.when(own, F.lit(r.loss)).otherwise(loss), F.when(own, F.coalesce(follows, F.lit(False))).otherwise(allowed)
    return rows.select(
        "conv_id", "turn", "role", "text",
        F.array(
            F.struct(before.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(F.col("text")).alias("text"), loss.alias("loss")),
            F.struct(after.alias("text"), F.lit(False).alias("loss")),
        ).alias("segments"),
        allowed.alias("in_order"),
    )


def conversations_read_back(turns: DataFrame, template: Template = LLAMA) -> DataFrame:
    """One row per conversation, read back from its segments: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
    in_order (every turn, and the last role may end it).

    Turns are sorted by conversation and streamed with running digests, so a conversation of any length takes the memory of one turn.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "in_order"]
    kind = turns.schema["conv_id"].dataType.simpleString()
    ends = template.ends
    # the template goes as plain values; its pattern is made again in the task
    said = ({n: (r.before, r.after, r.loss, tuple(r.follows)) for n, r in template.roles.items()}, tuple(template.ends), template.other, template.other_end)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roles, last_roles, other, other_end = said
        own = Template({n: Role(b, a, x, frozenset(f)) for n, (b, a, x, f) in roles.items()}, frozenset(last_roles), other, other_end)
        done: list[tuple] = []
        state: list | None = None

        def close() -> None:
            conv, n, turns_hash, chars, loss_hash, formatted, fine, role = state
            done.append((conv, n, turns_hash.hexdigest(), chars, loss_hash.hexdigest(), formatted, fine and role in ends))

        ids = pa.array([])
        for batch in batches:
            ids = batch.column(0)
            for conv, segments, fine in zip(ids.to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if state is None or state[0] != conv:
                    if state is not None:
                        close()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, True, ""]
                formatted = "".join(s["text"] for s in segments)
                for role, text in parse(own, formatted):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                    state[7] = role
                loss = unescape("".join(s["text"] for s in segments if s["loss"]))
                state[3] += len(loss)
                state[4].update(loss.encode())
                state[5] += len(formatted)
                state[6] = state[6] and fine
            if len(done) > 10_000:
                yield batch_of(done, ids.type)
                done.clear()
        if state is not None:
            close()
            yield batch_of(done, ids.type)

    def batch_of(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", *_order()).select("conv_id", "segments", "in_order")
    return ordered.mapInArrow(
        read, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, in_order boolean"
    )
