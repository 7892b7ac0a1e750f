"""Chat formatting (operator 1).

``format_turns`` orders the turns of each conversation, checks the order of
roles with a finite-state machine and emits, per turn, text segments with loss
flags from a declarative template.  ``read_back`` parses that output again.

Defined cases: a null text or role is the empty string; a null conversation id
is a conversation of its own; turns are ordered by (turn, role, text), nulls
last, so ties and repeated rows have one order; unknown roles are formatted and
marked invalid; other columns of the input are ignored; an empty table gives an
empty table.  Turns stream through a task in sorted order: only one turn is
held at a time, however long a conversation is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """``begin`` role ``separator`` text ``end`` for each turn.

    ``controls`` are the strings that must not occur unescaped inside a text;
    a backslash before a control string or a backslash undoes it.
    ``transitions[state][role]`` is the next state; a conversation is valid if
    every turn has a transition and the last state is in ``accept``."""

    begin: str = "<turn>"
    separator: str = "\n"
    end: str = "</turn>\n"
    controls: tuple[str, ...] = ("<turn>", "</turn>", "### ")
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    accept: tuple[str, ...] = ("assistant",)
    transitions: dict[str, dict[str, str]] = field(default_factory=lambda: {
        "start": {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user"},
    })

    def __post_init__(self):
        for c in self.controls:
            if not c or "\\" in c:
                raise ValueError("a control string is not empty and has no backslash")
            for k in range(1, len(c)):
                if self.end.startswith(c[k:]) or c[k:].startswith(self.end):
                    raise ValueError(f"a text that ends with {c[:k]!r} would complete {c!r} in the end marker")
        if not any(self.begin.startswith(c) for c in self.controls) \
                or not any(self.end.startswith(c) for c in self.controls):
            raise ValueError("the begin and end markers start with a control string")

    def escape(self, text: str, more: tuple[str, ...] = ()) -> str:
        marks = "|".join(re.escape(c) for c in ("\\", *self.controls, *more))
        return re.sub(f"(?={marks})", r"\\", text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        return [(self.begin + self.escape(role, (self.separator,)) + self.separator, False),
                (self.escape(text), role in self.loss_roles), (self.end, False)]

    def turn_pattern(self) -> re.Pattern:
        def inside(stop: str) -> str:
            return rf"((?:[^\\{re.escape(stop[0])}]++|\\.|(?!{re.escape(stop)}){re.escape(stop[0])})*+)"
        return re.compile(re.escape(self.begin) + inside(self.separator) + re.escape(self.separator)
                          + inside(self.end) + re.escape(self.end), re.DOTALL)


TURNS = ("conv_id long, turn_no long, role string, state string, valid boolean, "
         "segments array<struct<segment:string,loss:boolean>>")
CONVERSATIONS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                 "formatted_chars long, valid boolean")


def _number(x):
    return None if x is None or pd.isna(x) else int(x)


def format_turns(turns: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """One row per turn, sorted by conversation and turn within partitions:
    its number, role, the state it leads to, whether the machine has that
    transition, and its segments.  Joined segments are the formatted text."""
    template = template or ChatTemplate()
    ordered = (turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                            F.coalesce("role", F.lit("")).alias("role"),
                            F.coalesce("text", F.lit("")).alias("text"))
               .repartition("conv_id")
               .sortWithinPartitions("conv_id", F.asc_nulls_last("turn"), "role", "text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, no, state = object(), 0, template.start
        for batch in batches:
            rows = []
            for c, role, text in zip(batch["conv_id"], batch["role"], batch["text"]):
                c = _number(c)
                if c != conv:
                    conv, no, state = c, 0, template.start
                to = template.transitions.get(state, {}).get(role)
                state = to or state
                rows.append((c, no, role, state, to is not None,
                             [{"segment": s, "loss": m} for s, m in template.segments(role, text)]))
                no += 1
            out = pd.DataFrame(rows, columns=["conv_id", "turn_no", "role", "state", "valid", "segments"])
            out["conv_id"] = out["conv_id"].astype("Int64")
            yield out

    return ordered.mapInPandas(run, TURNS)


def read_back(formatted: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """Parse the formatted text of each conversation again (the order that
    ``format_turns`` left in its partitions): digests of its turns and of the
    text under the loss mask, and the formatted length in code points."""
    template = template or ChatTemplate()
    pattern = template.turn_pattern()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, row = object(), None

        def close():
            return (row["conv"], row["n"], row["turns"].hexdigest(), row["loss_chars"], row["loss"].hexdigest(),
                    row["chars"], row["valid"] and row["state"] in template.accept)

        def frame(rows):
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in CONVERSATIONS.split(", ")])
            out["conv_id"] = out["conv_id"].astype("Int64")
            return out

        for batch in batches:
            done = []
            for c, state, valid, segments in zip(batch["conv_id"], batch["state"], batch["valid"], batch["segments"]):
                c = _number(c)
                if c != conv:
                    if row:
                        done.append(close())
                    conv = c
                    row = {"conv": c, "n": 0, "chars": 0, "loss_chars": 0, "valid": True, "state": "",
                           "turns": hashlib.sha256(), "loss": hashlib.sha256()}
                text = "".join(s["segment"] for s in segments)
                at = 0
                while at < len(text):
                    found = pattern.match(text, at)
                    if not found:
                        raise ValueError(f"conversation {c}: no turn at offset {at} of {text[:80]!r}")
                    role, said = map(template.unescape, found.groups())
                    row["n"] += 1
                    row["turns"].update(f"{role}\n{said}\n".encode())
                    at = found.end()
                for s in segments:
                    if s["loss"]:
                        said = template.unescape(s["segment"])
                        row["loss_chars"] += len(said)
                        row["loss"].update(said.encode())
                row["chars"] += len(text)
                row["valid"] &= bool(valid)
                row["state"] = state
            if done:
                yield frame(done)
        if row:
            yield frame([close()])

    return formatted.mapInPandas(run, CONVERSATIONS)
