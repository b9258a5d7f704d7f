"""Chat formatting: a finite-state machine over roles emits text segments with loss flags.

The template says, per role, what stands before and after a text, which roles may follow and whether a
text is trained on; it is data, the machine only follows it. Control strings inside texts are escaped by
``ESCAPE`` and read back by the same machine, so formatting loses nothing. A conversation
with a forbidden order is formatted whole and flagged.

Rows of a conversation are read in order of turn (then role and text) from a sorted stream: no more than
one turn and two running digests are held, however long it is. Null texts and roles are empty, unknown roles
use the template's entry for other roles. Null ids form one conversation. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doorledger.llm.common import map_rows, shuffle_parts

ESCAPE = "\\"


@dataclass(frozen=True)
class Turn:
    """How turns of a role are written: text around it, roles that may come before it, trained or not."""

    before: str
    after: str
    follows: frozenset
    loss: bool = False


@dataclass(frozen=True)
class Template:
    turns: dict[str, Turn]
    start: str = "<s>"
    end: str = "</s>"
    other: Turn = field(default_factory=lambda: Turn("[ROLE]", "[/ROLE]", frozenset()))

    def controls(self) -> list[str]:
        marks = {self.start, self.end, self.other.before, self.other.after, ESCAPE, "|"}
        for t in self.turns.values():
            marks |= {t.before, t.after}
        return sorted((m for m in marks if m), key=len, reverse=True)


#: the initial state is ""
TEMPLATE = Template({
    "system": Turn("[SYS]", "[/SYS]", frozenset({""})),
    "user": Turn("[INST]", "[/INST]", frozenset({"", "system", "assistant"})),
    "assistant": Turn("[ANS]", "[/ANS]", frozenset({"user"}), loss=True),
})


class Formatter:
    """One conversation at a time: ``turn`` gives its segments, ``close`` the last one."""

    def __init__(self, template: Template = TEMPLATE):
        self.t = template
        self.controls = re.compile("|".join(map(re.escape, template.controls())))
        self.reset()

    def reset(self) -> None:
        self.state, self.valid, self.begun = "", True, False

    def escaped(self, text: str) -> str:
        return self.controls.sub(lambda m: ESCAPE + m[0], text)

    def turn(self, role: str, text: str) -> Iterator[tuple[str, bool]]:
        """Segments (text, trained on) of the next turn."""
        if not self.begun:
            self.begun = True
            yield self.t.start, False
        how = self.t.turns.get(role)
        self.valid &= how is not None and self.state in how.follows
        self.state = role
        if how is None:
            how = self.t.other
            yield f"{how.before}{self.escaped(role)}|", False
        else:
            yield how.before, False
        if text:
            yield self.escaped(text), how.loss
        yield how.after, False

    def close(self) -> Iterator[tuple[str, bool]]:
        self.valid &= self.state == "assistant"
        yield self.t.end, False


class Reader:
    """Reads formatted segments back to (role, text, trained text) turns."""

    def __init__(self, template: Template = TEMPLATE):
        self.t = template
        controls = "|".join(map(re.escape, template.controls()))
        self.token = re.compile(f"{re.escape(ESCAPE)}({controls})|({controls})")
        self.roles = {turn.before: role for role, turn in template.turns.items()}
        self.role, self.text, self.trained = None, [], []

    def feed(self, segment: str, loss: bool) -> Iterator[tuple[str, str, str]]:
        at = 0
        for m in self.token.finditer(segment):
            self._plain(segment[at:m.start()], loss)
            at = m.end()
            if m[1] is not None:
                self._plain(m[1], loss)
                continue
            mark = m[2]
            if mark in self.roles:
                self.role, self.text, self.trained = self.roles[mark], [], []
            elif mark == self.t.other.before:
                self.role, self.text, self.trained = None, [], []
            elif mark == "|":
                self.role, self.text = "".join(self.text), []
            elif mark not in (self.t.start, self.t.end):
                yield self.role, "".join(self.text), "".join(self.trained)
        self._plain(segment[at:], loss)

    def _plain(self, text: str, loss: bool) -> None:
        if text:
            self.text.append(text)
            if loss:
                self.trained.append(text)


def formatted(rows: DataFrame, template: Template = TEMPLATE, conv: str = "conv_id", turn: str = "turn",
              role: str = "role", text: str = "text") -> DataFrame:
    """Segments (conv_id, segment, text, loss) of all conversations, in order within a conversation."""
    def run(batches):
        f, now, number = Formatter(template), (), 0
        for b in batches:
            out = ([], [], [], [])

            def put(conv_id, segments):
                nonlocal number
                for s, loss in segments:
                    for column, value in zip(out, (conv_id, number, s, loss), strict=True):
                        column.append(value)
                    number += 1

            for c, r, t in zip(*(b[k].to_pylist() for k in ("_c", "_r", "_x")), strict=True):
                if now != (c,):
                    if now:
                        put(now[0], f.close())
                    f.reset()
                    now, number = (c,), 0
                put(c, f.turn(r, t))
            yield dict(zip(("conv_id", "segment", "text", "loss"), out, strict=True))
        if now:
            last = list(f.close())
            yield {"conv_id": [now[0]], "segment": [number], "text": [last[0][0]], "loss": [False]}

    return map_rows(_ordered(rows, conv, turn, role, text), run, "conv_id long, segment long, text string, loss boolean")


def _ordered(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    return (rows.select(F.col(conv).cast("long").alias("_c"), F.col(turn).cast("long").alias("_t"),
                        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("_r"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_x"))
            .repartition(shuffle_parts(rows), "_c").sortWithinPartitions("_c", "_t", "_r", "_x").select("_c", "_r", "_x"))


class _Digest:
    def __init__(self):
        self.turns, self.loss, self.n, self.loss_chars, self.chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0

    def add(self, role: str, text: str, trained: str) -> None:
        self.n += 1
        self.turns.update(f"{role}\n{text}\n".encode())
        self.loss.update(trained.encode())
        self.loss_chars += len(trained)


def digests(rows: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Per conversation, what its formatted text reads back to, and whether its order is allowed."""
    def run(batches):
        f, reader, now, d, out = Formatter(template), Reader(template), (), None, []

        def take(segments):
            for s, loss in segments:
                d.chars += len(s)
                for role, text, trained in reader.feed(s, loss):
                    d.add(role, text, trained)

        def finish():
            take(f.close())
            out.append((now[0], d.n, d.turns.hexdigest(), d.loss_chars, d.loss.hexdigest(), d.chars, f.valid))

        def columns():
            cols = [list(x) for x in zip(*out, strict=True)]
            out.clear()
            return dict(zip(("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid_order"), cols, strict=True))

        for b in batches:
            for c, r, t in zip(*(b[k].to_pylist() for k in ("_c", "_r", "_x")), strict=True):
                if now != (c,):
                    if now:
                        finish()
                    f.reset()
                    now, d = (c,), _Digest()
                take(f.turn(r, t))
            if out:
                yield columns()
        if now:
            finish()
            yield columns()

    return map_rows(_ordered(rows, "conv_id", "turn", "role", "text"), run,
                    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                    "formatted_chars long, valid_order boolean")
