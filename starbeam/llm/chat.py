"""Chat formatting: a template is rendered on successive turn prefixes.

A template is a black box, ``render(turns) -> str``.  Each turn's piece is
what its prefix's rendering adds to the rendering before; a rendering that
does not begin with the one before has rewritten history, and the
conversation is reported as such.  Where a turn's text stands inside its
piece is found by two probes, which differ in the text only: what both begin
and end with is the frame, the rest is the text.

Rows are dealt by conversation and sorted; a task holds the turns and pieces
of one conversation, as every prefix is rendered from its turns.
A template whose pieces depend on their own turn alone can say so by an
attribute ``by_turn``; then, and only then, a conversation of more than
``LONG`` turns is rendered on its first turn and its last ``RECENT`` ones.
The declaration is checked: at each doubling of the turns and at the end the
whole prefix is rendered and compared with the pieces so far (a cost in
proportion to the turns), and where they differ, every prefix of that
conversation is rendered.  Pieces are written one row a turn, so no row holds
a whole conversation.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[Sequence[Turn]], str]

#: by a template with ``by_turn``, a conversation of more turns is rendered on its first turn and the last RECENT ones
LONG, RECENT = 256, 32
#: characters of pieces that go out together
STRETCH = 4 << 20
LEARNED_ROLE = "assistant"
START, END = "<|im_start|>", "<|im_end|>"
_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<(\\*)\\\|")


def escape(text: str) -> str:
    """One more backslash inside every ``<|``, ``<\\|``, ... so that no control string is left; ``unescape`` takes it out."""
    return _CONTROL.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def chatml(turns: Sequence[Turn]) -> str:
    """The default template; roles are written as JSON strings without quotes, so a role is one line."""
    return "".join(f"{START}{escape(json.dumps(role, ensure_ascii=False)[1:-1])}\n{escape(text)}{END}\n" for role, text in turns)


chatml.by_turn = True


def common_end(a: str, b: str) -> int:
    return len(os.path.commonprefix([a[::-1], b[::-1]]))


class Renderer:
    """Renders one conversation turn by turn."""

    def __init__(self, template: Template, frames: dict[str, tuple[str, str]], every_prefix: bool = False) -> None:
        self.template, self.frames = template, frames
        self.by_turn = getattr(template, "by_turn", False) and not every_prefix
        self.turns: list[Turn] = []
        self.before = template([])
        self.length = len(self.before)
        self.opening = self.before
        self.rewrote = False

    def frame(self, role: str, piece: str) -> tuple[str, str]:
        # where a frame may depend on the turn's place, a known one that fits could still be another's
        head, tail = self.frames.get(role, (None, None)) if self.by_turn else (None, None)
        if head is None or not (piece.startswith(head) and piece.endswith(tail) and len(piece) >= len(head) + len(tail)):
            one, two = (self.template([*self.turns, (role, probe)])[len(self.before) :] for probe in ("A", "B"))
            head = os.path.commonprefix([one, two])
            tail = one[len(one) - common_end(one, two) :]
            self.frames[role] = head, tail
        return head, tail

    def add(self, role: str, text: str) -> tuple[str, int, int]:
        """The turn's piece, and where its text begins and ends in the conversation's rendering (-1, -1 once history was rewritten)."""
        now = self.template([*self.turns, (role, text)])
        if not now.startswith(self.before):
            self.rewrote = True
        piece = now[len(os.path.commonprefix([now, self.before])) if self.rewrote else len(self.before) :]
        begin = end = -1
        if not self.rewrote:
            head, tail = self.frame(role, piece)
            begin, end = self.length + len(head), self.length + len(piece) - len(tail)
        if self.length == len(self.opening) and not self.turns:
            piece = self.opening + piece
            self.length = 0
        self.length += len(piece)
        self.turns.append((role, text))
        self.before = now
        if len(self.turns) > LONG and self.by_turn:
            self.turns = self.turns[:1] + self.turns[-RECENT:]
            self.before = self.template(self.turns)
        return piece, begin, end


Piece = tuple[str, int, int, bool]


def rendered(template: Template, turns: Sequence[Turn], frames: dict[str, tuple[str, str]]) -> list[Piece]:
    """Piece, begin, end (see ``Renderer.add``) and whether history was rewritten, for each turn.

    A declaration ``by_turn`` that turns out wrong has no effect: every prefix is rendered then.
    """
    renderer, out, check = Renderer(template, frames), [], LONG
    for k, turn in enumerate(turns, 1):
        out.append((*renderer.add(*turn), renderer.rewrote))
        if renderer.by_turn and (renderer.rewrote or k > LONG and (k == len(turns) or k >= 2 * check)):
            if renderer.rewrote or template(turns[:k]) != "".join(piece for piece, *_ in out):
                exact = Renderer(template, {}, every_prefix=True)
                return [(*exact.add(*t), exact.rewrote) for t in turns]
            check = k
    return out


def in_order(conversations: DataFrame) -> DataFrame:
    """Rows of a conversation together, by turn, then role and text; nulls first."""
    return conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def format_conversations(conversations: DataFrame, template: Template = chatml, learned: str = LEARNED_ROLE) -> DataFrame:
    """One row a turn: conv_id, seq, piece, begin, end (of the learned text, else null), rewrote.

    The pieces of a conversation, in order, are its formatted text.  ``begin``
    and ``end`` count from the conversation's start and are set for turns of
    the learned role.  After a rewriting template, ``rewrote`` is true from
    that turn on and no text is learned.  A null role or text counts as
    empty, a null conv_id as a conversation; repeated rows are turns of
    their own; an empty table gives an empty result.
    """
    id_type = conversations.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "seq", "piece", "begin", "end", "rewrote"]
    types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames: dict[str, tuple[str, str]] = {}
        key, turns, arrow_id = object(), [], None
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal size
            columns = [pa.array(c, t) for c, t in zip(zip(*held, strict=True), (arrow_id, *types), strict=True)]
            held.clear()
            size = 0
            return pa.RecordBatch.from_arrays(columns, names=names)

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal size
            for seq, ((role, _), (piece, begin, end, rewrote)) in enumerate(zip(turns, rendered(template, turns, frames), strict=True)):
                taught = role == learned and begin >= 0
                held.append((key, seq, piece, begin if taught else None, end if taught else None, rewrote))
                size += len(piece)
                if size >= STRETCH or len(held) >= 10_000:
                    yield flush()

        for batch in batches:
            arrow_id = batch.schema.field("conv_id").type
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if conv != key:
                    yield from close()
                    key, turns = conv, []
                turns.append((role, text))
        yield from close()
        if held:
            yield flush()

    return in_order(conversations).mapInArrow(run, f"conv_id {id_type}, seq long, piece string, begin long, end long, rewrote boolean")


class Reader:
    """Reads a conversation's formatted text back, piece by piece."""

    def __init__(self) -> None:
        self.turns = self.loss_chars = self.chars = 0
        self.digest, self.loss = hashlib.sha256(), hashlib.sha256()
        self.held = ""

    def feed(self, piece: str, begin: int | None, end: int | None) -> None:
        if begin is not None:
            text = unescape(piece[begin - self.chars : end - self.chars])
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        self.chars += len(piece)
        self.held += piece
        at = 0
        while (stop := self.held.find(END + "\n", at)) >= 0:
            if not self.held.startswith(START, at):
                raise ValueError(f"no turn begins at {self.held[at : at + 40]!r}")
            role, _, text = self.held[at + len(START) : stop].partition("\n")
            self.digest.update((json.loads(f'"{unescape(role)}"') + "\n" + unescape(text) + "\n").encode())
            self.turns += 1
            at = stop + len(END) + 1
        self.held = self.held[at:]


def read_back(pieces: DataFrame) -> DataFrame:
    """One row a conversation, from ``format_conversations`` with the default template: conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars.  Pieces must come as they left it."""
    id_type = pieces.schema["conv_id"].dataType
    arrow_id = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_type.simpleString()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, reader, done = object(), None, []

        def close() -> None:
            if reader is not None:
                if reader.held:
                    raise ValueError(f"conversation {key} ends inside a turn")
                done.append((key, reader.turns, reader.digest.hexdigest(), reader.loss_chars, reader.loss.hexdigest(), reader.chars))

        def flush() -> pa.RecordBatch:
            types = (arrow_id, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            columns = [pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for conv, piece, begin, end in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "piece", "begin", "end")), strict=True):
                if conv != key:
                    close()
                    key, reader = conv, Reader()
                reader.feed(piece, begin, end)
            if done:
                yield flush()
        close()
        if done:
            yield flush()

    return pieces.mapInArrow(run, f"conv_id {id_type.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, "
                                  "loss_sha256 string, formatted_chars long")
