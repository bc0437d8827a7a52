"""Chat formatting by a grammar round trip.

A template writes each turn as marks around the text; the marks are the tokens of a small
grammar::

    conversation = turn*
    turn         = before text after            (a role of the template)
                 | other role between text end  (any other role)

Texts hold no mark, so one mark tells what follows and a single pass from left to right reads it back.
A turn is rendered as it is, parsed again and compared with the source; while they
differ, more of it is escaped:

0. nothing;
1. every mark inside the text: a backslash after its first character (``<\\/s>``);
2. also what looks like an escaped mark already (one more backslash).

The parser takes one backslash off each such string, so level 2 recovers any text (a
property test): a text without marks is never changed, one with marks by one
character for each.  Turns are self-delimiting, hence they are formatted where
they are read, without a shuffle.

``read_back`` parses whole conversations from the formatted turns alone: it streams them in
order through the parser, with one turn in memory, and hashes as it goes, so a
conversation of any length takes bounded memory.  A turn that does not come back as it was fails the job.

Defined cases: rows are ordered by turn (null first), then role, then formatted
text, so ties and repeated rows have one order and all count; a null text or
role is empty; rows with a null conversation are one conversation; an empty table
gives no rows; only ``conv_id``, ``turn``, ``role`` and ``text`` are read, so other columns
cannot clash.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import text_of


@dataclass(frozen=True)
class Template:
    """Marks of a chat format.

    ``roles``: (before, after) by role, before may be empty for one role.  ``other``:
    (before, between, after) for the remaining roles, whose name is written.
    ``reserved``: further control strings that no text may hold.
    """

    roles: dict[str, tuple[str, str]] = field(default_factory=lambda: {
        "system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("", "</s>")})
    other: tuple[str, str, str] = ("[ROLE]", "[/ROLE]", "</s>")
    loss: tuple[str, ...] = ("assistant",)
    reserved: tuple[str, ...] = ("<s>",)

    def __post_init__(self):
        opening = [before for before, _ in self.roles.values()] + [self.other[0]]
        if len(set(opening)) < len(opening) or not all(after for _, after in self.roles.values()) or not all(self.other):
            raise ValueError("each role needs marks of its own")
        for a in self.marks:
            if len(a) < 2 or "\\" in a:
                raise ValueError(f"{a!r} cannot be escaped")
            for b in self.marks:
                # The end of a text and the start of a mark, or the reverse, must not form a mark.
                if a != b and b in a or any(a.endswith(b[:k]) for k in range(1, len(b) if a == b else len(b) + 1)):
                    raise ValueError(f"{a!r} and {b!r} overlap")

    @cached_property
    def marks(self) -> list[str]:
        found = {m for pair in self.roles.values() for m in pair} | set(self.other) | set(self.reserved)
        return sorted(found - {""})

    @cached_property
    def mark(self) -> re.Pattern:
        return re.compile("|".join(map(re.escape, self.marks)))

    @cached_property
    def escapable(self) -> re.Pattern:
        """A mark with any number of backslashes after its first character."""
        return re.compile("|".join(rf"(?<={re.escape(m[0])})\\*(?={re.escape(m[1:])})" for m in self.marks))


LLAMA = Template()


def escape(t: Template, text: str, level: int) -> str:
    if level == 0:
        return text
    if level == 1:
        return t.mark.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)
    return t.escapable.sub(lambda m: m[0] + "\\", text)


def unescape(t: Template, text: str) -> str:
    return t.escapable.sub(lambda m: m[0][1:], text) if "\\" in text else text


class NotInGrammar(ValueError):
    pass


def parse_turn(t: Template, text: str, at: int = 0) -> tuple[str, int, int, int]:
    """One turn from ``at``: role, start and end of its text, and where it ends.

    Deterministic: the mark at ``at``, or that there is none, decides the rule;
    each following mark must be the one that the rule names.
    """
    def upto(after: str, begin: int) -> int:
        m = t.mark.search(text, begin)
        if not m or m[0] != after:
            raise NotInGrammar(f"{after} expected from {begin}")
        return m.start()

    if at >= len(text):
        raise NotInGrammar("a turn expected")
    m = t.mark.match(text, at)
    for role, (before, after) in t.roles.items():
        if m and m[0] == before and before:
            end = upto(after, m.end())
            return role, m.end(), end, end + len(after)
    if m and m[0] == t.other[0]:
        middle = upto(t.other[1], m.end())
        begin = middle + len(t.other[1])
        end = upto(t.other[2], begin)
        return unescape(t, text[m.end():middle]), begin, end, end + len(t.other[2])
    for role, (before, after) in t.roles.items():
        if not before:
            end = upto(after, at)
            return role, at, end, end + len(after)
    raise NotInGrammar("no turn starts here")


def parse(t: Template, text: str) -> list[tuple[str, str]]:
    """All turns of a formatted conversation, as (role, text)."""
    turns, at = [], 0
    while at < len(text):
        role, begin, end, at = parse_turn(t, text, at)
        turns.append((role, unescape(t, text[begin:end])))
    return turns


def render(t: Template, role: str, text: str) -> tuple[str, int, int, int]:
    """The turn, start and end of its text, and the escape level at which it comes back identical."""
    for level in range(3):
        if role in t.roles:
            before, after = t.roles[role]
        else:
            before, after = t.other[0] + escape(t, role, level) + t.other[1], t.other[2]
        body = escape(t, text, level)
        turn = before + body + after
        try:
            found, begin, end, stop = parse_turn(t, turn)
        except NotInGrammar:
            continue
        if stop == len(turn) and found == role and unescape(t, turn[begin:end]) == text:
            return turn, begin, end, level
    raise AssertionError("an escaped turn does not come back")


TURN = "conv_id {}, turn {}, role string, formatted string, loss_start int, loss_end int, level int, source_crc long"


def format_turns(conversations: DataFrame, template: Template = LLAMA) -> DataFrame:
    """One row per turn: ``conv_id, turn, role``, the ``formatted`` text, the code points
    ``loss_start`` to ``loss_end`` of it that a model is trained on (-1 where none), the escape
    ``level`` and ``source_crc`` of role and text.  A conversation's text is its turns in order."""
    rows = conversations.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"))
    kinds = [rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn")]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                turn, begin, end, level = render(template, role, text)
                loss = (begin, end) if role in template.loss else (-1, -1)
                out.append((turn, *loss, level, zlib.crc32(f"{role}\n{text}".encode())))
            turn, begin, end, level, crc = zip(*out) if out else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), batch.column("role"), pa.array(turn, pa.string()),
                 pa.array(begin, pa.int32()), pa.array(end, pa.int32()), pa.array(level, pa.int32()), pa.array(crc, pa.int64())],
                names=["conv_id", "turn", "role", "formatted", "loss_start", "loss_end", "level", "source_crc"])

    return rows.mapInArrow(task, TURN.format(*kinds))


class _Conversation:
    """Digests of one conversation while its turns stream by."""

    def __init__(self, key):
        self.key, self.n, self.chars, self.loss_chars = key, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, t: Template, formatted: str, loss: tuple[int, int], crc: int) -> None:
        at = 0
        while at < len(formatted):
            role, begin, end, at = parse_turn(t, formatted, at)
            text = unescape(t, formatted[begin:end])
            source = f"{role}\n{text}".encode()
            if zlib.crc32(source) != crc or at != len(formatted):
                raise ValueError(f"a turn of conversation {self.key} does not come back as it was")
            self.turns.update(source + b"\n")
            self.n += 1
        if loss[0] >= 0:
            text = unescape(t, formatted[loss[0]:loss[1]])
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        self.chars += len(formatted)

    def row(self) -> tuple:
        return self.key, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(turns: DataFrame, template: Template = LLAMA) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``, from formatted turns."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    ordered = (turns.select("conv_id", "turn", "role", "formatted", "loss_start", "loss_end", "source_crc")
               .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "formatted"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, key_type = None, None

        def table(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], key_type), *[pa.array(c, k) for c, k in zip(columns[1:], types)]], names=names)

        for batch in batches:
            key_type, rows = batch.column("conv_id").type, []
            for key, formatted, start, end, crc in zip(*(batch.column(c).to_pylist() for c in (
                    "conv_id", "formatted", "loss_start", "loss_end", "source_crc"))):
                if now is None or now.key != key:
                    if now is not None:
                        rows.append(now.row())
                    now = _Conversation(key)
                now.add(template, formatted, (start, end), crc)
            if rows:
                yield table(rows)
        if now is not None:
            yield table([now.row()])

    return ordered.mapInArrow(task, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
                                    "loss_sha256 string, formatted_chars long")
