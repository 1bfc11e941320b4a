"""Chat formatting with a round trip through a grammar.

Every turn is rendered into a template, read again by a deterministic parser and
compared with its source; a turn that does not come back as it was has its
control strings escaped until it does.  The grammar, over control strings and
the plain text between them:

    conversation = { turn }
    turn = "<<SYS>>" text "<</SYS>>" | "[INST]" text "[/INST]" | "<s>" text "</s>"
         | "[TURN]" role "[SEP]" text "[/TURN]"

Text and role have one space on either side.  The first string alone tells the
kind of a turn, and no end of a control string is the start of another, so that
the conversation is its rendered turns one after the other.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch

#: Opening and closing string of the roles that have a kind of turn of their own.
FRAMES = {
    "system": ("<<SYS>>", "<</SYS>>"),
    "user": ("[INST]", "[/INST]"),
    "assistant": ("<s>", "</s>"),
}
ROLE_OPEN, ROLE_END, ROLE_CLOSE = "[TURN]", "[SEP]", "[/TURN]"
#: Role whose text is learned.
LEARNED = "assistant"
#: A conversation that is longer is given in several parts, cut between turns.
PART_CHARS = 1_000_000

_STRINGS = [s for pair in FRAMES.values() for s in pair] + [ROLE_OPEN, ROLE_END, ROLE_CLOSE]
CONTROL = re.compile("|".join(re.escape(s) for s in _STRINGS))
#: The same strings with any number of backslashes after their first character.
_GUARDED = re.compile("|".join(re.escape(s[0]) + r"\\*" + re.escape(s[1:]) for s in _STRINGS))
_ESCAPED = re.compile("|".join(re.escape(s[0]) + r"\\+" + re.escape(s[1:]) for s in _STRINGS))
_OPENED = {a: (role, b) for role, (a, b) in FRAMES.items()}

Turn = tuple[str, str]


class FormatError(ValueError):
    """The text does not follow the grammar."""


def escape(text: str) -> str:
    """One more backslash in every control string, whether it has some already or not."""
    return _GUARDED.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    """One backslash less; undoes :func:`escape` on any text."""
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


def _body(text: str, start: int, end: int) -> tuple[int, int]:
    if end - start < 2 or text[start] != " " or text[end - 1] != " ":
        raise FormatError(f"no space beside a control string at {start}")
    return start + 1, end - 1


def parse(text: str) -> Iterator[tuple[str, str, int, int]]:
    """The turns of a rendered text: role, text, and the place of the text as it is written."""
    strings = CONTROL.finditer(text)

    def next_string(wanted: str | None) -> re.Match:
        found = next(strings, None)
        if found is None or (wanted is not None and found[0] != wanted):
            raise FormatError(f"{wanted} wanted, {found and found[0]} found")
        return found

    done = 0
    while done < len(text):
        first = next_string(None)
        if first.start() != done:
            raise FormatError(f"text outside of a turn at {done}")
        if first[0] == ROLE_OPEN:
            middle = next_string(ROLE_END)
            a, b = _body(text, first.end(), middle.start())
            role, start, close = unescape(text[a:b]), middle.end(), ROLE_CLOSE
        elif first[0] in _OPENED:
            (role, close), start = _OPENED[first[0]], first.end()
        else:
            raise FormatError(f"{first[0]} does not open a turn")
        last = next_string(close)
        a, b = _body(text, start, last.start())
        yield role, unescape(text[a:b]), a, b
        done = last.end()


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn as it is written, and the place of its text therein."""
    if role in FRAMES:
        start, close = f"{FRAMES[role][0]} ", FRAMES[role][1]
    else:
        start, close = f"{ROLE_OPEN} {role} {ROLE_END} ", ROLE_CLOSE
    return f"{start}{text} {close}", len(start), len(start) + len(text)


def _comes_back(written: str, role: str, text: str) -> bool:
    try:
        return [(r, t) for r, t, _, _ in parse(written)] == [(role, text)]
    except FormatError:
        return False


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn, escaped only if it would not be read back as it is."""
    for shown in ((role, text), (role, escape(text)), (escape(role), escape(text))):
        written = render(*shown)
        if _comes_back(written[0], role, text):
            return written
    raise FormatError(f"a turn of {role!r} is not read back")


def format_turns(turns: DataFrame) -> DataFrame:
    """One row per row of ``turns``: ``conv_id, turn, written, start, end``.

    ``written`` is the rendered turn, ``start`` and ``end`` (code points) the place
    of the text therein that is learned; both 0 where the role is not
    ``assistant``.  NULL texts and roles are read as empty.
    """
    schema = pa.schema(
        [("conv_id", pa.int64()), ("turn", pa.int64()), ("written", pa.string()), ("start", pa.int32()),
         ("end", pa.int32())]
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            written = []
            for role, text in zip(rows.column(2), rows.column(3)):
                name = role.as_py() or ""
                turn, start, end = render_turn(name, text.as_py() or "")
                written.append((turn, start, end) if name == LEARNED else (turn, 0, 0))
            yield batch(schema, [rows.column(0), rows.column(1), *(zip(*written) if written else ([], [], []))])

    return turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"),
        F.col("text").cast("string"),
    ).mapInArrow(write, "conv_id long, turn long, written string, start int, end int")


_FORMATTED = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("part", pa.int64()),
        ("formatted", pa.string()),
        ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ]
)


def format_conversations(turns: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """Conversations as text: ``conv_id, part, formatted, loss``.

    ``turns`` has conv_id, turn, role and text; other columns are not read.  A
    conversation is its turns by ``turn`` (NULL first, ties by their rendered
    text; repeated rows are turns of their own); rows without conv_id are one
    conversation.  ``loss`` holds the places (code points, end exclusive) whose
    text is learned, as it is written.  Beyond ``part_chars`` a conversation goes
    on in the next part, so that no row grows with the conversation; a turn is
    never cut.  Rows lie in order of ``conv_id`` and ``part``, all of a
    conversation in one partition.  No rows give no rows.

    Turns are rendered and read back before they are shuffled, each by itself.
    """
    chars = part_chars

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, part, pieces, length, loss = None, -1, [], 0, []
        for rows in batches:
            ready = []
            for conv, written, start, end in zip(
                rows.column(0).to_pylist(), rows.column(2).to_pylist(), rows.column(3).to_pylist(),
                rows.column(4).to_pylist(),
            ):
                if part < 0 or conv != key or length >= chars:
                    if part >= 0:
                        ready.append((key, part, "".join(pieces), loss))
                    part = part + 1 if part >= 0 and conv == key else 0
                    key, pieces, length, loss = conv, [], 0, []
                if end > start:
                    loss.append({"start": length + start, "end": length + end})
                pieces.append(written)
                length += len(written)
            if ready:
                yield batch(_FORMATTED, list(zip(*ready)))
        if part >= 0:
            yield batch(_FORMATTED, [[key], [part], ["".join(pieces)], [loss]])

    return (
        format_turns(turns)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "written")
        .mapInArrow(join, "conv_id long, part long, formatted string, loss array<struct<start:int,end:int>>")
    )


def read_back(formatted: DataFrame, arranged: bool = False) -> DataFrame:
    """What the parser finds in formatted conversations, one row each.

    ``conv_id, n_turns, turns_sha256`` (of role, newline, text, newline per turn),
    ``loss_chars, loss_sha256`` (of all text within ``loss``, unescaped) and
    ``formatted_chars``.  Text that is not of the grammar raises an error.  Parts
    of a conversation are read in order, and only one at a time is held in memory;
    their digest needs them one after the other.  With ``arranged`` the rows lie as
    :func:`format_conversations` leaves them and are not shuffled again.
    """
    schema = pa.schema(
        [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
         ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def result() -> tuple:
            return (key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        for rows in batches:
            ready = []
            for i in range(rows.num_rows):
                conv, text = rows.column(0)[i].as_py(), rows.column(2)[i].as_py()
                if state is None or conv != key:
                    if state is not None:
                        ready.append(result())
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said, _, _ in parse(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                for place in rows.column(3)[i].as_py() or ():
                    learned = unescape(text[place["start"] : place["end"]])
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                state[4] += len(text)
            if ready:
                yield batch(schema, list(zip(*ready)))
        if state is not None:
            yield batch(schema, [[v] for v in result()])

    rows = formatted.select("conv_id", "part", "formatted", "loss")
    if not arranged:
        rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return rows.mapInArrow(
        read,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
