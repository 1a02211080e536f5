"""Chat formatting with a grammar round trip.

A turn is written as an opening mark, the text and a closing mark:

    system     <<SYS>>text<</SYS>>
    user       [INST]text[/INST]
    assistant  <s>text</s>
    any other  [ROLE]role[/ROLE]text</s>

Marks inside a text would be read as marks. A text is first written as it is and
read back by a deterministic parser; where the turn that comes back isn't the turn
that went in, the marks inside it are escaped (a backslash after the mark's first
character, one more where there are some already) and it is read again, until both
are identical. Texts without conflicts are left as they are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import BOOL, LONG, STRING, arrow_schema, map_rows, schema, slices, stored, whole_text
from panelcast.session import ship_package

MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER, OTHER_MID, OTHER_END = "[ROLE]", "[/ROLE]", "</s>"
CONTROL = sorted({m for pair in MARKS.values() for m in pair} | {OTHER, OTHER_MID}, key=len, reverse=True)
LOSS_ROLE = "assistant"
MAX_ROUNDS = 4

_FIRST = {m[0] for m in CONTROL}
_ESCAPABLE = re.compile("|".join(re.escape(m[0]) + r"(\\*)" + re.escape(m[1:]) for m in CONTROL))
_ESCAPED = re.compile("|".join("(?:" + re.escape(m[0]) + r"\\+" + re.escape(m[1:]) + ")" for m in CONTROL))
_MARK = re.compile("|".join(map(re.escape, CONTROL)))


def escape(text: str) -> str:
    return _ESCAPABLE.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


def write_turn(role: str, text: str) -> str:
    if role in MARKS:
        return MARKS[role][0] + text + MARKS[role][1]
    return OTHER + role + OTHER_MID + text + OTHER_END


class GrammarError(ValueError):
    pass


def parse(rendered: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start, end of the text's span) of each turn, left to right; one
    mark decides what follows, so a text has one reading or none."""
    at, opens = 0, {m[0]: role for role, m in MARKS.items()}
    while at < len(rendered):
        mark = _MARK.match(rendered, at)
        if mark is None or (mark[0] not in opens and mark[0] != OTHER):
            raise GrammarError(f"no turn begins at {at}")
        start, role = mark.end(), opens.get(mark[0])
        if role is None:
            mid = _MARK.search(rendered, start)
            if mid is None or mid[0] != OTHER_MID:
                raise GrammarError(f"role not closed at {start}")
            role, start, close = unescape(rendered[start:mid.start()]), mid.end(), OTHER_END
            if role in MARKS:
                raise GrammarError(f"{role} has marks of its own")
        else:
            close = MARKS[role][1]
        end = _MARK.search(rendered, start)
        if end is None or end[0] != close:
            raise GrammarError(f"turn not closed at {start}")
        yield role, unescape(rendered[start:end.start()]), start, end.start()
        at = end.end()


def render_turn(role: str, text: str) -> tuple[str, int]:
    """The written turn and how often it had to be escaped."""
    role_w, text_w = role, text
    for rounds in range(MAX_ROUNDS):
        rendered = write_turn(role_w, text_w)
        try:
            back = [(r, t) for r, t, _, _ in parse(rendered)]
        except GrammarError:
            back = []
        if back == [(role, text)]:
            return rendered, rounds
        if len(back) != 1 or back[0][1] != text:
            text_w = escape(text) if text_w == text else text_w
        if role not in MARKS and (len(back) != 1 or back[0][0] != role):
            role_w = escape(role)
    raise GrammarError("the turn can't be written")


def format_turns(turns: DataFrame) -> DataFrame:
    """Rows of a conversation table -> conv_id, turn, role, rendered, rounds.

    Null roles and texts are empty. Every row is one turn; repeated rows stay. No
    shuffle: a turn is rendered by itself, and rendered turns of a conversation,
    put one after the other by turn, role and rendered text (null turns first),
    are the formatted conversation. Other columns are ignored.
    """
    src = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), whole_text().alias("text"))

    def make():
        def step(batch):
            return [(c, t, role, *render_turn(role, text)) for c, t, role, text in zip(*batch.values())]
        return step

    return map_rows(src, schema(conv_id=LONG, turn=LONG, role=STRING, rendered=STRING, rounds=LONG), make)


def write_conversations(turns: DataFrame) -> DataFrame:
    """Formatted conversations as a stored table, dealt by ranges of (conv_id, turn)
    so that one very long conversation is spread as well; read back."""
    done = format_turns(turns)
    return stored(done.repartitionByRange("conv_id", "turn", "role", F.xxhash64("rendered"))
                  .sortWithinPartitions("conv_id", "turn", "role", "rendered"), "conversations")


def read_turns(written: DataFrame) -> DataFrame:
    """Parse the stored text again: conv_id, turn, role, text, loss (is it under the loss mask)."""
    src = written.select("conv_id", "turn", "rendered")

    def make():
        return lambda batch: [(c, t, role, text, role == LOSS_ROLE) for c, t, line in zip(*batch.values())
                              for role, text, _, _ in parse(line)]

    return map_rows(src, schema(conv_id=LONG, turn=LONG, role=STRING, text=STRING, loss=BOOL), make)


def digests(written: DataFrame) -> DataFrame:
    """One row for each conversation, all from the stored text: n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars. A conversation is read as a stream of
    sorted turns, never held as a whole. Rows without conv_id are one conversation."""
    ship_package(written.sparkSession)
    out = schema(conv_id=LONG, n_turns=LONG, turns_sha256=STRING, loss_chars=LONG, loss_sha256=STRING, formatted_chars=LONG)
    src = (written.select("conv_id", "turn", "role", "rendered").repartition("conv_id")
           .sortWithinPartitions("conv_id", "turn", "role", "rendered").select("conv_id", "rendered"))

    def run(batches):
        arrow, now, rows = arrow_schema(out), None, []

        def close():
            n, said, chars, loss, size = now[1:]
            rows.append((now[0], n, said.hexdigest(), chars, loss.hexdigest(), size))

        def table():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow.types)], schema=arrow)

        for batch in batches:
            for piece in slices(batch):
                for conv, line in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    if now is None or now[0] != conv:
                        if now is not None:
                            close()
                        now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                    for role, text, _, _ in parse(line):
                        now[1] += 1
                        now[2].update(f"{role}\n{text}\n".encode())
                        if role == LOSS_ROLE:
                            now[3] += len(text)
                            now[4].update(text.encode())
                    now[5] += len(line)
                if rows:
                    yield table()
                    rows.clear()
        if now is not None:
            close()
            yield table()

    return src.mapInArrow(run, out)
