"""Chat formatting with a grammar that reads back what was written.

    conversation = turn*
    turn         = "### " role ": " text "\\n</turn>\\n"
                 | "### %: " role "\\n" text "\\n</turn>\\n"        for a role of more than 64 characters as written

Roles are written without white space, colon, percent or backslash, so ``%`` alone is no role and a long role's line
holds no control string. Inside a turn, ``### name: `` and ``</turn>`` are control strings; after one or more backslashes they are text, with one
backslash less. Each turn is rendered as it is and parsed; what comes back different (control strings, or control
strings after backslashes, in its text) is rendered again with a backslash more before each, until it reads back
as the one turn it was. Everything else is left as written, so formatted text stays readable.

Turns are formatted one by one, so a conversation of any length needs no memory of its own; its formatted text
is the concatenation of its turns in order.
"""

import hashlib
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from zonepulse.llm.text import plain

END = "</turn>"
TRAINED = "assistant"       # the role under the loss mask
CONTROL = re.compile(r"(?<!\\)(\\*)(### [^\s:]{0,64}: |</turn>)")     # a run of backslashes is tried once, from its start
HEADER = re.compile(r"### ([^\s:]{0,64}): ")
ROLE_MOST = 64
LONG_ROLE = "%"
ROUNDS = 3


class FormatError(ValueError):
    """The text isn't one the formatter writes."""


def _role_out(role: str) -> str:
    """The role without white space, colon, percent or backslash."""
    return "".join(c if c.isalnum() or c in "-_." else f"%{ord(c):x};" for c in role)


def _role_in(name: str) -> str:
    return re.sub(r"%([0-9a-f]+);", lambda m: chr(int(m[1], 16)), name)


def render(role: str, text: str, escaped: bool) -> str:
    body = CONTROL.sub(lambda m: f"\\{m[0]}", text) if escaped else text
    name = _role_out(role)
    head = f"### {name}: " if len(name) <= ROLE_MOST else f"### {LONG_ROLE}: {name}\n"
    return f"{head}{body}\n{END}\n"


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, from, to) of each turn; the places are those of the text as formatted."""
    turns, at = [], 0
    while at < len(formatted):
        header = HEADER.match(formatted, at)
        if not header:
            raise FormatError(f"no turn begins at {at}")
        name, begin = header[1], header.end()
        if name == LONG_ROLE:
            line = formatted.find("\n", begin)
            if line < 0:
                raise FormatError(f"a long role does not end at {begin}")
            name, begin = formatted[begin:line], line + 1
        at, parts = begin, []
        for found in CONTROL.finditer(formatted, begin):
            parts.append(formatted[at:found.start()])
            at = found.end()
            if found[1]:
                parts.append(found[1][1:] + found[2])
            elif found[2] == END:
                end = found.start() - 1
                break
            else:
                raise FormatError(f"a turn begins inside a turn at {found.start()}")
        else:
            raise FormatError("the last turn does not end")
        if end < begin or formatted[end] != "\n" or formatted[at:at + 1] != "\n":
            raise FormatError(f"no lines end around the turn's end at {at}")
        at += 1
        turns.append((_role_in(name), "".join(parts)[:-1], begin, end))
    return turns


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """(formatted turn, from, to): the places of its text."""
    for attempt in range(ROUNDS):
        formatted = render(role, text, escaped=attempt > 0)
        try:
            turns = parse(formatted)
        except FormatError:
            continue
        if len(turns) == 1 and turns[0][:2] == (role, text):
            return formatted, turns[0][2], turns[0][3]
    raise FormatError(f"does not read back: {role!r} {text[:80]!r}")


def format_turns(df: DataFrame, role: str = "role", text: str = "text", trained: str = TRAINED) -> DataFrame:
    """``df`` without role and text, with ``formatted`` and the loss mask within it: ``loss_from``,
    ``loss_to`` (equal where the turn isn't trained on).

    A null text or role counts as empty; a role of any length and of any characters reads back. Repeated rows are turns of their own; an empty frame gives no rows.
    """

    @F.pandas_udf("formatted string, loss_from int, loss_to int")
    def run(roles: pd.Series, texts: pd.Series) -> pd.DataFrame:
        rows = []
        for r, t in zip(roles, texts):
            r = r or ""
            formatted, begin, end = format_turn(r, t or "")
            rows.append((formatted, begin, end if r == trained else begin))
        return pd.DataFrame(rows, columns=["formatted", "loss_from", "loss_to"])

    df = plain(df, "formatted", "loss_from", "loss_to")
    made = df.withColumn("_made", run(F.col(role), F.col(text)))
    return made.select(*(c for c in df.columns if c not in (role, text)), "_made.*")


def digests(formatted: DataFrame, conversation: str = "conv_id", order: tuple[str, ...] = ("turn",)) -> DataFrame:
    """What reading formatted turns back gives, one row per conversation.

    n_turns; turns_sha256 over role, new line, text, new line of each turn; loss_chars, loss_sha256 over the masked
    text, unescaped; formatted_chars. Turns are dealt out by conversation and sorted in it; a task passes over
    them once with running digests, so no conversation is ever held in memory. A digest is of all turns in
    order, so each conversation is read by one task. Null conversations are one conversation.
    """

    def run(batches):
        current, state = None, None

        def row():
            n, turns, chars, loss, length = state
            return current, n, turns.hexdigest(), chars, loss.hexdigest(), length

        for batch in batches:
            rows = []
            for key, piece, begin, end in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or key != current:
                    if state is not None:
                        rows.append(row())
                    current, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text, first, last in parse(piece):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    if end > begin:
                        masked = CONTROL.sub(lambda m: m[0][1:], piece[max(begin, first):min(end, last)])
                        state[2] += len(masked)
                        state[3].update(masked.encode())
                state[4] += len(piece)
            yield from frames(rows)
        if state is not None:
            yield from frames([row()])

    def frames(rows):
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[conversation, *columns])

    columns = {"n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint", "loss_sha256": "string",
               "formatted_chars": "bigint"}
    schema = T.StructType([T.StructField(conversation, formatted.schema[conversation].dataType),
                           *(T.StructField(c, T.LongType() if k == "bigint" else T.StringType()) for c, k in columns.items())])
    kinds = [*to_arrow_schema(schema).types]
    return (formatted.repartition(conversation).sortWithinPartitions(conversation, *order)
            .select(conversation, "formatted", "loss_from", "loss_to").mapInArrow(run, schema))
