"""Chat formatting: conversations through a compiled template, with a loss mask, and back.

A turn reads `### role: text</turn>` and a new line. Inside roles and texts a backslash stands before every backslash and
control string (and before a colon in a role), so any text comes back as it was.

Turns are dealt by conversation, sorted, and streamed: a row of output holds about `PART` characters, so a conversation
of any length needs memory for one turn only. A digest of a whole conversation is sequential by nature and is made by
one task, which keeps nothing but the running hashes.

Defined results: null texts and roles are empty; rows of a conversation go by turn (null first), then role and text;
repeated rows are turns of their own; a null conversation id is a conversation; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.llm.common import bounded_batches
from voxlake.llm.template import Template, compile_template

TURNS = """\
{% for m in messages %}### {{ m.role | guard_role }}: \
{% if m.role == 'assistant' %}{% generation %}{{ m.text | guard }}{% endgeneration %}{% else %}{{ m.text | guard }}{% endif %}</turn>
{% endfor %}"""
END = "</turn>\n"
#: Characters of formatted text in one row of output.
PART = 1 << 16

_GUARD, _GUARD_ROLE = re.compile(r"\\|###|</turn>"), re.compile(r"\\|###|</turn>|:")
_TURN = re.compile(r"### ((?:[^\\:]++|\\.)*+): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.S)
_BACK = re.compile(r"\\(.)", re.S)


def guard(text: str | None) -> str:
    return _GUARD.sub(lambda m: "\\" + m[0], text or "")


def guard_role(role: str | None) -> str:
    return _GUARD_ROLE.sub(lambda m: "\\" + m[0], role or "")


def unguard(text: str) -> str:
    return _BACK.sub(r"\1", text) if "\\" in text else text


def chat_template(source: str = TURNS) -> Template:
    return compile_template(source, {"guard": guard, "guard_role": guard_role})


def parts(pieces: Iterable[tuple[str, bool]], limit: int = PART) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Pieces as strings of about `limit` characters, with the (start, length) spans of generated text in each."""
    held, spans, size = [], [], 0
    for text, generated in pieces:
        if generated:
            if spans and spans[-1][0] + spans[-1][1] == size:
                spans[-1] = (spans[-1][0], spans[-1][1] + len(text))
            else:
                spans.append((size, len(text)))
        held.append(text)
        size += len(text)
        if size >= limit:
            yield "".join(held), spans
            held, spans, size = [], [], 0
    if held:
        yield "".join(held), spans


def format_conversations(turns: DataFrame, template: str = TURNS, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, part, text, mask): each conversation's formatted text in parts, sorted within partitions.

    mask holds the spans (start, length) of generated text in the part, in code points.
    """
    bounded_batches(turns.sparkSession)
    rows = (
        turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
        .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    )

    def formatted(batches):
        made = chat_template(template)
        each = ((c, {"role": r or "", "text": t or ""}) for b in batches for c, r, t in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True))
        out, size = [], 0
        for conv, messages in groupby(each, lambda x: x[0]):
            for n, (text, spans) in enumerate(parts(made.render({"messages": (m for _, m in messages)}))):
                out.append((conv, n, text, [{"start": a, "length": k} for a, k in spans]))
                size += len(text)
                if size >= 1 << 20:
                    yield _batch(out)
                    out, size = [], 0
        yield _batch(out)

    return rows.mapInArrow(formatted, "conv_id long, part long, text string, mask array<struct<start:long,length:long>>")


def _batch(rows: list) -> pa.RecordBatch:
    conv, n, text, mask = zip(*rows, strict=True) if rows else ([], [], [], [])
    spans = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
    return pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(n, pa.int64()), pa.array(text, pa.string()), pa.array(mask, spans)], names=["conv_id", "part", "text", "mask"])


class Reader:
    """Turns of one formatted conversation, from its parts: feed(text, spans) gives (role, text, masked text) of whole turns."""

    def __init__(self):
        self.buffer, self.base, self.size, self.spans = "", 0, 0, []

    def feed(self, text: str, spans: Iterable[tuple[int, int]]) -> Iterator[tuple[str, str, str]]:
        for a, n in spans:
            self.spans.append((self.size + a, self.size + a + n))
        self.size += len(text)
        self.buffer += text
        at = 0
        while m := _TURN.match(self.buffer, at):
            begin, end = self.base + m.start(), self.base + m.end()
            masked = []
            while self.spans and self.spans[0][0] < end:
                a, b = self.spans[0]
                masked.append(self.buffer[max(a, begin) - self.base : min(b, end) - self.base])
                if b > end:
                    self.spans[0] = (end, b)
                    break
                self.spans.pop(0)
            yield unguard(m[1]), unguard(m[2]), unguard("".join(masked))
            at = m.end()
        self.buffer, self.base = self.buffer[at:], self.base + at

    def close(self) -> None:
        if self.buffer:
            raise ValueError(f"no turn at {self.buffer[:40]!r}")


def read_conversations(formatted: DataFrame, *, ordered: bool = False) -> DataFrame:
    """One row for each conversation, read from its formatted parts: turns and masked text are counted and hashed.

    `ordered`: formatted comes straight from format_conversations, dealt and sorted already.
    """
    if not ordered:
        formatted = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part")

    def read(batches):
        each = (x for b in batches for x in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True))
        out = []
        for conv, rows in groupby(each, lambda x: x[0]):
            reader, turns, loss, n, chars = Reader(), hashlib.sha256(), hashlib.sha256(), 0, 0
            for _, text, mask in rows:
                for role, said, masked in reader.feed(text, ((s["start"], s["length"]) for s in mask)):
                    turns.update(f"{role}\n{said}\n".encode())
                    loss.update(masked.encode())
                    n, chars = n + 1, chars + len(masked)
            reader.close()
            out.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), reader.size))
            if len(out) == 4096:
                yield _digests(out)
                out = []
        yield _digests(out)

    return formatted.mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _digests(rows: list) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * 6
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
