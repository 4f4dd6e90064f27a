"""Chat formatting: conversations rendered through a compiled template, with a loss mask.

Turns are dealt to tasks by conversation and sorted; each task streams through its rows and hands the
turns to the compiled template as an iterator, so neither a conversation nor its output is held
whole: the output comes in parts of about ``part_chars``, cut between pieces of text, with the
positions of generated text. Reading back streams through the parts in the same way.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chat_template import compile_template

#: Role names as the template writes them; others are written after an @.
ROLES = {"system": "System", "user": "User", "assistant": "Assistant"}
TEMPLATE = (
    "{% for m in messages %}"
    "### {{ m.role | role }}: "
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}"
    "{{ '</turn>' + '\\n' }}"
    "{% endfor %}"
)
PART_CHARS = 1 << 20
_NAMES = {v: k for k, v in ROLES.items()}
_MARK = re.compile(r"[\\#<]")
_ROLE_MARK = re.compile(r"[\\#<:]")
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.)*)</turn>\n", re.S)


def escape(text: str) -> str:
    """Backslashes before the characters that control strings begin with; undone by ``unescape``."""
    return _MARK.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def role_name(role: str) -> str:
    return ROLES.get(role) or "@" + _ROLE_MARK.sub(r"\\\g<0>", role)


def role_of(name: str) -> str:
    return unescape(name[1:]) if name.startswith("@") else _NAMES[name]


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "role": role_name}


_LOSS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


class _Parts:
    """Gathers rendered pieces into parts, cut where a new message begins."""

    def __init__(self, part_chars: int):
        self.part_chars, self.number, self.at_message = part_chars, 0, False
        self.begin()

    def begin(self) -> None:
        self.pieces, self.loss, self.size = [], [], 0

    def messages(self, rows: Iterable[tuple]) -> Iterator[dict]:
        for _, role, text in rows:
            self.at_message = True
            yield {"role": role, "text": text}

    def done(self) -> tuple[int, str, list[dict]]:
        row = (self.number, "".join(self.pieces), self.loss)
        self.number += 1
        self.begin()
        return row

    def rows(self, pieces: Iterable[tuple[str, bool]]) -> Iterator[tuple[int, str, list[dict]]]:
        for text, generated in pieces:
            if self.at_message and self.size >= self.part_chars:
                yield self.done()
            self.at_message = False
            if generated and text:
                self.loss.append({"start": self.size, "end": self.size + len(text)})
            self.pieces.append(text)
            self.size += len(text)
        yield self.done()


def _batches(rows: Iterable[tuple], schema: pa.Schema, weight: Callable[[tuple], int], limit: int = 4 << 20
             ) -> Iterator[pa.RecordBatch]:
    """Arrow batches of rows, each ended once it weighs ``limit`` or has 10,000 rows."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row)
        if size >= limit or len(held) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def format_conversations(turns: DataFrame, template: str = TEMPLATE, id_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text", part_chars: int = PART_CHARS) -> DataFrame:
    """One row per part of a conversation's formatted text: id, ``part`` (from 0), ``formatted``, ``loss`` (array of
    (start, end), code points of the part, that the template generates).

    Turns are taken in order of turn, then role and text, nulls first; null roles and texts are
    empty; repeated turns are repeated; rows with a null id form one conversation. Most
    conversations have one part. An empty table gives no rows. The template may walk ``messages`` once.
    """
    own = turns.select(F.col(id_col).alias("id"), F.col(turn_col).alias("turn"),
                       F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ordered = own.repartition("id").sortWithinPartitions("id", "turn", "role", "text").select("id", "role", "text")
    compile_template(template, FILTERS)     # errors show here, not in a task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        render = compile_template(template, FILTERS)
        schema = pa.schema([("id", first.schema.field("id").type), ("part", pa.int32()), ("formatted", pa.string()), ("loss", _LOSS)])
        stream = (row for b in itertools.chain([first], batches)
                  for row in zip(*(b.column(c).to_pylist() for c in ("id", "role", "text"))))

        def parts():
            for ident, rows in itertools.groupby(stream, key=lambda r: r[0]):
                out = _Parts(part_chars)
                for row in out.rows(render({"messages": out.messages(rows)})):
                    yield ident, *row
        yield from _batches(parts(), schema, lambda r: len(r[2]))
    kind = own.schema["id"].dataType.simpleString()
    return (ordered.mapInArrow(run, f"id {kind}, part int, formatted string, loss array<struct<start:long,end:long>>")
            .withColumnRenamed("id", id_col))


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a part written with ``TEMPLATE``; raises on anything else."""
    at = 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}: {formatted[at:at + 40]!r}")
        yield role_of(m[1]), unescape(m[2])
        at = m.end()


def read_back(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Per conversation, from the formatted parts alone: id, ``n_turns``, ``turns_sha256`` (of role, newline, text,
    newline of every turn), ``loss_chars`` and ``loss_sha256`` (of the unescaped text under the mask),
    ``formatted_chars``."""
    own = formatted.withColumnRenamed(id_col, "id")
    ordered = own.repartition("id").sortWithinPartitions("id", "part").select("id", "formatted", "loss")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        schema = pa.schema([("id", first.schema.field("id").type), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                            ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        stream = (row for b in itertools.chain([first], batches)
                  for row in zip(*(b.column(c).to_pylist() for c in ("id", "formatted", "loss"))))

        def conversations():
            for ident, rows in itertools.groupby(stream, key=lambda r: r[0]):
                n, chars, learnt, turns, loss = 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                for _, text, spans in rows:
                    chars += len(text)
                    for role, said in read_turns(text):
                        n += 1
                        turns.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                    for s in spans:
                        said = unescape(text[s["start"]:s["end"]])
                        learnt += len(said)
                        loss.update(said.encode("utf-8", "surrogatepass"))
                yield ident, n, turns.hexdigest(), learnt, loss.hexdigest(), chars
        yield from _batches(conversations(), schema, lambda r: 1)
    kind = own.schema["id"].dataType.simpleString()
    return (ordered.mapInArrow(run, f"id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                    "formatted_chars long").withColumnRenamed("id", id_col))
