"""Chat formatting that a parser has read back before it leaves.

A turn is rendered as

    ### role:
    text
    </turn>

and read by a deterministic parser.  A turn is first rendered as it is; where the
parser does not give back its role and text, the control string in the way is
escaped (a backslash before every occurrence), and the turn is parsed again, until
it comes back identical.  Unescaping takes the backslash right before a control
string, so a text's own backslashes, also those before control strings, come back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import arrow_type, chunks, columns, materialise, type_of

OPEN, CLOSE = "### ", "</turn>"
#: Roles whose texts a model learns to write.
LEARNT = ("assistant",)
#: Characters in a piece of output (one turn at least).
PIECE_CHARS = 1 << 20

_CONTROL = re.compile(f"{re.escape(CLOSE)}|{re.escape(OPEN)}")
_ESCAPED = re.compile(rf"\\({_CONTROL.pattern})")
_HEADER = re.compile(re.escape(OPEN) + r"((?:[^\\:\n]|\\.)*):\n")


class Unreadable(ValueError):
    """The text does not follow the grammar."""


# ---------------------------------------------------------------- grammar

def parse_turn(s: str, at: int = 0) -> tuple[str, str, int, int, int]:
    """(role, text, start and end of the text as rendered, place after the turn) of
    the turn that begins at ``at``: a header, then everything up to the first bare
    control string, which has to be a closing one in a line of its own."""
    head = _HEADER.match(s, at)
    if not head:
        raise Unreadable(f"no turn begins at {at}")
    start = head.end()
    for m in _CONTROL.finditer(s, start):
        if m.start() > start and s[m.start() - 1] == "\\":
            continue
        stop = m.start() - 1
        if m.group() != CLOSE or stop < start or s[stop] != "\n" or not s.startswith("\n", m.end()):
            raise Unreadable(f"a bare {m.group()!r} at {m.start()}")
        return _role(head.group(1)), unescape(s[start:stop]), start, stop, m.end() + 1
    raise Unreadable(f"the turn at {at} does not end")


def parse(s: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start and end of the text as rendered) of every turn."""
    at = 0
    while at < len(s):
        role, text, start, stop, at = parse_turn(s, at)
        yield role, text, start, stop


def unescape(s: str) -> str:
    return _ESCAPED.sub(r"\1", s) if "\\" in s else s


def _role(s: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m.group(1) == "n" else m.group(1), s) if "\\" in s else s


def _escaped_role(s: str) -> str:
    return s.replace("\\", "\\\\").replace("\n", "\\n").replace(":", "\\:")


# ---------------------------------------------------------------- rendering

def render_turn(role: str, text: str) -> tuple[str, int, int, int]:
    """(rendered turn, start and end of its text, number of parses) such that the
    parser gives back exactly this role and text and ends where the turn ends.
    Three parses at most fail: one for the role, one for either control string."""
    head, body, left, parses = role, text, [CLOSE, OPEN], 0
    while True:
        s = f"{OPEN}{head}:\n{body}\n{CLOSE}\n"
        parses += 1
        try:
            got, back, start, stop, end = parse_turn(s)
            if got == role and back == text and end == len(s):
                return s, start, stop, parses
        except Unreadable:
            got = None
        if head == role and head != _escaped_role(role) and got != role:
            head = _escaped_role(role)
            continue
        control = min((c for c in left if c in text), key=text.index)  # the first one in the way
        left.remove(control)
        body = body.replace(control, "\\" + control)


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """(conversation, number of the piece, whether it certainly is the whole
    conversation, formatted text, spans of learnt texts) from rows in order.  A
    partition may begin or end within a conversation: those two are never whole."""
    now, piece, first = None, 0, True
    out, spans, size = [], [], 0
    for batch, texts in chunks(batches):
        ids, roles = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for conv, role, text in zip(ids, roles, texts):
            changed = now is not None and conv != now[0]
            if changed or size >= PIECE_CHARS:
                yield now[0], piece, changed and not first and piece == 0, "".join(out), spans
                piece = 0 if changed else piece + 1
                first = first and not changed
                out, spans, size = [], [], 0
            now = (conv,)
            s, start, stop, _ = render_turn(role or "", text or "")
            if role in LEARNT:
                spans.append((size + start, size + stop))
            out.append(s)
            size += len(s)
    if now is not None:
        yield now[0], piece, False, "".join(out), spans


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_PIECE = [("part", pa.int32(), "int"), ("piece", pa.int32(), "int"), ("formatted", pa.string(), "string"),
          ("loss", _SPANS, "array<struct<start: bigint, end: bigint>>")]
_DIGEST = [("n_turns", pa.int64(), "bigint"), ("turns_sha256", pa.string(), "string"), ("loss_chars", pa.int64(), "bigint"),
           ("loss_sha256", pa.string(), "string"), ("formatted_chars", pa.int64(), "bigint")]


def _layout(rows: DataFrame, fields: list[tuple]) -> tuple[pa.Schema, str]:
    """Arrow schema and DDL of a conversation's id and further columns."""
    return (pa.schema([("conv_id", arrow_type(rows, "conv_id")), *((n, t) for n, t, _ in fields)]),
            f"conv_id {type_of(rows, 'conv_id')}, " + ", ".join(f"{n} {d}" for n, _, d in fields))


def _in_order(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows by conversation and turn over range partitions.  Ranges are cut within
    conversations, too, so one that holds a large share of all rows spreads over
    tasks; rows equal in all columns may stand in any order."""
    src = columns(conversations, conv_id=conv_id, turn=turn, role=role, text=text)
    by = ["conv_id", "turn", "role", "hash", "at"]
    return (src.withColumns({"hash": F.xxhash64("text"), "at": F.monotonically_increasing_id()})
            .repartitionByRange(*by).sortWithinPartitions(*by).select("conv_id", "role", "text"))


def format_conversations(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """(conv_id, part, piece, formatted, loss) of every conversation: its turns, by
    turn (nulls first; equal ones by role, then by the hash of the text), rendered
    so that ``parse`` gives them back.

    ``loss`` holds the spans (code points within the piece) of the texts a model
    learns to write.  A conversation is the concatenation of its pieces by (part,
    piece): most have one; one that goes on over a range partition's border, or
    beyond ``PIECE_CHARS``, has several.  Null roles and texts count as empty, a null
    conv_id is a conversation like any other; further columns are left out.
    """
    rows = _in_order(conversations, conv_id, turn, role, text)
    schema, ddl = _layout(rows, _PIECE)

    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        for conv, piece, _, formatted, spans in _slices(batches):
            yield pa.RecordBatch.from_pylist([_piece(conv, part, piece, formatted, spans)], schema=schema)

    return rows.mapInArrow(run, ddl)


def _piece(conv, part: int, piece: int, formatted: str, spans: list[tuple[int, int]]) -> dict:
    return {"conv_id": conv, "part": part, "piece": piece, "formatted": formatted,
            "loss": [{"start": a, "end": b} for a, b in spans]}


# ---------------------------------------------------------------- reading back

class Reader:
    """What the parser and the loss mask give for a conversation, piece by piece."""

    def __init__(self) -> None:
        self.turns = self.loss_chars = self.chars = 0
        self.turn_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def read(self, formatted: str, spans: Iterable[tuple[int, int]]) -> None:
        self.chars += len(formatted)
        for role, text, _, _ in parse(formatted):
            self.turns += 1
            self.turn_hash.update(f"{role}\n{text}\n".encode())
        for start, stop in spans:
            text = unescape(formatted[start:stop])
            self.loss_chars += len(text)
            self.loss_hash.update(text.encode())

    def result(self, conv) -> dict:
        return {"conv_id": conv, "n_turns": self.turns, "turns_sha256": self.turn_hash.hexdigest(),
                "loss_chars": self.loss_chars, "loss_sha256": self.loss_hash.hexdigest(), "formatted_chars": self.chars}


def read_back(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
              text: str = "text") -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of
    every conversation, all read from its formatted text and loss mask.

    A conversation that a task holds whole is formatted and read in one go; pieces
    of the others (the first and last one of a range partition, long ones) are
    written to the shared folder and read in order, a piece at a time: a hash of a
    whole conversation is sequential, but nothing larger than a piece is held.
    """
    rows = _in_order(conversations, conv_id, turn, role, text)
    schema, ddl = _layout(rows, _PIECE + _DIGEST)
    digest, digest_ddl = _layout(rows, _DIGEST)

    def walk(batches):
        from pyspark import TaskContext
        part, out = TaskContext.get().partitionId(), []
        for conv, piece, whole, formatted, spans in _slices(batches):
            if whole:
                reader = Reader()
                reader.read(formatted, spans)
                out.append(reader.result(conv))
            else:
                out.append(_piece(conv, part, piece, formatted, spans))
            if len(out) >= 1000 or not whole:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    def join(batches):
        now, reader = None, Reader()
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if now is None or now[0] != r["conv_id"]:
                    if now is not None:
                        yield pa.RecordBatch.from_pylist([reader.result(now[0])], schema=digest)
                    now, reader = (r["conv_id"],), Reader()
                reader.read(r["formatted"], [(s["start"], s["end"]) for s in r["loss"]])
        if now is not None:
            yield pa.RecordBatch.from_pylist([reader.result(now[0])], schema=digest)

    walked = materialise(rows.mapInArrow(walk, ddl), "chat")
    pieces = walked.where("part IS NOT NULL").select("conv_id", *(n for n, _, _ in _PIECE))
    joined = (pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece").mapInArrow(join, digest_ddl))
    return walked.where("part IS NULL").select(digest.names).unionByName(joined)
