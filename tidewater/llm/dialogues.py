"""Conversation structure repair by a run-length dynamic program.

A repaired conversation's role initials follow ``(s?(ua)+)?``.  Read from the left
that grammar has four states: begun, after a system row, after a user row, after an
assistant row.  A row's role initial and fault make a symbol; a symbol is a 4x4
min-plus matrix: the least cost of getting from one state before the row to another
one after it, rows inserted before it included.  Equal symbols in a row are a run,
and a run of n rows advances by the binary powers of its matrix, which are computed
once and kept.  Walking back over the runs gives the cost still to come at every
place; walking forward picks, among the edits that keep to the least cost, the one
whose letter comes first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import arrow_type, columns, materialise, type_of

DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
STATES = 4
#: State reached by keeping a system, user or assistant row (none: not allowed).
STEPS = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
#: State reached by a row of the role that is due: a user, or an assistant after a user.
DUE = (2, 2, 3, 2)
ACCEPTED = (0, 3)
FAR = 1 << 50  # no way; sums of two stay within 64 bits

#: Symbols: 0 for a row that has to go (blank or duplicate), else 1 + 2 * place of its
#: role initial (- stands for every other one) + 1 if its text is truncated.
GONE = 0
INITIALS = "sua-"


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product of a matrix with a matrix, or with rows of vectors."""
    return np.minimum((a[:, :, None] + b[None]).min(axis=1), FAR)


def _insertions() -> np.ndarray:
    """Least cost from state to state by inserted rows alone."""
    out = np.full((STATES, STATES), FAR, dtype=np.int64)
    for q in range(STATES):
        at, cost = q, 0
        while out[q, at] == FAR:
            out[q, at] = cost
            at, cost = DUE[at], cost + INSERT
    return out


INSERTED = _insertions()
#: Cost to come from each state when no row is left.
END = np.array([min(INSERTED[q, e] for e in ACCEPTED) for q in range(STATES)], dtype=np.int64)


@lru_cache(maxsize=None)
def _edits(sym: int, state: int) -> tuple[tuple[str, int, int], ...]:
    """(letter, cost, next state) of the edits of a row, by letter."""
    out = [("D", DELETE, state)]
    if sym != GONE:
        initial, extra = INITIALS[(sym - 1) // 2], TRUNCATED * ((sym - 1) % 2)
        kept = STEPS.get(initial, (None,) * STATES)[state]
        if kept is not None:
            out.append(("K", extra, kept))
        out.append(("R", REROLE + extra, DUE[state]))
    return tuple(out)


@lru_cache(maxsize=None)
def power(sym: int, exponent: int) -> np.ndarray:
    """Matrix of a run of ``2 ** exponent`` rows of one symbol."""
    if exponent:
        half = power(sym, exponent - 1)
        return _times(half, half)
    row = np.full((STATES, STATES), FAR, dtype=np.int64)
    for q in range(STATES):
        for _, cost, to in _edits(sym, q):
            row[q, to] = min(row[q, to], cost)
    return _times(INSERTED, row)


def advance(sym: int, length: int, to_come: np.ndarray) -> np.ndarray:
    """Cost to come before a run, from the cost (a vector, or rows of a matrix) after it."""
    out = to_come if to_come.ndim == 2 else to_come[:, None]
    for bit in range(length.bit_length()):
        if length >> bit & 1:
            out = _times(power(sym, bit), out)
    return out.reshape(to_come.shape)


def within(sym: int, length: int, to_come: np.ndarray) -> np.ndarray:
    """(states, length + 1): cost to come with 0, 1, ... rows of the run left; every
    step doubles how many are known."""
    out = to_come[:, None]
    bit = 0
    while out.shape[1] <= length:
        out = np.hstack([out, _times(power(sym, bit), out[:, :length + 1 - out.shape[1]])])
        bit += 1
    return out


def matrix(runs: list[tuple[int, int]]) -> np.ndarray:
    """Least costs from state to state over runs of (symbol, length)."""
    out = np.where(np.eye(STATES, dtype=bool), 0, FAR).astype(np.int64)
    for sym, length in reversed(runs):
        out = advance(sym, length, out)
    return out


def unroll(runs: list[tuple[int, int]], to_come: np.ndarray = END, state: int = 0, last: bool = True) -> tuple[str, int, int]:
    """(audit, cost, state reached): the letters of the cheapest edits in order, the
    least by ASCII where several cost the same.  ``to_come`` is the cost after the
    runs; rows are inserted at their end only where nothing follows (``last``)."""
    after = [to_come]
    for sym, length in reversed(runs):
        after.append(advance(sym, length, after[-1]))
    after.reverse()
    letters, total = [], 0
    for (sym, length), end in zip(runs, after[1:]):
        left = within(sym, length, end).T.tolist()
        rows = length
        while rows:
            now = left[rows][state]
            for letter, cost, to in _edits(sym, state):
                if letter > "I" and INSERT + left[rows][DUE[state]] == now:
                    letter, cost, to = "I", INSERT, DUE[state]
                if cost + left[rows - (letter != "I")][to] == now:
                    break
            letters.append(letter)
            total += cost
            state = to
            rows -= letter != "I"
    while last and state not in ACCEPTED:
        letters.append("I")
        total += INSERT
        state = DUE[state]
    return "".join(letters), total, state


# ---------------------------------------------------------------- rows

#: Characters that do not count as text (fixed: those of the contract), and ends of sentences.
SPACE = " \t\n\x0b\x0c\r"
STOPS = (".", "!", "?")
#: Neighbours that may stand next to each other.
LEGAL = ("su", "ua", "au")


def damage(conversations: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text), damaged by the checksum of their place:
    dropped, emptied, without ends of sentences, repeated, or with the role user.
    Nulls in the checksummed text, the role and the text count as one space."""
    kind = F.crc32(F.concat(*(F.coalesce(c, F.lit(" ")) for c in (F.col("conv_id").cast("string"), F.lit(":"),
                                                                  F.col("turn").cast("string"))))) % 20
    text = F.coalesce("text", F.lit(" "))
    return (conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), kind.alias("kind"))
            .where("kind != 0")
            .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", "".join(STOPS), ""))
                    .otherwise(F.col("text")).alias("text"),
                    F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
            .drop("copy"))


def _rows(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Every row with two hashes of role and text that stand for both, its role's
    initial, whether it is blank, and its symbol as the first of its kind."""
    src = columns(conversations, conv_id=conv_id, turn=turn, role=role, text=text).withColumns(
        {"role": F.coalesce("role", F.lit(" ")), "text": F.coalesce("text", F.lit(" "))})
    body = F.rtrim(F.col("text"), F.lit(SPACE))
    place = F.position(F.substring("role", 1, 1), F.lit(INITIALS[:3]))
    kind = F.when(F.length("role") == 0, 0).otherwise(place)
    return src.select("conv_id", "turn", "role", "text", F.xxhash64("role", "text").alias("k1"),
                      F.xxhash64("text", F.lit("/"), "role").alias("k2"), F.substring("role", 1, 1).alias("initial"),
                      (body == "").alias("blank"),
                      F.when(body == "", GONE).otherwise(
                          1 + 2 * F.when(kind == 0, 3).otherwise(kind - 1)
                          + F.when(F.right(body, F.lit(1)).isin(*STOPS), 0).otherwise(1)).cast("int").alias("symbol"))


def _sequence(rows: DataFrame) -> DataFrame:
    """One row per (conversation, turn, role, text), without the text: how many rows
    it stands for, and whether its first one is the first of that role and text.
    Equal rows are counted before anything is shuffled, and a text's least turn is an
    aggregate joined back, so neither a conversation nor a text becomes one group."""
    groups = rows.groupBy("conv_id", "turn", "k1", "k2", "initial", "blank", "symbol").agg(F.count(F.lit(1)).alias("n"))
    least = (groups.groupBy(F.col("conv_id").alias("c"), F.col("k1").alias("j1"), F.col("k2").alias("j2"))
             .agg(F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("early"), F.count(F.lit(1)).alias("turns"))
             .where("turns > 1").drop("turns"))
    first = F.when(F.col("j1").isNull(), True).when(F.col("early"), F.col("turn").isNull()).otherwise(
        F.col("turn").eqNullSafe(F.col("least")))
    return (groups.join(least, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("k1") == F.col("j1")) & (F.col("k2") == F.col("j2")), "left")
            .select("conv_id", "turn", "k1", "k2", "initial", "blank", "symbol", "n", first.alias("first")))


class Piece:
    """Rows of one conversation, in order, as far as one task holds them."""

    def __init__(self, conv) -> None:
        self.conv = conv
        self.runs: list[tuple[int, int]] = []  # symbols and how often they stand in a row
        self.k1: list[int] = []
        self.k2: list[int] = []
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.begin = self.end = None

    def add(self, k1: int, k2: int, initial: str, blank: bool, sym: int, n: int, first: bool) -> None:
        sym = sym if first else GONE
        self.blank += n if blank else 0
        self.duplicate += 0 if blank else n - first
        self.truncated += sym != GONE and (sym - 1) % 2
        self.illegal += n - 1 + (self.end is not None and self.end + initial not in LEGAL)
        self.begin = initial if self.begin is None else self.begin
        self.end = initial
        if sym != GONE:
            self.k1.append(k1)
            self.k2.append(k2)
            self._run(sym, 1)
            n -= 1
        self._run(GONE, n)

    def _run(self, sym: int, n: int) -> None:
        if n and self.runs and self.runs[-1][0] == sym:
            self.runs[-1] = (sym, self.runs[-1][1] + n)
        elif n:
            self.runs.append((sym, n))

    def solve(self, part: int, to_come: np.ndarray = END, state: int = 0, last: bool = True) -> Iterator[dict]:
        """The piece's audit and counts, then its repaired rows."""
        audit, cost, _ = unroll(self.runs, to_come, state, last)
        yield {**self.counts(part), "audit": audit, "cost": cost}
        kept = iter(zip(self.k1, self.k2))
        symbols = iter([sym for sym, n in self.runs for _ in range(n)] if len(self.k1) else [])
        for at, letter in enumerate(audit):
            row = {"conv_id": self.conv, "part": part, "at": at}
            sym = next(symbols, GONE) if letter != "I" else None
            if letter == "I":
                yield {**row, "role": "assistant" if state == 2 else "user"}
                state = DUE[state]
                continue
            keys = next(kept) if sym != GONE else None
            if letter == "D":
                continue
            yield {**row, "k1": keys[0], "k2": keys[1], "role": ("assistant" if state == 2 else "user") if letter == "R" else None}
            state = DUE[state] if letter == "R" else STEPS[INITIALS[(sym - 1) // 2]][state]

    def counts(self, part: int) -> dict:
        return {"conv_id": self.conv, "part": part, "at": -1, "blank": self.blank, "duplicate": self.duplicate,
                "truncated": self.truncated, "illegal": self.illegal, "begin": self.begin, "end": self.end}

    def open(self, part: int, slot: int) -> dict:
        return {**self.counts(part), "slot": slot, "symbols": [s for s, _ in self.runs], "lengths": [n for _, n in self.runs],
                "keys1": self.k1, "keys2": self.k2, "costs": matrix(self.runs).ravel().tolist()}

    @classmethod
    def opened(cls, r: dict) -> Piece:
        out = cls(r["conv_id"])
        out.runs, out.k1, out.k2 = list(zip(r["symbols"], r["lengths"])), r["keys1"], r["keys2"]
        for name in ("blank", "duplicate", "truncated", "illegal", "begin", "end"):
            setattr(out, name, r[name])
        return out


_LONG, _INT, _TEXT = (pa.int64(), "bigint"), (pa.int32(), "int"), (pa.string(), "string")
_LONGS, _INTS = (pa.list_(pa.int64()), "array<bigint>"), (pa.list_(pa.int32()), "array<int>")
_FIELDS = {"part": _INT, "at": _LONG, "k1": _LONG, "k2": _LONG, "role": _TEXT, "audit": _TEXT, "cost": _LONG, "blank": _LONG,
           "duplicate": _LONG, "truncated": _LONG, "illegal": _LONG, "begin": _TEXT, "end": _TEXT, "slot": _INT,
           "symbols": _INTS, "lengths": _LONGS, "keys1": _LONGS, "keys2": _LONGS, "costs": _LONGS}


def _layout(df: DataFrame, fields: dict) -> tuple[pa.Schema, str]:
    return (pa.schema([("conv_id", arrow_type(df, "conv_id")), *((n, t) for n, (t, _) in fields.items())]),
            f"conv_id {type_of(df, 'conv_id')}, " + ", ".join(f"`{n}` {d}" for n, (_, d) in fields.items()))


def _batches(rows: Iterable[dict], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for r in rows:
        held.append(r)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    yield pa.RecordBatch.from_pylist(held, schema=schema)


def edits(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
          text: str = "text") -> DataFrame:
    """The cheapest repair of every conversation, without texts: rows with ``at`` -1
    hold audit, cost and counts of a piece of a conversation, the others its repaired
    rows (hashes of role and text, or an inserted row without), in order of
    (part, at).  See ``summary`` for what counts.

    Rows without texts are sorted over range partitions that are cut within
    conversations, too.  A conversation within one partition is solved there.  Of one
    that goes on over borders each task gives the matrix of its piece; the matrices
    (at most two a partition) give each piece the cost that comes after it, then the
    state it begins in, and the pieces are unrolled in parallel.
    """
    rows = _rows(conversations, conv_id, turn, role, text)
    by = ["conv_id", "turn", "k1", "k2"]
    ordered = _sequence(rows).repartitionByRange(*by).sortWithinPartitions(*by).drop("turn")
    schema, ddl = _layout(rows, _FIELDS)

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[Piece]:
        piece = None
        for batch in batches:
            for conv, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if piece is None or piece.conv != conv:
                    if piece is not None:
                        yield piece
                    piece = Piece(conv)
                piece.add(*row)
        if piece is not None:
            yield piece

    def walk(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()

        def rows_of():
            held, first = None, True
            for piece in pieces(batches):
                if held is not None:
                    yield from [held.open(part, 0)] if first else held.solve(part)
                    first = False
                held = piece
            if held is not None:
                yield held.open(part, 1)

        yield from _batches(rows_of(), schema)

    walked = materialise(ordered.mapInArrow(walk, ddl), "dialogues")
    open_ = walked.where("slot IS NOT NULL")

    def backwards(pdf):
        """Cost to come after every piece of a conversation."""
        pdf = pdf.sort_values("part").reset_index(drop=True)
        after, to_come = [None] * len(pdf), END
        for i in range(len(pdf) - 1, -1, -1):
            after[i] = to_come
            to_come = _times(np.asarray(pdf["costs"][i]).reshape(STATES, STATES), to_come[:, None])[:, 0]
        return pdf[["part", "slot"]].assign(after=after, last=[i == len(pdf) - 1 for i in range(len(pdf))])

    def ends(batches):
        out = pa.schema([("conv_id", schema.field(0).type), ("part", pa.int32()), ("slot", pa.int32()), ("ends", pa.list_(pa.int32()))])
        for batch in batches:
            for r in batch.to_pylist():
                runs, after = list(zip(r["symbols"], r["lengths"])), np.array(r["after"])
                yield pa.RecordBatch.from_pylist([{**{c: r[c] for c in out.names[:3]}, "ends": [
                    unroll(runs, after, q, r["last"])[2] for q in range(STATES)]}], schema=out)

    def forwards(pdf):
        """The state every piece of a conversation begins in."""
        pdf = pdf.sort_values("part").reset_index(drop=True)
        states, state = [], 0
        for reached in pdf["ends"]:
            states.append(state)
            state = int(reached[state])
        return pdf[["part", "slot"]].assign(state=states)

    def finish(batches):
        for batch in batches:
            for r in batch.to_pylist():
                yield from _batches(Piece.opened(r).solve(r["part"], np.array(r["after"]), r["state"], r["last"]), schema)

    after = materialise(open_.select("conv_id", "part", "slot", "costs").groupBy("conv_id")
                        .applyInPandas(backwards, "part int, slot int, after array<bigint>, last boolean"), "dialogues-after")
    begun = (open_.select("conv_id", "part", "slot", "symbols", "lengths").join(after, ["part", "slot"])
             .select("conv_id", "part", "slot", "symbols", "lengths", "after", "last")
             .mapInArrow(ends, f"conv_id {type_of(rows, 'conv_id')}, part int, slot int, ends array<int>")
             .groupBy("conv_id").applyInPandas(forwards, "part int, slot int, state int"))
    solved = open_.join(after, ["part", "slot"]).join(begun, ["part", "slot"]).mapInArrow(finish, ddl)
    return walked.where("slot IS NULL").unionByName(solved).drop("slot", "symbols", "lengths", "keys1", "keys2", "costs")


def repaired(conversations: DataFrame, found: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """(conv_id, part, at, role, text) of the repaired conversations' rows, in order of
    (part, at); ``found`` are their ``edits``.  Inserted rows have empty texts."""
    texts = (_rows(conversations, conv_id, turn, role, text).groupBy(F.col("conv_id").alias("c"), "k1", "k2")
             .agg(F.first("role").alias("was"), F.first("text").alias("text")))
    rows = found.where("at >= 0")
    kept = (rows.where("k1 IS NOT NULL").join(texts, ["k1", "k2"]).where(F.col("conv_id").eqNullSafe(F.col("c")))
            .select("conv_id", "part", "at", F.coalesce("role", "was").alias("role"), "text"))
    return kept.unionByName(rows.where("k1 IS NULL").select("conv_id", "part", "at", "role", F.lit("").alias("text")))


_SUMMARY = {"gaps": _LONG, "blank": _LONG, "duplicate": _LONG, "truncated": _LONG, "illegal": _LONG, "cost": _LONG, "audit": _TEXT,
            "repaired_sha256": _TEXT}


def summary(conversations: DataFrame, everyone: DataFrame | None = None, conv_id: str = "conv_id", turn: str = "turn",
            role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256) of every conversation (and of those named in ``everyone``'s first
    column, though they may have no rows: zeros, an empty audit and the hash of an empty text).

    Rows stand by turn, nulls first; rows of one turn by hashes of role and text.  A
    row's first fault counts: blank (no character but blanks), duplicate (role and
    text stood earlier), truncated (its last character that is no blank ends no
    sentence).  Blank and duplicate rows have to go.  The audit is the letters of the
    cheapest edits in order (Delete, Insert, Keep, Rerole), the least by ASCII where
    several cost the same.  A null or empty role's initial fits nowhere; null roles and
    texts count as one space, a null conv_id as a conversation; further columns are
    left out.

    Edits and repaired rows come from tasks over ranges.  Only the hash of a whole
    conversation is sequential: its rows stream through one task, in order, one at a time.
    """
    found = materialise(edits(conversations, conv_id, turn, role, text), "dialogue-edits")
    lines = repaired(conversations, found, conv_id, turn, role, text)
    src = columns(conversations, conv_id=conv_id, turn=turn)
    gaps = src.groupBy("conv_id").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0))
                                      .cast("bigint").alias("gaps"))
    names = ["part", "at", "role", "text", "audit", "cost", "blank", "duplicate", "truncated", "illegal", "begin", "end", "gaps"]
    stream = (found.where("at = -1").drop("k1", "k2", "role")
              .unionByName(lines, allowMissingColumns=True)
              .unionByName(gaps.withColumns({"part": F.lit(-1), "at": F.lit(-1).cast("bigint")}), allowMissingColumns=True))
    if everyone is not None:
        stream = stream.unionByName(everyone.select(F.col(everyone.columns[0]).alias("conv_id"), F.lit(-2).alias("part"),
                                                    F.lit(-1).cast("bigint").alias("at")).distinct(), allowMissingColumns=True)
    schema, ddl = _layout(src, _SUMMARY)

    def digest(batches):
        def results():
            now, total, audit, sha, end, lines_ = None, {}, [], None, None, 0
            for batch in batches:
                for conv, *row in zip(*(c.to_pylist() for c in batch.columns)):
                    r = dict(zip(names, row))
                    if now is None or now[0] != conv:
                        if now is not None:
                            yield {"conv_id": now[0], **total, "audit": "".join(audit), "repaired_sha256": sha.hexdigest()}
                        now, audit, sha, end, lines_ = (conv,), [], hashlib.sha256(), None, 0
                        total = dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0)
                    if r["at"] >= 0:
                        sha.update(f"{chr(10) if lines_ else ''}{r['role']}:{r['text']}".encode())
                        lines_ += 1
                        continue
                    for c in total:
                        total[c] += r[c] or 0
                    if r["part"] >= 0:
                        audit.append(r["audit"])
                        total["illegal"] += end is not None and end + r["begin"] not in LEGAL
                        end = r["end"]
            if now is not None:
                yield {"conv_id": now[0], **total, "audit": "".join(audit), "repaired_sha256": sha.hexdigest()}

        yield from _batches(results(), schema)

    return (stream.select("conv_id", *names).repartition("conv_id").sortWithinPartitions("conv_id", "part", "at")
            .mapInArrow(digest, ddl))
