"""Secret scans: fixed patterns plus a token-efficiency test.

Ordinary text costs a byte-level vocabulary few tokens per character; random
strings (keys, tokens) cost many.  Unbroken runs whose characters-per-token ratio
is low (the shorter, the lower) are reported, except digests, UUIDs, times, paths
and plain identifiers.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import chunks, columns, held, id_column, type_of

# The base patterns and their least lengths, in the order of kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ["assign", "access", "hex", "random"]
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Runs of these characters (padding only at the end), from the least length of the
#: base patterns on, face the token-efficiency test.
LEAST_RUN = 12
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % LEAST_RUN)
#: At most so many characters per token count as random; runs of fewer than
#: ``SURE`` characters must cost more, by ``STEP`` for every character they lack.
RATIO, SURE, STEP = 2.2, 20, 0.05
# Bytes of the digests of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
DIGEST_BYTES = {"md5": 16, "sha1": 20, "sha224": 28, "sha256": 32, "sha384": 48, "sha512": 64}
DIGEST = re.compile(r"[0-9a-f]+|[0-9A-F]+")
ALGORITHM = r"(?i:(md5|sha-?(?:1|224|256|384|512)))"
NAMED = re.compile(ALGORITHM + r"[-_/]([A-Za-z0-9+/_-]+={0,2})")
NAMED_BEFORE = re.compile(r"(?<![A-Za-z0-9])" + ALGORITHM + r"[:=(]?[\x20\"']?$")
UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
TIME = re.compile(r"[0-9]{4}-?[0-9]{2}-?[0-9]{2}[T_-]?[0-9]{0,6}Z?")
#: Pieces of an identifier: words, capitals, numbers; and a word of some length.
PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
SEPARATOR = re.compile(r"[-+/_=]+")
WORD = re.compile(r"(?<![A-Za-z0-9])(?:[A-Za-z][a-z]{3,}|[A-Z]{4,})(?![A-Za-z0-9])")

_HEX_BYTE = np.zeros(256, dtype=bool)
_HEX_BYTE[list(b"0123456789abcdef")] = True
_RUN_BYTE = np.zeros(256, dtype=bool)
_RUN_BYTE[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")] = True


def vocabulary(path: str):
    """A tiktoken vocabulary, read once per worker process."""
    import public_tokenizers
    import tiktoken

    def read():
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        return tiktoken.Encoding("secrets", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    return held(("tiktoken", path), read)


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def named_digest(name: str, value: str) -> bool:
    """Whether ``value`` is as long as the named algorithm's digest in hex or base64."""
    size = DIGEST_BYTES[name.lower().replace("-", "")]
    bare = value.rstrip("=")
    return (len(value) == 2 * size and DIGEST.fullmatch(value) is not None) or (
        len(bare) == -(-8 * size // 6) and len(value) - len(bare) in (0, -size % 3))


def plain(part: str) -> bool:
    """A part of an identifier or path: short, or of few words and numbers."""
    return len(part) <= 3 or len(part) / len(PIECE.findall(part)) >= 2.5


def known(run: str, before: str = "") -> bool:
    """Digests of usual lengths or after the name of their algorithm (in the run or
    ``before`` it), UUIDs, times, and identifiers: runs without both letters and
    digits (or mixed case inside a word), of few readable pieces, or paths and
    compounds of which every part is plain."""
    if run.isalpha() and (run.islower() or run.isupper() or run.istitle()):
        return True
    if (len(run) in {2 * n for n in DIGEST_BYTES.values()} and DIGEST.fullmatch(run)) or UUID.fullmatch(run):
        return True
    named = NAMED.fullmatch(run)
    if named and named_digest(*named.groups()):
        return True
    named = NAMED_BEFORE.search(before)
    if (named and named_digest(named.group(1), run)) or TIME.fullmatch(run):
        return True
    letters = re.sub(r"[^A-Za-z]", "", run)
    if not letters:
        return True
    if not any(c.isdigit() for c in run) and (letters.islower() or letters.isupper() or letters.istitle()):
        return True
    if len(run) / len(PIECE.findall(run)) >= 5:
        return True
    parts = [p for p in SEPARATOR.split(run) if p]
    return len(parts) > 1 and all(map(plain, parts))


def core(run: str) -> tuple[int, int]:
    """The part of a run that faces the test: of a path, what lies between the plain
    segments at both ends, if these hold a word (random strings may hold a slash)."""
    if "/" not in run or NAMED.fullmatch(run):
        return 0, len(run)
    ends, at = [], 0
    for segment in run.split("/"):
        ends.append((at, at + len(segment)))
        at += len(segment) + 1
    odd = [i for i, (a, b) in enumerate(ends) if not all(plain(p) for p in SEPARATOR.split(run[a:b]))]
    if not odd:
        return 0, len(run)
    a, b = ends[odd[0]][0], ends[odd[-1]][1]
    if known(run[a:b]):
        return a, b
    return (a if WORD.search(run[:a]) else 0), (b if WORD.search(run[b:]) else len(run))


def is_random(run: str, encoding, ratio: float = RATIO) -> bool:
    limit = ratio - STEP * max(0, SURE - len(run))
    return not known(run) and len(run) <= limit * len(encoding.encode_ordinary(run))


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same places as spans apart from each other, by start."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def scan(text: str, encoding, ratio: float = RATIO, long_hex: bool = True,
         long_run: bool = True) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the secret itself) by start, then kind.  The
    flags say whether runs long enough for the hex and random kinds occur.  A run
    that base spans cover entirely is not tested; others may overlap with some."""
    found = []
    lower = text.lower()
    if any(k in lower for k in KEYWORDS):
        found += [("assign", m.start(), m.end(), m.start(2)) for m in ASSIGN.finditer(text)
                  if len(m.group(2)) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), m.start()) for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= LEAST["access"]]
    if long_hex:
        found += [("hex", m.start(), m.end(), m.start()) for m in HEX.finditer(text)
                  if m.end() - m.start() >= LEAST["hex"]]
    if long_run:
        base = joined([(a, b) for _, a, b, _ in found])
        starts = [a for a, _ in base]
        for m in CANDIDATE.finditer(text):
            if known(m.group(), text[max(0, m.start() - 10):m.start()]):
                continue
            low, high = core(m.group())
            a, b = m.start() + low, m.start() + high
            i = bisect_right(starts, a) - 1
            if b - a >= LEAST_RUN and not (i >= 0 and b <= base[i][1]) and is_random(text[a:b], encoding, ratio):
                found.append(("random", a, b, a))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _long_runs(texts: list[str], table: np.ndarray, least: int) -> np.ndarray:
    """Which texts hold a run of at least ``least`` bytes of the table's kind."""
    sizes = np.fromiter((len(t) if t.isascii() else len(t.encode()) for t in texts), dtype=np.int64, count=len(texts))
    flat = np.frombuffer(("\n".join(texts) + "\n").encode(), dtype=np.uint8)
    stops = np.flatnonzero(~table[flat])
    runs = np.flatnonzero(np.diff(stops, prepend=-1) > least)
    out = np.zeros(len(texts), dtype=bool)
    out[np.searchsorted(np.cumsum(sizes + 1), stops[runs] - 1, side="right")] = True
    return out


def scan_batch(texts: list[str], encoding, ratio: float = RATIO) -> list[list[tuple[str, int, int, int]]]:
    hexes = _long_runs(texts, _HEX_BYTE, LEAST["hex"])
    runs = _long_runs(texts, _RUN_BYTE, LEAST_RUN)
    return [scan(t, encoding, ratio, h, r) for t, h, r in zip(texts, hexes.tolist(), runs.tolist())]


def find_secrets(docs: DataFrame, path: str | None = None, ratio: float = RATIO,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans) of every row's whole text; a span is (kind, start, end,
    secret), code points with the end exclusive, ``secret`` the matched value.

    A null text counts as empty and has no spans; every row, repeated or with a
    null id, is scanned on its own; further columns are ignored.
    """
    src = columns(docs, doc_id=doc_id, text=text)
    path = path or vocabulary_path()

    def run(batches):
        encoding = vocabulary(path)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                   ("secret", pa.string())]))
        for piece, texts in chunks(batches):
            texts = [t or "" for t in texts]
            spans = [[{"kind": k, "start": a, "end": b, "secret": t[v:b]} for k, a, b, v in found]
                     for t, found in zip(texts, scan_batch(texts, encoding, ratio))]
            yield pa.RecordBatch.from_arrays([id_column(piece), pa.array(spans, type=kind)], names=["doc_id", "spans"])

    return src.mapInArrow(run, f"doc_id {type_of(src, 'doc_id')}, "
                               "spans array<struct<kind: string, start: bigint, end: bigint, secret: string>>")


def span_digests(found: DataFrame) -> DataFrame:
    """Counts, the digest of the base spans and the list of all spans."""
    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, path: str | None = None, ratio: float = RATIO, mark: str = "[SECRET]",
           text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with every secret's value replaced by ``mark`` (and ``n_chars``
    brought up to date where a text changed); other rows and columns stay."""
    path = path or vocabulary_path()
    names = docs.columns
    at = names.index(text)

    def clean(t, found):
        out, last = [], 0
        for a, b in sorted((v, b) for _, _, b, v in found):
            if a >= last:
                out += [t[last:a], mark]
            last = max(last, b)
        return "".join([*out, t[last:]])

    def run(batches):
        encoding = vocabulary(path)
        for piece, texts in chunks(batches, text):
            full = [t or "" for t in texts]
            new = [clean(t, f) if f else o for o, t, f in zip(texts, full, scan_batch(full, encoding, ratio))]
            cols = piece.columns
            if n_chars in names:
                c = names.index(n_chars)
                cols[c] = pa.array([len(n) if n != o else k for n, o, k in zip(new, texts, cols[c].to_pylist())],
                                   type=cols[c].type)
            cols[at] = pa.array(new, type=cols[at].type)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.mapInArrow(run, docs.schema)
