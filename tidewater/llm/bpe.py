"""Byte-level BPE encoding and decoding by speculate and verify.

Greedy longest match proposes the tokens of every distinct word of a chunk at
once; a vectorised test then checks every adjacent pair of proposed tokens.  A
token sequence is what BPE would produce exactly when each of its tokens encodes
to itself and no adjacent pair would have merged across its boundary, so words
that pass are done and only failing words are merged step by step.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidewater.llm.common import chunks, columns, held, id_column, type_of

# Fixed value: the byte-level pre-tokenizer's pattern.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Code points that the regex module counts as letters or numbers,
# but the tokenizers library's older Unicode tables do not.
UNASSIGNED = (
    "\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1"
    "\uab6c-\uab6d\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee"
    "\U00011b0a\U00011db0-\U00011ddb\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f"
    "\U00012550-\U00012686\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6"
    "\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20\U00018d80-\U00018df2"
    "\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6"
    "\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff"
    "\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed"
    "\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead"
    "\U000323b0-\U00033479\U0003d000-\U0003fc3f")
ODD = re.compile(f"[{UNASSIGNED}]")
# The pattern for texts that have such code points: letters and numbers without them.
ODD_WORD = (WORD.replace(r"\p{L}+", f"[\\p{{L}}--[{UNASSIGNED}]]+").replace(r"\p{N}+", f"[\\p{{N}}--[{UNASSIGNED}]]+")
            .replace(r"[^\s\p{L}\p{N}]+", f"(?:[^\\s\\p{{L}}\\p{{N}}]|[{UNASSIGNED}])+"))
NONE = int(np.iinfo(np.int64).max)
#: Words longer than this leave the lockstep and are merged exactly on their own.
LONG_WORD = 512
#: Up to this many bytes exact merging scans all pairs; beyond, it keeps a heap.
SHORT_WORD = 64
#: Failing words a worker remembers before it starts anew.
REMEMBERED = 100_000


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1
    bytes stand for themselves, the others for code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    out.update({chr(256 + i): b for i, b in enumerate(rest)})
    return out


class ByteBPE:
    """Vocabulary and merges of a ``tokenizers`` JSON file (byte-level BPE,
    no normalizer, no post-processor).

    Internally tokens are numbered by merge order: bytes first, then the result
    of merge i as 256 + i.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        model = spec["model"]
        vocab = model["vocab"]
        merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        names = [""] * 256
        for letter, b in letters.items():
            names[b] = letter
        order = {n: i for i, n in enumerate(names)}
        left, right = list(range(256)), list(range(256))
        for a, b in merges:
            order.setdefault(a + b, len(left))
            names.append(a + b)
            left.append(order[a])
            right.append(order[b])
        self.left, self.right = np.array(left), np.array(right)
        self.n = len(names)
        self.ids = np.array([vocab[n] for n in names], dtype=np.uint32)
        self.bytes = [bytes(letters[c] for c in n) for n in names]
        self.merge = {}
        for t in range(256, self.n):
            self.merge.setdefault((left[t], right[t]), t)
        keys = np.array([a * self.n + b for a, b in self.merge], dtype=np.int64)
        by = np.argsort(keys)
        self.pair_keys = keys[by]
        self.pair_token = np.array(list(self.merge.values()), dtype=np.int64)[by]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.split_added = (regex.compile("|".join(regex.escape(c) for c in sorted(self.added, key=len, reverse=True)))
                            if self.added else None)
        self.word, self.odd_word = regex.compile(WORD), regex.compile(ODD_WORD, regex.V1)
        self.byte_of_id = {int(i): b for i, b in zip(self.ids, self.bytes)}
        self.byte_of_id.update({i: bytes(letters[x] for x in c) if all(x in letters for x in c) else c.encode()
                                for c, i in self.added.items()})
        self._trie()
        self.whole = self._whole_tokens()
        self.remembered: dict[bytes, np.ndarray] = {}

    def _trie(self) -> None:
        """The vocabulary as a trie whose edges (node, byte) sit in a hash table with
        open addressing; node 0 is the root."""
        child: dict[int, int] = {}
        token = [-1]
        for t, b in enumerate(self.bytes):
            node = 0
            for x in b:
                nxt = child.get(node << 8 | x)
                if nxt is None:
                    nxt = child[node << 8 | x] = len(token)
                    token.append(-1)
                node = nxt
            if token[node] < 0:
                token[node] = t
        self.node_token = np.array(token, dtype=np.int32)
        keys = np.fromiter(child, dtype=np.int32, count=len(child))
        values = np.fromiter(child.values(), dtype=np.int32, count=len(child))
        self.shift = 32 - max(10, (4 * len(child)).bit_length())
        self.edge = np.full(1 << (32 - self.shift), -1, dtype=np.int32)
        self.child = np.zeros(len(self.edge), dtype=np.int32)
        slot = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.edge[slot] < 0)
            _, first = np.unique(slot[free], return_index=True)  # one newcomer a slot
            put = free[first]
            self.edge[slot[put]], self.child[slot[put]] = keys[put], values[put]
            rest = np.ones(len(keys), dtype=bool)
            rest[put] = False
            keys, values, slot = keys[rest], values[rest], (slot[rest] + 1) & (len(self.edge) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(self.shift)).astype(np.int32)

    def _step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The child of each node by its byte, 0 if there is none."""
        key = node << 8 | byte
        slot = self._slot(key)
        edge = self.edge[slot]
        out = np.where(edge == key, self.child[slot], 0)
        open_ = np.flatnonzero((edge != key) & (edge >= 0))  # the slot is another edge's
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.edge) - 1)
            edge = self.edge[slot[open_]]
            hit = edge == key[open_]
            out[open_[hit]] = self.child[slot[open_[hit]]]
            open_ = open_[~hit & (edge >= 0)]
        return out

    def _merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.n + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_token[at], NONE)

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """For each pair, whether BPE leaves the boundary between the tokens open.

        Merges are undone latest first on whichever side of the boundary was
        built later; at every step the two tokens that touch the boundary must
        not have a merge of their own that comes before the one just undone.
        Of equal merges the left one goes first.
        """
        a, b = a.astype(np.int64), b.astype(np.int64)
        limit = np.full(len(a), NONE) if limit is None else limit.astype(np.int64)
        ok = np.ones(len(a), dtype=bool)
        at = np.arange(len(a))
        while len(at):
            bad = self._merged(a, b) < limit
            ok[at[bad]] = False
            go = ~bad & (np.maximum(a, b) >= 256)
            at, a, b = at[go], a[go], b[go]
            on_left = a > b
            limit = np.where(on_left, a, b + 1)
            a, b = np.where(on_left, self.right[a], a), np.where(on_left, b, self.left[b])
        return ok

    def _whole_tokens(self) -> np.ndarray:
        """Which tokens BPE makes of their own bytes."""
        t = np.arange(256, self.n)
        own = np.ones(self.n, dtype=bool)
        own[t] = self.compatible(self.left[t], self.right[t], t)
        first = self._merged(self.left[t], self.right[t]) == t
        own[t] &= first
        for _ in range(64):  # a token is whole only if its parts are
            new = own.copy()
            new[t] &= own[self.left[t]] & own[self.right[t]]
            if (new == own).all():
                break
            own = new
        return own

    def merge_word(self, word: bytes) -> np.ndarray:
        """Exact merging: lowest merge first, leftmost of equal ones.  Short words
        by repeated scans, long ones with a heap in O(n log n)."""
        tok = list(word)
        n = len(tok)
        if n <= SHORT_WORD:
            get = self.merge.get
            ranks = [get(p, NONE) for p in zip(tok, tok[1:])]
            while ranks and (m := min(ranks)) != NONE:
                i = ranks.index(m)
                tok[i:i + 2] = [m]
                del ranks[i]
                if i < len(ranks):
                    ranks[i] = get((m, tok[i + 1]), NONE)
                if i:
                    ranks[i - 1] = get((tok[i - 1], m), NONE)
            return np.array(tok, dtype=np.int32)
        nxt, prev = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m, i, tok[i], tok[i + 1]) for i in range(n - 1)
                if (m := self.merge.get((tok[i], tok[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            m, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if tok[i] != a or j >= n or tok[j] != b:
                continue
            tok[i], tok[j] = m, -1
            nxt[i] = k = nxt[j]
            if k < n:
                prev[k] = i
                if (x := self.merge.get((m, tok[k]))) is not None:
                    heapq.heappush(heap, (x, i, m, tok[k]))
            if (h := prev[i]) >= 0 and (x := self.merge.get((tok[h], m))) is not None:
                heapq.heappush(heap, (x, h, tok[h], m))
        return np.array([t for t in tok if t >= 0], dtype=np.int32)

    def _propose(self, flat: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match of all words in lockstep; (word, token) in word order."""
        word, pos = np.flatnonzero(end > start), start[end > start].copy()
        stop = end[word]
        node = np.zeros(len(word), dtype=np.int32)
        best, best_end = np.full(len(word), -1, dtype=np.int32), pos.copy()
        out_w, out_t = [], []
        while len(word):
            byte = flat[np.minimum(pos, len(flat) - 1)]
            step = self._step(node, byte.astype(np.int32))
            step[pos >= stop] = 0
            on = step > 0
            pos = pos + on
            node = np.where(on, step, 0)
            token = self.node_token[node]
            hit = on & (token >= 0)
            best, best_end = np.where(hit, token, best), np.where(hit, pos, best_end)
            if not on.all():
                off = np.flatnonzero(~on)
                out_w.append(word[off])
                out_t.append(best[off])
                pos[off] = best_end[off]
                best[off] = -1
                live = on | (pos < stop)
                if not live.all():
                    word, pos, stop, node, best, best_end = (x[live] for x in (word, pos, stop, node, best, best_end))
        if not out_w:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)
        w, t = np.concatenate(out_w), np.concatenate(out_t)
        by = np.argsort(w, kind="stable")
        return w[by], t[by]

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
        """Tokens of distinct words, flat, and each word's count; and how many
        words had to be merged exactly."""
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        flat = np.frombuffer(b"".join(words) or b"\0", dtype=np.uint8)
        end = np.cumsum(size)
        long = size > LONG_WORD
        w, t = self._propose(flat, end - size, np.where(long, end - size, end))
        fails = long.copy()
        fails[w[~self.whole[t]]] = True
        near = np.flatnonzero(w[1:] == w[:-1]) if len(w) else np.zeros(0, dtype=np.int64)
        pair, back = np.unique(t[near].astype(np.int64) * self.n + t[near + 1], return_inverse=True)
        good = self.compatible(pair // self.n, pair % self.n)
        fails[w[near[~good[back]]]] = True
        failing = np.flatnonzero(fails)
        if not len(failing):
            return t, np.bincount(w, minlength=len(words)), 0
        if len(self.remembered) > REMEMBERED:
            self.remembered.clear()
        exact = []
        for i in failing:
            got = self.remembered.get(words[i])
            if got is None:
                got = self.merge_word(words[i])
                if len(words[i]) <= LONG_WORD:
                    self.remembered[words[i]] = got
            exact.append(got)
        keep = ~fails[w]
        w = np.concatenate([w[keep], np.repeat(failing, [len(x) for x in exact])])
        t = np.concatenate([t[keep], *exact])
        by = np.argsort(w, kind="stable")
        return t[by], np.bincount(w, minlength=len(words)), len(failing)

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; added tokens in a text become their own ids."""
        words: list[str] = []
        ends = []
        for text in texts:
            odd = not text.isascii() and ODD.search(text)
            find = (self.odd_word if odd else self.word).findall
            if self.split_added is None or not any(c in text for c in self.added):
                words += find(text)
            else:
                at = 0
                for m in self.split_added.finditer(text):
                    words += find(text[at:m.start()])
                    words.append(("", m.group()))
                    at = m.end()
                words += find(text[at:])
            ends.append(len(words))
        number = dict.fromkeys(words)
        distinct = list(number)
        number.update(zip(distinct, range(len(distinct))))
        code = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))
        plain = [w.encode() if isinstance(w, str) else b"" for w in distinct]
        t, count, _ = self.encode_words(plain)
        ids = self.ids[t]
        for i, w in enumerate(distinct):
            if not isinstance(w, str):
                ids = np.insert(ids, int(count[:i].sum()), self.added[w[1]])
                count[i] = 1
        first = np.cumsum(count) - count
        n = count[code]
        stop = np.cumsum(n)
        flat = ids[np.repeat(first[code] - (stop - n), n) + np.arange(stop[-1] if len(stop) else 0)]
        cuts = [0, *(int(stop[e - 1]) if e else 0 for e in ends)]
        return [flat[a:b] for a, b in zip(cuts, cuts[1:])]

    def decode(self, ids) -> str:
        """Text of ids, added tokens included; broken UTF-8 becomes U+FFFD."""
        return b"".join(map(self.byte_of_id.__getitem__, ids)).decode("utf-8", errors="replace")


def load(path: str) -> ByteBPE:
    """The vocabulary, read once per worker process."""
    return held(("bpe", path), lambda: ByteBPE(path))


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def encode(docs: DataFrame, path: str | None = None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of every row, the ids of its whole text and the text
    that the ids decode to (ids, decoded).

    A null text counts as empty and has no ids; rows with a null or repeated id
    are encoded each on their own; further columns are ignored; no rows in, no
    rows out.  Memory per task: the longest text plus one chunk.
    """
    src = columns(docs, **{c: c for c in keep}, _text=text)
    path = path or vocabulary_path()

    def run(batches):
        bpe = load(path)
        for piece, texts in chunks(batches, "_text"):
            ids = bpe.encode_batch([t or "" for t in texts])
            yield pa.RecordBatch.from_arrays(
                [*piece.columns[:-1], pa.array([x.astype(np.int32) for x in ids], type=pa.list_(pa.int32())),
                 pa.array([bpe.decode(x.tolist()) for x in ids], type=pa.string())], names=[*keep, "ids", "decoded"])

    types = ", ".join(f"`{c}` {type_of(src, c)}" for c in keep)
    return src.mapInArrow(run, f"{types}, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, path: str | None = None, doc_id: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): ``encode`` with its lists
    and texts reduced to digests inside the task, so that they are never shipped."""
    src = columns(docs, doc_id=doc_id, text=text)
    path = path or vocabulary_path()

    def run(batches):
        bpe = load(path)
        for piece, texts in chunks(batches):
            ids = bpe.encode_batch([t or "" for t in texts])
            yield pa.RecordBatch.from_arrays(
                [id_column(piece),
                 pa.array([len(x) for x in ids], type=pa.int64()),
                 pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], type=pa.string()),
                 pa.array([hashlib.sha256(bpe.decode(x.tolist()).encode()).hexdigest() for x in ids],
                          type=pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return src.mapInArrow(run, f"doc_id {type_of(src, 'doc_id')}, n_tokens bigint, ids_sha256 string, "
                               "decoded_sha256 string")
