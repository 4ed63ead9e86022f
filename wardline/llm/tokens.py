"""Token counts by a compiled finite-state transducer (operator 3).

A byte-pair model of the public ``.model`` format is compiled into a
deterministic transducer over characters.  Reading a character moves to the
next state and emits how many tokens the encoding of the text so far gained
or lost.  A state holds, for each earlier position from which a piece may
still run on, the place in the trie of pieces, the last token before that
position and the token count relative to now.  The last token of every prefix
is the only one whose neighbour allows it (two neighbours allow each other
when encoding their join gives them back), so states are finite in number;
they are compiled when first reached and kept in the worker process.

At a *cut* (a blank mark after another character, or either side of a newline)
no piece crosses, so the state there is the start state.  The state map of a
chunk is thus (text before its first cut, tokens between first and last cut,
state at the end); maps compose associatively, and a text is counted by a
prefix scan over the maps of its chunks.  The map of a single word is one
number, kept in a bounded table.
"""

from __future__ import annotations

import re
import struct
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import small_batches, text_or_empty, values, worker_cache

MARK = "▁"  # stands for a blank
CHUNK = 1 << 16
MAX_STATES, MAX_WORDS = 250_000, 300_000


def _varint(b: bytes, i: int) -> tuple[int, int]:
    out = shift = 0
    while True:
        x = b[i]
        i += 1
        out |= (x & 127) << shift
        shift += 7
        if x < 128:
            return out, i


def _fields(b: bytes):
    """Field number and value of each entry of a protobuf message."""
    i = 0
    while i < len(b):
        key, i = _varint(b, i)
        kind = key & 7
        if kind == 0:
            value, i = _varint(b, i)
        else:
            n, i = (8, i) if kind == 1 else (4, i) if kind == 5 else _varint(b, i)
            value = b[i : i + n]
            i += n
        yield key >> 3, value


def read_pieces(model: bytes) -> dict[str, float]:
    """Pieces and scores; raises on a model whose rules are not built here."""
    pieces, spec = {}, {2: {}, 3: {}}
    for field, value in _fields(model):
        if field == 1:
            p = dict(_fields(value))
            kind = p.get(3, 1)
            if kind == 1:
                pieces[p[1].decode()] = struct.unpack("<f", p[2])[0]
            elif kind in (4, 5):
                raise ValueError("user-defined and unused pieces are not supported")
        elif field in spec:
            spec[field] = dict(_fields(value))
    trainer, normal = spec[2], spec[3]
    if trainer.get(3) != 2 or not trainer.get(35):
        raise ValueError("only byte-pair models with byte fallback are supported")
    if normal.get(1) != b"identity" or normal.get(4, 1) or not normal.get(3, 1) or not normal.get(5, 1) or trainer.get(24):
        raise ValueError("only identity normalisation with a leading blank is supported")
    return pieces


class State(dict):
    """Transitions by character: (next state, tokens gained)."""

    __slots__ = ("live", "owner")

    def __missing__(self, c):
        out = self[c] = self.owner.compile_step(self.live, c)
        return out


class Counts(dict):
    """Tokens of a word that follows a blank."""

    __slots__ = ("owner",)

    def __missing__(self, word):
        n = self.owner.count_unit(MARK + word)
        if len(word) <= 48:
            if len(self) >= MAX_WORDS:
                self.clear()
            self[word] = n
        return n


class Transducer:
    START = ((0, None, 0),)

    def __init__(self, model: bytes):
        self.score = read_pieces(model)
        self.kids: list[dict[str, int]] = [{}]
        self.token: list[str | None] = [None]
        self.inner = set()  # neighbours inside some piece
        for p in self.score:
            node = 0
            for c in p:
                nxt = self.kids[node].get(c)
                if nxt is None:
                    nxt = self.kids[node][c] = len(self.kids)
                    self.kids.append({})
                    self.token.append(None)
                node = nxt
            self.token[node] = p
            self.inner.update(p[i : i + 2] for i in range(len(p) - 1))
        if any(c not in self.score for pair in self.inner for c in pair):
            raise ValueError("a character occurs in pieces but is no piece itself")
        if any(x[1] == MARK and x[0] != MARK or "\n" in x for x in self.inner):
            raise ValueError("a piece runs over a blank or a newline")
        self.allowed: dict[tuple[str, str], bool] = {}
        self.states: dict[tuple, State] = {}
        self.words = Counts()
        self.words.owner = self

    # -- compilation ------------------------------------------------------
    def encode(self, text: str) -> list[str]:
        """Merge the best pair, leftmost of equals, until none is left."""
        parts = list(text)
        while True:
            best = None
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best[0]):
                    best = (s, i)
            if best is None:
                return parts
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def allows(self, a: str | None, b: str) -> bool:
        if a is None or a[-1] + b[0] not in self.inner:
            return True
        got = self.allowed.get((a, b))
        if got is None:
            if len(self.allowed) >= MAX_STATES:
                self.allowed.clear()
            got = self.allowed[a, b] = self.encode(a + b) == [a, b]
        return got

    def state(self, live: tuple) -> State:
        s = self.states.get(live)
        if s is None:
            s = State()
            s.live, s.owner = live, self
            self.states[live] = s
        return s

    def compile_step(self, live: tuple, c: str) -> tuple[State, int]:
        going, found = [], None
        for node, last, rel in live:
            if node == 0 and last is not None and last[-1] + c not in self.inner:
                last = None
            nxt = self.kids[node].get(c)
            if nxt is None:
                continue
            if self.kids[nxt]:
                going.append((nxt, last, rel))
            t = self.token[nxt]
            if found is None and t is not None and self.allows(last, t):
                found = (t, rel + 1)
        if found is None:  # a character without a piece: one token for each byte
            return self.state(self.START), len(c.encode())
        t, gain = found
        return self.state(tuple((n, p, r - gain) for n, p, r in going) + ((0, t, 0),)), gain

    # -- running ----------------------------------------------------------
    def run(self, live: tuple, text: str) -> tuple[tuple, int]:
        """State after ``text`` and the tokens gained on the way."""
        if len(self.states) > MAX_STATES:
            self.states.clear()
        s, n = self.state(live), 0
        for c in text:
            s, k = s[c]
            n += k
        return s.live, n

    def count_unit(self, unit: str) -> int:
        """Tokens of a text that starts at a cut."""
        if "\n" in unit:
            lines = unit.split("\n")
            return len(lines) - 1 + sum(self.run(self.START, x)[1] for x in lines if x)
        return self.run(self.START, unit)[1]

    def count_from_cut(self, text: str) -> int:
        """Tokens of a text that starts and ends at a cut: a sum over words."""
        if not text:
            return 0
        if text[0] == MARK and MARK * 2 not in text:
            return sum(map(self.words.__getitem__, text[1:].split(MARK)))
        return sum(map(self.count_unit, re.findall(f"{MARK}+[^{MARK}]*|[^{MARK}]+", text)))

    CUT = re.compile(f"(?<=[^{MARK}])(?={MARK})|(?<=\n)|(?=\n)")

    def chunk_map(self, text: str):
        """State map of a chunk: (head, None) without a cut, else (head, tokens
        up to the end, state at the end)."""
        first = self.CUT.search(text, 1, len(text)) if len(text) > 1 else None
        if first is None:
            return (text, None, None)
        head, rest = text[: first.start()], text[first.start() :]
        tail = len(rest)  # where the last unit starts
        for i in range(len(rest) - 1, -1, -1):
            if i == 0 or (rest[i] == MARK and rest[i - 1] != MARK) or "\n" in rest[i - 1 : i + 1]:
                tail = i
                break
        live, n = self.run(self.START, rest[tail:])
        return (head, self.count_from_cut(rest[:tail]) + n, live)

    def compose(self, a, b):
        if b[1] is None:
            if a[1] is None:
                return (a[0] + b[0], None, None)
            live, n = self.run(a[2], b[0])
            return (a[0], a[1] + n, live)
        if a[1] is None:
            return (a[0] + b[0], b[1], b[2])
        return (a[0], a[1] + self.run(a[2], b[0])[1] + b[1], b[2])

    def scan(self, chunks: list[str]) -> int:
        """Compose the maps of neighbouring chunks pairwise until one is left."""
        maps = deque(self.chunk_map(x) for x in chunks)
        while len(maps) > 1:
            pairs = [maps.popleft() for _ in range(len(maps))]
            maps.extend(self.compose(*pairs[i : i + 2]) if i + 1 < len(pairs) else pairs[i] for i in range(0, len(pairs), 2))
        head, n, _ = maps[0]
        return self.run(self.START, head)[1] + (n or 0)

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = MARK + text.replace(" ", MARK)
        if len(text) <= CHUNK:
            return self.count_from_cut(text)
        return self.scan([text[i : i + CHUNK] for i in range(0, len(text), CHUNK)])


def count_tokens(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096) -> DataFrame:
    """One row per input row: ``id, n_bytes, n_tokens, over_limit``.

    ``model`` is the tokenizer file's content (a fixed few hundred kB, sent as
    a broadcast).  A null or empty text has no bytes and no tokens; repeated
    rows are counted each; an empty table gives an empty result; columns other
    than the id and the text are not carried, so their names cannot clash.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    key = hash(model)

    @F.arrow_udf("long")
    def tokens(texts: pa.Array) -> pa.Array:
        cache = worker_cache()
        if cache.get("bpe_key") != key:
            cache["bpe_key"], cache["bpe"] = key, Transducer(sent.value)
        return pa.array(map(cache["bpe"].count, values(texts)), pa.int64())

    return (small_batches(docs).select(F.col(id_col), text_or_empty(text_col).alias("_text"))
            .select(id_col, F.octet_length("_text").cast("long").alias("n_bytes"), tokens("_text").alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))
