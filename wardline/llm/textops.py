"""Words and word hashes of many texts at once, on numpy arrays.

Texts are UTF-8 bytes joined by one blank; a word is a maximal run of bytes
that a 256-entry table marks as word bytes.  All bytes of a non-ASCII
character are above 0x7F, so classes given by ASCII ranges act on bytes just
as on characters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: words of ``[^\x20\x09-\x0D]+``
BLANK_WORDS = np.ones(256, bool)
BLANK_WORDS[[0x20, *range(0x09, 0x0E)]] = False

#: words of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z
FOLDED_WORDS = np.zeros(256, bool)
FOLDED_WORDS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 32

#: the same words by ``bytes.translate(FOLD_TABLE).split()``
FOLD_TABLE = bytes(int(FOLD[i]) if FOLDED_WORDS[FOLD[i]] else 32 for i in range(256))

_MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
_C1, _C2, _C3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over 64 bits."""
    h = (h ^ (h >> np.uint64(30))) * _C2
    h = (h ^ (h >> np.uint64(27))) * _C3
    return h ^ (h >> np.uint64(31))


def join_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes (a blank after each text, eight more at the end) and the
    start of each text plus the end of the last."""
    buf = np.frombuffer(b" ".join(texts) + b" " * 9, dtype=np.uint8)
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return buf, starts


def find_words(buf: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of each word."""
    w = np.zeros(len(buf) + 1, bool)
    w[1:] = is_word[buf]
    edge = np.flatnonzero(w[1:] != w[:-1])  # the buffer ends in a blank
    return edge[::2], edge[1::2]


def hash_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each word, eight bytes at a time."""
    eight = np.ndarray((max(len(buf) - 7, 0),), dtype="<u8", buffer=buf, strides=(1,))
    size = ends - starts
    h = mix(size.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
    at, left, live = starts, size, None
    while len(at):
        got = mix((h if live is None else h[live]) ^ (eight[at] & _MASK[np.minimum(left, 8)])) * _C1
        if live is None:
            h, more = got, left > 8
            live = np.flatnonzero(more)
        else:
            h[live] = got
            more = left > 8
            live = live[more]
        at, left = at[more] + 8, left[more] - 8
    return mix(h)


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive word hashes."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        c = np.uint64((0xD6E8FEB86659FD93 * (2 * i + 1) * (i + 7) | 1) & (2**64 - 1))
        out += h[i : i + n] * c
    return mix(out)


def slices(texts: pa.Array | pa.ChunkedArray, limit: int = 1 << 20):
    """Cut a batch into runs of texts of about ``limit`` bytes: (first, list of
    bytes).  Only one run at a time is copied out of the Arrow buffers."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64) + 1
    upto = np.cumsum(size)
    first = 0
    while first < len(size):
        done = upto[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(upto, done + limit, "right")))
        yield first, texts.slice(first, last - first).cast(pa.binary()).to_pylist()
        first = last


def word_runs(text: bytes, table: bytes, limit: int = 1 << 20):
    """Words of a text in lists of about ``limit`` bytes: ``table`` maps every
    byte to itself, to its folded form or, between words, to a blank."""
    if len(text) <= limit:
        yield text.translate(table).split()
        return
    folded, at = text.translate(table), 0
    while at < len(folded):
        end = at + limit
        if end < len(folded):
            cut = folded.rfind(b" ", at, end)
            if cut < 0:
                cut = folded.find(b" ", end)
            end = len(folded) if cut < 0 else cut
        yield folded[at:end].split()
        at = end + 1
