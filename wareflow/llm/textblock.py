"""Vectorised text helpers used inside tasks: byte views of Arrow string
columns, word and chunk boundaries, 64-bit hashes of slices, word n-grams.

Texts are handled as UTF-8 bytes. Every helper works on whole texts: a batch is
walked in pieces of about a megabyte that end at white space, so that the
temporary arrays stay small however long one text is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C55 | 1
_U = np.uint64

#: White space of the contracts: space and \t..\r.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: White space, control characters and ASCII punctuation.
MARKS = np.zeros(256, bool)
MARKS[[c for c in range(128) if not chr(c).isalnum()]] = True

_raw = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_low = _raw.copy()
_low[ord("A"):ord("Z") + 1] = _raw[ord("a"):ord("z") + 1]
_pow = np.ones(1, np.uint64)
_inv = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _inv
    if len(_pow) < n:
        size = 1 << (n - 1).bit_length()
        step = np.full(size, _BASE, np.uint64)
        back = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        step[0] = back[0] = 1
        _pow, _inv = np.multiply.accumulate(step), np.multiply.accumulate(back)
    return _pow[:n], _inv[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def unmix(h: np.ndarray) -> np.ndarray:
    """The inverse of :func:`mix`."""
    def unshift(x, k):
        out = x
        for _ in range(64 // k):
            out = x ^ (out >> _U(k))
        return out
    h = unshift(h, 31) * _U(pow(0x94D049BB133111EB, -1, 1 << 64))
    h = unshift(h, 27) * _U(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    return unshift(h, 30)


def text_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string or binary column; null reads as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_null(col.type):
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    if pa.types.is_string(col.type):
        col = col.cast(pa.binary())
    elif pa.types.is_large_string(col.type):
        col = col.cast(pa.large_binary())
    if col.null_count:
        col = pc.fill_null(col, b"")
    wide = pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1]
    offsets = offsets.astype(np.int64)
    if data is None or not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    out = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]
    return out, offsets - offsets[0]


def pieces(data: np.ndarray, offsets: np.ndarray, size: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Cuts of the batch at document ends or before white space, about ``size`` bytes each."""
    lo, n = 0, len(data)
    while lo < n:
        hi = min(n, lo + size)
        if hi < n:
            k = np.searchsorted(offsets, hi, "right") - 1
            if offsets[k] > lo:
                hi = int(offsets[k])          # a document's start
            else:                             # inside one long document
                at = hi
                while at < n:
                    run = np.flatnonzero(SPACE[data[at:at + size]] & ~SPACE[data[at - 1:at - 1 + len(data[at:at + size])]])
                    if len(run):
                        hi = at + int(run[0])
                        break
                    at += size
                else:
                    hi = n
                end = int(offsets[np.searchsorted(offsets, lo, "right")])
                hi = min(hi, end)
        yield lo, hi
        lo = hi


def _slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    power, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * power[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True, between: np.ndarray = SPACE):
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text (or what else ``between`` parts), A-Z lower-cased.

    Returns (hash, start, end, word_offsets); word_offsets[i]:[i+1] are the words of text i.
    """
    hs, ss, es = [], [], []
    for lo, hi in pieces(data, offsets):
        part = data[lo:hi]
        solid = ~between[part]
        edge = np.zeros(hi - lo + 1, bool)
        edge[offsets[(offsets >= lo) & (offsets <= hi)] - lo] = True
        edge[0] = edge[-1] = True
        s = np.flatnonzero(solid & (edge[:-1] | ~np.concatenate(([False], solid[:-1]))))
        e = np.flatnonzero(solid & (edge[1:] | ~np.concatenate((solid[1:], [False])))) + 1
        hs.append(_slice_hashes(part, s, e, _low if lower else _raw))
        ss.append(s + lo)
        es.append(e + lo)
    if not hs:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, np.zeros(len(offsets), np.int64)
    start = np.concatenate(ss)
    return np.concatenate(hs), start, np.concatenate(es), np.searchsorted(start, offsets).astype(np.int64)


def chunks(data: np.ndarray, offsets: np.ndarray, lo: int, hi: int):
    """Pre-token chunks of the piece [lo, hi): `` ?\\S+`` or a run of white space.

    A run before a word gives up its last character: a space joins the word,
    another white-space character stands alone. Byte-level BPE splits each
    chunk by itself, whatever stands around it. ASCII white space only: texts
    with other white space take another path. A piece that starts inside a text
    starts at white space, so that no chunk is cut.
    Returns (hash, start, end), positions from the start of ``data``.
    """
    part = data[lo:hi]
    space = SPACE[part]
    edge = np.zeros(hi - lo + 1, bool)
    edge[offsets[(offsets >= lo) & (offsets <= hi)] - lo] = True
    edge[0] = True
    edge[-1] |= hi == len(data)
    word_next = np.concatenate((~space[1:], [hi < len(data) and not SPACE[data[min(hi, len(data) - 1)]]])) & ~edge[1:]
    word_prev = np.concatenate(([True], ~space[:-1]))
    blank_prev = np.concatenate(([False], part[:-1] == 0x20))
    first = edge[:-1] | np.where(space, word_prev | word_next, ~word_prev & ~blank_prev)
    s = np.flatnonzero(first)
    e = np.append(s[1:], hi - lo)
    return _slice_hashes(part, s, e, _raw), s + lo, e + lo


_STEP = mix(np.arange(1, 65, dtype=np.uint64) * _U(0xD6E8FEB86659FD93)) | _U(1)


def ngrams(h: np.ndarray, word_offsets: np.ndarray, k: int, short: bool = True):
    """Word k-grams of every text: (hash, text index, first word's index).

    With ``short``, a text of 1..k-1 words gives its whole sequence as one
    (hashed with its length, so it equals no k-gram).
    """
    n = len(h)
    if n == 0:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z
    counts = np.diff(word_offsets)
    doc = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero(np.arange(n) + k <= word_offsets[1:][doc])
    g = np.zeros(len(at), np.uint64)
    for j in range(k):
        g += h[at + j] * _STEP[j]
    g = mix(g)
    d = doc[at]
    if short and (few := np.flatnonzero((counts > 0) & (counts < k))).size:
        tail = counts[few].astype(np.uint64) * _STEP[63]
        for j in range(k - 1):
            has = counts[few] > j
            tail[has] += h[word_offsets[few][has] + j] * _STEP[j]
        tail = mix(tail)
        g, d, at = np.concatenate((g, tail)), np.concatenate((d, few)), np.concatenate((at, word_offsets[few]))
        order = np.argsort(at, kind="stable")
        g, d, at = g[order], d[order], at[order]
    return g, d, at


def spread(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices of the slices [start, start+len), one after another."""
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.concatenate(([0], np.cumsum(lens)[:-1]))
    return np.repeat(starts - before, lens) + np.arange(total)


def lookup(known: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index in the sorted array ``known`` of each wanted value, -1 where absent."""
    if not len(known):
        return np.full(len(wanted), -1, np.int64)
    i = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return np.where(known[i] == wanted, i, -1)


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct values, count of each)."""
    v = np.sort(values)
    if not len(v):
        return v, np.zeros(0, np.int64)
    at = np.flatnonzero(np.concatenate(([True], v[1:] != v[:-1])))
    return v[at], np.diff(np.append(at, len(v)))


def group(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct values, index of one occurrence of each, index into them of every value)."""
    order = np.argsort(values)
    v = values[order]
    new = np.concatenate((np.ones(min(1, len(v)), bool), v[1:] != v[:-1]))
    back = np.empty(len(v), np.int64)
    back[order] = np.cumsum(new) - 1
    return v[new], order[new], back
