"""Token ids and counts of whole texts by a byte-level BPE file, in tasks.

Each distinct chunk (see :func:`textblock.chunks`) is encoded once per worker
by the library and kept in a bounded cache; a text's ids are then gathered from
the cache. Texts holding a special token's string or white space beyond ASCII
go to the library whole, so every result equals the library's own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

from wareflow.llm.textblock import PIECE_BYTES, chunks, group, lookup, pieces, spread, text_bytes

#: More than the distinct chunks of a piece, so that a cleared cache holds all of the next one.
CACHE_ENTRIES = 1 << 19
RECENT_ENTRIES = 1 << 15
ROW = 500
#: UTF-8 of the white space beyond ASCII.
_WIDE_SPACE = re.compile(rb"\xc2\x85|\xc2\xa0|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
_models: dict[str, Pieces] = {}


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _merged(a, b):
    """Two tables of sorted hashes with their columns as one."""
    at = np.searchsorted(a[0], b[0])
    return tuple(np.insert(x, at, y) for x, y in zip(a, b))


class Pieces:
    """A tokenizer file with a cache of chunk -> ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        added = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]
        vocab = self.tok.get_vocab()
        self.bytes_of = np.zeros(max(vocab.values()) + 1, np.int64)      # a byte-level token has a character for each byte
        for token, i in vocab.items():
            self.bytes_of[i] = len(token)
        self.special = re.compile(b"|".join(map(re.escape, added))) if added else None
        self._clear()

    def _clear(self) -> None:
        none = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.main, self.recent = none, none     # sorted hashes, first id in the pool, number of ids
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    @staticmethod
    def of(path: str) -> Pieces:
        if path not in _models:
            _models[path] = Pieces(path)
        return _models[path]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tok.encode_batch(texts, add_special_tokens=False)]

    def _encode_spans(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each) of the chunks [start, end) of ``data``. Chunks that start with a space are encoded many
        in a row: the tokenizer cuts before each, and the byte lengths of the tokens tell where each ends."""
        lens = end - start
        in_row = data[start] == 0x20
        joined, alone = np.flatnonzero(in_row), np.flatnonzero(~in_row)
        size = np.zeros(len(start), np.int64)
        raw = data[spread(start[joined], lens[joined])].tobytes()
        ends = np.cumsum(lens[joined])
        cuts = [0, *ends[ROW - 1::ROW].tolist()]
        if cuts[-1] < len(raw):
            cuts.append(len(raw))
        got = self.tok.encode_batch_fast([raw[a:z].decode() for a, z in zip(cuts, cuts[1:])], add_special_tokens=False)
        flat = np.fromiter(chain.from_iterable(e.ids for e in got), np.uint32)
        reached = np.cumsum(self.bytes_of[flat])
        at = np.searchsorted(reached, ends) + 1
        if len(joined) and not np.array_equal(reached[at - 1], ends):
            raise ValueError("the tokenizer does not cut before a space")
        size[joined] = np.diff(np.concatenate(([0], at)))[:len(joined)]
        each = self.encode([data[a:z].tobytes().decode() for a, z in zip(start[alone], end[alone])])
        size[alone] = [len(x) for x in each]
        ids = np.concatenate((flat, *each))
        source = np.zeros(len(start), np.int64)           # where each one's ids begin
        order = np.concatenate((joined, alone))
        source[order] = np.cumsum(np.concatenate(([0], size[order][:-1])))
        return ids[spread(source, size)], size

    def chunk_sizes(self, texts: list[str]) -> np.ndarray:
        """Number of ids of each chunk."""
        if not texts:
            return np.zeros(0, np.int64)
        data, offsets = text_bytes(pa.array(texts, pa.large_string()))
        return self._encode_spans(data, offsets[:-1], offsets[1:])[1]

    def _learn(self, hashes: np.ndarray, data: np.ndarray, at: np.ndarray, to: np.ndarray) -> None:
        """Add the chunks [at, to) of ``data`` by their sorted hashes; few at a time go to a small table, which joins
        the large one when full."""
        if len(self.main[0]) + len(self.recent[0]) + len(hashes) > CACHE_ENTRIES:
            self._clear()
        ids, size = self._encode_spans(data, at, to)
        start = self.used + np.concatenate(([0], np.cumsum(size)[:-1])).astype(np.int64)
        more = int(size.sum())
        while self.used + more > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros_like(self.pool)))
        self.pool[self.used:self.used + more] = ids
        self.used += more
        self.recent = _merged(self.recent, (hashes, start, size))
        if len(self.recent[0]) > RECENT_ENTRIES:
            none = self.main[0][:0], self.main[1][:0], self.main[2][:0]
            self.main, self.recent = _merged(self.main, self.recent), none

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(known, first id in the pool, number of ids) of sorted hashes."""
        known = np.zeros(len(hashes), bool)
        start, count = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        for keys, s, c in (self.main, self.recent):
            at = lookup(keys, hashes)
            hit = at >= 0
            known |= hit
            start[hit], count[hit] = s[at[hit]], c[at[hit]]
        return known, start, count

    def plain(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """True for the texts that may be cut into chunks."""
        ok = np.ones(len(offsets) - 1, bool)
        raw = data.tobytes() if len(data) else b""
        for pattern in (_WIDE_SPACE, self.special):
            if pattern is not None and pattern.search(raw):
                for m in pattern.finditer(raw):
                    ok[np.searchsorted(offsets, m.start(), "right") - 1] = False
        return ok

    def ids(self, col, counts_only: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For runs of texts: (index of the first, tokens of each, all their ids one after another)."""
        data, offsets = text_bytes(col)
        ok = self.plain(data, offsets)
        n, i = len(ok), 0
        while i < n:
            if not ok[i]:
                got = self.encode([data[offsets[i]:offsets[i + 1]].tobytes().decode()])[0]
                yield i, np.array([len(got)]), got
                i += 1
                continue
            j = i + 1                      # a run of plain texts of about a piece
            while j < n and ok[j] and offsets[j + 1] - offsets[i] <= PIECE_BYTES:
                j += 1
            yield i, *self._run(data, offsets, i, j, counts_only)
            i = j

    def _run(self, data, offsets, i, j, counts_only):
        a, b = offsets[i], offsets[j]
        part, offs = data[a:b], offsets[i:j + 1] - a
        each, out = np.zeros(j - i, np.int64), []
        for lo, hi in pieces(part, offs):
            h, s, e = chunks(part, offs, lo, hi)
            uniq, first, back = group(h)
            known, start, count = self._find(uniq)
            while not known.all():            # again if the cache was cleared meanwhile
                new = np.flatnonzero(~known)
                self._learn(uniq[new], part, s[first[new]], e[first[new]])
                known, start, count = self._find(uniq)
            start, count = start[back], count[back]
            doc = np.searchsorted(offs, s, "right") - 1
            each += np.bincount(doc, weights=count, minlength=j - i).astype(np.int64)
            if not counts_only:
                out.append(self.pool[spread(start, count)])
        return each, np.concatenate(out) if out else np.zeros(0, np.uint32)
