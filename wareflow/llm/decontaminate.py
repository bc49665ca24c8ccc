"""Benchmark decontamination: rare n-gram seeds, then local alignment.

Test items are read in blocks of bounded size; each block's items are one
broadcast query set against every document. The word ``k``-grams of an item are
its seeds (an item shorter than k words is one seed). A first pass counts the
documents that hold each. A seed that more than one document in
``1 / COMMON_SHARE`` holds, and more than ``COMMON_LEAST``, is common language, a
rule that does not look at the items; it is left out unless it is the rarest of
``COVER`` seeds in a row, so that every stretch of an item keeps a seed. All
rarer seeds stay: copies raise the counts of just the k-grams they share, so
that counts among them say nothing.

A second pass joins the documents to the items by these seeds and aligns the item
with the words around each hit by Smith-Waterman over words (match 2, mismatch
-1, gap -1). Places whose words could not reach the threshold in any order are
left out before aligning; this loses nothing. The score is the best alignment
over that of an unchanged copy, so edited and paraphrased copies score below 1.
An item leaks into a document where the score reaches ``threshold``. Copies
without k unchanged words in a row, or k + ``COVER`` - 1 where the words are common
language, may have no seed and are then not found.

Words are lower-cased and parted by white space and ASCII punctuation. Null and
empty texts and items have no words and match nothing. Null or repeated ids and
repeated rows, of documents and of items, are scored row by row; a null id stays null. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareflow.llm.common import batch, discard, kept, tidy
from wareflow.llm.textblock import MARKS, _STEP, distinct, lookup, mix, spread, text_bytes, words

K = 4
THRESHOLD = 0.5
#: Share of the documents, and least number of them, that hold a seed of common language.
COMMON_SHARE, COMMON_LEAST = 1 / 1000, 1000
COVER = 4
BLOCK_CHARS = 8 << 20
MATCH, MISS, GAP = 2, -1, -1
_CELLS = 1 << 19
_USES = 1 << 20


def grams_at(h: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    g = np.full(len(at), k, np.uint64) * _STEP[63]
    for j in range(k):
        g += h[at + j] * _STEP[j]
    return mix(g)


@dataclass
class Items:
    """A block of items: words of each, and its seeds sorted by (size, hash)."""
    ids: list
    word: np.ndarray
    offs: np.ndarray
    seed: np.ndarray      # distinct seed hashes, sorted
    size: np.ndarray      # words of each seed
    first: np.ndarray     # uses[first[s]:first[s+1]] are the places of seed s
    use_item: np.ndarray
    use_pos: np.ndarray
    vocab: np.ndarray     # bit table of the items' words, by the upper 20 bits
    pair: np.ndarray      # distinct hashes of (item, word), sorted
    pair_n: np.ndarray    # times the word stands in the item

    @staticmethod
    def of(ids: list, texts: list, k: int) -> Items:
        h, _, _, offs = words(*text_bytes(pa.array(texts, pa.string())), between=MARKS)
        seed, size, item, pos = [], [], [], []
        for i in range(len(ids)):
            n = offs[i + 1] - offs[i]
            m = min(k, n)
            if m:
                at = np.arange(offs[i], offs[i + 1] - m + 1)
                seed.append(grams_at(h, at, m))
                size.append(np.full(len(at), m))
                item.append(np.full(len(at), i))
                pos.append(at - offs[i])
        cat = lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, t)
        seed, size, item, pos = cat(seed, np.uint64), cat(size, np.int64), cat(item, np.int64), cat(pos, np.int64)
        vocab = np.zeros(1 << 20, bool)
        vocab[(h >> np.uint64(44)).astype(np.int64)] = True
        pair, pair_n = distinct(Items._pair(np.repeat(np.arange(len(ids)), np.diff(offs)), h))
        return Items(ids, h, offs, *Items._sorted(seed, size, item, pos), vocab, pair, pair_n)

    def rare(self, common: np.ndarray, counts: np.ndarray, cover: int = COVER) -> Items:
        """Without the seeds of common language (sorted hashes and their documents) that are not the rarest of ``cover`` in a row."""
        at = lookup(common, self.seed)
        held = np.where(at >= 0, counts[at] if len(counts) else 0, 0)
        if not held.any():
            return self
        of = np.repeat(np.arange(len(self.seed)), np.diff(self.first))       # the seed of each place
        order = np.lexsort((self.use_pos, self.use_item))
        item, pos, seed = self.use_item[order], self.use_pos[order], of[order]
        n = held[seed]
        keep = n == 0
        for back in range(cover):                             # windows of places; each keeps its rarest
            lo = np.arange(len(seed)) - back
            window = lo[:, None] + np.arange(cover)
            inside = (window >= 0) & (window < len(seed))
            window = np.clip(window, 0, max(0, len(seed) - 1))
            inside &= item[window] == item[:, None]
            full = inside.all(axis=1) | (back == 0)            # a window that an item's end cuts counts once
            value = np.where(inside, n[window] * len(self.seed) + seed[window], np.iinfo(np.int64).max)     # of equals the lesser hash
            best = window[np.arange(len(seed)), value.argmin(axis=1)]
            keep[best[full]] = True
        stays = np.zeros(len(self.seed), bool)
        stays[seed[keep]] = True
        use = stays[of]
        return Items(self.ids, self.word, self.offs, *Items._sorted(self.seed[of][use], self.size[of][use], self.use_item[use], self.use_pos[use]),
                     self.vocab, self.pair, self.pair_n)

    @staticmethod
    def _pair(item: np.ndarray, word: np.ndarray) -> np.ndarray:
        return mix(word + mix(item.astype(np.uint64)))

    @staticmethod
    def _sorted(seed, size, item, pos):
        order = np.lexsort((pos, item, seed))
        seed, size, item, pos = seed[order], size[order], item[order], pos[order]
        u, n = distinct(seed)
        first = np.concatenate(([0], np.cumsum(n))).astype(np.int64)
        return u, size[first[:-1]], first, item, pos

    def reachable(self, item, size, text, t0, m, threshold: float) -> np.ndarray:
        """False for pairs (item, text slice) whose common words, in whatever order, score below ``threshold``."""
        ok = np.zeros(len(item), bool)
        ends = np.cumsum(m)
        a = 0
        while a < len(item):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + _CELLS, "right")))
            each = np.repeat(np.arange(b - a), m[a:b])
            at = lookup(self.pair, Items._pair(item[a:b][each], text[spread(t0[a:b], m[a:b])]))
            same, n = distinct((each * len(self.pair) + at)[at >= 0])
            common = np.bincount(same // len(self.pair), np.minimum(n, self.pair_n[same % len(self.pair)]), b - a)
            ok[a:b] = MATCH * common / np.maximum(1, MATCH * size[a:b]) >= threshold
            a = b
        return ok

    def hits(self, col):
        """(word hashes, offsets, [(text, word, seed)]) of the seeds found in a batch of texts."""
        h, _, _, offs = words(*text_bytes(col), between=MARKS)
        known = np.append(self.vocab[(h >> np.uint64(44)).astype(np.int64)], np.zeros(64, bool))
        docs, ats, seeds = [], [], []
        for k in np.unique(self.size).tolist():
            ok = known[:len(h)].copy()
            for j in range(1, k):
                ok &= known[j:len(h) + j]
            at = np.flatnonzero(ok)
            doc = np.searchsorted(offs, at, "right") - 1
            inside = at + k <= offs[doc + 1]
            at, doc = at[inside], doc[inside]
            s = lookup(self.seed, grams_at(h, at, k))
            ok = s >= 0
            docs.append(doc[ok])
            ats.append(at[ok])
            seeds.append(s[ok])
        cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        return h, offs, cat(docs), cat(ats), cat(seeds)

    def leaks(self, col, threshold: float):
        """(text, item, score, seed hits, end word) of every leak in a batch."""
        h, offs, doc, at, seed = self.hits(col)
        order = np.argsort(doc, kind="stable")
        doc, at, seed = doc[order], at[order], seed[order]
        ends = np.cumsum(self.first[seed + 1] - self.first[seed])
        out, a = [self._leaks(h, offs, doc[:0], at[:0], seed[:0], threshold)], 0
        while a < len(doc):                                    # whole texts, some uses of their seeds at a time
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + _USES, "right")))
            b = int(np.searchsorted(doc, doc[b - 1], "right"))
            out.append(self._leaks(h, offs, doc[a:b], at[a:b], seed[a:b], threshold))
            a = b
        return tuple(np.concatenate(c) for c in zip(*out))

    def _leaks(self, h, offs, doc, at, seed, threshold: float):
        n = self.first[seed + 1] - self.first[seed]
        use = spread(self.first[seed], n)
        doc, at, item = np.repeat(doc, n), np.repeat(at, n), self.use_item[use]
        begin = at - offs[doc] - self.use_pos[use]             # where the item would start in the text
        size = self.offs[item + 1] - self.offs[item]
        place = np.floor_divide(begin, np.maximum(size, 1))
        order = np.lexsort((place, item, doc))
        doc, item, place = doc[order], item[order], place[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (place[1:] != place[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(doc)))
        doc, item, place = doc[first], item[first], place[first]
        size = self.offs[item + 1] - self.offs[item]
        lo = np.maximum(0, place * size - size // 2 - 1)
        hi = np.minimum(np.diff(offs)[doc], place * size + 2 * size + size // 2 + 2)
        ok = self.reachable(item, size, h, offs[doc] + lo, hi - lo, threshold)
        doc, item, count, size, lo, hi = doc[ok], item[ok], count[ok], size[ok], lo[ok], hi[ok]
        best, end = align(self.word, self.offs[item], size, h, offs[doc] + lo, hi - lo)
        score = best / np.maximum(1, MATCH * size)
        ok = score >= threshold
        doc, item, score, count, end = doc[ok], item[ok], score[ok], count[ok], (lo + end)[ok]
        order = np.lexsort((-score, item, doc))                # best place of each (text, item)
        doc, item, score, count, end = doc[order], item[order], score[order], count[order], end[order]
        top = np.ones(len(doc), bool)
        top[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])
        return doc[top], item[top], score[top], count[top], end[top]


def align(item: np.ndarray, i0: np.ndarray, n: np.ndarray, text: np.ndarray, t0: np.ndarray, m: np.ndarray):
    """Best Smith-Waterman score of each pair (item slice, text slice) and where it ends in the text slice."""
    best, end = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
    order = np.lexsort((m, n))
    at = 0
    while at < len(order):
        step, wide = 1, max(1, int(m[order[at]]))
        while at + step < len(order) and (step + 1) * max(wide, int(m[order[at + step]])) <= _CELLS:
            wide = max(wide, int(m[order[at + step]]))
            step += 1
        part = order[at:at + step]
        b, e = _align(item, i0[part], n[part], text, t0[part], m[part])
        best[part], end[part] = b, e
        at += step
    return best, end


def _align(item, i0, n, text, t0, m):
    rows, wide, p = int(n.max()), int(m.max()), len(n)
    col = np.arange(wide)
    there = col < m[:, None]
    window = np.where(there, text[np.minimum(t0[:, None] + col, len(text) - 1)], 0) if len(text) else np.zeros((p, wide), np.uint64)
    h = np.zeros((p, wide + 1), np.int32)
    best, end = np.zeros(p, np.int64), np.zeros(p, np.int64)
    slope = -GAP * np.arange(wide + 1, dtype=np.int32)
    for i in range(rows):
        live = i < n
        w = item[np.minimum(i0 + i, len(item) - 1)]
        same = (window == w[:, None]) & there & live[:, None]
        new = np.zeros_like(h)
        np.maximum(h[:, :-1] + np.where(same, MATCH, MISS), h[:, 1:] + GAP, out=new[:, 1:])
        np.maximum(new, 0, out=new)
        h = np.maximum.accumulate(new + slope, axis=1) - slope
        top = h[:, 1:].max(axis=1)
        better = (top > best) & live
        if better.any():
            best[better] = top[better]
            end[better] = h[better, 1:].argmax(axis=1) + 1
    return best, end


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[tuple[list, list]]:
    """The items in blocks of about ``block_chars`` characters, each block collected by itself."""
    items = benchmark.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    chars = items.agg(F.sum(F.length("t"))).first()[0] or 0
    n = -(-chars // block_chars)
    if n > 1:                                  # numbered once, so that equal items may go to different blocks
        items = kept(items.withColumn("row", F.monotonically_increasing_id()), "items")
    else:
        items = items.withColumn("row", F.lit(0))
    for b in range(n):
        got = items.where(F.pmod(F.xxhash64("i", "t", "row"), F.lit(n)) == b).select("i", "t").toArrow().sort_by([("i", "ascending"), ("t", "ascending")])
        yield got.column(0).to_pylist(), got.column(1).to_pylist()


def _block(rows: DataFrame, ids: list, texts: list, k: int):
    """A broadcast block of items with its rare seeds; rows have the text in their second column."""
    sc = rows.sparkSession.sparkContext
    every = Items.of(ids, texts, k)
    shared = sc.broadcast(every)
    kind = pa.schema([("seed", pa.int64()), ("docs", pa.int64())])

    def count(batches):
        held, texts_ = np.zeros(len(shared.value.seed), np.int64), 0
        for b in batches:
            _, _, doc, _, seed = shared.value.hits(b.column(1))
            texts_ += b.num_rows
            if len(seed):
                both, _ = distinct(doc.astype(np.uint64) << np.uint64(32) | seed.astype(np.uint64))
                held += np.bincount((both & np.uint64(0xFFFFFFFF)).astype(np.int64), minlength=len(held))
        some = np.flatnonzero(held)
        yield batch(kind, shared.value.seed[some].view(np.int64), held[some])
        yield batch(kind, pa.nulls(1, pa.int64()), [texts_])

    seen = kept(rows.mapInArrow(tidy(count), "seed long, docs long").groupBy("seed").agg(F.sum("docs").alias("docs")), "seeds")
    total = seen.where("seed IS NULL").first()
    bound = max(COMMON_LEAST, int((total["docs"] if total else 0) * COMMON_SHARE))
    often = seen.where(F.col("seed").isNotNull() & (F.col("docs") > bound)).toArrow()       # some of the block's own seeds
    h, n = often.column(0).to_numpy().view(np.uint64), often.column(1).to_numpy()
    discard(seen)
    by = np.argsort(h)
    rare = every.rare(h[by], n[by])
    if rare is every:
        return shared
    shared.unpersist()
    return sc.broadcast(rare)


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
          item_text: str = "text", k: int = K, threshold: float = THRESHOLD,
          block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, score, n_seeds (hits around the place), end_word of every leak."""
    spark = docs.sparkSession
    kind = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("n_seeds", pa.int64()), ("end_word", pa.int64())])
    ddl = "doc_id long, item_id long, score double, n_seeds long, end_word long"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    out = spark.createDataFrame([], ddl)
    for ids, texts in _blocks(benchmark, item_id, item_text, block_chars):
        shared = _block(rows, ids, texts, k)

        def find(batches, shared=shared):
            names = pa.array(shared.value.ids, pa.int64())
            for b in batches:
                doc, item, score, n, end = shared.value.leaks(b.column(1), threshold)
                yield batch(kind, b.column(0).take(pa.array(doc)), names.take(pa.array(item, pa.int64())), score, n, end)

        out = out.unionByName(rows.mapInArrow(tidy(find), ddl))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                  k: int = K, threshold: float = THRESHOLD, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` into which no item leaks."""
    for ids, texts in _blocks(benchmark, item_id, item_text, block_chars):
        shared = _block(docs.select(F.lit(0), F.col(text_col).alias("t")), ids, texts, k)
        rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("t"))

        def clean(batches, shared=shared):
            for b in batches:
                ok = np.ones(b.num_rows, bool)
                ok[shared.value.leaks(b.column(1), threshold)[0]] = False
                yield b.select([0]).filter(pa.array(ok))

        docs = rows.mapInArrow(tidy(clean), T.StructType([rows.schema[0]])).select("row.*")
    return docs
