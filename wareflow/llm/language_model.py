"""Interpolated modified Kneser-Ney bigram model, counted in Spark, scored from memory-mapped arrays.

Training counts distinct words, then distinct bigrams. Tasks count their own
texts first and deal sorted arrays of (64-bit key, count) over shards of equal
key range; the owner of a shard adds them up and writes sorted hash arrays into
the model's folder in the shared store. A word's id is its place in the sorted
word hashes. A bigram's key is a bijection of (context id, word id), so shards
are even however frequent a word is, and the keys can be taken apart again to
count, for each word, the contexts it follows and, for each context, the words
that follow it once, twice or more often. These counts meet by id range. Counts
of counts give the discounts.

Scoring tasks map the arrays into memory and look up sorted queries, so a worker
holds the pages it touches, not the model. Where the shared store is no local
path, each worker copies the files it needs to unlinked temporary files.

P(w | v) = max(c(vw) - D(c), 0) / c(v) + g(v) P(w), and P(w) is the same over
continuation counts, interpolated with the uniform 1 / (V + 1); an unknown
context gives P(w). A text's tokens are its words, A-Z lower-cased, and one end.

Null and empty texts are the end alone. Rows with a null id belong to training
(their id counts as the empty string). Repeated rows count and score each. With
no training rows N and V are 0, and every token has base probability 1.
"""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wareflow.llm.common import batch, filesystem, put_file
from wareflow.llm.textblock import distinct, group, mix, text_bytes, unmix, words
from wareflow.session import scratch_path

_U = np.uint64
END = _U(0x0123456789ABCDEF)
SLICE = 2500


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shards of equal ranges of the 64-bit keys, in order."""
    return ((keys >> _U(32)) * _U(shards) >> _U(32)).astype(np.int64)


def _tokens(col):
    """(hashes with one end after each text, offsets)."""
    h, _, _, offs = words(*text_bytes(col))
    n = len(offs) - 1
    out = np.insert(h, offs[1:], END) if n else h
    return out, offs + np.arange(n + 1)


_BLOB = pa.schema([("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_BLOB_DDL = "shard int, keys binary, counts binary"


def _deal(keys: np.ndarray, counts: np.ndarray, shards: int):
    """One row for each shard of sorted distinct keys."""
    cut = np.searchsorted(shard_of(keys, shards), np.arange(shards + 1))
    rows = [(g, keys[a:z].tobytes(), counts[a:z].astype(np.uint32).tobytes()) for g, (a, z) in enumerate(zip(cut, cut[1:])) if z > a]
    for i in range(0, len(rows), 64):
        yield batch(_BLOB, *(list(c) for c in zip(*rows[i:i + 64])))


def _shards(batches):
    """(shard, keys, counts) summed, of the rows of one task, sorted by shard."""
    now, ks, cs = None, [], []
    for b in batches:
        shard, keys, counts = (c.to_pylist() for c in b.columns[:3])
        for s, k, c in zip(shard, keys, counts):
            if s != now and now is not None:
                yield now, *_sum(ks, cs)
                ks, cs = [], []
            now = s
            ks.append(np.frombuffer(k, np.uint64))
            cs.append(np.frombuffer(c, np.uint32))
            if len(ks) > 64:
                k, c = _sum(ks, cs)
                ks, cs = [k], [c]
    if now is not None:
        yield now, *_sum(ks, cs)


def _sum(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    at = np.flatnonzero(np.concatenate((np.ones(min(1, len(k)), bool), k[1:] != k[:-1])))
    return k[at], np.add.reduceat(c, at) if len(at) else c


def discounts(t: np.ndarray) -> np.ndarray:
    """D for counts 0, 1, 2 and 3 or more, from the numbers of entries seen 1, 2, 3 and 4 times."""
    t1, t2, t3, t4 = (max(float(x), 0.0) for x in t)
    if not t1 or not t2:
        return np.array([0.0, 0.5, 0.75, 0.9])
    y = t1 / (t1 + 2 * t2)
    d = [0.0, 1 - 2 * y * t2 / t1, 2 - 3 * y * t3 / t2, 3 - 4 * y * t4 / t3 if t3 else 1.5]
    return np.clip(d, 0, [0, 1, 2, 3])


class Store:
    """The mapped arrays of a model folder, opened once per worker."""
    _open: dict[str, Store] = {}

    def __init__(self, folder: str):
        self.folder = folder
        self.maps: dict[tuple[str, int], np.ndarray] = {}

    @staticmethod
    def of(folder: str) -> Store:
        if folder not in Store._open:
            Store._open.clear()
            Store._open[folder] = Store(folder)
        return Store._open[folder]

    def array(self, name: str, shard: int, dtype) -> np.ndarray:
        key = (name, shard)
        if key not in self.maps:
            store, path = filesystem(self.folder)
            path = f"{path}/{name}-{shard:06d}"
            info = store.get_file_info(path)
            if not info.is_file or not info.size:
                self.maps[key] = np.zeros(0, dtype)
            elif store.type_name == "local":
                self.maps[key] = np.memmap(path, dtype, "r")
            else:
                copy = tempfile.TemporaryFile()      # unlinked: gone with the worker
                with store.open_input_stream(path) as f:
                    while data := f.read(1 << 22):
                        copy.write(data)
                copy.flush()
                self.maps[key] = np.memmap(copy, dtype, "r")
        return self.maps[key]

    def find(self, name: str, keys: np.ndarray, shards: int, values: list[tuple[str, type]] = ()) -> tuple:
        """Of sorted distinct keys: (shard, place or -1), and the values there (0 where absent)."""
        which = shard_of(keys, shards)
        place = np.full(len(keys), -1, np.int64)
        out = [np.zeros(len(keys), t) for _, t in values]
        cut = np.searchsorted(which, np.arange(shards + 1))
        for g in np.flatnonzero(np.diff(cut)).tolist():
            z = slice(cut[g], cut[g + 1])
            have = self.array(name, g, np.uint64)
            if not len(have):
                continue
            i = np.minimum(np.searchsorted(have, keys[z]), len(have) - 1)
            ok = have[i] == keys[z]
            place[z] = np.where(ok, i, -1)
            for o, (v, t) in zip(out, values):
                o[z] = np.where(ok, self.array(v, g, t)[i], 0)
        return which, place, out


class Model:
    """What scoring needs besides the arrays; small, sent with the tasks."""

    def __init__(self, folder: str, shards: int, offsets: np.ndarray, tokens: int, texts: int, start: tuple,
                 d2: np.ndarray, d1: np.ndarray, pairs: int, cont: np.ndarray):
        self.folder, self.shards, self.offsets, self.tokens, self.texts = folder, shards, offsets, tokens, texts
        self.vocabulary = int(offsets[-1])
        self.start, self.d2, self.d1, self.pairs = start, d2, d1, pairs
        self.base = float(d1[1] * cont[0] + d1[2] * cont[1] + d1[3] * cont[2]) / max(1, pairs)    # weight of the uniform

    def ids(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id or -1, training count) of each word hash."""
        u, _, back = group(h)
        shard, place, (count,) = Store.of(self.folder).find("words", u, self.shards, [("word-counts", np.uint32)])
        ids = np.where(place >= 0, place + self.offsets[shard], -1)
        return ids[back], count.astype(np.int64)[back]

    def by_id(self, ids: np.ndarray) -> list[np.ndarray]:
        """cont, n1, n2, n3 of each id (0 for -1)."""
        out = [np.zeros(len(ids), np.int64) for _ in range(4)]
        u, _, back = group(ids.astype(np.int64))
        which = np.searchsorted(self.offsets, u, "right") - 1
        for g in np.unique(which[u >= 0]).tolist():
            z = np.flatnonzero((which == g) & (u >= 0))
            for o, name in zip(out, ("cont", "n1", "n2", "n3")):
                o[z] = Store.of(self.folder).array(name, g, np.uint32)[u[z] - self.offsets[g]]
        return [o[back] for o in out]

    def log10(self, ids: np.ndarray, counts: np.ndarray, first: np.ndarray) -> np.ndarray:
        """log10 P of each token after the one before it; first marks the first token of each text."""
        cont, n1, n2, n3 = self.by_id(ids)
        total = max(1, self.pairs)
        p = np.maximum(cont - self.d1[np.minimum(cont, 3)], 0) / total + (self.base if self.pairs else 1.0) / (self.vocabulary + 1)
        shift = lambda x, s: np.where(first, s, np.concatenate((x[:1], x[:-1])))
        ctx = shift(ids, self.vocabulary)
        seen = shift(counts, self.texts)
        c1, c2, c3 = (shift(x, s) for x, s in zip((n1, n2, n3), self.start))
        both = np.flatnonzero((ids >= 0) & (ctx >= 0))
        c = np.zeros(len(ids), np.int64)
        u, _, back = group(mix(ctx[both].astype(np.uint64) << _U(32) | ids[both].astype(np.uint64)))
        _, _, (held,) = Store.of(self.folder).find("pairs", u, self.shards, [("pair-counts", np.uint32)])
        c[both] = held.astype(np.int64)[back]
        known = seen > 0
        size = np.maximum(seen, 1)
        back_off = (self.d2[1] * c1 + self.d2[2] * c2 + self.d2[3] * c3) / size
        return np.log10(np.where(known, np.maximum(c - self.d2[np.minimum(c, 3)], 0) / size + back_off * p, p))


def train(docs: DataFrame, text_col: str = "text", folder: str | None = None) -> Model:
    """Count the texts of ``docs`` and write the arrays of a model below ``folder``."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "language-model")
    shards = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    texts = docs.select(F.col(text_col).alias("t"))

    def count_words(batches):
        for b in batches:
            parts = [distinct(_tokens(b.column(0).slice(i, SLICE))[0]) for i in range(0, b.num_rows, SLICE)]
            if parts:
                yield from _deal(*_sum(*(list(x) for x in zip(*parts))), shards)

    sizes = pa.schema([("shard", pa.int32()), ("n", pa.int64()), ("tokens", pa.int64()), ("texts", pa.int64())])

    def write_words(batches):
        for shard, k, c in _shards(batches):
            put_file(folder, f"words-{shard:06d}", k.tobytes())
            put_file(folder, f"word-counts-{shard:06d}", c.astype(np.uint32).tobytes())
            yield batch(sizes, [shard], [len(k)], [int(c.sum())], [int(c[k == END].sum())])

    def dealt(frame):
        return frame.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard")

    got = dealt(texts.mapInArrow(count_words, _BLOB_DDL)).mapInArrow(write_words, "shard int, n long, tokens long, texts long").collect()   # a row per shard
    n = np.zeros(shards, np.int64)
    for r in got:
        n[r.shard] = r.n
    offsets = np.concatenate(([0], np.cumsum(n)))
    vocabulary = int(offsets[-1])
    if vocabulary >= 1 << 32:
        raise ValueError("bigram keys hold ids of up to 2**32 distinct words")
    bare = Model(folder, shards, offsets, 0, 0, (0, 0, 0), np.zeros(4), np.zeros(4), 0, np.zeros(4))

    def count_pairs(batches):
        for b in batches:
            parts = []
            for i in range(0, b.num_rows, SLICE):
                h, offs = _tokens(b.column(0).slice(i, SLICE))
                ids, _ = bare.ids(h)
                ctx = np.concatenate((ids[:1], ids[:-1]))
                ctx[offs[:-1]] = vocabulary
                parts.append(distinct(mix(ctx.astype(np.uint64) << _U(32) | ids.astype(np.uint64))))
            if parts:
                yield from _deal(*_sum(*(list(x) for x in zip(*parts))), shards)

    stats = pa.schema([("shard", pa.int32()), ("ids", pa.binary()), ("cont", pa.binary()), ("n1", pa.binary()), ("n2", pa.binary()), ("n3", pa.binary()), ("times", pa.binary())])

    def write_pairs(batches):
        for shard, k, c in _shards(batches):
            put_file(folder, f"pairs-{shard:06d}", k.tobytes())
            put_file(folder, f"pair-counts-{shard:06d}", c.astype(np.uint32).tobytes())
            raw = unmix(k)
            word, ctx = (raw & _U(0xFFFFFFFF)).astype(np.int64), (raw >> _U(32)).astype(np.int64)
            ids, _, back = group(np.concatenate((word, ctx)))
            w, v = back[:len(word)], back[len(word):]
            cols = [np.bincount(w, minlength=len(ids))] + [np.bincount(v[m], minlength=len(ids)) for m in (c == 1, c == 2, c > 2)]
            cut = np.searchsorted(ids, offsets)
            times = np.array([(c == j).sum() for j in (1, 2, 3, 4)] + [len(c)], np.int64)
            rows = [(g, ids[a:z].astype(np.uint32).tobytes(), *(x[a:z].astype(np.uint32).tobytes() for x in cols), None)
                    for g, (a, z) in enumerate(zip(cut, cut[1:])) if z > a]
            at = cut[-1]                             # the start of texts stands behind all words
            start = np.array([x[at] if at < len(ids) else 0 for x in cols[1:]], np.int64)
            rows.append((0, None, None, None, None, None, np.concatenate((times, start)).tobytes()))
            for i in range(0, len(rows), 64):
                yield batch(stats, *(list(x) for x in zip(*rows[i:i + 64])))

    totals = pa.schema([("t", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])

    def write_stats(batches):
        now, held, times, seen = None, None, np.zeros(8, np.int64), np.zeros(5, np.int64)

        def put():
            for name, x in zip(("cont", "n1", "n2", "n3"), held):
                put_file(folder, f"{name}-{now:06d}", x.astype(np.uint32).tobytes())
            return np.array([(held[0] == j).sum() for j in (1, 2, 3, 4)] + [(held[0] > 2).sum()])

        for b in batches:
            for r in b.to_pylist():
                if r["ids"] is None:
                    times += np.frombuffer(r["times"], np.int64)
                    continue
                if r["shard"] != now:
                    if now is not None:
                        seen += put()
                    now, held = r["shard"], [np.zeros(n[r["shard"]], np.int64) for _ in range(4)]
                at = np.frombuffer(r["ids"], np.uint32).astype(np.int64) - offsets[now]
                for x, name in zip(held, ("cont", "n1", "n2", "n3")):
                    x[at] += np.frombuffer(r[name], np.uint32)
        if now is not None:
            seen += put()
        yield batch(totals, [seen.tolist()], [times.tolist()])

    pairs = dealt(texts.mapInArrow(count_pairs, _BLOB_DDL)).mapInArrow(
        write_pairs, "shard int, ids binary, cont binary, n1 binary, n2 binary, n3 binary, times binary")
    ends = dealt(pairs).mapInArrow(write_stats, "t array<long>, times array<long>").collect()                # a row per shard
    t = np.sum([r.t for r in ends] or [np.zeros(5)], axis=0)
    times = np.sum([r.times for r in ends] or [np.zeros(8)], axis=0)
    return Model(folder, shards, offsets, sum(r.tokens for r in got), sum(r.texts for r in got), tuple(int(x) for x in times[5:8]),
                 discounts(times[:4]), discounts(t[:4]), int(times[4]), np.array([t[0], t[1], t[4]]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", extra: dict | None = None) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score (log10) of every row, after the ``extra`` boolean columns."""
    extra = extra or {}
    names = list(extra)
    ddl = "doc_id long, " + "".join(f"{n} boolean, " for n in names) + "n_tokens long, n_known long, train_tokens long, base_score double, score double"
    kind = pa.schema([("doc_id", pa.int64()), *[(n, pa.bool_()) for n in names], ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                      ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *[c.alias(n) for n, c in extra.items()], F.col(text_col).alias("t"))

    def run(batches):
        for whole in batches:
            for i in range(0, whole.num_rows, SLICE):
                b = whole.slice(i, SLICE)
                h, offs = _tokens(b.column(len(names) + 1))
                ids, c = model.ids(h)
                first = np.zeros(len(h), bool)
                first[offs[:-1]] = True
                base = np.log10((c + 1) / (model.tokens + model.vocabulary + 1))
                p = model.log10(ids, c, first)
                at = offs[:-1]
                yield batch(kind, *b.columns[:len(names) + 1], np.diff(offs), np.add.reduceat((c > 0).astype(np.int64), at),
                            np.full(b.num_rows, model.tokens), np.add.reduceat(base, at), np.add.reduceat(p, at))

    return rows.mapInArrow(run, ddl)


def held_out(id_col: str = "doc_id"):
    """Rows kept from training: crc32 of the id's text leaves 2 modulo 7."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 7 == 2
