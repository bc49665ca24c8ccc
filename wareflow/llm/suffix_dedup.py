"""Repeated strings by a distributed, common-prefix-aware merge of suffix runs.

Every byte covered by a string of ``length`` bytes that also starts elsewhere
is removed. A sparse suffix array is enough: each window of ``length`` bytes is
assigned to one anchor inside it, the k-byte gram with the smallest hash, which
depends on the window's bytes alone, so equal windows have equal anchors at
equal places. The suffixes sorted are those at anchors, with the bytes before
the anchor reversed behind them; an anchor's record reaches as far as its
windows do, no further.

1. Tasks find the anchors of their texts; anchors whose gram stands nowhere
   else are dropped (an aggregation by gram hash and a join that can split).
2. Tasks sort the suffixes of the live anchors, front-code them (shared prefix
   with the one before, then the rest) and deal the runs by gram hash. Equal
   suffixes of a run travel once.
3. The owner of a bucket merges its runs by a loser tree that carries the known
   common prefix of each head with the last output, so bytes found equal are
   never compared again. Neighbours share the longest prefixes; what they leave
   open is settled inside the group of one gram: by all pairs in groups of up
   to ``PAIRS`` suffixes, beyond that by the fingerprints of all their windows.
   The union of an anchor's repeated windows is one interval around it.
   A gram with more than ``HOT`` anchors has no owner: its suffixes stay in parts
   of bounded size, and fingerprints of their windows are dealt out by value and
   counted. First those of cores, which all of ``CORE`` neighbouring windows hold,
   then those of the windows around the cores that stand elsewhere too.
4. Intervals are joined to the texts, merged and cut out.

Null and empty texts have no windows; so have texts shorter than ``length``.
Null or repeated ids and repeated rows are rows of their own (a repeated row
repeats every string of it). An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareflow.llm.common import batch, kept
from wareflow.llm.textblock import _powers, _raw, distinct, group, lookup, mix, spread, text_bytes

LENGTH = 400
GRAM = 96
PAIRS = 48
HOT = 2048
PART = 4096
CORE = 16
BLOCK = 1 << 20


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, k: int):
    """(text, gram hash, anchor, first window, last window) of every anchor, positions in ``data``."""
    out = [[], [], [], [], []]
    sizes = np.diff(offsets)
    i, n = 0, len(sizes)
    while i < n:
        if sizes[i] < length:
            i += 1
            continue
        j = i + 1
        while j < n and offsets[j + 1] - offsets[i] <= BLOCK:
            j += 1
        starts = range(int(offsets[i]), int(offsets[j]), BLOCK) if j == i + 1 else (int(offsets[i]),)
        for lo in starts:                    # a long text goes block by block of window starts
            hi = min(int(offsets[j]), lo + BLOCK + length - 1) if j == i + 1 else int(offsets[j])
            if hi - lo >= length:
                for c, v in zip(out, _anchors(data[lo:hi], offsets[i:j + 1] - lo, i, lo, length, k)):
                    c.append(v)
        i = j
    return [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]


def _anchors(part, offs, first, lo, length, k):
    w, n = length - k + 1, len(part)
    power, inverse = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_raw[part] * power[:-1], out=sums[1:])
    h = mix((sums[k:] - sums[:-k]) * inverse[:n - k + 1])
    low = np.uint64(0xFFFFFF)
    v = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    full = np.full(-(-len(v) // w) * w, ~np.uint64(0))
    full[:len(v)] = v
    rows = full.reshape(-1, w)
    head = np.minimum.accumulate(rows, axis=1).ravel()
    tail = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - length + 1                   # window starts
    best = (np.minimum(tail[:count], head[w - 1:w - 1 + count]) & low).astype(np.int64)
    doc = np.searchsorted(offs, np.arange(count), "right") - 1
    ok = np.flatnonzero(np.arange(count) + length <= offs[np.minimum(doc + 1, len(offs) - 1)])
    doc, best = doc[ok], best[ok]
    new = np.ones(len(ok), bool)
    new[1:] = (best[1:] != best[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    end = np.append(at[1:], len(ok)) - 1
    p = best[at]
    return doc[at] + first, h[p].view(np.int64), p + lo, ok[at] + lo, (ok[end] + lo) if len(ok) else ok


class Suffixes:
    """Keys of ``length`` bytes from the anchor on (zero-padded), then the bytes before it, reversed."""

    def __init__(self, length: int, k: int):
        self.right, self.left = length, length - k
        self.width = self.right + self.left
        self.core = CORE

    def keys(self, data, p, left, right):
        out = np.zeros((len(p), self.width), np.uint8)
        if len(p):
            r = spread(p, right)
            rows = np.repeat(np.arange(len(p)), right)
            out[rows, r - np.repeat(p, right)] = data[r]
            back = spread(p - left, left)
            rows = np.repeat(np.arange(len(p)), left)
            out[rows, self.right + np.repeat(p, left) - 1 - back] = data[back]
        return out


def front_code(keys: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Shared prefix with the key before, and the rests one after another; keys sorted."""
    n, width = keys.shape
    lcp = np.zeros(n, np.uint16)
    if n > 1:
        differ = keys[1:] != keys[:-1]
        lcp[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    rest = np.arange(width)[None, :] >= lcp[:, None]
    return lcp, keys[rest].tobytes()


def front_decode(lcp: np.ndarray, rest: bytes, width: int) -> list[bytes]:
    out, at, before = [], 0, b""
    for c in lcp.tolist():
        before = before[:c] + rest[at:at + width - c]
        at += width - c
        out.append(before)
    return out


def merge(runs: list[tuple[list[int], list[bytes]]]):
    """Merge sorted runs of (lcps, keys): yields (run, index, lcp with the key before).

    A loser tree. Each head carries its common prefix with the last output. Of
    two heads the one with the longer known prefix is smaller, and the other's
    prefix stays right; only heads with equal prefixes are compared, from there on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    pos = [0] * k
    head: list[bytes | None] = [runs[r][1][0] if r < len(runs) and runs[r][1] else None for r in range(k)]
    known = [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        x, y = head[a], head[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        c = known[a]
        if x == y:
            known[max(a, b)] = len(x)
            return (a, b) if a < b else (b, a)
        lo, hi = c, len(x)                  # first difference at or after c, by halving
        while hi - lo > 1:
            mid = (lo + hi) // 2
            if x[lo:mid] == y[lo:mid]:
                lo = mid
            else:
                hi = mid
        if x[lo] < y[lo]:
            known[b] = lo
            return a, b
        known[a] = lo
        return b, a

    loser = [0] * k
    level = list(range(k))
    at = k
    while len(level) > 1:                   # first round
        at //= 2
        won = []
        for i in range(0, len(level), 2):
            w, l = play(level[i], level[i + 1])
            loser[at + i // 2] = l
            won.append(w)
        level = won
    best = level[0]
    while head[best] is not None:
        yield best, pos[best], known[best]
        lcps, keys = runs[best]
        pos[best] += 1
        if pos[best] < len(keys):
            head[best], known[best] = keys[pos[best]], lcps[pos[best]]
        else:
            head[best] = None
        node = (best + k) // 2
        while node:
            best, loser[node] = play(best, loser[node])
            node //= 2


def reach(keys: np.ndarray, lcp: np.ndarray, left: np.ndarray, right: np.ndarray, copies: np.ndarray, s: Suffixes, k: int):
    """Bytes before and after each anchor that its repeated windows cover (0, 0: none); keys sorted and distinct."""
    n = len(keys)
    far_l, far_r = np.where(copies > 1, left, 0), np.where(copies > 1, right, 0)
    if n < 2:
        return far_l, far_r
    tied = lcp[1:] >= k
    pr = np.minimum(lcp[1:], np.minimum(right[1:], right[:-1]))
    pl = _same(keys[1:, s.right:], keys[:-1, s.right:], np.minimum(left[1:], left[:-1]))
    ok = tied & (pl + pr >= s.right)
    for a, b in ((slice(1, None), slice(None, -1)), (slice(None, -1), slice(1, None))):
        far_l[a] = np.maximum(far_l[a], np.where(ok, pl, 0))
        far_r[a] = np.maximum(far_r[a], np.where(ok, pr, 0))
    done = (far_l == left) & (far_r == right)
    bound = np.flatnonzero(np.concatenate(([True], ~tied, [True])))
    start, size = bound[:-1], np.diff(bound)
    opened = np.add.reduceat(~done, start) if n else np.zeros(0)
    for a, m in zip(start[(size > 2) & (opened > 0)].tolist(), size[(size > 2) & (opened > 0)].tolist()):
        part = slice(a, a + m)
        solve = _pairs if m <= PAIRS else _windows
        l, r = solve(keys[part], lcp[part], left[part], right[part], s)
        far_l[part], far_r[part] = np.maximum(far_l[part], l), np.maximum(far_r[part], r)
    return far_l, far_r


def _same(x, y, most):
    differ = x != y
    return np.minimum(np.where(differ.any(axis=1), differ.argmax(axis=1), x.shape[1]), most) if x.shape[1] else np.zeros(len(x), np.int64)


def _pairs(keys, lcp, left, right, s):
    m = len(keys)
    i, j = np.triu_indices(m, 1)
    run = np.full((m, m), 1 << 20)
    for d in range(1, m):
        run[np.arange(m - d), np.arange(d, m)] = np.minimum(run[np.arange(m - d), np.arange(d, m) - 1], lcp[d:])
    r = np.minimum(run[i, j], np.minimum(right[i], right[j]))
    l = _same(keys[i, s.right:], keys[j, s.right:], np.minimum(left[i], left[j]))
    ok = l + r >= s.right
    far_l, far_r = np.zeros(m, np.int64), np.zeros(m, np.int64)
    for x in (i[ok], j[ok]):
        np.maximum.at(far_l, x, l[ok])
        np.maximum.at(far_r, x, r[ok])
    return far_l, far_r


def _windows(keys, lcp, left, right, s):
    """The same from 64-bit fingerprints of every window of the group, linear in its suffixes."""
    m, length = len(keys), s.right
    text = np.concatenate((keys[:, s.right:][:, ::-1], keys[:, :s.right]), axis=1)     # reading order, anchor at s.left
    far_l, far_r = np.zeros(m, np.int64), np.zeros(m, np.int64)
    power, inverse = _powers(s.width + 1)
    sums = np.zeros((m, s.width + 1), np.uint64)
    np.cumsum(_raw[text] * power[:-1], axis=1, out=sums[:, 1:])
    for l in range(s.left + 1):
        at = s.left - l
        has = np.flatnonzero((left >= l) & (right >= length - l))
        if len(has) < 2:
            continue
        h = (sums[has, at + length] - sums[has, at]) * inverse[at]
        u, _, back = group(h)
        twice = has[(np.bincount(back, minlength=len(u)) > 1)[back]]
        far_l[twice] = l
        far_r[twice] = np.maximum(far_r[twice], length - l)
    return far_l, far_r


def _print(sums: np.ndarray, a: int, b: int) -> np.ndarray:
    """Fingerprints of the bytes [a, b) of every row, in reading order, and of the place."""
    return mix((sums[:, b] - sums[:, a]) * _powers(sums.shape[1])[1][a] + np.uint64((a << 16 | b) * 0x9E3779B97F4A7C55 % (1 << 64)))


def cores(sums, left, right, s: Suffixes):
    """(there, fingerprints) of what the windows of each run of ``core`` places have in common."""
    first = range(0, s.left + 1, s.core)
    last = [min(a + s.core - 1, s.left) for a in first]
    there = np.stack([np.maximum(a, s.right - right) <= np.minimum(b, left) for a, b in zip(first, last)], axis=1)
    return there, np.stack([_print(sums, s.left - a, s.left + s.right - b) for a, b in zip(first, last)], axis=1)


def windows(sums, left, right, s: Suffixes):
    """(there, fingerprints) of the windows that start 0, 1, ... bytes before each anchor."""
    there = np.stack([(left >= l) & (right >= s.right - l) for l in range(s.left + 1)], axis=1)
    return there, np.stack([_print(sums, s.left - l, s.left - l + s.right) for l in range(s.left + 1)], axis=1)


def _slices(row: dict, s: Suffixes):
    """(slice, prefix sums, left, right) of the suffixes of a part, some at a time."""
    lcp = np.frombuffer(row["lcp"], np.uint16)
    keys = np.frombuffer(b"".join(front_decode(lcp, row["rest"], s.width)), np.uint8).reshape(-1, s.width)
    left, right = (np.frombuffer(row[c], np.uint16).astype(np.int64) for c in ("left", "right"))
    for i in range(0, len(keys), 512):
        z = slice(i, i + 512)
        text = np.concatenate((keys[z, s.right:][:, ::-1], keys[z, :s.right]), axis=1)
        sums = np.zeros((len(text), s.width + 1), np.uint64)
        np.cumsum(_raw[text] * _powers(s.width + 1)[0][:-1], axis=1, out=sums[:, 1:])
        yield z, sums, left[z], right[z]


def _known(row: dict) -> np.ndarray:
    return np.sort(np.concatenate([np.frombuffer(x, np.uint64) for x in row["again"]]))


def joined(row: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """(row, lo, hi) with the intervals of a row that touch made one."""
    order = np.lexsort((lo, row))
    row, lo, hi = row[order], lo[order].astype(np.int64), hi[order].astype(np.int64)
    if not len(row):
        return row, lo, hi
    base = np.cumsum(np.concatenate(([0], row[1:] != row[:-1]))) << 32
    top = np.maximum.accumulate(base + hi)
    first = np.flatnonzero(np.concatenate(([True], (base + lo)[1:] > top[:-1])))
    last = np.append(first[1:], len(row)) - 1
    return row[first], lo[first], (top - base)[last]


def hot_spans(hot: DataFrame, s: Suffixes, buckets: int) -> DataFrame:
    """row, lo, hi of the repeated intervals of parts of suffixes, whichever part the other copy is in; those of a part joined."""
    sent = pa.schema([("part", pa.int64()), ("bucket", pa.int32()), ("prints", pa.binary()), ("n", pa.binary())])
    back = pa.schema([("part", pa.int64()), ("prints", pa.binary())])
    span = pa.schema([("row", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])

    def deal(part, prints, copies):
        u, _, at = group(prints)
        n = np.minimum(np.bincount(at, copies, len(u)), 2).astype(np.uint8)
        which = (u % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(which, kind="stable")
        full, size = distinct(which.astype(np.uint64))
        cut = np.concatenate(([0], np.cumsum(size)))
        rows = [order[a:b] for a, b in zip(cut[:-1], cut[1:])]
        return batch(sent, np.full(len(rows), part), full.astype(np.int32), [u[r].tobytes() for r in rows], [n[r].tobytes() for r in rows])

    def send(wanted):
        def run(batches):
            for b in batches:
                for i in range(b.num_rows):
                    row = b.slice(i, 1).to_pylist()[0]
                    copies, prints, n = np.frombuffer(row["copies"], np.int32), [], []
                    known = _known(row) if "again" in row else None
                    for z, sums, left, right in _slices(row, s):
                        there, h = wanted(sums, left, right, s, known)
                        prints.append(h[there])
                        n.append(np.repeat(copies[z], there.sum(axis=1)))
                    yield deal(row["part"], np.concatenate(prints), np.concatenate(n))
        return run

    def count(batches):
        parts, prints, n = [], [], []
        for b in batches:
            parts += b.column(0).to_pylist()
            prints += [np.frombuffer(x, np.uint64) for x in b.column(2).to_pylist()]
            n += [np.frombuffer(x, np.uint8) for x in b.column(3).to_pylist()]
        if parts:
            u, _, at = group(np.concatenate(prints))
            twice = (np.bincount(at, np.concatenate(n), len(u)) > 1)[at]
            cut = np.concatenate(([0], np.cumsum([len(x) for x in prints])))
            for i in range(0, len(parts), 256):
                j = min(i + 256, len(parts))
                yield batch(back, parts[i:j], [x[twice[cut[q]:cut[q + 1]]].tobytes() for q, x in enumerate(prints[i:j], i)])

    def again(rows, wanted):
        got = (rows.mapInArrow(send(wanted), "part long, bucket int, prints binary, n binary").repartitionById(buckets, F.col("bucket"))
               .mapInArrow(count, "part long, prints binary"))
        return hot.join(got.where(F.length("prints") > 0).groupBy("part").agg(F.collect_list("prints").alias("again")), "part")

    def every_core(sums, left, right, s, _):
        return cores(sums, left, right, s)

    def around_cores(sums, left, right, s, known):
        there, h = cores(sums, left, right, s)
        alive = there & (lookup(known, h.ravel()).reshape(h.shape) >= 0)
        there, h = windows(sums, left, right, s)
        return there & alive[:, np.arange(s.left + 1) // s.core], h

    def cover(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                known, copies = _known(row), np.frombuffer(row["copies"], np.int32)
                rows, at = np.frombuffer(row["row"], np.int64), np.frombuffer(row["at"], np.int32)
                ends, out = np.concatenate(([0], np.cumsum(copies))), [[], [], []]
                for z, sums, left, right in _slices(row, s):
                    there, h = windows(sums, left, right, s)
                    hit = there & (lookup(known, h.ravel()).reshape(h.shape) >= 0)
                    some = np.repeat(hit.any(axis=1), copies[z])
                    lo = np.repeat(s.left - hit[:, ::-1].argmax(axis=1), copies[z])[some]
                    hi = np.repeat(s.right - hit.argmax(axis=1), copies[z])[some]
                    own = slice(ends[z.start], ends[min(z.stop, len(copies))])
                    for c, v in zip(out, (rows[own][some], at[own][some] - lo, at[own][some] + hi)):
                        c.append(v)
                which, lo, hi = joined(*(np.concatenate(c) for c in out))
                yield batch(span, which, lo.astype(np.int32), hi.astype(np.int32))

    return again(again(hot, every_core), around_cores).mapInArrow(cover, "row long, lo int, hi int")


def _runs(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Overlapping and touching intervals as maximal runs."""
    merged: list[list[int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    return merged


def _left(data: bytes, runs: list[list[int]]) -> bytes:
    """The bytes outside the runs."""
    ends = [0, *(b for _, b in runs)]
    return b"".join(data[a:b] for a, b in zip(ends, [*(a for a, _ in runs), len(data)]))


def _digest(data: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, str]:
    """Removed bytes, maximal removed runs, and the checksum of what is left."""
    runs = _runs(spans)
    return sum(b - a for a, b in runs), len(runs), hashlib.sha256(_left(data, runs)).hexdigest()


def repeated_spans(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", length: int = LENGTH, k: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """(held, spans): held has every row (row, doc_id, n_bytes, sha, text where it has live anchors);
    spans are the repeated intervals (row, lo, hi), overlapping ones not merged."""
    s = Suffixes(length, k)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("t"))
    rows = rows.withColumn("check", F.xxhash64("t"))
    kind = pa.schema([("gram", pa.int64()), ("row", pa.int64()), ("check", pa.int64()), ("at", pa.int32()), ("lefts", pa.int16()), ("rights", pa.int16())])

    def find(batches):
        for b in batches:
            data, offs = text_bytes(b.column(2))
            doc, gram, p, w0, w1 = anchors(data, offs, length, k)
            names, checks = b.column(0).to_numpy(), b.column(3).to_numpy()
            for i in range(0, len(doc), 1 << 17):
                d, z = doc[i:i + (1 << 17)], slice(i, i + (1 << 17))
                yield batch(kind, gram[z], names[d], checks[d], (p[z] - offs[d]).astype(np.int32),
                            (p[z] - w0[z]).astype(np.int16), (w1[z] + length - p[z]).astype(np.int16))

    found = rows.mapInArrow(                 # all columns, so that both reads of the input have one plan
        find, "gram long, row long, check long, at int, lefts short, rights short")
    found = kept(found, "anchors")
    # a table of its own: an aggregate right below the join would keep a hot gram's rows in one task
    live = kept(found.groupBy("gram").count().where("count > 1").select("gram", (F.col("count") > HOT).alias("hot")), "live-grams")
    mine = (found.join(live, "gram").groupBy("row", "check")
            .agg(F.collect_list(F.struct("gram", "at", "lefts", "rights", "hot")).alias("live")))       # a text's own anchors
    held = rows.join(mine.withColumnRenamed("check", "was"), "row", "left").select(
        "row", "doc_id", F.length("t").cast("long").alias("n_bytes"), F.when(F.col("live").isNull(), F.sha2("t", 256)).alias("sha"),
        F.when(F.col("live").isNotNull(), F.col("t")).alias("t"), "live",
        F.when(F.col("was") != F.col("check"), F.raise_error(F.lit("input rows moved between two reads"))).alias("moved"))
    held = kept(held, "held")

    run = pa.schema([("bucket", pa.int64()), ("n", pa.int64()), ("lcp", pa.binary()), ("rest", pa.binary()), ("left", pa.binary()),
                     ("right", pa.binary()), ("copies", pa.binary()), ("row", pa.binary()), ("at", pa.binary())])
    buckets = max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def sort_runs(batches):
        for b in batches:
            step = 2000
            for z in range(0, b.num_rows, step):
                yield from runs_of(b.slice(z, step))

    def anchors_of(b):
        data, offs = text_bytes(b.column(1))
        lists = b.column(2)
        flat = lists.flatten()
        n = np.diff(lists.offsets.to_numpy())
        doc = np.repeat(np.arange(b.num_rows), n)
        gram, at, left, right = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
        return data, offs, doc, gram, at, left, right, b.column(0).to_numpy()

    def runs_of(b):
        data, offs, doc, gram, at, left, right, names = anchors_of(b)
        which = (mix(gram.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(which, kind="stable")
        cut = np.searchsorted(which[order], np.arange(buckets + 1))
        for g in range(buckets):
            part = order[cut[g]:cut[g + 1]]
            if not len(part):
                continue
            yield coded(g, data, offs, doc[part], at[part], left[part], right[part], names)

    def hot_parts(batches):
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            for z in range(0, b.num_rows, 2000):
                data, offs, doc, _, at, left, right, names = anchors_of(b.slice(z, 2000))
                for i in range(0, len(doc), PART):
                    part = slice(i, i + PART)
                    yield coded(number, data, offs, doc[part], at[part], left[part], right[part], names)
                    number += 1

    def coded(g, data, offs, d, at, left, right, names):
        l, r = left.astype(np.int64), right.astype(np.int64)
        keys = s.keys(data, offs[d] + at, l, r)
        # equal keys with equal reach travel once
        tagged = np.concatenate((keys, l.astype(">u2").view(np.uint8).reshape(-1, 2), r.astype(">u2").view(np.uint8).reshape(-1, 2)), axis=1)
        view = np.ascontiguousarray(tagged).view(f"V{tagged.shape[1]}").ravel()
        by = np.argsort(view, kind="stable")
        same = view[by][1:] == view[by][:-1]
        first = np.flatnonzero(np.concatenate(([True], ~same)))
        one = by[first]
        lcp, rest = front_code(keys[one])
        return batch(run, [g], [len(one)], [lcp.tobytes()], [rest], [l[one].astype(np.uint16).tobytes()], [r[one].astype(np.uint16).tobytes()],
                     [np.diff(np.append(first, len(by))).astype(np.int32).tobytes()], [names[d][by].tobytes()], [at[by].astype(np.int32).tobytes()])

    span = pa.schema([("row", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])

    def merge_bucket(batches):
        bucket, got = None, []
        for b in batches:
            for r in b.to_pylist():
                if bucket is not None and r["bucket"] != bucket:
                    yield from spans_of(got)
                    got = []
                bucket = r["bucket"]
                got.append(r)
        if got:
            yield from spans_of(got)

    def spans_of(got):
        runs, parts = [], []
        for r in got:
            lcp = np.frombuffer(r["lcp"], np.uint16)
            runs.append((lcp.tolist(), front_decode(lcp, r["rest"], s.width)))
            copies = np.frombuffer(r["copies"], np.int32)
            parts.append((np.frombuffer(r["left"], np.uint16), np.frombuffer(r["right"], np.uint16), copies,
                          np.frombuffer(r["row"], np.int64), np.frombuffer(r["at"], np.int32), np.concatenate(([0], np.cumsum(copies)))))
            r.clear()
        base = np.concatenate(([0], np.cumsum([len(x[1]) for x in runs])))
        order, lcps = [], []
        for r, i, c in merge(runs):
            order.append(base[r] + i)
            lcps.append(c)
        order, lcps = np.array(order), np.array(lcps)
        keys = np.frombuffer(b"".join(runs[int(np.searchsorted(base, o, "right")) - 1][1][o - base[np.searchsorted(base, o, "right") - 1]] for o in order.tolist()), np.uint8)
        keys = keys.reshape(-1, s.width)
        left, right, copies = (np.concatenate([x[j] for x in parts]).astype(np.int64)[order] for j in range(3))
        # equal keys from several runs, with equal reach, are one suffix
        by = _classes(lcps, left, right, s.width)
        u = np.flatnonzero(np.concatenate(([True], by[1:] != by[:-1])))
        total = np.add.reduceat(copies, u)
        step = lcps[u].copy()
        l, r = reach(keys[u], step, left[u], right[u], total, s, k)
        l, r = l[by], r[by]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        for q, x in enumerate(parts):
            mine = back[base[q]:base[q + 1]]
            each = np.repeat(mine, x[2])
            hit = np.flatnonzero(r[each] > 0)
            yield batch(span, x[3][hit], (x[4][hit] - l[each[hit]]).astype(np.int32), (x[4][hit] + r[each[hit]]).astype(np.int32))

    coded_ddl = "n long, lcp binary, rest binary, left binary, right binary, copies binary, row binary, at binary"

    def with_anchors(which):
        return held.select("row", "t", F.expr(f"filter(live, x -> {which})").alias("live")).where("size(live) > 0")

    dealt = with_anchors("not x.hot").mapInArrow(sort_runs, f"bucket long, {coded_ddl}").repartitionById(buckets, F.col("bucket").cast("int"))
    spans = dealt.mapInArrow(merge_bucket, "row long, lo int, hi int")
    if not live.where("hot").isEmpty():
        hot = kept(with_anchors("x.hot").mapInArrow(hot_parts, f"part long, {coded_ddl}"), "hot-suffixes")
        spans = spans.unionByName(hot_spans(hot, s, buckets))
    return held, spans


def _classes(lcps, left, right, width):
    """Class number of each key in merged order; equal keys of equal reach that stand together share one."""
    new = np.ones(len(lcps), bool)
    new[1:] = (lcps[1:] < width) | (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    return np.cumsum(new) - 1


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, k: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    held, spans = repeated_spans(docs, text_col, id_col, length, k)
    each = spans.groupBy("row").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    texts = held.where("live IS NOT NULL").select("row", "doc_id", "n_bytes", "t").join(each, "row", "left")
    kind = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def cut(batches):
        for b in batches:
            out = [_digest(t, [(x["lo"], x["hi"]) for x in sp or ()]) for t, sp in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield batch(kind, b.column(0), b.column(1), *([list(c) for c in zip(*out)] if out else [[], [], []]))

    changed = texts.select("doc_id", "n_bytes", "t", "spans").mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    whole = held.where("live IS NULL").select("doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
                                              F.col("sha").alias("kept_sha256"))
    return changed.unionByName(whole)


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, k: int = GRAM) -> DataFrame:
    """Every row of ``docs`` with its columns, the repeated passages cut out of its text.

    What is left of a character that was cut in two reads as U+FFFD. A null text stays null. Every read of ``docs`` must
    give the same rows in the same partitions, as file scans do.
    """
    _, spans = repeated_spans(docs, text_col, id_col, length, k)
    each = spans.groupBy(F.col("row").alias("at")).agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("t"), whole).join(each, F.col("row") == F.col("at"), "left")
    cut = rows.where("spans IS NOT NULL").select("whole", "t", "spans")
    kind = T.StructType([cut.schema["whole"], T.StructField("left", T.StringType())])

    def run(batches):
        for b in batches:
            left = [_left(t.encode(), _runs([(x["lo"], x["hi"]) for x in sp])).decode("utf-8", "replace")
                    for t, sp in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(left, pa.string())], names=["whole", "left"])

    def back(c: str):
        return F.col("left") if c == text_col else F.col(f"whole.`{c}`")

    done = cut.mapInArrow(run, kind).select(*[back(c).alias(c) for c in docs.columns])
    return done.unionByName(rows.where("spans IS NULL").select("whole.*"))
