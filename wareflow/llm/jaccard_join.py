"""Near duplicates by an exact n-gram Jaccard join over grouped prefixes.

A text's set is its distinct word shingles (hashed to 64 bits). Two texts link
where 100 * intersection >= 75 * union. Linked sets share a shingle in their
prefixes, the first n - ceil(0.75 n) + 1 shingles in one order of all shingles.
The order puts shingles that many texts share last: each task counts the
shingles of its texts, the counts are summed, and the most frequent, ``head`` at
most, are broadcast with their counts; all others come first, by hash. The
order changes the work alone: any order gives the same links.

1. Equal sets are one unit. Units with the same prefix and size are one group.
2. Groups are posted under their prefix shingles. An entry stays in a list if the
   sizes and places of the others allow it to hold its first common shingle with one of
   them; lists of two groups or more are kept. In each list one group is the hub.
3. Every group is verified against the hub it shares most lists with, and the
   units of one group against one of them, unless small bitmaps (step 5) rule the pair out; the
   links found give components. A group of copies thus costs one pair for each member, not all pairs.
4. Of the lists that still hold several components, those with the same units (texts share
   shingles in runs) are one. Each gets a hub, the unit that stands in
   most of them, then others turn by turn, and
   every unit one pair with a hub of another component, as long as half
   of the pairs that bitmaps (step 5) leave link. A group whose members link with some of each other
   only thus grows together at a few pairs a member. The components found so
   far are contracted: a turn joins roots, and only members of joined roots change.
5. Entries of lists that are still open carry parity bitmaps of the sets (the bits in which
   two differ never outnumber the shingles in which they do). A task that holds a list thus rules
   out pairs before it makes them: those whose sizes and places in the list do not allow it to hold
   their first common shingle, and those whose bitmaps differ too much.
6. Turn by turn, every unit outside a list's largest component gets one pair with the unit of another
   component that its bitmap is nearest to, as long as a fifth of these pairs links. A component
   thus joins another at a pair a member, however many of their members link.
7. All pairs of units from different components that are still not ruled out are verified. No pair
   that could join two components is left out, so the components are exact.

Lists of up to ``LONG`` entries are written together and sorted once; a turn of step 4 reads
them where they are. Longer ones stay dealt over all tasks: their hubs are found by
an aggregation and sent to the entries. In steps 5 to 7 they are met by pairs of
blocks, each a group of its own, so that no task holds a whole long list.

The candidates, one text of each unit that stands in a pair or list, are written with their bitmaps by the
tasks that read them: a bit for each row says whether it is one, so that no text is moved for that.
Verification moves the texts of the units in question to their hub, dealt over
several tasks when a hub has many, and compares the whole sets.

Null and empty texts have no shingles, link with nothing and are components of
their own. Texts of fewer words than a shingle have one, the whole sequence.
Null ids take part in linking; a component's id is its smallest id that is not
null (null if there is none). Repeated rows are equal sets; rows that share an id
are linked row by row. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wareflow.llm.common import batch, discard, kept, tidy
from wareflow.llm.textblock import distinct, lookup, mix, ngrams, text_bytes, words
from wareflow.operators.keys import per_key
from wareflow.operators.measure import fits_broadcast

K = 5
NUM, DEN = 75, 100
HEAD = 1 << 18
SLICE = 1000
HUB_PART = 512
#: Turns of one pair a unit, with hubs and then with the nearest units, before the pairs that are left are all made.
TURNS = 8
#: Entries of a list that one task may hold.
LONG = 4096
#: Bounds of what is broadcast (rows, bytes); beyond them the same joins shuffle.
SENT_ROWS, SENT_BYTES = 2_000_000, 128 << 20
_U = np.uint64


def sets(col, k: int):
    """(offsets, shingles): the sorted distinct shingles of every text, worked out ``SLICE`` texts at a time."""
    size, out = [], []
    for z in range(0, len(col), SLICE):
        h, _, _, offs = words(*text_bytes(col.slice(z, SLICE)))
        g, doc, _ = ngrams(h, offs, k)
        at = np.searchsorted(doc, np.arange(len(offs)))
        del h, doc
        for a, b in zip(at, at[1:]):
            s = np.sort(g[a:b])
            s = s[np.concatenate(([True], s[1:] != s[:-1]))] if len(s) else s
            out.append(s)
            size.append(len(s))
    return np.concatenate(([0], np.cumsum(size))).astype(np.int64), np.concatenate(out) if out else np.zeros(0, np.uint64)


def signature(offs: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """64 bits of each set, whatever the order of its members."""
    out = np.zeros(len(offs) - 1, np.int64)
    for z in range(0, len(out), SLICE):
        at = offs[z:z + SLICE + 1]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(flat[at[0]:at[-1]] ^ _U(0x5851F42D4C957F2D)))))
        at = at - at[0]
        out[z:z + SLICE] = mix(sums[at[1:]] - sums[at[:-1]] + np.diff(at).astype(np.uint64)).view(np.int64)
    return out


def links(x: np.ndarray, y: np.ndarray, num: int = NUM, den: int = DEN) -> bool:
    if min(len(x), len(y)) * den < num * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return den * both >= num * (len(x) + len(y) - both)


def prefix_size(n, num: int, den: int):
    return n - -(-num * n // den) + 1


def parity(s: np.ndarray, more: int = 0) -> bytes:
    """Parities of the shingles in each of 2**b buckets, as many as the shingles or more; 2**``more`` times as many, up to 2**16."""
    least = max(6, int(len(s) - 1).bit_length())
    bits = 1 << max(least, min(least + more, 16))
    odd = np.bincount((s & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def may_link(nx: int, px: bytes, ny: int, py: bytes, num: int, den: int) -> bool:
    """False only if the differing parities alone rule the link out."""
    if min(nx, ny) * den < num * max(nx, ny):
        return False
    x, y = np.frombuffer(px, np.uint8), np.frombuffer(py, np.uint8)
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    differ = int(np.bitwise_count(x ^ y).sum())
    # |x^y| >= differ, so the intersection is at most (nx + ny - differ) / 2
    both = (nx + ny - differ) // 2
    return den * both >= num * (nx + ny - both)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each connected component of edges (a, b); by alternating stars."""
    now = kept(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
                 .where("a <> b").distinct())
        old, now = now, kept(small, "edges")
        discard(old)
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            out = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            out._kept_at = now._kept_at
            return out
        before = mark


def _sent(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it is measured to be small; else a join shuffles it."""
    return F.broadcast(df) if fits_broadcast(df, SENT_ROWS, SENT_BYTES) else df


def _only(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows (sig, ...) of units that stand in ``pairs``, so that no others are shuffled for them."""
    named = pairs.select(F.explode(F.array("a", "b")).alias("sig")).distinct()
    return rows.join(_sent(named), "sig", "left_semi")


def _order(seen: DataFrame, head: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, counts) of the most frequent shingles, ``head`` at most."""
    level = F.floor(F.log2("count") * 4)
    sizes = sorted(((r[0], r[1]) for r in seen.groupBy(level).count().collect()), reverse=True)     # a few hundred levels
    least, total = None, 0
    for lev, n in sizes:
        if total + n > head:
            break
        least, total = lev, total + n
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    got = seen.where(level >= least).select("hash", "count").toArrow()
    h, c = got.column(0).to_numpy().view(np.uint64), got.column(1).to_numpy()
    by = np.argsort(h)
    return h[by], c[by]


def _survey(rows: DataFrame, k: int) -> DataFrame:
    """Rows (row, doc_id, n, sig) of all texts, and rows (hash, count) of shingles that a batch holds in several texts."""
    kind = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("sig", pa.int64()), ("hash", pa.int64()), ("count", pa.int64())])

    def run(batches):
        for b in batches:
            offs, flat = sets(b.column(2), k)
            n, sig = np.diff(offs), signature(offs, flat)
            none = pa.nulls(b.num_rows, pa.int64())
            yield batch(kind, b.column(0), b.column(1), n, sig, none, none)
            flat.sort()
            u, c = distinct(flat[1:][flat[1:] == flat[:-1]])     # each occurrence but the first
            none = pa.nulls(len(u), pa.int64())
            yield batch(kind, none, none, none, none, u.view(np.int64), c + 1)

    return rows.mapInArrow(tidy(run), "row long, doc_id long, n long, sig long, hash long, count long")


def _runs(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the runs of equal names."""
    start = np.flatnonzero(np.concatenate((names[:1] == names[:1], names[1:] != names[:-1])))
    return start, np.diff(np.append(start, len(names)))


def _partnered(start, size, n, pos, num: int, den: int) -> np.ndarray:
    """False for entries whose list has no other that may link with them and has its first common shingle there.

    Such an entry is of at most ``most`` shingles and may itself have a partner of this entry's size (:func:`_first_common`).
    """
    if not len(n):
        return np.zeros(0, bool)
    most = (num + den) * (n - pos) // num - n
    name = np.repeat(np.arange(len(start)), size)

    def least(v):
        """The smallest value of the other entries in the list."""
        order = np.lexsort((v, name))
        out = np.repeat(v[order[start]], size)
        out[order[start]] = np.where(size > 1, v[order[np.minimum(start + 1, len(v) - 1)]], 1 << 40)
        return out

    return (least(n) <= most) & (n <= -least(-most))


def _posted(rows: DataFrame, k: int, num: int, den: int, heavy, buckets: int) -> DataFrame:
    """Kept lists (list, grp, n, hub) and the units of each group (grp, sig, n)."""
    shared = rows.sparkSession.sparkContext.broadcast(heavy)
    blob = pa.schema([("bucket", pa.int32()), ("grp", pa.binary()), ("n", pa.binary()), ("sig", pa.binary()), ("count", pa.binary()), ("high", pa.binary()), ("low", pa.binary()), ("pos", pa.binary())])

    def post(batches):
        often, times = shared.value
        for b in (whole.slice(z, 2 * SLICE) for whole in batches for z in range(0, whole.num_rows, 2 * SLICE)):
            offs, flat = sets(b.column(2), k)
            sig = signature(offs, flat)
            _, first = np.unique(sig, return_index=True)
            at = lookup(often, flat)
            rank = np.where(at >= 0, times[at] if len(times) else 0, 0)
            prefixes, size, sigs = [], [], []
            for i in first.tolist():
                a, z = offs[i], offs[i + 1]
                if a == z:
                    continue
                p = prefix_size(z - a, num, den)
                r = rank[a:z]
                s = flat[a:z]
                if r.any():
                    s = s[np.lexsort((s, r))[:p]]
                prefixes.append(s[:p])
                size.append(z - a)
                sigs.append(sig[i])
            if not prefixes:
                continue
            size, sigs = np.array(size), np.array(sigs)
            many = np.array([len(x) for x in prefixes])
            tokens = np.concatenate(prefixes)
            ends = np.concatenate(([0], np.cumsum(many)))
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(tokens))))
            grp = mix(sums[ends[1:]] - sums[ends[:-1]] + size.astype(np.uint64) * _U(0x9E3779B97F4A7C15))
            _, one = np.unique(grp, return_index=True)          # a group is posted once
            posted = np.zeros(len(grp), bool)
            posted[one] = True
            owner = np.repeat(np.arange(len(grp)), many)
            place = np.arange(len(tokens)) - ends[owner]
            live = posted[owner]
            tokens, owner, place = tokens[live], owner[live], place[live]
            which = (tokens % _U(buckets)).astype(np.int64)
            order = np.argsort(which, kind="stable")
            cut = np.searchsorted(which[order], np.arange(buckets + 1))
            home = (grp % _U(buckets)).astype(np.int64)
            for g in range(buckets):
                part = order[cut[g]:cut[g + 1]]
                who, count = distinct(owner[part].astype(np.uint64))      # owners stand in order
                who = who.astype(np.int64)
                t = tokens[part]
                mine = np.flatnonzero(home == g)
                if len(part):
                    yield batch(blob, [g], [grp[who].tobytes()], [size[who].astype(np.int32).tobytes()], [None], [count.astype(np.int32).tobytes()],
                                [((t >> _U(24)) & _U(0xFFFFFFFF)).astype(np.uint32).tobytes()], [((t >> _U(16)) & _U(0xFF)).astype(np.uint8).tobytes()],
                                [place[part].astype(np.uint32).tobytes()])
                if len(mine):
                    yield batch(blob, [g], [grp[mine].tobytes()], [size[mine].astype(np.int32).tobytes()], [sigs[mine].tobytes()], [None], [None], [None], [None])

    kind = pa.schema([("list", pa.int64()), ("grp", pa.int64()), ("n", pa.int32()), ("hub", pa.int64()), ("sig", pa.int64()), ("pos", pa.int32())])

    def gather(batches):
        now, held = None, []
        for b in batches:
            for r in b.to_pylist():
                if now is not None and r["bucket"] != now:
                    yield from lists(now, held)
                    held = []
                now = r["bucket"]
                held.append(r)
        if held:
            yield from lists(now, held)

    def lists(bucket, held):
        units = [r for r in held if r["sig"] is not None]
        posts = [r for r in held if r["sig"] is None]
        if units:
            g, n, s = (np.concatenate([np.frombuffer(r[c], t) for r in units]) for c, t in (("grp", np.int64), ("n", np.int32), ("sig", np.int64)))
            order = np.lexsort((s, g))
            g, n, s = g[order], n[order], s[order]
            new = np.concatenate(([True], (g[1:] != g[:-1]) | (s[1:] != s[:-1])))
            none = pa.nulls(int(new.sum()), pa.int64())
            yield batch(kind, none, g[new], n[new], none, s[new], none.cast(pa.int32()))
        if not posts:
            return
        grp, n = (np.concatenate([np.frombuffer(r[c], t) for r in posts]) for c, t in (("grp", np.int64), ("n", np.int32)))
        count = np.concatenate([np.frombuffer(r["count"], np.int32) for r in posts])
        token = (np.concatenate([np.frombuffer(r["high"], np.uint32) for r in posts]).astype(np.uint64) << _U(8)
                 | np.concatenate([np.frombuffer(r["low"], np.uint8) for r in posts]))
        names, first, back = np.unique(grp, return_index=True, return_inverse=True)
        owner = np.repeat(back, count)
        place = np.concatenate([np.frombuffer(r["pos"], np.uint32) for r in posts]).astype(np.int32)
        order = np.lexsort((owner, token))
        token, owner, place = token[order], owner[order], place[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
        token, owner, place = token[new], owner[new], place[new]
        n = n[first]
        start, size = _runs(token)
        keep = np.repeat(size > 1, size)
        token, owner, place = token[keep], owner[keep], place[keep]
        keep = _partnered(*_runs(token), n[owner].astype(np.int64), place.astype(np.int64), num, den)
        token, owner, place = token[keep], owner[keep], place[keep]
        start, size = _runs(token)
        keep = np.repeat(size > 1, size)
        hub = np.repeat(owner[start], size)[keep]               # the smallest group name of the list
        token, owner, place = token[keep], owner[keep], place[keep]
        name = (token.astype(np.int64) << 20) | bucket
        for i in range(0, len(token), 1 << 18):
            z = slice(i, i + (1 << 18))
            yield batch(kind, name[z], names[owner[z]], n[owner[z]], names[hub[z]], pa.nulls(len(owner[z]), pa.int64()), place[z])

    packed = rows.mapInArrow(tidy(post), "bucket int, grp binary, n binary, sig binary, count binary, high binary, low binary, pos binary")
    return packed.repartitionById(buckets, F.col("bucket")).mapInArrow(tidy(gather), "list long, grp long, n int, hub long, sig long, pos int")


def _verify(pairs: DataFrame, texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The linked ones of the pairs (a, b) of units, a written table; texts (sig, t). A hub of many pairs is dealt over several tasks."""
    texts = _only(texts.select("sig", "t"), pairs)
    sizes = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("pairs"))
    sizes = sizes.select("a", F.ceil(F.col("pairs") / HUB_PART).cast("int").alias("parts"))
    member = pairs.join(sizes, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), "b")
    member = member.join(texts, F.col("b") == F.col("sig")).select("a", "part", "b", "t")
    hub = sizes.join(texts, F.col("a") == F.col("sig")).select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("b"), "t")
    dealt = hub.unionByName(member).repartition("a", "part").sortWithinPartitions("a", "part", F.asc_nulls_first("b"))
    kind = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def check(batches):
        mine, now = None, None
        for x in (whole.slice(z, SLICE) for whole in batches for z in range(0, whole.num_rows, SLICE)):
            offs, flat = sets(x.column(3), k)
            a, part, b = (x.column(i).to_pylist() for i in range(3))
            names = signature(offs, flat).tolist()
            if any(n != (p if q is None else q) for n, p, q in zip(names, a, b)):
                raise RuntimeError("input rows moved between two reads")
            out = []
            for i in range(x.num_rows):
                s = flat[offs[i]:offs[i + 1]]
                if b[i] is None:
                    now, mine = (a[i], part[i]), s
                elif (a[i], part[i]) != now:
                    raise RuntimeError("a hub's text is missing")
                elif links(mine, s, num, den):
                    out.append((a[i], b[i]))
            yield batch(kind, [o[0] for o in out], [o[1] for o in out])

    return dealt.mapInArrow(tidy(check), "a long, b long")


def _first_common(nx, i, ny, j, num: int, den: int):
    """Whether sets of these sizes may link if their first common shingle stands at places i and j."""
    return (num + den) * np.minimum(nx - i, ny - j) >= num * (nx + ny)


def _some_first_common(nx, i, ny, j, num: int, den: int) -> Column:
    """The same of columns."""
    return (num + den) * F.least(nx - i, ny - j) >= num * (nx + ny)


def _distinct_pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return batch(_PAIR, a[new], b[new])


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _by_list(entries: DataFrame, pairs_of) -> DataFrame:
    """Pairs (a, b) that ``pairs_of`` makes of whole lists; entries (list, sig, n, pos, deg, comp) stand together and sorted by list.

    ``pairs_of`` gets the starts and sizes of some lists and their entries' columns. A list that the scan cuts in two is two lists.
    """
    def run(batches):
        held = [np.zeros(0, np.int64)] * 6
        for b in batches:
            arr = [np.concatenate((h, b.column(i).to_numpy().astype(np.int64))) for i, h in enumerate(held)]
            if not len(arr[0]):
                continue
            other = np.flatnonzero(arr[0] != arr[0][-1])
            last = int(other[-1]) + 1 if len(other) else 0      # the last list may go on
            yield from some([c[:last] for c in arr])
            held = [c[last:] for c in arr]
        yield from some(held)

    def some(arr):
        name = arr[0]
        if len(name):
            start = np.flatnonzero(np.concatenate(([True], name[1:] != name[:-1])))
            for x, y in pairs_of(start, np.diff(np.append(start, len(name))), *arr[1:]):
                yield _distinct_pairs(x, y)

    return entries.select("list", "sig", "n", "pos", "deg", "comp").mapInArrow(tidy(run), "a long, b long")


def _together(entries: DataFrame, *keys: str) -> DataFrame:
    return entries.repartition(*keys).sortWithinPartitions(*keys)


def _folded(m: np.ndarray, words_: int) -> np.ndarray:
    """Bitmaps (rows of words) of the same sets with fewer bits."""
    while m.shape[1] > words_:
        m = m[:, :m.shape[1] // 2] ^ m[:, m.shape[1] // 2:]
    return m


class Bitmaps:
    """The parity bitmaps of some units, by their widths."""

    def __init__(self, bits: list[bytes]):
        width = np.array([len(b) // 8 for b in bits])
        self.width, self.at, self.rows = width, np.zeros(len(bits), np.int64), {}
        for w in np.unique(width).tolist():
            mine = np.flatnonzero(width == w)
            self.at[mine] = np.arange(len(mine))
            self.rows[w, w] = np.frombuffer(b"".join(bits[i] for i in mine.tolist()), np.uint64).reshape(-1, w)

    def differ(self, i: int, others: np.ndarray) -> np.ndarray:
        """At how many bits, at the least, unit i differs from each of the others."""
        out = np.zeros(len(others), np.int64)
        wide = self.width[others]
        for w in np.unique(wide).tolist():
            use = min(w, int(self.width[i]))
            if (w, use) not in self.rows:
                self.rows[w, use] = _folded(self.rows[w, w], use)
            mine = _folded(self.rows[self.width[i], self.width[i]][self.at[i]][None], use)
            here = np.flatnonzero(wide == w)
            out[here] = np.bitwise_count(self.rows[w, use][self.at[others[here]]] ^ mine).sum(axis=1, dtype=np.int64)
        return out


def _met(left: np.ndarray, sig, n, pos, comp, bits: list[bytes], num: int, den: int, nearest: bool):
    """Pairs of units of one list, each of another component than the other, that neither places nor bitmaps rule out.
    Units of two blocks (``left``: of the first) meet those of the other block. ``nearest``: of each unit's pairs the one with
    the highest bound of its Jaccard index. Units of the most frequent component stand in pairs of the others only."""
    maps = Bitmaps(bits)
    names, of = np.unique(comp, return_inverse=True)
    side = (np.flatnonzero(left), np.flatnonzero(~left)) if not left.all() else (np.arange(len(sig)),) * 2
    out_a, out_b, count = [], [], 0
    for i in np.flatnonzero(of != np.argmax(np.bincount(of))).tolist():
        far = side[int(left[i])]
        far = far[(comp[far] != comp[i]) & _first_common(n[i], pos[i], n[far], pos[far], num, den)]
        if not len(far):
            continue
        both = (n[i] + n[far] - maps.differ(i, far)) // 2            # the most shingles that they may share
        either = n[i] + n[far] - both
        can = np.flatnonzero(den * both >= num * either)
        if nearest and len(can):
            can = can[[np.argmax(both[can] / either[can])]]
        out_a.append(np.minimum(sig[i], sig[far[can]]))
        out_b.append(np.maximum(sig[i], sig[far[can]]))
        count += len(can)
        if count > 1 << 18:
            yield _distinct_pairs(np.concatenate(out_a), np.concatenate(out_b))
            out_a, out_b, count = [], [], 0
    if count:
        yield _distinct_pairs(np.concatenate(out_a), np.concatenate(out_b))


def _across(short: DataFrame, long: DataFrame, sizes: DataFrame, maps: DataFrame, num: int, den: int, nearest: bool) -> DataFrame:
    """The pairs (a, b) of :func:`_met` over all lists that hold several components. Lists beyond ``LONG`` entries (``sizes``: list,
    entries) are dealt into blocks of about ``LONG``, and each two blocks (or a block by itself) meet in a group of their own:
    left entries first, then the right ones."""
    cols = ["list", "sig", "n", "pos", "comp"]
    parts = sizes.select("list", F.ceil(F.col("entries") / LONG).cast("int").alias("parts"))
    entries = short.select(*cols, F.lit(1).alias("parts")).unionByName(long.join(_sent(parts), "list").select(*cols, "parts"))
    mixed = per_key(entries, ["list"], F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("list")
    entries = entries.join(_sent(mixed), "list", "left_semi")
    entries = entries.withColumn("mine", F.pmod(F.xxhash64("sig"), F.col("parts")).cast("int"))
    entries = entries.join(maps.select("sig", "bits"), "sig").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = entries.select("list", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), (F.col("mine") > F.col("other")).alias("right"),
                           "sig", "n", "pos", "comp", "bits")

    def run(batches):
        held = None
        for b in (pa.Table.from_batches([b]) for b in batches if b.num_rows):
            held = b if held is None else pa.concat_tables([held, b])
            key = [held.column(i).to_numpy() for i in range(3)]
            new = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
            for x, y in zip([0, *new.tolist()], new.tolist()):
                yield from meet(held.slice(x, y - x))
            held = held.slice(int(new[-1])).combine_chunks() if len(new) else held
        if held is not None:
            yield from meet(held)

    def meet(t):
        right = t.column(3).to_numpy()
        sig, n, pos, comp = (t.column(i).to_numpy().astype(np.int64) for i in range(4, 8))
        yield from _met(~right, sig, n, pos, comp, t.column(8).to_pylist(), num, den, nearest)

    return (dealt.repartition("list", "lo", "hi").sortWithinPartitions("list", "lo", "hi", "right")
            .mapInArrow(tidy(run), "a long, b long").distinct())


def _to_hub(short: DataFrame, long: DataFrame, turn: int, num: int, den: int) -> DataFrame:
    """At most one pair (hub, unit) for each unit: the hub of another component that it shares most lists with.

    A list's hub is the unit that stands in most open lists: edits make shingles of their own, which stand first and in
    no list, so that the text that many others were made from stands in more lists than they. From the second turn
    on, noise of up to the degree itself gives other hubs their turn, the same ones in lists that share them.
    """
    salt = turn * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
    width = 1 if turn > 1 else 0

    def one(start, size, sig, n, pos, deg, comp):
        luck = (mix(sig.view(np.uint64) ^ _U(salt)) >> _U(11)).astype(float) / (1 << 53)
        order = deg * (1 + width * luck) + luck / 2
        first = np.flatnonzero(order == np.repeat(np.maximum.reduceat(order, start), size))
        h = np.repeat(first[np.searchsorted(first, start)], size)
        far = np.flatnonzero((comp != comp[h]) & _first_common(n[h], pos[h], n, pos, num, den))
        if len(far):
            yield sig[h[far]], sig[far]

    luck = F.pmod(F.xxhash64("sig", F.lit(turn)), F.lit(1 << 30)) / float(1 << 30)
    order = F.col("deg") * (1 + width * luck) + luck / 2
    hubs = per_key(long, ["list"], F.max(F.struct(order.alias("order"), "sig", "n", "pos", "comp")).alias("hub"))
    far = (F.col("comp") != F.col("hub.comp")) & _some_first_common(F.col("hub.n"), F.col("hub.pos"), F.col("n"), F.col("pos"), num, den)
    of_long = long.join(_sent(hubs), "list").where(far).select(F.col("hub.sig").alias("a"), F.col("sig").alias("b"))
    shared = _by_list(short, one).unionByName(of_long).groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))
    return shared.groupBy("b").agg(F.max(F.struct("shared", "a")).alias("m")).select(F.col("m.a").alias("a"), "b")


def _candidates(rows: DataFrame, chosen: DataFrame, k: int) -> DataFrame:
    """(sig, n, t, bits, few) of the ``chosen`` (sig, at) rows, a written table: their texts and two parity bitmaps, the
    smaller one ``few``. The rows are told by one bit each, so that texts stay in the tasks that read them."""
    bits = chosen.groupBy(F.bitmap_bucket_number("at").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("rows"))
    bits = kept(bits, "chosen-bits")
    place = F.bitmap_bit_position("row")
    byte = F.conv(F.hex(F.col("rows").substr((F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    mine = (F.bitmap_bucket_number("row") == F.col("part")) & (F.getbit(byte, (place % 8).cast("int")) == 1)
    def run(batches):
        for b in (whole.slice(z, SLICE) for whole in batches for z in range(0, whole.num_rows, SLICE)):
            kind = pa.schema([("sig", pa.int64()), ("n", pa.int32()), ("t", b.column(2).type), ("bits", pa.binary()), ("few", pa.binary())])
            offs, flat = sets(b.column(2), k)
            each = [flat[x:y] for x, y in zip(offs, offs[1:])]
            yield batch(kind, signature(offs, flat), np.diff(offs).astype(np.int32), b.column(2),
                        [parity(s, 2) for s in each], [parity(s) for s in each])

    # The same columns are read again, so that a source which deals rows by their content deals them alike.
    shape = f"sig long, n int, t {rows.schema['t'].dataType.simpleString()}, bits binary, few binary"
    out = kept(rows.join(_sent(bits), mine, "left_semi").mapInArrow(tidy(run), shape), "candidates", "zstd")
    mark = F.count(F.lit(1)), F.sum(F.xxhash64("sig").cast("decimal(38,0)"))
    if out.agg(*mark).first() != chosen.agg(*mark).first():
        raise RuntimeError("input rows moved between two reads")
    discard(bits)
    return out


def _filtered(pairs: DataFrame, maps: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs, a written table, that the parity bitmaps do not rule out."""
    maps = _only(maps, pairs)
    one = maps.select(F.col("sig").alias("a"), F.col("n").alias("na"), F.col("bits").alias("pa"))
    two = maps.select(F.col("sig").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("pb"))
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def possible(batches):
        for x in batches:
            na, xa, nb, xb = (x.column(i).to_pylist() for i in range(2, 6))
            ok = [may_link(*v, num, den) for v in zip(na, xa, nb, xb)]
            yield pa.RecordBatch.from_arrays([x.column(0), x.column(1)], schema=out).filter(pa.array(ok, pa.bool_()))

    both = pairs.join(one, "a").join(two, "b").select("a", "b", "na", "pa", "nb", "pb")
    return both.mapInArrow(tidy(possible), "a long, b long")


def _labelled(entries: DataFrame, label: DataFrame) -> DataFrame:
    """Entries (list, sig, n, pos, ...) with their component so far (a unit without links is its own)."""
    return entries.join(label, F.col("sig") == F.col("node"), "left").select(*entries.columns, F.coalesce("root", "sig").alias("comp"))


def _joined(label: DataFrame, links_: DataFrame) -> DataFrame:
    """The components (node, root; roots themselves stand in none) after more links between units: roots that links join
    are contracted, and the members of the others stay as they are. ``label`` is a kept table and is discarded."""
    sent = _sent(label)
    of_a, of_b = (sent.select(F.col("node").alias(x), F.col("root").alias(f"r{x}")) for x in "ab")
    new = links_.join(of_a, "a", "left").join(of_b, "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    roots = components(new)
    moved = _sent(roots.select(F.col("node").alias("old"), F.col("root").alias("new")))
    out = (label.join(moved, F.col("root") == F.col("old"), "left").select("node", F.coalesce("new", "root").alias("root"))
           .unionByName(roots.select("node", "root")))
    out = kept(out, "components")
    discard(label, roots)
    return out


def _links(docs: DataFrame, id_col: str, text_col: str, k: int, num: int, den: int, head: int) -> DataFrame:
    """row, doc_id, n_shingles, component (a number that linked rows share; null without shingles) of every row."""
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    survey = kept(_survey(rows, k), "survey")
    all_docs = survey.where("row IS NOT NULL").select("row", "doc_id", "n", "sig")
    seen = survey.where("hash IS NOT NULL").groupBy("hash").agg(F.sum("count").alias("count"))
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    posted = kept(_posted(rows, k, num, den, _order(seen, head), buckets), "posted")
    lists = posted.where("list IS NOT NULL").select("list", "grp", "hub", "pos")
    units = posted.where("list IS NULL").select("grp", "sig", "n")

    lead = units.groupBy("grp").agg(F.min("sig").alias("lead"), F.count(F.lit(1)).alias("units"))
    inner = units.join(lead.where("units > 1"), "grp").where("sig <> lead").select(F.col("lead").alias("a"), F.col("sig").alias("b"))
    best = (lists.where("grp <> hub").groupBy("grp", "hub").agg(F.count(F.lit(1)).alias("shared"))
            .groupBy("grp").agg(F.max(F.struct("shared", "hub")).alias("m")).select("grp", F.col("m.hub").alias("hub")))
    star = (best.join(lead.select("grp", F.col("lead").alias("b")), "grp")
            .join(lead.select(F.col("grp").alias("hub"), F.col("lead").alias("a")), "hub").select("a", "b"))
    first = kept(inner.unionByName(star), "star-pairs")

    active = lists.select("grp").distinct().join(units, "grp").select("sig").unionByName(inner.select(F.col("a").alias("sig"))).unionByName(
        inner.select(F.col("b").alias("sig"))).distinct()
    chosen = kept(all_docs.where("n > 0").groupBy("sig").agg(F.min("row").alias("at")).join(active, "sig", "left_semi"), "chosen")
    texts = _candidates(rows, chosen, k)
    maps = texts.select("sig", "n", "bits")
    tried = kept(_filtered(first, texts.select("sig", "n", F.col("few").alias("bits")), num, den), "tried-stars")
    label = components(_verify(tried, texts, k, num, den))
    discard(chosen, first, tried)
    inside = units.join(lead.where("units > 1"), "grp").select(F.col("grp").alias("list"), "sig", "n", F.lit(0).alias("pos"))
    spread = _labelled(lists.join(units, "grp").select("list", "sig", "n", "pos").unionByName(inside), _sent(label))
    # Of lists with the same units the one that stands first in the order holds the first common shingle of all their pairs.
    several = (spread.groupBy("list").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("entries"), F.sum("pos").alias("at"),
                                          F.bit_xor(F.xxhash64("sig")).alias("x"), F.bit_xor(F.xxhash64("sig", F.lit(1))).alias("y")).where("lo < hi"))
    several = kept(several.groupBy("x", "y", "entries").agg(F.min(F.struct("at", "list")).alias("m"), F.count(F.lit(1)).alias("lists"))
                   .select(F.col("m.list").alias("list"), "entries", "lists"), "open-lists")
    still = kept(spread.join(several, "list").select("list", "sig", "n", "pos", "entries", "lists"), "open-entries")
    degree = per_key(still, ["sig"], F.sum("lists").cast("int").alias("deg"))
    still_of = still.join(_sent(degree), "sig").select("list", "sig", "n", "pos", "deg", "entries")
    short = kept(_together(still_of.where(F.col("entries") <= LONG).drop("entries"), "list"), "short-lists")
    long = kept(still_of.where(F.col("entries") > LONG).drop("entries"), "long-lists")
    discard(still)
    sizes = several.where(F.col("entries") > LONG)
    discard(posted)
    for turn in range(1, TURNS + 1):
        small = fits_broadcast(label, SENT_ROWS, SENT_BYTES)
        now = F.broadcast(label) if small else label
        here = _labelled(short, now)
        if not small:                   # a broadcast leaves the short lists as they were written; a join that shuffles parts them
            here = _together(here, "list")
        asked = kept(_to_hub(here, _labelled(long, now), turn, num, den), "hub-candidates")
        tried = kept(_filtered(asked, maps, num, den), "hub-pairs")
        found = kept(_verify(tried, texts, k, num, den), "links")
        n_tried, n_linked = tried.count(), found.count()
        if n_linked:
            label = _joined(label, found)
        discard(asked, tried, found)
        if n_linked * 2 < n_tried or not n_tried:
            break
    for turn in range(TURNS + 1):       # the last one makes all pairs
        now = _sent(label)
        all_left = turn == TURNS or (turn > 0 and n_linked * 5 < n_tried)
        near = kept(_across(_labelled(short, now), _labelled(long, now), sizes, maps, num, den, not all_left), "far-pairs" if all_left else "near-pairs")
        found = kept(_verify(near, texts, k, num, den), "links")
        n_tried, n_linked = near.count(), found.count()
        if n_linked:
            label = _joined(label, found)
        discard(near, found)
        if all_left or not n_tried:     # a unit without a nearest one has no pair at all
            break
    discard(short, long, several, texts)
    out = all_docs.join(label, F.col("sig") == F.col("node"), "left").select(
        "row", "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("root", "sig")).alias("component"))
    out._made_of = (survey, label)
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, num: int = NUM, den: int = DEN,
                    head: int = HEAD) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    linked = _links(docs, id_col, text_col, k, num, den, head)
    smallest = per_key(linked.where("component IS NOT NULL"), ["component"], F.min("doc_id").alias("component_id"))
    some = linked.where("component IS NOT NULL").join(smallest, "component").select("doc_id", "n_shingles", "component_id")
    return some.unionByName(linked.where("component IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, num: int = NUM, den: int = DEN,
                head: int = HEAD) -> DataFrame:
    """The rows of ``docs`` less near duplicates: of each component the row with the smallest id stays (nulls last), of equal
    ids the first row. Rows without words stay. Every read of ``docs`` must give the same rows in the same partitions, as
    file scans do; else this fails."""
    found = _links(docs, id_col, text_col, k, num, den, head)
    linked = kept(found.where("component IS NOT NULL").select("row", "doc_id", "component"), "linked")
    discard(*found._made_of)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    stays = linked.groupBy("component").agg(F.min(order).alias("m"), F.count(F.lit(1)).alias("rows")).where("rows > 1").select(
        "component", F.col("m.row").alias("stays"))
    gone = kept(linked.join(stays, "component").where("row <> stays").select(F.col("row").alias("gone"), F.col("doc_id").alias("gone_id")), "gone")
    discard(linked)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"))
    moved = F.raise_error(F.lit("input rows moved between two reads")).cast("boolean")
    same = F.when(F.col("doc_id").eqNullSafe(F.col("gone_id")), False).otherwise(moved)
    return rows.join(_sent(gone), F.col("row") == F.col("gone"), "left").where(F.when(F.col("gone").isNull(), True).otherwise(same)).select("whole.*")
