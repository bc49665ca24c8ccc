"""Packing by minimum bin slack.

Each document's ids (plus the end id) are cut into windows of ``window`` and a
rest. Full windows are sequences of their own. The histogram of rest lengths,
``window`` entries at most, goes to the driver, which fills one window after
another: the longest length left goes in, then a bitset subset-sum over the
multiset of lengths left finds the fullest reachable level, and backtracking
over the stored bitsets gives how many of each length to take. A pattern is
applied as often as its lengths last, so the number of patterns is bounded by
the number of lengths, not by the documents. Where no multiset fills a window,
one more rest is cut to fill it and what is left of it opens the next window.
The last, part-filled window is cut into powers of two, which need no padding.

Spark gives every rest its rank among the rests of equal length. Ranks come
from counts by (length, hash bucket) and a window inside each bucket, so a
length that a third of all documents share is dealt over all buckets. A
broadcast join with the pattern segments (bounded by the plan) turns ranks into
sequence and offset.

Null and empty texts are one piece holding the end id. Null ids are kept.
Repeated rows are packed once each; rows that share an id but not the text are
packed by themselves, and their pieces differ in ``doc_tokens`` or checksum. An
empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wareflow.llm.common import batch, kept, local_rows, tidy
from wareflow.llm.pieces import Pieces, default_tokenizer

WINDOW = 2048
END_ID = 1
BUCKETS = 1024

#: x, first rank, end rank, first sequence, copies a sequence, offset, start in the rest, length
Segment = tuple[int, int, int, int, int, int, int, int]


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Copies of each length whose sum is the largest reachable one up to ``room``."""
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for x in sorted(counts, reverse=True):
        left = min(counts[x], room // x) if x <= room else 0
        size = 1
        while left > 0:                       # binary splitting of the multiplicity
            take = min(size, left)
            steps.append((x, take, reach))
            reach |= (reach << (x * take)) & mask
            left -= take
            size *= 2
        if reach >> room & 1:
            break
    level = reach.bit_length() - 1
    out: dict[int, int] = {}
    for x, take, before in reversed(steps):   # backtrack: was the level there without this step?
        if not before >> level & 1:
            level -= x * take
            out[x] = out.get(x, 0) + take
    return out


def plan(hist: dict[int, int], window: int = WINDOW) -> tuple[list[Segment], int]:
    """Segments that place every rest, and the number of sequences they make."""
    counts = {x: n for x, n in hist.items() if n > 0}
    used = dict.fromkeys(counts, 0)
    out: list[Segment] = []
    seq, carry = 0, None                      # carry: what is left of a cut rest: x, rank, start

    def take(x: int, n: int) -> int:
        first = used[x]
        used[x] += n
        counts[x] -= n
        if not counts[x]:
            del counts[x]
        return first

    while counts or carry:
        times, at = 1, 0
        if carry:
            x, rank, start = carry
            out.append((x, rank, rank + 1, seq, 1, 0, start, x - start))
            at, carry = x - start, None
            pick = fullest(counts, window - at)
        else:
            big = max(counts)
            rest = dict(counts)
            rest[big] -= 1
            pick = fullest({x: n for x, n in rest.items() if n}, window - big)
            pick[big] = pick.get(big, 0) + 1
            if sum(x * n for x, n in pick.items()) == window:
                times = min(counts[x] // n for x, n in pick.items())
        for x, n in sorted(pick.items(), reverse=True):
            first = take(x, n * times)
            out.append((x, first, first + n * times, seq, n, at, 0, x))
            at += x * n
        if at < window and counts:            # every rest left is longer than the slack
            x = min(counts)
            rank = take(x, 1)
            out.append((x, rank, rank + 1, seq, 1, at, 0, window - at))
            carry, at = (x, rank, window - at), window
        if at < window:
            out, seq = _powers(out, seq, at)
        seq += times
    return out, seq


def _powers(out: list[Segment], seq: int, filled: int) -> tuple[list[Segment], int]:
    """Cut the last sequence into sequences of power-of-two lengths."""
    last = [s for s in out if s[3] == seq]
    done = [s for s in out if s[3] != seq]
    flat = [(x, lo + k, start, length) for x, lo, _, _, n, _, start, length in last for k in range(n)]
    sizes = [1 << b for b in range(filled.bit_length() - 1, -1, -1) if filled >> b & 1]
    number, at, room = seq, 0, sizes[0]
    sizes = sizes[1:]
    for x, rank, start, length in flat:
        while length:
            part = min(length, room - at)
            done.append((x, rank, rank + 1, number, 1, at, start, part))
            start, length, at = start + part, length - part, at + part
            if at == room and sizes:
                room, sizes, number, at = sizes[0], sizes[1:], number + 1, 0
    return done, number


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _with_end(model: Pieces, col, end_id: int) -> Iterable[tuple[int, np.ndarray]]:
    for i, each, ids in model.ids(col):
        at = 0
        for k, n in enumerate(each.tolist()):
            yield i + k, np.append(ids[at:at + n], np.uint32(end_id)).astype(np.uint32)
            at += n


def token_lengths(docs: DataFrame, id_col: str, text_col: str, window: int, end_id: int, path: str) -> DataFrame:
    """doc_id, text_key, n (ids with the end id), crcs (of each window of ids) per row."""
    out = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n", pa.int64()), ("crcs", pa.list_(pa.int64()))])

    def tokenise(batches):
        model = Pieces.of(path)
        for b in batches:
            n, crcs = np.zeros(b.num_rows, np.int64), [[]] * b.num_rows
            for i, ids in _with_end(model, b.column(2), end_id):
                n[i] = len(ids)
                crcs[i] = [_crc(ids[k:k + window]) for k in range(0, len(ids), window)]
            yield batch(out, b.column(0), b.column(1), n, crcs)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("t"))
    return rows.mapInArrow(tidy(tokenise), "doc_id long, text_key long, n long, crcs array<long>")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = END_ID,
         tokenizer: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The plan, one row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return _plan(docs, id_col, text_col, window, end_id, tokenizer or default_tokenizer(), buckets).drop("text_key")


def packed_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = END_ID,
               tokenizer: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The packed sequences: sequence_id, offset, doc_id, start, ids (array of int) of every piece, its ids cut by the plan.

    The texts are tokenised again, where their pieces are; sort by sequence_id and offset to write the sequences.
    """
    path = tokenizer or default_tokenizer()
    pieces = kept(_plan(docs, id_col, text_col, window, end_id, path, buckets), "pieces")
    out = pa.schema([("sequence_id", pa.int64()), ("offset", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def cut(batches):
        model = Pieces.of(path)
        for b in batches:
            parts, ids = b.column(2).to_pylist(), b.column(0).to_pylist()
            rows = [(p["sequence_id"], p["offset"], ids[i], p["start"], x[p["start"]:p["start"] + p["length"]].astype(np.int32))
                    for i, x in _with_end(model, b.column(1), end_id) for p in parts[i]]
            yield batch(out, *([r[c] for r in rows] for c in range(5)))

    return _with_parts(docs, pieces, id_col, text_col).mapInArrow(tidy(cut), "sequence_id long, offset long, doc_id long, start long, ids array<int>")


def _plan(docs: DataFrame, id_col: str, text_col: str, window: int, end_id: int, path: str, buckets: int) -> DataFrame:
    """The pieces with the key of their text; rows that share an id but not the text are told apart by it."""
    spark = docs.sparkSession
    key = ("doc_id", "text_key")
    lens = kept(token_lengths(docs, id_col, text_col, window, end_id, path), "lengths")
    lens = lens.select("*", (F.col("n") % window).alias("rest"), F.floor(F.col("n") / window).cast("long").alias("full"),
                       F.pmod(F.xxhash64(*key), F.lit(buckets)).alias("bucket"))

    by_rest = lens.where("rest > 0").groupBy("rest", "bucket").count()
    cells = kept(by_rest, "rest-cells")                                  # window x buckets rows at most
    hist = {r[0]: r[1] for r in cells.groupBy("rest").agg(F.sum("count")).collect()}
    segments, n_packed = plan(hist, window)
    before = Window.partitionBy("rest").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("rest", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("rest", "bucket").orderBy(*key)
    ranked = (lens.where("rest > 0").withColumn("rank", F.row_number().over(inside) - 1)
              .join(cells, ["rest", "bucket"]).withColumn("rank", F.col("rank") + F.col("first")))
    seg = local_rows(spark, segments, "x", "lo", "hi", "seq", "copies", "at", "inner", "length")
    hit = (F.col("rest") == F.col("x")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    k = F.col("rank") - F.col("lo")
    placed = ranked.join(F.broadcast(seg), hit).select(
        *key, (F.col("full") * window + F.col("inner")).alias("start"), "length", F.element_at("crcs", -1).alias("crc"),
        F.col("n").alias("doc_tokens"), (F.col("seq") + F.floor(k / F.col("copies"))).alias("sequence_id"),
        (F.col("at") + k % F.col("copies") * F.col("x")).alias("offset"), (F.col("length") == F.col("x")).alias("entire"))

    sums = {r[0]: r[1] for r in lens.groupBy("bucket").agg(F.sum("full")).collect()}    # a row per bucket
    total, first = n_packed, []
    for b in sorted(sums):
        first.append((b, total))
        total += sums[b]
    starts = local_rows(spark, first, "bucket", "base")
    running = Window.partitionBy("bucket").orderBy(*key).rowsBetween(Window.unboundedPreceding, -1)
    fulls = (lens.withColumn("before", F.coalesce(F.sum("full").over(running), F.lit(0))).where("full > 0")
             .join(F.broadcast(starts), "bucket")
             .select(*key, "n", "base", "before", F.posexplode(F.slice("crcs", F.lit(1), F.col("full").cast("int"))).alias("i", "crc")))
    fulls = fulls.select(*key, (F.col("i") * F.lit(window)).cast("long").alias("start"), F.lit(window).cast("long").alias("length"), "crc",
                         F.col("n").alias("doc_tokens"), (F.col("base") + F.col("before") + F.col("i")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))

    names = [*key, "start", "length", "crc", "doc_tokens", "sequence_id", "offset"]
    n_cut = sum(s[7] != s[0] for s in segments)
    if n_cut:                                  # few: one a part-filled window
        placed = kept(placed, "placed")
        cut = _cut_crcs(docs, placed.where("NOT entire"), id_col, text_col, end_id, path)
        placed = placed.where("entire").select(*names).unionByName(cut.select(*names))
    return (placed.select(*names).unionByName(fulls).withColumnRenamed("crc", "ids_crc32")
            .select(*key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"))


def _with_parts(docs: DataFrame, pieces: DataFrame, id_col: str, text_col: str, few: bool = False) -> DataFrame:
    """doc_id, t, parts, text_key: every text that has pieces, with all of them (those of its repeated rows too)."""
    parts = (pieces.groupBy("doc_id", "text_key")
             .agg(F.collect_list(F.struct("start", "length", "doc_tokens", "sequence_id", "offset")).alias("parts")))
    texts = docs.select(F.col(id_col).cast("long").alias("d"), F.xxhash64(text_col).alias("k"), F.col(text_col).alias("t"))
    same = F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("k") == F.col("text_key"))
    joined = texts.join(F.broadcast(parts) if few else parts, same)
    return joined.dropDuplicates(["doc_id", "text_key"]).select("doc_id", "t", "parts", "text_key")


def _cut_crcs(docs: DataFrame, cut: DataFrame, id_col: str, text_col: str, end_id: int, path: str) -> DataFrame:
    """Checksums of pieces shorter than their rest; their number is bounded by the plan, so they are broadcast."""
    out = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("crc", pa.int64()),
                     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
    texts = _with_parts(docs, cut, id_col, text_col, few=True)

    def crcs(batches):
        model = Pieces.of(path)
        for b in batches:
            ids, parts, keys = (b.column(c).to_pylist() for c in (0, 2, 3))
            rows = [(ids[i], keys[i], p["start"], p["length"], _crc(x[p["start"]:p["start"] + p["length"]]), p["doc_tokens"], p["sequence_id"], p["offset"])
                    for i, x in _with_end(model, b.column(1), end_id) for p in parts[i]]
            yield batch(out, *([r[c] for r in rows] for c in range(8)))

    return texts.mapInArrow(tidy(crcs), "doc_id long, text_key long, start long, length long, crc long, doc_tokens long, sequence_id long, offset long")
