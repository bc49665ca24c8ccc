"""Target-distribution importance resampling over an Aho-Corasick dictionary.

Texts are lower-cased (A-Z) and their words, runs of letters, digits and bytes
from 0x80 on, stand between single blanks. Every distinct word of a piece of
about a megabyte goes into an automaton between two delimiters, with its CRC-32
and its length as payload. Scanning the piece emits one payload a word, in
order; a run of several words is composed from adjacent payloads alone, since
crc(a + b) follows from crc(a), crc(b) and the length of b. The CRC of a run
modulo ``buckets`` is its bucket.

1. Each task adds its features up by bucket; the sums of ``docs`` and of
   ``target`` (``buckets`` numbers each) give a gain for every bucket.
2. A second scan sums the gains of each text's features, its weight. With
   Gumbel noise keyed by the id, the highest scores are a draw without
   replacement.
3. The eligible texts are sorted by score over range partitions; a rank is the
   place in the partition plus the sizes of the partitions before it.

Null and empty texts have no words, weight 0, and are never drawn. A null id
has the noise of an empty id and loses ties. Repeated ids share their noise and
are ranked row by row. Empty tables give an empty result; an empty target gives
gains from the smoothing alone.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wareflow.llm.common import batch, kept
from wareflow.llm.textblock import MARKS, pieces, text_bytes

BUCKETS = 10_000
RUN = 1
RATE = 10
LEAST_WORDS = 20
SEED = 2024
SLICE = 2000

#: Lower-cases A-Z and turns every byte that is no part of a word into a blank.
_PLAIN = bytes(0x20 if MARKS[c] else ord(chr(c).lower()) if c < 128 else c for c in range(256))
_END = "\x00"           # stands between texts; no text holds it after _PLAIN


def _zeros() -> list[np.ndarray]:
    """Tables of the CRC-32 register after 1, 2, 4, ... zero bytes: one value for each byte of the register."""
    one = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)
    step = np.zeros((4, 256), np.uint32)
    for k in range(4):
        for b in range(256):
            x = b << 8 * k
            step[k, b] = (x >> 8) ^ int(one[x & 0xFF])
    out = [step]
    for _ in range(31):
        out.append(np.stack([_through(out[-1], row) for row in out[-1]]))
    return out


def _through(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    return table[0][x & 0xFF] ^ table[1][x >> 8 & 0xFF] ^ table[2][x >> 16 & 0xFF] ^ table[3][x >> 24]


_ZEROS = _zeros()
_BLANK = np.uint32(zlib.crc32(b" "))


def combine(first: np.ndarray, second: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of two strings one after the other, from the CRC of each and the bytes of the second."""
    out = first.astype(np.uint32)
    for k in range(int(size.max(initial=0)).bit_length()):
        out = np.where(size >> k & 1, _through(_ZEROS[k], out), out)
    return out ^ second.astype(np.uint32)


def payloads(text: str) -> np.ndarray:
    """Length and CRC (32 bits each) of every word of a plain text, in order; -1 for the end of a text."""
    import ahocorasick
    words = ahocorasick.Automaton(ahocorasick.STORE_ANY)
    for w in set(text.split(" ")):
        if w == _END:
            words.add_word(f" {w} ", -1)
        elif w:
            raw = w.encode("utf-8", "surrogateescape")
            words.add_word(f" {w} ", len(raw) << 32 | zlib.crc32(raw))
    if not len(words):
        return np.zeros(0, np.int64)
    words.make_automaton()
    return np.fromiter((v for _, v in words.iter(text)), np.int64)


def runs(payload: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For 1..n words: (index of the last word, CRC) of every run of adjacent words within a text."""
    word = payload >= 0
    crc, size = (payload & 0xFFFFFFFF).astype(np.uint32), payload >> 32
    whole, now = word, crc
    yield np.flatnonzero(whole), now[whole]
    spaced = combine(np.full(len(crc), _BLANK), crc, np.where(word, size, 0)) if n > 1 else crc
    for _ in range(n - 1):
        whole = word & np.concatenate((np.zeros(min(1, len(word)), bool), whole[:-1]))
        before = np.concatenate((np.zeros(min(1, len(now)), np.uint32), now[:-1]))
        now = combine(before, spaced, np.where(whole, size + 1, 0))
        yield np.flatnonzero(whole), now[whole]


def scan(col, n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Piece by piece: (text index of every feature, its CRC, text index of every word)."""
    data, offsets = text_bytes(col)
    plain = data.tobytes().translate(_PLAIN)
    ends = offsets[1:]
    done, tail = int(np.searchsorted(ends, 0, "right")), np.zeros(0, np.int64)
    for lo, hi in pieces(data, offsets):
        upto = int(np.searchsorted(ends, hi, "right"))
        cuts = [lo, *ends[done:upto].tolist()]
        parts = [plain[a:z] for a, z in zip(cuts, [*cuts[1:], hi])]
        text = b" ".join((b"", f" {_END} ".encode().join(parts), b"")).decode("utf-8", "surrogateescape")
        got = np.concatenate((tail, payloads(text)))            # the last words may go on in this piece
        doc = done + np.concatenate(([0], np.cumsum(got < 0)[:-1])) if len(got) else np.zeros(0, np.int64)
        new = len(tail)
        which, crcs = [], []
        for at, crc in runs(got, n):
            fresh = at >= new
            which.append(doc[at[fresh]])
            crcs.append(crc[fresh])
        yield np.concatenate(which), np.concatenate(crcs), doc[new:][got[new:] >= 0]
        last = np.flatnonzero(got < 0)
        tail = got[max(int(last[-1]) + 1 if len(last) else 0, len(got) - n + 1):] if n > 1 else tail
        done = upto


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS, n: int = RUN) -> np.ndarray:
    """Features of all texts by bucket: added up within tasks first, ``buckets`` numbers come to the driver."""
    kind = pa.schema([("bucket", pa.int32()), ("count", pa.int64())])

    def add(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for z in range(0, b.num_rows, SLICE):
                for _, crc, _ in scan(b.column(0).slice(z, SLICE), n):
                    total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        some = np.flatnonzero(total)
        yield batch(kind, some, total[some])

    sums = texts.select(F.col(text_col).alias("t")).mapInArrow(add, "bucket int, count long").groupBy("bucket").agg(F.sum("count").alias("count"))
    out = np.zeros(buckets, np.int64)
    for r in sums.collect():
        out[r["bucket"]] = r["count"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of every bucket's smoothed shares in target and source, rounded down."""
    s_all, t_all, many = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log(float((t + 1) * (s_all + many)) / float((s + 1) * (t_all + many))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Thousandths of a Gumbel variate keyed by the id, rounded down."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", n: int = RUN, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)         # ``buckets`` numbers
    kind = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_words", "n_features", "weight", "score"))])

    def run(batches):
        gain = shared.value
        for whole in batches:
            for z in range(0, whole.num_rows, SLICE):
                b = whole.slice(z, SLICE)
                words, many, weight = (np.zeros(b.num_rows, np.int64) for _ in range(3))
                for doc, crc, word in scan(b.column(1), n):
                    words += np.bincount(word, minlength=b.num_rows)
                    many += np.bincount(doc, minlength=b.num_rows)
                    np.add.at(weight, doc, gain[crc % np.uint32(len(gain))])
                luck = np.array([noise(i, seed) for i in b.column(0).to_pylist()], np.int64)
                yield batch(kind, b.column(0), words, many, weight, weight + luck)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, score, ...) with rank 1, 2, 3, ... by falling score, then rising id, nulls last.

    One sort over range partitions; the driver sees one number a partition.
    """
    spark = rows.sparkSession
    named = kept(rows.withColumn("__row", F.monotonically_increasing_id()), "scores")
    order = named.orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "__row")
    placed = kept(order.withColumn("__at", F.monotonically_increasing_id()).drop("__row"), "order")
    part = F.shiftright("__at", 33)
    before, total = [], 0
    for p, size in sorted(tuple(r) for r in placed.groupBy(part).count().collect()):
        before.append((p, total))
        total += size
    base = spark.createDataFrame(before, "__part long, __before long")
    place = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return (placed.withColumn("__part", part).join(F.broadcast(base), "__part")
            .withColumn("rank", F.col("__before") + place + 1).drop("__part", "__before", "__at"))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             rate: int = RATE, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, n: int = RUN, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every row: ``rate`` percent of the texts of ``least_words`` words
    or more are drawn towards the distribution of ``target`` and have a rank; it is null elsewhere."""
    gain = gains(bucket_counts(docs, text_col, buckets, n), bucket_counts(target, target_col, buckets, n))
    weighed = kept(weigh(docs, gain, id_col, text_col, n, seed), "weights")
    able = weighed.where(F.col("n_words") >= least_words)
    draw = rate * able.count() // 100
    none = F.lit(None).cast("long")
    drawn = ranked(able).withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
    return drawn.unionByName(weighed.where(F.col("n_words") < least_words).withColumn("rank", none))
