"""Training-order materialisation of token sequences.

The ids of every document plus an end id form one stream per input partition,
cut into sequences of ``seq_len`` ids. The texts are encoded once: a first pass
writes the sequences, compressed, and their number in each partition gives every
sequence a global index. A keyed Feistel
network over the next even power of two, walked until it lands below the number
of sequences, maps the index to its slot in training order. Slots are dealt by
range, ``per_shard`` to a shard; each shard is one task, which writes its slots
in order at a fixed stride, so a reader can seek to any slot and resume there.
A shard is written under a name of the attempt and moved into place.

The input is read once, and the sequences of the first pass are dropped when the
shards are written. Null and empty texts add their end id alone; null ids and repeated rows are kept; an empty table
writes no shard and gives an empty manifest. Only the last sequence of a
partition can be short; it is padded with the end id and its count recorded.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wareflow.llm.common import batch, discard, filesystem, kept, put_file
from wareflow.llm.packing import _with_end
from wareflow.llm.pieces import Pieces, default_tokenizer
from wareflow.llm.textblock import mix
from wareflow.session import scratch_path

SEQ_LEN = 2048
PER_SHARD = 4096
ROUNDS = 6


def _round_keys(key: int, rounds: int) -> np.ndarray:
    return mix(np.arange(1, rounds + 1, dtype=np.uint64) + mix(np.array([key], np.uint64)))


def permute(index: np.ndarray, size: int, key: int = 0, rounds: int = ROUNDS) -> np.ndarray:
    """A keyed permutation of range(size): balanced Feistel rounds with cycle walking."""
    half = np.uint64(max(1, ((size - 1).bit_length() + 1) // 2))
    low = (np.uint64(1) << half) - np.uint64(1)
    keys = _round_keys(key, rounds)

    def once(v):
        left, right = v >> half, v & low
        for k in keys:
            left, right = right, left ^ (mix(right + k) & low)
        return left << half | right

    out = once(index.astype(np.uint64))
    while (far := np.flatnonzero(out >= size)).size:
        out[far] = once(out[far])
    return out.astype(np.int64)


def write_shards(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", seq_len: int = SEQ_LEN,
                 per_shard: int = PER_SHARD, key: int = 17, end_id: int = 50256, tokenizer: str | None = None) -> DataFrame:
    """Write the shards below ``folder`` and return the manifest, one row per sequence."""
    path = tokenizer or default_tokenizer()
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    cut_schema = pa.schema([("pid", pa.int64()), ("seq", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()),
                            ("n_tokens", pa.int32()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])
    kind = np.dtype("<u2" if Pieces.of(path).tok.get_vocab_size() <= 65536 else "<u4")

    def sequences(batches):
        model, pid = Pieces.of(path), TaskContext.get().partitionId()
        at, rest, rest_doc = 0, np.zeros(0, np.uint32), (None, 0)

        def cut(ids, starts, last):
            nonlocal at
            n = -(-len(ids) // seq_len) if last else len(ids) // seq_len
            cols = [[], [], [], [], [], [], []]
            pos = np.array([s[0] for s in starts])
            for k in range(n):
                part = ids[k * seq_len:(k + 1) * seq_len]
                s = starts[np.searchsorted(pos, k * seq_len, "right") - 1]
                data = np.concatenate((part, np.full(seq_len - len(part), end_id, np.uint32))).astype(kind).tobytes()
                for c, v in zip(cols, (pid, at + k, s[1], s[2] + k * seq_len - s[0], len(part), zlib.crc32(data), data)):
                    c.append(v)
            at += n
            return cols, n * seq_len

        for b in batches:
            names = b.column(0).to_pylist()
            parts, starts, held = [rest], [(0, *rest_doc)], len(rest)
            for i, ids in _with_end(model, b.column(1), end_id):
                starts.append((held, names[i], 0))
                parts.append(ids)
                held += len(ids)
                if held >= 512 * seq_len:
                    rest, rest_doc, done = yield_rest(parts, starts, cut)
                    yield batch(cut_schema, *done)
                    parts, starts, held = [rest], [(0, *rest_doc)], len(rest)
            rest, rest_doc, done = yield_rest(parts, starts, cut)
            yield batch(cut_schema, *done)
        if len(rest):
            yield batch(cut_schema, *cut(rest, [(0, *rest_doc)], True)[0])

    def yield_rest(parts, starts, cut):
        ids = np.concatenate(parts)
        cols, used = cut(ids, starts, False)
        s = starts[int(np.searchsorted(np.array([x[0] for x in starts]), used, "right")) - 1]
        return ids[used:], (s[1], s[2] + used - s[0]), cols

    cuts = kept(texts.mapInArrow(sequences, "pid long, seq long, doc_id long, start long, n_tokens int, ids_crc32 long, ids binary"), "sequences", "zstd")
    first, total = {}, 0
    for pid, n in sorted(tuple(r) for r in cuts.groupBy("pid").count().collect()):      # a row per input partition
        first[pid] = total
        total += n
    base = spark.sparkContext.broadcast(first)
    row = pa.schema([("shard", pa.int32()), ("slot", pa.int64()), *list(cut_schema)[2:]])

    def slots(batches):
        codec = pa.Codec("zstd", 3)         # the exchange moves ids alone; a sequence is packed by itself
        for b in batches:
            pid, seq = b.column(0).to_numpy(), b.column(1).to_numpy()
            slot = permute(np.array([base.value[p] for p in pid.tolist()], np.int64) + seq, total, key)
            packed = pa.array([codec.compress(x.as_buffer(), asbytes=True) for x in b.column(6)], pa.binary())
            yield batch(row, (slot // per_shard).astype(np.int32), slot, *(b.column(i) for i in range(2, 6)), packed)

    dealt = cuts.mapInArrow(slots, "shard int, slot long, doc_id long, start long, n_tokens int, ids_crc32 long, ids binary")
    shards = max(1, -(-total // per_shard))
    dealt = dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions("slot")
    stride = seq_len * kind.itemsize
    done = pa.schema([("slot", pa.int64()), ("shard", pa.int32()), ("byte_offset", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()),
                      ("n_tokens", pa.int32()), ("ids_crc32", pa.int64())])

    def write(batches):
        held, rows, shard, codec = [], [], None, pa.Codec("zstd", 3)
        for b in batches:
            if b.num_rows:
                shard = b.column(0)[0].as_py()
                slot = b.column(1).to_numpy()
                rows.append(batch(done, b.column(1), b.column(0), slot % per_shard * stride, b.column(2), b.column(3), b.column(4), b.column(5)))
                held.append(b"".join(codec.decompress(x.as_buffer(), stride, asbytes=True) for x in b.column(6)))
        if shard is not None:
            put_file(folder, f"shard-{shard:07d}.bin", *held)
        yield from rows

    manifest = dealt.mapInArrow(write, "slot long, shard int, byte_offset long, doc_id long, start long, n_tokens int, ids_crc32 long")
    manifest.write.parquet(f"{folder}/manifest")
    discard(cuts)
    return spark.read.schema(manifest.schema).parquet(f"{folder}/manifest")


def read_slots(folder: str, first: int, count: int, seq_len: int = SEQ_LEN, per_shard: int = PER_SHARD, dtype: str = "<u2"):
    """Sequences of the slots first..first+count-1, read by seeking; resume at any slot."""
    store, path = filesystem(folder)
    stride, slot = seq_len * np.dtype(dtype).itemsize, first
    while slot < first + count:
        shard, at = divmod(slot, per_shard)
        take = min(per_shard - at, first + count - slot)
        with store.open_input_file(f"{path}/shard-{shard:07d}.bin") as f:
            f.seek(at * stride)
            data = f.read(take * stride)
        yield from np.frombuffer(data, dtype).reshape(-1, seq_len)
        slot += take


def default_folder(spark) -> str:
    return scratch_path(spark, "token-shards")
