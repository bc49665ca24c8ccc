"""Token counts without ids.

Every text is cut into pre-tokens (chunks that the tokenizer splits one by
one). Pass 1 gathers the distinct pre-tokens of the corpus with their
frequencies; each distinct one is tokenised once and gives a table
(hash, pieces, frequency). Pass 2 makes per-document pre-token frequencies and
joins them to that table. The most frequent pre-tokens, ``head`` at most, travel
as a broadcast array of 12 bytes each, so the hot keys of the join never reach
a shuffle; all other frequencies go through a shuffled join. Both parts are
exact. Texts that cannot be cut (a special token's string, white space beyond
ASCII) are counted whole by the library.

Null and empty texts have 0 bytes and 0 tokens; a null or repeated id keeps its
rows, one output row for each input row; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wareflow.llm.common import batch, kept
from wareflow.llm.pieces import Pieces, default_tokenizer
from wareflow.llm.textblock import chunks, distinct, group, lookup, pieces, text_bytes

#: Pre-tokens whose counts are broadcast: 12 bytes each, so 12 MB.
HEAD = 1 << 20


def pretoken_table(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Distinct pre-tokens of the corpus: hash, pieces (tokens of each), freq (occurrences)."""
    path = tokenizer or default_tokenizer()
    local = pa.schema([("piece", pa.string()), ("freq", pa.int64())])

    def gather(batches):
        model = Pieces.of(path)
        for b in batches:
            data, offs = text_bytes(b.column(0))
            ok = model.plain(data, offs)
            plain = b.column(0).filter(pa.array(ok))
            data, offs = text_bytes(plain)
            hs, ss, es = [], [], []
            for lo, hi in pieces(data, offs):
                h, s, e = chunks(data, offs, lo, hi)
                u, first, back = group(h)
                hs.append((u, np.bincount(back, minlength=len(u))))
                ss.append(s[first])
                es.append(e[first])
            if not hs:
                continue
            h, n = (np.concatenate(x) for x in zip(*hs))
            s, e = np.concatenate(ss), np.concatenate(es)
            u, first, back = group(h)
            freq = np.bincount(back, weights=n, minlength=len(u)).astype(np.int64)
            raw = data.tobytes()
            yield batch(local, [raw[a:z].decode() for a, z in zip(s[first].tolist(), e[first].tolist())], freq)

    table = pa.schema([("hash", pa.int64()), ("pieces", pa.int32()), ("freq", pa.int64())])

    def count(batches):
        model = Pieces.of(path)
        for b in batches:
            data, offs = text_bytes(b.column(0))
            n = model.chunk_sizes(b.column(0).to_pylist()).astype(np.int32)
            yield batch(table, _whole_hashes(data, offs).view(np.int64), n, b.column(1))

    seen = docs.select(F.col(text_col).alias("t")).mapInArrow(gather, "piece string, freq long")
    once = seen.groupBy("piece").agg(F.sum("freq").alias("freq"))
    return once.mapInArrow(count, "hash long, pieces int, freq long")


def _whole_hashes(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """The hash :func:`textblock.chunks` gives to each value taken as one chunk."""
    from wareflow.llm import textblock as tb
    out = np.zeros(len(offs) - 1, np.uint64)
    step = 65536
    for i in range(0, len(out), step):
        o = offs[i:i + step + 1]
        out[i:i + step] = tb._slice_hashes(data[o[0]:o[-1]], o[:-1] - o[0], o[1:] - o[0], tb._raw)
    return out


def _head(table: DataFrame, head: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, pieces) of the most frequent pre-tokens, by a frequency threshold."""
    level = F.floor(F.log2("freq") * 4)
    sizes = sorted(((r[0], r[1]) for r in table.groupBy(level).count().collect()), reverse=True)  # a few hundred levels
    least, total = None, 0
    for lev, n in sizes:
        if total + n > head:
            break
        least, total = lev, total + n
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    got = table.where(level >= least).select("hash", "pieces").toArrow()
    h = got.column(0).to_numpy().view(np.uint64)
    order = np.argsort(h)
    return h[order], got.column(1).to_numpy()[order]


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 512,
                 tokenizer: str | None = None, head: int = HEAD) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``) of every row."""
    path = tokenizer or default_tokenizer()
    spark = docs.sparkSession
    table = kept(pretoken_table(docs, text_col, path), "pretokens")
    hot_h, hot_n = _head(table, head)
    hot = spark.sparkContext.broadcast((hot_h, hot_n))
    out = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("base", pa.int64()),
                     ("rare", pa.list_(pa.struct([("hash", pa.int64()), ("freq", pa.int32())])))])

    def frequencies(batches):
        known, known_n = hot.value
        model = Pieces.of(path)
        for b in batches:
            data, offs = text_bytes(b.column(2))
            ok = model.plain(data, offs)
            base = np.zeros(len(ok), np.int64)
            docs_, hash_, freq_ = [], [], []
            for i in np.flatnonzero(~ok):
                base[i] = len(model.encode([data[offs[i]:offs[i + 1]].tobytes().decode()])[0])
            for lo, hi in pieces(data, offs):
                h, s, _ = chunks(data, offs, lo, hi)
                doc = np.searchsorted(offs, s, "right") - 1
                h, doc = h[ok[doc]], doc[ok[doc]]
                u, _, back = group(h)
                at = lookup(known, u)
                n = np.where(at >= 0, known_n[at] if len(known_n) else 0, 0)[back]
                base += np.bincount(doc, weights=n, minlength=len(ok)).astype(np.int64)
                far = at[back] < 0
                pair, freq = distinct(doc[far].astype(np.uint64) << np.uint64(32) | back[far].astype(np.uint64))
                docs_.append((pair >> np.uint64(32)).astype(np.int64))
                hash_.append(u[(pair & np.uint64(0xFFFFFFFF)).astype(np.int64)])
                freq_.append(freq)
            doc = np.concatenate(docs_) if docs_ else np.zeros(0, np.int64)
            ends = np.searchsorted(doc, np.arange(len(ok) + 1)).astype(np.int32)   # pieces follow the documents' order
            pairs = pa.StructArray.from_arrays(
                [pa.array(np.concatenate(hash_).view(np.int64) if hash_ else [], pa.int64()),
                 pa.array(np.concatenate(freq_).astype(np.int32) if freq_ else [], pa.int32())], fields=list(out.field(4).type.value_type))
            yield batch(out, b.column(0), b.column(1), np.diff(offs), base, pa.ListArray.from_arrays(pa.array(ends), pairs, type=out.field(4).type))

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    rows = rows.mapInArrow(frequencies, "row long, doc_id long, n_bytes long, base long, rare array<struct<hash:long,freq:int>>")
    each = rows.select("row", "doc_id", "n_bytes", "base", F.explode_outer("rare").alias("p"))
    each = each.select("row", "doc_id", "n_bytes", "base", F.col("p.freq").alias("freq"),
                       F.coalesce("p.hash", F.xxhash64("row")).alias("hash"))    # no hot null key
    joined = each.join(table.select("hash", "pieces"), "hash", "left")
    total = F.first("base") + F.coalesce(F.sum(F.col("freq") * F.col("pieces")), F.lit(0))
    return (joined.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_bytes").alias("n_bytes"), total.alias("n_tokens"))
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
