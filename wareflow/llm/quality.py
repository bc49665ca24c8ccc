"""Text quality by a factorisation machine.

Inputs are the hashed distinct words of a text, weighed by one over the root of
their number, structure statistics (shares of capitals, digits and each mark,
repetition of words and lines, lengths of words and lines) and the metadata
``n_chars``, each as one of a few levels. The score is

    sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)

whose pairwise part is, for each of the ``rank`` factors, half of
(sum_i v_i x_i)^2 - sum_i (v_i x_i)^2: linear in the inputs of a text.

The model is fitted on a bounded sample of labelled rows (the ``sample``
smallest hashes of the ids, one row an id). Words in fewer than ``least_df`` of
them are counted out in Spark, so that only words that weigh come to the driver.
Scoring covers every word of every text.

Null and empty texts have no words: their levels and the metadata alone score.
Null labels, and rows or labels with a null id, are not learned from. Of repeated
labels the largest counts, of repeated ids one row. A table without labels of
both kinds gives the share of label 1 (a half if none) to every row. A null or
absent ``n_chars`` has a level of its own. Empty tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wareflow.llm.common import batch, kept
from wareflow.llm.textblock import MARKS, SPACE, distinct, group, text_bytes, words

BITS = 18
SAMPLE = 10_000
RANK = 8
LEAST_DF = 5
CUT = 0.7
SLICE = 1000
#: Remainder of the fold that labels are never learned from, and the number of folds.
FOLD, FOLDS = 2, 4

_MARK_BYTES = [c for c in range(0x21, 0x7F) if MARKS[c]]
_LINES = np.zeros(256, bool)
_LINES[[0x0A, 0x0B, 0x0C, 0x0D]] = True
_LEVELS = 24


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row's label is never learned from (false for a null id, which has no label)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("long").cast("string").cast("binary")) % FOLDS == FOLD, F.lit(False))


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _tenths(x: np.ndarray) -> np.ndarray:
    return np.clip(np.ceil(x * 10), 0, 10).astype(np.int64)


def _halvings(x: np.ndarray) -> np.ndarray:
    """0 for nothing, then 12 levels of shares from 2**-12 to 1."""
    return np.where(x > 0, np.clip(13 + np.floor(np.log2(np.maximum(x, 2.0 ** -12))), 1, 13), 0).astype(np.int64)


def _doublings(n: np.ndarray) -> np.ndarray:
    return np.where(n > 0, np.clip(1 + np.floor(np.log2(np.maximum(n, 1))), 1, _LEVELS - 1), 0).astype(np.int64)


def _most(doc: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    np.maximum.at(out, doc, count)
    return out


def _per_text(h: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, slot of 32 bits, count) of the distinct hashes of every text."""
    doc = np.repeat(np.arange(len(offs) - 1, dtype=np.uint64), np.diff(offs))
    both, count = distinct(doc << np.uint64(32) | h >> np.uint64(32))
    return (both >> np.uint64(32)).astype(np.int64), (both & np.uint64(0xFFFFFFFF)).astype(np.int64), count


def structure(col, n_chars: np.ndarray) -> np.ndarray:
    """Levels, one column a statistic, of every text; n_chars is -1 where it is not known."""
    data, offsets = text_bytes(col)
    n = len(offsets) - 1
    size = np.diff(offsets)
    sums = lambda hit: np.diff(np.concatenate(([0], np.cumsum(hit, dtype=np.int64)))[offsets])
    h, start, end, offs = words(data, offsets)
    many = np.diff(offs)
    doc, _, count = _per_text(h, offs)
    line, _, _, line_offs = words(data, offsets, between=_LINES)
    lines = np.diff(line_offs)
    line_doc, _, line_count = _per_text(line, line_offs)
    of = np.repeat(np.arange(n), many)
    upper = (data >= 0x41) & (data <= 0x5A)
    letter = upper | (data >= 0x61) & (data <= 0x7A)
    chars = sums((data & 0xC0) != 0x80)
    odd_ends, bare = (np.bincount(of[x], minlength=n) for x in _edges(data, start, end)) if len(of) else (np.zeros(n, np.int64),) * 2
    spots = np.flatnonzero(MARKS[data] & ~SPACE[data])
    text_of = np.searchsorted(offsets, spots, "right") - 1
    marks = np.bincount(text_of * 128 + data[spots], minlength=128 * n).reshape(n, 128)
    again = np.zeros(n, np.int64)
    if len(h) > 1:
        same = np.concatenate(([False], (h[1:] == h[:-1]) & (of[1:] == of[:-1])))
        again = np.bincount(of[same], minlength=n)
    known = np.where(n_chars < 0, 0, np.where(n_chars == chars, 1, np.where(n_chars < chars, 2, 3)))
    cols = [
        _doublings(many), _doublings(lines), _doublings(_share(many, lines)), _halvings(_share(sums(upper), sums(letter))),
        _halvings(_share(sums((data >= 0x30) & (data <= 0x39)), size)), _halvings(_share(sums(data >= 0x80), size)),
        _halvings(_share(marks.sum(axis=1), size)), _tenths(_share(np.bincount(doc, minlength=n), many)),
        _halvings(_share(_most(doc, count, n), many)), _tenths(_share(np.bincount(line_doc, minlength=n), lines)),
        _halvings(_share(_most(line_doc, line_count, n), lines)), np.clip(_share(size, many), 0, _LEVELS - 1).astype(np.int64),
        _tenths(_share(odd_ends, many)), _tenths(_share(bare, many)), _halvings(_share(again, many)),
        np.where(n_chars < 0, 0, _doublings(n_chars + 1)), known]
    cols += [_halvings(_share(marks[:, c], many)) for c in _MARK_BYTES]
    return np.stack(cols, axis=1)


def _edges(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words that end in a mark, and words of one mark alone."""
    last = MARKS[data[end - 1]]
    return last, last & (end - start == 1)


#: Statistics of a text.
WIDTH = 17 + len(_MARK_BYTES)


def inputs(col, n_chars, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, slot, value) of every text's inputs in slot order, and its words; statistics follow the 2**bits word slots."""
    got = np.asarray(n_chars.fill_null(-1).to_numpy(zero_copy_only=False), np.int64) if n_chars is not None else np.full(len(col), -1)
    levels = structure(col, got)
    n = len(levels)
    h, _, _, offs = words(*text_bytes(col), between=MARKS)
    doc, slot, _ = _per_text((h >> np.uint64(64 - bits)) << np.uint64(32), offs)
    weight = 1 / np.sqrt(np.maximum(np.bincount(doc, minlength=n), 1))
    at = (1 << bits) + np.arange(levels.shape[1]) * _LEVELS + levels
    docs = np.concatenate((doc, np.repeat(np.arange(n), levels.shape[1])))
    slots = np.concatenate((slot, at.ravel()))
    values = np.concatenate((weight[doc], np.full(at.size, 1 / np.sqrt(WIDTH))))
    order = np.argsort(docs, kind="stable")
    offsets = np.searchsorted(docs[order], np.arange(n + 1))
    return offsets, slots[order], values[order], np.diff(offs)


@dataclass
class Machine:
    """Sparse factorisation machine: sorted slots with a weight and ``rank`` factors each."""
    slots: np.ndarray
    w: np.ndarray
    v: np.ndarray
    w0: float
    bits: int

    def margin(self, offsets: np.ndarray, slot: np.ndarray, value: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        doc = np.repeat(np.arange(n), np.diff(offsets))
        if not len(self.slots):
            return np.full(n, self.w0)
        i = np.minimum(np.searchsorted(self.slots, slot), len(self.slots) - 1)
        hit = self.slots[i] == slot
        return _margin(doc[hit], i[hit], value[hit], n, self.w0, self.w, self.v)[0]

    def score(self, col, n_chars) -> tuple[np.ndarray, np.ndarray]:
        """(words, score) of every text."""
        offsets, slot, value, n = inputs(col, n_chars, self.bits)
        return n, 1 / (1 + np.exp(-np.clip(self.margin(offsets, slot, value), -30, 30)))


def _margin(doc, at, value, n, w0, w, v):
    """Margins by the sum-of-squares identity, and the sums of each factor."""
    out = w0 + np.bincount(doc, weights=w[at] * value, minlength=n)
    sums = np.empty((v.shape[1], n))
    for f in range(v.shape[1]):
        vx = v[at, f] * value
        sums[f] = np.bincount(doc, weights=vx, minlength=n)
        out += 0.5 * (sums[f] ** 2 - np.bincount(doc, weights=vx * vx, minlength=n))
    return out, sums


def _gradient(doc, at, value, n, m, y, w0, w, v):
    """Mean log loss, and its gradients to w0, w and v, of n texts over m slots."""
    z, sums = _margin(doc, at, value, n, w0, w, v)
    z = np.clip(z, -30, 30)
    loss = np.mean(np.log1p(np.exp(-z)) + (1 - y) * z)
    g = (1 / (1 + np.exp(-z)) - y) / n
    gx = g[doc] * value
    gv = np.empty_like(v)
    for f in range(v.shape[1]):
        gv[:, f] = np.bincount(at, weights=gx * (sums[f][doc] - v[at, f] * value), minlength=m)
    return loss, g.sum(), np.bincount(at, weights=gx, minlength=m), gv


def fit(offsets: np.ndarray, slot: np.ndarray, value: np.ndarray, y: np.ndarray, bits: int = BITS, rank: int = RANK,
        epochs: int = 8, step: float = 0.05, penalty: float = 1e-3, size: int = 256) -> Machine:
    """AdaGrad on the mean log loss with an L2 penalty, over minibatches in a fixed order."""
    share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 0.5
    w0 = float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        return Machine(np.zeros(0, np.int64), np.zeros(0), np.zeros((0, rank)), w0, bits)
    used, _, at = group(slot)
    rnd = np.random.default_rng(13)
    w, v = np.zeros(len(used)), rnd.normal(0, 0.05, (len(used), rank))
    hw, hv, h0 = np.full(len(used), 1e-8), np.full(v.shape, 1e-8), 1e-8
    for _ in range(epochs):
        order = rnd.permutation(len(y))
        for k in range(0, len(y), size):
            pick = np.sort(order[k:k + size])
            many = np.diff(offsets)[pick]
            where = np.repeat(offsets[pick] - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
            mine, _, local = group(at[where])
            _, g0, gw, gv = _gradient(np.repeat(np.arange(len(pick)), many), local, value[where], len(pick), len(mine), y[pick], w0, w[mine], v[mine])
            gw, gv = gw + penalty * w[mine] / len(pick), gv + penalty * v[mine] / len(pick)
            h0 += g0 * g0
            hw[mine] += gw * gw
            hv[mine] += gv * gv
            w0 -= step * g0 / np.sqrt(h0)
            w[mine] -= step * gw / np.sqrt(hw[mine])
            v[mine] -= step * gv / np.sqrt(hv[mine])
    return Machine(used, w, v, w0, bits)


def _rows(docs: DataFrame, id_col: str, text_col: str, chars_col: str | None) -> DataFrame:
    """(doc_id, t, chars)."""
    has = chars_col is not None and chars_col in docs.columns
    chars = F.col(f"`{chars_col}`").cast("long") if has else F.lit(None).cast("long")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"), chars.alias("chars"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars",
          label_col: str = "quality", sample: int = SAMPLE, bits: int = BITS, least_df: int = LEAST_DF, rank: int = RANK) -> Machine:
    """Fit on at most ``sample`` labelled ids, one row each; labels of the held-out fold are never read."""
    rated = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
             .groupBy(F.col(id_col).cast("long").alias("doc_id")).agg((F.max(label_col) > 0).cast("int").alias("label")))
    some = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = _rows(docs, id_col, text_col, chars_col).join(F.broadcast(some), "doc_id").select("doc_id", "label", "t", "chars")
    kind = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("slots", pa.list_(pa.int32())), ("weight", pa.float64())])

    def run(batches):
        for whole in batches:
            for z in range(0, whole.num_rows, SLICE):
                b = whole.slice(z, SLICE)
                offsets, slot, value, _ = inputs(b.column(2), b.column(3), bits)
                yield batch(kind, b.column(0), b.column(1), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(slot, pa.int32())),
                            value[offsets[:-1]])                # of the first word (of a statistic where there is none)

    made = rows.mapInArrow(run, "doc_id long, label int, slots array<int>, weight double")
    once = kept(made.groupBy("doc_id").agg(F.min(F.struct("slots", "weight", "label")).alias("r")).select("doc_id", "r.*"), "quality-sample")
    cells = once.select("doc_id", F.explode("slots").alias("slot"))
    often = cells.groupBy("slot").count().where((F.col("count") >= least_df) | (F.col("slot") >= 1 << bits)).select("slot")
    left = cells.join(often, "slot").groupBy("doc_id").agg(F.array_sort(F.collect_list("slot")).alias("slot"))     # 2**bits words a row at most
    got = once.select("doc_id", "label", "weight").join(left, "doc_id").orderBy("doc_id").toArrow().combine_chunks()
    if not got.num_rows:
        return fit(np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0), bits, rank)
    lists = pa.concat_arrays(got.column("slot").chunks)
    offsets, slot = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy().astype(np.int64)
    value = np.where(slot < 1 << bits, np.repeat(got.column("weight").to_numpy(), np.diff(offsets)), 1 / np.sqrt(WIDTH))
    return fit(offsets, slot, value, got.column("label").to_numpy().astype(float), bits, rank)


def score(docs: DataFrame, model: Machine, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars",
          cut: float = CUT) -> DataFrame:
    """doc_id, held_out, n_words, score, predicted of every row."""
    rows = _rows(docs, id_col, text_col, chars_col)
    shared = rows.sparkSession.sparkContext.broadcast(model)     # a weight and factors for at most 2**bits words and the levels
    kind = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches):
        for whole in batches:
            for z in range(0, whole.num_rows, SLICE):
                b = whole.slice(z, SLICE)
                n, p = shared.value.score(b.column(1), b.column(2))
                yield batch(kind, b.column(0), n, p, (p >= cut).astype(np.int32))

    scored = rows.mapInArrow(run, "doc_id long, n_words long, score double, predicted int")
    return scored.select("doc_id", held_out().alias("held_out"), "n_words", "score", "predicted")
