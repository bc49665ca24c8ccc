"""Toxicity severity by cumulative-link ordinal regression.

Features are the distinct lower-cased words of a text, hashed to ``2**bits``
slots. One weight vector w is shared by all thresholds t_1 < t_2 < ...:
P(severity >= k) = sigmoid(w.x - t_k). The expected severity is the sum of these
probabilities. The model is fitted on a bounded sample of labelled rows (the
``sample`` smallest hashes of the labelled ids, one row of each); words without evidence
weigh nothing. Scoring covers every word of every text.

Labels that hold only 0 and 1 are graded first: toxic rows with more distinct
evidence words than the median toxic row get grade 2, the others grade 1.
Labels with more grades are used as they are.

Null and empty texts have no words and score with the thresholds alone; null
labels are left out; a table without labels of both kinds gives a model that
rejects nothing. Null or repeated ids keep their rows; one row of a repeated id is
learned from. Of repeated labels the largest counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wareflow.llm.common import batch, kept, tidy
from wareflow.llm.textblock import MARKS, distinct, text_bytes, words

BITS = 20
SAMPLE = 20_000
SLICE = 1000
#: P(severity >= 1) from which a text is toxic.
CUT = 0.25


@dataclass
class Ordinal:
    """Sparse weights (sorted slots and their values) and ascending thresholds."""
    slots: np.ndarray
    weights: np.ndarray
    cuts: np.ndarray
    bits: int

    def score(self, col) -> tuple[np.ndarray, np.ndarray]:
        """(number of words, P(severity >= k) for each k) of every text."""
        doc, slot, value, n = features(col, self.bits)
        z = np.zeros(len(n))
        if len(self.slots):
            i = np.minimum(np.searchsorted(self.slots, slot), len(self.slots) - 1)
            hit = self.slots[i] == slot
            z = np.bincount(doc[hit], weights=self.weights[i[hit]] * value[hit], minlength=len(n))
        return n, 1 / (1 + np.exp(-np.clip(z[:, None] - self.cuts[None, :], -60, 60)))


def features(col, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text index, slot, 1 + log2 of its count) of every distinct word slot, and the words of each text."""
    h, _, _, offs = words(*text_bytes(col), between=MARKS)
    n = np.diff(offs)
    doc = np.repeat(np.arange(len(n), dtype=np.uint64), n)
    both, count = distinct(doc << np.uint64(32) | h >> np.uint64(64 - bits))
    return (both >> np.uint64(32)).astype(np.int64), (both & np.uint64(0xFFFFFFFF)).astype(np.int64), 1 + np.log2(count), n


def evidence(doc: np.ndarray, slot: np.ndarray, y: np.ndarray, bits: int, least_df: int, least_z: float) -> np.ndarray:
    """Slots whose rows are mostly toxic, and more often than chance explains."""
    base = (y > 0).mean()
    df = np.bincount(slot, minlength=1 << bits)
    up = np.bincount(slot[y[doc] > 0], minlength=1 << bits)
    z = (up - df * base) / np.sqrt(np.maximum(df, 1) * max(base * (1 - base), 1e-9))
    return np.flatnonzero((df >= least_df) & (z >= least_z) & (2 * up > df))


def grade(doc: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Severity grades of binary labels; doc: the row of each evidence word."""
    if y.max(initial=0) > 1:
        return y
    held = np.bincount(doc, minlength=len(y))
    return np.where(y > 0, 1 + (held > np.median(held[y > 0])), 0)


def fit(doc: np.ndarray, slot: np.ndarray, value: np.ndarray, y: np.ndarray, bits: int = BITS, penalty: float = 1e-6, steps: int = 3000,
        least_df: int = 5, least_z: float = 5.0) -> Ordinal:
    """Minimise the mean negative log-likelihood of the cumulative-link model plus an L1 penalty (Adam, projected).

    Weights are not negative: words add severity, and clean words around them take
    none away. They start at the words' log odds. Slots in fewer than ``least_df``
    sample rows, or whose rows are not toxic more often than the rest by
    ``least_z`` standard deviations, get no weight.
    """
    if not (y > 0).any() or not (y == 0).any():
        return Ordinal(np.zeros(0, np.int64), np.zeros(0), np.full(1, 30.0), bits)
    n, base = len(y), (y > 0).mean()
    used = evidence(doc, slot, y, bits, least_df, least_z)
    held = np.isin(slot, used)
    doc, value, col, m = doc[held], value[held], np.searchsorted(used, slot[held]), len(used)
    df, up = np.bincount(col, minlength=m), np.bincount(col[y[doc] > 0], minlength=m)
    y = grade(doc, y)
    top = int(y.max())
    above = (y[:, None] > np.arange(top)[None, :]).mean(axis=0)        # share of severity >= k
    share = np.clip(above, 1 / n, 1 - 1 / n)
    cuts = np.maximum.accumulate(-np.log(share / (1 - share)) + 1)
    w = np.log((up + 0.5) / (df - up + 0.5) * (1 - base) / base)
    m1, m2 = np.zeros(m + top), np.zeros(m + top)
    for step in range(1, steps + 1):
        g_z, g_c = _gradient(np.bincount(doc, weights=w[col] * value, minlength=n), cuts, y)
        g = np.concatenate((np.bincount(col, weights=g_z[doc] * value, minlength=m) + penalty, g_c))
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        move = 0.02 * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-10)
        w = np.maximum(0, w - move[:m])
        cuts = np.maximum.accumulate(cuts - move[m:]) + np.arange(top) * 1e-6
    keep = np.flatnonzero(w)
    return Ordinal(used[keep], w[keep], cuts, bits)


def _gradient(z: np.ndarray, cuts: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the mean loss to z and to the thresholds; P(y=k) = s(z-t_k) - s(z-t_{k+1})."""
    n = len(y)
    s = 1 / (1 + np.exp(-np.clip(z[:, None] - cuts[None, :], -40, 40)))
    d = s * (1 - s)
    hi = np.hstack((np.ones((n, 1)), s))
    lo = np.hstack((s, np.zeros((n, 1))))
    dhi = np.hstack((np.zeros((n, 1)), d))
    dlo = np.hstack((d, np.zeros((n, 1))))
    rows = np.arange(n)
    p = np.maximum(hi[rows, y] - lo[rows, y], 1e-9)
    gz = -(dhi[rows, y] - dlo[rows, y]) / p / n
    gc = np.zeros(len(cuts))
    np.add.at(gc, y[y > 0] - 1, (dhi[rows, y] / p / n)[y > 0])
    np.add.at(gc, y[y < len(cuts)], (-dlo[rows, y] / p / n)[y < len(cuts)])
    return gz, gc


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          sample: int = SAMPLE, bits: int = BITS, least_df: int = 5, least_z: float = 5.0) -> Ordinal:
    """Fit on at most ``sample`` labelled rows, one an id.

    Slots are counted in Spark; the driver gets the rows' labels and the few slots that are evidence.
    """
    rated = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).cast("long").alias("label_id")).agg(F.max(label_col).cast("int").alias("label")))
    some = rated.orderBy(F.xxhash64("label_id"), "label_id").limit(sample)
    rows = docs.select(F.col(id_col).cast("long").alias("label_id"), F.col(text_col).alias("t"))
    rows = rows.join(F.broadcast(some), "label_id").select("label_id", F.greatest("label", F.lit(0)).alias("label"), "t")
    kind = pa.schema([("label_id", pa.int64()), ("label", pa.int32()), ("slots", pa.list_(pa.int32())), ("values", pa.list_(pa.float32()))])

    def collect(batches):
        for b in _slices(batches):
            doc, slot, value, n = features(b.column(2), bits)
            at = pa.array(np.searchsorted(doc, np.arange(len(n) + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(x, t)) for x, t in ((slot, pa.int32()), (value, pa.float32()))]
            yield batch(kind, b.column(0), b.column(1), *lists)

    made = rows.mapInArrow(tidy(collect), "label_id long, label int, slots array<int>, values array<float>")
    one = made.groupBy("label_id").agg(F.min(F.struct("label", "slots", "values")).alias("r")).select("label_id", "r.*")
    once = kept(one.groupBy("label", "slots", "values").agg(F.min("label_id").alias("id")), "toxicity-sample")     # copies are no more evidence
    ids, y = (c.to_numpy() for c in once.select("id", "label").orderBy("label", "id").toArrow().columns)
    counts = pa.schema([("slot", pa.int32()), ("df", pa.int64()), ("up", pa.int64())])

    def count(batches):
        for b in _slices(batches):
            slots, size = _flat(b.column(2))
            toxic = np.repeat(b.column(1).to_numpy() > 0, size)
            u, df = distinct(slots)
            v, up = distinct(slots[toxic])
            both = np.zeros(len(u), np.int64)
            both[np.searchsorted(u, v)] = up
            yield batch(counts, u, df, both)

    seen = (once.select("id", "label", "slots").mapInArrow(tidy(count), "slot int, df long, up long")
            .groupBy("slot").agg(F.sum("df").alias("df"), F.sum("up").alias("up")))
    base = float((y > 0).mean()) if len(y) else 0.0
    chance = F.sqrt(F.col("df") * F.lit(max(base * (1 - base), 1e-9)))
    used = seen.where((F.col("df") >= least_df) & ((F.col("up") - F.col("df") * base) / chance >= least_z) & (2 * F.col("up") > F.col("df")))
    known = docs.sparkSession.sparkContext.broadcast(np.sort(used.select("slot").toArrow().column(0).to_numpy()))     # 2**bits slots at most
    cells = pa.schema([("id", pa.int64()), ("slot", pa.int32()), ("value", pa.float32())])

    def held(batches):
        for b in _slices(batches):
            slots, size = _flat(b.column(1))
            hit = np.flatnonzero(np.isin(slots, known.value))
            yield batch(cells, np.repeat(b.column(0).to_numpy(), size)[hit], slots[hit], _flat(b.column(2))[0][hit])

    got = once.select("id", "slots", "values").mapInArrow(tidy(held), "id long, slot int, value float").toArrow()
    known.unpersist()
    doc, slot, value = (c.to_numpy() for c in got.columns)
    by_id = np.argsort(ids)
    at = by_id[np.searchsorted(ids, doc, sorter=by_id)] if len(doc) else np.zeros(0, np.int64)
    order = np.lexsort((slot, at))
    return fit(at[order], slot[order].astype(np.int64), value[order].astype(float), y.astype(np.int64), bits, least_df=least_df, least_z=least_z)


def _slices(batches):
    """Some rows at a time: the arrays of a slice are many times its text."""
    for b in batches:
        for z in range(0, b.num_rows, SLICE):
            yield b.slice(z, SLICE)


def _flat(lists) -> tuple[np.ndarray, np.ndarray]:
    """(all values one after another, how many each row has) of a list column without nulls."""
    at = lists.offsets.to_numpy()
    return lists.values.to_numpy(zero_copy_only=False)[at[0]:at[-1]], np.diff(at)


def score(docs: DataFrame, model: Ordinal, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT) -> DataFrame:
    """doc_id, n_words, p_toxic = P(severity >= 1), expected_severity, grade (most likely), toxic of every row."""
    return _scored(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t")), model, cut).drop("row")


def reject(docs: DataFrame, model: Ordinal, text_col: str = "text", cut: float = CUT) -> DataFrame:
    """The rows that are not toxic, with the columns of ``docs``."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("t"))
    return _scored(rows, model, cut).where("NOT toxic").select("row.*")


def _scored(rows: DataFrame, model: Ordinal, cut: float) -> DataFrame:
    """First column kept, text in the second."""
    name = rows.columns[0]
    shared = rows.sparkSession.sparkContext.broadcast(model)     # at most a weight for each of 2**bits slots

    def run(batches):
        for b in _slices(batches):
            n, p = shared.value.score(b.column(1))
            of = np.hstack((np.ones((len(n), 1)), p)) - np.hstack((p, np.zeros((len(n), 1))))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(p[:, 0]), pa.array(p.sum(axis=1)), pa.array(of.argmax(axis=1), pa.int32()),
                 pa.array(p[:, 0] >= cut)], names=[name, "n_words", "p_toxic", "expected_severity", "grade", "toxic"])

    from pyspark.sql import types as T
    schema = T.StructType([rows.schema[0], *T._parse_datatype_string(
        "n_words long, p_toxic double, expected_severity double, grade int, toxic boolean").fields])
    return rows.mapInArrow(tidy(run), schema)
