"""Fill-in-middle transformation by in-place block rotation.

A text is cut into tokens, each a word with the white space before it (white
space at the end is a token of its own). Two cuts keyed by the id part it into
prefix, middle and suffix. The bytes stand in one bytearray, into which a
sentinel is inserted before each part; the parts are then exchanged where they
are, by rotations of three reversals. The inverse finds the sentinels, rotates
back by the same lengths and takes them out, which restores the text exactly: a
text that holds a sentinel is left plain, and no sentinel can arise where parts
meet, since each begins with ``<`` and holds no other.

Forms: ``plain`` (the text), ``psm`` (``<P>``prefix``<S>``suffix``<M>``middle)
and ``spm`` (``<S>``suffix``<P>``prefix``<M>``middle).

Null and empty texts are plain and empty. A null id draws as an empty one;
repeated ids draw alike, each row by itself. Empty tables give empty results.
Texts may be of any length; a task holds a few copies of one batch.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wareflow.llm.common import batch
from wareflow.llm.textblock import SPACE, text_bytes, words

SEED = 42
#: Percent of texts transformed, and of those the percent in form spm.
RATE, SPM_RATE = 50, 80
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SLICE = 1000

COLUMNS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four 32-bit numbers keyed by the id."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[i:i + 8], 16) for i in range(0, 32, 8)]


def rotate(buf: bytearray, start: int, mid: int, end: int) -> None:
    """Exchange the neighbours [start, mid) and [mid, end) of ``buf`` where they stand, by three reversals."""
    view = np.frombuffer(buf, np.uint8)
    for a, z in ((start, mid), (mid, end), (start, end)):
        half = (z - a) // 2
        low, high = view[a:a + half], view[z - half:z][::-1]
        kept = low.copy()
        low[:] = high
        high[:] = kept


def weave(text: bytes, cut: int, cut2: int, form: str) -> bytes:
    """Sentinels inserted before the three parts and the parts brought into the order of ``form``."""
    buf = bytearray(text)
    buf[cut2:cut2] = SUFFIX
    buf[cut:cut] = MIDDLE
    buf[0:0] = PREFIX
    middle = cut + len(PREFIX)                                 # <P>prefix | <M>middle | <S>suffix
    suffix = cut2 + len(PREFIX) + len(MIDDLE)
    rotate(buf, middle if form == "psm" else 0, suffix, len(buf))
    return bytes(buf)


def unweave(output: bytes, form: str) -> bytes:
    """The text that :func:`weave` was given."""
    if form == "plain":
        return output
    buf = bytearray(output)
    if form == "psm":                                          # <P>prefix | <S>suffix | <M>middle
        at, mid = buf.index(SUFFIX), buf.index(MIDDLE)
    else:                                                      # <S>suffix | <P>prefix<M>middle
        at, mid = 0, buf.index(PREFIX)
    size = mid - at                                            # of <S>suffix
    rotate(buf, at, mid, len(buf))
    suffix = len(buf) - size
    del buf[suffix:suffix + len(SUFFIX)]
    middle = buf.index(MIDDLE)
    del buf[middle:middle + len(MIDDLE)]
    del buf[0:len(PREFIX)]
    return bytes(buf)


def _chars(data: np.ndarray) -> int:
    """Code points of UTF-8 bytes."""
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: int = RATE, spm_rate: int = SPM_RATE,
              seed: int = SEED) -> DataFrame:
    """doc_id, n (tokens), form, prefix_chars, middle_chars (code points, null if plain), output of every row."""
    kind = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                      ("middle_chars", pa.int64()), ("output", pa.binary())])
    out_kind = pa.schema([*list(kind)[:-1], pa.field("output", pa.string())])

    def run(batches):
        for whole in batches:
            for z in range(0, whole.num_rows, SLICE):
                b = whole.slice(z, SLICE)
                data, offsets = text_bytes(b.column(1))
                _, _, ends, first = words(data, offsets)
                rows = []
                for i, doc_id in enumerate(b.column(0).to_pylist()):
                    lo, hi = int(offsets[i]), int(offsets[i + 1])
                    cuts = ends[first[i]:first[i + 1]]
                    n = len(cuts) + (hi > lo and bool(SPACE[data[hi - 1]]))
                    h1, h2, h3, h4 = draws(doc_id, seed)
                    text = data[lo:hi].tobytes()
                    if not text or h3 % 100 >= rate or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
                        rows.append((n, "plain", None, None, text))
                        continue
                    a, c = (hi - lo if k == n else int(cuts[k - 1]) - lo if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1))))
                    form = "spm" if h4 % 100 < spm_rate else "psm"
                    rows.append((n, form, _chars(data[lo:lo + a]), _chars(data[lo + a:lo + c]), weave(text, a, c, form)))
                made = batch(kind, b.column(0), *([r[k] for r in rows] for k in range(5)))
                yield pa.RecordBatch.from_arrays([*made.columns[:-1], made.column(5).view(pa.string())], schema=out_kind)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t")).mapInArrow(run, COLUMNS)


def restore(rows: DataFrame, output_col: str = "output", form_col: str = "form") -> DataFrame:
    """``rows`` (of unlike column names) with a column ``restored``: the text, from output and form alone.

    A null output or form gives null.
    """
    names = [c for c in rows.columns if c != "restored"]
    at, how = names.index(output_col), names.index(form_col)

    def run(batches):
        for whole in batches:
            for z in range(0, whole.num_rows, SLICE):
                b = whole.slice(z, SLICE)
                data, offsets = text_bytes(b.column(at))
                known, forms = b.column(at).is_valid().to_pylist(), b.column(how).to_pylist()
                back = [unweave(data[offsets[i]:offsets[i + 1]].tobytes(), f) if f is not None and known[i] else None for i, f in enumerate(forms)]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(back, pa.binary()).view(pa.string())], names=[*names, "restored"])

    mine = rows.select(*[F.col(f"`{c}`") for c in names])
    from pyspark.sql import types as T
    return mine.mapInArrow(run, T.StructType([*mine.schema.fields, T.StructField("restored", T.StringType())]))
