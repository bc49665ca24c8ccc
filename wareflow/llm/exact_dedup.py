"""Exact duplicates by compressed radix tries.

Texts are equal when the same bytes remain after deleting the ASCII white space
``[\\x20\\x09-\\x0D]``. Rows are dealt by (byte length, content hash); the task
that owns a partition inserts the full byte strings into Patricia tries, one a
length, and the terminal node of each string holds the row that stays: the one
with the most code points in its original text, then the smallest id (null ids
last). Before the shuffle every task runs the same trie over its own rows and
sends one row per distinct text, so that a text which a third of all rows share
arrives at most once from each task and flush. Tries are cut by the first hash
byte of their texts; when a partition outgrows ``trie_bytes``, the largest of
those subtrees goes to a temporary file of the task and is finished by itself
after the others.

Null texts count as empty and are one group. Rows that repeat id and text are
members of one group; ``owners`` keeps one row of them. Whitespace-only texts
equal the empty text. An empty table gives an empty result. Other columns are
carried untouched whatever their names, since they travel in one struct.
"""

from __future__ import annotations

import tempfile

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wareflow.llm.common import tidy

TRIE_BYTES = 48 << 20
DROPPED = "\x20\x09\x0a\x0b\x0c\x0d"


class Node:
    """An edge label, children by first byte, and the value of the string that ends here."""
    __slots__ = ("label", "next", "value")

    def __init__(self, label: bytes = b"", value=None):
        self.label, self.next, self.value = label, {}, value


def common(a: bytes, at: int, b: bytes) -> int:
    """Length of the common prefix of a[at:] and b, halving the range with whole compares."""
    if a.startswith(b, at):
        return len(b)
    lo, hi = 0, min(len(b), len(a) - at)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[at + lo:at + mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def insert(root: Node, key: bytes) -> Node:
    """The terminal node of ``key``, made if it is new (value None then)."""
    node, at = root, 0
    while at < len(key):
        child = node.next.get(key[at])
        if child is None:
            node.next[key[at]] = leaf = Node(key[at:])
            return leaf
        n = common(key, at, child.label)
        if n < len(child.label):               # split the edge
            upper = Node(child.label[:n])
            child.label = child.label[n:]
            upper.next[child.label[0]] = child
            node.next[key[at]] = child = upper
        node, at = child, at + n
    return node


class Owners:
    """Tries over the rows of one task: best row and count of each distinct text.

    Rows come as Arrow batches with columns text, sha, chars, id, n, row. Those
    of the best rows are held as slices of their batches until they are given out.
    """

    def __init__(self, schema: pa.Schema, limit: int, spill: bool):
        self.schema, self.limit, self.spill = schema, limit, spill
        self.files: dict[int, pa.ipc.RecordBatchStreamWriter] = {}
        self.sinks: dict[int, object] = {}
        self._reset()

    def _reset(self) -> None:
        self.roots: dict[int, dict[int, Node]] = {}      # by first hash byte, then length
        self.terminals: dict[int, list[Node]] = {}
        self.rows: list[pa.RecordBatch] = []
        self.size: dict[int, int] = {}

    def add(self, batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        texts, shas = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        chars, ids, counts = (batch.column(i).to_pylist() for i in (2, 3, 4))
        k, away = len(self.rows), {}
        self.rows.append(batch)
        for i, (text, sha, n, doc, count) in enumerate(zip(texts, shas, chars, ids, counts)):
            part = sha[0]
            if part in self.files:
                away.setdefault(part, []).append(i)
                continue
            root = self.roots.setdefault(part, {}).setdefault(len(text), Node())
            node = insert(root, text)
            rank = (-n, doc is None, doc or 0)
            if node.value is None:
                node.value = [rank, k, i, count]
                self.terminals.setdefault(part, []).append(node)
                self.size[part] = self.size.get(part, 0) + 2 * len(text) + 400
            else:
                node.value[3] += count
                if rank < node.value[0]:
                    node.value[:3] = rank, k, i
        for part, at in away.items():
            self.files[part].write_batch(batch.take(pa.array(at)))
        out = []
        if sum(self.size.values()) > self.limit:
            if not self.spill:
                out = self.flush()
            else:
                while sum(self.size.values()) > self.limit // 2:
                    self._spill(max(self.size, key=self.size.get))
        elif len(self.rows) > 8:
            self._compact()
        return out

    def _best(self, parts) -> pa.RecordBatch | None:
        nodes = [n for p in parts for n in self.terminals.get(p, ())]
        if not nodes:
            return None
        nodes.sort(key=lambda n: n.value[1:3])
        picked, counts, i = [], [], 0
        while i < len(nodes):
            k, at = nodes[i].value[1], []
            while i < len(nodes) and nodes[i].value[1] == k:
                at.append(nodes[i].value[2])
                counts.append(nodes[i].value[3])
                i += 1
            picked.append(self.rows[k].take(pa.array(at)))
        whole = pa.Table.from_batches(picked).combine_chunks().to_batches()[0]
        cols = [pa.array(counts, pa.int64()) if j == 4 else whole.column(j) for j in range(whole.num_columns)]
        for j, n in enumerate(nodes):
            n.value[1:3] = 0, j
        return pa.RecordBatch.from_arrays(cols, schema=self.schema)

    def _compact(self) -> None:
        best = self._best(list(self.terminals))
        self.rows = [best] if best is not None else []

    def _spill(self, part: int) -> None:
        best = self._best([part])
        sink = tempfile.TemporaryFile()
        self.sinks[part] = sink
        self.files[part] = pa.ipc.new_stream(sink, self.schema)
        self.files[part].write_batch(best)
        for d in (self.roots, self.terminals, self.size):
            d.pop(part, None)
        self._compact()

    def flush(self) -> list[pa.RecordBatch]:
        best = self._best(list(self.terminals))
        self._reset()
        return [best] if best is not None else []

    def finish(self):
        yield from self.flush()
        files, sinks, self.files, self.sinks = self.files, self.sinks, {}, {}
        for part, writer in files.items():
            writer.close()
            sinks[part].seek(0)
            alone = Owners(self.schema, 1 << 62, False)
            for b in pa.ipc.open_stream(sinks[part]):
                alone.add(b)
            yield from alone.flush()
            sinks[part].close()


def owners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", trie_bytes: int = TRIE_BYTES,
           carry: bool = True) -> DataFrame:
    """One row per distinct text: text_sha256, keep_chars, keep_id, group_size and ``row``, the row that stays
    (all columns of the input as a struct; only the id without ``carry``)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if carry else [id_col])])
    plain = F.translate(text, DROPPED, "")
    rows = docs.select(F.encode(plain, "UTF-8").alias("text"), F.char_length(text).cast("long").alias("chars"),
                       F.col(id_col).cast("long").alias("id"), row.alias("row"))
    rows = rows.select("text", F.unhex(F.sha2("text", 256)).alias("sha"), "chars", "id", F.lit(1).cast("long").alias("n"), "row")
    kind = rows.schema

    def combine(batches):
        own = None
        for b in batches:
            own = own or Owners(b.schema, trie_bytes, False)
            yield from own.add(b)
        if own:
            yield from own.flush()

    def own(batches):
        tries = None
        for b in batches:
            tries = tries or Owners(b.schema, trie_bytes, True)
            tries.add(b)
        if tries:
            yield from tries.finish()

    few = rows.mapInArrow(tidy(combine), kind)
    if carry and text_col in docs.columns:      # the row holds its text: without white space it is made again where the row arrives
        few = few.select(F.octet_length("text").alias("bytes"), F.xxhash64("text").alias("hash"), "sha", "chars", "id", "n", "row")
        text = F.coalesce(F.col("row").getField(text_col), F.lit(""))
        dealt = few.repartition("bytes", "hash").select(F.encode(F.translate(text, DROPPED, ""), "UTF-8").alias("text"), *kind.names[1:])
    else:
        dealt = few.repartition(F.octet_length("text"), F.xxhash64("text"))
    return dealt.mapInArrow(tidy(own), kind).select(
        F.lower(F.hex("sha")).alias("text_sha256"), F.col("chars").alias("keep_chars"), F.col("id").alias("keep_id"),
        F.col("n").alias("group_size"), "row")


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, one of each distinct text, with the columns of ``docs``."""
    return owners(docs, id_col, text_col).select("row.*")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row, dropped ones too.

    Rows that repeat the kept row's id and length are all marked kept here.
    """
    own = owners(docs, id_col, text_col, carry=False).select("text_sha256", "keep_id", "keep_chars", "group_size")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.char_length(text).alias("chars"),
                       F.sha2(F.encode(F.translate(text, DROPPED, ""), "UTF-8"), 256).alias("text_sha256"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars"))
    return rows.join(own, "text_sha256").select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")
