"""Token counts, packing and shards against the tokenizer library itself."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

from wareflow.llm import packing, token_counts, token_shards
from wareflow.llm.common import documents
from wareflow.llm.pieces import Pieces, default_tokenizer


@pytest.fixture(scope="module")
def tok():
    return Pieces.of(default_tokenizer()).tok


def ids_of(tok, text):
    return np.array(tok.encode(text or "", add_special_tokens=False).ids, np.uint32)


@pytest.mark.parametrize("head", [1 << 20, 50, 0])
def test_counts_equal_the_library(llm, tok, head):
    docs = documents(llm, "/root/testdata/sf0.001")
    want = {r.doc_id: (len((r.text or "").encode()), len(ids_of(tok, r.text))) for r in docs.collect()}
    got = token_counts.token_counts(docs, head=head).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == want and len(got) == len(want)
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)


def test_counts_of_odd_rows(odd, empty, tok):
    want = sorted((str(r.doc_id), len(ids_of(tok, r.text))) for r in odd.collect())
    assert sorted((str(r.doc_id), r.n_tokens) for r in token_counts.token_counts(odd).collect()) == want
    assert token_counts.token_counts(empty).collect() == []


def check_packed(rows, texts, tok, window, end=1):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.append(ids_of(tok, texts[r.doc_id]), end).astype("<u4")
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
        by_doc[r.doc_id].append((r.start, r.length))
        by_seq[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for parts in (*by_doc.values(), *by_seq.values()):
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
    sizes = [sum(n for _, n in p) for p in by_seq.values()]
    assert all(s == window or s & (s - 1) == 0 for s in sizes) and max(sizes) <= window


def test_packed_ids_are_the_sequences(llm, tok, odd):
    docs = documents(llm, "/root/testdata/sf0.001").select("doc_id", "text").unionByName(odd.select("doc_id", "text")).unionByName(
        llm.createDataFrame([(4, "another text of an id that is there")], "doc_id long, text string"))
    want = defaultdict(int)
    for r in docs.collect():
        want[r.doc_id, np.append(ids_of(tok, r.text), 1).astype(np.int32).tobytes()] += 1
    plan = sorted((r.sequence_id, r.offset, str(r.doc_id), r.start, r.length, r.ids_crc32) for r in packing.pack(docs, window=256).collect())
    rows = sorted(packing.packed_ids(docs, window=256).collect(), key=lambda r: (r.sequence_id, r.offset))
    assert [(r.sequence_id, r.offset, str(r.doc_id), r.start, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in rows] == plan
    heads = [r for r in rows if r.start == 0]
    assert len(heads) == sum(want.values())


def test_packing_round_trip(llm, tok):
    docs = documents(llm, "/root/testdata/sf0.001")
    check_packed(packing.pack(docs).collect(), {r.doc_id: r.text for r in docs.collect()}, tok, 2048)
    check_packed(packing.pack(docs, window=64, buckets=3).collect(), {r.doc_id: r.text for r in docs.collect()}, tok, 64)


def test_packing_of_odd_rows(odd, empty, tok):
    got = packing.pack(odd).collect()
    assert sum(r.length for r in got) == sum(len(ids_of(tok, r.text)) + 1 for r in odd.collect())
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts in seqs.values():
        assert sorted(parts)[0][0] == 0 and len({o for o, _ in parts}) == len(parts)
    assert packing.pack(empty).collect() == []


def test_fullest_against_enumeration():
    rnd = np.random.default_rng(4)
    for _ in range(200):
        counts = {int(x): int(n) for x, n in zip(rnd.integers(1, 30, 6), rnd.integers(1, 4, 6))}
        room = int(rnd.integers(0, 80))
        sums = {0}
        for x, n in counts.items():
            sums = {s + k * x for s in sums for k in range(n + 1)}
        pick = packing.fullest(counts, room)
        assert sum(x * n for x, n in pick.items()) == max(s for s in sums if s <= room)
        assert all(n <= counts[x] for x, n in pick.items())


def test_permutation_is_one():
    for n in (1, 2, 3, 1000, 4097):
        got = token_shards.permute(np.arange(n), n, key=9)
        assert sorted(got.tolist()) == list(range(n))
    assert token_shards.permute(np.arange(50), 50, 1).tolist() != token_shards.permute(np.arange(50), 50, 2).tolist()


def test_shards_round_trip(llm, scratch, tok, empty, odd):
    docs = documents(llm, "/root/testdata/sf0.001")
    folder = scratch("shards")
    rows = sorted(token_shards.write_shards(docs, folder, seq_len=256, per_shard=50).collect())
    assert [r.slot for r in rows] == list(range(len(rows)))
    texts = {r.doc_id: r.text for r in docs.collect()}
    read = list(token_shards.read_slots(folder, 0, len(rows), 256, 50))
    for r, ids in zip(rows, read):
        assert zlib.crc32(ids.astype("<u2").tobytes()) == r.ids_crc32
        own = np.append(ids_of(tok, texts[r.doc_id]), 50256)[r.start:][:r.n_tokens]
        assert (ids[:len(own)] == own).all()
    assert sum(r.n_tokens for r in rows) == sum(len(ids_of(tok, t)) + 1 for t in texts.values())
    again = list(token_shards.read_slots(folder, 77, 30, 256, 50))         # resume inside a shard
    assert all((a == b).all() for a, b in zip(again, read[77:107]))
    assert token_shards.write_shards(empty, scratch("none")).collect() == []
    assert sum(r.n_tokens for r in token_shards.write_shards(odd, scratch("odd")).collect()) == sum(len(ids_of(tok, r.text)) + 1 for r in odd.collect())


def test_shards_encode_each_text_once(llm, scratch, monkeypatch):
    docs, calls = llm.createDataFrame([(i, f"a text {i}, with words of its own") for i in range(300)], "doc_id long, text string"), []
    read = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, *a, **b: calls.append(f.__name__) or read(self, f, *a, **b))
    folder = scratch("once")
    rows = sorted(token_shards.write_shards(docs, folder, seq_len=64, per_shard=7).collect())
    assert calls == ["sequences", "slots", "write"]             # one of them has a tokenizer: no count before
    assert [r[0] for r in rows] == list(range(len(rows))) and len(list(token_shards.read_slots(folder, 0, len(rows), 64, 7))) == len(rows)
