"""Importance resampling, fill-in-middle and the quality classifier against brute force, round trips and held-out labels."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from wareflow.llm import importance, infill, quality
from wareflow.llm.common import documents

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------ importance ----

def grams(text, n):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [" ".join(words[i:i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def direct_resample(docs, target, n, buckets, rate, least, seed):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s = Counter(bucket(g) for _, t in docs for g in grams(t, n)[1])
    t = Counter(bucket(g) for x in target for g in grams(x, n)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    rows = []
    for i, x in docs:
        words, gs = grams(x, n)
        w = sum(gain(bucket(g)) for g in gs)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(words), len(gs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[:rate * len(able) // 100], 1):
        r[5] = k
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("n", [1, 3])
def test_resample_against_counts(llm, n):
    docs, target = documents(llm, SF), llm.read.parquet(f"{SF}/benchmark.parquet")
    want = direct_resample([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()], n, 10_000, 10, 20, 2024)
    assert sorted(map(tuple, importance.resample(docs, target, n=n).collect()), key=repr) == want


def test_pieces_cut_inside_texts_keep_runs(monkeypatch):
    texts = ["", None, "One two  three", "a" * 50, "", "x y z " * 30, "Ünï 中文 b-c\x00d", ""]
    col = pa.array(texts)
    from wareflow.llm import textblock
    for size in (8, 1 << 20):
        monkeypatch.setattr(importance, "pieces", lambda d, o, size=size: textblock.pieces(d, o, size))
        got = Counter((int(d), int(c)) for doc, crc, _ in importance.scan(col, 3) for d, c in zip(doc, crc))
        assert got == Counter((i, zlib.crc32(g.encode())) for i, t in enumerate(texts) for g in grams(t, 3)[1])


def test_combined_checksums():
    rnd = random.Random(5)
    pairs = [(rnd.randbytes(rnd.randint(0, 40)), rnd.randbytes(rnd.randint(0, 5000))) for _ in range(50)]
    got = importance.combine(*(np.array(x) for x in zip(*((zlib.crc32(a), zlib.crc32(b), len(b)) for a, b in pairs))))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in pairs]


def test_resample_of_odd_rows(llm, odd, empty):
    target = llm.createDataFrame([(1, "no id here"), (2, None), (3, "")], "item_id long, text string")
    want = direct_resample([(r.doc_id, r.text) for r in odd.collect()], ["no id here", None, ""], 1, 10_000, 50, 1, 2024)
    assert sorted(map(tuple, importance.resample(odd, target, rate=50, least_words=1).collect()), key=repr) == want
    assert importance.resample(empty, target).collect() == []
    assert importance.resample(odd, target.limit(0)).count() == odd.count()


def test_ranks_run_on_over_partitions_and_ties(llm):
    rows = [(i % 7 if i % 5 else None, float(i % 3)) for i in range(200)]
    frame = llm.createDataFrame(rows, "doc_id long, score double").repartition(9)
    got = importance.ranked(frame).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 201))
    assert [(-r.score, r.doc_id is None, r.doc_id or 0) for r in got] == sorted((-s, i is None, i or 0) for i, s in rows)


# -------------------------------------------------------------- infill ----

def direct_infill(doc_id, text, rate, spm, seed):
    text = text or ""
    tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(tokens)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return (doc_id, n, "plain", None, None, text)
    if h4 % 100 < spm:
        return (doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("rate", [50, 100])
def test_infill_against_slices_and_back(llm, odd, empty, rate):
    tricky = [(100 + i, t) for i, t in enumerate(["<P> a b", "x <S", "> y <M", "a<<P b", "  lead", "trail \n", " ", "ü 中文 x  y\tz"])]
    docs = documents(llm, SF).select("doc_id", "text").unionByName(odd.select("doc_id", "text")).unionByName(
        llm.createDataFrame(tricky, "doc_id long, text string"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = infill.restore(infill.transform(docs, rate=rate)).collect()
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted((direct_infill(*r, rate, 80, 42) for r in rows), key=repr)
    assert Counter(r.restored for r in got) == Counter(t or "" for _, t in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert infill.transform(empty).collect() == [] and infill.restore(infill.transform(empty)).collect() == []


def test_rotations_of_any_bytes():
    rnd = random.Random(6)
    for _ in range(300):
        raw = rnd.randbytes(rnd.randint(0, 60))
        a, b, c = sorted(rnd.randint(0, len(raw)) for _ in range(3))
        buf = bytearray(raw)
        infill.rotate(buf, a, b, c)
        assert bytes(buf) == raw[:a] + raw[b:c] + raw[a:b] + raw[c:]
    for form in ("psm", "spm"):
        for _ in range(200):
            text = bytes(rnd.choice(b"<>PSM ab") for _ in range(rnd.randint(1, 40)))
            if not any(s in text for s in (b"<P>", b"<S>", b"<M>")):
                a, b = sorted((rnd.randint(0, len(text)), rnd.randint(0, len(text))))
                assert infill.unweave(infill.weave(text, a, b, form), form) == text


def test_restore_of_missing_parts(llm):
    rows = llm.createDataFrame([("ab", None, "x"), (None, "plain", "y"), ("ab", "plain", None)], "output string, form string, other string")
    assert [(r.restored, r.other) for r in infill.restore(rows).collect()] == [(None, "x"), (None, "y"), ("ab", None)]


# ------------------------------------------------------------- quality ----

def test_machine_equals_the_sum_over_pairs():
    rnd = np.random.default_rng(3)
    m = quality.Machine(np.arange(0, 40, 2), rnd.normal(size=20), rnd.normal(size=(20, 4)), 0.3, 18)
    offsets, slot, value = np.array([0, 0, 7, 19]), np.concatenate([rnd.choice(40, 7, False), rnd.choice(40, 12, False)]), rnd.normal(size=19)
    want = []
    for a, z in zip(offsets, offsets[1:]):
        x = [(s // 2, v) for s, v in zip(slot[a:z], value[a:z]) if s % 2 == 0]
        want.append(0.3 + sum(m.w[i] * u for i, u in x) + sum(m.v[i] @ m.v[j] * u * t for k, (i, u) in enumerate(x) for j, t in x[:k]))
    assert np.allclose(m.margin(offsets, slot, value), want)


def test_gradient_of_the_machine():
    rnd = np.random.default_rng(4)
    doc, at, value = np.repeat(np.arange(5), 6), np.concatenate([rnd.choice(9, 6, False) for _ in range(5)]), rnd.normal(size=30)
    y, w, v = (rnd.random(5) > 0.5).astype(float), rnd.normal(size=9), rnd.normal(size=(9, 3))
    loss = lambda w0, w, v: quality._gradient(doc, at, value, 5, 9, y, w0, w, v)[0]
    _, g0, gw, gv = quality._gradient(doc, at, value, 5, 9, y, 0.2, w, v)
    e = 1e-6
    assert math.isclose(g0, (loss(0.2 + e, w, v) - loss(0.2 - e, w, v)) / (2 * e), rel_tol=1e-4, abs_tol=1e-7)
    for i in range(9):
        d = np.zeros(9)
        d[i] = e
        assert math.isclose(gw[i], (loss(0.2, w + d, v) - loss(0.2, w - d, v)) / (2 * e), rel_tol=1e-4, abs_tol=1e-7)
        for f in range(3):
            dv = np.zeros((9, 3))
            dv[i, f] = e
            assert math.isclose(gv[i, f], (loss(0.2, w, v + dv) - loss(0.2, w, v - dv)) / (2 * e), rel_tol=1e-4, abs_tol=1e-7)


def test_held_out_labels(llm):
    docs, labels = (llm.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = quality.score(docs, quality.train(docs, labels)).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    known = {r.doc_id: r.quality for r in labels.collect()}
    held = [(r.predicted, known[r.doc_id]) for r in got if r.held_out and r.doc_id in known]
    right = {q: np.mean([p == q for p, k in held if k == q]) for q in (0, 1)}
    assert right[0] >= 0.95 and right[1] >= 0.98


def test_labels_of_the_held_out_fold_are_not_read(llm):
    docs, labels = documents(llm, SF), llm.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("quality", quality.F.when(quality.held_out(), 1 - quality.F.col("quality")).otherwise(quality.F.col("quality")))
    one, two = (sorted((r.doc_id, r.score) for r in quality.score(docs, quality.train(docs, x)).collect()) for x in (labels, flipped))
    assert one == two and len({s for _, s in one}) > 10


def test_quality_of_odd_rows(llm, odd, empty):
    labels = llm.createDataFrame([(1, 0), (4, 1), (4, 0), (5, 1), (6, None), (None, 1), (3, 0)], "doc_id long, quality int")
    model = quality.train(odd, labels, least_df=1)
    got = quality.score(odd, model).collect()
    assert len(got) == odd.count() and all(0 < r.score < 1 for r in got)
    assert {r.score for r in got if r.doc_id in (1, 2)} and len({r.score for r in got if r.doc_id == 4}) == 1
    assert quality.score(empty, model).collect() == []
    for none in (labels.limit(0), labels.where("quality = 1")):
        same = quality.score(odd, quality.train(odd, none))
        assert len({r.score for r in same.collect()}) == 1
    many = odd.unionByName(odd).unionByName(odd)             # a labelled id on several rows is one sample row
    assert np.allclose(quality.train(many, labels, least_df=1).w, model.w)


def test_levels_see_the_whole_text():
    rnd = random.Random(8)
    plain = " ".join("".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(40_000))
    late = plain + " WOW!!" * 40_000
    a, b = quality.structure(pa.array([plain, late]), np.array([len(plain), -1]))
    assert (a != b).sum() > 5 and a.shape == (quality.WIDTH,)
