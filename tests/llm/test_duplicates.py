"""Exact duplicates, near duplicates and repeated strings against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from wareflow.llm import exact_dedup, jaccard_join, suffix_dedup
from wareflow.llm.common import kept

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, texts):
    return spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)


def test_exact_against_grouping(llm):
    rnd = random.Random(2)
    texts = {i: rnd.choice([" ", "\n", ""]).join(rnd.choice("abcé") for _ in range(rnd.randint(0, 4))) for i in range(300)}
    groups = defaultdict(list)
    for d, t in texts.items():
        groups[re.sub("[\x20\x09-\x0D]", "", t)].append(d)
    want = {}
    for plain, ds in groups.items():
        keep = min(ds, key=lambda d: (-len(texts[d]), d))
        want.update({d: (keep, len(ds), d == keep, hashlib.sha256(plain.encode()).hexdigest()) for d in ds})
    got = exact_dedup.exact_dedup(frame(llm, texts)).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got} == want
    stay = exact_dedup.survivors(frame(llm, texts)).collect()
    assert sorted(r.doc_id for r in stay) == sorted({w[0] for w in want.values()})


def test_exact_odd_rows(odd, empty):
    got = exact_dedup.exact_dedup(odd).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got}
    assert by[1].group_size == 3 and by[3].kept and not by[1].kept       # null, empty and white space are one text
    assert by[6].keep_id == 5 and by[4].group_size == 2
    stay = exact_dedup.survivors(odd)
    assert stay.columns == odd.columns and stay.count() == 5
    assert exact_dedup.exact_dedup(empty).collect() == [] and exact_dedup.survivors(empty).collect() == []


def test_survivors_send_a_text_once(llm):
    """The text without white space is made again from the row where it arrives; names that clash change nothing."""
    rows = [(1, "a b", "x", 1), (2, "ab ", "y", 2), (3, "a  b", "z", 3), (4, None, "n", 4), (None, "  ", "m", 5)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, hash string, bytes long")
    stay = exact_dedup.survivors(docs)
    assert sorted(tuple(r) for r in stay.collect() if r.doc_id) == [(3, "a  b", "z", 3)]
    assert [tuple(r) for r in stay.collect() if not r.doc_id] == [(None, "  ", "m", 5)]
    plan = exact_dedup.owners(docs)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    sent = plan[next(i for i, line in enumerate(plan) if "RepartitionByExpression" in line) + 1]
    assert "Project" in sent and " text#" not in sent and "[text#" not in sent


def test_tries_spill_by_subtree():
    rnd = random.Random(8)
    texts = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 12))) for _ in range(2000)]
    schema = pa.schema([("text", pa.binary()), ("sha", pa.binary()), ("chars", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("row", pa.struct([("doc_id", pa.int64())]))])
    own = exact_dedup.Owners(schema, 20_000, True)
    for i in range(0, len(texts), 100):
        part = texts[i:i + 100]
        ids = list(range(i, i + len(part)))
        own.add(pa.record_batch([pa.array(part, pa.binary()), pa.array([hashlib.sha256(t).digest() for t in part], pa.binary()), pa.array([1] * len(part), pa.int64()),
                                 pa.array(ids, pa.int64()), pa.array([1] * len(part), pa.int64()), pa.array([{"doc_id": d} for d in ids], schema.field(5).type)], schema=schema))
    assert own.files                                                      # the limit made it spill
    got = [r for b in own.finish() for r in b.to_pylist()]
    assert {r["text"]: (r["id"], r["n"]) for r in got} == {t: (texts.index(t), texts.count(t)) for t in set(texts)}
    assert len(got) == len(set(texts))


def near_brute(texts):
    sets = {}
    for d, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        sets[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()
    root = {d: d for d in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    held = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            held[x].append(d)
    for d, s in sets.items():
        for e, n in Counter(e for x in s for e in held[x] if e < d).items():
            if 100 * n >= 75 * (len(s) + len(sets[e]) - n):
                a, b = sorted((find(d), find(e)))
                root[b] = a
    return {d: (len(sets[d]), find(d)) for d in texts}


def test_near_against_all_pairs(llm, monkeypatch):
    rnd = random.Random(3)
    vocab = [f"W{i}" for i in range(40)]
    texts = {i: " ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 60))) for i in range(100)}
    for i in range(100, 350):
        w = texts[rnd.randrange(i)].split()
        for _ in range(rnd.randint(0, 3)):
            if w:
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
        texts[i] = " ".join(w)
    texts |= {500: None, 501: "", 502: "A b", 503: "a  B"}
    want = near_brute(texts)
    # Hub turns or none; lists that one task may hold, lists dealt in blocks; joins that broadcast, joins that shuffle.
    for turns, long, sent in ((8, 4096, 2_000_000), (0, 3, 2_000_000), (3, 4, 0)):
        monkeypatch.setattr(jaccard_join, "TURNS", turns)
        monkeypatch.setattr(jaccard_join, "LONG", long)
        monkeypatch.setattr(jaccard_join, "SENT_ROWS", sent)
        got = jaccard_join.near_duplicates(frame(llm, texts), head=0 if turns else 1 << 18).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    stay = jaccard_join.one_of_each(kept(frame(llm, texts), "frame")).collect()
    assert sorted(r.doc_id for r in stay) == sorted(d for d, w in want.items() if w[1] == d)


def test_near_odd_rows(odd, empty):
    got = jaccard_join.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 2), (3, 3), (4, 4), (None, None), (5, 5), (6, 5), (7, 7)}
    stay = jaccard_join.one_of_each(odd)
    assert stay.columns == odd.columns and sorted(str(r.doc_id) for r in stay.collect()) == ["1", "2", "3", "4", "5", "7", "None"]
    assert jaccard_join.near_duplicates(empty).collect() == [] and jaccard_join.one_of_each(empty).collect() == []


def test_one_of_each_goes_by_rows_not_ids(llm):
    t, u = (" ".join(f"{c}{i}" for i in range(40)) for c in "tu")
    rows = [(1, t, "a"), (7, u, "b"), (7, t + " x", "c"), (9, u + " y", "d"), (3, "w " + t, "e"), (3, "v " + t, "f"), (None, u + " z", "g")]
    docs = llm.createDataFrame(rows, "doc_id long, text string, row string").selectExpr("*", "1 AS __gone", "2 AS gone", "3 AS whole", "4 AS component").coalesce(1)
    stay = jaccard_join.one_of_each(docs)
    assert stay.columns == docs.columns and sorted((r.doc_id, r["row"]) for r in stay.collect()) == [(1, "a"), (7, "b")]


def test_rows_that_stay_are_not_shuffled(llm):
    docs = kept(frame(llm, {1: "a b c d e f", 2: "a b c d e f", 3: "g h i j k l", 4: None}), "staying-rows")
    llm.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stay = jaccard_join.one_of_each(docs)
        assert sorted(r.doc_id for r in stay.collect()) == [1, 3, 4]
        assert "Exchange hashpartitioning" not in stay._jdf.queryExecution().executedPlan().toString()
    finally:
        llm.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pairs_grow_with_a_group_not_with_its_square(llm, monkeypatch):
    rnd = random.Random(21)
    base, made = [f"b{i}" for i in range(150)], []
    inner = jaccard_join.kept

    def counted(df, name, *a):
        out = inner(df, name, *a)
        if name.endswith(("-pairs", "-candidates")):
            made.append(out.count())
        return out

    def near_copy(edits):
        w = list(base)
        for i in rnd.sample(range(150), edits):
            w[i] = f"e{rnd.random()}"
        return " ".join(w)

    texts = {i: near_copy(rnd.choice((3, 4))) for i in range(160)}       # some of them link with a few of the others only
    want = near_brute(texts)
    assert 90 < len({c for _, c in want.values()}) < 120
    monkeypatch.setattr(jaccard_join, "kept", counted)
    got = jaccard_join.near_duplicates(frame(llm, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert sum(made) < 12 * len(texts), made


def test_candidates_stay_where_they_are_read(llm, monkeypatch):
    """Texts are not shuffled to pick the candidates, and bitmaps rule out pairs with hubs before texts move for them."""
    rng = np.random.default_rng(11)
    passages = [" ".join(f"p{i}w{j}" for j in range(40)) for i in range(6)]
    texts = [passages[i % 6] + " " + " ".join(f"u{i}x{w}" for w in rng.integers(0, 1 << 30, 80)) for i in range(60)]
    texts += [t + " end" for t in texts[:4]]
    plans, verified = {}, []
    inner, check = jaccard_join.kept, jaccard_join._verify

    def seen(df, name, *a):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return inner(df, name, *a)

    def counted(pairs, *a):
        verified.append(pairs.count())
        return check(pairs, *a)

    monkeypatch.setattr(jaccard_join, "kept", seen)
    monkeypatch.setattr(jaccard_join, "_verify", counted)
    llm.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(frame(llm, dict(enumerate(texts))), head=0).collect()}
    finally:
        llm.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {i: i - 60 if i >= 60 else i for i in range(64)}
    assert "SortMergeJoin" not in plans["candidates"] and "Exchange hashpartitioning" not in plans["candidates"]
    assert 4 <= verified[0] <= 8                # 50 pairs or more share a passage


def test_candidates_are_those_that_were_chosen(llm):
    rows = kept(llm.createDataFrame([(0, 7, "one two three four five six"), ((1 << 33) + 40_000, 8, "a b c d e f g")], "row long, doc_id long, t string"), "rows")
    texts = [r.t for r in rows.collect()]
    offs, flat = jaccard_join.sets(pa.array(texts), 5)
    sig = dict(zip(texts, jaccard_join.signature(offs, flat).tolist()))
    chosen = llm.createDataFrame([(sig["a b c d e f g"], (1 << 33) + 40_000)], "sig long, at long")
    got = jaccard_join._candidates(rows, chosen, 5).collect()
    assert [(r.sig, r.n, r.t) for r in got] == [(sig["a b c d e f g"], 3, "a b c d e f g")]
    assert bytes(got[0].few) == jaccard_join.parity(flat[offs[texts.index(got[0].t)]:offs[texts.index(got[0].t) + 1]])
    moved = llm.createDataFrame([(sig["a b c d e f g"], 0)], "sig long, at long")
    with pytest.raises(RuntimeError, match="moved"):
        jaccard_join._candidates(rows, moved, 5)


def test_entries_without_a_partner_leave_their_list():
    rnd = np.random.default_rng(22)
    size = rnd.integers(1, 7, 400)
    start, total = np.cumsum(size) - size, int(size.sum())
    n = rnd.integers(1, 60, total)
    pos = (rnd.random(total) * jaccard_join.prefix_size(n, 75, 100)).astype(np.int64)
    keep = jaccard_join._partnered(start, size, n, pos, 75, 100)
    for at, m in zip(start.tolist(), size.tolist()):
        for i in range(at, at + m):
            others = [j for j in range(at, at + m) if j != i]
            has = any(jaccard_join._first_common(n[i], pos[i], n[j], pos[j], 75, 100) for j in others)
            assert keep[i] >= has and (m > 2 or keep[i] == has)
    assert 0 < keep.sum() < total and not len(jaccard_join._partnered(start[:0], size[:0], n[:0], pos[:0], 75, 100))


def test_bitmaps_of_a_list_give_the_bound_of_each_pair():
    rnd = np.random.default_rng(23)
    sets_ = [np.unique(rnd.integers(0, 2**63, int(rnd.integers(1, 300)), dtype=np.uint64)) for _ in range(40)]
    sets_ += [np.unique(np.concatenate((s[rnd.random(len(s)) < 0.95], rnd.integers(0, 2**63, 3, dtype=np.uint64)))) for s in sets_]
    bits = [jaccard_join.parity(s, 2) for s in sets_]
    maps, every = jaccard_join.Bitmaps(bits), np.arange(len(bits))
    for i, x in enumerate(sets_):
        differ = maps.differ(i, every)
        for j, y in enumerate(sets_):
            assert differ[j] <= len(np.setxor1d(x, y))
            both = (len(x) + len(y) - int(differ[j])) // 2
            bound = 100 * both >= 75 * (len(x) + len(y) - both)
            assert jaccard_join.may_link(len(x), bits[i], len(y), bits[j], 75, 100) == (bound and min(len(x), len(y)) * 100 >= 75 * max(len(x), len(y)))


def test_bitmaps_never_drop_a_link():
    rnd = np.random.default_rng(5)
    for _ in range(300):
        x = np.unique(rnd.integers(0, 2**63, int(rnd.integers(1, 200)), dtype=np.uint64))
        y = np.unique(np.concatenate((x[rnd.random(len(x)) < 0.9], rnd.integers(0, 2**63, int(rnd.integers(0, 20)), dtype=np.uint64))))
        if len(y) and jaccard_join.links(x, y):
            assert jaccard_join.may_link(len(x), jaccard_join.parity(x), len(y), jaccard_join.parity(y), 75, 100)


def test_bitmaps_are_small_and_rule_out_unlike_sets():
    rnd = np.random.default_rng(6)
    for n in (40, 300, 511, 2000):
        x, y = (np.unique(rnd.integers(0, 2**63, n, dtype=np.uint64)) for _ in range(2))
        assert len(jaccard_join.parity(x)) * 8 <= max(64, 2 * n)          # they are moved with every pair
        assert not jaccard_join.may_link(n, jaccard_join.parity(x), n, jaccard_join.parity(y), 75, 100)


def test_signatures_do_not_depend_on_the_slices(monkeypatch):
    rnd = np.random.default_rng(7)
    size = rnd.integers(0, 9, 50)
    offs, flat = np.concatenate(([0], np.cumsum(size))), rnd.integers(0, 2**63, int(size.sum()), dtype=np.uint64)
    whole = jaccard_join.signature(offs, flat)
    monkeypatch.setattr(jaccard_join, "SLICE", 7)
    assert jaccard_join.signature(offs, flat).tolist() == whole.tolist()


def repeats_brute(texts, n):
    seen = Counter(t[i:i + n] for t in texts.values() for i in range(len(t) - n + 1))
    out = {}
    for d, t in texts.items():
        gone = bytearray(len(t))
        for i in range(len(t) - n + 1):
            if seen[t[i:i + n]] > 1:
                gone[i:i + n] = b"\1" * n
        runs = sum(c and not (i and gone[i - 1]) for i, c in enumerate(gone))
        out[d] = (len(t), sum(gone), runs, hashlib.sha256(bytes(b for b, c in zip(t, gone) if not c)).hexdigest())
    return out


def test_repeats_against_counting(llm, monkeypatch):
    rnd = random.Random(5)
    base = ["".join(rnd.choice("abé") for _ in range(rnd.randint(0, 120))) for _ in range(120)]
    for _ in range(80):
        a, b = rnd.choice(base), rnd.choice(base)
        base.append(a[:rnd.randint(0, len(a))] + rnd.choice(["", "q"]) + b[rnd.randint(0, len(b)):])
    core = "".join(rnd.choice("abcdefgh") for _ in range(60))
    base += ["".join(rnd.choice("xyz") for _ in range(rnd.randint(0, 10))) + core[:rnd.randint(20, 60)] for _ in range(120)]
    texts = dict(enumerate([*base, "a" * 100, "ab" * 40, "", None]))
    want = repeats_brute({d: (t or "").encode() for d, t in texts.items()}, 20)
    got = suffix_dedup.remove_repeats(frame(llm, texts), length=20, k=6).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want


def test_pairs_and_fingerprints_agree(llm, monkeypatch):
    rnd = random.Random(6)
    core = "".join(rnd.choice("abcdefgh") for _ in range(50))
    texts = {i: "".join(rnd.choice("xy") for _ in range(8)) + core[:rnd.randint(15, 50)] + "".join(rnd.choice("xy") for _ in range(8)) for i in range(150)}
    want = repeats_brute({d: t.encode() for d, t in texts.items()}, 20)
    for pairs in (1, 10_000):
        suffix_dedup.PAIRS = pairs
        s = suffix_dedup.Suffixes(20, 6)
        data = "".join(texts.values()).encode()
        offs = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts.values()])))
        doc, gram, p, w0, w1 = suffix_dedup.anchors(np.frombuffer(data, np.uint8), offs, 20, 6)
        left, right = p - w0, w1 + 20 - p
        keys = s.keys(np.frombuffer(data, np.uint8), p, left, right)
        order = np.lexsort((right, left, *keys.T[::-1]))
        lcp, _ = suffix_dedup.front_code(keys[order])
        by = suffix_dedup._classes(lcp.astype(int), left[order], right[order], s.width)
        first = np.flatnonzero(np.concatenate(([True], by[1:] != by[:-1])))
        l, r = suffix_dedup.reach(keys[order][first], lcp[first].astype(int), left[order][first], right[order][first], np.bincount(by), s, 6)
        removed = {d: np.zeros(len(t), bool) for d, t in texts.items()}
        for i, q in enumerate(order):
            at = p[q] - offs[doc[q]]
            removed[int(doc[q])][at - l[by[i]]:at + r[by[i]]] = True
        assert {d: int(x.sum()) for d, x in removed.items()} == {d: w[1] for d, w in want.items()}
    suffix_dedup.PAIRS = 48


def test_hot_passages_are_not_merged_by_one_owner(llm, monkeypatch):
    rnd = random.Random(15)
    some = lambda chars, lo, hi: "".join(rnd.choice(chars) for _ in range(rnd.randint(lo, hi)))
    core = some("abcdefgh", 60, 60)
    texts = {i: some("xyz", 0, 30) + core[rnd.randint(0, 9):rnd.randint(40, 60)] + some("xyz", 0, 30) for i in range(150)}
    texts |= {200 + i: core[:rnd.randint(3, 30)] + some("xy", 5, 9) for i in range(40)} | {300: core + core, 301: "", 302: some("mnopq", 99, 99)}
    want = repeats_brute({d: t.encode() for d, t in texts.items()}, 20)
    dealt, inner = [], suffix_dedup.hot_spans
    monkeypatch.setattr(suffix_dedup, "hot_spans", lambda hot, *a: dealt.append([(r.part, sum(np.frombuffer(r.copies, np.int32))) for r in hot.collect()]) or inner(hot, *a))
    for hot, part, core_places in ((1, 7, 4), (20, 1000, 16)):
        monkeypatch.setattr(suffix_dedup, "HOT", hot)
        monkeypatch.setattr(suffix_dedup, "PART", part)
        monkeypatch.setattr(suffix_dedup, "CORE", core_places)
        got = suffix_dedup.remove_repeats(frame(llm, texts), length=20, k=6).collect()
        assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want
        sizes = [n for _, n in dealt.pop()]
        assert sum(sizes) > 100 and max(sizes) <= part


def test_joined_intervals():
    rnd = np.random.default_rng(16)
    row, lo = rnd.integers(0, 5, 40), rnd.integers(0, 300, 40)
    hi = lo + rnd.integers(1, 20, 40)
    want = {r: np.zeros(330, bool) for r in range(5)}
    for r, a, b in zip(row, lo, hi):
        want[r][a:b] = True
    got = list(zip(*(c.tolist() for c in suffix_dedup.joined(row, lo, hi))))
    for r, x in want.items():
        edge = np.flatnonzero(np.diff(np.concatenate(([0], x, [0]))))
        assert [(a, b) for q, a, b in got if q == r] == list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def test_loser_tree_merges_with_prefixes():
    rnd = random.Random(9)
    runs = []
    for _ in range(7):
        keys = sorted("".join(rnd.choice("ab") for _ in range(12)).encode() for _ in range(rnd.randint(0, 40)))
        lcp, rest = suffix_dedup.front_code(np.frombuffer(b"".join(keys), np.uint8).reshape(-1, 12)) if keys else (np.zeros(0, np.uint16), b"")
        assert suffix_dedup.front_decode(lcp, rest, 12) == keys
        runs.append((lcp.tolist(), keys))
    out = [(runs[r][1][i], c) for r, i, c in suffix_dedup.merge(runs)]
    assert [k for k, _ in out] == sorted(k for _, ks in runs for k in ks)
    for (a, _), (b, c) in zip(out, out[1:]):
        n = next((j for j in range(12) if a[j] != b[j]), 12)
        assert c == n


def test_repeats_odd_rows(odd, empty):
    got = {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.remove_repeats(odd).collect()}
    size = {r.doc_id: len((r.text or "").encode()) for r in odd.collect()}
    assert got == {(d, n, n if d in (5, 6) else 0, 1 if d in (5, 6) else 0) for d, n in size.items()}
    assert suffix_dedup.remove_repeats(empty).collect() == []


def test_cleaned_rows_keep_their_columns(llm, odd, empty):
    rnd = random.Random(9)
    passage = "".join(rnd.choice("abc é") for _ in range(300))
    rows = [(i, f"{i} start {passage} end {i}" if i % 2 else f"{i} alone", None if i == 3 else f"r{i}") for i in range(6)] + [(9, None, "n"), (None, "", "e")]
    docs = kept(llm.createDataFrame(rows, "doc_id long, text string, whole string"), "clean-rows")
    got = suffix_dedup.clean(docs, length=200, k=48).collect()
    want = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs, length=200, k=48).collect()}
    assert suffix_dedup.clean(docs, length=200, k=48).columns == docs.columns
    assert sorted(((r.doc_id, r.whole) for r in got), key=repr) == sorted(((d, w) for d, _, w in rows), key=repr)
    for r in got:
        raw = (r.text or "").encode()
        assert "\ufffd" in (r.text or "") or hashlib.sha256(raw).hexdigest() == want[r.doc_id].kept_sha256
        assert (r.text is None) == (r.doc_id == 9)
    assert {len(r.text.encode()) for r in got if r.doc_id and r.doc_id % 2 and r.doc_id < 9} != {len(rows[1][1].encode())}
    assert suffix_dedup.clean(odd).count() == odd.count() and suffix_dedup.clean(empty).collect() == []
