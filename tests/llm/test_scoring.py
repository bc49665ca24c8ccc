"""Language model, toxicity, licenses and decontamination against direct versions."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

import corpus_pipeline
from wareflow.llm import decontaminate, language_model, licenses, toxicity
from wareflow.llm.common import documents, local_rows, tidy

SF = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))


def test_language_model_against_direct_counts(llm):
    docs = documents(llm, SF)
    model = language_model.train(docs.where("doc_id % 3 <> 0"))
    texts = {r.doc_id: words(r.text) + [None] for r in docs.collect()}
    uni, bi = Counter(), Counter()
    for d, w in texts.items():
        if d % 3:
            uni.update(w)
            bi.update(zip(["<s>", *w[:-1]], w))
    n, v = sum(uni.values()), len(uni)
    d2 = language_model.discounts(np.array([sum(c == j for c in bi.values()) for j in (1, 2, 3, 4)]))
    cont = Counter(w for _, w in bi)
    d1 = language_model.discounts(np.array([sum(c == j for c in cont.values()) for j in (1, 2, 3, 4)]))
    rest = sum(d1[min(c, 3)] for c in cont.values()) / len(bi)
    total, left = Counter(), defaultdict(float)
    for (a, _), c in bi.items():
        total[a] += c
        left[a] += d2[min(c, 3)]

    def p(a, w):
        one = max(cont[w] - d1[min(cont[w], 3)], 0) / len(bi) + rest / (v + 1)
        return max(bi[a, w] - d2[min(bi[a, w], 3)], 0) / total[a] + left[a] / total[a] * one if total[a] else one

    assert math.isclose(sum(p("<s>", w) for w in uni) + left["<s>"] / total["<s>"] * rest / (v + 1), 1, rel_tol=1e-9)
    for r in language_model.score(docs, model).collect():
        w = texts[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(uni[x] > 0 for x in w), n)
        assert math.isclose(r.base_score, sum(math.log10((uni[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
        assert math.isclose(r.score, sum(math.log10(p(a, x)) for a, x in zip(["<s>", *w[:-1]], w)), rel_tol=1e-9)


def test_language_model_odd_rows(odd, empty):
    model = language_model.train(odd)
    got = language_model.score(odd, model).collect()
    assert len(got) == odd.count() and all(math.isfinite(r.score) for r in got)
    assert language_model.score(empty, model).collect() == []
    none = language_model.train(empty)
    assert all(r.base_score == 0 and math.isfinite(r.score) for r in language_model.score(odd, none).collect())


def test_toxicity_held_out(llm):
    sf = "/root/testdata/sf0.01"
    docs, labels = documents(llm, sf), llm.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.train(docs, labels.where("doc_id % 4 <> 0"))
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [(r.toxic, got[r.doc_id].toxic) for r in labels.where("doc_id % 4 = 0").collect()]
    assert sum(not y and p for y, p in held) <= 2
    assert sum(bool(y) and p for y, p in held) >= 0.5 * sum(y for y, _ in held)      # some labels are noise
    assert all(0 <= r.expected_severity <= 2 for r in got.values())
    assert all((np.diff(model.cuts) >= 0).tolist())
    stay = toxicity.reject(docs, model)
    assert stay.columns == docs.columns and stay.count() == sum(not r.toxic for r in got.values())


def test_toxicity_odd_rows(odd, empty, llm):
    labels = llm.createDataFrame([(1, 0), (2, 1), (4, None), (4, 1), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(odd, labels)
    assert toxicity.score(odd, model).count() == odd.count()
    none = toxicity.train(empty, labels)
    assert toxicity.reject(odd, none).count() == odd.count()
    assert toxicity.score(empty, model).collect() == []


def test_ordinal_gradient():
    rnd = np.random.default_rng(1)
    z, cuts, y = rnd.normal(size=20), np.array([-0.3, 0.8]), rnd.integers(0, 3, 20)

    def loss(z, cuts):
        s = 1 / (1 + np.exp(-(z[:, None] - cuts)))
        hi, lo = np.hstack((np.ones((20, 1)), s)), np.hstack((s, np.zeros((20, 1))))
        return -np.log((hi - lo)[np.arange(20), y]).mean()

    gz, gc = toxicity._gradient(z, cuts, y)
    for i in range(3):
        e = np.zeros(20)
        e[i] = 1e-6
        assert math.isclose(gz[i], (loss(z + e, cuts) - loss(z - e, cuts)) / 2e-6, rel_tol=1e-3, abs_tol=1e-7)
    for i in range(2):
        e = np.zeros(2)
        e[i] = 1e-6
        assert math.isclose(gc[i], (loss(z, cuts + e) - loss(z, cuts - e)) / 2e-6, rel_tol=1e-3, abs_tol=1e-7)


def test_license_base_columns(llm):
    texts = ["CC BY cc-by, all rights RESERVED.", "GNU General Public License, version 3 or later", "nothing", None, "", "é ccby cc by",
             "Licensed under the Apache License, Version 2.0", "all rights all rights reserved reserved", "SPDX-License-Identifier: BSD-3-Clause"]
    got = licenses.scan(llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in got:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (texts[r.doc_id] or "").translate(LOW))
        at = [(k, label) for phrase, label in licenses.PHRASES for k in range(len(w)) if w[k:k + len(phrase.split())] == phrase.split()]
        assert (r.n_words, r.n_base) == (len(w), len(at))
        assert (r.first_word, r.last_word) == (min((k for k, _ in at), default=None), max((k for k, _ in at), default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in at}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    by = {r.doc_id: r.labels.split(",") for r in got}
    assert "gpl-3.0-or-later" in by[1] and "gpl-3.0" not in by[1] and by[6] == ["apache-2.0"] and by[8] == ["bsd-3-clause"] and by[2] == [""]


def test_license_detections_against_python(llm):
    rnd = random.Random(4)
    parts = ["licensed under the mit license", "cc by sa 4 0", "copyright 2020", "gnu general public license version 2", "all rights reserved", "foo", "bar",
             "under the terms of the", "apache license 2 0", "redistributions of source code must retain the above copyright notice", "public domain"]
    texts = {i: " " + " ".join(rnd.choice(parts) for _ in range(rnd.randint(1, 6))) + " " for i in range(60)}
    want = set()
    for d, x in texts.items():
        spans = [(m.start(), -m.end(), tier, i, label) for i, (label, key, pattern, tier, _) in enumerate(licenses.rules()) if key in x
                 for m in re.finditer(f"(?<= )(?:{pattern})(?= )", x)]
        for k, (lo, hi, tier, i, label) in enumerate(sorted(spans)):
            if not any(-h >= -hi and t <= tier for _, h, t, _, _ in sorted(spans)[:k]):
                want.add((d, label, tier, lo, -hi))
    rows = llm.createDataFrame(list(texts.items()), "row long, x string")
    assert {(r.row, r.label, r.tier, r.lo, r.hi) for r in licenses.detections(rows).collect()} == want


def test_license_keywords_lose_nothing(llm):
    texts = {0: "MIT No Attribution", 1: "Released under MIT No Attribution.", 2: "an End User Licence Agreement", 3: "Open Source Licence", 4: "open-source license",
             5: "MIT No Attribution License", 6: "end user license agreement", 7: "no such statement"}
    rows = llm.createDataFrame(list(texts.items()), "doc_id long, text string").select("doc_id", licenses.normalised("text").alias("x")).collect()
    got = {r.doc_id: set(filter(None, r.labels.split(","))) for r in licenses.scan(llm.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    for r in rows:                                            # patterns without their keywords
        spans = sorted((m.start(), -m.end(), tier, i, label) for i, (label, _, pattern, tier, _) in enumerate(licenses.rules())
                       for m in re.finditer(f"(?<= )(?:{pattern})(?= )", r.x))
        assert got[r.doc_id] == {x[4] for k, x in enumerate(spans) if not any(h <= x[1] and t <= x[2] for _, h, t, _, _ in spans[:k])}
    assert got[0] == got[1] == got[5] == {"mit-0"} and got[2] == got[6] == {"proprietary"} and got[3] == got[4] == {"open-source"} and not got[7]


def test_license_odd_rows(odd, empty):
    got = licenses.scan(odd)
    assert got.count() == odd.count() and licenses.scan(empty).collect() == []


def direct_score(item, text):
    h = np.zeros((len(item) + 1, len(text) + 1), int)
    for i, a in enumerate(item):
        for j, b in enumerate(text):
            h[i + 1, j + 1] = max(0, h[i, j] + (2 if a == b else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
    return h.max()


def test_alignment_against_table():
    rnd = np.random.default_rng(7)
    text = rnd.integers(1, 6, 3000, dtype=np.uint64)
    item = rnd.integers(1, 6, 400, dtype=np.uint64)
    n, m = rnd.integers(1, 20, 60), rnd.integers(0, 50, 60)
    i0, t0 = rnd.integers(0, 380, 60), rnd.integers(0, 2900, 60)
    best, _ = decontaminate.align(item, i0, n, text, t0, m)
    for k in range(60):
        assert best[k] == direct_score(item[i0[k]:i0[k] + n[k]].tolist(), text[t0[k]:t0[k] + m[k]].tolist())


def test_leaks_found_and_clean_left(llm, odd, empty):
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(5))
    items = [" ".join(word() for _ in range(rnd.randint(2, 50))) for _ in range(30)] + ["", None]
    bench = llm.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs, want = {}, set()
    for i, q in enumerate(items[:30]):
        w = q.split()
        edited = [word() if j % 7 == 3 else x for j, x in enumerate(w)] if len(w) > 12 else w
        docs[i] = " ".join([*(word() for _ in range(60)), *(x.upper() + "," for x in edited), *(word() for _ in range(20))])
        docs[100 + i] = " ".join(word() for _ in range(80))
        want.add((i, i))
    frame = llm.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = decontaminate.leaks(frame, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and all(0.5 <= r.score <= 1 for r in got)
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(frame, bench, block_chars=300).collect()} == want     # several blocks
    assert {r.doc_id for r in decontaminate.decontaminate(frame, bench).collect()} == {d for d in docs if d >= 100}
    assert decontaminate.leaks(odd, bench).collect() == [] and decontaminate.leaks(empty, bench).collect() == []
    none = llm.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(odd, none).count() == odd.count()
    assert decontaminate.decontaminate(odd, bench).columns == odd.columns


def test_edited_copies_beside_verbatim_ones(llm):
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    common = [word() for _ in range(4)]                       # stands in every document and in the last item
    around = lambda ws: " ".join([*(word() for _ in range(30)), *common, *ws, *(word() for _ in range(30))])
    edits = [lambda w: [word() if j % 6 == 5 else x for j, x in enumerate(w)], lambda w: [word() if j % 6 == 2 else x for j, x in enumerate(w)],
             lambda w: [word() if j % 5 == 4 else x for j, x in enumerate(w)], lambda w: w[:21],
             lambda w: [*w[:10], word(), word(), *w[12:20], *w[23:33], word()]]
    items = [[word() for _ in range(40)] for _ in edits]
    bench = llm.createDataFrame([*((i, " ".join(w)) for i, w in enumerate(items)), (99, " ".join([*common, *(word() for _ in range(30))]))], "item_id long, text string")
    for many in (1, 60):                                      # each edited copy also repeated many times
        copies = [(i, c) for i, (w, edit) in enumerate(zip(items, edits)) for c in [w, *[edit(w)] * many]]
        texts = [around(c) for _, c in copies]
        frame = llm.createDataFrame([*enumerate(texts), *((1000 + i, around([])) for i in range(20))], "doc_id long, text string")
        got = {(r.doc_id, r.item_id): r.score for r in decontaminate.leaks(frame, bench).collect()}
        assert set(got) == {(d, i) for d, (i, _) in enumerate(copies)}
        for d, (i, _) in enumerate(copies):
            assert math.isclose(got[d, i], direct_score(items[i], texts[d].split()) / 80)
        assert {r.doc_id for r in decontaminate.decontaminate(frame, bench).collect()} == set(range(1000, 1020))


def test_common_seeds_are_thinned_but_every_stretch_keeps_one(llm, monkeypatch):
    rnd = random.Random(21)
    texts = [" ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 40))) for _ in range(20)]
    items = decontaminate.Items.of(list(range(20)), texts, 4)
    n = np.array([rnd.choice([0, 0, 5, 9, 30]) for _ in items.seed])
    rare = items.rare(items.seed[n > 0], n[n > 0])
    count = dict(zip(items.seed.tolist(), n.tolist()))
    stays = set(rare.seed.tolist())
    assert {s for s, c in count.items() if not c} <= stays and len(stays) < len(count)
    for i, t in enumerate(texts):
        size = len(t.split())
        seeds = decontaminate.grams_at(items.word, np.arange(items.offs[i], items.offs[i + 1] - 3), 4).tolist() if size >= 4 else []
        for a in range(max(0, len(seeds) - 3)):
            assert min(seeds[a:a + 4], key=lambda x: (count[x], x)) in stays
        assert not seeds or stays & set(seeds)
    # a corpus in which the seeds of one item are common: its copies are found all the same, by fewer seeds
    monkeypatch.setattr(decontaminate, "COMMON_LEAST", 30)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    hot, cold = " ".join(word() for _ in range(30)), " ".join(word() for _ in range(30))
    rows = [(i, " ".join(word() for _ in range(10)) + (f" {hot} x" if i < 50 else f" {cold} x" if i < 60 else "")) for i in range(100)]
    bench = llm.createDataFrame([(1, hot), (2, cold)], "item_id long, text string")
    got = decontaminate.leaks(llm.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(i, 1 if i < 50 else 2) for i in range(60)}
    assert {r.n_seeds for r in got if r.item_id == 2} == {27} and max(r.n_seeds for r in got if r.item_id == 1) < 27


def test_null_and_repeated_items(llm):
    item = " ".join(f"w{i}" for i in range(20))
    bench = llm.createDataFrame([(None, item), (-1, item), (-1, item), (5, "x " + item), (5, "other words that stand in no text")], "item_id long, text string")
    docs = llm.createDataFrame([(1, "a b " + item + " c"), (None, item), (1, item), (2, "clean")], "doc_id long, text string")
    for chars in (8 << 20, 40):
        got = decontaminate.leaks(docs, bench, block_chars=chars).collect()
        assert Counter((r.doc_id, r.item_id) for r in got) == Counter([(d, i) for d in (1, None, 1) for i in (None, -1, -1, 5)])
        assert [r.doc_id for r in decontaminate.decontaminate(docs, bench, block_chars=chars).collect()] == [2]


def direct_toxicity(model, text):
    """p_toxic and expected severity from the model's weights, word by word."""
    words_ = Counter(re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").translate({c: chr(c + 32) for c in range(65, 91)})))
    weight = dict(zip(model.slots.tolist(), model.weights.tolist()))
    slots = Counter()
    for w, n in words_.items():
        h = toxicity.words(*toxicity.text_bytes(pa.array([w])), between=toxicity.MARKS)[0]
        slots[int(h[0] >> np.uint64(64 - model.bits))] += n
    z = sum(weight.get(s, 0) * (1 + math.log2(n)) for s, n in slots.items())
    p = [1 / (1 + math.exp(-(z - c))) for c in model.cuts]
    of = [a - b for a, b in zip([1, *p], [*p, 0])]
    return sum(words_.values()), p[0], sum(p), of.index(max(of)), p[0] >= toxicity.CUT


def test_toxicity_scores_word_by_word(llm, odd):
    sf = "/root/testdata/sf0.01"
    docs, labels = documents(llm, sf), llm.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.train(docs, labels)
    both = docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    texts = [(r.doc_id, r.text) for r in both.collect()]
    got = sorted((tuple(r) for r in toxicity.score(both, model).collect()), key=repr)
    want = sorted(((d, *direct_toxicity(model, t)) for d, t in texts), key=repr)
    assert len(model.slots) > 5 and len({g[4] for g in got}) > 1
    for g, w in zip(sorted(got, key=lambda r: (str(r[0]), r[1])), sorted(want, key=lambda r: (str(r[0]), r[1]))):
        assert g[:2] == w[:2] and g[4:] == w[4:] and math.isclose(g[2], w[2], rel_tol=1e-9) and math.isclose(g[3], w[3], rel_tol=1e-9)


def test_toxicity_learns_one_row_of_a_labelled_id(llm):
    sf = "/root/testdata/sf0.01"
    docs, labels = documents(llm, sf).select("doc_id", "text"), llm.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.train(docs, labels)
    one = labels.where("toxic = 0").first().doc_id
    many = docs.unionByName(llm.range(500).selectExpr(f"cast({one} as long) doc_id", "concat('zzz filler ', id) text"))
    again = toxicity.train(many, labels)
    assert np.array_equal(again.slots, model.slots) and np.allclose(again.weights, model.weights, rtol=0.2)


def test_places_left_out_could_not_reach(llm, monkeypatch):
    rnd = random.Random(13)
    texts = [" ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 90))) for _ in range(40)]
    items = decontaminate.Items.of(list(range(12)), [" ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 25))) for _ in range(12)], 4)
    got = items.leaks(pa.array(texts), 0.5)
    monkeypatch.setattr(decontaminate, "_USES", 7)
    few = items.leaks(pa.array(texts), 0.5)
    monkeypatch.setattr(decontaminate.Items, "reachable", lambda self, item, *_: np.ones(len(item), bool))
    every = items.leaks(pa.array(texts), 0.5)
    assert len(got[0]) and all(np.array_equal(x, y) and np.array_equal(x, z) for x, y, z in zip(got, few, every))


def test_pipeline_stages(llm):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_duplicates", "decontamination", "packing"]
    docs, sizes = documents(llm, SF), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(llm, docs, SF).cache()
        assert docs.columns == documents(llm, SF).columns
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and 0 < sizes[-1] < 200
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    assert {r.doc_id for r in corpus_pipeline.run(llm, SF).collect()} == ids


def test_pipeline_tasks_give_memory_back(llm, monkeypatch):
    """Workers stay beside the executor's heap from stage to stage: what a task freed must not stay with them."""
    tasks, plain = [], type(llm.range(0)).mapInArrow

    def record(self, func, *args, **kw):
        tasks.append(func)
        return plain(self, func, *args, **kw)

    monkeypatch.setattr(type(llm.range(0)), "mapInArrow", record)
    corpus_pipeline.run(llm, SF).count()
    assert len(tasks) > 10 and [f.__name__ for f in tasks if not getattr(f, "releases", False)] == []


def test_freed_memory_leaves_the_process():
    def used():
        return int(re.search(r"\nRssAnon:\s+(\d+)", open("/proc/self/status").read())[1]) >> 10

    last = []

    def run(batches):
        for b in batches:
            held = [np.ones(8192) for _ in range(4000)]       # 250 MB, the last one stays above what is freed
            last.append(held.pop())
            del held
            yield b

    before = used()
    assert list(tidy(run)(iter([1, 2]))) == [1, 2]
    assert used() < before + 60


def test_local_rows(llm):
    got = local_rows(llm, [(1, 2), (3, 4)], "a", "b")
    assert got.dtypes == [("a", "bigint"), ("b", "bigint")] and sorted(map(tuple, got.collect())) == [(1, 2), (3, 4)]
    none = local_rows(llm, [], "a", "b")
    assert none.dtypes == got.dtypes and none.collect() == []


def _near_words(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").translate({c: chr(c + 32) for c in range(65, 91)}))


def test_pipeline_against_brute_force(llm):
    """Every stage recomputed on the whole of a small table: what is packed is what brute force leaves, and is packed whole."""
    from tokenizers import Tokenizer

    from wareflow.llm.pieces import default_tokenizer
    from .test_duplicates import near_brute
    from .test_tokens import check_packed
    docs, labels = documents(llm, SF), llm.read.parquet(f"{SF}/labels.parquet")
    left = {r.doc_id: r.text for r in docs.collect()}
    model = toxicity.train(docs, labels)
    left = {d: t for d, t in left.items() if not direct_toxicity(model, t)[4]}
    equal = {}
    for d, t in left.items():
        equal.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), d))
    left = {min(g)[1]: left[min(g)[1]] for g in equal.values()}
    left = {d: left[d] for d, (_, root) in near_brute(left).items() if root == d}
    items = [_near_words(r.text) for r in llm.read.parquet(f"{SF}/benchmark.parquet").collect()]
    grams = lambda w, k: {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
    leaked = set()
    for d, t in left.items():
        w = _near_words(t)
        for item in items:
            k = min(4, len(item))
            if k and grams(item, k) & grams(w, k) and direct_score(item, w) >= 0.5 * 2 * len(item):
                leaked.add(d)
                break
    left = {d: t for d, t in left.items() if d not in leaked}
    assert 0 < len(left) < docs.count() and leaked
    check_packed(corpus_pipeline.run(llm, SF).collect(), left, Tokenizer.from_file(default_tokenizer()), 2048)
