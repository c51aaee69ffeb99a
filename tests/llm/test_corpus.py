"""Operators over the whole corpus: links, passages, the language model, the pipeline."""

import collections
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from llm_data import frame, words
from tablesmith.llm import buckets, hmm, jaccard, paragraphs, quality, secret_scan, tiling
from tablesmith.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def test_components(spark):
    rng = random.Random(1)
    chain = [(k, k + 1) for k in range(100, 160)]
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + chain + [(7, 7)] + [(500, 501)] * 3
    parent = {x: x for e in links for x in e}
    for a, b in links:
        a, b = sorted((find(parent, a), find(parent, b)))
        parent[b] = a
    got = {r.node: r.component for r in components(spark.createDataFrame([*links, (None, 3), (4, None)], "a long, b long")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: find(parent, x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_classes(rows):
    sets = [(r[0], shingles(r[1])) for r in rows if r[0] is not None]
    parent = {i: i for i, _ in sets}
    for (i, a), (j, b) in itertools.combinations(sets, 2):
        n = len(a & b)
        if n and 100 * n >= 75 * len(a | b):
            x, y = sorted((find(parent, i), find(parent, j)))
            parent[y] = x
    return sorted((str(r[0]), len(shingles(r[1])), None if r[0] is None else find(parent, r[0])) for r in rows)


def near(rng, base, share):
    return [w if rng.random() > share else f"z{rng.randrange(10**6)}" for w in base]


@pytest.fixture(scope="module")
def copies():
    """Near copies around the threshold, chains, common passages, short texts, exact ties."""
    rng = random.Random(3)
    rows, k = [], 100
    for g in range(6):
        base = words(1000 + g, rng.randrange(12, 120))
        for _ in range(12):
            rows.append((k, " ".join(near(rng, base, rng.choice([0, 0.01, 0.03, 0.05]))).title()))
            k += 1
        base = near(rng, base, 0.04)
    line = words(2000, 30)
    for _ in range(60):
        rows.append((k, " ".join(words(3000 + k, rng.randrange(4, 60)) + line + words(4000 + k, rng.randrange(3)))))
        k += 1
    tie = words(5000, 11)  # 7 shingles against 7 + 0; and 6 of 8 = 75 per cent
    rows += [(k, " ".join(tie[:11])), (k + 1, " ".join(tie[:10] + ["end", "x"][:1])), (k + 2, "a b c"), (k + 3, "A B C"), (k + 4, "a b")]
    return rows


def test_jaccard_classes(spark, copies, edge_rows):
    rows = copies + [r for r in edge_rows if r[0] != 12]
    want = brute_classes(rows)
    read = lambda **a: sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in jaccard.classes(frame(spark, rows), **a).collect())
    assert read() == want
    assert read(kinds=3) == want  # many shingles count as common and are indexed in pairs
    kept = jaccard.keep_first(frame(spark, rows))
    assert kept.columns == frame(spark, []).columns
    firsts = sorted({c for _, _, c in want if c is not None})
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == firsts


def test_jaccard_edges(spark, edges, edge_rows, nothing):
    got = jaccard.classes(edges).collect()
    assert len(got) == len(edge_rows)
    by = collections.defaultdict(set)
    for g in got:
        by[g.doc_id].add(g.component_id)
    assert by[2] == by[11] == by[1] == {1} and by[3] == {3} and by[5] == {5} and by[None] == {None} and 12 in by[12] | {6}
    assert jaccard.classes(nothing).count() == 0 and jaccard.keep_first(nothing).count() == 0


def test_signatures_meet():
    """Sets over the threshold share a signature, whatever is common."""
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(2, 40))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
        drop, add = int(rng.integers(0, len(a) // 4 + 1)), int(rng.integers(0, len(a) // 6 + 1))
        b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 2**63, add).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 75 * (len(a) + len(b) - both):
            continue
        pool = np.union1d(a, b)
        common = np.sort((rng.permutation(pool)[: int(rng.integers(0, len(pool) + 1))] >> np.uint64(32 - jaccard._SAMPLE_BITS)).view(np.int64))
        x, y = jaccard.signatures(a, common, 75), jaccard.signatures(b, common, 75)
        assert len(a) == len(b) == both or np.intersect1d(x[0], y[0]).size or np.intersect1d(x[1], y[1]).size


def test_packed_entries():
    rng = np.random.default_rng(3)
    sig = rng.integers(0, 2**64 - 1, 500, dtype=np.uint64)
    sig = np.concatenate([sig, sig[:100], sig[:100]])
    node = np.concatenate([np.arange(600), np.arange(500, 600)])
    for bits in (0, 3):
        back = [(r, len(np.frombuffer(e, dtype=buckets.ENTRY))) for r, e in buckets.packed(sig, node, bits)]
        assert sum(n for _, n in back) == 600 and len(back) == 2 ** bits


def test_repeated_passages(spark, nothing):
    passage = words(9, 60)
    rows = [(k, " ".join(words(100 + k, 50 + k) + passage + words(200 + k, 40))) for k in range(30)]
    rows += [(50 + k, " ".join(words(300 + k, 150))) for k in range(20)]
    changed = passage[:30] + ["other"] + passage[31:]
    rows += [(80, " ".join(words(1, 30) + changed)), (81, None), (82, ""), (None, " ".join(passage)), (83, "Is on. " * 200), (84, " ".join(words(5, 100))), (84, " ".join(words(5, 100)))]
    got = paragraphs.repeated(frame(spark, rows)).collect()
    flagged = {g.doc_id for g in got}
    assert flagged >= {*range(30), 80, 84, None} and not flagged & {*range(50, 70), 81, 82}
    text = dict((r[0], r[1]) for r in rows)
    for g in got:
        if g.doc_id in range(30):
            assert text[g.doc_id].encode()[g.start:g.end].decode().split()[0] in text[g.doc_id].split()
    kept = collections.Counter(g.component_id for g in got if not g.removed)
    assert all(n == 1 for n in kept.values())
    assert paragraphs.repeated(nothing).count() == 0


def test_passages_do_not_depend_on_their_place():
    rng = random.Random(4)
    for seed in range(40):
        passage = words(seed, 51)
        found = []
        for n in (0, 17):
            text = " ".join(words(900 + seed + n, n) + passage + words(700 + seed, rng.randrange(20)))
            data = np.frombuffer(text.encode(), dtype=np.uint8)
            *_, first, end, _, grams = paragraphs._paragraphs(None, data, np.array([0, len(data)]))
            found.append(set(paragraphs._node(grams, first, end).tolist()))
        assert found[0] & found[1]


def tokens(text):
    return WORD.findall((text or "").translate(LOWER)) + [None]


def test_language_model_counts(spark, edges, edge_rows, nothing):
    learn = collections.Counter()
    for r in edge_rows:
        if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 != 2:
            learn.update(tokens(r[1]))
    n, v = sum(learn.values()), len(learn)
    want = sorted((str(r[0]), len(tokens(r[1])), sum(learn[t] > 0 for t in tokens(r[1])), n,
                   round(sum(math.log10((learn[t] + 1) / (n + v + 1)) for t in tokens(r[1])), 6)) for r in edge_rows)
    got = hmm.score_texts(edges, block_bytes=20_000).collect()
    assert sorted((str(g.doc_id), g.n_tokens, g.n_known, g.train_tokens, round(g.base_score, 6)) for g in got) == want
    assert all(math.isfinite(g.score) and g.score < 0 for g in got)
    assert hmm.score_texts(nothing).count() == 0


def small_model(rng, top):
    symbols = len(top) + hmm.CLASSES + 1
    return hmm.Model(rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(symbols), 3).T, top)


def test_forward_and_counts_against_all_paths():
    rng = np.random.default_rng(5)
    model = small_model(rng, np.zeros(0, np.uint64))
    rows = [[4, 9, 4, hmm.CLASSES], [hmm.CLASSES], [1, hmm.CLASSES]]
    symbols, bounds = np.concatenate(rows), np.array([0, 4, 5, 7])
    want = np.zeros(3 + 9 + model.emit.size)
    for k, row in enumerate(rows):
        paths = {}
        for path in itertools.product(range(3), repeat=len(row)):
            p = model.start[path[0]]
            for t, s in enumerate(path):
                p *= model.emit[row[t], s] * (model.move[path[t - 1], s] if t else 1)
            paths[path] = p
        total = sum(paths.values())
        assert math.isclose(hmm.forward(model, symbols, bounds)[0][k], math.log(total), rel_tol=1e-12)
        for path, p in paths.items():
            want[path[0]] += p / total
            for t, s in enumerate(path):
                want[12 + row[t] * 3 + s] += p / total
                if t:
                    want[3 + path[t - 1] * 3 + s] += p / total
    assert np.allclose(hmm.expected(model, symbols, bounds), want)


def test_language_model_learns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = hmm.score_texts(docs).toPandas()
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()


def test_pipeline_stages(spark):
    """Each stage against brute force on what the one before it kept."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").cache()
    labels, bench = spark.read.parquet(f"{sf}/labels.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "ngram_jaccard_join", "benchmark_decontamination", "secret_scans", "bpe_encoding"]
    stage = dict(corpus_pipeline.STAGES)
    good = stage["quality_classifier"](spark, docs, sf).cache()
    scored = {r.doc_id: r.score for r in quality.score(docs, quality.fit_training_fold(docs, labels)).collect()}
    assert sorted(r.doc_id for r in good.collect()) == sorted(i for i, s in scored.items() if s >= quality.THRESHOLD)
    one = stage["ngram_jaccard_join"](spark, good, sf).cache()
    assert sorted(r.doc_id for r in one.collect()) == sorted({c for _, _, c in brute_classes([(r.doc_id, r.text) for r in good.collect()])})
    clean = stage["benchmark_decontamination"](spark, one, sf).cache()
    left = {r.doc_id: r.text for r in clean.collect()}
    for r in one.collect():
        assert (r.doc_id in left) != any(b.text in r.text for b in bench)
    safe = stage["secret_scans"](spark, clean, sf).cache()
    assert sorted(r.doc_id for r in safe.collect()) == sorted(left)
    live = {r.repo for r in secret_scan.scan(clean).collect() if any(s.verdict == "live" for s in r.spans)}
    assert {r.doc_id for r in safe.collect() if r.text != left[r.doc_id]} == live
    for frame_ in (good, one, clean, safe):
        assert frame_.columns == docs.columns
    ids = stage["bpe_encoding"](spark, safe, sf)
    assert ids.where("NOT round_trip").count() == 0 and ids.count() == safe.count()
    assert tiling.contaminated(clean, spark.read.parquet(f"{sf}/benchmark.parquet")).count() == 0


def test_pairs_across_classes(spark):
    rng = random.Random(6)
    rows = [(0, True, rng.randrange(40), rng.randrange(30)) for _ in range(200)]
    rows = sorted({(r, s, g, n, n % 11) for r, s, g, n in rows})
    want = collections.Counter()
    for x, y in itertools.combinations(rows, 2):
        if x[2] == y[2] and x[4] != y[4]:
            want[min(x[3], y[3]), max(x[3], y[3])] += 1
    members = spark.createDataFrame(rows, "range long, single boolean, sig long, node long, class long")
    got = {(r.a, r.b): r.shared for r in buckets.across(members).collect()}
    assert got == dict(want)


def test_sketches_keep_every_link():
    rng = np.random.default_rng(7)
    for _ in range(200):
        pool = rng.integers(0, 2**64 - 1, 400, dtype=np.uint64)
        a = np.unique(rng.choice(pool, int(rng.integers(1, 300)), replace=False))
        b = np.unique(np.concatenate([rng.choice(a, max(1, int(len(a) * rng.uniform(0.6, 1))), replace=False), rng.choice(pool, int(rng.integers(0, 40)))]))
        both = len(np.intersect1d(a, b))
        s = buckets.Sketches(np.array([1, 2]), np.array([len(a), len(b)]), np.stack([jaccard.sketch_of(a), jaccard.sketch_of(b)]), 75)
        link = 100 * both >= 75 * (len(a) + len(b) - both)
        assert s.possible(np.array([1]), np.array([2]))[0] or not link
