"""Common shingles are counted on all texts; pairs of a large bucket are made a block at a time."""

import collections
import itertools

import numpy as np
from llm_data import frame, words

from tablesmith.llm import buckets, jaccard
from tablesmith.llm.textarrays import slices


def test_common_shingles_are_those_of_all_texts(spark):
    line = words(1, 7)  # three shingles
    docs = frame(spark, [(k, " ".join(words(100 + k, 9) + line + words(900 + k, 2))) for k in range(40)]
                 + [(50 + k, " ".join(words(3000 + k, 30))) for k in range(12)])
    key = np.uint64(32 - jaccard._SAMPLE_BITS)
    sets = []
    for batch in docs.select("text").toArrow().to_batches():
        for _, data, offsets in slices(batch, "text"):
            sets += [s >> key for _, s in jaccard._sets(data, offsets, 5)]
    kinds = collections.defaultdict(list)  # of each shingle's texts; a text's kind is its least shingle
    for s in sets:
        for h in s.tolist():
            kinds[h].append(int(s[0]))
    want = sorted(h for h, k in kinds.items() if len(set(k)) >= 8 and len(set(k)) >= jaccard.COMMON_SHARE * len(k))
    most = max(len(set(k)) for k in kinds.values())
    texts = docs.select("doc_id", "text")
    assert 0 < len(want) <= 3
    for bits in (0, 9):  # the ranges of the count don't matter
        assert jaccard.common_shingles(texts, 5, 75, 8, bits).tolist() == want
    assert jaccard.common_shingles(texts, 5, 75, 8, most=0).tolist() == []
    assert jaccard.common_shingles(texts, 5, 75, most + 1).tolist() == []


def test_blocks_hold_few_pairs(monkeypatch):
    monkeypatch.setattr(buckets, "PAIRS_AT_ONCE", 100)
    sig = np.repeat([1, 2, 3], [300, 2, 4])
    node = np.arange(306)
    cls = np.concatenate([np.repeat([0, 1], 150), [7, 8], [9, 9, 9, 9]])
    blocks = list(buckets._blocks(node, cls, sig))
    assert max(len(x) for x, _ in blocks) <= 150  # one member's partners, or PAIRS_AT_ONCE
    got = sorted((int(a), int(b)) for x, y in blocks for a, b in zip(x, y, strict=True))
    assert got == sorted((a, b) for a, b in itertools.combinations(range(306), 2) if sig[a] == sig[b] and cls[a] != cls[b])


def test_nearest_partner_in_a_larger_class_and_merged_ranges(spark):
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 2**63, 200).astype(np.uint64))
    drop = {1: 0, 2: 1, 3: 2, 4: 12, 5: 30}
    sets = {k: base[n:] for k, n in drop.items()}
    sketches = spark.sparkContext.broadcast(buckets.Sketches(
        np.array(list(sets)), np.array([len(s) for s in sets.values()]), np.stack([jaccard.sketch_of(s) for s in sets.values()]), 75))
    cls = {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}
    rows = [(r, True, 7, k, cls[k], 3 if cls[k] == 1 else 1) for r in range(4) for k in sets]
    members = spark.createDataFrame(rows, "range long, single boolean, sig long, node long, class long, size long")
    got = {r.a: r.b for r in buckets.across(members, best=True, sketches=sketches, merged=1).collect()}
    assert got == {4: 3, 5: 4}
    for merged in (0, 1, 2):
        pairs = {(r.a, r.b): r.shared for r in buckets.across(members.drop("size"), merged=merged).collect()}
        assert pairs == {(a, b): 4 for a, b in itertools.combinations(sets, 2) if cls[a] != cls[b]}
