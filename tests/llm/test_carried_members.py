"""What a task of the similarity join holds: its own members with their sketches, and few pairs."""

import itertools
import re
from pathlib import Path

import numpy as np
from llm_data import frame, words
from test_corpus import find, shingles

from tablesmith.llm import bpe, buckets, jaccard
from tablesmith.llm.textarrays import handed_back


def template(n, length=120, places=12):
    """Texts of one template with one of ``places`` words changed and a third of their own: near copies below the threshold."""
    base = words(7, length, 10**6)
    return [(k, " ".join([*base[: 2 * length // 3], f"own{k}", *words(100 + k % places, length // 3, 10**6)])) for k in range(n)]


def test_a_bucket_stands_once_and_keeps_its_count(spark):
    sets = {1: [10, 20, 30, 40, 50], 2: [10, 20, 30, 60], 3: [40, 70], 4: [50, 60, 80]}
    sig = np.array([s << 50 for v in sets.values() for s in v], dtype=np.uint64)
    node = np.array([k for k, v in sets.items() for _ in v], dtype=np.int64)
    index = spark.createDataFrame([(r, single, bytearray(e)) for single in (True, False) for r, e in buckets.packed(sig, node, 4)],
                                  "range bigint, single boolean, entries binary")
    got = [r for r in buckets.meet(index).collect() if r.single is not None]
    by = {}
    for r in got:
        by.setdefault((r.range, r.sig), []).append(r)
    want = {}
    for a, b in itertools.combinations(sets, 2):
        n = len({*sets[a]} & {*sets[b]})
        if n:
            want[(a, b)] = n
    assert {tuple(sorted({r.node for r in rows})): sum(r.shared for r in rows) // 2 for rows in by.values()} == want
    assert sum(r.single for r in got if r.node == 1) < 5  # it shares five signatures, in three buckets


def test_members_bring_sketches_and_nothing_is_broadcast(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 2**63, 200).astype(np.uint64))
    sets = {k: base[n:] for k, n in {1: 0, 2: 1, 3: 2, 4: 12, 5: 30, 6: 120}.items()}
    cls = {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6}
    rows = [(r, True, 7, k, r + 1, len(s), bytearray(jaccard.sketch_of(s).tobytes()), cls[k], 3 if cls[k] == 1 else 1) for r in range(4) for k, s in sets.items()]
    members = spark.createDataFrame(rows, "range long, single boolean, sig long, node long, shared long, n long, sketch binary, class long, size long")
    near = {r.a: r.b for r in buckets.across(members, best=True, merged=1, percent=75).collect()}
    assert near == {4: 3, 5: 4}
    for merged in (0, 1, 2):
        pairs = {(r.a, r.b): r.shared for r in buckets.across(members.drop("size"), merged=merged, percent=75).collect()}
        assert pairs == {(a, b): 10 for a, b in itertools.combinations(range(1, 6), 2) if cls[a] != cls[b]}
    source = Path(jaccard.__file__).read_text()
    assert not re.search(r"broadcast\((?!k\)|common_shingles)", source)  # key lists of a checked length and the common shingles only


def test_pairs_leave_a_task_in_parts(spark, monkeypatch):
    """A bucket's pairs are no longer all held by its task; those sent in several parts count as one."""
    monkeypatch.setattr(buckets, "PAIRS_HELD", 100)
    sent = buckets.grouped

    def noted(frame, run, schema):
        def few(table):
            at_once, buckets.PAIRS_AT_ONCE = buckets.PAIRS_AT_ONCE, 50
            parts = list(run(table))
            buckets.PAIRS_AT_ONCE = at_once
            assert len(parts) > 8 and max(len(p) for p in parts) < 300
            yield from parts

        return sent(frame, few, schema)

    monkeypatch.setattr(buckets, "grouped", noted)
    rows = [(0, True, s, k, k) for s in (1, 2) for k in range(60)]
    members = spark.createDataFrame(rows, "range long, single boolean, sig long, node long, class long")
    got = {(r.a, r.b): r.shared for r in buckets.across(members).collect()}
    assert got == {p: 2 for p in itertools.combinations(range(60), 2)}


def test_a_template_gives_few_candidates(spark, monkeypatch):
    """Texts that share most signatures and are links only within a group: as brute force, and few pairs are verified."""
    rows = template(240) + [(1000 + k, " ".join(words(50 + k, 60))) for k in range(20)]
    made = {}
    held = jaccard.written

    def counted(df, name):
        out = held(df, name)
        made[name] = max(made.get(name, 0), out.count())
        return out

    monkeypatch.setattr(jaccard, "written", counted)
    got = {r.doc_id: r.component_id for r in jaccard.classes(frame(spark, rows)).collect()}
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}
    for i, j in itertools.combinations(sets, 2):
        n = len(sets[i] & sets[j])
        if 100 * n >= 75 * len(sets[i] | sets[j]):
            a, b = sorted((find(parent, i), find(parent, j)))
            parent[b] = a
    assert got == {i: find(parent, i) for i in sets}
    assert max(n for name, n in made.items() if name.endswith("candidates")) < 4 * len(rows)
    assert made["jaccard-members"] < made["jaccard-buckets"]


def resident():
    return int(re.search(r"VmRSS:\s+(\d+)", Path("/proc/self/status").read_text())[1]) << 10


def test_another_stage_frees_the_vocabulary():
    """A worker that has encoded brings no vocabulary into the next run's first stages, and builds it again when it must."""
    spec = bpe.read_spec()
    handed_back()
    before = resident()
    first = bpe.loaded(spec).encode("some words to encode")
    taken = resident() - before
    assert bpe._loaded
    handed_back()
    assert not bpe._loaded and resident() - before < taken // 2
    assert bpe.loaded(spec).encode("some words to encode") == first
