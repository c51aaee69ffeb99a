"""Pairs of paragraphs that share a band: what leaves a bucket, and that no link is lost."""

import itertools
import random

import numpy as np

from llm_data import frame, words
from tablesmith.llm import buckets, paragraphs


def test_carried_sketches_lose_no_link():
    rng = random.Random(2)
    sets = []
    for n in (1, 3, 9, 15, 16, 17, 40, 64, 65, 130, 300):
        base = rng.sample(range(2**32), n)
        for change in (0, 1, n // 8, n // 4, n // 2):
            sets.append(np.unique(np.array(base[change:] + rng.sample(range(2**32), rng.randrange(change + 1)) or [7], dtype=np.uint32)).view(np.int32))
    node = np.arange(len(sets), dtype=np.int64) * 5 - 40
    judge = buckets.Carried(node, np.array([len(s) for s in sets]), buckets.sketch_column(sets), 75)
    pairs = list(itertools.permutations(range(len(sets)), 2))
    apart = judge.apart(node[[i for i, _ in pairs]], node[[j for _, j in pairs]])
    held = [set(s.tolist()) for s in sets]
    linked = np.array([100 * len(held[i] & held[j]) >= 75 * len(held[i] | held[j]) for i, j in pairs])
    assert linked.sum() > 40 and (apart[linked] >= 0).all()
    assert (apart >= 0).sum() < linked.sum() + 0.03 * len(pairs)
    assert len(buckets.sketch_column([])) == 0


def test_a_line_template_leaves_few_pairs(spark, monkeypatch):
    """Lines that differ in one inner word share bands by the thousand and are no links: their pairs don't leave the task."""
    n, template = 400, words(5, 13)
    rows = [(k, f"{' '.join(template[:6])} name{k} {' '.join(template[7:])}") for k in range(n)]
    base = words(6, 60)
    rows += [(n + k, " ".join([*base[:k], f"other{k}", *base[k + 1:]])) for k in range(8, 40)]
    made = []
    held = paragraphs._verified

    def counted(pairs, *more, **named):
        made.append(pairs.count())
        return held(pairs, *more, **named)

    monkeypatch.setattr(paragraphs, "_verified", counted)
    got = paragraphs.repeated(frame(spark, rows)).collect()
    assert {g.doc_id for g in got} == set(range(n + 8, n + 40))
    assert len({g.component_id for g in got if g.n_words == 60}) == 1
    assert sum(made[1:]) < 4 * len(rows)  # 29,472 pairs of the lines share a band


def test_near_copies_below_the_threshold_leave_few_rows(spark, monkeypatch):
    """Lines with one word changed at one of twelve places: alike enough to share bands and to have sketches that
    don't tell them apart, links only where the place is the same. No table grows with the pairs."""
    n, base = 480, words(7, 69, 10**6)
    rows = [(k, " ".join([*base[:4 + k % 12 * 5], f"changed{k}", *base[5 + k % 12 * 5:]])) for k in range(n)]
    made = {}
    held = paragraphs.written

    def counted(df, name):
        out = held(df, name)
        made[name] = max(made.get(name, 0), out.count())
        return out

    monkeypatch.setattr(paragraphs, "written", counted)
    got = [g for g in paragraphs.repeated(frame(spark, rows)).collect() if g.n_words == 69]
    assert sorted(g.doc_id for g in got) == list(range(n))
    assert {(g.doc_id % 12, g.n_copies, g.removed) for g in got} == {(k, n // 12, r) for k in range(12) for r in (False, True)}
    assert len({(g.doc_id % 12, g.component_id) for g in got}) == 12
    assert max(made.values()) < 40 * n  # some 50,000 pairs of 480 lines pass their sketches


def test_members_are_joined_as_all_their_links_do(spark):
    rng = random.Random(9)
    sets, bases = {}, [rng.sample(range(2**32), 40) for _ in range(12)]
    for node in range(240):
        keep = rng.randrange(28, 41)
        sets[node * 7 - 300] = sorted({*rng.sample(bases[node % 12], keep), *rng.sample(range(2**32), rng.randrange(8))})
    members = [(rng.randrange(2), rng.randrange(2) << 31 | (node // 7) % 12, node) for node in sets for _ in range(3)]
    members += members[:50]  # entries that come twice
    got = buckets.tied(spark.createDataFrame([(r, s, x, np.array(sets[x], dtype=np.uint32).view(np.int32).tolist()) for r, s, x in members],
                                             "range bigint, sig bigint, node bigint, shingles array<int>"), 75).collect()
    linked = {(x, y) for (r, s, x), (q, t, y) in itertools.combinations(sorted(set(members), key=lambda m: m[2]), 2)
              if (r, s) == (q, t) and x < y and 100 * len({*sets[x]} & {*sets[y]}) >= 75 * len({*sets[x]} | {*sets[y]})}

    def classes(pairs):
        least = {x: x for x in sets}
        for _ in range(len(sets)):
            before = dict(least)
            for x, y in pairs:
                least[x] = least[y] = min(least[x], least[y])
            if least == before:
                return least

    assert len(linked) > 100 and classes(linked) == classes([(g.a, g.b) for g in got])
    assert len(got) <= len(set(members))
    near = buckets.hopeful(spark.createDataFrame([(r, s, x, len(sets[x]), bytes(buckets.sketch_column([np.array(sets[x], dtype=np.uint32)])[0].as_py()))
                                                  for r, s, x in members], "range bigint, sig bigint, node bigint, n bigint, sketch binary"), 75).collect()
    assert len(near) <= len(set(members))
    kept = {(g.range, g.sig, g.node) for g in near}
    by = {}
    for r, s, x in set(members):
        by.setdefault((r, s), []).append(x)
    assert all({(r, s, x), (r, s, y)} <= kept for (r, s), of in by.items() for x, y in itertools.combinations(sorted(of), 2) if (x, y) in linked)
    assert len(kept) < len(set(members))


def test_lines_of_a_template_bring_no_sets(spark, monkeypatch):
    """Lines that share bands but can't be links by their sketches are no members of the task that verifies."""
    n, template = 400, words(5, 13)
    rows = [(k, f"{' '.join(template[:6])} name{k} {' '.join(template[7:])}") for k in range(n)]
    made = []
    held = paragraphs._verified

    def counted(members, *more, **named):
        made.append(members.count())
        return held(members, *more, **named)

    monkeypatch.setattr(paragraphs, "_verified", counted)
    assert paragraphs.repeated(frame(spark, rows)).count() == 0
    assert len(made) == 1 and made[0] < n // 4
