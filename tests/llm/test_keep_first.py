"""Which rows stay of near copies where ids repeat."""

import itertools

from llm_data import frame
from test_corpus import find, shingles
from tablesmith.llm import jaccard


def brute_kept(rows):
    """(id, text) of the rows that stay: of linked texts the one with the smallest id, blank texts link with nothing."""
    rows = sorted({(r[0], r[1]) for r in rows if r[0] is not None}, key=str)
    sets = [shingles(t) for _, t in rows]
    parent = {k: k for k in range(len(rows))}
    for i, j in itertools.combinations(range(len(rows)), 2):
        n = len(sets[i] & sets[j])
        if n and 100 * n >= 75 * len(sets[i] | sets[j]):
            parent[find(parent, i)] = find(parent, j)
    groups = {}
    for k, r in enumerate(rows):
        groups.setdefault(find(parent, k), []).append(r)
    return list(groups.values())


def test_repeated_ids_lose_no_text(spark, edge_rows):
    blank = [(20, None), (20, ""), (20, " "), (20, None), (21, "three words here"), (21, "Three WORDS here"), (22, "three words here")]
    rows = [*edge_rows, *blank, (12, "another text for the same id"), (6, "a second text of six"), (12, "a second text of six")]
    got = [(r.doc_id, r.text) for r in jaccard.keep_first(frame(spark, rows)).collect()]
    ids = [g for g in got if g[0] is not None]
    assert (6, "One two") in ids and (12, "another text for the same id") in ids and (12, "one TWO") not in ids
    groups = brute_kept(rows)
    assert len(ids) == len(groups)
    for group in groups:
        (kept,) = [g for g in ids if g in group]
        assert kept[0] == min(i for i, _ in group)
    assert len(got) - len(ids) == sum(r[0] is None for r in rows)
