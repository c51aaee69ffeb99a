"""Suffix trees and periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_data import frame, words
from tablesmith.llm import queries, runs
from tablesmith.llm.suffixtree import RangeMinima, SuffixTree, maximal_runs

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(s, least=2):
    """Every maximal stretch of equal places q apart, smallest periods only."""
    out = []
    for q in range(1, len(s) // 2 + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            n = j - i + q
            if j > i and n >= max(least, 2 * q) and not any(s[i:j + q - p] == s[i + p:j + q] for p in range(1, q)):
                out.append((i, n, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


SMALL = st.one_of(st.lists(st.integers(1, 2), max_size=40), st.lists(st.integers(1, 4), max_size=60),
                  st.builds(lambda a, b, k: a + b * k + a, st.lists(st.integers(1, 3), max_size=8), st.lists(st.integers(1, 3), max_size=9), st.integers(1, 6)))


@settings(max_examples=400, deadline=None)
@given(SMALL)
def test_runs_of_small_sequences(s):
    assert [tuple(r) for r in maximal_runs(s).tolist()] == brute_runs(s)
    assert runs.runs_of([bytes([x]) for x in s]) == brute_runs(s, 12)
    assert runs.runs_of([bytes([x]) for x in s], 7) == brute_runs(s, 7)


@settings(max_examples=200, deadline=None)
@given(SMALL)
def test_suffix_order_and_extensions(s):
    tree, n = SuffixTree(s), len(s)
    assert tree.rank.tolist() == np.argsort(np.argsort([sorted(range(n + 1), key=lambda i: s[i:]).index(i) for i in range(n + 1)])).tolist()
    opposite = [-x for x in s]
    order = sorted(range(n + 1), key=lambda i: opposite[i:])
    assert [order.index(i) for i in range(n + 1)] == tree.rank_reversed.tolist()
    pairs = [(i, j) for i in range(n + 1) for j in range(n + 1) if i != j][:400]
    if pairs:
        i, j = np.array(pairs).T
        want = [next((k for k in range(n) if max(a, b) + k >= n or s[a + k] != s[b + k]), n) for a, b in pairs]
        assert tree.common(i, j).tolist() == want


def test_range_minima():
    rng = np.random.default_rng(5)
    for n in (1, 31, 32, 33, 700):
        v = rng.integers(0, 50, n)
        lo = rng.integers(0, n, 300)
        hi = np.array([rng.integers(a, n) for a in lo])
        assert RangeMinima(v).query(lo, hi).tolist() == [v[a:b + 1].min() for a, b in zip(lo, hi, strict=True)]


def brute_row(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w, 12) if n < 400 else runs.runs_of([x.encode() for x in w])
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (str(doc_id), len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def rows_of(df):
    return sorted(((str(r.doc_id), r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in df.collect()), key=str)


def test_query_on_edge_rows(spark, edges, edge_rows, nothing):
    found = runs.digest(runs.find_runs(edges, rewrite=runs.made_periodic))
    assert rows_of(found) == sorted((brute_row(r[0], r[1]) for r in edge_rows), key=str)
    assert runs.digest(runs.find_runs(nothing)).count() == 0


def test_query_on_the_table(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    assert rows_of(queries.op11_periodic_runs(spark, SF)) == sorted((brute_row(*r) for r in rows), key=str)


def test_outputs(spark):
    line = "one two three four five six"
    text = f"begin {line} {line} {line} end"
    rows = [(1, text), (2, "a b " * 6), (3, "a b " * 5), (None, text), (1, text)]
    got = {(r.doc_id, r.collapsed, tuple(map(tuple, r.runs))) for r in runs.find_runs(frame(spark, rows)).collect()}
    assert got == {(1, f"begin {line} end", ((1, 18, 6),)), (None, f"begin {line} end", ((1, 18, 6),)),
                   (2, "a b", ((0, 12, 2),)), (3, "a b a b a b a b a b", ())}


def test_long_repetitive_text():
    rng = random.Random(3)
    for unit in (["a"], ["a", "b"], words(4, 900)):
        w = [x.encode() for x in unit] * (30_000 // len(unit))
        assert runs.runs_of(w)[0] == (0, len(w), len(unit))
    assert runs.runs_of([str(rng.random()).encode() for _ in range(30_000)]) == []
