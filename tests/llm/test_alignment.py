"""Token alignment and its pair index against brute force."""

import hashlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_data import frame
from tablesmith.llm import alignment, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(alignment._read(public_tokenizers.path(alignment.VOCABULARY_A)), alignment._read(public_tokenizers.path(alignment.VOCABULARY_B)))


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def stand_ins():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(rest)}}


def spans(tokens):
    ends = np.cumsum([len(t) for t in tokens]).tolist()
    return list(zip([0, *ends[:-1]], ends, strict=True))


def brute(libraries, text):
    """(A ids, B ids, group texts, links) or None."""
    if not text:
        return None
    a, b = libraries
    table = stand_ins()
    x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    xb = [bytes(table[c] for c in a.id_to_token(i)) for i in x]
    yb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
    if not b"".join(xb) == b"".join(yb) == (" " + text).encode():
        return None
    xs, ys = spans(xb), spans(yb)
    links, lo = [], 0
    for i, (s, e) in enumerate(xs):
        while ys[lo][1] <= s:
            lo += 1
        j = lo
        while j < len(ys) and ys[j][0] < e:
            links.append((x[i], y[j]))
            j += 1
    cuts = sorted({e for _, e in xs} & {e for _, e in ys})
    at = {c: k for k, c in enumerate(cuts)}
    groups = [([], []) for _ in cuts]
    for side, (ids, where) in enumerate(((x, xs), (y, ys))):
        for i, (_, e) in zip(ids, where, strict=True):
            groups[at[min(c for c in cuts if c >= e)] if len(cuts) < 400 else int(np.searchsorted(cuts, e))][side].append(i)
    return x, y, [",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups], links


def brute_rows(libraries, rows):
    each = [brute(libraries, t) for _, t in rows]
    docs = Counter(p for e in each if e for p in set(e[3]))
    most = defaultdict(int)
    for (a, _), n in docs.items():
        most[a] = max(most[a], n)
    out = []
    for (doc_id, _), e in zip(rows, each, strict=True):
        if e is None:
            out.append((str(doc_id), 0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((str(doc_id), len(e[0]), len(e[1]), len(e[2]), len(e[3]), sum(docs[p] == most[p[0]] for p in e[3]), sum(docs[p] for p in e[3]),
                        hashlib.sha256(";".join(e[2]).encode()).hexdigest()))
    return sorted(out)


def rows_of(df):
    return sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


PARTS = ["a", "ther", "Token", " ", "  ", "\n", "\n\n", "\t", "\x1c", "\x85", " ", "é", "漢", "😀", "'s", "<|endoftext|>", "<s>", "<unk>", "▁", "12", "<0x0A>",
         "\x00", "don't", "ing", "　", "ﬁ", "́", "x"]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.lists(st.sampled_from(PARTS), max_size=25).map("".join), st.text(max_size=40)))
def test_alignment_of_texts(aligner, libraries, text):
    check(aligner, libraries, [text])


def check(aligner, libraries, texts):
    got = aligner.align(texts)
    for k, text in enumerate(texts):
        want, keys = brute(libraries, text), got.keys[got.owner == k]
        if want is None:
            assert got.counts[k].tolist() == [0] * 4 and got.groups[k] == b"" and not len(keys)
        else:
            assert got.counts[k].tolist() == [len(w) for w in want]
            assert got.groups[k].decode() == ";".join(want[2])
            assert Counter(keys.tolist()) == Counter(a << alignment.B_BITS | b for a, b in want[3])


def test_texts_together(libraries):
    """Words of one batch, some that need a whole text, in a small memory."""
    small = alignment.Aligner(alignment._read(public_tokenizers.path(alignment.VOCABULARY_A)), alignment._read(public_tokenizers.path(alignment.VOCABULARY_B)), memory=5)
    texts = ["the token there", None, "", "a▁b the", "tab\there", "x " * 40, "  ends in blanks \n", "\n\nfirst", "漢字 と かな", "▁", " ", "the▁ other", "good words"]
    for _ in range(2):
        check(small, libraries, texts)
    check(small, libraries, [None, ""])
    check(small, libraries, [])


BITS = st.lists(st.tuples(st.integers(0, 5), st.integers(0, 99)), max_size=300)


@settings(max_examples=100, deadline=None)
@given(BITS, BITS)
def test_bitmaps(one, two):
    def of(pairs, size):
        p = np.array(sorted(set(pairs)), dtype=np.int64).reshape(-1, 2)
        return alignment.Bitmaps.of(size, p[:, 0], p[:, 1])

    def held(b):
        return sorted(zip(*[x.tolist() for x in b.pairs()], strict=True))

    a, b = of(one, 100), of([(k, p % 40) for k, p in two], 40)
    both = alignment.Bitmaps.merged([a, b])
    want = sorted({*one, *((k, p % 40) for k, p in two)})
    assert held(a) == sorted(set(one)) and held(both) == want
    assert dict(zip(*[x.tolist() for x in both.popcounts()], strict=True)) == Counter(k for k, _ in want)
    assert held(alignment._unpacked(alignment._packed([both, a]))[0]) == want


def test_report_on_edge_rows(spark, libraries, edges, edge_rows, nothing):
    assert rows_of(alignment.report(edges)) == brute_rows(libraries, [(r[0], r[1]) for r in edge_rows])
    assert alignment.report(nothing).count() == 0


def test_report_on_the_table(spark, libraries):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    assert rows_of(queries.op13_tokenizer_alignment(spark, SF)) == brute_rows(libraries, rows)


def test_counts_and_groups(spark, libraries):
    rows = [(k, " ".join(["the token", "therefore", "the"] * (k % 4 + 1))) for k in range(40)] + [(None, "the"), (1, "the"), (1, None)]
    docs = frame(spark, rows)
    segments = alignment.index(docs, keep_groups=True)
    counts = alignment.pair_counts(segments)
    links = [(i, p) for i, (_, t) in enumerate(rows) for p in (brute(libraries, t) or ((),) * 4)[3]]
    got = {(r.a, r.b): (r.n_docs, r.n_links) for r in counts.collect()}
    assert got == {p: (len({i for i, q in links if q == p}), sum(q == p for _, q in links)) for p in {p for _, p in links}}
    out = alignment.scores(segments, counts).where("doc_id = 1 AND n_a = 1").collect()
    assert [r.groups for r in out] == [";".join(brute(libraries, "the")[2])]


def test_merged_chunks_equal_one(aligner):
    texts = ["a b c the the", "the a", "", "b " * 50, "the " * 9] * 30
    whole, cut = alignment._Segment(0, aligner), alignment._Segment(0, aligner)
    for k, t in enumerate(texts):
        whole.add(k, t)
        cut.add(k, t)
        if k % 7 == 3:
            cut.close_chunk()
    whole.close_chunk()
    cut.close_chunk()
    assert whole.rows == cut.rows
    for k, plane in enumerate(whole.chunks[0]):
        merged = alignment.Bitmaps.merged([c[k] for c in cut.chunks if k < len(c)])
        assert sorted(zip(*[x.tolist() for x in merged.pairs()], strict=True)) == sorted(zip(*[x.tolist() for x in plane.pairs()], strict=True))
