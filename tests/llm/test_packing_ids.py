"""Packing of null and repeated ids."""

import public_tokenizers
import pytest

from llm_data import frame, words
from tablesmith.llm import packing


@pytest.fixture(scope="module")
def encoder():
    with open(public_tokenizers.path(packing.VOCABULARY), "rb") as f:
        return packing.Encoder(f.read())


def test_null_and_repeated_ids(spark, encoder):
    rows = [(None, "one two"), (None, "one two"), (1, None), (1, "three " * 3000), (2, ""), (2, " ".join(words(1, 50)))]
    got = {}
    for r in packing.pack_documents(frame(spark, rows).coalesce(1), width=256, block_tokens=1000).collect():
        for doc, at, a, b in zip(r.doc_ids, r.doc_offsets, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            got.setdefault(doc, []).append((at, r.ids[a:b]))
    want = {}
    for doc, text in rows:
        ids = encoder.encoding.encode_ordinary(text or "")
        want.setdefault(doc, []).extend((a, ids[a: a + 256]) for a in range(0, max(len(ids), 1), 256))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
