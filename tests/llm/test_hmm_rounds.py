"""Every Baum-Welch round of the language model sees every training document."""

import numpy as np

from llm_data import frame, words
from tablesmith.llm import hmm


def test_every_round_counts_all_documents(spark):
    rows = [(k, " ".join(words(k, 3 + k % 5, 60))) for k in range(4000)]
    blocked, size = hmm._blocked(frame(spark, rows), "text", "doc_id", 7, 2, 1 << 20)
    counts = hmm.count_words(blocked, size)
    got = hmm.train(blocked, counts)

    learn = [r.text.encode() for r in blocked.where("learn").collect()]
    assert len(learn) > 3000
    h, k, bounds = hmm.tokens(np.frombuffer(b"".join(learn), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in learn])]))
    background = np.concatenate([counts.top_counts, counts.class_tokens, [counts.ends]]) + 1.0
    background /= background.sum()
    want = hmm.train(blocked, counts, rounds=0)
    for _ in range(hmm.ROUNDS):
        want = hmm._updated(want, hmm.expected(want, want.symbols(h, k), bounds), background)
    assert hmm.ROUNDS == 3
    for name in ("start", "move", "emit"):
        assert np.allclose(getattr(got, name), getattr(want, name), rtol=1e-8, atol=1e-12)
