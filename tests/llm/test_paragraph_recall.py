"""Near copies of whole paragraphs against brute force."""

import collections

from llm_data import frame, words
from test_corpus import shingles
from tablesmith.llm import paragraphs


def test_one_changed_word_of_a_line(spark):
    """Lines of 40 to 100 words between other lines, one inner word changed in the copy."""
    rows, near = [], []
    for k in range(200):
        line = words(k, 40 + k % 61, 10**6)
        at = 8 + k % (len(line) - 16)
        changed = [*line[:at], f"changed{k}", *line[at + 1:]]
        a, b = shingles(" ".join(line)), shingles(" ".join(changed))
        if 100 * len(a & b) >= 75 * len(a | b):
            near.append(k)
        for doc, text in ((2 * k, line), (2 * k + 1, changed)):
            rows.append((doc, "\n".join(" ".join(x) for x in (words(9000 + doc, 40, 10**6), text, words(20_000 + doc, 40, 10**6)))))
    text = dict(rows)
    lines = collections.defaultdict(set)
    for g in paragraphs.repeated(frame(spark, rows)).collect():
        if text[g.doc_id].encode()[g.start:g.end].decode() == text[g.doc_id].split("\n")[1]:
            lines[g.doc_id // 2].add((g.component_id, g.n_copies, g.doc_id % 2, g.removed))
    found = {k for k, x in lines.items() if len({c for c, *_ in x}) == 1 and {y[1:] for y in x} == {(2, 0, False), (2, 1, True)}}
    assert len(near) == 200
    assert len(found & set(near)) >= 0.96 * len(near)


def test_short_lines_and_blocks(spark):
    """Whole paragraphs are reported below the words of a passage; a line in its own block is no copy of it."""
    line, block = " ".join(words(1, 14)), " ".join(words(2, 3)) + "\n" + " ".join(words(3, 60))
    rows = [(1, f"{' '.join(words(11, 30))}\n{line}\n{' '.join(words(12, 30))}"), (2, f"{' '.join(words(13, 30))}\n{line}\n{' '.join(words(14, 30))}"),
            (3, f"{' '.join(words(15, 30))}\n\n{block}\n \n{' '.join(words(16, 30))}")]
    got = paragraphs.repeated(frame(spark, rows)).collect()
    assert [(g.doc_id, g.n_words, g.removed) for g in sorted(got)] == [(1, 14, False), (2, 14, True)]
    more = [*rows, (4, f"{' '.join(words(17, 30))}\n\n{block}\n\n{' '.join(words(18, 30))}")]
    got = [g for g in paragraphs.repeated(frame(spark, more)).collect() if g.doc_id > 2]
    assert {(g.doc_id, g.removed) for g in got} == {(3, False), (4, True)} and {g.n_copies for g in got} == {2}
    assert {63, 60} <= {g.n_words for g in got}
