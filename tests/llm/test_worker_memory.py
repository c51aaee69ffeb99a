"""What a worker holds while it cuts and scores texts: workers outlive a stage, so one stage's arrays burden the next."""

import re
import tracemalloc
from pathlib import Path

import numpy as np

from tablesmith.llm import jaccard
from tablesmith.llm.quality import KEEP_BYTES
from tablesmith.llm.textarrays import SLICE_BYTES, _power_tables, _powers, handed_back, window_hashes, word_hashes, shingle_set
from llm_data import words


def texts(total):
    one = (" ".join(words(3, 2000)) + " ").encode()
    rows = [one] * (total // len(one)) + [b"", b"a b", one]
    return np.frombuffer(b"".join(rows), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in rows])])


def test_sets_of_a_slice_take_little_memory():
    data, offsets = texts(SLICE_BYTES)
    _power_tables(len(data) + 1)
    tracemalloc.start()
    rows = sum(1 for _ in jaccard._sets(data, offsets, 5))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == len(offsets) - 1
    assert peak < 8 * SLICE_BYTES  # 20 times the slice when it was hashed whole


def test_sets_are_those_of_the_whole_slice():
    data, offsets = texts(3 * jaccard.PART_BYTES)
    whole, bounds = word_hashes(data, offsets)
    windows = window_hashes(whole, 5)
    got = list(jaccard._sets(data, offsets, 5))
    assert [r for r, _ in got] == list(range(len(offsets) - 1))
    for r, s in got:
        assert s.tolist() == shingle_set(whole, windows, int(bounds[r]), int(bounds[r + 1]), 5).tolist()


def test_kept_rows_are_scored_in_small_parts():
    assert KEEP_BYTES <= SLICE_BYTES // 8


def resident():
    return int(re.search(r"VmRSS:\s+(\d+)", Path("/proc/self/status").read_text())[1]) << 10


def test_a_finished_task_gives_memory_back():
    before = resident()
    held = [np.arange(1 << 14) for _ in range(400)]  # 128 KB each, which the allocator would keep
    _power_tables(4 * SLICE_BYTES)
    taken = resident() - before
    held = held[-1:]  # the last one stands above the free ones
    handed_back()
    assert len(_powers[0]) == 1 and len(held) == 1
    assert resident() - before < taken // 4
    assert _power_tables(100)[0][1] * _power_tables(100)[1][1] == 1
