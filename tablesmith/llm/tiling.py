"""Benchmark decontamination by greedy string tiling.

Documents meet benchmark items through shared seeds, hashed runs of
``SEED_WORDS`` words. For each document and item that share a seed, the longest
common runs of words that no earlier run has marked are marked again and again
(running Karp-Rabin, down to the seed's length). The share of the item's words
that is marked says how much of it the document holds, in whatever order the
passages stand.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tablesmith.llm.textarrays import handed_back, slices, window_hashes, word_hashes

SEED_WORDS = 4
#: Share of an item's words that marks a document as holding the item.
MIN_COVERAGE = 0.5
#: Benchmark words in one broadcast block; a larger benchmark takes a pass over the documents for each block.
BLOCK_WORDS = 2_000_000


def tiles(doc: np.ndarray, item: np.ndarray, least: int = SEED_WORDS) -> list[tuple[int, int, int]]:
    """(start in doc, start in item, length) of greedy non-overlapping common runs, longest first.

    Equal lengths: the smallest start in the document, then in the item. Runs
    are found from equal windows of ``least`` words and stretched while the
    words agree and are unmarked; windows of equal hash are compared by word
    hashes of 64 bits.
    """
    if len(doc) < least or len(item) < least:
        return []
    at: dict[int, list[int]] = defaultdict(list)
    for j, h in enumerate(window_hashes(item, least).tolist()):
        at[h].append(j)
    seeds = window_hashes(doc, least)
    hits = np.flatnonzero(np.isin(seeds, np.fromiter(at, dtype=np.uint64, count=len(at))))
    pairs = [(int(i), j) for i in hits for j in at[int(seeds[i])]]
    doc_free, item_free = np.ones(len(doc), dtype=bool), np.ones(len(item), dtype=bool)
    out: list[tuple[int, int, int]] = []
    d, t = doc.tolist(), item.tolist()
    while pairs:
        best, left, seen = (0, 0, 0), [], set()
        for i, j in pairs:
            if not (doc_free[i:i + least].all() and item_free[j:j + least].all()):
                continue
            left.append((i, j))
            if (i - 1, j - 1) in seen:  # inside a run that began one word earlier
                seen.add((i, j))
                continue
            seen.add((i, j))
            n = 0
            while i + n < len(d) and j + n < len(t) and d[i + n] == t[j + n] and doc_free[i + n] and item_free[j + n]:
                n += 1
            if n > best[0]:
                best = (n, i, j)
        n, i, j = best
        if n < least:
            break
        out.append((i, j, n))
        doc_free[i:i + n] = False
        item_free[j:j + n] = False
        pairs = left
    return out


class Seeds:
    """One block of the benchmark: its items' word hashes, and which items hold each seed."""

    def __init__(self, items: list[tuple[object, str]], seed: int):
        self.ids = [i for i, _ in items]
        text = pa.RecordBatch.from_arrays([pa.array([t for _, t in items], pa.large_string())], ["t"])
        self.words: list[np.ndarray] = []
        for _, data, offsets in slices(text, "t"):
            w, bounds = word_hashes(data, offsets)
            self.words += [w[a:b].copy() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        self.holders: dict[int, list[int]] = defaultdict(list)
        for k, w in enumerate(self.words):
            for h in window_hashes(w, min(seed, len(w)) or 1).tolist():  # once for each place in the item
                self.holders[h].append(k)
        self.short = sorted({len(w) for w in self.words if 0 < len(w) < seed})
        self.sizes = sorted({seed, *self.short})
        self.keys = np.sort(np.fromiter(self.holders, dtype=np.uint64, count=len(self.holders)))
        self.filter = np.zeros(1 << 16, dtype=bool)
        self.filter[self.keys >> np.uint64(48)] = True


def found_in(rows: int, words: np.ndarray, bounds: np.ndarray, seeds: Seeds, seed: int, coverage: float) -> list[tuple[int, int, float, int, int]]:
    """(row, item, coverage, tiles, longest tile) of the rows that hold an item."""
    got: dict[int, set[int]] = defaultdict(set)
    for size in seeds.sizes:
        h = window_hashes(words, size)
        near = np.flatnonzero(seeds.filter[h >> np.uint64(48)])
        if not len(near) or not len(seeds.keys):
            continue
        place = np.minimum(np.searchsorted(seeds.keys, h[near]), len(seeds.keys) - 1)
        near = near[seeds.keys[place] == h[near]]
        owner = np.searchsorted(bounds, near, side="right") - 1
        inside = near + size <= bounds[owner + 1]
        for i, r in zip(near[inside].tolist(), owner[inside].tolist(), strict=True):
            got[r].add(int(h[i]))
    out: list[tuple[int, int, float, int, int]] = []
    for r, hashes in sorted(got.items()):
        doc = words[bounds[r]:bounds[r + 1]]
        share: dict[int, int] = defaultdict(int)
        for h in hashes:
            for k in seeds.holders[h]:
                share[k] += 1
        for k, n in sorted(share.items()):
            item = seeds.words[k]
            least = min(seed, len(item))
            # the runs hold n seeds in all, and each run of r seeds has r + least - 1 words
            if n * least < coverage * len(item):
                continue
            runs = tiles(doc, item, least)
            marked = sum(x[2] for x in runs)
            if marked >= coverage * len(item):
                out.append((r, k, marked / len(item), len(runs), max(x[2] for x in runs)))
    return out


def _match(batches: Iterator[pa.RecordBatch], seeds: Seeds, seed: int, coverage: float, id_type: pa.DataType, item_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, offsets in slices(batch, "text"):
            out = found_in(len(rows), *word_hashes(data, offsets), seeds, seed, coverage)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(pa.array([x[0] for x in out], pa.int64())),
                 pa.array([seeds.ids[x[1]] for x in out], item_type),
                 pa.array([x[2] for x in out], pa.float64()), pa.array([x[3] for x in out], pa.int64()),
                 pa.array([x[4] for x in out], pa.int64())], ["doc_id", "item_id", "coverage", "n_tiles", "longest_tile"])


def _seed_blocks(benchmark: DataFrame, item_id_col: str, item_text_col: str, seed: int, block_words: int) -> Iterator[Seeds]:
    """The benchmark in blocks of about ``block_words`` words; items are dealt by hash and each block is read alone."""
    b = benchmark.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).alias("text")).where(F.col("text").isNotNull())
    n_words = b.agg(F.sum(F.size(F.split("text", r"[\x20\x09-\x0D]+")))).first()[0] or 0
    blocks = max(1, -(-n_words // block_words))
    for k in range(blocks):
        part = b if blocks == 1 else b.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        yield Seeds([(r[0], r[1]) for r in part.collect()], seed)


def contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                 item_id_col: str = "item_id", item_text_col: str = "text", seed: int = SEED_WORDS,
                 coverage: float = MIN_COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document and benchmark item that it holds: coverage, number of tiles, longest tile in words.

    Words are split at white space, A-Z lower-cased. The benchmark is a query
    set: it is broadcast in blocks of at most ``block_words`` words, each with
    one pass over all documents, so any benchmark size gives the same rows.

    Null or empty texts and items hold nothing and match nothing. An item of
    fewer words than a seed must occur whole. Null and repeated ids are
    reported as they are, repeated rows each. Empty tables: no rows. Only the
    named columns are read.
    """
    sc = docs.sparkSession.sparkContext
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kinds = d.schema["doc_id"].dataType, benchmark.schema[item_id_col].dataType
    id_type, item_type = map(to_arrow_type, kinds)
    out = None
    for block in _seed_blocks(benchmark, item_id_col, item_text_col, seed, block_words):
        seeds = sc.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], seeds=seeds) -> Iterator[pa.RecordBatch]:
            return _match(batches, seeds.value, seed, coverage, id_type, item_type)

        found = d.mapInArrow(run, f"doc_id {kinds[0].simpleString()}, item_id {kinds[1].simpleString()}, coverage double, n_tiles bigint, longest_tile bigint")
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
          seed: int = SEED_WORDS, coverage: float = MIN_COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns as they are: a pass for each block, no shuffle."""
    sc = docs.sparkSession.sparkContext
    for block in _seed_blocks(benchmark, item_id_col, item_text_col, seed, block_words):
        seeds = sc.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], seeds=seeds) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for rows, data, offsets in slices(batch, text_col):
                    kept = np.ones(len(rows), dtype=bool)
                    kept[[x[0] for x in found_in(len(rows), *word_hashes(data, offsets), seeds.value, seed, coverage)]] = False
                    yield rows.filter(pa.array(kept))
            handed_back()

        docs = docs.mapInArrow(run, docs.schema)
    return docs
