"""Periodic runs of words: where a text repeats itself, and the text without the repeats.

A run is a stretch of words that repeats with a period q at least twice and
that no neighbouring word carries on. Runs are found through the suffix trees
of a document's words and of their reversal (``suffixtree``).

A run of 12 words or more and two periods or more lies wholly in 6-word
windows that stand twice in the text: its first length - q >= 6 words stand
again q words later. So the trees are built over the stretches that such
windows cover, with a symbol of its own after each; a text without a repeated
window holds no run.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.suffixtree import maximal_runs

#: A run has at least this many words, and two periods.
MIN_WORDS = 12
#: Rows whose texts a task holds as words at once.
_ROWS = 64
_STEP = np.uint64(0x9E3779B97F4A7C15)

Rewrite = Callable[[object, list[bytes]], list[bytes]]


def made_periodic(doc_id: object, words: list[bytes]) -> list[bytes]:
    """The contract's planting: a tenth of the ids, by CRC-32 of the decimal id, repeat their words from some place on. A null id: unchanged."""
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a: a + p] * -(-(n - a) // p))[: n - a]


def _stretches(words: list[bytes], size: int) -> list[tuple[int, int]]:
    """Bounds of the maximal stretches covered by windows of ``size`` words that stand twice or more."""
    n = len(words) - size + 1
    if n < 2:
        return []
    h = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    w = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        w = w * _STEP + h[k: k + n]
    order = np.argsort(w)
    equal = w[order[1:]] == w[order[:-1]]
    if not equal.any():
        return []
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + size, -1)
    covered = np.concatenate([[False], np.cumsum(edges[:-1]) > 0, [False]])
    change = np.flatnonzero(covered[1:] != covered[:-1])
    return list(zip(change[::2].tolist(), change[1::2].tolist(), strict=True))


def runs_of(words: list[bytes], min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of at least ``min_words`` words, by start and period."""
    stretches = [s for s in _stretches(words, max(min_words // 2, 1)) if s[1] - s[0] >= min_words]
    if not stretches:
        return []
    ids: dict[bytes, int] = {}
    sequence, places = [], []
    for a, b in stretches:
        sequence += [ids.setdefault(w, len(ids) + 1) for w in words[a:b]]
        places.append(np.arange(a, b))
        sequence.append(0)
        places.append(np.array([-1]))
    top = len(ids) + 1
    for k, x in enumerate(sequence):
        if not x:
            sequence[k], top = top, top + 1
    found = maximal_runs(sequence)
    found = found[found[:, 1] >= np.maximum(min_words, 2 * found[:, 2])]
    found[:, 0] = np.concatenate(places)[found[:, 0]]
    return [tuple(r) for r in found.tolist()]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds beyond its first period."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    dropped = np.cumsum(edges) > 0
    return [w for w, d in zip(words, dropped.tolist(), strict=False) if not d]


def find_runs(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_words: int = MIN_WORDS,
              rewrite: Rewrite | None = None) -> DataFrame:
    """(doc_id, runs, collapsed): one row per input row.

    ``runs`` holds (start, length, period) in words, by start and period;
    ``collapsed`` is the text's words without the repeats, joined by one space.
    Words are split at ASCII blanks and compared as bytes. ``rewrite`` changes
    a row's words before the search.

    Each row is judged alone, so nothing is shuffled and a task's memory
    follows its longest text. Null, empty and blank texts: no runs, empty
    collapsed text. Null or repeated ids and repeated rows keep a row each. An
    empty table gives no rows. Only the two named columns are read.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_name = d.schema["doc_id"].dataType.simpleString()
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, _ROWS):
                part = batch.slice(lo, _ROWS)
                found, texts = [], []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.large_binary()).to_pylist(), strict=True):
                    words = (text or b"").split()
                    if rewrite is not None:
                        words = rewrite(doc_id, words)
                    runs = runs_of(words, min_words)
                    found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                    texts.append(b" ".join(collapsed(words, runs)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(found, pa.list_(run_type)), pa.array(texts, pa.binary()).cast(pa.string())],
                    ["doc_id", "runs", "collapsed"])

    return d.mapInArrow(search, f"doc_id {id_name}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns: number of runs, the longest run (ties: smallest start, then period), and digests of runs and collapsed text."""
    def text(r):
        return F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))

    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    d = found.withColumn("best", longest)
    length, period = F.col("best.length"), -F.col("best.period")
    return d.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), length.alias("length"),
        period.alias("period"), F.floor(F.expr("1000 * best.length div -best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", text), ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
