"""A hidden Markov language model over words.

Latent states emit symbols: the most frequent words each have their own, the
other words share classes by their ending and length, and a class emits its
words in proportion to their corpus counts plus one, with one share for words
that the corpus doesn't hold. Baum-Welch counts are summed over all training
documents; a scaled forward recursion gives every text's exact probability.

Corpus counts grow with the corpus, so no task ever holds them all. Documents
are dealt to blocks of bounded size. Each block sends its different words, in
ranges of their hashes, to the tasks that add them up, and gets back the totals
of its own words only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.staging import dropped, written
from tablesmith.llm.textarrays import mix, slices, span_hashes, word_spans

STATES = 8
#: Words with a symbol of their own; all others are emitted through their class.
TOP_WORDS = 4096
CLASSES = 512
#: Baum-Welch rounds, each over all training documents.
ROUNDS = 3
BLOCK_BYTES = 4 << 20
#: Text whose rows step through a round together: a step costs about the same for many rows as for few.
ROUND_BYTES = 6 << 20
#: Word entries that one task adds up, about.
RANGE_ENTRIES = 1 << 20
_ENTRY = np.dtype([("hash", "<u8"), ("class", "<u2"), ("count", "<u4")])
END = np.uint64(0x51ED270B03A7F1C5)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash and class of each token, bounds of each row's tokens); every row ends with the end token (class ``CLASSES``)."""
    b, starts, ends, rows = word_spans(data, offsets)
    hashes = span_hashes(b, starts, ends)
    last = b[ends - 1].astype(np.uint64)
    size = ends - starts
    previous = np.where(size > 1, b[np.maximum(ends - 2, 0)], 0).astype(np.uint64)
    kind = mix(last | (previous << np.uint64(8)) | (np.minimum(size, 7).astype(np.uint64) << np.uint64(16))) % np.uint64(CLASSES)
    n = len(offsets) - 1
    bounds = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n) + 1)])
    out, kinds = np.full(int(bounds[-1]), END, dtype=np.uint64), np.full(int(bounds[-1]), CLASSES, dtype=np.int64)
    at = np.arange(len(rows)) + rows
    out[at], kinds[at] = hashes, kind.astype(np.int64)
    return out, kinds, bounds


def _blocked(docs: DataFrame, text_col: str, id_col: str, parts: int, held: int, block_bytes: int) -> tuple[DataFrame, int]:
    """(block, doc_id, held, learn, text): blocks of about ``block_bytes`` by a hash of id and text."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(parts))
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = d.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    return d.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).alias("block"), "doc_id",
                    F.coalesce(fold == held, F.lit(False)).alias("held"), F.coalesce(fold != held, F.lit(False)).alias("learn"), "text"), int(size)


@dataclass
class Counts:
    """Corpus totals of bounded size; the table ``blocks`` has each block's own words' counts."""

    n: int
    v: int
    top: np.ndarray  # hashes of the most frequent words, ascending
    top_counts: np.ndarray
    class_tokens: np.ndarray  # training tokens and different words of each class, without the top words
    class_words: np.ndarray
    ends: int
    blocks: DataFrame


def _distinct(hashes: np.ndarray, kinds: np.ndarray, learn: np.ndarray) -> np.ndarray:
    """A block's different tokens by hash, with their training counts."""
    keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    out = np.empty(len(keys), dtype=_ENTRY)
    out["hash"], out["class"], out["count"] = keys, kinds[first], np.bincount(inverse, learn, minlength=len(keys))
    return out


def _table_tokens(table: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``tokens`` of all rows of a group, slice by slice."""
    found, base = [], 0
    for batch in table.combine_chunks().to_batches():
        for _, data, offsets in slices(batch, column):
            h, k, bounds = tokens(data, offsets)
            found.append((h, k, np.diff(bounds)))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(1, np.int64)
    return (np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found]),
            np.concatenate([[base], np.cumsum(np.concatenate([x[2] for x in found]))]))


def count_words(blocked: DataFrame, size: int, top_words: int = TOP_WORDS, range_entries: int = RANGE_ENTRIES) -> Counts:
    """Totals over all training rows, and for every block the totals of its own words."""
    ranges = max(1, min(1 << 24, size // 40 // range_entries))  # a block has a new word in some 40 bytes
    bits = max(0, (ranges - 1).bit_length())
    shift = 64 - bits

    def by_range(hashes: np.ndarray) -> np.ndarray:
        return np.zeros(len(hashes), np.int64) if not bits else (hashes >> np.uint64(shift)).astype(np.int64)

    def split(table: pa.Table) -> pa.Table:
        h, k, bounds = _table_tokens(table, "text")
        learn = np.repeat(table.column("learn").to_numpy().astype(np.int64), np.diff(bounds))
        entries = _distinct(h, k, learn)
        r = by_range(entries["hash"])
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(r)) + 1, [len(r)]])
        pairs = [(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a]
        block = table.column("block")[0].as_py()
        return pa.table({"block": pa.array([block] * len(pairs), pa.int64()), "range": pa.array([int(r[a]) for a, _ in pairs], pa.int64()),
                         "entries": pa.array([entries[a:b].tobytes() for a, b in pairs], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        blobs = [np.frombuffer(x, dtype=_ENTRY) for x in table.column("entries").to_pylist()]
        every = np.concatenate(blobs)
        keys, first, inverse = np.unique(every["hash"], return_index=True, return_inverse=True)
        total = np.bincount(inverse, every["count"], minlength=len(keys)).astype(np.int64)
        cuts = np.concatenate([[0], np.cumsum([len(b) for b in blobs])])
        kinds = every["class"][first]
        word = kinds < CLASSES
        most = np.lexsort((keys, -total))
        most = most[(total[most] > 0) & word[most]][:top_words]
        known = word & (total > 0)
        stats = {"top_hash": keys[most].view(np.int64).tolist(), "top_count": total[most].tolist(), "top_class": kinds[most].astype(int).tolist(),
                 "class_tokens": np.bincount(kinds[word], total[word], minlength=CLASSES).astype(int).tolist(),
                 "class_words": np.bincount(kinds[known], minlength=CLASSES).tolist(),
                 "n": int(total.sum()), "v": int((total > 0).sum()), "ends": int(total[~word].sum())}
        range_id = table.column("range")[0].as_py()
        rows = [{"block": b, "range": range_id, "totals": total[inverse[x:y]].astype("<u8").tobytes()}
                for b, x, y in zip(table.column("block").to_pylist(), cuts[:-1], cuts[1:], strict=True)]
        return pa.Table.from_pylist([*rows, {"block": -1, "range": range_id, "stats": stats}], schema=_TOTALS)

    spread = blocked.groupBy("block").applyInArrow(split, "block bigint, range bigint, entries binary")
    totals = written(spread.groupBy("range").applyInArrow(
        add, "block bigint, range bigint, totals binary, stats struct<top_hash:array<bigint>,top_count:array<bigint>,top_class:array<bigint>,"
             "class_tokens:array<bigint>,class_words:array<bigint>,n:bigint,v:bigint,ends:bigint>"), "word-totals")
    stats = totals.where("block = -1").select("stats.*")
    sums = stats.agg(F.sum("n"), F.sum("v"), F.sum("ends")).first()
    top = (stats.select(F.explode(F.arrays_zip("top_hash", "top_count", "top_class")).alias("t")).select("t.*")
           .orderBy(F.desc("top_count"), "top_hash").limit(top_words).collect())
    per_class = {name: np.zeros(CLASSES, dtype=np.int64) for name in ("class_tokens", "class_words")}
    for name, values in per_class.items():
        for r in stats.select(F.posexplode(name).alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect():
            values[r["i"]] = r["x"]
    for r in top:
        per_class["class_tokens"][r["top_class"]] -= r["top_count"]
        per_class["class_words"][r["top_class"]] -= 1
    hashes = np.array([r["top_hash"] for r in top], dtype=np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return Counts(int(sums[0] or 0), int(sums[1] or 0), hashes[order], np.array([r["top_count"] for r in top], dtype=np.int64)[order],
                  per_class["class_tokens"], per_class["class_words"], int(sums[2] or 0), totals.where("block >= 0").select("block", "range", "totals"))


_TOTALS = pa.schema([("block", pa.int64()), ("range", pa.int64()), ("totals", pa.binary()), ("stats", pa.struct(
    [("top_hash", pa.list_(pa.int64())), ("top_count", pa.list_(pa.int64())), ("top_class", pa.list_(pa.int64())), ("class_tokens", pa.list_(pa.int64())),
     ("class_words", pa.list_(pa.int64())), ("n", pa.int64()), ("v", pa.int64()), ("ends", pa.int64())]))])


@dataclass
class Model:
    """Start, transition (state x state) and emission (symbol x state) probabilities; symbols are top words, classes, end."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray
    top: np.ndarray

    def symbols(self, hashes: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        out = len(self.top) + kinds
        if len(self.top):
            place = np.minimum(np.searchsorted(self.top, hashes), len(self.top) - 1)
            hit = (self.top[place] == hashes) & (kinds < CLASSES)
            out[hit] = place[hit]
        return out


def forward(model: Model, symbols: np.ndarray, bounds: np.ndarray, keep: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(natural log-likelihood of each row, rows longest first, scaled states and scales of every token if ``keep``).

    All rows step together; the longest come first, so that the rows still
    running are always a prefix.
    """
    size = np.diff(bounds)
    order = np.argsort(-size, kind="stable")
    begin, size = bounds[:-1][order], size[order]
    out = np.zeros(len(size))
    states = np.zeros((len(symbols), len(model.start))) if keep else np.zeros((0, 0))
    scales = np.zeros(len(symbols)) if keep else np.zeros(0)
    alpha = np.broadcast_to(model.start, (len(size), len(model.start)))
    live = np.searchsorted(-size, -np.arange(1, (int(size[0]) if len(size) else 0) + 1), side="right")
    for t, n in enumerate(live.tolist()):
        at = begin[:n] + t
        alpha = (alpha[:n] @ model.move if t else alpha[:n]) * model.emit[symbols[at]]
        total = alpha.sum(axis=1)
        alpha = alpha / total[:, None]
        out[:n] += np.log(total)
        if keep:
            states[at], scales[at] = alpha, total
    likelihood = np.empty(len(size))
    likelihood[order] = out
    return likelihood, order, states, scales


def expected(model: Model, symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Baum-Welch counts of some rows, flat: starts, moves, emissions."""
    k = len(model.start)
    _, order, alpha, scales = forward(model, symbols, bounds, keep=True)
    begin, size = bounds[:-1][order], np.diff(bounds)[order]
    gamma = np.zeros_like(alpha)
    moves = np.zeros((k, k))
    beta = np.zeros((len(size), k))
    top = int(size[0]) if len(size) else 0
    live = np.searchsorted(-size, -np.arange(1, top + 2), side="right")  # live[t]: rows with more than t tokens
    for t in range(top - 1, -1, -1):
        n, further = int(live[t]), int(live[t + 1])
        at = begin[:n] + t
        if further:
            ahead = model.emit[symbols[at[:further] + 1]] * beta[:further] / scales[at[:further] + 1][:, None]
            moves += alpha[at[:further]].T @ ahead
            beta[:further] = ahead @ model.move.T
        beta[further:n] = 1.0
        gamma[at] = alpha[at] * beta[:n]
    starts = gamma[bounds[:-1]].sum(axis=0)
    emissions = np.stack([np.bincount(symbols, gamma[:, j], minlength=len(model.emit)) for j in range(k)], axis=1)
    return np.concatenate([starts, (moves * model.move).ravel(), emissions.ravel()])


def _updated(model: Model, counts: np.ndarray, background: np.ndarray) -> Model:
    """Maximisation, with a little of the background mixed in so that nothing gets probability 0."""
    k = len(model.start)
    start, move, emit = counts[:k] + 0.1, counts[k:k + k * k].reshape(k, k) + 0.1, counts[k + k * k:].reshape(model.emit.shape)
    emit = emit + background[:, None] * (1.0 + 0.02 * emit.sum(axis=0))
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0), model.top)


def _coded(learn: DataFrame, model: Model) -> DataFrame:
    """(symbols, sizes): the texts' symbols, 16 bits each, and their lengths, a row for a slice of texts; written once for all rounds."""
    given = learn.sparkSession.sparkContext.broadcast(model)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in slices(batch, "text", ROUND_BYTES):
                h, k, bounds = tokens(data, offsets)
                yield pa.RecordBatch.from_arrays([pa.array([given.value.symbols(h, k).astype("<u2").tobytes()]), pa.array([np.diff(bounds).astype("<i8").tobytes()])],
                                                 ["symbols", "sizes"])

    return written(learn.mapInArrow(code, "symbols binary, sizes binary"), "hmm-symbols")


def train(blocked: DataFrame, counts: Counts, states: int = STATES, rounds: int = ROUNDS, seed: int = 5) -> Model:
    """``rounds`` Baum-Welch rounds, each over all training documents."""
    rng = np.random.default_rng(seed)
    background = np.concatenate([counts.top_counts, counts.class_tokens, [counts.ends]]) + 1.0
    background /= background.sum()
    emit = background[:, None] * np.exp(0.5 * rng.normal(size=(len(background), states)))
    move = rng.dirichlet(np.full(states, 4.0), states)
    model = Model(np.full(states, 1 / states), move, emit / emit.sum(axis=0), counts.top)
    learn = blocked.where("learn").select("text")
    if not counts.ends:
        return model
    sc = blocked.sparkSession.sparkContext
    coded = _coded(learn, model)
    for _ in range(rounds):
        now = sc.broadcast(model)

        def count(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            m, sums = now.value, 0.0
            for batch in batches:
                for symbols, sizes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    bounds = np.concatenate([[0], np.cumsum(np.frombuffer(sizes, dtype="<i8"))])
                    sums = sums + expected(m, np.frombuffer(symbols, dtype="<u2").astype(np.int64), bounds)
            if isinstance(sums, np.ndarray):
                used = np.flatnonzero(sums)
                yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(sums[used])], ["i", "x"])

        got = coded.mapInArrow(count, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).toPandas()
        flat = np.zeros(states + states * states + emit.size)
        flat[got["i"].to_numpy()] = got["x"].to_numpy()
        model = _updated(model, flat, background)
    dropped(coded)
    return model


def score_texts(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", parts: int = 7, held: int = 2, states: int = STATES,
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: counts, the add-one unigram score and the model's score, both log10.

    Learns from rows whose crc32(id as text) mod ``parts`` isn't ``held``; a
    null id is neither learned from nor held out. A null or empty text is the
    end token alone. Repeated rows count and score each. Without training rows
    all words are unknown. A text of any length is read whole; an empty table
    gives no rows. Only the two named columns are read.
    """
    blocked, size = _blocked(docs, text_col, id_col, parts, held, block_bytes)
    counts = count_words(blocked, size)
    model = train(blocked, counts, states)
    sc = docs.sparkSession.sparkContext
    n_all, v_all = counts.n, counts.v
    given = sc.broadcast((model, np.log10(counts.class_tokens + counts.class_words + 1.0)))
    id_type = blocked.schema["doc_id"].dataType.simpleString()

    def finish(texts: pa.Table, totals: pa.Table) -> pa.Table:
        m, class_mass = given.value
        own = {r: np.frombuffer(t, dtype="<u8") for r, t in zip(totals.column("range").to_pylist(), totals.column("totals").to_pylist(), strict=True)}
        out = {name: [] for name in ("n_tokens", "n_known", "base", "score")}
        count = np.concatenate([own[r] for r in sorted(own)]) if own else np.zeros(0, np.uint64)
        if len(texts):
            h, k, bounds = _table_tokens(texts, "text")
            _, inverse = np.unique(h, return_inverse=True)
            c = count[inverse].astype(np.float64)
            row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            log_c = np.log10(c + 1.0)
            many = np.diff(bounds)
            symbols = m.symbols(h, k)
            through = (symbols >= len(m.top)) & (k < CLASSES)
            inside = np.where(through, log_c - class_mass[np.minimum(k, CLASSES - 1)], 0.0)
            likelihood = forward(m, symbols, bounds)[0]
            out["n_tokens"] = many
            out["n_known"] = np.bincount(row, c > 0, minlength=len(many)).astype(np.int64)
            out["base"] = np.bincount(row, log_c, minlength=len(many)) - many * math.log10(n_all + v_all + 1)
            out["score"] = likelihood / math.log(10) + np.bincount(row, inside, minlength=len(many))
        return pa.table({"doc_id": texts.column("doc_id"), "held_out": texts.column("held"),
                         "n_tokens": pa.array(out["n_tokens"], pa.int64()), "n_known": pa.array(out["n_known"], pa.int64()),
                         "train_tokens": pa.array([n_all] * len(texts), pa.int64()),
                         "base_score": pa.array(out["base"], pa.float64()), "score": pa.array(out["score"], pa.float64())})

    return (blocked.select("block", "doc_id", "held", "text").groupBy("block").cogroup(counts.blocks.groupBy("block"))
            .applyInArrow(finish, f"doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"))
