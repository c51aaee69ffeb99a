"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of one fixed public
vocabulary. A word's probability is the sum, over all ways to cut it into
pieces, of the product of the pieces' probabilities; a forward pass over the
word's bytes gives that sum. The probabilities are trained by expectation
maximisation with the matching backward pass.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.staging import written
from tablesmith.llm.textarrays import hashes_between, prefix_sums, slices, span_hashes, word_spans

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: A longer run of letters is cut, between characters, into words of about this many bytes.
WORD_BYTES = 64
#: Rows of each language that the probabilities are learned from, about: a hash of the id picks them.
FIT_ROWS = 500
ROUNDS = 3
SMOOTHING = 0.05
UNDETERMINED = "und"
#: Each byte's weight is scaled by this, so that products over a word stay within a double.
_SCALE = 2.0 ** 10
_CELLS = 1 << 18


_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
#: Words are runs of letters: of ASCII letters and of all bytes above.
_NO_LETTER = ~_ASCII_LETTER & (np.arange(256) < 128)


class Pieces:
    """The vocabulary's pieces that can stand in a word, found by hash; the byte pieces among them spell everything."""

    def __init__(self, ranks: bytes):
        tokens = {base64.b64decode(line.split()[0]) for line in ranks.splitlines() if line.strip()}
        tokens |= {bytes([b]) for b in range(256)}
        kept = sorted(t for t in tokens if not any(c in b" \t\n\x0b\x0c\r" for c in t[1:]))
        ends = np.cumsum([len(t) for t in kept])
        keys = span_hashes(np.frombuffer(b"".join(kept), dtype=np.uint8), ends - [len(t) for t in kept], ends)
        order = np.argsort(keys)
        self.keys, self.ids, self.count = keys[order], order.astype(np.int32), len(kept)
        self.longest = max(map(len, kept))
        self.filter = np.zeros(1 << 20, dtype=bool)
        self.filter[self.keys >> np.uint64(44)] = True

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece of each hash; ``count`` (a piece of probability 0) where there is none."""
        out = np.full(len(hashes), self.count, dtype=np.int32)
        near = np.flatnonzero(self.filter[hashes >> np.uint64(44)])
        place = np.minimum(np.searchsorted(self.keys, hashes[near]), len(self.keys) - 1)
        hit = self.keys[place] == hashes[near]
        out[near[hit]] = self.ids[place[hit]]
        return out


@dataclass
class Words:
    """Different words, longest first, each a blank and its bytes: ``size[i]`` bytes, ``pieces[k - 1][i, a]`` the piece at a of k bytes."""

    size: np.ndarray
    pieces: list[np.ndarray]
    none: int


def lattice(b: np.ndarray, starts: np.ndarray, ends: np.ndarray, pieces: Pieces) -> Words:
    """The pieces at every place of the words b[starts:ends], which come longest first."""
    size = ends - starts + 1
    top = int(size[0]) if len(size) else 0
    grid = np.zeros((len(size), top), dtype=np.uint8)
    inside = np.arange(top) < size[:, None]
    grid[:, 0] = 32
    rest = inside.copy()
    rest[:, 0] = False
    where = np.repeat(starts - np.concatenate([[0], np.cumsum(size - 1)[:-1]]), size - 1) + np.arange(int((size - 1).sum()))
    grid[rest] = b[where]
    flat = grid.ravel()
    at = np.flatnonzero(inside.ravel())
    row_end = (at // max(top, 1)) * top + size[at // max(top, 1)]
    found, sums = [], prefix_sums(flat)
    for k in range(1, min(pieces.longest, top) + 1):
        table = np.full(flat.shape, pieces.count, dtype=np.int32)
        ok = at[at + k <= row_end]
        if len(ok):
            table[ok] = pieces.find(hashes_between(sums, ok, ok + k))
        found.append(table.reshape(grid.shape))
    return Words(size, found, pieces.count)


def forward(words: Words, weights: np.ndarray) -> np.ndarray:
    """alpha[i, a, l]: scaled sum over all segmentations of the first a bytes of word i; weights[piece, l], a last row of zeros."""
    n, top = words.pieces[0].shape if len(words.size) else (0, 0)
    alpha = np.zeros((n, top + 1, weights.shape[1]))
    if n:
        alpha[:, 0] = 1.0
    for a in range(1, top + 1):
        live = int(np.searchsorted(-words.size, -a, side="right"))
        for k in range(1, min(a, len(words.pieces)) + 1):
            alpha[:live, a] += alpha[:live, a - k] * (weights[words.pieces[k - 1][:live, a - k]] * _SCALE ** k)
    return alpha


def log_likelihoods(words: Words, weights: np.ndarray) -> np.ndarray:
    """Natural log of each word's probability in each language."""
    if not len(words.size):
        return np.zeros((0, weights.shape[1]))
    total = forward(words, weights)[np.arange(len(words.size)), words.size]
    return np.log(total) - (words.size * np.log(_SCALE))[:, None]


def expected_counts(words: Words, weights: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations of ``count[i]`` copies of word i; weights of one language."""
    out = np.zeros(words.none + 1)
    if not len(words.size):
        return out[:-1]
    alpha = forward(words, weights[:, None])[:, :, 0]
    n, top = words.pieces[0].shape
    beta = np.zeros((n, top + 1 + len(words.pieces)))
    rows = np.arange(n)
    beta[rows, words.size] = 1.0
    total = alpha[rows, words.size]
    for a in range(top - 1, -1, -1):
        live = int(np.searchsorted(-words.size, -(a + 1), side="right"))
        for k in range(1, min(len(words.pieces), top - a) + 1):
            piece = words.pieces[k - 1][:live, a]
            step = weights[piece] * _SCALE ** k * beta[:live, a + k]
            beta[:live, a] += step
            out += np.bincount(piece, alpha[:live, a] * step / total[:live] * count[:live], minlength=len(out))
    return out[:-1]


def _cut(b: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words longer than ``WORD_BYTES`` in parts, cut where a character begins."""
    parts = np.maximum(1, -(-(ends - starts) // WORD_BYTES))
    if not len(parts) or parts.max() == 1:
        return starts, ends, rows
    first = np.repeat(np.concatenate([[0], np.cumsum(parts)[:-1]]), parts)
    nth = np.arange(int(parts.sum())) - first
    begin = np.repeat(starts, parts) + nth * WORD_BYTES
    for _ in range(3):
        begin -= (nth > 0) & (b[begin] & 0xC0 == 0x80)
    after = np.append(begin[1:], 0)
    return begin, np.where(nth + 1 < np.repeat(parts, parts), after, np.repeat(ends, parts)), np.repeat(rows, parts)


def _has_letter(rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, text_at: int) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])
    out = sums[offsets[1:]] > sums[offsets[:-1]]
    for i in np.flatnonzero(~out & (offsets[1:] > offsets[:-1])):
        out[i] = any(c.isalpha() for c in rows.column(text_at)[int(i)].as_py())
    return out


_pieces: dict[int, Pieces] = {}


def _loaded(ranks: bytes) -> Pieces:
    key = hash(ranks)
    if key not in _pieces:
        _pieces[key] = Pieces(ranks)
    return _pieces[key]


def _blocks(size: np.ndarray) -> Iterator[slice]:
    """Runs of words, longest first, whose lattices have about ``_CELLS`` places."""
    i = 0
    while i < len(size):
        j = min(len(size), i + max(1, _CELLS // (int(size[i]) + 1)))
        yield slice(i, j)
        i = j


class Scorer:
    """Log-likelihoods of words in each language; what was computed lately is kept by hash."""

    def __init__(self, pieces: Pieces, weights: np.ndarray, memory: int = 400_000):
        self.pieces, self.weights, self.memory = pieces, weights, memory
        self.hashes, self.scores = np.zeros(0, dtype=np.uint64), np.zeros((0, weights.shape[1]))

    def __call__(self, b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        hashes, first, inverse = np.unique(span_hashes(b, starts, ends), return_index=True, return_inverse=True)
        out = np.empty((len(hashes), self.weights.shape[1]))
        place = np.minimum(np.searchsorted(self.hashes, hashes), max(0, len(self.hashes) - 1))
        known = self.hashes[place] == hashes if len(self.hashes) else np.zeros(len(hashes), dtype=bool)
        out[known] = self.scores[place[known]]
        new = np.flatnonzero(~known)
        order = new[np.argsort(starts[first[new]] - ends[first[new]], kind="stable")]
        begin, end = starts[first[order]], ends[first[order]]
        for part in _blocks(end - begin):
            out[order[part]] = log_likelihoods(lattice(b, begin[part], end[part], self.pieces), self.weights)
        if len(self.hashes) + len(new) > self.memory:
            self.hashes, self.scores = hashes, out
        elif len(new):
            both = np.concatenate([self.hashes, hashes[new]])
            by = np.argsort(both)
            self.hashes, self.scores = both[by], np.concatenate([self.scores, out[new]])[by]
        return out[inverse]


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # piece (and a last row of zeros) x language


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        fit_rows: int = FIT_ROWS, rounds: int = ROUNDS, vocabulary: str | None = None) -> Model:
    """Train on about ``fit_rows`` rows of each language (all rows where there are fewer), picked by a hash of the id.

    Rows with a null text or language teach nothing. The word counts of each
    language stay distributed; a round sends expected piece counts, at most
    pieces x languages numbers, to the driver.
    """
    spark = docs.sparkSession
    with open(vocabulary or public_tokenizers.path(VOCABULARY), "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())
    pieces = _loaded(ranks.value)
    d = docs.select(F.col(id_col).cast("string").alias("id"), F.col(lang_col).cast("string").alias("lang"),
                    F.col(text_col).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in d.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((pieces.count + 1, 0)))
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, fit_rows / sizes[k]))])
    picked = d.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.element_at(share, F.col("lang")) * float(1 << 20))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch, "text"):
                b, starts, ends, owner = word_spans(data, offsets, separators=_NO_LETTER)
                starts, ends, owner = _cut(b, starts, ends, owner)
                raw = b.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).take(pa.array(owner)), pa.array([raw[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)], pa.binary())],
                    ["lang", "word"])

    counted = written(picked.select("lang", "text").mapInArrow(words, "lang string, word binary")
                      .groupBy("lang", "word").agg(F.count("*").alias("n")), "language-words")
    weights = np.full((pieces.count + 1, len(languages)), 1.0 / pieces.count)
    weights[-1] = 0.0
    for _ in range(rounds):
        now = spark.sparkContext.broadcast(weights)

        def expect(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            table = _loaded(ranks.value)
            sums: dict[str, np.ndarray] = {}
            for batch in batches:
                langs, words_, n = (batch.column(k) for k in range(3))
                langs = np.array(langs.to_pylist(), dtype=object)
                for lang in set(langs.tolist()):
                    pick = np.flatnonzero(langs == lang)
                    w = [words_[int(i)].as_py() for i in pick]
                    order = sorted(range(len(w)), key=lambda i: -len(w[i]))
                    size = np.array([len(w[i]) for i in order])
                    ends, text = np.cumsum(size), np.frombuffer(b"".join(w[i] for i in order), dtype=np.uint8)
                    many = n.to_numpy()[pick][order].astype(float)
                    for part in _blocks(size):
                        grid = lattice(text, (ends - size)[part], ends[part], table)
                        sums[lang] = sums.get(lang, 0.0) + expected_counts(grid, now.value[:, languages.index(lang)], many[part])
            for lang, s in sums.items():
                used = np.flatnonzero(s)
                yield pa.RecordBatch.from_arrays([pa.array([languages.index(lang)] * len(used), pa.int32()), pa.array(used.astype(np.int32)), pa.array(s[used])], ["l", "p", "n"])

        rows = counted.mapInArrow(expect, "l int, p int, n double").groupBy("l", "p").agg(F.sum("n").alias("n")).toPandas()
        weights = np.full(weights.shape, SMOOTHING)
        np.add.at(weights, (rows["p"].to_numpy(), rows["l"].to_numpy()), rows["n"].to_numpy())
        weights[-1] = 0.0
        weights /= weights.sum(axis=0)
    return Model(languages, weights)


def identify(docs: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id", vocabulary: str | None = None) -> DataFrame:
    """doc_id, lang_pred and score (the likeliest language's posterior under equal priors) of every row.

    ``und`` with score 0: a null text, one without a letter, or a model without
    languages. Ties go to the first language in order. Null and repeated ids
    and rows keep a row each; a text of any length is read whole; an empty
    table gives no rows. Only the two named columns are read.
    """
    sc = docs.sparkSession.sparkContext
    with open(vocabulary or public_tokenizers.path(VOCABULARY), "rb") as f:
        ranks = sc.broadcast(f.read())
    known = sc.broadcast(model)
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = known.value
        scorer = Scorer(_loaded(ranks.value), m.weights)
        names = np.array([*m.languages, UNDETERMINED], dtype=object)
        for batch in batches:
            for rows, data, offsets in slices(batch, "text", 4 << 20):
                pred, score = np.full(len(rows), len(m.languages)), np.zeros(len(rows))
                letters = _has_letter(rows, data, offsets, 1)
                if m.languages and letters.any():
                    b, starts, ends, owner = word_spans(data, offsets, separators=_NO_LETTER)
                    starts, ends, owner = _cut(b, starts, ends, owner)
                    each = scorer(b, starts, ends)
                    total = np.stack([np.bincount(owner, each[:, k], minlength=len(rows)) for k in range(len(m.languages))], axis=1)
                    best = total.argmax(axis=1)
                    post = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                    pred, score = np.where(letters, best, pred), np.where(letters, post, 0.0)
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(names[pred], pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def report(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", parts: int = 5) -> DataFrame:
    """Learn from rows whose crc32(id as text) mod ``parts`` isn't 0, predict all; a null id is neither learned from nor held out."""
    fold = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(parts))
    model = fit(docs.where(fold != 0), text_col, lang_col, id_col)
    found = identify(docs, model, text_col, id_col)
    mine = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(parts))
    return found.select("doc_id", F.coalesce(mine == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
