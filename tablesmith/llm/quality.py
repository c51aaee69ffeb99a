"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages and only the bag has a label. Every passage is
encoded from its surface (which kinds of bytes, how long and how varied its
words are); a gated attention network learns from the labels which passages
matter, and the attention-weighted mean of the encodings gives the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.textarrays import handed_back, mix, slices, span_hashes, word_spans

#: Passages have this many bytes, or a 64th of a longer document, which so has 64 passages at most.
PASSAGE_BYTES = 400
MAX_PASSAGES = 64
#: Labelled rows that the model is fitted on, about: a hash of the id picks them.
FIT_ROWS = 4000
THRESHOLD = 0.7
#: Text that ``keep`` scores and ``fit`` encodes at once: its arrays take some 40 bytes for each of its bytes.
KEEP_BYTES = 1 << 18
HIDDEN, GATE = 24, 12
_WORD_BINS = 32

#: A class for each byte: control and space characters, digits, each ASCII sign, lower and upper letters, other bytes.
_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[[9, 11, 12, 13, 32]] = 1
_CLASS[10] = 2
_CLASS[48:58] = 3
_CLASS[97:123] = 4
_CLASS[65:91] = 5
_CLASS[128:] = 6
_SIGNS = [c for c in range(33, 127) if not chr(c).isalnum()]
_CLASS[_SIGNS] = np.arange(7, 7 + len(_SIGNS))
_CLASSES = 7 + len(_SIGNS)
N_FEATURES = _CLASSES + 8 + _WORD_BINS


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features of each passage, bounds of each row's passages). An empty row has one passage of zeros."""
    n = np.diff(offsets)
    size = np.maximum(PASSAGE_BYTES, -(-n // MAX_PASSAGES))
    counts = np.maximum(1, -(-n // size))
    bounds = np.concatenate([[0], np.cumsum(counts)])
    total = int(bounds[-1])
    row = np.repeat(np.arange(len(n)), n)
    at = bounds[row] + (np.arange(len(data)) - offsets[row]) // size[row]
    classes = np.bincount(at * _CLASSES + _CLASS[data], minlength=total * _CLASSES).reshape(total, _CLASSES)
    length = np.maximum(1, classes.sum(axis=1))[:, None]
    raw, starts, ends, owner = word_spans(data, offsets, lower=False)
    hashes = span_hashes(raw, starts, ends)
    where = at[starts] if len(starts) else np.zeros(0, dtype=np.int64)
    words = np.bincount(where, minlength=total)
    some = np.maximum(1, words)
    spelled = np.bincount(where, ends - starts, minlength=total) / some
    square = np.bincount(where, (ends - starts) ** 2.0, minlength=total) / some

    def varied(groups: np.ndarray, many: int) -> np.ndarray:
        """Share of different words in each group."""
        key = mix(hashes ^ mix(groups.astype(np.uint64) + np.uint64(1)))
        _, first = np.unique(key, return_index=True)
        return np.bincount(groups[first], minlength=many) / np.maximum(1, np.bincount(groups, minlength=many))

    own, whole = varied(where, total), varied(owner, len(n))
    per_row = np.repeat(np.arange(len(n)), counts)
    words_in_row = np.bincount(owner, minlength=len(n))
    bins = np.bincount(where * _WORD_BINS + (hashes >> np.uint64(59)).astype(np.int64), minlength=total * _WORD_BINS).reshape(total, _WORD_BINS)
    features = np.concatenate([
        np.sqrt(classes / length),
        np.stack([np.log1p(words), spelled / 8, np.sqrt(np.maximum(0, square - spelled ** 2)) / 8, own,
                  whole[per_row], np.log1p(words_in_row)[per_row] / 4, (words_in_row < 5)[per_row], (words == 0)], axis=1),
        bins / some[:, None]], axis=1)
    return features.astype(np.float32), bounds


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    parts: dict[str, np.ndarray]
    prior: float


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def _forward(parts: dict[str, np.ndarray], x: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    h = np.tanh(x @ parts["enc"] + parts["enc0"])
    t, s = np.tanh(h @ parts["V"]), _sigmoid(h @ parts["U"])
    e = (t * s) @ parts["w"]
    per = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    top = np.maximum.reduceat(e, bounds[:-1])
    a = np.exp(e - top[per])
    a /= np.add.reduceat(a, bounds[:-1])[per]
    z = np.add.reduceat(a[:, None] * h, bounds[:-1], axis=0)
    return {"h": h, "t": t, "s": s, "a": a, "z": z, "per": per, "p": _sigmoid(z @ parts["c"] + parts["c0"][0])}


def _gradients(parts: dict[str, np.ndarray], x: np.ndarray, bounds: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    f = _forward(parts, x, bounds)
    d = (f["p"] - y) / len(y)
    dz = d[:, None] * parts["c"][None, :]
    dh = f["a"][:, None] * dz[f["per"]]
    da = (f["h"] * dz[f["per"]]).sum(axis=1)
    de = f["a"] * (da - np.add.reduceat(f["a"] * da, bounds[:-1])[f["per"]])
    dts = de[:, None] * parts["w"][None, :]
    dt, ds = dts * f["s"] * (1 - f["t"] ** 2), dts * f["t"] * f["s"] * (1 - f["s"])
    dh += dt @ parts["V"].T + ds @ parts["U"].T
    du = dh * (1 - f["h"] ** 2)
    return {"c": f["z"].T @ d, "c0": np.array([d.sum()]), "w": (f["t"] * f["s"]).T @ de, "V": f["h"].T @ dt, "U": f["h"].T @ ds,
            "enc": x.T @ du, "enc0": du.sum(axis=0)}


def train(bags: list[np.ndarray], y: np.ndarray, epochs: int = 40, batch: int = 128, rate: float = 0.004,
          decay: float = 1e-4, seed: int = 7) -> Model:
    """Adam over shuffled batches of bags. No bags: a model that scores everything 0.5."""
    rng = np.random.default_rng(seed)
    width = N_FEATURES
    parts = {"enc": rng.normal(0, width ** -0.5, (width, HIDDEN)), "enc0": np.zeros(HIDDEN),
             "V": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, GATE)), "U": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, GATE)),
             "w": np.zeros(GATE), "c": np.zeros(HIDDEN), "c0": np.zeros(1)}
    if not bags:
        return Model(np.zeros(width), np.ones(width), parts, 0.5)
    every = np.concatenate(bags)
    mean, scale = every.mean(axis=0), every.std(axis=0) + 0.05
    bags = [(b - mean) / scale for b in bags]
    parts["w"] = rng.normal(0, GATE ** -0.5, GATE)
    first = {k: np.zeros_like(v) for k, v in parts.items()}
    second = {k: np.zeros_like(v) for k, v in parts.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for lo in range(0, len(order), batch):
            pick = order[lo: lo + batch]
            bounds = np.concatenate([[0], np.cumsum([len(bags[i]) for i in pick])])
            g = _gradients(parts, np.concatenate([bags[i] for i in pick]), bounds, y[pick])
            step += 1
            now = rate * (1 - epoch / epochs)
            for k in parts:
                g[k] = g[k] + decay * parts[k]
                first[k] = 0.9 * first[k] + 0.1 * g[k]
                second[k] = 0.999 * second[k] + 0.001 * g[k] ** 2
                parts[k] = parts[k] - now * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return Model(mean, scale, parts, float(y.mean()))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", text_col: str = "text", id_col: str = "doc_id",
        fit_rows: int = FIT_ROWS) -> Model:
    """Fit on about ``fit_rows`` labelled documents (all, where there are fewer).

    Null labels and ids teach nothing; several labels of one document are
    averaged. The driver receives the passages' features of that sample, at
    most ``MAX_PASSAGES`` a document.
    """
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y")).where("id IS NOT NULL AND y IS NOT NULL")
             .groupBy("id").agg(F.avg("y").alias("y")))
    n = known.count()
    if not n:
        return train([], np.zeros(0))
    picked = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < min(1.0, fit_rows / n) * (1 << 20)).limit(2 * fit_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "id").select("y", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handed_back()  # what the stages of an earlier run kept
        for batch in batches:
            for rows, data, offsets in slices(batch, "text", KEEP_BYTES):
                x, bounds = passages(data, offsets)
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([x[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())], ["y", "x"])
        handed_back()

    got = texts.mapInArrow(encode, "y double, x binary").toArrow()
    bags = [np.frombuffer(x, dtype=np.float32).reshape(-1, N_FEATURES) for x in got.column("x").to_pylist()]
    y = got.column("y").to_numpy()
    order = sorted(range(len(bags)), key=lambda i: (y[i], bags[i].tobytes()))  # whatever order the tasks ended in
    return train([bags[i] for i in order], y[order])


def scores(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    x, bounds = passages(data, offsets)
    return _forward(model.parts, (x - model.mean) / model.scale, bounds)["p"]


def score(docs: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id and score (0 to 1) of every row.

    A null or empty text is one empty passage and is scored too. Null and
    repeated ids and rows keep a row each; a text of any length is read whole;
    an empty table gives no rows. Only the two named columns are read.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(scores(known.value, data, offsets))], ["doc_id", "score"])

    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, score double")


def keep(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that score ``threshold`` or more; one pass, no shuffle."""
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handed_back()
        for batch in batches:
            for rows, data, offsets in slices(batch, text_col, KEEP_BYTES):
                yield rows.filter(pa.array(scores(known.value, data, offsets) >= threshold))
        handed_back()

    return docs.mapInArrow(run, docs.schema)


def _fold(col: str, parts: int):
    return F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(parts))


def fit_training_fold(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
                      text_col: str = "text", parts: int = 4, held: int = 2) -> Model:
    """Learn only from labels of documents whose crc32(id as text) mod ``parts`` isn't ``held``."""
    return fit(docs, labels.where(_fold(id_col, parts) != held), label_col, text_col, id_col)


def report(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
           parts: int = 4, held: int = 2, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; a null id is neither learned from nor held out."""
    model = fit_training_fold(docs, labels, label_col, id_col, text_col, parts, held)
    return score(docs, model, text_col, id_col).select(
        "doc_id", F.coalesce(_fold("doc_id", parts) == held, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
