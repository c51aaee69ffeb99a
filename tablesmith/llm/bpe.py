"""Byte-level BPE by backtracking, and decoding by an offset table.

A pre-token is covered from the left by the longest vocabulary token that
starts at each place; a token is only accepted next to its left neighbour if
merging the two neighbours' bytes alone would give exactly these two tokens.
Where none fits, the encoder steps back and tries a shorter token. Every place
is given up at most once, so the work is linear in the pre-token, and the
result is the one that applying the merges in order of rank gives.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.textarrays import caches

VOCABULARY = "byte_bpe_50k.json"
#: Words whose ids a worker remembers; a full memory is emptied, nothing else changes.
MEMORY = 400_000
_BLANK = regex.compile(r"\s")


def _char_bytes() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in set(plain)):
        table[chr(256 + k)] = b
    return table


class Vocabulary:
    """Tokens, merges and special tokens of one tokenizer file.

    ``spec`` is the file's text: the driver reads it once and broadcasts it, so
    executors need no such file.
    """

    def __init__(self, spec: str, memory: int = MEMORY):
        read = json.loads(spec)
        chars = _char_bytes()
        model = read["model"]
        self.ids = {bytes(chars[c] for c in token): i for token, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in read.get("added_tokens", [])}
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

        top = max([*self.ids.values(), *self.special.values()], default=-1) + 1
        spelled: list[bytes] = [b""] * top
        for token, i in self.ids.items():
            spelled[i] = token
        for token, i in self.special.items():
            spelled[i] = token.encode()
        #: Decoding: token i is bytes[starts[i]:starts[i + 1]].
        self.bytes = b"".join(spelled)
        self.starts = np.concatenate([[0], np.cumsum([len(t) for t in spelled])]).astype(np.int64)
        self.spelled = spelled

        # how each token came to be: rank of its merge (-1 for single bytes) and its two parts
        self.rank = [-1] * top
        self.parts: list[tuple[int, int]] = [(-1, -1)] * top
        self.merge_rank: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            left, right = bytes(chars[c] for c in left), bytes(chars[c] for c in right)
            both = self.ids[left + right]
            self.merge_rank[self.ids[left], self.ids[right]] = rank
            if self.rank[both] < 0:
                self.rank[both], self.parts[both] = rank, (self.ids[left], self.ids[right])

        # read backwards, the automaton reports at each place all tokens that start there, the longest first
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        for token, i in self.ids.items():
            self.automaton.add_word(token[::-1].decode("latin-1"), i)
        self.automaton.make_automaton()
        self.fits: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}
        #: By word; False where the word holds further white space.
        self.units: dict[str, tuple[int, ...] | bool] = {}
        self.memory = memory

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges, applied to both tokens' bytes joined, leave exactly these two tokens.

        The joined bytes differ from the tokens alone only where some part that
        ends ``left`` and some part that begins ``right`` exist at the same time
        and merge before either is used up. Undoing the later of the two merges
        again and again visits every such pair of parts. Equal ranks merge from
        the left.
        """
        rank, parts = self.rank, self.parts
        left_end = right_end = len(self.merge_rank)
        while True:
            r = self.merge_rank.get((left, right))
            if r is not None and r < left_end and r <= right_end:
                return False
            if rank[left] < 0 and rank[right] < 0:
                return True
            if rank[left] > rank[right]:
                left_end, left = rank[left], parts[left][1]
            else:
                right_end, right = rank[right], parts[right][0]

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one pre-token."""
        whole = len(piece)
        begins: list[list[int]] = [[] for _ in range(whole)]
        for end, token in self.automaton.iter(piece[::-1].decode("latin-1")):
            begins[whole - 1 - end].append(token)
        spelled, fits = self.spelled, self.fits
        reachable = bytearray([1]) * (whole + 1)
        out: list[int] = []
        tried = [0]  # for each accepted token and the next place: how many of its candidates are spent
        at = 0
        while at < whole:
            options, k = begins[at], tried[-1]
            left = out[-1] if out else -1
            token = -1
            while k < len(options):
                option = options[k]
                k += 1
                if not reachable[at + len(spelled[option])]:
                    continue
                if left >= 0:
                    ok = fits.get((left, option))
                    if ok is None:
                        if len(fits) >= 1 << 20:
                            fits.clear()
                        ok = fits[left, option] = self.compatible(left, option)
                    if not ok:
                        continue
                token = option
                break
            if token >= 0:
                tried[-1] = k
                out.append(token)
                at += len(spelled[token])
                tried.append(0)
            else:  # no token starts here next to this neighbour: never come back to this place
                reachable[at] = 0
                tried.pop()
                at -= len(spelled[out.pop()])
        return tuple(out)

    def _plain(self, text: str) -> list[tuple[int, ...]]:
        known = self.pieces
        out = []
        for piece in self.pattern.findall(text):
            ids = known.get(piece)
            if ids is None:
                if len(known) >= self.memory:
                    known.clear()
                ids = known[piece] = self.encode_piece(piece.encode())
            out.append(ids)
        return out

    def _units(self, text: str) -> list[tuple[int, ...]]:
        """As ``_plain``, faster: single blanks and line ends between words can't be inside a pre-token's joint.

        A unit is a word with the one blank or line end before it. Where
        separators stand next to each other or at an end, or others than these
        two occur, the whole text goes the plain way.
        """
        first, *units = text.replace("\n", " \n").split(" ")
        known = self.units
        out = list(map(known.get, units))
        if None in out:
            for k, ids in enumerate(out):
                if ids is None:
                    ids = known.get(units[k])
                    out[k] = self._unit(units[k]) if ids is None else ids
        if False in out or not first or _BLANK.search(first):
            return self._plain(text)
        return self._plain(first) + out

    def _unit(self, unit: str) -> tuple[int, ...] | bool:
        rest = unit[1:] if unit[:1] == "\n" else unit
        if not rest or _BLANK.search(rest):
            ids = False
        else:
            ids = tuple(chain.from_iterable(self._plain(unit if unit[0] == "\n" else " " + unit)))
        if len(self.units) >= self.memory:
            self.units.clear()
        self.units[unit] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text; strings of special tokens become those tokens."""
        if self.special_pattern is None or not any(s in text for s in self.special):
            parts = [text]
        else:
            parts = self.special_pattern.split(text)
        out: list[int] = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(self.special[part])
            elif part:
                out.extend(chain.from_iterable(self._units(part)))
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids, by the offset table; bytes that are no UTF-8 become U+FFFD."""
        if not len(ids):
            return ""
        i = np.asarray(ids, dtype=np.int64)
        begin, size = self.starts[i], self.starts[i + 1] - self.starts[i]
        if len(i) < 64:
            return b"".join([self.spelled[k] for k in ids]).decode("utf-8", "replace")
        shift = begin - np.concatenate([[0], np.cumsum(size)[:-1]])
        where = np.repeat(shift, size) + np.arange(int(size.sum()))
        return np.frombuffer(self.bytes, dtype=np.uint8)[where].tobytes().decode("utf-8", "replace")


_loaded: dict[int, Vocabulary] = {}
caches.append(_loaded)


def loaded(spec: str, memory: int = MEMORY) -> Vocabulary:
    """The vocabulary of this text, built once in each worker."""
    key = hash((spec, memory))
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Vocabulary(spec, memory)
    return _loaded[key]


def read_spec(path: str | None = None) -> str:
    with open(path or public_tokenizers.path(VOCABULARY), encoding="utf-8") as f:
        return f.read()


def encode_documents(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", vocabulary: str | None = None,
                     memory: int = MEMORY, digest: bool = False, check: bool = False) -> DataFrame:
    """One row per input row: doc_id and ids, or with ``digest`` the contract's count and hashes.

    With ``check`` a column ``round_trip`` says whether the ids decode to the text.

    A null or empty text has no ids. Null and repeated ids and rows stay as
    they are. Empty table: no rows. A text is encoded whole, however long; a
    task holds one text's ids at a time. Only the two named columns are read.
    """
    spark = docs.sparkSession
    spec = spark.sparkContext.broadcast(read_spec(vocabulary))
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = d.schema["doc_id"].dataType.simpleString()
    if digest:
        schema = f"doc_id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    else:
        schema = f"doc_id {id_type}, ids array<int>" + ", round_trip boolean" * check

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = loaded(spec.value, memory)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                texts = [t or "" for t in part.column(1).to_pylist()]
                rows = [v.encode(t) for t in texts]
                cols = [part.column(0)]
                if digest:
                    cols += [pa.array([len(r) for r in rows], pa.int64()),
                             pa.array([hashlib.sha256(",".join(map(str, r)).encode()).hexdigest() for r in rows], pa.string()),
                             pa.array([hashlib.sha256(v.decode(r).encode()).hexdigest() for r in rows], pa.string())]
                    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                else:
                    cols.append(pa.array(rows, pa.list_(pa.int32())))
                    names = ["doc_id", "ids"]
                    if check:
                        cols.append(pa.array([v.decode(r) == t for r, t in zip(rows, texts, strict=True)], pa.bool_()))
                        names.append("round_trip")
                yield pa.RecordBatch.from_arrays(cols, names)
        v.units.clear()  # an idle worker keeps the tables, not the words

    return d.mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, ids_col: str = "ids", id_col: str = "doc_id", vocabulary: str | None = None) -> DataFrame:
    """doc_id and text of rows of ids; null or empty ids give the empty text, an id outside the vocabulary is an error."""
    spec = encoded.sparkSession.sparkContext.broadcast(read_spec(vocabulary))
    d = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = loaded(spec.value)
        for batch in batches:
            texts = [v.decode(r or []) for r in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, text string")
