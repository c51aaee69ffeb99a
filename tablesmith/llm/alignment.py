"""Token ids of two vocabularies held against each other by an inverted index of id pairs.

A text is cut by vocabulary A and by vocabulary B. Two tokens are linked where
their bytes overlap; byte offsets where tokens of both end cut a text into
groups. The index has, for every linked pair of ids, a compressed bitmap of
the documents that hold it and bit planes of how often they hold it beyond the
first time. Bitmaps of one segment of documents are merged by OR; their bits,
counted and summed over all segments, give each pair's documents and links in
the corpus. The postings then carry every pair's count back to its documents.
"""

from __future__ import annotations

import hashlib
import io
import json
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.bpe import _char_bytes
from tablesmith.llm.staging import written

VOCABULARY_A = "byte_bpe_50k.json"
VOCABULARY_B = "piece_bpe_32k.model"
#: Bits of a B id within a pair's key, ``a << B_BITS | b``.
B_BITS = 15
#: A segment ends at this many documents (a place in it has 16 bits) or bytes of text, or after one longer document.
SEGMENT_ROWS = 1 << 16
SEGMENT_BYTES = 8 << 20
#: Bytes of text whose links a task sorts at once.
CHUNK_BYTES = 1 << 20
#: Words whose alignment a task remembers.
MEMORY = 200_000
#: Words that are encoded as one text.
LEARN_WORDS = 5_000
#: A text is cut before blanks that follow something else; no token of either vocabulary spans such a place.
UNIT = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: White space for which that doesn't hold; such texts are encoded at once.
OTHER_BLANK = re.compile(r"[^\S \n]")



class Aligned(NamedTuple):
    """Texts held against both vocabularies: per text its counts and groups, and the links of all texts one after another."""

    counts: np.ndarray  #: a row a text: A tokens, B tokens, groups, links; all 0 where a text has no tokens
    groups: list[bytes]
    keys: np.ndarray  #: of links, ``a << B_BITS | b``
    owner: np.ndarray  #: place of each link's text


class Aligner:
    """Aligns whole texts; words that came before are looked up, new ones are encoded together."""

    def __init__(self, a_spec: bytes, b_model: bytes, memory: int = MEMORY):
        import sentencepiece

        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.encode_a, a_bytes = _byte_level(a_spec)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        if len(b_bytes) > 1 << B_BITS or len(a_bytes) > 1 << 16:
            raise ValueError("a vocabulary has more ids than a pair's key has room for")
        # words may be encoded apart if no piece has a blank after something else
        self.by_word = len(self.b.encode("x")) == 1 and not any(re.search("[^▁\n][▁\n]", p) for p in pieces)
        self.a_bytes, self.b_bytes = pa.array(a_bytes, pa.large_binary()), pa.array(b_bytes, pa.large_binary())
        self.a_length, self.b_length = (np.array([len(t) for t in x], dtype=np.int64) for x in (a_bytes, b_bytes))
        self.numbers = pa.array([f"{i}{c}" for n, last in ((len(a_bytes), "|"), (len(b_bytes), ";")) for i in range(n) for c in (",", last)], pa.large_string())
        self.memory = memory
        self._forget()

    def _forget(self) -> None:
        self.words: dict[str, int] = {}
        self.sound = np.zeros(0, dtype=bool)
        self.counts = np.zeros((0, 4), dtype=np.int64)
        self.links = np.zeros(0, dtype=np.int32)
        self.texts = pa.array([], pa.large_binary())

    def _cut(self, whole: bytes, a: np.ndarray, b: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array] | None:
        """(counts, keys of links, groups as text) of each part of ``whole`` that ends at ``ends``; None where the bytes or ends don't fit."""
        if _joined(self.a_bytes, a) != whole or _joined(self.b_bytes, b) != whole:
            return None
        end_a, end_b = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        if not np.isin(ends, common).all():
            return None
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        first = np.searchsorted(end_b, end_a - self.a_length[a], side="right")
        reach = np.searchsorted(end_b - self.b_length[b], end_a) - first
        keys = np.repeat(a << B_BITS, reach) | b[_ranges(first, reach)]
        part_a = np.searchsorted(ends, end_a)
        counts = np.stack([np.bincount(part_a, minlength=len(ends)), np.bincount(np.searchsorted(ends, end_b), minlength=len(ends)),
                           np.bincount(np.searchsorted(ends, common), minlength=len(ends)),
                           np.bincount(part_a, weights=reach, minlength=len(ends)).astype(np.int64)], axis=1)
        order = np.empty(len(a) + len(b), dtype=np.int64)
        order[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = 2 * a + np.append(group_a[1:] != group_a[:-1], True)
        order[np.arange(len(b)) + np.searchsorted(group_a, group_b, side="right")] = 2 * (len(self.a_length) + b) + np.append(group_b[1:] != group_b[:-1], True)
        spelled = self.numbers.take(pa.array(order))
        offsets = np.frombuffer(spelled.buffers()[1], dtype=np.int64)[: len(order) + 1]
        bounds = offsets[np.concatenate([[0], np.cumsum(counts[:, 0] + counts[:, 1])])]
        return counts, keys.astype(np.int32), pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(bounds), spelled.buffers()[2]])

    def _learn(self, units: list[str]) -> None:
        """Remember new words. They are encoded as one text, halved where that text doesn't come apart at their ends."""
        spelled = [u.encode() for u in units]
        joined = "".join(units)
        a, b = self.encode_a(joined), np.array(self.b.encode("x" + joined)[1:], dtype=np.int64)
        found = self._cut(b"".join(spelled), a, b, np.cumsum([len(u) for u in spelled]))
        if found is None and len(units) > 1:
            self._learn(units[: len(units) // 2])
            self._learn(units[len(units) // 2:])
            return
        counts, keys, texts = found or (np.zeros((1, 4), dtype=np.int64), np.zeros(0, dtype=np.int32), pa.array([b""], pa.large_binary()))
        self.words.update(zip(units, range(len(self.words), len(self.words) + len(units)), strict=True))
        self.fresh.append((np.full(len(units), found is not None), counts, keys, texts))

    def align(self, texts: list[str | None]) -> Aligned:
        """Blank + text of each text; no tokens for a null or empty text, or where either vocabulary doesn't give the bytes back."""
        if len(self.words) > self.memory:
            self._forget()
        units: list[str] = []
        bounds, apart = [0], []
        for k, text in enumerate(texts):
            if text and self.by_word and not OTHER_BLANK.search(text):
                units += UNIT.findall(" " + text)
            elif text:
                apart.append(k)
            bounds.append(len(units))
        new = list(set(units).difference(self.words))
        self.fresh: list[tuple] = []
        solid = [u for u in new if u[-1] not in " \n"]
        for k in range(0, len(solid), LEARN_WORDS):
            self._learn(solid[k: k + LEARN_WORDS])
        for u in new:
            if u[-1] in " \n":
                self._learn([u])
        if self.fresh:
            sound, counts, links, spelled = zip(*self.fresh, strict=True)
            self.sound, self.counts = np.concatenate([self.sound, *sound]), np.concatenate([self.counts, *counts])
            self.links, self.texts = np.concatenate([self.links, *links]), pa.concat_arrays([self.texts, *spelled])
        codes = np.fromiter(map(self.words.__getitem__, units), dtype=np.int64, count=len(units))
        ends = np.array(bounds)
        owner = np.repeat(np.arange(len(texts)), np.diff(ends))
        wrong = np.unique(owner[~self.sound[codes]])
        if len(wrong):
            keep = ~np.isin(owner, wrong)
            codes, owner = codes[keep], owner[keep]
            ends = np.searchsorted(owner, np.arange(len(texts) + 1))
        sums = np.concatenate([np.zeros((1, 4), dtype=np.int64), np.cumsum(self.counts[codes], axis=0)])
        counts = sums[ends[1:]] - sums[ends[:-1]]
        starts = np.cumsum(self.counts[:, 3]) - self.counts[:, 3]
        n = self.counts[codes, 3]
        keys, owners = [self.links[_ranges(starts[codes], n)]], [np.repeat(owner, n)]
        spelled = self.texts.take(pa.array(codes))
        data, at = spelled.buffers()[2], np.frombuffer(spelled.buffers()[1], dtype=np.int64)[: len(codes) + 1][ends].tolist() if len(codes) else [0] * len(ends)
        data = memoryview(data) if data is not None else b""
        groups = [bytes(data[x: y - 1]) if y > x else b"" for x, y in zip(at[:-1], at[1:], strict=True)]
        for k in [*apart, *wrong.tolist()]:
            spaced = " " + texts[k]
            whole = spaced.encode()
            found = self._cut(whole, self.encode_a(spaced), np.array(self.b.encode(texts[k]), dtype=np.int64), np.array([len(whole)]))
            if found is not None:
                counts[k], groups[k] = found[0][0], found[2][0].as_py()[:-1]
                keys.append(found[1])
                owners.append(np.full(len(found[1]), k))
        return Aligned(counts, groups, np.concatenate(keys), np.concatenate(owners))


def _byte_level(spec: bytes) -> tuple[Callable[[str], np.ndarray], list[bytes]]:
    """(encoder, bytes of each token) of a byte-level tokenizer file; special tokens' strings are plain text.

    Where every merge makes the next id, ids are ranks, and the faster library
    for ranks gives the same ids; else the file's own library encodes.
    """
    read = json.loads(spec)
    byte_of, vocabulary = _char_bytes(), read["model"]["vocab"]
    tokens = {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items() if all(c in byte_of for c in t)}
    spelled = [b""] * (max([*vocabulary.values(), *(t["id"] for t in read.get("added_tokens", []))]) + 1)
    for t in read.get("added_tokens", []):
        spelled[t["id"]] = t["content"].encode()
    special = {t["content"] for t in read.get("added_tokens", [])}
    for t, i in tokens.items():
        spelled[i] = t
    merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in read["model"]["merges"]]
    if merged == list(range(256, 256 + len(merged))):
        import tiktoken

        ranks = {t: i for t, i in tokens.items() if t.decode("utf-8", "replace") not in special}
        coder = tiktoken.Encoding("given", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda text: np.array(coder.encode_ordinary(text), dtype=np.int64), spelled
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(spec.decode())
    tokenizer.encode_special_tokens = True
    return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.int64), spelled


def _joined(spelled: pa.Array, ids: np.ndarray) -> bytes:
    data = spelled.take(pa.array(ids)).buffers()[2]
    return data.to_pybytes() if data is not None else b""


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each length, one after another."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))


class Bitmaps:
    """A bitmap of places for every key: 16-bit places where few bits are set, bits where many are."""

    def __init__(self, size: int, keys: np.ndarray, counts: np.ndarray, places: np.ndarray, dense_keys: np.ndarray, bits: np.ndarray):
        self.size, self.keys, self.counts, self.places, self.dense_keys, self.bits = size, keys, counts, places, dense_keys, bits

    @classmethod
    def of(cls, size: int, keys: np.ndarray, places: np.ndarray) -> Bitmaps:
        """From (key, place) pairs, sorted and distinct."""
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
        counts = np.diff(np.append(first, len(keys)))
        width = -(-size // 8)
        many = counts * 2 > width
        in_many = np.repeat(many, counts)
        bits = np.zeros((int(many.sum()), width * 8), dtype=bool)
        bits[np.repeat(np.arange(len(bits)), counts[many]), places[in_many]] = True
        return cls(size, keys[first][~many].astype(np.int32), counts[~many].astype(np.int32), places[~in_many].astype(np.uint16),
                   keys[first][many].astype(np.int32), np.packbits(bits, axis=1))

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """(key, place) of every bit."""
        row, place = np.nonzero(np.unpackbits(self.bits, axis=1)) if len(self.bits) else (np.zeros(0, dtype=np.int64),) * 2
        return (np.concatenate([np.repeat(self.keys, self.counts), self.dense_keys[row]]),
                np.concatenate([self.places.astype(np.int64), place]))

    def popcounts(self) -> tuple[np.ndarray, np.ndarray]:
        """(key, bits set) by key."""
        keys = np.concatenate([self.keys, self.dense_keys])
        n = np.concatenate([self.counts.astype(np.int64), np.bitwise_count(self.bits).sum(axis=1, dtype=np.int64)])
        order = np.argsort(keys)
        return keys[order], n[order]

    @classmethod
    def merged(cls, parts: list[Bitmaps]) -> Bitmaps:
        """The OR of bitmaps over the same places."""
        size = max((p.size for p in parts), default=0)
        width = -(-size // 8)
        dense_keys = np.unique(np.concatenate([p.dense_keys for p in parts]))
        bits = np.zeros((len(dense_keys), width), dtype=np.uint8)
        sparse = []
        for p in parts:
            row = np.searchsorted(dense_keys, p.dense_keys)
            bits[row, : p.bits.shape[1]] |= p.bits
            keys, places = np.repeat(p.keys, p.counts), p.places
            at = np.searchsorted(dense_keys, keys)
            hit = (at < len(dense_keys)) & (dense_keys[np.minimum(at, len(dense_keys) - 1)] == keys) if len(dense_keys) else np.zeros(len(keys), dtype=bool)
            np.bitwise_or.at(bits, (at[hit], places[hit] >> 3), (0x80 >> (places[hit] & 7)).astype(np.uint8))
            sparse.append(keys[~hit].astype(np.int64) << 16 | places[~hit])
        packed = np.unique(np.concatenate(sparse))
        few = cls.of(size, packed >> 16, packed & 0xFFFF)
        return cls(size, few.keys, few.counts, few.places, np.concatenate([dense_keys, few.dense_keys]).astype(np.int32),
                   np.concatenate([bits, few.bits]))

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.size]), self.keys, self.counts, self.places, self.dense_keys, self.bits]


def _packed(planes: list[Bitmaps]) -> bytes:
    out = io.BytesIO()
    np.savez(out, *[x for p in planes for x in p.arrays()])
    return out.getvalue()


def _unpacked(data: bytes) -> list[Bitmaps]:
    with np.load(io.BytesIO(data)) as z:
        flat = [z[f"arr_{k}"] for k in range(len(z.files))]
    return [Bitmaps(int(flat[k][0]), *flat[k + 1: k + 6]) for k in range(0, len(flat), 6)]


def posted(keys: np.ndarray, places: np.ndarray, size: int) -> list[Bitmaps]:
    """Of links' keys and documents' places: the bitmaps of all documents with a pair, then planes of the further occurrences, lowest bit first."""
    keyed, times = np.unique(keys.astype(np.int64) << 16 | places, return_counts=True)
    out, more = [Bitmaps.of(size, keyed >> 16, keyed & 0xFFFF)], times - 1
    while more.any():
        odd = keyed[(more & 1).astype(bool)]
        out.append(Bitmaps.of(size, odd >> 16, odd & 0xFFFF))
        more = more >> 1
    return out


class _Segment:
    """Documents that share bitmaps; their digests and chunks' postings until the segment ends."""

    def __init__(self, number: int, aligner: Aligner, keep_groups: bool = False):
        self.number, self.aligner, self.keep_groups = number, aligner, keep_groups
        self.bytes = self.pending = 0
        self.ids: list[object] = []
        self.texts: list[str | None] = []
        self.rows: list[tuple] = []
        self.chunks: list[list[Bitmaps]] = []

    def add(self, doc_id: object, text: str | None) -> None:
        n = len(text or "")
        if self.pending + n > CHUNK_BYTES:
            self.close_chunk()
        self.ids.append(doc_id)
        self.texts.append(text)
        self.bytes, self.pending = self.bytes + n, self.pending + n

    def close_chunk(self) -> None:
        """Align the texts at hand and keep what the segment's record needs of them."""
        first = len(self.rows)
        found = self.aligner.align(self.texts)
        for doc_id, counts, groups in zip(self.ids, found.counts.tolist(), found.groups, strict=True):
            self.rows.append((doc_id, *counts, hashlib.sha256(groups).hexdigest() if counts[0] else "", groups.decode() if self.keep_groups else None))
        self.chunks.append(posted(found.keys, found.owner + first, len(self.rows)))
        self.ids, self.texts, self.pending = [], [], 0

    def full(self) -> bool:
        return len(self.rows) + len(self.ids) >= SEGMENT_ROWS or self.bytes >= SEGMENT_BYTES

    def record(self, id_type: pa.DataType, names: list[str]) -> pa.RecordBatch:
        self.close_chunk()
        planes = [Bitmaps.merged([c[k] for c in self.chunks if k < len(c)]) for k in range(max(map(len, self.chunks)))]
        kinds = [id_type, *[pa.int64()] * 4, pa.string(), pa.string()]
        columns = [pa.array([list(c)], pa.list_(t)) for c, t in zip(zip(*self.rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([self.number], pa.int64()), *columns, pa.array([_packed(planes)], pa.binary())], names)


_loaded: dict[int, Aligner] = {}


def _aligner(a_spec: bytes, b_model: bytes) -> Aligner:
    key = hash((a_spec, b_model))
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Aligner(a_spec, b_model)
    return _loaded[key]


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def index(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", vocabulary_a: str | None = None, vocabulary_b: str | None = None,
          keep_groups: bool = False) -> DataFrame:
    """The inverted index as a written table, one row per segment of documents.

    (segment, doc_ids, n_a, n_b, n_groups, n_links, groups_sha256, groups,
    postings): arrays by place in the segment, and the packed bitmaps.
    ``groups`` holds texts ``a1,a2|b1;a3|b2`` if ``keep_groups``, else nulls.

    A text that is null, empty, or not given back byte by byte by both
    vocabularies has no tokens; it keeps its place. Every row counts as a
    document of its own, null and repeated ids too. A segment's size is bounded
    by ``SEGMENT_ROWS`` and ``SEGMENT_BYTES`` or one longer document. Empty
    table: no segments. Only the two named columns are read.
    """
    sc = docs.sparkSession.sparkContext
    a_spec = sc.broadcast(_read(vocabulary_a or public_tokenizers.path(VOCABULARY_A)))
    b_model = sc.broadcast(_read(vocabulary_b or public_tokenizers.path(VOCABULARY_B)))
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_name = d.schema["doc_id"].dataType.simpleString()
    fields = {"segment": "bigint", "doc_ids": f"array<{id_name}>", **{c: "array<bigint>" for c in ("n_a", "n_b", "n_groups", "n_links")},
              "groups_sha256": "array<string>", "groups": "array<string>", "postings": "binary"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(a_spec.value, b_model.value)
        number = TaskContext.get().partitionId() << 32
        segment, id_type = _Segment(number, aligner, keep_groups), pa.null()
        for batch in batches:
            id_type = batch.schema.field(0).type
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    segment.add(doc_id, text)
                    if segment.full():
                        yield segment.record(id_type, list(fields))
                        number += 1
                        segment = _Segment(number, aligner, keep_groups)
        if segment.ids or segment.rows:
            yield segment.record(id_type, list(fields))

    return written(d.mapInArrow(run, ", ".join(f"{k} {v}" for k, v in fields.items())), "pair-postings")


def pair_counts(segments: DataFrame) -> DataFrame:
    """(pair, a, b, n_docs, n_links, best): every linked pair of ids once, over the whole corpus, as a written table.

    ``n_docs`` documents hold the pair, in ``n_links`` links; ``best`` is true
    where no other pair of the same A id is in more documents (ties: all).
    Segments' counts are summed map-side first, so a pair that stands
    everywhere reaches its reducer once a task. The best counts are one row
    an A id, at most the vocabulary's size, which is broadcast.
    """
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                planes = _unpacked(data.as_py())
                keys, docs = planes[0].popcounts()
                links = docs.copy()
                for k, plane in enumerate(planes[1:]):
                    some, n = plane.popcounts()
                    links[np.searchsorted(keys, some)] += n << k
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(docs), pa.array(links)], ["pair", "n_docs", "n_links"])

    each = segments.select("postings").mapInArrow(counted, "pair int, n_docs bigint, n_links bigint")
    summed = each.groupBy("pair").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))
    summed = written(summed.withColumn("a", F.shiftright("pair", B_BITS)).withColumn("b", F.col("pair").bitwiseAND((1 << B_BITS) - 1)), "pair-sums")
    most = summed.groupBy("a").agg(F.max("n_docs").alias("most"))
    return written(summed.join(F.broadcast(most), "a").select("pair", "a", "b", "n_docs", "n_links", (F.col("n_docs") == F.col("most")).alias("best")),
                   "pair-counts")


def scores(segments: DataFrame, counts: DataFrame) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, groups): one row per document.

    ``count_sum`` adds, over a document's links, how many documents hold the
    pair; ``n_best`` counts the links whose pair is the best of its A id. Every
    segment's pairs are joined to their counts, one row a pair and segment,
    and come back to the segment, whose bitmaps deal them to its documents.
    """
    id_name = segments.schema["doc_ids"].dataType.elementType.simpleString()

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                k, _ = _unpacked(data.as_py())[0].popcounts()
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), number)), pa.array(k, pa.int32())], ["segment", "pair"])

    asked = segments.select("segment", "postings").mapInArrow(keys, "segment bigint, pair int")
    told = asked.join(counts.select("pair", "n_docs", "best"), "pair").select("segment", "pair", "n_docs", "best")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]

    def deal(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = {c: left.column(c)[0] for c in ("doc_ids", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups")}
        n = len(rows["doc_ids"])
        order = np.argsort(right.column("pair").to_numpy())
        pair = right.column("pair").to_numpy()[order]
        worth = right.column("n_docs").to_numpy()[order]
        best = right.column("best").to_numpy(zero_copy_only=False)[order]
        n_best, total = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        for k, plane in enumerate(_unpacked(left.column("postings")[0].as_py())):
            key, place = plane.pairs()
            at = np.searchsorted(pair, key)
            times = 1 << max(k - 1, 0)
            np.add.at(total, place, worth[at] * times)
            n_best += np.bincount(place, weights=best[at], minlength=n).astype(np.int64) * times
        return pa.table([rows["doc_ids"].values, rows["n_a"].values, rows["n_b"].values, rows["n_groups"].values, rows["n_links"].values,
                         pa.array(n_best), pa.array(total), rows["groups_sha256"].values, rows["groups"].values], names)

    fields = f"doc_id {id_name}, " + ", ".join(f"{c} bigint" for c in names[1:7]) + ", groups_sha256 string, groups string"
    return segments.groupBy("segment").cogroup(told.groupBy("segment")).applyInArrow(deal, fields)


def report(docs: DataFrame) -> DataFrame:
    """The contract's columns for every row of ``docs``."""
    segments = index(docs)
    return scores(segments, pair_counts(segments)).drop("groups")
