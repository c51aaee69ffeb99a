"""Token ids packed into rows of fixed width by best-fit decreasing.

Documents are encoded, documents longer than a row are split into full rows
and a rest, and each block of pieces is packed: the longest piece first, each
into the open row with the least room that still holds it. A segment tree over
the amounts of room finds that row in log2(width) steps.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "byte_bpe_50k.tiktoken"
WIDTH = 2048
#: The free id of the vocabulary; fills rows up.
PAD = 50256
#: Tokens that a task packs at once.
BLOCK_TOKENS = 1 << 20


class Rooms:
    """Open rows by the room they have left; counts in a segment tree over 0..width."""

    def __init__(self, width: int):
        self.size = 1 << width.bit_length()
        self.tree = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(self.size)]

    def _add(self, room: int, n: int) -> None:
        node = self.size + room
        while node:
            self.tree[node] += n
            node >>= 1

    def put(self, row: int, room: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(row, room) of the least room >= need, the row opened last among equals; None if there is none."""
        node, tree = self.size + need, self.tree
        if not tree[node]:
            while node > 1 and (node & 1 or not tree[node + 1]):  # up to the first subtree on the right that holds a row
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node *= 2
                if not tree[node]:
                    node += 1
        room = node - self.size
        row = self.rows[room].pop()
        self._add(room, -1)
        return row, room


def best_fit_decreasing(sizes: list[int], width: int) -> list[list[int]]:
    """Pieces (by position) of each row. Equal sizes keep their order."""
    rooms, rows = Rooms(width), []
    for k in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        if sizes[k] > width:
            raise ValueError("a piece is longer than a row")
        found = rooms.take(sizes[k])
        if found is None:
            rows.append([k])
            rooms.put(len(rows) - 1, width - sizes[k])
        else:
            row, room = found
            rows[row].append(k)
            rooms.put(row, room - sizes[k])
    return rows


class Encoder:
    """Ids by a public byte-level vocabulary. Whole texts go to the library: with many different words that is faster than a memory of words."""

    def __init__(self, ranks: bytes):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
        self.encoding = tiktoken.Encoding("given", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def encode(self, text: str | None) -> np.ndarray:
        """A null text has no ids."""
        return np.array(self.encoding.encode_ordinary(text or ""), dtype=np.int32)


_loaded: dict[int, Encoder] = {}


def _encoder(ranks: bytes) -> Encoder:
    key = hash(ranks)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Encoder(ranks)
    return _loaded[key]


def _rows(ids: list[np.ndarray], docs: list[object], width: int, pad: int, id_type: pa.DataType) -> pa.RecordBatch:
    """Pack one block of documents."""
    pieces = [(k, a, min(a + width, len(x))) for k, x in enumerate(ids) for a in range(0, max(len(x), 1), width)]
    rows = best_fit_decreasing([b - a for _, a, b in pieces], width)
    matrix = np.full((len(rows), width), pad, dtype=np.int32)
    bounds, resets, held, offsets, counts = [], [], [], [], []
    for r, members in enumerate(rows):
        at, ends = 0, [0]
        for k, a, b in (pieces[m] for m in members):
            matrix[r, at: at + b - a] = ids[k][a:b]
            at += b - a
            ends.append(at)
        bounds.append(ends)
        resets.append(ends[:-1])
        held.append([docs[pieces[m][0]] for m in members])
        offsets.append([pieces[m][1] for m in members])
        counts.append(at)
    matrix_col = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * width), pa.array(matrix.ravel()))
    ints = pa.list_(pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(counts, pa.int64()), matrix_col, pa.array(bounds, ints), pa.array(resets, ints),
         pa.array(held, pa.list_(id_type)), pa.array(offsets, pa.list_(pa.int64()))],
        ["n_tokens", "ids", "cu_seqlens", "position_resets", "doc_ids", "doc_offsets"])


def pack_documents(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", width: int = WIDTH, pad: int = PAD,
                   vocabulary: str | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per packed row.

    ``ids`` has ``width`` ids, ``n_tokens`` of them real; ``cu_seqlens`` the
    cumulative segment lengths from 0; ``position_resets`` where positions
    start again at 0; ``doc_ids`` the document of each segment and
    ``doc_offsets`` the segment's first token within its document, so every
    document can be put together again.

    Each task packs its documents in blocks of ``block_tokens`` tokens (or one
    longer document): no shuffle, and memory that doesn't follow the input. A
    null or empty text is a segment of length 0. Null and repeated ids are kept
    as they are. Empty table: no rows. Only the two named columns are read.
    """
    with open(vocabulary or public_tokenizers.path(VOCABULARY), "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_name = d.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks.value)
        ids, held, n, id_type = [], [], 0, pa.null()
        for batch in batches:
            id_type = batch.schema.field(0).type
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    x = encoder.encode(text)
                    ids.append(x)
                    held.append(doc)
                    n += len(x)
                    if n >= block_tokens:
                        yield _rows(ids, held, width, pad, id_type)
                        ids, held, n = [], [], 0
        if ids:
            yield _rows(ids, held, width, pad, id_type)

    return d.mapInArrow(run, f"n_tokens bigint, ids array<int>, cu_seqlens array<int>, position_resets array<int>, "
                             f"doc_ids array<{id_name}>, doc_offsets array<bigint>")


def write_packed(packed: DataFrame, path: str) -> None:
    """Parquet files whose ``ids`` are little-endian binary of 4 bytes an id, for loaders that map them into memory."""
    def binary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [np.asarray(x, dtype="<i4").tobytes() for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary()), *b.columns[2:]], b.schema.names)

    fields = ", ".join(f"{f.name} {'binary' if f.name == 'ids' else f.dataType.simpleString()}" for f in packed.schema)
    packed.mapInArrow(binary, fields).write.parquet(path)
