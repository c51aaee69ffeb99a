"""Repeated passages by MinHash banding of paragraphs.

Paragraphs are a text's lines and its blocks between blank lines, whole. So that
a passage is also found inside longer ones, the words of a text are cut by
content into pieces of some 50 words and chunks of some 18, which fall alike
wherever a passage is pasted: a word whose hash is the least among its
neighbours opens one, and each runs to the second next opening. Paragraphs of
one kind whose MinHash bands collide are verified by the Jaccard similarity of
their five-word shingles and joined to components; all but a component's first
paragraph are marked for removal. Chunks stand for exact copies: one changed
word leaves most of the chunks around it below any useful similarity, so they
join by equality and take no part in the bands.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablesmith.llm import buckets
from tablesmith.llm.components import components
from tablesmith.llm.staging import dropped, written
from tablesmith.llm.textarrays import mix, slices, span_hashes, window_hashes, word_spans

#: Words on each side that a word must undercut to open a chunk: openings lie 5 words or more apart, 9 on average.
NEIGHBOURS = 4
#: And to open a piece: 13 words or more apart, 25 on average. Only texts with more words than a piece has are cut to pieces.
PIECE_NEIGHBOURS = 12
PIECE_WORDS = 50
#: Shorter paragraphs are no passages.
MIN_WORDS = 12
#: Repeated paragraphs that overlap or touch make a passage; chunks are reported in passages of this many words on.
PASSAGE_WORDS = 20
CHUNK, PIECE, WHOLE = 0, 1, 2
SHINGLE_WORDS = 5
PERCENT = 75
#: Six bands of three rows meet a pair of similarity 0.75 with probability 0.96, of 0.85 with 0.997, equal ones always.
BANDS, ROWS = 6, 3
#: A table of texts to cut from of at most this many rows is broadcast; a longer one is joined by shuffle, with the same rows.
#: Tables of nodes are joined by shuffle at any size.
BROADCAST_PLACES = 1_000_000


def openings(words: np.ndarray, bounds: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Flags of the words that open a chunk or piece; the first word of every row does."""
    n = len(words)
    out = np.ones(n, dtype=bool)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    key = mix(words)
    for k in range(1, neighbours + 1):
        same = row[k:] == row[:-k] if n > k else np.zeros(0, bool)
        if len(same):
            out[k:] &= ~same | (key[k:] < key[:-k])  # less than the word k before
            out[:-k] &= ~same | (key[:-k] <= key[k:])  # and at most the one k after
    some = bounds[:-1][np.diff(bounds) > 0]
    out[some] = True
    return out


def spans(words: np.ndarray, bounds: np.ndarray, neighbours: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, end, row) of the chunks or pieces with enough words."""
    opens = np.flatnonzero(openings(words, bounds, neighbours))
    row = np.searchsorted(bounds, opens, side="right") - 1
    second = np.full(len(opens), len(words), dtype=np.int64)
    second[:-2] = opens[2:]
    end = np.minimum(second, bounds[row + 1])
    kept = end - opens >= MIN_WORDS
    return opens[kept], end[kept], row[kept]


def whole_spans(b: np.ndarray, starts: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, end, row) of the lines and of the blocks between blank lines, each span once."""
    breaks = np.cumsum(b == 10)[starts]  # line feeds before each word
    step = np.diff(breaks)
    inner = bounds[1:-1]
    inner = inner[(inner > 0) & (inner < len(starts))] - 1
    found = []
    for least in (1, 2):
        cut = step >= least
        cut[inner] = True
        at = np.concatenate([[0], np.flatnonzero(cut) + 1, [len(starts)]])
        found.append(np.stack([at[:-1], at[1:]], axis=1))
    span = np.unique(np.concatenate(found), axis=0)
    span = span[span[:, 1] - span[:, 0] >= MIN_WORDS]
    return span[:, 0], span[:, 1], np.searchsorted(bounds, span[:, 0], side="right") - 1


def _paragraphs(rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, chunks: bool = True):
    """(bytes, starts and ends of the words, kind, first word, end and row of each paragraph, hashes of the word windows)."""
    b, starts, ends, owner = word_spans(data, offsets)
    words = span_hashes(b, starts, ends)
    bounds = np.searchsorted(owner, np.arange(len(offsets)))
    pieces = spans(words, bounds, PIECE_NEIGHBOURS)
    long = pieces[1] - pieces[0] >= PIECE_WORDS // 2
    pieces = tuple(x[long & (np.diff(bounds)[pieces[2]] > PIECE_WORDS)] for x in pieces)
    found = [spans(words, bounds) if chunks else (pieces[0][:0],) * 3, pieces, whole_spans(b, starts, bounds)]
    kind = np.repeat(np.array([CHUNK, PIECE, WHOLE]), [len(x[0]) for x in found])
    first, end, row = (np.concatenate([x[k] for x in found]).astype(np.int64) for k in range(3))
    grams = window_hashes(words, SHINGLE_WORDS)
    return b, starts, ends, kind, first, end, row, grams


def _node(grams: np.ndarray, first: np.ndarray, end: np.ndarray, kind: np.ndarray | int = CHUNK) -> np.ndarray:
    """One number for equal runs of shingles of one kind."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(grams), dtype=np.uint64)])
    power = np.concatenate([[np.uint64(0)], np.cumsum(mix(grams ^ np.uint64(0x5BD1E995)) * np.uint64(3), dtype=np.uint64)])
    stop = end - SHINGLE_WORDS + 1
    length = (stop - first).astype(np.uint64) + (np.asarray(kind).astype(np.uint64) << np.uint64(48))
    return (mix((sums[stop] - sums[first]) ^ mix(power[stop] - power[first]) + length) >> np.uint64(1)).astype(np.int64)


def _bands(grams: np.ndarray, first: np.ndarray, end: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """(paragraph x band) keys; those of two kinds never meet."""
    stop = end - SHINGLE_WORDS + 1
    edges = np.stack([first, stop], axis=1).ravel()
    out = np.empty((len(first), BANDS), dtype=np.uint64)
    padded = np.concatenate([grams, [np.uint64(2**64 - 1)]])
    for band in range(BANDS):
        key = (band + 1 + BANDS * kind).astype(np.uint64)
        for r in range(ROWS):
            least = np.minimum.reduceat(mix(padded ^ np.uint64((band * ROWS + r + 1) * 0x9E3779B97F4A7C1)), edges)[::2]
            key = mix(key ^ least)
        out[:, band] = key
    return out


def paragraphs(docs: DataFrame) -> DataFrame:
    """Every paragraph of (doc_id, text): a number of its row, a hash of its text, bytes of the UTF-8 text, its first word's place, kind and node."""
    numbered = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"), F.xxhash64("text").alias("key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch, "text"):
                _, starts, ends, kind, first, end, row, grams = _paragraphs(rows, data, offsets)
                held = rows.select(["row", "key", "doc_id"]).take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [*held.columns, pa.array(starts[first] - offsets[row]), pa.array(ends[end - 1] - offsets[row]),
                     pa.array(first - np.searchsorted(starts, offsets)[row]), pa.array(end - first), pa.array(kind.astype(np.int8)), pa.array(_node(grams, first, end, kind))],
                    ["row", "key", "doc_id", "start", "end", "at", "n_words", "kind", "node"])

    return numbered.mapInArrow(run, f"row bigint, key bigint, doc_id {docs.schema['doc_id'].dataType.simpleString()}, "
                                    "start bigint, end bigint, at bigint, n_words bigint, kind tinyint, node bigint")


def _index(docs: DataFrame, bits: int) -> DataFrame:
    """The packed band keys of the lines, blocks and pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch, "text"):
                *_, kind, first, end, _, grams = _paragraphs(rows, data, offsets, chunks=False)
                if len(first):
                    node = _node(grams, first, end, kind)
                    yield buckets.batch(list(buckets.packed(_bands(grams, first, end, kind).ravel(), np.repeat(node, BANDS), bits)))

    return docs.mapInArrow(run, buckets.SCHEMA)


def _small(table: DataFrame) -> DataFrame:
    """A written table, with the hint to broadcast it where its rows are few."""
    return F.broadcast(table) if table.count() <= BROADCAST_PLACES else table


def _places(found: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, key, doc_id, at, n_words, kind) of one place of each of the given nodes, written."""
    one = found.where(F.col("kind") != CHUNK).groupBy("node").agg(*[F.first(c).alias(c) for c in ("key", "doc_id", "at", "n_words", "kind")])
    return written(one.join(nodes.hint("shuffle_hash"), "node", "left_semi"), "paragraph-places")


def _cut(docs: DataFrame, places: DataFrame, sketches: bool) -> DataFrame:
    """(node, n, sketch) or (node, shingles) of the nodes, written, each cut from the one text of its place: only
    those texts reach Python. Texts are known by their hash; a node that the named span doesn't give (another text of
    that hash) is not sent, and one whose text stands on several rows of one id may come more than once. A shingle travels
    as 32 bits of its hash: two different ones of a pair of 100 shingles each agree by chance in 2 pairs of a million."""
    spans = written(places.groupBy("key", "doc_id").agg(F.collect_list(F.struct("node", "at", "n_words", "kind")).alias("spans")), "paragraph-spans")
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("key")).alias("t")
    chosen = texts.join(_small(spans).alias("p"), F.expr("t.key = p.key AND t.doc_id <=> p.doc_id")).select("text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            for rows, data, offsets in slices(batch, "text"):
                b, starts, ends, owner = word_spans(data, offsets)
                bounds = np.searchsorted(owner, np.arange(len(offsets)))
                grams = window_hashes(span_hashes(b, starts, ends), SHINGLE_WORDS)
                spans = rows.column("spans")
                row = np.repeat(np.arange(len(spans)), spans.value_lengths().to_numpy())
                node, at, n, kind = (spans.flatten().field(c).to_numpy() for c in ("node", "at", "n_words", "kind"))
                first, end = bounds[row] + at, bounds[row] + at + n
                inside = np.flatnonzero(end <= bounds[row + 1])
                right = inside[_node(grams, first[inside], end[inside], kind[inside]) == node[inside]]
                right = [k for k in right[np.unique(node[right], return_index=True)[1]].tolist() if int(node[k]) not in sent]
                sent.update(node[right].tolist())
                short = (mix(grams) >> np.uint64(32)).astype(np.uint32)
                sets = [np.unique(short[first[k]: end[k] - SHINGLE_WORDS + 1]).view(np.int32) for k in right]
                if sketches:
                    held = {"n": pa.array([len(s) for s in sets], pa.int64()), "sketch": buckets.sketch_column(sets)}
                else:
                    held = {"shingles": pa.array(sets, pa.list_(pa.int32()))}
                yield pa.RecordBatch.from_pydict({"node": pa.array(node[right]), **held})

    got = written(chosen.mapInArrow(run, "node bigint, n bigint, sketch binary" if sketches else "node bigint, shingles array<int>"), "paragraph-sets")
    dropped(spans)
    return got


def _verified(members: DataFrame, docs: DataFrame, places: DataFrame, percent: int) -> DataFrame:
    """(a, b) of nodes that links join, written, one at most for each member of a task: members (range, sig, node)
    bring their whole sets, and those of one band whose shingles reach the threshold are linked."""
    wanted = places.join(members.select("node").distinct().hint("shuffle_hash"), "node", "left_semi")
    sets = _cut(docs, wanted, sketches=False)
    links = written(buckets.tied(members.join(sets, "node"), percent), "paragraph-links")
    dropped(sets)
    return links


def repeated(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", percent: int = PERCENT) -> DataFrame:
    """One row per paragraph that stands elsewhere too, as it is or nearly.

    doc_id, start and end (bytes of the UTF-8 text), n_words, passage_words
    (the run of repeated paragraphs around it, ``PASSAGE_WORDS`` at least for
    chunks and pieces), component_id (a number of the component), n_copies, and
    ``removed``, false for the component's first paragraph (by doc_id, then
    place) only. A line in its block, or a chunk in the next one, is no copy:
    paragraphs of one component that overlap count as one.

    Nearly, for lines, blocks and pieces: similarity of ``percent`` or more with
    a paragraph of the same kind that shares a band; chunks are copies when equal. Parity sketches tell which members of a band
    may have a link there; these bring their whole sets to the band's task, which joins classes first by its smallest member, then
    by all pairs that are still in different ones. Equal paragraphs are one node, so a passage that a third
    of the corpus holds is one entry.

    Null, empty and short texts have no paragraphs. Rows with a null id come
    after all others and are matched like them. Repeated rows and ids are copies like any others.
    Empty table: no rows. Texts are read whole; only the two named columns are
    read.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = written(paragraphs(d), "paragraphs")
    total = found.where(F.col("kind") != CHUNK).count()
    met = written(buckets.sharing(_index(d, buckets.range_bits(total * BANDS))), "paragraph-bands")
    places = _places(found, met.select("node").distinct())
    sketches = _cut(d, places, sketches=True)
    members = written(buckets.hopeful(met.join(sketches, "node"), percent), "paragraph-members")
    dropped(met)
    dropped(sketches)
    links = _verified(members, d, places, percent)
    dropped(members)
    dropped(places)
    tied = components(links)

    # only nodes that stand twice or have a link matter from here on
    stand = found.select("node", F.lit(1).alias("n"), F.lit(None).cast("bigint").alias("component"))
    several = stand.unionByName(tied.select("node", F.lit(2).alias("n"), "component")).groupBy("node").agg(F.sum("n").alias("n"), F.min("component").alias("component"))
    named = written(several.where("n > 1").select("node", F.coalesce("component", "node").alias("component_id")), "paragraph-nodes")
    copies = written(found.join(named.hint("shuffle_hash"), "node").drop("node", "key"), "paragraph-copies")
    dropped(found)
    # paragraphs of a component that overlap are one occurrence, known by its first word
    along = Window.partitionBy("component_id", "row").orderBy("at", F.desc("n_words"))
    reach = F.max(F.col("at") + F.col("n_words")).over(along.rowsBetween(Window.unboundedPreceding, -1))
    copies = (copies.withColumn("apart", F.coalesce(F.col("at") >= reach, F.lit(True)))
              .withColumn("place", F.max(F.when(F.col("apart"), F.col("at"))).over(along)))
    groups = copies.groupBy("component_id").agg(
        F.count_if("apart").alias("n_copies"), F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "row", "place")).alias("first")).where("n_copies > 1")
    out = copies.join(groups, "component_id")
    # paragraphs that overlap or touch are one passage
    before = Window.partitionBy("row").orderBy("at")
    opens = F.coalesce(F.col("at") > F.max(F.col("at") + F.col("n_words")).over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    passages = out.withColumn("opens", opens.cast("int")).withColumn("passage", F.sum("opens").over(before))
    whole = Window.partitionBy("row", "passage")
    size = F.max(F.col("at") + F.col("n_words")).over(whole) - F.min("at").over(whole)
    is_first = (F.col("row") == F.col("first.row")) & (F.col("place") == F.col("first.place"))
    return (passages.withColumn("passage_words", size).where((F.col("kind") == WHOLE) | (F.col("passage_words") >= PASSAGE_WORDS))
            .select("doc_id", "start", "end", "n_words", "passage_words", "component_id", "n_copies", (~is_first).alias("removed")))
