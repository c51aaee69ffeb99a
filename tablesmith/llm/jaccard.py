"""Similarity join on word shingles by token-combination prefixes.

Every text is the set of its five-word shingles. In one global order of the
shingles (the common ones last, else by hash) two sets whose Jaccard similarity
reaches the threshold share their first common shingle within their prefixes,
and, extended by one, their second one too. So a rare shingle is indexed alone,
and common shingles in pairs: if the first shared one is common, the second is
also. Every candidate pair is verified on the whole sets.

A group of near copies shares thousands of shingles. Its members are first tied
to the smallest member they meet, verified and joined to classes; then to their best
partner in a larger class; only after that all pairs across classes are
candidates. Parity sketches rule out most pairs that are no links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.llm import buckets
from tablesmith.llm.components import components
from tablesmith.llm.staging import dropped, written
from tablesmith.llm.textarrays import handed_back, mix, shingle_set, slices, window_hashes, word_hashes

SHINGLE_WORDS = 5
#: Jaccard similarity of a link, in percent.
PERCENT = 75
#: A shingle is common if so many texts of different kinds hold it (texts with the same least shingle are one
#: kind), and so large a share of its texts are of a kind of their own: that tells a passage from a group of near copies.
#: All texts are counted. The result doesn't depend on it, only the order and so the work.
COMMON_KINDS = 8
COMMON_SHARE = 0.6
#: Common shingles, at most (8 bytes each, broadcast); with more, those in the most kinds.
COMMON_MOST = 1 << 20
#: A key list of at most this many rows is broadcast; a longer one is joined by shuffle.
BROADCAST_ROWS = 200_000
#: Text hashed at once: the arrays beside it take some 60 bytes for each of its bytes.
PART_BYTES = 1 << 18
#: Members of shared signatures that one task pairs, about; each brings a sketch.
MEMBERS = 1 << 16
#: Bits of a node's parity sketch.
SKETCH_BITS = 1024
_NODE = np.dtype([("node", "<i8"), ("n", "<i8"), ("rare", "<i8"), ("sketch", f"V{SKETCH_BITS // 8}")])


def _prefix(n: int, percent: int) -> int:
    """Shingles among which a set of ``n`` shows the first one that it shares with any similar set."""
    return n - -(-n * percent // 100) + 1


def _sets(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, set) of every row; ``PART_BYTES`` of text, or one longer text, are hashed at once."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + PART_BYTES, side="right")) - 1))
        words, bounds = word_hashes(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo])
        windows = window_hashes(words, size)
        for r, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            yield lo + r, shingle_set(words, windows, a, b, size)
        lo = hi


def node_of(s: np.ndarray) -> int:
    """One number for equal sets: 63 bits, -1 for the empty set."""
    if not len(s):
        return -1
    with np.errstate(over="ignore"):
        return int(mix(np.array([mix(s).sum() + np.uint64(len(s))], dtype=np.uint64))[0] >> np.uint64(1))


def sketch_of(s: np.ndarray) -> np.ndarray:
    """Parity sketch of a set, as 64-bit words."""
    parity = np.bincount((s & np.uint64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.uint64)


def _nodes(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, node, n) of every row, and its other columns but the text."""
    held = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in slices(batch, "text"):
                found = [(node_of(s), len(s)) for _, s in _sets(data, offsets, size)]
                yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in held], pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())],
                                                 [*held, "node", "n"])
        handed_back()

    return docs.mapInArrow(run, ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in held) + ", node bigint, n bigint")


def common_shingles(docs: DataFrame, size: int, percent: int, kinds: int, bits: int = 0, most: int = COMMON_MOST) -> np.ndarray:
    """Hashes of the common shingles, ascending: those in ``kinds`` kinds of text, or in so many more that at most ``most`` are.

    Only shingles near a prefix matter. Every text counts; ``bits`` give the ranges of the count.
    """
    bits = max(bits, _SAMPLE_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in slices(batch, "text"):
                sig, kind = [], []
                for _, s in _sets(data, offsets, size):
                    if len(s):
                        near = s[: _prefix(len(s), percent) * 3 // 2 + 8]
                        sig.append(near)
                        kind.append(np.full(len(near), (int(s[0]) >> 33 << 32) | (node_of(s) & 0xFFFFFFFF), dtype=np.int64))
                if sig:
                    yield buckets.batch(list(buckets.packed(np.concatenate(sig), np.concatenate(kind), bits)))
        handed_back()

    def count(table: pa.Table) -> Iterator[pa.Table]:
        sig, node, first = buckets.shared(table)
        own = np.ones(len(sig), dtype=bool)
        own[1:] = (sig[1:] != sig[:-1]) | (node[1:] >> 32 != node[:-1] >> 32)
        several = np.bincount(first, own, minlength=len(sig)).astype(np.int64)
        held = np.bincount(first, minlength=len(sig))
        at = np.flatnonzero((several >= kinds) & (several >= COMMON_SHARE * held) & (held > 0))
        r = np.uint64(table.column("range")[0].as_py())
        h = ((r << np.uint64(32)) | sig[at].astype(np.uint64)) >> np.uint64(bits - _SAMPLE_BITS)
        yield pa.table({"h": pa.array(h.view(np.int64), pa.int64()), "kinds": pa.array(several[at], pa.int64())})

    got = written(buckets.grouped(docs.mapInArrow(run, buckets.SCHEMA).groupBy("range"), count, "h bigint, kinds bigint"), "jaccard-common")
    # as many powers of two of kinds as fit
    level, held = F.floor(F.log2(F.col("kinds").cast("double"))).cast("int"), 0
    least = 64
    for r in got.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():  # 64 rows at most
        held += r["count"]
        if held > most:
            break
        least = r["level"]
    return np.unique(got.where(level >= least).select("h").toArrow().column("h").to_numpy())


#: Bits of the ranges, at least; a common shingle is known by 32 bits more.
_SAMPLE_BITS = 5


def _is_common(s: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Flags by the upper bits that common shingles are known by."""
    if not len(common):
        return np.zeros(len(s), dtype=bool)
    key = (s >> np.uint64(32 - _SAMPLE_BITS)).view(np.int64)
    return common[np.minimum(np.searchsorted(common, key), len(common) - 1)] == key


def signatures(s: np.ndarray, common: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(rare shingles of the prefix, pairs of common ones of the extended prefix) of a sorted set."""
    p = _prefix(len(s), percent)
    flags = _is_common(s, common)
    rare = s[~flags]
    if len(rare) >= p:
        single, often = rare[:p], s[:0]
        if len(rare) == p and flags.any():
            often = s[flags][:1]
    else:
        single, often = rare, s[flags][: p + 1 - len(rare)]
    if len(often) < 2:
        return single, s[:0]
    i, j = np.triu_indices(len(often), 1)
    return single, mix(mix(often[i]) + often[j])


def _index(docs: DataFrame, size: int, percent: int, common, bits: int) -> DataFrame:
    """(range, single, entries): the packed index; and with range -1 every node's (node, n, rare shingles in the prefix)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in slices(batch, "text"):
                seen: set[int] = set()
                got: dict[bool, list] = {True: [], False: []}
                table = []
                for _, s in _sets(data, offsets, size):
                    node = node_of(s)
                    if node < 0 or node in seen:
                        continue
                    seen.add(node)
                    single, pairs = signatures(s, common.value, percent)
                    table.append((node, len(s), len(single), sketch_of(s).tobytes()))
                    for kind, sig in ((True, single), (False, pairs)):
                        if len(sig):
                            got[kind].append((sig, np.full(len(sig), node, dtype=np.int64)))
                rows = [(-1, True, np.array(table, dtype=_NODE).tobytes())] if table else []
                for kind, parts in got.items():
                    if parts:
                        rows += [(r, kind, e) for r, e in buckets.packed(np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts]), bits)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.bool_()), pa.array([r[2] for r in rows], pa.binary())], ["range", "single", "entries"])
        handed_back()

    return docs.mapInArrow(run, "range bigint, single boolean, entries binary")


def _unpacked(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, n, rare, sketch), a row for each node in ``wanted``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for e in batch.column(0).to_pylist():
                x = np.frombuffer(e, dtype=_NODE)
                yield pa.RecordBatch.from_arrays([*[pa.array(x[c].copy()) for c in ("node", "n", "rare")], pa.array([k.tobytes() for k in x["sketch"]], pa.binary())],
                                                 ["node", "n", "rare", "sketch"])

    rows = index.where("range = -1").select("entries").mapInArrow(run, "node bigint, n bigint, rare bigint, sketch binary")
    return rows.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("n").alias("n"), F.min("rare").alias("rare"), F.first("sketch").alias("sketch"))


def _set_table(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of the nodes in ``wanted`` (node, doc_id), a written table: only those documents' texts are shuffled to them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in slices(batch, "text", PART_BYTES):
                part = [s for _, s in _sets(data, offsets, size)]
                yield pa.RecordBatch.from_arrays([pa.array([node_of(s) for s in part], pa.int64()), pa.array([s.view(np.int64) for s in part], pa.list_(pa.int64()))], ["node", "shingles"])
        handed_back()

    few = wanted.count() <= BROADCAST_ROWS

    def keys(column: str) -> DataFrame:
        k = wanted.select(column).distinct()
        return F.broadcast(k) if few else k

    chosen = docs.join(keys("doc_id"), "doc_id", "left_semi").select("text")
    return chosen.mapInArrow(run, "node bigint, shingles array<bigint>").join(keys("node"), "node", "left_semi").dropDuplicates(["node"])


def _verified(pairs: DataFrame, docs: DataFrame, at: DataFrame, size: int, percent: int, name: str) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold."""
    pairs = written(pairs.select("a", "b"), f"{name}-candidates")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = written(at.join(ends, "node", "left_semi"), "jaccard-wanted")
    sets = written(_set_table(docs, wanted, size), f"{name}-sets")
    one = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
    two = one.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    inter = F.size(F.array_intersect("sa", "sb"))
    links = written(two.where(100 * inter >= percent * (F.size("sa") + F.size("sb") - inter)).select("a", "b"), "jaccard-links")
    for table in (pairs, wanted, sets):
        dropped(table)
    return links


def _members(met: DataFrame, nodes: DataFrame, tied: DataFrame, sized: bool = False) -> DataFrame:
    """The nodes of every bucket with their set sizes, sketches and classes so far, and the classes' sizes."""
    named = tied.withColumnRenamed("component", "class")
    if sized:
        named = named.join(named.groupBy("class").agg(F.count("*").alias("size")), "class")
    out = met.join(nodes.select("node", "n", "sketch"), "node").join(named, "node", "left")
    return out.select("range", F.lit(True).alias("single"), "sig", "node", "shared", "n", "sketch", F.coalesce("class", "node").alias("class"),
                      *[F.coalesce("size", F.lit(1)).alias("size")] * sized)


def classes(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", size: int = SHINGLE_WORDS, percent: int = PERCENT,
            kinds: int = COMMON_KINDS) -> DataFrame:
    """doc_id, n_shingles, component_id of every row; component_id is the smallest id reachable over links.

    A null, empty or blank text has no shingles and links with nothing: it is
    its own component. Rows with a null id keep their row, count as no one's
    neighbour and have a null component. Repeated rows and repeated ids: equal
    sets are one node, whose id is the smallest of its rows'. Every link
    between different texts counts, ties at the threshold included. Empty
    table: no rows. Texts are read whole; only the two named columns are read.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows, at, linked = _linked(d, size, percent, kinds)
    smallest = linked.join(at, "node").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    reach = linked.join(smallest, "component").select("node", "component_id")
    out = (rows.join(at.withColumnRenamed("doc_id", "own"), "node", "left").join(reach, "node", "left"))
    own = F.coalesce("component_id", "own", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), own).alias("component_id"))


def _linked(d: DataFrame, size: int, percent: int, kinds: int = COMMON_KINDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of (doc_id, text, ...): the rows with their nodes, (node, doc_id) of each node's smallest id, (node, component) of the linked ones."""
    sc = d.sparkSession.sparkContext
    rows = written(_nodes(d, size), "jaccard-rows")
    at = rows.where("node >= 0 AND doc_id IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    total = rows.agg(F.count("*").alias("rows"), F.sum("n").alias("n")).first()
    texts = d.where("doc_id IS NOT NULL").select("doc_id", "text")
    # prefixes are the least hashes of their sets: as few of the ranges are busy as of the shingles are in prefixes
    bits = buckets.range_bits(total["n"] or 0)
    common = sc.broadcast(common_shingles(texts, size, percent, kinds, bits))
    index = written(_index(texts, size, percent, common, bits), "jaccard-index")
    found = written(buckets.meet(index), "jaccard-buckets")
    met = written(found.where("single IS NOT NULL").groupBy("range", "sig", "node").agg(F.sum("shared").alias("shared")), "jaccard-members")
    nodes = written(_unpacked(index, met.select("node").distinct()), "jaccard-nodes")
    dropped(index)
    merged = buckets.SET_BITS - buckets.range_bits(met.count(), size=MEMBERS)

    # near copies: each node with the hub that it meets most
    stars = found.where("single IS NULL").groupBy(F.col("other").alias("b"), F.col("node").alias("a")).agg(F.sum("sig").alias("shared"))
    sized = (stars.join(nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("rare").alias("ra")), "a")
             .join(nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("rare").alias("rb")), "b"))
    alike = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    best = (sized.where(alike & (5 * F.col("shared") >= F.least("ra", "rb"))).groupBy("b")
            .agg(F.max_by("a", F.struct("shared", F.negate("a"))).alias("a")))
    links = _verified(best, texts, at, size, percent, "jaccard-stars")
    dropped(found)

    # then each node with its nearest partner in a larger class
    second = buckets.across(_members(met, nodes, components(links), sized=True), best=True, merged=merged, percent=percent)
    links = links.unionByName(_verified(second, texts, at, size, percent, "jaccard-second"))

    # what is left: pairs across the classes so far
    rest = (buckets.across(_members(met, nodes, components(links)), merged=merged, percent=percent)
            .join(nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("rare").alias("ra")), "a")
            .join(nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("rare").alias("rb")), "b"))
    # the overlap is at most the shared prefix shingles and what lies behind one of the prefixes
    least = F.ceil(percent * (F.col("na") + F.col("nb")) / F.lit(100.0 + percent))
    rest = rest.where(alike & (F.col("shared") + F.greatest(F.col("na") - F.col("ra"), F.col("nb") - F.col("rb")) >= least))
    links = links.unionByName(_verified(rest, texts, at, size, percent, "jaccard-rest"))

    return rows, at, components(links)


def keep_first(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", size: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of each group of near copies, the one with the smallest id; all columns as they are.

    Rows are told by id and text: of an id that stands on texts of several
    groups, each group decides for its own row. Rows without an id stay. Of
    rows with one id and one text, one stays, null, empty and blank texts
    included, which are copies of nothing else.
    """
    key = F.xxhash64(F.col(text_col).isNull(), F.col(text_col))
    rows, at, linked = _linked(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), key.alias("key")), size, percent)
    firsts = (at.join(linked, "node", "left").groupBy(F.coalesce("component", "node").alias("component"))
              .agg(F.min(F.struct("doc_id", "node")).alias("first")).select("first.*"))
    kept = (rows.join(firsts, ["doc_id", "node"]).groupBy("doc_id", "node").agg(F.min("key").alias("key")).select("doc_id", "key")
            .unionByName(rows.where("node < 0 AND doc_id IS NOT NULL").select("doc_id", "key").distinct()))
    kept = kept.select(F.col("doc_id").alias("kept_id"), F.col("key").alias("kept_key"))
    whole = docs.select(F.struct("*").alias("d"), F.col(id_col).alias("id"), key.alias("key"))
    chosen = whole.join(kept, (whole["id"] == kept["kept_id"]) & (whole["key"] == kept["kept_key"]), "left_semi").dropDuplicates(["id", "key"])
    return chosen.select("d.*").unionByName(whole.where("id IS NULL").select("d.*"))


#: The same rows in DuckDB SQL.
CLASSES_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE
    WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS m FROM documents UNION SELECT l.a, r.m FROM r JOIN l ON l.b = r.doc_id)
SELECT r.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.m) AS component_id
FROM r LEFT JOIN n USING (doc_id) GROUP BY r.doc_id
"""
