"""Joins on signatures, packed: signatures travel in binary runs by ranges of their hash.

A signature is 64 bits, a node too. A task packs the entries of its rows by
range; the task that gets a range sorts them and sees each signature's nodes
side by side. Entries that a task holds more than once are sent once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.llm.textarrays import handed_back, mix

#: Entries that one task sorts, about.
RANGE_ENTRIES = 1 << 19
#: Pairs that a task adds up at once.
PAIRS_AT_ONCE = 1 << 18
#: Bits a number of the sketches by which sets in a task are told apart first, at least.
WIDE = 8
#: Pairs that a task holds before it sends them on.
PAIRS_HELD = 1 << 18
#: Rows that a task sends at once.
ROWS_SENT = 1 << 16
#: Bits of the ranges that buckets are dealt by once they are known by their members.
SET_BITS = 24
#: Bits that deal the signatures of a range to tasks when members bring their sets.
PART_BITS = 3
#: The signature's 32 bits after the range, and the node. Chance agreement of 32 bits only adds candidates.
ENTRY = np.dtype([("sig", "<u4"), ("node", "<i8")])
SCHEMA = "range bigint, entries binary"


def range_bits(entries: int, least: int = 0, size: int = RANGE_ENTRIES) -> int:
    """Bits of the range for about this many entries, ``size`` in each; at least ``least`` ranges."""
    return min(24, max(0, (max(1, -(-entries // size), least) - 1).bit_length()))


def _fresh(*keys: np.ndarray) -> np.ndarray:
    """Flags of the rows that differ from the row before; rows are sorted by the keys."""
    out = np.ones(len(keys[0]), dtype=bool)
    if len(out):
        out[1:] = False
        for k in keys:
            out[1:] |= k[1:] != k[:-1]
    return out


def counted(a: np.ndarray, b: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs and how often each stands (or the sum of its ``n``)."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    starts = np.flatnonzero(_fresh(a, b))
    if n is None:
        return a[starts], b[starts], np.diff(np.concatenate([starts, [len(a)]]))
    return a[starts], b[starts], np.add.reduceat(n[order], starts) if len(starts) else n[:0]


def packed(signatures: np.ndarray, nodes: np.ndarray, bits: int) -> Iterator[tuple[int, bytes]]:
    """(range, entries) of the different entries."""
    order = np.lexsort((nodes, signatures))
    signatures, nodes = signatures[order], nodes[order]
    kept = _fresh(signatures, nodes)
    signatures, nodes = signatures[kept], nodes[kept]
    if not len(signatures):
        return
    where = (signatures >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(signatures), dtype=np.int64)
    entries = np.empty(len(signatures), dtype=ENTRY)
    entries["sig"] = ((signatures << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
    entries["node"] = nodes
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(where)) + 1, [len(where)]])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        yield int(where[a]), entries[a:b].tobytes()


def batch(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r for r, _ in rows], pa.int64()), pa.array([e for _, e in rows], pa.binary())], ["range", "entries"])


def shared(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, node, first place of the signature) of a range's entries whose signature has two nodes or more."""
    entries = np.concatenate([np.frombuffer(e, dtype=ENTRY) for e in table.column("entries").to_pylist()])
    order = np.lexsort((entries["node"], entries["sig"]))
    sig, node = entries["sig"][order], entries["node"][order]
    kept = _fresh(sig, node)
    sig, node = sig[kept], node[kept]
    starts = np.flatnonzero(_fresh(sig))
    size = np.diff(np.concatenate([starts, [len(sig)]]))
    many = np.repeat(size >= 2, size)
    first = np.repeat(starts, size)
    place = np.cumsum(many) - 1
    return sig[many], node[many], place[first[many]]


def grouped(frame, run, schema: str) -> DataFrame:
    """``run`` (table to tables) on every group of a grouped frame: its results leave in small batches, and what it took is given back."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(pa.Table.from_batches(list(batches))):
            yield from out.to_batches(max_chunksize=ROWS_SENT)
        handed_back()

    return frame.applyInArrow(each, schema)


def pair_table(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.Table:
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})


def _best(x: np.ndarray, y: np.ndarray, n: np.ndarray, node: np.ndarray, cls: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of pairs between classes, for each node of the smaller class the pair of most weight."""
    known, at = np.unique(node, return_index=True)
    i, j = at[np.searchsorted(known, x)], at[np.searchsorted(known, y)]
    turn = (size[i] > size[j]) | ((size[i] == size[j]) & (cls[i] < cls[j]))
    x, y = np.where(turn, y, x), np.where(turn, x, y)
    order = np.lexsort((y, -n, x))
    x, y, n = x[order], y[order], n[order]
    kept = _fresh(x)
    return x[kept], y[kept], n[kept]


def meet(index: DataFrame) -> DataFrame:
    """What an index (range, single, entries) of two kinds of signature joins.

    (range, single, sig, node, shared) rows of the buckets, which are the nodes
    of a signature that has two or more. A bucket is known by its members,
    ``range`` and ``sig`` being bits of their hash, so that the many signatures
    that just two near copies share are one bucket: once a task here, and once
    at all when the caller sums up ``shared``, the number of its single
    signatures. Chance agreement only adds candidates.
    Beside them, with ``single`` null, the stars: ``node`` is the smallest node
    of ``sig`` signatures, each of which ``other`` has too.
    """
    def run(table: pa.Table) -> Iterator[pa.Table]:
        sig, node, first = shared(table)
        hub = node[first]
        other = hub != node
        a, b, n = counted(hub[other], node[other])
        starts = np.flatnonzero(_fresh(sig))
        held = np.diff(np.append(starts, len(sig)))
        key = mix(np.add.reduceat(mix(node.view(np.uint64)), starts) + held.astype(np.uint64)) if len(sig) else sig[:0].astype(np.uint64)
        _, at, times = np.unique(key, return_index=True, return_counts=True)
        kept = np.zeros(len(starts), dtype=bool)
        kept[at] = True
        kind = table.column("single")[0].as_py()
        weight = np.zeros(len(starts), dtype=np.int64)
        weight[at] = int(kind) * times
        key, weight, node = np.repeat(key[kept], held[kept]), np.repeat(weight[kept], held[kept]), node[np.repeat(kept, held)]
        where = (key >> np.uint64(64 - SET_BITS)).astype(np.int64)
        low = ((key << np.uint64(SET_BITS)) >> np.uint64(32)).astype(np.int64)
        yield pa.table({
            "range": pa.array(np.concatenate([where, np.zeros(len(a), dtype=np.int64)])), "single": pa.array([kind] * len(node) + [None] * len(a), pa.bool_()),
            "sig": pa.array(np.concatenate([low, n])), "node": pa.array(np.concatenate([node, a])),
            "other": pa.array(np.concatenate([node, b])), "shared": pa.array(np.concatenate([weight, n]))})

    return grouped(index.where("range >= 0").groupBy("range", "single"), run, "range bigint, single boolean, sig bigint, node bigint, other bigint, shared bigint")


def sharing(index: DataFrame) -> DataFrame:
    """(range, sig, node) of an index's (range, entries) signatures with two nodes or more."""
    def run(table: pa.Table) -> pa.Table:
        sig, node, _ = shared(table)
        return pa.table({"range": pa.array([table.column("range")[0].as_py()] * len(sig), pa.int64()), "sig": pa.array(sig.astype(np.int64)), "node": pa.array(node)})

    return index.groupBy("range").applyInArrow(run, "range bigint, sig bigint, node bigint")


class Sketches:
    """Nodes' set sizes and parity sketches: bit k of a sketch is the parity of
    the node's shingles that fall to k. Every bit in which two sketches differ
    is a shingle that only one set has, so a pair with too many is no link."""

    def __init__(self, node: np.ndarray, n: np.ndarray, bits: np.ndarray, percent: int):
        order = np.argsort(node)
        self.node, self.n, self.bits, self.percent = node[order], n[order], bits[order], percent

    def apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Bits in which the pairs differ, by a million shingles of both; -1 for those that can't reach ``percent``. Sizes tell first."""
        i, j = np.searchsorted(self.node, x), np.searchsorted(self.node, y)
        a, b = self.n[i], self.n[j]
        out = np.full(len(x), -1, dtype=np.int64)
        every = np.flatnonzero(100 * np.minimum(a, b) >= self.percent * np.maximum(a, b))
        for lo in range(0, len(every), 1 << 15):
            at = every[lo: lo + (1 << 15)]
            differ = np.bitwise_count(self.bits[i[at]] ^ self.bits[j[at]]).sum(axis=1, dtype=np.int64)
            both = a[at] + b[at]
            may = (100 + self.percent) * differ <= (100 - self.percent) * both
            out[at[may]] = 1_000_000 * differ[may] // both[may]
        return out

    def possible(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Flags of the pairs that may reach ``percent``."""
        return self.apart(x, y) >= 0


def _brought(table: pa.Table, percent: int) -> Sketches:
    """The sketches, all of one length, that members (node, n, sketch) bring; each node's once."""
    node, at = np.unique(table.column("node").to_numpy(), return_index=True)
    held = pa.concat_arrays([c.cast(pa.large_binary()) for c in table.column("sketch").chunks]).take(pa.array(at))
    width = len(held[0].as_py()) // 8
    bits = np.frombuffer(held.buffers()[2], dtype=np.uint64, count=len(at) * width).reshape(-1, width)
    return Sketches(node, table.column("n").to_numpy()[at], bits, percent)


def sketch_column(sets: list[np.ndarray], least: int = 2) -> pa.Array:
    """Parity sketches of sets of 32-bit numbers, of ``least`` to twice as many bits a number and 64 at least: longer ones fold to shorter ones by halves."""
    n = np.array([len(s) for s in sets], dtype=np.int64)
    width = np.array([max(64, 1 << (least * k - 1).bit_length()) if k else 64 for k in n.tolist()], dtype=np.int64)
    edges = np.concatenate([[0], np.cumsum(width)])
    flat = np.concatenate([s.view(np.uint32) for s in sets]).astype(np.int64) if len(sets) else n
    bits = np.bincount(np.repeat(edges[:-1], n) + (flat & (np.repeat(width, n) - 1)), minlength=edges[-1]) & 1
    data = np.packbits(bits.astype(np.uint8), bitorder="little")
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((edges // 8).astype(np.int32)), pa.py_buffer(data)])


class Carried(Sketches):
    """The same from the members themselves: set sizes and ``sketch_column`` sketches of any lengths."""

    def __init__(self, node: np.ndarray, n: np.ndarray, sketch: pa.Array, percent: int):
        self.node, at = np.unique(node, return_index=True)
        self.n, self.percent = n[at], percent
        held = sketch.take(pa.array(at))
        self.width = pc.binary_length(held).to_numpy().astype(np.int64) // 8
        self.row = np.zeros(len(at), dtype=np.int64)
        self.bits, self.half = {}, {}
        for w in np.unique(self.width).tolist():
            rows = np.flatnonzero(self.width == w)
            self.row[rows] = np.arange(len(rows))
            bits = np.frombuffer(b"".join(held.take(pa.array(rows)).to_pylist()), dtype=np.uint64).reshape(-1, w)
            self.bits[w] = bits
            if w > 1:
                self.half[w // 2] = bits[:, : w // 2] ^ bits[:, w // 2:]

    def apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        i, j = np.searchsorted(self.node, x), np.searchsorted(self.node, y)
        turn = self.width[i] > self.width[j]
        i, j = np.where(turn, j, i), np.where(turn, i, j)  # the longer sketch is the second one's
        a, b = self.n[i], self.n[j]
        out = np.full(len(x), -1, dtype=np.int64)
        alike = 100 * np.minimum(a, b) >= self.percent * np.maximum(a, b)  # so one is at most twice as long
        for w, bits in self.bits.items():
            for other, factor in ((bits, 1), (self.half.get(w), 2)):
                every = np.flatnonzero(alike & (self.width[i] == w) & (self.width[j] == factor * w)) if other is not None else ()
                step = max(1, (1 << 18) // w)
                for lo in range(0, len(every), step):
                    at = every[lo: lo + step]
                    differ = np.bitwise_count(bits[self.row[i[at]]] ^ other[self.row[j[at]]]).sum(axis=1, dtype=np.int64)
                    both = a[at] + b[at]
                    may = (100 + self.percent) * differ <= (100 - self.percent) * both
                    out[at[may]] = 1_000_000 * differ[may] // both[may]
        return out


def _blocks(node: np.ndarray, cls: np.ndarray, sig: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(x, y) of all members of different classes that share a signature, about ``PAIRS_AT_ONCE`` pairs at a time.
    Members are sorted by signature and class."""
    n = len(sig)
    starts = np.flatnonzero(_fresh(sig))
    last = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n)))  # where each member's signature ends
    runs = np.flatnonzero(_fresh(sig, cls))
    end = np.repeat(np.append(runs[1:], n), np.diff(np.append(runs, n)))  # and its class
    more = last - end
    held = np.flatnonzero(more)
    upto = np.cumsum(more[held])
    lo = 0
    while lo < len(held):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + PAIRS_AT_ONCE, side="right")))
        at = held[lo:hi]
        m = more[at]
        yield np.repeat(node[at], m), node[np.repeat(end[at], m) + np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)]
        lo = hi


class _Nearest:
    """Of pairs between classes, for each node of the smaller class the one that differs least."""

    def __init__(self, node: np.ndarray, cls: np.ndarray, size: np.ndarray):
        self.known, at = np.unique(node, return_index=True)
        self.cls, self.size = cls[at], size[at]
        self.other, self.least = np.zeros(len(at), dtype=np.int64), np.full(len(at), np.iinfo(np.int64).max)

    def add(self, x: np.ndarray, y: np.ndarray, apart: np.ndarray) -> None:
        i, j = np.searchsorted(self.known, x), np.searchsorted(self.known, y)
        turn = (self.size[i] > self.size[j]) | ((self.size[i] == self.size[j]) & (self.cls[i] < self.cls[j]))
        i, b = np.where(turn, j, i), np.where(turn, x, y)
        order = np.lexsort((b, apart, i))
        order = order[_fresh(i[order])]
        i, b, apart = i[order], b[order], apart[order]
        nearer = (apart < self.least[i]) | ((apart == self.least[i]) & (b < self.other[i]))
        self.other[i[nearer]], self.least[i[nearer]] = b[nearer], apart[nearer]

    def table(self) -> pa.Table:
        met = self.least < np.iinfo(np.int64).max
        return pair_table(self.known[met], self.other[met], -self.least[met])


def across(members: DataFrame, best: bool = False, sketches=None, merged: int = 0, percent: int | None = None) -> DataFrame:
    """(a, b, shared) of nodes of different classes that share a signature; ``shared`` counts single ones,
    or adds up the ``shared`` that members bring.

    With ``best`` (members then have a ``size``, of their class) only one pair
    a node: with the member of a larger class that shares the most with it, or
    whose sketch differs least, ``shared`` then being the negated difference.

    ``sketches``, a broadcast of ``Sketches``, drops pairs that can't be links
    before they are added up. With ``percent`` members bring theirs instead, as
    ``n`` and ``sketch``, so that a task holds those of its own members only.

    ``merged`` bits fewer than the index has tell the tasks apart: few of its
    entries are members, and a pair that meets in several tasks counts in each.

    Pairs are made ``PAIRS_AT_ONCE`` at a time; with ``best`` a task keeps the
    different ones, or with sketches one a node, else it sends them on whenever
    it has ``PAIRS_HELD``.
    """
    def run(table: pa.Table) -> Iterator[pa.Table]:
        sig, node, cls = (table.column(c).to_numpy() for c in ("sig", "node", "class"))
        sig = sig | (table.column("low").to_numpy() << 32)
        single = table.column("shared").to_numpy() if "shared" in table.column_names else np.full(len(sig), int(table.column("single")[0].as_py()))
        order = np.lexsort((cls, sig))
        judge = sketches.value if sketches is not None else None
        if percent is not None:
            judge = _brought(table, percent)
        size = table.column("size").to_numpy()[order] if best else None
        sig, node, cls, single = sig[order], node[order], cls[order], single[order]
        nearest = _Nearest(node, cls, size) if best and judge is not None else None
        done = []
        for i, j in _blocks(np.arange(len(sig)), cls, sig):
            x, y, n = node[i], node[j], single[i]
            if judge is not None:
                apart = judge.apart(x, y)
                kept = apart >= 0
                x, y, n = x[kept], y[kept], n[kept]
                if nearest is not None:
                    nearest.add(x, y, apart[kept])
                    continue
            done.append(counted(np.minimum(x, y), np.maximum(x, y), n))
            if len(done) > 1 and sum(len(d[0]) for d in done[1:]) > len(done[0][0]):
                done[:] = [counted(*[np.concatenate([d[k] for d in done]) for k in range(3)])]
            if not best and sum(len(d[0]) for d in done) >= PAIRS_HELD:
                yield from (pair_table(*d) for d in done)
                done.clear()
        if nearest is not None:
            yield nearest.table()
        elif done:
            x, y, n = counted(*[np.concatenate([d[k] for d in done]) for k in range(3)])
            yield pair_table(*(_best(x, y, n, node, cls, size) if best else (x, y, n)))

    dealt = members.withColumn("low", F.expr(f"range & {(1 << merged) - 1}")).withColumn("range", F.expr(f"shiftright(range, {merged})"))
    pairs = grouped(dealt.groupBy("range", "single"), run, "a bigint, b bigint, n bigint")
    if best and (sketches is not None or percent is not None):
        pairs = pairs.withColumnRenamed("n", "shared")
    else:
        pairs = pairs.groupBy("a", "b").agg(F.sum("n").alias("shared"))
    if not best:
        return pairs
    return (pairs.groupBy("a").agg(F.max_by("b", F.struct("shared", F.negate("b"))).alias("b"), F.max("shared").alias("shared"))
            .select("a", "b", "shared"))


def hopeful(members: DataFrame, percent: int) -> DataFrame:
    """(range, sig, node) of the members (with ``n`` and ``sketch``) that may reach ``percent`` with another of their signature.

    Members leave a task, not pairs: as many at most as came. Each is held
    against the first of its signature, and only those without a partner then
    against all others.
    """
    def run(table: pa.Table) -> pa.Table:
        sig, node = (table.column(c).to_numpy() for c in ("sig", "node"))
        order = np.lexsort((node, sig))
        order = order[_fresh(sig[order], node[order])]
        sig, node = sig[order], node[order]
        judge = Carried(node, table.column("n").to_numpy()[order], table.column("sketch").combine_chunks().take(pa.array(order)), percent)
        at = np.arange(len(sig))
        hub = np.maximum.accumulate(np.where(_fresh(sig), at, 0))
        others = np.flatnonzero(hub != at)
        near = others[judge.possible(node[others], node[hub[others]])]
        met = np.zeros(len(sig), dtype=bool)
        met[near] = met[hub[near]] = True
        apart = np.where(met, -1, at)
        order = np.lexsort((apart, sig))
        for x, y in _blocks(at[order], apart[order], sig[order]):
            may = judge.possible(node[x], node[y])
            met[x[may]] = met[y[may]] = True
        return pa.table({"range": pa.array([table.column("range")[0].as_py()] * int(met.sum()), pa.int64()), "sig": pa.array(sig[met]), "node": pa.array(node[met])})

    return members.groupBy("range").applyInArrow(run, "range bigint, sig bigint, node bigint")


class Sets:
    """Sorted sets of 32-bit numbers, known by their places: which pairs reach ``percent``, exactly."""

    def __init__(self, flat: np.ndarray, bounds: np.ndarray, percent: int):
        self.flat, self.start, self.n, self.percent = flat.view(np.uint32), bounds[:-1], np.diff(bounds), percent
        self.key = (np.repeat(np.arange(len(self.n)), self.n) << 32) | self.flat
        parts = [sketch_column([self.flat[a:b] for a, b in zip(bounds[lo: lo + 256].tolist(), bounds[lo + 1: lo + 257].tolist(), strict=False)], WIDE)
                 for lo in range(0, len(self.n), 256)]
        self.judge = Carried(np.arange(len(self.n)), self.n, pa.concat_arrays(parts), percent)

    def linked(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Flags of the pairs that reach ``percent``."""
        out = np.zeros(len(x), dtype=bool)
        may = np.flatnonzero(self.judge.possible(x, y))
        turn = self.n[x[may]] > self.n[y[may]]
        x, y = np.where(turn, y[may], x[may]), np.where(turn, x[may], y[may])
        upto = np.concatenate([[0], np.cumsum(self.n[x])])
        lo = 0
        while lo < len(may):
            hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] + PAIRS_AT_ONCE, side="right")) - 1)
            m = self.n[x[lo:hi]]
            first = np.cumsum(m) - m
            asked = (np.repeat(y[lo:hi], m) << 32) | self.flat[np.repeat(self.start[x[lo:hi]] - first, m) + np.arange(int(m.sum()))]
            found = np.searchsorted(self.key, asked)
            both = np.add.reduceat(self.key[np.minimum(found, len(self.key) - 1)] == asked, first, dtype=np.int64)
            out[may[lo:hi]] = 100 * both >= self.percent * (m + self.n[y[lo:hi]] - both)
            lo = hi
        return out


def _joined(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Join the classes of x and y; ``label`` has the least place of each place's class, before and after."""
    while True:
        a, b = label[x], label[y]
        differ = a != b
        if not differ.any():
            return
        x, y = x[differ], y[differ]
        np.minimum.at(label, np.maximum(a, b)[differ], np.minimum(a, b)[differ])
        while True:
            deeper = label[label]
            if (deeper == label).all():
                break
            label[:] = deeper


def tied(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): each member (range, sig, node, sorted ``shingles``) that has a link, and the smallest node that its links lead to in the task.

    A link joins two members of one signature whose sets reach ``percent``. One
    row a node leaves a task, however many links a group has: pairs are made
    ``PAIRS_AT_ONCE`` at a time, and those whose members links have joined
    already are not judged. Signatures of a range are dealt anew, as members
    with their sets are longer.
    """
    def run(table: pa.Table) -> pa.Table:
        sig = table.column("sig").to_numpy() | (table.column("range").to_numpy() << 32)
        node, first, at = np.unique(table.column("node").to_numpy(), return_index=True, return_inverse=True)
        held = table.column("shingles").combine_chunks().take(pa.array(first))
        sets = Sets(held.flatten().to_numpy(), np.concatenate([[0], np.cumsum(held.value_lengths().to_numpy(), dtype=np.int64)]), percent)
        order = np.lexsort((at, sig))
        order = order[_fresh(sig[order], at[order])]
        sig, at = sig[order], at[order]
        label = np.arange(len(node))
        hub = at[np.maximum.accumulate(np.where(_fresh(sig), np.arange(len(sig)), 0))]
        right = hub != at
        right[right] = sets.linked(at[right], hub[right])
        _joined(label, at[right], hub[right])
        order = np.lexsort((label[at], sig))
        for x, y in _blocks(at[order], label[at[order]], sig[order]):
            differ = label[x] != label[y]
            x, y = x[differ], y[differ]
            right = sets.linked(x, y)
            _joined(label, x[right], y[right])
        several = np.flatnonzero(label != np.arange(len(node)))
        return pa.table({"a": pa.array(node[several]), "b": pa.array(node[label[several]])})

    dealt = members.withColumn("part", F.expr(f"shiftleft(range, {PART_BITS}) | shiftright(sig, {32 - PART_BITS})"))
    return dealt.groupBy("part").applyInArrow(run, "a bigint, b bigint")
