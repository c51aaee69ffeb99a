"""Correlation matrices (A17 Pearson, A18 Spearman, A19 Kendall tau-b).

Every method works per column pair on the rows where both values are present
(pairwise complete). All pairs travel in one long table keyed by pair id, so
each method is one pipeline whatever the number of columns.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesmith.functions.strips import STRIP_ROWS, Strips, number
from tablesmith.functions.types import numeric_columns, require_numeric
from tablesmith.session import staged

#: Strips a side of one block of cells.
GRID_BLOCK = 512
#: Ranks that one group of rows holds, about: rows by columns by kinds of partner.
BLOCK_RANKS = 1 << 22


def _c(name: str):
    return F.col(f"`{name}`")


def _pairs(columns):
    return list(itertools.combinations(columns, 2))


def _matrix_rows(df: DataFrame, df_pairs: DataFrame, columns, value_col: str) -> DataFrame:
    """Symmetric long matrix: (col_x, col_y, value) both ways from one pass over
    the pairs, plus the diagonal, which is missing for a constant column."""
    both = df_pairs.select(F.explode(F.array(
        F.struct("col_x", "col_y", value_col),
        F.struct(F.col("col_y").alias("col_x"), F.col("col_x").alias("col_y"), value_col))).alias("m")).select("m.*")
    varied = df.agg(*[(F.min(_c(c)) < F.max(_c(c))).alias(f"v{i}") for i, c in enumerate(columns)])
    diag = varied.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("col_x"), F.lit(c).alias("col_y"), F.when(F.col(f"v{i}"), F.lit(1.0)).alias(value_col))
        for i, c in enumerate(columns)])).alias("m")).select("m.*")
    return both.unionByName(diag)


def guarded_corr(x, y):
    """Pearson's r of the complete pairs; missing where a side is constant."""
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return F.when(spread > 0, F.covar_pop(x, y) / spread)


def pearson_matrix(df: DataFrame, columns=None) -> DataFrame:
    """All pairs in one aggregate, each on its complete rows."""
    cols = list(columns) if columns else numeric_columns(df)
    require_numeric(df, cols)
    pairs = _pairs(cols)
    if not pairs:
        return _matrix_rows(df, df.sparkSession.createDataFrame([], "col_x string, col_y string, r double"), cols, "r")
    row = df.agg(*[guarded_corr(_c(a).cast("double"), _c(b).cast("double")).alias(f"p{i}")
                   for i, (a, b) in enumerate(pairs)])
    long = row.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("col_x"), F.lit(b).alias("col_y"), F.col(f"p{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)])).alias("x")).select("x.*")
    return _matrix_rows(df, long, cols, "r")


def _named(df: DataFrame, pairs) -> DataFrame:
    each = F.array(*[F.struct(F.lit(i).alias("pair"), F.lit(a).alias("col_x"), F.lit(b).alias("col_y")) for i, (a, b) in enumerate(pairs)])
    return df.sparkSession.range(1).select(F.explode(each).alias("p")).select("p.*")


def _striped(df: DataFrame, cols: list[str], strip_rows: int) -> tuple[DataFrame, Strips]:
    """(rid, v0..., s0...) written once: the columns as doubles, and the strip of each value."""
    table = df.select(*[number(c).alias(f"v{k}") for k, c in enumerate(cols)])
    names = [f"v{k}" for k in range(len(cols))]
    rows = table.agg(*[F.count(c) for c in names]).first()
    strips = Strips.plan(table, names, max(rows), strip_rows)
    return staged(strips.added(table.withColumn("rid", F.monotonically_increasing_id()), names), "strips"), strips


def _key(a, strip) -> Column:
    """Column and strip as one number: rows sorted by one number need no comparisons."""
    return (a.cast("long") * (1 << 32) + strip).alias("key")


def _by_strip(table: DataFrame, n: int, carried: list[str]) -> DataFrame:
    """(key, carried...): every row once for each of its columns whose value lies in an open interval."""
    at = F.explode(F.array(*[F.struct(F.lit(k).alias("a"), F.col(f"s{k}").alias("strip")) for k in range(n)])).alias("at")
    return table.select(at, *carried).where("at.strip >= 0 AND at.strip % 2 = 0").select(_key(F.col("at.a"), F.col("at.strip")), *carried)


def spearman_matrix(df: DataFrame, columns=None, strip_rows: int = STRIP_ROWS) -> DataFrame:
    """Pearson correlation of average ranks, ranked per pair on that
    pair's complete rows (trap T17).

    A column's ranks differ between its partners only where a partner has
    gaps, so each value gets one rank for all complete partners and one for
    each partner with gaps. Ranks are counted within strips of values and
    raised by the totals of the strips below; a value that is a strip of its
    own has its rank from the totals alone. One regrouping by blocks of rows,
    ranks packed by block, then adds up the products of all pairs.
    """
    cols = list(columns) if columns else numeric_columns(df)
    require_numeric(df, cols)
    pairs = _pairs(cols)
    m = len(cols)
    if not pairs:
        return _matrix_rows(df, df.sparkSession.createDataFrame([], "col_x string, col_y string, rho double"), cols, "rho")
    table, _ = _striped(df, cols, strip_rows)
    gappy = table.agg(*[F.max(F.col(f"s{k}") < 0).alias(f"g{k}") for k in range(m)]).first()
    partial = [k for k in range(m) if gappy[k]]
    kinds = [F.lit(True), *[F.col(f"s{k}") >= 0 for k in partial]]  # partners: those without gaps, then each with gaps
    kind_of = [1 + partial.index(k) if k in partial else 0 for k in range(m)]
    at = F.explode(F.array(*[F.struct(F.lit(k).alias("a"), F.col(f"s{k}").alias("strip")) for k in range(m)])).alias("at")
    sizes = (table.select(at, *[c.alias(f"k{i}") for i, c in enumerate(kinds)]).where("at.strip >= 0").groupBy("at.a", "at.strip")
             .agg(*[F.count_if(f"k{i}").alias(f"n{i}") for i in range(len(kinds))]).collect())  # a row a column and strip
    totals: dict[int, list] = {k: [] for k in range(m)}
    for r in sizes:
        totals[r["a"]].append(list(r)[1:])
    below = {}
    for k, rows in totals.items():
        t = np.array(sorted(rows), dtype=float).reshape(-1, 1 + len(kinds))
        below[k] = (t[:, 0].astype(np.int64), np.cumsum(t[:, 1:], axis=0) - t[:, 1:], t[:, 1:])
    shared = df.sparkSession.sparkContext.broadcast(below)
    middle = {k: (b[2].sum(axis=0) + 1) / 2 for k, b in below.items()}
    n_kinds = len(kinds)
    flags = [f"k{i}" for i in range(1, n_kinds)]
    bits = max(1, (BLOCK_RANKS // (m * n_kinds)).bit_length() - 1)  # rows of a block, as a power of two
    both = [(cols.index(a), cols.index(b)) for a, b in pairs]

    def runs(rid: np.ndarray, a: int, values: np.ndarray) -> pa.Table:
        """(block, a, places, found): the values (a column a row) of each block's rows, packed."""
        order = np.argsort(rid)
        rid, values = rid[order], values[:, order]
        block = rid >> bits
        cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(rid)] if len(rid) else [0]
        place = (rid & ((1 << bits) - 1)).astype(np.int32)
        ends = list(itertools.pairwise(cuts))
        return pa.table({"block": pa.array([int(block[i]) for i, _ in ends], pa.int64()), "a": pa.array([a] * len(ends), pa.int32()),
                         "places": pa.array([place[i:j].tobytes() for i, j in ends], pa.binary()),
                         "found": pa.array([values[:, i:j].tobytes() for i, j in ends], pa.binary())})

    def leaf(group: pa.Table) -> pa.Table:
        """Centred ranks of one strip's rows, a row for each kind of partner."""
        k, strip = divmod(group.column("key")[0].as_py(), 1 << 32)
        strips, lower, _ = shared.value[k]
        start = lower[np.searchsorted(strips, strip)]
        v = group.column("v").to_numpy()
        order = np.argsort(v)
        v = v[order]
        first = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
        size = np.diff(np.append(first, len(v)))
        out = np.empty((n_kinds, len(v)))
        for i in range(n_kinds):
            t = size if not i else np.add.reduceat(group.column(flags[i - 1]).to_numpy()[order].astype(np.int64), first)
            out[i] = np.repeat(start[i] + np.cumsum(t) - t + (t + 1) / 2, size) - middle[k][i]
        return runs(group.column("rid").to_numpy()[order], k, out)

    def strips_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows' strips, as they are: those of single values have their ranks from the totals."""
        for batch in batches:
            yield from runs(batch.column(0).to_numpy(), -1, np.stack([batch.column(1 + k).to_numpy() for k in range(m)])).to_batches()

    def products(group: pa.Table) -> pa.Table:
        """Each pair's sums over one block of rows."""
        ranks = np.full((m, n_kinds, 1 << bits), np.nan)
        for k, places, found in zip(*(group.column(c).to_pylist() for c in ("a", "places", "found")), strict=True):
            place = np.frombuffer(places, dtype=np.int32)
            if k >= 0:
                ranks[k][:, place] = np.frombuffer(found).reshape(n_kinds, -1)
                continue
            for c, s in enumerate(np.frombuffer(found, dtype=np.int32).reshape(m, -1)):
                alone = np.flatnonzero(s % 2 == 1) if len(shared.value[c][0]) else []
                alone = [] if not len(alone) else alone[s[alone] > 0]
                if len(alone):
                    strips, lower, size = shared.value[c]
                    one = lower + (size + 1) / 2 - middle[c]
                    ranks[c][:, place[alone]] = one[np.searchsorted(strips, s[alone])].T
        here = ~np.isnan(ranks[:, 0])
        out = []
        for p, (i, j) in enumerate(both):
            complete = here[i] & here[j]
            x, y = np.where(complete, ranks[i][kind_of[j]], 0.0), np.where(complete, ranks[j][kind_of[i]], 0.0)
            out.append((p, *(float(np.einsum("i,i->", u, w)) for u, w in ((x, y), (x, x), (y, y)))))
        return pa.table(dict(zip(("pair", "xy", "xx", "yy"), map(list, zip(*out, strict=True)), strict=True)),
                        schema=pa.schema([("pair", pa.int32()), ("xy", pa.float64()), ("xx", pa.float64()), ("yy", pa.float64())]))

    packed = "block bigint, a int, places binary, found binary"
    cell = F.explode(F.array(*[F.struct(F.lit(k).alias("a"), F.col(f"s{k}").alias("strip"), F.col(f"v{k}").alias("v")) for k in range(m)])).alias("c")
    open_rows = (table.select(cell, "rid", *[c.alias(f"k{i}") for i, c in enumerate(kinds) if i])
                 .where("c.strip >= 0 AND c.strip % 2 = 0").select(_key(F.col("c.a"), F.col("c.strip")), "c.v", "rid", *flags))
    rows = open_rows.groupBy("key").applyInArrow(leaf, packed).unionByName(table.select("rid", *[f"s{k}" for k in range(m)]).mapInArrow(strips_of, packed))
    long = rows.groupBy("block").applyInArrow(products, "pair int, xy double, xx double, yy double").groupBy("pair").agg(*[F.sum(c).alias(c) for c in ("xy", "xx", "yy")])
    rho = F.when((F.col("xx") > 0) & (F.col("yy") > 0), F.col("xy") / F.sqrt(F.col("xx") * F.col("yy")))
    return _matrix_rows(df, _named(df, pairs).join(long.select("pair", rho.alias("rho")), "pair", "left").select("col_x", "col_y", "rho"), cols, "rho")


def inversions(ranks: np.ndarray) -> int:
    """Pairs of places whose later value is smaller, bit by bit: behind a common prefix, ones that stand before zeros."""
    if not len(ranks):
        return 0
    y = ranks.astype(np.int64) - int(ranks.min())
    place, count = np.arange(len(y)), 0
    for k in range(int(y.max()).bit_length() - 1, -1, -1):
        size = np.bincount(y >> (k + 1))  # rows stand sorted by these prefixes
        size = size[size > 0]
        first = np.cumsum(size) - size
        one = (y >> k) & 1
        ones = np.cumsum(one) - one
        before = ones - np.repeat(ones[first], size)
        zero = one == 0
        count += int(before[zero].sum())
        if k:
            zeros = np.repeat(size - np.add.reduceat(one, first) + first, size)  # where a prefix's ones begin
            after = np.empty_like(y)
            after[np.where(zero, place - before, zeros + before)] = y
            y = after
    return count


def _ties(values: np.ndarray) -> int:
    """Pairs of equal values."""
    n = np.unique(values, return_counts=True)[1]
    return int((n * (n - 1) // 2).sum())


def _dense(values: np.ndarray) -> tuple[np.ndarray, int]:
    """Dense ranks, and the pairs of equal values."""
    order = np.argsort(values)
    v = values[order]
    fresh = np.append(True, v[1:] != v[:-1])
    n = np.diff(np.append(np.flatnonzero(fresh), len(v)))
    out = np.empty(len(v), dtype=np.int64)
    out[order] = np.cumsum(fresh) - 1
    return out, int((n * (n - 1) // 2).sum())


def order_score(x: np.ndarray, y: np.ndarray) -> int:
    """Concordant minus discordant pairs; a pair that ties in either counts nothing."""
    n = len(x)
    if n < 2:
        return 0
    (x, tied_x), (y, tied_y) = _dense(x), _dense(y)
    width = int(y.max()) + 1
    key = np.sort(x * width + y)
    y = key % width
    both = np.diff(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])))
    tied_both = int((both * (both - 1) // 2).sum())
    differ = n * (n - 1) // 2 - tied_y
    return differ - (tied_x - tied_both) - 2 * inversions(y)  # within equal x the order is that of y: no inversions there


def _grid_score(pdf: pd.DataFrame) -> pd.DataFrame:
    """Score between rows of one block of cells that share neither strip."""
    grid = np.zeros((int(pdf["dx"].max()) + 1, int(pdf["dy"].max()) + 1))
    grid[pdf["dx"], pdf["dy"]] = pdf["w"]
    before = np.vstack([np.zeros((1, grid.shape[1])), grid.cumsum(axis=0)[:-1]])
    upto = before.cumsum(axis=1)
    lower, higher = upto - before, upto[:, -1:] - upto
    return pd.DataFrame({"pair": [int(pdf["pair"].iloc[0])], "s": [float((grid * (lower - higher)).sum())], "tx": [0.0], "ty": [0.0]})


def kendall_matrix(df: DataFrame, columns=None, strip_rows: int = STRIP_ROWS, block: int = GRID_BLOCK) -> DataFrame:
    """Tau-b per pair, exact at any size.

    Every column is cut into strips once. Rows are counted per pair of strips
    (map-side first); pairs of rows in different strips of both columns are
    scored from these cells, in blocks: the strips' numbers are written as
    digits, and the digits at which two rows first differ in x and in y name
    the one block of at most ``block`` squared cells that compares them. Pairs
    within one strip are scored in that strip's group, which serves all
    partners of its column: within an x strip by the values of both columns,
    within a y strip by the strips of x, so that none is counted twice. A
    value that is a strip of its own ties there and needs no group.

    Groups hold one block of cells or one open interval, about ``strip_rows``
    rows, or up to a million where a column would have more than 512 intervals.
    """
    cols = list(columns) if columns else numeric_columns(df)
    require_numeric(df, cols)
    pairs = _pairs(cols)
    m = len(cols)
    empty = df.sparkSession.createDataFrame([], "col_x string, col_y string, tau double")
    if not pairs:
        return _matrix_rows(df, empty, cols, "tau")
    table, strips = _striped(df, cols, strip_rows)
    place = {c: k for k, c in enumerate(cols)}
    number_of = {(place[a], place[b]): p for p, (a, b) in enumerate(pairs)}
    named = F.explode(F.array(*[F.struct(F.lit(p).alias("pair"), F.col(f"s{i}").alias("x"), F.col(f"s{j}").alias("y"))
                                for (i, j), p in number_of.items()])).alias("c")
    cells = staged(table.select(named).select("c.*").where("x >= 0 AND y >= 0").groupBy("pair", "x", "y").agg(F.count("*").cast("double").alias("w")), "cells")

    levels = 1
    while block ** levels < strips.width:
        levels += 1
    schema = "pair int, s double, tx double, ty double"
    scores = None
    for i in range(levels):
        for j in range(levels):
            ux, uy = block ** (levels - 1 - i), block ** (levels - 1 - j)
            digit = cells.select("pair", F.expr(f"x div {ux * block}").alias("px"), F.expr(f"(x div {ux}) % {block}").alias("dx"),
                                 F.expr(f"y div {uy * block}").alias("py"), F.expr(f"(y div {uy}) % {block}").alias("dy"), "w")
            if levels > 1:
                digit = digit.groupBy("pair", "px", "dx", "py", "dy").agg(F.sum("w").alias("w"))
            part = digit.groupBy("pair", "px", "py").applyInPandas(_grid_score, schema)
            scores = part if scores is None else scores.unionByName(part)

    shared = df.sparkSession.sparkContext.broadcast(strips)

    def leaf(pdf: pd.DataFrame) -> pd.DataFrame:
        a = int(pdf["key"].iloc[0]) >> 32
        values, out = pdf[f"v{a}"].to_numpy(), []
        for b in range(m):
            if b == a:
                continue
            other = pdf[f"v{b}"].to_numpy(dtype=float)
            here = ~np.isnan(other)
            own, other = values[here], other[here]
            ties = float(_ties(own))
            if a < b:
                out.append((number_of[a, b], float(order_score(own, other)), ties, 0.0))
            else:
                out.append((number_of[b, a], float(order_score(shared.value.of(b, other), own)), 0.0, ties))
        return pd.DataFrame(out, columns=["pair", "s", "tx", "ty"]).astype({"pair": np.int32})

    scores = scores.unionByName(_by_strip(table, m, [f"v{k}" for k in range(m)]).groupBy("key").applyInPandas(leaf, schema))
    for axis, s, other in (("x", "tx", "ty"), ("y", "ty", "tx")):  # values that are strips of their own
        t = F.col("t")
        alone = cells.where(f"{axis} % 2 = 1").groupBy("pair", axis).agg(F.sum("w").alias("t"))
        scores = scores.unionByName(alone.select("pair", F.lit(0.0).alias("s"), (t * (t - 1) / 2).alias(s), F.lit(0.0).alias(other)))
    total = cells.groupBy("pair").agg(F.sum("w").alias("n"))
    s = scores.groupBy("pair").agg(F.sum("s").alias("s"), F.sum("tx").alias("tx"), F.sum("ty").alias("ty"))
    all_pairs = F.col("n") * (F.col("n") - 1) / 2
    scale = F.sqrt((all_pairs - F.col("tx")) * (all_pairs - F.col("ty")))
    out = (_named(df, pairs).join(s, "pair", "left").join(total, "pair", "left")
           .select("col_x", "col_y", F.when(scale > 0, F.col("s") / scale).alias("tau")))
    return _matrix_rows(df, out, cols, "tau")


def correlation_matrix(df: DataFrame, columns=None, method: str = "pearson") -> DataFrame:
    if method == "pearson":
        return pearson_matrix(df, columns)
    if method == "spearman":
        return spearman_matrix(df, columns)
    if method == "kendall":
        return kendall_matrix(df, columns)
    raise ValueError(f"Unknown method: {method}")
