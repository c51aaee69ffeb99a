"""k-nearest-neighbour imputation (M8).

Rules: features are the other numeric columns that are at least 80 % present
on the rows needing imputation; such rows missing a feature are dropped;
distance is Euclidean over features scaled by the reference rows' population
sd; a gap is filled with the plain mean of its k nearest references' values
(equal distances: smallest tie key first).

Plan: an exact join over cells of space. The cells are the leaves of a tree of
median splits, planned on a bounded sample of the references; the sample
decides the work, never the result. Every distinct query first looks into its
own cell, which gives it a distance that its k-th neighbour can't exceed, then
into the cells whose boxes reach within that distance, and no others. Within a
cell, references and queries meet in blocks of bounded size, each block pair
keeping k per query, and a ranked window keeps the best k of all blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesmith.functions.types import is_numeric_type, require_numeric
from tablesmith.session import staged

#: References of one cell, about, and the most cells; beyond, cells grow and are joined in more blocks.
CELL_ROWS = 2_000
MAX_CELLS = 4_096
#: Most references and queries, about, that meet in one task's group.
BLOCK_REFS = 20_000
BLOCK_QUERIES = 20_000
#: References that the splits are planned on, about.
SAMPLE_ROWS = 50_000


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _all(columns, test) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & test(_c(c))
    return out


@dataclass
class Cells:
    """A tree of splits: node i sends values of ``axis[i]`` below ``cut[i]`` to ``low[i]``, others to ``high[i]``; ~cell marks a leaf."""

    axis: np.ndarray
    cut: np.ndarray
    low: np.ndarray
    high: np.ndarray
    count: int

    @classmethod
    def plan(cls, points: np.ndarray, scale: np.ndarray, leaves: int) -> Cells:
        """Median splits along the widest scaled axis, the largest part first, until there are ``leaves`` parts or only equal points."""
        axis, cut, low, high = [], [], [], []
        parts, done, n = [(points, None)], [], 1
        while parts and n < leaves:
            parts.sort(key=lambda p: len(p[0]))
            rows, parent = parts.pop()
            spread = np.ptp(rows, axis=0) * scale if len(rows) > 1 else np.zeros(points.shape[1])
            if not spread.max() > 0:
                done.append((rows, parent))
                continue
            k = int(spread.argmax())
            at = float(np.median(rows[:, k]))
            if at <= rows[:, k].min():
                at = float(rows[rows[:, k] > at, k].min())
            node = len(axis)
            axis.append(k)
            cut.append(at)
            low.append(0)
            high.append(0)
            if parent is not None:
                (low if parent[1] else high)[parent[0]] = node
            below = rows[:, k] < at
            parts += [(rows[below], (node, True)), (rows[~below], (node, False))]
            n += 1
        for cell, (_, parent) in enumerate(parts + done):
            if parent is not None:
                (low if parent[1] else high)[parent[0]] = ~cell
        return cls(np.array(axis, dtype=np.int64), np.array(cut), np.array(low, dtype=np.int64), np.array(high, dtype=np.int64), len(parts) + len(done))

    def of(self, points: np.ndarray) -> np.ndarray:
        """The cell of each point."""
        at = np.zeros(len(points), dtype=np.int64) if len(self.axis) else np.full(len(points), -1)
        while (live := np.flatnonzero(at >= 0)).size:
            node = at[live]
            at[live] = np.where(points[live, self.axis[node]] < self.cut[node], self.low[node], self.high[node])
        return ~at


def _distances(a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Squared scaled distances of rows of ``a`` to rows of ``b``, features added up in order."""
    out = np.zeros((len(a), len(b)))
    for f in range(a.shape[1]):
        d = a[:, f][:, None] - b[:, f][None, :]
        out += d * d * weight[f]
    return out


def _box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared scaled distance of each point to the nearest and to the farthest place of each box."""
    near, far = np.zeros((len(points), len(low))), np.zeros((len(points), len(low)))
    for f in range(points.shape[1]):
        x = points[:, f][:, None]
        d = np.maximum(np.maximum(low[:, f] - x, x - high[:, f]), 0)
        near += d * d * weight[f]
        d = np.maximum(np.abs(x - low[:, f]), np.abs(high[:, f] - x))
        far += d * d * weight[f]
    return near, far


def nearest(refs: DataFrame, queries: DataFrame, features: list[str], values: list[str], key: Column, k: int,
            cell_rows: int = CELL_ROWS, block_refs: int = BLOCK_REFS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(f0..., key, d2, v0...): the exact k nearest references of every distinct query, features and values by their order.

    ``d2`` is the squared distance over features scaled by the references' sd
    (a constant feature counts unscaled); equal distances are taken by key,
    smallest first. Features must not be null. Of references with equal
    features only the k with the smallest keys can be neighbours, so a value
    that a third of all rows share costs no more than any other.
    """
    nf, nv = len(features), len(values)
    fcols, vcols = [f"f{i}" for i in range(nf)], [f"v{j}" for j in range(nv)]
    spark = refs.sparkSession
    sc = spark.sparkContext
    plain = refs.select(key.cast("long").alias("key"), *[_c(c).cast("double").alias(f) for c, f in zip(features, fcols, strict=True)],
                        *[_c(c).cast("double").alias(v) for c, v in zip(values, vcols, strict=True)])
    stats = plain.agg(F.count("*").alias("n"), *[F.var_pop(f).alias(f) for f in fcols]).first()
    weight = np.array([1.0 / stats[f] if stats[f] else 1.0 for f in fcols])
    alike = Window.partitionBy(*fcols).orderBy("key")
    kept = staged(plain.withColumn("place", F.row_number().over(alike)).where(F.col("place") <= k).drop("place"), "knn-references")

    leaves = int(min(MAX_CELLS, max(1, stats["n"] // cell_rows)))
    share = min(1.0, SAMPLE_ROWS / max(stats["n"], 1))
    sampled = kept.select(*fcols).sample(share, seed=7).limit(2 * SAMPLE_ROWS).collect() if leaves > 1 else []
    cells = Cells.plan(np.array(sampled, dtype=float).reshape(-1, nf), np.sqrt(weight), leaves)
    tree = sc.broadcast(cells)

    @F.pandas_udf("int")
    def cell_of(*columns: pd.Series) -> pd.Series:
        return pd.Series(tree.value.of(np.column_stack([c.to_numpy() for c in columns])).astype(np.int32))

    asked = queries.select(*[_c(c).cast("double").alias(f) for c, f in zip(features, fcols, strict=True)]).distinct()
    asked = staged(asked.withColumn("q", F.monotonically_increasing_id()).withColumn("cell", cell_of(*fcols)), "knn-queries")
    placed = staged(kept.withColumn("cell", cell_of(*fcols)), "knn-references")
    # one row a cell, MAX_CELLS at most
    boxes = placed.groupBy("cell").agg(F.count("*").alias("n"), *[g(f).alias(f"{n}_{f}") for f in fcols for n, g in (("low", F.min), ("high", F.max))]).orderBy("cell").collect()
    if not boxes:
        return spark.createDataFrame([], ", ".join([*[f"{f} double" for f in fcols], "key long", "d2 double", *[f"{v} double" for v in vcols]]))
    numbers, sizes = np.array([b["cell"] for b in boxes]), np.array([b["n"] for b in boxes])
    low, high = (np.array([[b[f"{side}_{f}"] for f in fcols] for b in boxes]) for side in ("low", "high"))
    space = sc.broadcast((numbers, sizes, low, high))
    ref_blocks = {int(c): int(-(-n // block_refs)) for c, n in zip(numbers, sizes, strict=True)}

    def blocked(rows: DataFrame, counts: list[tuple], own: str, other: str, deal: Column) -> DataFrame:
        """``rows`` dealt to their cell's own blocks, once for each block of the other side. A row a cell is broadcast."""
        plan = spark.createDataFrame(counts, f"cell int, {own}s int, {other}s int") if counts else spark.createDataFrame([], f"cell int, {own}s int, {other}s int")
        return (rows.join(F.broadcast(plan), "cell").withColumn(own, F.pmod(deal, F.col(f"{own}s")).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1))).drop(f"{own}s", f"{other}s"))

    def meet(pairs: DataFrame) -> DataFrame:
        """(q, key, d2, values): of (q, cell, features) pairs, the best k of each block pair."""
        counts = [(r["cell"], int(-(-r["count"] // block_queries)), ref_blocks[r["cell"]])
                  for r in pairs.groupBy("cell").count().collect() if r["cell"] in ref_blocks]
        q = blocked(pairs, counts, "query_block", "ref_block", F.xxhash64("q"))
        r = blocked(placed, [(c, n, m) for c, m, n in counts], "ref_block", "query_block", F.xxhash64("key", *fcols))
        on = ["cell", "ref_block", "query_block"]

        def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            names = ["q", "key", "d2", *vcols]
            if left.empty or right.empty:
                return pd.DataFrame({n: np.zeros(0, dtype=np.int64 if n in ("q", "key") else float) for n in names})
            points, keys, kept_values = right[fcols].to_numpy(), right["key"].to_numpy(), right[vcols].to_numpy()
            wanted, ids, out = left[fcols].to_numpy(), left["q"].to_numpy(), []
            few = min(k, len(points))
            step = max(1, 2_000_000 // len(points))
            for a in range(0, len(wanted), step):
                d2 = _distances(wanted[a: a + step], points, weight)
                row, col = np.nonzero(d2 <= np.partition(d2, few - 1, axis=1)[:, few - 1: few])
                order = np.lexsort((keys[col], d2[row, col], row))
                row, col = row[order], col[order]
                first = np.searchsorted(row, np.arange(len(d2)))
                within = np.arange(len(row)) - first[row] < few
                out.append((ids[a: a + step][row[within]], keys[col[within]], d2[row[within], col[within]], kept_values[col[within]]))
            q_ids, q_keys, q_d2, q_values = (np.concatenate(x) for x in zip(*out, strict=True))
            return pd.DataFrame({"q": q_ids, "key": q_keys, "d2": q_d2, **{v: q_values[:, j] for j, v in enumerate(vcols)}})

        schema = "q long, key long, d2 double" + "".join(f", {v} double" for v in vcols)
        return q.groupBy(*on).cogroup(r.groupBy(*on)).applyInPandas(best, schema)

    def top(found: DataFrame) -> DataFrame:
        nearest_first = Window.partitionBy("q").orderBy("d2", "key")
        return found.withColumn("place", F.row_number().over(nearest_first)).where(F.col("place") <= k)

    own = staged(top(meet(asked)), "knn-own")
    reach = own.where(F.col("place") == k).select("q", F.col("d2").alias("reach"))

    def others(batches):
        """The cells beside its own that a query has to look into."""
        where, held, lows, highs = space.value
        for pdf in batches:
            for a in range(0, len(pdf), 1024):
                part = pdf.iloc[a: a + 1024]
                near, far = _box_distances(part[fcols].to_numpy(), lows, highs, weight)
                # without k references at hand: the distance within which whole boxes hold k
                by_far = np.argsort(far, axis=1)
                enough = np.cumsum(held[by_far], axis=1) >= k
                at = by_far[np.arange(len(part)), np.where(enough.any(axis=1), enough.argmax(axis=1), len(where) - 1)]
                bound = np.where(enough.any(axis=1), far[np.arange(len(part)), at], np.inf)
                limit = np.fmin(part["reach"].to_numpy(dtype=float, na_value=np.nan), bound) * (1 + 1e-9)
                row, col = np.nonzero((near <= limit[:, None]) & (where[None, :] != part["cell"].to_numpy()[:, None]))
                yield pd.DataFrame({"q": part["q"].to_numpy()[row], "cell": where[col].astype(np.int32),
                                    **{f: part[f].to_numpy()[row] for f in fcols}})

    wider = asked.join(reach, "q", "left").mapInPandas(others, "q long, cell int" + "".join(f", {f} double" for f in fcols))
    found = top(own.drop("place").unionByName(meet(staged(wider, "knn-reached"))))
    return found.join(asked.select("q", *fcols), "q").select(*fcols, "key", "d2", *vcols)


def knn_impute(df: DataFrame, columns, k: int = 5, tie_key: str | None = None, cell_rows: int = CELL_ROWS):
    """Returns ``(DataFrame, warning or None)``. Without a tie key, equal distances go by a hash of the row."""
    columns = list(columns)
    require_numeric(df, columns)
    others = [f.name for f in df.schema.fields if f.name not in columns and is_numeric_type(f.dataType)]
    if not others:
        raise ValueError(f"Nothing to measure distances on: {columns} are the only numeric columns.")
    need = ~_all(columns, lambda c: c.isNotNull())
    stats = df.filter(need).agg(F.count("*").alias("n"), *[F.count(_c(c)).alias(f"v{i}") for i, c in enumerate(others)]).first()
    n_need = stats["n"]
    if n_need == 0:
        return df, None
    feats = [c for i, c in enumerate(others) if stats[f"v{i}"] / n_need >= 0.80]
    if not feats:
        raise ValueError(f"No numeric column is filled in at least 80 % of the {n_need} rows that lack {columns}.")
    feat_ok = _all(feats, lambda c: c.isNotNull())
    n_can = df.filter(need & feat_ok).count()
    warning = None
    if n_can / n_need < 0.5:
        warning = (f"{n_need - n_can} of {n_need} rows without {columns} also lack one of {feats}; "
                   f"they are dropped, and {n_can} ({n_can / n_need:.1%}) are filled.")
    whole = df.filter(~need)
    if n_can == 0:
        return whole, warning
    refs, gaps = whole.filter(feat_ok), df.filter(need & feat_ok)
    key = _c(tie_key) if tie_key else F.xxhash64(*[_c(c) for c in df.columns])
    found = nearest(refs, gaps, feats, columns, key, k, cell_rows)
    at = [f"at {i}" for i in range(len(feats))]
    means = (found.groupBy(*[F.col(f"f{i}").alias(a) for i, a in enumerate(at)])
             .agg(*[F.avg(f"v{j}").alias(f"mean {j}") for j in range(len(columns))]))
    means = staged(means, "knn-means")
    if means.isEmpty():
        raise ValueError(f"No complete row to learn {columns} from.")
    same = F.lit(True)
    for c, a in zip(feats, at, strict=True):
        same = same & (_c(c).cast("double") == _c(a))
    filled = gaps.join(means, same, "left")
    names = {c: F.coalesce(_c(c).cast("double"), _c(f"mean {i}")) for i, c in enumerate(columns)}
    return (whole.select(*[_c(c).cast("double").alias(c) if c in names else _c(c) for c in df.columns])
            .unionByName(filled.select(*[names[c].alias(c) if c in names else _c(c) for c in df.columns]))), warning
