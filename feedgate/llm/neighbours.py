"""Operator 5: nearest neighbours by low-dimensional stable projections and a kd-tree.

Vectors are normalised, so the largest cosine is the smallest Euclidean distance, and projected to M dimensions
by independent Gaussians (2-stable): the squared projected distance over the squared distance follows a
chi-square law with M degrees. Projected points are split into cells by a kd-tree fitted on a bounded sample
and, inside a cell, into the leaves of a full kd-tree. A query walks leaves in order of their projected
distance, computes exact cosines, and stops at a leaf so far that a nearer vector than its k-th best would lie
there with probability below 1 - CONFIDENCE by the chi-square law.

A first round searches each query's own cell for a bound on the distance; a second one walks the tree of the cells' bounds
from its root and sends the query to those other cells the test does not rule out. All rows are indexed, cells are dealt in blocks of bounded size, and
the results of the blocks are merged by rank.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows without ``vec_id``,
take no part. Vectors of different length are never neighbours. Equal vectors are searched once: only the
k + 1 smallest ids of a vector can be among anyone's nearest, as ties go to smaller ids. Repeated rows count
once. A ``vec_id`` with several vectors keeps them all as candidates, and is searched with its smallest vector. Extra
columns are not read. With fewer than k candidates all are returned. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedgate.plans.workspace import Workspace

M = 8
CONFIDENCE = 0.98
NEAREST = 5
EVERY = 50
SEED = 7
SAMPLE = 4096
CELL_ROWS = 4096
MOST_CELLS = 1 << 16
LEAF = 64
QUERY_BLOCK = 512


def chi_square(x: np.ndarray, m: int = M) -> np.ndarray:
    """The chi-square distribution function for even m."""
    half = np.minimum(np.asarray(x, float) / 2, 700.0)
    return 1 - np.exp(-half) * sum(half**i / math.factorial(i) for i in range(m // 2))


def projection(size: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((size, M))


def _unit(vectors: pd.Series) -> np.ndarray:
    rows = np.stack([np.asarray(v, np.float64) for v in vectors])
    # By a power of two, so exactly: the squares of very small or large components would be zero or infinite.
    rows = np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1))[1][:, None])
    return rows / np.sqrt((rows * rows).sum(axis=1))[:, None]


def splits(points: np.ndarray, cells: int) -> list[tuple[int, float, int, int]]:
    """A kd-tree over the sample as (axis, value, left, right); a negative child c is cell -c - 1."""
    tree: list = []
    count = 0

    def grow(rows: np.ndarray, wanted: int) -> int:
        nonlocal count
        if wanted <= 1 or len(rows) < 2 or not (spread := np.ptp(points[rows], axis=0)).any():
            count += 1
            return -count
        axis = int(spread.argmax())
        value = float(np.median(points[rows, axis]))
        low = points[rows, axis] < value
        if not low.any():
            low = points[rows, axis] <= value
            value = float(np.nextafter(value, np.inf))
        at = len(tree)
        tree.append(None)
        left = grow(rows[low], wanted // 2)
        tree[at] = (axis, value, left, grow(rows[~low], wanted - wanted // 2))
        return at

    root = grow(np.arange(len(points)), cells)
    return tree if root >= 0 else []


def cell_of(tree: list, points: np.ndarray) -> np.ndarray:
    out = np.zeros(len(points), np.int64)
    todo = [(0, np.arange(len(points)))] if tree else []
    while todo:
        at, rows = todo.pop()
        if at < 0:
            out[rows] = -at - 1
            continue
        axis, value, left, right = tree[at]
        low = points[rows, axis] < value
        todo += [(left, rows[low]), (right, rows[~low])]
    return out


class Boxes:
    """The cells of one kd-tree with the bounds of the rows they hold, and of every branch above them.

    One row per cell, of which there are MOST_CELLS at most.
    """

    def __init__(self, tree: list, cells: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.tree = tree
        self.at = {int(c): i for i, c in enumerate(cells)}
        self.low, self.high = low, high
        self.branches: dict[int, tuple[np.ndarray, np.ndarray] | None] = {}
        for branch in range(len(tree) - 1, -1, -1):  # children come after their branch
            sides = [b for child in tree[branch][2:] if (b := self.bounds(child)) is not None]
            self.branches[branch] = tuple(f(np.stack(x), axis=0) for f, x in zip((np.min, np.max), zip(*sides, strict=True), strict=True)) if sides else None

    def bounds(self, node: int) -> tuple[np.ndarray, np.ndarray] | None:
        if node >= 0 and self.tree:
            return self.branches[node]
        i = self.at.get(-node - 1 if self.tree else 0)
        return None if i is None else (self.low[i], self.high[i])

    def within(self, point: np.ndarray, bound: float, home: int) -> list[int]:
        """Cells but the home one that a nearer vector than ``bound`` may lie in, by the chi-square law; nearest branches alone are opened."""
        near = math.inf if math.isnan(bound) else max(2 - 2 * bound, 1e-30)
        found, todo = [], [0]
        while todo:
            node = todo.pop()
            box = self.bounds(node)
            if box is None:
                continue
            gap = np.maximum(np.maximum(box[0] - point, point - box[1]), 0)
            if chi_square(float(gap @ gap) / near) > CONFIDENCE:
                continue
            if node >= 0 and self.tree:
                todo += self.tree[node][2:]
            elif (cell := -node - 1 if self.tree else 0) != home:
                found.append(cell)
        return found


def leaves(points: np.ndarray) -> list[np.ndarray]:
    """Rows of the leaves of a kd-tree with median splits."""
    done, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) <= LEAF:
            done.append(rows)
            continue
        axis = int(np.ptp(points[rows], axis=0).argmax())
        order = rows[np.argpartition(points[rows, axis], len(rows) // 2)]
        todo += [order[: len(rows) // 2], order[len(rows) // 2 :]]
    return done


def search(ids, vectors, points, query_ids, queries, query_points, bounds, k: int) -> list[tuple[int, int, float]]:
    """(query, id, cosine) of the k best of one block for each query. ``bounds``: k-th best cosine known so far."""
    parts = leaves(points)
    low = np.stack([points[p].min(axis=0) for p in parts])
    high = np.stack([points[p].max(axis=0) for p in parts])
    found = []
    for q in range(len(query_ids)):
        gap = np.maximum(np.maximum(low - query_points[q], query_points[q] - high), 0)
        away = (gap * gap).sum(axis=1)
        best: list[tuple[float, int]] = []
        bound = bounds[q]
        for leaf in np.argsort(away, kind="stable"):
            near = 2 - 2 * bound if not np.isnan(bound) else math.inf
            if away[leaf] > 0 and (near <= 0 or chi_square(away[leaf] / near) > CONFIDENCE):
                break
            rows = parts[leaf]
            cosine = (vectors[rows] * queries[q]).sum(axis=1)
            for i in np.flatnonzero(cosine >= (bound - 1e-12 if not np.isnan(bound) else -np.inf)):
                if ids[rows[i]] != query_ids[q]:
                    best.append((-float(cosine[i]), int(ids[rows[i]])))
            best = sorted(best)[:k]
            if len(best) == k:
                bound = np.fmax(bound, -best[-1][0])
        found += [(int(query_ids[q]), i, -c) for c, i in best]
    return found


def _block(k: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        is_query = rows["query"].to_numpy()
        data, asked = rows[~is_query], rows[is_query]
        out: list = []
        if len(data) and len(asked):
            unit, own = _unit(data["vector"]), _unit(asked["vector"])
            axes = projection(unit.shape[1])
            out = search(
                data["vec_id"].to_numpy(), unit, unit @ axes,
                asked["vec_id"].to_numpy(), own, own @ axes, asked["bound"].to_numpy(), k,
            )
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return run


BLOCK = "query_id long, vec_id long, score double"


def _clean(vectors: DataFrame) -> DataFrame:
    """``vec_id, vector`` of usable rows, as doubles."""
    vector = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    finite = "forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    return rows.where(f"vec_id is not null and vector is not null and {finite} and exists(vector, x -> x <> 0)")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(best)).where(f"rank <= {k}")


def nearest(vectors: DataFrame, k: int = NEAREST, every: int = EVERY) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k nearest of every row whose id ``every`` divides."""
    spark = vectors.sparkSession
    keep = Workspace(spark, "neighbours").keep
    rows = _clean(vectors)
    same = Window.partitionBy("vector").orderBy("vec_id")
    distinct = rows.distinct().withColumn("copy", F.row_number().over(same)).where(f"copy <= {k + 1}")
    base = keep("base", distinct.select("vec_id", "vector", F.size("vector").alias("size")))
    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = keep("asked", asked.withColumn("size", F.size("vector")))

    # A kd-tree over a bounded sample, per vector length: SAMPLE rows of each, by hash.
    counts = {r["size"]: r["count"] for r in base.groupBy("size").count().collect()}
    trees: dict[int, list] = {}
    boxes: dict[int, int] = {}
    for size, count in counts.items():
        sample = base.where(F.col("size") == size).orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector")
        points = _unit(sample.toPandas()["vector"]) @ projection(size)
        boxes[size] = min(MOST_CELLS, max(1, 2 ** round(math.log2(max(1, count / CELL_ROWS)))))
        trees[size] = splits(points, boxes[size])
    handle = spark.sparkContext.broadcast(trees)

    @F.pandas_udf("long")
    def cell(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            out = np.zeros(len(part), np.int64)
            sizes = np.array([len(v) for v in part], np.int64)
            for size in np.unique(sizes):
                mine = np.flatnonzero(sizes == size)
                points = _unit(part.iloc[mine]) @ projection(int(size))
                out[mine] = cell_of(handle.value.get(int(size), []), points)
            yield pd.Series(out)

    base = keep("cells", base.withColumn("cell", cell("vector")))
    # A cell that the sample did not foresee to be large is dealt in blocks too.
    sizes = keep("sizes", base.groupBy("size", "cell").agg(F.ceil(F.count("*") / (2 * CELL_ROWS)).cast("int").alias("blocks")))
    placed = base.join(sizes, ["size", "cell"]).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    side = ["size", "cell", "block", "part", "query", "vec_id", "vector", "bound"]
    asked = asked.withColumn("home", cell("vector"))
    parts = asked.agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("parts")).first().parts or 1
    asked = keep("homes", asked.withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(parts)).cast("int")))

    def blocks(data: DataFrame, queries: DataFrame) -> DataFrame:
        """Pairs of a block of rows and a block of queries, each within its own size."""
        wanted = keep_pairs(queries.select("size", "cell", "block", "part").distinct())
        left = data.join(wanted, ["size", "cell", "block"]).withColumn("query", F.lit(False)).withColumn("bound", F.lit(None).cast("double"))
        both = left.select(*side).unionByName(queries.withColumn("query", F.lit(True)).select(*side))
        return both.groupBy("size", "cell", "block", "part").applyInPandas(_block(k), BLOCK)

    turn = iter(range(10))

    def keep_pairs(df: DataFrame) -> DataFrame:
        return keep(f"pairs{next(turn)}", df)

    home = asked.withColumnRenamed("home", "cell").join(sizes, ["size", "cell"])
    home = home.withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)"))).withColumn("bound", F.lit(None).cast("double"))
    first = keep("first", _ranked(blocks(placed, home), k).select("query_id", "vec_id", "score"))

    bound = first.groupBy("query_id").agg(F.expr(f"case when count(*) >= {k} then min(score) end").alias("bound"))
    bound = keep("bounds", bound.withColumnRenamed("query_id", "vec_id"))
    box = [F.min(F.col("p")[i]).alias(f"low{i}") for i in range(M)] + [F.max(F.col("p")[i]).alias(f"high{i}") for i in range(M)]

    @F.pandas_udf("array<double>")
    def projected(part: pd.Series) -> pd.Series:
        return pd.Series([list(_unit(pd.Series([v]))[0] @ projection(len(v))) for v in part])

    # A row per cell, MOST_CELLS of them at most for each vector length.
    limits = base.withColumn("p", projected("vector")).groupBy("size", "cell").agg(*box).toPandas()
    found = {}
    for size, rows_of in limits.groupby("size"):
        low, high = (rows_of[[f"{side}{i}" for i in range(M)]].to_numpy(float) for side in ("low", "high"))
        found[int(size)] = Boxes(trees.get(int(size), []), rows_of["cell"].to_numpy(), low, high)
    walk = spark.sparkContext.broadcast(found)

    @F.pandas_udf("array<long>")
    def reached(points: pd.Series, sizes: pd.Series, bounds: pd.Series, homes: pd.Series) -> pd.Series:
        each = zip(points, sizes, bounds.astype(float), homes, strict=True)
        return pd.Series([walk.value[int(size)].within(np.asarray(p, float), bound, int(home)) for p, size, bound, home in each], dtype=object)

    others = (
        asked.join(bound, "vec_id", "left")
        .withColumn("p", projected("vector"))
        .withColumn("cell", F.explode(reached("p", "size", "bound", "home")))
        .join(sizes, ["size", "cell"])
        .withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
    )
    second = blocks(placed, keep("others", others.select("size", "cell", "block", "part", "vec_id", "vector", "bound")))
    return _ranked(first.unionByName(second), k).select("query_id", "rank", "vec_id", "score")
