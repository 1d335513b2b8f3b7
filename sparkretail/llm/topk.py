"""Exact top-k by inner product: dual-tree search over cover trees.

Vectors are dealt to cells around pivots, and large cells into blocks of bounded size by a
hash, so one frequent vector fills many blocks. Queries go in chunks of neighbouring
cells. First each query meets the blocks of its own cell, which gives it a k-th score.
Then a query goes to the blocks of another cell only if the cell's radius leaves room for
a score as good as that. A task holds one chunk and one block: it builds a cover tree over
each and walks both together, dropping a pair of nodes when their centres and covering
radii bound every inner product below the worst k-th score of the query group.

All bounds are valid for every vector, so nothing that belongs to a result is pruned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkretail.llm.common import durable

PIVOTS = 64
BLOCK_ROWS = 16_384
CHUNK_ROWS = 2_048
LEAF = 128
FAN = 16
EXACT = 2.0**53


def quantised(column: str = "embedding", factor: int = 64) -> Column:
    """floor(factor * x) of each component as double; null unless all are finite numbers."""
    x = F.col(column)

    def finite(v: Column) -> Column:
        wide = v.cast("double")
        return v.isNotNull() & ~F.isnan(wide) & (F.abs(wide) != F.lit(float("inf")))

    good = F.forall(x, lambda v: F.coalesce(finite(v), F.lit(False)))
    return F.when(good, F.transform(x, lambda v: F.floor(v.cast("double") * factor).cast("double")))


class Tree:
    """A cover tree over the rows of ``x``. Each node has a centre among its rows and the
    exact radius that covers them; rows of a node are a slice of ``order``."""

    def __init__(self, x: np.ndarray):
        self.order = np.arange(len(x))
        self.nodes: list[tuple] = []  # start, end, centre, norm of the centre, radius, children
        self.x = x
        if len(x):
            self._build(0, len(x), 0)
        self.x = x[self.order]

    def _build(self, start: int, end: int, centre: int) -> int:
        """Node over order[start:end]; ``centre`` is the row at its centre."""
        rows = self.order[start:end]
        at = self.x[centre]
        distance = np.sqrt(np.maximum(((self.x[rows] - at) ** 2).sum(1), 0))
        radius = float(distance.max())
        number = len(self.nodes)
        self.nodes.append(None)
        children = []
        if len(rows) > LEAF and radius > 0:
            # Greedy net of half the radius, the centre first; beyond FAN points the rest
            # goes to the nearest, and that child's radius says how far it reaches.
            nearest, owner, centres = distance, np.zeros(len(rows), np.int64), [centre]
            while len(centres) < FAN and nearest.max() > radius / 2:
                far = int(nearest.argmax())
                centres.append(int(rows[far]))
                to_new = np.sqrt(((self.x[rows] - self.x[rows[far]]) ** 2).sum(1))
                owner = np.where(to_new < nearest, len(centres) - 1, owner)
                nearest = np.minimum(nearest, to_new)
            if len(centres) > 1:
                by_owner = np.argsort(owner, kind="stable")
                self.order[start:end] = rows[by_owner]
                edges = np.searchsorted(owner[by_owner], np.arange(len(centres) + 1))
                for k, c in enumerate(centres):
                    if edges[k] < edges[k + 1]:
                        children.append(self._build(start + int(edges[k]), start + int(edges[k + 1]), c))
        self.nodes[number] = (start, end, at, float(np.sqrt((at**2).sum())), radius, children)
        return number


def dual_search(
    queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, data_ids: np.ndarray, k: int, floor: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(scores, ids), each queries x k, by falling score and rising id; -inf where fewer.

    ``floor`` is a score per query that its k-th result is known to reach. A row does not
    find itself: equal ids do not match.
    """
    if len(queries) == 0 or len(data) == 0:
        return np.full((len(queries), k), -np.inf), np.zeros((len(queries), k), np.int64)
    left, right = Tree(queries), Tree(data)
    ids, own, least = data_ids[right.order], query_ids[left.order], floor[left.order].astype(float)
    top = np.full((len(queries), k), -np.inf)
    who = np.full((len(queries), k), np.iinfo(np.int64).max)
    big = float(np.abs(queries).max()) * float(np.abs(data).max()) * queries.shape[1]
    exact_left = left.x if big < EXACT else left.x.astype(np.int64)
    exact_right = right.x if big < EXACT else right.x.astype(np.int64)

    def bound(q: tuple, d: tuple) -> float:
        most = float(q[2] @ d[2]) + q[4] * d[3] + d[4] * q[3] + q[4] * d[4]
        return most + 1e-9 * (abs(most) + (q[3] + q[4]) * (d[3] + d[4])) + 1e-6

    def meet(q: tuple, d: tuple) -> None:
        rows = slice(q[0], q[1])
        found = (exact_left[rows] @ exact_right[d[0] : d[1]].T).astype(float)
        found[own[rows][:, None] == ids[None, d[0] : d[1]]] = -np.inf
        better = np.flatnonzero((found >= least[rows][:, None]).any(1) & (found > -np.inf).any(1))
        if not len(better):
            return
        at = better + q[0]
        scores = np.hstack([top[at], found[better]])
        names = np.hstack([who[at], np.broadcast_to(ids[d[0] : d[1]], (len(at), d[1] - d[0]))])
        names = np.where(scores > -np.inf, names, np.iinfo(np.int64).max)
        order = np.lexsort((names, -scores), axis=-1)[:, :k]
        top[at] = np.take_along_axis(scores, order, 1)
        who[at] = np.take_along_axis(names, order, 1)
        least[at] = np.maximum(least[at], top[at][:, k - 1])

    stack = [(0, 0)]
    while stack:
        i, j = stack.pop()
        q, d = left.nodes[i], right.nodes[j]
        if bound(q, d) < least[q[0] : q[1]].min():
            continue
        if not q[5] and not d[5]:
            meet(q, d)
        elif not d[5] or (q[5] and q[4] > d[4]):
            stack += [(c, j) for c in q[5]]
        else:  # the most promising child last, so that it is taken first
            stack += [(i, c) for c in sorted(d[5], key=lambda c: bound(q, right.nodes[c]))]
    back = np.empty(len(queries), np.int64)
    back[left.order] = np.arange(len(queries))
    return top[back], who[back]


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _assign(pivots: np.ndarray):
    """Adds the nearest pivot of each vector and its distance; -1 for another dimension."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            cell, reach = np.full(len(sizes), -1), np.zeros(len(sizes))
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                x = _matrix(lists.take(pa.array(rows))) if dim else np.zeros((len(rows), 0))
                if len(pivots) and dim == pivots.shape[1]:
                    near = (x**2).sum(1)[:, None] - 2 * x @ pivots.T + (pivots**2).sum(1)[None]
                    cell[rows] = near.argmin(1)
                    reach[rows] = np.sqrt(((x - pivots[cell[rows]]) ** 2).sum(1))
                else:
                    reach[rows] = np.sqrt((x**2).sum(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists, pa.array(sizes, pa.int32()), pa.array(cell, pa.int32()), pa.array(reach)],
                names=["vec_id", "v", "dim", "cell", "reach"],
            )

    return assign


def _search(k: int):
    def search(table: pa.Table) -> pa.Table:
        is_query = pc.equal(table.column("side"), 0)
        asked, data = table.filter(is_query), table.filter(pc.invert(is_query))
        if len(asked) and len(data) and table.column("dim")[0].as_py():
            query_ids = asked.column("vec_id").to_numpy()
            scores, ids = dual_search(
                _matrix(asked.column("v")), query_ids, _matrix(data.column("v")),
                data.column("vec_id").to_numpy(), k, asked.column("floor").to_numpy(),
            )
        elif len(asked) and len(data):  # vectors without components: all scores are 0
            query_ids = asked.column("vec_id").to_numpy()
            scores, ids = dual_search(
                np.zeros((len(asked), 1)), query_ids, np.zeros((len(data), 1)),
                data.column("vec_id").to_numpy(), k, asked.column("floor").to_numpy(),
            )
        else:
            query_ids, scores, ids = np.zeros(0, np.int64), np.zeros((0, k)), np.zeros((0, k), np.int64)
        row, column = np.nonzero(scores > -np.inf)
        return pa.table(
            {"query_id": pa.array(query_ids[row], pa.int64()), "vec_id": pa.array(ids[row, column], pa.int64()),
             "score": pa.array(scores[row, column].astype(np.int64))}
        )

    return search


def _reachable(pivots: np.ndarray, radii: dict[int, float]):
    """For each query the other cells that may hold a vector as good as its k-th score."""

    def reachable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.array(sorted(c for c in radii if c >= 0), np.int64)
        centres, radius = pivots[cells], np.array([radii[c] for c in cells.tolist()])
        for batch in batches:
            floor, home = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            out = [[] for _ in range(len(floor))]
            rows = np.flatnonzero(home >= 0)
            if len(rows) and len(cells):
                x = _matrix(batch.column(1).take(pa.array(rows)))
                norm = np.sqrt((x**2).sum(1))
                most = x @ centres.T + norm[:, None] * radius[None]
                most += 1e-9 * np.abs(most) + 1e-6
                open_ = (most >= floor[rows][:, None]) & (cells[None] != home[rows][:, None])
                for i, r in enumerate(rows):
                    out[r] = cells[open_[i]].tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.list_(pa.int32()))], names=[*batch.schema.names, "targets"]
            )

    return reachable


def top_k(
    vectors: DataFrame,
    queries: Column,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows for which ``queries`` holds, against all
    other rows: the ``k`` highest inner products of the quantised vectors, ties to the
    smaller id; all of them if there are fewer.

    Rows without an id, with a null vector, or with a null or non-finite component take no
    part. Only vectors of equal dimension are compared. An id that repeats counts as one
    row, with the greatest of its vectors. Other columns are ignored; an empty table gives
    an empty result. Scores are exact below 2^53.
    """
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), quantised(vector_column).alias("v"),
        F.coalesce(queries, F.lit(False)).alias("asked"),
    ).where("vec_id IS NOT NULL AND v IS NOT NULL")
    if rows.groupBy("vec_id").count().where("count > 1").limit(1).count():
        rows = rows.groupBy("vec_id").agg(F.max("v").alias("v"), F.max("asked").alias("asked"))
    asked_ids = rows.where("asked").select("vec_id")
    sample = rows.select("vec_id", "v").orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).collect()
    sizes = [len(r[1]) for r in sample if len(r[1])]
    dim = max(set(sizes), key=lambda s: (sizes.count(s), s), default=1)  # the usual dimension
    pivots = np.array([r[1] for r in sample if len(r[1]) == dim], float).reshape(-1, dim)
    placed = durable(
        rows.select("vec_id", "v").mapInArrow(
            _assign(pivots), "vec_id long, v array<double>, dim int, cell int, reach double"
        )
    )
    asked = durable(placed.join(asked_ids, "vec_id", "left_semi"))
    cells = placed.groupBy("dim", "cell").agg(F.count("*").alias("rows"), F.max("reach").alias("radius"))
    in_queries = asked.groupBy("dim", "cell").agg(F.count("*").alias("asked"))
    # One row per pivot, and one for each other dimension that occurs.
    stats = cells.join(in_queries, ["dim", "cell"], "left").fillna(0, ["asked"]).orderBy("dim", "cell").collect()
    # Chunks hold queries of neighbouring cells; a cell with many fills several.
    deal, before, last_dim = {}, 0, None
    for r in stats:
        before = 0 if r["dim"] != last_dim else before
        last_dim = r["dim"]
        deal[r["dim"], r["cell"]] = (max(1, math.ceil(r["rows"] / BLOCK_ROWS)), before, max(1, r["asked"]))
        before += r["asked"]
    spark = vectors.sparkSession
    layout = spark.createDataFrame(
        [(d, c, *v) for (d, c), v in deal.items()], "dim int, cell int, blocks int, start long, asked long"
    )
    chunk = F.floor((F.col("start") + F.pmod(F.xxhash64("vec_id"), F.col("asked"))) / CHUNK_ROWS).cast("int")
    asked = asked.join(F.broadcast(layout), ["dim", "cell"]).withColumn("chunk", chunk)
    block = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")
    data = placed.join(F.broadcast(layout), ["dim", "cell"]).withColumn("block", block)

    def run(wanted: DataFrame) -> DataFrame:
        """Searches ``wanted(vec_id, v, dim, chunk, floor, target)`` in the target cells."""
        pairs = wanted.select("dim", "chunk", F.col("target").alias("cell")).distinct()
        blocks = F.broadcast(layout.select("dim", F.col("cell").alias("target"), F.col("blocks").alias("n")))
        left = (
            wanted.join(blocks, ["dim", "target"])
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
            .select("dim", "chunk", F.col("target").alias("cell"), "block", "vec_id", "v", "floor", F.lit(0).alias("side"))
        )
        # A row per chunk and cell that meet: each block goes to the chunks that ask for it.
        right = data.join(pairs, ["dim", "cell"]).select(
            "dim", "chunk", "cell", "block", "vec_id", "v", F.lit(0.0).alias("floor"), F.lit(1).alias("side")
        )
        return (
            left.unionByName(right)
            .groupBy("dim", "chunk", "cell", "block")
            .applyInArrow(_search(k), "query_id long, vec_id long, score long")
        )

    none = F.lit(float("-inf"))
    first = durable(run(asked.withColumn("floor", none).withColumn("target", F.col("cell"))))
    by_rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = (
        first.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") == k)
        .select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("floor"))
    )
    radii = {r["cell"]: r["radius"] for r in stats if r["dim"] == dim}
    more = (
        asked.join(kth, "vec_id", "left")
        .select("vec_id", "v", F.coalesce("floor", none).alias("floor"), "cell", "dim", "chunk")
        .mapInArrow(
            _reachable(pivots, radii),
            "vec_id long, v array<double>, floor double, cell int, dim int, chunk int, targets array<int>",
        )
        .withColumn("target", F.explode("targets"))
    )
    found = first.unionByName(run(durable(more.drop("targets", "cell"))))
    return (
        found.withColumn("rank", F.row_number().over(by_rank))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
