"""Codes of vectors by codebooks that a dual-tree form of Lloyd's method improves.

Vectors are cut into parts; each part position has a codebook. Rows are taken in blocks
where they are read, and each block gets a tree over its parts, once: halves along the
widest side, with the box and the sum of every node. In each round a tree over the entries
is walked together with each block's tree. A pair of nodes is dropped when the least
distance of their boxes exceeds the greatest distance of the part's node to another node
of entries. A node with one entry left is assigned whole, by its cached sum; the parts of
leaves with several entries left are compared with these one by one.

All bounds and distances are whole numbers, so the result is that of comparing every part
with every entry. What leaves a task are sums per entry; codebooks have a fixed size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkretail.llm.common import durable

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
BLOCK = 4_096  # rows under one tree
LEAF = 16  # rows in a leaf at most
HOT_ROWS = 1_000_000  # a label with more rows is joined in several parts


def finite(column: str = "embedding") -> Column:
    """Whether a vector and all its components are there and finite."""

    def good(v: Column) -> Column:
        wide = v.cast("double")
        return F.coalesce(~F.isnan(wide) & (F.abs(wide) != F.lit(float("inf"))), F.lit(False))

    return F.coalesce(F.forall(F.col(column), good), F.lit(False))


class Tree:
    """Halves of ``points``, level by level: bounds[k] are the borders of the nodes of level
    k in ``order``, low[k] and high[k] their boxes, sums[k] their sums."""

    def __init__(self, points: np.ndarray, leaf: int):
        size = len(points)
        self.order = np.arange(size)
        self.bounds = [np.array([0, size])]
        while (self.bounds[-1][1:] - self.bounds[-1][:-1]).max(initial=0) > leaf:
            borders = [0]
            for a, b in zip(self.bounds[-1][:-1].tolist(), self.bounds[-1][1:].tolist()):
                middle = (a + b) // 2
                if b - a > 1:
                    rows = self.order[a:b]
                    held = points[rows]
                    side = int(np.argmax(held.max(0) - held.min(0))) if held.shape[1] else 0
                    key = held[:, side] if held.shape[1] else np.zeros(b - a)
                    self.order[a:b] = rows[np.argpartition(key, middle - a)]
                borders += [middle, b]
            self.bounds.append(np.array(borders))
        self.points = points[self.order]
        self.fill()

    def fill(self) -> None:
        """Boxes and sums, from the leaves up. Empty nodes have an inside-out box."""
        borders = self.bounds[-1]
        starts, full = borders[:-1], borders[1:] > borders[:-1]
        shape = (len(starts), self.points.shape[1])
        low, high, sums = np.full(shape, 1 << 40), np.full(shape, -(1 << 40)), np.zeros(shape, np.int64)
        if full.any():
            low[full] = np.minimum.reduceat(self.points, starts[full], axis=0)
            high[full] = np.maximum.reduceat(self.points, starts[full], axis=0)
            sums[full] = np.add.reduceat(self.points, starts[full], axis=0)
        self.low, self.high, self.sums = [low], [high], [sums]
        for _ in self.bounds[1:]:
            self.low.insert(0, np.minimum(self.low[0][::2], self.low[0][1::2]))
            self.high.insert(0, np.maximum(self.high[0][::2], self.high[0][1::2]))
            self.sums.insert(0, self.sums[0][::2] + self.sums[0][1::2])

    @classmethod
    def stored(cls, points: bytes, width: int, size: int, leaf: int) -> Tree:
        """A tree whose points come in its order; its borders follow from their number."""
        tree = cls.__new__(cls)
        tree.points = np.frombuffer(points, np.int32).astype(np.int64).reshape(size, width)
        tree.bounds = [np.array([0, size])]
        while (tree.bounds[-1][1:] - tree.bounds[-1][:-1]).max(initial=0) > leaf:
            last = tree.bounds[-1]
            tree.bounds.append(np.insert(last, np.arange(1, len(last)), (last[:-1] + last[1:]) // 2))
        tree.fill()
        return tree


def walk(parts: Tree, entries: Tree) -> Iterator[tuple[int, int, int, int, np.ndarray]]:
    """(level, node, from, to, entries) for nodes that together hold every part once: the
    entries, rising, that may be nearest to a part of the node. One for a node that is
    assigned whole; several only at leaves."""
    depth, entry_depth = len(parts.bounds) - 1, len(entries.bounds) - 1
    p, e, i, j = np.zeros(1, np.int64), np.zeros(1, np.int64), 0, 0
    while True:
        gap = np.maximum(parts.low[i][p] - entries.high[j][e], entries.low[j][e] - parts.high[i][p])
        reach = np.maximum(parts.high[i][p] - entries.low[j][e], entries.high[j][e] - parts.low[i][p])
        least, most = (np.maximum(gap, 0) ** 2).sum(1), (reach**2).sum(1)
        starts = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
        counts = np.diff(np.append(starts, len(p)))
        keep = least <= np.repeat(np.minimum.reduceat(most, starts), counts)
        p, e = p[keep], e[keep]
        if j == entry_depth:
            starts = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
            counts = np.diff(np.append(starts, len(p)))
            done = counts == 1 if i < depth else np.ones(len(counts), bool)
            for start, count in zip(starts[done].tolist(), counts[done].tolist()):
                node = int(p[start])
                a, b = int(parts.bounds[i][node]), int(parts.bounds[i][node + 1])
                found = entries.order[entries.bounds[j][e[start : start + count]]]
                yield i, node, a, b, np.sort(found)
            left = np.repeat(~done, counts)
            p, e = p[left], e[left]
            if not len(p):
                return
        if i < depth:
            i += 1
            p, e = np.concatenate((2 * p, 2 * p + 1)), np.concatenate((e, e))
            full = parts.bounds[i][p + 1] > parts.bounds[i][p]
            p, e = p[full], e[full]
        if j < entry_depth:
            j += 1
            p, e = np.concatenate((p, p)), np.concatenate((2 * e, 2 * e + 1))
            full = entries.bounds[j][e + 1] > entries.bounds[j][e]
            p, e = p[full], e[full]
        by_part = np.lexsort((e, p))
        p, e = p[by_part], e[by_part]


def nearest(points: np.ndarray, codebook: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The nearest chosen entry of each point, the first of equals."""
    centres = codebook[chosen]
    # Whole numbers below 2^53 are exact in floating point.
    kind = float if 4.0 * points.shape[1] * max(np.abs(points).max(), np.abs(centres).max()) ** 2 < 2**53 else np.int64
    points, centres = points.astype(kind), centres.astype(kind)
    return chosen[((centres**2).sum(1)[None] - 2 * points @ centres.T).argmin(1)]


def improve(parts: Tree, codebook: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> None:
    """Adds each part of the block to the sum and count of its nearest entry."""
    for level, node, a, b, chosen in walk(parts, Tree(codebook, 1)):
        if len(chosen) == 1:
            sums[chosen[0]] += parts.sums[level][node]
            counts[chosen[0]] += b - a
        else:
            held = parts.points[a:b]
            to = nearest(held, codebook, chosen)
            np.add.at(sums, to, held)
            counts += np.bincount(to, minlength=len(counts))


def assign(parts: Tree, codebook: np.ndarray) -> np.ndarray:
    """The nearest entry of each part of the block, in the order of the tree."""
    out = np.zeros(len(parts.points), np.int64)
    for _, _, a, b, chosen in walk(parts, Tree(codebook, 1)):
        out[a:b] = chosen[0] if len(chosen) == 1 else nearest(parts.points[a:b], codebook, chosen)
    return out


def _whole_numbers(vectors: pa.Array, dim: int) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)
    found = np.floor(flat * SCALE)
    if len(found) and 4 * dim * np.abs(found).max() ** 2 >= 2**62:
        raise ValueError("a component is too large for squared distances in 64 bits")
    return found.astype(np.int64).reshape(len(vectors), dim)


def _blocks(dim: int):
    """Blocks of rows: their keys, and per part the order and the points of its tree."""
    width = dim // PARTS

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), BLOCK):
                part = batch.slice(start, BLOCK)
                x = _whole_numbers(part.column(1), dim)
                if x.size and np.abs(x).max() >= 2**31:
                    raise ValueError("a component is too large for 32 bits")
                trees = [Tree(x[:, k * width : (k + 1) * width], LEAF) for k in range(PARTS)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part.column(0).to_pylist()], pa.list_(part.column(0).type)),
                        pa.array([[t.order.astype(np.int32).tobytes() for t in trees]], pa.list_(pa.binary())),
                        pa.array([[t.points.astype(np.int32).tobytes() for t in trees]], pa.list_(pa.binary())),
                    ],
                    names=["keys", "orders", "points"],
                )

    return blocks


def _trees(row: dict, width: int) -> list[Tree]:
    return [Tree.stored(p, width, len(row["keys"]), LEAF) for p in row["points"]]


def _next(codebooks: list[np.ndarray], found: list) -> list[np.ndarray]:
    """The mean of each entry's parts, rounded down; unused entries stay."""
    out = [c.copy() for c in codebooks]
    for r in found:
        out[r["part"]][r["entry"]] = [s // r["n"] for s in r["sums"]]
    return out


def train(blocks: DataFrame, codebooks: list[np.ndarray], rounds: int = ROUNDS) -> list[np.ndarray]:
    """Codebooks after some rounds over all blocks. A round reads the blocks once."""
    width = codebooks[0].shape[1]
    for _ in range(rounds):
        held = blocks.sparkSession.sparkContext.broadcast(codebooks)

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            books = held.value  # noqa: B023
            totals = [np.zeros(b.shape, np.int64) for b in books]
            counts = [np.zeros(len(b), np.int64) for b in books]
            for batch in batches:
                for row in batch.to_pylist():
                    for k, tree in enumerate(_trees(row, width)):
                        improve(tree, books[k], totals[k], counts[k])
            used = [(k, e) for k in range(PARTS) for e in np.flatnonzero(counts[k]).tolist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k for k, _ in used], pa.int32()), pa.array([e for _, e in used], pa.int32()),
                    pa.array([int(counts[k][e]) for k, e in used], pa.int64()),
                    pa.array([totals[k][e].tolist() for k, e in used], pa.list_(pa.int64())),
                ],
                names=["part", "entry", "n", "sums"],
            )

        per_task = blocks.mapInArrow(sums, "part int, entry int, n long, sums array<long>")
        total = F.array(*(F.sum(F.col("sums")[i]) for i in range(width))) if width else F.first("sums")
        found = per_task.groupBy("part", "entry").agg(F.sum("n").alias("n"), total.alias("sums")).collect()
        codebooks = _next(codebooks, found)
    return codebooks


def digest(codebooks: list[np.ndarray]) -> str:
    """SHA-256 of all components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(v) for b in codebooks for v in b.ravel().tolist()).encode()).hexdigest()


def compress(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label"
) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, entries, error) per vector and the codebooks: the number of the
    nearest entry for each part, and the sum of the squared distances to them.

    The first codebooks are the parts of the ``ENTRIES`` smallest ids, or of all rows if
    there are fewer; rows of one id stand in the order of their vectors, null ids last.
    Rows with a null vector, or a null or non-finite component, take no part, nor do rows of
    another dimension than the first of these; that must be a multiple of four. Repeated
    rows and null labels are rows like others; other columns are ignored; an empty table
    gives an empty result and empty codebooks. Whole numbers, components times 1024, must
    fit 32 bits and their squared distances 64, or an error is raised.
    """
    rows = vectors.where(finite(vector_column)).select(
        F.struct(F.col(id_column).alias("vec_id"), F.col(label_column).alias("label")).alias("key"),
        F.col(vector_column).alias("v"),
    )
    first = rows.orderBy(F.asc_nulls_last("key.vec_id"), "v").limit(ENTRIES).select("key", "v").collect()
    dim = len(first[0]["v"]) if first else 0
    if dim % PARTS:
        raise ValueError(f"vectors of {dim} components cannot be cut into {PARTS} equal parts")
    width = dim // PARTS
    chosen = [r["v"] for r in first if len(r["v"]) == dim]
    start = np.floor(np.array(chosen, float).reshape(len(chosen), dim) * SCALE).astype(np.int64)
    codebooks = [start[:, k * width : (k + 1) * width] for k in range(PARTS)]
    key_type = rows.schema["key"].dataType.simpleString()
    blocks = durable(
        rows.where(F.size("v") == dim).mapInArrow(
            _blocks(dim), f"keys array<{key_type}>, orders array<binary>, points array<binary>"
        )
    )
    codebooks = train(blocks, codebooks)
    held = vectors.sparkSession.sparkContext.broadcast(codebooks)

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.to_pylist()):
                entries = np.zeros((len(row["keys"]), PARTS), np.int32)
                error = np.zeros(len(row["keys"]), np.int64)
                for k, tree in enumerate(_trees(row, width)):
                    to = assign(tree, held.value[k])
                    order = np.frombuffer(row["orders"][k], np.int32)
                    entries[order, k] = to
                    error[order] += ((tree.points - held.value[k][to]) ** 2).sum(1)
                keys = pc.list_flatten(batch.column(0).slice(i, 1))
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(entries.tolist(), pa.list_(pa.int32())), pa.array(error)],
                    names=["key", "entries", "error"],
                )

    coded = blocks.mapInArrow(codes, f"key {key_type}, entries array<int>, error long")
    return coded.select("key.vec_id", "key.label", "entries", "error"), codebooks


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the error summed over equal labels, nulls together.

    Labels with more than ``HOT_ROWS`` rows, of which there can be one for each million
    rows at most, are sent out and joined in several parts.
    """
    sums = durable(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")))
    sums = sums.select(F.col("label").alias("_label"), "label_error", F.ceil(F.col("n") / HOT_ROWS).cast("int").alias("_parts"))
    hot = sums.where("_parts > 1").select(F.col("_label").alias("_hot"), F.col("_parts").alias("_n"))
    salt = F.pmod(F.xxhash64("vec_id", "entries"), F.coalesce("_n", F.lit(1))).cast("int")
    left = coded.join(F.broadcast(hot), F.col("label").eqNullSafe(F.col("_hot")), "left").withColumn("_salt", salt)
    right = sums.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    on = F.col("label").eqNullSafe(F.col("_label")) & (F.col("_salt") == F.col("_part"))
    return left.join(right, on).select(*coded.columns, "label_error")


def coded_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) per vector of ``compress``; a
    code is two hex digits for each part."""
    coded, codebooks = compress(vectors)
    code = F.array_join(F.transform("entries", lambda e: F.lpad(F.lower(F.hex(e)), 2, "0")), "")
    return with_label_errors(durable(coded)).select(
        "vec_id", code.alias("code"), "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256")
    )


def oracle() -> str:
    """The query in SQL: every part against every entry, round by round. The number of
    rounds is fixed, so they are written out."""
    good = "len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
    steps = [
        f"""
    kept AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY vec_id, embedding) AS row, vec_id, label,
            list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings WHERE embedding IS NOT NULL AND {good}),
    parts AS MATERIALIZED (
        SELECT row, vec_id, label, p, v[p * len(v) // {PARTS} + 1 : (p + 1) * len(v) // {PARTS}] AS v
        FROM kept, range({PARTS}) AS r(p)),
    book0 AS MATERIALIZED (SELECT p, row - 1 AS e, v FROM parts WHERE row <= {ENTRIES})"""
    ]
    distance = "list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for k in range(ROUNDS + 1):
        steps.append(f"""
    near{k} AS MATERIALIZED (
        SELECT row, p, any_value(vec_id) AS vec_id, any_value(label) AS label, any_value(v) AS v,
            min((d, e)) AS best
        FROM (SELECT a.row, a.p, a.vec_id, a.label, a.v, b.e, CAST({distance} AS BIGINT) AS d
              FROM parts AS a JOIN book{k} AS b ON a.p = b.p) GROUP BY row, p)""")
        if k < ROUNDS:
            steps.append(f"""
    mean{k} AS (
        SELECT p, e, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS v
        FROM (SELECT p, best[2] AS e, i, sum(v[i]) AS s, count(*) AS n
              FROM (SELECT p, best, v, unnest(range(1, len(v) + 1)) AS i FROM near{k}) GROUP BY p, best[2], i)
        GROUP BY p, e),
    book{k + 1} AS MATERIALIZED (
        SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book{k} AS b LEFT JOIN mean{k} AS m ON b.p = m.p AND b.e = m.e)""")
    return f"""WITH {",".join(steps)},
    digest AS (
        SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{ROUNDS}),
    coded AS (
        SELECT row, any_value(vec_id) AS vec_id, any_value(label) AS label,
            string_agg(lower(printf('%02x', best[2])), '' ORDER BY p) AS code, CAST(sum(best[1]) AS BIGINT) AS error
        FROM near{ROUNDS} GROUP BY row)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM coded, digest"""
