"""Vector codes against a comparison of every part with every entry."""

import numpy as np
import oracle
from pyspark.sql import functions as F

from sparkretail.llm import queries, vector_codes
from sparkretail.llm.vector_codes import Tree


def near(points, codebook):
    """The nearest entry of each point in whole numbers, ties to the lower index."""
    return ((points[:, None, :] - codebook[None]) ** 2).sum(2).argmin(1)


def plain(vectors, rounds=vector_codes.ROUNDS):
    """Codebooks and codes of (id, vector), sorted by id, by full comparison."""
    x = np.floor(np.array([v for _, v in vectors], float) * vector_codes.SCALE).astype(np.int64)
    width = x.shape[1] // 4
    codes, error, books = [], 0, []
    for k in range(4):
        part = x[:, k * width : (k + 1) * width]
        book = part[: vector_codes.ENTRIES].copy()
        for _ in range(rounds):
            to = near(part, book)
            for e in set(to.tolist()):
                book[e] = part[to == e].sum(0) // (to == e).sum()
        to = near(part, book)
        codes.append(to)
        books.append(book)
        error = error + ((part - book[to]) ** 2).sum(1)
    return ["".join(f"{c:02x}" for c in row) for row in zip(*codes)], error, vector_codes.digest(books)


def test_walk_assigns_as_full_comparison():
    r = np.random.default_rng(2)
    whole = 0
    for size in (1, 2, 7, 16, 17, 100, 777):
        for entries in (1, 2, 3, 50, 256):
            for spread in (0, 1, 40):
                centres = r.integers(-1000, 1000, (8, 5))
                points = centres[r.integers(0, 8, size)] + r.integers(-spread, spread + 1, (size, 5))
                codebook = centres[r.integers(0, 8, entries)] + r.integers(-spread, spread + 1, (entries, 5))
                tree = Tree(points, vector_codes.LEAF)
                stored = Tree.stored(tree.points.astype(np.int32).tobytes(), 5, size, vector_codes.LEAF)
                for held in (tree, stored):
                    to = vector_codes.assign(held, codebook)
                    assert (to == near(tree.points, codebook)).all()
                    sums, counts = np.zeros(codebook.shape, np.int64), np.zeros(entries, np.int64)
                    vector_codes.improve(held, codebook, sums, counts)
                    assert (counts == np.bincount(to, minlength=entries)).all()
                    assert all((sums[e] == tree.points[to == e].sum(0)).all() for e in range(entries))
                whole += sum(b - a > 1 and len(c) == 1 for _, _, a, b, c in vector_codes.walk(tree, Tree(codebook, 1)))
    assert whole > 100  # nodes are assigned by their sums


def test_bounds_leave_the_nearest_entry_and_prune():
    """On clustered parts most pairs are never compared."""
    r = np.random.default_rng(5)
    centres = r.integers(-20_000, 20_000, (40, 6))
    points = centres[r.integers(0, 40, 4000)] + r.integers(-30, 31, (4000, 6))
    codebook = points[:256]
    compared = sum((b - a) * len(c) for _, _, a, b, c in vector_codes.walk(Tree(points, 16), Tree(codebook, 1)) if len(c) > 1)
    assert compared < 0.1 * len(points) * len(codebook)


def test_odd_rows(spark):
    r = np.random.default_rng(1)
    rows = [(i, r.normal(size=8).tolist(), i % 3 if i % 5 else None) for i in range(300)]
    rows += [(2, rows[2][1], 1), (5, [0.0] * 8, None), (5, [0.0] * 8, None)]
    bad = [(1000, None, 1), (1001, [None] * 8, 1), (1002, [float("nan")] * 8, 1), (1003, [float("inf")] * 8, 1)]
    schema = "vec_id long, embedding array<double>, label int"
    df = spark.createDataFrame(rows + bad, schema).repartition(5).withColumn("n", F.lit(1)).withColumn("_part", F.lit(1))
    kept = sorted(rows, key=lambda x: (x[0], x[1]))
    codes, error, digest = plain([(i, v) for i, v, _ in kept])
    by_label = {}
    for (_, _, label), e in zip(kept, error.tolist(), strict=True):
        by_label[label] = by_label.get(label, 0) + e
    want = sorted((i, c, e, by_label[label], digest) for (i, _, label), c, e in zip(kept, codes, error.tolist(), strict=True))
    for hot in (1_000_000, 20):
        vector_codes.HOT_ROWS = hot
        assert sorted(tuple(x) for x in vector_codes.coded_vectors(df).collect()) == want
    vector_codes.HOT_ROWS = 1_000_000
    few = spark.createDataFrame(rows[:3], schema)
    codes, error, digest = plain([(i, v) for i, v, _ in rows[:3]])
    assert [(x.code, x.error, x.codebooks_sha256) for x in vector_codes.coded_vectors(few).orderBy("vec_id").collect()] == list(
        zip(codes, error.tolist(), [digest] * 3)
    )
    assert vector_codes.coded_vectors(df.limit(0)).count() == 0


def test_query_equals_sql(spark, sf):
    got = queries.op11_vector_codes(spark, sf)
    assert not oracle.compare(got, oracle.connect(sf), queries.ORACLES["op11_vector_codes"])
