"""Joins and searches against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkretail.llm import ngram_join, topk
from sparkretail.llm.components import components


def shingle_set(text, width=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def linked(rows, percent=75):
    sets, parent = [shingle_set(t) for _, t in rows], list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, len(sets[i]), low.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def corpus(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60 if seed % 2 else 400)]
    base = [[r.choice(words) for _ in range(r.choice([3, 6, 8, 20, 60, 200]))] for _ in range(15)]
    rows = [(1, None), (2, ""), (3, "  "), (None, "a b c d e f"), (None, "a b c d e f"), (4, "x " * 3000)]
    for i in range(150):
        text = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2, 4])):
            k = r.randrange(len(text) + 1)
            if r.random() < 0.5 and k < len(text):
                text[k] = r.choice([*words, f"u{r.random()}"])
            else:
                text.insert(k, r.choice(words))
        rows.append((100 + i, " ".join(text).upper() if r.random() < 0.1 else " ".join(text)))
    return rows


@pytest.mark.parametrize("seed", [0, 1])
def test_ngram_join_equals_all_pairs(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("cid", F.lit(1)).repartition(3)
    got = [tuple(r)[:3] for r in ngram_join.link_documents(docs).collect()]
    assert sorted(got, key=str) == linked(rows)


def test_allocation_covers_the_need():
    sets, size = np.full(20, 10.0), np.full(20, 30.0)
    members = np.arange(20.0) ** 3
    place, allocation = ngram_join.allocate(15, sets, size, members)
    used = np.argsort(place)
    assert set(allocation.tolist()) == {1, 2}
    assert np.cumsum(allocation[used])[14] >= 15


def test_one_row_of_each_group_stays(spark, monkeypatch):
    rows = [
        (1, None, "a"), (2, "", "b"), (2, "", "b"), (None, "p q r s t u", "d"), (None, "p q r s t u", "e"),
        (7, "A b c d e f", "f"), (7, "A b c d e f", "f"), (9, "a b c d e f", "g"), (10, "x y", "h"), (11, "x  Y", "i"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    for limit in (10, -1):  # sent to all tasks, and by a shuffled join
        monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", limit)
        kept = [tuple(r)[:2] for r in ngram_join.keep_one(docs).collect()]
        assert sorted(kept, key=str) == sorted(
            [(1, None), (2, ""), (2, ""), (None, "p q r s t u"), (7, "A b c d e f"), (10, "x y")], key=str
        )
    assert ngram_join.keep_one(docs.limit(0)).count() == 0
    more = docs.withColumn("_key", F.lit(7)).withColumn("_LOST_id", F.lit(8)).withColumn("_lost_key", F.lit(9))
    left = ngram_join.keep_one(more)
    assert left.columns == more.columns and {tuple(r)[-3:] for r in left.collect()} == {(7, 8, 9)}


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    got = {r.node: r.label for r in components(links).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


def test_top_k_equals_all_pairs(spark, monkeypatch):
    for name, value in (("LEAF", 16), ("BLOCK_ROWS", 64), ("CHUNK_ROWS", 8)):
        monkeypatch.setattr(topk, name, value)
    r = np.random.default_rng(0)
    rows = [(i, [float(x) for x in r.normal(size=8).round(1)]) for i in range(200)]
    rows += [(i, [0.5] * 8) for i in range(200, 320)]
    rows += [(500, None), (501, [1.0, None] * 4), (502, [float("nan")] * 8), (503, [float("inf")] * 8)]
    rows += [(None, [1.0] * 8), (520, [1.0, 2.0]), (540, [1.0, 3.0]), (560, []), *rows[:5]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit(0)).repartition(3)
    vectors = {
        i: np.floor(64 * np.array(v, np.float32).astype(float))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    }
    expected = []
    for i, q in vectors.items():
        if i % 20 == 0:
            best = sorted((-int(q @ v), j) for j, v in vectors.items() if j != i and len(v) == len(q))[:20]
            expected += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    got = [tuple(r) for r in topk.top_k(table, F.col("vec_id") % 20 == 0).collect()]
    assert sorted(got) == sorted(expected)
    assert topk.top_k(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0
