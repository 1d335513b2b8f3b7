"""Repair of conversations against a search over all edit scripts."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

from pyspark.sql import functions as F

from sparkretail.llm import conversations as c
from sparkretail.llm import queries
from sparkretail.session import conf_overlay


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        if not re.search(r"[^ \t\n\x0b\x0c\r]", text):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append(None if text.rstrip(" \t\n\x0b\x0c\r")[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def brute(rows):
    """Cheapest and then least script over (turn, role, text), by uniform-cost search."""
    faults = faults_of(rows)
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, roles, out = heapq.heappop(heap)
        if i == len(rows) and re.fullmatch(r"(s?(ua)+)?", roles):
            return cost, audit, "\n".join(f"{r}:{t}" for r, t in out)
        key = (i, roles[-1:] or "-")
        if key in done:  # the heap gives the least cost, then the least audit, of each state
            continue
        done.add(key)

        def go(cost2, letter, j, role, text):
            new = roles + role[:1]
            if role == "" or re.fullmatch(r"s?(ua)*u?", new):
                heapq.heappush(heap, (cost + cost2, audit + letter, j, new if role else roles, (*out, (role, text)) if role else out))

        for role in ("user", "assistant"):
            go(3, "I", i, role, "")
        if i < len(rows):
            _, role, text = rows[i]
            go(4, "D", i + 1, "", "")
            if faults[i] not in ("blank", "duplicate"):
                late = 3 if faults[i] else 0
                if role:
                    go(late, "K", i + 1, role, text)
                for other in ("user", "assistant"):
                    go(3 + late, "R", i + 1, other, text)
    raise AssertionError


def expected(rows):
    turns = [t for t, _, _ in rows if t is not None]
    faults = faults_of(rows)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    cost, audit, text = brute(rows)
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))


def random_rows(r, n):
    texts = ["Yes.", "No", "", " \n", "What?", "Go!  \t", "x" * 50]
    roles = ["user", "assistant", "system", "tool", "", "user", "assistant"]
    return [(r.choice([None, *range(n + 2)]), r.choice(roles), r.choice(texts) * r.choice([1, 1, r.randrange(1, 5)])) for _ in range(n)]


def test_traces_equal_a_search_over_all_scripts():
    r = random.Random(4)
    for _ in range(1500):
        rows = in_order(random_rows(r, r.randrange(14)))
        seen, symbols, faults = set(), bytearray(), []
        for _, role, text in rows:
            symbol, fault = c.judge(role, text, (role, text) in seen)
            seen.add((role, text))
            symbols.append(symbol)
            faults.append(fault)
        edits = list(c._edit_rows(rows, bytes(symbols), faults, c.START, c.tables().end, True))
        cost, audit, text = brute(rows)
        assert ("".join(e[1] for e in edits), sum(e[3] for e in edits)) == (audit, cost)
        assert "\n".join(f"{e[5]}:{e[6]}" for e in edits if e[1] != "D") == text
        assert c.tables().costs(bytes(symbols), c.tables().end)[c.START] == cost


def test_blocks_equal_single_steps():
    r, t = random.Random(1), c.tables()
    for _ in range(500):
        symbols = bytes(r.randrange(c.SYMBOLS) for _ in range(r.randrange(20)))
        v = r.randrange(len(t.vectors))
        vector = t.vectors[v]
        for s in reversed(symbols):
            vector = c.step(tuple(vector), s)[0]
        assert t.costs(symbols, v) == [min(x, c.BEYOND) for x in vector]


def reported(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_hot_conversations_span_partitions(spark):
    r = random.Random(9)
    rows = [(7, *row) for row in random_rows(r, 400)] + [(None, *row) for row in random_rows(r, 60)]
    rows += [(9, 1, "user", "Same.")] * 300
    rows += [(k, *row) for k in range(10, 40) for row in random_rows(r, r.randrange(1, 9))]
    want = {}
    for conv, group in itertools.groupby(rows, key=lambda x: x[0]):
        want[conv] = expected(in_order([row[1:] for row in group]))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.repartition(3).withColumn("part", F.lit("x")).withColumn("_row", F.lit(1))
    parts = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"}
    with conf_overlay(spark, parts):
        edits = c.repair(df)
        assert edits.groupBy("conv_id").agg(F.countDistinct("part").alias("n")).where("n > 2").count() >= 2
        assert reported(c.report(df)) == want
    assert reported(c.report(df)) == want


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, 2, "user", "Hi."), (2, None, "system", "Be."), ("long", 0, "user", "y" * 3_000_000)]
    df = spark.createDataFrame([(str(a), *b) for a, *b in rows], "conv_id string, turn int, role string, text string")
    got = reported(c.report(df))
    assert got["1"] == expected([(None, " ", " "), (2, "user", "Hi.")])
    assert got["2"] == expected([(None, "system", "Be.")])
    assert got["long"][5:7] == (4, "D")
    assert c.report(df.limit(0)).count() == 0 and c.repair(df.limit(0)).count() == 0


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if role is None else role), (" " if text is None else text)
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return in_order(out)


def test_query_equals_a_search_over_all_scripts(spark, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(None, None, None, None), (None, 3, "user", "Hi."), (10**6, 0, "user", None), (10**6, None, None, "A?")]
    lost = next(k for k in itertools.count(10**7) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    rows.append((lost, 0, "user", "Gone."))
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = reported(queries.op12_conversations(spark, str(tmp_path)))
    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    assert got == {conv: expected(damaged(group)) for conv, group in groups.items()}
    assert got[lost] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
