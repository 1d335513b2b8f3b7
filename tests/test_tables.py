"""Running values, versioned merges, rewritten folders and stateful streams."""

import datetime as dt
import itertools
import os
import random

import pytest
from pyspark.sql import functions as F

from sparkretail.operators import gate, hash_tree, running, sketches, versions
from sparkretail.session import profiled
from sparkretail.sources import colocated, compaction, readers, sinks
from sparkretail.streaming import attribution, events


# ---- running values ----
def plain_running(rows):
    """(id, key, at, n) -> running sum, number, n before, at after."""
    out = {}
    by_key = itertools.groupby(sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or 0, r[0])), key=lambda r: r[1])
    for _, group in by_key:
        group, total = list(group), None
        for i, (row, _, _, n) in enumerate(group):
            total = total if n is None else (total or 0) + n
            before = group[i - 1][3] if i else None
            after = group[i + 1][2] if i + 1 < len(group) else None
            out[row] = (total, i + 1, before, after)
    return out


def running_rows(r, n):
    hot = [(i, 7, r.choice([None, 3, r.randrange(n)]), r.choice([None, r.randrange(-5, 50)])) for i in range(n)]
    rest = [(n + i, r.choice([None, 1, 2, 3]), r.randrange(10), r.randrange(50)) for i in range(n // 2)]
    return hot + rest


@pytest.mark.parametrize("share", [10, 60, 10_000])
def test_running_values_of_hot_keys(spark, share):
    rows = running_rows(random.Random(share), 600)
    df = spark.createDataFrame(rows, "id long, key long, at long, n long").repartition(4)
    got = running.running(
        df, ["key"], ["at", "id"], {"total": "n"}, "number", {"before": "n"}, {"after": "at"}, rows_per_task=share
    )
    assert got.columns == ["id", "key", "at", "n", "total", "number", "before", "after"]
    assert {r.id: (r.total, r.number, r.before, r.after) for r in got.collect()} == plain_running(rows)


def test_no_piece_of_a_hot_key_holds_more_than_a_share(spark):
    df = spark.range(20_000).select(F.lit(1).alias("key"), (F.col("id") % 3).alias("at"), "id")
    pieces = running.in_pieces(df, ["key"], ["at", "id"], running.cut_points(df, ["key"], ["at", "id"], 1_000)).groupBy("_piece").count().collect()
    assert len(pieces) >= 15 and max(r["count"] for r in pieces) < 2_500
    assert sum(r["count"] for r in pieces) == 20_000


def test_hot_keys_go_through_windows_by_piece_and_small_broadcasts(spark):
    df = spark.range(5_000).select((F.col("id") % 2).alias("key"), "id")
    plan = readers.plan_text(running.running(df, ["key"], ["id"], number="n", rows_per_task=500))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    inside = [line for line in plan.splitlines() if "hashpartitioning(key" in line]
    assert any("_piece" in line for line in inside)  # the rows go to their piece, not to their key


def test_global_rank(spark):
    rows = [(i, (i * 37) % 11) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, v long").repartition(5)
    got = {r.id: r["rank"] for r in running.global_rank(df, ["v", "id"], rows_per_task=40).collect()}
    assert got == {i: k + 1 for k, (i, _) in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}
    assert running.global_rank(df.limit(0), ["v", "id"]).count() == 0
    with pytest.raises(ValueError, match="exist already"):
        running.global_rank(df, ["v"], name="v")


# ---- versions ----
LAYOUT = versions.Layout(keys=["k"], tracked=["a", "b"], latest=["c"], at="t", buckets=8)
SCHEMA = "k long, a string, b long, c long, t int, deleted boolean"


def plain_versions(change_sets):
    """Versions of all changes, later sets winning over earlier ones at one time."""
    said = {}
    for n, changes in enumerate(change_sets):
        for k, a, b, c, t, gone in changes:
            rank = (n, bool(gone), (a is not None, a or ""), (b is not None, b or 0))
            old = said.setdefault(k, {}).get(t)
            if old is None or old[0] <= rank:
                said[k][t] = (rank, a, b, bool(gone))
    newest = {}
    for n, changes in enumerate(change_sets):
        for k, _, _, c, t, gone in changes:
            if not gone:
                newest[k] = max(newest.get(k, (-1, 0, None)), (t, n, c))
    out = set()
    for k, by_time in said.items():
        kept, before = [], None
        for t in sorted(by_time):
            _, a, b, gone = by_time[t]
            says = None if gone else (a, b)
            if says != before:
                kept.append((t, says))
            before = says
        for i, (t, says) in enumerate(kept):
            if says is not None:
                out.add((k, *says, newest[k][2], t, kept[i + 1][0] if i + 1 < len(kept) else None))
    return out


def stored(spark, path):
    rows = spark.read.parquet(path).select("k", "a", "b", "c", "valid_from", "valid_to").collect()
    assert len(rows) == len({tuple(r) for r in rows})
    return {tuple(r) for r in rows}


def changes(r, n, times, k=6):
    """Changes with distinct values for each time, so that none repeats the one before."""
    found = {(r.choice([None, *range(k)]), r.choice(times)) for _ in range(n)}
    return [(key, r.choice(["x", "y", None]), t, r.randrange(9), t, r.random() < 0.2) for key, t in sorted(found, key=str)]


@pytest.mark.parametrize("seed", range(3))
def test_merges_in_steps_equal_one_rebuild(spark, tmp_path, seed):
    r = random.Random(seed)
    sets = [changes(r, 40, range(0, 10)), changes(r, 30, range(10, 20)), changes(r, 30, range(20, 30))]
    sets[1] += sets[1][:5]
    path = str(tmp_path / "t")
    df = [spark.createDataFrame(s, SCHEMA) for s in sets]
    versions.create(df[0], path, LAYOUT)
    for batch in df[1:]:
        versions.merge(spark, path, batch, LAYOUT)
    assert stored(spark, path) == plain_versions(sets)
    before = stored(spark, path)
    versions.merge(spark, path, df[2], LAYOUT)
    assert stored(spark, path) == before


def test_late_changes_corrections_and_deletions(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.create(spark.createDataFrame([(1, "x", 1, 10, 1, False), (2, "x", 1, 10, 1, None)], SCHEMA), path, LAYOUT)
    one = [(1, "y", 1, 50, 9, False), (2, None, None, None, 5, True), (3, None, None, None, 5, True)]
    versions.merge(spark, path, spark.createDataFrame(one, SCHEMA), LAYOUT)
    assert stored(spark, path) == {(1, "x", 1, 50, 1, 9), (1, "y", 1, 50, 9, None), (2, "x", 1, 10, 1, 5)}
    # Late: its tracked values find their place, its type 1 value is older than what is known.
    two = [(1, "z", 1, 30, 4, False), (2, "x", 1, 70, 7, False), (2, "w", 1, 60, 1, False)]
    versions.merge(spark, path, spark.createDataFrame(two, SCHEMA), LAYOUT)
    assert stored(spark, path) == {
        (1, "x", 1, 50, 1, 4), (1, "z", 1, 50, 4, 9), (1, "y", 1, 50, 9, None),
        (2, "w", 1, 70, 1, 5), (2, "x", 1, 70, 7, None),
    }


def files(path):
    return {
        os.path.join(folder, name): os.stat(os.path.join(folder, name)).st_mtime_ns
        for folder, _, names in os.walk(path) for name in names if name.endswith(".parquet")
    }


def test_a_merge_rewrites_only_touched_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(k, "x", k, 1, 1, False) for k in range(200)]
    versions.create(spark.createDataFrame(rows, SCHEMA), path, LAYOUT)
    before = files(path)
    touched = versions.merge(spark, path, spark.createDataFrame([(5, "y", 5, 1, 2, False)], SCHEMA), LAYOUT)
    after = files(path)
    folder = f"bucket={touched[0]}"
    assert len(touched) == 1 and len({os.path.dirname(f) for f in before}) == 8
    same = {f: t for f, t in before.items() if folder not in f}
    assert {f: t for f, t in after.items() if folder not in f} == same
    assert len(stored(spark, path)) == 201


def test_a_hot_key_is_merged_in_pieces(spark, tmp_path):
    path = str(tmp_path / "t")
    first = [(1, "xy"[t % 2], 0, t, t, False) for t in range(0, 400, 2)] + [(2, "x", 0, 0, 0, False)]
    second = [(1, "z", 0, t, t, False) for t in range(1, 400, 2)]
    versions.create(spark.createDataFrame(first, SCHEMA), path, LAYOUT, rows_per_task=50)
    versions.merge(spark, path, spark.createDataFrame(second, SCHEMA), LAYOUT, rows_per_task=50)
    got = stored(spark, path)
    assert (1, "x", 0, 399, 0, None if len(got) < 3 else 1) in got
    chain = sorted(r for r in got if r[0] == 1)
    assert all(a[5] == b[4] for a, b in itertools.pairwise(sorted(chain, key=lambda r: r[4])))
    # The first set says "x" throughout, so only its beginning was kept.
    assert len(got) == 3


def test_row_hash_tells_apart_what_joined_text_would_not(spark):
    rows = [("a|b", None), ("a", "b|"), ("a", None), (None, "a"), ("-", None), (None, None)]
    df = spark.createDataFrame(rows, "a string, b string").select(versions.row_hash(["a", "b"]).alias("h"))
    assert df.distinct().count() == len(rows)


def test_upsert_ignores_older_changes(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.create_latest(spark.createDataFrame([(1, "x", 1, 1, 5, False), (1, "w", 1, 1, 4, False)], SCHEMA), path, LAYOUT)
    for _ in range(2):
        versions.upsert(spark, path, spark.createDataFrame([(1, "y", 1, 1, 3, False), (2, "y", 1, 1, 3, False)], SCHEMA), LAYOUT)
    versions.upsert(spark, path, spark.createDataFrame([(2, None, None, None, 6, True)], SCHEMA), LAYOUT)
    versions.upsert(spark, path, spark.createDataFrame([(2, "v", 1, 1, 5, False)], SCHEMA), LAYOUT)
    assert [tuple(r) for r in versions.live(spark, path, LAYOUT).collect()] == [(1, "x", 1, 1, 5)]


# ---- rewritten folders ----
def test_only_the_written_folders_change(spark, tmp_path):
    path = str(tmp_path / "months")
    df = spark.range(1_000).select("id", (F.col("id") % 5).cast("string").alias("month"))
    sinks.write_partitioned(df, ["month"], path, max_records=100)
    before = files(path)
    part = df.where("month = '3' AND id > 500")
    for _ in range(2):
        sinks.overwrite_partitions(part, ["month"], path, max_records=100)
        after = files(path)
        assert {f: t for f, t in after.items() if "month=3" not in f} == {f: t for f, t in before.items() if "month=3" not in f}
        assert spark.read.parquet(path).where("month = '3'").count() == part.count()
    assert not set(f for f in after if "month=3" in f) & set(before)


# ---- streams ----
SCHEMA_EVENTS = "event_id bigint, ts timestamp, event_type string, cents bigint"


def event(i, seconds, kind="a"):
    return i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds), kind, 1


def write_batches(spark, path, batches):
    for n, rows in enumerate(batches):
        df = spark.createDataFrame(rows, SCHEMA_EVENTS).withColumn("slice", F.lit(0))
        attribution.write_slices(df, "slice", 1, path, append=n > 0)


def test_closed_windows_drop_late_rows_and_leave_the_state(spark, tmp_path):
    hours = [[event(60 * h + i, 3600 * h + 60 * i, "ab"[i % 2]) for i in range(60)] for h in range(6)]
    hours[4].append(event(1000, 30, "a"))  # four hours late
    hours[1].append(event(1001, 3500, "a"))  # its hour is still open
    write_batches(spark, f"{tmp_path}/in", hours)
    stream = readers.stream_files(profiled(spark, "streaming"), f"{tmp_path}/in", SCHEMA_EVENTS)
    totals = events.windowed_totals(stream, "ts", ["event_type"], "1 hour", "10 minutes", {"cents": "cents"})
    progress = events.drain(totals, f"{tmp_path}/out", f"{tmp_path}/checkpoint", 3)
    got = {(r.start.hour, r.event_type): r.n_rows for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {(h, k): 30 + (h == 0 and k == "a") for h in range(5) for k in "ab"}
    state = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    dropped = sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in progress if p["stateOperators"])
    assert dropped == 1
    assert max(state) <= 4 and state[-1] == 2  # two hours at most are open, then only the last


def test_a_stopped_stream_equals_one_that_ran_on(spark, tmp_path):
    batches = [[event(i, 60 * i) for i in range(20 * n, 20 * n + 20)] for n in range(4)]
    for n in range(1, 4):
        batches[n] += batches[n - 1][::3]  # come again one batch later, also over the stop
    results = {}
    for name, stops in (("on", [4]), ("stopped", [1, 2, 3, 4])):
        source, out, checkpoint = (f"{tmp_path}/{name}-{x}" for x in ("in", "out", "checkpoint"))
        done = 0
        for stop in stops:
            for n in range(done, stop):
                df = spark.createDataFrame(batches[n], SCHEMA_EVENTS).withColumn("slice", F.lit(0))
                attribution.write_slices(df, "slice", 1, source, append=n > 0)
            done = stop
            stream = readers.stream_files(profiled(spark, "streaming"), source, SCHEMA_EVENTS)
            events.drain(events.first_arrivals(stream, "ts", ["event_id"], "2 hours"), out, checkpoint, 3)
        results[name] = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert results["on"] == results["stopped"] == sorted(event(i, 60 * i) for i in range(80))


# ---- quarantine ----
def test_rows_are_split_by_one_job_with_counts(spark, tmp_path):
    rules = {"positive": F.col("n") > 0, "small": F.col("n") < 10, "named": F.col("name") != ""}
    rows = [(1, "a"), (0, "b"), (20, ""), (None, "c"), (5, None), (7, "d"), (7, "d")]
    df = spark.createDataFrame(rows, "n long, name string")
    counts = gate.split_valid(df, rules, f"{tmp_path}/out")
    assert counts == {"rows": 7, "valid_rows": 3, "positive": 2, "small": 2, "named": 2}
    assert sorted(tuple(r) for r in gate.valid_rows(df, f"{tmp_path}/out").collect()) == [(1, "a"), (7, "d"), (7, "d")]
    bad = {(r.n, r.name): r.broken for r in gate.quarantined_rows(df, f"{tmp_path}/out", rules).collect()}
    assert bad == {
        (0, "b"): ["positive"], (20, ""): ["small", "named"], (None, "c"): ["positive", "small"], (5, None): ["named"],
    }
    assert gate.split_valid(df.limit(0), rules, f"{tmp_path}/none")["rows"] == 0
    assert gate.valid_rows(df, f"{tmp_path}/none").count() == 0


# ---- small files ----
def test_only_folders_with_files_to_spare_are_packed(spark, tmp_path):
    path = f"{tmp_path}/t"
    many = spark.range(3_000).select("id", F.lit("many").alias("k")).repartition(9)
    one = spark.range(3_000).select("id", F.lit("one").alias("k")).coalesce(1)
    many.unionByName(one).write.partitionBy("k").parquet(path)
    before = files(path)
    sizes = [r["bytes"] for r in compaction.file_sizes(spark.read.parquet(path), ["k"]).where("k = 'many'").collect()]
    assert len(sizes) == 9
    plan = compaction.compact(spark, path, ["k"], target=3 * max(sizes)).collect()
    after = files(path)
    assert len(plan) == 9 and {r["k"] for r in plan} == {"many"}
    assert {f: t for f, t in after.items() if "k=one" in f} == {f: t for f, t in before.items() if "k=one" in f}
    assert 1 <= sum("k=many" in f for f in after) <= 4
    assert spark.read.parquet(path).groupBy("k").agg(F.sum("id").alias("s")).where(f"s = {sum(range(3_000))}").count() == 2
    compaction.compact(spark, path, ["k"], target=1)  # every file is full: nothing is touched
    assert files(path) == after


# ---- co-located tables ----
def test_bucketed_tables_join_and_group_without_a_shuffle(spark):
    left = spark.range(2_000).select((F.col("id") % 300).alias("k"), "id")
    right = spark.range(300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    with colocated.bucketed([left, right], ["k"], 5) as (a, b):
        joined = a.join(b.hint("merge"), "k").groupBy("k").agg(F.sum("v").alias("s"), F.count(F.lit(1)).alias("n"))
        assert "Exchange" not in readers.plan_text(joined) and "SortMergeJoin" in readers.plan_text(joined)
        got = {r.k: (r.s, r.n) for r in joined.collect()}
    assert got == {k: (2 * k * n, n) for k in range(300) for n in [len(range(k, 2_000, 300))]}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


# ---- sketches ----
def test_sketches_merge_to_the_sketch_of_all_rows(spark):
    df = spark.range(30_000).select((F.col("id") % 40).alias("day"), (F.col("id") % 40 % 4).alias("month"), F.pmod(F.xxhash64("id"), F.lit(9_000)).alias("v"))
    daily = sketches.sketched(df, ["month", "day"], F.col("v"))
    merged = {r.month: r.distinct for r in sketches.estimated(sketches.merged(daily, ["month"])).collect()}
    exact = {r.month: r.n for r in df.groupBy("month").agg(F.count_distinct("v").alias("n")).collect()}
    assert all(abs(merged[m] - exact[m]) <= 4 * sketches.relative_error() * exact[m] for m in exact)
    none = sketches.sketched(spark.createDataFrame([(1, None)], "k int, v long"), ["k"], F.col("v"))
    assert [tuple(r) for r in sketches.estimated(none).collect()] == [(1, 0)]


# ---- difference by hash tree ----
def test_tree_difference_finds_what_a_full_comparison_finds(spark):
    a = [(k, float(k), "x", None) for k in range(3_000)] + [(None, 1.0, "n", None), (7, 9.0, "y", 1), (8, 8.0, "x", None)]
    b = [(k, float(k), "x", None) for k in range(3_000) if k not in (5, 6)] + [(None, 1.0, "n", 2), (7, 9.0, "y", 1), (8, 8.5, "x", None)]
    b += [(-1, 0.0, "e", None), (-1, 0.0, "e", None)]
    b = [(k, v + (0.3 if k == 20 else 3.0 if k == 21 else 0), s, n) for k, v, s, n in b]
    schema = "k long, v double, s string, n long"
    left, right = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema).select("s", "n", "v", "k")
    got = {tuple(r) for r in hash_tree.tree_diff(left, right, ["k"], absolute={"v": 0.5}).collect()}
    assert got == {
        (5, "missing", ""), (6, "missing", ""), (-1, "extra", ""), (None, "mismatch", "n"), (21, "mismatch", "v"),
        (8, "duplicate", ""),
    }
    assert hash_tree.tree_diff(left, left.repartition(7), ["k"]).count() == 0
    assert hash_tree.tree_diff(left, right, ["k"], relative={"v": 0.2}).where("k IN (20, 21)").count() == 0
    assert hash_tree.tree_diff(left.limit(0), left, ["k"]).where("verdict = 'extra'").count() == 3_001
    with pytest.raises(ValueError, match="columns differ"):
        hash_tree.tree_diff(left, left.drop("n"), ["k"])


def test_tree_difference_sorts_no_rows(spark):
    left = spark.range(1_000).select("id", (F.col("id") * 2).alias("v"))
    plan = readers.plan_text(hash_tree.tree_diff(left, left.where("id <> 5"), ["id"]))
    assert "Sort [" not in plan and "SortMergeJoin" not in plan
