"""Comparison, sinks, sources, card checks, event logs."""

import json
from decimal import Decimal as D

import pytest
from conftest import collect
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sparkretail.functions import cards
from sparkretail.functions.draws import draw, pick_weighted
from sparkretail.operators import compare, eventlog, ordering
from sparkretail.session import fresh_path
from sparkretail.sources import readers, sinks


def verdicts(diff):
    return {r[0]: (r.verdict, r["columns"]) for r in diff.collect()}


def test_keyed_diff(spark):
    schema = "k INT, amount DECIMAL(10,2), tags ARRAY<STRING>, n INT"
    expected = spark.createDataFrame(
        [(1, D("1.00"), ["a", "b"], 100), (2, D("2.00"), [], 100), (3, D("3.00"), None, 1),
         (4, D("4.00"), [], 1), (5, None, [], 1), (6, None, [], 1), (None, D("1.00"), [], 1), (8, D("1.00"), [], 1)],
        schema,
    )
    actual = spark.createDataFrame(
        [(1, D("1.01"), ["b", "a", "a"], 109), (2, D("2.02"), [], 111), (4, D("4.00"), [], 1), (4, D("4.00"), [], 1),
         (5, D("1.00"), [], 1), (6, None, [], 1), (None, D("1.00"), [], 1), (7, D("7.00"), [], 1), (8, D("1.00"), [], 2)],
        schema,
    )
    tol = compare.Tolerance(absolute={"amount": 0.01}, relative={"n": 0.1}, as_set=["tags"])
    diff = compare.keyed_diff(expected, actual, ["k"], tol)
    assert verdicts(diff) == {
        1: ("equal", []), 2: ("mismatch", ["amount", "n"]), 3: ("missing", []), 4: ("duplicate", []),
        5: ("mismatch", ["amount"]), 6: ("equal", []), None: ("equal", []), 7: ("extra", []),
        8: ("mismatch", ["n"]),
    }
    assert dict(collect(compare.diff_counts(diff))) == {
        "equal": 3, "mismatch": 3, "missing": 1, "duplicate": 1, "extra": 1,
    }
    assert [r.k for r in compare.diff_examples(diff, ["k"], 2).collect()] == [2, 3]
    strict = verdicts(compare.keyed_diff(expected, actual, ["k"]))
    assert strict[1] == ("mismatch", ["amount", "tags", "n"])


def test_row_and_key_diff(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "k INT, v STRING")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "k INT, v STRING")
    assert collect(compare.row_diff(a, b)) == [(1, "x", 1), (3, "z", -1)]
    assert compare.same_rows(a, a.repartition(3)) and not compare.same_rows(a, b)
    assert collect(compare.key_diff(a, b, ["k"])) == [(3, "extra")]


def test_schema_problems_and_parts(spark):
    a = spark.createDataFrame([(1, "x")], "k INT, v STRING")
    assert compare.schema_problems(a, a) == []
    assert compare.schema_problems(a, a.select("v", "k"))
    assert compare.schema_problems(a, a.withColumn("k", F.col("k").cast("bigint"))) == ["k: expected int, got bigint"]
    assert compare.concat_parts([a, a]).count() == 2
    with pytest.raises(ValueError):
        compare.concat_parts([a, a.withColumnRenamed("v", "w")])


def test_parquet_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(100)
    sinks.write_table(rows, path, replace=False)
    with pytest.raises(AnalysisException):
        sinks.write_table(rows, path, replace=False)
    sinks.write_table(rows, path, max_records_per_file=10)
    assert readers.read_table(spark, path).count() == 100
    assert len(list((tmp_path / "t").glob("part-*.parquet"))) >= 10
    pair = readers.read_pair(spark, path, path)
    assert readers.scalar(pair[0].agg(F.max("id"))) == 99
    assert readers.read_table(spark, path, ["id"]).columns == ["id"]


def test_small_result_files(spark, tmp_path):
    rows = spark.createDataFrame([("US", D("1.50")), ("GB", D("2.25"))], "c STRING, fee DECIMAL(18,2)").repartition(4)
    sinks.write_small_csv(rows, str(tmp_path / "csv"))
    files = list((tmp_path / "csv").glob("part-*.csv"))
    assert len(files) == 1 and files[0].read_text().splitlines()[0] == "c,fee"
    assert compare.same_rows(rows, readers.read_csv(spark, str(tmp_path / "csv"), rows.schema))
    sinks.write_small_json(rows, str(tmp_path / "json"))
    assert len(list((tmp_path / "json").glob("part-*.json"))) == 1
    assert compare.same_rows(rows, readers.read_json(spark, str(tmp_path / "json"), rows.schema))


def test_partitioned_layout_splits_crowded_folders_only(spark, tmp_path):
    rows = spark.range(12_000).select(
        F.col("id").cast("string").alias("txn_id"),
        F.when(F.col("id") % 3 > 0, "US").when(F.col("id") % 6 == 0, "GB").alias("country_code"),
        (F.col("id") % 2).cast("int").alias("half"),
    )
    path = tmp_path / "layout"
    sinks.write_partitioned(rows, ["country_code", "half"], str(path), max_records=1_000)
    back = spark.read.schema("txn_id STRING, country_code STRING, half INT").parquet(str(path))
    assert compare.same_rows(rows, back)
    files = lambda folder: list((path / folder).glob("half=*/part-*.parquet"))
    assert len(files("country_code=GB")) == 2
    assert 8 <= len(files("country_code=US")) <= 20
    assert all(spark.read.parquet(str(f)).count() <= 1_000 for f in files("country_code=US"))
    assert "PartitionFilters: [isnotnull(country_code" in readers.plan_text(back.filter("country_code = 'GB'"))


def test_sorted_export_is_globally_ordered_and_splits_a_frequent_value(spark, tmp_path):
    rows = spark.range(8_000).select(
        F.col("id").alias("event_id"), F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id") % 100).alias("amount")
    )
    path = tmp_path / "sorted"
    sinks.write_sorted(rows, ordering.by_amount(), 8, str(path))
    parts = sorted(path.glob("part-*.parquet"))
    seen = [tuple(r) for p in parts for r in spark.read.parquet(str(p)).select("amount", "event_id").collect()]
    assert seen == sorted(seen, key=lambda r: (-r[0], r[1]))
    assert len(seen) == 8_000
    counts = [spark.read.parquet(str(p)).count() for p in parts]
    assert len(parts) == 8 and max(counts) < 2_500


def test_shuffled_keeps_rows(spark):
    rows = spark.range(500)
    out = [r[0] for r in ordering.shuffled(rows, 1).collect()]
    assert sorted(out) == list(range(500)) and out != list(range(500))
    assert out == [r[0] for r in ordering.shuffled(rows.repartition(3), 1).collect()]


def test_sort_helpers(spark):
    rows = spark.createDataFrame([(None,), (2,), (1,)], "k INT")
    assert [r[0] for r in rows.orderBy(*ordering.nulls_last("k")).collect()] == [1, 2, None]


def test_connector_options():
    conf = readers.object_store_conf("http://store:9000", "id", "secret")
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    jdbc = sinks.jdbc_options("jdbc:postgresql://db/x", "customer_aggregates", "u", "p", connections=4)
    assert jdbc["dbtable"] == "customer_aggregates" and jdbc["numPartitions"] == "4"


def luhn(body):
    total = 0
    for i, ch in enumerate(reversed(body)):
        d = int(ch) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def test_luhn(spark):
    bodies = [f"400000{i:09d}" for i in range(0, 90_000, 97)] + ["0", "1", "7992739871", "9" * 18]
    df = spark.createDataFrame([(b,) for b in bodies], "b STRING").withColumn("d", cards.luhn_digit("b"))
    for b, d in df.collect():
        assert d == luhn(b)
    number = F.concat("b", "d")
    assert df.filter(~cards.luhn_valid(number)).isEmpty()
    wrong = F.concat("b", ((F.col("d").cast("int") + 1) % 10).cast("string"))
    assert df.filter(cards.luhn_valid(wrong)).isEmpty()
    odd = spark.createDataFrame([(None,), ("",), ("0",), ("4000x00000000002",), ("1" * 25,)], "n STRING")
    assert odd.filter(cards.luhn_valid("n")).isEmpty()
    assert odd.filter(cards.luhn_valid("n").isNull()).isEmpty()


def test_draws_spread_evenly(spark):
    rows = spark.range(50_000).select(draw("id", 5).alias("a"), draw("id", 6).alias("b"))
    cells = rows.groupBy((F.col("a") % 10).alias("x"), (F.col("b") % 10).alias("y")).count().collect()
    assert len(cells) == 100 and 400 < min(r["count"] for r in cells) and max(r["count"] for r in cells) < 600
    halves = rows.select(pick_weighted(F.col("a"), [("x", 30), ("y", 10)]).alias("v")).groupBy("v").count()
    share = dict(collect(halves))["x"] / 50_000
    assert abs(share - 0.75) < 0.01


def brute_force_profile(text):
    """The metrics of one log from its lines, in plain Python."""
    reads, durations, span, app = {}, {}, {}, {}
    for line in text.splitlines():
        e = json.loads(line)
        if e["Event"] == "SparkListenerTaskEnd":
            s, info, m = e["Stage ID"], e["Task Info"], e.get("Task Metrics") or {}
            r = m.get("Shuffle Read Metrics") or {}
            reads[s] = reads.get(s, 0) + r.get("Remote Bytes Read", 0) + r.get("Local Bytes Read", 0)
            durations.setdefault(s, []).append((info["Finish Time"] - info["Launch Time"]) / 1000)
        elif e["Event"] == "SparkListenerStageCompleted":
            i = e["Stage Info"]
            span[i["Stage ID"]] = (i["Completion Time"] - i["Submission Time"]) / 1000
    heavy = max(s for s in reads if len(durations[s]) >= 4 and reads[s] == max(v for k, v in reads.items() if len(durations[k]) >= 4))
    counted = [d for d in durations[heavy] if d > 0.001]
    return heavy, len(durations[heavy]), round(span[heavy], 2), round(max(counted) / min(counted), 2)


def test_event_log_of_this_session(spark, log_dir, tmp_path):
    spark.range(400_000).repartition(6, (F.col("id") % 1000)).groupBy(F.col("id") % 997).count().count()
    import shutil
    import time

    time.sleep(1)
    source = next(log_dir.glob("*"))
    copy = tmp_path / "app-1"
    shutil.copy(source, copy)
    # The log is still being written; a cut last line is not JSON yet.
    text = copy.read_text()
    copy.write_text(text[: text.rindex("\n") + 1])
    events = eventlog.read_event_log(spark, str(copy))
    stage, n, seconds, ratio = brute_force_profile(copy.read_text())
    heavy = eventlog.heaviest_shuffle_stage(events).first()
    assert (heavy.log, heavy.stage_id, heavy.task_count, heavy.task_skew) == ("app-1", stage, n, ratio)
    profile = eventlog.run_profile(events).first()
    assert profile.spark_app_seconds is None
    assert profile.shuffle_stage_seconds == seconds
    dist = eventlog.task_distribution(events).filter("measure = 'run_ms'").collect()
    assert [r.quantile for r in sorted(dist, key=lambda r: r["quantile"])] == eventlog.QUANTILES


def test_rolled_event_log_is_one_run(spark, tmp_path):
    def line(**fields):
        return json.dumps(fields)

    task = lambda s, ms: line(
        Event="SparkListenerTaskEnd", **{"Stage ID": s, "Task Info": {"Launch Time": 0, "Finish Time": ms},
        "Task Metrics": {"Shuffle Read Metrics": {"Remote Bytes Read": 10, "Local Bytes Read": 5}}},
    )
    folder = tmp_path / "eventlog_v2_app-7"
    folder.mkdir()
    start = line(Event="SparkListenerApplicationStart", Timestamp=1_000)
    (folder / "events_1_app-7").write_text("\n".join([start, task(1, 100), task(1, 200), task(1, 1)]) + "\n")
    end = line(Event="SparkListenerApplicationEnd", Timestamp=3_500)
    (folder / "events_2_app-7").write_text("\n".join([task(1, 800), task(2, 5), end]) + "\n")
    events = eventlog.read_event_log(spark, str(folder))
    row = eventlog.run_profile(events).first()
    # The one-millisecond task does not count for the ratio, the two-task stage not at all.
    assert (row.log, row.spark_app_seconds, row.shuffle_task_skew_ratio) == ("eventlog_v2_app-7", 2.5, 8.0)
    assert eventlog.heaviest_shuffle_stage(events).first().shuffle_bytes == 60


def test_fresh_paths_lie_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    a, b = fresh_path(spark, "x"), fresh_path(spark, "x")
    assert a.startswith(shared) and a != b
